"""Change-feed application: upserts and tombstones into the items table.

Rules (one page = one atomic step, pages applied in order):

* within a page every upsert is applied before every tombstone, whatever the
  row order, so the order key is ``(page_seq, is_tombstone, row_idx)``;
* an upsert inserts or replaces the item (status ``ok``) but leaves the
  folder-rollup columns as they were;
* a tombstone marks an existing item ``deleted`` and refreshes its
  ``collected_at``; a tombstone for an unknown item does nothing;
* a later upsert revives a deleted item.

So per key: payload = the latest upsert (the previous state counts as an
upsert that precedes every change), deleted = the latest tombstone comes after
that upsert.  This is one ``groupBy`` with ``max_by``/``max`` — partial
aggregation keeps a key with many versions cheap, and no window is needed.
Only keys touched by the batch are aggregated; untouched state rows pass
through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.schemas import ITEM_KEY, ITEM_ROLLUP_COLUMNS, ITEMS

ORDER_FIELDS = ["page_seq", "is_tombstone", "row_idx"]
# Optional state columns: the order key of the change that produced a row.
# With them, a change that arrives late but is older than the row loses, so
# pages may be applied in any arrival order.
STATE_ORDER = ["_last_page_seq", "_last_is_tombstone", "_last_row_idx"]
ITEM_COLUMNS = [f.name for f in ITEMS.fields]
PAYLOAD_COLUMNS = [c for c in ITEM_COLUMNS if c not in ITEM_KEY + ITEM_ROLLUP_COLUMNS + ["collected_at"]]


def _order(page_seq: Column, is_tomb: Column, row_idx: Column) -> Column:
    return F.struct(page_seq.cast("long").alias("page_seq"), is_tomb.cast("int").alias("is_tombstone"), row_idx.cast("long").alias("row_idx"))


def _conform(df: DataFrame, columns: list[str]) -> DataFrame:
    types = {f.name: f.dataType for f in ITEMS.fields}
    types.update({"page_seq": "long", "row_idx": "long", "is_tombstone": "boolean"})
    return df.select(
        *[
            (F.col(c) if c in df.columns else F.lit(None)).cast(types.get(c, "string")).alias(c)
            for c in columns
        ]
    )


def _types(columns: list[str]):
    types = {f.name: f.dataType for f in ITEMS.fields}
    return [(c, types[c]) for c in columns]


def affected_keys(changes: DataFrame) -> DataFrame:
    return changes.select(*ITEM_KEY).distinct()


def merge_changes(state: DataFrame | None, changes: DataFrame, keep_ghosts: bool = False) -> DataFrame:
    """Merged rows for the keys present in ``state`` ∪ ``changes``.

    ``changes`` holds change records: item columns (tombstones may leave
    them null) plus ``page_seq``, ``row_idx``, ``is_tombstone`` and
    ``collected_at``.  ``state`` is an items table (or None).
    """
    ch = changes.filter(F.col("id").isNotNull())
    new = _conform(ch, ITEM_KEY + PAYLOAD_COLUMNS + ["collected_at"] + ORDER_FIELDS).select(
        "*",
        F.col("id").isNotNull().alias("_has"),
        F.lit(False).alias("_prior"),
        _order(F.col("page_seq"), F.col("is_tombstone"), F.col("row_idx")).alias("_ord"),
        F.coalesce(F.col("is_tombstone"), F.lit(False)).alias("_tomb"),
        *[F.lit(None).cast("long").alias(c) for c in ITEM_ROLLUP_COLUMNS if c != "folder_total_size_formatted"],
        F.lit(None).cast("string").alias("folder_total_size_formatted"),
    )
    new = new.withColumn("status", F.when(F.col("_tomb"), F.lit(None)).otherwise(F.lit("ok")))
    cols = ITEM_KEY + PAYLOAD_COLUMNS + ["collected_at", "_has", "_prior", "_ord", "_tomb"] + ITEM_ROLLUP_COLUMNS
    union = new.select(*cols)
    if state is not None:
        has_order = all(c in state.columns for c in STATE_ORDER)
        prior_ord = (
            _order(
                F.coalesce(F.col("_last_page_seq"), F.lit(-1)),
                F.coalesce(F.col("_last_is_tombstone"), F.lit(0)),
                F.coalesce(F.col("_last_row_idx"), F.lit(-1)),
            )
            if has_order
            else _order(F.lit(-1), F.lit(0), F.lit(-1))
        )
        # a ghost (a remembered tombstone of a never-seen item) acts as a tombstone
        ghost = F.coalesce(F.col("_ghost"), F.lit(False)) if "_ghost" in state.columns else F.lit(False)
        old = state.select(
            *[(F.col(c) if c in state.columns else F.lit(None)).cast(t).alias(c) for c, t in _types(ITEM_COLUMNS)],
            F.lit(True).alias("_has"), F.lit(True).alias("_prior"),
            prior_ord.alias("_ord"),
            ghost.alias("_tomb"),
        )
        union = old.select(*cols).unionByName(union)

    up_ord = F.when(~F.col("_tomb"), F.col("_ord"))
    payload = F.struct(*[F.col(c) for c in PAYLOAD_COLUMNS])
    agg = union.groupBy(*ITEM_KEY).agg(
        F.max(up_ord).alias("_up"),
        F.max(F.when(F.col("_tomb"), F.col("_ord"))).alias("_dead"),
        F.max_by(payload, up_ord).alias("_p"),
        F.max_by(F.col("collected_at"), F.col("_ord")).alias("collected_at"),
        F.max(F.col("_ord")).alias("_last"),
        *[F.max(F.when(F.col("_prior"), F.col(c))).alias(c) for c in ITEM_ROLLUP_COLUMNS],
    )
    is_ghost = F.col("_up").isNull()
    live = agg.filter(F.col("_up").isNotNull() | (F.lit(keep_ghosts) & F.col("_dead").isNotNull()))
    deleted = is_ghost | (F.col("_dead").isNotNull() & (F.col("_dead") > F.col("_up")))
    out = []
    for c in ITEM_COLUMNS:
        if c in ITEM_KEY or c == "collected_at":
            out.append(F.col(c))
        elif c == "status":
            out.append(F.when(deleted, F.lit("deleted")).otherwise(F.col("_p.status")).alias(c))
        elif c == "raw_json":
            out.append(F.when(deleted, F.coalesce(F.col("_p.raw_json"), F.lit("{}"))).otherwise(F.col("_p.raw_json")).alias(c))
        elif c in ("file_count", "folder_total_size_bytes"):
            out.append(F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c))
        elif c == "folder_total_size_formatted":
            out.append(F.col(c))
        else:
            out.append(F.col(f"_p.{c}").alias(c))
    return live.select(
        *out,
        F.col("_last.page_seq").alias("_last_page_seq"),
        F.col("_last.is_tombstone").alias("_last_is_tombstone"),
        F.col("_last.row_idx").alias("_last_row_idx"),
        is_ghost.alias("_ghost"),
    )


def apply_changes(state: DataFrame | None, changes: DataFrame, keep_ghosts: bool = False) -> DataFrame:
    """The new items table after applying ``changes`` to ``state``.

    With ``keep_ghosts`` a tombstone for an item not (yet) known is kept as
    a hidden row (``_ghost``), so an older upsert of it that arrives later
    is still deleted — needed when pages can land out of order.

    Untouched state rows only meet the batch's key set (semi/anti join); when
    that set is under Spark's broadcast limits the state is scanned in place.
    """
    if state is None:
        return merge_changes(None, changes, keep_ghosts)
    keys = affected_keys(changes.filter(F.col("id").isNotNull()))
    touched = state.join(keys, ITEM_KEY, "left_semi")
    untouched = state.join(keys, ITEM_KEY, "left_anti")
    merged = merge_changes(touched, changes, keep_ghosts)
    carried = list(STATE_ORDER)
    untouched = untouched.select(
        *[F.col(c).cast(t) for c, t in _types([c for c in ITEM_COLUMNS if c in untouched.columns])],
        *[F.lit(None).cast(dict(_types(ITEM_COLUMNS))[c]).alias(c) for c in ITEM_COLUMNS if c not in untouched.columns],
        *[(F.col(c) if c in state.columns else F.lit(None)).cast("long" if c != "_last_is_tombstone" else "int").alias(c) for c in carried],
        (F.coalesce(F.col("_ghost"), F.lit(False)) if "_ghost" in state.columns else F.lit(False)).alias("_ghost"),
    )
    merged = merged.select(*untouched.columns)
    return untouched.unionByName(merged)
