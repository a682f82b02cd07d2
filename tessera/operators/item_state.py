"""Item states: change records folded so that they can be folded further.

``operators.changes`` gives the items table; here the fold is kept open.  An
item's state is its last upsert and its last tombstone, each with its place in
the drive's order ``(page_seq, is_tombstone, row_idx)``.  Both are maxima, so
states compose associatively and in any order: a snapshot of states plus the
changes of later pages (or of earlier pages that landed late) is the state of
all pages.

* ``fence``: a reset wipes what a drive's pages up to ``fence`` brought.  As
  the state holds the last upsert and the last tombstone, dropping those at or
  below the fence equals folding only the pages above it.
* ``reconcile``: after a complete relist (see ``events.relists``) an item of
  the drive that the relist did not bring is gone, although no page said so.
* The rollup columns belong to the folder rollup: changes never set them, they
  ride with the state that has them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.changes import ITEM_COLUMNS, PAYLOAD_COLUMNS, affected_keys
from tessera.schemas import ITEM_KEY, ITEM_ROLLUP_COLUMNS, ITEMS

_TYPES = {f.name: f.dataType for f in ITEMS.fields}
STATE_COLUMNS = [*ITEM_KEY, "up", "dead", "rollup"]


def _rollup(df: DataFrame) -> Column:
    return F.struct(*[(F.col(c) if c in df.columns else F.lit(None)).cast(_TYPES[c]).alias(c) for c in ITEM_ROLLUP_COLUMNS])


def states_of(changes: DataFrame) -> DataFrame:
    """``drive_id, id, up, dead, rollup`` of change records: one aggregate,
    with partial sums before the shuffle."""
    tomb = F.coalesce("is_tombstone", F.lit(False))
    order = F.struct(F.col("page_seq").cast("long").alias("page_seq"), tomb.cast("int").alias("is_tombstone"), F.col("row_idx").cast("long").alias("row_idx"))
    columns = {
        c: (F.lit("ok") if c == "status" else F.col(c) if c in changes.columns else F.lit(None)).cast(_TYPES[c]) for c in PAYLOAD_COLUMNS
    }
    at = F.col("collected_at").cast("string").alias("at")
    up = F.struct(order.alias("ord"), at, F.struct(*[c.alias(n) for n, c in columns.items()]).alias("payload"))
    dead = F.struct(order.alias("ord"), at)
    rows = changes.filter("id is not null and drive_id is not null")
    return rows.groupBy(*ITEM_KEY).agg(
        F.max_by(up, F.when(~tomb, order)).alias("up"), F.max_by(dead, F.when(tomb, order)).alias("dead")
    ).withColumn("rollup", _rollup(rows.select()))


def merge_states(states: DataFrame, more: DataFrame) -> DataFrame:
    """Both folded together.  States that ``more`` does not touch only meet its
    keys, which Spark broadcasts where they are small."""
    keys = affected_keys(more)
    touched = states.join(keys, ITEM_KEY, "left_semi").unionByName(more)
    merged = touched.groupBy(*ITEM_KEY).agg(
        F.max_by("up", "up.ord").alias("up"), F.max_by("dead", "dead.ord").alias("dead"),
        F.max_by("rollup", F.when(F.col("rollup.file_count").isNotNull(), 1)).alias("rollup"),
    )
    none = _rollup(states.select())
    return states.join(keys, ITEM_KEY, "left_anti").select(*STATE_COLUMNS).unionByName(
        merged.withColumn("rollup", F.coalesce("rollup", none)).select(*STATE_COLUMNS)
    )


def fence(states: DataFrame, fences: DataFrame) -> DataFrame:
    """``states`` without what lies at or below its drive's fence; ``fences``
    has one row a drive (drive_id, fence)."""
    limits = fences.select("drive_id", F.col("fence").alias("_fence"))
    joined = states.join(limits, "drive_id", "left")
    above = lambda c: F.col("_fence").isNull() | (F.col(f"{c}.ord.page_seq") > F.col("_fence"))
    up = F.when(above("up"), F.col("up"))
    return joined.select(
        *ITEM_KEY, up.alias("up"), F.when(above("dead"), F.col("dead")).alias("dead"),
        F.when(up.isNotNull(), F.col("rollup")).otherwise(_rollup(states.select())).alias("rollup"),
    ).filter("up is not null or dead is not null")


def fence_changes(changes: DataFrame, fences: DataFrame) -> DataFrame:
    """Change records above their drive's fence."""
    limits = fences.select("drive_id", F.col("fence").alias("_fence"))
    return changes.join(limits, "drive_id", "left").filter("_fence is null or page_seq > _fence").drop("_fence")


def with_rollup(states: DataFrame, items: DataFrame) -> DataFrame:
    """``states`` carrying the rollup columns of an items table."""
    totals = items.select(*ITEM_KEY, _rollup(items).alias("_rollup")).filter("_rollup.file_count is not null")
    return states.join(totals, ITEM_KEY, "left").withColumn("rollup", F.coalesce("_rollup", "rollup")).select(*STATE_COLUMNS)


def reconcile(states: DataFrame, relists: DataFrame) -> DataFrame:
    """``states`` with a tombstone, at the relist's last page, for every item
    that its drive's last complete relist did not bring."""
    joined = states.join(relists, "drive_id", "left")
    missed = (F.col("up.ord.page_seq") <= F.col("relist_from")) & (
        F.col("dead").isNull() | (F.col("dead.ord") < F.col("up.ord"))
    )  # an item that a page deleted keeps that page's tombstone
    order = F.struct(F.col("relist_to").alias("page_seq"), F.lit(1).alias("is_tombstone"), F.lit(-1).cast("long").alias("row_idx"))
    dead = F.when(missed, F.struct(order.alias("ord"), F.col("relist_at").alias("at"))).otherwise(F.col("dead"))
    return joined.withColumn("dead", dead).select(*STATE_COLUMNS)


def items_of(states: DataFrame) -> DataFrame:
    """The public items table of folded states; tombstones of items never seen
    are no items."""
    deleted = F.coalesce(F.col("dead.ord") > F.col("up.ord"), F.lit(False))
    out = []
    for c in ITEM_COLUMNS:
        if c in ITEM_KEY:
            value = F.col(c)
        elif c == "collected_at":
            value = F.when(deleted, F.col("dead.at")).otherwise(F.col("up.at"))
        elif c == "status":
            value = F.when(deleted, F.lit("deleted")).otherwise(F.lit("ok"))
        elif c == "raw_json":
            value = F.when(deleted, F.coalesce(F.col("up.payload.raw_json"), F.lit("{}"))).otherwise(F.col("up.payload.raw_json"))
        elif c in ("file_count", "folder_total_size_bytes"):
            value = F.coalesce(F.col(f"rollup.{c}"), F.lit(0)).cast("long")
        elif c in ITEM_ROLLUP_COLUMNS:
            value = F.col(f"rollup.{c}")
        else:
            value = F.col(f"up.payload.{c}")
        out.append(value.alias(c))
    return states.filter("up is not null").select(*out)
