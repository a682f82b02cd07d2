"""Drive sync state (checkpoints) and error records as DataFrame transitions.

The state table has one row per drive (``DRIVE_SYNC_STATE``).  Every
transition is a projection with ``when`` plus, where rows are added, a
``left_anti`` join — no row-at-a-time updates.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import truncate_message
from tessera.functions.classify import EXPIRED_TOKEN_CODE, NON_RETRYABLE_CODES, SYNC_MESSAGE_MAX
from tessera.schemas import DRIVE_SYNC_STATE

SYNC_COLUMNS = [f.name for f in DRIVE_SYNC_STATE.fields]

# Sync statuses and the messages the transitions record.
PENDING, IN_PROGRESS, DONE, FAILED = "pending", "in_progress", "done", "failed"
RESUMED_MESSAGE = "Retomado apos interrupcao"
EXPIRED_MESSAGE = "Delta token expirado/invalido. Proxima tentativa fara carga completa."
NO_LINK_MESSAGE = "Resposta delta sem @odata.nextLink nem @odata.deltaLink"


def _site_ids(spark, site_ids: Iterable[str] | DataFrame) -> DataFrame:
    if isinstance(site_ids, DataFrame):
        return site_ids.select(F.col(site_ids.columns[0]).cast("string").alias("_site")).distinct()
    return spark.createDataFrame([(s,) for s in sorted(set(site_ids))], "_site string")


def _site_filter(df: DataFrame, site_ids: Iterable[str] | DataFrame | None, column: str = "site_id") -> DataFrame:
    """``None`` → all rows, empty → none, else the listed sites."""
    if site_ids is None:
        return df
    return df.join(_site_ids(df.sparkSession, site_ids), F.col(column) == F.col("_site"), "left_semi")


def _with_scope(df: DataFrame, site_ids: Iterable[str] | DataFrame | None, column: str = "site_id") -> DataFrame:
    """``df`` with ``_scope``: whether the row's site is among ``site_ids``."""
    if site_ids is None:
        return df.withColumn("_scope", F.lit(True))
    listed = _site_ids(df.sparkSession, site_ids).withColumn("_scope", F.lit(True))
    joined = df.join(listed, F.col(column) == F.col("_site"), "left").drop("_site")
    return joined.withColumn("_scope", F.coalesce("_scope", F.lit(False)))


def _conform(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    types = {f.name: f.dataType for f in DRIVE_SYNC_STATE.fields}
    cols = [(F.col(c) if c in df.columns else F.lit(None)).cast(types[c]).alias(c) for c in SYNC_COLUMNS]
    return df.select(*cols, *[F.col(c) for c in (extra or [])])


def empty_state(spark) -> DataFrame:
    return spark.createDataFrame([], DRIVE_SYNC_STATE)


def sync_from_pages(page_log: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Fold a page log into the sync state.  The last page of a drive
    decides: delta link → ``done``; next link → ``in_progress``; neither →
    the page is an error, the drive goes back to ``pending``."""
    last = page_log.groupBy("drive_id").agg(
        F.max_by(
            F.struct("site_id", "library_name", "next_link", "delta_link", "collected_at", "page_seq"), "page_seq"
        ).alias("p"),
    )
    done = F.col("p.delta_link").isNotNull()
    moving = ~done & F.col("p.next_link").isNotNull()
    broken = ~done & ~moving
    status = F.when(done, F.lit(DONE)).when(moving, F.lit(IN_PROGRESS)).otherwise(F.lit(PENDING))
    new = last.select(
        "drive_id",
        F.col("p.site_id").alias("n_site_id"),
        F.col("p.library_name").alias("n_library_name"),
        status.alias("n_status"),
        F.when(done, F.lit(None).cast("string")).when(moving, F.col("p.next_link")).alias("n_next_link"),
        F.when(done, F.col("p.delta_link")).alias("n_delta_link"),
        F.when(broken, F.lit(NO_LINK_MESSAGE)).alias("n_last_error"),
        broken.alias("n_broken"),
        done.alias("n_done"),
        F.col("p.collected_at").alias("n_at"),
        F.col("p.page_seq").alias("n_page_seq_src"),
    )
    if state is None:
        state = empty_state(page_log.sparkSession)
    last_seq = F.col("_last_page_seq").cast("long") if "_last_page_seq" in state.columns else F.lit(None).cast("long")
    s = _conform(state.withColumn("_last_page_seq_kept", last_seq), extra=["_last_page_seq_kept"]).withColumnRenamed(
        "_last_page_seq_kept", "_last_page_seq"
    )
    new = new.withColumn("n_page_seq", F.col("n_page_seq_src"))
    j = s.join(new, "drive_id", "full_outer")
    # a page older than the drive's last applied page (late arrival) changes nothing
    has_new = F.col("n_status").isNotNull() & (F.col("_last_page_seq").isNull() | (F.col("n_page_seq") > F.col("_last_page_seq")))

    def pick(new_col, old_col):
        return F.when(has_new, new_col).otherwise(F.col(old_col))

    return j.select(
        "drive_id",
        F.coalesce(F.col("n_site_id"), F.col("site_id")).alias("site_id"),
        F.coalesce(F.col("n_library_name"), F.col("library_name")).alias("library_name"),
        F.col("mode"),
        pick(F.col("n_status"), "status").alias("status"),
        F.coalesce(F.col("attempts"), F.lit(0)).cast("int").alias("attempts"),
        pick(F.when(F.col("n_broken"), F.col("next_link")).otherwise(F.col("n_next_link")), "next_link").alias("next_link"),
        pick(F.when(F.col("n_done"), F.col("n_delta_link")).otherwise(F.col("delta_link")), "delta_link").alias("delta_link"),
        pick(F.when(F.col("n_broken"), F.col("n_last_error")).when(F.col("n_done"), F.lit(None)).otherwise(F.col("last_error")), "last_error").alias("last_error"),
        F.coalesce(F.col("created_at"), F.col("n_at")).alias("created_at"),
        pick(F.col("n_at"), "updated_at").alias("updated_at"),
        F.col("last_started_at"),
        pick(F.when(F.col("n_done"), F.col("n_at")).otherwise(F.col("last_completed_at")), "last_completed_at").alias("last_completed_at"),
        F.when(has_new, F.col("n_page_seq")).otherwise(F.col("_last_page_seq")).alias("_last_page_seq"),
    )


def sync_state_columns(df: DataFrame) -> DataFrame:
    """The public sync-state columns (drops the bookkeeping column)."""
    return df.select(*SYNC_COLUMNS)


def prepare(state: DataFrame, drives: DataFrame, now: str, reset_completed: bool = False, site_ids=None) -> DataFrame:
    """Register drives without a state row as pending, send interrupted
    drives back to pending, and optionally re-queue completed ones."""
    s = _with_scope(_conform(state), site_ids)
    scope = F.col("_scope")
    status = (
        F.when(scope & (F.col("status") == IN_PROGRESS), F.lit(PENDING))
        .when(scope & F.lit(reset_completed) & (F.col("status") == DONE), F.lit(PENDING))
        .otherwise(F.col("status"))
    )
    last_error = (
        F.when(scope & (F.col("status") == IN_PROGRESS), F.coalesce(F.col("last_error"), F.lit(RESUMED_MESSAGE)))
        .when(scope & F.lit(reset_completed) & (F.col("status") == DONE), F.lit(None))
        .otherwise(F.col("last_error"))
    )
    touched = scope & ((F.col("status") == IN_PROGRESS) | (F.lit(reset_completed) & (F.col("status") == DONE)))
    updated = s.withColumn("last_error", last_error).withColumn(
        "updated_at", F.when(touched, F.lit(now)).otherwise(F.col("updated_at"))
    ).withColumn("status", status).drop("_scope")
    missing = _site_filter(drives, site_ids).join(
        s.select(F.col("drive_id").alias("id")), "id", "left_anti"
    ).select(
        F.col("id").alias("drive_id"), "site_id", F.col("name").alias("library_name"),
        F.lit(PENDING).alias("status"), F.lit(0).alias("attempts"),
        F.lit(now).alias("created_at"), F.lit(now).alias("updated_at"),
    )
    return updated.unionByName(_conform(missing))


def reset(state: DataFrame, now: str, site_ids=None) -> DataFrame:
    """Forget checkpoints: pending, no links, no error."""
    s = _with_scope(_conform(state), site_ids)
    scope = F.col("_scope")
    cols = {
        "status": F.lit(PENDING), "next_link": F.lit(None), "delta_link": F.lit(None),
        "last_error": F.lit(None), "updated_at": F.lit(now),
    }
    return s.select(*[F.when(scope, cols[c]).otherwise(F.col(c)).cast(s.schema[c].dataType).alias(c) if c in cols else F.col(c) for c in SYNC_COLUMNS])


def reset_site(tables: dict[str, DataFrame], site_id: str, now: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Drop a site's items and errors, reset its drives' checkpoints and
    processed flags.  Returns the new tables and a one-row count frame."""
    site_id = (site_id or "").strip()
    if not site_id:
        raise ValueError("site_id must not be blank")
    sites, drives, items = tables["sites"], tables["drives"], tables["items"]
    state, errors = tables["drive_sync_state"], tables["errors"]
    counts = (
        sites.filter(F.col("id") == site_id).select(F.lit("sites").alias("table"))
        .unionByName(drives.filter(F.col("site_id") == site_id).select(F.lit("drives").alias("table")))
        .unionByName(items.filter(F.col("site_id") == site_id).select(F.lit("items").alias("table")))
        .unionByName(state.filter(F.col("site_id") == site_id).select(F.lit("drive_sync_state").alias("table")))
        .unionByName(errors.filter(F.col("site_id") == site_id).select(F.lit("errors").alias("table")))
        .groupBy().pivot("table", ["sites", "drives", "items", "drive_sync_state", "errors"]).count()
        .na.fill(0)
    )
    hit = F.col("site_id") == site_id
    s = _conform(state)
    reset_cols = {
        "status": F.lit(PENDING), "attempts": F.lit(0), "next_link": F.lit(None), "delta_link": F.lit(None),
        "last_error": F.lit(None), "updated_at": F.lit(now), "last_started_at": F.lit(None),
        "last_completed_at": F.lit(None),
    }
    new_state = s.select(
        *[F.when(hit, reset_cols[c]).otherwise(F.col(c)).cast(s.schema[c].dataType).alias(c) if c in reset_cols else F.col(c) for c in SYNC_COLUMNS]
    )
    out = dict(tables)
    out["items"] = items.filter(~hit | F.col("site_id").isNull())
    out["errors"] = errors.filter(~hit | F.col("site_id").isNull())
    out["drive_sync_state"] = new_state
    out["drives"] = drives.withColumn("processed_at", F.when(hit, F.lit(None)).otherwise(F.col("processed_at")))
    out["sites"] = sites.withColumn("processed_at", F.when(F.col("id") == site_id, F.lit(None)).otherwise(F.col("processed_at")))
    return out, counts


def drive_error_retryable(status_code) -> F.Column:
    """A failed drive sync is retried unless the error is 401/403/404."""
    c = F.col(status_code) if isinstance(status_code, str) else status_code
    return F.coalesce(~c.isin(NON_RETRYABLE_CODES), F.lit(True))


def apply_failures(state: DataFrame, errors: DataFrame) -> DataFrame:
    """Fold each drive's latest sync error (if newer than its last step)
    into its state: an expired token
    (410) clears the links and re-queues; other errors re-queue when
    retryable, else fail; the message is cut to 2000 characters."""
    latest = (
        errors.filter(F.col("drive_id").isNotNull())
        .groupBy("drive_id")
        .agg(F.max_by(F.struct("status_code", "message", "created_at"), F.struct("created_at", "id")).alias("e"))
    )
    s = _conform(state).join(latest, "drive_id", "left")
    # only errors newer than the drive's last recorded step change it
    has = F.col("e").isNotNull() & (F.col("updated_at").isNull() | (F.col("e.created_at") > F.col("updated_at")))
    expired = has & (F.col("e.status_code") == EXPIRED_TOKEN_CODE)
    status = (
        F.when(expired, F.lit(PENDING))
        .when(has & drive_error_retryable(F.col("e.status_code")), F.lit(PENDING))
        .when(has, F.lit(FAILED))
        .otherwise(F.col("status"))
    )
    return s.select(
        *[
            status.alias(c) if c == "status"
            else F.when(expired, F.lit(None)).otherwise(F.col(c)).alias(c) if c in ("next_link", "delta_link")
            else F.when(has, truncate_message(F.col("e.message"), SYNC_MESSAGE_MAX)).otherwise(F.col(c)).alias(c) if c == "last_error"
            else F.when(has, F.col("e.created_at")).otherwise(F.col(c)).alias(c) if c == "updated_at"
            else F.col(c)
            for c in SYNC_COLUMNS
        ]
    )


def clear_items(items: DataFrame, site_ids=None) -> DataFrame:
    """Items kept after a checkpoint reset with ``clear_items``: those of
    the site set go (``None`` = every site, empty set = none)."""
    if site_ids is None:
        return items.limit(0)
    ids = list(site_ids)
    return items.filter(~F.col("site_id").isin(ids) | F.col("site_id").isNull()) if ids else items
