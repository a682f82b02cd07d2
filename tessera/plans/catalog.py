"""Catalogue statistics, run log and error records.

Several one-row statistics over different tables are combined by a union of
one-row partial results and a final aggregate — no cross join, and every
table is read once.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import format_size, is_blocked, run_outcome, truncate_message
from tessera.functions.classify import BLOCKED_CODE, ERROR_MESSAGE_MAX
from tessera.operators.sync import PENDING
from tessera.schemas import ERRORS, RUNS

STAT_FIELDS = ["sites", "drives", "folders", "files", "total_bytes", "open_errors", "blocked_sites", "last_delta_checkpoint"]


def _partial(df: DataFrame, **aggs) -> DataFrame:
    row = df.agg(*[v.alias(k) for k, v in aggs.items()])
    return row.select(
        *[
            (F.col(k) if k in aggs else F.lit(None)).cast("string" if k == "last_delta_checkpoint" else "long").alias(k)
            for k in STAT_FIELDS
        ]
    )


def catalog_stats(
    sites: DataFrame,
    drives: DataFrame,
    items: DataFrame,
    errors: DataFrame,
    sync_state: DataFrame | None,
    include_inventory_totals: bool = True,
    blocked_counts_as_open: bool = False,
) -> DataFrame:
    """One row: sites, drives, live folders/files/bytes, open errors (423
    excluded unless ``blocked_counts_as_open``), distinct blocked sites,
    last checkpoint time, formatted total."""
    live = items.filter(F.col("status") != "deleted")
    is_folder = F.col("item_type") == "folder"
    is_file = F.col("item_type") == "file"
    open_err = errors.filter(~F.coalesce(F.col("resolved"), F.lit(False)))
    open_counted = F.lit(True) if blocked_counts_as_open else (F.coalesce(F.col("status_code"), F.lit(0)) != BLOCKED_CODE)
    parts = [
        _partial(sites, sites=F.count(F.lit(1))),
        _partial(drives, drives=F.count(F.lit(1))),
        _partial(
            open_err,
            open_errors=F.count_if(open_counted),
            blocked_sites=F.count_distinct(F.when(is_blocked("status_code"), F.col("site_id"))),
        ),
    ]
    if sync_state is not None:
        parts.append(_partial(sync_state, last_delta_checkpoint=F.max("updated_at")))
    if include_inventory_totals:
        parts.append(
            _partial(
                live,
                folders=F.count_if(is_folder),
                files=F.count_if(is_file),
                total_bytes=F.coalesce(F.sum(F.when(is_file, F.col("size_bytes"))), F.lit(0)),
            )
        )
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    agg = u.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in STAT_FIELDS if c != "last_delta_checkpoint"],
        F.max("last_delta_checkpoint").alias("last_delta_checkpoint"),
    )
    return agg.withColumn("total_formatted", format_size("total_bytes"))


def summary(sites, drives, items, errors) -> DataFrame:
    """Export summary: like the stats, but every unresolved error is open
    (blocked sites included) and no checkpoint column."""
    stats = catalog_stats(sites, drives, items, errors, None, True, True)
    return stats.select("sites", "drives", "folders", "files", "total_bytes", "open_errors", "total_formatted")


def sync_counts(sync_state: DataFrame) -> DataFrame:
    return sync_state.groupBy("status").agg(F.count(F.lit(1)).alias("total"))


def pending_count(sync_state: DataFrame, site_ids=None) -> DataFrame:
    from tessera.operators.sync import _site_filter

    return _site_filter(sync_state.filter(F.col("status") == PENDING), site_ids).agg(F.count(F.lit(1)).alias("pending"))


def error_records(raw: DataFrame, now_col: str = "created_at") -> DataFrame:
    """Normalise error rows: message cut to 4000 chars, unresolved."""
    return raw.select(
        *[
            truncate_message(F.col("message"), ERROR_MESSAGE_MAX).alias("message") if f.name == "message"
            else F.coalesce(F.col("resolved"), F.lit(False)).alias("resolved") if f.name == "resolved" and "resolved" in raw.columns
            else F.lit(False).alias("resolved") if f.name == "resolved"
            else (F.col(f.name) if f.name in raw.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in ERRORS.fields
        ]
    )


def run_record(spark, run_id: int, command: str, started_at: str, finished_at: str, stats: dict, status: str | None = None) -> DataFrame:
    """One ``runs`` row; the status follows the open-failure rule unless given."""
    delta = stats.get("delta") or {}
    if status is None:
        row = spark.range(1).select(
            run_outcome(F.lit(stats.get("open_errors") or 0), F.lit(delta.get("failed") or 0), F.lit(delta.get("in_progress") or 0)).alias("s")
        ).first()
        status = row["s"]
    return spark.createDataFrame(
        [(run_id, command, started_at, finished_at, status, json.dumps(stats, ensure_ascii=False, default=str))], RUNS
    )


def append_run(run: DataFrame, path: str) -> None:
    run.write.mode("append").parquet(path)
