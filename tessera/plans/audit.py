"""Collection audit and storage/version metrics.

Audit: expected sites (ranked usage list) are matched to collected sites on
the normalised URL and compared on bytes.  Collected totals are
pre-aggregated per site on each side before the join, so drives and files
are never multiplied against each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import (
    audit_ratio,
    audit_status,
    bytes_to,
    format_size,
    mb_to_bytes,
    normalize_url,
    percent_of,
    round_ratio,
    to_int_or_null,
    version_percent,
)
from tessera.functions.classify import AUDIT_MISSING, AUDIT_OK, AUDIT_UNDER, AUDIT_WARN_RATIO
from tessera.functions.sizes import BYTES_IN_GB
from tessera.functions.text import report_int
from tessera.operators import lookup_join


def collected_per_site(sites: DataFrame, drives: DataFrame, items: DataFrame) -> DataFrame:
    d = drives.groupBy("site_id").agg(F.countDistinct("id").alias("drives"))
    live_files = items.filter((F.col("item_type") == "file") & (F.col("status") != "deleted"))
    i = live_files.groupBy("site_id").agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).cast("long").alias("collected_storage_bytes"),
    )
    s = sites.select(F.col("id").alias("site_id"), F.col("name").alias("site_name"), F.col("web_url").alias("site_url"))
    j = s.join(d, "site_id", "left").join(i, "site_id", "left")
    return j.select(
        "site_id", "site_name", "site_url",
        F.coalesce(F.col("drives"), F.lit(0)).cast("long").alias("drives"),
        F.coalesce(F.col("files"), F.lit(0)).cast("long").alias("files"),
        F.coalesce(F.col("collected_storage_bytes"), F.lit(0)).cast("long").alias("collected_storage_bytes"),
    )


def expected_sites(priority: DataFrame) -> DataFrame:
    """Expected rows from a ranked usage list: bytes as ``int(float(x))``;
    name falls back to the owner."""
    cols = priority.columns
    name = F.col("site_name") if "site_name" in cols else F.lit(None).cast("string")
    owner = F.col("owner") if "owner" in cols else F.lit(None).cast("string")
    expected = report_int(F.col("storage_used_bytes").cast("string"))
    return priority.select(
        F.coalesce(F.col("site_id"), F.lit("")).alias("site_id"),
        F.coalesce(F.col("site_url"), F.lit("")).alias("site_url"),
        F.coalesce(F.nullif(name, F.lit("")), F.nullif(owner, F.lit("")), F.lit("")).alias("site_name"),
        expected.alias("expected_storage_bytes"),
    ).withColumn("expected_storage_formatted", format_size("expected_storage_bytes"))


def audit_sites(expected: DataFrame, collected: DataFrame, warn_ratio: float = AUDIT_WARN_RATIO) -> DataFrame:
    """One row per expected site with status missing / under_collected / ok."""
    by_url = (
        collected.filter(F.col("site_url").isNotNull() & (F.col("site_url") != ""))
        .withColumn("_url", normalize_url("site_url"))
        .groupBy("_url")
        .agg(F.max_by(F.struct("site_id", "site_name", "drives", "files", "collected_storage_bytes"), "site_id").alias("c"))
    )
    e = expected.withColumn("_url", normalize_url("site_url"))
    j = lookup_join(e, by_url, "_url", "left")
    matched = F.col("c").isNotNull()
    collected_bytes = F.coalesce(F.col("c.collected_storage_bytes"), F.lit(0)).cast("long")
    missing_bytes = F.greatest(F.col("expected_storage_bytes") - collected_bytes, F.lit(0))
    return j.select(
        "site_id", "site_url", "site_name", "expected_storage_bytes", "expected_storage_formatted",
        audit_status(matched, collected_bytes, F.col("expected_storage_bytes"), warn_ratio).alias("status"),
        F.when(matched, F.col("c.site_id")).otherwise(F.lit("")).alias("collected_site_id"),
        F.when(matched, F.col("c.site_name")).otherwise(F.lit("")).alias("collected_site_name"),
        F.when(matched, F.col("c.drives")).otherwise(F.lit(0)).cast("long").alias("drives"),
        F.when(matched, F.col("c.files")).otherwise(F.lit(0)).cast("long").alias("files"),
        collected_bytes.alias("collected_storage_bytes"),
        format_size(collected_bytes).alias("collected_storage_formatted"),
        audit_ratio(collected_bytes, F.col("expected_storage_bytes")).alias("collected_vs_expected_ratio"),
        missing_bytes.cast("long").alias("missing_storage_bytes"),
        format_size(missing_bytes).alias("missing_storage_formatted"),
    )


def audit_rollup(audit: DataFrame) -> DataFrame:
    return audit.agg(
        F.count(F.lit(1)).alias("expected_sites"),
        F.count_if(F.col("status") == AUDIT_MISSING).alias("missing_sites"),
        F.count_if(F.col("status") == AUDIT_UNDER).alias("under_collected_sites"),
        F.count_if(F.col("status") == AUDIT_OK).alias("ok_sites"),
    )


# --------------------------------------------------------------------------- storage / version metrics

def metric_rows(results: DataFrame, collected_at: str) -> DataFrame:
    """Collector results → ``site_storage_metrics`` rows (MB → bytes,
    integers parsed, failures → null)."""
    return results.select(
        F.col("site_id").cast("string").alias("site_id"),
        F.col("site_url").cast("string").alias("site_url"),
        mb_to_bytes(F.col("storage_used_mb")).alias("storage_used_bytes"),
        to_int_or_null(F.col("version_count")).alias("version_count"),
        to_int_or_null(F.col("version_size_bytes")).alias("version_size_bytes"),
        F.coalesce(F.col("status").cast("string"), F.lit("failed")).alias("status"),
        F.col("message").cast("string").alias("message"),
        F.lit(collected_at).alias("collected_at"),
    )


def ingest_counts(metrics: DataFrame) -> DataFrame:
    return metrics.agg(
        F.count_if(F.col("status") == "ok").alias("ok"),
        F.count_if(F.col("status") != "ok").alias("failed"),
        F.count(F.lit(1)).alias("total"),
    )


def metrics_report(metrics: DataFrame, sites: DataFrame) -> DataFrame:
    s = sites.select(F.col("id").alias("site_id"), F.col("name").alias("site_name"))
    return (
        lookup_join(metrics, s, "site_id", "left")
        .select(
            "site_id", "site_name", "site_url", "storage_used_bytes", "version_count",
            "version_size_bytes", "status", "message", "collected_at",
        )
        .orderBy(F.desc(F.coalesce(F.col("version_size_bytes"), F.lit(0))), "site_id")
    )


def ok_metrics(metrics: DataFrame, sites: DataFrame) -> DataFrame:
    """Successful metrics with a display name (site name, else URL)."""
    s = sites.select(F.col("id").alias("site_id"), F.col("name").alias("_name"))
    return (
        lookup_join(metrics.filter(F.col("status") == "ok"), s, "site_id", "left")
        .withColumn("site_name", F.coalesce(F.col("_name"), F.col("site_url")))
        .select("site_id", "site_name", "site_url", "storage_used_bytes", "version_count", "version_size_bytes")
    )


def version_kpis(ok: DataFrame) -> DataFrame:
    agg = ok.agg(
        F.coalesce(F.sum("storage_used_bytes"), F.lit(0)).cast("long").alias("storage_used_bytes"),
        F.coalesce(F.sum("version_count"), F.lit(0)).cast("long").alias("version_count"),
        F.coalesce(F.sum("version_size_bytes"), F.lit(0)).cast("long").alias("version_size_bytes"),
    )
    return agg.withColumn(
        "version_percent",
        F.when(F.col("storage_used_bytes") != 0, percent_of("version_size_bytes", F.col("storage_used_bytes"), 1))
        .otherwise(F.lit(0.0)),
    )


def version_table(ok: DataFrame) -> DataFrame:
    return (
        ok.select(
            "site_name",
            F.when(F.col("storage_used_bytes").isNotNull(), round_ratio(F.col("storage_used_bytes"), BYTES_IN_GB, 2, half_even=True)).alias("storage_gb"),
            F.when(F.col("version_size_bytes").isNotNull(), round_ratio(F.col("version_size_bytes"), BYTES_IN_GB, 2, half_even=True)).alias("versoes_gb"),
            "version_count",
            version_percent("version_size_bytes", "storage_used_bytes").alias("pct_versoes"),
            "site_url",
            "site_id",
        )
        .orderBy(F.desc_nulls_last("versoes_gb"), "site_id")
        .drop("site_id")
    )


def version_chart(ok: DataFrame, limit: int = 10) -> DataFrame:
    """Top sites by version space for the chart: GB and a 32-char label."""
    from tessera.functions import shorten_label

    return (
        ok.orderBy(F.desc_nulls_last("version_size_bytes"), "site_id")
        .limit(limit)
        .select(
            "site_id", "site_name", "site_url", "version_count", "version_size_bytes",
            bytes_to("version_size_bytes", "GB").alias("version_gb"),
            shorten_label("site_name").alias("site_label"),
        )
    )
