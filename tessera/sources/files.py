"""File readers: ID lists, storage-metric results, ranked site lists,
layer tables and per-tenant inventory workspaces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import parse_timestamp, py_strip
from tessera.functions.sizes import BYTES_IN_GB
from tessera.schemas import STORAGE_METRIC_RESULT
from tessera.sinks.parquet import read_layer  # noqa: F401  (re-exported)

BOM = "﻿"


def file_order() -> Column:
    """The place of a row read from files: file, block, and the row's id,
    which ascends within a block."""
    at = F.col("_metadata")
    return F.struct(at["file_path"].alias("file"), at["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("row"))


def read_quoted_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header as text columns: ``"`` quotes, a doubled quote inside
    stands for one, quoted values may hold line breaks, blanks stay."""
    return (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("encoding", "UTF-8")
        .csv(path)
    )


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """One id per line: trimmed, BOM dropped, blank and '#' lines skipped;
    ``pos`` keeps the file order (for order-preserving de-duplication)."""
    lines = spark.read.text(path).select(
        py_strip(F.regexp_replace(F.col("value"), "^" + BOM, "")).alias("id"),
        file_order().alias("pos"),
    )
    return lines.filter((F.col("id") != "") & ~F.col("id").startswith("#"))


def distinct_ids(ids: DataFrame) -> DataFrame:
    """Each id once, at its first position."""
    return ids.groupBy("id").agg(F.min("pos").alias("pos"))


def read_storage_metric_results(spark: SparkSession, path: str) -> DataFrame:
    """Collector output files: each a JSON array of results or a single
    result object, with or without a BOM; numbers may be text.  A file is
    one document, so each is parsed whole (one row per file)."""
    text = spark.read.text(path, wholetext=True).select(
        py_strip(F.regexp_replace(F.col("value"), "^" + BOM, "")).alias("doc")
    )
    as_list = F.from_json(F.col("doc"), T.ArrayType(STORAGE_METRIC_RESULT))
    as_one = F.array(F.from_json(F.col("doc"), STORAGE_METRIC_RESULT))
    results = F.when(F.col("doc").startswith("["), as_list).otherwise(as_one)
    return text.select(F.explode(results).alias("r")).select("r.*")


def read_site_priority(spark: SparkSession, path: str) -> DataFrame:
    """A ranked site list written by the priority sink, read back with types
    (dates parsed, a GB column added)."""
    df = read_quoted_csv(spark, path)
    first = df.columns[0]
    if first.startswith(BOM):
        df = df.withColumnRenamed(first, first.lstrip(BOM))
    longs = ["rank", "file_count", "active_file_count", "storage_used_bytes", "storage_allocated_bytes"]
    out = df.select(
        *[F.col(c).try_cast("long").alias(c) if c in longs else F.col(c) for c in df.columns]
    )
    if "last_activity_date" in out.columns:
        out = out.withColumn("last_activity_date", parse_timestamp("last_activity_date"))
    if "storage_used_bytes" in out.columns:
        out = out.withColumn("storage_used_gb", F.col("storage_used_bytes") / F.lit(float(BYTES_IN_GB)))
    return out


def read_workspaces(spark: SparkSession, roots: dict[str, str]) -> DataFrame:
    """Inventory datasets of several tenants, one ``tenant`` column.

    ``roots`` maps a tenant name to its dataset folder (the newest export
    run for that tenant).  Reads are unioned by name so tenants with older
    column sets still line up.
    """
    out = None
    for tenant, path in roots.items():
        df = spark.read.parquet(path).withColumn("tenant", F.lit(tenant))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        return spark.createDataFrame([], T.StructType([T.StructField("tenant", T.StringType())]))
    return out


def latest_runs(runs: DataFrame, tenant_col: str = "tenant", ts_col: str = "run_ts") -> DataFrame:
    """Per tenant, the row of its newest export run (``max_by``)."""
    payload = F.struct(*[F.col(c) for c in runs.columns if c != tenant_col])
    return runs.groupBy(tenant_col).agg(F.max_by(payload, F.col(ts_col)).alias("_r")).select(tenant_col, "_r.*")
