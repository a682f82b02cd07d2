"""Parquet sinks: layer tables and the partitioned inventory dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import format_size
from tessera.operators.ranking import cut_keys, place
from tessera.session import shuffles_dropped, work_table

# The export's default rows per part and the floor it is
# raised to.
ROWS_PER_FILE = 1_000_000
CHUNK_SIZE = 10_000
#: rows, and parts, that a task of the export writes at most if a part is smaller
ROWS_A_TASK, PARTS_A_TASK = 250_000, 500


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, asked of the file system it lies on."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def read_layer(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a layer table; a missing table reads as an empty frame."""
    if not table_exists(spark, path):
        return spark.createDataFrame([], schema or T.StructType([]))
    return spark.read.parquet(path)


def write_layer(df: DataFrame, path: str, name: str = "table") -> dict:
    """Write one layer table (Snappy Parquet, nested values as JSON text) and
    report its row count from an ``observe`` metric of the same job."""
    obs = Observation(f"rows_{name}")
    flat = df.select(
        *[
            F.to_json(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
    flat.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return {"rows": int(obs.get.get("rows", 0)), "file": path}


def in_ordered_parts(df: DataFrame, order: Sequence[Column], rows_per_file: int) -> DataFrame:
    """``df`` in partitions that hold whole parts of ``rows_per_file`` rows of
    the given order (columns, ascending, nulls first): written with
    ``maxRecordsPerFile``, every part but the last has exactly that many rows
    and file names follow the order.  A task gets one large part, or small ones
    up to ``ROWS_A_TASK`` (and ``PARTS_A_TASK``, file names in a task have three
    digits), so that the number of tasks follows the rows, not the parts.

    The rows are written once, as they come, and shuffled once: the keys at
    which a task begins are found first (``cut_keys``).  Where a row lies in
    that table tells rows of one key apart."""
    each = min(max(1, ROWS_A_TASK // rows_per_file), PARTS_A_TASK)
    rows = work_table(df, "export-rows")
    n = rows.count()
    if n <= rows_per_file * each:
        return rows.repartitionById(1, F.lit(0)).sortWithinPartitions(*order)
    key = F.struct(*order, F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")).alias("key")
    cuts, found = cut_keys(rows.select(key), n, rows_per_file * each)
    dealt = place(rows.select("*", key), cuts, found, "_task").drop("key").repartitionById(found + 1, F.col("_task"))
    return dealt.drop("_task").sortWithinPartitions(*order)


def write_inventory(
    df: DataFrame,
    path: str,
    rows_per_file: int = ROWS_PER_FILE,
    chunk_size: int = CHUNK_SIZE,
    order: Sequence[Column] | None = None,
) -> dict:
    """Export the inventory as Snappy Parquet parts.

    ``maxRecordsPerFile`` caps each part; with ``order`` (a total one) the parts
    follow it and are all of that size but the last, else the rows stay in the
    partitions that they come in.  Previous parts are replaced (``overwrite``).
    Totals come from ``observe`` metrics gathered during the write, not from a
    second pass.
    """
    rows_per_file = max(rows_per_file, chunk_size)
    if order is not None:
        df = in_ordered_parts(df, order, rows_per_file)
    obs = Observation("inventory_export")
    is_file = F.col("tipo_item") == "file"
    observed = df.observe(
        obs,
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.when(is_file, F.coalesce(F.col("tamanho_bytes"), F.lit(0)))), F.lit(0)).alias("file_bytes"),
    )
    spark = df.sparkSession
    with shuffles_dropped(spark):
        observed.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)
    metrics = obs.get
    parts = len([f for f in spark.read.parquet(path).inputFiles() if "part-" in f])
    total_bytes = int(metrics.get("file_bytes", 0) or 0)
    formatted = spark.range(1).select(format_size(F.lit(total_bytes)).alias("s")).first()["s"]
    return {
        "inventory_rows": int(metrics.get("rows", 0)),
        "file_total_bytes": total_bytes,
        "file_total_formatted": formatted,
        "dataset_dir": path,
        "part_files": int(parts),
        "rows_per_file": rows_per_file,
    }


def write_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, path: str) -> None:
    """Write ``df`` as a bucketed, sorted Parquet table (external, at
    ``path`` on shared storage).  Tables bucketed on the same key with the
    same bucket count join bucket by bucket, without shuffling either side
    — e.g. items and drives on ``drive_id`` for the export and the silver
    joins when drives are too large to broadcast."""
    (
        df.write.mode("overwrite")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", path)
        .format("parquet")
        .saveAsTable(table)
    )
