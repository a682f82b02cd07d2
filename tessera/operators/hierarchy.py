"""Folder-tree rollup: file count and total bytes of every live folder.

Semantics: a live file counts towards a live folder when every folder on the
way up from the file's parent to that folder is live (deleted folders are
skipped as children and are not updated themselves).  Deleted files never
count.  Links are the ``(drive_id, parent_id)`` pointers, not text paths.

Plan: files are pre-aggregated per parent folder (map-side partial
aggregation, so a folder holding a third of all files costs nothing extra).
Then pointers double: each folder holds the sum over its nearest ``2**k``
levels and a pointer to its ancestor ``2**k`` levels up.  A round adds to
every folder the sums of those folders whose pointer names it and squares the
pointers, so a tree of depth d takes ``log2(d) + 1`` rounds of folder-sized
joins.  Each round is written to the shared checkpoint folder.  Pointers that
still move when no tree of that many folders could be so deep lie on a cycle,
which is reported.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import format_size
from tessera.session import work_path

KEY = ["drive_id", "folder_id"]


def _live(items: DataFrame) -> DataFrame:
    return items.filter(F.col("status") != "deleted")


def _staged(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def folder_totals(items: DataFrame) -> DataFrame:
    """``(drive_id, id, file_count, folder_total_size_bytes)`` for every live
    folder (zeros when it holds nothing).  A cycle of parent pointers raises
    ``ValueError`` with one of its folders."""
    live = _live(items)
    folders = live.filter(F.col("item_type") == "folder").select("drive_id", F.col("id").alias("folder_id"), "parent_id")
    direct = (
        live.filter(F.col("item_type") == "file")
        .groupBy("drive_id", F.col("parent_id").alias("folder_id"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("size_bytes").alias("b"))
    )
    parents = folders.select("drive_id", F.col("folder_id").alias("up"))
    nodes = (
        folders.withColumnRenamed("parent_id", "up")
        .join(parents.withColumn("_live", F.lit(True)), ["drive_id", "up"], "left")
        .withColumn("up", F.when(F.col("_live"), F.col("up")))
        .join(direct, KEY, "left")
        .select(*KEY, "up", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("b", F.lit(0)).alias("b"))
    )
    nodes = _staged(nodes, "rollup")
    count = nodes.count()
    for _ in range(count.bit_length() + 1):
        moving = nodes.filter(F.col("up").isNotNull())
        if moving.limit(1).count() == 0:
            break
        gain = moving.groupBy("drive_id", F.col("up").alias("folder_id")).agg(F.sum("n").alias("dn"), F.sum("b").alias("db"))
        far = nodes.select("drive_id", F.col("folder_id").alias("up"), F.col("up").alias("far"))
        nodes = _staged(
            nodes.join(gain, KEY, "left").join(far, ["drive_id", "up"], "left").select(
                *KEY,
                F.col("far").alias("up"),
                (F.col("n") + F.coalesce("dn", F.lit(0))).cast("long").alias("n"),
                (F.col("b") + F.coalesce("db", F.lit(0))).cast("long").alias("b"),
            ),
            "rollup",
        )
    else:
        stuck = nodes.filter(F.col("up").isNotNull()).orderBy(*KEY).first()
        if stuck is not None:
            raise ValueError(f"folder {stuck['folder_id']!r} of drive {stuck['drive_id']!r} lies below a cycle of parents")
    return nodes.select(
        "drive_id",
        F.col("folder_id").alias("id"),
        F.col("n").cast("long").alias("file_count"),
        F.col("b").cast("long").alias("folder_total_size_bytes"),
    )


def recalculate_folders(items: DataFrame) -> DataFrame:
    """The items table with rollup columns refreshed on live folders.

    Only the folder rows meet the (folder-sized) totals in a join; file rows
    pass through untouched, so the big side is never shuffled for this.
    """
    totals = folder_totals(items).withColumnRenamed("file_count", "_n").withColumnRenamed(
        "folder_total_size_bytes", "_b"
    )
    is_live_folder = (F.col("item_type") == "folder") & (F.col("status") != "deleted")
    passthrough = items.filter(~is_live_folder)
    folders = items.filter(is_live_folder).join(totals, ["drive_id", "id"], "left")
    updated = folders.select(
        *[
            F.coalesce(F.col("_n"), F.lit(0)).cast("long").alias(c) if c == "file_count"
            else F.coalesce(F.col("_b"), F.lit(0)).cast("long").alias(c) if c == "folder_total_size_bytes"
            else format_size(F.coalesce(F.col("_b"), F.lit(0))).alias(c) if c == "folder_total_size_formatted"
            else F.col(c)
            for c in items.columns
        ]
    )
    return passthrough.unionByName(updated)
