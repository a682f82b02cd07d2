"""Global ranking without a single-partition window.

``row_number().over(Window.orderBy(...))`` moves every row into one task.
``global_positions`` instead range-partitions the rows by the order (a
normal distributed sort), counts rows per sorted partition (one small row
per partition), turns the counts into offsets, and adds each row's index
inside its partition.  The sorted rows are checkpointed first so partition
ids and in-partition order are fixed when the counts are taken.

``cut_keys`` finds the keys at every n-th place of an order without sorting
the rows: it counts them between the keys of a sample, and sorts the keys of
those stretches alone that hold such a place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.session import work_table


def global_positions(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Add ``name`` = 1..n following ``order`` (which should be a total order)."""
    staged = (
        df.orderBy(*order)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint()
    )
    # One row per partition of the sorted data: bounded by the partition
    # count, not by the data, so ordering these few rows is free.
    counts = staged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_off"),
    )
    within = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (
        staged.join(F.broadcast(offsets), "_pid")
        .withColumn(name, (F.col("_off") + within + 1).cast("long"))
        .drop("_pid", "_mid", "_off")
    )


#: keys sampled for each cut, and in all; more make the sorted stretches shorter
SAMPLE_A_CUT, SAMPLE_KEYS = 32, 200_000


def place(df: DataFrame, bounds: DataFrame, n: int, name: str) -> DataFrame:
    """Add ``name``: how many of the ``n`` ascending keys of ``bounds`` (one
    row, an array ``keys``) are at most ``key``, by bisection."""
    keys, at = bounds.select("keys").scalar(), F.col(name)
    df = df.withColumn(name, F.lit(0))
    for step in reversed([1 << k for k in range(n.bit_length())]):
        # beyond the last key ``get`` is null, which is not at most ``key``
        df = df.withColumn(name, F.when(F.col("key") >= F.get(keys, at + (step - 1)), at + step).otherwise(at))
    return df


def _as_bounds(keys: DataFrame) -> tuple[DataFrame, int]:
    """``keys`` sorted into one row, and their number.  Made of the collected
    row, for a file would not keep which fields are never null, and each
    comparison would then cast them."""
    row = keys.agg(F.sort_array(F.collect_list("key")).alias("keys"))
    found = row.first()["keys"]
    return keys.sparkSession.createDataFrame([(found,)], row.schema, verifySchema=False), len(found)


def cut_keys(keys: DataFrame, n: int, every: int) -> tuple[DataFrame, int]:
    """The keys at places ``every``, 2 ``every``, ... (from 0) of the ``n``
    ascending values of ``key``, all different, as one row with an array
    ``keys``, and their number.  ``keys`` is read three times: it has to be a
    table, and narrow.  The sample only says where to count; any sample gives
    the same cuts."""
    cuts = max(0, -(-n // every) - 1)
    wanted = min(SAMPLE_A_CUT * cuts, SAMPLE_KEYS)
    placed = place(keys, *_as_bounds(keys.sample(min(1.0, wanted / max(1, n)), 7)), "stretch")
    counts = placed.groupBy("stretch").agg(F.count(F.lit(1)).alias("n"))  # a row a sampled key at most
    before = F.coalesce(F.sum("n").over(Window.orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = F.greatest(F.ceil(F.col("before") / every), F.lit(1))  # cuts of a stretch: first to last
    last = F.ceil((F.col("before") + F.col("n")) / every) - 1
    held = work_table(
        counts.withColumn("before", before).withColumns({"first": first, "last": last}).filter("first <= last")
        .select("stretch", F.explode(F.sequence("first", "last")).alias("cut"), "before")
        .select("stretch", (F.col("cut") * every - F.col("before") + 1).alias("rank")),
        "cuts",
    )
    near = placed.join(F.broadcast(held.select("stretch").distinct()), "stretch", "left_semi")
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("stretch").orderBy("key")).cast("long"))
    return _as_bounds(ranked.join(F.broadcast(held), ["stretch", "rank"]))
