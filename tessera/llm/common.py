"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import ship_package, work_path

#: white space of the line and shingle contracts: [\x20\x09-\x0D]
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: session setting: a query's shuffle files go as soon as it ends
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: cuts the lineage, and a lost executor costs no recomputation.  The
    shuffle files of the write, which nothing reads again, are dropped with it,
    so the steps of an operator do not pile theirs up on disk."""
    spark = df.sparkSession
    path = work_path(spark, name)
    was = spark.conf.get(FILE_CLEANUP, None)
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(FILE_CLEANUP) if was is None else spark.conf.set(FILE_CLEANUP, was)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else (``lower`` also maps other scripts)."""
    return F.translate(c, UPPER, LOWER)


def map_batches(df: DataFrame, fn, schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` whose tasks can import this package."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def map_columns(
    df: DataFrame,
    fields: list[T.StructField],
    fn: Callable[[pa.RecordBatch], list[pa.Array]],
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """Add (or replace) ``fields``, computed Arrow batch by Arrow batch; every
    other column not in ``drop`` rides along."""
    names = [f.name for f in fields]
    keep = [f for f in df.schema.fields if f.name not in drop and f.name not in names]
    schema = T.StructType(keep + fields)
    kept = [f.name for f in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(n)) for n in kept] + fn(b), kept + names)

    return map_batches(df, run, schema)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding."""
    return column(batch, name).cast(pa.binary()).to_pylist()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer on uint64 (the splitmix64 one)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


