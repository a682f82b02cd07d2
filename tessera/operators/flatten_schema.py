"""A stored schema for flattened JSON columns, widened batch by batch.

Flattening by each batch's own schema makes columns come and go.  Here the
leaves seen so far are a published table; a batch's leaves (one aggregate, see
``flatten.object_schema``) are merged into it and the batch is flattened by the
result.  Types only widen::

    bigint < double < string < json      boolean, date, … < string < json

A leaf that is an object or an array in some batch and a scalar in another is
JSON text (the leaves below it stay columns of their own), so no column ever
goes, and the merge gives the same schema for any order of batches.  Names come
from the path; of paths whose names differ in case or separators only, the
smallest keeps the name and the others end in a hash of their path.
"""

from __future__ import annotations

import json
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.flatten import _leaves, _path, object_schema, parse_json_object

BIGINT, DOUBLE, STRING, JSON = "bigint", "double", "string", "json"
_WIDER = {BIGINT: 0, DOUBLE: 1, STRING: 2, JSON: 3}
LEAF = T.StructType([T.StructField("path", T.StringType()), T.StructField("type", T.StringType())])


def leaf_type(dt: T.DataType) -> str:
    if isinstance(dt, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return JSON
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return BIGINT
    if isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
        return DOUBLE
    return STRING if isinstance(dt, T.StringType) else dt.simpleString()


def wider(a: str, b: str) -> str:
    """The narrowest type that holds both."""
    if a == b:
        return a
    if a in _WIDER and b in _WIDER:
        return max(a, b, key=_WIDER.get)
    return JSON if JSON in (a, b) else STRING


def merge_leaves(a: dict[tuple, str], b: dict[tuple, str]) -> dict[tuple, str]:
    """Leaves (path -> type) of both; a path that has leaves below it is JSON
    text."""
    out = {p: wider(a.get(p, b.get(p)), b.get(p, a.get(p))) for p in {*a, *b}}
    inner = {p[:k] for p in out for k in range(1, len(p))}
    return {p: JSON if p in inner else t for p, t in out.items()}


def leaves_of(df: DataFrame, col: str) -> dict[tuple, str]:
    return {tuple(keys): leaf_type(dt) for keys, dt in _leaves(object_schema(df, col), [])}


def names_of(leaves: dict[tuple, str], prefix: str, sep: str, taken=()) -> dict[tuple, str]:
    used, out = {c.lower() for c in taken}, {}
    for p in sorted(leaves):
        name = prefix + sep.join(p)
        if name.lower() in used:
            name = f"{name}__{zlib.crc32(json.dumps(p).encode()):08x}"
        used.add(name.lower())
        out[p] = name
    return out


class StoredSchema:
    """The leaves of one JSON column, kept as a published table."""

    def __init__(self, spark: SparkSession, path: str):
        from tessera.sinks.published import PublishedTable

        self.spark, self.table = spark, PublishedTable(spark, path, LEAF, ["path"], buckets=1)

    def leaves(self) -> dict[tuple, str]:
        return {tuple(json.loads(r["path"])): r["type"] for r in self.table.read().collect()}  # a row a column

    def widen(self, df: DataFrame, col: str, attempts: int = 5) -> dict[tuple, str]:
        """Merge a batch's leaves; with two writers each takes in the other's."""
        from tessera.sinks.published import ConflictError

        new = leaves_of(df, col)
        for left in range(attempts - 1, -1, -1):
            version = self.table.version()
            old = {tuple(json.loads(r["path"])): r["type"] for r in self.table.read(version).collect()}
            merged = merge_leaves(old, new)
            if merged == old:
                break
            rows = [(json.dumps(p), t) for p, t in sorted(merged.items())]
            try:
                self.table.overwrite(self.spark.createDataFrame(rows, LEAF), version)
                break
            except ConflictError:
                if not left:
                    raise
        return merged


def flatten_with(df: DataFrame, leaves: dict[tuple, str], col: str = "raw_json", prefix: str = "raw_", sep: str = "_") -> DataFrame:
    """``df`` with a column for each stored leaf, whether the batch holds it or
    not; a value that does not fit its column is null, JSON text takes any."""
    if col not in df.columns:
        return df
    v = parse_json_object(col)
    columns = []
    for p, name in names_of(leaves, prefix, sep, df.columns).items():
        at, kind = _path(list(p)), leaves[p]
        value = F.to_json(F.try_variant_get(v, at, "variant")) if kind == JSON else F.try_variant_get(v, at, kind)
        columns.append(value.alias(name))
    return df.select("*", *columns)
