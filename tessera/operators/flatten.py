"""Flatten a JSON-object text column into prefixed scalar columns.

The merged schema of all objects in the column is computed by one
distributed aggregation (``schema_of_variant_agg``); only that schema string
reaches the driver.  Leaves are then read with ``variant_get`` on
case-exact JSON paths, so keys that differ only by case, or that hold
``@``/``.``, are addressed without ambiguity.  Text that is not a JSON object
counts as an empty object; arrays and mixed-type leaves become JSON text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_json_object(col) -> Column:
    """JSON text → VARIANT when it is an object, else null."""
    c = F.col(col) if isinstance(col, str) else col
    v = F.try_parse_json(c)
    return F.when(F.schema_of_variant(v).startswith("OBJECT"), v)


def object_schema(df: DataFrame, col: str) -> T.StructType:
    """Merged schema of the JSON objects in ``col`` (empty when none)."""
    row = df.select(F.schema_of_variant_agg(parse_json_object(col)).alias("s")).first()
    text = row["s"] if row is not None else None
    if not text or not text.startswith("OBJECT<"):
        return T.StructType([])
    ddl = text.replace("OBJECT<", "STRUCT<")
    schema = df.sparkSession.createDataFrame([], f"_v {ddl}").schema
    inner = schema.fields[0].dataType
    return inner if isinstance(inner, T.StructType) else T.StructType([])


def _path(keys: list[str]) -> str:
    return "$" + "".join("['" + k.replace("\\", "\\\\").replace("'", "\\'") + "']" for k in keys)


def _leaves(schema: T.StructType, prefix: list[str]):
    for field in schema.fields:
        keys = prefix + [field.name]
        dt = field.dataType
        if isinstance(dt, T.StructType):
            yield from _leaves(dt, keys)
        else:
            yield keys, dt


def _leaf_value(v: Column, keys: list[str], dt: T.DataType) -> Column:
    path = _path(keys)
    if isinstance(dt, (T.ArrayType, T.MapType)):
        return F.to_json(F.try_variant_get(v, path, "variant"))
    if isinstance(dt, (T.StringType, T.VariantType)):
        return F.try_variant_get(v, path, "string")
    if isinstance(dt, T.DecimalType):
        return F.try_variant_get(v, path, "double")
    return F.try_variant_get(v, path, dt.simpleString())


def flatten_json_column(df: DataFrame, col: str = "raw_json", prefix: str = "raw_", sep: str = "_") -> DataFrame:
    if col not in df.columns:
        return df
    schema = object_schema(df, col)
    leaves = list(_leaves(schema, []))
    if not leaves:
        return df
    v = parse_json_object(col)
    taken = {c.lower() for c in df.columns}
    cols = []
    for keys, dt in leaves:
        name = prefix + sep.join(keys)
        base, n = name, 2
        while name.lower() in taken:
            name = f"{base}__{n}"
            n += 1
        taken.add(name.lower())
        cols.append(_leaf_value(v, keys, dt).alias(name))
    return df.select("*", *cols)
