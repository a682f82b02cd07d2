"""Small helpers shared by the column-function modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str.strip()`` removes for the text
# this engine handles (ASCII whitespace).  Spark's ``trim`` removes spaces only.
PY_WHITESPACE = " \t\n\r\x0b\x0c"


def as_col(value) -> Column:
    """Accept a Column, a column name, or a Python literal."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        return F.col(value)
    return F.lit(value)


def py_strip(value) -> Column:
    """Python ``str.strip()``: remove leading/trailing whitespace."""
    return F.btrim(as_col(value), F.lit(PY_WHITESPACE))


def blank_to_null(value) -> Column:
    """'' or whitespace-only → null (the ``x or None`` idiom)."""
    v = py_strip(value)
    return F.when(v == "", F.lit(None).cast("string")).otherwise(v)


def rtrim_chars(value, chars: str) -> Column:
    """SQL ``RTRIM(chars FROM value)``; argument order differs between the
    SQL form and ``F.rtrim``, so it is pinned down here once."""
    return F.rtrim(as_col(value), F.lit(chars))


def ltrim_chars(value, chars: str) -> Column:
    return F.ltrim(as_col(value), F.lit(chars))
