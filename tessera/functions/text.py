"""Text cleaning, number parsing, truthy flags and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.common import as_col, py_strip

# Labels the reports use for missing names and extensions.
NO_NAME = "(sem nome)"
NO_LIBRARY = "(sem biblioteca)"
NO_EXTENSION = "(sem extensao)"

# Text accepted as "true" by the settings/flag parser, in order.
TRUTHY_VALUES = ["1", "true", "yes", "y", "sim"]

LABEL_MAX_CHARS = 32


def clean_text(value, default: str = "") -> Column:
    """``fillna(default).astype(str).str.strip()`` — null → default, then
    strip; a blank string stays blank."""
    return py_strip(F.coalesce(as_col(value).cast("string"), F.lit(default)))


def label_or_default(value, label: str = NO_EXTENSION) -> Column:
    """``COALESCE(NULLIF(x, ''), label)``."""
    v = as_col(value)
    return F.coalesce(F.nullif(v, F.lit("")), F.lit(label))


def is_truthy(value) -> Column:
    """Settings flag: trimmed, lower-cased text in the truthy set."""
    return F.coalesce(F.lower(py_strip(as_col(value))).isin(TRUTHY_VALUES), F.lit(False))


def is_true_text(value) -> Column:
    """``x.strip().lower() == 'true'`` (usage report 'Is Deleted')."""
    return F.coalesce(F.lower(py_strip(as_col(value))) == F.lit("true"), F.lit(False))


def report_int(value) -> Column:
    """Usage-report integer: strip, drop ',' thousands separators,
    ``int(float(x))`` (truncate toward zero); blank or bad → 0."""
    cleaned = F.replace(py_strip(as_col(value).cast("string")), F.lit(","), F.lit(""))
    as_double = cleaned.try_cast("double")
    return F.coalesce(as_double.try_cast("long"), F.lit(0).cast("long"))


def to_long_or_zero(value) -> Column:
    """``pd.to_numeric(errors='coerce').fillna(0).astype(int64)``."""
    v = as_col(value)
    return F.coalesce(
        v.try_cast("long"), v.try_cast("double").try_cast("long"), F.lit(0).cast("long")
    )


def to_int_or_null(value) -> Column:
    """``int(x)`` with failure → None (integral text or numbers)."""
    return as_col(value).try_cast("long")


def shorten_label(value, max_chars: int = LABEL_MAX_CHARS) -> Column:
    """Chart label: null/'' → '(sem nome)'; strip; longer than ``max_chars``
    → first ``max_chars - 1`` characters + '...'."""
    v = as_col(value)
    text = py_strip(v)
    short = F.when(
        F.length(text) <= max_chars, text
    ).otherwise(F.concat(F.substring(text, 1, max_chars - 1), F.lit("...")))
    return F.when(v.isNull() | (v == ""), F.lit(NO_NAME)).otherwise(short)


def truncate_message(value, max_chars: int) -> Column:
    """``message[:n]``."""
    return F.substring(as_col(value), 1, max_chars)
