"""Deterministic de-duplication and latest-record selection.

Both are single aggregations (``min_by``/``max_by`` are partially
aggregated map-side), so a key with many versions never has to be gathered
into one task the way a window over that key would.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _as_list(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def keep_one(df: DataFrame, key, order: Sequence[Column] | None = None, latest: bool = False) -> DataFrame:
    """One row per ``key``: the one with the smallest ``order`` value (or the
    largest with ``latest=True``).  Without ``order`` the whole row is the
    order, which makes the choice deterministic whatever the input order."""
    keys = _as_list(key)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    payload = F.struct(*[F.col(c) for c in rest])
    ordering = F.struct(*order) if order else payload
    pick = F.max_by(payload, ordering) if latest else F.min_by(payload, ordering)
    return df.groupBy(*keys).agg(pick.alias("_row")).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def latest_per_key(df: DataFrame, key, order: Sequence[Column]) -> DataFrame:
    """Upsert semantics: the most recent record per key by ``order``."""
    return keep_one(df, key, order, latest=True)


def first_positions(df: DataFrame, key: str, position: str) -> DataFrame:
    """Order-preserving de-duplication of a list: each key once, at its first
    position (``dict.fromkeys`` semantics)."""
    return df.groupBy(key).agg(F.min(position).alias(position))
