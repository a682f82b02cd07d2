"""Join helpers.

``lookup_join`` and ``upsert_by_key`` hint no broadcast: Catalyst broadcasts a side whose estimated size
is under ``spark.sql.autoBroadcastJoinThreshold``, and AQE turns a sort-merge
join into a broadcast only when the measured shuffle output of that side is
under ``spark.sql.adaptive.autoBroadcastJoinThreshold``.  Beyond those byte
limits the join stays a shuffle join, whose skewed partitions AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(fact: DataFrame, lookup: DataFrame, on, how: str = "left") -> DataFrame:
    """Join a (possibly huge, possibly skewed) fact table to a lookup table."""
    return fact.join(lookup, on, how)


#: rows of a lookup table that every executor may hold
HELD_ROWS = 2_000_000


def held(lookup: DataFrame) -> DataFrame:
    """``lookup``, hinted for a broadcast unless it has more than ``HELD_ROWS``
    rows.  For the joins of wide rows: Catalyst's estimate of a derived lookup
    may lie far over its size, and then every wide row is shuffled to meet it."""
    return F.broadcast(lookup) if lookup.count() <= HELD_ROWS else lookup


def upsert_by_key(old: DataFrame | None, new: DataFrame, key, keep_old: list[str] | None = None) -> DataFrame:
    """Insert-or-replace by ``key``: rows of ``new`` replace rows of ``old``
    with the same key, except for ``keep_old`` columns (e.g. the first
    ``discovered_at``), which keep the old value when there was one.

    ``new`` is de-duplicated per key beforehand by the caller's rule (the
    last write of a batch wins, see ``operators.dedup.latest_per_key``)."""
    keys = [key] if isinstance(key, str) else list(key)
    if old is None:
        return new
    keep_old = [c for c in (keep_old or []) if c in old.columns]
    kept = old.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in keep_old])
    untouched = old.join(new.select(*keys), keys, "left_anti")
    replaced = new.join(kept, keys, "left")
    for c in keep_old:
        replaced = replaced.withColumn(c, F.coalesce(F.col(f"_old_{c}"), F.col(c))).drop(f"_old_{c}")
    return untouched.unionByName(replaced.select(*old.columns), allowMissingColumns=True)
