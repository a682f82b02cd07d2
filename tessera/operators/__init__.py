"""DataFrame operators that Spark does not ship as one call."""

from tessera.operators.dedup import first_positions, keep_one, latest_per_key  # noqa: F401
from tessera.operators.joins import held, lookup_join  # noqa: F401
