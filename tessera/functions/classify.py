"""Classification rules: storage tiers, activity, quota, audit, errors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.common import as_col
from tessera.functions.sizes import BYTES_IN_GB, BYTES_IN_TB, percent_of, round_ratio

# Default tier thresholds (bytes) and tier names with labels.
OVER_1TB_BYTES = BYTES_IN_TB
OVER_500GB_BYTES = 500 * BYTES_IN_GB
OVER_100GB_BYTES = 100 * BYTES_IN_GB
TIERS = [
    ("over_1tb", ">= 1 TB"),
    ("over_500gb_to_1tb", ">= 500 GB e < 1 TB"),
    ("over_100gb_to_500gb", ">= 100 GB e < 500 GB"),
    ("under_100gb", "< 100 GB"),
]

# Site activity classes and their day thresholds.
ACTIVITY_NONE = "Sem atividade registrada"
ACTIVITY_INACTIVE = "Inativo"
ACTIVITY_LOW = "Pouco ativo"
ACTIVITY_ACTIVE = "Ativo"
INACTIVE_AFTER_DAYS = 180
LOW_ACTIVITY_AFTER_DAYS = 90

# Storage-limit classes and the "default" quota threshold.
LIMIT_NONE = "Sem limite reportado"
LIMIT_DEFAULT = "Limite alto/padrao reportado"
LIMIT_SPECIFIC = "Limite especifico aparente"
DEFAULT_QUOTA_BYTES = 25 * BYTES_IN_TB

# Audit statuses and the default warning ratio.
AUDIT_MISSING = "missing"
AUDIT_UNDER = "under_collected"
AUDIT_OK = "ok"
AUDIT_WARN_RATIO = 0.8

# HTTP status codes with special error handling.
NON_RETRYABLE_CODES = [401, 403, 404]
BLOCKED_CODE = 423
EXPIRED_TOKEN_CODE = 410
ERROR_MESSAGE_MAX = 4000
SYNC_MESSAGE_MAX = 2000


def storage_tier(
    used_bytes,
    over_1tb: int = OVER_1TB_BYTES,
    over_500gb: int = OVER_500GB_BYTES,
    over_100gb: int = OVER_100GB_BYTES,
) -> Column:
    """Tier name of a site by storage used.  Rows that fit no tier (only
    possible with inconsistent thresholds) get null, as in the reference,
    where such a site lands in no group."""
    b = as_col(used_bytes)
    return (
        F.when(b >= over_1tb, F.lit(TIERS[0][0]))
        .when((b >= over_500gb) & (b < over_1tb), F.lit(TIERS[1][0]))
        .when((b >= over_100gb) & (b < over_500gb), F.lit(TIERS[2][0]))
        .when(b < over_100gb, F.lit(TIERS[3][0]))
    )


def activity_class(last_activity, as_of) -> Column:
    parsed = as_col(last_activity).cast("string").try_cast("timestamp")
    days = F.datediff(as_col(as_of), F.to_date(parsed))
    return (
        F.when(days.isNull(), F.lit(ACTIVITY_NONE))
        .when(days > INACTIVE_AFTER_DAYS, F.lit(ACTIVITY_INACTIVE))
        .when(days > LOW_ACTIVITY_AFTER_DAYS, F.lit(ACTIVITY_LOW))
        .otherwise(F.lit(ACTIVITY_ACTIVE))
    )


def limit_class(allocated_bytes) -> Column:
    a = as_col(allocated_bytes)
    return (
        F.when(a.isNull() | (a <= 0), F.lit(LIMIT_NONE))
        .when(a >= DEFAULT_QUOTA_BYTES, F.lit(LIMIT_DEFAULT))
        .otherwise(F.lit(LIMIT_SPECIFIC))
    )


def quota_percent(used_bytes, allocated_bytes) -> Column:
    """``used / allocated * 100``; 0 when allocated is 0 or null."""
    used = as_col(used_bytes).cast("double")
    alloc = as_col(allocated_bytes).cast("double")
    return F.coalesce(F.try_divide(used, F.nullif(alloc, F.lit(0.0))) * F.lit(100.0), F.lit(0.0))


def version_percent(version_bytes, storage_bytes, scale: int = 1) -> Column:
    """Share of storage held by versions, in percent, rounded; null unless
    storage > 0."""
    v = as_col(version_bytes)
    s = as_col(storage_bytes)
    return F.when(s > 0, percent_of(v, s, scale))


def audit_ratio(collected_bytes, expected_bytes, scale: int = 4) -> Column:
    """collected / expected rounded to 4 places (ties to even); 1.0 when
    nothing is expected."""
    c = as_col(collected_bytes)
    e = as_col(expected_bytes)
    return F.when(e == 0, F.lit(1.0)).otherwise(round_ratio(c, e, scale, half_even=True))


def audit_status(matched, collected_bytes, expected_bytes, warn_ratio: float = AUDIT_WARN_RATIO) -> Column:
    c = as_col(collected_bytes).cast("double")
    e = as_col(expected_bytes)
    return (
        F.when(~as_col(matched), F.lit(AUDIT_MISSING))
        .when((e != 0) & ((c / e.cast("double")) < F.lit(warn_ratio)), F.lit(AUDIT_UNDER))
        .otherwise(F.lit(AUDIT_OK))
    )


def is_retryable(status_code) -> Column:
    """An error is retried unless it is an auth/not-found error or a blocked
    site (423); unknown codes are retried."""
    code = as_col(status_code)
    return F.coalesce(~code.isin(NON_RETRYABLE_CODES + [BLOCKED_CODE]), F.lit(True))


def is_blocked(status_code) -> Column:
    return F.coalesce(as_col(status_code) == BLOCKED_CODE, F.lit(False))


def run_outcome(open_errors, failed_drives, in_progress_drives) -> Column:
    """A finished run is 'completed_with_errors' if anything is left open."""
    has_open = (
        (F.coalesce(as_col(open_errors), F.lit(0)) > 0)
        | (F.coalesce(as_col(failed_drives), F.lit(0)) > 0)
        | (F.coalesce(as_col(in_progress_drives), F.lit(0)) > 0)
    )
    return F.when(has_open, F.lit("completed_with_errors")).otherwise(F.lit("completed"))
