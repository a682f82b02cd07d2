"""Byte sizes: units, human-readable formatting and exact decimal rounding.

Rounding is done in integer arithmetic on byte counts, so results are the
exact rounding of ``bytes / 1024**k`` and do not depend on how an engine
rounds binary doubles.  Power-of-two divisors use shift/mask arithmetic on
longs (small expressions that stay inside whole-stage codegen); general
divisors (aggregated ratios) use ``decimal(38,0)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.common import as_col

BYTES_IN_KB = 1024
BYTES_IN_MB = 1024**2
BYTES_IN_GB = 1024**3
BYTES_IN_TB = 1024**4

# Unit labels of the human-readable size, in order.
SIZE_UNITS = ["B", "KB", "MB", "GB", "TB", "PB"]

_WIDE = "decimal(38,0)"
_SHIFT = {"KB": 10, "MB": 20, "GB": 30, "TB": 40}


def _wide(c: Column) -> Column:
    return c.cast(_WIDE)


def _quot_rem(mag: Column, den: Column):
    """Exact floor division of non-negative decimal(38,0) values.

    Spark keeps six fractional digits on a wide decimal division, so the
    floor of the quotient can be one too high; the remainder repairs it.
    """
    q0 = F.floor(mag / den).cast(_WIDE)
    r0 = mag - q0 * den
    q = F.when(r0 < 0, q0 - 1).otherwise(q0)
    r = F.when(r0 < 0, r0 + den).otherwise(r0)
    return q, r


def round_ratio(num, den, scale: int = 2, half_even: bool = False) -> Column:
    """Round the exact rational ``num / den`` to ``scale`` decimals.

    ``num`` and ``den`` are integral columns (or ints); ``den`` must be > 0.
    Ties go away from zero (SQL ROUND) or to even (Python ``round``/``format``).
    Returns a double equal to ``q / 10**scale`` for the rounded integer ``q``.
    Meant for aggregated values (few rows); per-row byte values use the
    shift-based helpers below.
    """
    num_c = _wide(as_col(num))
    den_c = _wide(as_col(den))
    mag = F.abs(num_c) * F.lit(10**scale).cast(_WIDE)
    q, r = _quot_rem(mag, den_c)
    twice = r * 2
    bump = (twice > den_c) | ((twice == den_c) & (F.lit(not half_even) | (q % 2 == 1)))
    q_rounded = F.when(bump, q + 1).otherwise(q)
    signed = F.when(num_c < 0, -q_rounded).otherwise(q_rounded)
    return signed.cast("double") / F.lit(float(10**scale))


def percent_of(part, whole, scale: int, half_even: bool = True) -> Column:
    """``round_ratio`` of ``part * 100 / whole``; the product is taken in the
    wide decimal, as a byte total over 2**63 / 100 (80 PiB) times 100 fits no long."""
    return round_ratio(_wide(as_col(part)) * 100, whole, scale, half_even)


def wide_sum(c: Column) -> Column:
    """Sum of a long column as ``decimal(38,0)``, exact beyond 2**63: the upper
    and lower 32 bits are summed as longs and put together once."""
    high, low = F.sum(F.shiftright(c, 32)), F.sum(c.bitwiseAND(F.lit(0xFFFFFFFF)))
    return _wide(high) * F.lit(1 << 32) + _wide(low)


def _pow2_quotient(n: Column, shift: int, scale: int, half_even: bool) -> Column:
    """q = round(n * 10**scale / 2**shift) for 0 <= n < 2**63 / 10**scale.

    Larger ``n`` is clamped to 0 before multiplying: callers branch such
    values elsewhere, but common-subexpression elimination may evaluate this
    expression for every row."""
    limit = (1 << 63) // 10**scale
    t = F.when(n < F.lit(limit), n).otherwise(F.lit(0).cast("long")) * F.lit(10**scale)
    q0 = F.shiftright(t, shift)
    r = t.bitwiseAND(F.lit((1 << shift) - 1))
    half = F.lit(1 << (shift - 1))
    tie_up = (q0.bitwiseAND(F.lit(1)) == 1) if half_even else F.lit(True)
    bump = (r > half) | ((r == half) & tie_up)
    return q0 + F.when(bump, F.lit(1)).otherwise(F.lit(0))


def _fixed2(q: Column) -> Column:
    """Render integer hundredths ``q`` (>= 0) as ``'<int>.<2 digits>'``."""
    return F.concat(
        (q / F.lit(100)).cast("long").cast("string"),
        F.lit("."),
        F.lpad((q % F.lit(100)).cast("string"), 2, "0"),
    )


# From this many bytes on, n * 100 no longer fits a long; such sizes
# (>= 64 PiB) are formatted from the double value, as Python does after
# ``float(size)``.
_HUGE = 1 << 56


def format_size(size) -> Column:
    """Human-readable size: ``0 B`` for null/0, ``n B`` below 1 KiB, else
    two decimals in KB..PB with ties to even (Python ``'.2f'``).

    One quotient per row: the unit index k is chosen first and the shift
    ``10 * k`` is a per-row value, which keeps the generated code small."""
    n = as_col(size).cast("long")
    last = len(SIZE_UNITS) - 1
    k = F.lit(last)
    for i in range(last - 1, 0, -1):
        k = F.when(n < F.lit(BYTES_IN_KB ** (i + 1)), F.lit(i)).otherwise(k)
    shift = k * F.lit(10)
    one = F.lit(1).cast("long")
    t = F.when(n < F.lit(_HUGE), n).otherwise(F.lit(0).cast("long")) * F.lit(100)
    q0 = F.call_function("shiftright", t, shift)
    r = t.bitwiseAND(F.call_function("shiftleft", one, shift) - one)
    half = F.call_function("shiftleft", one, shift - F.lit(1))
    bump = (r > half) | ((r == half) & (q0.bitwiseAND(one) == one))
    q = q0 + F.when(bump, one).otherwise(F.lit(0).cast("long"))
    unit = F.element_at(F.array(*[F.lit(" " + u) for u in SIZE_UNITS[1:]]), k)
    pb = F.bround(n.cast("double") / F.lit(float(BYTES_IN_KB**last)), 2)
    return (
        F.when(n.isNull() | (n == 0), F.lit("0 B"))
        .when(n < F.lit(BYTES_IN_KB), F.concat(n.cast("string"), F.lit(" B")))
        .when(n >= F.lit(_HUGE), F.concat(pb.cast("decimal(38,2)").cast("string"), F.lit(" PB")))
        .otherwise(F.concat(_fixed2(q), unit))
    )


def bytes_to(size, unit: str) -> Column:
    """Bytes → KB/MB/GB/TB as a double (exact: division by a power of two)."""
    return as_col(size).cast("double") / F.lit(float(1 << _SHIFT[unit]))


def rounded_units(size, unit: str, scale: int) -> Column:
    """``ROUND(size / unit, scale)`` (ties away from zero), exact, per row.
    Sizes too large for long arithmetic (over ~900 TiB at four decimals)
    take the decimal path."""
    shift = _SHIFT[unit]
    n = as_col(size).cast("long")
    mag = F.abs(n)
    fast = _pow2_quotient(mag, shift, scale, half_even=False).cast("double") / F.lit(float(10**scale))
    slow = round_ratio(mag, F.lit(1 << shift), scale)
    q = F.when(mag < F.lit((1 << 63) // 10**scale), fast).otherwise(slow)
    return F.when(n < 0, -q).otherwise(q)


def format_gb(size) -> Column:
    """Dashboard GB label: Python ``f'{bytes / 1024**3:,.2f} GB'``
    (comma thousands, ties to even); null → ``0.00 GB``."""
    n = F.coalesce(as_col(size).cast("long"), F.lit(0).cast("long"))
    mag = F.abs(n)
    q_fast = _pow2_quotient(mag, 30, 2, half_even=True)
    q = F.when(mag < F.lit(_HUGE), q_fast).otherwise(
        (round_ratio(mag, F.lit(BYTES_IN_GB), 2, half_even=True) * F.lit(100.0)).cast("long")
    )
    whole = F.format_number((q / F.lit(100)).cast("long"), 0)
    frac = F.lpad((q % F.lit(100)).cast("string"), 2, "0")
    sign = F.when(n < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, whole, F.lit("."), frac, F.lit(" GB"))


def format_count(value) -> Column:
    """Integer with '.' as thousands separator (``f'{int(v):,}'`` then ','→'.');
    null → '0'."""
    v = as_col(value)
    truncated = F.when(v.isNull(), F.lit(0)).otherwise(v.cast("double").cast("long"))
    return F.translate(F.format_number(truncated, 0), ",", ".")


def mb_to_bytes(value) -> Column:
    """Megabytes (number or text) → bytes, rounded half to even; bad → null."""
    mb = as_col(value).try_cast("double")
    return F.bround(mb * F.lit(float(BYTES_IN_MB)), 0).try_cast("long")
