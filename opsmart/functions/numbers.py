"""Numbers out of free text, flags, ratios and order-independent sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wide enough for a sum over 10^10 values below LARGE; ten places are kept of each value. A double
# of LARGE and above has no places after the point.
FIXED_POINT, WHOLE = "decimal(28,10)", "decimal(38,0)"
LARGE = 1e17
# Holds every 64-bit integer exactly, with decimals to cut off.
_DECIMAL = "decimal(38,10)"


def _with_point(c: Column) -> Column:
    return F.translate(c.cast("string"), ",", ".")


# try_cast ignores surrounding blanks and gives NULL for '', '-', 'null' and other words, so the
# texts that stand for a missing number need no tests of their own.
def to_int(c: Column) -> Column:
    """32-bit integer, decimals cut off ('9,5' -> 9); anything unreadable is NULL."""
    return _with_point(c).try_cast(_DECIMAL).try_cast("int")


def to_long(c: Column) -> Column:
    """64-bit integer id, also when an exporter wrote it as '12.0'; anything unreadable is NULL."""
    return F.coalesce(
        c.try_cast("bigint"), _with_point(c).try_cast(_DECIMAL).try_cast("bigint")
    )


def to_double(c: Column) -> Column:
    """Double with comma or point decimals; anything unreadable is NULL."""
    return _with_point(c).try_cast("double")


def is_one(c: Column) -> Column:
    """0/1 code as a boolean; NULL stays NULL."""
    return to_int(c) == F.lit(1)


def percent_of(part: Column, whole: Column, positive_only: bool = False) -> Column:
    """``part / whole * 100`` with a missing part as 0; NULL when there is no usable whole."""
    usable = whole > 0 if positive_only else whole != 0
    return F.when(usable, F.coalesce(part, F.lit(0)) / whole * F.lit(100.0))


def exceeds(value: Column, limit: Column) -> Column:
    """``value > limit``; NULL when either is unknown."""
    return value > limit


def ratio(part: Column, whole: Column, if_empty: float | None = None) -> Column:
    """``part / whole``; ``if_empty`` when the whole is 0 or NULL."""
    empty = F.coalesce(whole, F.lit(0)) == 0
    return F.when(empty, F.lit(if_empty).cast("double")).otherwise(
        part.cast("double") / whole.cast("double")
    )


def _finite(c: Column) -> Column:
    x = c.cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), x)


def exact_sum(c: Column) -> Column:
    """Sum of doubles in fixed point: the same result however tasks split or are retried.

    NaN and infinite values count as missing (see ``not_finite``). Every finite value counts; one
    beyond 38 digits, or a sum that has more, fails the job.
    """
    x = _finite(c)
    small = F.sum(F.when(F.abs(x) < LARGE, x).cast(FIXED_POINT))
    large = F.sum(F.when(F.abs(x) >= LARGE, x).cast(WHOLE))
    total = F.coalesce(small.cast("double"), F.lit(0.0)) + F.coalesce(
        large.cast("double"), F.lit(0.0)
    )
    return F.when(F.count(x) > 0, total)


def exact_avg(c: Column) -> Column:
    """Mean of the known doubles, summed in fixed point. NULL when there are none."""
    known = F.count(_finite(c))
    return F.when(known > 0, exact_sum(c) / known)


def not_finite(c: Column) -> Column:
    """How many values are NaN or infinite, which the exact sums leave out."""
    return F.count(F.when(c.isNotNull() & _finite(c).isNull(), 1))


def half_up(c: Column, places: int = 0) -> Column:
    """Rounded, halves away from zero."""
    return F.round(c, places)
