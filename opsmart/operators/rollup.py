"""Counts per period with an all-time grain, shares of total, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsmart.functions.numbers import ratio
from opsmart.functions.text import first_match
from opsmart.functions.times import ALL_PERIODS, month_label, month_start

PERIOD = "period"
#: The month's first day; a frame that has it stands for the rows it was aggregated from.
MONTH = "_month"


def by_month(df: DataFrame, ts: str, keys: Sequence[str], **sums: Column) -> DataFrame:
    """One row per (month, keys) with the given additive aggregates.

    Groups on the month's first day rather than on its text: labels are formatted once per
    result row, not once per input row.
    """
    aggregates = [c.alias(name) for name, c in sums.items()]
    return df.groupBy(month_start(F.col(ts)).alias(MONTH), *keys).agg(*aggregates)


def period_rollup(
    df: DataFrame,
    ts: str,
    keys: Sequence[str] = (),
    sums: dict[str, Column] | None = None,
    distinct: dict[str, str] | None = None,
    keep_null_period: bool = False,
) -> DataFrame:
    """Aggregates per ``yyyy-MM`` and for ``ALL`` time, in one pass over the input.

    The input is reduced to one row per month and key first; both grains come from that small
    result as grouping sets, so no input row is duplicated. ``distinct`` maps an output name to
    the id column (a whole number) whose distinct non-NULL values are counted, exactly and at both
    grains: the months carry bitmaps of the ids, one for each 32,768 of them, and ``ALL`` combines the
    months' bitmaps, so ids are never shuffled one by one.

    Rows without a timestamp always count towards ``ALL``; ``keep_null_period`` also keeps
    them as a NULL period. ``df`` may also be monthly
    states, the result of ``by_month`` with these keys (or more).
    """
    sums = sums or {"ticket_count": F.count(F.lit(1))}
    distinct = distinct or {}
    if len(distinct) > 1:
        raise ValueError("one distinct count at a time")
    ready = MONTH in df.columns
    sums = {name: F.sum(name) for name in sums} if ready else sums
    month = F.col(MONTH) if ready else month_start(F.col(ts))
    buckets = {f"_bucket_{n}": F.bitmap_bucket_number(F.col(c).cast("long")) for n, c in distinct.items()}
    bits = {n: F.bitmap_construct_agg(F.bitmap_bit_position(F.col(c).cast("long"))) for n, c in distinct.items()}
    detail = df.groupBy(month.alias(MONTH), *keys, *[c.alias(n) for n, c in buckets.items()]).agg(
        *[c.alias(n) for n, c in (sums | bits).items()]
    )
    month, fixed = F.col(MONTH), [F.col(k) for k in [*keys, *buckets]]
    combined = {n: F.sum(n) for n in sums} | {n: F.bitmap_or_agg(n) for n in distinct}
    stacked = detail.groupingSets([[month, *fixed], fixed], month, *fixed).agg(
        F.grouping(MONTH).alias("_all"), *[c.alias(n) for n, c in combined.items()]
    )
    if distinct:
        counted_ids = {n: F.sum(F.bitmap_count(n)) for n in distinct}
        stacked = stacked.groupBy("_all", MONTH, *keys).agg(
            *[F.sum(n).alias(n) for n in sums], *[c.alias(n) for n, c in counted_ids.items()]
        )
    if not keep_null_period:
        stacked = stacked.where((F.col("_all") == 1) | month.isNotNull())
    period = F.when(F.col("_all") == 1, F.lit(ALL_PERIODS)).otherwise(month_label(month))
    return stacked.select(period.alias(PERIOD), *keys, *sums, *distinct)


def distinct_totals(df: DataFrame, ids: dict[str, str], sums: dict[str, Column]) -> DataFrame:
    """One row: additive aggregates and exact distinct counts of id columns (output name -> column).

    Map tasks reduce the rows to one per combination of id buckets (32,768 ids each), with a bitmap per
    column; bitmaps of one bucket are combined, and their bits counted.
    """
    buckets = {n: f"_bucket_{n}" for n in ids}
    placed = {buckets[n]: F.bitmap_bucket_number(F.col(c).cast("long")) for n, c in ids.items()}
    bits = {n: F.bitmap_construct_agg(F.bitmap_bit_position(F.col(c).cast("long"))) for n, c in ids.items()}
    detail = df.groupBy(*[c.alias(n) for n, c in placed.items()]).agg(*[c.alias(n) for n, c in (sums | bits).items()])
    counts = {
        n: detail.groupBy(buckets[n]).agg(F.bitmap_or_agg(n).alias(n)).agg(F.coalesce(F.sum(F.bitmap_count(n)), F.lit(0)))
        for n in ids
    }
    totals = detail.agg(*[F.sum(n).alias(n) for n in sums])
    return totals.select("*", *[c.scalar().alias(n) for n, c in counts.items()])


def with_share(
    counts: DataFrame,
    count: str = "ticket_count",
    total: str = "total_tickets",
    share: str = "share",
) -> DataFrame:
    """Add the period's total and each row's share of it.

    Totals are joined back, not computed by a window: a window would pull every key of the
    ``ALL`` period into one task. There is one total per calendar month plus one, which bounds
    the broadcast at about 120 000 rows for all months a timestamp can name.
    """
    totals = counts.groupBy(PERIOD).agg(F.sum(count).alias(total))
    joined = counts.join(F.broadcast(totals), PERIOD, "left")
    return joined.withColumn(share, ratio(F.col(count), F.col(total), 0.0))


def bucketize(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the first bucket whose upper edge exceeds the value (lower edges inclusive)."""
    if len(labels) != len(edges) + 1:
        raise ValueError("need one label more than edges")
    rules = [(value < edge, label) for edge, label in zip(edges, labels)]
    return F.when(value.isNotNull(), first_match(rules, F.lit(labels[-1])))


def counted(df: DataFrame, *keys: Column | str, name: str = "ticket_count") -> DataFrame:
    """Row count per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
