"""Figures the dashboard derives from the serving queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsmart.functions.facility import occupancy_band
from opsmart.functions.numbers import half_up, ratio
from opsmart.functions.text import first_match, label_or
from opsmart.functions.times import ALL_PERIODS
from opsmart.operators.select import asc, desc, pivot_sum, top_k

# Thresholds, list lengths and labels of the dashboard.
FULL_AT = 10
CRITICAL_ABOVE = 15
HIGH_ABOVE = 10
UNDERUSED_BELOW = 5
LISTED = 10
TECHNICIAN_CARDS = 5
VERY_HIGH = 5
RED_ABOVE = 80
YELLOW_ABOVE = 60
UNCATEGORISED = "Non catégorisé"
OPEN_LABEL = "Ouvert"
RESOLVED_LABEL = "Résolu"
PRIORITY_COLUMNS = {6: "major", 5: "very_high", 4: "high", 3: "medium", 2: "low"}


def item_pressure(reservations: DataFrame, newest: int | None = None, listed: int = LISTED) -> DataFrame:
    """Busiest items with mean hours, capped occupancy and a pressure level.

    ``newest`` restricts the figures to that many latest reservations, as the dashboard does
    with its first page; by default every reservation counts.
    """
    rows = reservations
    if newest is not None:
        rows = top_k(rows, [desc("start_ts"), desc("reservation_id")], newest)
    seconds = F.round(F.col("duration_hours") * 3600).cast("bigint")
    # The name depends on the id: as a second key it keeps the aggregation a hash aggregation.
    per_item = rows.groupBy("reservation_item_id", F.col("reservation_item_name").alias("name")).agg(
        F.count(F.lit(1)).alias("reservation_count"),
        F.coalesce(F.sum(seconds), F.lit(0)).alias("_seconds"),
    )
    n = F.col("reservation_count")
    level = first_match([(n > CRITICAL_ABOVE, "Critical"), (n > HIGH_ABOVE, "High")], F.lit("Medium"))
    figures = per_item.select(
        "reservation_item_id",
        "name",
        F.least(F.lit(100), half_up(n / FULL_AT * 100)).cast("int").alias("occupancy"),
        half_up(F.col("_seconds") / F.lit(3600.0) / n, 1).alias("avg_duration"),
        "reservation_count",
        level.alias("pressure"),
    )
    return top_k(figures, [desc("reservation_count"), asc("reservation_item_id")], listed)


def occupancy_colour(rate: Column) -> Column:
    """red above 80, yellow above 60, else green."""
    return first_match([(rate > RED_ABOVE, "red"), (rate > YELLOW_ABOVE, "yellow")], F.lit("green"))


def coloured_pressure(pressure: DataFrame) -> DataFrame:
    """Item pressure with the colour of its occupancy bar."""
    return pressure.withColumn("colour", occupancy_colour(F.col("occupancy")))


def underused_items(by_item: DataFrame, below: int = UNDERUSED_BELOW, listed: int = LISTED) -> DataFrame:
    """Items with fewer than ``below`` reservations, fewest first."""
    few = by_item.where(F.col("reservations_count") < below).select(
        "reservation_item_id",
        F.col("reservation_item_name").alias("name"),
        F.col("reservations_count").alias("reservations"),
        half_up(F.col("reserved_hours"), 1).alias("hours"),
        half_up(F.col("avg_duration_hours"), 1).alias("avg_duration"),
    )
    return top_k(few, [asc("reservations"), asc("reservation_item_id")], listed)


def busiest_window(peaks: DataFrame) -> DataFrame:
    """The two-hour label with most reservations; the earliest of equals."""
    best = F.min_by(
        F.col("start_hour_2h_window"),
        F.struct(-F.col("reservations_count"), F.col("start_hour_2h_window")),
    )
    return peaks.agg(F.coalesce(best, F.lit("N/A")).alias("peak_period"))


def technician_matrix(load: DataFrame, period: str = ALL_PERIODS) -> DataFrame:
    """Technician x priority counts, zero-filled, largest total first.

    Keyed by id: technicians who share a name, or have none, stay apart. ``other`` counts the
    priorities without a column.
    """
    rows = load.where(F.col("period") == period)
    keys = ["last_updater_user_id", "last_updater_full_name"]
    matrix = pivot_sum(rows, keys, "priority_code", PRIORITY_COLUMNS, "ticket_count")
    return matrix.withColumnRenamed("last_updater_full_name", "technician").orderBy(
        desc("row_total"), asc("technician"), asc("last_updater_user_id")
    )


def open_and_resolved(cards: DataFrame, period: str = ALL_PERIODS) -> DataFrame:
    """The open/resolved pair of a period as two rows."""
    pair = cards.where(F.col("period") == period).select(
        F.col("is_open").alias(OPEN_LABEL), F.col("is_resolved").alias(RESOLVED_LABEL)
    )
    return pair.unpivot([], [OPEN_LABEL, RESOLVED_LABEL], "status", "ticket_count")


def priority_count(priorities: DataFrame, code: int = VERY_HIGH, period: str = ALL_PERIODS) -> DataFrame:
    """Tickets of one priority code in a period; 0 when there are none."""
    match = (F.col("period") == period) & (F.col("priority_code") == code)
    total = F.coalesce(F.sum("ticket_count"), F.lit(0))
    return priorities.where(match).agg(total.alias("ticket_count"))


def technician_shares(
    by_technician: DataFrame, cards: DataFrame, period: str = ALL_PERIODS, listed: int = TECHNICIAN_CARDS
) -> DataFrame:
    """Busiest technicians with their percentage of all tickets of the period."""
    total = cards.where(F.col("period") == period).select("period", "total_tickets")
    best = top_k(
        by_technician.where(F.col("period") == period),
        [desc("ticket_count"), asc("last_updater_user_id")],
        listed,
    )
    share = ratio(F.col("ticket_count"), F.col("total_tickets")) * F.lit(100.0)
    return best.join(total, "period", "left").select(
        "last_updater_user_id", "last_updater_full_name", "ticket_count",
        share.alias("pct_of_total"),
    )


def banded_sites(by_site: DataFrame) -> DataFrame:
    """Sites with the colour band of their occupancy."""
    rate = F.col("weighted_occupancy_rate_pct")
    return by_site.select("site", rate, occupancy_band(rate).alias("band"))


def site_comparison(by_site: DataFrame) -> DataFrame:
    """People, area (in hundreds), capacity and lease status per site."""
    return by_site.select(
        F.col("site").alias("name"),
        F.col("total_employees").alias("employees"),
        half_up(F.col("total_area_m2") / 100).cast("bigint").alias("surface"),
        F.col("total_capacity").alias("capacity"),
        F.col("leased_spaces").alias("leased"),
        F.col("non_leased_spaces").alias("not_leased"),
    )


def trend_points(trends: DataFrame) -> DataFrame:
    """Monthly reservations with rounded hours and mean duration."""
    return trends.select(
        F.col("start_month").alias("month"),
        F.col("reservations_count").alias("reservations"),
        half_up(F.col("reserved_hours"), 1).alias("hours"),
        half_up(F.col("avg_duration_hours"), 2).alias("avg_duration"),
    )


def named_categories(by_category: DataFrame, period: str = ALL_PERIODS, listed: int = LISTED) -> DataFrame:
    """Largest categories of a period; the unlabelled ones share one name."""
    best = top_k(
        by_category.where(F.col("period") == period), [desc("ticket_count"), asc("category_id")], listed
    )
    return best.select(
        "category_id",
        label_or(F.col("category"), UNCATEGORISED).alias("category"),
        "ticket_count",
        (F.col("share") * 100).alias("pct_of_total"),
    )


def named_users(by_user: DataFrame) -> DataFrame:
    """Usage per user under the full name, or the login where there is none."""
    return by_user.select(
        "user_id",
        label_or(F.col("user_full_name"), F.col("user_login")).alias("name"),
        F.col("reservations_count").alias("count"),
        F.col("reserved_hours").alias("hours"),
    )
