"""Room reservation marts.

The KPI marts read the silver fact (ids and timestamps only), aggregate first and attach names
to the small result, so the fact is never shuffled for a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsmart.functions import times as when_
from opsmart.operators.latest import latest_per_key
from opsmart.operators.lookup import attach, in_role
from opsmart.operators.rollup import bucketize, counted, distinct_totals

# Duration buckets in hours, lower edge inclusive.
BUCKET_EDGES = (1, 2, 4, 8)
BUCKET_LABELS = ("<1h", "1-2h", "2-4h", "4-8h", ">8h")

USER_ROLE = {"user_id": "user_id", "user_name": "user_login", "full_name": "user_full_name"}


def user_names(users: DataFrame) -> DataFrame:
    """User dimension of the reservation marts."""
    return in_role(users, USER_ROLE)


def item_names(items: DataFrame) -> DataFrame:
    """Item dimension: one name per item id."""
    return latest_per_key(
        items.select("reservation_item_id", "reservation_item_name"),
        ["reservation_item_id"],
        ["reservation_item_name"],
    )


def start_columns() -> dict[str, Column]:
    """Calendar columns of the reservation start."""
    start, hour = F.col("start_ts"), F.hour("start_ts")
    return {
        "start_date": F.to_date(start),
        "start_month": when_.month_label(start),
        "start_year": F.year(start),
        "start_hour": hour,
        "start_hour_2h_window": when_.window_label(hour),
    }


def layout_columns() -> dict[str, Column]:
    """Month and hour of the start as numbers that order like the calendar columns; no text is formatted."""
    start = F.col("start_ts")
    return {"start_month": F.year(start) * 100 + F.month(start), "start_hour": F.hour(start)}


def enriched_current(
    reservations: DataFrame, users: DataFrame, items: DataFrame, run_ts: Column | None = None
) -> DataFrame:
    """Reservations with user, item and calendar columns."""
    named = attach(attach(reservations, user_names(users), "user_id"), item_names(items), "reservation_item_id")
    return named.withColumns(
        {**start_columns(), "_ingest_gold_ts": when_.run_stamp(run_ts)}
    ).select(
        "reservation_id", "user_id", "user_login", "user_full_name", "reservation_item_id",
        "reservation_item_name", "group_id", "start_ts", "end_ts", "duration_hours",
        "is_invalid_duration", "comment", "start_date", "start_month", "start_year",
        "start_hour", "start_hour_2h_window", "ingestion_date", "_source_file",
        "_source_system", "_ingest_bronze_ts", "_ingest_silver_ts", "_ingest_gold_ts",
    )


def is_valid() -> Column:
    """Rows that count towards hours: both ends known, not reversed."""
    return ~F.col("is_invalid_duration") & (F.col("duration_hours") >= 0)


def _valid_seconds() -> Column:
    seconds = when_.seconds_between(F.col("start_ts"), F.col("end_ts"))
    return F.when(is_valid(), seconds)


def hour_aggs() -> list[Column]:
    """Seconds and number of the valid reservations of a group."""
    return [
        F.sum(_valid_seconds()).alias("_seconds"),
        F.count(_valid_seconds()).alias("_timed"),
    ]


def hour_columns() -> dict[str, Column]:
    """Hour figures out of ``hour_aggs``."""
    # Durations are whole seconds: summing them as integers makes the hours exact.
    total = F.coalesce(F.col("_seconds"), F.lit(0))
    timed = F.when(F.col("_timed") > 0, F.col("_timed"))
    return {
        "reserved_hours": when_.hours(total),
        "avg_duration_hours": when_.hours(F.col("_seconds")) / timed,
    }


def _finish(df: DataFrame, columns: list[str], run_ts: Column | None) -> DataFrame:
    stamp = when_.run_stamp(run_ts).alias("gold_kpi_build_ts")
    return df.select(*columns, stamp)


def _invalid_count() -> Column:
    return F.count_if(F.col("is_invalid_duration")).alias("invalid_duration_count")


def cards_current(reservations: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Totals over all reservations, as one row; what is shuffled are bitmaps of ids."""
    seconds, timed = hour_aggs()
    sums = {
        "total_reservations": F.count(F.lit(1)),
        "_seconds": seconds,
        "_timed": timed,
        "invalid_duration_count": _invalid_count(),
    }
    ids = {"distinct_items": "reservation_item_id", "distinct_users": "user_id"}
    counts = [n for n in sums if n != "_seconds"]
    kpis = distinct_totals(reservations, ids, sums).withColumns(
        {n: F.coalesce(n, F.lit(0)) for n in counts}
    )
    names = ["total_reservations", "reserved_hours", "avg_duration_hours",
             "invalid_duration_count", "distinct_items", "distinct_users"]
    return _finish(kpis.withColumns(hour_columns()), names, run_ts)


def peak_period_current(reservations: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Reservations per two-hour label; 24 rows at most."""
    started = reservations.where(F.col("start_ts").isNotNull())
    per_hour = counted(started, F.hour("start_ts").alias("_hour"), name="reservations_count")
    labelled = per_hour.withColumn("start_hour_2h_window", when_.window_label(F.col("_hour")))
    return _finish(labelled, ["start_hour_2h_window", "reservations_count"], run_ts)


def trends_by_month(reservations: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Reservations and hours per month of the start."""
    started = reservations.where(F.col("start_ts").isNotNull())
    kpis = started.groupBy(when_.month_start(F.col("start_ts")).alias("_month")).agg(
        F.count(F.lit(1)).alias("reservations_count"), *hour_aggs(), _invalid_count()
    )
    label = {"start_month": when_.month_label(F.col("_month"))}
    names = ["start_month", "reservations_count", "reserved_hours", "avg_duration_hours",
             "invalid_duration_count"]
    return _finish(kpis.withColumns({**label, **hour_columns()}), names, run_ts)


def _usage(reservations: DataFrame, key: str) -> DataFrame:
    kpis = reservations.groupBy(key).agg(
        F.count(F.lit(1)).alias("reservations_count"), *hour_aggs()
    )
    return kpis.withColumns(hour_columns()).drop("_seconds", "_timed")


def by_item_current(
    reservations: DataFrame, items: DataFrame, run_ts: Column | None = None
) -> DataFrame:
    """Reservations and hours per item, the unknown item included."""
    named = attach(_usage(reservations, "reservation_item_id"), item_names(items), "reservation_item_id")
    names = ["reservation_item_id", "reservation_item_name", "reservations_count",
             "reserved_hours", "avg_duration_hours"]
    return _finish(named, names, run_ts)


def by_user_current(
    reservations: DataFrame, users: DataFrame, run_ts: Column | None = None
) -> DataFrame:
    """Reservations and hours per user, the unknown user included."""
    named = attach(_usage(reservations, "user_id"), user_names(users), "user_id")
    names = ["user_id", "user_login", "user_full_name", "reservations_count",
             "reserved_hours", "avg_duration_hours"]
    return _finish(named, names, run_ts)


def duration_distribution_current(
    reservations: DataFrame, run_ts: Column | None = None
) -> DataFrame:
    """Valid reservations per duration bucket."""
    bucket = bucketize(F.col("duration_hours"), BUCKET_EDGES, BUCKET_LABELS)
    counts = counted(
        reservations.where(is_valid()), bucket.alias("duration_bucket"), name="reservations_count"
    )
    return _finish(counts, ["duration_bucket", "reservations_count"], run_ts)


def invalid_current(
    reservations: DataFrame, users: DataFrame, items: DataFrame, run_ts: Column | None = None
) -> DataFrame:
    """Reservations that end before they start. Filtered before names are attached."""
    bad = reservations.where(F.col("is_invalid_duration"))
    named = attach(attach(bad, user_names(users), "user_id"), item_names(items), "reservation_item_id")
    names = ["reservation_id", "user_id", "user_login", "user_full_name",
             "reservation_item_id", "reservation_item_name", "start_ts", "end_ts",
             "ingestion_date", "_source_file"]
    return _finish(named, names, run_ts)


def per_day(reservations: DataFrame) -> DataFrame:
    """Reservations per start day."""
    started = reservations.where(F.col("start_ts").isNotNull())
    return counted(started, F.to_date("start_ts").alias("day"), name="room_reserved")


def per_item(reservations: DataFrame) -> DataFrame:
    """Reservations per known item id."""
    known = reservations.where(F.col("reservation_item_id").isNotNull())
    return counted(known, F.col("reservation_item_id").alias("item"), name="room_reserved")
