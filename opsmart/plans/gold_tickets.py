"""Service ticket marts.

As with reservations, the KPI marts aggregate the silver fact on its ids and attach labels and
names to the aggregated rows. The period marts take the fact or the monthly states that stand for it
(``STATES``, kept up to date by ``plans.incremental``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsmart.functions import times as when_
from opsmart.functions.numbers import ratio
from opsmart.operators.lookup import attach, attach_codes, in_role
from opsmart.operators.rollup import MONTH, counted, period_rollup, with_share

REQUESTER = {
    "user_id": "requester_user_id",
    "user_name": "requester_login",
    "full_name": "requester_full_name",
}
UPDATER = {
    "user_id": "last_updater_user_id",
    "user_name": "last_updater_login",
    "full_name": "last_updater_full_name",
}
TECHNICIAN = {k: v for k, v in UPDATER.items() if k != "user_name"}
CODE_OF = {
    "ticket_status": "status_code",
    "ticket_priority": "priority_code",
    "ticket_type": "type_code",
    "ticket_category": "category_id",
    "ticket_location": "location_id",
}
CREATED = "created_ts"
#: Monthly states: name -> keys. Each has ``ticket_count``, ``is_open`` and ``is_resolved``.
STATES = {
    "status": ["status_code"],
    "priority": ["priority_code"],
    "category": ["category_id"],
    "location": ["location_id"],
    "requester": ["requester_user_id"],
    "technician": ["last_updater_user_id", "priority_code"],
}


def is_open() -> Column:
    """Neither solved nor closed."""
    return F.col("solved_ts").isNull() & F.col("closed_ts").isNull()


def has_invalid_solve_time() -> Column:
    """Solved before it was created."""
    return when_.is_reversed(F.col(CREATED), F.col("solved_ts"))


def enriched(
    tickets: DataFrame,
    users: DataFrame,
    codes: Mapping[str, DataFrame],
    run_ts: Column | None = None,
    hot_share: float | None = None,
) -> DataFrame:
    """Tickets with labels, both users, open flag and hours to solve and close.

    Five broadcast joins with code tables, two with the user dimension in its two roles; the row
    count is that of the tickets. ``hot_share`` spreads users with that share of the tickets.
    """
    out = attach(tickets, in_role(users, REQUESTER), "requester_user_id", hot_share=hot_share)
    out = attach(out, in_role(users, UPDATER), "last_updater_user_id", hot_share=hot_share)
    for table, key in CODE_OF.items():  # last, so that no label is shuffled
        out = attach_codes(out, codes[table], key)
    created = F.col(CREATED)
    derived = {
        "is_open": is_open().cast("int"),
        "time_to_solve_hours": when_.hours_between(created, F.col("solved_ts")),
        "time_to_close_hours": when_.hours_between(created, F.col("closed_ts")),
        "_ingest_gold_ts": when_.run_stamp(run_ts),
    }
    return out.withColumns(derived).select(
        "ticket_id", "title", "category_id", "category", "location_id", "location",
        "requester_user_id", "requester_login", "requester_full_name",
        "last_updater_user_id", "last_updater_login", "last_updater_full_name",
        "type_code", "type", "status_code", "status", "is_open", "is_deleted",
        "priority_code", "priority", "created_ts", "updated_ts", "solved_ts", "closed_ts",
        "time_to_solve_hours", "time_to_close_hours", "_source_file", "_source_system",
        "ingestion_date", "_ingest_bronze_ts", "_ingest_silver_ts", "_ingest_gold_ts",
    )


def state_sums(sign: Column | None = None) -> dict[str, Column]:
    """The additive figures of a group of tickets; with a sign, of tickets that come and go."""
    one = F.lit(1) if sign is None else sign
    counts = {"ticket_count": one, "is_open": F.when(is_open(), one), "is_resolved": F.when(~is_open(), one)}
    return {name: F.coalesce(F.sum(c), F.lit(0)) for name, c in counts.items()}


def _per_month(tickets: DataFrame) -> DataFrame:
    """Tickets with a creation time per month, as ``_month`` and ``ticket_count``."""
    if MONTH in tickets.columns:
        return tickets.where(F.col(MONTH).isNotNull()).groupBy(MONTH).agg(F.sum("ticket_count").alias("ticket_count"))
    dated = tickets.where(F.col(CREATED).isNotNull())
    return counted(dated, when_.month_start(F.col(CREATED)).alias(MONTH))


def _finish(df: DataFrame, columns: list[str], run_ts: Column | None) -> DataFrame:
    stamp = when_.run_stamp(run_ts).alias("gold_kpi_build_ts")
    return df.select(*columns, stamp)


def cards(tickets: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Totals per period. Tickets without a creation time keep a NULL period of their own."""
    kpis = period_rollup(
        tickets,
        CREATED,
        sums=state_sums(),
        distinct={"technicians": "last_updater_user_id"},
        keep_null_period=True,
    ).withColumnRenamed("ticket_count", "total_tickets")
    kpis = kpis.withColumn("open_rate", ratio(F.col("is_open"), F.col("total_tickets"), 0.0))
    names = ["period", "total_tickets", "is_open", "is_resolved", "technicians", "open_rate"]
    return _finish(kpis, names, run_ts)


def _by_code(
    tickets: DataFrame, codes: DataFrame, key: str, share: bool, run_ts: Column | None
) -> DataFrame:
    counts = period_rollup(tickets, CREATED, [key])
    if share:
        counts = with_share(counts)
    label = next(c for c in codes.columns if c != key)
    names = ["period", key, label, "ticket_count"]
    names += ["total_tickets", "share"] if share else []
    return _finish(attach_codes(counts, codes, key), names, run_ts)


def by_status(tickets, codes, run_ts=None) -> DataFrame:
    """Tickets per status and period."""
    return _by_code(tickets, codes["ticket_status"], "status_code", False, run_ts)


def by_priority(tickets, codes, run_ts=None) -> DataFrame:
    """Tickets per priority and period."""
    return _by_code(tickets, codes["ticket_priority"], "priority_code", False, run_ts)


def by_category(tickets, codes, run_ts=None) -> DataFrame:
    """Tickets per category and period with the share of the period."""
    return _by_code(tickets, codes["ticket_category"], "category_id", True, run_ts)


def by_location(tickets, codes, run_ts=None) -> DataFrame:
    """Tickets per location and period with the share of the period."""
    return _by_code(tickets, codes["ticket_location"], "location_id", True, run_ts)


def by_year(tickets: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Tickets per year of creation."""
    years = _per_month(tickets).groupBy(F.year(MONTH).alias("year"))
    return _finish(years.agg(F.sum("ticket_count").alias("ticket_count")), ["year", "ticket_count"], run_ts)


def by_month(tickets: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Tickets per month of creation."""
    labelled = _per_month(tickets).withColumn("period", when_.month_label(F.col(MONTH)))
    return _finish(labelled, ["period", "ticket_count"], run_ts)


def by_technician(tickets: DataFrame, users: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Tickets per last updater and period."""
    key = "last_updater_user_id"
    named = attach(period_rollup(tickets, CREATED, [key]), in_role(users, TECHNICIAN), key)
    return _finish(named, ["period", key, "last_updater_full_name", "ticket_count"], run_ts)


def load_by_technician_priority(
    tickets: DataFrame, users: DataFrame, codes: Mapping[str, DataFrame], run_ts: Column | None = None
) -> DataFrame:
    """Tickets per last updater, priority and period."""
    key = "last_updater_user_id"
    counts = period_rollup(tickets, CREATED, [key, "priority_code"])
    named = attach(attach_codes(counts, codes["ticket_priority"], "priority_code"), in_role(users, TECHNICIAN), key)
    names = ["period", key, "last_updater_full_name", "priority_code", "priority", "ticket_count"]
    return _finish(named, names, run_ts)


def by_requester(tickets: DataFrame, users: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Tickets per requester and period."""
    key = "requester_user_id"
    named = attach(period_rollup(tickets, CREATED, [key]), in_role(users, REQUESTER), key)
    names = ["period", key, "requester_login", "requester_full_name", "ticket_count"]
    return _finish(named, names, run_ts)


# --- exploration --------------------------------------------------------------------------
SLICE_COLUMNS = ("ticket_id", "request_type_id", "location_id", "type_code", "category_id",
                 "priority_code", "status_code")
INCIDENT = 1


def count_by(tickets: DataFrame, key: str) -> DataFrame:
    """Row count per value of one column, most frequent first."""
    return counted(tickets, key, name="count").orderBy(F.desc("count"), F.asc_nulls_first(key))


def of_type(tickets: DataFrame, type_code: int = INCIDENT) -> DataFrame:
    """Tickets of one type, code columns only."""
    return tickets.where(F.col("type_code") == type_code).select(*SLICE_COLUMNS)


def sample_per_location(tickets: DataFrame, rows: int = 1) -> DataFrame:
    """The lowest-numbered ``rows`` tickets of every location, in one job."""
    order = Window.partitionBy("location_id").orderBy(F.col("ticket_id").asc_nulls_last())
    ranked = tickets.select(*SLICE_COLUMNS).withColumn("_n", F.row_number().over(order))
    return ranked.where(F.col("_n") <= rows).drop("_n")
