"""Space occupancy marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsmart.functions import facility as place
from opsmart.functions import numbers as num
from opsmart.functions import text
from opsmart.functions import times as when_
from opsmart.operators.latest import latest_per_key

# Thresholds of the room counts, in percent.
UNDERUSED_BELOW = 40
OVERFULL_ABOVE = 100


def room_current(silver: DataFrame, run_ts: Column | None = None, null_marker: str | None = "∅") -> DataFrame:
    """One row per room with occupancy, density and over-capacity flag."""
    parts = [text.norm(F.col(c)) for c in ("site", "floor", "room")]
    keyed = silver.withColumn("room_nk", text.natural_key(*parts, null_marker=null_marker))
    newest = ["_ingestion_date", "_silver_ts"]
    settle = [c for c in silver.columns if c not in newest]
    latest = latest_per_key(keyed, ["room_nk"], newest, settle)
    people, seats, area = F.col("employee_count"), F.col("total_capacity"), F.col("area_m2")
    return latest.select(
        "room_nk", "site", "floor", "room", "occupancy_status", "organization_name",
        "organization_type", "space_type", "activity", "employee_count", "total_capacity",
        "area_m2",
        num.percent_of(people, seats).alias("occupancy_rate_pct"),
        num.percent_of(people, area, positive_only=True).alias("density_emp_per_100m2"),
        num.exceeds(people, seats).alias("is_over_capacity"),
        "_ingestion_date", "_source_file", "_source_system", "_entity", "_ingest_ts",
        "_silver_ts",
        when_.run_stamp(run_ts).alias("last_updated_ts"),
    )


def _totals(area: str, capacity: str, employees: str) -> list[Column]:
    return [
        num.exact_sum(F.col("area_m2")).alias(area),
        F.sum("total_capacity").alias(capacity),
        F.sum("employee_count").alias(employees),
    ]


def _status_counts(with_modes: bool) -> list[Column]:
    status = F.col("occupancy_status")
    tests = {
        "leased_spaces": place.has_status(status, exactly=place.LEASED),
        "non_leased_spaces": place.has_status(status, exactly=place.NOT_LEASED),
    }
    if with_modes:
        tests["reservation_spaces"] = place.has_status(status, mentions=place.RESERVABLE)
        tests["per_person_spaces"] = place.has_status(status, mentions=place.PER_PERSON)
    rate = F.col("occupancy_rate_pct")
    tests["underutilized_spaces_lt_40pct"] = rate < UNDERUSED_BELOW
    tests["overoccupied_spaces_gt_100pct"] = rate > OVERFULL_ABOVE
    return [F.count_if(test).alias(name) for name, test in tests.items()]


def _with_occupancy(kpis: DataFrame, run_ts: Column | None) -> DataFrame:
    rate = num.ratio(F.col("total_employees"), F.col("total_capacity")) * F.lit(100.0)
    return kpis.withColumns(
        {"weighted_occupancy_rate_pct": rate, "_as_of_ts": when_.run_stamp(run_ts)}
    )


def _density() -> Column:
    return num.exact_avg(F.col("density_emp_per_100m2")).alias("avg_density_emp_per_100m2")


def kpi_global(rooms: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """All sites in one row.

    ``room_nk`` is unique in the room mart, so spaces are counted, not de-duplicated again.
    """
    kpis = rooms.agg(
        F.countDistinct("site").alias("villages_count"),
        F.count("room_nk").alias("total_spaces"),
        *_totals("total_area_m2", "total_capacity", "total_employees"),
        *_status_counts(with_modes=True),
        _density(),
    )
    return _with_occupancy(kpis, run_ts)


def kpi_by_site(rooms: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """The same per site, without the reservation and per-person counts."""
    kpis = rooms.groupBy("site").agg(
        F.count("room_nk").alias("total_spaces"),
        *_totals("total_area_m2", "total_capacity", "total_employees"),
        *_status_counts(with_modes=False),
        _density(),
    )
    return _with_occupancy(kpis, run_ts)


def _by_site_and(rooms: DataFrame, kind: str, run_ts: Column | None) -> DataFrame:
    spaces = F.count("room_nk").alias("spaces_count")
    kpis = rooms.groupBy("site", kind).agg(
        spaces, *_totals("sum_area_m2", "sum_capacity", "sum_employees")
    )
    return kpis.withColumn("_as_of_ts", when_.run_stamp(run_ts))


def kpi_by_site_space_type(rooms: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Spaces, area, capacity and people per site and space type."""
    return _by_site_and(rooms, "space_type", run_ts)


def kpi_by_site_org_type(rooms: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Spaces, area, capacity and people per site and organisation type."""
    return _by_site_and(rooms, "organization_type", run_ts)
