"""The read queries of the serving layer: published table(s) + parameters -> DataFrame.

Each is one filter/project/sort plan over one published table. NULL order follows the serving
database (descending: NULLs first, ascending: NULLs last); a unique suffix makes the order total.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsmart.functions.text import as_text, stamp_text
from opsmart.functions.times import ALL_PERIODS
from opsmart.operators.select import (
    DEFAULT_LIMIT,
    asc,
    check_limit,
    desc,
    filter_optional,
    page,
    page_after,
    place_of,
    top_k,
)

BUILT = "gold_kpi_build_ts"


def or_zero(name: str, type_name: str) -> Column:
    """A column with 0 (or false) for NULL, in the type the query returns."""
    zero = F.lit(False) if type_name == "boolean" else F.lit(0)
    return F.coalesce(F.col(name), zero).cast(type_name).alias(name)


def _as_of() -> Column:
    return stamp_text(F.col("_as_of_ts")).alias("as_of_ts")


def _built() -> Column:
    return stamp_text(F.col(BUILT)).alias(BUILT)


def _without(df: DataFrame, *names: str) -> list[str]:
    return [c for c in df.columns if c not in names]


# --- space --------------------------------------------------------------------------------
def space_global(mart: DataFrame) -> DataFrame:
    """The one-row overall KPIs."""
    return mart.select(*_without(mart, "_as_of_ts"), _as_of()).limit(1)


def space_by_site(mart: DataFrame) -> DataFrame:
    """Sites by weighted occupancy, unknown first."""
    out = mart.select(*_without(mart, "_as_of_ts"), _as_of())
    return out.orderBy(desc("weighted_occupancy_rate_pct"), asc("site"))


def _site_split(mart: DataFrame, site: str, kind: str, measures: Sequence[str]) -> DataFrame:
    types = {"sum_area_m2": "double"}
    zeroed = [or_zero(m, types.get(m, "bigint")) for m in measures]
    rows = mart.where(F.col("site") == site).select("site", kind, *zeroed, _as_of())
    return rows.orderBy(desc("spaces_count"), asc(kind))


def space_by_site_space_type(mart: DataFrame, site: str) -> DataFrame:
    """Space types of one site, most spaces first."""
    measures = ["spaces_count", "sum_area_m2", "sum_capacity", "sum_employees"]
    return _site_split(mart, site, "space_type", measures)


def space_by_site_org_type(mart: DataFrame, site: str) -> DataFrame:
    """Organisation types of one site, most spaces first."""
    measures = ["spaces_count", "sum_employees", "sum_area_m2", "sum_capacity"]
    return _site_split(mart, site, "organization_type", measures)


def space_rooms(
    mart: DataFrame,
    site: str | None = None,
    floor: str | None = None,
    space_type: str | None = None,
    organization_type: str | None = None,
    occupancy_status: str | None = None,
    limit: int = DEFAULT_LIMIT,
) -> DataFrame:
    """Rooms that match every given filter (empty text = no filter)."""
    wanted = {
        "site": site,
        "floor": floor,
        "space_type": space_type,
        "organization_type": organization_type,
        "occupancy_status": occupancy_status,
    }
    numbers = {
        "employee_count": "int",
        "total_capacity": "int",
        "area_m2": "double",
        "occupancy_rate_pct": "double",
        "density_emp_per_100m2": "double",
        "is_over_capacity": "boolean",
    }
    rows = filter_optional(mart, wanted, blank_is_absent=True).select(
        "room_nk", "site", "floor", "room", "occupancy_status", "organization_name",
        "organization_type", "space_type", "activity",
        *[or_zero(n, t) for n, t in numbers.items()],
        as_text(F.col("_ingestion_date")).alias("ingestion_date"),
        stamp_text(F.col("last_updated_ts")).alias("last_updated_ts"),
    )
    return top_k(rows, [asc("site"), asc("floor"), asc("room"), asc("room_nk")], limit)


# --- tickets ------------------------------------------------------------------------------
def _in_period(mart: DataFrame, period: str) -> DataFrame:
    return mart.where(F.col("period") == period).select(*_without(mart, BUILT), _built())


def ticket_cards(mart: DataFrame, period: str = ALL_PERIODS) -> DataFrame:
    """The cards of one period."""
    return _in_period(mart, period).limit(1)


def tickets_by_month(mart: DataFrame) -> DataFrame:
    """Months in order."""
    return mart.select("period", "ticket_count", _built()).orderBy(asc("period"))


def tickets_by_year(mart: DataFrame) -> DataFrame:
    """Years in order."""
    return mart.select("year", "ticket_count", _built()).orderBy(asc("year"))


def ticket_priorities(mart: DataFrame, period: str = ALL_PERIODS) -> DataFrame:
    """Priorities of one period, highest code first."""
    return _in_period(mart, period).orderBy(desc("priority_code"))


def _most_tickets(mart: DataFrame, period: str, key: str) -> DataFrame:
    return _in_period(mart, period).orderBy(desc("ticket_count"), asc(key))


def tickets_by_category(mart: DataFrame, period: str = ALL_PERIODS) -> DataFrame:
    """Categories of one period, most tickets first."""
    return _most_tickets(mart, period, "category_id")


def tickets_by_location(mart: DataFrame, period: str = ALL_PERIODS) -> DataFrame:
    """Locations of one period, most tickets first."""
    return _most_tickets(mart, period, "location_id")


def tickets_by_requester(mart: DataFrame, period: str = ALL_PERIODS) -> DataFrame:
    """Requesters of one period, most tickets first."""
    return _most_tickets(mart, period, "requester_user_id")


def tickets_by_technician(mart: DataFrame, period: str = ALL_PERIODS) -> DataFrame:
    """Technicians of one period, most tickets first."""
    return _most_tickets(mart, period, "last_updater_user_id")


def ticket_heatmap(mart: DataFrame, period: str = ALL_PERIODS) -> DataFrame:
    """Technician x priority rows of one period."""
    rows = _in_period(mart, period)
    order = [asc("last_updater_full_name"), desc("priority_code"), asc("last_updater_user_id")]
    return rows.orderBy(*order)


def ticket_list(
    enriched: DataFrame,
    period: str = ALL_PERIODS,
    page_no: int = 1,
    page_size: int = DEFAULT_LIMIT,
    sort_by: str | None = None,
    sort_order: str = "asc",
) -> DataFrame:
    """One page of the ticket list of a period."""
    return page(_listed(_of_month(enriched, period)), "ticket_id", page_no, check_limit(page_size), sort_by, sort_order)


#: Columns of the ticket list that are shown under another name or as text.
_LISTED = {
    "priority": "priority_code",
    "assigned_technician": "last_updater_full_name",
    "created_date": "created_ts",
    "last_updated": "updated_ts",
    "resolution_date": "solved_ts",
}


def ticket_list_after(
    enriched: DataFrame,
    period: str = ALL_PERIODS,
    after: int | None = None,
    page_size: int = DEFAULT_LIMIT,
    sort_by: str | None = None,
    sort_order: str = "asc",
) -> DataFrame:
    """The page of the ticket list behind the ticket ``after`` (None: the first page), in the order of
    ``ticket_list``; sorted and cut on the stored columns, so the seek reaches the scan."""
    rows, size = _of_month(enriched, period), check_limit(page_size)
    column = _LISTED.get(sort_by, sort_by)
    last = after if after is None or column is None else place_of(rows, "ticket_id", after, column)
    order = [] if column is None else [(asc if sort_order == "asc" else desc)(column)]
    found = page_after(rows, "ticket_id", last, size, column, sort_order)
    return _listed(found.orderBy(*order, asc("ticket_id")))


def _of_month(enriched: DataFrame, period: str) -> DataFrame:
    if period == ALL_PERIODS:
        return enriched
    first = F.to_date(F.lit(f"{period}-01"))
    return enriched.where((F.col("created_ts") >= first) & (F.col("created_ts") < F.add_months(first, 1)))


def _listed(rows: DataFrame) -> DataFrame:
    return rows.select(
        "ticket_id", "title", "status", F.col("priority_code").alias("priority"), "category",
        "location", F.col("last_updater_full_name").alias("assigned_technician"),
        stamp_text(F.col("created_ts")).alias("created_date"),
        stamp_text(F.col("updated_ts")).alias("last_updated"),
        stamp_text(F.col("solved_ts")).alias("resolution_date"),
    )


# --- reservations -------------------------------------------------------------------------
_STAMPED = ("start_ts", "end_ts", "_ingest_bronze_ts", "_ingest_silver_ts", "_ingest_gold_ts")
_DATED = ("start_date", "ingestion_date")


def _shown(enriched: DataFrame) -> DataFrame:
    texts = {n: stamp_text(F.col(n)) for n in _STAMPED}
    texts |= {n: as_text(F.col(n)) for n in _DATED}
    return enriched.select(
        *[texts[n].alias(n) if n in texts else F.col(n) for n in enriched.columns]
    )


def _newest(enriched: DataFrame, limit: int) -> DataFrame:
    # Sort and cut on the typed columns, format the surviving rows only.
    return _shown(top_k(enriched, [desc("start_ts"), desc("reservation_id")], check_limit(limit)))


def reservation_cards(mart: DataFrame) -> DataFrame:
    """The one-row overall KPIs."""
    return mart.select(*_without(mart, BUILT), _built()).limit(1)


def reservations_current(
    enriched: DataFrame,
    user_id: int | None = None,
    reservation_item_id: int | None = None,
    start_month: str | None = None,
    start_hour: int | None = None,
    is_invalid_duration: bool | None = None,
    limit: int = DEFAULT_LIMIT,
) -> DataFrame:
    """Newest reservations that match every given filter."""
    wanted = {
        "user_id": user_id,
        "reservation_item_id": reservation_item_id,
        "start_month": start_month,
        "start_hour": start_hour,
        "is_invalid_duration": is_invalid_duration,
    }
    return _newest(filter_optional(enriched, wanted), limit)


def reservations_of_user(enriched: DataFrame, user_id: int, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Newest reservations of one user."""
    return reservations_current(enriched, user_id=user_id, limit=limit)


def reservations_of_item(enriched: DataFrame, item_id: int, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Newest reservations of one item."""
    return reservations_current(enriched, reservation_item_id=item_id, limit=limit)


def _most_reserved(mart: DataFrame, key: str, limit: int) -> DataFrame:
    best = top_k(mart, [desc("reservations_count"), asc(key)], check_limit(limit))
    return best.select(*_without(mart, BUILT), _built())


def reservations_by_item(mart: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Items by number of reservations."""
    return _most_reserved(mart, "reservation_item_id", limit)


def reservations_by_user(mart: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Users by number of reservations."""
    return _most_reserved(mart, "user_id", limit)


def reservation_trends(mart: DataFrame) -> DataFrame:
    """Months, newest first."""
    return mart.select(*_without(mart, BUILT), _built()).orderBy(desc("start_month"))


def peak_periods(mart: DataFrame) -> DataFrame:
    """Two-hour labels, busiest first."""
    rows = mart.select(*_without(mart, BUILT), _built())
    return rows.orderBy(desc("reservations_count"), asc("start_hour_2h_window"))


def duration_distribution(mart: DataFrame) -> DataFrame:
    """Duration buckets by label text."""
    return mart.select(*_without(mart, BUILT), _built()).orderBy(asc("duration_bucket"))
