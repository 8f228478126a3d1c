"""Silver builders (SV) and marts (K)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsmart.checks.bindings import Tables
from opsmart.checks.registry import check
from opsmart.contracts import serving_tables
from opsmart.operators.lookup import attach_codes
from opsmart.operators.rollup import counted
from opsmart.plans import gold_reservations as gr
from opsmart.plans import gold_space as gs
from opsmart.plans import gold_tickets as gt
from opsmart.plans import jobs, silver

STAMPS = ("gold_kpi_build_ts", "_as_of_ts", "last_updated_ts", "_ingest_ts", "_silver_ts")


def unstamped(df: DataFrame) -> DataFrame:
    """Without the build stamps."""
    return df.drop(*STAMPS)


def room_mart(t: Tables) -> DataFrame:
    """The stored room mart."""
    return gold(t, jobs.ROOM_MART)


def gold(t: Tables, table: str) -> DataFrame:
    """One stored gold table, by its serving name."""
    return t.stored(f"gold_{table}", lambda: jobs.BUILDERS[table](_inputs(t, table), t.run_ts))


def _inputs(t: Tables, table: str) -> dict[str, DataFrame]:
    domain = serving_tables()[table]
    if domain == "tickets":
        return {"tickets": t.tickets, "users": t.users, **t.codes}
    if domain == "reservations":
        return {"reservations": t.reservations, "users": t.users, "reserveditems": t.items}
    if table == jobs.ROOM_MART:
        return {"space_repartition": t.rooms}
    return {jobs.ROOM_MART: room_mart(t)}


# --- silver ---
_TICKET = """ticket_id, entity_id, category_id, request_type_id, location_id, requester_user_id, last_updater_user_id,
    title, created_ts, updated_ts, solved_ts, closed_ts, status_code, priority_code, type_code, is_deleted,
    ingestion_date, _source_file, _source_system, _ingest_bronze_ts, _ingest_silver_ts"""


@check("sv_users", "SELECT * FROM uss")
def _(t):
    return silver.users(t.bronze_users, t.run_ts)


@check("sv_tickets", f"SELECT {_TICKET} FROM tks")
def _(t):
    return silver.tickets(t.bronze_tickets, t.run_ts)


@check("sv_reservations", "SELECT * FROM rss")
def _(t):
    return silver.reservations(t.bronze_reservations, t.run_ts)


@check("sv_items", "SELECT * FROM its")
def _(t):
    return silver.reserveditems(t.bronze_items, t.run_ts)


@check("sv_rooms", "SELECT * EXCLUDE (_ingest_ts, _silver_ts) FROM rm")
def _(t):
    return unstamped(silver.rooms(t.bronze_rooms, t.run_ts))


@check("sv_dims", """SELECT 'status' AS dim, CAST(status_code AS BIGINT) AS code, status AS label, count(*) AS tickets FROM te GROUP BY 2, 3
    UNION ALL SELECT 'priority', priority_code, priority, count(*) FROM te GROUP BY 2, 3
    UNION ALL SELECT 'type', type_code, type, count(*) FROM te GROUP BY 2, 3
    UNION ALL SELECT 'category', category_id, category, count(*) FROM te GROUP BY 2, 3
    UNION ALL SELECT 'location', location_id, location, count(*) FROM te GROUP BY 2, 3""")
def _(t):
    return dimension_usage(t.tickets, t.codes)


def dimension_usage(tickets: DataFrame, codes: dict[str, DataFrame]) -> DataFrame:
    """Tickets per code of every code table, with its label."""
    parts = []
    for table, key in gt.CODE_OF.items():
        label = codes[table].columns[1]
        used = counted(tickets, F.col(key).cast("bigint").alias(key), name="tickets")
        named = attach_codes(used, codes[table], key)
        dim = F.lit(table.removeprefix("ticket_")).alias("dim")
        parts.append(named.select(dim, F.col(key).alias("code"), F.col(label).alias("label"), "tickets"))
    return reduce(lambda a, b: a.unionByName(b), parts)


# --- space ---
@check("k_s01_room_current", "SELECT * FROM rc")
def _(t):
    return unstamped(gs.room_current(t.rooms, t.run_ts))


@check("k_s02_global", "SELECT * FROM s_global")
def _(t):
    return unstamped(gs.kpi_global(room_mart(t)))


@check("k_s03_by_site", "SELECT * FROM s_site")
def _(t):
    return unstamped(gs.kpi_by_site(room_mart(t)))


@check("k_s04_by_site_space_type", "SELECT * FROM s_space_type")
def _(t):
    return unstamped(gs.kpi_by_site_space_type(room_mart(t)))


@check("k_s05_by_site_org_type", "SELECT * FROM s_org_type")
def _(t):
    return unstamped(gs.kpi_by_site_org_type(room_mart(t)))


# --- reservations ---
@check("k_r01_enriched", "SELECT * FROM re")
def _(t):
    return gr.enriched_current(t.reservations, t.users, t.items, t.run_ts)


@check("k_r02_cards", "SELECT * FROM r_cards")
def _(t):
    return unstamped(gr.cards_current(t.reservations))


@check("k_r03_peak_period", "SELECT * FROM r_peak")
def _(t):
    return unstamped(gr.peak_period_current(t.reservations))


@check("k_r04_trends_by_month", "SELECT * FROM r_trends")
def _(t):
    return unstamped(gr.trends_by_month(t.reservations))


@check("k_r05_by_item", "SELECT * FROM r_item")
def _(t):
    return unstamped(gr.by_item_current(t.reservations, t.items))


@check("k_r06_by_user", "SELECT * FROM r_user")
def _(t):
    return unstamped(gr.by_user_current(t.reservations, t.users))


@check("k_r07_duration_distribution", "SELECT * FROM r_duration")
def _(t):
    return unstamped(gr.duration_distribution_current(t.reservations))


@check("k_r08_invalid", """SELECT reservation_id, user_id, user_login, user_full_name, reservation_item_id,
    reservation_item_name, start_ts, end_ts, ingestion_date, _source_file FROM re WHERE is_invalid_duration""")
def _(t):
    return unstamped(gr.invalid_current(t.reservations, t.users, t.items))


@check("k_r09_per_day", "SELECT CAST(start_ts AS DATE) AS day, count(*) AS room_reserved FROM rs WHERE start_ts IS NOT NULL GROUP BY 1")
def _(t):
    return gr.per_day(t.reservations)


@check("k_r10_per_item", """SELECT reservation_item_id AS item, count(*) AS room_reserved FROM rs
    WHERE reservation_item_id IS NOT NULL GROUP BY 1""")
def _(t):
    return gr.per_item(t.reservations)


# --- tickets ---
@check("k_t01_enriched", "SELECT * FROM te")
def _(t):
    return gt.enriched(t.tickets, t.users, t.codes, t.run_ts)


@check("k_t02_cards", "SELECT * FROM m_cards")
def _(t):
    return unstamped(gt.cards(t.tickets))


@check("k_t03_status_period", "SELECT * FROM m_status")
def _(t):
    return unstamped(gt.by_status(t.tickets, t.codes))


@check("k_t04_priority_period", "SELECT * FROM m_priority")
def _(t):
    return unstamped(gt.by_priority(t.tickets, t.codes))


@check("k_t05_by_year", "SELECT * FROM m_year")
def _(t):
    return unstamped(gt.by_year(t.tickets))


@check("k_t06_by_month", "SELECT * FROM m_month")
def _(t):
    return unstamped(gt.by_month(t.tickets))


@check("k_t07_technician_period", "SELECT * FROM m_technician")
def _(t):
    return unstamped(gt.by_technician(t.tickets, t.users))


@check("k_t08_technician_priority_period", "SELECT * FROM m_load")
def _(t):
    return unstamped(gt.load_by_technician_priority(t.tickets, t.users, t.codes))


@check("k_t09_category_period", "SELECT * FROM m_category")
def _(t):
    return unstamped(gt.by_category(t.tickets, t.codes))


@check("k_t10_requester_period", "SELECT * FROM m_requester")
def _(t):
    return unstamped(gt.by_requester(t.tickets, t.users))


@check("k_t11_location_period", "SELECT * FROM m_location")
def _(t):
    return unstamped(gt.by_location(t.tickets, t.codes))


@check("k_e01_by_location", "SELECT location_id, count(*) AS count FROM tk GROUP BY 1")
def _(t):
    return gt.count_by(t.tickets, "location_id")


@check("k_e02_by_type", "SELECT type_code, count(*) AS count FROM tk GROUP BY 1")
def _(t):
    return gt.count_by(t.tickets, "type_code")


@check("k_e03_by_request_type", "SELECT request_type_id, count(*) AS count FROM tk GROUP BY 1")
def _(t):
    return gt.count_by(t.tickets, "request_type_id")


@check("k_e04_incidents", """SELECT ticket_id, request_type_id, location_id, type_code, category_id, priority_code,
    status_code FROM tk WHERE type_code = 1""")
def _(t):
    return gt.of_type(t.tickets)
