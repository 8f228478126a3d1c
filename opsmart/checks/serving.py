"""Parameterised serving queries (Q)."""

from __future__ import annotations

from opsmart.checks.marts import gold
from opsmart.checks.prelude import STAMP
from opsmart.checks.registry import check
from opsmart.plans import serving

_BUILT = f"'{STAMP}' AS gold_kpi_build_ts"
_AS_OF = f"'{STAMP}' AS as_of_ts"
_SITE = "brand#2"
_MONTH = "1997-05"


def _zero(name: str) -> str:
    return f"coalesce({name}, 0) AS {name}"


def _int_zero(name: str) -> str:
    return f"CAST(coalesce({name}, 0) AS INTEGER) AS {name}"


def _big_zero(name: str) -> str:
    return f"CAST(coalesce({name}, 0) AS BIGINT) AS {name}"


# --- space ---
@check("q_s1_global", f"SELECT *, {_AS_OF} FROM s_global LIMIT 1")
def _(t):
    return serving.space_global(gold(t, "space_kpi_global_current"))


@check("q_s2_by_site", f"SELECT *, {_AS_OF} FROM s_site ORDER BY weighted_occupancy_rate_pct DESC NULLS FIRST, site")
def _(t):
    return serving.space_by_site(gold(t, "space_kpi_by_site_current"))


@check("q_s3_by_site_space_type", f"""SELECT site, space_type, {_big_zero("spaces_count")}, {_zero("sum_area_m2")},
    {_big_zero("sum_capacity")}, {_big_zero("sum_employees")}, {_AS_OF} FROM s_space_type WHERE site = '{_SITE}'""")
def _(t):
    return serving.space_by_site_space_type(gold(t, "space_kpi_by_site_space_type_current"), _SITE)


@check("q_s4_by_site_org_type", f"""SELECT site, organization_type, {_big_zero("spaces_count")},
    {_big_zero("sum_employees")}, {_zero("sum_area_m2")}, {_big_zero("sum_capacity")}, {_AS_OF}
    FROM s_org_type WHERE site = '{_SITE}'""")
def _(t):
    return serving.space_by_site_org_type(gold(t, "space_kpi_by_site_org_type_current"), _SITE)


_ROOM = f"""room_nk, site, floor, room, occupancy_status, organization_name, organization_type, space_type, activity,
    {_zero("employee_count")}, {_zero("total_capacity")}, {_zero("area_m2")}, {_zero("occupancy_rate_pct")},
    {_zero("density_emp_per_100m2")}, coalesce(is_over_capacity, FALSE) AS is_over_capacity,
    CAST(_ingestion_date AS VARCHAR) AS ingestion_date, '{STAMP}' AS last_updated_ts"""
_ROOM_ORDER = "ORDER BY site NULLS LAST, floor NULLS LAST, room NULLS LAST, room_nk LIMIT 500"


@check("q_s5_rooms", f"SELECT {_ROOM} FROM rc {_ROOM_ORDER}")
def _(t):
    return serving.space_rooms(gold(t, "space_room_current"), site="")


@check("q_s5_rooms_filtered", f"""SELECT {_ROOM} FROM rc WHERE floor = 'premier étage'
    AND occupancy_status = 'loué' {_ROOM_ORDER}""")
def _(t):
    mart = gold(t, "space_room_current")
    return serving.space_rooms(mart, floor="premier étage", occupancy_status="loué", space_type="")


# --- tickets ---
@check("q_t1_cards", f"SELECT *, {_BUILT} FROM m_cards WHERE period = 'ALL'")
def _(t):
    return serving.ticket_cards(gold(t, "tickets_cards"))


@check("q_t1_cards_month", f"SELECT *, {_BUILT} FROM m_cards WHERE period = '{_MONTH}'")
def _(t):
    return serving.ticket_cards(gold(t, "tickets_cards"), _MONTH)


@check("q_t2_by_month", f"SELECT *, {_BUILT} FROM m_month ORDER BY period")
def _(t):
    return serving.tickets_by_month(gold(t, "kpi_tickets_by_month"))


@check("q_t3_by_year", f"SELECT *, {_BUILT} FROM m_year ORDER BY year")
def _(t):
    return serving.tickets_by_year(gold(t, "kpi_tickets_by_year"))


@check("q_t4_priority", f"SELECT *, {_BUILT} FROM m_priority WHERE period = 'ALL'")
def _(t):
    return serving.ticket_priorities(gold(t, "kpi_priority_distribution_period"))


@check("q_t5_category", f"SELECT *, {_BUILT} FROM m_category WHERE period = 'ALL'")
def _(t):
    return serving.tickets_by_category(gold(t, "kpi_tickets_by_category_period"))


@check("q_t6_location", f"SELECT *, {_BUILT} FROM m_location WHERE period = '{_MONTH}'")
def _(t):
    return serving.tickets_by_location(gold(t, "kpi_tickets_by_location_period"), _MONTH)


@check("q_t7_by_requester", f"SELECT *, {_BUILT} FROM m_requester WHERE period = 'ALL'")
def _(t):
    return serving.tickets_by_requester(gold(t, "kpi_tickets_by_requester_period"))


@check("q_t8_by_technician", f"SELECT *, {_BUILT} FROM m_technician WHERE period = 'ALL'")
def _(t):
    return serving.tickets_by_technician(gold(t, "kpi_tickets_by_technician_period"))


@check("q_t9_heatmap", f"SELECT *, {_BUILT} FROM m_load WHERE period = 'ALL'")
def _(t):
    return serving.ticket_heatmap(gold(t, "kpi_load_by_technician_priority_period"))


def _text_ts(name: str) -> str:
    return f"strftime({name}, '%Y-%m-%d %H:%M:%S') || '+00'"


@check("q_t_list", f"""SELECT ticket_id, title, status, priority_code AS priority, category, location,
    last_updater_full_name AS assigned_technician, {_text_ts("created_ts")} AS created_date,
    {_text_ts("updated_ts")} AS last_updated, {_text_ts("solved_ts")} AS resolution_date FROM te
    WHERE created_ts >= TIMESTAMP '1997-05-01' AND created_ts < TIMESTAMP '1997-06-01'
    ORDER BY priority DESC, ticket_id LIMIT 20 OFFSET 20""")
def _(t):
    return serving.ticket_list(gold(t, "tickets_enriched"), _MONTH, 2, 20, "priority", "desc")


@check("q_t_list_seek", f"""SELECT ticket_id, title, status, priority_code AS priority, category, location,
    last_updater_full_name AS assigned_technician, {_text_ts("created_ts")} AS created_date,
    {_text_ts("updated_ts")} AS last_updated, {_text_ts("solved_ts")} AS resolution_date FROM te
    WHERE created_ts >= TIMESTAMP '1997-05-01' AND created_ts < TIMESTAMP '1997-06-01'
    ORDER BY resolution_date DESC NULLS FIRST, ticket_id LIMIT 20 OFFSET 20""")
def _(t):
    enriched = gold(t, "tickets_enriched")
    first = serving.ticket_list_after(enriched, _MONTH, None, 20, "resolution_date", "desc").collect()
    after = first[-1].ticket_id if first else None
    return serving.ticket_list_after(enriched, _MONTH, after, 20, "resolution_date", "desc")


# --- reservations ---
_SHOWN = f"""SELECT * REPLACE ({_text_ts("start_ts")} AS start_ts, {_text_ts("end_ts")} AS end_ts,
    CAST(start_date AS VARCHAR) AS start_date, CAST(ingestion_date AS VARCHAR) AS ingestion_date,
    {_text_ts("_ingest_bronze_ts")} AS _ingest_bronze_ts, {_text_ts("_ingest_silver_ts")} AS _ingest_silver_ts,
    {_text_ts("_ingest_gold_ts")} AS _ingest_gold_ts) FROM (SELECT * FROM re {{where}}
    ORDER BY start_ts DESC NULLS FIRST, reservation_id DESC LIMIT {{limit}})"""


@check("q_r1_cards", f"SELECT *, {_BUILT} FROM r_cards")
def _(t):
    return serving.reservation_cards(gold(t, "reservations_kpi_cards_current"))


@check("q_r2_current", _SHOWN.format(where="", limit=500))
def _(t):
    return serving.reservations_current(gold(t, "reservations_enriched_current"))


@check("q_r2_current_filtered", _SHOWN.format(
    where="WHERE start_hour = 9 AND is_invalid_duration = FALSE AND start_month = '1997-05'", limit=1000))
def _(t):
    return serving.reservations_current(
        gold(t, "reservations_enriched_current"),
        start_month=_MONTH,
        start_hour=9,
        is_invalid_duration=False,
        limit=1000,
    )


@check("q_r3_by_item", f"SELECT *, {_BUILT} FROM r_item ORDER BY reservations_count DESC, reservation_item_id NULLS LAST LIMIT 500")
def _(t):
    return serving.reservations_by_item(gold(t, "reservations_kpi_by_item_current"))


@check("q_r4_by_user", f"SELECT *, {_BUILT} FROM r_user ORDER BY reservations_count DESC, user_id NULLS LAST LIMIT 500")
def _(t):
    return serving.reservations_by_user(gold(t, "reservations_kpi_by_user_current"))


@check("q_r5_trends", f"SELECT *, {_BUILT} FROM r_trends ORDER BY start_month DESC")
def _(t):
    return serving.reservation_trends(gold(t, "reservations_kpi_trends_by_month"))


@check("q_r6_peak_periods", f"SELECT *, {_BUILT} FROM r_peak ORDER BY reservations_count DESC")
def _(t):
    return serving.peak_periods(gold(t, "reservations_kpi_peak_period_current"))


@check("q_r7_duration_distribution", f"SELECT *, {_BUILT} FROM r_duration ORDER BY duration_bucket")
def _(t):
    return serving.duration_distribution(gold(t, "reservations_kpi_duration_distribution_current"))


@check("q_r8_of_user", _SHOWN.format(where="WHERE user_id = 7", limit=200))
def _(t):
    return serving.reservations_of_user(gold(t, "reservations_enriched_current"), 7, 200)


@check("q_r9_of_item", _SHOWN.format(where="WHERE reservation_item_id = 12", limit=500))
def _(t):
    return serving.reservations_of_item(gold(t, "reservations_enriched_current"), 12)
