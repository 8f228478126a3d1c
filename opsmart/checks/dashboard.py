"""Figures the dashboard derives (D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from opsmart.checks.marts import gold
from opsmart.checks.registry import check
from opsmart.functions.facility import occupancy_band
from opsmart.plans import dashboard

_PRESSURE = """SELECT reservation_item_id, max(reservation_item_name) AS name,
      CAST(least(100, round(count(*) / 10.0::DOUBLE * 100)) AS INTEGER) AS occupancy,
      round(coalesce(sum(duration_hours * 3600), 0) / 3600.0::DOUBLE / count(*), 1) AS avg_duration,
      count(*) AS reservation_count,
      CASE WHEN count(*) > 15 THEN 'Critical' WHEN count(*) > 10 THEN 'High' ELSE 'Medium' END AS pressure
    FROM {rows} GROUP BY 1 ORDER BY reservation_count DESC, reservation_item_id NULLS LAST LIMIT 10"""
_NEWEST = "(SELECT * FROM re ORDER BY start_ts DESC NULLS FIRST, reservation_id DESC LIMIT 500)"


@check("d_01_item_pressure", _PRESSURE.format(rows="re"))
def _(t):
    return dashboard.item_pressure(gold(t, "reservations_enriched_current"))


@check("d_01_item_pressure_newest", _PRESSURE.format(rows=_NEWEST))
def _(t):
    return dashboard.item_pressure(gold(t, "reservations_enriched_current"), newest=500)


@check("d_02_underused_items", """SELECT reservation_item_id, reservation_item_name AS name, reservations_count AS reservations,
    round(reserved_hours, 1) AS hours, round(avg_duration_hours, 1) AS avg_duration FROM r_item
    WHERE reservations_count < 15 ORDER BY reservations, reservation_item_id LIMIT 10""")
def _(t):
    return dashboard.underused_items(gold(t, "reservations_kpi_by_item_current"), below=15)


@check("d_03_busiest_window", """SELECT start_hour_2h_window AS peak_period FROM r_peak
    ORDER BY reservations_count DESC, start_hour_2h_window LIMIT 1""")
def _(t):
    return dashboard.busiest_window(gold(t, "reservations_kpi_peak_period_current"))


def _cell(code: int) -> str:
    return f"CAST(coalesce(sum(ticket_count) FILTER (WHERE priority_code = {code}), 0) AS BIGINT)"


@check("d_04_technician_matrix", f"""SELECT last_updater_user_id, last_updater_full_name AS technician, {_cell(6)} AS major, {_cell(5)} AS very_high,
    {_cell(4)} AS high, {_cell(3)} AS medium, {_cell(2)} AS low,
    CAST(coalesce(sum(ticket_count) FILTER (WHERE priority_code IS NULL OR priority_code NOT BETWEEN 2 AND 6), 0)
      AS BIGINT) AS other,
    CAST(sum(ticket_count) AS BIGINT) AS row_total
    FROM m_load WHERE period = 'ALL' GROUP BY 1, 2""")
def _(t):
    return dashboard.technician_matrix(gold(t, "kpi_load_by_technician_priority_period"))


@check("d_05_open_and_resolved", """SELECT 'Ouvert' AS status, is_open AS ticket_count FROM m_cards WHERE period = 'ALL'
    UNION ALL SELECT 'Résolu', is_resolved FROM m_cards WHERE period = 'ALL'""")
def _(t):
    return dashboard.open_and_resolved(gold(t, "tickets_cards"))


@check("d_06_priority_count", "SELECT count(*) AS ticket_count FROM tk WHERE priority_code = 5")
def _(t):
    return dashboard.priority_count(gold(t, "kpi_priority_distribution_period"))


@check("d_07_technician_share", """SELECT last_updater_user_id, last_updater_full_name, ticket_count,
    ticket_count / (SELECT count(*) FROM tk)::DOUBLE * 100.0::DOUBLE AS pct_of_total FROM m_technician
    WHERE period = 'ALL' ORDER BY ticket_count DESC, last_updater_user_id NULLS LAST LIMIT 5""")
def _(t):
    return dashboard.technician_shares(
        gold(t, "kpi_tickets_by_technician_period"), gold(t, "tickets_cards")
    )


@check("d_08_occupancy_band", """SELECT site, weighted_occupancy_rate_pct, CASE WHEN weighted_occupancy_rate_pct > 100 THEN 'red'
    WHEN weighted_occupancy_rate_pct < 40 THEN 'amber' ELSE 'green' END AS band FROM s_site""")
def _(t):
    return dashboard.banded_sites(gold(t, "space_kpi_by_site_current"))


@check("d_08_room_bands", """SELECT CASE WHEN occupancy_rate_pct > 100 THEN 'red' WHEN occupancy_rate_pct < 40 THEN 'amber'
    ELSE 'green' END AS band, count(*) AS rooms FROM rc GROUP BY 1""")
def _(t):
    rooms = gold(t, "space_room_current")
    band = occupancy_band(F.col("occupancy_rate_pct")).alias("band")
    return rooms.groupBy(band).agg(F.count(F.lit(1)).alias("rooms"))


@check("d_09_site_comparison", """SELECT site AS name, total_employees AS employees, CAST(round(total_area_m2 / 100) AS BIGINT) AS surface,
    total_capacity AS capacity, leased_spaces AS leased, non_leased_spaces AS not_leased FROM s_site""")
def _(t):
    return dashboard.site_comparison(gold(t, "space_kpi_by_site_current"))


@check("d_10_coloured_pressure", f"""SELECT *, CASE WHEN occupancy > 80 THEN 'red' WHEN occupancy > 60 THEN 'yellow'
    ELSE 'green' END AS colour FROM ({_PRESSURE.format(rows="re")})""")
def _(t):
    pressure = dashboard.item_pressure(gold(t, "reservations_enriched_current"))
    return dashboard.coloured_pressure(pressure)


@check("d_11_trend_points", """SELECT start_month AS month, reservations_count AS reservations, round(reserved_hours, 1) AS hours,
    round(avg_duration_hours, 2) AS avg_duration FROM r_trends""")
def _(t):
    return dashboard.trend_points(gold(t, "reservations_kpi_trends_by_month"))


@check("d_12_named_categories", """SELECT category_id, coalesce(nullif(category, ''), 'Non catégorisé') AS category, ticket_count,
    share * 100 AS pct_of_total FROM m_category WHERE period = 'ALL' ORDER BY ticket_count DESC, category_id LIMIT 10""")
def _(t):
    return dashboard.named_categories(gold(t, "kpi_tickets_by_category_period"))


@check("d_13_named_users", """SELECT user_id, coalesce(nullif(user_full_name, ''), user_login) AS name,
    reservations_count AS count, reserved_hours AS hours FROM r_user""")
def _(t):
    return dashboard.named_users(gold(t, "reservations_kpi_by_user_current"))
