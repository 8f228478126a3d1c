"""Marts, serving queries and dashboard figures on the small silver tables."""

import datetime as dt

import fixtures
import pytest
from pyspark.sql import functions as F

from opsmart.plans import dashboard, dims, jobs, serving
from opsmart.plans import gold_reservations as gr
from opsmart.plans import gold_space as gs
from opsmart.plans import gold_tickets as gt



def rows(df, *names):
    names = names or [c for c in df.columns if not c.endswith("_ts") and c != "as_of_ts"]
    found = [tuple(r) for r in df.select(*names).collect()]
    return sorted(found, key=lambda r: [(v is not None, v) for v in r])


@pytest.fixture(scope="module")
def silver(spark):
    stamp = F.lit("2024-02-06 00:00:00").cast("timestamp")
    tables = {
        "tickets": fixtures.tickets(spark),
        "users": fixtures.users(spark),
        "reservations": fixtures.reservations(spark),
        "reserveditems": fixtures.items(spark),
        "space_repartition": fixtures.rooms(spark),
        **dims.all_code_tables(spark),
    }
    tables[jobs.ROOM_MART] = gs.room_current(tables["space_repartition"], stamp)
    return tables, stamp


@pytest.fixture(scope="module")
def gold(silver):
    tables, stamp = silver
    return lambda name: jobs.BUILDERS[name](tables, stamp)


# --- tickets ---
def test_tickets_enriched(gold):
    out = gold("tickets_enriched")
    assert out.count() == 5
    names = ["ticket_id", "category", "location", "requester_login", "last_updater_full_name", "type",
             "status", "is_open", "priority", "time_to_solve_hours", "time_to_close_hours"]
    assert rows(out, *names) == [
        (1, "IT and Support", "Medianet", "john.doe@x.y", "Admin", "Incident", "Solved", 0, "Major", 1.5, None),
        (2, "IT and Support", None, "john.doe@x.y", "Admin", "Request", "Closed", 0, "Very high", None, 24.0),
        (3, None, None, "admin", "DOE John", "Incident", "New", 1, "Very high", None, None),
        (4, None, "Studio", None, None, "Incident", "Solved", 0, None, None, None),
        (5, None, None, None, "Admin", "Request", "In progress (Assigned)", 0, "Low", None, None),
    ]


def test_invalid_solve_time(spark):
    flags = fixtures.tickets(spark).select("ticket_id", gt.has_invalid_solve_time().alias("bad"))
    assert [r.ticket_id for r in flags.where("bad").collect()] == [4]


def test_ticket_cards_keep_the_null_period(gold):
    assert rows(gold("tickets_cards")) == [
        (None, 1, 0, 1, 1, 0.0), ("2024-01", 2, 0, 2, 1, 0.0), ("2024-02", 2, 1, 1, 1, 0.5), ("ALL", 5, 1, 4, 2, 0.2),
    ]


def test_ticket_distributions(gold):
    assert rows(gold("kpi_status_distribution_period").where("period <> 'ALL'")) == [
        ("2024-01", 5, "Solved", 1), ("2024-01", 6, "Closed", 1), ("2024-02", 1, "New", 1), ("2024-02", 5, "Solved", 1),
    ]
    assert rows(gold("kpi_priority_distribution_period").where("period = 'ALL'")) == [
        ("ALL", 1, None, 1), ("ALL", 2, "Low", 1), ("ALL", 5, "Very high", 2), ("ALL", 6, "Major", 1),
    ]


def test_tickets_by_year_and_month(gold):
    assert rows(gold("kpi_tickets_by_year")) == [(2024, 4)]
    assert rows(gold("kpi_tickets_by_month")) == [("2024-01", 2), ("2024-02", 2)]


def test_tickets_by_people(gold):
    assert rows(gold("kpi_tickets_by_technician_period").where("period = 'ALL'")) == [
        ("ALL", None, None, 1), ("ALL", 1, "DOE John", 1), ("ALL", 2, "Admin", 3),
    ]
    assert rows(gold("kpi_tickets_by_requester_period").where("period = '2024-02'")) == [
        ("2024-02", 2, "admin", "Admin", 1), ("2024-02", 9, None, None, 1),
    ]
    assert rows(gold("kpi_load_by_technician_priority_period").where("period = 'ALL'")) == [
        ("ALL", None, None, 1, None, 1), ("ALL", 1, "DOE John", 5, "Very high", 1), ("ALL", 2, "Admin", 2, "Low", 1),
        ("ALL", 2, "Admin", 5, "Very high", 1), ("ALL", 2, "Admin", 6, "Major", 1),
    ]


def test_tickets_by_category_and_location(gold):
    assert rows(gold("kpi_tickets_by_category_period").where("period = 'ALL'")) == [
        ("ALL", None, None, 1, 5, 0.2), ("ALL", 0, None, 1, 5, 0.2), ("ALL", 1, "IT and Support", 2, 5, 0.4),
        ("ALL", 20, None, 1, 5, 0.2),
    ]
    assert rows(gold("kpi_tickets_by_location_period").where("period = '2024-01'")) == [
        ("2024-01", 1, "Medianet", 1, 2, 0.5), ("2024-01", 5, None, 1, 2, 0.5),
    ]


def test_months_and_the_rest_make_all(gold):
    out = gold("tickets_cards").toPandas().set_index("period")["total_tickets"]
    assert out["ALL"] == out.drop("ALL").sum()


def test_exploration(spark):
    tickets = fixtures.tickets(spark)
    assert rows(gt.count_by(tickets, "type_code")) == [(1, 3), (2, 2)]
    assert gt.of_type(tickets).columns == list(gt.SLICE_COLUMNS)
    assert rows(gt.of_type(tickets), "ticket_id") == [(1,), (3,), (4,)]
    doubled = tickets.unionByName(tickets.withColumn("ticket_id", F.col("ticket_id") + 100))
    assert rows(gt.sample_per_location(doubled), "location_id", "ticket_id") == [
        (None, 5), (0, 3), (1, 1), (5, 2), (27, 4),
    ]


def test_location_labels_take_the_site_name():
    labels = dims.location_labels("Lac")
    assert (labels[0], labels[2], labels[18], labels[27]) == (None, "Lac", "Hors Lac", "Studio")
    assert len(labels) == 25 and not {5, 10, 24} & labels.keys()


# --- reservations ---
def test_reservations_enriched(gold):
    out = gold("reservations_enriched_current")
    names = ["reservation_id", "user_login", "reservation_item_name", "start_month", "start_year",
             "start_hour", "start_hour_2h_window", "duration_hours"]
    assert rows(out, *names) == [
        (1, "john.doe@x.y", "Salle COSY - Salle 4", "2024-01", 2024, 9, "09:00-11:00", 0.5),
        (2, "john.doe@x.y", "Salle COSY - Salle 4", "2024-01", 2024, 22, "22:00-00:00", 8.0),
        (3, "admin", "Studio", "2024-02", 2024, 23, "23:00-01:00", 1.0),
        (4, None, None, "2024-02", 2024, 9, "09:00-11:00", None),
        (5, None, None, None, None, None, None, None),
        (6, "admin", "Salle COSY - Salle 4", "2024-02", 2024, 9, "09:00-11:00", 2.0),
    ]


def test_reservation_cards(gold):
    assert rows(gold("reservations_kpi_cards_current")) == [(6, 11.5, 11.5 / 4, 1, 3, 3)]


def test_cards_of_no_reservations(spark):
    empty = fixtures.reservations(spark).limit(0)
    assert rows(gr.cards_current(empty)) == [(0, 0.0, None, 0, 0, 0)]


def test_reservation_marts(gold):
    assert rows(gold("reservations_kpi_peak_period_current")) == [
        ("09:00-11:00", 3), ("22:00-00:00", 1), ("23:00-01:00", 1),
    ]
    assert rows(gold("reservations_kpi_trends_by_month")) == [
        ("2024-01", 2, 8.5, 4.25, 0), ("2024-02", 3, 3.0, 1.5, 1),
    ]
    assert rows(gold("reservations_kpi_by_item_current")) == [
        (None, None, 1, 0.0, None), (10, "Salle COSY - Salle 4", 3, 10.5, 3.5), (11, "Studio", 1, 1.0, 1.0),
        (99, None, 1, 0.0, None),
    ]
    assert rows(gold("reservations_kpi_by_user_current")) == [
        (None, None, None, 1, 0.0, None), (1, "john.doe@x.y", "DOE John", 2, 8.5, 4.25),
        (2, "admin", "Admin", 2, 3.0, 1.5), (3, None, None, 1, 0.0, None),
    ]
    assert rows(gold("reservations_kpi_duration_distribution_current")) == [
        ("1-2h", 1), ("2-4h", 1), ("<1h", 1), (">8h", 1),
    ]
    assert rows(gold("reservations_kpi_invalid_current"), "reservation_id", "reservation_item_id") == [(4, 99)]


def test_reservations_per_day_and_item(spark):
    reservations = fixtures.reservations(spark)
    assert rows(gr.per_day(reservations)) == [
        (dt.date(2024, 1, 1), 2), (dt.date(2024, 2, 1), 1), (dt.date(2024, 2, 3), 1), (dt.date(2024, 2, 4), 1),
    ]
    assert rows(gr.per_item(reservations)) == [(10, 3), (11, 1), (99, 1)]


# --- space ---
def test_room_current(gold):
    names = ["room_nk", "employee_count", "occupancy_rate_pct", "density_emp_per_100m2", "is_over_capacity"]
    assert rows(gold("space_room_current"), *names) == [
        ("site a|rdc|salle 01", 5, 50.0, 10.0, False),
        ("site a|rdc|salle 03", 3, 150.0, 15.0, True),
        ("site a|∅|salle 02", None, 0.0, None, None),
        ("site b|rdc|accueil", 8, None, 8 / 80.5 * 100.0, None),
        ("site b|rdc|terrasse", 7, None, None, True),
    ]


def test_space_kpis(gold):
    names = ["villages_count", "total_spaces", "total_area_m2", "total_capacity", "total_employees", "leased_spaces",
             "non_leased_spaces", "reservation_spaces", "per_person_spaces", "underutilized_spaces_lt_40pct",
             "overoccupied_spaces_gt_100pct", "weighted_occupancy_rate_pct"]
    assert rows(gold("space_kpi_global_current"), *names) == [
        (2, 5, 150.5, 16, 23, 2, 1, 1, 1, 1, 1, 23 / 16 * 100.0)
    ]
    density = gold("space_kpi_global_current").first().avg_density_emp_per_100m2
    assert density == pytest.approx((10 + 15 + 8 / 80.5 * 100) / 3)
    assert rows(gold("space_kpi_by_site_current"), "site", "total_spaces", "weighted_occupancy_rate_pct") == [
        ("site a", 3, 50.0), ("site b", 2, None),
    ]
    assert rows(gold("space_kpi_by_site_space_type_current")) == [
        ("site a", "bureau", 2, 50.0, 14, 5), ("site a", "réservation", 1, 20.0, 2, 3),
        ("site b", "bureau", 1, 80.5, None, 8), ("site b", "terrasse", 1, 0.0, 0, 7),
    ]
    org = gold("space_kpi_by_site_org_type_current").select("site", "organization_type", "spaces_count")
    assert rows(org) == [
        ("site a", "n/a", 1), ("site a", "society", 2), ("site b", "costorage", 1), ("site b", "n/a", 1),
    ]


# --- serving ---
def test_space_serving(gold):
    assert serving.space_global(gold("space_kpi_global_current")).first().as_of_ts == "2024-02-06 00:00:00+00"
    by_site = serving.space_by_site(gold("space_kpi_by_site_current")).collect()
    assert [r.site for r in by_site] == ["site b", "site a"]  # unknown occupancy comes first
    split = serving.space_by_site_space_type(gold("space_kpi_by_site_space_type_current"), "site b")
    assert [tuple(r)[1:6] for r in split.collect()] == [("bureau", 1, 80.5, 0, 8), ("terrasse", 1, 0.0, 0, 7)]
    org = serving.space_by_site_org_type(gold("space_kpi_by_site_org_type_current"), "site a").collect()
    assert [r.organization_type for r in org] == ["society", "n/a"]


def test_room_list(gold):
    mart = gold("space_room_current")
    every = serving.space_rooms(mart, site="", floor=None).collect()
    assert [r.room for r in every] == ["salle 01", "salle 03", "salle 02", "accueil", "terrasse"]
    assert (every[2].employee_count, every[2].is_over_capacity, every[2].area_m2) == (0, False, 0.0)
    assert serving.space_rooms(mart, site="site a", occupancy_status="loué").count() == 1
    assert serving.space_rooms(mart, limit=2).count() == 2
    with pytest.raises(ValueError):
        serving.space_rooms(mart, limit=0)


def test_ticket_serving(gold):
    cards = gold("tickets_cards")
    assert serving.ticket_cards(cards).first().total_tickets == 5
    assert serving.ticket_cards(cards, "2024-01").first().total_tickets == 2
    assert serving.ticket_cards(cards, "1999-01").count() == 0
    assert [r.period for r in serving.tickets_by_month(gold("kpi_tickets_by_month")).collect()] == ["2024-01", "2024-02"]
    assert serving.tickets_by_year(gold("kpi_tickets_by_year")).first().year == 2024
    priorities = serving.ticket_priorities(gold("kpi_priority_distribution_period")).collect()
    assert [r.priority_code for r in priorities] == [6, 5, 2, 1]
    categories = serving.tickets_by_category(gold("kpi_tickets_by_category_period")).collect()
    assert [r.category_id for r in categories] == [1, 0, 20, None]
    locations = serving.tickets_by_location(gold("kpi_tickets_by_location_period"), "2024-02").collect()
    assert [r.location_id for r in locations] == [0, 27]
    requesters = serving.tickets_by_requester(gold("kpi_tickets_by_requester_period")).collect()
    assert [r.requester_user_id for r in requesters] == [1, 2, 9, None]
    technicians = serving.tickets_by_technician(gold("kpi_tickets_by_technician_period")).collect()
    assert [r.last_updater_user_id for r in technicians] == [2, 1, None]
    heat = serving.ticket_heatmap(gold("kpi_load_by_technician_priority_period")).collect()
    assert [(r.last_updater_full_name, r.priority_code) for r in heat] == [
        ("Admin", 6), ("Admin", 5), ("Admin", 2), ("DOE John", 5), (None, 1),
    ]


def test_ticket_list_pages(gold):
    enriched = gold("tickets_enriched")
    assert [r.ticket_id for r in serving.ticket_list(enriched, "2024-01").collect()] == [1, 2]
    page = serving.ticket_list(enriched, page_no=2, page_size=2, sort_by="priority", sort_order="desc")
    assert [r.ticket_id for r in page.collect()] == [3, 5]


def test_reservation_serving(gold):
    enriched = gold("reservations_enriched_current")
    newest = serving.reservations_current(enriched, limit=3).collect()
    assert [r.reservation_id for r in newest] == [5, 6, 4]  # no start comes first
    assert newest[1].start_ts == "2024-02-04 09:00:00+00"
    assert [r.reservation_id for r in serving.reservations_current(enriched, start_hour=9, is_invalid_duration=False).collect()] == [6, 1]
    assert [r.reservation_id for r in serving.reservations_of_user(enriched, 2).collect()] == [6, 3]
    assert [r.reservation_id for r in serving.reservations_of_item(enriched, 10, 2).collect()] == [6, 2]
    assert serving.reservation_cards(gold("reservations_kpi_cards_current")).count() == 1
    by_item = serving.reservations_by_item(gold("reservations_kpi_by_item_current"), 2).collect()
    assert [r.reservation_item_id for r in by_item] == [10, 11]
    by_user = serving.reservations_by_user(gold("reservations_kpi_by_user_current")).collect()
    assert [r.user_id for r in by_user] == [1, 2, 3, None]
    trends = serving.reservation_trends(gold("reservations_kpi_trends_by_month")).collect()
    assert [r.start_month for r in trends] == ["2024-02", "2024-01"]
    peaks = serving.peak_periods(gold("reservations_kpi_peak_period_current")).collect()
    assert [r.reservations_count for r in peaks] == [3, 1, 1]
    buckets = serving.duration_distribution(gold("reservations_kpi_duration_distribution_current")).collect()
    assert [r.duration_bucket for r in buckets] == ["1-2h", "2-4h", "<1h", ">8h"]


# --- dashboard ---
def test_item_pressure(spark, gold):
    enriched = gold("reservations_enriched_current")
    assert [tuple(r) for r in dashboard.item_pressure(enriched).collect()][0] == (
        10, "Salle COSY - Salle 4", 30, 3.5, 3, "Medium",
    )
    assert dashboard.item_pressure(enriched, newest=2).count() == 2
    many = enriched.where("reservation_id = 1").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(16))))
    busy = dashboard.coloured_pressure(dashboard.item_pressure(many)).first()
    assert (busy.occupancy, busy.pressure, busy.colour) == (100, "Critical", "red")
    eleven = dashboard.item_pressure(many.where("n <= 11")).first()
    assert (eleven.occupancy, eleven.pressure) == (100, "High")
    seven = dashboard.coloured_pressure(dashboard.item_pressure(many.where("n <= 7"))).first()
    assert (seven.occupancy, seven.pressure, seven.colour) == (70, "Medium", "yellow")


def test_underused_and_busiest(gold):
    few = dashboard.underused_items(gold("reservations_kpi_by_item_current")).collect()
    assert [(r.reservation_item_id, r.reservations) for r in few] == [(11, 1), (99, 1), (None, 1), (10, 3)]
    peaks = gold("reservations_kpi_peak_period_current")
    assert dashboard.busiest_window(peaks).first()[0] == "09:00-11:00"
    assert dashboard.busiest_window(peaks.where("reservations_count = 1")).first()[0] == "22:00-00:00"
    assert dashboard.busiest_window(peaks.limit(0)).first()[0] == "N/A"


def test_ticket_figures(gold):
    matrix = dashboard.technician_matrix(gold("kpi_load_by_technician_priority_period")).collect()
    listed = [(r.technician, r.major, r.very_high, r.low, r.other, r.row_total) for r in matrix]
    assert listed == [
        ("Admin", 1, 1, 1, 0, 3), ("DOE John", 0, 1, 0, 0, 1), (None, 0, 0, 0, 1, 1),
    ]
    cards = gold("tickets_cards")
    assert rows(dashboard.open_and_resolved(cards)) == [("Ouvert", 1), ("Résolu", 4)]
    priorities = gold("kpi_priority_distribution_period")
    assert dashboard.priority_count(priorities).first()[0] == 2
    assert dashboard.priority_count(priorities, code=3).first()[0] == 0
    shares = dashboard.technician_shares(gold("kpi_tickets_by_technician_period"), cards)
    assert rows(shares) == [(None, None, 1, 20.0), (1, "DOE John", 1, 20.0), (2, "Admin", 3, 60.0)]
    named = dashboard.named_categories(gold("kpi_tickets_by_category_period")).collect()
    assert [r.category for r in named] == ["IT and Support"] + ["Non catégorisé"] * 3


def test_site_and_user_figures(gold):
    sites = gold("space_kpi_by_site_current")
    assert rows(dashboard.banded_sites(sites)) == [("site a", 50.0, "green"), ("site b", None, "green")]
    assert rows(dashboard.site_comparison(sites)) == [("site a", 8, 1, 16, 1, 1), ("site b", 15, 1, 0, 1, 0)]
    points = dashboard.trend_points(gold("reservations_kpi_trends_by_month"))
    assert rows(points) == [("2024-01", 2, 8.5, 4.25), ("2024-02", 3, 3.0, 1.5)]
    users = dashboard.named_users(gold("reservations_kpi_by_user_current"))
    assert rows(users, "user_id", "name") == [(None, None), (1, "DOE John"), (2, "Admin"), (3, None)]
