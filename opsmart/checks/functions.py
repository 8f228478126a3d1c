"""Column expressions (SF), projections and predicates (PF)."""

from __future__ import annotations

from pyspark.sql import functions as F

from opsmart.checks.marts import room_mart
from opsmart.checks.prelude import hours, missing, norm, real, whole, window_label
from opsmart.checks.registry import check
from opsmart.functions import facility, numbers, people, text, times
from opsmart.operators.lookup import in_role
from opsmart.operators.rollup import counted
from opsmart.operators.select import filter_optional
from opsmart.plans import gold_tickets, serving, silver


# --- projections and predicates ---
@check("pf_01_projection", """SELECT ticket_id, request_type_id, location_id, type_code, category_id, priority_code,
    status_code FROM tk""")
def _(t):
    return t.tickets.select(*gold_tickets.SLICE_COLUMNS)


@check("pf_02_rename", """SELECT user_id AS requester_user_id, user_name AS requester_login,
    full_name AS requester_full_name FROM us""")
def _(t):
    return in_role(t.users, gold_tickets.REQUESTER)


@check("pf_03_not_null", "SELECT ticket_id, created_ts FROM tk WHERE created_ts IS NOT NULL")
def _(t):
    return t.tickets.where(F.col("created_ts").isNotNull()).select("ticket_id", "created_ts")


@check("pf_04_code_equals", "SELECT ticket_id, type_code FROM tk WHERE type_code = 2")
def _(t):
    return gold_tickets.of_type(t.tickets, 2).select("ticket_id", "type_code")


@check("pf_05_case", f"""SELECT floor, count(*) AS rooms FROM (SELECT CASE WHEN {norm("etage")} LIKE '1èr%' THEN 'premier étage'
    WHEN {norm("etage")} LIKE '2ème%' THEN 'deuxième étage' WHEN {norm("etage")} LIKE '9ème%' THEN 'neuvième étage'
    WHEN {norm("etage")} LIKE 'rdc%' THEN 'rez de chaussée' ELSE {norm("etage")} END AS floor FROM rmb) GROUP BY floor""")
def _(t):
    return counted(t.bronze_rooms, facility.floor_label(F.col("etage")).alias("floor"), name="rooms")


@check("pf_06_like", f"""SELECT count(*) FILTER (WHERE {norm("etage")} LIKE '1èr%') AS prefixed,
    count(*) FILTER (WHERE {norm("salle")} LIKE '%05') AS suffixed,
    count(*) FILTER (WHERE {norm("etat")} LIKE '%réser%') AS mentioned FROM rmb""")
def _(t):
    floor, room = text.norm(F.col("etage")), text.norm(F.col("salle"))
    return t.bronze_rooms.agg(
        F.count_if(F.startswith(floor, F.lit("1èr"))).alias("prefixed"),
        F.count_if(F.endswith(room, F.lit("05"))).alias("suffixed"),
        F.count_if(facility.has_status(F.col("etat"), mentions=facility.RESERVABLE)).alias("mentioned"),
    )


@check("pf_07_missing", f"""SELECT {missing("type_de_lorganisation")} AS is_missing, count(*) AS rows FROM rmb GROUP BY 1""")
def _(t):
    return counted(
        t.bronze_rooms, text.is_missing(F.col("type_de_lorganisation")).alias("is_missing"), name="rows"
    )


@check("pf_08_shared_predicate", """SELECT is_open, count(*) AS tickets, count(*) FILTER (WHERE is_open) AS open_tickets
    FROM (SELECT solved_ts IS NULL AND closed_ts IS NULL AS is_open FROM tk) GROUP BY is_open""")
def _(t):
    open_ = gold_tickets.is_open()
    return t.tickets.groupBy(open_.alias("is_open")).agg(
        F.count(F.lit(1)).alias("tickets"), F.count_if(open_).alias("open_tickets")
    )


@check("pf_09_optional_filter", """SELECT ticket_id, status_code, priority_code FROM tk
    WHERE status_code = 3 AND priority_code = 5""")
def _(t):
    wanted = {"status_code": 3, "priority_code": 5, "type_code": None, "title": ""}
    return filter_optional(t.tickets, wanted, blank_is_absent=True).select(
        "ticket_id", "status_code", "priority_code"
    )


@check("pf_10_default_on_read", """SELECT room_nk, coalesce(employee_count, 0) AS employee_count,
    coalesce(area_m2, 0) AS area_m2, coalesce(is_over_capacity, FALSE) AS is_over_capacity FROM rc""")
def _(t):
    shown = [serving.or_zero("employee_count", "int"), serving.or_zero("area_m2", "double")]
    return room_mart(t).select("room_nk", *shown, serving.or_zero("is_over_capacity", "boolean"))


@check("pf_11_as_text", """SELECT ticket_id, strftime(created_ts, '%Y-%m-%d %H:%M:%S') || '+00' AS created,
    CAST(ingestion_date AS VARCHAR) AS ingested FROM tk""")
def _(t):
    return t.tickets.select(
        "ticket_id",
        text.stamp_text(F.col("created_ts")).alias("created"),
        text.as_text(F.col("ingestion_date")).alias("ingested"),
    )


# --- scalar expressions ---
@check("sf_01_norm", f"SELECT {norm('viilage')} AS site, count(*) AS rows FROM rmb GROUP BY 1")
def _(t):
    return counted(t.bronze_rooms, text.norm(F.col("viilage")).alias("site"), name="rows")


@check("sf_02_clean_text", f"""SELECT CASE WHEN {missing("viilage")} THEN NULL ELSE {norm("viilage")} END AS site,
    CASE WHEN {missing("nom_de_lorganisation")} THEN 'n/a' ELSE {norm("nom_de_lorganisation")} END AS organization,
    count(*) AS rows FROM rmb GROUP BY 1, 2""")
def _(t):
    return counted(
        t.bronze_rooms,
        text.clean_text(F.col("viilage")).alias("site"),
        text.clean_text(F.col("nom_de_lorganisation"), "n/a").alias("organization"),
        name="rows",
    )


@check("sf_03_clean_str", "SELECT nullif(trim(raw_name), '') AS title, count(*) AS rows FROM tkb GROUP BY 1")
def _(t):
    return counted(t.bronze_tickets, text.clean_str(F.col("name")).alias("title"), name="rows")


@check("sf_04_to_int", f"""SELECT raw_status AS raw, {whole("raw_status")} AS code, count(*) AS rows FROM tkb GROUP BY 1, 2
    UNION ALL SELECT nb_employes, {whole("nb_employes")}, count(*) FROM rmb GROUP BY 1, 2""")
def _(t):
    def parsed(df, name):
        return counted(df, F.col(name).alias("raw"), numbers.to_int(F.col(name)).alias("code"), name="rows")

    return parsed(t.bronze_tickets, "status").unionByName(parsed(t.bronze_rooms, "nb_employes"))


@check("sf_05_to_double", f"""SELECT surface_m2 AS raw, {real("surface_m2")} AS area, count(*) AS rows FROM rmb GROUP BY 1, 2""")
def _(t):
    raw = F.col("surface_m2")
    return counted(t.bronze_rooms, raw.alias("raw"), numbers.to_double(raw).alias("area"), name="rows")


@check("sf_06_to_long", """SELECT CASE WHEN c_custkey % 499 <> 0 THEN c_custkey END AS user_id, count(*) AS rows
    FROM (SELECT c_custkey FROM customer UNION ALL SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0) GROUP BY 1""")
def _(t):
    return counted(t.bronze_users, numbers.to_long(F.col("id")).alias("user_id"), name="rows")


@check("sf_07_parse_ts", """SELECT CASE WHEN o_orderkey % 487 = 0 THEN 'null' ELSE CAST(o_orderkey AS VARCHAR) END AS id,
    created_ts, updated_ts FROM tkb""")
def _(t):
    return t.bronze_tickets.select(
        "id",
        times.parse_ts(F.col("date_creation")).alias("created_ts"),
        times.parse_ts(F.col("date_mod"), None).alias("updated_ts"),
    )


@check("sf_08_duration_hours", f"""SELECT ticket_id, {hours("created_ts", "solved_ts")} AS to_solve,
    {hours("created_ts", "closed_ts")} AS to_close FROM tk""")
def _(t):
    created = F.col("created_ts")
    return t.tickets.select(
        "ticket_id",
        times.hours_between(created, F.col("solved_ts")).alias("to_solve"),
        times.hours_between(created, F.col("closed_ts")).alias("to_close"),
    )


@check("sf_09_invalid_interval", """SELECT ticket_id, created_ts IS NOT NULL AND solved_ts IS NOT NULL
    AND solved_ts < created_ts IS TRUE AS is_invalid FROM tk""")
def _(t):
    return t.tickets.select("ticket_id", gold_tickets.has_invalid_solve_time().alias("is_invalid"))


@check("sf_10_open_flag", "SELECT ticket_id, CASE WHEN solved_ts IS NULL AND closed_ts IS NULL THEN 1 ELSE 0 END AS is_open FROM tk")
def _(t):
    return t.tickets.select("ticket_id", gold_tickets.is_open().cast("int").alias("is_open"))


@check("sf_11_calendar", """SELECT ticket_id, strftime(created_ts, '%Y-%m') AS period,
    CAST(year(created_ts) AS INTEGER) AS year, CAST(hour(created_ts) AS INTEGER) AS hour,
    CAST(created_ts AS DATE) AS day FROM tk""")
def _(t):
    created = F.col("created_ts")
    return t.tickets.select(
        "ticket_id",
        times.month_label(created).alias("period"),
        F.year(created).alias("year"),
        F.hour(created).alias("hour"),
        F.to_date(created).alias("day"),
    )


@check("sf_12_window_label", f"""SELECT event_id, {window_label("hour(ts)")} AS label FROM events""")
def _(t):
    return t.source("events").select("event_id", times.window_label(F.hour("ts")).alias("label"))


@check("sf_13_percent", """SELECT room_nk, CASE WHEN total_capacity <> 0 THEN coalesce(employee_count, 0) / total_capacity::DOUBLE * 100.0::DOUBLE END AS occupancy,
    CASE WHEN area_m2 > 0 THEN coalesce(employee_count, 0) / area_m2 * 100.0::DOUBLE END AS density FROM rc""")
def _(t):
    return room_mart(t).select(
        "room_nk",
        numbers.percent_of(F.col("employee_count"), F.col("total_capacity")).alias("occupancy"),
        numbers.percent_of(F.col("employee_count"), F.col("area_m2"), True).alias("density"),
    )


@check("sf_14_over_capacity", "SELECT employee_count > total_capacity AS over, count(*) AS rooms FROM rm GROUP BY 1")
def _(t):
    over = numbers.exceeds(F.col("employee_count"), F.col("total_capacity"))
    return counted(t.typed_rooms, over.alias("over"), name="rooms")


@check("sf_15_person_name", "SELECT c_custkey AS user_id, first_name, last_name, full_name FROM us_named")
def _(t):
    login = text.clean_str(t.login())
    first, last = people.login_parts(login)
    return t.source("customer").select(
        F.col("c_custkey").alias("user_id"),
        first.alias("first_name"),
        last.alias("last_name"),
        people.display_name(login).alias("full_name"),
    )


@check("sf_16_floor", "SELECT floor, count(*) AS rooms FROM rm GROUP BY floor")
def _(t):
    return counted(t.typed_rooms, "floor", name="rooms")


@check("sf_17_room", "SELECT room, count(*) AS rooms FROM rm GROUP BY room")
def _(t):
    return counted(t.typed_rooms, "room", name="rooms")


@check("sf_18_organization_type", "SELECT organization_type, count(*) AS rooms FROM rm GROUP BY 1")
def _(t):
    return counted(t.typed_rooms, "organization_type", name="rooms")


@check("sf_19_space_type", "SELECT space_type, occupancy_status, count(*) AS rooms FROM rm GROUP BY 1, 2")
def _(t):
    return counted(t.typed_rooms, "space_type", "occupancy_status", name="rooms")


@check("sf_20_item_name", "SELECT reservation_item_id, reservation_item_name FROM it")
def _(t):
    return t.typed_items


@check("sf_21_is_one", """SELECT reservation_item_id, is_active, is_deleted, is_recursive FROM its""")
def _(t):
    return silver.reserveditems(t.bronze_items, t.run_ts).select(
        "reservation_item_id", "is_active", "is_deleted", "is_recursive"
    )


@check("sf_22_natural_key", """SELECT coalesce(site, '∅') || '|' || coalesce(floor, '∅') || '|' || room AS safe_key,
    concat_ws('|', site, floor, room) AS joined_key, count(*) AS rows FROM rm GROUP BY 1, 2""")
def _(t):
    parts = [F.col("site"), F.col("floor"), F.col("room")]
    return counted(
        t.typed_rooms,
        text.natural_key(*parts).alias("safe_key"),
        text.natural_key(*parts, null_marker=None).alias("joined_key"),
        name="rows",
    )


@check("sf_23_ticket_fields", """SELECT ticket_id, status_code, solve_delay_sec, validation_percent, slas_id_ttr,
    CAST(NULL AS INTEGER) AS impact_code FROM tks""")
def _(t):
    return silver.tickets(t.bronze_tickets, t.run_ts, wide=True).select(
        "ticket_id", "status_code", "solve_delay_sec", "validation_percent", "slas_id_ttr", "impact_code"
    )


@check("sf_24_label_or", """SELECT user_id, coalesce(nullif(full_name, ''), user_name) AS name,
    coalesce(nullif(user_name, ''), 'anonymous') AS login FROM us""")
def _(t):
    return t.users.select(
        "user_id",
        text.label_or(F.col("full_name"), F.col("user_name")).alias("name"),
        text.label_or(F.col("user_name"), "anonymous").alias("login"),
    )

