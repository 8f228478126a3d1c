"""Schemas of every stored table, and the projection that enforces them.

Column names and types are fixed values: readers of the serving tables depend on them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- landing: every field is read as text; typing is the silver layer's work -------------
LANDING_FIELDS = {
    "users": "id name is_active is_deleted is_deleted_ldap date_creation date_mod last_login",
    "tickets": """
        id entities_id itilcategories_id locations_id requesttypes_id users_id_recipient
        users_id_lastupdater date date_creation date_mod solvedate closedate begin_waiting_date
        ola_ttr_begin_date name content status type priority impact urgency is_deleted
        global_validation validation_percent actiontime waiting_duration ola_waiting_duration
        sla_waiting_duration time_to_own time_to_resolve internal_time_to_own
        internal_time_to_resolve takeintoaccount_delay_stat solve_delay_stat close_delay_stat
        slas_id_tto slas_id_ttr slalevels_id_ttr olas_id_tto olas_id_ttr olalevels_id_ttr""",
    "reservations": "id users_id reservationitems_id group begin end comment",
    "reserveditems": "id items_id entities_id itemtype comment is_active is_deleted is_recursive",
    "computers": "id name",
}


def landing_schema(entity: str) -> T.StructType:
    """All-text schema of one landing entity."""
    return T.StructType([T.StructField(n, T.StringType()) for n in LANDING_FIELDS[entity].split()])


# --- silver -------------------------------------------------------------------------------
_STAMPS = """ingestion_date date, _source_file string, _source_system string,
    _ingest_bronze_ts timestamp, _ingest_silver_ts timestamp"""

SILVER = {
    "users": f"""user_id bigint, user_name string, first_name string, last_name string,
        full_name string, is_active int, is_deleted int, is_deleted_ldap int,
        created_ts timestamp, updated_ts timestamp, last_login_ts timestamp, {_STAMPS}""",
    "tickets": f"""ticket_id bigint, entity_id bigint, category_id bigint,
        request_type_id bigint, location_id bigint, requester_user_id bigint,
        last_updater_user_id bigint, title string, created_ts timestamp, updated_ts timestamp,
        solved_ts timestamp, closed_ts timestamp, status_code int, priority_code int,
        type_code int, is_deleted int, {_STAMPS}""",
    "reservations": f"""reservation_id bigint, user_id bigint, reservation_item_id bigint,
        group_id bigint, start_ts timestamp, end_ts timestamp, duration_hours double,
        is_invalid_duration boolean, comment string, {_STAMPS}""",
    "reserveditems": f"""reservation_item_id bigint, reservation_item_name string,
        itemtype string, is_active boolean, is_deleted boolean, is_recursive boolean,
        {_STAMPS}""",
    "space_repartition": """site string, floor string, room string, occupancy_status string,
        organization_name string, organization_type string, space_type string,
        activity string, employee_count int, total_capacity int, area_m2 double,
        occupancy_rate_pct double, _ingestion_date date, _source_file string,
        _source_system string, _entity string, _ingest_ts timestamp, _silver_ts timestamp""",
    "ticket_status": "status_code bigint, status string",
    "ticket_priority": "priority_code bigint, priority string",
    "ticket_type": "type_code bigint, type string",
    "ticket_category": "category_id bigint, category string",
    "ticket_location": "location_id bigint, location string",
}

# --- serving ------------------------------------------------------------------------------
_BUILT = "gold_kpi_build_ts timestamp"
SERVING_SCHEMA = "srv"
SERVING = {
    "space": {
        "space_room_current": """room_nk string, site string, floor string, room string,
            occupancy_status string, organization_name string, organization_type string,
            space_type string, activity string, employee_count int, total_capacity int,
            area_m2 double, occupancy_rate_pct double, density_emp_per_100m2 double,
            is_over_capacity boolean, _ingestion_date date, last_updated_ts timestamp""",
        "space_kpi_global_current": """villages_count int, total_spaces int,
            total_area_m2 double, total_capacity bigint, total_employees bigint,
            leased_spaces bigint, non_leased_spaces bigint, reservation_spaces bigint,
            per_person_spaces bigint, underutilized_spaces_lt_40pct bigint,
            overoccupied_spaces_gt_100pct bigint, avg_density_emp_per_100m2 double,
            weighted_occupancy_rate_pct double, _as_of_ts timestamp""",
        "space_kpi_by_site_current": """site string, total_spaces int, total_area_m2 double,
            total_capacity bigint, total_employees bigint, leased_spaces bigint,
            non_leased_spaces bigint, underutilized_spaces_lt_40pct bigint,
            overoccupied_spaces_gt_100pct bigint, avg_density_emp_per_100m2 double,
            weighted_occupancy_rate_pct double, _as_of_ts timestamp""",
        "space_kpi_by_site_space_type_current": """site string, space_type string,
            spaces_count int, sum_area_m2 double, sum_capacity bigint, sum_employees bigint,
            _as_of_ts timestamp""",
        "space_kpi_by_site_org_type_current": """site string, organization_type string,
            spaces_count int, sum_employees bigint, sum_area_m2 double, sum_capacity bigint,
            _as_of_ts timestamp""",
    },
    "reservations": {
        "reservations_enriched_current": """reservation_id bigint, user_id bigint,
            user_login string, user_full_name string, reservation_item_id bigint,
            reservation_item_name string, group_id bigint, start_ts timestamp,
            end_ts timestamp, duration_hours double, is_invalid_duration boolean,
            comment string, start_date date, start_month string, start_year bigint,
            start_hour bigint, start_hour_2h_window string, ingestion_date date,
            _source_file string, _source_system string, _ingest_bronze_ts timestamp,
            _ingest_silver_ts timestamp, _ingest_gold_ts timestamp""",
        "reservations_kpi_cards_current": f"""total_reservations bigint, reserved_hours double,
            avg_duration_hours double, invalid_duration_count bigint, distinct_items bigint,
            distinct_users bigint, {_BUILT}""",
        "reservations_kpi_peak_period_current": f"""start_hour_2h_window string,
            reservations_count bigint, {_BUILT}""",
        "reservations_kpi_trends_by_month": f"""start_month string, reservations_count bigint,
            reserved_hours double, avg_duration_hours double, invalid_duration_count bigint,
            {_BUILT}""",
        "reservations_kpi_by_item_current": f"""reservation_item_id bigint,
            reservation_item_name string, reservations_count bigint, reserved_hours double,
            avg_duration_hours double, {_BUILT}""",
        "reservations_kpi_by_user_current": f"""user_id bigint, user_login string,
            user_full_name string, reservations_count bigint, reserved_hours double,
            avg_duration_hours double, {_BUILT}""",
        "reservations_kpi_duration_distribution_current": f"""duration_bucket string,
            reservations_count bigint, {_BUILT}""",
        "reservations_kpi_invalid_current": f"""reservation_id bigint, user_id bigint,
            user_login string, user_full_name string, reservation_item_id bigint,
            reservation_item_name string, start_ts timestamp, end_ts timestamp,
            ingestion_date date, _source_file string, {_BUILT}""",
    },
    "tickets": {
        "tickets_enriched": """ticket_id bigint, title string, category_id bigint,
            category string, location_id bigint, location string, requester_user_id bigint,
            requester_login string, requester_full_name string, last_updater_user_id bigint,
            last_updater_login string, last_updater_full_name string, type_code bigint,
            type string, status_code bigint, status string, is_open boolean,
            is_deleted boolean, priority_code bigint, priority string, created_ts timestamp,
            updated_ts timestamp, solved_ts timestamp, closed_ts timestamp,
            time_to_solve_hours double, time_to_close_hours double, _source_file string,
            _source_system string, ingestion_date date, _ingest_bronze_ts timestamp,
            _ingest_silver_ts timestamp, _ingest_gold_ts timestamp""",
        "kpi_load_by_technician_priority_period": f"""period string,
            last_updater_user_id bigint, last_updater_full_name string, priority_code bigint,
            priority string, ticket_count bigint, {_BUILT}""",
        "kpi_priority_distribution_period": f"""period string, priority_code bigint,
            priority string, ticket_count bigint, {_BUILT}""",
        "kpi_status_distribution_period": f"""period string, status_code bigint,
            status string, ticket_count bigint, {_BUILT}""",
        "kpi_tickets_by_category_period": f"""period string, category_id bigint,
            category string, ticket_count bigint, total_tickets bigint, share double,
            {_BUILT}""",
        "kpi_tickets_by_month": f"period string, ticket_count bigint, {_BUILT}",
        "kpi_tickets_by_requester_period": f"""period string, requester_user_id bigint,
            requester_login string, requester_full_name string, ticket_count bigint,
            {_BUILT}""",
        "kpi_tickets_by_technician_period": f"""period string, last_updater_user_id bigint,
            last_updater_full_name string, ticket_count bigint, {_BUILT}""",
        "kpi_tickets_by_year": f"year bigint, ticket_count bigint, {_BUILT}",
        "kpi_tickets_by_location_period": f"""period string, location_id bigint,
            location string, ticket_count bigint, total_tickets bigint, share double,
            {_BUILT}""",
        "tickets_cards": f"""period string, total_tickets bigint, is_open bigint,
            is_resolved bigint, technicians bigint, open_rate double, {_BUILT}""",
    },
}
SERVING_KEYS = {
    "space_room_current": ["room_nk"],
    "space_kpi_by_site_current": ["site"],
    "space_kpi_by_site_space_type_current": ["site", "space_type"],
    "space_kpi_by_site_org_type_current": ["site", "organization_type"],
}
FACT_TABLES = {"space_room_current", "reservations_enriched_current", "tickets_enriched"}


def schema_of(ddl: str) -> T.StructType:
    """A contract text as a schema."""
    return T.StructType.fromDDL(" ".join(ddl.split()))


def silver_schema(table: str) -> T.StructType:
    return schema_of(SILVER[table])


def serving_schema(table: str) -> T.StructType:
    for tables in SERVING.values():
        if table in tables:
            return schema_of(tables[table])
    raise KeyError(table)


def serving_tables() -> Mapping[str, str]:
    """Every serving table with the domain it belongs to."""
    return {table: domain for domain, tables in SERVING.items() for table in tables}


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Exactly the contract's columns, in order and type; a missing column is an error.

    An integer 0/1 code published as a boolean becomes ``code = 1``.
    """
    missing = [f.name for f in contract if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    out = []
    for field in contract:
        column, have = F.col(f"`{field.name}`"), df.schema[field.name].dataType
        if have != field.dataType:
            is_code = isinstance(field.dataType, T.BooleanType) and isinstance(
                have, T.IntegralType
            )
            column = column == F.lit(1) if is_code else column.cast(field.dataType)
        out.append(column.alias(field.name))
    return df.select(*out)


def contract_columns(tables: Mapping[str, str] | None = None) -> list[tuple[str, str, int, str]]:
    """(table, column, position, type) for every serving column."""
    return [
        (table, field.name, position, field.dataType.simpleString())
        for table in (tables or serving_tables())
        for position, field in enumerate(serving_schema(table), 1)
    ]
