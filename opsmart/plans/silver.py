"""Bronze to silver: one cleaned, typed row per business key.

Every builder is a single projection (one pass, no shuffle) followed by ``latest_per_key``,
whose map-side limit leaves at most one row per key and task to shuffle. Rows whose id cannot be
read are kept one by one, spread over the tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsmart.contracts import conform, silver_schema
from opsmart.functions import facility as place
from opsmart.functions import numbers as num
from opsmart.functions import people, text
from opsmart.functions import times as when_
from opsmart.operators.latest import Order, latest_per_key

STAMPS = ("_source_file", "_source_system", "_ingest_bronze_ts")

# Ticket fields that silver drops but the wide table keeps: output name -> raw field.
TICKET_EXTRA_TS = {
    "ticket_date_ts": "date",
    "waiting_begin_ts": "begin_waiting_date",
    "ola_ttr_begin_ts": "ola_ttr_begin_date",
}
TICKET_EXTRA_INT = {
    "impact_code": "impact",
    "urgency_code": "urgency",
    "global_validation_code": "global_validation",
    "action_time_sec": "actiontime",
    "waiting_duration_sec": "waiting_duration",
    "ola_waiting_duration_sec": "ola_waiting_duration",
    "sla_waiting_duration_sec": "sla_waiting_duration",
    "time_to_own_sec": "time_to_own",
    "time_to_resolve_sec": "time_to_resolve",
    "internal_time_to_own_sec": "internal_time_to_own",
    "internal_time_to_resolve_sec": "internal_time_to_resolve",
    "take_into_account_delay_sec": "takeintoaccount_delay_stat",
    "solve_delay_sec": "solve_delay_stat",
    "close_delay_sec": "close_delay_stat",
}
TICKET_EXTRA_ID = (
    "slas_id_tto", "slas_id_ttr", "slalevels_id_ttr",
    "olas_id_tto", "olas_id_ttr", "olalevels_id_ttr",
)


def _stamps(run_ts: Column | None) -> dict[str, Column]:
    kept = {name: F.col(name) for name in STAMPS}
    day = F.col("ingestion_date").cast("date")
    return {"ingestion_date": day, **kept, "_ingest_silver_ts": when_.run_stamp(run_ts)}


def _project(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.select(*[c.alias(name) for name, c in columns.items()])


def _business(columns: dict[str, Column], *keys: str) -> list[str]:
    """Columns that settle ties between equally new rows."""
    return [c for c in columns if c not in keys and c != "_ingest_silver_ts"]


#: Business key of each table that has one, and what makes a row newer than another of its key.
KEYS = {
    "users": "user_id",
    "tickets": "ticket_id",
    "reservations": "reservation_id",
    "reserveditems": "reservation_item_id",
}
NEWEST = {
    "users": ["updated_ts", "_ingest_bronze_ts", "ingestion_date"],
    "tickets": ["updated_ts", "_ingest_bronze_ts", "ingestion_date"],
    "reservations": ["ingestion_date", "_ingest_bronze_ts"],
    "reserveditems": ["_ingest_bronze_ts"],
}


def order_of(entity: str) -> Order:
    """How rows of one key are ordered in the silver table of an entity."""
    if entity not in KEYS:
        raise ValueError(f"{entity} has no key to merge by")
    names = silver_schema(entity).names
    ties = [c for c in names if c not in (KEYS[entity], *NEWEST[entity], "_ingest_silver_ts")]
    return Order(KEYS[entity], NEWEST[entity], ties)


def _versioned(df: DataFrame, columns: dict[str, Column], entity: str) -> DataFrame:
    """One row per key; rows without a readable key are no versions of each other and all stay."""
    key, newest = KEYS[entity], NEWEST[entity]
    apart = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    rows = _project(df, columns).withColumn("_unkeyed", apart)
    ties = [c for c in _business(columns, key) if c not in newest]
    return latest_per_key(rows, [key, "_unkeyed"], newest, ties).drop("_unkeyed")


def key_slices(bronze: DataFrame, count: int) -> list[DataFrame]:
    """Bronze rows in ``count`` slices, all versions of a key in one; rows without a readable key are spread."""
    if count == 1:
        return [bronze]
    content = [F.col(f"`{f.name}`") for f in bronze.schema if not isinstance(f.dataType, T.MapType)]
    place = F.pmod(F.xxhash64(F.coalesce(num.to_long(F.col("id")), F.xxhash64(*content))), F.lit(count))
    return [bronze.where(place == i) for i in range(count)]


def users(bronze: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Accounts with names derived from the login, newest version per ``user_id``."""
    login = text.clean_str(F.col("name"))
    first, last = people.login_parts(login)
    columns = {
        "user_id": num.to_long(F.col("id")),
        "user_name": login,
        "first_name": first,
        "last_name": last,
        "full_name": people.display_name(login),
        "is_active": num.to_int(F.col("is_active")),
        "is_deleted": num.to_int(F.col("is_deleted")),
        "is_deleted_ldap": num.to_int(F.col("is_deleted_ldap")),
        "created_ts": when_.parse_ts(F.col("date_creation")),
        "updated_ts": when_.parse_ts(F.col("date_mod")),
        "last_login_ts": when_.parse_ts(F.col("last_login")),
        **_stamps(run_ts),
    }
    return conform(_versioned(bronze, columns, "users"), silver_schema("users"))


def ticket_columns(run_ts: Column | None = None, wide: bool = False) -> dict[str, Column]:
    """Silver ticket columns as expressions over the raw fields."""
    columns = {
        "ticket_id": num.to_long(F.col("id")),
        "entity_id": num.to_long(F.col("entities_id")),
        "category_id": num.to_long(F.col("itilcategories_id")),
        "request_type_id": num.to_long(F.col("requesttypes_id")),
        "location_id": num.to_long(F.col("locations_id")),
        "requester_user_id": num.to_long(F.col("users_id_recipient")),
        "last_updater_user_id": num.to_long(F.col("users_id_lastupdater")),
        "title": text.clean_str(F.col("name")),
        "created_ts": when_.parse_ts(F.col("date_creation"), None),
        "updated_ts": when_.parse_ts(F.col("date_mod"), None),
        "solved_ts": when_.parse_ts(F.col("solvedate"), None),
        "closed_ts": when_.parse_ts(F.col("closedate"), None),
        "status_code": num.to_int(F.col("status")),
        "priority_code": num.to_int(F.col("priority")),
        "type_code": num.to_int(F.col("type")),
        "is_deleted": num.to_int(F.col("is_deleted")),
        **_stamps(run_ts),
    }
    if wide:
        columns["description_html"] = text.clean_str(F.col("content"))
        columns["validation_percent"] = num.to_double(F.col("validation_percent"))
        columns |= {n: when_.parse_ts(F.col(raw), None) for n, raw in TICKET_EXTRA_TS.items()}
        columns |= {n: num.to_int(F.col(raw)) for n, raw in TICKET_EXTRA_INT.items()}
        columns |= {n: num.to_long(F.col(n)) for n in TICKET_EXTRA_ID}
    return columns


def tickets(bronze: DataFrame, run_ts: Column | None = None, wide: bool = False) -> DataFrame:
    """Tickets, newest version per ``ticket_id``; ``wide`` keeps the SLA and delay fields."""
    rows = _versioned(bronze, ticket_columns(run_ts, wide), "tickets")
    return rows if wide else conform(rows, silver_schema("tickets"))


def reservations(bronze: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Reservations with duration and validity, newest version per ``reservation_id``.

    Both ends are parsed in a projection of their own: the derived columns use them several times.
    """
    parsed = {"start_ts": F.col("begin"), "end_ts": F.col("end")}
    bronze = bronze.withColumns({n: when_.parse_ts(c) for n, c in parsed.items()})
    start, end = F.col("start_ts"), F.col("end_ts")
    columns = {
        "reservation_id": num.to_long(F.col("id")),
        "user_id": num.to_long(F.col("users_id")),
        "reservation_item_id": num.to_long(F.col("reservationitems_id")),
        "group_id": num.to_long(F.col("group")),
        "start_ts": start,
        "end_ts": end,
        "duration_hours": when_.hours_between(start, end),
        "is_invalid_duration": when_.is_reversed(start, end),
        "comment": text.clean_str(F.col("comment")),
        **_stamps(run_ts),
    }
    rows = _versioned(bronze, columns, "reservations")
    return conform(rows, silver_schema("reservations"))


def reserveditems(bronze: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Bookable items with tidy names, newest ingest per id; rows without an id are dropped."""
    columns = {
        "reservation_item_id": num.to_long(F.col("id")),
        "reservation_item_name": place.item_label(F.col("items_id")),
        "itemtype": F.col("itemtype"),
        "is_active": num.is_one(F.col("is_active")),
        "is_deleted": num.is_one(F.col("is_deleted")),
        "is_recursive": num.is_one(F.col("is_recursive")),
        **_stamps(run_ts),
    }
    keyed = bronze.where(num.to_long(F.col("id")).isNotNull())
    rows = _versioned(keyed, columns, "reserveditems")
    return conform(rows, silver_schema("reserveditems"))


def rooms(bronze: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Rooms of the facility sheet; rows without a room are dropped. Not deduplicated here."""
    named = bronze.where(F.col("salle").isNotNull())
    columns = {
        "site": text.clean_text(F.col("viilage")),
        "floor": place.floor_label(F.col("etage")),
        "room": place.room_label(F.col("salle")),
        "occupancy_status": text.norm(F.col("etat")),
        "organization_name": text.clean_text(F.col("nom_de_lorganisation"), place.NOT_AVAILABLE),
        "organization_type": place.organization_type_label(F.col("type_de_lorganisation")),
        "space_type": place.space_type_label(F.col("type_de_lespace"), F.col("etat")),
        "activity": text.clean_text(F.col("activite"), place.NOT_AVAILABLE),
        "employee_count": num.to_int(F.col("nb_employes")),
        "total_capacity": num.to_int(F.col("capacite_totale")),
        "area_m2": num.to_double(F.col("surface_m2")),
        "_ingestion_date": F.col("_ingestion_date").cast("date"),
        "_source_file": F.col("_source_file"),
        "_source_system": F.col("_source_system"),
        "_entity": F.col("_entity"),
        "_ingest_ts": F.col("_ingest_ts"),
        "_silver_ts": when_.run_stamp(run_ts),
    }
    rate = num.percent_of(F.col("employee_count"), F.col("total_capacity"))
    typed = _project(named, columns).withColumn("occupancy_rate_pct", rate)
    return conform(typed, silver_schema("space_repartition"))


BUILDERS = {
    "users": users,
    "tickets": tickets,
    "reservations": reservations,
    "reserveditems": reserveditems,
    "space_repartition": rooms,
}
