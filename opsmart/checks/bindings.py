"""The supplied tables seen as the engine's own tables.

The layers are stored as they are in production: bronze, silver and gold tables are written once
per session and data directory. Silver builders read stored bronze, the marts stored silver, the
serving queries stored gold.

Orders play tickets, line items reservations, customers users, parts items and rooms, and events
the daily exports. Every row of a source table becomes (at least) one row here; missing and dirty
values are put in by arithmetic on the keys, since the supplied tables have none. The same
definitions exist as SQL in ``prelude``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsmart import session
from opsmart.contracts import LANDING_FIELDS, conform, silver_schema
from opsmart.functions import facility, people, text
from opsmart.functions import times as when_
from opsmart.operators.latest import latest_per_key
from opsmart.plans import dims, silver
from opsmart.sources import lake
from opsmart.sources.landing import clean_names

RUN_STAMP = "2024-02-01 00:00:00"
SNAPSHOT_DAY = "2024-01-31"
ROWS_PER_FILE = 50_000
RAW_ROOM_HEADERS = (
    "Viilage", "Étage", "Salle", "État", "Nom de l'organisation", "Type de l'organisation",
    "Type de l'espace", "Activité", "Nb employés", "Capacité totale", "Surface m²",
)


def plain(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the SQL side has them."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def _hours_after(ts: Column, hours: Column) -> Column:
    return F.timestamp_add("HOUR", hours, ts.cast("timestamp"))


def _minutes_after(ts: Column, minutes: Column) -> Column:
    return F.timestamp_add("MINUTE", minutes, ts)


def _text_ts(ts: Column) -> Column:
    return F.date_format(ts, when_.TIMESTAMP_FORMAT)


# (application, data directory, table) -> folder it was stored in by this process.
_STORED: dict[tuple[str, str, str], str] = {}


class Tables:
    """All bindings of one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = session.pin(spark)
        self.sf_dir = sf_dir
        self.run_ts = F.lit(RUN_STAMP).cast("timestamp")

    def source(self, name: str) -> DataFrame:
        """A supplied table."""
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def scratch(self, label: str) -> str:
        """A fresh shared folder."""
        return session.shared_dir(self.spark, label)

    def stored(self, table: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A table of a stored layer; the first use writes it."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, table)
        if key not in _STORED:
            path, rows = self.scratch(table), build()
            with session.shuffles_for(self.spark, session.input_paths(rows)):
                lake.replace_snapshot(rows, path, ROWS_PER_FILE)
            _STORED[key] = path
        return lake.read_table(self.spark, _STORED[key])

    @cached_property
    def codes(self) -> dict[str, DataFrame]:
        return dims.all_code_tables(self.spark)

    def _stamps(self, source: str, bronze_ts: Column) -> dict[str, Column]:
        return {
            "ingestion_date": F.lit(SNAPSHOT_DAY).cast("date"),
            "_source_file": F.lit(source),
            "_source_system": F.lit("glpi"),
            "_ingest_bronze_ts": bronze_ts,
        }

    # --- tickets <- orders ---
    def _ticket_times(self) -> dict[str, Column]:
        k, day, state = F.col("o_orderkey"), F.col("o_orderdate"), F.col("o_orderstatus")
        to_solve = k * 37 % 2000 - 100
        return {
            "created": F.when(k % 50 != 0, _hours_after(day, k % 24)),
            "updated": _hours_after(day, k % 72),
            "solved": F.when(state == "F", _hours_after(day, to_solve)),
            "closed": F.when((state == "F") & (k % 3 == 0), _hours_after(day, to_solve + k % 72))
            .when((state == "P") & (k % 17 == 0), _hours_after(day, F.lit(5))),
        }

    def _ticket_codes(self) -> dict[str, Column]:
        k, state = F.col("o_orderkey"), F.col("o_orderstatus")
        urgency = 7 - F.left(F.col("o_orderpriority"), F.lit(1)).cast("int")
        return {
            "status": (k % 6 + 1).cast("int"),
            "priority": F.when(k % 97 == 0, F.lit(1)).otherwise(urgency),
            "type": F.when(state == "F", 1).when(state == "O", 2).otherwise(3),
            "deleted": (k % 40 == 0).cast("int"),
        }

    @property
    def tickets(self) -> DataFrame:
        """Stored silver tickets."""
        return self.stored("silver_tickets", lambda: self.typed_tickets)

    @cached_property
    def typed_tickets(self) -> DataFrame:
        """Silver tickets."""
        k, when, code = F.col("o_orderkey"), self._ticket_times(), self._ticket_codes()
        columns = {
            "ticket_id": k,
            "entity_id": k % 3,
            "category_id": k % 21,
            "request_type_id": k % 5,
            "location_id": k % 29,
            "requester_user_id": F.col("o_custkey"),
            "last_updater_user_id": F.when(k % 61 != 0, k * 7 % 1700),
            "title": F.concat(F.lit("Ticket "), k.cast("string")),
            "created_ts": when["created"],
            "updated_ts": when["updated"],
            "solved_ts": when["solved"],
            "closed_ts": when["closed"],
            "status_code": code["status"],
            "priority_code": code["priority"],
            "type_code": code["type"],
            "is_deleted": code["deleted"],
            **self._stamps("orders", when["updated"]),
            "_ingest_silver_ts": self.run_ts,
        }
        rows = self.source("orders").select(*[c.alias(n) for n, c in columns.items()])
        return conform(rows, silver_schema("tickets"))

    @property
    def bronze_tickets(self) -> DataFrame:
        """Stored bronze tickets."""
        return self.stored("bronze_tickets", lambda: self.exported_tickets)

    @property
    def exported_tickets(self) -> DataFrame:
        """Ticket export rows: text only, dirty codes, some unreadable ids, a second version of every
        fourth ticket."""
        return self.ticket_exports.drop("_key", "_version")

    def ticket_day(self, number: int) -> DataFrame:
        """The export of one of three days: every row comes on one of them, and the second version of
        every eighth ticket was created forty days later."""
        k, version = F.col("_key"), F.col("_version")
        created = F.to_timestamp(F.when(F.col("date_creation").startswith("0"), None).otherwise(F.col("date_creation")))
        moved = _text_ts(F.timestamp_add("DAY", F.lit(40), created))
        late = (version == 1) & (k % 8 == 0) & created.isNotNull()
        rows = self.ticket_exports.where((k + version) % 3 == number)
        return rows.withColumn("date_creation", F.when(late, moved).otherwise(F.col("date_creation"))).drop(
            "_key", "_version", "ingestion_date", "_source_file", "_source_system", "_ingest_bronze_ts"
        )

    @cached_property
    def ticket_exports(self) -> DataFrame:
        """``exported_tickets`` with the ticket's key and version."""
        k, when, code = F.col("o_orderkey"), self._ticket_times(), self._ticket_codes()
        version = F.col("version")
        as_text = {n: c.cast("string") for n, c in code.items()}
        dirty_status = (
            F.when(k % 13 == 0, F.lit("null"))
            .when(k % 17 == 0, F.concat(as_text["status"], F.lit(",5")))
            .when(k % 19 == 0, F.lit("abc"))
            .otherwise(F.concat(F.lit(" "), as_text["status"], F.lit(" ")))
        )
        updated = F.when(k % 10 != 0, _hours_after(F.col("o_orderdate"), k % 72 + version))
        raw = {
            "id": F.when(k % 487 == 0, F.lit("null")).otherwise(k.cast("string")),
            "entities_id": k % 3,
            "itilcategories_id": k % 21,
            "locations_id": k % 29,
            "requesttypes_id": k % 5,
            "users_id_recipient": F.col("o_custkey"),
            "users_id_lastupdater": F.when(k % 61 != 0, k * 7 % 1700),
            "date_creation": F.coalesce(_text_ts(when["created"]), F.lit("0000-00-00 00:00:00")),
            "date_mod": _text_ts(updated),
            "solvedate": _text_ts(when["solved"]),
            "closedate": _text_ts(when["closed"]),
            "name": F.when(k % 23 == 0, F.lit("  ")).otherwise(
                F.concat(F.lit(" Ticket "), k.cast("string"), F.lit(" v"), version.cast("string"))
            ),
            "status": dirty_status,
            "type": code["type"],
            "priority": code["priority"],
            "is_deleted": code["deleted"],
            "solve_delay_stat": F.concat((k % 9).cast("string"), F.lit(".7")),
            "validation_percent": F.concat((k % 100).cast("string"), F.lit(",25")),
            "slas_id_ttr": k % 4,
        }
        exported = [raw.get(n, F.lit(None)).cast("string").alias(n) for n in LANDING_FIELDS["tickets"].split()]
        stamps = self._stamps("orders", _hours_after(F.col("o_orderdate"), k % 72 + version))
        versions = F.explode(F.sequence(F.lit(0), F.when(k % 4 == 0, 1).otherwise(0)))
        return (
            self.source("orders")
            .withColumn("version", versions)
            .select(*exported, *[c.alias(n) for n, c in stamps.items()], k.alias("_key"), version.alias("_version"))
        )

    # --- users <- customer ---
    @staticmethod
    def login() -> Column:
        k, name = F.col("c_custkey"), F.lower("c_mktsegment")
        key = k.cast("string")
        return (
            F.when(k % 15 == 0, F.lit(""))
            .when(k % 10 == 0, F.concat(F.lit("admin"), key))
            .when(k % 7 == 0, F.concat(name, F.lit(".b"), key, F.lit(".c@x.y")))
            .when(k % 23 == 0, F.concat(F.lit("user"), key, F.lit(".")))
            .when(k % 29 == 0, F.concat(F.lit(".doe"), key))
            .otherwise(F.concat(name, F.lit(".customer"), key, F.lit("@x.y")))
        )

    @property
    def users(self) -> DataFrame:
        """Stored silver users."""
        return self.stored("silver_users", lambda: self.typed_users)

    @cached_property
    def typed_users(self) -> DataFrame:
        """Silver users, the columns the marts use."""
        login = text.clean_str(self.login())
        return self.source("customer").select(
            F.col("c_custkey").alias("user_id"),
            login.alias("user_name"),
            people.display_name(login).alias("full_name"),
        )

    @property
    def bronze_users(self) -> DataFrame:
        """Stored bronze users."""
        return self.stored("bronze_users", lambda: self.exported_users)

    @cached_property
    def exported_users(self) -> DataFrame:
        """User export rows, with a second version of every third user."""
        k, version = F.col("c_custkey"), F.col("version")
        day = F.to_timestamp(F.lit("2024-01-01 08:00:00"))
        modified = F.when(k % 9 != 0, _hours_after(day, k % 100 + version))
        raw = {
            "id": F.when(k % 499 == 0, F.lit("null")).otherwise(k.cast("string")),
            "name": self.login(),
            "is_active": (k + version) % 2,
            "is_deleted": F.when(k % 31 == 0, F.lit("null")).otherwise(F.lit("0")),
            "is_deleted_ldap": F.lit("0"),
            "date_creation": _text_ts(day),
            "date_mod": F.coalesce(_text_ts(modified), F.lit("0000-00-00 00:00:00")),
            "last_login": _text_ts(_hours_after(day, k % 500)),
        }
        versions = F.explode(F.sequence(F.lit(0), F.when(k % 3 == 0, 1).otherwise(0)))
        stamps = self._stamps("customer", _hours_after(day, version))
        return (
            self.source("customer")
            .withColumn("version", versions)
            .select(
                *[c.cast("string").alias(n) for n, c in raw.items()],
                *[c.alias(n) for n, c in stamps.items()],
            )
        )

    # --- items <- part ---
    @staticmethod
    def _item_name() -> Column:
        k, name, size = F.col("p_partkey"), F.col("p_name"), F.col("p_size").cast("string")
        kind = k % 6
        return (
            F.when(k % 37 == 0, F.lit(None))
            .when(kind == 0, F.concat(name, F.lit(" (S-"), size, F.lit(")")))
            .when(kind == 1, F.concat(name, F.lit("  (S"), size, F.lit(")")))
            .when(kind == 2, F.concat(F.replace(name, F.lit(" "), F.lit("–")), F.lit(" (s "), size, F.lit(") ")))
            .when(kind == 3, F.concat(F.replace(name, F.lit(" "), F.lit("-")), F.lit(" room")))
            .when(kind == 4, F.concat(F.lit("  "), name))
            .otherwise(F.concat(F.lit("(S"), size, F.lit(")")))
        )

    @property
    def items(self) -> DataFrame:
        """Stored silver items."""
        return self.stored("silver_items", lambda: self.typed_items)

    @cached_property
    def typed_items(self) -> DataFrame:
        """Silver items, the columns the marts use."""
        return self.source("part").select(
            F.col("p_partkey").alias("reservation_item_id"),
            facility.item_label(self._item_name()).alias("reservation_item_name"),
        )

    @property
    def bronze_items(self) -> DataFrame:
        """Stored bronze items."""
        return self.stored("bronze_items", lambda: self.exported_items)

    @cached_property
    def exported_items(self) -> DataFrame:
        """Item export rows, with an older version of every fifth item and some without id."""
        k, version = F.col("p_partkey"), F.col("version")
        older = F.concat(F.lit("old "), F.col("p_name"))
        raw = {
            "id": F.when(k % 211 != 0, k.cast("string")),
            "items_id": F.when(version == 1, older).otherwise(self._item_name()),
            "entities_id": F.lit("0"),
            "itemtype": F.col("p_type"),
            "comment": F.lit(None),
            "is_active": k % 2,
            "is_deleted": F.when(k % 43 != 0, F.lit(0)),
            "is_recursive": k % 3,
        }
        versions = F.explode(F.sequence(F.lit(0), F.when(k % 5 == 0, 1).otherwise(0)))
        day = F.to_timestamp(F.lit("2024-01-31 06:00:00"))
        stamps = self._stamps("part", _hours_after(day, -version))
        return (
            self.source("part")
            .withColumn("version", versions)
            .select(
                *[c.cast("string").alias(n) for n, c in raw.items()],
                *[c.alias(n) for n, c in stamps.items()],
            )
        )

    # --- reservations <- lineitem ---
    def _reservation_times(self) -> tuple[Column, Column]:
        part = F.col("l_partkey")
        opened = _minutes_after(
            F.col("l_shipdate").cast("timestamp"), F.col("l_orderkey") % 24 * 60 + part % 60
        )
        ends = _minutes_after(opened, (F.col("l_quantity").cast("int") - 5) * 30)
        return F.when(part % 89 != 0, opened), F.when(part % 83 != 0, ends)

    def _reservation_ids(self) -> dict[str, Column]:
        part, line = F.col("l_partkey"), F.col("l_linenumber")
        return {
            "reservation_id": F.col("l_orderkey") * 10 + line,
            "user_id": F.when(part % 101 != 0, F.col("l_suppkey")),
            "reservation_item_id": F.when(part % 103 != 0, part + 1),
            "group_id": F.when(line % 2 == 0, line.cast("bigint")),
        }

    def _reservation_bronze_ts(self) -> Column:
        return F.timestamp_add("SECOND", F.col("l_partkey"), F.col("l_shipdate").cast("timestamp"))

    @staticmethod
    def _comment() -> Column:
        return F.when(F.col("l_returnflag") == "N", F.lit("  ")).otherwise(
            F.concat(F.lit(" "), F.col("l_returnflag"), F.col("l_linestatus"))
        )

    def _read_reservations(self) -> DataFrame:
        """What the reservation rows hold of their own."""
        start, end = self._reservation_times()
        columns = {
            **self._reservation_ids(),
            "start_ts": start,
            "end_ts": end,
            "comment": text.clean_str(self._comment()),
            "_ingest_bronze_ts": self._reservation_bronze_ts(),
        }
        return self.source("lineitem").select(*[c.alias(n) for n, c in columns.items()])

    def _as_silver(self, rows: DataFrame) -> DataFrame:
        """With the columns that follow from the others or are the same in every row."""
        start, end = F.col("start_ts"), F.col("end_ts")
        derived = {
            "duration_hours": when_.hours_between(start, end),
            "is_invalid_duration": when_.is_reversed(start, end),
            **self._stamps("lineitem", F.col("_ingest_bronze_ts")),
            "_ingest_silver_ts": self.run_ts,
        }
        return conform(rows.withColumns(derived), silver_schema("reservations"))

    @cached_property
    def reservation_versions(self) -> DataFrame:
        """Typed reservation rows, several per id."""
        return self._as_silver(self._read_reservations())

    @property
    def reservations(self) -> DataFrame:
        """Stored silver reservations."""
        return self.stored("silver_reservations", lambda: self.typed_reservations)

    @cached_property
    def typed_reservations(self) -> DataFrame:
        """Silver reservations: the newest row per id, which alone gets its further columns."""
        newest = latest_per_key(
            self._read_reservations(),
            ["reservation_id"],
            ["_ingest_bronze_ts"],
            ["start_ts", "end_ts", "user_id", "reservation_item_id"],
        )
        return self._as_silver(newest)

    @property
    def bronze_reservations(self) -> DataFrame:
        """Stored bronze reservations."""
        return self.stored("bronze_reservations", lambda: self.exported_reservations)

    @cached_property
    def exported_reservations(self) -> DataFrame:
        """Reservation export rows, some without a readable id."""
        ids = self._reservation_ids()
        start, end = self._reservation_times()
        raw = {
            "id": F.when(ids["reservation_id"] % 97 != 0, ids["reservation_id"]),
            "users_id": ids["user_id"],
            "reservationitems_id": ids["reservation_item_id"],
            "group": ids["group_id"],
            "begin": _text_ts(start),
            "end": _text_ts(end),
            "comment": self._comment(),
        }
        stamps = self._stamps("lineitem", self._reservation_bronze_ts())
        return self.source("lineitem").select(
            *[c.cast("string").alias(n) for n, c in raw.items()],
            *[c.alias(n) for n, c in stamps.items()],
        )

    # --- rooms <- part ---
    @cached_property
    def room_sheet(self) -> DataFrame:
        """The facility sheet: text cells under its raw headers."""
        k, size = F.col("p_partkey"), F.col("p_size")
        n = size.cast("string")
        pick = lambda options: F.element_at(F.array(*[F.lit(o) for o in options]), (k % len(options) + 1).cast("int"))
        cells = [
            F.when(k % 53 == 0, F.lit("-")).otherwise(F.concat(F.lit(" "), F.col("p_brand"), F.lit(" "))),
            F.when(k % 5 == 4, F.col("p_type")).when(k % 59 == 0, F.lit(None)).otherwise(
                pick(["1èr étage", "2ème", "9ème Étage", "RDC Nord", "x"])
            ),
            F.when(k % 41 == 0, F.lit(None))
            .when(k % 7 < 3, F.concat(F.lit("Salle 2"), F.lpad(n, 2, "0")))
            .when(k % 7 == 3, F.concat(F.lit("Open Space "), n, F.lit("b")))
            .when(k % 7 == 4, F.lit("La Grande terrasse "))
            .when(k % 7 == 5, F.lit("tesrrasse C"))
            .otherwise(F.concat(F.lit("Bureau "), F.col("p_name"))),
            pick(["Loué", "Non loué", "Réservation", "Par personne", "-", " LOUÉ "]),
            F.when(k % 8 == 0, F.lit("-")).otherwise(F.col("p_name")),
            F.when(k % 6 == 0, F.lit("CoStorage, Nord")).when(k % 6 == 1, F.lit("")).when(
                k % 6 == 2, F.lit("-")
            ).otherwise(F.col("p_type")),
            F.when(k % 4 == 0, F.lit("-")).otherwise(F.col("p_type")),
            F.when(k % 9 == 0, F.lit(None)).otherwise(F.concat(F.lit('says "'), F.col("p_name"), F.lit('",\nthen'))),
            F.when(k % 11 == 0, F.lit(None)).when(k % 29 == 0, F.lit("-")).when(
                k % 13 == 0, F.concat((k % 60).cast("string"), F.lit(",5"))
            ).otherwise((k % 60).cast("string")),
            F.when(k % 31 == 0, F.lit("0")).when(k % 17 == 0, F.lit(None)).otherwise(n),
            F.when(k % 43 == 0, F.lit("0")).when(k % 47 == 0, F.lit(None)).otherwise(
                F.replace(F.col("p_retailprice").cast("string"), F.lit("."), F.lit(","))
            ),
        ]
        return self.source("part").select(
            *[c.alias(h) for c, h in zip(cells, RAW_ROOM_HEADERS)]
        )

    @property
    def bronze_rooms(self) -> DataFrame:
        """Stored bronze rooms."""
        return self.stored("bronze_rooms", lambda: self.exported_rooms)

    @cached_property
    def exported_rooms(self) -> DataFrame:
        """The sheet under its cleaned column names, with lineage."""
        return self.room_sheet.toDF(*clean_names(RAW_ROOM_HEADERS)).withColumns(
            {
                "_source_file": F.lit("part"),
                "_source_system": F.lit("drive_csv"),
                "_entity": F.lit("space_repartition"),
                "_ingest_ts": self.run_ts,
                "_ingestion_date": F.lit(SNAPSHOT_DAY).cast("date"),
            }
        )

    @property
    def rooms(self) -> DataFrame:
        """Stored silver rooms."""
        return self.stored("silver_rooms", lambda: self.typed_rooms)

    @cached_property
    def typed_rooms(self) -> DataFrame:
        """Silver rooms."""
        return silver.rooms(self.bronze_rooms, self.run_ts)

    # --- daily exports <- events ---
    @cached_property
    def event_days(self) -> DataFrame:
        """Events with the day they were exported."""
        return self.source("events").withColumn("ingestion_date", F.to_date("ts"))
