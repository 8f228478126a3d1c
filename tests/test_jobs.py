"""The batch jobs from landing files to gold tables."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from opsmart.contracts import SERVING, serving_tables, silver_schema
from opsmart.plans import jobs
from opsmart.sources import lake, publish

DAY, NEXT = "2024-01-30", "2024-01-31"
EXPORTS = {
    "users": [
        {"id": "1", "name": " john.doe@x.y ", "is_active": 1, "date_mod": "2024-01-01 00:00:00"},
        {"id": "1", "name": "john.doe2@x.y", "is_active": 0, "date_mod": "2024-01-02 00:00:00"},
        {"id": "2", "name": "admin", "date_mod": None},
        {"id": "null", "name": ""},
    ],
    "tickets": [
        {"id": 1, "name": " t1 ", "date_creation": "2024-01-01 08:00:00", "solvedate": "2024-01-01 10:00:00",
         "status": " 5 ", "priority": "6", "type": 1, "itilcategories_id": 1, "locations_id": 14,
         "users_id_recipient": 1, "users_id_lastupdater": 2, "is_deleted": "0", "date_mod": "2024-01-01 10:00:00"},
        {"id": 1, "name": "older", "date_mod": "2023-12-31 10:00:00"},
        {"id": 2, "name": "", "date_creation": "0000-00-00 00:00:00", "status": "null", "priority": "2,5",
         "type": "abc", "users_id_recipient": 7},
    ],
    "reservations": [
        {"id": 1, "users_id": 1, "reservationitems_id": 10, "begin": "2024-01-01 23:00:00", "end": "2024-01-02 01:00:00", "comment": " "},
        {"id": 2, "users_id": 2, "reservationitems_id": 10, "begin": "2024-01-01 09:00:00", "end": "2024-01-01 08:00:00", "comment": "x"},
        {"id": 3, "group": 4, "begin": None, "end": "2024-01-01 08:00:00"},
    ],
    "reserveditems": [
        {"id": 10, "items_id": "Salle COSY (S-4)", "is_active": 1, "is_deleted": 0},
        {"id": None, "items_id": "dropped"},
    ],
    "computers": [{"id": 1, "name": "pc"}],
}
SHEET = (
    "Viilage,Étage,Salle,État,Nom de l'organisation,Type de l'organisation,Type de l'espace,"
    "Activité,Nb employés,Capacité totale,Surface m²\n"
    '"Lac, Nord",RDC,Salle 201,Loué,"Org ""A""",CoStorage x,-,-,"9,5",10,"50,5"\n'
    "Lac,1èr étage,,Loué,,,,,1,1,1\n"
)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """Every entity ingested, cleaned and turned into gold."""
    root = str(tmp_path_factory.mktemp("lake"))
    roots = {n: f"{root}/{n}" for n in ("landing", "bronze", "silver", "gold")}
    stamp = F.lit("2024-02-01 00:00:00").cast("timestamp")
    for entity, rows in EXPORTS.items():
        for day, part in ((DAY, rows[:1]), (NEXT, rows)):
            folder = Path(roots["landing"]) / entity / f"ingestion_date={day}"
            folder.mkdir(parents=True)
            lines = "\n".join(json.dumps(r) for r in part)
            (folder / "export.json").write_text(lines, encoding="utf-8")
    folder = Path(roots["landing"]) / "space_repartition" / f"ingestion_date={NEXT}"
    folder.mkdir(parents=True)
    (folder / "sheet.csv").write_text(SHEET, encoding="utf-8")

    entities = [*EXPORTS, "space_repartition"]
    loaded = {e: jobs.ingest(spark, e, roots["landing"], roots["bronze"], stamp) for e in entities}
    audits = {
        e: jobs.build_silver(spark, e, roots["bronze"], roots["silver"], stamp)
        for e in entities
        if e != "computers"
    }
    jobs.build_dimensions(spark, roots["silver"], site="Lac")
    for domain in SERVING:
        jobs.build_gold(spark, domain, roots["silver"], roots["gold"], stamp)
    return roots, loaded, audits


def table(spark, built, layer, name):
    return lake.read_table(spark, f"{built[0][layer]}/{name}")


def test_ingest_counts(built):
    assert built[1]["tickets"] == {"dates": [DAY, NEXT], "rows": 4}
    assert built[1]["computers"]["rows"] == 2
    assert built[1]["space_repartition"] == {"dates": [NEXT], "rows": 2}


def test_silver_audit(built):
    assert {e: a["rows"] for e, a in built[2].items()} == {
        "users": 3, "tickets": 2, "reservations": 3, "reserveditems": 1, "space_repartition": 1,
    }


def test_silver_schemas(spark, built):
    for entity in built[2]:
        have = table(spark, built, "silver", entity).schema
        assert [(f.name, f.dataType) for f in have] == [
            (f.name, f.dataType) for f in silver_schema(entity)
        ]


def test_silver_users(spark, built):
    out = table(spark, built, "silver", "users").orderBy("user_id").collect()
    assert [(r.user_id, r.user_name, r.first_name, r.last_name, r.full_name, r.is_active) for r in out] == [
        (None, None, None, None, None, None),
        (1, "john.doe2@x.y", "john", "doe2", "DOE2 John", 0),
        (2, "admin", "admin", None, "Admin", None),
    ]


def test_silver_keeps_every_row_without_a_readable_id(spark):
    from opsmart.plans import silver

    fields = "id name is_active is_deleted is_deleted_ldap date_creation date_mod last_login".split()
    ids = ["0.0", "1.0", "1", "x", "y", "y", None]
    stamps = ["2024-01-01", "file", "glpi", "2024-01-02 00:00:00"]
    rows = [(i, "n", *[None] * 6, *stamps) for i in ids]
    names = [*fields, "ingestion_date", "_source_file", "_source_system", "_ingest_bronze_ts"]
    bronze = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    bronze = bronze.withColumn("_ingest_bronze_ts", F.col("_ingest_bronze_ts").cast("timestamp"))
    out = [r.user_id for r in silver.users(bronze).collect()]
    assert sorted(out, key=lambda v: -1 if v is None else v) == [None] * 4 + [0, 1]


def test_silver_tickets(spark, built):
    one, two = table(spark, built, "silver", "tickets").orderBy("ticket_id").collect()
    assert (one.title, one.status_code, one.priority_code, one.is_deleted) == ("t1", 5, 6, 0)
    assert (two.title, two.created_ts, two.status_code, two.priority_code, two.type_code) == (None, None, None, 2, None)
    assert str(one.ingestion_date) == NEXT


def test_silver_rooms(spark, built):
    room = table(spark, built, "silver", "space_repartition").first()
    assert (room.site, room.floor, room.room, room.organization_name, room.organization_type) == (
        "lac, nord", "rez de chaussée", "salle 01", 'org "a"', "costorage",
    )
    assert (room.space_type, room.activity, room.employee_count, room.area_m2, room.occupancy_rate_pct) == (
        "loué", "n/a", 9, 50.5, 90.0,
    )


def test_gold_tables_meet_their_contracts(spark, built):
    for name, path in jobs.gold_paths(built[0]["gold"]).items():
        gold = lake.read_table(spark, path)
        frame = publish.publish_frame(gold, name)
        assert frame.count() == gold.count() > 0, name
    assert len(serving_tables()) == 24


def test_gold_tickets(spark, built):
    one = table(spark, built, "gold", "tickets/tickets_enriched").where("ticket_id = 1").first()
    assert (one.location, one.requester_full_name, one.last_updater_login, one.time_to_solve_hours) == (
        "Salle COSY", "DOE2 John", "admin", 2.0,
    )
    cards = table(spark, built, "gold", "tickets/tickets_cards")
    assert {r.period: r.total_tickets for r in cards.collect()} == {"ALL": 2, "2024-01": 1, None: 1}


def test_gold_reservations(spark, built):
    cards = table(spark, built, "gold", "reservations/reservations_kpi_cards_current").first()
    assert (cards.total_reservations, cards.reserved_hours, cards.invalid_duration_count) == (3, 2.0, 1)
    item = table(spark, built, "gold", "reservations/reservations_kpi_by_item_current")
    assert item.where("reservation_item_id = 10").first().reservation_item_name == "Salle COSY - Salle 4"


def test_fact_layout_lets_filters_skip_data(spark, built):
    fact = table(spark, built, "gold", "reservations/reservations_enriched_current")
    plan = fact.where("start_month = '2024-01'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(start_month,2024-01)" in plan
    assert fact.columns[0] == "reservation_id" and fact.count() == 3


def test_running_again_changes_nothing(spark, built):
    roots = built[0]
    assert jobs.ingest(spark, "tickets", roots["landing"], roots["bronze"]) == {"dates": [], "rows": 0}
    before = table(spark, built, "silver", "tickets").drop("_ingest_silver_ts").collect()
    jobs.build_silver(spark, "tickets", roots["bronze"], roots["silver"])
    after = table(spark, built, "silver", "tickets").drop("_ingest_silver_ts").collect()
    assert sorted(before) == sorted(after)
