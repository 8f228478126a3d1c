"""Small silver tables for the mart tests; the expected rows in the tests are worked out by hand."""

from pyspark.sql import functions as F

from opsmart.contracts import silver_schema

USERS = [
    (1, "john.doe@x.y", "DOE John"),
    (2, "admin", "Admin"),
    (3, None, None),
]
ITEMS = [(10, "Salle COSY - Salle 4"), (11, "Studio")]

# id, category, location, requester, updater, created, solved, closed, status, priority, type
TICKETS = [
    (1, 1, 1, 1, 2, "2024-01-01 08:00:00", "2024-01-01 09:30:00", None, 5, 6, 1),
    (2, 1, 5, 1, 2, "2024-01-31 23:59:59", None, "2024-02-01 23:59:59", 6, 5, 2),
    (3, 0, 0, 2, 1, "2024-02-10 10:00:00", None, None, 1, 5, 1),
    (4, 20, 27, 9, None, "2024-02-11 10:00:00", "2024-02-11 09:00:00", None, 5, 1, 1),
    (5, None, None, None, 2, None, "2024-02-11 09:00:00", None, 2, 2, 2),
]

# id, user, item, start, end
RESERVATIONS = [
    (1, 1, 10, "2024-01-01 09:00:00", "2024-01-01 09:30:00"),
    (2, 1, 10, "2024-01-01 22:30:00", "2024-01-02 06:30:00"),
    (3, 2, 11, "2024-02-01 23:59:00", "2024-02-02 00:59:00"),
    (4, 3, 99, "2024-02-03 09:10:00", "2024-02-03 08:10:00"),
    (5, None, None, None, "2024-02-03 08:10:00"),
    (6, 2, 10, "2024-02-04 09:00:00", "2024-02-04 11:00:00"),
]

# site, floor, room, status, org type, space type, people, seats, area
ROOMS = [
    ("site a", "rdc", "salle 01", "loué", "society", "bureau", 5, 10, 50.0),
    ("site a", "rdc", "salle 01", "loué", "society", "bureau", 4, 10, 50.0),
    ("site a", None, "salle 02", "non loué", "n/a", "bureau", None, 4, None),
    ("site a", "rdc", "salle 03", "réservation", "society", "réservation", 3, 2, 20.0),
    ("site b", "rdc", "terrasse", "par personne", "n/a", "terrasse", 7, 0, 0.0),
    ("site b", "rdc", "accueil", "loué", "costorage", "bureau", 8, None, 80.5),
]


def _fill(spark, table, rows, names, **fixed):
    """Rows under the given names, the other columns of the silver table as given or NULL."""
    schema = silver_schema(table)
    types = {f.name: f.dataType for f in schema}
    raw = ", ".join(
        f"{n} {'string' if types[n].simpleString() == 'timestamp' else types[n].simpleString()}" for n in names
    )
    df = spark.createDataFrame(rows, raw)
    columns = []
    for name, kind in types.items():
        source = F.col(name) if name in names else F.lit(fixed.get(name))
        columns.append(source.cast(kind).alias(name))
    return df.select(*columns)


def users(spark):
    return _fill(spark, "users", USERS, ["user_id", "user_name", "full_name"])


def items(spark):
    return _fill(spark, "reserveditems", ITEMS, ["reservation_item_id", "reservation_item_name"])


def tickets(spark):
    names = ["ticket_id", "category_id", "location_id", "requester_user_id", "last_updater_user_id",
             "created_ts", "solved_ts", "closed_ts", "status_code", "priority_code", "type_code"]
    return _fill(spark, "tickets", TICKETS, names, is_deleted=0, title="t", request_type_id=1)


def reservations(spark):
    names = ["reservation_id", "user_id", "reservation_item_id", "start_ts", "end_ts"]
    df = _fill(spark, "reservations", RESERVATIONS, names, ingestion_date="2024-02-05")
    seconds = F.unix_timestamp("end_ts") - F.unix_timestamp("start_ts")
    return df.withColumns(
        {
            "is_invalid_duration": F.coalesce(seconds < 0, F.lit(False)),
            "duration_hours": F.when(seconds >= 0, seconds / 3600.0).cast("double"),
        }
    )


def rooms(spark):
    names = ["site", "floor", "room", "occupancy_status", "organization_type", "space_type",
             "employee_count", "total_capacity", "area_m2"]
    fixed = {"_ingestion_date": "2024-02-05", "_silver_ts": "2024-02-05 00:00:00", "activity": "n/a"}
    return _fill(spark, "space_repartition", ROOMS, names, **fixed)
