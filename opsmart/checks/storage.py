"""Sources and sinks (IO), batch jobs (JB) and the streamed ingest.

Each query writes what it needs, derived from the supplied tables, into a fresh folder under the
cluster's shared directory and reads it back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsmart.checks.bindings import SNAPSHOT_DAY, Tables
from opsmart.checks.marts import dimension_usage, gold
from opsmart.checks.prelude import BUILT, STAMP, rollup
from opsmart.checks.registry import check
from opsmart.contracts import FACT_TABLES, SERVING, SERVING_KEYS, serving_tables
from opsmart.functions import numbers
from opsmart.operators.audit import key_report, observed
from opsmart.plans import dims, incremental, jobs
from opsmart.sources import lake, landing, publish
from opsmart.streaming.landing_stream import ingest_available

EVENT_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in "event_id ts user_id event_type value props".split()]
)
DAY_BEFORE = "2024-01-30"


def _export_events(t: Tables, events: DataFrame | None = None) -> str:
    """Events as JSON-lines day folders; returns the landing folder."""
    root = f"{t.scratch('landing')}/events"
    (t.event_days if events is None else events).write.partitionBy(lake.INGESTION_DATE).json(root)
    return root


def _typed_events(df: DataFrame, *more: str) -> DataFrame:
    return df.select(
        numbers.to_long(F.col("event_id")).alias("event_id"),
        numbers.to_long(F.col("user_id")).alias("user_id"),
        "event_type",
        numbers.to_double(F.col("value")).alias("value"),
        "props",
        "ingestion_date",
        *more,
    )


def _export_csv(df: DataFrame, folder: str) -> None:
    df.write.options(
        header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(folder)


_EVENTS = "SELECT event_id, user_id, event_type, value, props, ingestion_date FROM ev"


@check("io_01_json_scan", _EVENTS)
def _(t):
    root = _export_events(t)
    folders = [f"{root}/{lake.INGESTION_DATE}={d}" for d in lake.partition_dates(t.spark, root)]
    return _typed_events(landing.read_json_day(t.spark, folders, EVENT_SCHEMA, root))


@check("io_02_csv_scan", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source FROM documents")
def _(t):
    folder = t.scratch("csv")
    _export_csv(t.source("documents").select("doc_id", "text", "lang", "source"), folder)
    return landing.read_csv(t.spark, folder)


@check("io_03_table_scan", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'")
def _(t):
    orders = lake.read_table(t.spark, f"{t.sf_dir}/orders.parquet")
    recent = orders.where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    return recent.select("o_orderkey", "o_orderstatus")


_NEWEST = """SELECT event_id, event_type, value, ingestion_date FROM ev
    WHERE ingestion_date = (SELECT max(ingestion_date) FROM ev)"""


def _event_table(t: Tables) -> str:
    root = t.scratch("events")
    lake.replace_partitions(t.event_days, root)
    return root


@check("io_04_latest_by_listing", _NEWEST)
def _(t):
    rows = lake.read_latest(t.spark, _event_table(t))
    return rows.select("event_id", "event_type", "value", "ingestion_date")


@check("io_05_latest_by_max", _NEWEST)
def _(t):
    rows = lake.latest_partition(lake.read_table(t.spark, _event_table(t)))
    return rows.select("event_id", "event_type", "value", "ingestion_date")


def _dates(t: Tables, dates: list[str]) -> DataFrame:
    text = t.spark.createDataFrame([(d,) for d in dates], "day string")
    return text.select(F.col("day").cast("date"))


@check("io_06_partition_dates", "SELECT DISTINCT ingestion_date AS day FROM ev")
def _(t):
    return _dates(t, lake.partition_dates(t.spark, _event_table(t)))


@check("io_07_missing_dates", """SELECT DISTINCT ingestion_date AS day FROM ev
    EXCEPT SELECT ingestion_date FROM ev WHERE event_type = 'error' AND value > 200""")
def _(t):
    bronze = t.scratch("bronze")
    lake.replace_partitions(t.event_days.where("event_type = 'error' AND value > 200"), bronze)
    return _dates(t, lake.missing_dates(t.spark, _event_table(t), bronze))


@check("io_08_skip_empty_days", "SELECT ingestion_date, count(*) AS rows FROM ev GROUP BY 1")
def _(t):
    root = _export_events(t)
    path = t.spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(t.spark._jsc.hadoopConfiguration())
    for extra in (f"{lake.INGESTION_DATE}=2030-01-01", "not_a_day"):
        fs.mkdirs(path(f"{root}/{extra}"))
    bronze = t.scratch("bronze")
    landing.ingest_json(t.spark, root, bronze, EVENT_SCHEMA, t.run_ts)
    return lake.read_table(t.spark, bronze).groupBy("ingestion_date").agg(F.count(F.lit(1)).alias("rows"))


@check("io_09_partition_overwrite", """SELECT ingestion_date, count(*) AS rows FROM ev
    WHERE ingestion_date <> DATE '2024-01-10' OR event_type = 'click' GROUP BY 1""")
def _(t):
    root = _event_table(t)
    again = t.event_days.where("ingestion_date = DATE '2024-01-10' AND event_type = 'click'")
    lake.replace_partitions(again, root)
    return lake.read_table(t.spark, root).groupBy("ingestion_date").agg(F.count(F.lit(1)).alias("rows"))


@check("io_10_snapshot_overwrite", "SELECT c_custkey AS user_id, c_mktsegment AS segment FROM customer")
def _(t):
    path = t.scratch("snapshot")
    lake.replace_snapshot(t.source("customer"), path)
    renamed = t.source("customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment")
    )
    lake.replace_snapshot(renamed, path)
    return lake.read_table(t.spark, path)


@check("io_11_code_tables", """SELECT ticket_id, status, priority, type, category, location FROM te""")
def _(t):
    from opsmart.operators.lookup import attach_codes
    from opsmart.plans.gold_tickets import CODE_OF

    out = t.tickets.select("ticket_id", *CODE_OF.values())
    for table, key in CODE_OF.items():
        out = attach_codes(out, t.codes[table], key)
    return out.select("ticket_id", "status", "priority", "type", "category", "location")


@check("io_12_lineage", """SELECT CAST(ingestion_date AS VARCHAR) AS source_day, 'glpi' AS _source_system,
    TIMESTAMP '2024-02-01 00:00:00' AS _ingest_bronze_ts, ingestion_date, count(*) AS rows FROM ev GROUP BY ingestion_date""")
def _(t):
    root = _export_events(t)
    folders = [f"{root}/{lake.INGESTION_DATE}={d}" for d in lake.partition_dates(t.spark, root)]
    scan = landing.read_json_day(t.spark, folders, EVENT_SCHEMA, root)
    rows = landing.with_lineage(scan, landing.JSON_SYSTEM, t.run_ts, "_ingest_bronze_ts")
    day = F.regexp_extract("_source_file", r"ingestion_date=([0-9-]+)/", 1).alias("source_day")
    keys = [day, "_source_system", "_ingest_bronze_ts", "ingestion_date"]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))


@check("io_14_publish_projection", """SELECT room_nk, site, floor, room, occupancy_status, organization_name, organization_type,
    space_type, activity, employee_count, total_capacity, area_m2, occupancy_rate_pct, density_emp_per_100m2,
    is_over_capacity, _ingestion_date, TIMESTAMP '2024-02-01 00:00:00' AS last_updated_ts FROM rc""")
def _(t):
    return publish.publish_frame(gold(t, "space_room_current"), "space_room_current")


@check("io_15_publish_coercion", """SELECT * REPLACE (is_open = 1 AS is_open, is_deleted = 1 AS is_deleted,
    CAST(status_code AS BIGINT) AS status_code, CAST(priority_code AS BIGINT) AS priority_code,
    CAST(type_code AS BIGINT) AS type_code) FROM te""")
def _(t):
    return publish.publish_frame(gold(t, "tickets_enriched"), "tickets_enriched")


@check("io_16_write_parallelism", "SELECT count(*) AS rows, TRUE AS within_limit FROM te")
def _(t):
    path = t.scratch("fact")
    frame = publish.publish_frame(gold(t, "tickets_enriched"), "tickets_enriched")
    lake.replace_snapshot(frame.coalesce(publish.FACT_PARTITIONS), path)
    files = F.countDistinct("_metadata.file_name") <= publish.FACT_PARTITIONS
    return lake.read_table(t.spark, path).agg(F.count(F.lit(1)).alias("rows"), files.alias("within_limit"))


# A CSV cell cannot tell an empty text from a missing one: both read as NULL.
_SHEET = "* REPLACE (nullif(type_de_lorganisation, '') AS type_de_lorganisation)"


@check("io_17_header_names", f"SELECT {_SHEET} FROM rmb")
def _(t):
    folder = t.scratch("sheet")
    _export_csv(t.room_sheet, folder)
    return landing.read_csv(t.spark, folder)


@check("io_18_audit", """SELECT count(*) AS rows_written, count(*) FILTER (WHERE is_invalid_duration) AS invalid_rows,
    count(*) AS rows_read_back FROM rs""")
def _(t):
    path = t.scratch("silver")
    invalid = F.count_if(F.col("is_invalid_duration"))
    out, audit = observed(t.typed_reservations, "audit", invalid=invalid)
    lake.replace_snapshot(out, path)
    back = lake.read_table(t.spark, path).agg(F.count(F.lit(1)).alias("rows_read_back"))
    return back.select(
        F.lit(audit.get["rows"]).cast("bigint").alias("rows_written"),
        F.lit(audit.get["invalid"]).cast("bigint").alias("invalid_rows"),
        "rows_read_back",
    )


@check("io_19_preview", "SELECT count(*) AS rows FROM (SELECT * FROM tk LIMIT 10)")
def _(t):
    return lake.preview(t.tickets).agg(F.count(F.lit(1)).alias("rows"))


@check("io_20_contract_keys", """SELECT 'space_room_current' AS table_name, count(*) AS rows, count(DISTINCT room_nk) AS distinct_keys, CAST(0 AS BIGINT) AS surplus_rows FROM rc
    UNION ALL SELECT 'space_kpi_by_site_current', count(*), count(*), 0 FROM s_site
    UNION ALL SELECT 'space_kpi_by_site_space_type_current', count(*), count(*), 0 FROM s_space_type
    UNION ALL SELECT 'space_kpi_by_site_org_type_current', count(*), count(*), 0 FROM s_org_type""")
def _(t):
    reports = [
        key_report(publish.publish_frame(gold(t, table), table), *keys).withColumn("table_name", F.lit(table))
        for table, keys in SERVING_KEYS.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), reports)


def _store_silver(t: Tables, *names: str) -> str:
    """Silver tables of the bindings, stored; returns the silver root."""
    root = t.scratch("silver")
    frames = {
        "space_repartition": lambda: t.typed_rooms,
        "reservations": lambda: t.typed_reservations,
        "reserveditems": lambda: t.typed_items,
        "users": lambda: t.typed_users,
        "tickets": lambda: t.typed_tickets,
    }
    for name in names:
        lake.replace_snapshot(frames[name](), f"{root}/{name}")
    return root


@check("io_21_catalogue", """SELECT s.site, s.total_spaces, g.total_spaces AS all_spaces FROM s_site s, s_global g""")
def _(t):
    gold_root = t.scratch("gold")
    jobs.build_gold(t.spark, "space", _store_silver(t, "space_repartition"), gold_root, t.run_ts)
    paths = {n: p for n, p in jobs.gold_paths(gold_root).items() if serving_tables()[n] == "space"}
    lake.register_catalogue(t.spark, paths)
    return t.spark.sql(
        """SELECT s.site, s.total_spaces,
             (SELECT total_spaces FROM space_kpi_global_current) AS all_spaces
           FROM space_kpi_by_site_current s"""
    )


# --- jobs ---
@check("jb_1_ingest_json", f"""SELECT event_id, user_id, event_type, value, props, ingestion_date, 'glpi' AS _source_system,
    TIMESTAMP '{STAMP[:19]}' AS _ingest_bronze_ts FROM ev""")
def _(t):
    root, bronze = _export_events(t), t.scratch("bronze")
    for _run in range(2):  # the second run finds nothing missing
        landing.ingest_json(t.spark, root, bronze, EVENT_SCHEMA, t.run_ts)
    return _typed_events(lake.read_table(t.spark, bronze), "_source_system", "_ingest_bronze_ts")


@check("jb_1_ingest_csv", f"""SELECT rmb.{_SHEET}, 'drive_csv' AS _source_system, 'space_repartition' AS _entity,
    TIMESTAMP '{STAMP[:19]}' AS _ingest_ts, _ingestion_date FROM rmb, (VALUES (DATE '{DAY_BEFORE}'), (DATE '{SNAPSHOT_DAY}')) d(_ingestion_date)""")
def _(t):
    root, bronze = t.scratch("landing"), t.scratch("bronze")
    days = f"{root}/space_repartition/{lake.INGESTION_DATE}="
    _export_csv(t.room_sheet, f"{days}{DAY_BEFORE}")
    _export_csv(t.room_sheet.select(*reversed(t.room_sheet.columns)), f"{days}{SNAPSHOT_DAY}")
    jobs.ingest(t.spark, "space_repartition", root, bronze, t.run_ts)
    return lake.read_table(t.spark, f"{bronze}/space_repartition").drop("_source_file")


@check("jb_2_build_silver", """SELECT ticket_id, title, created_ts, updated_ts, solved_ts, closed_ts, status_code, priority_code,
    type_code, category_id, location_id, requester_user_id, last_updater_user_id, ingestion_date FROM tks""")
def _(t):
    root, bronze, silver_root = t.scratch("landing"), t.scratch("bronze"), t.scratch("silver")
    export = t.exported_tickets.drop("ingestion_date", "_source_file", "_source_system", "_ingest_bronze_ts")
    for day, rows in ((DAY_BEFORE, export.where("status = 'abc'")), (SNAPSHOT_DAY, export)):
        rows.write.json(f"{root}/tickets/{lake.INGESTION_DATE}={day}")
    jobs.ingest(t.spark, "tickets", root, bronze, t.run_ts)
    jobs.build_silver(t.spark, "tickets", bronze, silver_root, t.run_ts)
    return lake.read_table(t.spark, f"{silver_root}/tickets").select(
        "ticket_id", "title", "created_ts", "updated_ts", "solved_ts", "closed_ts", "status_code",
        "priority_code", "type_code", "category_id", "location_id", "requester_user_id",
        "last_updater_user_id", "ingestion_date",
    )


MERGE_DAYS = ("2024-01-29", "2024-01-30", "2024-01-31")


def _merged_days(t: Tables, after_day=lambda silver_root: None) -> str:
    """Three daily exports taken into silver one by one."""
    root, bronze, silver_root = t.scratch("landing"), t.scratch("bronze"), t.scratch("silver")
    for number, day in enumerate(MERGE_DAYS):
        t.ticket_day(number).write.json(f"{root}/tickets/{lake.INGESTION_DATE}={day}")
        jobs.ingest(t.spark, "tickets", root, bronze, t.run_ts)
        incremental.merge_silver(t.spark, "tickets", bronze, silver_root, t.run_ts)
        after_day(silver_root)
    return silver_root


@check("jb_6_merge_silver", """SELECT ticket_id, title, created_ts, updated_ts, solved_ts, closed_ts, status_code, priority_code,
    category_id, location_id, requester_user_id, last_updater_user_id, ingestion_date FROM tkm""")
def _(t):
    return lake.read_table(t.spark, f"{_merged_days(t)}/tickets").select(
        "ticket_id", "title", "created_ts", "updated_ts", "solved_ts", "closed_ts", "status_code", "priority_code",
        "category_id", "location_id", "requester_user_id", "last_updater_user_id", "ingestion_date",
    )


def _mart_rows(name: str, key_1: str = "NULL", key_2: str = "NULL", tickets: str = "ticket_count", figure: str = "NULL"):
    return [
        f"'{name}' AS mart", "period", f"CAST({key_1} AS BIGINT) AS key_1", f"CAST({key_2} AS BIGINT) AS key_2",
        f"CAST({tickets} AS BIGINT) AS tickets", f"CAST({figure} AS DOUBLE) AS figure",
    ]


def _per(keys: str, aggs: str = "count(*) AS ticket_count", null_period: bool = False) -> str:
    return f"({rollup(keys, aggs, null_period, 'tkm')})"


_CARDS = """count(*) AS ticket_count, count(*) FILTER (WHERE solved_ts IS NULL AND closed_ts IS NULL) AS is_open,
    count(DISTINCT last_updater_user_id) AS technicians"""
_SHARED = f"(SELECT *, ticket_count / sum(ticket_count) OVER (PARTITION BY period)::DOUBLE AS share FROM {_per('category_id')})"
#: Serving name -> how its rows are compared, and the SQL table of the same rows.
_PERIOD_MARTS = {
    "tickets_cards": (("cards", "is_open", "technicians", "total_tickets", "open_rate"), None),
    "kpi_status_distribution_period": (("status", "status_code"), _per("status_code")),
    "kpi_priority_distribution_period": (("priority", "priority_code"), _per("priority_code")),
    "kpi_tickets_by_category_period": (("category", "category_id", "NULL", "ticket_count", "share"), _SHARED),
    "kpi_tickets_by_location_period": (("location", "location_id"), _per("location_id")),
    "kpi_tickets_by_requester_period": (("requester", "requester_user_id"), _per("requester_user_id")),
    "kpi_tickets_by_technician_period": (("technician", "last_updater_user_id"), _per("last_updater_user_id")),
    "kpi_load_by_technician_priority_period": (
        ("load", "last_updater_user_id", "priority_code"),
        _per("last_updater_user_id, priority_code"),
    ),
    "kpi_tickets_by_month": (
        ("month",),
        "(SELECT strftime(created_ts, '%Y-%m') AS period, count(*) AS ticket_count FROM tkm WHERE created_ts IS NOT NULL GROUP BY 1)",
    ),
}
_MERGED_SQL = [
    f"SELECT {', '.join(_mart_rows('cards', 'is_open', 'technicians', 'ticket_count', 'is_open / ticket_count::DOUBLE'))} "
    f"FROM {_per('', _CARDS, True)}"
] + [f"SELECT {', '.join(_mart_rows(*how))} FROM {sql}" for how, sql in _PERIOD_MARTS.values() if sql]


@check("jb_7_merge_marts", " UNION ALL ".join(_MERGED_SQL))
def _(t):
    gold_root = t.scratch("gold")

    def refresh(silver_root: str) -> None:
        if lake.current_version(t.spark, f"{silver_root}/users") is None:
            jobs.build_dimensions(t.spark, silver_root)
            lake.replace_snapshot(t.users, f"{silver_root}/users")
        incremental.refresh_ticket_marts(t.spark, silver_root, gold_root, t.run_ts)

    _merged_days(t, refresh)
    marts = [
        lake.read_table(t.spark, f"{gold_root}/tickets/{name}").selectExpr(*_mart_rows(*how))
        for name, (how, _) in _PERIOD_MARTS.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), marts)


_MART_OF = {
    "space_room_current": "rc", "space_kpi_global_current": "s_global", "space_kpi_by_site_current": "s_site",
    "space_kpi_by_site_space_type_current": "s_space_type", "space_kpi_by_site_org_type_current": "s_org_type",
    "reservations_enriched_current": "re", "reservations_kpi_cards_current": "r_cards",
    "reservations_kpi_peak_period_current": "r_peak", "reservations_kpi_trends_by_month": "r_trends",
    "reservations_kpi_by_item_current": "r_item", "reservations_kpi_by_user_current": "r_user",
    "reservations_kpi_duration_distribution_current": "r_duration",
    "tickets_enriched": "te", "kpi_load_by_technician_priority_period": "m_load",
    "kpi_priority_distribution_period": "m_priority", "kpi_status_distribution_period": "m_status",
    "kpi_tickets_by_category_period": "m_category", "kpi_tickets_by_month": "m_month",
    "kpi_tickets_by_requester_period": "m_requester", "kpi_tickets_by_technician_period": "m_technician",
    "kpi_tickets_by_year": "m_year", "kpi_tickets_by_location_period": "m_location", "tickets_cards": "m_cards",
}
_UNTOLD = {"gold_kpi_build_ts", "_as_of_ts", "last_updated_ts"}


def _told(table: str) -> tuple[list[str], list[str]]:
    """Columns of a serving table that name a row, and those that are its figures."""
    contract = SERVING[serving_tables()[table]][table]
    fields = [tuple(f.split()) for f in contract.split(",")]
    names = [n for n, kind in fields if kind == "string" or n.endswith(("_id", "_code", "year"))]
    return names, [n for n, _ in fields if n not in names and n not in _UNTOLD]


def _told_sql(table: str, cte: str) -> str:
    """Every figure of a mart as a row; of a fact, whose rows ``k_r01`` and ``k_t01`` compare, the count."""
    if table in FACT_TABLES or table == "reservations_kpi_invalid_current":
        return f"SELECT '{table}' AS table_name, '' AS row_key, 'rows' AS figure, CAST(count(*) AS DOUBLE) AS value FROM {cte}"
    names, figures = _told(table)
    key = " || '|' || ".join(["''", *[f"coalesce(CAST({n} AS VARCHAR), '∅')" for n in names]])
    values = ", ".join(f"{{'figure': '{n}', 'value': CAST({n} AS DOUBLE)}}" for n in figures)
    return f"""SELECT '{table}' AS table_name, row_key, u.figure AS figure, u.value AS value
        FROM (SELECT {key} AS row_key, unnest([{values}]) AS u FROM {cte})"""


def _told_rows(df: DataFrame, table: str) -> DataFrame:
    name = F.lit(table).alias("table_name")
    if table in FACT_TABLES or table == "reservations_kpi_invalid_current":
        rows = F.count(F.lit(1)).cast("double").alias("value")
        return df.agg(rows).select(name, F.lit("").alias("row_key"), F.lit("rows").alias("figure"), "value")
    names, figures = _told(table)
    parts = [F.coalesce(F.col(n).cast("string"), F.lit("∅")) for n in names]
    key = F.concat_ws("|", F.lit(""), *parts).alias("row_key")
    values = F.array(*[F.struct(F.lit(n).alias("figure"), F.col(n).cast("double").alias("value")) for n in figures])
    return df.select(name, key, F.explode(values).alias("_told")).select("table_name", "row_key", "_told.*")


_TOLD = " UNION ALL ".join(
    _told_sql(table, cte)
    for table, cte in {**_MART_OF, "reservations_kpi_invalid_current": "re WHERE is_invalid_duration"}.items()
)


@check("jb_3_build_gold", _TOLD, BUILT)
def _(t):
    bronze, silver_root, gold_root = t.scratch("bronze"), t.scratch("silver"), t.scratch("gold")
    exports = {
        "users": t.exported_users,
        "tickets": t.exported_tickets,
        "reservations": t.exported_reservations,
        "reserveditems": t.exported_items,
        "space_repartition": t.exported_rooms,
    }
    for entity, rows in exports.items():
        column = landing.CSV_PARTITION if entity in jobs.CSV_ENTITIES else lake.INGESTION_DATE
        lake.replace_partitions(rows, f"{bronze}/{entity}", column)
        jobs.build_silver(t.spark, entity, bronze, silver_root, t.run_ts)
    jobs.build_dimensions(t.spark, silver_root)
    for domain in jobs.SILVER_OF:
        jobs.build_gold(t.spark, domain, silver_root, gold_root, t.run_ts)
    told = [_told_rows(lake.read_table(t.spark, path), name) for name, path in jobs.gold_paths(gold_root).items()]
    return reduce(lambda a, b: a.unionByName(b), told)


@check("jb_4_publish_frames", _TOLD)
def _(t):
    told = [_told_rows(publish.publish_frame(gold(t, n), n), n) for n in serving_tables()]
    return reduce(lambda a, b: a.unionByName(b), told)


@check("jb_5_build_dimensions", """SELECT 'status' AS dim, CAST(status_code AS BIGINT) AS code, status AS label, count(*) AS tickets FROM te GROUP BY 2, 3
    UNION ALL SELECT 'priority', priority_code, priority, count(*) FROM te GROUP BY 2, 3
    UNION ALL SELECT 'type', type_code, type, count(*) FROM te GROUP BY 2, 3
    UNION ALL SELECT 'category', category_id, category, count(*) FROM te GROUP BY 2, 3
    UNION ALL SELECT 'location', location_id, location, count(*) FROM te GROUP BY 2, 3""")
def _(t):
    root = t.scratch("silver")
    jobs.build_dimensions(t.spark, root)
    stored = {name: lake.read_table(t.spark, f"{root}/{name}") for name in dims.code_tables()}
    return dimension_usage(t.tickets, stored)


@check("st_1_ingest_stream", _EVENTS)
def _(t):
    root, bronze = _export_events(t), t.scratch("bronze")
    checkpoint = t.scratch("stream")
    for _run in range(2):  # the second call finds no new file
        ingest_available(t.spark, root, bronze, checkpoint, EVENT_SCHEMA)
    return _typed_events(lake.read_table(t.spark, bronze))




@check("st_2_stream_and_batch", _EVENTS)
def _(t):
    """Half of the days by batch, then a stream over all files, a replay of it, and the batch again."""
    days = t.event_days
    middle = F.median(F.unix_date(lake.INGESTION_DATE)).cast("int")
    early = days.where(F.unix_date(lake.INGESTION_DATE) < days.agg(middle).scalar())
    root, bronze = _export_events(t, early), t.scratch("bronze")
    landing.ingest_json(t.spark, root, bronze, EVENT_SCHEMA, t.run_ts)
    late = days.join(early.select("event_id"), "event_id", "left_anti")
    late.write.mode("append").partitionBy(lake.INGESTION_DATE).json(root)
    for checkpoint in (t.scratch("stream"), t.scratch("stream")):  # the second knows of nothing loaded
        ingest_available(t.spark, root, bronze, checkpoint, EVENT_SCHEMA)
    landing.ingest_json(t.spark, root, bronze, EVENT_SCHEMA, t.run_ts)
    return _typed_events(lake.read_table(t.spark, bronze))
