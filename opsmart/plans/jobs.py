"""The batch jobs a scheduler runs: ingest, silver, gold, publish.

Every job reads stored tables and writes stored tables, so a failed one is simply run again.
Roots are folders on shared storage: ``<landing>/<entity>``, ``<bronze>/<entity>``,
``<silver>/<table>``, ``<gold>/<domain>/<table>``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import closing, contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsmart.contracts import SERVING, landing_schema, serving_tables
from opsmart.operators.audit import observed
from opsmart.operators.layout import along_curve, curve_cell, curve_cuts, even_ranges
from opsmart.plans import dims, gold_reservations, gold_space, gold_tickets, silver
from opsmart.session import pin, settings, shared_dir, shuffles_for, slice_depth, stored_bytes
from opsmart.sources import lake, landing, publish

CSV_ENTITIES = ("space_repartition",)
#: Without it the shuffle files of a job stay on disk until the driver collects its garbage.
_NO_LEFTOVERS = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
ROOM_MART = "space_room_current"


def ingest(
    spark: SparkSession,
    entity: str,
    landing_root: str,
    bronze_root: str,
    run_ts: Column | None = None,
    verify: bool = False,
) -> dict[str, object]:
    """Landing to bronze: load the days bronze lacks; nothing to do is not an error. ``verify`` lists
    the files of every day and loads those again that have lost one."""
    pin(spark)
    src, dst = f"{landing_root}/{entity}", f"{bronze_root}/{entity}"
    if entity in CSV_ENTITIES:
        return landing.ingest_csv(spark, src, dst, entity, run_ts, verify)
    return landing.ingest_json(spark, src, dst, landing_schema(entity), run_ts, verify)


def build_dimensions(spark: SparkSession, silver_root: str, site: str = dims.DEFAULT_SITE) -> None:
    """Write the literal code tables."""
    pin(spark)
    dims.write_code_tables(spark, silver_root, site)


def build_silver(
    spark: SparkSession, entity: str, bronze_root: str, silver_root: str, run_ts: Column | None = None
) -> dict[str, int]:
    """Newest bronze day to a silver snapshot; returns the audit counts: rows, and rows of them
    whose id could not be read."""
    pin(spark)
    column = landing.CSV_PARTITION if entity in CSV_ENTITIES else lake.INGESTION_DATE
    root = f"{bronze_root}/{entity}"
    bronze = lake.read_latest(spark, root, column)
    key = silver.KEYS.get(entity)
    unkeyed = {"unreadable_ids": F.count_if(F.col(key).isNull())} if key else {}
    folder, audits = lake.latest_folder(spark, root, column), []

    def built() -> Iterator[DataFrame]:
        depth = slice_depth(stored_bytes(spark, [folder]), target=1 << 30) if key else 0
        for rows in silver.key_slices(bronze, 1 << depth):
            out, audit = observed(silver.BUILDERS[entity](rows, run_ts), f"silver_{entity}", **unkeyed)
            audits.append(audit)
            yield out

    with _sized(spark, [folder]):
        lake.replace_by_slices(built(), f"{silver_root}/{entity}")
    return {name: sum(audit.get[name] for audit in audits) for name in audits[0].get}


@contextmanager
def _sized(spark: SparkSession, paths: list[str]) -> Iterator[None]:
    """``shuffles_for`` tables as ``lake.store`` writes them, and no shuffle files left behind."""
    with shuffles_for(spark, paths, expansion=8, split=16 << 20), settings(spark, _NO_LEFTOVERS):
        yield


Inputs = Mapping[str, DataFrame]
Builder = Callable[[Inputs, Column | None], DataFrame]

# Serving name -> builder over the domain's silver tables (space KPIs: over the room mart).
_R, _T = gold_reservations, gold_tickets
BUILDERS: dict[str, Builder] = {
    ROOM_MART: lambda s, ts: gold_space.room_current(s["space_repartition"], ts),
    "space_kpi_global_current": lambda s, ts: gold_space.kpi_global(s[ROOM_MART], ts),
    "space_kpi_by_site_current": lambda s, ts: gold_space.kpi_by_site(s[ROOM_MART], ts),
    "space_kpi_by_site_space_type_current": lambda s, ts: gold_space.kpi_by_site_space_type(
        s[ROOM_MART], ts
    ),
    "space_kpi_by_site_org_type_current": lambda s, ts: gold_space.kpi_by_site_org_type(
        s[ROOM_MART], ts
    ),
    "reservations_enriched_current": lambda s, ts: _R.enriched_current(
        s["reservations"], s["users"], s["reserveditems"], ts
    ),
    "reservations_kpi_cards_current": lambda s, ts: _R.cards_current(s["reservations"], ts),
    "reservations_kpi_peak_period_current": lambda s, ts: _R.peak_period_current(
        s["reservations"], ts
    ),
    "reservations_kpi_trends_by_month": lambda s, ts: _R.trends_by_month(s["reservations"], ts),
    "reservations_kpi_by_item_current": lambda s, ts: _R.by_item_current(
        s["reservations"], s["reserveditems"], ts
    ),
    "reservations_kpi_by_user_current": lambda s, ts: _R.by_user_current(
        s["reservations"], s["users"], ts
    ),
    "reservations_kpi_duration_distribution_current": lambda s, ts: (
        _R.duration_distribution_current(s["reservations"], ts)
    ),
    "reservations_kpi_invalid_current": lambda s, ts: _R.invalid_current(
        s["reservations"], s["users"], s["reserveditems"], ts
    ),
    "tickets_enriched": lambda s, ts: _T.enriched(s["tickets"], s["users"], s, ts),
    "kpi_load_by_technician_priority_period": lambda s, ts: _T.load_by_technician_priority(
        s["tickets"], s["users"], s, ts
    ),
    "kpi_priority_distribution_period": lambda s, ts: _T.by_priority(s["tickets"], s, ts),
    "kpi_status_distribution_period": lambda s, ts: _T.by_status(s["tickets"], s, ts),
    "kpi_tickets_by_category_period": lambda s, ts: _T.by_category(s["tickets"], s, ts),
    "kpi_tickets_by_month": lambda s, ts: _T.by_month(s["tickets"], ts),
    "kpi_tickets_by_requester_period": lambda s, ts: _T.by_requester(s["tickets"], s["users"], ts),
    "kpi_tickets_by_technician_period": lambda s, ts: _T.by_technician(
        s["tickets"], s["users"], ts
    ),
    "kpi_tickets_by_year": lambda s, ts: _T.by_year(s["tickets"], ts),
    "kpi_tickets_by_location_period": lambda s, ts: _T.by_location(s["tickets"], s, ts),
    "tickets_cards": lambda s, ts: _T.cards(s["tickets"], ts),
}


#: The enriched facts are stored so that the filters of the serving queries skip data: reservations along a
#: curve over the four that may be given, tickets in ranges of their creation. The id splits ties.
FACT_LAYOUT = {
    "reservations_enriched_current": {
        "curve_by": ("start_month", "user_id", "reservation_item_id", "start_hour"),
        "cluster_by": ("reservation_id",),
    },
    "tickets_enriched": {"cluster_by": ("created_ts", "ticket_id")},
}

#: The silver table that a fact's rows come from, one for one, and the columns of its layout made of it.
FACT_SOURCE = {
    "reservations_enriched_current": ("reservations", _R.layout_columns),
    "tickets_enriched": ("tickets", dict),
}

SILVER_OF = {
    "space": ["space_repartition"],
    "reservations": ["reservations", "users", "reserveditems"],
    "tickets": ["tickets", "users", *dims.code_tables()],
}


def build_gold(
    spark: SparkSession,
    domain: str,
    silver_root: str,
    gold_root: str,
    run_ts: Column | None = None,
    hot_share: float | None = None,
) -> list[str]:
    """Write every gold table of a domain.

    ``hot_share`` looks for users with that share of the tickets and spreads their join.

    KPI marts scan the stored silver table (two to four columns each); the space KPIs read the
    stored room mart, which is already one row per room.
    """
    pin(spark)
    paths = {t: f"{silver_root}/{t}" for t in SILVER_OF[domain]}
    tables = {t: lake.read_table(spark, path) for t, path in paths.items()}
    with _sized(spark, [lake.current_version(spark, p) or p for p in paths.values()]):
        for name in SERVING[domain]:
            path, build = f"{gold_root}/{domain}/{name}", BUILDERS[name]
            if name == "tickets_enriched" and hot_share is not None:
                build = lambda s, ts: _T.enriched(s["tickets"], s["users"], s, ts, hot_share)
            if name in FACT_LAYOUT:
                fact = paths[FACT_SOURCE[name][0]]
                size = stored_bytes(spark, [lake.current_version(spark, fact) or fact])
                with closing(_fact_slices(name, tables, lambda s: build(s, run_ts), slice_depth(size))) as rows:
                    lake.replace_by_slices(rows, path)
            else:
                lake.replace_snapshot(build(tables, run_ts), path)
            if name == ROOM_MART:
                tables[name] = lake.read_table(spark, path)
    return list(SERVING[domain])


def _fact_slices(name: str, tables: Inputs, build: Callable[[Inputs], DataFrame], depth: int) -> Iterator[DataFrame]:
    """A fact in up to 2^``depth`` slices of its layout, one after the other: what is shuffled and staged
    is a slice's, and gone before the next."""
    source, derived = FACT_SOURCE[name]
    curve_by, order = FACT_LAYOUT[name].get("curve_by"), list(FACT_LAYOUT[name]["cluster_by"])
    by = curve_by or order[:1]
    facts = tables[source].withColumns(derived())
    cuts = curve_cuts(facts, by) if curve_by or depth else []
    order = ["_curve", *order] if curve_by else order
    cell = curve_cell(facts, by, cuts, 2 * depth)
    for first, last in even_ranges(facts, cell, 1 << depth) if depth else [(0, 0)]:
        part = facts.where(cell.between(first, last)) if depth else facts
        rows = build({**tables, source: part.select(*tables[source].columns)})
        if curve_by:
            rows = along_curve(rows, curve_by, cuts=cuts)
        with _staged(rows) as stored:  # ranges are found by reading the rows first, so they are joined once and stored
            yield stored.repartitionByRange(*order).sortWithinPartitions(*order).drop("_curve")


@contextmanager
def _staged(rows: DataFrame) -> Iterator[DataFrame]:
    """The rows written to the shared scratch folder and read back, for a while."""
    spark, path = rows.sparkSession, shared_dir(rows.sparkSession, "staged")
    try:
        lake.store(spark, rows.write, path)
        yield spark.read.schema(rows.schema).parquet(path)
    finally:
        lake.delete_folder(spark, path)


def gold_paths(gold_root: str) -> dict[str, str]:
    """The gold catalogue: serving name -> stored folder."""
    return {table: f"{gold_root}/{domain}/{table}" for table, domain in serving_tables().items()}


def publish_gold(
    spark: SparkSession,
    domain: str,
    gold_root: str,
    target: publish.JdbcTarget,
    fact_partitions: int = publish.FACT_PARTITIONS,
    kpi_partitions: int = publish.KPI_PARTITIONS,
) -> list[str]:
    """Send a domain's stored gold tables to the serving database."""
    pin(spark)
    gold = {t: lake.read_table(spark, f"{gold_root}/{domain}/{t}") for t in SERVING[domain]}
    return publish.publish_domain(domain, gold, target, fact_partitions, kpi_partitions)
