"""Properties that matter on large data: plan shapes, and one key with a third of all rows."""

import re

import fixtures
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from opsmart import session
from opsmart.checks import dashboard, functions, marts, relational, serving, storage  # noqa: F401
from opsmart.checks.registry import QUERIES
from opsmart.operators import latest, lookup, rollup
from opsmart.plans import dims, jobs
from opsmart.plans import gold_tickets as gt
from opsmart.plans import serving as serve
from opsmart.sources import lake

N = 30_000


@pytest.fixture(scope="module")
def skewed(spark):
    """One user, and one NULL, with a third of the rows each."""
    who = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id") % 500)
    ts = F.timestamp_add("HOUR", F.col("id") % 9000, F.lit("2024-01-01").cast("timestamp"))
    return spark.range(N).select(
        F.col("id").alias("ticket_id"), who.cast("bigint").alias("who"), ts.alias("created_ts")
    )


@pytest.fixture(scope="module")
def people(spark):
    return spark.range(500).select(F.col("id").alias("who"), F.concat(F.lit("u"), "id").alias("name"))


@pytest.fixture
def no_broadcast(spark):
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    }
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_latest_limits_each_key_before_the_shuffle(skewed):
    plan = plan_of(latest.latest_per_key(skewed, ["who"], ["ticket_id"]))
    final, partial = plan.index(", Final"), plan.index(", Partial")
    assert final < plan.index("Exchange hashpartitioning") < partial


def test_latest_of_a_hot_key(skewed):
    rows = latest.latest_per_key(skewed, ["who"], ["ticket_id"]).collect()
    expected = {}
    for i in range(N):
        expected[1 if i % 3 == 0 else None if i % 3 == 1 else i % 500] = i
    assert {r.who: r.ticket_id for r in rows} == expected


def test_hot_key_join_without_broadcast(skewed, people, no_broadcast):
    joined = lookup.attach(skewed.repartition(6), people, "who")
    summary = joined.groupBy("name").count().collect()
    found = {r.name: r["count"] for r in summary}
    expected = {}
    for i in range(N):
        who = 1 if i % 3 == 0 else None if i % 3 == 1 else i % 500
        name = None if who is None else f"u{who}"
        expected[name] = expected.get(name, 0) + 1
    assert found == expected
    salted = lookup.attach(skewed, people, "who", salts=8).groupBy("name").count().collect()
    assert {r.name: r["count"] for r in salted} == expected


def test_salted_copies_are_not_broadcast(skewed, people):
    plan = plan_of(lookup.attach(skewed, people, "who", salts=8))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_hot_partition_is_split_at_run_time(skewed, people, no_broadcast):
    wide = skewed.repartition(6).withColumn("pad", F.sha2(F.col("ticket_id").cast("string"), 512))
    joined = lookup.attach(wide, people, "who")
    joined.write.format("noop").mode("overwrite").save()
    joined.collect()
    assert "SortMergeJoin(skew=true)" in plan_of(joined)


def test_code_tables_never_shuffle_the_fact(spark):
    fact = fixtures.tickets(spark)
    out = lookup.attach_codes(fact, dims.code_table(spark, "ticket_status"), "status_code")
    plan = plan_of(out)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_large_dimension_is_not_broadcast(spark, skewed, people, no_broadcast):
    assert "SortMergeJoin" in plan_of(lookup.attach(skewed, people, "who"))


def test_rollup_reads_and_shuffles_the_fact_once(spark, folder, skewed):
    lake.replace_snapshot(skewed, f"{folder}/t")
    out = rollup.with_share(rollup.period_rollup(lake.read_table(spark, f"{folder}/t"), "created_ts", ["who"]))
    out.collect()
    plan = plan_of(out).split("Initial Plan")[0]
    assert plan.count("FileScan parquet") == 1 and "ReusedExchange" in plan
    # Expand works on the monthly counts: below it there is an aggregated exchange, not the scan.
    assert plan.index("Expand") < plan.index("Exchange hashpartitioning(_grouping") < plan.index("FileScan")


def test_rollup_of_a_hot_key(skewed):
    rows = rollup.period_rollup(skewed, "created_ts", ["who"]).where("period = 'ALL'").collect()
    counts = {r.who: r.ticket_count for r in rows}
    assert counts[1] >= N // 3 and counts[None] == N // 3 and sum(counts.values()) == N


def test_marts_scan_only_their_columns(spark, folder):
    lake.replace_snapshot(fixtures.tickets(spark), f"{folder}/t")
    stored = lake.read_table(spark, f"{folder}/t")
    plan = plan_of(gt.by_status(stored, dims.all_code_tables(spark)))
    assert "ReadSchema: struct<created_ts:timestamp,status_code:int>" in plan


def test_serving_filters_reach_the_scan(spark, folder):
    tables = {"tickets": fixtures.tickets(spark), **dims.all_code_tables(spark)}
    lake.replace_snapshot(jobs.BUILDERS["kpi_tickets_by_category_period"](tables, None), f"{folder}/c")
    plan = plan_of(serve.tickets_by_category(lake.read_table(spark, f"{folder}/c"), "2024-01"))
    assert "PushedFilters: [IsNotNull(period), EqualTo(period,2024-01)]" in plan


def test_latest_partition_prunes(spark, folder):
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "v int, ingestion_date string")
    lake.replace_partitions(df, f"{folder}/t")
    listed = lake.read_latest(spark, f"{folder}/t").inputFiles()
    assert listed and all("ingestion_date=2024-01-02" in f for f in listed)
    by_max = plan_of(lake.latest_partition(lake.read_table(spark, f"{folder}/t")))
    assert re.search(r"PartitionFilters: \[[^\]]*ingestion_date#\d+ = 2024-01-02", by_max)


def test_top_k_never_sorts_everything(skewed):
    from opsmart.operators.select import asc, desc, top_k

    assert "TakeOrderedAndProject" in plan_of(top_k(skewed, [desc("created_ts"), asc("ticket_id")], 10))


def test_no_query_uses_python_or_a_cross_join(spark):
    tables = marts.Tables(spark, "/root/testdata/sf0.001")
    writers = ("io_", "jb_", "st_")
    for name, query in QUERIES.items():
        if name.startswith(writers):
            continue
        plan = plan_of(query(tables))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
            assert bad not in plan, f"{name}: {bad}"


def test_shared_dir_needs_a_shared_folder_on_a_cluster(spark):
    class Context:
        master = "spark://cluster:7077"

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session(), "x")
    assert session.shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_shuffle_partitions_are_bounded():
    assert session.shuffle_partitions(400 << 40, 200, 32 * 4000) == 128_000
    assert session.shuffle_partitions(1 << 40, 200, 128_000) == 8192
    assert session.shuffle_partitions(1, 200, 128_000) == 200


def test_shuffle_partitions_follow_the_input(spark, folder):
    lake.replace_snapshot(spark.range(10_000).repartition(2), f"{folder}/t")
    size = session.stored_bytes(spark, [f"{folder}/t", f"{folder}/none"])
    assert size > 0
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with session.shuffles_for(spark, [f"{folder}/t"], target=size // 50, expansion=1, per_core=99) as n:
        assert 50 <= n <= 52 and spark.conf.get(key) == str(n)
    assert spark.conf.get(key) == before
    with session.shuffles_for(spark, [f"{folder}/t"]) as n:
        assert str(n) == before


def test_splits_are_small_while_a_job_runs(spark, folder):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    lake.replace_snapshot(spark.range(1000), f"{folder}/t")
    with session.shuffles_for(spark, [f"{folder}/t"]):
        assert session.byte_size(spark, key) == 32 << 20
    with session.shuffles_for(spark, [f"{folder}/t"], split=100, per_core=1):
        assert 100 <= session.byte_size(spark, key) < 32 << 20
    assert spark.conf.get(key) == before


def test_stored_layers_are_sized_by_what_they_read(spark, folder, monkeypatch):
    from opsmart.checks import bindings

    spark.range(4000).repartition(20).write.parquet(f"{folder}/many")
    spark.range(4000).coalesce(1).write.parquet(f"{folder}/one")
    read = session.input_paths(spark.read.parquet(f"{folder}/many").union(spark.read.parquet(f"{folder}/one")))
    assert [p.endswith("/many") for p in read] == [True, False]
    assert session.stored_bytes(spark, read) > 20_000
    seen = []
    monkeypatch.setattr(bindings.session, "stored_bytes", lambda spark, paths: len(paths) << 40)
    monkeypatch.setattr(bindings.lake, "replace_snapshot", lambda *a: seen.append(
        (int(spark.conf.get("spark.sql.shuffle.partitions")), session.byte_size(spark, "spark.sql.files.maxPartitionBytes"))
    ))
    monkeypatch.setattr(bindings.lake, "read_table", lambda *a: None)
    bindings.Tables(spark, folder).stored("t", lambda: spark.read.parquet(f"{folder}/one"))
    assert seen == [(32 * 4, 256 << 20)]
    monkeypatch.setattr(bindings.session, "stored_bytes", lambda spark, paths: 1 << 20)
    bindings.Tables(spark, folder).stored("u", lambda: spark.read.parquet(f"{folder}/one"))
    assert seen[1] == (4, 32 << 20)


def test_reservation_versions_are_sorted_by_narrow_rows(spark):
    from opsmart.checks.bindings import Tables

    plan = plan_of(Tables(spark, "/root/testdata/sf0.001").typed_reservations)
    below = plan[plan.index("WindowGroupLimit"):]
    assert "duration_hours" not in below and "_source_system" not in below


def test_each_optional_filter_skips_stored_reservations(spark, folder):
    """Files whose statistics admit a value, for one filter at a time."""
    import glob

    import pyarrow.parquet as pq

    from opsmart.plans import jobs

    rows = spark.range(60_000).selectExpr(
        "id AS reservation_id", "date_format(date_add(date'2023-01-01', cast(hash(id) % 365 AS int)), 'yyyy-MM') AS start_month",
        "CASE WHEN id % 50 = 0 THEN NULL WHEN id % 3 = 0 THEN 7 ELSE pmod(hash(id, 1), 5000) END AS user_id",
        "pmod(hash(id, 2), 800) AS reservation_item_id", "cast(pmod(hash(id, 3), 24) AS int) AS start_hour",
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "256")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        lake.replace_snapshot(rows, f"{folder}/t", **jobs.FACT_LAYOUT["reservations_enriched_current"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    out = lake.read_table(spark, f"{folder}/t")
    assert out.count() == 60_000 and out.columns == rows.columns
    files = glob.glob(f"{folder}/t/_versions/*/*.parquet")
    assert len(files) > 200
    for column, value in (("start_month", "2023-05"), ("user_id", 4321), ("reservation_item_id", 555), ("start_hour", 9)):
        admitted = 0
        for file in files:
            meta = pq.ParquetFile(file).metadata
            at = meta.schema.names.index(column)
            groups = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
            admitted += any(s.has_min_max and s.min <= value <= s.max for s in groups)
        assert admitted <= 0.6 * len(files), (column, admitted, len(files))
