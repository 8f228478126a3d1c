"""Landing, bronze, snapshots, catalogue, publishing."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from opsmart import contracts
from opsmart.contracts import conform, landing_schema, schema_of
from opsmart.sources import lake, landing, publish
from opsmart.streaming.landing_stream import ingest_available

USERS = landing_schema("users")


def export(root, day, rows, name="part-0.json"):
    folder = Path(root) / f"ingestion_date={day}"
    folder.mkdir(parents=True, exist_ok=True)
    if rows is not None:
        lines = [r if isinstance(r, str) else json.dumps(r) for r in rows]
        (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


@pytest.fixture
def roots(folder):
    """Three landing days, the last one empty, and a folder that is not a day."""
    src, dst = f"{folder}/landing/users", f"{folder}/bronze/users"
    export(src, "2024-01-01", [{"id": 1, "name": "a"}, {"id": 2, "name": "b"}])
    export(src, "2024-01-02", [{"id": 1, "name": "a2"}])
    export(src, "2024-01-03", None)
    (Path(src) / "archive").mkdir()
    return src, dst


def test_partition_dates(spark, roots):
    src, dst = roots
    assert lake.partition_dates(spark, src) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert lake.partition_dates(spark, dst) == []
    assert lake.missing_dates(spark, src, dst) == ["2024-01-01", "2024-01-02", "2024-01-03"]


def days(spark, path):
    counts = lake.read_table(spark, path).groupBy("ingestion_date").count()
    return {str(r.ingestion_date): r["count"] for r in counts.collect()}


def test_ingest_json_once_again_and_after_a_loss(spark, roots):
    src, dst = roots
    first = landing.ingest_json(spark, src, dst, USERS)
    assert first == {"dates": ["2024-01-01", "2024-01-02"], "rows": 3}
    assert days(spark, dst) == {"2024-01-01": 2, "2024-01-02": 1}
    assert landing.ingest_json(spark, src, dst, USERS) == {"dates": [], "rows": 0}
    lost = Path(dst) / "ingestion_date=2024-01-01"
    for file in lost.iterdir():
        file.unlink()
    lost.rmdir()
    assert landing.ingest_json(spark, src, dst, USERS) == {"dates": ["2024-01-01"], "rows": 2}
    assert days(spark, dst) == {"2024-01-01": 2, "2024-01-02": 1}


def test_ingest_json_keeps_lineage_and_broken_lines(spark, folder):
    src, dst = f"{folder}/landing", f"{folder}/bronze"
    export(src, "2024-01-01", [{"id": 1, "name": "a", "is_active": True, "extra": 5}, "{broken"])
    landing.ingest_json(spark, src, dst, USERS, F.lit("2024-01-05 00:00:00").cast("timestamp"))
    good, bad = lake.read_table(spark, dst).orderBy(F.col("id").asc_nulls_last()).collect()
    assert (good.id, good.is_active, good._source_system) == ("1", "true", "glpi")
    assert good._source_file.endswith("ingestion_date=2024-01-01/part-0.json")
    assert str(good._ingest_bronze_ts) == "2024-01-05 00:00:00"
    assert (bad.id, bad._corrupt_record) == (None, "{broken")
    assert (good._extra_fields, bad._extra_fields) == ({"extra": "5"}, None)


def test_ingest_json_lists_blank_lines_and_nested_values(spark, folder):
    src, dst = f"{folder}/landing", f"{folder}/bronze"
    rows = ['[{"id": 1}, {"id": 2, "more": {"a": [1]}}]', "", "   ", '{"id": 3, "name": {"x": 1}}', "[]"]
    export(src, "2024-01-01", rows)
    assert landing.ingest_json(spark, src, dst, USERS)["rows"] == 3
    out = lake.read_table(spark, dst).orderBy("id").collect()
    assert [(r.id, r.name, r._extra_fields) for r in out] == [
        ("1", None, None), ("2", None, {"more": '{"a":[1]}'}), ("3", '{"x":1}', None),
    ]


def test_only_recorded_days_are_loaded(spark, roots):
    """An empty day, a day without manifest and a day that lost a file are loaded again."""
    src, dst = roots
    (Path(dst) / "ingestion_date=2024-01-02").mkdir(parents=True)
    half = Path(dst) / "ingestion_date=2024-01-01"
    spark.range(5).write.parquet(str(half))
    assert landing.ingest_json(spark, src, dst, USERS)["dates"] == ["2024-01-01", "2024-01-02"]
    assert days(spark, dst) == {"2024-01-01": 2, "2024-01-02": 1}
    next(half.glob("*.parquet")).unlink()
    assert landing.ingest_json(spark, src, dst, USERS)["dates"] == []
    assert landing.ingest_json(spark, src, dst, USERS, verify=True)["dates"] == ["2024-01-01"]
    assert days(spark, dst) == {"2024-01-01": 2, "2024-01-02": 1}


def test_a_failed_reload_leaves_the_day_to_be_loaded(spark, roots):
    src, dst = roots
    landing.ingest_json(spark, src, dst, USERS)
    bad = lake.read_table(spark, dst).withColumn("name", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        lake.replace_partitions(bad, dst, days=["2024-01-02"])
    assert lake.missing_dates(spark, src, dst) == ["2024-01-02", "2024-01-03"]


def test_overlapping_runs_keep_both_records(spark, folder):
    path = f"{folder}/t"
    one = lake.Manifests(spark, path)
    for day in ("2024-01-01", "2024-01-02"):
        spark.range(1).write.parquet(f"{path}/ingestion_date={day}")
    two = lake.Manifests(spark, path)
    one.write(also=["2024-01-01"])
    two.write(also=["2024-01-02"])
    assert lake.Manifests(spark, path).loaded(verify=True) == {"2024-01-01", "2024-01-02"}
    lake.Manifests(spark, path).write()
    assert len(list((Path(path) / "_loaded").glob("ingestion*"))) == 1


def test_calls_do_not_grow_with_the_loaded_days(spark, folder, monkeypatch):
    calls = []
    located = lake._located
    monkeypatch.setattr(lake, "_located", lambda *a: calls.append(a) or located(*a))
    counts = []
    for n in (5, 500):
        src, dst = f"{folder}/{n}/landing", f"{folder}/{n}/bronze"
        days = [f"20{10 + i // 300}-{i // 28 % 10 + 1:02d}-{i % 28 + 1:02d}" for i in range(n)]
        manifests = lake.Manifests(spark, dst)
        for day in days:
            (Path(src) / f"ingestion_date={day}").mkdir(parents=True, exist_ok=True)
            (Path(dst) / f"ingestion_date={day}").mkdir(parents=True, exist_ok=True)
        manifests.write(also=set(days))
        export(src, "2023-12-31", [{"id": 1}])
        calls.clear()
        assert landing.ingest_json(spark, src, dst, USERS)["dates"] == ["2023-12-31"]
        counts.append(len(calls))
    assert counts[0] == counts[1] < 20


def test_ingest_json_can_infer(spark, folder):
    src, dst = f"{folder}/landing", f"{folder}/bronze"
    export(src, "2024-01-01", [{"id": 1, "name": "a"}])
    landing.ingest_json(spark, src, dst)
    assert dict(lake.read_table(spark, dst).dtypes)["id"] == "bigint"


def test_read_latest(spark, roots, folder):
    src, dst = roots
    landing.ingest_json(spark, src, dst, USERS)
    by_listing = lake.read_latest(spark, dst)
    by_maximum = lake.latest_partition(lake.read_table(spark, dst))
    for df in (by_listing, by_maximum):
        assert [(r.name, str(r.ingestion_date)) for r in df.collect()] == [("a2", "2024-01-02")]
    with pytest.raises(ValueError, match="no ingestion_date"):
        lake.read_latest(spark, f"{folder}/nothing")
    with pytest.raises(ValueError, match="no ingestion_date found"):
        lake.latest_partition(lake.read_table(spark, dst).limit(0))


def test_snapshot_replaces_schema(spark, folder):
    path = f"{folder}/table"
    lake.replace_snapshot(spark.range(3).toDF("a"), path)
    lake.replace_snapshot(spark.range(2).select(F.col("id").cast("string").alias("b")), path)
    assert lake.read_table(spark, path).dtypes == [("b", "string")]
    assert lake.read_table(spark, path).count() == 2


def test_failed_snapshot_changes_nothing(spark, folder):
    path = f"{folder}/table"
    lake.replace_snapshot(spark.range(3), path)
    before = lake.read_table(spark, path)
    with pytest.raises(Exception, match="broken"):
        lake.replace_snapshot(spark.range(9).select(F.raise_error(F.lit("broken")).alias("id")), path)
    assert lake.read_table(spark, path).count() == 3
    lake.replace_snapshot(lake.read_table(spark, path).where("id > 0"), path)
    assert lake.read_table(spark, path).count() == 2
    assert before.count() == 3  # its version is still there
    assert len(list((Path(path) / "_versions").iterdir())) == 2


def test_snapshot_by_month_keeps_types_and_prunes(spark, folder):
    path = f"{folder}/table"
    rows = [("2024-01", 1), ("2024-02", 2), (None, 3)]
    lake.replace_snapshot(spark.createDataFrame(rows, "m string, v int"), path, 0, "m", ["v"])
    out = lake.read_table(spark, path)
    assert out.dtypes == [("m", "string"), ("v", "int")]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(rows, key=str)
    plan = out.where("m = '2024-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(m" in plan


def test_partition_overwrite_leaves_other_days(spark, folder):
    path = f"{folder}/table"
    both = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "v int, ingestion_date string")
    lake.replace_partitions(both, path)
    lake.replace_partitions(both.where("v = 2").withColumn("v", F.lit(9)), path)
    assert sorted(r.v for r in lake.read_table(spark, path).collect()) == [1, 9]


def test_catalogue(spark, folder):
    lake.replace_snapshot(spark.range(3), f"{folder}/t")
    lake.register_catalogue(spark, {"catalogue_t": f"{folder}/t"})
    assert spark.sql("select count(*) from catalogue_t").first()[0] == 3


@pytest.mark.parametrize(
    ("header", "name"),
    [
        ("Viilage", "viilage"), ("Étage", "etage"), ("Nom de l'organisation", "nom_de_lorganisation"),
        ("Surface m²", "surface_m2"), (" a - b/c ", "a_b_c"), ("Nb employés", "nb_employes"), ("%", "col"), ("", "col"),
    ],
)
def test_clean_name(header, name):
    assert landing.clean_name(header) == name


def test_clean_names_are_unique():
    assert landing.clean_names(["A", "a", "b"]) == ["a", "a_1", "b"]
    assert landing.clean_names(["A", "a", "a", "a_1"]) == ["a", "a_1", "a_2", "a_1_1"]


def test_ingest_csv(spark, folder):
    src, dst = Path(folder) / "landing", f"{folder}/bronze"
    one, two, empty = (src / f"ingestion_date=2024-01-0{d}" for d in (1, 2, 3))
    for day in (one, two, empty):
        day.mkdir(parents=True)
    (one / "sheet.csv").write_text('Étage,Salle\nRDC,"a, ""b""\nc"\n', encoding="utf-8")
    (two / "sheet.csv").write_text("Salle,Étage,Activité\nd,2ème,x\n", encoding="utf-8")
    first = landing.ingest_csv(spark, str(src), dst, "space_repartition")
    assert first == {"dates": ["2024-01-01", "2024-01-02"], "rows": 2}
    assert landing.ingest_csv(spark, str(src), dst, "space_repartition")["rows"] == 0
    out = lake.read_table(spark, dst).orderBy("_ingestion_date")
    assert [(r.etage, r.salle, r.activite, r._entity) for r in out.collect()] == [
        ("RDC", 'a, "b"\nc', None, "space_repartition"), ("2ème", "d", "x", "space_repartition"),
    ]
    assert out.first()._source_system == "drive_csv"


def test_csv_files_of_one_day_may_differ_in_header(spark, folder):
    day = Path(folder) / "landing" / "ingestion_date=2024-01-01"
    day.mkdir(parents=True)
    (day / "a 1.csv").write_text("Salle,Etat\nS1,loue\n", encoding="utf-8")
    (day / "b.csv").write_text("\nEtat,Salle,Plus\nlibre,S2,x\n", encoding="utf-8")
    (day / "c.csv").write_text('"Sal\nle",Etat\nS3,loue\n', encoding="utf-8")
    (day / "d.csv").write_text("", encoding="utf-8")
    assert landing.ingest_csv(spark, f"{folder}/landing", f"{folder}/bronze", "e")["rows"] == 3
    out = lake.read_table(spark, f"{folder}/bronze").orderBy("etat", "salle").collect()
    assert sorted((str(r.salle), r.etat, r.plus) for r in out) == [
        ("S1", "loue", None), ("S2", "libre", "x"), ("S3", "loue", None),
    ]


def test_csv_plan_grows_with_headers_not_days(spark, folder):
    folders = []
    for n in range(300):
        day = Path(folder) / f"ingestion_date={n:03d}"
        day.mkdir()
        (day / "a.csv").write_text("A,B\n1,2\n" if n % 2 else "B,A\n2,1\n", encoding="utf-8")
        folders.append(str(day))
    assert len(landing.csv_scans(spark, folders)) == 2
    counts = landing.read_csv(spark, *folders).groupBy("a", "b").count().collect()
    assert [tuple(r) for r in counts] == [("1", "2", 300)]


def _messy_csv(pick, rows, ends):
    def cell():
        kind = pick.random()
        if kind < 0.2:
            return pick.choice(["", '""'])
        if kind < 0.5:
            inside = "".join(pick.choice(["a", "\n", "\r\n", ",", '""', "é", " "]) for _ in range(pick.randint(0, 30)))
            return f'"{inside}"'
        return "".join(pick.choice("ab é1-") for _ in range(pick.randint(0, 6)))

    return ends.join(",".join(cell() for _ in range(pick.choice([3, 3, 3, 2, 4]))) for _ in range(rows))


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "1000", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("seed", range(4))
def test_one_csv_file_of_many_splits(spark, folder, small_splits, seed):
    import random

    pick = random.Random(seed)
    path = Path(folder) / "day" / "big 1.csv"
    path.parent.mkdir()
    long = '"' + "x\n" * 2500 + '"'  # a cell over several splits
    ends, header = pick.choice(["\n", "\r\n"]), '"Sal\nle",Étage,Étage'
    parts = ["", header, _messy_csv(pick, 400, ends), f"{long},1,2", header, _messy_csv(pick, 300, ends)]
    text = ends.join(parts) + pick.choice(["", ends])
    path.write_text(text, encoding="utf-8", newline="")
    whole = spark.read.options(**landing.CSV_OPTIONS).csv(str(path))
    out = landing.read_csv(spark, str(path.parent))
    assert out.columns == landing.clean_names(whole.columns)
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, map(tuple, whole.collect())))
    scan = landing.csv_splits.records(spark, [str(path)])
    assert scan.select(F.spark_partition_id()).distinct().count() > 3
    files = {r._source_file for r in landing.csv_scans(spark, [str(path.parent)])[0].collect()}
    assert len(files) == 1 and files.pop().endswith("big%201.csv")


def test_small_and_large_files_of_one_header(spark, folder, small_splits):
    day = Path(folder) / "day"
    day.mkdir()
    (day / "a.csv").write_text("A,B\n" + "1,2\n" * 1000)
    (day / "b.csv").write_text("A,B\n3,4\n")
    (day / "c.csv").write_text("B,A\n" + '4,"3"\n' * 900)
    counts = landing.read_csv(spark, str(day)).groupBy("a", "b").count().collect()
    assert sorted(map(tuple, counts)) == [("1", "2", 1000), ("3", "4", 901)]


def test_heads_longer_than_a_block(spark, folder, monkeypatch):
    monkeypatch.setattr(landing, "HEAD_BYTES", 16)
    day = Path(folder) / "day"
    day.mkdir()
    (day / "a.csv").write_text('\n\n"' + "é" * 300 + '\n",B\n1,2\n', encoding="utf-8")
    (day / "b.csv").write_text("A,B", encoding="utf-8")
    (day / "c.csv").write_text("\n\n", encoding="utf-8")
    groups = landing._files_by_header(spark, [str(day)])
    assert sorted(h for h, *_ in groups) == ['"' + "é" * 300 + '\n",B', "A,B"]


def test_stream_loads_each_file_once(spark, folder):
    src, dst, state = (f"{folder}/{n}" for n in ("landing", "bronze", "state"))
    export(src, "2024-01-01", [{"id": 1}, {"id": 2}])
    ingest_available(spark, src, dst, state, USERS)
    ingest_available(spark, src, dst, state, USERS)
    assert days(spark, dst) == {"2024-01-01": 2}
    export(src, "2024-01-01", [{"id": 3}], "late.json")
    export(src, "2024-01-02", [{"id": 4}])
    ingest_available(spark, src, dst, state, USERS)
    assert days(spark, dst) == {"2024-01-01": 3, "2024-01-02": 1}


def test_stream_and_batch_have_one_schema(spark, folder):
    src, state = f"{folder}/landing", f"{folder}/state"
    export(src, "2024-01-01", [{"id": 1, "extra": True}, "{broken"])
    ingest_available(spark, src, f"{folder}/stream", state, USERS)
    landing.ingest_json(spark, src, f"{folder}/batch", USERS)
    frames = [lake.read_table(spark, f"{folder}/{n}").drop("_ingest_bronze_ts") for n in ("stream", "batch")]
    assert sorted(frames[0].dtypes) == sorted(frames[1].dtypes)
    a, b = ({str(r) for r in f.select(*sorted(f.columns)).collect()} for f in frames)
    assert a == b and any("{broken" in r for r in a)


# --- contracts and publishing ---
def test_conform_projects_casts_and_checks(spark):
    df = spark.createDataFrame([(1, "x", 3), (0, "y", None), (None, "z", 4)], "flag int, extra string, n int")
    out = conform(df, schema_of("n bigint, flag boolean"))
    assert out.dtypes == [("n", "bigint"), ("flag", "boolean")]
    assert [tuple(r) for r in out.collect()] == [(3, True), (None, False), (4, None)]
    with pytest.raises(ValueError, match="missing columns: other"):
        conform(df, schema_of("n bigint, other string"))


def test_serving_contracts(spark):
    tables = contracts.serving_tables()
    assert len(tables) == 24
    assert sorted(set(tables.values())) == ["reservations", "space", "tickets"]
    assert set(contracts.SERVING_KEYS) <= set(tables) and contracts.FACT_TABLES <= set(tables)
    listed = contracts.contract_columns()
    assert ("tickets_cards", "open_rate", 6, "double") in listed
    with pytest.raises(KeyError):
        contracts.serving_schema("nothing")


def test_jdbc_target():
    target = publish.JdbcTarget("db", "serving", "me", "secret")
    assert target.url == "jdbc:postgresql://db:5432/serving?sslmode=require"
    options = target.options("tickets_cards", 2)
    assert options["dbtable"] == "srv.tickets_cards"
    assert (options["truncate"], options["numPartitions"]) == ("true", "2")
    with pytest.raises(ValueError, match="host, password"):
        publish.JdbcTarget("", "serving", "me", "")


def test_publish_table_writes_once_with_truncate(spark, monkeypatch):
    """The write itself needs a database; here only the writer's settings are checked."""
    from pyspark.sql import DataFrameWriter

    seen = []

    def save(self, *args, **kwargs):
        seen.append(self)

    calls = {}
    monkeypatch.setattr(DataFrameWriter, "save", save)
    monkeypatch.setattr(DataFrameWriter, "mode", lambda self, m: calls.update(mode=m) or self)
    monkeypatch.setattr(DataFrameWriter, "format", lambda self, f: calls.update(format=f) or self)
    monkeypatch.setattr(DataFrameWriter, "options", lambda self, **o: calls.update(o) or self)
    df = spark.createDataFrame([("ALL", 1)], "period string, ticket_count int").withColumn(
        "gold_kpi_build_ts", F.current_timestamp()
    )
    publish.publish_table(df, "kpi_tickets_by_month", publish.JdbcTarget("h", "d", "u", "p"))
    assert len(seen) == 1
    assert (calls["format"], calls["mode"], calls["truncate"]) == ("jdbc", "overwrite", "true")
    assert calls["numPartitions"] == "2"


def test_publish_domain_checks_keys_before_it_empties_a_table(spark, monkeypatch):
    written = []
    monkeypatch.setattr(publish, "publish_table", lambda df, table, target, n: written.append((table, n)))
    target = publish.JdbcTarget("h", "d", "u", "p")

    def gold(site):
        frames = {t: spark.createDataFrame([], contracts.serving_schema(t)) for t in contracts.SERVING["space"]}
        rows = spark.createDataFrame([(s,) for s in site], "site string")
        blanks = [F.lit(None).cast(f.dataType).alias(f.name) for f in contracts.serving_schema("space_kpi_by_site_current")[1:]]
        return frames | {"space_kpi_by_site_current": rows.select("site", *blanks)}

    with pytest.raises(ValueError, match="space_kpi_by_site_current: repeated key"):
        publish.publish_domain("space", gold(["a", "a"]), target)
    assert written == []
    publish.publish_domain("space", gold(["a", "b"]), target, fact_partitions=64, kpi_partitions=3)
    assert dict(written)["space_room_current"] == 64 and dict(written)["space_kpi_by_site_current"] == 3


def test_stream_and_batch_share_one_folder(spark, folder):
    from opsmart.streaming.landing_stream import bronze_sink

    src, dst = f"{folder}/landing", f"{folder}/bronze"
    export(src, "2024-01-01", [{"id": 1}, {"id": 2}])
    assert landing.ingest_json(spark, src, dst, USERS)["rows"] == 2
    export(src, "2024-01-01", [{"id": 3}], "late.json")
    export(src, "2024-01-02", [{"id": 4}])
    ingest_available(spark, src, dst, f"{folder}/one", USERS)
    assert days(spark, dst) == {"2024-01-01": 3, "2024-01-02": 1}
    assert lake.missing_dates(spark, src, dst, verify=True) == []
    ingest_available(spark, src, dst, f"{folder}/two", USERS)  # another checkpoint sees all files anew
    assert landing.ingest_json(spark, src, dst, USERS) == {"dates": [], "rows": 0}
    assert days(spark, dst) == {"2024-01-01": 3, "2024-01-02": 1}
    # One batch again, also after an attempt that had moved only a part of its files.
    rows = lake.read_table(spark, dst).where("id = 4").withColumn("_source_file", F.lit("new.json"))
    rows.write.parquet(f"{folder}/batch")
    batch = spark.read.parquet(f"{folder}/batch").unionByName(spark.read.parquet(f"{folder}/batch").withColumn("id", F.lit("5")))
    take = bronze_sink(dst, "stream-x")
    for _attempt in range(2):
        take(batch, 7)
        assert days(spark, dst) == {"2024-01-01": 3, "2024-01-02": 3}
    assert lake.missing_dates(spark, src, dst, verify=True) == []
