"""Jobs that leave little on disk: slices, files of few bytes, nothing staged or shuffled left behind."""

import glob
import os
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from opsmart import session
from opsmart.operators.layout import along_curve, curve_cell, curve_cuts, even_ranges
from opsmart.plans import jobs, silver
from opsmart.sources import lake

DAY = "2024-01-31"


def _exports(spark):
    """Reservations with versions, missing and unreadable ids, with users and items."""
    stamps = {
        "_source_file": F.lit("f"), "_source_system": F.lit("glpi"), "ingestion_date": F.lit(DAY).cast("date"),
        "_ingest_bronze_ts": F.timestamp_add("SECOND", F.col("n"), F.lit("2024-01-31").cast("timestamp")),
    }
    rows = spark.range(600).withColumnRenamed("id", "n").withColumns(stamps)
    begin = F.timestamp_add("HOUR", F.col("n") * 37 % 9000, F.lit("2023-01-01").cast("timestamp"))
    end = F.timestamp_add("MINUTE", F.col("n") % 400 - 20, begin)
    reservations = rows.selectExpr(
        "CASE WHEN n % 40 = 0 THEN 'x' WHEN n % 41 = 0 THEN NULL WHEN n % 2 = 0 THEN concat(n % 250, '.0') "
        "ELSE cast(n % 250 AS string) END AS id",
        "cast(nullif(n % 13, 5) AS string) AS users_id", "cast(nullif(n % 17, 5) AS string) AS reservationitems_id",
        "cast(n % 3 AS string) AS `group`", "cast(n AS string) AS comment", *stamps, "n",
    )
    begin = F.when(F.col("n") % 19 != 0, F.date_format(begin, "yyyy-MM-dd HH:mm:ss"))
    reservations = reservations.withColumns({"begin": begin, "end": F.date_format(end, "yyyy-MM-dd HH:mm:ss")})
    users = rows.where("n < 13").selectExpr(
        "cast(n AS string) AS id", "concat('a.b', n, '@x.y') AS name", "'1' AS is_active", "'0' AS is_deleted",
        "'0' AS is_deleted_ldap", "'2024-01-01 00:00:00' AS date_creation", "'2024-01-01 00:00:00' AS date_mod",
        "'2024-01-01 00:00:00' AS last_login", *stamps,
    )
    items = rows.where("n < 17").selectExpr(
        "cast(n AS string) AS id", "concat('room ', n) AS items_id", "'t' AS itemtype", "'1' AS is_active",
        "'0' AS is_deleted", "'0' AS is_recursive", *stamps,
    )
    return {"reservations": reservations.drop("n"), "users": users, "reserveditems": items}


def _shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in folders for _, _, files in os.walk(d.getPath()) for f in files if f.startswith("shuffle_")}


def _build(spark, root):
    stamp = F.lit("2024-02-01 00:00:00").cast("timestamp")
    for entity, rows in _exports(spark).items():
        lake.replace_partitions(rows, f"{root}/bronze/{entity}")
    audits = {e: jobs.build_silver(spark, e, f"{root}/bronze", f"{root}/silver", stamp) for e in jobs.SILVER_OF["reservations"]}
    jobs.build_gold(spark, "reservations", f"{root}/silver", f"{root}/gold", stamp)
    fact = lake.read_table(spark, f"{root}/gold/reservations/reservations_enriched_current")
    # A row without an id is known by its comment, which is the number of the export row.
    return audits, sorted(tuple(map(str, r)) for r in fact.collect())


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    root, before = str(tmp_path_factory.mktemp("whole")), _shuffle_files(spark)
    return root, before, _build(spark, root)


def test_sliced_jobs_give_the_same_rows(spark, folder, whole, monkeypatch):
    depths = []

    def three(size, target=0):
        depths.append(3)
        return 3

    monkeypatch.setattr(jobs, "slice_depth", three)
    audits, rows = _build(spark, folder)
    assert len(depths) == 4 and (audits, rows) == whole[2]
    assert audits["reservations"]["rows"] == len(rows) > 250 and audits["reservations"]["unreadable_ids"] == 29
    written = glob.glob(f"{folder}/gold/reservations/reservations_enriched_current/_versions/*/*.parquet")
    assert len({os.path.basename(f).split("-", 2)[2] for f in written}) == 8  # jobs that wrote it


def test_nothing_is_left_behind(spark, whole):
    assert not glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/opsmart/staged-*")
    for _ in range(20):  # files are removed a moment after a query
        if not (left := _shuffle_files(spark) - whole[1]):
            break
        time.sleep(0.5)
    assert not left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_stored_files_are_small(spark, whole):
    for layer in ("bronze/reservations", "silver/reservations", "gold/reservations/reservations_enriched_current"):
        file = glob.glob(f"{whole[0]}/{layer}/**/*.parquet", recursive=True)[0]
        group = pq.ParquetFile(file).metadata.row_group(0)
        columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
        assert {c.compression for c in columns.values()} == {"ZSTD"}
        assert columns["_ingest_bronze_ts"].physical_type == "INT64"
    assert spark.conf.get("spark.sql.parquet.outputTimestampType") == "INT96"


def test_timestamps_of_any_age_are_kept(spark, folder):
    texts = ["0001-01-01 00:00:00", "1582-10-10 01:02:03.456789", "1899-12-31 23:59:59", "9999-12-31 23:59:59.999999"]
    rows = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").selectExpr("t", "to_timestamp(t) AS ts")
    lake.replace_snapshot(rows, f"{folder}/t")
    back = lake.read_table(spark, f"{folder}/t")
    assert back.schema == rows.schema
    assert back.where("ts <=> to_timestamp(t)").count() == 5


def test_cells_are_the_beginning_of_the_curve(spark):
    rows = spark.range(2000).selectExpr("id % 24 AS h", "CASE WHEN id % 3 > 0 THEN id * 7 % 900 END AS u", "id")
    for columns in (["h", "u"], ["id"]):
        cuts = curve_cuts(rows, columns)
        placed = along_curve(rows, columns, cuts=cuts)
        for depth in (1, 3, 4):
            same = curve_cell(placed, columns, cuts, depth) == F.shiftright("_curve", 6 * len(columns) - depth)
            assert placed.where(same).count() == 2000


def test_ranges_of_cells_hold_about_as_many_rows(spark):
    cell = F.when(F.col("id") < 500, 9).otherwise(F.col("id") % 8)
    found = even_ranges(spark.range(1000), cell, 4)
    assert found == [(0, 3), (4, 7), (9, 9)]
    assert even_ranges(spark.range(0), F.col("id"), 4) == [(0, 0)]


def test_versions_of_a_key_share_a_slice(spark):
    texts = ["7", "7.0", "7e0", *map(str, range(100, 140)), *["x", None] * 40]
    rows = spark.createDataFrame([(t, str(i)) for i, t in enumerate(texts)], "id string, n string")
    rows = rows.withColumn("_extra", F.create_map(F.lit("a"), "n"))
    parts = [[(r.id, r.n) for r in part.collect()] for part in silver.key_slices(rows, 4)]
    assert sorted(n for part in parts for _, n in part) == sorted(map(str, range(len(texts))))
    assert sum(any(n in ("0", "1", "2") for _, n in part) for part in parts) == 1
    assert all(any(i is None for i, _ in part) for part in parts)


def test_slices_follow_the_size():
    assert [session.slice_depth(s << 20) for s in (0, 100, 512, 513, 1025, 4096, 1 << 30)] == [0, 0, 0, 1, 2, 3, 4]
