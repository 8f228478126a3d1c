"""Silver and marts that follow the exports day by day."""

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from opsmart.contracts import silver_schema
from opsmart.operators.latest import Order
from opsmart.plans import dims, gold_tickets, incremental, silver
from opsmart.sources import lake, merged

ORDER = Order("k", ["v"], ["t"])
SCHEMA = "k long, v int, t string, ingestion_date date"


def rows_of(df):
    return sorted(map(tuple, df.drop("gold_kpi_build_ts").collect()), key=str)


def newest(rows):
    best = {}
    for k, v, t, d in rows:
        if k is None:
            best[(None, d, t, v, len(best))] = (k, v, t, d)
            continue
        new, old = (v is not None, v or 0, t), best.get(k)
        if old is None or new > (old[1] is not None, old[1] or 0, old[2]):
            best[k] = (k, v, t, d)
    return sorted(best.values(), key=str)


def day(spark, rows):
    return spark.createDataFrame(rows, "k long, v int, t string, d string").select("k", "v", "t", F.to_date("d").alias("ingestion_date"))


def test_merging_days_equals_one_rebuild(spark, folder):
    pick = random.Random(3)
    path, every = f"{folder}/t", []
    for d in ("2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"):
        rows = [
            (pick.choice([None, *range(40)]), pick.choice([None, 1, 2, 3, 4, 5]), pick.choice("abc"), d)
            for _ in range(60)
        ]
        every += rows
        merged.merge_newest(day(spark, rows), path, ORDER, [d], buckets=8)
        got = [(k, v, t, str(x)) for k, v, t, x in rows_of(lake.read_table(spark, path))]
        assert sorted(got, key=str) == newest(every)
    assert merged.merged_days(spark, path) == ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]
    merged.merge_newest(day(spark, rows), path, ORDER, [d])  # the last day again
    got = [(k, v, t, str(x)) for k, v, t, x in rows_of(lake.read_table(spark, path))]
    assert sorted(got, key=str) == newest(every)
    assert lake.read_table(spark, path).columns == ["k", "v", "t", "ingestion_date"]


def test_rows_known_to_be_single_are_not_reduced_again(spark, folder, monkeypatch):
    calls, newest_of = [], merged._newest
    monkeypatch.setattr(merged, "_newest", lambda *a: calls.append(1) or newest_of(*a))
    rows = [(k, 1, "a", "2024-01-01") for k in range(30)] + [(None, 1, "a", "2024-01-01")] * 3
    merged.merge_newest(day(spark, rows), f"{folder}/t", ORDER, ["2024-01-01"], buckets=8, single=True)
    assert not calls and lake.read_table(spark, f"{folder}/t").count() == 33
    later = [(k, 2, "b", "2024-01-02") for k in range(20, 40)]
    merged.merge_newest(day(spark, later), f"{folder}/t", ORDER, ["2024-01-02"], single=True)
    got = {(k, v) for k, v, *_ in rows_of(lake.read_table(spark, f"{folder}/t")) if k is not None}
    assert len(calls) == 1 and got == {(k, 1) for k in range(20)} | {(k, 2) for k in range(20, 40)}


def test_untouched_buckets_are_neither_read_nor_written(spark, folder):
    path = f"{folder}/t"
    merged.merge_newest(day(spark, [(i, 1, "a", "2024-01-01") for i in range(200)]), path, ORDER, ["2024-01-01"], buckets=16)
    before = set(lake.read_table(spark, path).inputFiles())
    touched = merged.merge_newest(day(spark, [(7, 2, "b", "2024-01-02")]), path, ORDER, ["2024-01-02"])
    after = set(lake.read_table(spark, path).inputFiles())
    assert len(touched) == 1
    stays = {f for f in before if f"_bucket={touched[0]}/" not in f}
    assert stays < after and len(after - before) == 1
    # A bucket that is not touched need not even be readable.
    for file in stays:
        Path(file.removeprefix("file://")).write_bytes(b"broken")
    assert merged.merge_newest(day(spark, [(7, 3, "c", "2024-01-03")]), path, ORDER, ["2024-01-03"]) == touched
    mark = lake.read_mark(spark, lake.last_versions(spark, path, 1)[0])
    out = lake.read_parts(spark, path, mark, map(str, touched)).where("k = 7")
    assert [(r.k, r.v, r.t) for r in out.collect()] == [(7, 3, "c")]


def test_a_failed_merge_changes_nothing(spark, folder):
    path = f"{folder}/t"
    merged.merge_newest(day(spark, [(1, 1, "a", "2024-01-01")]), path, ORDER, ["2024-01-01"], buckets=4)
    bad = day(spark, [(1, 2, "b", "2024-01-02")]).withColumn("t", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        merged.merge_newest(bad, path, ORDER, ["2024-01-02"])
    assert [r.t for r in lake.read_table(spark, path).collect()] == ["a"]
    assert merged.merged_days(spark, path) == ["2024-01-01"]


def test_changes_of_the_last_merge(spark, folder):
    path = f"{folder}/t"
    first = [(1, 1, "a", "2024-01-01"), (2, 5, "b", "2024-01-01"), (None, 1, "n", "2024-01-01")]
    merged.merge_newest(day(spark, first), path, ORDER, ["2024-01-01"], buckets=4)
    assert len(rows_of(merged.changes(spark, path, "k"))) == 3
    second = [(1, 2, "c", "2024-01-02"), (2, 4, "older", "2024-01-02"), (3, 1, "d", "2024-01-02"), (None, 1, "m", "2024-01-02")]
    merged.merge_newest(day(spark, second), path, ORDER, ["2024-01-02"])
    found = sorted((r.t, r._sign) for r in merged.changes(spark, path, "k").collect())
    assert found == [("a", -1), ("c", 1), ("d", 1), ("m", 1)]
    merged.merge_newest(day(spark, [(None, 1, "o", "2024-01-02")]), path, ORDER, ["2024-01-02"])  # the day again, corrected
    assert sorted((r.t, r._sign) for r in merged.changes(spark, path, "k").collect()) == [("m", -1), ("o", 1)]


def ticket(i, created, updated, technician=1, status=1, solved=None, **more):
    return {"id": str(i), "date_creation": created, "date_mod": updated, "users_id_lastupdater": technician,
            "status": str(status), "priority": "5", "solvedate": solved, "itilcategories_id": 1, **more}


DAYS = {
    "2024-03-01": [
        ticket(1, "2024-01-05 08:00:00", "2024-01-05 08:00:00"),
        ticket(2, "2024-02-05 08:00:00", "2024-02-05 08:00:00", technician=2),
        ticket(3, "2024-02-06 08:00:00", "2024-02-06 08:00:00", technician=None),
        ticket(4, None, "2024-02-06 08:00:00", technician=9_000_000_000),
        ticket("null", "2024-02-07 08:00:00", "2024-02-07 08:00:00"),
    ],
    "2024-03-02": [  # ticket 1 was the only one of January; 3 moves to April and is solved
        ticket(1, "2024-03-05 08:00:00", "2024-03-05 08:00:00", technician=2, status=5),
        ticket(3, "2024-04-06 08:00:00", "2024-04-06 08:00:00", technician=2, solved="2024-04-07 08:00:00"),
    ],
    "2024-03-03": [
        ticket(2, "2024-02-05 08:00:00", "2024-02-01 08:00:00", technician=7),  # older than what is there
        ticket(5, "2023-12-31 23:00:00", "2024-03-03 08:00:00", technician=1, status=2),
    ],
}


@pytest.fixture
def roots(spark, folder):
    out = {n: f"{folder}/{n}" for n in ("landing", "bronze", "silver", "gold")}
    dims.write_code_tables(spark, out["silver"])
    users = spark.createDataFrame([(1, "a", "A"), (2, "b", "B")], "user_id long, user_name string, full_name string")
    lake.replace_snapshot(users, f"{out['silver']}/users")
    return out


def export(spark, roots, d):
    from opsmart.plans import jobs

    target = Path(roots["landing"]) / "tickets" / f"ingestion_date={d}"
    target.mkdir(parents=True)
    (target / "a.json").write_text("\n".join(json.dumps(r) for r in DAYS[d]))
    jobs.ingest(spark, "tickets", roots["landing"], roots["bronze"])


def rebuilt(spark, roots):
    """The marts formed from all of silver."""
    tickets = lake.read_table(spark, f"{roots['silver']}/tickets")
    codes = {t: lake.read_table(spark, f"{roots['silver']}/{t}") for t in dims.code_tables()}
    users = lake.read_table(spark, f"{roots['silver']}/users")
    return incremental.ticket_marts(dict.fromkeys(gold_tickets.STATES, tickets), users, codes)


def test_marts_follow_the_days(spark, roots):
    touched = []
    for d in DAYS:
        export(spark, roots, d)
        assert incremental.merge_silver(spark, "tickets", roots["bronze"], roots["silver"], buckets=4)["days"] == [d]
        touched.append(incremental.refresh_ticket_marts(spark, roots["silver"], roots["gold"]))
        for name, whole in rebuilt(spark, roots).items():
            mart = lake.read_table(spark, f"{roots['gold']}/tickets/{name}")
            assert rows_of(mart) == rows_of(whole.select(mart.columns)), (d, name)
    # Only months that a changed ticket left or entered are written.
    assert touched[1]["status"] == ["2024-01", "2024-02", "2024-03", "2024-04"]
    assert touched[2]["status"] == ["2023-12"]
    months = {r.period for r in lake.read_table(spark, f"{roots['gold']}/tickets/kpi_tickets_by_month").collect()}
    assert months == {"2023-12", "2024-02", "2024-03", "2024-04"}
    again = incremental.merge_silver(spark, "tickets", roots["bronze"], roots["silver"])
    assert again == {"days": [], "buckets": []}
    assert set(map(tuple, incremental.refresh_ticket_states(spark, roots["silver"], f"{roots['gold']}/ticket_states").values())) == {()}


def test_states_that_missed_a_merge_are_rebuilt(spark, roots):
    for d in DAYS:
        export(spark, roots, d)
        incremental.merge_silver(spark, "tickets", roots["bronze"], roots["silver"], buckets=4)
        if d != "2024-03-02":
            incremental.refresh_ticket_marts(spark, roots["silver"], roots["gold"])
    for name, whole in rebuilt(spark, roots).items():
        mart = lake.read_table(spark, f"{roots['gold']}/tickets/{name}")
        assert rows_of(mart) == rows_of(whole.select(mart.columns)), name


def test_every_keyed_entity_has_an_order():
    for entity in silver.KEYS:
        order = silver.order_of(entity)
        assert {order.key, *order.newest, *order.ties} == set(silver_schema(entity).names) - {"_ingest_silver_ts"}
    with pytest.raises(ValueError, match="no key"):
        silver.order_of("space_repartition")
