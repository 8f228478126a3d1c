"""Building blocks on small frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from opsmart.operators import audit, latest, lookup, rollup, select

ROWS = [
    (1, "2024-01-05 00:00:00", "a", 10),
    (2, "2024-01-06 00:00:00", "a", 10),
    (3, "2024-02-01 00:00:00", "b", 11),
    (4, None, "b", None),
    (5, "2024-02-02 00:00:00", None, 10),
]


@pytest.fixture
def facts(spark):
    df = spark.createDataFrame(ROWS, "id int, ts string, k string, who int")
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_latest_per_key_orders_nulls_last_and_breaks_ties(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", None, "y"), ("b", None, "x"), ("b", None, "z"), (None, 1, "q")],
        "k string, v int, t string",
    )
    assert rows(latest.latest_per_key(df, ["k"], ["v"], ["t"])) == [
        (None, 1, "q"), ("a", 1, "x"), ("b", None, "z"),
    ]


def test_latest_per_key_several_rows(spark):
    df = spark.createDataFrame([("a", i) for i in range(5)], "k string, v int")
    assert rows(latest.latest_per_key(df, ["k"], ["v"], rows=2)) == [("a", 3), ("a", 4)]


def test_attach_keeps_every_fact_row(spark):
    fact = spark.createDataFrame([(1, 1), (2, 1), (3, 9), (4, None)], "id int, k int")
    dim = spark.createDataFrame([(1, "one"), (2, "two")], "k int, name string")
    expected = [(1, "one"), (2, "one"), (3, None), (4, None)]
    for salts in (1, 4):
        out = lookup.attach(fact, dim, "k", salts)
        assert rows(out.select("id", "name")) == expected
        assert out.columns == ["k", "id", "name"]


def test_period_rollup_keeps_all_and_drops_null_period(facts):
    out = rollup.period_rollup(facts, "ts", ["k"])
    assert rows(out) == [
        ("2024-01", "a", 2), ("2024-02", None, 1), ("2024-02", "b", 1),
        ("ALL", None, 1), ("ALL", "a", 2), ("ALL", "b", 2),
    ]


def test_period_rollup_counts_distinct_at_both_grains(facts):
    out = rollup.period_rollup(
        facts, "ts", sums={"n": F.count(F.lit(1))}, distinct={"people": "who"}, keep_null_period=True
    )
    assert rows(out) == [(None, 1, 0), ("2024-01", 2, 1), ("2024-02", 2, 2), ("ALL", 5, 2)]


def test_states_stand_for_their_rows(facts):
    states = rollup.by_month(facts, "ts", ["k", "who"], ticket_count=F.count(F.lit(1)))
    one, two = rollup.period_rollup(facts, "ts", ["k"]), rollup.period_rollup(states, "ts", ["k"])
    assert rows(one) == rows(two.select(one.columns))


def test_distinct_ids_of_any_size(spark):
    ids = [0, 1, -1, -40_000, 32_768, 32_769, 1 << 33, (1 << 62) + 5, -(1 << 62), None]
    values = [(f"2024-0{i % 2 + 1}-01 00:00:00", v) for i, v in enumerate(ids * 3)]
    df = spark.createDataFrame(values, "ts string, who long").withColumn("ts", F.col("ts").cast("timestamp"))
    out = rollup.period_rollup(df, "ts", sums={"n": F.count(F.lit(1))}, distinct={"people": "who"})
    assert rows(out) == [("2024-01", 15, 5), ("2024-02", 15, 4), ("ALL", 30, 9)]
    totals = rollup.distinct_totals(df.withColumn("half", F.col("who") % 2), {"a": "who", "b": "half"}, {"n": F.count(F.lit(1))})
    assert rows(totals) == [(30, 9, 3)]
    assert rows(rollup.distinct_totals(df.limit(0), {"a": "who"}, {"n": F.count(F.lit(1))})) == [(None, 0)]


def test_distinct_ids_are_not_shuffled_one_by_one(spark):
    df = spark.range(100_000).selectExpr("timestamp'2024-01-01 00:00:00' + make_interval(0, id % 5) AS ts", "id AS who")
    out = rollup.period_rollup(df, "ts", sums={"n": F.count(F.lit(1))}, distinct={"people": "who"})
    plan = out._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert shuffles and not any("who" in line.replace("_bucket_people", "") for line in shuffles)
    assert {(r.period, r.people) for r in out.collect()} == {("2024-01", 20_000), ("2024-02", 20_000), ("2024-03", 20_000), ("2024-04", 20_000), ("2024-05", 20_000), ("ALL", 100_000)}


def test_rollup_of_nothing(facts):
    assert rows(rollup.period_rollup(facts.limit(0), "ts", ["k"])) == []


def test_shares_add_up_to_one(facts):
    shares = rollup.with_share(rollup.period_rollup(facts, "ts", ["k"]))
    assert rows(shares.groupBy("period").agg(F.sum("share"))) == [("2024-01", 1.0), ("2024-02", 1.0), ("ALL", 1.0)]
    assert rows(shares.where("period = 'ALL'").select("k", "total_tickets", "share")) == [
        (None, 5, 0.2), ("a", 5, 0.4), ("b", 5, 0.4),
    ]


def test_bucketize_edges(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 0.99, 1.0, 2.0, 4.0, 7.99, 8.0, 9.0, None)], "h double")
    bucket = rollup.bucketize(F.col("h"), (1, 2, 4, 8), ("<1h", "1-2h", "2-4h", "4-8h", ">8h"))
    assert [r[0] for r in df.select(bucket).collect()] == [
        "<1h", "<1h", "1-2h", "2-4h", "4-8h", "4-8h", ">8h", ">8h", None,
    ]
    with pytest.raises(ValueError):
        rollup.bucketize(F.col("h"), (1, 2), ("a", "b"))


def test_filter_optional(facts):
    assert select.filter_optional(facts, {"k": None, "who": None}).count() == 5
    assert select.filter_optional(facts, {"k": "a", "who": 10}).count() == 2
    assert select.filter_optional(facts, {"k": ""}).count() == 0
    assert select.filter_optional(facts, {"k": ""}, blank_is_absent=True).count() == 5
    assert select.filter_optional(facts, {"who": 0}).count() == 0


def test_limits_are_checked(facts):
    with pytest.raises(ValueError):
        select.top_k(facts, [select.asc("id")], 0)
    for n in (0, 10_001):
        with pytest.raises(ValueError):
            select.check_limit(n)
    assert select.top_k(facts, [select.asc("id")], 20_000).count() == 5


def test_seek_paging(facts):
    def ids(*args):
        return [r.id for r in select.page_after(facts, "id", *args).collect()]

    assert (ids(None, 2), ids(2, 2), ids(4, 2), ids(5, 2)) == ([1, 2], [3, 4], [5], [])
    plan = select.page_after(facts, "id", 2, 2)._jdf.queryExecution().executedPlan().toString()
    assert "offset" not in plan.lower()


def test_null_order_of_the_serving_database(facts):
    newest = select.top_k(facts, [select.desc("ts"), select.asc("id")], 2)
    assert [r.id for r in newest.collect()] == [4, 5]
    oldest = facts.orderBy(select.asc("ts"), select.asc("id"))
    assert [r.id for r in oldest.collect()] == [1, 2, 3, 5, 4]


@pytest.mark.parametrize("order", ["asc", "desc"])
@pytest.mark.parametrize("column", ["v", "f", "t"])
def test_walking_all_pages_by_any_column(spark, order, column):
    import random

    pick = random.Random(1)
    values = [(i, pick.choice([None, 1, 2, 3]), pick.choice([None, 0.5, float("nan"), -1.0]), pick.choice([None, "a", "", "b"])) for i in range(60)]
    df = spark.createDataFrame(values, "id int, v int, f double, t string")
    direction = select.asc if order == "asc" else select.desc
    whole = [r.id for r in df.orderBy(direction(column), select.asc("id")).collect()]
    walked, last = [], None
    while page := select.page_after(df, "id", last, 7, column, order).collect():
        walked += [r.id for r in page]
        last = (page[-1][column], page[-1].id)
        assert select.place_of(df, "id", last[1], column)[1] == last[1]
    assert walked == whole
    with pytest.raises(ValueError, match="no row"):
        select.place_of(df, "id", 999, column)


def test_a_seek_reaches_the_scan(spark, folder):
    df = spark.range(100).selectExpr("id", "id % 7 AS v")
    df.write.parquet(f"{folder}/t")
    out = select.page_after(spark.read.parquet(f"{folder}/t"), "id", (3, 20), 5, "v", "desc")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(LessThan(v,3),And(EqualTo(v,3),GreaterThan(id,20)))]" in plan


def test_hot_keys_are_found_and_spread(spark):
    fact = spark.range(20_000).selectExpr("id", "CASE WHEN id % 2 = 0 THEN 7 WHEN id % 11 = 0 THEN NULL ELSE id END AS k")
    dim = spark.range(20_000).selectExpr("id AS k", "concat('n', id) AS name")
    assert lookup.hot_keys(fact, "k", 0.05) == [7]
    assert lookup.hot_keys(fact.where("k IS NULL"), "k", 0.05) == [] and lookup.hot_keys(fact.limit(0), "k", 0.05) == []
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = lookup.attach_spread(fact, dim, "k", 0.05, 16)
        assert out.columns == ["k", "id", "name"]
        sizes = [r[0] for r in out.groupBy(F.spark_partition_id()).count().select("count").collect()]
        plain = [r[0] for r in lookup.attach(fact, dim, "k").groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert max(plain) > 10_000 and max(sizes) < 8000
    assert out.where("k IS NULL").count() == fact.where("k IS NULL").count()
    assert out.where("name IS NULL AND k IS NOT NULL OR name <> concat('n', k)").count() == 0 and out.count() == 20_000


def test_page(facts):
    def ids(*args):
        return [r.id for r in select.page(facts, "id", *args).collect()]

    assert ids(1, 2) == [1, 2]
    assert ids(3, 2) == [5]
    assert ids(4, 2) == []
    assert ids(1, 3, "ts", "desc") == [4, 5, 3]
    for bad in ((0, 2), (1, 0)):
        with pytest.raises(ValueError):
            ids(*bad)
    with pytest.raises(ValueError):
        ids(1, 2, "ts", "down")


def test_pivot_sum_fills_zeros(spark):
    df = spark.createDataFrame([("t", 5, 2), ("t", 5, 1), ("t", 9, 7), ("u", 6, 4)], "who string, code int, n int")
    out = select.pivot_sum(df, ["who"], "code", {6: "major", 5: "high"}, "n")
    assert rows(out) == [("t", 0, 3, 7, 10), ("u", 4, 0, 0, 4)]


def test_key_report_and_require_unique(facts):
    assert tuple(audit.key_report(facts, "k").first()) == (5, 3, 2)
    assert tuple(audit.key_report(facts.limit(0), "k").first()) == (0, 0, 0)
    audit.require_unique(facts, ["id"], "facts")
    with pytest.raises(ValueError, match="repeated key"):
        audit.require_unique(facts, ["k"], "facts")


def test_observed_counts_without_a_second_job(facts):
    out, seen = audit.observed(facts, "seen", dated=F.count("ts"))
    out.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 5, "dated": 4}


def test_counted(facts):
    assert rows(rollup.counted(facts, "who")) == [(None, 1), (10, 3), (11, 1)]
    day = rollup.counted(facts, F.to_date("ts").alias("day"), name="n").where("day is not null")
    assert rows(day)[0] == (dt.date(2024, 1, 5), 1)


def test_place_on_the_curve_by_a_few_comparisons(spark):
    """Ranks equal the number of cuts reached, NULL none, and each takes six comparisons."""
    from opsmart.operators.layout import _rank, along_curve

    cuts = [-3, 0, 0, 1, 4, 4, 9]
    df = spark.createDataFrame([(x,) for x in [None, *range(-5, 12)]], "x long")
    for r in df.select("x", _rank(F.col("x"), cuts).alias("rank")).collect():
        assert r.rank == (0 if r.x is None else sum(r.x >= c for c in cuts))
    rows = spark.range(500).selectExpr("cast(id AS string) AS month", "id % 7 AS n", "nullif(id % 5, 0) AS m")
    placed = along_curve(rows, ["month", "n", "m"])
    text = placed._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("try_cast") + text.count("replace(") <= 6
    assert placed.columns == [*rows.columns, "_curve"] and placed.count() == 500
