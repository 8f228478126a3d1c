"""Column expressions on edge rows."""

import datetime as dt

import pytest
from conftest import one_column
from pyspark.sql import functions as F

from opsmart.functions import facility, numbers, people, text, times


def test_norm_and_missing(spark):
    values = ["  Ab ", "", "  ", "-", " - ", None, "a-b"]
    assert one_column(spark, text.norm, values) == ["ab", "", "", "-", "-", None, "a-b"]
    assert one_column(spark, text.is_missing, values) == [False, True, True, True, True, True, False]


def test_clean_text_and_clean_str(spark):
    values = ["  Ab ", "", " - ", None]
    assert one_column(spark, text.clean_text, values) == ["ab", None, None, None]
    assert one_column(spark, lambda c: text.clean_text(c, "n/a"), values) == ["ab", "n/a", "n/a", "n/a"]
    assert one_column(spark, text.clean_str, values) == ["Ab", None, "-", None]


def test_first_match_takes_the_first_rule(spark):
    def grade(c):
        return text.first_match([(c > 2, "big"), (c > 1, "mid")], F.lit("low"))

    assert one_column(spark, grade, [3, 2, 1, None], "int") == ["big", "mid", "low", "low"]


def test_relabel_prefix_suffix_infix(spark):
    def label(c):
        return text.relabel(c, prefixes={"a": "P"}, suffixes={"z": "S"}, infixes={"m": "I"})

    assert one_column(spark, label, ["Abz", "bZ", "xmx", " Q ", None]) == ["P", "S", "I", "q", None]


def test_label_or(spark):
    assert one_column(spark, lambda c: text.label_or(c, "none"), ["a", "", None]) == ["a", "none", "none"]


def test_natural_key_keeps_null_parts_apart(spark):
    df = spark.createDataFrame([("a", None, "c"), ("a", "c", None)], "p string, q string, r string")
    parts = [F.col(c) for c in "pqr"]
    safe = [r[0] for r in df.select(text.natural_key(*parts)).collect()]
    joined = [r[0] for r in df.select(text.natural_key(*parts, null_marker=None)).collect()]
    assert safe == ["a|∅|c", "a|c|∅"]
    assert joined == ["a|c", "a|c"]


def test_to_int(spark):
    values = [" 3 ", "null", "NULL", "2,5", "9.5", "abc", "", "-", "-4", "99999999999", None]
    expected = [3, None, None, 2, 9, None, None, None, -4, None, None]
    assert one_column(spark, numbers.to_int, values) == expected


def test_to_long_is_exact(spark):
    values = ["9007199254740993", "null", " 7 ", "x", None, "12.0", "1e3", "12,0", "99999999999999999999"]
    expected = [9007199254740993, None, 7, None, None, 12, 1000, 12, None]
    assert one_column(spark, numbers.to_long, values) == expected


def test_to_double(spark):
    values = ["9,5", " 9.5 ", "-", "", "null", "x", None]
    assert one_column(spark, numbers.to_double, values) == [9.5, 9.5, None, None, None, None, None]


def test_is_one(spark):
    values = ["1", "0", "2", "x", None, "1.0"]
    assert one_column(spark, numbers.is_one, values) == [True, False, False, None, None, True]


@pytest.mark.parametrize(
    ("part", "whole", "expected"),
    [(5, 10, 50.0), (None, 10, 0.0), (5, 0, None), (5, None, None), (15, 10, 150.0)],
)
def test_percent_of(spark, part, whole, expected):
    df = spark.createDataFrame([(part, whole)], "p int, w int")
    assert df.select(numbers.percent_of(F.col("p"), F.col("w"))).first()[0] == expected


def test_percent_of_negative_whole(spark):
    df = spark.createDataFrame([(5, -10.0)], "p int, w double")
    row = df.select(
        numbers.percent_of(F.col("p"), F.col("w")), numbers.percent_of(F.col("p"), F.col("w"), True)
    ).first()
    assert tuple(row) == (-50.0, None)


def test_ratio_guards(spark):
    df = spark.createDataFrame([(1, 4), (1, 0), (1, None)], "p int, w int")
    guarded = df.select(numbers.ratio(F.col("p"), F.col("w")), numbers.ratio(F.col("p"), F.col("w"), 0.0))
    assert [tuple(r) for r in guarded.collect()] == [(0.25, 0.25), (None, 0.0), (None, 0.0)]


def test_exact_sum_does_not_depend_on_partitioning(spark):
    rows = [(i * 0.1,) for i in range(1000)]
    sums = set()
    for n in (1, 3, 7):
        df = spark.createDataFrame(rows, "x double").repartition(n)
        sums.add(df.agg(numbers.exact_sum(F.col("x"))).first()[0])
    assert sums == {49950.0}


def test_exact_avg_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert df.agg(numbers.exact_avg(F.col("x"))).first()[0] is None


def test_exact_sum_leaves_out_what_is_no_number(spark):
    df = spark.createDataFrame([(1.5,), (float("nan"),), (float("inf"),), (None,), (2.0,)], "x double")
    row = df.agg(numbers.exact_sum(F.col("x")), numbers.exact_avg(F.col("x"))).first()
    assert tuple(row) == (3.5, 1.75)
    assert df.agg(numbers.not_finite(F.col("x"))).first()[0] == 2


def test_exact_sum_keeps_large_values(spark):
    df = spark.createDataFrame([(2e18,), (1.0,), (1e30,), (-1e30,)], "x double")
    assert df.agg(numbers.exact_sum(F.col("x"))).first()[0] == 2e18 + 1


def test_parse_ts(spark):
    values = ["2024-01-31 10:20:30", "0000-00-00 00:00:00", "", "x", None]
    stamp = dt.datetime(2024, 1, 31, 10, 20, 30)
    assert one_column(spark, times.parse_ts, values) == [stamp, None, None, None, None]
    iso = ["2024-01-31T10:20:30", "2024-01-31", "0000-00-00 00:00:00"]
    assert one_column(spark, lambda c: times.parse_ts(c, None), iso) == [stamp, dt.datetime(2024, 1, 31), None]


@pytest.mark.parametrize(
    ("start", "end", "hours", "is_reversed"),
    [
        ("2024-01-01 08:00:00", "2024-01-01 08:30:00", 0.5, False),
        ("2024-01-01 08:00:00", "2024-01-01 08:00:00", 0.0, False),
        ("2024-01-01 08:00:00", "2024-01-01 07:59:59", None, True),
        (None, "2024-01-01 07:59:59", None, False),
        ("2024-01-01 08:00:00", None, None, False),
    ],
)
def test_durations(spark, start, end, hours, is_reversed):
    df = spark.createDataFrame([(start, end)], "s string, e string").select(
        F.col("s").cast("timestamp").alias("s"), F.col("e").cast("timestamp").alias("e")
    )
    s, e = F.col("s"), F.col("e")
    row = df.select(times.hours_between(s, e), times.is_reversed(s, e)).first()
    assert tuple(row) == (hours, is_reversed)


def test_window_label_wraps(spark):
    labels = one_column(spark, times.window_label, [0, 9, 22, 23, None], "int")
    assert labels == ["00:00-02:00", "09:00-11:00", "22:00-00:00", "23:00-01:00", None]


def test_login_names(spark):
    values = ["john.doe@x.y", "admin", "a.b.c@x", "john.", ".doe", None]
    names = one_column(spark, people.display_name, values)
    assert names == ["DOE John", "Admin", "B A", " John", "DOE ", None]
    assert one_column(spark, lambda c: people.login_parts(c)[1], values) == ["doe", None, "b", "", "doe", None]


def test_floor_label(spark):
    values = ["1èr étage", "2ème", " 9ème Nord", "RDC", "Autre ", None]
    assert one_column(spark, facility.floor_label, values) == [
        "premier étage", "deuxième étage", "neuvième étage", "rez de chaussée", "autre", None,
    ]


def test_room_label(spark):
    values = ["Salle 201", "S24", "bureau 112", "S25", "salle 00", "Open Space A", "Grande terrasse",
              "une petite terrasse", "Tesrrasse C", "Accueil", "1", None]
    assert one_column(spark, facility.room_label, values) == [
        "salle 01", "salle 24", "salle 12", "s25", "salle 00", "open space", "grande terrasse",
        "petite terrasse", "terrasse", "accueil", "1", None,
    ]


def test_organization_and_space_type(spark):
    values = ["Le CoStorage 2", "-", "", None, "Company "]
    assert one_column(spark, facility.organization_type_label, values) == [
        "costorage", "n/a", "n/a", "n/a", "company",
    ]
    space = one_column(spark, lambda c: facility.space_type_label(c, F.lit(" Loué ")), ["Bureau", "-", None])
    assert space == ["bureau", "loué", "loué"]


def test_item_label(spark):
    values = ["Salle COSY (S-4)", "Salle COSY  (S4)", "Open–Space (s 15) ", "A-B room", "(S4)",
              "A - B", "Room (X4)", "A-B-C", None]
    assert one_column(spark, facility.item_label, values) == [
        "Salle COSY - Salle 4", "Salle COSY - Salle 4", "Open Space - Salle 15", "A B room",
        "- Salle 4", "A - B", "Room (X4)", "A B C", None,
    ]


def test_occupancy_band(spark):
    rates = [101.0, 100.0, 40.0, 39.9, None]
    assert one_column(spark, facility.occupancy_band, rates, "double") == [
        "red", "green", "green", "amber", "green",
    ]


def test_status_tests(spark):
    values = ["Loué", " non loué ", "Réservation", "Par personne"]
    assert one_column(spark, lambda c: facility.has_status(c, exactly="loué"), values) == [True, False, False, False]
    assert one_column(spark, lambda c: facility.has_status(c, mentions="réser"), values) == [False, False, True, False]


def test_stamp_text(spark):
    stamps = [dt.datetime(2024, 1, 31, 10, 0, 0), None]
    assert one_column(spark, text.stamp_text, stamps, "timestamp") == ["2024-01-31 10:00:00+00", None]
