import math
import random
from collections import Counter

import numpy as np
import pytest

from opsmart.llm import mixing


def frame(spark, sizes):
    rows = [(i * 1000 + j, s) for i, (s, n) in enumerate(sizes.items()) for j in range(n)]
    return spark.createDataFrame(rows, "doc_id long, source string")


def brute_schedule(weights):
    """(weight, number in its class, turn) of every slot, by looking at every source."""
    cycle, taken, out = sum(weights), [0] * len(weights), []
    member = [sum(v == w for v in weights[:i]) for i, w in enumerate(weights)]
    for t in range(cycle):
        ready = [
            (math.ceil((taken[i] + 1) * cycle / w), w, member[i], i)
            for i, w in enumerate(weights)
            if taken[i] < w and taken[i] * cycle // w <= t
        ]
        i = min(ready)[3]
        out.append((weights[i], member[i], taken[i]))
        taken[i] += 1
    return out


def slots_of(spark, weights):
    rows = [(f"1s{i:05}", 10, w) for i, w in enumerate(weights)]
    found = mixing.schedule(spark.createDataFrame(rows, "key string, n long, weight long")).collect()
    out = {}
    for r in found:
        for j in range(r["count"]):
            assert r.slot + j not in out
            out[r.slot + j] = (r.weight, r.first + j, r.turn)
    return [out[t] for t in range(sum(weights))], len(found)


def deviation(weights, slots):
    """How far any source ever stands from its share, in blocks."""
    index, seen = {}, Counter()
    for i, w in enumerate(weights):
        index[w, seen[w]] = i
        seen[w] += 1
    share, taken, worst = np.array(weights) / sum(weights), np.zeros(len(weights)), 0
    for t, (w, member, _) in enumerate(slots, 1):
        taken[index[w, member]] += 1
        worst = max(worst, np.abs(taken - share * t).max())
    return worst


@pytest.mark.parametrize("weights", [[1], [3, 1], [5, 3, 2], [50, 5, 5, 5, 5, 5, 5, 5, 5, 5, 5], [7, 11, 13, 1], [1, 1, 1, 1, 2, 2, 100]])
def test_schedule_is_earliest_deadline_first_within_a_block(spark, weights):
    slots, _ = slots_of(spark, weights)
    assert slots == brute_schedule(weights)
    assert deviation(weights, slots) < 1


@pytest.mark.parametrize("sources", [201, 1000])
def test_any_number_of_sources_stays_within_a_block(spark, sources):
    pick = random.Random(sources)
    weights = [pick.choice([1, 1, 2, 3, 7, 11, 30, 64, 100]) for _ in range(sources)]
    slots, segments = slots_of(spark, weights)
    assert segments <= 2 * sum(set(weights))
    assert deviation(weights, slots) < 1
    if sources < 500:
        assert slots == brute_schedule(weights)


def test_every_weight_at_once(spark):
    weights = list(range(1, 101)) * 3
    slots, segments = slots_of(spark, weights)
    assert segments <= 2 * 5050 and deviation(weights, slots) < 1


def test_every_row_has_one_place(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 40)
    docs = frame(spark, {"big": 300, "mid": 90, None: 33, "one": 1})
    out = sorted(mixing.mixed(docs, block=4).collect(), key=lambda r: r.position)
    assert [r.position for r in out] == list(range(424))
    assert [r.slot for r in out] == sorted(r.slot for r in out)
    weights = {r.key: r.weight for r in mixing.tempered_weights(docs).collect()}
    cycle, taken, seen = sum(weights.values()), Counter(), 0
    for r in out:
        if not r.in_ratio:
            break
        taken[r.source] += 1
        seen += 1
    for source, count in taken.items():
        key = "0" if source is None else "1" + source
        assert abs(count / 4 - weights[key] * seen / 4 / cycle) < 2
    assert any(r.in_ratio for r in out) and not out[-1].in_ratio


@pytest.mark.parametrize("sources", [230, 1001])
def test_rows_of_any_number_of_sources(spark, sources):
    sizes = {f"s{i:04}": 3 + 40 * (i % 7 == 0) for i in range(sources)} | {None: 60}
    docs = frame(spark, sizes)
    out = sorted(mixing.mixed(docs, block=2).collect(), key=lambda r: r.position)
    assert [r.position for r in out] == list(range(sum(sizes.values())))
    assert [r.slot for r in out] == sorted(r.slot for r in out)
    assert len({r.doc_id for r in out}) == len(out) and len({r.slot for r in out}) == len({(r.source, r.block) for r in out})
    assert any(r.in_ratio for r in out) and not out[-1].in_ratio
    weights = {r.key: r.weight for r in mixing.tempered_weights(docs).collect()}
    cycle, blocks, done = sum(weights.values()), {}, Counter()
    for r in out:
        blocks.setdefault(r.source, []).append(r.block)
        if r.in_ratio and r.block == done[r.source]:
            done[r.source] += 1
            key = "0" if r.source is None else "1" + r.source
            assert abs(done[r.source] - weights[key] * (r.slot + 1) / cycle) < 1
    assert all(b == sorted(b) for b in blocks.values())


def test_edges(spark):
    docs = frame(spark, {"a": 3}).selectExpr("*", "'x' AS text", "1 AS slot", "2 AS n")
    repeated = docs.unionByName(docs).unionByName(docs.selectExpr("CAST(NULL AS LONG) doc_id", "source", "text", "slot", "n"))
    assert sorted(r.position for r in mixing.mixed(repeated).collect()) == list(range(9))
    assert mixing.ordered(repeated).columns == docs.columns
    assert mixing.mixed(docs.limit(0)).count() == 0 and mixing.ordered(docs.limit(0)).count() == 0
    assert mixing.mixed(docs.limit(0)).columns == ["doc_id", "source", "text", "n", *mixing.ADDED]


HELPERS = [
    "key", "hash", "row", "range", "rank", "weight", "member", "turn", "round", "runs", "first", "count", "number", "offset",
    "before", "rows", "size", "sources", "cycle", "_range", "_hash", "_slot", "_key", "_rank", "a.b", "n", "own", "found", "t",
]


def test_no_name_of_a_column_matters(spark):
    docs = frame(spark, {"a": 40, "b": 9, None: 3}).selectExpr("*", "CAST(doc_id AS STRING) AS text")
    extra = docs.selectExpr("*", *[f"'{i}' AS `{name}`" for i, name in enumerate(HELPERS)])
    plain = {r.doc_id: r for r in mixing.mixed(docs, block=4).collect()}
    out = mixing.mixed(extra, block=4)
    assert out.columns == [*extra.columns, *mixing.ADDED]
    for r in out.collect():
        assert [r[name] for name in HELPERS] == [str(i) for i in range(len(HELPERS))]
        assert [r[c] for c in mixing.ADDED] == [plain[r.doc_id][c] for c in mixing.ADDED]
    kept = mixing.ordered(extra).collect()
    assert [r.doc_id for r in kept] == [r.doc_id for r in mixing.ordered(docs).collect()]
    assert kept[0][len(docs.columns) :] == tuple(str(i) for i in range(len(HELPERS)))


def test_rows_without_id_are_spread_by_their_text(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 10)
    docs = spark.range(500).selectExpr("CAST(NULL AS LONG) doc_id", "'a' AS source", "CAST(id AS STRING) AS text")
    out = mixing.mixed(docs).collect()
    assert sorted(r.position for r in out) == list(range(500)) and len({r.text for r in out}) == 500
