import numpy as np

from opsmart.llm import ann

SCHEMA = "vec_id long, embedding array<float>"


def vectors(n=1500, d=24):
    pick = np.random.default_rng(1)
    x = pick.normal(size=(n, d)).astype(np.float32)
    x[n // 2 :: 3] = x[5]  # one very common vector
    return x


def brute(x, ids, q, k):
    score = x.astype(float) @ x[q].astype(float)
    order = [i for i in np.lexsort((ids, -score)) if i != q][:k]
    return [(int(ids[i]), score[i]) for i in order]


def test_recall_ties_and_scores(spark):
    x = vectors()
    ids = np.arange(len(x))
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], SCHEMA)
    out = ann.nearest(df, df.filter("vec_id % 20 = 0"), k=20).collect()
    found = {}
    for r in sorted(out, key=lambda r: r.rank):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    hits = 0
    for q in range(0, len(x), 20):
        want = brute(x, ids, q, 20)
        assert len(found[q]) == 20 and [r for r in found[q]] == sorted(found[q], key=lambda p: (-p[1], p[0]))
        hits += len({i for i, _ in want} & {i for i, _ in found[q]})
        for i, score in found[q]:
            assert abs(score - x[q].astype(float) @ x[i].astype(float)) < 1e-9
    assert hits / (20 * len(found)) > 0.9
    common = len(x) // 2 + 3 * 10
    common = next(i for i in range(0, len(x), 20) if (x[i] == x[5]).all())
    assert [i for i, _ in found[common]] == [i for i, _ in brute(x, ids, common, 20)]


def test_blocks_give_the_same(spark, monkeypatch):
    x = vectors(400, 8)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], SCHEMA)
    asked = df.filter("vec_id % 20 = 0")
    whole = sorted(map(tuple, ann.nearest(df, asked).collect()))
    monkeypatch.setattr(ann, "BLOCK", 5)
    monkeypatch.setattr(ann, "QUERIES", 3)
    assert sorted(map(tuple, ann.nearest(df, asked).collect())) == whole


def test_edges(spark):
    rows = [
        (0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (4, []), (5, [0.0, 0.0]),
        (6, [1.0, None]), (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (9, [1.0, 2.0, 3.0]), (None, [1.0, 0.0]),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS class", "2 AS rank")
    out = ann.nearest(df, df.filter("vec_id = 0"), k=20)
    assert [(r.vec_id, r.score) for r in out.orderBy("rank").collect()] == [(2, 1.0), (1, 0.0)]
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0
    assert ann.probed(np.eye(4), 0, 2, 5).shape == (4, 5)


def test_few_vectors_are_all_found(spark):
    x = np.random.default_rng(2).normal(size=(15, 64))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], SCHEMA)
    out = ann.nearest(df, df).collect()
    for q in range(15):
        assert {r.vec_id for r in out if r.query_id == q} == set(range(15)) - {q}


def test_recall_of_each_query_outside_a_cone(spark):
    pick = np.random.default_rng(3)
    cone = pick.normal(size=(3000, 64)) * 0.3 + 2 * pick.normal(size=64)
    x = np.concatenate([pick.normal(size=(20, 64)), cone]).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = np.arange(len(x))
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], SCHEMA)
    found = {}
    for r in ann.nearest(df, df.filter("vec_id < 20 OR vec_id % 100 = 0")).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    recall = {q: len(f & {i for i, _ in brute(x, ids, q, 20)}) / 20 for q, f in found.items()}
    print("outside", np.mean([r for q, r in recall.items() if q < 20]), "all", np.mean(list(recall.values())), "least", min(recall.values()))
    assert all(len(f) == 20 for f in found.values())
    assert np.mean([r for q, r in recall.items() if q < 20]) > 0.9 and np.mean(list(recall.values())) > 0.9


def recall_of(spark, x):
    ids = np.arange(len(x))
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], SCHEMA)
    found = {}
    for r in ann.nearest(df, df.filter("vec_id % 20 = 0")).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    every = [len(f & {i for i, _ in brute(x, ids, q, 20)}) / 20 for q, f in found.items()]
    assert len(found) == -(-len(x) // 20)
    return float(np.mean(every))


def test_recall_at_any_dimension_and_norm(spark):
    pick = np.random.default_rng(5)
    norms = np.exp(0.5 * pick.normal(size=(2000, 1)))
    cases = {d: pick.normal(size=(2000, d)) for d in (16, 256, 768)} | {"norms": pick.normal(size=(2000, 64)) * norms}
    for name, x in cases.items():
        assert recall_of(spark, x.astype(np.float32)) >= 0.9, name


def test_probes_fall_as_vectors_get_nearer(spark):
    pick = np.random.default_rng(6)
    centres = pick.normal(size=(50, 32))
    fitted = []
    for spread in (0.1, 3.0):
        x = centres[pick.integers(0, 50, 2000)] + spread * pick.normal(size=(2000, 32))
        classes = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "class long, embedding array<float>")
        fitted.append(ann.fitted_probes(classes, classes.filter("class % 20 = 0"), 20, 8, 1, np.zeros(1)))
    assert 1 <= fitted[0] < fitted[1] <= 64
