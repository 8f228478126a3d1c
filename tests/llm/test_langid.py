import zlib

import numpy as np

from opsmart.llm import langid


def test_gradient():
    pick = np.random.default_rng(0)
    network = langid.Network(["a", "b", "c"], units=4, seed=1)
    for layer in (network.forward, network.backward):
        layer.weights = {k: v.astype(np.float64) for k, v in layer.weights.items()}
    x, y = pick.integers(0, 256, (4, 9)).astype(np.uint8), np.array([0, 1, 2, 1])

    def loss():
        p = network.probabilities(x).astype(float)
        return -np.log(p[:, np.arange(4), y]).mean()

    slope = network.probabilities(x).astype(float)
    slope[:, np.arange(4), y] -= 1
    slope /= slope.shape[0] * slope.shape[1]
    for layer, order in ((network.forward, range(9)), (network.backward, range(8, -1, -1))):
        grad = layer.gradient(x, order, slope.__getitem__)
        for name, at in (("back", (1, 5)), ("out", (2, 1)), ("by_byte", (x[0, 3], 2))):
            held = layer.weights[name][at]
            ends = []
            for step in (0.03, -0.03):
                layer.weights[name][at] = held + step
                ends.append(loss())
            layer.weights[name][at] = held
            assert abs((ends[0] - ends[1]) / 0.06 - grad[name][at]) < 2e-4


def rows():
    words = {"en": "the house and water of light", "de": "das Haus und Wasser schöner Straße", "es": "la casa y agua señor niño"}
    out = []
    for i in range(240):
        lang = ("en", "de", "es")[i % 3]
        own = words[lang].split()
        out.append((i, " ".join(own[(i * 7 + k * (1 + i % 5)) % len(own)] for k in range(40)), lang))
    return out


def test_held_out_accuracy_and_edges(spark, monkeypatch):
    monkeypatch.setattr(langid, "STEPS", 120)
    extra = [(900, None, "en"), (901, "", "en"), (902, "12 34 !?", "de"), (903, "the house " * 3000, None), (None, "the house and", "es")]
    df = spark.createDataFrame(rows() + extra, "doc_id long, text string, lang string").selectExpr("*", "1 AS score")
    out = {r.doc_id: r for r in langid.identified(df, langid.learned(df)).collect()}
    lang = {i: l for i, _, l in rows()}
    held = [i for i in lang if out[i].held_out]
    assert held == [i for i in lang if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([out[i].lang_pred == lang[i] for i in held]) > 0.95
    assert [(out[i].lang_pred, out[i].score) for i in (900, 901, 902)] == [("und", 0.0)] * 3
    assert out[903].lang_pred == "en" and 0 <= out[903].score <= 1 and not out[None].held_out
    assert langid.identified(df.limit(0), langid.learned(df.limit(0))).count() == 0
    assert {r.lang_pred for r in langid.identified(df, langid.learned(df.limit(0))).collect()} == {"und"}


def test_learning_uses_no_held_out_row(spark):
    df = spark.createDataFrame(rows(), "doc_id long, text string, lang string")
    marked = df.selectExpr("doc_id", "IF(crc32(CAST(doc_id AS STRING)) % 4 = 2, 'ZZZZ', text) AS text", "lang")
    assert all(b"ZZZZ" not in bytes(r[1]) for r in langid.sample(marked).collect())


def test_every_language_is_learned(spark, monkeypatch):
    monkeypatch.setattr(langid, "STEPS", 40)
    monkeypatch.setattr(langid, "LANGUAGES", 4)
    pick = np.random.default_rng(5)
    # Nine languages over a bound of four; the last code is the most frequent.
    rows, letters = [], "abcdefghijklmnopqrstuvwxyzäö"
    for i in range(500):
        k = 8 if i % 2 else i // 2 % 8
        own = letters[3 * k : 3 * k + 4]
        rows.append((i, " ".join("".join(pick.choice(list(own), 5)) for _ in range(30)), f"l{k}"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(langid, "TRAIN_DOCS", 30)
    network = langid.learned(df)
    assert network.classes == [f"l{k}" for k in range(9)]
    lang = {i: l for i, _, l in rows}
    out = [r for r in langid.identified(df, network).collect() if r.held_out]
    assert {r.lang_pred for r in out} == set(network.classes)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in out]) > 0.9


def test_the_sample_stays_bounded():
    for n in (1, 4, 64, 65, 200, 960):
        assert n * langid.docs_of_each(n) <= langid.LANGUAGES * langid.TRAIN_DOCS
    assert langid.docs_of_each(64) == langid.TRAIN_DOCS and langid.docs_of_each(5000) == langid.LEAST_DOCS
    assert langid.steps_for(4) == langid.STEPS and langid.units_for(40) == langid.UNITS


def test_the_sample_is_bounded_under_repeated_rows(spark):
    rows = [(i, "plain words of a text " * 20, "en" if i % 2 else "de") for i in range(40)] + [(2, "again and again " * 30, "de")] * 5000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = langid.sample(docs).count()
    ids = docs.filter(~langid.held_out()).select("doc_id").distinct().count()
    assert 0 < found <= ids * langid.TRAIN_WINDOWS


def test_a_text_of_many_megabytes():
    network = langid.Network(["de", "en"], 4)
    text = "ein langer Text " * 300_000  # 4.8 MB
    (lang, score), (short, _) = langid.predict(network, [text, "ein langer Text"])
    assert lang in ("de", "en") and short in ("de", "en") and 0 <= score <= 1
