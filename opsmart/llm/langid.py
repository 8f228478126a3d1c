"""Language identification by a bidirectional gated recurrent network over bytes.

A text is cut into windows of ``WINDOW`` bytes. Two gated recurrent layers read a window forwards and
backwards; at every byte their states give a probability for each language, and the mean over all
bytes of the whole text is the document's. Network and training - backpropagation through time with
Adam - are plain numpy. Training reads a bounded sample of labelled windows and runs on the driver;
prediction is a streamed map over all documents with the few thousand weights in its closure.

Learning uses only text and language of rows that are not held out; ``lang``, ``source`` and
``doc_id`` are no inputs of a prediction.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is every text
if nothing could be learned; rows without ``doc_id`` are not held out and not learned from; repeated
rows are predicted one by one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opsmart.llm.common import importable, map_rows, table

#: Bytes a window has, and units each direction has.
WINDOW, UNITS = 48, 10
#: Bounds of the training sample: documents of each language (those of smallest hash) and windows of
#: each document. Every language is learned; beyond ``LANGUAGES`` of them each has fewer documents, so
#: that the sample stays bounded, but at least ``LEAST_DOCS``.
LANGUAGES, TRAIN_DOCS, TRAIN_WINDOWS, LEAST_DOCS = 64, 300, 8, 20
STEPS, BATCH, RATE = 260, 160, 0.02
#: Windows that are read together in prediction.
TOGETHER = 4096
UNKNOWN = "und"

_LETTERS = re.compile(r"[^\W\d_]")


def held_out(column: str = "doc_id") -> Column:
    rest = F.crc32(F.col(column).cast("string")) % 4
    return F.coalesce(rest == 2, F.lit(False))


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in _LETTERS.finditer(text))


# --- the network ---


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class Direction:
    """One gated recurrent layer: update and reset gates and the candidate, in this order."""

    def __init__(self, random: np.random.Generator, units: int, classes: int):
        self.units = units
        scale = 1 / np.sqrt(units)
        self.weights = {
            "by_byte": random.normal(0, 0.3, (256, 3 * units)),
            "back": random.normal(0, scale, (units, 3 * units)),
            "out": random.normal(0, scale, (units, classes)),
        }
        self.weights = {k: v.astype(np.float32) for k, v in self.weights.items()}

    def step(self, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        """The next state of a batch, and what its gradient needs."""
        u = self.units
        given = self.weights["by_byte"][x]
        back = h @ self.weights["back"]
        gates = given[:, : 2 * u]
        gates += back[:, : 2 * u]
        gates = _sigmoid(gates)
        z, r = gates[:, :u], gates[:, u:]
        new = r * back[:, 2 * u :]
        new += given[:, 2 * u :]
        new = np.tanh(new, out=new)
        return new + z * (h - new), z, r, new, back[:, 2 * u :]

    def logits(self, windows: np.ndarray, order: range) -> np.ndarray:
        """What this direction says at every place, by place, window and class."""
        h = np.zeros((len(windows), self.units), np.float32)
        out = np.empty((windows.shape[1], len(windows), self.weights["out"].shape[1]), np.float32)
        columns = np.ascontiguousarray(windows.T)
        for t in order:
            h = self.step(columns[t], h)[0]
            np.matmul(h, self.weights["out"], out=out[t])
        return out

    def gradient(self, windows: np.ndarray, order: range, d_logits) -> dict[str, np.ndarray]:
        """Backpropagation through time; ``d_logits(t)`` is the loss's slope at place t."""
        u = self.units
        grad = {k: np.zeros_like(v) for k, v in self.weights.items()}
        h = np.zeros((len(windows), u), np.float32)
        tape = []
        for t in order:
            following, z, r, new, back = self.step(windows[:, t], h)
            tape.append((t, h, following, z, r, new, back))
            h = following
        d_h = np.zeros_like(h)
        for t, before, h, z, r, new, back in reversed(tape):
            slope = d_logits(t)
            grad["out"] += h.T @ slope
            d_h = d_h + slope @ self.weights["out"].T
            d_new = d_h * (1 - z) * (1 - new * new)
            d_z = d_h * (before - new) * z * (1 - z)
            d_r = d_new * back * r * (1 - r)
            grad["by_byte"] += _one_hot(windows[:, t]).T @ np.concatenate([d_z, d_r, d_new], axis=1)
            d_back = np.concatenate([d_z, d_r, d_new * r], axis=1)
            grad["back"] += before.T @ d_back
            d_h = d_h * z + d_back @ self.weights["back"].T
        return grad


def _one_hot(x: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x), 256), np.float32)
    out[np.arange(len(x)), x] = 1
    return out


class Network:
    """Both directions and a bias per class."""

    def __init__(self, classes: list[str], units: int = UNITS, seed: int = 3):
        random = np.random.default_rng(seed)
        self.classes = classes
        self.forward = Direction(random, units, len(classes))
        self.backward = Direction(random, units, len(classes))
        self.bias = np.zeros(len(classes), np.float32)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """By place, window and class."""
        size = windows.shape[1]
        out = self.forward.logits(windows, range(size))
        out += self.backward.logits(windows, range(size - 1, -1, -1))
        out += self.bias
        out -= out.max(axis=2, keepdims=True)
        np.exp(out, out=out)
        out /= out.sum(axis=2, keepdims=True)
        return out

    def train(self, windows: np.ndarray, labels: np.ndarray, steps: int = STEPS) -> None:
        """Adam on the mean cross-entropy over all places; the rate falls to zero."""
        random = np.random.default_rng(4)
        layers = (self.forward, self.backward)
        mean = [{k: np.zeros_like(v) for k, v in d.weights.items()} for d in layers]
        square = [{k: np.zeros_like(v) for k, v in d.weights.items()} for d in layers]
        size = windows.shape[1]
        for step in range(1, steps + 1):
            chosen = random.integers(0, len(windows), BATCH)
            x = windows[chosen]
            slope = self.probabilities(x)
            slope[:, np.arange(len(x)), labels[chosen]] -= 1
            slope /= len(x) * size
            rate = RATE * (1 - (step - 1) / steps)
            orders = (range(size), range(size - 1, -1, -1))
            for layer, order, m, s in zip(layers, orders, mean, square):
                for k, g in layer.gradient(x, order, slope.__getitem__).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s[k] = 0.99 * s[k] + 0.01 * g * g
                    grown = np.sqrt(s[k] / (1 - 0.99**step)) + 1e-8
                    layer.weights[k] = layer.weights[k] - (
                        rate * (m[k] / (1 - 0.9**step)) / grown
                    ).astype(np.float32)
            self.bias -= np.float32(rate * 10) * slope.sum(axis=(0, 1))


def cut(data: bytes, window: int = WINDOW) -> bytes:
    """The text filled up to whole windows."""
    return data + bytes(-len(data) % window)


def predict(network: Network, texts: list[str]) -> list[tuple[str, float]]:
    """Language and probability of each text, over all of its bytes."""
    out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
    which = [i for i, t in enumerate(texts) if t and network.classes and has_letter(t)]
    if not which:
        return out
    data = [texts[i].encode() for i in which]
    whole = b"".join(cut(d) for d in data)
    windows = np.frombuffer(whole, np.uint8).reshape(-1, WINDOW)
    counts = np.array([-(-len(d) // WINDOW) for d in data])
    ends = np.cumsum(counts)
    sums = np.empty((len(windows), len(network.classes)))
    lengths = np.full(len(windows), WINDOW)
    lengths[ends - 1] -= np.array([-len(d) % WINDOW for d in data])
    # As many windows as take the memory of TOGETHER with LANGUAGES languages.
    many = max(1, TOGETHER * LANGUAGES // max(LANGUAGES, len(network.classes)))
    for at in range(0, len(windows), many):
        found = network.probabilities(windows[at : at + many])
        part = lengths[at : at + many]
        short = np.flatnonzero(part < WINDOW)
        for i in short:
            found[part[i] :, i] = 0
        sums[at : at + many] = found.sum(axis=0, dtype=np.float64)
    totals = np.add.reduceat(sums, ends - counts, axis=0) / np.array([len(d) for d in data])[:, None]
    for i, row in zip(which, totals):
        k = int(row.argmax())
        out[i] = network.classes[k], float(min(1.0, max(0.0, row[k])))
    return out


# --- on Spark ---


def docs_of_each(languages: int) -> int:
    """Documents that are learned from of each of so many languages."""
    return max(LEAST_DOCS, TRAIN_DOCS * LANGUAGES // max(LANGUAGES, languages))


def steps_for(languages: int) -> int:
    """Steps of training: as each has fewer of a batch, more for more than sixteen languages."""
    return STEPS * max(16, min(languages, 4 * LANGUAGES)) // 16


def units_for(languages: int) -> int:
    """Units of each direction: more for more than forty languages."""
    return max(UNITS, min(4 * UNITS, languages // 4))


def sample(docs: DataFrame) -> DataFrame:
    """``lang, windows``: the bounded training sample of the rows that are not held out."""
    labelled = docs.filter(
        ~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    ids = labelled.select("lang", "doc_id").distinct()
    # One row per language.
    sizes = ids.groupBy("lang").agg(F.count("*").alias("n"))
    each = docs_of_each(sizes.count())
    hashed = F.xxhash64("doc_id")
    # Of a large language only rows of low hash, some four times what is wanted, meet in the window.
    low = F.pmod(hashed, F.lit(1 << 20)) * F.col("n") < F.lit(4 * each) * F.lit(1 << 20)
    by_hash = Window.partitionBy("lang").orderBy(F.pmod(hashed, F.lit(1 << 20)), "doc_id")
    chosen = (
        ids.join(F.broadcast(sizes), "lang")
        .filter(low)
        .withColumn("place", F.row_number().over(by_hash))
        .filter(F.col("place") <= each)
        .select("lang", "doc_id")
    )

    def windows(rows: Iterator[tuple]) -> Iterator[tuple]:
        for lang, doc_id, text in rows:
            if not has_letter(text):
                continue
            data = cut(text.encode())
            count = len(data) // WINDOW
            random = np.random.default_rng(abs(doc_id))
            for i in sorted(random.choice(count, min(count, TRAIN_WINDOWS), replace=False).tolist()):
                yield lang, data[i * WINDOW : (i + 1) * WINDOW]

    # At most TRAIN_DOCS * LANGUAGES short rows are broadcast, or LEAST_DOCS a language.
    texts = labelled.select("lang", "doc_id", "text").join(F.broadcast(chosen), ["lang", "doc_id"])
    # Of repeated rows of one id one text counts.
    texts = texts.groupBy("lang", "doc_id").agg(F.min("text").alias("text"))
    return map_rows(texts.select("lang", "doc_id", "text"), "lang string, window binary", windows)


def learned(docs: DataFrame) -> Network:
    """The network for these documents."""
    rows = sorted((r[0], bytes(r[1])) for r in sample(docs).collect())
    classes = sorted({lang for lang, _ in rows})
    network = Network(classes, units_for(len(classes)))
    if len(classes) > 1:
        windows = np.frombuffer(b"".join(w for _, w in rows), np.uint8).reshape(-1, WINDOW)
        number = {lang: i for i, lang in enumerate(classes)}
        labels = np.array([number[lang] for lang, _ in rows])
        # Languages count alike, however many windows each has.
        each = max(np.bincount(labels).max(), 1)
        even = np.concatenate(
            [np.resize(np.flatnonzero(labels == k), each) for k in range(len(classes))]
        )
        network.train(windows[even], labels[even], steps_for(len(classes)))
    return network


def identified(docs: DataFrame, network: Network) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row of ``docs``."""

    def rows(inputs: Iterator[tuple]) -> Iterator[tuple]:
        held: list[tuple] = []
        size = 0
        for row in inputs:
            held.append(row)
            size += len(row[2] or "")
            if size >= TOGETHER * WINDOW:
                yield from answered(held)
                held, size = [], 0
        yield from answered(held)

    def answered(held: list[tuple]) -> Iterator[tuple]:
        for row, (lang, score) in zip(held, predict(network, [r[2] or "" for r in held])):
            yield row[0], row[1], lang, score

    importable(docs.sparkSession)
    return map_rows(
        docs.select("doc_id", held_out().alias("held_out"), "text"),
        "doc_id long, held_out boolean, lang_pred string, score double",
        rows,
    )


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents")
    return identified(docs, learned(docs))
