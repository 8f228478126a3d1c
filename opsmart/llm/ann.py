"""Approximate nearest neighbours by cross-polytope hashing with multiprobe.

A unit vector is turned by pseudo-rotations (three rounds of random signs and a fast Hadamard
transform); its hash is the signed axis it then lies nearest to. Each of ``tables`` tables has its
own rotations, ``functions`` of them joined to one bucket number. Every vector is indexed in one
bucket per table; a query looks into the ``probes`` buckets whose axes it lies nearest to. How many
that takes depends on the rows, their dimension and their norms, and is measured: up to ``SAMPLE``
queries are compared with every vector, and ``probes`` is the least number with which ``TARGET`` of
their true neighbours lie in a probed bucket. It falls as a table grows, since neighbours get nearer. What
a query meets is ranked exactly, by the inner product of the original vectors in double precision. Unit vectors
are centred for the hash, so that a cone of vectors spreads over the buckets. A query that met fewer than
k + 1 classes looks into eight times as many buckets, in the end into all.

Equal vectors form one class and are hashed and compared once; a class keeps its k + 1 smallest ids,
which is all that k nearest can show of it. Buckets are cut into blocks of at most about
``BLOCK`` classes and ``QUERIES`` queries, and every block of classes meets every block of queries
of its bucket, so no task holds more than that.

Measured recall of the 20 nearest: see README. With one function a table has two buckets per axis; for
a hundred million vectors or more take two functions and more tables.

Defined results: vectors that are null, empty, zero, of another length than most, or hold null or
non-finite components take no part; a repeated row counts once, and a ``vec_id`` with several vectors
stands for each of them; ties go to the smaller ``vec_id``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opsmart.llm.common import importable, stored, table

TABLES, FUNCTIONS = 8, 1
#: Queries that the number of probes is fitted on, and the share of their neighbours to be met.
SAMPLE, TARGET = 64, 0.95
BLOCK, QUERIES = 4096, 16384
SEED = 20


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row; the length is a power of two."""
    n, size = x.shape
    half = 1
    while half < size:
        pairs = x.reshape(n, size // (2 * half), 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2)
        x = x.reshape(n, size)
        half *= 2
    return x / np.sqrt(size)


def rotated(x: np.ndarray, seed: int) -> np.ndarray:
    """A pseudo-rotation of each row, the same for a seed wherever it is computed."""
    random = np.random.default_rng(seed)
    size = 1 << max(1, (x.shape[1] - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, size - x.shape[1])))
    for _ in range(3):
        x = hadamard(x * random.choice([-1.0, 1.0], size))
    return x


def probed(x: np.ndarray, table_number: int, functions: int, probes: int) -> np.ndarray:
    """The ``probes`` best buckets of each row in one table, best first.

    The cost of an axis is how far its coordinate lies behind the largest one, squared; costs of
    several functions add up.
    """
    codes = np.zeros((len(x), 1), np.int64)
    costs = np.zeros((len(x), 1))
    for k in range(functions):
        y = rotated(x, SEED + table_number * functions + k)
        both = np.concatenate([y, -y], axis=1)
        order = np.argsort(-both, axis=1, kind="stable")[:, :probes]
        behind = np.take_along_axis(both, order[:, :1], 1) - np.take_along_axis(both, order, 1)
        cost = (costs[:, :, None] + (behind**2)[:, None, :]).reshape(len(x), -1)
        code = (codes[:, :, None] * both.shape[1] + order[:, None, :]).reshape(len(x), -1)
        best = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        codes, costs = np.take_along_axis(code, best, 1), np.take_along_axis(cost, best, 1)
    return codes


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(size > 0, size, 1)


def _centre(classes: DataFrame) -> np.ndarray | None:
    """The mean of the unit vectors, to four decimals; none without a vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = None, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                x = _unit(_matrix(batch.slice(at, 2048).column("embedding")))
                total, n = x.sum(axis=0) + (0 if total is None else total), n + len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()]), pa.array([n])], names=["total", "n"])

    parts = classes.select("embedding").mapInArrow(run, "total array<double>, n long").collect()
    if not parts:
        return None
    return np.round(np.sum([p.total for p in parts], axis=0) / sum(p.n for p in parts), 4)


def _dealt(
    vectors: DataFrame, tables: int, functions: int, probes: int, centre: np.ndarray
) -> DataFrame:
    """``class, embedding`` once per table and probed bucket, with ``number`` and ``bucket``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                x = _unit(_unit(_matrix(part.column("embedding"))) - centre)
                for number in range(tables):
                    codes = probed(x, number, functions, probes)
                    rows = np.repeat(np.arange(len(x)), codes.shape[1])
                    taken = part.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays(
                        [
                            taken.column("class"),
                            taken.column("embedding"),
                            pa.array(np.full(len(rows), number, np.int32)),
                            pa.array(codes.ravel()),
                        ],
                        names=["class", "embedding", "number", "bucket"],
                    )

    return vectors.select("class", "embedding").mapInArrow(
        run, "class long, embedding array<float>, number int, bucket long"
    )


def _nearest(k: int):
    """Of one block of queries and one block of classes the ``k`` nearest of each query."""

    def run(queries: pa.Table, classes: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if queries.num_rows and classes.num_rows:
            ids = classes.column("class").to_numpy()
            order = np.argsort(ids)
            ids, x = ids[order], _matrix(classes.column("embedding"))[order]
            asked, y = queries.column("class").to_numpy(), _matrix(queries.column("embedding"))
            for at in range(0, len(y), 512):
                rough = y[at : at + 512] @ x.T
                many = min(len(ids), k)
                # The k-th best rough score, less what rounding can move.
                edge = -np.partition(-rough, many - 1, axis=1)[:, many - 1] - 1e-9 * (1 + np.abs(rough).max())
                row, column = np.nonzero(rough >= edge[:, None])
                exact = np.einsum("ij,ij->i", y[at + row], x[column])
                best = np.lexsort((ids[column], -exact, row))
                row, column, exact = row[best], column[best], exact[best]
                place = np.arange(len(row)) - np.searchsorted(row, row)
                kept = place < k
                found.append((asked[at + row[kept]], ids[column[kept]], exact[kept]))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [[], [], []]
        types = (pa.int64(), pa.int64(), pa.float64())
        return pa.table(
            {n: pa.array(c, t) for n, c, t in zip(("query", "class", "score"), columns, types)}
        )

    return run


def fitted_probes(
    classes: DataFrame, asked: DataFrame, k: int, tables: int, functions: int, centre: np.ndarray
) -> int:
    """The least number of probes that meets ``TARGET`` of the true neighbours of a sample of queries.

    One pass over all vectors, of which every task returns the k best of each sampled query; the sample
    (``SAMPLE`` vectors) and its neighbours (k each) come to the driver.
    """
    chosen = asked.orderBy(F.xxhash64("class"), "class").limit(SAMPLE).select("class", "embedding").collect()
    if not chosen:
        return 1
    own = np.array([r[0] for r in chosen])
    queries = np.array([r.embedding for r in chosen], np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = batch.column("class").to_numpy(), _matrix(batch.column("embedding"))
            scores = queries @ x.T
            scores[own[:, None] == ids[None, :]] = -np.inf
            best = np.argsort(-scores, axis=1, kind="stable")[:, :k]
            row = np.repeat(np.arange(len(queries)), best.shape[1])
            found = [row, ids[best.ravel()], scores[row, best.ravel()]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["query", "class", "score"])

    scored = classes.select("class", "embedding").mapInArrow(run, "query long, class long, score double")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "class")
    top = scored.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)
    near = top.filter("score > double('-Infinity')").join(classes, "class").select("query", "embedding").collect()
    if not near:
        return 1
    of = np.array([r[0] for r in near])
    x = _unit(_unit(np.array([r.embedding for r in near], np.float64)) - centre)
    y = _unit(_unit(queries) - centre)
    axes = 2 << max(1, (x.shape[1] - 1).bit_length())
    # With several functions the lists of buckets are cut where no one would probe them all.
    most = min(axes**functions, max(axes, 1024))
    needed = np.full(len(near), most)
    for number in range(tables):
        code = probed(x, number, functions, 1)[:, 0]
        met = probed(y, number, functions, most)[of] == code[:, None]
        needed = np.minimum(needed, np.where(met.any(axis=1), met.argmax(axis=1) + 1, most))
    return int(np.sort(needed)[max(0, int(np.ceil(TARGET * len(needed))) - 1)])


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding`` of the vectors that take part, each row once."""
    vectors = vectors.select("vec_id", F.col("embedding").cast("array<float>").alias("embedding"))
    finite = F.forall(
        "embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    )
    sound = vectors.filter(
        F.col("vec_id").isNotNull()
        & F.col("embedding").isNotNull()
        & finite
        & F.exists("embedding", lambda v: v != 0)
    )
    usual = (
        sound.groupBy(F.size("embedding").alias("size"))
        .count()
        .orderBy(F.desc("count"), "size")
        .limit(1)
        .select("size")
    )
    return sound.filter(F.size("embedding") == F.coalesce(usual.scalar(), F.lit(0))).distinct()


def _met(index: DataFrame, probing: DataFrame, k: int) -> DataFrame:
    """``query, class, score``: of every block of classes the ``k + 1`` best of the queries that meet it."""
    key = ["number", "bucket"]
    blocks = (
        index.groupBy(*key)
        .agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
        .join(
            probing.groupBy(*key).agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("parts")), key
        )
    )

    def cut(df: DataFrame, own: str, own_count: str, other: str, other_count: str) -> DataFrame:
        return (
            df.join(blocks, key)
            .withColumn(own, F.pmod(F.xxhash64("class"), F.col(own_count)).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_count) - 1)))
            .select(*key, "block", "part", "class", "embedding")
        )

    group = [*key, "block", "part"]
    return (
        cut(probing, "part", "parts", "block", "blocks")
        .groupBy(*group)
        .cogroup(cut(index, "block", "blocks", "part", "parts").groupBy(*group))
        .applyInArrow(_nearest(k + 1), "query long, class long, score double")
    )


def nearest(
    vectors: DataFrame,
    asked: DataFrame,
    k: int = 20,
    tables: int = TABLES,
    functions: int = FUNCTIONS,
    probes: int | None = None,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every row of ``asked``.

    ``asked`` holds rows of ``vectors`` (``vec_id``); a row is never its own neighbour. Without
    ``probes`` their number is fitted.
    """
    spark = vectors.sparkSession
    importable(spark)
    rows = stored(usable(vectors), "vectors")
    classes = stored(
        rows.groupBy("embedding").agg(F.min("vec_id").alias("class")), "vector-classes"
    )
    by_id = Window.partitionBy("embedding").orderBy("vec_id")
    members = (
        rows.withColumn("place", F.row_number().over(by_id))
        .filter(F.col("place") <= k + 1)
        .join(classes, "embedding")
        .select("class", "vec_id")
    )
    queries = stored(
        rows.join(asked.select("vec_id").distinct(), "vec_id", "left_semi")
        .join(classes, "embedding")
        .select(F.col("vec_id").alias("query_id"), "class", "embedding"),
        "vector-queries",
    )
    centre = _centre(classes)
    centre = np.zeros(1) if centre is None else centre
    index = _dealt(classes, tables, functions, 1, centre)
    open_queries = queries.select("class", "embedding").dropDuplicates(["class"])
    if probes is None:
        probes = fitted_probes(classes, open_queries, k, tables, functions, centre)
    met = stored(_met(index, _dealt(open_queries, tables, functions, probes, centre), k).distinct(), "vectors-met")
    buckets = (2 << max(1, (len(centre) - 1).bit_length())) ** functions
    while probes < buckets:
        # Queries that met too few classes look further, in the end into every bucket.
        probes = min(8 * probes, buckets)
        enough = met.groupBy("query").agg(F.countDistinct("class").alias("n")).filter(F.col("n") > k)
        open_queries = stored(
            open_queries.join(enough, open_queries["class"] == enough["query"], "left_anti"), "queries-open"
        )
        if open_queries.isEmpty():
            break
        more = _met(index, _dealt(open_queries, tables, functions, probes, centre), k)
        met = stored(met.union(more).distinct(), "vectors-met")
    best_classes = Window.partitionBy("query").orderBy(F.desc("score"), "class")
    top = (
        met
        .withColumn("place", F.row_number().over(best_classes))
        .filter(F.col("place") <= k + 1)
        .select("query", "class", "score")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    asked_class = queries.select("query_id", F.col("class").alias("query"))
    return (
        top.join(members, "class")
        .join(asked_class, "query")
        .filter(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every row whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0))
