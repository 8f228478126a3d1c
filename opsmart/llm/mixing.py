"""Mixing sources to target weights with Pfair scheduling; DataFrame functions only.

Every source is cut into blocks. With integer weights ``a`` that add up to a cycle of ``P`` slots,
block k (from 0) of a source is released at slot ``floor(k P / a)`` and due by slot
``ceil((k + 1) P / a)``. One block per slot is taken by earliest deadline among the released ones;
for a single sequence of slots this meets every deadline, so after any number of slots each source
stands less than one block away from its exact share, however many sources there are. The schedule
repeats after ``P`` slots: only one cycle is computed, blocks of all cycles follow by arithmetic.

Sources of one weight have equal releases and deadlines, so they are scheduled as one class: its k-th
blocks are a batch, taken source by source. Between two releases the earliest batch runs on, so a cycle
is a list of segments (class, k, first source, number, slot). Their number depends on the weights
alone: with weights up to 100 there are at most 5050 batches and as many releases, for any number of
sources. Equal deadlines go to the smaller weight, then to the smaller hash of the source.

A source that runs out gives its slots up and the order of the rest closes ranks, so every row has a
place. ``in_ratio`` marks the rows before the first source runs out, for which the bound holds.

No source is sorted as a whole: rows are ordered by a hash of ``doc_id`` (and of the text, if there is
one), cut into ranges of hashes, numbered inside (source, range), and shifted by the sizes of the
earlier ranges. A source with a third of all rows is as evenly spread as the others.

Defined results: a null source is a source of its own; rows of one hash follow one another by
``doc_id``; repeated rows count each; columns may have any name, those called like the new ones are
replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opsmart.llm.common import stored, table, tasks

BLOCK = 32
#: Largest integer weight.
SCALE = 100
RANGE_ROWS = 100_000
ADDED = ("block", "slot", "position", "in_ratio")


def source_key(column: str = "source") -> Column:
    """A text that tells a null source from every other."""
    source = F.col(column)
    return F.when(source.isNull(), "0").otherwise(F.concat(F.lit("1"), source))


def tempered_weights(docs: DataFrame, exponent: float = 0.5, scale: int = SCALE) -> DataFrame:
    """``key, n, weight``: weights follow the sizes raised to ``exponent``, as integers to ``scale``.

    The usual smoothing of natural sizes: 1 keeps them, 0 makes all sources equal.
    """
    sizes = docs.groupBy(source_key().alias("key")).agg(F.count("*").alias("n"))
    share = F.col("n").cast("double") / sizes.agg(F.max("n")).scalar()
    weight = F.greatest(F.lit(1), F.round(scale * F.pow(share, F.lit(exponent)))).cast("long")
    return sizes.select("key", "n", weight.alias("weight"))


def _down(a: Column, b: Column) -> Column:
    """``a / b`` rounded down, in whole numbers."""
    return F.call_function("div", a, b)


def _up(a: Column, b: Column) -> Column:
    return F.call_function("div", a + b - 1, b)


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def schedule(weights: DataFrame) -> DataFrame:
    """The segments of one cycle: ``weight, turn, first, count, slot``.

    From ``slot`` on, ``count`` sources of a weight, from number ``first`` in their order, place block
    ``turn`` of their cycle, one a slot. The fold has one row of the distinct weights; its steps are at
    most twice the sum of these.
    """
    counts = weights.groupBy("weight").agg(F.count("*").alias("members"))
    classes = F.sort_array(F.collect_list(F.struct("weight", "members")))
    total, steps = F.sum(F.col("weight") * F.col("members")), F.sum("weight")
    one = counts.agg(classes.alias("classes"), total.alias("cycle"), steps.alias("steps"))
    cycle = F.col("cycle")

    def next_batch(taken: Column, t: Column) -> Column:
        """The earliest deadline among released batches, with its class; null after the last."""
        return F.array_min(
            F.transform(
                F.arrays_zip(taken.alias("taken"), F.col("classes").alias("of")),
                lambda x, i: _let(
                    _down(x["taken"], x["of"]["members"]),
                    lambda k: F.when(
                        (k < x["of"]["weight"]) & (_down(k * cycle, x["of"]["weight"]) <= t),
                        F.struct(_up((k + 1) * cycle, x["of"]["weight"]).alias("due"), i.alias("at"), k.alias("turn")),
                    ),
                ),
            )
        )

    def next_release(t: Column) -> Column:
        """The first slot after ``t`` at which a batch is released."""
        found = F.transform(
            "classes",
            lambda c: _let(
                _up((t + 1) * c["weight"], cycle),
                lambda k: F.when(k < c["weight"], _down(k * cycle, c["weight"])),
            ),
        )
        return F.coalesce(F.array_min(found), cycle)

    def run(state: Column, batch: Column) -> Column:
        of = F.element_at("classes", batch["at"] + 1)
        first = F.element_at(state["taken"], batch["at"] + 1) - batch["turn"] * of["members"]
        count = F.least(of["members"] - first, next_release(state["t"]) - state["t"])
        return _let(
            F.struct(first.alias("first"), count.alias("count")),
            lambda s: F.struct(
                (state["t"] + s["count"]).alias("t"),
                F.transform(state["taken"], lambda n, i: n + F.when(i == batch["at"], s["count"]).otherwise(0)).alias("taken"),
                F.concat(
                    state["found"],
                    F.array(
                        F.struct(
                            of["weight"].alias("weight"), batch["turn"].alias("turn"), s["first"].alias("first"),
                            s["count"].alias("count"), state["t"].alias("slot"),
                        )
                    ),
                ).alias("found"),
            ),
        )

    nothing = "array<struct<weight:bigint,turn:bigint,first:bigint,count:bigint,slot:bigint>>"
    start = F.struct(
        F.lit(0).cast("long").alias("t"),
        F.transform("classes", lambda c: F.lit(0).cast("long")).alias("taken"),
        F.array().cast(nothing).alias("found"),
    )
    found = F.aggregate(
        F.sequence(F.lit(1).cast("long"), 2 * F.col("steps")),
        start,
        lambda state, _: _let(
            next_batch(state["taken"], state["t"]), lambda b: F.when(b.isNull(), state).otherwise(run(state, b))
        ),
        lambda state: state["found"],
    )
    return one.filter("cycle > 0").select(F.inline(found))


def _ranked(rows: DataFrame, count: int, ties: list[str]) -> DataFrame:
    """``rows`` (``count`` of them, with ``key`` and a hexadecimal ``hash``) with ``rank``, the row's
    number in its key from 0, in the order of the hash."""
    ranges = tasks(rows.sparkSession, count, RANGE_ROWS)
    prefix = F.conv(F.substring("hash", 1, 8), 16, 10).cast("long")
    dealt = rows.withColumn("range", F.floor(prefix * ranges / (1 << 32)).cast("long"))
    earlier = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("key", "range")
        .agg(F.count("*").alias("size"))
        .select("key", "range", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy("key", "range").orderBy("hash", *ties)
    return (
        dealt.withColumn("number", F.row_number().over(inside))
        .join(offsets, ["key", "range"])
        .withColumn("rank", F.col("offset") + F.col("number") - 1)
        .drop("range", "number", "offset")
    )


class _Plan:
    """The schedule of one table: stored sources (``key, n, weight, member``), stored segments by
    (weight, turn), and what follows from both."""

    def __init__(self, weights: DataFrame, block: int):
        self.block = block
        own = stored(weights.select("key", "n", "weight"), "mix-weights")
        sources, rows, cycle = own.agg(F.count("*"), F.sum("n"), F.sum("weight")).first()
        self.rows, self.cycle = rows or 0, cycle or 0
        if not self.cycle:
            return
        classes = own.select(F.col("weight").alias("key"), F.md5("key").alias("hash"), F.struct("key", "n").alias("own"))
        members = _ranked(classes, sources, ["own"])
        self.sources = stored(members.select("own.*", F.col("key").alias("weight"), F.col("rank").alias("member")), "mix-sources")
        runs = F.collect_list(F.struct("first", "count", "slot")).alias("runs")
        self.segments = stored(schedule(own).groupBy("weight", "turn").agg(runs), "mix-segments")
        # The block after a source's last one marks the slot at which it has run out.
        blocks = F.ceil(F.col("n") / block)
        ends = self.sources.withColumn("block", F.explode(F.array(blocks, F.greatest(F.lit(0), blocks - 1))))
        over = F.col("block") >= blocks
        self.stop, self.last = (
            self.slots(ends).agg(F.min(F.when(over, F.col("slot"))), F.max(F.when(~over, F.col("slot")))).first()
        )

    def slots(self, blocks: DataFrame) -> DataFrame:
        """``slot`` of each row's ``block``, by its ``weight`` and ``member``. The segments are a small
        stored table, which Spark broadcasts by its size."""
        turned = blocks.withColumns(
            {"turn": F.col("block") % F.col("weight"), "round": _down(F.col("block"), F.col("weight"))}
        )
        run = F.filter(
            "runs", lambda r: (r["first"] <= F.col("member")) & (F.col("member") < r["first"] + r["count"])
        )[0]
        slot = F.col("round") * self.cycle + run["slot"] + F.col("member") - run["first"]
        return turned.join(self.segments, ["weight", "turn"]).withColumn("slot", slot).drop("turn", "round", "runs")

    def placed(self, docs: DataFrame, content: Column | None = None) -> DataFrame:
        """The rows as structs ``row``, with ``rank`` in their source, ``block`` and ``slot``."""
        if content is None and "text" in docs.columns:
            content = F.xxhash64("text")
        named = F.col("doc_id").cast("string")
        hashed = F.coalesce(F.md5(named), F.lit("ffffffff"))
        if content is not None:
            hashed = F.md5(F.concat_ws(":", named, content.cast("string")))
        rows = docs.select(
            source_key().alias("key"), hashed.alias("hash"), "doc_id", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
        )
        numbered = _ranked(rows, self.rows, ["doc_id"]).withColumn("block", F.floor(F.col("rank") / self.block))
        known = self.sources.select("key", "weight", "member")
        return self.slots(numbered.join(known, "key"))


def mixed(
    docs: DataFrame, weights: DataFrame | None = None, block: int = BLOCK, content: Column | None = None
) -> DataFrame:
    """``docs`` with ``block``, ``slot``, ``position`` (from 0, without gaps) and ``in_ratio``.

    ``weights`` has ``key`` (see ``source_key``), ``n`` rows and an integer ``weight`` for every
    source of ``docs``; without it sizes are tempered by a square root. ``content`` stands for the
    text in the order of the rows, by default the XXH64 of ``text``.
    """
    plan = _Plan(tempered_weights(docs) if weights is None else weights, block)
    own = [f"row.`{c}`" for c in docs.columns if c not in ADDED]
    if not plan.cycle:
        empty = [F.lit(None).cast(t).alias(n) for n, t in zip(ADDED, ("long", "long", "long", "boolean"))]
        return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).select(*own, *empty).limit(0)
    placed = plan.placed(docs, content)
    ranges = tasks(docs.sparkSession, plan.rows // block + 1, RANGE_ROWS)
    blocks = (
        placed.groupBy("slot")
        .agg(F.count("*").alias("rows"))
        .withColumn("range", F.floor(F.col("slot").cast("decimal(38,0)") * ranges / (plan.last + 1)).cast("long"))
    )
    # One row per range.
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        blocks.groupBy("range")
        .agg(F.sum("rows").alias("sum"))
        .select("range", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy("range").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("offset") + F.coalesce(F.sum("rows").over(inside), F.lit(0))
    places = blocks.join(offsets, "range").select("slot", before.alias("before"))
    return (
        placed.join(places, "slot")
        .withColumn("position", F.col("before") + F.col("rank") % block)
        .withColumn("in_ratio", F.col("slot") < plan.stop)
        .select(*own, *ADDED)
    )


def ordered(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` in mixed order, with their own columns."""
    plan = _Plan(tempered_weights(docs), BLOCK)
    if not plan.cycle:
        return docs.limit(0)
    rows = plan.placed(docs).orderBy("slot", "rank")
    return rows.select(*[F.col(f"row.`{c}`") for c in docs.columns])


def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document in the mix of sources."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixed(docs).select("doc_id", "source", "block", "slot", "position", "in_ratio")


OP4_SQL = """
WITH RECURSIVE sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
weights AS (
    SELECT source, n, CAST(greatest(1, round(100 * sqrt(n / (SELECT max(n) FROM sizes)))) AS BIGINT) AS a,
        md5(coalesce('1' || source, '0')) AS name
    FROM sizes
),
total AS (SELECT CAST(sum(a) AS BIGINT) AS p FROM weights),
edf AS (
    SELECT CAST(-1 AS BIGINT) AS t, source, name, a, p, CAST(0 AS BIGINT) AS k, false AS pick
    FROM weights, total
    UNION ALL
    SELECT t, source, name, a, p, k,
        row_number() OVER (
            ORDER BY k < a AND (k * p) // a <= t DESC, ((k + 1) * p + a - 1) // a, a, name
        ) = 1
    FROM (SELECT t + 1 AS t, source, name, a, p, k + CAST(pick AS BIGINT) AS k FROM edf)
    WHERE t < p
),
slots AS (SELECT t, source, a, p, k FROM edf WHERE pick),
ranked AS (
    SELECT doc_id, source,
        row_number() OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) - 1 AS r
    FROM documents
),
placed AS (
    SELECT doc_id, ranked.source, r // 32 AS block, (r // 32) // a * p + t AS slot, r
    FROM ranked JOIN slots ON ranked.source = slots.source AND (r // 32) % a = k
),
ends AS (
    SELECT min(((n + 31) // 32) // s.a * p + t) AS stop
    FROM weights w JOIN slots s ON w.source = s.source AND ((n + 31) // 32) % s.a = k
)
SELECT doc_id, source, CAST(block AS BIGINT) AS block, CAST(slot AS BIGINT) AS slot,
    row_number() OVER (ORDER BY slot, r) - 1 AS position, slot < stop AS in_ratio
FROM placed, ends
"""
