"""Chat formatting after collapsing cumulative snapshots; DataFrame functions only.

A logger that stores a conversation after every turn leaves many conversations that are prefixes of
longer ones. Every turn gets a rolling hash of the conversation up to it. A conversation whose last
hash stands inside another one is dropped by an anti-join, equal conversations become the one of
smallest id, and the rest is rendered turn by turn.

The rolling hash of a prefix is the sum of one 64-bit hash per turn (of its place, role and text),
taken twice with different arguments; a place has to agree, so order matters. Sums are formed inside
stretches of turns first and shifted by the sums of the earlier stretches, so a conversation with a
third of all turns is spread over tasks like the others. For the same reason the result has one row
per turn; a conversation is its rows in order of ``position``.

Defined results: turns follow one another by ``turn`` (null first), role and text; a repeated row
counts once; a null role or text is empty; a row without ``conv_id`` is a conversation of its own; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opsmart.llm.common import stored, table

#: Turns by number that form one stretch.
STRETCH = 256
TEMPLATE = ("<|", "|>\n", "<|end|>\n")


def prefixes(turns: DataFrame) -> DataFrame:
    """Every turn once, with its ``position`` (from 1), the hashes ``p1, p2`` of the conversation up
    to it, and ``last`` for the final turn. ``conversation`` names conversations without id too."""
    rows = turns.select(
        F.col("conv_id"),
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).distinct()
    own = F.md5(F.concat_ws("\0", F.coalesce(F.col("turn").cast("string"), F.lit("-")), "role", "text"))
    rows = rows.withColumn(
        "conversation",
        F.when(F.col("conv_id").isNull(), F.concat(F.lit("row "), own)).otherwise(
            F.col("conv_id").cast("string")
        ),
    ).withColumn("stretch", F.coalesce(F.floor(F.col("turn") / STRETCH).cast("long"), F.lit(-(1 << 62))))
    inside = Window.partitionBy("conversation", "stretch")
    order = inside.orderBy("turn", "role", "text")
    earlier = Window.partitionBy("conversation").orderBy("stretch")
    sizes = (
        rows.groupBy("conversation", "stretch")
        .agg(F.count("*").alias("size"))
        .withColumn("offset", F.coalesce(F.sum("size").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("final", F.lead("stretch").over(earlier).isNull())
    )
    numbered = (
        rows.withColumn("place", F.row_number().over(order))
        .join(sizes, ["conversation", "stretch"])
        .withColumn("position", F.col("offset") + F.col("place"))
        .withColumn("last", F.col("final") & (F.col("place") == F.col("size")))
    )
    turn_hash = {
        "h1": F.xxhash64("position", "role", "text"),
        "h2": F.xxhash64(F.lit(1), "text", "position", "role"),
    }
    hashed = numbered.withColumns({k: v.cast("decimal(38,0)") for k, v in turn_hash.items()})
    sums = (
        hashed.groupBy("conversation", "stretch")
        .agg(F.sum("h1").alias("s1"), F.sum("h2").alias("s2"))
        .withColumns(
            {
                k: F.coalesce(F.sum(s).over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
                for k, s in (("b1", "s1"), ("b2", "s2"))
            }
        )
        .drop("s1", "s2")
    )
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    so_far = hashed.withColumns({"r1": F.sum("h1").over(running), "r2": F.sum("h2").over(running)})
    return so_far.join(sums, ["conversation", "stretch"]).select(
        "conversation",
        "conv_id",
        "turn",
        "role",
        "text",
        F.col("position").cast("long").alias("position"),
        (F.col("b1") + F.col("r1")).cast("decimal(38,0)").alias("p1"),
        (F.col("b2") + F.col("r2")).cast("decimal(38,0)").alias("p2"),
        "last",
    )


def collapsed(turns: DataFrame) -> DataFrame:
    """The turns of the maximal conversations: ``conv_id, position, turn, role, text, n_turns,
    copies``; ``copies`` counts the logged conversations equal to this one."""
    rows = stored(prefixes(turns), "turn-prefixes")
    key = ["position", "p1", "p2"]
    classes = (
        rows.filter("last")
        .groupBy(*key)
        .agg(F.min(F.struct("conv_id", "conversation")).alias("first"), F.count("*").alias("copies"))
    )
    inside = rows.filter(~F.col("last")).select(*key).distinct()
    maximal = classes.join(inside, key, "left_anti").select(
        F.col("first.conversation").alias("conversation"),
        F.col("position").alias("n_turns"),
        "copies",
    )
    return rows.join(maximal, "conversation").select(
        "conv_id", "position", "turn", "role", "text", "n_turns", "copies"
    )


def rendered(turns: DataFrame, template: tuple[str, str, str] = TEMPLATE) -> DataFrame:
    """The maximal conversations with each turn rendered: opening, role, text, end."""
    opening, after_role, end = map(F.lit, template)
    return collapsed(turns).select(
        "conv_id",
        "position",
        "turn",
        "role",
        F.concat(opening, "role", after_role, "text", end).alias("rendered"),
        "n_turns",
        "copies",
    )


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered turns of all maximal conversations."""
    return rendered(table(spark, sf_dir, "conversations"))


OP8_SQL = """
WITH turns AS (
    SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS position,
        count(*) OVER (PARTITION BY conv_id) AS n_turns
    FROM turns
),
so_far AS (
    SELECT *, string_agg(concat(length(role), ':', role, length(text), ':', text), '') OVER (
        PARTITION BY conv_id ORDER BY position ROWS UNBOUNDED PRECEDING) AS prefix
    FROM placed
),
kept AS (
    SELECT min(conv_id) AS conv_id, count(*) AS copies
    FROM so_far f
    WHERE position = n_turns AND NOT EXISTS (
        SELECT 1 FROM so_far o WHERE o.position = f.position AND o.n_turns > o.position AND o.prefix = f.prefix)
    GROUP BY prefix
)
SELECT conv_id, position, turn, role, concat('<|', role, '|>', chr(10), text, '<|end|>', chr(10)) AS rendered,
    n_turns, copies
FROM placed JOIN kept USING (conv_id)
"""
