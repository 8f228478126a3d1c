"""Left joins that attach dimension columns to a fact."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_codes(fact: DataFrame, codes: DataFrame, on: str) -> DataFrame:
    """Attach a literal code table.

    Code tables are constants of this package with a few dozen rows at most (see ``plans.dims``),
    so they are broadcast outright and the fact is not shuffled.
    """
    return fact.join(F.broadcast(codes), on, "left")


def attach(
    fact: DataFrame, dim: DataFrame, on: str, salts: int = 1, hot_share: float | None = None
) -> DataFrame:
    """Attach a dimension that has one row per key and may be of any size.

    No hint: Spark broadcasts the dimension when its size is under
    ``spark.sql.autoBroadcastJoinThreshold`` (checked at planning and again by AQE on the
    measured shuffle output), and otherwise sort-merges with AQE splitting hot fact partitions.
    ``salts > 1`` spreads every key - NULL keys too - over that many join partitions without
    relying on AQE, at the price of that many copies of the dimension, which are merged with the fact
    partition by partition: Spark's size of a frame does not see them, so a dimension just under the
    threshold would be broadcast ``salts`` times over. ``hot_share`` looks for the keys with that share
    of the rows and spreads only these (``attach_spread``).
    """
    if hot_share is not None:
        return attach_spread(fact, dim, on, hot_share)
    if salts <= 1:
        return fact.join(dim, on, "left")
    # The salt comes from the row's own content, so a retried task builds the same rows.
    salted = fact.withColumn("_salt", F.pmod(F.xxhash64(*fact.columns), F.lit(salts)).cast("int"))
    copies = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies.hint("merge"), [on, "_salt"], "left").drop("_salt")


def hot_keys(fact: DataFrame, on: str, share: float) -> list[object]:
    """Keys that at least about ``share`` of the rows have; at most 1 / ``share`` of them, and NULL is none.

    One pass: every task keeps a summary of its most frequent keys, of bounded size, and the summaries
    are merged. With ten places for every key looked for no such key is missed.
    """
    most = max(1, math.ceil(1 / share))
    column = F.col(f"`{on}`")
    places = 1 << max(6, math.ceil(math.log2(20 * most)))
    frequent = F.call_function("approx_top_k", column, F.lit(most), F.lit(places))
    rows, found = fact.agg(F.count(F.lit(1)), F.when(F.count(column) > 0, frequent)).first()
    return [f["item"] for f in found or () if f["item"] is not None and f["count"] >= share * rows]


def attach_spread(fact: DataFrame, dim: DataFrame, on: str, share: float = 0.01, salts: int = 64) -> DataFrame:
    """``attach`` that finds the hot keys itself and spreads only these, and rows without a key.

    A row of a hot key gets one of ``salts`` places by its own content, and the dimension rows of the
    hot keys, at most 1 / ``share``, are copied to each place; all other keys join as they are. Does
    not depend on AQE.
    """
    hot = hot_keys(fact, on, share)
    column = F.col(f"`{on}`")
    is_hot = column.isin(hot) if hot else F.lit(False)
    place = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns]), F.lit(salts)).cast("int")
    salted = fact.withColumn("_salt", F.when(is_hot | column.isNull(), place).otherwise(0))
    places = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    copies = dim.withColumn("_salt", F.explode(places))
    return salted.join(copies, [on, "_salt"], "left").drop("_salt")


def in_role(dim: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """A dimension projected and renamed for one role of the fact (requester, technician, ...)."""
    return dim.select(*[F.col(old).alias(new) for old, new in names.items()])
