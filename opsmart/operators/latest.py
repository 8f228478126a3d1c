"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Order:
    """Which of two rows of one key is newer: ``newest`` columns, then ``ties``, all descending."""

    key: str
    newest: Sequence[str]
    ties: Sequence[str] = ()


def newest_first(*names: str) -> list[Column]:
    """Descending order with NULLs last for each name."""
    return [F.col(n).desc_nulls_last() for n in names]


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    newest: Sequence[str],
    tiebreak: Sequence[str] = (),
    rows: int = 1,
) -> DataFrame:
    """Keep the first ``rows`` rows of each key in descending ``newest`` order.

    ``tiebreak`` columns settle equal stamps, so reruns keep the same row. The filter on
    ``row_number`` lets Spark limit each key before the shuffle: a map task sends at most
    ``rows`` rows per key, however many copies of one key exist.
    """
    order = newest_first(*newest, *tiebreak)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= rows).drop("_rank")
