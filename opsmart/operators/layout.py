"""Orders of rows for storage in which filters on any of several columns skip data."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of a column's rank on the curve.
BITS = 6


def _number(df: DataFrame, name: str) -> Column:
    """A column as a number that orders like it; texts of digits and dashes (months) by their digits."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.replace(F.col(name), F.lit("-"), F.lit("")).try_cast("long")
    if isinstance(df.schema[name].dataType, T.TimestampType):
        return F.unix_micros(F.col(name))
    return F.col(name)


def _rank(value: Column, cuts: Sequence[object], least: int = 0) -> Column:
    """How many of the ascending cuts a value reaches, and ``least``, by halving them; NULL reaches none."""
    if not cuts:
        return F.lit(least)
    middle = len(cuts) // 2
    above, below = _rank(value, cuts[middle + 1 :], least + middle + 1), _rank(value, cuts[:middle], least)
    return F.when(value >= F.lit(cuts[middle]), above).otherwise(below)


def curve_cuts(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> list[Sequence[object]]:
    """What cuts the rows into equal shares by each column, 2^bits - 1 numbers each, found in one pass."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    wanted = [F.percentile_approx(_number(df, c), shares, 10_000).alias(f"_{i}") for i, c in enumerate(columns)]
    return [found or () for found in df.agg(*wanted).first()]


def along_curve(
    df: DataFrame,
    columns: Sequence[str],
    bits: int = BITS,
    name: str = "_curve",
    cuts: Sequence[Sequence[object]] | None = None,
) -> DataFrame:
    """The rows with their place on a space-filling curve (Z order) over the columns.

    Every column counts by its rank among equal shares of the rows, so columns of any scale and skew
    weigh the same, the first a little more; NULL ranks first. The ``cuts`` of all columns are found by one
    pass over the rows, unless they are given.
    """
    cuts = curve_cuts(df, columns, bits) if cuts is None else cuts
    numbers, ranks, terms = {}, {}, []
    for k, (column, found) in enumerate(zip(columns, cuts)):
        numbers[f"{name}_number_{k}"] = _number(df, column)
        ranks[f"{name}_{k}"] = _rank(F.col(f"{name}_number_{k}"), found)
        for b in range(bits):
            bit = F.shiftright(F.col(f"{name}_{k}"), b).bitwiseAND(F.lit(1)).cast("long")
            terms.append(F.shiftleft(bit, (b + 1) * len(columns) - 1 - k))
    placed = df.withColumns(numbers).withColumns(ranks).withColumn(name, reduce(add, terms))
    return placed.drop(*numbers, *ranks)


def curve_cell(
    df: DataFrame, columns: Sequence[str], cuts: Sequence[Sequence[object]], depth: int, bits: int = BITS
) -> Column:
    """The first ``depth`` bits of a row's place on the curve, by the few cuts that decide them."""
    terms = [F.lit(0)]
    for k, (column, found) in enumerate(zip(columns, cuts)):
        own = len(range(k, depth, len(columns)))
        step = 1 << (bits - own)
        rank = _rank(_number(df, column), found[step - 1 :: step])
        for level in range(own):
            bit = F.shiftright(rank, own - 1 - level).bitwiseAND(F.lit(1))
            terms.append(F.shiftleft(bit, depth - 1 - k - level * len(columns)))
    return reduce(add, terms)


def even_ranges(df: DataFrame, cell: Column, parts: int) -> list[tuple[int, int]]:
    """First and last cell of up to ``parts`` ranges that hold about as many rows each; of no rows the whole."""
    counts = sorted(df.groupBy(cell.alias("_cell")).agg(F.count(F.lit(1)).alias("_n")).collect())
    total, before, ranges = sum(n for _, n in counts), 0, {}
    for at, n in counts:
        ranges.setdefault((2 * before + n) * parts // (2 * total), []).append(at)
        before += n
    return [(own[0], own[-1]) for own in ranges.values()] or [(0, 0)]
