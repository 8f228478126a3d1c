"""Optional filters, ordered output, top-k, pages, pivots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Limits of the serving queries.
DEFAULT_LIMIT = 500
MAX_LIMIT = 10_000


def filter_optional(
    df: DataFrame, params: Mapping[str, object], blank_is_absent: bool = False
) -> DataFrame:
    """AND of an equality per supplied parameter; ``None`` means not supplied.

    ``blank_is_absent`` also ignores empty strings. The result is a plain conjunction, so it
    reaches the scan.
    """
    given = {
        name: value
        for name, value in params.items()
        if value is not None and not (blank_is_absent and value == "")
    }
    if not given:
        return df
    return df.where(reduce(and_, [F.col(name) == F.lit(v) for name, v in given.items()]))


def check_limit(n: int) -> int:
    """A row limit between 1 and the serving maximum."""
    if not 1 <= n <= MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_LIMIT}, got {n}")
    return n


def desc(name: str) -> Column:
    """Descending with NULLs first, as the serving database orders."""
    return F.col(name).desc_nulls_first()


def asc(name: str) -> Column:
    """Ascending with NULLs last, as the serving database orders."""
    return F.col(name).asc_nulls_last()


def top_k(df: DataFrame, order: Sequence[Column], n: int = DEFAULT_LIMIT) -> DataFrame:
    """First ``n`` rows in the given order; each task keeps only its own best ``n``."""
    if n < 1:
        raise ValueError(f"at least one row has to be asked for, got {n}")
    return df.orderBy(*order).limit(n)


def page(
    df: DataFrame,
    unique: str,
    page_no: int = 1,
    page_size: int = DEFAULT_LIMIT,
    sort_by: str | None = None,
    sort_order: str = "asc",
) -> DataFrame:
    """One page of a stable order: ``sort_by``, then the unique column.

    Tasks keep all rows up to the end of the page; to walk through pages use ``page_after``.
    """
    if page_no < 1:
        raise ValueError("pages are numbered from 1")
    if sort_order not in ("asc", "desc"):
        raise ValueError("sort_order is 'asc' or 'desc'")
    direction = asc if sort_order == "asc" else desc
    order = ([direction(sort_by)] if sort_by else []) + [asc(unique)]
    if page_size < 1:
        raise ValueError(f"a page has at least one row, got {page_size}")
    return df.orderBy(*order).offset((page_no - 1) * page_size).limit(page_size)


def page_after(
    df: DataFrame,
    unique: str,
    last: object | None,
    page_size: int = DEFAULT_LIMIT,
    sort_by: str | None = None,
    sort_order: str = "asc",
) -> DataFrame:
    """The page behind a row, in the order of ``page``. The seek is a filter on the scan, so a deep page
    costs as much as the first.

    ``last`` tells the row: its unique value or, with ``sort_by``, the pair (value of ``sort_by``, unique
    value); None asks for the first page. NULL values come last in ascending order and first in
    descending order, as in ``page``.
    """
    if sort_order not in ("asc", "desc"):
        raise ValueError("sort_order is 'asc' or 'desc'")
    if sort_by is None:
        rows = df if last is None else df.where(F.col(unique) > F.lit(last))
        return top_k(rows, [asc(unique)], page_size)
    order = [(asc if sort_order == "asc" else desc)(sort_by), asc(unique)]
    return top_k(df if last is None else df.where(_behind(sort_by, unique, last, sort_order)), order, page_size)


def _behind(sort_by: str, unique: str, last: tuple[object, object], sort_order: str) -> Column:
    """Rows behind a pair in the order of ``sort_by`` and then ``unique``."""
    value, key = last
    column, later = F.col(sort_by), F.col(unique) > F.lit(key)
    if value is None:
        same = column.isNull() & later
        return same if sort_order == "asc" else same | column.isNotNull()
    same = (column == F.lit(value)) & later
    if sort_order == "asc":
        return (column > F.lit(value)) | same | column.isNull()
    return (column < F.lit(value)) | same


def place_of(df: DataFrame, unique: str, key: object, sort_by: str) -> tuple[object, object]:
    """The pair that ``page_after`` needs of the row with a unique value; one row comes to the driver."""
    row = df.where(F.col(unique) == F.lit(key)).select(sort_by).first()
    if row is None:
        raise ValueError(f"no row with {unique} {key}")
    return row[0], key


def pivot_sum(
    df: DataFrame, rows: Sequence[str], column: str, values: Mapping[int, str], measure: str
) -> DataFrame:
    """Zero-filled matrix: one output column per listed value, ``other`` for the rest (values not
    listed and NULL), and the row total over all.

    The values are given, so no extra job looks for them.
    """
    listed = F.col(column).isin(list(values))
    sums = {
        name: F.coalesce(F.sum(F.when(F.col(column) == v, F.col(measure))), F.lit(0))
        for v, name in values.items()
    }
    sums["other"] = F.coalesce(
        F.sum(F.when(~F.coalesce(listed, F.lit(False)), F.col(measure))), F.lit(0)
    )
    return (
        df.groupBy(*rows)
        .agg(*[c.alias(name) for name, c in sums.items()])
        .withColumn("row_total", reduce(add, [F.col(n) for n in sums]))
    )
