"""Text cleaning and text predicates."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for "no value" in the exports.
BLANK = ""
DASH = "-"


def norm(c: Column) -> Column:
    """Lower-case, trimmed."""
    return F.lower(F.trim(c))


def is_missing(c: Column, sentinels: Iterable[str] = (BLANK, DASH)) -> Column:
    """NULL, or one of the texts that stand for it. Never NULL itself."""
    return c.isNull() | F.trim(c).isin(*sentinels)


def clean_text(c: Column, default: str | None = None) -> Column:
    """Normalised text; missing becomes ``default`` (NULL when not given)."""
    return F.when(is_missing(c), F.lit(default)).otherwise(norm(c))


def clean_str(c: Column) -> Column:
    """Trimmed text with its case kept; blank becomes NULL."""
    return F.nullif(F.trim(c), F.lit(BLANK))


def first_match(
    rules: Iterable[tuple[Column, Column | str | None]], otherwise: Column | None = None
) -> Column:
    """Searched CASE: the value of the first rule that holds."""
    case = None
    for test, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        case = F.when(test, value) if case is None else case.when(test, value)
    if case is None:
        return F.lit(None) if otherwise is None else otherwise
    return case if otherwise is None else case.otherwise(otherwise)


def relabel(
    c: Column,
    prefixes: Mapping[str, str] | None = None,
    suffixes: Mapping[str, str] | None = None,
    infixes: Mapping[str, str] | None = None,
) -> Column:
    """Replace normalised text by the label of the first prefix/suffix/infix it shows."""
    text = norm(c)
    rules = [(F.startswith(text, F.lit(k)), v) for k, v in (prefixes or {}).items()]
    rules += [(F.endswith(text, F.lit(k)), v) for k, v in (suffixes or {}).items()]
    rules += [(F.contains(text, F.lit(k)), v) for k, v in (infixes or {}).items()]
    return first_match(rules, text)


def label_or(c: Column, fallback: Column | str) -> Column:
    """``c``, or the fallback when it is NULL or empty."""
    fallback = fallback if isinstance(fallback, Column) else F.lit(fallback)
    return F.coalesce(F.nullif(c, F.lit(BLANK)), fallback)


def as_text(c: Column) -> Column:
    """Dates and numbers the way a serving query shows them."""
    return c.cast("string")


def stamp_text(c: Column) -> Column:
    """A timestamp with its UTC offset, the way the serving database shows it."""
    return F.concat(c.cast("string"), F.lit("+00"))


def natural_key(*parts: Column, null_marker: str | None = "∅") -> Column:
    """Parts joined by a pipe.

    ``concat_ws`` skips NULL parts, which makes ``(a, NULL, c)`` and ``(a, c)`` the same key;
    the marker keeps them apart. Pass ``null_marker=None`` for the plain joined form.
    """
    if null_marker is not None:
        parts = tuple(F.coalesce(p, F.lit(null_marker)) for p in parts)
    return F.concat_ws("|", *parts)
