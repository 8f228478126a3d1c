"""Normalised floors, rooms, organisations and bookable items."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opsmart.functions.text import clean_text, first_match, is_missing, norm, relabel

# The words the exports use and the labels the marts show.
FLOOR_PREFIXES = {
    "1èr": "premier étage",
    "2ème": "deuxième étage",
    "9ème": "neuvième étage",
    "rdc": "rez de chaussée",
}
NUMBERED_ROOMS = range(1, 25)
ROOM_PREFIX = "salle "
ROOM_INFIXES = {
    "open space": "open space",
    "grande terrasse": "grande terrasse",
    "petite terrasse": "petite terrasse",
    "tesrrasse c": "terrasse",
}
SHARED_STORAGE = "costorage"
NOT_AVAILABLE = "n/a"
LEASED = "loué"
NOT_LEASED = "non loué"
RESERVABLE = "réser"
PER_PERSON = "personne"
DASHES = "–—−"
ROOM_AT_END = r"(?i) ?\( ?s ?-? ?(\d+) ?\)$"
ITEM_ROOM = " - Salle $1"


def floor_label(c: Column) -> Column:
    """Ordinal floors spelled out; other text normalised."""
    return relabel(c, prefixes=FLOOR_PREFIXES)


def room_label(c: Column) -> Column:
    """``salle NN`` for text that ends in 01..24, then the named areas, else normalised text."""
    number = F.right(norm(c), F.lit(2))
    numbered = number.isin([f"{n:02d}" for n in NUMBERED_ROOMS])
    return F.when(numbered, F.concat(F.lit(ROOM_PREFIX), number)).otherwise(
        relabel(c, infixes=ROOM_INFIXES)
    )


def organization_type_label(c: Column) -> Column:
    """Shared storage under one name; missing becomes ``n/a``."""
    return first_match(
        [(F.contains(norm(c), F.lit(SHARED_STORAGE)), SHARED_STORAGE)],
        clean_text(c, NOT_AVAILABLE),
    )


def space_type_label(c: Column, status: Column) -> Column:
    """The space type, or the occupancy status where it is missing."""
    return F.when(is_missing(c), norm(status)).otherwise(norm(c))


def has_status(status: Column, exactly: str | None = None, mentions: str | None = None) -> Column:
    """Occupancy status test on normalised text."""
    if exactly is not None:
        return norm(status) == F.lit(exactly)
    return F.contains(norm(status), F.lit(mentions))


def occupancy_band(rate: Column) -> Column:
    """red above 100 %, amber below 40 %, else green."""
    return first_match([(rate > 100, "red"), (rate < 40, "amber")], F.lit("green"))


def item_label(c: Column) -> Column:
    """Tidy item name; a closing ``(S-4)`` reads `` - Salle 4``.

    White space is collapsed, dashes unified, a dash between two word characters becomes a space.
    """
    dashed = F.regexp_replace(c, rf"[{DASHES}]", "-")
    spaced = F.regexp_replace(dashed, r"\s+|\b-\b", " ")
    return F.trim(F.regexp_replace(F.trim(spaced), ROOM_AT_END, ITEM_ROOM))


