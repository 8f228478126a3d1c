"""Names out of logins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def login_parts(login: Column) -> tuple[Column, Column]:
    """(first, last) of a ``first.last@host`` login; last is NULL when there is no dot."""
    words = F.split(F.split_part(login, F.lit("@"), F.lit(1)), r"\.")
    return F.get(words, F.lit(0)), F.get(words, F.lit(1))


def display_name(login: Column) -> Column:
    """``LAST First``, or the capitalised single name; NULL for a NULL login."""
    first, last = login_parts(login)
    return F.coalesce(F.concat(F.upper(last), F.lit(" "), F.initcap(first)), F.initcap(first))
