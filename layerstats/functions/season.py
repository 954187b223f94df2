"""Season and round from a ``YYYY-round`` token such as ``2023-38``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from layerstats.functions.clean import integer_text

# Fixed value: four-digit year, hyphen, round; white space around them as around a bare number.
SEASON_TOKEN = r"^\s*([0-9]{4})-([0-9]+)\s*$"


def _part(column: Column | str, group: int) -> Column:
    return F.nullif(F.regexp_extract(column, SEASON_TOKEN, group), F.lit("")).try_cast("int")


def season_of(column: Column | str, default: int | None = None) -> Column:
    """Year of the token; ``default`` where the text is no token."""
    return F.coalesce(_part(column, 1), F.lit(default).cast("int"))


def round_of(column: Column | str) -> Column:
    """Round of the token; a bare round number is read as it stands."""
    return F.coalesce(_part(column, 2), integer_text(column))
