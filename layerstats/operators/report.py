"""Latest-season, top-N reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, season: str) -> DataFrame:
    """The rows of the highest season.

    The highest season is a scalar subquery: found once, by an aggregation that
    reads the season column alone, then pushed to the scan as a filter. On rows
    that are yet to be summarised by season, filter before summarising: the
    other seasons are then never aggregated.
    """
    return df.where(F.col(season) == df.agg(F.max(season)).scalar())


def top_n(
    df: DataFrame,
    order: Sequence[tuple[str, str]],
    n: int = 10,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """First ``n`` rows in the given order: per-task heaps, no global sort.

    ``order`` pairs a column with ``"asc"`` (NULL first) or ``"desc"`` (NULL
    last). ``tie_break`` columns, ascending, decide between equal rows.
    """
    directions = {"asc": F.asc_nulls_first, "desc": F.desc_nulls_last}
    columns = [directions[direction](name) for name, direction in order]
    return df.orderBy(*columns, *[F.asc_nulls_first(name) for name in tie_break]).limit(n)


@dataclass(frozen=True)
class Report:
    """A latest-season, top-N question to a summary table."""

    name: str
    table: str
    season: str
    columns: tuple[str, ...]
    order: tuple[tuple[str, str], ...]
    tie_break: tuple[str, ...] = ()
    n: int = 10


def run_report(table: DataFrame, report: Report) -> DataFrame:
    chosen = latest(table.select(*report.columns), report.season)
    return top_n(chosen, report.order, report.n, report.tie_break)
