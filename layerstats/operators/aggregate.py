"""Per-group counts, rounded means and totals, one table or several per scan."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerstats.sources.shared import remove_dir, shared_dir

LEVEL = "grouping_level"


@dataclass(frozen=True)
class Summary:
    """A table of grouped statistics: source column -> output column.

    ``counts`` counts non-NULL values, ``means`` are rounded half up to
    ``scale`` digits, ``sums`` add up. ``exact`` takes the means in decimal
    arithmetic, which gives the same digits whatever order the rows are added
    in; a value that needs more than six decimals beyond ``scale``, or is not
    finite, is an error. Means of whole numbers do not need it while a group's
    sum stays below 2^53.
    """

    name: str
    keys: tuple[str, ...]
    counts: Mapping[str, str] = field(default_factory=dict)
    means: Mapping[str, str] = field(default_factory=dict)
    sums: Mapping[str, str] = field(default_factory=dict)
    scale: int = 2
    exact: bool = False

    def measures(self) -> dict[str, tuple[str, Column]]:
        """Output column -> (a name for what it computes, the aggregate)."""
        out = {}
        for source, alias in self.counts.items():
            out[alias] = (f"count {source}", F.count(source))
        for source, alias in self.means.items():
            label = f"mean {source} {self.scale} {self.exact}"
            out[alias] = (label, rounded_mean(source, self.scale, self.exact))
        for source, alias in self.sums.items():
            out[alias] = (f"sum {source}", F.sum(source))
        return out


def rounded_mean(column: str, scale: int = 2, exact: bool = False) -> Column:
    """The mean to ``scale`` decimals; ``exact`` adds up decimals with six more than that.

    A value that these cannot hold to its last digit is an error, never rounded.
    """
    if exact:
        value = F.col(column).try_cast(f"decimal(30,{scale + 6})")
        refuse = F.raise_error(F.concat(F.lit(f"{column} has no exact mean: "), F.col(column)))
        held = F.when(value.cast("double") == F.col(column).cast("double"), value)
        value = F.when(F.col(column).isNotNull(), F.coalesce(held, refuse))
        return F.round(F.avg(value), scale).cast("double")
    return F.round(F.avg(column), scale)


def summarise(df: DataFrame, summary: Summary) -> DataFrame:
    """One summary table: partial aggregation, one shuffle of group rows."""
    return df.groupBy(*summary.keys).agg(
        *[column.alias(alias) for alias, (_, column) in summary.measures().items()]
    )


def summarise_together(df: DataFrame, summaries: Sequence[Summary]) -> dict[str, DataFrame]:
    """Several summary tables as projections of one aggregation over one scan.

    Tables with the same keys share their groups and any common measures;
    tables with other keys become further grouping sets. Each frame depends on
    the whole aggregation: to use more than one, see :func:`shared_summaries`.
    """
    shared = _grouped(df, summaries)
    return {summary.name: _pick(shared, summary, summaries) for summary in summaries}


@contextmanager
def shared_summaries(
    df: DataFrame, summaries: Sequence[Summary], otherwise: str | None = None
) -> Iterator[dict[str, DataFrame]]:
    """:func:`summarise_together`, with the aggregation run once for all tables.

    The group rows, never the input, are kept in the shared folder (see
    :func:`shared_dir` for ``otherwise``) for the length of the block. Unlike
    persisted blocks they outlive the executors that made them, and adaptive
    execution sizes their partitions.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "summaries", otherwise)
    try:
        grouped = _grouped(df, summaries)
        grouped.write.partitionBy(LEVEL).parquet(path)
        shared = spark.read.schema(grouped.schema).parquet(path)
        yield {summary.name: _pick(shared, summary, summaries) for summary in summaries}
    finally:
        remove_dir(spark, path)


def _all_keys(summaries: Sequence[Summary]) -> list[str]:
    return list(dict.fromkeys(key for summary in summaries for key in summary.keys))


def _grouped(df: DataFrame, summaries: Sequence[Summary]) -> DataFrame:
    keys = _all_keys(summaries)
    sets = list(dict.fromkeys(tuple(k for k in keys if k in s.keys) for s in summaries))
    aggregates = dict(m for summary in summaries for m in summary.measures().values())
    columns = [column.alias(label) for label, column in aggregates.items()]
    if len(sets) == 1:
        return df.groupBy(*keys).agg(F.lit(0).cast("long").alias(LEVEL), *columns)
    return df.groupingSets([[F.col(k) for k in s] for s in sets], *keys).agg(
        F.grouping_id().alias(LEVEL), *columns
    )


def _pick(shared: DataFrame, summary: Summary, summaries: Sequence[Summary]) -> DataFrame:
    # Spark's grouping id has one bit per key, first key highest, set where the
    # key is not part of the row's grouping set.
    level = 0
    for key in _all_keys(summaries):
        level = 2 * level + (key not in summary.keys)
    return shared.where(F.col(LEVEL) == level).select(
        *summary.keys,
        *[F.col(f"`{label}`").alias(alias) for alias, (label, _) in summary.measures().items()],
    )


def profile(
    df: DataFrame,
    keys: Sequence[str],
    event: str,
    metrics: Iterable[str],
    count_name: str = "matches",
    scale: int = 2,
    exact: bool = False,
) -> DataFrame:
    """Count of events and ``avg_<metric>`` per group."""
    means = {metric: f"avg_{metric}" for metric in metrics}
    return summarise(
        df, Summary("profile", tuple(keys), {event: count_name}, means, {}, scale, exact)
    )


def totals(df: DataFrame, keys: Sequence[str], metrics: Iterable[str]) -> DataFrame:
    """``total_<metric>`` per group."""
    sums = {metric: f"total_{metric}" for metric in metrics}
    return summarise(df, Summary("totals", tuple(keys), sums=sums))
