"""Raw rows to the typed, zero-filled statistics grain."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from layerstats.functions.clean import (
    count_value,
    integer_text,
    percent_value,
    strict_double_value,
    strict_int_value,
)

KINDS = {
    "count": count_value,
    "percent": percent_value,
    "strict_int": strict_int_value,
    "strict_double": strict_double_value,
}


@dataclass(frozen=True)
class Measure:
    """A statistic, how its text is read, and what stands in for no value."""

    name: str
    kind: str = "count"
    default: float = 0

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown kind {self.kind!r}; one of {', '.join(KINDS)}")

    def column(self) -> Column:
        return KINDS[self.kind](self.name, self.default).alias(self.name)


@dataclass(frozen=True)
class ConformSpec:
    """What the columns of a statistics file are.

    Names other than those in ``renames`` are names after renaming. ``season``
    is a constant or an expression over the renamed columns; ``period_number``
    an expression, by default the period text read as a whole number.
    ``source`` carries the provenance column over under a new name.
    """

    event: str
    entity: str
    period_text: str
    period_number: str
    measures: tuple[Measure, ...]
    season: int | Column
    season_name: str = "season"
    period_expression: Column | None = None
    renames: Mapping[str, str] = field(default_factory=dict)
    source: tuple[str, str] | None = None


def conform(df: DataFrame, spec: ConformSpec) -> DataFrame:
    """Rename, clean, type and zero-fill in one row-local projection.

    Renames of absent columns are skipped; a column the specification needs and
    the frame lacks is an analysis error. Names match without regard to case.
    """
    df = df.withColumnsRenamed(dict(spec.renames))
    period = spec.period_expression
    if period is None:
        period = _whole_number(df, spec.period_text)
    season = spec.season if isinstance(spec.season, Column) else F.lit(spec.season)
    source = [F.col(spec.source[0]).alias(spec.source[1])] if spec.source else []
    return df.select(
        _whole_number(df, spec.event).alias(spec.event),
        F.col(spec.period_text).cast("string").alias(spec.period_text),
        F.trim(F.col(spec.entity).cast("string")).alias(spec.entity),
        *[measure.column() for measure in spec.measures],
        *source,
        season.cast("int").alias(spec.season_name),
        period.alias(spec.period_number),
    )


def _whole_number(df: DataFrame, name: str) -> Column:
    """An inferred number is cast; text is read."""
    if isinstance(df.select(name).schema[0].dataType, NumericType):
        return F.col(name).try_cast("int")
    return integer_text(name)
