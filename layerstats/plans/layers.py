"""Bronze, Silver and Gold, one after the other."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from layerstats.operators.aggregate import Summary, shared_summaries
from layerstats.operators.conform import ConformSpec, conform
from layerstats.operators.report import Report, run_report
from layerstats.sources.delimited import ingest_csv
from layerstats.sources.layers import BRONZE, GOLD, SILVER, LayerConfig, publish, publish_all, read_layer, stage
from layerstats.sources.shared import finer_splits


@dataclass(frozen=True)
class LayerPlan:
    """A statistics file's table names, cleaning, summaries and reports."""

    bronze: str
    silver: str
    spec: ConformSpec
    summaries: tuple[Summary, ...]
    reports: tuple[Report, ...] = ()
    schema: StructType | str | None = None
    infer_schema: bool = False
    delimiter: str = ","


def build_bronze(spark: SparkSession, path: str, cfg: LayerConfig, plan: LayerPlan) -> DataFrame:
    """The files as they are; with inference, period and entity are text still."""
    spec = plan.spec
    text = {spec.period_text.lower(), spec.entity.lower()}
    text |= {old for old, new in spec.renames.items() if new.lower() in text}
    with finer_splits(spark):
        raw = ingest_csv(spark, path, plan.schema, plan.infer_schema, plan.delimiter, as_text=text)
        return publish(raw, cfg, BRONZE, plan.bronze)


def build_silver(
    spark: SparkSession, cfg: LayerConfig, plan: LayerPlan, partition_by: tuple[str, ...] = ()
) -> DataFrame:
    bronze = read_layer(spark, cfg, BRONZE, plan.bronze)
    with finer_splits(spark):
        return publish(conform(bronze, plan.spec), cfg, SILVER, plan.silver, partition_by)


def build_gold(
    spark: SparkSession,
    cfg: LayerConfig,
    plan: LayerPlan,
    sort: bool = False,
    silver: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All summary tables from a single scan of Silver, by default read by path.

    None of them takes its place before all are written.

    ``sort`` writes them in key order. Tables have no order and every report
    sorts for itself, so it is off unless somebody reads the files directly.
    """
    if silver is None:
        silver = read_layer(spark, cfg, SILVER, plan.silver)
    with finer_splits(spark), shared_summaries(silver, plan.summaries, f"{cfg.base}/staging") as tables:
        names = [summary.name for summary in plan.summaries]
        keys = [summary.keys if sort else () for summary in plan.summaries]
        staged = [
            partial(stage, tables[name], cfg, GOLD, name, sort_by=by) for name, by in zip(names, keys, strict=True)
        ]
        return dict(zip(names, publish_all(spark, staged), strict=True))


def run_layers(
    spark: SparkSession,
    path: str,
    cfg: LayerConfig,
    plan: LayerPlan,
    partition_by: tuple[str, ...] = (),
    sort: bool = False,
) -> dict[str, DataFrame]:
    """Rebuild every layer from the files at ``path``; an error stops the run.

    Each layer is written before the next one reads it back, so a rerun or a
    lost executor never has to go further back than one layer.
    """
    build_bronze(spark, path, cfg, plan)
    silver = build_silver(spark, cfg, plan, partition_by)
    return build_gold(spark, cfg, plan, sort, silver)


def run_reports(spark: SparkSession, cfg: LayerConfig, plan: LayerPlan) -> dict[str, DataFrame]:
    """The plan's reports over the published tables, by catalog name."""
    return {
        report.name: run_report(spark.table(cfg.table(report.table)), report)
        for report in plan.reports
    }
