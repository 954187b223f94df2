"""Build all layers from football statistics files and show what came out."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from layerstats import (
    BRONZE,
    GOLD,
    SILVER,
    LayerConfig,
    football_plan,
    read_layer,
    run_layers,
    run_reports,
    verify_layer,
)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("input", help="CSV file, folder or pattern")
    parser.add_argument("base", help="folder of the layers")
    parser.add_argument("--database", help="existing database to register the tables in")
    parser.add_argument("--provider", default="parquet", help="table format")
    parser.add_argument("--season", type=int, default=2023, help="season of all rows")
    parser.add_argument("--infer-schema", action="store_true", help="type Bronze by its values")
    parser.add_argument("--sort", action="store_true", help="write Gold in key order")
    options = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("football statistics").getOrCreate()
    cfg = LayerConfig(options.base, options.provider, options.database)
    plan = football_plan(season=options.season, infer_schema=options.infer_schema)
    run_layers(spark, options.input, cfg, plan, sort=options.sort)

    tables = [(BRONZE, plan.bronze), (SILVER, plan.silver)]
    tables += [(GOLD, summary.name) for summary in plan.summaries]
    for layer, name in tables:
        print(f"{layer}: {name}")
        check = verify_layer(read_layer(spark, cfg, layer, name))
        check.schema.show(50, truncate=False)
        check.sample.show(truncate=False)
    for name, report in run_reports(spark, cfg, plan).items():
        print(name)
        report.show(truncate=False)


if __name__ == "__main__":
    main()
