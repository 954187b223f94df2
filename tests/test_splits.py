"""How many tasks the layers are built by."""

from layerstats.plans import layers
from layerstats.sources.shared import MIN_SPLITS, finer_splits
from layerstats import build_bronze, build_silver, football_plan
from layerstats.plans.football import RAW_COLUMNS


def test_a_small_table_is_several_tasks_a_core(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    spark.range(400_000).repartition(4 * cores).write.parquet(f"{tmp_path}/rows")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = lambda: spark.read.parquet(f"{tmp_path}/rows").rdd.getNumPartitions()
        assert rows() < 2 * cores
        with finer_splits(spark):
            assert rows() >= 3 * cores
            with finer_splits(spark):
                pass
            assert rows() >= 3 * cores
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert spark.conf.get(MIN_SPLITS, None) is None


def test_layers_are_built_by_finer_splits(spark, cfg, tmp_path, monkeypatch):
    seen, publish = [], layers.publish

    def watched(*args):
        seen.append(spark.conf.get(MIN_SPLITS, None))
        return publish(*args)

    monkeypatch.setattr(layers, "publish", watched)
    (tmp_path / "in.csv").write_text(f"{','.join(RAW_COLUMNS)}\n1,1,A,1,1,1%,1,1%,1,1,1,1,1\n")
    plan = football_plan()
    build_bronze(spark, f"{tmp_path}/in.csv", cfg, plan)
    spark.conf.set(MIN_SPLITS, "5")
    try:
        build_silver(spark, cfg, plan)
        assert spark.conf.get(MIN_SPLITS) == "5"
    finally:
        spark.conf.unset(MIN_SPLITS)
    assert seen == [str(3 * spark.sparkContext.defaultParallelism), "5"]
    assert spark.conf.get(MIN_SPLITS, None) is None
