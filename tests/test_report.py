from layerstats import Report, Summary, latest, run_report, summarise, top_n, verify_layer

from planned import final_plan

SCHEMA = "season int, club string, a double, b int"
ROWS = [
    (2022, "old", 99.0, 9),
    (2023, "x", 5.0, 1),
    (2023, "y", None, 4),
    (2023, None, 5.0, 2),
    (2023, "w", 5.0, 3),
    (2023, "z", 7.0, 3),
    (None, "none", 100.0, 1),
]


def clubs(df):
    return [row.club for row in df.collect()]


def test_latest_season(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert sorted(map(str, clubs(latest(df, "season")))) == ["None", "w", "x", "y", "z"]
    assert latest(df.where("season is null"), "season").count() == 0
    assert latest(df.limit(0), "season").count() == 0


def test_order_nulls_and_ties(spark):
    df = latest(spark.createDataFrame(ROWS, SCHEMA), "season")
    assert clubs(top_n(df, (("a", "desc"),), 10, ("club",))) == ["z", None, "w", "x", "y"]
    assert clubs(top_n(df, (("a", "asc"),), 3, ("club",))) == ["y", None, "w"]
    assert clubs(top_n(df, (("a", "desc"), ("b", "desc")), 3)) == ["z", "w", None]


def test_report(spark):
    report = Report("r", "t", "season", ("season", "club", "a"), (("a", "desc"),), ("club",), 2)
    got = run_report(spark.createDataFrame(ROWS, SCHEMA), report)
    assert [tuple(row) for row in got.collect()] == [(2023, "z", 7.0), (2023, None, 5.0)]


def test_heaps_instead_of_a_sort_and_a_season_found_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame(ROWS, SCHEMA).repartition(4).write.parquet(path)
    rows = latest(spark.read.parquet(path), "season")
    table = summarise(rows, Summary("s", ("season", "club"), means={"a": "m"}))
    plan = final_plan(top_n(table, (("m", "desc"),), 10, ("club",)))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
    # The season is found once, from one column, and filters below the aggregation.
    assert plan.index("partial_avg") < plan.index("Filter")
    assert "ReadSchema: struct<season:int>" in plan and "ReusedSubquery" in plan


def test_verify_layer(spark):
    check = verify_layer(spark.createDataFrame(ROWS, SCHEMA), rows=3)
    assert [tuple(row) for row in check.schema.collect()] == [
        (1, "season", "int"),
        (2, "club", "string"),
        (3, "a", "double"),
        (4, "b", "int"),
    ]
    assert check.sample.count() == 3
    assert verify_layer(spark.createDataFrame(ROWS[:2], SCHEMA)).sample.count() == 2
