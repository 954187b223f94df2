import math
import os
import random
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from layerstats import Summary, profile, shared_summaries, summarise, summarise_together, totals

from planned import final_plan

KEYS = ("season", "club")


def make(spark, n=5000, seed=3, hot=0.4):
    """Rows of which one club holds a large part."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        club = "hot" if rng.random() < hot else rng.choice([None, "a", "b", "c"])
        rows.append(
            (
                None if rng.random() < 0.1 else i,
                rng.choice([2022, 2023]),
                rng.choice([None, 1, 2, 3]),
                club,
                rng.randint(0, 40),
                float(rng.randint(0, 100)),
                rng.choice([None, 0, 1]),
            )
        )
    schema = "id int, season int, round int, club string, shots int, pct double, cards int"
    return rows, spark.createDataFrame(rows, schema).repartition(7)


def half_up(values):
    if not values:
        return None
    mean = sum(map(Fraction, values)) / len(values)
    mean = Decimal(mean.numerator) / Decimal(mean.denominator)
    return float(mean.quantize(Decimal("0.01"), ROUND_HALF_UP))


def brute(rows, key):
    groups = {}
    for row in rows:
        groups.setdefault(key(row), []).append(row)
    return {
        k: (
            sum(r[0] is not None for r in g),
            half_up([r[4] for r in g]),
            half_up([r[5] for r in g]),
            sum(r[6] for r in g if r[6] is not None),
        )
        for k, g in groups.items()
    }


def test_against_brute_force(spark):
    rows, df = make(spark)
    expected = brute(rows, lambda r: (r[1], r[3]))
    got = profile(df, KEYS, "id", ("shots", "pct"))
    assert got.columns == ["season", "club", "matches", "avg_shots", "avg_pct"]
    assert {tuple(r)[:2]: tuple(r)[2:] for r in got.collect()} == {k: v[:3] for k, v in expected.items()}
    cards = totals(df, KEYS, ("cards",))
    assert cards.dtypes[-1] == ("total_cards", "bigint")
    assert {tuple(r)[:2]: r.total_cards for r in cards.collect()} == {k: v[3] for k, v in expected.items()}


SUMMARIES = (
    Summary("by_club", KEYS, {"id": "n"}, {"shots": "m_shots", "pct": "m_pct"}),
    Summary("by_round", ("season", "round"), {"id": "entries"}, {"shots": "r_shots"}),
    Summary("cards", ("club", "season"), sums={"cards": "total"}),
    Summary("overall", (), {"id": "n"}, {"pct": "m"}, scale=1),
)


def as_set(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_together_equals_one_by_one(spark):
    _, df = make(spark)
    together = summarise_together(df, SUMMARIES)
    with shared_summaries(df, SUMMARIES) as shared:
        for summary in SUMMARIES:
            alone = summarise(df, summary)
            assert together[summary.name].dtypes == alone.dtypes
            assert as_set(together[summary.name]) == as_set(alone) == as_set(shared[summary.name])
        assert shared["cards"].columns == ["club", "season", "total"]


def test_keys_may_be_measured_too(spark):
    """A grouping set without a key must not blank it for the aggregates."""
    _, df = make(spark, 500)
    summaries = (
        Summary("a", KEYS, {"club": "n", "round": "r"}, {"round": "m"}),
        Summary("b", ("season", "round"), {"club": "clubs"}, {"season": "s"}, {"round": "t"}),
    )
    together = summarise_together(df, summaries)
    for summary in summaries:
        assert as_set(together[summary.name]) == as_set(summarise(df, summary))


def test_same_keys_need_no_grouping_sets(spark):
    _, df = make(spark, 50)
    tables = summarise_together(df, (SUMMARIES[0], SUMMARIES[2]))
    assert "Expand" not in final_plan(tables["cards"])
    assert as_set(tables["cards"]) == as_set(summarise(df, SUMMARIES[2]))


def test_shared_rows_are_released(spark):
    _, df = make(spark, 50)
    root = spark.conf.get("spark.checkpoint.dir")
    kept = lambda: [name for name in os.listdir(root) if name.startswith("summaries-")]
    with pytest.raises(KeyError):
        with shared_summaries(df, SUMMARIES) as tables:
            tables["by_club"].collect()
            assert len(kept()) == 1
            raise KeyError
    assert kept() == []


def test_unreadable_ids_are_averaged_but_not_counted(spark):
    df = spark.createDataFrame([(None, 1, "a", 4), (7, 1, "a", 2)], "id int, season int, club string, n int")
    assert tuple(profile(df, KEYS, "id", ("n",)).first()) == (1, "a", 1, 3.0)


def test_not_a_number_spreads_and_ties_round_up(spark):
    rows = [(1, 1, "a", float("nan")), (2, 1, "a", 1.0)]
    df = spark.createDataFrame(rows, "id int, season int, club string, n double")
    assert math.isnan(profile(df, KEYS, "id", ("n",)).first().avg_n)
    rows = [(i, 1, "a", 1522 if i == 0 else 0) for i in range(80)]
    ties = spark.createDataFrame(rows, "id int, season int, club string, n int")
    assert profile(ties, KEYS, "id", ("n",)).first().avg_n == 19.03


def test_exact_means_do_not_depend_on_row_order(spark):
    rng = random.Random(5)
    values = [rng.randint(1, 10**7) / 100 for _ in range(4001)]
    rows = [(i, 1, "a", v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "id int, season int, club string, n double")
    expected = half_up([Decimal(str(v)) for v in values])
    for parts in (1, 5, 13):
        assert profile(df.repartition(parts), KEYS, "id", ("n",), exact=True).first().avg_n == expected


def test_exact_means_leave_out_nulls_and_refuse_what_they_cannot_hold(spark, ansi):
    def mean(*values):
        rows = [(i, 1, "a", v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, "id int, season int, club string, n double")
        return profile(df, KEYS, "id", ("n",), exact=True).first().avg_n

    assert mean(1.0, None, 2.01) == 1.51
    assert mean(None) is None
    assert mean(1.0, 1e12) == 500000000000.5
    assert mean(0.0000004, 0.0000004) == 0.0
    for value in (float("nan"), float("inf"), 1e25, 1 / 3):
        with pytest.raises(PySparkException, match="no exact mean"):
            mean(1.0, value)


def test_one_shuffle_of_pre_aggregated_rows(spark, tmp_path):
    _, df = make(spark, 4000)
    df.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    plan = final_plan(profile(stored, KEYS, "id", ("shots",)))
    final = plan[: plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert final.count("Exchange hashpartitioning") == 1
    assert "partial_avg(shots" in final and "Python" not in final
    assert "pct" not in plan and "cards" not in plan


def test_hot_club_shuffles_a_row_per_task(spark, tmp_path):
    """Groups are reduced before the shuffle, so a hot one is no burden after it."""
    rows = spark.range(0, 200000, 1, 8).select(
        F.col("id").cast("int"),
        F.lit(2023).alias("season"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 20)).alias("club"),
        (F.col("id") % 10).cast("int").alias("shots"),
    )
    got = profile(rows, KEYS, "id", ("shots",))
    got.collect()
    plan = got._jdf.queryExecution().executedPlan()
    nodes, written = [plan], []
    while nodes:
        node = nodes.pop()
        name = node.getClass().getSimpleName()
        if name == "ShuffleExchangeExec":
            written.append(node.metrics().apply("shuffleRecordsWritten").value())
        if name == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            nodes.append(node.plan())
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    assert len(written) == 1 and written[0] <= 8 * 21
