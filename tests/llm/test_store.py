"""What operators leave in the shared folder."""

import os

import pytest
from pyspark.sql import functions as F

from layerstats.llm import jaccard_join, pitman_yor, suffix_dedup, topk
from layerstats.llm.store import settled, shared_folder, written


def names(spark):
    folder = shared_folder(spark).removeprefix("file:")
    return {n for n in os.listdir(folder)} if os.path.isdir(folder) else set()


def test_what_was_written_on_the_way_goes(spark):
    before = names(spark)

    def make():
        inner = settled(spark, lambda: written(spark.range(5), "deep").where("id > 0"), "inner")
        return written(inner, "middle").where("id > 1")

    table = settled(spark, make, "outer")
    assert sorted(r.id for r in table.collect()) == [2, 3, 4]
    assert {n.split("-")[0] for n in names(spark) - before} == {"outer"}


def test_what_was_written_goes_when_the_work_fails(spark):
    before = names(spark)
    with pytest.raises(ValueError):
        settled(spark, lambda: [written(spark.range(5), "lost"), int("x")][0], "outer")
    assert names(spark) == before


def test_operators_leave_their_results_alone(spark, documents):
    docs = spark.createDataFrame([d[:2] for d in documents[:80]], "doc_id long, text string")
    runs = {
        "classes": lambda: jaccard_join.join(docs),
        "spans": lambda: suffix_dedup.remove_repeats(docs),
        "best": lambda: topk.search(docs, F.col("doc_id") % 20 == 0),
        "scores": lambda: pitman_yor.score(docs, F.col("doc_id") % 7 != 2),
    }
    for name, run in runs.items():
        before = names(spark)
        assert run().count() > 0
        assert {n.split("-")[0] for n in names(spark) - before} == {name}
