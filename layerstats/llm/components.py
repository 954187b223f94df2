"""Connected components of a distributed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerstats.llm.store import files_for, written

#: Edges in a file.
EACH = 200_000


def components(edges: DataFrame, files: int | None = None) -> DataFrame:
    """node and root, the least node of its component, for every node of ``edges`` (a, b).

    Alternating stars: every node hangs its larger neighbours, then its smaller
    ones and itself, on its least neighbour, until nothing moves. Each round keeps
    the number of edges bounded by that of the last, and a hub's edges are reduced
    to its least neighbour before they are joined. Rounds are written tables, the first in
    ``files`` files at most, the others in as many as the edges of the last one need.
    """
    now = written(edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges", files)
    print_of = lambda df: df.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
    mark = print_of(now)
    while mark[0]:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a != b").distinct()
        # Now every edge leads from a smaller a to a larger b; b's smaller neighbours hang on the least.
        small = large.groupBy("b").agg(F.min("a").alias("m"))
        joined = large.join(small, "b")
        moved = joined.select(F.col("m").alias("a"), F.col("a").alias("b")).where("a != b")
        now = written(moved.unionByName(small.select(F.col("m").alias("a"), "b")).distinct(), "edges", files_for(edges.sparkSession, mark[0], EACH))
        before, mark = mark, print_of(now)
        if mark == before:
            break
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )
