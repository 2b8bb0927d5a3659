"""Connected components of links between numbers, by hooking and pointer jumping.

In each round every component hooks onto its least neighbour, then chains of hooks are cut
short until each points at its end. What a round leaves is stored, so lineage stays short
and a lost executor costs that round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertally.llm.common import stored


def components(links: DataFrame, folder: str) -> DataFrame:
    """For each number in `a, b` the root of its component, a number of it."""
    edges = stored(links.select("a", "b").where("a <> b").distinct(), f"{folder}/edges-0")
    both = edges.union(edges.select("b", "a"))
    labels = both.select(F.col("a").alias("member")).distinct()
    labels = stored(labels.withColumn("root", F.col("member")), f"{folder}/labels-0")
    turn = 0
    while not edges.isEmpty():
        turn += 1
        both = edges.union(edges.select("b", "a"))
        hooks = both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.first("a"), F.min("b")).alias("parent")
        )
        hooks = stored(hooks, f"{folder}/hooks-{turn}-0")
        jump = 0
        while True:
            jump += 1
            ends = hooks.select(F.col("node").alias("parent"), F.col("parent").alias("end"))
            hooks = stored(
                hooks.join(ends, "parent").select("node", F.col("end").alias("parent"), (F.col("end") != F.col("parent")).alias("moved")),
                f"{folder}/hooks-{turn}-{jump}",
            )
            done = hooks.where("moved").isEmpty()
            hooks = hooks.select("node", "parent")
            if done:
                break
        roots = hooks.select(F.col("node").alias("root"), F.col("parent").alias("new"))
        labels = stored(
            labels.join(roots, "root", "left").select(
                "member", F.coalesce("new", "root").alias("root")
            ),
            f"{folder}/labels-{turn}",
        )
        one = roots.select(F.col("root").alias("a"), F.col("new").alias("new_a"))
        two = roots.select(F.col("root").alias("b"), F.col("new").alias("new_b"))
        moved = edges.join(one, "a").join(two, "b").where("new_a <> new_b")
        edges = stored(
            moved.select(F.col("new_a").alias("a"), F.col("new_b").alias("b")).distinct(),
            f"{folder}/edges-{turn}",
        )
    return labels
