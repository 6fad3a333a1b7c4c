"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import written


def connected(links: DataFrame, kind: str = "components") -> DataFrame:
    """(id, label): the smallest id reachable from each id in ``links`` (a, b; both long, no nulls).

    Each round hooks every label to the smallest one next to it, follows these
    hooks to their ends by doubling, and replaces the links by links between
    labels. Rounds and doublings are logarithmic in the number of ids. Every
    step is a written table, so nothing but a number reaches the driver.
    """
    links = written(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), kind)
    both = links.select(F.col("a").alias("id")).union(links.select("b"))
    labels = written(both.distinct().withColumn("label", F.col("id")), kind)
    while not links.isEmpty():
        # b hooks to its smallest neighbour below it; ids without one are ends.
        hooks = written(links.groupBy(F.col("b").alias("x")).agg(F.min("a").alias("to")), kind)
        while True:
            far = hooks.select(F.col("x").alias("to"), F.col("to").alias("further"))
            doubled = hooks.join(far, "to", "left")
            hooks = written(doubled.select("x", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")), kind)
            moved = not hooks.where("moved").isEmpty()
            hooks = hooks.drop("moved")
            if not moved:
                break
        labels = written(labels.join(hooks, labels["label"] == hooks["x"], "left").select("id", F.coalesce("to", "label").alias("label")), kind)
        at_a, at_b = (hooks.select(F.col("x").alias(k), F.col("to").alias(f"{k}_to")) for k in "ab")
        moved = links.join(at_a, "a", "left").join(at_b, "b", "left").select(F.coalesce("a_to", "a").alias("a"), F.coalesce("b_to", "b").alias("b"))
        links = written(moved.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), kind)
    return labels
