"""Connected components by rounds of contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subsmart.operators.spread import settle


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node reachable, for every node of ``links``.

    ``links`` has two long columns, ``a`` and ``b``, in one direction or both. In each
    round every node joins its first neighbour, twice over, and links inside a merged
    node go. First is the least in even rounds, so a group around its least node is done
    at once, and the least by a hash in odd ones, so chains shrink whatever their ids.
    Rounds grow with the logarithm of the longest chain and the work with the links.
    Results of rounds go to the shared folder.
    """
    edges = settle(links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct())
    steps: list[DataFrame] = []
    while not steps or edges.limit(1).count():
        rank = (lambda c: F.xxhash64(c, F.lit(len(steps)))) if len(steps) % 2 else F.col
        order = lambda c, rank=rank: F.struct(rank(c).alias("rank"), F.col(c).alias("node"))
        chosen = edges.groupBy("a").agg(F.least(order("a"), F.min(order("b")))["node"].alias("up"))
        above = chosen.select(F.col("a").alias("up"), F.col("up").alias("to"))
        merged = settle(chosen.join(above, "up").select("a", "to"))
        steps.append(merged)
        left = merged.withColumnRenamed("to", "x")
        right = merged.select(F.col("a").alias("b"), F.col("to").alias("y"))
        edges = settle(
            edges.join(left, "a")
            .join(right, "b")
            .filter("x <> y")
            .select(F.col("x").alias("a"), F.col("y").alias("b"))
            .distinct()
        )
    labels = steps[0].select(F.col("a").alias("node"), F.col("to").alias("root"))
    for merged in steps[1:]:
        moved = merged.withColumnRenamed("a", "root")
        labels = labels.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    labels = settle(labels)
    least = labels.groupBy("root").agg(F.min("node").alias("least"))
    return settle(labels.join(least, "root").select("node", F.col("least").alias("root")))
