"""Connected components of a table of links, by contraction, without collecting links."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (columns a, b of one type); equal labels mean connected.

    Each round every node goes to the neighbour (or itself) whose hash is smallest,
    with hashes of that round's own, and links between what is left go on. Chains
    shrink by a constant share a round whatever their ids, a star in one round. A
    minimum combines before its shuffle, so a hub's links never meet in one task;
    each round is a stored table, so lost executors cost no earlier round.
    """
    links = materialize(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    steps: list[DataFrame] = []
    while links.head(1):
        rank = F.xxhash64("b", F.lit(len(steps)))
        both = links.union(links.select("b", "a"))
        near = both.groupBy("a").agg(F.min(F.struct(rank.alias("rank"), F.col("b").alias("to"))).alias("near"))
        own = F.xxhash64("a", F.lit(len(steps)))
        step = near.select(F.col("a").alias("node"), F.when(F.struct(own, "a") < F.col("near"), F.col("a")).otherwise(F.col("near.to")).alias("label"))
        step = materialize(step, "component-step")
        left, right = (step.select(F.col("node").alias(c), F.col("label").alias(f"{c}2")) for c in "ab")
        moved = links.join(left, "a").join(right, "b").where("a2 <> b2").select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b"))
        links = materialize(moved.distinct(), "links")
        steps.append(step)
    if not steps:
        return links.select(F.col("a").alias("node"), F.col("b").alias("label"))

    def follow(found: DataFrame, step: DataFrame) -> DataFrame:
        later = step.select(F.col("node").alias("label"), F.col("label").alias("later"))
        return found.join(later, "label", "left").select("node", F.coalesce("later", "label").alias("label"))

    return reduce(follow, steps)
