"""Connected components of a link table, by label propagation with pointer jumping; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame, limit: int = 64) -> DataFrame:
    """links (a, b) -> (node, comp), comp the smallest node of its component; only nodes that have a link.

    A round gives each node the smallest label among its neighbours and its own and then follows that label
    one step further, so that long chains are halved rather than walked. Labels are stored by round.
    """
    both = stored(links.select(F.col("a").alias("node"), F.col("b").alias("to")).union(links.select(F.col("b").alias("node"), F.col("a").alias("to"))).distinct())
    labels = stored(both.groupBy("node").agg(F.least(F.min("to"), F.first("node")).alias("comp")))
    for _ in range(limit):
        near = both.join(labels.withColumnRenamed("node", "to"), "to").groupBy("node").agg(F.min("comp").alias("near"))
        low = labels.join(near, "node").select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("comp").alias("further"))
        new = stored(low.join(jump, "low", "left").select("node", "old", F.least("low", F.coalesce("further", "low")).alias("comp")))
        if new.where("old <> comp").isEmpty():
            return new.select("node", "comp")
        labels = new.select("node", "comp")
    raise RuntimeError(f"labels still change after {limit} rounds")
