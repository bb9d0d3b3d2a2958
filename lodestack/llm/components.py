"""Connected components of a graph given as edges, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of all ends of `edges` (columns a, b): the least id that can be reached.

    Every round takes the least label among neighbours, then the label's own label, so that the rounds grow with the
    logarithm of the longest path. The least labels are gathered before they are shuffled, and a much-linked id lies in
    a join that can be split, so no task holds all neighbours of one id. Null ends are passed over.
    """
    pairs = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    both = cut(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("l")))
    while True:
        near = both.join(labels.select(F.col("a").alias("b"), "l"), "b").groupBy("a").agg(F.min("l").alias("m"))
        low = labels.join(near, "a").select("a", "l", F.least("l", "m").alias("m"))
        jump = labels.select(F.col("a").alias("m"), F.col("l").alias("j"))
        new = cut(low.join(jump, "m", "left").select("a", "l", F.least("m", F.coalesce("j", "m")).alias("m")))
        if new.where("l <> m").isEmpty():
            return new.select(F.col("a").alias("id"), F.col("m").alias("component"))
        labels = new.select("a", F.col("m").alias("l"))
