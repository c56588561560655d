"""Connected components of links, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def components(links: DataFrame) -> DataFrame:
    """node, comp for each node of links (a long, b long): comp is the least node reachable.

    Each round a node takes the least label among its neighbours' and its own, then the
    label of that label; rounds grow with the logarithm of the longest path. Tables
    are staged after each round, nothing is collected but one count.
    """
    both = stage(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a != b").distinct(), "links")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("comp")), "labels")
    while True:
        heard = both.join(labels.withColumnRenamed("node", "a"), "a").groupBy(F.col("b").alias("node")).agg(F.min("comp").alias("heard"))
        new = labels.join(heard, "node").select("node", F.col("comp").alias("old"), F.least("comp", "heard").alias("comp"))
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("further"))
        new = stage(new.join(jump, "comp").select("node", "old", F.least("comp", "further").alias("comp")), "labels")
        if not new.where("old != comp").take(1):
            return new.select("node", "comp")
        labels = new.select("node", "comp")
