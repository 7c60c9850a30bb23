"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from each node of links (a, b).

    Rounds of least neighbour labels, each followed by a jump along labels, so
    long chains shorten by halves.  A round's labels are a written table: no
    lineage grows, and nothing is collected but a count.
    """
    both = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "labels")
    while True:
        near = both.join(labels, F.col("a") == F.col("node")).groupBy(F.col("b").alias("node")).agg(F.min("root").alias("least"))
        new = labels.join(near, "node", "left").select("node", F.col("root").alias("old"), F.least("root", "least").alias("root"))
        jump = labels.select(F.col("node").alias("at"), F.col("root").alias("far"))
        new = written(new.join(jump, F.col("root") == F.col("at"), "left").select(
            "node", "old", F.least("root", "far").alias("root")), "labels")
        if not new.where("old <> root").limit(1).count():
            return new.select("node", "root")
        labels = new.select("node", "root")
