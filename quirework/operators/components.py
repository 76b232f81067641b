"""Connected components of pairs, without gathering them anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.session import checkpoint


def least_labels(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(u, label) for each end of the pairs (a, b): the least end that pairs lead to.

    Labels go to neighbours and then jump to their label's label, so rounds grow with the logarithm of the longest chain. Each round is cut with
    checkpoint(); only whether anything changed comes to the driver. Empty pairs give no rows; repeated pairs and loops change nothing.
    """
    both = checkpoint(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v"))).distinct())
    label = checkpoint(both.groupBy("u").agg(F.least("u", F.min("v")).alias("l")))
    for _ in range(max_rounds):
        near = both.join(label.withColumnRenamed("u", "v"), "v").groupBy("u").agg(F.min("l").alias("m"))
        step = label.join(near, "u").select("u", "l", F.least("l", "m").alias("n"))
        jump = step.join(label.select(F.col("u").alias("n"), F.col("l").alias("j")), "n", "left").select("u", "l", F.least("n", F.coalesce("j", "n")).alias("n"))
        new = checkpoint(jump)
        label = new.select("u", F.col("n").alias("l"))
        if not new.filter("n <> l").limit(1).count():
            return label.withColumnRenamed("l", "label")
    raise RuntimeError("labels did not settle")
