"""Connected components by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def components(links: DataFrame) -> DataFrame:
    """links: a, b (long, not null). Returns node, label: the smallest node that each linked node can reach.

    Each round takes the least label among the neighbours and then the label of that label; every round is
    written to the shared folder, so lost executors don't replay earlier rounds. The rounds end when no label
    changes; with the jumps their number grows with the logarithm of the longest chain in the usual case.
    """
    both = common.stage(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links")
    now = common.stage(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    while True:
        of = now.select(F.col("node").alias("b"), F.col("label").alias("l"))
        near = both.join(of, "b").groupBy(F.col("a").alias("node")).agg(F.min("l").alias("m"))
        met = now.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        up = now.select(F.col("node").alias("label"), F.col("label").alias("above"))
        new = common.stage(met.join(up, "label", "left").select("node", "old", F.least("label", F.coalesce("above", "label")).alias("label")), "labels")
        now = new.select("node", "label")
        if not new.where("old <> label").limit(1).count():
            return now
