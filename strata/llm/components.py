"""Connected components of a link table by joins, without collecting links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stage


def components(links: DataFrame) -> DataFrame:
    """(node, label) of the nodes of ``links`` (a, b): label is the least node reachable.

    Every round a node takes the least label among its neighbours and itself and then
    that label's own label, so labels run along a chain in about as many rounds as its
    length has binary digits.  Each round is staged; minima are combined in the tasks
    before they are shuffled, so a hub is a few rows.
    """
    edges = stage(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                  .where("a <> b").distinct(), "cc-edges")
    labels = stage(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), "cc-labels")
    while True:
        heard = (edges.join(labels, edges["b"] == labels["node"]).groupBy(F.col("a").alias("to")).agg(F.min("label").alias("least")))
        better = stage(labels.join(heard, F.col("node") == F.col("to")).select("node", "label", F.least("label", "least").alias("least")), "cc-heard")
        own = better.select(F.col("node").alias("via"), F.col("least").alias("further"))
        step = stage(better.join(own, F.col("least") == F.col("via"), "left")
                     .select("node", F.least("least", F.coalesce("further", "least")).alias("label"), F.col("label").alias("was")), "cc-step")
        if step.where("label <> was").isEmpty():
            return step.select("node", "label")
        labels = step.select("node", "label")
