"""Connected components of a link table by iterated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import discard, written


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for the ends of ``links`` (a, b): ``comp`` is the least node
    that can be reached. Each round takes the least label among a node's
    neighbours and then its label's label, so a path of length n needs about
    log n rounds. Null ends are left out."""
    links = links.where("a IS NOT NULL AND b IS NOT NULL").select("a", "b")
    both = written(links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links", few=True)
    labels = written(both.groupBy("a").agg(F.min(F.least("a", "b")).alias("comp")).withColumnRenamed("a", "node"), "labels", few=True)
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("comp").alias("near"))
                .withColumnRenamed("a", "node"))
        lower = labels.join(near, "node").select("node", "comp", F.least("comp", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("comp").alias("far"))
        new = written(lower.join(jump, "low", "left").select(
            "node", F.least("low", F.coalesce("far", "low")).alias("comp"), F.col("comp").alias("old")), "labels", few=True)
        discard(labels)
        labels = new.select("node", "comp")
        if new.where("comp <> old").isEmpty():
            discard(both)
            return labels
