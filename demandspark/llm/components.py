"""Connected components by smallest labels with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import stash


def components(edges: DataFrame) -> DataFrame:
    """``v, c`` for every vertex of ``edges`` (a, b): c is the smallest vertex that v reaches.

    Each round takes the smallest label among the neighbours and then the
    label's own label, so long chains halve. Rounds end when no label changes.
    """
    both = stash(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    labels = stash(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("c")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["v"]).groupBy("a").agg(F.min("c").alias("n"))
        lower = labels.join(near, labels["v"] == near["a"]).select("v", F.least("c", "n").alias("d"), "c")
        jump = labels.select(F.col("v").alias("at"), F.col("c").alias("to"))
        moved = lower.join(jump, lower["d"] == jump["at"]).select("v", F.least("d", "to").alias("c"), (F.least("d", "to") < F.col("c")).alias("changed"))
        moved = stash(moved, "labels")
        labels = moved.select("v", "c")
        if not moved.where("changed").head(1):
            return labels
