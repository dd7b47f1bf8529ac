"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.tables import parts, settle

_ROWS_PER_PART = 250_000


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b); label is the least node reachable.

    Every round passes the least label over each link, then follows labels one step further,
    so that chains shorten by half or more. Labels move by joins and map-side combined minima;
    no group of neighbours is ever gathered. Nulls and links to oneself are left out. The links are
    read twice, so they should be a settled table.
    """
    ab = links.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    # There are at most as many nodes as edges, both ways counted.
    partitions = parts(2 * links.count(), _ROWS_PER_PART)
    both = ab.union(ab.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges = settle(both, "edges", partitions)
    least = edges.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label"))
    labels = settle(least, "labels", partitions)
    while True:
        offers = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("offer"))
        nearer = labels.join(offers.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("label").alias("old"), F.least("label", "offer").alias("label")
        )
        # Labels are nodes, and the label of a label was its least known one a round ago.
        ahead = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        moved = settle(
            nearer.join(ahead, "label").select("node", "old", F.least("label", "further").alias("label")),
            "labels",
            partitions,
        )
        labels = moved.select("node", "label")
        if moved.filter("label <> old").isEmpty():
            return labels
