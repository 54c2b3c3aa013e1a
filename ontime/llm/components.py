"""Connected components of a link table, by rounds of joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ontime.session import materialize


def components(links: DataFrame) -> DataFrame:
    """Smallest node reachable from each linked node: columns node and label.

    ``links`` has columns a and b. Every round ties the neighbours of a node to the smallest among
    them, in turn the larger ones and the smaller ones; it ends when nothing changes, after a
    number of rounds that grows with the logarithm of the longest chain. Each round is stored in
    the shared folder. Smallest neighbours are found by partial aggregation and joined back, so a
    node with very many neighbours is split over tasks.
    """
    edges = materialize(
        links.filter("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct()
    )
    state = None
    while True:
        both = edges.select(F.col("high").alias("u"), F.col("low").alias("v")).unionByName(
            edges.select(F.col("low").alias("u"), F.col("high").alias("v"))
        )
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        larger = both.filter("v > u").join(least, "u").select(F.col("v").alias("high"), F.col("m").alias("low"))
        larger = materialize(larger.filter("high <> low").distinct())
        lowest = larger.groupBy(F.col("high").alias("u")).agg(F.min("low").alias("m"))
        tied = larger.join(lowest, larger["high"] == lowest["u"]).select(
            F.when(F.col("low") == F.col("m"), F.col("high")).otherwise(F.col("low")).alias("high"),
            F.col("m").alias("low"),
        )
        edges = materialize(tied.filter("high <> low").distinct())
        seen = edges.agg(
            F.count(F.lit(1)).alias("edges"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)")).alias("sum")
        ).first()
        if seen == state:
            break
        state = seen
    found = edges.select(F.col("high").alias("node"), F.col("low").alias("label"))
    return found.unionByName(edges.select(F.col("low").alias("node"), F.col("low").alias("label"))).distinct()
