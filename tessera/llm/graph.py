"""Connected components of an edge table, by repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` (smallest node of the component) for every node of ``edges``.

    Alternates large-star and small-star steps: every node links its larger
    neighbours, then its smaller ones, to the smallest node it knows, until the
    edges are stars. Steps grow with the logarithm of the node count; each is a
    grouped minimum and a join, written to the checkpoint folder. A node with a
    great many neighbours is reduced by partial aggregation, and its join rows
    are split by AQE, as each matches one row.
    """
    e = cut_lineage(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct())
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        new = cut_lineage(small)
        same = new.select("u", "v").exceptAll(e).isEmpty() and e.exceptAll(new).isEmpty()
        e = new
        if same:
            break
    stars = e.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
