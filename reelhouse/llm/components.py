"""Connected components of an edge list, as Spark joins.

Alternates large-star and small-star steps: each vertex points its larger
neighbours, then all its neighbours, at the smallest vertex it knows.  Every
step is an aggregate with map-side combination and a join adaptive execution
may split, so a vertex may have any number of edges.  Each round is written to
the shared folder, counted while it is written, and replaces the one before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for each vertex of ``links`` (columns a, b); the component is its smallest vertex."""
    rounds = Scratch(links.sparkSession)

    def written(edges: DataFrame) -> tuple[DataFrame, tuple]:
        seen = Observation()
        mark = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        edges = rounds.store(edges.observe(seen, F.count("*").alias("n"), mark.alias("mark")), "components")
        rounds.drop(keep=1)
        return edges, (seen.get["n"], seen.get["mark"])

    edges, mark = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                          .where("u <> v").distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        least = least.select("w", F.least("w", "m").alias("m"))
        # large-star: larger neighbours of u point at the least of u's neighbourhood
        large = both.where("v > u").join(least, F.col("u") == F.col("w")).select(
            F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small-star: u and its smaller neighbours point at the least of them
        low = large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        small = large.join(low, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(low.select(F.col("w").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct()
        before = mark
        edges, mark = written(small)
        if mark == before:
            break
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
    scratch.paths += rounds.paths
    return found
