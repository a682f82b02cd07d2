"""Connected components of an edge list that may be as large as the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node of the node's component, for every node
    of ``edges`` (a, b).

    Large-star and small-star steps take turns until nothing changes: each
    node's larger neighbours, then its smaller ones, are tied to its smallest
    neighbour.  A step is a partial minimum and a join, no list of neighbours
    is ever gathered, and the number of rounds grows with the logarithm of
    the longest path.  Each round's edges are a written table."""
    edges = staged(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(least, "u")
        small = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            tied.select("u", F.col("m").alias("v"))
        )
        new = staged(small.filter("u <> v").distinct(), "edges")
        # done when every node hangs from one root: no node is both
        roots = new.select(F.col("v").alias("u")).distinct()
        forest = new.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
        if not forest.filter("n > 1").limit(1).count() and not forest.join(roots, "u", "left_semi").limit(1).count():
            break
        edges = new
    stars = new.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return stars.unionByName(new.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
