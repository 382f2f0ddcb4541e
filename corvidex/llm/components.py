"""Connected components by alternating large-star and small-star steps.

Works on (a, b) edge tables of any size: each step is one exchange on a node,
written to the shared folder.  A hub's neighbours are never collected: minima
are partial aggregates, and every edge is rewritten by a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

MAX_ROUNDS = 40


def _large_star(e: DataFrame) -> DataFrame:
    """Every neighbour larger than a node is linked to the node's smallest neighbour."""
    both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
    m = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    return both.where("v > u").join(m, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a <> b").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them."""
    x = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    m = x.groupBy("u").agg(F.min("v").alias("m"))
    y = x.join(m, "u")
    return y.select(F.col("m").alias("a"), F.col("v").alias("b")).where("a <> b").unionByName(m.select(F.col("m").alias("a"), F.col("u").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, root): root is the smallest id of the component; ids without an edge are absent."""
    e = materialise(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    for _ in range(MAX_ROUNDS):
        new = materialise(_small_star(_large_star(e)), "edges")
        changed = new.exceptAll(e).limit(1).count()
        e = new
        if not changed:
            break
    else:
        raise RuntimeError("components did not settle")
    stars = e.select(F.col("b").alias("id"), F.col("a").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("id"), "root").distinct())
