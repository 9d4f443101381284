"""Connected components by alternating large and small stars, in DataFrames.

Every round is a few aggregations and joins; no vertex's neighbours are gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import discard, materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Each vertex's larger neighbours go to the least of its neighbours and itself."""
    around = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    # written, so that the join has an exchange on either side and AQE can split a vertex of many neighbours
    least = materialize(around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    return around.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each vertex's smaller neighbours and itself go to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return down.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least vertex that each vertex of an edge (a, b) reaches."""
    now, before = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())
        before = state
        after = materialize(_small_star(_large_star(now)).where("a <> b").distinct(), "edges")
        discard(now)
        now = after
