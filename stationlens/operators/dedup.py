"""Keyed deduplication: the best row of each key, at the place of the key's first row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..storage import materialize


def best_per_key(df: DataFrame, key: str, quality: list[str], order: str, place: str = "first_seq") -> DataFrame:
    """Greatest ``quality`` (in that order of columns) of each key, earliest on ties; ``place`` is the key's first ``order``."""
    own = W.partitionBy(key)
    ranked = df.withColumn("rank_", F.row_number().over(own.orderBy(*(F.desc(q) for q in quality), order))).withColumn(place, F.min(order).over(own))
    return ranked.where("rank_ = 1").drop("rank_")


def first_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("rank_", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("rank_ = 1").drop("rank_")


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], most: int) -> DataFrame:
    """The first ``most`` rows of each key, with their rank."""
    return df.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= most)


def insert_absent(catalog: DataFrame, found: DataFrame, key: str, order: str) -> DataFrame:
    """``catalog`` and the first row of each key of ``found`` that it lacks."""
    new = first_per_key(found, [key], [order]).join(catalog.select(key).distinct(), key, "left_anti")
    return catalog.unionByName(new, allowMissingColumns=True)


def overlay(catalog: DataFrame, picks: DataFrame, key: str, order: str, picked: str, columns: list[str]) -> DataFrame:
    """Editorial picks over a catalog: a pick's filled columns replace those of the first row of its key; picks without one are added.

    Of picks of one key the last by ``picked`` counts. Rows that a pick touched, or made, are ``featured``.
    """
    last = first_per_key(picks, [key], [F.desc(picked)]).select(key, *(F.col(c).alias(f"pick_{c}") for c in columns), F.lit(True).alias("picked_"))
    ranked = catalog.withColumn("take_", F.row_number().over(W.partitionBy(key).orderBy(order)) == 1)
    own = ranked.where("take_").join(last, key, "full_outer")
    filled = lambda c: F.coalesce(F.when(F.col(f"pick_{c}").cast("string") != "", F.col(f"pick_{c}")), F.col(c)).alias(c)
    rest = [c for c in catalog.columns if c not in columns and c != key]
    changed = own.select(key, *map(filled, columns), *rest, F.coalesce("picked_", F.lit(False)).alias("featured"))
    others = ranked.where("not take_").select(key, *columns, *rest, F.lit(False).alias("featured"))
    return changed.unionByName(others)


def featured_first(catalog: DataFrame, order: list[Column | str], place: str = "place") -> DataFrame:
    """The rows in order, those that are featured before all others; ``place`` counts from 0 and is found without one task holding all.

    Rows are ranged over tasks by their order; a task's rows are numbered after those of the tasks before it.
    """
    keys = [F.desc("featured"), *order]
    ranged = materialize(catalog.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumns({"part_": F.spark_partition_id(), "at_": F.monotonically_increasing_id()}), "ranged")
    at = F.row_number().over(W.partitionBy("part_").orderBy("at_")) - 1
    sizes = ranged.groupBy("part_").agg(F.count("*").alias("n_"))
    before = sizes.select("part_", (F.sum("n_").over(W.orderBy("part_")) - F.col("n_")).alias("before_"))  # a row for each task
    return ranged.withColumn("within_", at).join(before, "part_").withColumn(place, F.col("before_") + F.col("within_")).drop("part_", "at_", "within_", "before_")
