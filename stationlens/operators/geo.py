"""Coordinates against the country they claim. Boxes (code, min_lat, max_lat, min_lon, max_lon) and dependencies (code, dep) are the caller's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Degrees by which a box is widened.
MARGIN = 2.0


def in_box(lat: Column, lon: Column, margin: float = MARGIN) -> Column:
    """A box whose west edge is east of its east edge crosses the antimeridian."""
    low, high = F.col("min_lon") - margin, F.col("max_lon") + margin
    within = F.when(F.col("min_lon") > F.col("max_lon"), (lon >= low) | (lon <= high)).otherwise((lon >= low) & (lon <= high))
    return (lat >= F.col("min_lat") - margin) & (lat <= F.col("max_lat") + margin) & within


def with_dependencies(boxes: DataFrame, dependencies: DataFrame) -> DataFrame:
    """All boxes of a code: its own and those of its dependencies, where it has its own."""
    edges = ["min_lat", "max_lat", "min_lon", "max_lon"]
    own = boxes.select("code", *edges)
    others = dependencies.join(own.select("code"), "code", "left_semi").join(own.select(F.col("code").alias("dep"), *edges), "dep").select("code", *edges)
    return own.unionByName(others)


def verdicts(points: DataFrame, row: str, country: str, lat: str, lon: str, boxes: DataFrame, dependencies: DataFrame, margin: float = MARGIN) -> DataFrame:
    """(row, inside): false for no coordinate or null island, null where the code has no box."""
    code = F.upper(F.trim(F.coalesce(country, F.lit(""))))
    plain = points.select(F.col(row), code.alias("code"), F.col(lat).alias("lat"), F.col(lon).alias("lon"))
    valid = F.coalesce(F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180) & ~((F.col("lat") == 0) & (F.col("lon") == 0)), F.lit(False))
    met = plain.join(with_dependencies(boxes, dependencies), "code", "left").withColumn("hit", F.when(F.col("min_lat").isNotNull(), in_box(F.col("lat"), F.col("lon"), margin)))
    return met.groupBy(row).agg(F.bool_or("hit").alias("hit"), F.first(valid).alias("valid")).select(row, F.when(~F.col("valid"), F.lit(False)).otherwise(F.col("hit")).alias("inside"))


def without_false(catalog: DataFrame, country: str, geo: str, boxes: DataFrame, dependencies: DataFrame, margin: float = MARGIN) -> DataFrame:
    """Coordinates outside the country become null; unverifiable ones stay. ``inside`` tells which."""
    points = catalog.where(F.col(geo).isNotNull()).select("key", country, F.col(f"{geo}.lat").alias("lat"), F.col(f"{geo}.lon").alias("lon"))
    judged = verdicts(points, "key", country, "lat", "lon", boxes, dependencies, margin)
    return catalog.join(judged, "key", "left").withColumn(geo, F.when(F.col("inside").isNull() | F.col("inside"), F.col(geo)))


def drop_rate(with_geo: Column, dropped: Column) -> Column:
    return dropped / F.greatest(F.lit(1), with_geo + dropped) * 100
