"""How an index matures: closed forms, and seeded draws to hold against them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# Seconds between tracks, samples a day, tracks in rotation, draws' seed.
TRACK_SECONDS, SAMPLES, ROTATION, SEED = 233.0, 24, 300, 11


def sampling_rate(track_seconds: float = TRACK_SECONDS, samples: int = SAMPLES) -> float:
    return samples / (86_400 / track_seconds)


def missed(rate: Column, plays: Column, days: Column) -> Column:
    """The chance that none of so many plays a day was sampled."""
    return F.pow(1 - rate, plays * days)


def zipf(spark: SparkSession, n: int, exponent: float) -> DataFrame:
    """(rank, weight) of a Zipf distribution; weights add up to 1."""
    raw = spark.range(1, n + 1).select(F.col("id").alias("rank"), F.pow(F.col("id").cast("double"), F.lit(-exponent)).alias("w"))
    total = raw.agg(F.sum("w").alias("total"))
    return raw.crossJoin(total).select("rank", (F.col("w") / F.col("total")).alias("weight"))


def expected_coverage(weights: DataFrame, samples: int) -> DataFrame:
    """Expected share of all plays whose item was drawn at least once."""
    return weights.agg(F.sum(F.col("weight") * (1 - F.pow(1 - F.col("weight"), F.lit(samples)))).alias("coverage"))


def drawn(points: DataFrame, weights: DataFrame, slots: int = 1024) -> DataFrame:
    """Points (u from 0 to 1) with the item whose share of the cumulated weights holds them; joined by slots of equal width."""
    upper = weights.withColumn("hi", F.sum("weight").over(W.orderBy("rank").rowsBetween(W.unboundedPreceding, 0)))
    ranges = upper.select("rank", "weight", (F.col("hi") - F.col("weight")).alias("lo"), "hi")
    ranges = ranges.withColumn("slot", F.explode(F.sequence(F.floor(F.col("lo") * slots), F.floor(F.least(F.col("hi"), F.lit(1 - 1e-12)) * slots))))
    last = F.col("hi") >= 1 - 1e-9
    return points.withColumn("slot", F.floor(F.col("u") * slots)).join(ranges, "slot").where((F.col("u") >= F.col("lo")) & ((F.col("u") < F.col("hi")) | last)).drop("slot", "lo", "hi")


def draw(seed: int, *of: Column | str) -> Column:
    """A number from 0 to 1 that is the same for the same values: the first 48 bits of an MD5."""
    text = F.concat_ws(":", F.lit(str(seed)), *(F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in of))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("long") / F.lit(float(1 << 48))


def drawn_coverage(weights: DataFrame, samples: int, trials: int, seed: int = SEED) -> DataFrame:
    """The mean over trials of the share of plays whose item was drawn."""
    points = weights.sparkSession.range(trials * samples).select((F.col("id") % trials).alias("trial"), draw(seed, "id").alias("u"))
    hits = drawn(points, weights).select("trial", "rank", "weight").distinct()
    return hits.groupBy("trial").agg(F.sum("weight").alias("share")).agg(F.avg("share").alias("coverage"))


def hit_rate(spark: SparkSession, stations: int, days: int = 30, searches: int = 4000, universe: int = 20_000, rate: float | None = None, seed: int = 7) -> DataFrame:
    """The share of searches for an artist that some station was seen to play.

    Fixed values: searches are Zipf by 0.8; a station plays 150 to 500 artists from a quarter of a drawn rank on,
    the r-th 3 / r ** 0.7 times a day.
    """
    rate = sampling_rate() if rate is None else rate
    wanted = zipf(spark, universe, 0.8)
    start = spark.range(stations).select("id", draw(seed, "id").alias("u"), (150 + F.floor(draw(seed + 1, "id") * 351)).alias("depth"))
    first = drawn(start, wanted).select("id", "depth", F.floor((F.col("rank") - 1) / 4).alias("start"))
    played = first.select("id", "start", F.explode(F.sequence(F.lit(0), F.col("depth").cast("int") - 1)).alias("r"))
    plays = 3.0 / F.pow(F.col("r") + 1, F.lit(0.7))
    seen = played.where(draw(seed + 2, "id", "r") < 1 - missed(F.lit(rate), plays, F.lit(days))).select((F.least(F.col("start") + F.col("r"), F.lit(universe - 1)) + 1).alias("rank")).distinct()
    asked = drawn(spark.range(searches).select(draw(seed + 3, "id").alias("u")), wanted).select("rank")
    found = asked.join(seen, "rank", "left_semi").agg(F.count("*").alias("n"))
    return found.select((F.col("n") / searches).alias("hit_rate"))


def wait_minutes(pool: Column, rate: Column) -> Column:
    """Minutes until one of a pool of stations is seen to play."""
    return 60 / (pool * rate / 24)
