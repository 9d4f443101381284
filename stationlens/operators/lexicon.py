"""Names and pairs that tell an artist from a title, from large dumps of recordings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

#: Least popularity, and how much more often a string must be an artist than a title.
POPULARITY, RATIO = 2, 2.0


def redirect_counts(redirects: DataFrame, target: str = "target") -> DataFrame:
    return redirects.groupBy(F.col(target).alias("recording")).agg(F.count("*").alias("redirects"))


def evidence(recordings: DataFrame, counts: DataFrame, artist: str = "artist", title: str = "title", recording: str = "recording") -> DataFrame:
    """(key, pop, as_artist, as_title) of every folded string; distinct strings are folded once."""
    counted = recordings.join(counts, recording, "left").select(F.col(artist).alias("artist"), F.col(title).alias("title"), F.coalesce("redirects", F.lit(0)).alias("redirects"))
    roles = counted.groupBy(F.col("artist").alias("name")).agg(F.max("redirects").alias("pop"), F.count("*").alias("as_artist"), F.lit(0).cast("long").alias("as_title"))
    roles = roles.unionByName(counted.groupBy(F.col("title").alias("name")).agg(F.lit(0).cast("long").alias("pop"), F.lit(0).cast("long").alias("as_artist"), F.count("*").alias("as_title")))
    keyed = roles.where("name is not null").withColumn("key", T.fold(F.col("name"))).where("key <> ''")
    return keyed.groupBy("key").agg(F.max("pop").cast("long").alias("pop"), F.sum("as_artist").alias("as_artist"), F.sum("as_title").alias("as_title"))


def admissible(evidence: DataFrame, popularity: int = POPULARITY, ratio: float = RATIO) -> DataFrame:
    return evidence.where((F.col("pop") >= popularity) & (F.col("as_artist") > 0) & (F.col("as_artist") >= ratio * F.col("as_title")))


def observed_halves(titles: DataFrame, raw: str = "raw") -> DataFrame:
    """Distinct folded halves of titles, whichever side they stand on."""
    both = T.halves(T.spaced(F.col(raw)))
    pieces = titles.select(both.alias("h")).where("h is not null").select(F.explode(F.array("h.left", "h.right")).alias("piece")).distinct()
    return pieces.select(T.fold(F.col("piece")).alias("key")).where("key <> ''").distinct()


def tiers(evidence: DataFrame, observed: DataFrame, popularity: int = POPULARITY, ratio: float = RATIO) -> DataFrame:
    """(key, tier): a for popular names, b for observed names of any popularity that a lacks."""
    a = admissible(evidence, popularity, ratio).select("key")
    b = admissible(evidence, 0, ratio).select("key").join(observed.select("key"), "key", "left_semi").join(a, "key", "left_anti")
    return a.withColumn("tier", F.lit("a")).unionByName(b.withColumn("tier", F.lit("b")))


def known_pairs(recordings: DataFrame, names: DataFrame, artist: str = "artist", title: str = "title") -> DataFrame:
    """Distinct (artist, title) keys of recordings both of whose strings are names."""
    folded = recordings.select(F.col(artist).alias("a"), F.col(title).alias("t")).distinct().select(T.fold(F.col("a")).alias("artist"), T.fold(F.col("t")).alias("title")).distinct()
    return folded.join(names.select(F.col("key").alias("artist")), "artist", "left_semi").join(names.select(F.col("key").alias("title")), "title", "left_semi")


def from_discography(albums: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(artists, pairs) of rows with artist and albums (array of structs with tracks, array of structs with title)."""
    keyed = albums.withColumn("key", T.fold(F.col("artist"))).where("key <> ''")
    tracks = keyed.select("key", F.explode("albums").alias("album")).select("key", F.explode("album.tracks").alias("track"))
    pairs = tracks.select(F.col("key").alias("artist"), T.fold(F.coalesce("track.title", F.lit(""))).alias("title")).where("title <> ''").distinct()
    return keyed.select("key").distinct(), pairs
