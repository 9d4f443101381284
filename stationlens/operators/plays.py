"""Observations to play counts, a bounded histogram, and the inverted index of artists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import text as T

#: Stations of an artist in the index, rows of the histogram, longest key in it.
TOP, HALVES, KEY = 24, 200_000, 120


def pairs(observations: DataFrame, station: str = "uuid", artist: str = "artist_key", stamp: str = "round") -> DataFrame:
    """(uuid, artist_key, n, first, last) of observations."""
    return observations.groupBy(F.col(station).alias("uuid"), F.col(artist).alias("artist_key")).agg(F.count("*").alias("n"), F.min(stamp).alias("first"), F.max(stamp).alias("last"))


def merged_pairs(state: DataFrame, new: DataFrame) -> DataFrame:
    """Two such tables as one: counts add up."""
    return state.unionByName(new).groupBy("uuid", "artist_key").agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"))


def names(observations: DataFrame, artist: str = "artist_key", shown: str = "artist", seq: str = "seq") -> DataFrame:
    """The name under which an artist was first seen."""
    return observations.groupBy(F.col(artist).alias("artist_key")).agg(F.min_by(shown, seq).alias("artist"))


def half_counts(titles: DataFrame, raw: str = "raw", limit: int = HALVES) -> DataFrame:
    """How often each folded half occurs on either side; the most frequent ``limit``, ties by key."""
    both = T.halves(T.spaced(F.col(raw)))
    pieces = titles.select(both.alias("h")).where("h is not null").select(F.explode(F.array("h.left", "h.right")).alias("piece"))
    return bounded(pieces.select(T.fold(F.col("piece")).alias("key")), limit)


def bounded(keys: DataFrame, limit: int = HALVES, longest: int = KEY) -> DataFrame:
    counted = keys.where((F.col("key") != "") & (F.length("key") <= longest)).groupBy("key").agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), "key").limit(limit)


def merged_halves(state: DataFrame, new: DataFrame, limit: int = HALVES) -> DataFrame:
    """Two such histograms (key, n) as one, of the most frequent ``limit`` keys."""
    added = state.select("key", "n").unionByName(new.select("key", "n")).groupBy("key").agg(F.sum("n").alias("n"))
    return added.orderBy(F.desc("n"), "key").limit(limit)


def rounds(observations: DataFrame, stamp: str = "round") -> DataFrame:
    """(rounds, updated): how many rounds there were, and the last."""
    return observations.agg(F.count_distinct(stamp).alias("rounds"), F.max(stamp).alias("updated"))


def merged_rounds(state: DataFrame, new: DataFrame) -> DataFrame:
    """Two such counts of different rounds as one."""
    return state.unionByName(new).agg(F.sum("rounds").alias("rounds"), F.max("updated").alias("updated"))


def index_rows(pairs: DataFrame, catalog: DataFrame, representatives: DataFrame | None = None, min_plays: int = 1, top: int = TOP) -> DataFrame:
    """(artist_key, rank, uuid, n, watchable, variants): an artist's stations, watchable first, then by plays.

    ``representatives`` has uuid and representative; stations of a group count as one,
    unless the representative left the catalog.
    """
    known = catalog.select("uuid", F.coalesce("watchable", F.lit(False)).alias("watchable"))
    seen = pairs.where(F.col("n") >= min_plays).join(known.select("uuid"), "uuid", "left_semi")
    if representatives is not None:
        live = representatives.join(known.select(F.col("uuid").alias("representative")), "representative", "left_semi")
        seen = seen.join(live, "uuid", "left").withColumn("uuid", F.coalesce("representative", "uuid")).drop("representative")
    rows = seen.groupBy("artist_key", "uuid").agg(F.sum("n").alias("n"), F.count("*").alias("variants")).join(known, "uuid")
    order = W.partitionBy("artist_key").orderBy(F.desc("watchable"), F.desc("n"), "uuid")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("artist_key", "rank", "uuid", "n", "watchable", "variants")


def search_index(rows: DataFrame) -> DataFrame:
    """One row for each artist; ``variants`` is null where it is 1, so that JSON leaves it out."""
    station = F.struct("rank", "uuid", "n", "watchable", F.nullif("variants", F.lit(1)).alias("variants"))
    without_rank: Column = F.transform(F.array_sort(F.collect_list(station)), lambda s: s.dropFields("rank"))
    return rows.groupBy("artist_key").agg(without_rank.alias("stations"))


def widest(rows: DataFrame, most: int = 8) -> DataFrame:
    return rows.groupBy("artist_key").agg(F.count("*").alias("stations")).orderBy(F.desc("stations"), "artist_key").limit(most)


def rekeyed(index: DataFrame, artists: DataFrame) -> DataFrame:
    """Index rows under the key of the decoded name: rows that meet add up, the first name stays.

    ``index`` has artist_key, uuid, n and watchable, ``artists`` artist_key and artist.
    """
    new = artists.withColumn("name", T.unescaped(F.col("artist"))).withColumn("new_key", T.artist_key(F.col("name")))
    shown = new.groupBy("new_key").agg(F.min_by("name", "artist_key").alias("artist"))
    met = index.join(new.select("artist_key", "new_key"), "artist_key").where("new_key <> ''").groupBy("new_key", "uuid").agg(F.sum("n").alias("n"), F.max("watchable").alias("watchable"))
    return met.join(shown, "new_key").withColumnRenamed("new_key", "artist_key")


def dictionary_encoded(index: DataFrame, catalog: DataFrame, order: list[Column | str]) -> tuple[DataFrame, DataFrame]:
    """(stations, rows): stations numbered from 0 by first use in ``order``; rows outside the catalog are dropped.

    Numbering is over distinct stations, not over rows.
    """
    kept = index.join(catalog.select("uuid"), "uuid", "left_semi")
    placed = kept.select("uuid", F.struct(*order).alias("use")).groupBy("uuid").agg(F.min("use").alias("use"))
    stations = placed.withColumn("number", F.row_number().over(W.orderBy("use", "uuid")) - 1).select("uuid", "number")
    return stations, kept.join(stations, "uuid")


def misses(index: DataFrame, catalog: DataFrame) -> DataFrame:
    return index.join(catalog.select("uuid"), "uuid", "left_anti").agg(F.count("*").alias("misses"))
