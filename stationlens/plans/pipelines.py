"""The six pipelines as plans over DataFrames; reading and writing stay with the caller."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import url as U
from ..operators import catalog as C
from ..operators import dedup, lexicon, mounts, orientation, plays, siblings, simulcast, taxonomy


@dataclass
class Catalog:
    stations: DataFrame
    funnel: DataFrame
    tags: DataFrame


def build_catalog(passes: list[DataFrame], synonyms: DataFrame, noise: DataFrame, boxes: DataFrame, dependencies: DataFrame, gate: C.Gate = C.Gate()) -> Catalog:
    """Passes over the directory, as one bag, to a catalog; tags are counted before rows are dropped."""
    raw = passes[0]
    for p in passes[1:]:
        raw = raw.unionByName(p)
    found, funnel = C.curated(raw, synonyms, noise, boxes, dependencies, gate)
    tags = raw.select(F.explode("tags").alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))
    return Catalog(found, funnel, taxonomy.coverage(tags, synonyms, noise))


def probe(stations: DataFrame, docs: DataFrame) -> DataFrame:
    """Stations and what they play, by the status documents (doc, host, path, body) of their hosts."""
    hosted = stations.withColumn("host", F.lower(U.authority(F.col("url"))))
    found = mounts.first_answer(docs, mounts.parsed(docs, "doc", "path", "body"), "host", "doc", "path")
    chosen = mounts.selected(hosted, found, "uuid", "host", "url")
    return mounts.watchable(stations, chosen, "uuid")


def discover(stations: DataFrame, docs: DataFrame, synonyms: DataFrame, noise: DataFrame, least: int = siblings.BITRATE) -> DataFrame:
    """New stations on the hosts of watchable ones; ``stations`` has seq."""
    seeds = siblings.seeds(stations, "url", "seq").select("host", U.status_base(F.col("url")).alias("base"), F.col("uuid").alias("seed_uuid"), F.col("country").alias("seed_country"), F.col("language").alias("seed_language"), F.col("seq").alias("seed_seq"))
    found = mounts.first_answer(docs, mounts.parsed(docs, "doc", "path", "body"), "host", "doc", "path").select("host", "pos", "mount.*")
    listed = siblings.listenable(found, "host").join(seeds, "host").withColumn("url", siblings.candidate_url(F.col("base"), F.col("raw_path"), F.col("path"))).where("url is not null")
    single = listed.join(siblings.alias_hosts(listed), "host", "left_anti")
    good = single.where(siblings.passes(F.col("codec"), F.col("bitrate"), least)).withColumn("seq", F.struct("seed_seq", "pos"))
    new = siblings.discovered(siblings.variants(good), stations)
    named = new.withColumn("shown", F.coalesce(F.nullif(F.trim("name"), F.lit("")), F.regexp_replace("path", "^/+", ""))).withColumn("genre_tags", F.filter(F.array(F.lower(F.trim("genre"))), lambda g: g != ""))
    return siblings.entries(taxonomy.classified(named, "key", "genre_tags", "shown", synonyms, noise))


def merge_siblings(stations: DataFrame, found: DataFrame) -> DataFrame:
    keyed = lambda df: df.withColumn("key", U.dedup_key(F.col("url")))
    return dedup.insert_absent(keyed(stations), keyed(found), "key", "uuid")


def harvest(state: DataFrame | None, observations: DataFrame, stations: DataFrame, co: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(play counts, index rows) after a round; with co-occurrence state, stations of a group count as one."""
    new = plays.pairs(observations)
    counts = new if state is None else plays.merged_pairs(state, new)
    groups = None if co is None else simulcast.representative_map(simulcast.groups(co, stations))
    return counts, plays.index_rows(counts, stations, groups)


def build_lexicon(recordings: DataFrame, redirects: DataFrame, titles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(names, pairs) of the dumps, and of the halves that stations really play."""
    found = lexicon.evidence(recordings, lexicon.redirect_counts(redirects))
    names = lexicon.tiers(found, lexicon.observed_halves(titles)).select("key").distinct()
    return names, lexicon.known_pairs(recordings, names)


def replay(titles: DataFrame, names: DataFrame, pairs: DataFrame, stations: DataFrame, stamp: str) -> DataFrame:
    """Captured titles (url, title) read in order of station and text, as observations of one round."""
    distinct = titles.select("url", T.unescaped(F.col("title")).alias("title")).distinct()
    ordered = dedup.top_per_key(distinct, ["url"], ["title"], (1 << 31) - 1).withColumn("seq", F.col("rank").cast("long"))
    songs = orientation.readings(ordered, names, pairs, station="url", raw="title").where("kind = 'song'")
    met = songs.join(stations.select(F.col("url").alias("station"), "uuid"), "station")
    return met.select("uuid", "artist", T.artist_key(F.col("artist")).alias("artist_key"), "track", "raw", F.lit(stamp).alias("round")).where("artist_key <> ''")
