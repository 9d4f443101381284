"""The catalog's quality gate and its statistics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import url as U
from . import dedup, geo, taxonomy


@dataclass(frozen=True)
class Gate:
    """Looser for speech, stricter for music. Codecs that players handle, speech genres, bitrates."""

    music: int = 96
    speech: int = 48
    require_ok: bool = True
    codecs: tuple[str, ...] = ("MP3", "AAC", "AAC+", "AACP", "OGG", "FLAC")
    speech_genres: tuple[str, ...] = ("news", "talk", "sport", "culture", "comedy")

    def codec(self, codec: Column) -> Column:
        return F.replace(F.upper(F.coalesce(codec, F.lit(""))), F.lit("AAC+"), F.lit("AAC"))

    def good_codec(self, codec: Column) -> Column:
        """An unknown codec passes."""
        return (self.codec(codec) == "") | self.codec(codec).isin(*(c.replace("AAC+", "AAC") for c in self.codecs))

    def floor(self, genres: Column) -> Column:
        speech = (F.size(genres) > 0) & F.forall(genres, lambda g: g.isin(*self.speech_genres))
        return F.when(speech, self.speech).otherwise(self.music)

    def reason(self, unsafe: Column, ok: Column, codec: Column, bitrate: Column, genres: Column) -> Column:
        """The first rule that a row fails, null if none; bitrate 0 is unknown and passes."""
        return (
            F.when(unsafe, "unsafe")
            .when(F.lit(self.require_ok) & ~F.coalesce(ok, F.lit(False)), "dead")
            .when(~self.good_codec(codec), "codec")
            .when((bitrate != 0) & (bitrate < self.floor(genres)), "bitrate")
        )


def funnel(df: DataFrame, reason: str = "reason") -> DataFrame:
    return df.groupBy(F.coalesce(reason, F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def curated(stations: DataFrame, synonyms: DataFrame, noise: DataFrame, boxes: DataFrame, dependencies: DataFrame, gate: Gate = Gate(), margin: float = geo.MARGIN) -> tuple[DataFrame, DataFrame]:
    """(catalog, funnel) of raw stations: gate, dedup by URL key, coordinates outside the country dropped."""
    url = F.coalesce(F.nullif("url_resolved", F.lit("")), "url")
    with_genres = taxonomy.classified(stations, "seq", "tags", "name", synonyms, noise)
    judged = with_genres.withColumn("url", url).withColumn("reason", gate.reason(U.refusal(F.col("url")).isNotNull(), F.col("lastcheckok"), F.col("codec"), F.col("bitrate"), F.col("genres")))
    kept = judged.where("reason is null").select(
        "seq", "uuid", "name", "url", "homepage", F.col("countrycode").alias("country"), "language", "genres", F.slice("tags", 1, 8).alias("tags"), gate.codec(F.col("codec")).alias("codec"), "bitrate",
        (F.col("votes") + F.col("clickcount")).alias("popularity"), F.when((F.col("geo_lat") != 0) & (F.col("geo_long") != 0), F.struct(F.col("geo_lat").alias("lat"), F.col("geo_long").alias("lon"))).alias("geo"), "favicon",
        U.dedup_key(F.col("url")).alias("key"),
    )
    best = dedup.best_per_key(kept, "key", ["bitrate", "popularity"], "seq")
    placed = geo.without_false(best, "country", "geo", boxes, dependencies, margin)
    duplicates = kept.groupBy("key").agg((F.count("*") - 1).alias("n")).agg(F.lit("duplicate").alias("reason"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return placed.orderBy(F.desc("popularity"), "first_seq"), funnel(judged).unionByName(duplicates)


def statistics(catalog: DataFrame) -> DataFrame:
    return catalog.agg(F.count("*").alias("kept"), F.count_if(F.size("genres") > 0).alias("with_genre"), F.count_if(F.col("geo").isNotNull()).alias("with_geo"))


def by_genre(catalog: DataFrame) -> DataFrame:
    return catalog.select(F.explode("genres").alias("genre")).groupBy("genre").agg(F.count("*").alias("n"))


def triage(catalog: DataFrame) -> DataFrame:
    return catalog.select("name", "url", F.coalesce(F.try_element_at("genres", F.lit(1)), F.lit("unknown")).alias("group"))


def report(funnel: DataFrame, statistics: DataFrame, genres: DataFrame, most: int = 12) -> str:
    """The catalog's figures as text; all three inputs are small aggregates."""
    dropped = {r["reason"]: r["n"] for r in funnel.collect()}
    kept = statistics.first()
    lines = [f"input: {sum(n for reason, n in dropped.items() if reason != 'duplicate')}", *(f"  - {reason}: {n}" for reason, n in sorted(dropped.items()) if reason != "kept")]
    lines += [f"kept: {kept['kept']}, with genre: {kept['with_genre']}, with coordinates: {kept['with_geo']}"]
    top = genres.orderBy(F.desc("n"), "genre").limit(most).collect()
    return "\n".join([*lines, "genres: " + ", ".join(f"{r['genre']}={r['n']}" for r in top)])
