"""Stations that carry one programme: co-occurrence in rounds, confirmed pairs, groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialize
from .agreements import agreements
from .components import components

#: Rounds of agreement, and share of common rounds in agreement, that confirm a pair.
MIN_SAME, MIN_AGREEMENT = 3, 0.75


def co_occurrence(observations: DataFrame, round_: str = "round", station: str = "uuid", song: str = "song", min_same: int = 1, min_agreement: float = 0.0) -> DataFrame:
    """(a, b, same, both, first, last) of pairs that ever played one song in a round.

    ``both`` counts the rounds, from the first agreement on, in which both played.
    Agreements per (round, song) grow with the square of the stations that share a song;
    that is what is asked for. They are made and counted between blocks of stations, not shuffled.
    With minima only the pairs that ``confirmed`` keeps are returned.
    """
    seen = observations.select(F.col(round_).alias("round"), F.col(station).alias("uuid"), F.col(song).alias("song")).where("round is not null and uuid is not null").distinct()
    return agreements(seen, min_same, min_agreement)


def merged(state: DataFrame, agreed: DataFrame, playing: DataFrame) -> DataFrame:
    """A round folded into the state: ``agreed`` has a, b and round, ``playing`` uuid and round."""
    known = state.select("a", "b").join(playing.select(F.col("uuid").alias("a"), "round"), "a").join(playing.select(F.col("uuid").alias("b"), "round"), ["b", "round"]).join(agreed.select("a", "b", "round"), ["a", "b", "round"], "left_anti")
    against = known.select("a", "b", F.lit(0).cast("long").alias("same"), F.lit(1).cast("long").alias("both"), F.lit(None).cast("string").alias("first"), F.lit(None).cast("string").alias("last"))
    for_ = agreed.select("a", "b", F.lit(1).cast("long").alias("same"), F.lit(1).cast("long").alias("both"), F.col("round").alias("first"), F.col("round").alias("last"))
    return state.unionByName(for_).unionByName(against).groupBy("a", "b").agg(F.sum("same").alias("same"), F.sum("both").alias("both"), F.min("first").alias("first"), F.max("last").alias("last"))


def confirmed(co: DataFrame, min_same: int = MIN_SAME, min_agreement: float = MIN_AGREEMENT) -> DataFrame:
    return co.where((F.col("same") >= min_same) & (F.col("both") > 0) & (F.col("same") / F.col("both") >= min_agreement))


def groups(co: DataFrame, catalog: DataFrame, min_same: int = MIN_SAME, min_agreement: float = MIN_AGREEMENT) -> DataFrame:
    """(representative, members, weakest_same, weakest_agreement): confirmed pairs of the catalog, merged transitively."""
    known = catalog.select("uuid", F.coalesce("bitrate", F.lit(0)).alias("bitrate"), F.coalesce("popularity", F.lit(0)).alias("popularity"))
    sure = confirmed(co, min_same, min_agreement)
    inside = sure.join(known.select(F.col("uuid").alias("a")), "a", "left_semi").join(known.select(F.col("uuid").alias("b")), "b", "left_semi")
    inside = materialize(inside, "confirmed")  # the few confirmed pairs; co-occurrence isn't computed again for their groups
    of = components(inside.select("a", "b"))
    members = of.join(known, F.col("node") == F.col("uuid")).groupBy("component").agg(F.max_by("uuid", F.struct("bitrate", "popularity", "uuid")).alias("representative"), F.array_sort(F.collect_list("uuid")).alias("members"))
    edges = inside.join(of, F.col("a") == F.col("node")).groupBy("component").agg(F.min("same").alias("weakest_same"), F.round(F.min(F.col("same") / F.col("both")), 3).alias("weakest_agreement"))
    return members.join(edges, "component").select("representative", "members", "weakest_same", "weakest_agreement").orderBy(F.desc(F.size("members")), "representative")


def representative_map(found: DataFrame) -> DataFrame:
    return found.select(F.explode("members").alias("uuid"), "representative")
