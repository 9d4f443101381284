"""Readings of titles: evidence from the lexicon and cues, and a running tally of each station's habit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import text as T
from ..functions import titles as S

#: Votes that make a strong habit, and a weak one; a counter stops at the cap.
MIN_STRONG, MIN_WEAK, CAP = 2, 3, 64


def with_evidence(titles: DataFrame, names: DataFrame, pairs: DataFrame, raw: str = "raw", bound_decides: bool = True) -> DataFrame:
    """Titles with kind (notmusic, unsplit or split), left, right and e (orientation, strength, source)."""
    text = T.spaced(F.col(raw))
    rows = titles.withColumn("text", text).withColumn("h", T.halves(F.col("text")))
    junk = (F.length("text") < 4) | T.is_junk(F.col("text")) | T.is_broken(F.col("text"))
    junk_half = T.is_junk(F.col("h.left")) | T.is_junk(F.col("h.right"))
    rows = rows.withColumn("kind", F.when(junk, "notmusic").when(F.col("h").isNull(), "unsplit").when(junk_half, "notmusic").otherwise("split"))
    rows = rows.withColumns({"left": F.when(F.col("kind") == "split", F.col("h.left")), "right": F.when(F.col("kind") == "split", F.col("h.right"))}).drop("h")
    # distinct halves are folded and looked up once
    pieces = rows.select(F.explode(F.array("left", "right")).alias("piece")).where("piece is not null").distinct().withColumn("key", T.fold(F.col("piece")))
    known = names.select("key", F.lit(True).alias("name")).distinct()
    folded = pieces.join(known, "key", "left").select("piece", "key", F.coalesce("name", F.lit(False)).alias("name"))
    side = lambda c: folded.select(F.col("piece").alias(c), F.col("key").alias(f"{c}_key"), F.col("name").alias(f"{c}_name"))
    rows = rows.join(side("left"), "left", "left").join(side("right"), "right", "left")
    pair = lambda a, b, out: pairs.select(F.col("artist").alias(f"{a}_key"), F.col("title").alias(f"{b}_key"), F.lit(True).alias(out)).distinct()
    rows = rows.join(pair("left", "right", "lr"), ["left_key", "right_key"], "left").join(pair("right", "left", "rl"), ["left_key", "right_key"], "left")
    no = F.lit(False)
    found = S.evidence(F.coalesce("lr", no), F.coalesce("rl", no), F.coalesce("left_name", no), F.coalesce("right_name", no), S.structural(F.col("left"), F.col("right")), bound_decides)
    return rows.withColumn("e", F.when(F.col("kind") == "split", found)).drop("left_key", "right_key", "left_name", "right_name", "lr", "rl")


def habit(strong_first: Column, strong_second: Column, weak_first: Column, weak_second: Column, min_weak: int = MIN_WEAK) -> Column:
    """What a station's tally says: strong votes if they are clear; weak ones only without any strong."""
    high, low = F.greatest(strong_first, strong_second), F.least(strong_first, strong_second)
    return (
        F.when((high >= MIN_STRONG) & (high > 2 * low), F.when(strong_first > strong_second, S.ARTIST_FIRST).otherwise(S.TRACK_FIRST))
        .when(high > 0, None)
        .when((weak_first >= min_weak) & (weak_second == 0), S.ARTIST_FIRST)
        .when((weak_second >= min_weak) & (weak_first == 0), S.TRACK_FIRST)
    )


def tallied(rows: DataFrame, station: str = "station", seq: str = "seq") -> DataFrame:
    """The four counters after each row, capped; a title votes once for a station.

    A station's rows are one window partition in order of ``seq``: the tally is a running one.
    """
    votes = (F.coalesce(F.col(station), F.lit("")) != "") & F.col("e.orientation").isNotNull() & (F.col("e.strength") >= 1)
    first = F.row_number().over(W.partitionBy(station, "text", votes).orderBy(seq)) == 1
    rows = rows.withColumn("vote_", F.coalesce(votes & first, F.lit(False)))
    running = W.partitionBy(station).orderBy(seq).rowsBetween(W.unboundedPreceding, 0)
    for name, strong, orientation in (("strong_first", True, 0), ("strong_second", True, 1), ("weak_first", False, 0), ("weak_second", False, 1)):
        counts = F.col("vote_") & ((F.col("e.strength") >= 2) == F.lit(strong)) & (F.col("e.orientation") == orientation)
        rows = rows.withColumn(name, F.least(F.lit(CAP), F.sum(F.when(counts, 1).otherwise(0)).over(running)).cast("long"))
    return rows.drop("vote_")


def readings(titles: DataFrame, names: DataFrame, pairs: DataFrame, station: str = "station", raw: str = "raw", seq: str = "seq", min_weak: int = MIN_WEAK, bound_decides: bool = True) -> DataFrame:
    """(station, seq, raw, kind, artist, track, source): strong evidence decides, else the station's habit after this row's vote."""
    rows = tallied(with_evidence(titles, names, pairs, raw, bound_decides), station, seq)
    own = F.when(F.col("e.strength") >= 2, F.col("e.orientation"))
    by_habit = F.when(F.coalesce(F.col(station), F.lit("")) != "", habit(F.col("strong_first"), F.col("strong_second"), F.col("weak_first"), F.col("weak_second"), min_weak))
    decision = F.coalesce(own, by_habit)
    artist, track = F.when(decision == S.ARTIST_FIRST, F.col("left")).otherwise(F.col("right")), F.when(decision == S.ARTIST_FIRST, F.col("right")).otherwise(F.col("left"))
    song = (F.col("kind") == "split") & decision.isNotNull() & artist.rlike(T.WORD) & (F.length(artist) <= 90)
    kind = F.when(F.col("kind") == "notmusic", "notmusic").when(song, "song").otherwise("unsplit")
    source = F.when(own.isNotNull(), F.col("e.source")).otherwise("station")
    return rows.select(F.col(station).alias("station"), F.col(seq).alias("seq"), F.col(raw).alias("raw"), kind.alias("kind"), F.when(song, artist).alias("artist"), F.when(song, track).alias("track"), F.when(song, source).alias("source"))


def resolution(found: DataFrame) -> DataFrame:
    """Counts by kind, and the percentage of music that was resolved."""
    counts = [F.count_if(F.col("kind") == k).alias(k) for k in ("song", "unsplit", "notmusic")]
    music = F.col("song") + F.col("unsplit")
    return found.agg(*counts).withColumn("rate", F.when(music > 0, 100.0 * F.col("song") / music).otherwise(0.0))


def graded(songs: DataFrame, oracle: DataFrame, artist: str = "artist", track: str = "track") -> DataFrame:
    """Songs with verdict ok, WRONG or ungraded: whether the oracle's (artist, title) keys hold the pair, or only its reverse."""
    keyed = songs.withColumn("a_", T.fold(F.col(artist))).withColumn("t_", T.fold(F.col(track)))
    pairs = oracle.select("artist", "title").distinct()
    as_is = pairs.select(F.col("artist").alias("a_"), F.col("title").alias("t_"), F.lit(True).alias("as_is"))
    turned = pairs.select(F.col("title").alias("a_"), F.col("artist").alias("t_"), F.lit(True).alias("turned"))
    met = keyed.join(as_is, ["a_", "t_"], "left").join(turned, ["a_", "t_"], "left")
    verdict = F.when(F.col("as_is") & F.col("turned").isNull(), "ok").when(F.col("turned") & F.col("as_is").isNull(), "WRONG").otherwise("ungraded")
    return met.withColumn("verdict", verdict).drop("a_", "t_", "as_is", "turned")


def grades(found: DataFrame) -> DataFrame:
    return found.groupBy("source", "verdict").agg(F.count("*").alias("n"))


def corpus(titles: DataFrame, station: str = "station") -> DataFrame:
    """(titles, stations) of a capture."""
    return titles.agg(F.count("*").alias("titles"), F.count_distinct(station).alias("stations"))


def measured(readings: DataFrame, oracle: DataFrame | None = None) -> DataFrame:
    """One row: sampled, song, unsplit, notmusic, rate, and against an oracle right, wrong and the accuracy (null if nothing is graded)."""
    figures = ("sampled", "song", "unsplit", "notmusic", "right", "wrong")
    none = F.lit(0).cast("long")
    counted = resolution(readings).drop("rate")
    counted = counted.unionByName(readings.agg(F.count("*").alias("sampled")), allowMissingColumns=True)
    if oracle is not None:
        verdict = graded(readings.where("kind = 'song'"), oracle)
        counted = counted.unionByName(verdict.agg(F.count_if(F.col("verdict") == "ok").alias("right"), F.count_if(F.col("verdict") == "WRONG").alias("wrong")), allowMissingColumns=True)
    else:
        counted = counted.withColumns({"right": none, "wrong": none})
    one = counted.agg(*(F.coalesce(F.sum(c), none).alias(c) for c in figures))
    music, judged = F.col("song") + F.col("unsplit"), F.col("right") + F.col("wrong")
    rate, accuracy = (F.when(music > 0, 100.0 * F.col("song") / music).otherwise(0.0), F.when(judged > 0, 100.0 * F.col("right") / judged))
    return one.withColumns({"rate": rate, "accuracy": accuracy})
