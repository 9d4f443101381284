"""Further stations on hosts that the catalog knows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import titles as S
from ..functions import url as U
from ..storage import materialize
from . import dedup
from .catalog import Gate

# Mounts that carry no programme, mounts of a mass host, the overlap of two names of one machine.
SKIPPED = ("/", "/admin", "/status", "/stream.nsv")
SKIPPED_ENDINGS = r"\.(xspf|m3u|pls|asx)$"
MOST_MOUNTS, OVERLAP, BITRATE = 400, 0.9, 96


def seeds(catalog: DataFrame, url: str, seq: str, watchable: str = "watchable", most: int | None = None) -> DataFrame:
    """The first watchable station of each host, as written in the URL."""
    named = catalog.where(F.col(watchable)).withColumn("host", F.lower(U.authority(F.col(url)))).where("host <> ''")
    first = dedup.first_per_key(named, ["host"], [seq])
    return first.orderBy(seq).limit(most) if most else first


def listenable(mounts: DataFrame, host: str, path: str = "path", most: int = MOST_MOUNTS) -> DataFrame:
    """Mounts that carry a programme, of hosts with at most ``most`` mounts."""
    counted = mounts.withColumn("n_", F.count("*").over(W.partitionBy(host))).where(F.col("n_") <= most).drop("n_")
    return counted.where((F.col(path) != "") & ~F.col(path).isin(*SKIPPED) & ~F.col(path).rlike(SKIPPED_ENDINGS))


def candidate_url(base: Column, raw_path: Column, path: Column) -> Column:
    """The queried host and the mount's path as written; null without one."""
    raw = F.coalesce(F.nullif(raw_path, F.lit("")), path)
    return F.when((raw != "") & (raw != "/") & base.isNotNull(), F.concat(base, raw))


def passes(codec: Column, bitrate: Column, least: int = BITRATE, gate: Gate = Gate()) -> Column:
    return ((codec == "") | codec.isin(*gate.codecs)) & ((bitrate == 0) | (bitrate >= least))


def overlaps(paths: DataFrame, host: str = "host", path: str = "path", least: float = OVERLAP) -> DataFrame:
    """(a, b) of hosts whose sets of paths have a Jaccard index of at least ``least``, a before b: more paths, then name.

    Such sets share one of the first n - ceil(least * n) + 1 of their paths, in any order that all
    sets have: by rarity, so that a path that many hosts have joins few of them. The pairs that
    meet there, of sizes near enough, are compared in full.
    """
    distinct = materialize(paths.select(F.col(host).alias("host"), F.col(path).alias("path")).distinct(), "paths")
    sizes = distinct.groupBy("host").agg(F.count("*").alias("n"))
    often = distinct.groupBy("path").agg(F.count("*").alias("often"))
    sized = distinct.join(often, "path").join(sizes, "host")
    rank = F.row_number().over(W.partitionBy("host").orderBy("often", "path"))
    rare = materialize(sized.withColumn("rank", rank).where(F.col("rank") <= F.col("n") - F.ceil(F.lit(least) * F.col("n") - 1e-9) + 1).select("host", "path", "n"), "rare")
    before = (F.col("x.n") > F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.host") < F.col("y.host")))
    met = rare.alias("x").join(rare.alias("y"), (F.col("x.path") == F.col("y.path")) & (F.col("x.host") != F.col("y.host")) & before & (F.col("y.n") >= F.col("x.n") * least))
    pairs = met.select(F.col("x.host").alias("a"), F.col("y.host").alias("b"), F.col("x.n").alias("na"), F.col("y.n").alias("nb")).distinct()
    # the smaller set's paths, looked up in the larger
    both = pairs.join(distinct.select(F.col("host").alias("b"), "path"), "b").join(distinct.select(F.col("host").alias("a"), "path"), ["a", "path"])
    both = both.groupBy("a", "b", "na", "nb").agg(F.count("*").alias("both"))
    return both.where(F.col("both") / (F.col("na") + F.col("nb") - F.col("both")) >= least).select("a", "b")


def alias_hosts(paths: DataFrame, host: str = "host", path: str = "path", least: float = OVERLAP) -> DataFrame:
    """(host) of the hosts that are another view of a kept one.

    In order of size and name a host is dropped if it overlaps one that is kept. Rounds
    decide every host whose earlier neighbours are all decided; only edges go round.
    """
    edges = materialize(overlaps(paths, host, path, least), "overlaps")
    hosts = edges.select(F.col("a").alias("host")).union(edges.select("b")).distinct()
    decided = materialize(hosts.join(edges.select(F.col("b").alias("host")), "host", "left_anti").withColumn("kept", F.lit(True)), "hosts")
    while True:
        open_ = hosts.join(decided, "host", "left_anti")
        state = edges.join(open_, F.col("b") == F.col("host"), "left_semi").join(decided.withColumnRenamed("host", "a"), "a", "left")
        verdict = state.groupBy("b").agg(F.bool_or(F.coalesce("kept", F.lit(False))).alias("drop"), F.bool_and(F.col("kept").isNotNull()).alias("all"))
        new = verdict.where("drop or all").select(F.col("b").alias("host"), (~F.col("drop")).alias("kept"))
        after = materialize(decided.unionByName(new), "hosts")
        if after.count() == decided.count():
            return after.where("not kept").select("host")
        decided = after


def variants(mounts: DataFrame, host: str = "host", path: str = "path", seq: str = "seq") -> DataFrame:
    """The best mount of each station stem of a host: bitrate, then listeners, then first."""
    return dedup.first_per_key(mounts.withColumn("stem", S.station_stem(F.col(path))), [host, "stem"], [F.desc("bitrate"), F.desc("listeners"), seq])


def discovered(candidates: DataFrame, catalog: DataFrame, url: str = "url", seq: str = "seq") -> DataFrame:
    """Candidates of unknown key and fine shape, one for each key."""
    keyed = candidates.withColumn("key", U.dedup_key(F.col(url)))
    known = catalog.select(U.dedup_key(F.col(url)).alias("key")).distinct()
    fresh = keyed.join(known, "key", "left_anti").where(U.refusal(F.col(url)).isNull())
    return dedup.first_per_key(fresh, ["key"], [seq])


def funnel(mounts: DataFrame, aliases: DataFrame, good: DataFrame, picked: DataFrame, known: DataFrame, new: DataFrame, host: str = "host") -> DataFrame:
    """(step, n): what each step of a discovery saw and left out. Mounts of alias hosts don't count as seen."""
    count = lambda step, df, n=None: df.agg(F.lit(step).alias("step"), (F.count("*") if n is None else n).alias("n"))
    single = mounts.join(aliases, host, "left_anti")
    steps = [count("hosts_probed", mounts.select(host).distinct()), count("mounts_seen", single), count("alias_hosts", aliases), count("passed_quality", good), count("picked_variants", picked), count("already_known", known), count("new", new)]
    out = steps[0]
    for s in steps[1:]:
        out = out.unionByName(s)
    return out


def entries(found: DataFrame) -> DataFrame:
    """Discovered mounts in the catalog's shape; country and language come from the seed. Expects seed_* columns and genres."""
    name = F.coalesce(F.nullif(F.trim("name"), F.lit("")), F.regexp_replace("path", "^/+", ""))
    genre = F.lower(F.trim("genre"))
    return found.select(
        F.concat(F.lit("sibling:"), "key").alias("uuid"), name.alias("name"), "url", F.lit("").alias("homepage"), F.col("seed_country").alias("country"), F.col("seed_language").alias("language"), "genres",
        F.when(genre != "", F.array(genre)).otherwise(F.array().cast("array<string>")).alias("tags"), "codec", "bitrate", F.lit(0).cast("long").alias("popularity"), F.lit("").alias("favicon"), F.lit(True).alias("watchable"), F.col("seed_uuid").alias("discovered_from"),
    )
