"""Queries of readers, sinks and state: tables written and read again, with the SQL of the tables themselves."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from .operators import lexicon
from .queries import SQL_EVIDENCE, SQL_PLAYS, _observations, _recordings, query, table
from .sources import readers, sinks
from .storage import cached, shared_folder


def _folder(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("sink_pretty_array", "SELECT p_partkey, p_name, p_retailprice FROM part")
def sink_pretty_array(spark, sf_dir):
    folder = _folder(spark, "array")
    sinks.pretty_array(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice"), ["p_partkey"], folder)
    return readers.json_array(spark, folder, "p_partkey: bigint, p_name: string, p_retailprice: double").select("p_partkey", "p_name", "p_retailprice")


@query("array_order", "SELECT p_partkey, row_number() OVER (ORDER BY p_size DESC, p_partkey) - 1 AS seq FROM part")
def array_order(spark, sf_dir):
    """The place of each row in the array that was written in order."""
    folder = _folder(spark, "array")
    sinks.pretty_array(table(spark, sf_dir, "part").select("p_partkey", "p_size"), [F.desc("p_size"), "p_partkey"], folder)
    return readers.json_array(spark, folder, "p_partkey: bigint").select("p_partkey", F.col("seq").cast("long").alias("seq"))


@query("sink_keyed_object", "SELECT p_partkey::VARCHAR || ' \"q\"' AS key, p_size AS n, p_name AS name FROM part")
def sink_keyed_object(spark, sf_dir):
    folder = _folder(spark, "object")
    rows = table(spark, sf_dir, "part").select(F.concat(F.col("p_partkey").cast("string"), F.lit(' "q"')).alias("key"), F.col("p_size").alias("n"), F.col("p_name").alias("name"))
    sinks.keyed_object(rows, "key", folder)
    return readers.keyed_json(spark, folder, "struct<n: int, name: string>").select("key", "value.*")


@query("sink_json_lines", "SELECT p_partkey, CASE WHEN p_size > 10 THEN p_name END AS p_name FROM part")
def sink_json_lines(spark, sf_dir):
    folder = _folder(spark, "lines")
    sinks.json_lines(table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") > 10, F.col("p_name")).alias("p_name")), folder)
    return spark.read.schema("p_partkey bigint, p_name string").json(folder)


@query("sink_sorted_lines", "SELECT DISTINCT p_name AS key FROM part")
def sink_sorted_lines(spark, sf_dir):
    folder = _folder(spark, "sorted")
    sinks.sorted_lines(table(spark, sf_dir, "part"), "p_name", folder)
    return readers.lines(spark, folder)


@query("pair_lines", "SELECT DISTINCT p_brand AS artist, p_name AS title FROM part")
def pair_lines(spark, sf_dir):
    folder = _folder(spark, "pairs")
    sinks.sorted_lines(table(spark, sf_dir, "part").select(F.concat("p_brand", F.lit("\x01"), "p_name").alias("pair")), "pair", folder)
    return readers.pair_lines(spark, folder)


@query("sink_versions", "SELECT p_partkey, p_partkey % 2 AS version FROM part")
def sink_versions(spark, sf_dir):
    folder = _folder(spark, "versions")
    part = table(spark, sf_dir, "part").select("p_partkey")
    for v in ("0", "1"):
        sinks.versioned(part.where(F.col("p_partkey") % 2 == int(v)), folder, v)
    return spark.read.parquet(folder).select("p_partkey", F.col("version").cast("long").alias("version"))


@query("embedded_snapshot", "SELECT r_regionkey, r_name FROM region")
def embedded_snapshot(spark, sf_dir):
    """A small export packed into a source text and read out of it again."""
    import base64
    import re
    import zlib

    rows = [r.asDict() for r in table(spark, sf_dir, "region").orderBy("r_regionkey").select("r_regionkey", "r_name").collect()]  # an export of a few rows
    source = sinks.substituted('let other = "x"\nlet snapshot = "old"\n', "snapshot", sinks.packed(json.dumps(rows)))
    blob = re.search(r'snapshot = "([^"]+)"', source)[1]
    return spark.createDataFrame(json.loads(zlib.decompress(base64.b64decode(blob), -15)), "r_regionkey int, r_name string")


@query("recordings_csv", "SELECT 'Artist, \"' || p_brand || '\"' AS artist, 'r' || p_partkey AS recording, p_name AS title FROM part")
def recordings_csv(spark, sf_dir):
    folder = _folder(spark, "csv")
    x = F.lit("x")
    rows = table(spark, sf_dir, "part").select(x.alias("id"), x.alias("a"), x.alias("b"), F.concat(F.lit('Artist, "'), "p_brand", F.lit('"')).alias("artist"), x.alias("c"), x.alias("d"), F.concat(F.lit("r"), F.col("p_partkey").cast("string")).alias("recording_mbid"), F.col("p_name").alias("title"))
    rows.write.csv(folder, header=True, quote='"', escape='"')
    return readers.recordings(spark, folder)


@query("redirect_counts", "SELECT lpad(l_partkey::VARCHAR, 8, '0') || '-0000-0000-0000-000000000000' AS recording, count(*) AS redirects FROM lineitem GROUP BY 1")
def redirect_counts(spark, sf_dir):
    folder = _folder(spark, "redirects")
    id_ = lambda c: F.concat(F.lpad(F.col(c).cast("string"), 8, "0"), F.lit("-0000-0000-0000-000000000000"))
    table(spark, sf_dir, "lineitem").select(F.concat_ws(",", id_("l_orderkey"), id_("l_partkey"), id_("l_suppkey")).alias("value")).write.text(folder)
    return lexicon.redirect_counts(readers.redirects(spark, folder))


@query("cached_evidence", f"WITH {SQL_EVIDENCE} SELECT key, pop, as_artist, as_title FROM evidence")
def cached_evidence(spark, sf_dir):
    """The evidence of the lexicon, made once and read the second time."""
    path = _folder(spark, "evidence")
    cached(spark, path, lambda: lexicon.evidence(*_recordings(spark, sf_dir)))
    return cached(spark, path, lambda: None)


@query("stream_halves", "SELECT key, n FROM (SELECT key, count(*) AS n FROM (SELECT event_type AS key FROM events UNION ALL SELECT 'song ' || json_extract_string(props, '$.k') FROM events) GROUP BY key) ORDER BY n DESC, key LIMIT 40")
def stream_halves(spark, sf_dir):
    from .streaming import harvest

    folder = _folder(spark, "stream")
    stream = spark.readStream.schema(table(spark, sf_dir, "events").schema).format("parquet").load(f"{sf_dir}/events.parque[t]")
    raw = F.concat(F.col("event_type"), F.lit(" - Song "), F.get_json_object("props", "$.k"))
    harvest.stream_halves(stream.select(raw.alias("raw")), f"{folder}/state", f"{folder}/checkpoint", limit=40).awaitTermination()
    return harvest.latest(spark, f"{folder}/state").select("key", "n")


@query("stream_new_titles", "SELECT DISTINCT event_type AS station, json_extract_string(props, '$.k') AS title FROM events")
def stream_new_titles(spark, sf_dir):
    from .streaming import harvest

    folder = _folder(spark, "titles")
    stream = spark.readStream.schema(table(spark, sf_dir, "events").schema).format("parquet").load(f"{sf_dir}/events.parque[t]")
    titles = stream.select(F.col("event_type").alias("station"), F.get_json_object("props", "$.k").alias("title"))
    harvest.new_titles(titles, ["station", "title"], f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("station", "title")


@query("stored_play_pairs", SQL_PLAYS)
def stored_play_pairs(spark, sf_dir):
    """Play counts written as a version and read again."""
    from .operators import plays

    path = sinks.versioned(plays.pairs(_observations(spark, sf_dir)), _folder(spark, "plays"), "1")
    return spark.read.parquet(path)
