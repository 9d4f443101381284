"""Queries of status documents, siblings and the catalog over tables of real size, with their SQL.

Parts are mounts, brands and types are servers: documents are written from the tables, and
what is read from them must be the tables' values again.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import text as T
from .functions import url as U
from .operators import catalog, dedup, geo, lexicon, mounts, orientation, plays, siblings, simulcast
from .plans import pipelines
from .queries import BOXES, DEPENDENCIES, SQL_CO, SQL_POINTS, SQL_READ, _co, _observations, _readings, query, table, values
from .sources import readers

# --------------------------------------------------------------- documents

SQL_PATH = "'/Live/' || replace(p_name, ' ', '-') || '-' || p_partkey || '.mp3'"


def _parts(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.withColumn("path", F.concat(F.lit("/Live/"), F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("-"), F.col("p_partkey").cast("string"), F.lit(".mp3")))


def _joined(rows, host, piece, opening, closing):
    """One document for each host: its pieces in order of the key."""
    listed = rows.groupBy(F.col(host).alias("host")).agg(F.array_sort(F.collect_list(F.struct("p_partkey", piece.alias("piece")))).alias("pieces"))
    return listed.select("host", F.concat(F.lit(opening), F.concat_ws(",", F.transform("pieces", lambda p: p["piece"])) if opening.startswith("{") else F.array_join(F.transform("pieces", lambda p: p["piece"]), "\n"), F.lit(closing)).alias("body"))


def _icecast(spark, sf_dir):
    source = F.to_json(
        F.struct(
            F.concat(F.lit("http://"), F.replace("p_brand", F.lit("#"), F.lit("")), F.col("path")).alias("listenurl"), F.concat(F.lit(" \n"), "p_type", F.lit(" - "), "p_name", F.lit("\t")).alias("title"),
            F.col("p_size").cast("string").alias("listeners"), (F.col("p_size") * 8).alias("bitrate"), F.col("p_name").alias("server_name"), F.lit("audio/mpeg").alias("server_type"),
        )
    )
    docs = _joined(_parts(spark, sf_dir), "p_brand", source, '{"icestats":{"source":[', "]}}")
    return docs.select("host", F.col("host").alias("doc"), F.lit("/status-json.xsl").alias("path"), "body")


@query("icecast_mounts", f"SELECT p_brand AS doc, lower({SQL_PATH[:-len(chr(39)) - 4]}.mp3') AS path, {SQL_PATH} AS raw_path, p_type || ' - ' || p_name AS title, p_name AS name, 'MP3' AS codec, p_size::BIGINT * 8 AS bitrate, p_size::BIGINT AS listeners FROM part")
def icecast_mounts(spark, sf_dir):
    found = mounts.parsed(_icecast(spark, sf_dir), "doc", "path", "body")
    return found.select("doc", "mount.path", "mount.raw_path", "mount.title", "mount.name", "mount.codec", "mount.bitrate", "mount.listeners")


@query("html_mounts", f"SELECT p_type AS doc, lower({SQL_PATH}) AS path, p_brand || ' - ' || p_name AS title, p_name AS name, p_size::BIGINT AS listeners FROM part")
def html_mounts(spark, sf_dir):
    """Labels and values with line breaks around them, as pages have them."""
    block = F.concat(
        F.lit("<h3 class='mount'>\nMount Point "), "path", F.lit("</h3>\n<table><tr><td>\nStream Name:</td>\n <td> "), "p_name", F.lit("\n</td></tr><tr><td>Listeners (current):</td><td>"), F.col("p_size").cast("string"),
        F.lit("</td></tr><tr><td class=x>\n\tCurrently Playing:</td><td>\n"), "p_brand", F.lit(" - "), "p_name", F.lit("\n</td></tr></table>"),
    )
    docs = _joined(_parts(spark, sf_dir), "p_type", block, "<html>", "</html>").select(F.col("host").alias("doc"), F.lit("/status.xsl").alias("path"), "body")
    return mounts.parsed(docs, "doc", "path", "body").select("doc", "mount.path", "mount.title", "mount.name", "mount.listeners")


@query("shoutcast_mounts", "SELECT s_name AS doc, '' AS path, '/stream' AS raw_path, s_name || ' - Song' AS title, s_suppkey AS bitrate, s_nationkey::BIGINT AS listeners FROM supplier")
def shoutcast_mounts(spark, sf_dir):
    body = F.to_json(F.struct(F.concat(F.lit(" "), "s_name", F.lit(" - Song\n")).alias("songtitle"), F.col("s_suppkey").cast("string").alias("bitrate"), F.col("s_nationkey").alias("currentlisteners"), F.lit("/stream").alias("streampath")))
    docs = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("doc"), F.lit("/stats?json=1").alias("path"), body.alias("body"))
    return mounts.parsed(docs, "doc", "path", "body").select("doc", "mount.path", "mount.raw_path", "mount.title", "mount.bitrate", "mount.listeners")


@query("deep_titles", "SELECT p_partkey AS doc, 0 AS pos, p_name || ' - ' || p_brand AS title FROM part UNION ALL SELECT p_partkey, 1, 'outer' FROM part")
def deep_titles(spark, sf_dir):
    """Titles in unknown JSON under as many objects as a part's size, and one after them."""
    inner = F.to_json(F.struct(F.concat("p_name", F.lit(" - "), "p_brand", F.lit("\n")).alias("song")))
    body = F.concat(F.repeat(F.lit('{"zz":['), F.col("p_size").cast("int")), inner, F.repeat(F.lit("]}"), F.col("p_size").cast("int") - 1), F.lit('],"title":"outer","a":"no"}'))
    docs = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("doc"), F.lit("/status-json.xsl").alias("path"), body.alias("body"))
    return mounts.parsed(docs, "doc", "path", "body").select("doc", F.col("pos").cast("int").alias("pos"), "mount.title")


@query(
    "mounts_of_streams",
    f"""SELECT p_partkey, CASE WHEN p_partkey % 3 < 2 THEN '/status-json.xsl' END AS nowplaying_endpoint, p_partkey % 3 < 2 AS watchable, CASE WHEN p_partkey % 3 < 2 THEN p_type END AS artist, CASE WHEN p_partkey % 3 < 2 THEN p_name END AS track FROM part""",
)
def mounts_of_streams(spark, sf_dir):
    """Streams by their own path, by a base name behind a prefix, and by a path that the server doesn't have."""
    base = F.element_at(F.split("path", "/"), -1)
    url = F.concat(F.lit("http://x/"), F.when(F.col("p_partkey") % 3 == 0, F.substring("path", 2, 400)).when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("proxy/"), base, F.lit("?x=1"))).otherwise(F.concat(F.lit("gone"), base)))
    streams = _parts(spark, sf_dir).select("p_partkey", F.col("p_brand").alias("host"), url.alias("url"))
    docs = _icecast(spark, sf_dir)
    chosen = mounts.selected(streams, mounts.first_answer(docs, mounts.parsed(docs, "doc", "path", "body"), "host", "doc", "path"), "p_partkey", "host", "url")
    found = mounts.watchable(streams, chosen, "p_partkey")
    return found.select("p_partkey", "nowplaying_endpoint", "watchable", "song.artist", "song.track")


@query(
    "observed_plays",
    "SELECT p_partkey::VARCHAR AS uuid, p_type AS artist, p_name AS track, trim(regexp_replace(lower(p_type), '[^a-z0-9 ]+', ' ', 'g')) AS artist_key, 'r1' AS round FROM part WHERE p_partkey % 2 = 0",
)
def observed_plays(spark, sf_dir):
    song = T.song_of(F.when(F.col("p_partkey") % 2 == 0, F.concat("p_type", F.lit(" - "), "p_name")).otherwise(F.concat(F.lit("Advert - "), "p_name")))
    probed = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("uuid"), song.alias("song"), F.lit("raw").alias("raw"))
    return mounts.observed(probed, "uuid", F.lit("r1")).select("uuid", "artist", "track", "artist_key", "round")


# --------------------------------------------------------------- siblings and catalog


@query(
    "sibling_candidates",
    f"""SELECT p_partkey, 'http://h' || {SQL_PATH} AS url FROM part WHERE p_size >= 12 AND p_partkey % 10 <> 0 AND p_brand IN (SELECT p_brand FROM part GROUP BY p_brand HAVING count(*) <= 90)""",
)
def sibling_candidates(spark, sf_dir):
    """Mounts that carry a programme, on hosts of few mounts, good enough, with their URL."""
    rows = _parts(spark, sf_dir).select("p_partkey", F.col("p_brand").alias("host"), F.when(F.col("p_partkey") % 10 == 0, F.concat("path", F.lit(".m3u"))).otherwise(F.col("path")).alias("path"), (F.col("p_size") * 8).alias("bitrate"), F.lit("MP3").alias("codec"))
    good = siblings.listenable(rows, "host", "path", 90).where(siblings.passes(F.col("codec"), F.col("bitrate")))
    return good.select("p_partkey", siblings.candidate_url(F.lit("http://h"), F.col("path"), F.lower("path")).alias("url")).where("url is not null")


@query("sibling_entries", "SELECT 'sibling:k' || p_partkey AS uuid, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE 'p' || p_partkey END AS name, p_brand AS country, [lower(p_type)] AS tags, true AS watchable, p_type AS discovered_from FROM part")
def sibling_entries(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string")
    found = part.select(
        F.concat(F.lit("k"), key).alias("key"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).otherwise(" ").alias("name"), F.concat(F.lit("//p"), key).alias("path"), F.lit("u").alias("url"), F.col("p_brand").alias("seed_country"),
        F.lit("xx").alias("seed_language"), F.array().cast("array<string>").alias("genres"), F.col("p_type").alias("genre"), F.lit("MP3").alias("codec"), F.lit(1).alias("bitrate"), F.col("p_type").alias("seed_uuid"),
    )
    return siblings.entries(found).select("uuid", "name", "country", "tags", "watchable", "discovered_from")


def _stations(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    text = lambda c: F.lit(c).cast("string")
    raw = part.select(
        F.col("p_partkey").alias("seq"), F.col("p_partkey").cast("string").alias("stationuuid"), F.col("p_type").alias("name"), F.concat(F.lit("http://www.h"), (F.col("p_partkey") % 700).cast("string"), F.lit(":80/s/")).alias("url"), text("").alias("url_resolved"), text("").alias("homepage"),
        F.replace("p_name", F.lit(" "), F.lit(",")).alias("tags"), text("").alias("country"), text("de").alias("countrycode"), text("").alias("language"), F.when(F.col("p_partkey") % 11 == 0, "WMA").otherwise("mp3").alias("codec"), text("").alias("favicon"),
        (F.col("p_size") * 8).cast("string").alias("bitrate"), F.col("p_size").cast("string").alias("votes"), text("1").alias("clickcount"), F.when(F.col("p_partkey") % 13 == 0, "0").otherwise("1").alias("lastcheckok"), text(None).alias("geo_lat"), text(None).alias("geo_long"),
    )
    return readers.shaped(raw)


def _built(spark, sf_dir):
    rows = _stations(spark, sf_dir)
    none = values(spark, "('none')", "tag")
    genres = values(spark, "('metal', 'bolt', 0), ('red', 'red', 1)", "genre, synonym, priority")
    boxes = values(spark, "('XX', 0.0, 1.0, 0.0, 1.0)", "code, min_lat, max_lat, min_lon, max_lon")
    return pipelines.build_catalog([rows.where("seq % 2 = 0"), rows.where("seq % 2 = 1")], genres, none, boxes, values(spark, "('XX', 'XX')", "code, dep"))


SQL_STATIONS = "SELECT p_partkey AS seq, p_partkey % 700 AS host, p_size * 8 AS bitrate, p_size + 1 AS popularity, CASE WHEN p_partkey % 13 = 0 THEN 'dead' WHEN p_partkey % 11 = 0 THEN 'codec' WHEN p_size * 8 < 96 THEN 'bitrate' ELSE 'kept' END AS reason FROM part"


@query(
    "catalog_build",
    f"""WITH s AS ({SQL_STATIONS}), r AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY bitrate DESC, popularity DESC, seq) AS rn, min(seq) OVER (PARTITION BY host) AS first_seq FROM s WHERE reason = 'kept')
    SELECT '//h' || host || '/s' AS key, seq::VARCHAR AS uuid, first_seq, bitrate::BIGINT AS bitrate, popularity::BIGINT AS popularity, 'MP3' AS codec FROM r WHERE rn = 1""",
)
def catalog_build(spark, sf_dir):
    return _built(spark, sf_dir).stations.select("key", "uuid", "first_seq", "bitrate", "popularity", "codec")


@query("catalog_funnel", f"WITH s AS ({SQL_STATIONS}) SELECT reason, count(*) AS n FROM s GROUP BY 1 UNION ALL SELECT 'duplicate', count(*) - count(DISTINCT host) FROM s WHERE reason = 'kept'")
def catalog_funnel(spark, sf_dir):
    return _built(spark, sf_dir).funnel


@query("catalog_tags", "SELECT tag, count(*) AS n, CASE tag WHEN 'bolt' THEN 'metal' WHEN 'red' THEN 'red' END AS genre FROM (SELECT unnest(string_split(p_name, ' ')) AS tag FROM part) GROUP BY tag")
def catalog_tags(spark, sf_dir):
    return _built(spark, sf_dir).tags.select("tag", "n", "genre")


@query("catalog_order", f"WITH s AS ({SQL_STATIONS}) SELECT seq, row_number() OVER (ORDER BY seq % 37 = 0 DESC, popularity DESC, seq) - 1 AS place FROM s")
def catalog_order(spark, sf_dir):
    rows = _stations(spark, sf_dir).select("seq", (F.col("votes") + F.col("clickcount")).alias("popularity"), (F.col("seq") % 37 == 0).alias("featured"))
    return dedup.featured_first(rows, [F.desc("popularity"), "seq"]).select("seq", F.col("place").cast("long").alias("place"))


@query(
    "geo_kept",
    f"""WITH p AS ({SQL_POINTS}), box AS (SELECT * FROM (VALUES {BOXES}) v(code, a, b, w, e)), dep AS (SELECT * FROM (VALUES {DEPENDENCIES}) v(code, dep)),
    every AS (SELECT * FROM box UNION ALL SELECT d.code, b.a, b.b, b.w, b.e FROM dep d JOIN box o ON o.code = d.code JOIN box b ON b.code = d.dep),
    met AS (SELECT p.*, every.code IS NOT NULL AS known, lat >= a - 2 AND lat <= b + 2 AND CASE WHEN w > e THEN lon >= w - 2 OR lon <= e + 2 ELSE lon >= w - 2 AND lon <= e + 2 END AS hit FROM p LEFT JOIN every ON every.code = p.code WHERE lat IS NOT NULL)
    , v AS (SELECT c_custkey, CASE WHEN lat NOT BETWEEN -90 AND 90 OR lon NOT BETWEEN -180 AND 180 OR (lat = 0 AND lon = 0) THEN false WHEN NOT bool_or(known) THEN NULL ELSE bool_or(hit) END AS inside FROM met GROUP BY c_custkey, lat, lon)
    SELECT count(*) FILTER (inside IS NULL) AS unverifiable, count(*) FILTER (inside) AS inside, count(*) FILTER (NOT inside) AS dropped FROM v""",
)
def geo_kept(spark, sf_dir):
    """Coordinates that stay, that go, and that can't be judged."""
    table(spark, sf_dir, "customer").createOrReplaceTempView("stationlens_customer")
    points = spark.sql(SQL_POINTS.replace("FROM customer", "FROM stationlens_customer")).select(F.col("c_custkey").alias("key"), F.col("code").alias("country"), F.when(F.col("lat").isNotNull(), F.struct(F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"))).alias("geo"))
    found = geo.without_false(points, "country", "geo", values(spark, BOXES, "code, min_lat, max_lat, min_lon, max_lon"), values(spark, DEPENDENCIES, "code, dep")).join(points.where("geo is not null").select("key"), "key", "left_semi")
    return found.agg(F.count_if(F.col("inside").isNull() & F.col("geo").isNotNull()).alias("unverifiable"), F.count_if(F.col("inside") & F.col("geo").isNotNull()).alias("inside"), F.count_if(F.col("geo").isNull()).alias("dropped"))


@query("wide_countries", "SELECT upper(substr(n_name, 1, 2)) AS code, n_nationkey::BIGINT AS n FROM nation WHERE n_nationkey >= 1 AND upper(substr(n_name, 1, 2)) NOT IN ('GE', 'FR', 'IN')")
def wide_countries(spark, sf_dir):
    records = table(spark, sf_dir, "nation").select(F.substring("n_name", 1, 2).alias("name"), F.col("n_nationkey").alias("stationcount"))
    return readers.wide(readers.countries(records), ["GE", "FR", "IN"])


# --------------------------------------------------------------- plays, simulcasts, titles


@query("harvest_rounds", "SELECT count(DISTINCT strftime(ts, '%Y-%m-%dT%H:%MZ')) AS rounds, max(strftime(ts, '%Y-%m-%dT%H:%MZ')) AS updated FROM events")
def harvest_rounds(spark, sf_dir):
    seen = _observations(spark, sf_dir)
    early = F.col("round") < "2024-01-15"
    return plays.merged_rounds(plays.rounds(seen.where(early)), plays.rounds(seen.where(~early)))


@query("merged_half_topk", "SELECT key, n FROM (SELECT key, count(*) AS n FROM (SELECT event_type AS key FROM events UNION ALL SELECT 'song ' || json_extract_string(props, '$.k') FROM events) GROUP BY key) ORDER BY n DESC, key LIMIT 30")
def merged_half_topk(spark, sf_dir):
    seen = _observations(spark, sf_dir)
    early = F.col("seq") % 2 == 0
    return plays.merged_halves(plays.half_counts(seen.where(early), "raw"), plays.half_counts(seen.where(~early), "raw"), 30)


@query(
    "simulcast_members",
    f"""WITH RECURSIVE {SQL_CO}, sure AS (SELECT a, b FROM co WHERE same >= 2 AND same / "both" >= 0.6), edge AS (SELECT a AS u, b AS v FROM sure UNION SELECT b, a FROM sure),
    reach(u, v) AS (SELECT u, u FROM edge UNION SELECT r.u, e.v FROM reach r JOIN edge e ON e.u = r.v), label AS (SELECT u, min(v) AS component FROM reach GROUP BY u),
    rep AS (SELECT component, arg_max(u, (c_acctbal > 0)::INT * 100000 + u::INT) AS representative FROM label JOIN customer ON c_custkey = u::INT GROUP BY component)
    SELECT u AS uuid, representative FROM label JOIN rep USING (component)""",
)
def simulcast_members(spark, sf_dir):
    stations = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("uuid"), (F.col("c_acctbal") > 0).cast("int").alias("bitrate"), F.col("c_custkey").alias("popularity"))
    return simulcast.representative_map(simulcast.groups(_co(spark, sf_dir, 2, 0.6), stations, 2, 0.6))


@query("capture_size", f"WITH {SQL_READ} SELECT count(*) AS titles, count(DISTINCT station) AS stations FROM readings")
def capture_size(spark, sf_dir):
    return orientation.corpus(_readings(spark, sf_dir))


SQL_KEY = "regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace(lower({0}), '[\\(\\[].*?[\\)\\]]', ' ', 'g'), '[^a-z0-9 ]+', ' ', 'g'), ' +', ' ', 'g')), '^the ', '')"


@query(
    "orientation_measured",
    f"""WITH {SQL_READ}, oracle AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS t FROM part WHERE p_size > 47), s AS (SELECT {SQL_KEY.format('artist')} AS a, {SQL_KEY.format('track')} AS t FROM readings WHERE kind = 'song'),
    g AS (SELECT (a, t) IN (SELECT (a, t) FROM oracle) AS x, (t, a) IN (SELECT (a, t) FROM oracle) AS y FROM s), v AS (SELECT count(*) FILTER (x AND NOT y) AS "right", count(*) FILTER (y AND NOT x) AS wrong FROM g),
    c AS (SELECT count(*) AS sampled, count(*) FILTER (kind = 'song') AS song, count(*) FILTER (kind = 'unsplit') AS unsplit, count(*) FILTER (kind = 'notmusic') AS notmusic FROM readings)
    SELECT sampled, song, unsplit, notmusic, round(100.0 * song / (song + unsplit), 6) AS rate, "right", wrong, round(100.0 * "right" / ("right" + wrong), 6) AS accuracy FROM c, v""",
)
def orientation_measured(spark, sf_dir):
    oracle = table(spark, sf_dir, "part").where("p_size > 47").select(F.split("p_name", " ")[0].alias("artist"), F.split("p_name", " ")[1].alias("title"))
    found = orientation.measured(_readings(spark, sf_dir), oracle)
    return found.select("sampled", "song", "unsplit", "notmusic", F.round("rate", 6).alias("rate"), "right", "wrong", F.round("accuracy", 6).alias("accuracy"))


@query("discography_pairs", "SELECT DISTINCT lower(regexp_replace(p_brand, '#', ' ')) AS artist, p_name AS title FROM part")
def discography_pairs(spark, sf_dir):
    tracks = F.array(F.struct(F.array(F.struct(F.col("p_name").alias("title"))).alias("tracks")))
    albums = table(spark, sf_dir, "part").select(F.col("p_brand").alias("artist"), tracks.alias("albums"))
    return lexicon.from_discography(albums)[1]


@query(
    "replayed_titles",
    "SELECT s_suppkey::VARCHAR AS uuid, 'red' AS artist, 'red' AS artist_key, 'Song ' || s_suppkey AS track, 't1' AS round FROM supplier WHERE s_suppkey % 4 <> 1",
)
def replayed_titles(spark, sf_dir):
    """Captured titles read anew with the lexicon, as observations of the catalog's stations."""
    rows = table(spark, sf_dir, "supplier")
    titles = rows.select(F.col("s_name").alias("url"), F.concat(F.lit("red - Song "), F.col("s_suppkey").cast("string")).alias("title"))
    titles = titles.unionByName(titles).unionByName(rows.select(F.col("s_name").alias("url"), F.lit("Advert - x").alias("title")))
    stations = rows.where("s_suppkey % 4 <> 1").select(F.col("s_name").alias("url"), F.col("s_suppkey").cast("string").alias("uuid"))
    found = pipelines.replay(titles, values(spark, "('red')", "key"), values(spark, "('a', 'b')", "artist, title"), stations, "t1")
    return found.select("uuid", "artist", "artist_key", "track", "round")


@query("catalog_report", f"WITH s AS ({SQL_STATIONS}), n AS (SELECT reason, count(*) AS n FROM s GROUP BY 1) SELECT (SELECT sum(n) FROM n)::BIGINT AS input, (SELECT count(DISTINCT host) FROM s WHERE reason = 'kept') AS kept")
def catalog_report(spark, sf_dir):
    """The two figures that head the report's text."""
    built = _built(spark, sf_dir)
    text = catalog.report(built.funnel, catalog.statistics(built.stations), catalog.by_genre(built.stations))
    rows = spark.createDataFrame([(text,)], "text string")
    return rows.select(F.regexp_extract("text", r"input: (\d+)", 1).cast("long").alias("input"), F.regexp_extract("text", r"kept: (\d+)", 1).cast("long").alias("kept"))


@query("host_names", "SELECT url, lower(regexp_extract(url, '^https?://([^/?#:]*)', 1)) AS host, coalesce(nullif(regexp_extract(url, '^https?://[^/?#:]*:([0-9]+)', 1), '')::INT, CASE WHEN starts_with(url, 'https') THEN 443 ELSE 80 END) AS port FROM pages")
def host_names(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select("url", U.host(url).alias("host"), F.coalesce(U.port(url), F.when(U.scheme(url) == "https", 443).otherwise(80)).alias("port"))
