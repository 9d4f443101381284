"""Status documents to mounts, and the mount that belongs to a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import ArrayType, StringType

from ..functions import text as T
from ..functions import url as U

# Status paths in the order in which they are tried, keys of titles, labels of table rows.
STATUS_PATHS = ("/status-json.xsl", "/stats?json=1", "/status.xsl", "/7.html")
TITLE_KEYS = ("title", "songtitle", "yp_currently_playing", "song")
TITLE_LABELS = ("currently playing", "current song", "now playing", "title")
NAME_LABELS = ("stream name", "stream title", "name")
LISTENER_LABELS = ("listeners (current)", "current listeners", "listeners")
# How a page of mounts writes a block's heading, a row of label and value, and a cell.
HEADING = r"(?iU)<h3[^>]*>\s*Mount Point\s*([^<\s]+)"
ROW = r"(?iU)<td[^>]*>([^<]{1,60}):</td>\s*<td[^>]*>([^<]{0,200})</td>"
CELL = r"<td[^>]*>([^<]{4,150})</td>"

MOUNT = "struct<path:string,listen_url:string,raw_path:string,title:string,name:string,genre:string,codec:string,bitrate:bigint,listeners:bigint>"


def _json(value: str, at: str) -> Column:
    """A string of a JSON value without white space around it; empty for anything else."""
    is_text = F.expr(f"coalesce(schema_of_variant(try_variant_get({value}, '{at}', 'variant')) = 'STRING', false)")
    return F.when(is_text, T.stripped(F.expr(f"try_variant_get({value}, '{at}', 'string')"))).otherwise("")


def _filled(*values: Column) -> Column:
    return F.coalesce(*(F.nullif(v, F.lit("")) for v in values))


def _number(*values: Column) -> Column:
    """The first value that is there and not zero, as a whole number; 0 if it is none."""
    return F.coalesce(F.coalesce(*(F.when(~v.isin("", "0"), v) for v in values)).try_cast("bigint"), F.lit(0).cast("bigint"))


def _text(value: str, at: str) -> Column:
    return F.coalesce(F.expr(f"try_variant_get({value}, '{at}', 'string')"), F.lit(""))


def _mount(path: Column, listen: Column, raw: Column, title: Column, name: Column, genre: Column, codec: Column, bitrate: Column, listeners: Column) -> Column:
    parts = dict(path=path, listen_url=listen, raw_path=raw, title=F.nullif(title, F.lit("")), name=name, genre=genre, codec=codec, bitrate=bitrate, listeners=listeners)
    return F.struct(*(v.alias(k) for k, v in parts.items())).cast(MOUNT)


def icecast(docs: DataFrame, doc: str, value: str) -> DataFrame:
    """(doc, pos, mount) of ``icestats.source``, an object or an array of them."""
    source = f"try_variant_get({value}, '$.icestats.source', 'variant')"
    listed = docs.withColumn("s_", F.expr(source)).where("s_ is not null")
    listed = listed.withColumn("s_", F.expr("if(startswith(schema_of_variant(s_), 'OBJECT'), array(s_), try_cast(s_ as array<variant>))"))
    rows = listed.select(doc, F.posexplode("s_").alias("pos", "src")).where("startswith(schema_of_variant(src), 'OBJECT')")
    listen = _json("src", "$.listenurl")
    raw = F.coalesce(_filled(_json("src", "$.mount"), listen), F.lit(""))
    title = F.coalesce(_filled(_json("src", "$.title"), _json("src", "$.yp_currently_playing")), F.lit(""))
    bitrate = _number(_text("src", "$.bitrate"), _text("src", '$["ice-bitrate"]'))
    mount = _mount(U.mount_path(raw), listen, U.raw_mount_path(raw), title, _json("src", "$.server_name"), _json("src", "$.genre"), U.codec_of(_json("src", "$.server_type")), bitrate, _number(_text("src", "$.listeners")))
    return rows.where(raw != "").select(doc, "pos", mount.alias("mount"))


def shoutcast(docs: DataFrame, doc: str, value: str) -> DataFrame:
    """The one stream of a flat object, left without a path."""
    has = f"try_variant_get({value}, '$.songtitle', 'variant') is not null or try_variant_get({value}, '$.servertitle', 'variant') is not null"
    raw = F.coalesce(_filled(_json(value, "$.streampath")), F.lit("/"))
    mount = _mount(F.lit(""), F.lit(""), U.raw_mount_path(raw), _json(value, "$.songtitle"), _json(value, "$.servertitle"), _json(value, "$.servergenre"), U.codec_of(_json(value, "$.content")), _number(_text(value, "$.bitrate")), _number(_text(value, "$.currentlisteners")))
    return docs.where(has).select(doc, F.lit(0).alias("pos"), mount.alias("mount"))


@F.arrow_udf(ArrayType(StringType()))
def _titles(bodies):
    """All texts under a title key, in the order of the document, however deep."""
    import json

    import pyarrow as pa

    def of(body):
        try:
            whole = json.loads(body)
        except (ValueError, RecursionError):
            return None
        todo, out = [whole] if isinstance(whole, dict | list) else [], []
        while todo:
            node = todo.pop()
            if isinstance(node, str):
                out.append(node)  # put there by its key
            elif isinstance(node, dict):
                inner = [v.strip() if k in TITLE_KEYS and isinstance(v, str) else v for k, v in node.items() if isinstance(v, dict | list) or k in TITLE_KEYS and isinstance(v, str) and v.strip()]
                todo += reversed(inner)
            elif isinstance(node, list):
                todo += reversed([v for v in node if isinstance(v, dict | list)])
        return out

    return pa.array([None if b is None else of(b) for b in bodies.to_pylist()], pa.list_(pa.string()))


def any_titles(docs: DataFrame, doc: str, body: str) -> DataFrame:
    """Titles of unknown JSON, at any depth, as mounts without a path; Spark's functions don't recurse."""
    listed = docs.select(doc, _titles(F.col(body)).alias("titles")).select(doc, F.posexplode("titles").alias("pos", "title"))
    empty = F.lit("")
    return listed.select(doc, "pos", _mount(empty, empty, empty, F.col("title"), empty, empty, empty, F.lit(0), F.lit(0)).alias("mount"))


def html(docs: DataFrame, doc: str, body: str) -> DataFrame:
    """Blocks headed "Mount Point /x" with rows of label and value; else titles in cells that hold a dash."""
    blocks = docs.select(doc, F.posexplode(F.split(F.col(body), f"(?={HEADING})")).alias("pos", "block"))
    raw = F.regexp_extract("block", f"^{HEADING}", 1)
    labels, values = F.regexp_extract_all("block", F.lit(ROW), F.lit(1)), F.regexp_extract_all("block", F.lit(ROW), F.lit(2))
    rows = blocks.withColumn("raw", raw).where("raw <> ''").withColumn("fields", F.transform(F.arrays_zip(labels.alias("k"), values.alias("v")), lambda f: F.struct(F.lower(T.stripped(f["k"])).alias("k"), T.stripped(f["v"]).alias("v"))))
    # of rows with one label the last counts
    of = lambda label: F.coalesce(F.try_element_at(F.filter("fields", lambda f: f["k"] == label), F.lit(-1))["v"], F.lit(""))
    first = lambda names: F.coalesce(_filled(*map(of, names)), F.lit(""))
    mount = _mount(U.mount_path(F.col("raw")), F.lit(""), U.raw_mount_path(F.col("raw")), first(TITLE_LABELS), first(NAME_LABELS), of("genre"), U.codec_of(of("content type")), _number(of("bitrate")), _number(first(LISTENER_LABELS)))
    named = rows.select(doc, "pos", mount.alias("mount"))
    cells = docs.join(named.select(doc).distinct(), doc, "left_anti").select(doc, F.posexplode(F.regexp_extract_all(F.col(body), F.lit(CELL), F.lit(1))).alias("pos", "cell"))
    cells = cells.withColumn("cell", T.stripped(F.col("cell")))
    empty = F.lit("")
    bare = cells.where("contains(cell, ' - ')").select(doc, "pos", _mount(empty, empty, empty, F.col("cell"), empty, empty, empty, F.lit(0), F.lit(0)).alias("mount"))
    return named.unionByName(bare)


def parsed(docs: DataFrame, doc: str, path: str, body: str) -> DataFrame:
    """(doc, pos, mount) by the first parser that finds mounts."""
    is_json = F.col(path).rlike(r"(json=1|json\.xsl)$")
    as_json = docs.where(is_json).withColumn("value_", F.expr(f"try_parse_json({body})")).where("value_ is not null")
    one = icecast(as_json, doc, "value_")
    rest = as_json.join(one.select(doc).distinct(), doc, "left_anti")
    two = shoutcast(rest, doc, "value_")
    three = any_titles(rest.join(two.select(doc).distinct(), doc, "left_anti"), doc, body)
    return one.unionByName(two).unionByName(three).unionByName(html(docs.where(~is_json), doc, body))


def first_answer(docs: DataFrame, mounts: DataFrame, host: str, doc: str, path: str) -> DataFrame:
    """Of each host the mounts of the first status path that has any."""
    rank = F.array_position(F.array(*map(F.lit, STATUS_PATHS)), F.col(path))
    with_host = mounts.join(docs.select(doc, host, path), doc).withColumn("rank_", rank)
    return with_host.withColumn("best_", F.min("rank_").over(W.partitionBy(host))).where("rank_ = best_").select(host, path, "pos", "mount")


def selected(streams: DataFrame, mounts: DataFrame, stream: str, host: str, url: str) -> DataFrame:
    """(stream, endpoint, mount) of the streams whose mount is sure.

    The path itself (the first of equals), else a base name that only one mount of the host has,
    else the only mount if it has no name.
    """
    by = lambda path, base: F.explode(F.array(*(F.struct(F.lit(k).alias("rung"), v.alias("key")) for k, v in ((1, path), (2, base), (3, F.lit("")))))).alias("by")
    wanted = streams.select(stream, host, U.mount_path(F.col(url)).alias("wanted"))
    wanted = wanted.select(stream, host, by(F.col("wanted"), F.substring_index("wanted", "/", -1))).select(stream, host, "by.*")
    listed = mounts.select(host, F.struct("pos", "path", "mount").alias("at"), by(F.col("mount.path"), F.substring_index("mount.path", "/", -1))).select(host, "at", "by.*")
    # one mount at most for each rung and key, joined by equality: hosts have many streams and many mounts
    sure = listed.where((F.col("rung") == 3) | (F.col("key") != "")).groupBy(host, "rung", "key").agg(F.count("*").alias("n_"), F.min_by("at", "at.pos").alias("at"))
    sure = sure.where((F.col("rung") == 1) | (F.col("n_") == 1)).where((F.col("rung") < 3) | F.col("at.mount.path").isin("", "/")).drop("n_")
    best = wanted.join(sure, [host, "rung", "key"]).groupBy(stream).agg(F.min_by("at", F.struct("rung", "at.pos")).alias("at"))
    return best.select(stream, F.col("at.path").alias("endpoint"), "at.mount")


def watchable(streams: DataFrame, chosen: DataFrame, stream: str) -> DataFrame:
    """Streams with watchable, nowplaying_endpoint and what plays."""
    song = T.song_of(T.unescaped(F.coalesce("mount.title", F.lit(""))))
    now = chosen.select(stream, "endpoint", F.coalesce("mount.title", F.lit("")).alias("raw"), song.alias("song"))
    return streams.join(now, stream, "left").withColumn("watchable", F.col("endpoint").isNotNull()).withColumnRenamed("endpoint", "nowplaying_endpoint")


def observed(probed: DataFrame, stream: str, round_: Column) -> DataFrame:
    """One round's observations: streams that play a song whose artist has a key."""
    music = probed.where("song is not null").select(F.col(stream).alias("uuid"), F.col("song.artist").alias("artist"), F.col("song.track").alias("track"), "raw")
    return music.withColumn("artist_key", T.artist_key(F.col("artist"))).where("artist_key <> ''").withColumn("round", round_)
