"""Files in the shapes that the pipelines read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T


def stations(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of directory records, as written there."""
    return shaped(spark.read.option("multiLine", True).schema(RECORD).json(path).withColumn("seq", F.monotonically_increasing_id()))


RECORD = (
    "stationuuid string, name string, url string, url_resolved string, homepage string, tags string, country string, countrycode string, language string, codec string, favicon string, "
    "bitrate string, votes string, clickcount string, lastcheckok string, geo_lat string, geo_long string"
)


def shaped(records: DataFrame) -> DataFrame:
    """Records with defaults, typed: tags split, trimmed and lowered; codes upper case; numbers 0 if they are none."""
    text = lambda c: F.coalesce(c, F.lit("")).alias(c)
    number = lambda c: F.coalesce(F.col(c).try_cast("bigint"), F.lit(0).cast("bigint")).alias(c)
    tags = F.filter(F.transform(F.split(F.coalesce("tags", F.lit("")), ","), lambda t: F.lower(T.stripped(t))), lambda t: t != "")
    return records.select(
        "seq", F.coalesce("stationuuid", F.lit("")).alias("uuid"), T.stripped(F.coalesce("name", F.lit(""))).alias("name"), text("url"), F.coalesce(F.nullif("url_resolved", F.lit("")), "url", F.lit("")).alias("url_resolved"),
        text("homepage"), tags.alias("tags"), text("country"), F.upper(F.coalesce("countrycode", F.lit(""))).alias("countrycode"), text("language"), F.upper(F.coalesce("codec", F.lit(""))).alias("codec"), text("favicon"),
        number("bitrate"), number("votes"), number("clickcount"), F.coalesce(F.col("lastcheckok").isin("1", "true"), F.lit(False)).alias("lastcheckok"), F.col("geo_lat").try_cast("double").alias("geo_lat"), F.col("geo_long").try_cast("double").alias("geo_long"),
    )


def countries(records: DataFrame, least: int = 1) -> DataFrame:
    """Country codes of two letters with at least so many stations, most first; ``records`` has name and stationcount."""
    code = F.upper(F.trim(F.coalesce("name", F.lit(""))))
    n = F.coalesce(F.col("stationcount").try_cast("bigint"), F.lit(0).cast("bigint"))
    return records.select(code.alias("code"), n.alias("n")).where(F.col("code").rlike(r"(?U)^\p{Alpha}{2}$") & (F.col("n") >= least)).orderBy(F.desc("n"), "code")


def by_tag(catalog: DataFrame, tag: str, limit: int) -> DataFrame:
    return catalog.where(F.array_contains("tags", tag)).orderBy(F.desc("clickcount"), "uuid").limit(limit)


def keyed_json(spark: SparkSession, path: str, value: str) -> DataFrame:
    """A JSON object of entries as (key, value) rows; ``value`` is the entries' type."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.explode(F.from_json("value", f"map<string, {value}>")).alias("key", "value"))


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Arrays of records of all files that match, with the file, and the place in it, as their order."""
    whole = spark.read.text(path, wholetext=True).withColumn("file", F.col("_metadata.file_path"))
    rows = whole.select("file", F.posexplode(F.from_json("value", f"array<struct<{schema}>>")).alias("seq", "r"))
    return rows.select("file", "seq", "r.*")


def recordings(spark: SparkSession, path: str, lines_within: bool = False) -> DataFrame:
    """The canonical dump: columns 3, 6 and 7 (from 0) of a CSV with a header.

    A file is split among tasks; only a dump with line breaks inside its fields
    (``lines_within``) is read by one task for each file.
    """
    raw = spark.read.csv(path, header=False, quote='"', escape='"', multiLine=lines_within)
    names = raw.columns
    rows = raw.select(F.col(names[3]).alias("artist"), F.col(names[6]).alias("recording"), F.col(names[7]).alias("title"))
    return rows.where("recording not in ('recording_mbid', 'canonical_recording_mbid') or recording is null")


# A row of the redirect dump is three ids of 36 characters, apart by a comma; the second is the target.
REDIRECT_WIDTH, TARGET_AT, ID_WIDTH = 110, 38, 36


def redirects(spark: SparkSession, path: str) -> DataFrame:
    """The redirect dump by its fixed widths: the second of three ids."""
    rows = spark.read.text(path).where(F.length("value") == REDIRECT_WIDTH)
    return rows.select(F.substring("value", TARGET_AT, ID_WIDTH).alias("target")).where(F.col("target").rlike("^[0-9a-fA-F]{8}-"))


def archived(spark: SparkSession, paths: list[str], ending: str) -> DataFrame:
    """(archive, seq, value) of the lines of the members whose name ends so, of tar archives, plain or by zstd or gzip.

    An archive is a stream, which one task reads; write the lines to split them. Paths are
    of files that all executors can open.
    """

    def run(batches):
        import tarfile

        import pyarrow as pa
        import zstandard

        for batch in batches:
            for path in batch.column(0).to_pylist():
                with open(path, "rb") as file:
                    source = zstandard.ZstdDecompressor().stream_reader(file) if path.endswith((".zst", ".zstd")) else file
                    seq, held, size = 0, [], 0
                    with tarfile.open(fileobj=source, mode="r|gz" if path.endswith("gz") else "r|") as tar:
                        for member in tar:
                            if not member.isfile() or not member.name.endswith(ending):
                                continue
                            for line in tar.extractfile(member):
                                held.append(line.rstrip(b"\n").decode("utf-8", "replace"))
                                size += len(line)
                                if size > 4 << 20:
                                    yield _batch(pa, path, seq, held)
                                    seq, held, size = seq + len(held), [], 0
                    if held:
                        yield _batch(pa, path, seq, held)

    rows = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)))
    return rows.mapInArrow(run, "archive string, seq long, value string")


def _batch(pa, path: str, seq: int, lines_: list[str]):
    return pa.RecordBatch.from_arrays([pa.array([path] * len(lines_)), pa.array(range(seq, seq + len(lines_)), pa.int64()), pa.array(lines_, pa.string())], names=["archive", "seq", "value"])


def lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).where("value <> ''").select(F.col("value").alias("key"))


def pair_lines(spark: SparkSession, path: str) -> DataFrame:
    return lines(spark, path).select(F.substring_index("key", "\x01", 1).alias("artist"), F.expr("substring(key, locate('\x01', key) + 1)").alias("title"))


def sampled(catalog: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """``n`` watchable stations with a URL in the order of a seeded hash: the same ones each time."""
    return catalog.where("watchable and url <> ''").orderBy(F.md5(F.concat(F.lit(f"{seed}:"), "url").cast("binary")), "url").limit(n)


def wide(codes: DataFrame, deep: list[str]) -> DataFrame:
    """The countries that aren't read deep, in their order: ``codes`` has code and n."""
    return codes.where(~F.col("code").isin(*deep)) if deep else codes
