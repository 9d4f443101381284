"""Files in the shapes that consumers read."""

from __future__ import annotations

import base64
import re
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def json_lines(df: DataFrame, path: str, single: bool = False) -> None:
    """Null fields are left out, so a field that is null where it says nothing disappears."""
    (df.coalesce(1) if single else df).write.mode("overwrite").json(path)


def _in_one_file(entries: DataFrame, opening: str, closing: str, path: str) -> None:
    """Entries (value, in order) as one text file, with commas between; the one task that writes it streams."""

    def run(batches):
        import pyarrow as pa

        last = None  # an entry is given out with its comma when another follows
        for batch in batches:
            values = batch.column(0).to_pylist()
            if values:
                out = [v + "," for v in ([] if last is None else [last]) + values[:-1]]
                last = values[-1]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last])], names=["value"])

    body = entries.coalesce(1).mapInArrow(run, "value string")
    spark = entries.sparkSession
    one = lambda text: spark.createDataFrame([(text,)], "value string").coalesce(1)
    one(opening).union(body).union(one(closing)).coalesce(1).write.mode("overwrite").text(path)


def pretty_array(df: DataFrame, order: list, path: str) -> None:
    """One JSON array, an indented object for each row, in the given order; null fields are left out."""
    value = F.to_json(F.struct(*df.columns), {"pretty": "true"})
    _in_one_file(df.orderBy(*order).select(F.regexp_replace(value, "(?m)^", "  ").alias("value")), "[", "]", path)


def keyed_object(df: DataFrame, key: str, path: str) -> None:
    """One JSON object with its keys in order: a state that a version control shows line by line."""
    rest = [c for c in df.columns if c != key]
    entry = F.concat(F.regexp_extract(F.to_json(F.array(key)), r"(?s)^\[(.*)\]$", 1), F.lit(": "), F.to_json(F.struct(*rest)))
    _in_one_file(df.orderBy(key).select(entry.alias("value")), "{", "}", path)


def substituted(source: str, name: str, blob: str) -> str:
    """A source text with the string of the one assignment ``name = "..."`` replaced."""
    out, n = re.subn(rf'({re.escape(name)} = ")[^"]+(")', lambda m: m[1] + blob + m[2], source)
    if n != 1:
        raise ValueError(f"{name} is assigned {n} times")
    return out


def versioned(df: DataFrame, folder: str, version: str) -> str:
    """A new version beside the old ones; a reader that has the old one keeps it."""
    path = f"{folder}/version={version}"
    df.write.mode("errorifexists").parquet(path)
    return path


def sorted_lines(df: DataFrame, column: str, path: str) -> None:
    """Distinct lines in byte order, one file after the other."""
    df.select(F.col(column).cast("string").alias("value")).where("value <> ''").distinct().orderBy("value").write.mode("overwrite").text(path)


def packed(text: str) -> str:
    """Raw deflate as base64, checked by a round trip; the text is one export's JSON, made by ``to_json``."""
    deflate = zlib.compressobj(9, zlib.DEFLATED, -15)
    blob = base64.b64encode(deflate.compress(text.encode()) + deflate.flush()).decode()
    if zlib.decompress(base64.b64decode(blob), -15).decode() != text:
        raise ValueError("the packed text doesn't unpack to itself")
    return blob
