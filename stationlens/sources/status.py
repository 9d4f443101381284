"""Status documents over HTTP: the paths in turn, until a server's document has mounts."""

from __future__ import annotations

import http.client
import urllib.request
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import url as U
from ..operators import mounts
from ..storage import materialize

#: Bytes of a document that are read, seconds that a server may take, servers that a task asks at least.
BODY_BYTES, TIMEOUT, SERVERS = 400_000, 6.0, 32


def _asked(batches: Iterator[pa.RecordBatch], path: str, timeout: float, agent: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for base in batch.column(0).to_pylist():
            try:
                with urllib.request.urlopen(urllib.request.Request(base + path, headers={"User-Agent": agent}), timeout=timeout) as answer:
                    rows.append((base, answer.read(BODY_BYTES).decode("utf-8", "ignore")))
            except (OSError, ValueError, http.client.HTTPException):
                continue  # this path has nothing here; the next one is asked
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=["host", "body"])


def answers(streams: DataFrame, url: str = "url", timeout: float = TIMEOUT, agent: str = "stationlens", tasks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, mounts) of the servers of some streams: host, doc, path, body, and doc, pos, mount.

    A server is asked once for all its streams, on one path after the other, and no more
    when a document has mounts. Unsafe URLs are not asked.
    """
    bases = streams.select(U.status_base(F.col(url)).alias("host")).where("host is not null").distinct()
    open_ = materialize(bases, "servers")
    tasks = tasks or max(1, min(open_.count() // SERVERS, 4 * streams.sparkSession.sparkContext.defaultParallelism))
    documents = found = None
    for path in mounts.STATUS_PATHS:
        asked = open_.repartition(tasks, "host").mapInArrow(lambda b, p=path: _asked(b, p, timeout, agent), "host string, body string")
        docs = materialize(asked.select("host", F.concat("host", F.lit(path)).alias("doc"), F.lit(path).alias("path"), "body"), "documents")
        new = materialize(mounts.parsed(docs, "doc", "path", "body"), "mounts")
        answered = docs.join(new.select("doc").distinct(), "doc", "left_semi")
        documents = answered if documents is None else documents.unionByName(answered)
        found = new if found is None else found.unionByName(new)
        open_ = materialize(open_.join(answered.select("host"), "host", "left_anti"), "servers")
    return documents, found


def probed(streams: DataFrame, stream: str = "uuid", url: str = "url", **options) -> DataFrame:
    """``streams`` with watchable, nowplaying_endpoint and what they play now."""
    documents, found = answers(streams, url, **options)
    hosted = streams.withColumn("host", U.status_base(F.col(url)))
    chosen = mounts.selected(hosted, mounts.first_answer(documents, found, "host", "doc", "path"), stream, "host", url)
    return mounts.watchable(streams, chosen, stream)
