"""The station directory as a Spark data source: countries and tags, asked by one task unless more are wanted."""

from __future__ import annotations

import gzip
import http.client
import json
import time
import urllib.parse
import urllib.request
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .readers import RECORD


class Pass(InputPartition):
    """What one task asks for, with a pause before each call."""

    def __init__(self, wanted: list[tuple[str, str]]):
        self.wanted = wanted


class DirectoryReader(DataSourceReader):
    """Asks the mirrors in turn, with a pause between calls; fails if none answers."""

    def __init__(self, options: dict[str, str]):
        self.mirrors = [m for m in options.get("mirrors", "").split(",") if m]
        self.countries = [c for c in options.get("countries", "").split(",") if c]
        self.tags = [t for t in options.get("tags", "").split(",") if t]
        self.limit = int(options.get("limit", "1000"))
        self.pause = float(options.get("pause", "0.35"))
        self.timeout = float(options.get("timeout", "20"))
        #: Tasks that ask at a time; with one, the pause holds for all calls.
        self.tasks = int(options.get("tasks", "1"))

    def partitions(self) -> list[InputPartition]:
        wanted = [("bycountrycodeexact", c) for c in self.countries] + [("bytagexact", t) for t in self.tags]
        return [Pass(wanted[k :: self.tasks]) for k in range(min(self.tasks, len(wanted)))]

    def fetch(self, path: str, **query: str) -> list[dict]:
        failed: Exception | None = None
        for mirror in self.mirrors:
            request = urllib.request.Request(f"{mirror}{path}?{urllib.parse.urlencode(query)}", headers={"Accept-Encoding": "gzip"})
            time.sleep(self.pause)
            try:
                with urllib.request.urlopen(request, timeout=self.timeout) as answer:
                    body = answer.read()
                    if answer.headers.get("Content-Encoding") == "gzip":
                        body = gzip.decompress(body)
                return json.loads(body)
            except (OSError, ValueError, http.client.HTTPException) as e:
                failed = e
        raise ConnectionError(f"no mirror answers {path}") from failed

    def read(self, partition: Pass) -> Iterator[tuple]:
        names = [c.split()[0] for c in RECORD.split(", ")]
        for kind, value in partition.wanted:
            path = f"/json/stations/{kind}/{urllib.parse.quote(value)}"
            for record in self.fetch(path, order="clickcount", reverse="true", hidebroken="true", limit=str(self.limit)):
                yield tuple(None if record.get(n) is None else str(record[n]) for n in names)


class Directory(DataSource):
    """``spark.dataSource.register(Directory)``, then ``spark.read.format("stationlens_directory")``."""

    @classmethod
    def name(cls) -> str:
        return "stationlens_directory"

    def schema(self) -> str:
        return RECORD

    def reader(self, schema) -> DirectoryReader:
        return DirectoryReader(self.options)


def report_clicks(stations, mirror: str, uuid: str = "uuid", timeout: float = 5.0) -> None:
    """Tell the directory which stations were played, as well as that goes: failures are left out."""

    def tell(rows) -> None:
        for row in rows:
            try:
                urllib.request.urlopen(f"{mirror}/json/url/{urllib.parse.quote(row[uuid])}", timeout=timeout).close()
            except (OSError, http.client.HTTPException):
                continue

    stations.select(uuid).foreachPartition(tell)


def mirrors(suffix: str, name: str, fallback: list[str]) -> list[str]:
    """Mirrors of a directory by its DNS name: reverse names that end in ``suffix``, or the fallback."""
    import socket

    found = set()
    try:
        addresses = {info[4][0] for info in socket.getaddrinfo(name, 443, proto=socket.IPPROTO_TCP)}
    except OSError:
        return fallback
    for address in addresses:
        try:
            host = socket.gethostbyaddr(address)[0]
        except OSError:
            continue  # the other addresses are looked at all the same
        if host.endswith(suffix):
            found.add(f"https://{host}")
    return sorted(found) or fallback
