"""Sources, sinks and status documents: local servers, files, and odd shapes."""

import hashlib
import http.server
import io
import json
import socket
import tarfile
import threading

import pytest
import zstandard
from pyspark.sql import functions as F

from stationlens import storage
from stationlens.functions import text as T
from stationlens.functions import url as U
from stationlens.operators import mounts, siblings, simulate
from stationlens.sources import directory, readers, sinks, status

SHAPE = "doc string, host string, path string, body string"


def parsed(spark, path, *bodies):
    rows = spark.createDataFrame([(f"d{i}", f"h{i}", path, b) for i, b in enumerate(bodies)], SHAPE)
    return {(r.doc, r.pos): r.mount for r in mounts.parsed(rows, "doc", "path", "body").collect()}


def test_titles_at_any_depth_in_document_order(spark):
    deep = '{"a":' * 300 + '{"title":" Deep - One\\n"}' + "}" * 300
    odd = ['{"z":{"song":"B - 2"},"title":"A - 1","title ":"no"}', '[{"songtitle":"x"},["y"],{"title":["t"]},{"title":{"title":"in"}}]', '"title"', "7", "{broken", "[" * 100_000]
    found = parsed(spark, "/status-json.xsl", deep, *odd)
    assert {k: m.title for k, m in found.items()} == {("d0", 0): "Deep - One", ("d1", 0): "B - 2", ("d1", 1): "A - 1", ("d2", 0): "x", ("d2", 1): "in"}


def test_pages_with_line_breaks_in_labels_and_values(spark):
    page = "<h3>\nMount Point\n/A/b.mp3</h3><td>\n Title:</td>\n<td>X - Y\n</td><td>Title\n:</td><td>no</td><td>Bitrate:</td><td> 128 </td>"
    found = parsed(spark, "/status.xsl", page, "<td>\n E - W\t</td><td>short</td>", "x" * 10 + "<h3>Mount Point /n</h3>" * 3000)
    (one,) = [m for (d, _), m in found.items() if d == "d0"]
    assert (one.path, one.raw_path, one.bitrate, one.title) == ("/a/b.mp3", "/A/b.mp3", 128, "no")  # of rows with one label the last counts
    assert [m.title for (d, _), m in found.items() if d == "d1"] == ["E - W"] and len([1 for d, _ in found if d == "d2"]) == 3000


def test_names_without_any_white_space_or_marks(spark):
    rows = spark.createDataFrame([(" \x1c\n x y \r\n", "a\U000e0100b"), (None, None)], "a string, b string")
    found = rows.select(T.stripped(F.col("a")).alias("a"), T.fold(F.col("b")).alias("b"), T.key64(F.col("b")).alias("k"), T.spaced(F.col("a")).alias("s")).collect()
    assert (found[0].a, found[0].b, found[0].s) == ("x y", "ab", "x y") and found[1].a is None and found[1].k is None
    assert found[0].k == int.from_bytes(hashlib.blake2b("a\U000e0100b".encode(), digest_size=8).digest(), "big", signed=True)


def test_addresses(spark):
    cases = {"8.8.8.8": True, "10.0.0.1": False, "172.15.0.1": True, "172.16.0.1": False, "192.0.0.9": True, "192.0.0.8": False, "256.1.1.1": None, "01.1.1.1": None, "1.1.1": None, "example.com": None, "224.0.0.1": False, "0.0.0.0": False, "1.2.3.4.5": None}
    found = spark.createDataFrame([(k,) for k in cases], "a string").select("a", U.is_public_ipv4(F.col("a")).alias("p")).collect()
    assert {r.a: r.p for r in found} == cases


class Server(http.server.BaseHTTPRequestHandler):
    asked: list = []

    def do_GET(self):
        Server.asked.append(self.path)
        if self.path == "/status-json.xsl" and self.server.kind == "icy":
            self.wfile.write(b"ICY 200 OK\r\n\r\n")  # no HTTP status line
            return
        body = {("json", "/status-json.xsl"): json.dumps({"icestats": {"source": [{"mount": "/live", "title": "A Band - Song"}]}}), ("icy", "/7.html"): "<td>Old - Title</td>", ("icy", "/stats?json=1"): "{}"}.get((self.server.kind, self.path))
        self.send_response(200 if body else 404)
        self.end_headers()
        self.wfile.write((body or "").encode())

    def log_message(self, *_):
        pass


@pytest.fixture
def servers():
    made = []
    for kind in ("json", "icy"):
        server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Server)
        server.kind = kind
        threading.Thread(target=server.serve_forever, daemon=True).start()
        made.append(server)
    yield {s.kind: s.server_port for s in made}
    for s in made:
        s.shutdown()


def test_status_documents_of_servers(spark, servers, monkeypatch):
    monkeypatch.setattr(status.U, "status_base", lambda url: F.regexp_extract(url, "^(https?://[^/]*)", 1))  # local servers are refused otherwise
    rows = [("a", f"http://127.0.0.1:{servers['json']}/live"), ("b", f"http://127.0.0.1:{servers['json']}/other"), ("c", f"http://127.0.0.1:{servers['icy']}/;"), ("d", "http://127.0.0.1:1/x")]
    Server.asked.clear()
    found = {r.uuid: r for r in status.probed(spark.createDataFrame(rows, "uuid string, url string"), timeout=3.0).collect()}
    assert {k: (r.watchable, r.nowplaying_endpoint) for k, r in found.items()} == {"a": (True, "/status-json.xsl"), "b": (False, None), "c": (True, "/7.html"), "d": (False, None)}
    assert (found["a"].song.artist, found["a"].song.track, found["c"].raw) == ("A Band", "Song", "Old - Title")
    # one document serves both streams of a server, and nothing more is asked once it has mounts
    assert sorted(Server.asked) == ["/7.html", "/stats?json=1", "/status-json.xsl", "/status-json.xsl", "/status.xsl"]


def test_unsafe_streams_are_not_asked(spark):
    rows = spark.createDataFrame([("a", "http://127.0.0.1/x"), ("b", "ftp://x/y"), ("c", None)], "uuid string, url string")
    assert [r.watchable for r in status.probed(rows).collect()] == [False] * 3


def test_mirrors_beyond_an_address_without_a_name(monkeypatch):
    monkeypatch.setattr(socket, "getaddrinfo", lambda *a, **k: [(0, 0, 0, "", (x, 443)) for x in ("1.1.1.1", "2.2.2.2", "3.3.3.3")])

    def name_of(address):
        if address == "2.2.2.2":
            raise socket.herror("none")
        return (f"m{address[0]}.example.org", [], [])

    monkeypatch.setattr(socket, "gethostbyaddr", name_of)
    assert directory.mirrors("example.org", "all.example.org", ["f"]) == ["https://m1.example.org", "https://m3.example.org"]
    assert directory.mirrors("other.org", "all.example.org", ["f"]) == ["f"]


def test_a_mirror_that_speaks_no_http_is_passed_over(servers, monkeypatch):
    monkeypatch.setattr(Server, "do_GET", lambda self: self.wfile.write(b"ICY 200 OK\r\n\r\n") if self.server.kind == "icy" else (self.send_response(200), self.end_headers(), self.wfile.write(b"[1]")))
    reader = directory.DirectoryReader({"mirrors": f"http://127.0.0.1:{servers['icy']},http://127.0.0.1:{servers['json']}", "pause": "0", "timeout": "3"})
    assert reader.fetch("/json") == [1]
    reader = directory.DirectoryReader({"countries": "DE,CZ", "tags": "rock", "tasks": "2"})
    assert [p.wanted for p in reader.partitions()] == [[("bycountrycodeexact", "DE"), ("bytagexact", "rock")], [("bycountrycodeexact", "CZ")]]
    assert len(directory.DirectoryReader({"countries": "DE,CZ"}).partitions()) == 1


@pytest.mark.parametrize("ending", [".tar", ".tar.gz", ".tar.zst"])
def test_lines_of_an_archive(spark, tmp_path, ending):
    raw = io.BytesIO()
    with tarfile.open(fileobj=raw, mode="w:gz" if ending == ".tar.gz" else "w") as tar:
        for name, body in (("d/other.csv", b"no\n"), ("d/wanted.csv", "ä,1\n\nlast".encode() + b"\xff"), ("d/empty_wanted.csv", b"")):
            info = tarfile.TarInfo(name)
            info.size = len(body)
            tar.addfile(info, io.BytesIO(body))
    path = tmp_path / f"dump{ending}"
    path.write_bytes(zstandard.ZstdCompressor().compress(raw.getvalue()) if ending == ".tar.zst" else raw.getvalue())
    found = readers.archived(spark, [str(path)], "wanted.csv").collect()
    assert [(r.seq, r.value) for r in found] == [(0, "ä,1"), (1, ""), (2, "last�")]


def test_one_file_of_json(spark, tmp_path):
    rows = spark.createDataFrame([(2, 'b "q"', None), (1, "a", 1.5)], "n int, key string, x double").repartition(2)
    sinks.pretty_array(rows, [F.desc("n")], str(tmp_path / "array"))
    sinks.keyed_object(rows, "key", str(tmp_path / "object"))
    read = lambda name: json.loads("".join(p.read_text() for p in (tmp_path / name).glob("part-*")))
    assert read("array") == [{"n": 2, "key": 'b "q"'}, {"n": 1, "key": "a", "x": 1.5}]
    assert list(read("object").items()) == [("a", {"n": 1, "x": 1.5}), ('b "q"', {"n": 2})]
    sinks.pretty_array(rows.where("false"), ["n"], str(tmp_path / "none"))
    assert read("none") == []


def test_substitution_is_of_one_place():
    assert sinks.substituted('a = "1"\nb = "2"', "b", "x\\1") == 'a = "1"\nb = "x\\1"'
    for bad in ('c = "1"', 'b = "1" b = "2"'):
        with pytest.raises(ValueError):
            sinks.substituted(bad, "b", "x")


def test_cached_tables_are_made_once(spark, tmp_path):
    made = []

    def make():
        made.append(1)
        return spark.range(3)

    for _ in range(2):
        assert storage.cached(spark, str(tmp_path / "t"), make).count() == 3
    assert len(made) == 1


def test_overlaps_are_those_of_all_pairs(spark):
    import random

    rng = random.Random(8)
    base = [[f"/{k}{j}" for j in range(40)] for k in range(4)]
    sets = {f"h{i}": {"/stream", *(p for p in base[i % 4] if rng.random() > rng.choice([0.0, 0.02, 0.1]))} for i in range(40)}
    expected = set()
    for a, x in sets.items():
        for b, y in sets.items():
            if (len(x), b) > (len(y), a) and a != b and (len(x) > len(y) or a < b) and len(x & y) >= 0.9 * len(x | y):
                expected.add((a, b))
    rows = spark.createDataFrame([(h, p) for h, ps in sets.items() for p in ps], "host string, path string")
    assert {tuple(r) for r in siblings.overlaps(rows).collect()} == expected and expected


def test_draws_are_the_same_each_time(spark):
    rows = spark.range(1000).select(simulate.draw(3, "id").alias("u"))
    u = [r.u for r in rows.collect()]
    assert sorted(u) == [r.u for r in spark.range(1000).repartition(3).select(simulate.draw(3, "id").alias("u")).orderBy("u").collect()]
    assert 0 <= min(u) and max(u) < 1 and abs(sum(u) / 1000 - 0.5) < 0.05
