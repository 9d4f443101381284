"""Operators against sequential models and known cases."""

import random

import pytest
from pyspark.sql import functions as F

from stationlens.functions import text as T
from stationlens.functions import titles as S
from stationlens.functions import url as U
from stationlens.operators import catalog, dedup, geo, lexicon, mounts, orientation, plays, siblings, simulcast
from stationlens.operators.components import components
from stationlens.plans import pipelines
from stationlens.sources import readers, sinks


def column(spark, value, expression):
    return spark.createDataFrame([(value,)], "x string").select(expression(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "url, reason",
    [("http://example.com/a", None), ("", "length"), (None, "length"), ("http://e.com/" + "x" * 2048, "length"), ("gopher://e.com", "scheme"), ("http:///x", "host"), ("http://e.com:6379/", "port"), ("http://e.com:0/", None), ("http://e.com:70000/", "port"), ("http://e.com:abc/", "port"),
     ("http://192.168.1.1/", "address"), ("http://172.31.0.1/", "address"), ("http://8.8.8.8/", None), ("http://[::1]/", "address"), ("http://[2606:4700::1]:8000/", None), ("http://224.0.0.1/", "address"), ("http://user@10.0.0.1/", "address"), ("HTTPS://A_b.example.com", None)],
)
def test_refusal(spark, url, reason):
    assert column(spark, url, lambda c: U.refusal(c, six=True)) == reason


@pytest.mark.parametrize("url, key", [("http://WWW.Example.com:80/a//?s=1#f", "//example.com/a"), ("https://u:p@example.com:8443/A", "//example.com:8443/A"), ("http://example.com:443", "//example.com"), ("http://www.www.e.com/", "//www.e.com")])
def test_dedup_key(spark, url, key):
    assert column(spark, url, U.dedup_key) == key


@pytest.mark.parametrize(
    "raw, song",
    [("AC-DC - Back", ("AC-DC", "Back")), ("Jay-Z", None), ("Karel Šiktanc – \"Píseň\"", ("Karel Šiktanc", "Píseň")), ("advert - x", None), ("A - 12", None), ("NOVÃK - Song", None), ("São - Ålborg", ("São", "Ålborg")), ("0 N - 2000s", None), ("РЕКЛАМА - x", ("РЕКЛАМА", "x")), ("x", None), (None, None)],
)
def test_song_of(spark, raw, song):
    found = column(spark, raw, T.song_of)
    assert (found and tuple(found)) == song


@pytest.mark.parametrize("name, key", [("The Beatles", "beatles"), ("Beyoncé feat. X", "beyonce"), ("A & B", "a"), ("Sigur Rós (live)", "sigur ros"), ("Ø", ""), ("ﬁne", "fine"), ("Кино", ""), ("", "")])
def test_artist_key(spark, name, key):
    assert column(spark, name, T.artist_key) == key


def test_fold_and_tag_key(spark):
    assert column(spark, "The  Café [x] ½", T.fold) == "cafe"
    assert column(spark, " Hip-Hop_/Rap Só ", T.tag_key) == "hip hop rap so"


@pytest.mark.parametrize("left, right, cue", [("She", "Karin Ann (Remix Benny Benassi)", (0, False)), ("Calvin Harris", "Feels feat. Pharrell", (1, False)), ("X feat. Y", "Z", (0, True)), ("A (Live) B", "C", (1, True)), ("A", "B (Edit) C", (0, True)), ("A", "B", (None, False)), ("A (mix)", "B (mix)", (None, False))])
def test_structural_cues(spark, left, right, cue):
    found = spark.createDataFrame([(left, right)], "l string, r string").select(S.structural(F.col("l"), F.col("r")).alias("c")).first()["c"]
    assert tuple(found) == cue


def test_best_per_key_is_the_loop(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice("abcdefgh"), rng.randrange(3), rng.randrange(3)) for i in range(60)]
    best, first = {}, {}
    for r in rows:
        first.setdefault(r[1], r[0])
        if r[1] not in best or r[2:] > best[r[1]][2:]:
            best[r[1]] = r
    found = dedup.best_per_key(spark.createDataFrame(rows, "seq long, k string, q long, p long"), "k", ["q", "p"], "seq").collect()
    assert {(r.seq, r.first_seq) for r in found} == {(b[0], first[k]) for k, b in best.items()}


def test_components_are_union_find(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(100 + i, 101 + i) for i in range(30)]
    up = list(range(200))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {x: find(x) for e in edges if e[0] != e[1] for x in e}


def test_alias_hosts_are_the_greedy_loop(spark):
    rng = random.Random(3)
    for _ in range(4):
        base = [set(rng.sample(range(40), 20)) for _ in range(3)]
        hosts = {f"h{i}": set(rng.choice(base)) ^ set(rng.sample(range(40), rng.randrange(3))) for i in range(14)}
        kept, dropped = [], set()
        for h in sorted(hosts, key=lambda h: (-len(hosts[h]), h)):
            if any(len(hosts[h] & hosts[k]) / len(hosts[h] | hosts[k]) >= 0.9 for k in kept):
                dropped.add(h)
            else:
                kept.append(h)
        rows = spark.createDataFrame([(h, p) for h, ps in hosts.items() for p in ps], "host string, path long")
        assert {r.host for r in siblings.alias_hosts(rows).collect()} == dropped


def test_co_occurrence_is_round_by_round(spark):
    rng = random.Random(4)
    rows = [(r, f"s{s}", f"x{rng.randrange(4)}") for r in range(12) for s in range(10) if rng.random() < 0.8]
    co = {}
    for r in range(12):
        now = {s: x for q, s, x in rows if q == r}
        agreed = {(a, b) for a in now for b in now if a < b and now[a] == now[b]}
        for p in agreed:
            c = co.setdefault(p, [0, 0])
            c[0] += 1
            c[1] += 1
        for p in set(co) - agreed:
            if p[0] in now and p[1] in now:
                co[p][1] += 1
    found = simulcast.co_occurrence(spark.createDataFrame(rows, "round long, uuid string, song string")).collect()
    assert {(r.a, r.b): [r.same, r.both] for r in found} == co


def brute_agreements(rows):
    """(same, both, first, last) of each pair, round by round; a row without a song plays something unknown."""
    songs, co = {}, {}
    for r, s, x in rows:
        songs.setdefault(r, {}).setdefault(s, set()).update({x} - {None})
    for r in sorted(songs):
        now = songs[r]
        for a in now:
            for b in now:
                if a < b and (now[a] & now[b] or (a, b) in co):
                    same, both, first, _ = c = co.get((a, b), (0, 0, r, r))
                    co[a, b] = (same + 1, both + 1, first, r) if now[a] & now[b] else (same, both + 1, first, c[3])
    return co


def agreement_rows():
    rng = random.Random(8)
    return [(f"r{r:03d}", f"s{s}", None if rng.random() < 0.05 else f"x{rng.randrange(5)}") for r in range(150) for s in range(40) if rng.random() < 0.5 for _ in range(1 + (rng.random() < 0.2))]


@pytest.mark.parametrize("limits", [{}, {"block_rows": 300}, {"task_agreements": 2000, "bitmap_bytes": 0}, {"block_rows": 60, "bitmap_bytes": 0}])
def test_agreements_between_blocks_are_the_loop(spark, limits):
    """Pairs within and between blocks, blocks without stations, null songs, two songs in a round, more than 64 rounds."""
    from stationlens.operators.agreements import agreements

    rows = agreement_rows()
    seen = spark.createDataFrame(rows, "round string, uuid string, song string").distinct()
    assert {(r.a, r.b): (r.same, r.both, r.first, r.last) for r in agreements(seen, **limits).collect()} == brute_agreements(rows)


def test_many_agreements_are_held_in_pieces(monkeypatch):
    import pyarrow as pa

    from stationlens.operators import agreements

    monkeypatch.setattr(agreements, "HELD", 500)
    monkeypatch.setattr(agreements, "PIECE", 7)
    rows = sorted(set(agreement_rows()), key=repr)
    table = pa.table({c: pa.array([row[i] for row in rows]).dictionary_encode() for i, c in enumerate(("round", "uuid", "song"))})
    for limit in (0, 1 << 20):
        found = pa.Table.from_batches(agreements._pairs([table], 1, 0.0, limit)).to_pylist()
        assert len(found) == len({(r["a"], r["b"]) for r in found})
        assert {(r["a"], r["b"]): (r["same"], r["both"], r["first"], r["last"]) for r in found} == brute_agreements(rows)


def test_pairs_of_stations_are_not_shuffled(spark):
    """Pairs grow with the square of a song's stations: they were joined and counted through shuffles, which filled the disk."""
    rows = spark.createDataFrame([("r", f"s{i}", "hit") for i in range(200)], "round string, uuid string, song string")
    found = simulcast.co_occurrence(rows)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
    assert found.count() == 200 * 199 // 2


@pytest.mark.parametrize("min_same, min_agreement", [(2, 0.5), (1, 0.2), (3, 0.0)])
def test_minima_keep_the_confirmed_pairs(spark, min_same, min_agreement):
    rows = spark.createDataFrame(agreement_rows(), "round string, uuid string, song string").where("round < 'r012'")
    found = simulcast.co_occurrence(rows, min_same=min_same, min_agreement=min_agreement).collect()
    assert found and sorted(found) == sorted(simulcast.confirmed(simulcast.co_occurrence(rows), min_same, min_agreement).collect())


def test_no_observations_have_no_pairs(spark):
    assert simulcast.co_occurrence(spark.createDataFrame([], "round string, uuid string, song string")).count() == 0


def mounts_case(spark):
    rng = random.Random(9)
    paths = ["/a", "/b", "/x/a", "/x/b", "/y/a", "/c/", "/", ""]
    listed = [(f"h{h}", pos, rng.choice(paths)) for h in range(60) for pos in range(rng.choice([1, 1, 2, 4, 7]))]
    streams = [(k, f"h{rng.randrange(62)}", "http://x" + rng.choice(["/a", "/b", "/z/a", "/y/a", "/c", "/none", "/", ""])) for k in range(600)]
    mount = "struct<path:string>"
    return streams, listed, spark.createDataFrame(streams, "stream long, host string, url string"), spark.createDataFrame([(h, "/p", pos, (path,)) for h, pos, path in listed], f"host string, path string, pos int, mount {mount}")


def test_selected_mounts_are_the_loop(spark):
    """The path itself, the first of equals; else a base name of one mount; else the only mount if it has no name."""
    streams, listed, wanted, mounts_ = mounts_case(spark)
    paths = {r.stream: r.p for r in wanted.select("stream", U.mount_path(F.col("url")).alias("p")).collect()}
    expected = {}
    for k, host, _ in streams:
        own = sorted((pos, path) for h, pos, path in listed if h == host)
        base = paths[k].rsplit("/", 1)[-1]
        same = [pos for pos, path in own if path != "" and path == paths[k]]
        alike = [pos for pos, path in own if base != "" and path.rsplit("/", 1)[-1] == base]
        if same or len(alike) == 1 or len(own) == 1 and own[0][1] in ("", "/"):
            expected[k] = own[[p for p, _ in own].index(same[0] if same else alike[0] if len(alike) == 1 else own[0][0])][1]
    found = mounts.selected(wanted, mounts_, "stream", "host", "url")
    assert {r.stream: r.mount.path for r in found.collect()} == expected and 0 < len(expected) < len(streams)


def test_streams_do_not_meet_all_mounts_of_their_host(spark):
    """They did, by a join on the host alone, which took a host's streams times its mounts."""
    streams = spark.range(2000).select(F.col("id").alias("stream"), F.lit("h").alias("host"), F.concat(F.lit("http://x/m"), "id").alias("url"))
    listed = spark.range(2000).select(F.lit("h").alias("host"), F.lit("/p").alias("path"), F.col("id").cast("int").alias("pos"), F.struct(F.concat(F.lit("/m"), "id").alias("path")).alias("mount"))
    found = mounts.selected(streams, listed, "stream", "host", "url")
    assert found.count() == 2000
    joins = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join " in line]
    assert joins and all("key" in line for line in joins)


def tally(rows, evidence):
    """The sequential model: rows of (station, seq, text), evidence of text -> (orientation, strength)."""
    counts, voted, out = {}, set(), {}
    for station, seq, text in rows:
        o, strength = evidence[text]
        t = counts.setdefault(station, [0, 0, 0, 0])
        if station and o is not None and (station, text) not in voted:
            voted.add((station, text))
            t[(0 if strength >= 2 else 2) + o] += 1
        out[station, seq] = tuple(t)
    return out


def tally_case():
    rng = random.Random(5)
    evidence = {f"text {i}": rng.choice([(0, 2), (1, 2), (0, 1), (1, 1), (None, 0)]) for i in range(60)}
    rows = [(rng.choice(["", "a", "b", "c"]), seq, rng.choice(list(evidence))) for seq in range(400)]
    return rows, evidence


def test_tally_is_the_loop(spark):
    rows, evidence = tally_case()
    df = spark.createDataFrame([(s, q, t, evidence[t]) for s, q, t in rows], "station string, seq long, text string, e struct<orientation:int,strength:int>")
    found = {(r.station, r.seq): (r.strong_first, r.strong_second, r.weak_first, r.weak_second) for r in orientation.tallied(df).collect()}
    assert found == tally(rows, evidence)


def test_streamed_tally_is_the_loop(spark, tmp_path):
    from stationlens.streaming import harvest

    rows, evidence = tally_case()
    shape = "station string, seq long, text string, orientation int, strength int"
    for k in range(2):
        spark.createDataFrame([(s, q, t, *evidence[t]) for s, q, t in rows[k * 200 : k * 200 + 200]], shape).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(shape).parquet(str(tmp_path / "in"))
        harvest.stream_tally(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    found = {(r.station, r.seq): (r.strong_first, r.strong_second, r.weak_first, r.weak_second) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert found == tally(rows, evidence)


def test_new_titles_come_once(spark, tmp_path):
    from stationlens.streaming import harvest

    for _ in range(2):
        spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "url string, title string").write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("url string, title string").parquet(str(tmp_path / "in"))
        harvest.new_titles(stream, ["url", "title"], str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_geo_cases(spark):
    boxes = spark.createDataFrame([("DE", 47.0, 55.0, 6.0, 15.0), ("FR", 42.0, 51.0, -5.0, 9.0), ("MQ", 14.3, 14.9, -61.3, -60.8), ("FJ", -21.0, -12.0, 176.0, -178.0)], "code string, min_lat double, max_lat double, min_lon double, max_lon double")
    points = [(1, "DE", 18.81, -38.92), (2, "FR", 14.6, -61.0), (3, "XX", 1.0, 1.0), (4, "XX", 0.0, 0.0), (5, "FJ", -17.0, -179.0), (6, "FJ", -17.0, 0.0), (7, " de ", 50.0, 10.0), (8, "DE", None, 1.0), (9, "DE", float("nan"), 1.0)]
    found = geo.verdicts(spark.createDataFrame(points, "id long, cc string, lat double, lon double"), "id", "cc", "lat", "lon", boxes, spark.createDataFrame([("FR", "MQ")], "code string, dep string"))
    assert {r.id: r.inside for r in found.collect()} == {1: False, 2: True, 3: None, 4: False, 5: True, 6: False, 7: True, 8: False, 9: False}


def test_groups_take_the_best_and_drop_who_left(spark):
    co = spark.createDataFrame([("a", "b", 3, 4), ("b", "c", 5, 5), ("c", "gone", 9, 9), ("x", "y", 2, 2)], "a string, b string, same long, both long")
    stations = spark.createDataFrame([("a", 128, 1), ("b", 192, 5), ("c", 192, 9), ("x", 1, 1), ("y", 1, 1)], "uuid string, bitrate long, popularity long")
    (g,) = simulcast.groups(co, stations).collect()
    assert (g.representative, g.members, g.weakest_same, g.weakest_agreement) == ("c", ["a", "b", "c"], 3, 0.75)


def test_admissible_names(spark):
    rows = spark.createDataFrame([("celebration", 9, 120, 1342), ("beatles", 9, 16899, 86), ("rare", 1, 5, 0)], "key string, pop long, as_artist long, as_title long")
    assert [r.key for r in lexicon.admissible(rows).collect()] == ["beatles"]


def test_discography(spark):
    rows = spark.createDataFrame([("The X", [([("Song One",), (None,)],)]), ("", []), ("Y", None)], "artist string, albums array<struct<tracks:array<struct<title:string>>>>")
    names, pairs = lexicon.from_discography(rows)
    assert {r.key for r in names.collect()} == {"x", "y"}
    assert [tuple(r) for r in pairs.collect()] == [("x", "song one")]


def test_catalog_pipeline(spark):
    shape = "seq long, uuid string, name string, url string, url_resolved string, homepage string, tags array<string>, country string, countrycode string, language string, codec string, favicon string, bitrate long, votes long, clickcount long, lastcheckok boolean, geo_lat double, geo_long double"
    row = lambda seq, url, codec="MP3", bitrate=128, ok=True, tags=("rock",), votes=1, lat=50.0, lon=10.0: (seq, f"u{seq}", "Name", url, "", "", list(tags), "", "DE", "", codec, "", bitrate, votes, 0, ok, lat, lon)
    raw = [row(0, "http://a.com/x"), row(1, "http://www.a.com:80/x/", bitrate=192), row(2, "http://10.0.0.1/"), row(3, "http://b.com", ok=False), row(4, "http://c.com", codec="OPUS"), row(5, "http://d.com", bitrate=64), row(6, "http://e.com", bitrate=64, tags=("news",)), row(7, "http://f.com", codec="aac+", bitrate=0, votes=9, lat=-30.0)]
    synonyms = spark.createDataFrame([("rock", "rock", 0), ("news", "news", 1)], "genre string, synonym string, priority long")
    boxes = spark.createDataFrame([("DE", 47.0, 55.0, 6.0, 15.0)], "code string, min_lat double, max_lat double, min_lon double, max_lon double")
    found = pipelines.build_catalog([spark.createDataFrame(raw[:4], shape), spark.createDataFrame(raw[4:], shape)], synonyms, spark.createDataFrame([("fm",)], "tag string"), boxes, spark.createDataFrame([], "code string, dep string"))
    rows = found.stations.collect()
    assert [r.uuid for r in rows] == ["u7", "u1", "u6"] and [r.geo is None for r in rows] == [True, False, False]
    assert {r.reason: r.n for r in found.funnel.collect()} == {"kept": 4, "unsafe": 1, "dead": 1, "codec": 1, "bitrate": 1, "duplicate": 1}
    assert {r.tag: (r.n, r.genre) for r in found.tags.collect()} == {"rock": (7, "rock"), "news": (1, "news")}
    assert {r.group for r in catalog.triage(found.stations).collect()} == {"rock", "news"}


def test_probe_and_discover(spark):
    doc = '{"icestats":{"source":[{"mount":"/one.mp3","title":"Band - Song","bitrate":128,"server_type":"audio/mpeg"},{"mount":"/two.mp3","bitrate":128,"genre":"Rock"},{"mount":"/two_app.mp3","bitrate":128,"listeners":4},{"mount":"/low.mp3","bitrate":32},{"mount":"/admin"}]}}'
    docs = spark.createDataFrame([("d", "h.com", "/status-json.xsl", doc)], "doc string, host string, path string, body string")
    stations = spark.createDataFrame([(0, "u0", "http://h.com/one.mp3", "DE", "german"), (1, "u1", "http://other.com/x", "", "")], "seq long, uuid string, url string, country string, language string")
    probed = pipelines.probe(stations, docs)
    assert {r.uuid: (r.watchable, r.song and r.song.artist) for r in probed.collect()} == {"u0": (True, "Band"), "u1": (False, None)}
    synonyms = spark.createDataFrame([("rock", "rock", 0)], "genre string, synonym string, priority long")
    new = pipelines.discover(probed.select(*stations.columns, "watchable"), docs, synonyms, spark.createDataFrame([], "tag string")).collect()
    assert [(r.uuid, r.country, r.discovered_from) for r in new] == [("sibling://h.com/two_app.mp3".replace("sibling:", "sibling:"), "DE", "u0")]


def test_harvest_and_replay(spark):
    seen = spark.createDataFrame([("u0", "band", "Band", "r1"), ("u1", "band", "Band", "r1"), ("u0", "band", "Band", "r2")], "uuid string, artist_key string, artist string, round string")
    stations = spark.createDataFrame([("u0", "x", True, 128, 1), ("u1", "y", False, 64, 1)], "uuid string, url string, watchable boolean, bitrate long, popularity long")
    counts, index = pipelines.harvest(None, seen, stations)
    assert {(r.uuid, r.n) for r in counts.collect()} == {("u0", 2), ("u1", 1)}
    counts, index = pipelines.harvest(counts, seen, stations, spark.createDataFrame([("u0", "u1", 9, 9)], "a string, b string, same long, both long"))
    assert [(r.uuid, r.n, r.variants) for r in index.collect()] == [("u0", 6, 2)]
    names = spark.createDataFrame([("band",)], "key string")
    titles = spark.createDataFrame([("x", "Band - Song &amp; Dance"), ("x", "Band - Song &amp; Dance"), ("z", "Band - Other"), ("x", "Nobody - Knows")], "url string, title string")
    found = pipelines.replay(titles, names, spark.createDataFrame([], "artist string, title string"), stations, "now").collect()
    assert [(r.uuid, r.artist_key, r.track) for r in found] == [("u0", "band", "Song & Dance")]


def test_files_round_trip(spark, tmp_path):
    (tmp_path / "titles_1.json").write_text('[{"url":"a","title":"x"},{"url":"b","title":"y"}]')
    (tmp_path / "titles_2.json").write_text('[{"url":"c","title":"z"}]')
    (tmp_path / "plays.json").write_text('{"k":{"n":2}}')
    rows = readers.json_array(spark, str(tmp_path / "titles_*.json"), "url string, title string")
    assert sorted(r.url for r in rows.collect()) == ["a", "b", "c"]
    assert [(r.key, r.value.n) for r in readers.keyed_json(spark, str(tmp_path / "plays.json"), "struct<n:bigint>").collect()] == [("k", 2)]
    sinks.sorted_lines(spark.createDataFrame([("b",), ("a\x01x",), ("b",), ("",)], "key string"), "key", str(tmp_path / "lines"))
    assert sorted(r.key for r in readers.lines(spark, str(tmp_path / "lines")).collect()) == ["a\x01x", "b"]
    assert [tuple(r) for r in readers.pair_lines(spark, str(tmp_path / "lines")).where("artist <> title").collect()] == [("a", "x")]
    assert len(sinks.packed('{"a": "é"}')) > 4
    assert sinks.versioned(spark.range(3), str(tmp_path / "state"), "1").endswith("version=1")
    sinks.json_lines(spark.range(2), str(tmp_path / "json"), single=True)
    dump = "a,b,c,artist,d,e,recording_mbid,title\n1,2,3,\"A, B\",5,6,r1,T\n"
    (tmp_path / "dump.csv").write_text(dump)
    assert [tuple(r) for r in readers.recordings(spark, str(tmp_path / "dump.csv")).collect()] == [("A, B", "r1", "T")]


def test_directory_source(spark):
    import http.server
    import json
    import threading

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            code = self.path.split("?")[0].rsplit("/", 1)[1]
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps([{"stationuuid": f"{code}-{i}", "bitrate": 128, "lastcheckok": 1, "tags": "a,B"} for i in range(2)]).encode())

        def log_message(self, *a):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    from stationlens.sources.directory import Directory

    spark.dataSource.register(Directory)
    mirrors = f"http://127.0.0.1:1,http://127.0.0.1:{server.server_port}"
    raw = spark.read.format("stationlens_directory").options(mirrors=mirrors, countries="DE,CZ", pause="0", timeout="3").load()
    rows = readers.shaped(raw.withColumn("seq", F.monotonically_increasing_id())).collect()
    assert sorted(r.uuid for r in rows) == ["CZ-0", "CZ-1", "DE-0", "DE-1"] and rows[0].tags == ["a", "b"] and rows[0].lastcheckok
    server.shutdown()


def test_dictionary_and_names(spark):
    index = spark.createDataFrame([("b", 1, "u2"), ("a", 2, "u1"), ("a", 1, "u2"), ("a", 3, "gone")], "artist_key string, rank int, uuid string")
    stations, rows = plays.dictionary_encoded(index, spark.createDataFrame([("u1",), ("u2",)], "uuid string"), ["artist_key", "rank"])
    assert {r.uuid: r.number for r in stations.collect()} == {"u2": 0, "u1": 1} and rows.count() == 3


def test_resolved_hosts(spark):
    from stationlens.operators import safety

    hosts = spark.createDataFrame([("localhost",), ("no.such.host.invalid",)], "host string")
    found = safety.resolved(hosts)
    assert {r.host for r in found.collect()} == {"localhost"}
    urls = spark.createDataFrame([("http://localhost/a",), ("http://no.such.host.invalid/",), ("ftp://x/",)], "url string")
    assert {r.url: r.unsafe for r in safety.verdicts(urls, found).collect()} == {"http://localhost/a": "address", "http://no.such.host.invalid/": "unresolved", "ftp://x/": "scheme"}


def test_hit_rate_grows(spark):
    from stationlens.operators import simulate

    small, large = (simulate.hit_rate(spark, n, searches=2000).first()[0] for n in (30, 400))
    assert 0 < small < large < 1


def test_report(spark):
    rows = spark.createDataFrame([("kept", 2), ("dead", 1), ("duplicate", 1)], "reason string, n long")
    stats = spark.createDataFrame([(1, 1, 0)], "kept long, with_genre long, with_geo long")
    text = catalog.report(rows, stats, spark.createDataFrame([("rock", 1)], "genre string, n long"))
    assert text.startswith("input: 3\n  - dead: 1") and text.endswith("genres: rock=1")


def test_the_package_is_shipped_once(spark):
    from stationlens.storage import ship

    ship(spark)
    files = list(spark.sparkContext._python_includes)
    ship(spark)
    assert list(spark.sparkContext._python_includes) == files and "stationlens.zip" in files
