"""Line dedup, substring dedup and suffix dedup against brute force."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stationlens.llm import kernels, lines, recompression, substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def spans(found):
    return [(s.start, s.end) for s in found.spans]


def words_left(rows, width):
    seen = Counter()
    split = [WORD.findall(t or "") for _, t in rows]
    for w in split:
        seen.update(tuple(w[i : i + width]) for i in range(len(w) - width + 1))
    out = []
    for (key, _), w in zip(rows, split):
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        out.append((key, " ".join(x for x, g in zip(w, gone) if not g), len(w), sum(gone)))
    return sorted(out, key=repr)


def bytes_left(rows, width):
    first = {}
    for key, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - width + 1 if key is not None else 0):
            w = b[i : i + width]
            first[w] = min(key, first.get(w, key))
    out = []
    for key, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - width + 1 if key is not None else 0):
            if first[b[i : i + width]] < key:
                gone[i : i + width] = [True] * width
        out.append((key, bytes(x for x, g in zip(b, gone) if not g), len(b), sum(gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("width", [35, 8])
@pytest.mark.parametrize("chunk", [300, kernels.BLOCK_BYTES])
def test_recompression(make, corpus, width, chunk):
    found = recompression.remove_repeated(make(corpus), width=width, chunk=chunk).collect()
    assert sorted([(r.doc_id, r.kept, r.n_words, r.n_removed) for r in found], key=repr) == words_left(corpus, width)
    assert all(sum(b - a for a, b in spans(r)) == r.n_removed for r in found)


@pytest.mark.parametrize("chunk", [300, kernels.BLOCK_BYTES])
def test_suffixes(make, corpus, chunk):
    found = substrings.remove_repeated(make(corpus), width=50, chunk=chunk).collect()
    assert sorted([(r.doc_id, bytes(r.kept), r.n_bytes, r.n_removed) for r in found], key=repr) == bytes_left(corpus, 50)
    assert all(sum(b - a for a, b in spans(r)) == r.n_removed for r in found)


def test_a_very_long_text(make):
    text = " ".join(f"w{i % 9973}" for i in range(120_000))
    rows = [(1, text), (2, "start " + text[5000:5400] + " end")]
    assert {r.doc_id: r.n_removed for r in substrings.remove_repeated(make(rows)).collect()} == {1: 0, 2: 400}
    found = {r.doc_id: r for r in recompression.remove_repeated(make(rows)).collect()}
    assert found[1].n_removed == 120_000 and found[2].n_removed >= 35
    assert {r.doc_id: r.n_removed for r in lines.dedup_lines(make([(1, "a\nb\nc\n" * 30_000), (2, None)])).collect()}[2] == 0


def chunks_of(text):
    """The chunks of a text by a plain loop: (start, end)."""
    import hashlib

    found = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in found]
    low = [(h[i] + 31 * (h[i - 1] if i else 0) + 961 * (h[i - 2] if i > 1 else 0)) % 1009 < 252 for i in range(len(h))]
    ends = [e for e in range(1, len(h) + 1) if e == len(h) or 2 <= e <= len(h) - 2 and low[e - 1] and (e < 3 or not low[e - 2])]
    out, a = [], 0
    for e in ends:
        out += [(s, min(s + 32, e)) for s in range(a, e, 32)]
        a = e
    return found, out


def lines_left(rows):
    first = {}
    for key, t in rows:
        if t is not None:
            found, chunks = chunks_of(t)
            for a, b in chunks:
                at = (key is None, key or 0, a)
                k = tuple(found[a:b])
                first[k] = min(at, first.get(k, at))
    out = []
    for key, t in rows:
        if t is None:
            out.append((key, None, 0, 0))
            continue
        found, chunks = chunks_of(t)
        gone = set()
        for a, b in chunks:
            if b - a >= 2 and first[tuple(found[a:b])] != (key is None, key or 0, a):
                gone.update(range(a, b))
        out.append((key, "\n".join(x for i, x in enumerate(found) if i not in gone), len(found), len(gone)))
    return sorted(out, key=repr)


def test_lines(make, corpus):
    rows = [(i, t) for i, t in corpus if i is not None]
    rows = list({i: (i, t) for i, t in rows}.values())
    more = [(1000 + i, None if t is None else "\n".join(t.split(" "))) for i, t in rows] + [(3000, "\n".join(f"l{i}" for i in range(200))), (3001, "new\n" + "\n".join(f"l{i}" for i in range(200))), (None, "\n".join(f"l{i}" for i in range(90)))]
    found = lines.dedup_lines(make([*rows, *more]), carry=("source", "lines")).collect()
    assert sorted([(r.doc_id, r.text, r.n_lines, r.n_removed) for r in found], key=repr) == lines_left([*rows, *more])
    # bounds resist a shift: all but a few lines of the shifted copy go
    assert {r.doc_id: r.n_removed for r in found}[3001] > 180
    assert {r.source for r in found} == {"s"}


def test_rows_that_repeat_and_empty_tables(make, corpus):
    assert len(lines.dedup_lines(make(corpus)).collect()) == len(corpus)
    for f in (lines.dedup_lines, recompression.remove_repeated, substrings.remove_repeated):
        assert f(make([])).collect() == []


def test_lines_of_rows_that_share_an_id(make):
    text = lambda name: "\n".join(f"{name}{i}" for i in range(40))
    rows = [(1, text("r")), (None, text("r")), (None, text("u")), (None, text("v")), (7, text("s")), (7, text("w")), (9, text("s")), (9, text("x")), (8, text("z")), (8, text("z")), (6, "y\n" + text("z"))]
    found = lines.dedup_lines(make(rows)).collect()
    left = sorted([(r.doc_id, r.text) for r in found], key=repr)
    # of chunks of two lines or more that repeat, the first by id stays; single lines stay
    assert len(left) == len(rows)
    for i, name in ((None, "u"), (None, "v"), (7, "w"), (9, "x"), (1, "r"), (7, "s")):
        assert (i, text(name)) in left
    for i, name in ((None, "r"), (9, "s"), (8, "z")):
        assert (i, text(name)) not in left
    removed = {(r.doc_id, r.text): r.n_removed for r in found}
    assert [r.n_removed for r in found if r.doc_id == 8][0] == [r.n_removed for r in found if r.doc_id == 8][1] > 20
    assert sorted(n > 20 for (i, _), n in removed.items() if i is None) == [False, False, True]


def test_of_a_repeated_chunk_one_stays_whatever_the_ids_are(make, corpus):
    """Null, repeated and unlike rows: what goes are all places of a chunk but one, and nothing else."""
    lines_of = lambda t: None if t is None else "\n".join(t.split(" "))
    rows = [(i, lines_of(t)) for i, t in corpus] + [(i and i % 5, lines_of(t)) for i, t in corpus[:40]] + [(None, lines_of(t)) for _, t in corpus[20:50]]
    times = Counter()
    for _, text in set(rows):
        if text is not None:
            found, chunks = chunks_of(text)
            for a, b in chunks:
                if b - a >= 2:
                    times[tuple(found[a:b])] += 1
    removed, seen = 0, set()
    for r in lines.dedup_lines(make(rows).withColumn("whole", F.col("text")), carry=("whole",)).collect():
        if (r.doc_id, r.whole) in seen or r.whole is None:
            continue
        seen.add((r.doc_id, r.whole))
        removed += r.n_removed
        found, kept = r.whole.split("\n"), r.text.split("\n") if r.n_removed < r.n_lines else []
        assert len(found) == r.n_lines and len(kept) == r.n_lines - r.n_removed
        rest = iter(found)
        assert all(x in rest for x in kept)  # what stays is in order
    assert removed == sum((n - 1) * len(chunk) for chunk, n in times.items()) > 500
