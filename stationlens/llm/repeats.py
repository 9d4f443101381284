"""Repeated windows over all documents, shared by the two exact substring operators.

A window is ``width`` units (bytes, or words) of one document. Every window is
represented by one *anchor* inside it that depends on the window's own content
alone, so equal windows have equal anchors at equal offsets; neighbouring windows
mostly share theirs, which leaves about one anchor for 10 to 16 windows. An anchor has a
name (what stands there), and a span: all that the windows it represents cover.

Documents are dealt into blocks by a hash of their id. Five steps, in which a block
asks and a bucket of names answers:

1. Each block sends the distinct (name, span) that it has, with the least document
   and the number of occurrences (up to two), to the bucket of the name.
2. A bucket sorts by name and span. A name that occurs once is done. A name with one
   span is settled: all its windows are repeated. Otherwise the spans differ.
3. For each differing span one block sends its text.
4. The bucket orders the windows of each name and offset by passes over their digits,
   from the most significant on, through the width of a window and no deeper: a digit is
   as many units as 64 bits hold, a pass splits each group of windows by the next digit,
   and groups of one window are finished. The groups that are left are the repeated
   windows, exactly. All blocks that have the spans are answered with the runs of them.
5. Each block marks what the answers cover in its documents.

What a block sends about a name doesn't grow with how often the block has it, so a
passage or a document that a third of all rows hold costs a bucket one entry per
block. Names carry 48 bits and spans 64 more: two spans count as copies of each other when
112 bits agree; windows of spans that differ are compared unit by unit.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from . import shared

#: Input file bytes of a task, and of the share of the input that a bucket answers for, at least.
SHARE = 4 << 20
#: Blocks of documents to a task: what a task holds at once is a block.
BLOCKS = 4
#: Every block sends to every bucket: shares grow with the root of the input, so that a message
#: stands for so many bytes of it (22 MB a share at 30 GB, 1.3 GB at 100 TB).
MESSAGE = 16 << 10

ROWS = "block long, kind int, doc_id long, body binary"
_ROWS = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("doc_id", pa.int64()), ("body", pa.binary())])
NO_DOC = np.iinfo(np.int64).max


class Anchors:
    """Anchors of some texts: text, first window, its offset from the anchor, windows, name, span, and the bytes of spans on demand."""

    def __init__(self, units: list[int], text, first, offset, count, name, span, body: Callable[[np.ndarray], list[bytes]]):
        self.units, self.text, self.first, self.offset, self.count, self.name, self.span, self.body = units, text, first, offset, count, name, span, body

    @staticmethod
    def joined(several: list[Anchors]) -> Anchors:
        cat = lambda field: np.concatenate([getattr(a, field) for a in several])
        ends = np.cumsum([len(a.name) for a in several])

        def body(which: np.ndarray) -> list[bytes]:
            part = np.searchsorted(ends, which, side="right")
            out: list[bytes] = [b""] * len(which)
            for k, a in enumerate(several):
                here = np.flatnonzero(part == k)
                for place, found in zip(here.tolist(), a.body(which[here] - (ends[k] - len(a.name)))):
                    out[place] = found
            return out

        return Anchors([u for a in several for u in a.units], cat("text"), cat("first"), cat("offset"), cat("count"), cat("name"), cat("span"), body)


#: Texts (as bytes) to their anchors, with the number of units of each text.
Finder = Callable[[list[bytes]], Anchors]
#: The bytes of some spans to their units as numbers in a row, the first unit of each span, and the bits of a number.
Units = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray, int]]


class Block:
    """The distinct texts of a block's documents, their anchors and entries."""

    def __init__(self, ids: list[int | None], bodies: list[bytes | None], find: Finder, buckets: int):
        self.ids = ids
        place: dict[bytes, int] = {}
        self.text_of = np.fromiter((place.setdefault(b or b"", len(place)) for b in bodies), dtype=np.int64, count=len(bodies))
        self.texts = list(place)
        self.anchors = a = find(self.texts)
        known = np.array([NO_DOC if i is None else i for i in ids], dtype=np.int64)
        least = np.full(len(self.texts), NO_DOC, dtype=np.int64)
        np.minimum.at(least, self.text_of, known)
        times = np.bincount(self.text_of, minlength=len(self.texts))
        # entries: distinct (name, span), in that order
        order = np.lexsort((a.span, a.name))
        name, span = a.name[order], a.span[order]
        fresh = np.ones(len(order), dtype=bool)
        if len(order):
            fresh[1:] = (name[1:] != name[:-1]) | (span[1:] != span[:-1])
        start = np.flatnonzero(fresh)
        self.name, self.span = name[start], span[start]
        self.entry_of = np.empty(len(order), dtype=np.int64)
        self.entry_of[order] = np.cumsum(fresh) - 1
        self.sample = order[start]  # an anchor of each entry
        if len(start):
            self.least = np.minimum.reduceat(least[a.text[order]], start)
            self.times = np.minimum(np.add.reduceat(times[a.text[order]], start), 2).astype(np.uint8)
        else:
            self.least, self.times = np.zeros(0, np.int64), np.zeros(0, np.uint8)
        bucket = ((self.name >> K.U(16)) * K.U(buckets)) >> K.U(32)
        self.edges = np.searchsorted(bucket, np.arange(buckets + 1, dtype=K.U))


def pack(**arrays) -> bytes:
    return pickle.dumps(arrays, protocol=5)


def _question(name: np.ndarray, span: np.ndarray, least: np.ndarray, times: np.ndarray) -> bytes:
    """17 bytes for an entry: the least documents as places in a list, the name in 48 bits."""
    docs, place = np.unique(least, return_inverse=True)
    wide = len(docs) >= 1 << 16
    parts = (np.array([len(name), len(docs), wide], np.int64), docs, span, (name & K.U(0xFFFFFFFF)).astype(np.uint32), (name >> K.U(32)).astype(np.uint16), place.astype(np.int64 if wide else np.uint16), times)
    return b"".join(x.tobytes() for x in parts)


def _read_question(body: bytes) -> tuple[np.ndarray, ...]:
    n, m, wide = (int(x) for x in np.frombuffer(body, np.int64, 3))
    at = 24
    out = []
    for kind, count in ((np.int64, m), (np.uint64, n), (np.uint32, n), (np.uint16, n), (np.int64 if wide else np.uint16, n), (np.uint8, n)):
        out.append(np.frombuffer(body, kind, count, at))
        at += out[-1].nbytes
    docs, span, low, high, place, times = out
    return low.astype(K.U) | (high.astype(K.U) << K.U(32)), span, docs[place], times


def _emit(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ROWS)], schema=_ROWS)


def _blocks(batches: Iterator[pa.RecordBatch], find: Finder, buckets: int) -> Iterator[tuple[int, Block, list[dict], list[dict]]]:
    shared.kept("repeats")
    for number, rows in shared.runs(batches, "block"):
        kind = rows.column("kind").to_numpy()
        bodies = rows.column("body")
        docs = np.flatnonzero(kind == 0)
        answers = [[pickle.loads(b) for b in bodies.take(pa.array(np.flatnonzero(kind == k))).to_pylist()] for k in (1, 2)]
        ids = rows.column("doc_id").take(pa.array(docs)).to_pylist()
        yield int(number), Block(ids, bodies.take(pa.array(docs)).to_pylist(), find, buckets), *answers


def ask(batches, find: Finder, buckets: int):
    for number, block, _, _ in _blocks(batches, find, buckets):
        out = []
        for b in range(buckets):
            lo, hi = block.edges[b], block.edges[b + 1]
            if lo < hi:
                out.append((b, 0, number, _question(block.name[lo:hi], block.span[lo:hi], block.least[lo:hi], block.times[lo:hi])))
        if out:
            yield _emit(out)


def answer(batches):
    """Step 2. Answers (kind 1, to blocks) and what is open (kind 3, kept by bucket)."""
    shared.kept("repeats")
    for bucket, rows in shared.runs(batches, "block"):
        blocks = rows.column("doc_id").to_numpy()
        asked = [_read_question(b) for b in rows.column("body").to_pylist()]
        sizes = [len(a[0]) for a in asked]
        name, span, least, times = (np.concatenate(x) for x in zip(*asked))
        times = times.astype(np.int64)
        asker = np.repeat(np.arange(len(asked)), sizes)
        entry = np.concatenate([np.arange(n) for n in sizes])
        del asked
        # names that occur once are done
        order = np.argsort(name, kind="stable")
        fresh = np.ones(len(order), dtype=bool)
        fresh[1:] = name[order[1:]] != name[order[:-1]]
        start = np.flatnonzero(fresh)
        total = np.add.reduceat(times[order], start)
        order = order[np.repeat(total > 1, np.diff(np.append(start, len(order))))]
        if not len(order):
            continue
        order = order[np.lexsort((span[order], name[order]))]
        name, span, least, times, asker, entry = (x[order] for x in (name, span, least, times, asker, entry))
        new_name = np.ones(len(name), dtype=bool)
        new_name[1:] = name[1:] != name[:-1]
        new_span = new_name.copy()
        new_span[1:] |= span[1:] != span[:-1]
        of_span, of_name = np.cumsum(new_span) - 1, np.cumsum(new_name) - 1
        first = np.flatnonzero(new_span)
        span_least = np.minimum.reduceat(least, first)
        span_times = np.minimum(np.add.reduceat(times, first), 2)
        spans_of_name = np.bincount(of_name[first])
        settled = spans_of_name[of_name] == 1
        send = new_span & ~settled
        out = []
        by_block = np.argsort(asker, kind="stable")
        edges = np.searchsorted(asker[by_block], np.arange(len(blocks) + 1))
        for k, number in enumerate(blocks.tolist()):
            mine = by_block[edges[k] : edges[k + 1]]
            if len(mine):
                s = mine[settled[mine]]
                out.append((number, 1, None, pack(bucket=int(bucket), entry=entry[s].astype(np.uint32), least=span_least[of_span[s]], send=entry[mine[send[mine]]].astype(np.uint32))))
        if not settled.all():
            o = np.flatnonzero(~settled)
            f = first[~settled[first]]
            renumber = np.cumsum(~settled[first]) - 1
            out.append((int(bucket), 3, None, pack(name=name[f], span=span[f], least=span_least[of_span[f]], times=span_times[of_span[f]].astype(np.uint8), of=renumber[of_span[o]].astype(np.uint32), block=blocks[asker[o]], entry=entry[o].astype(np.uint32))))
        if out:
            yield _emit(out)


def send(batches, find: Finder, buckets: int):
    """Step 3: the texts of the spans that were asked for."""
    for number, block, answers, _ in _blocks(batches, find, buckets):
        out = []
        a = block.anchors
        for x in answers:
            if len(x["send"]):
                e = block.edges[x["bucket"]] + x["send"].astype(np.int64)
                s = block.sample[e]
                out.append((x["bucket"], 4, number, pack(name=block.name[e], span=block.span[e], offset=a.offset[s].astype(np.int16), count=a.count[s].astype(np.uint16), body=a.body(s))))
        if out:
            yield _emit(out)


def digit_passes(units: np.ndarray, bits: int, start: np.ndarray, group: np.ndarray, times: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Most-significant-digit radix sort of windows, through ``width`` units.

    ``start`` is a window's first unit, ``group`` its first group (dense), ``times`` how often it
    stands. Returns the windows whose whole sequence stands more than once in their group, in
    order, and the number of their equal group.
    """
    each = 64 // bits
    digit = np.zeros(len(units), dtype=K.U)
    for k in range(min(each, len(units))):
        digit[: len(units) - k] |= units[k:] << K.U(bits * (each - 1 - k))
    live, depth = np.arange(len(start)), 0
    while True:
        total = np.bincount(group, weights=times[live]) if len(live) else np.zeros(0)
        company = total[group] > 1
        live, group = live[company], group[company]
        if depth >= width or not len(live):
            return live, np.cumsum(np.diff(group, prepend=-1) != 0) - 1 if len(live) else group
        take = min(each, width - depth)
        here = digit[start[live] + depth] >> K.U(bits * (each - take))
        order = np.lexsort((here, group))
        live, group, here = live[order], group[order], here[order]
        new = np.ones(len(live), dtype=bool)
        new[1:] = (group[1:] != group[:-1]) | (here[1:] != here[:-1])
        group = np.cumsum(new) - 1
        depth += take


def resolve(batches, width: int, units_of: Units):
    """Step 4: runs of repeated windows of each open span, to every block that has it."""
    shared.kept("repeats")
    for bucket, rows in shared.runs(batches, "block"):
        kind = rows.column("kind").to_numpy()
        bodies = [pickle.loads(b) for b in rows.column("body").to_pylist()]
        spans = [b for b, k in zip(bodies, kind) if k == 4]
        (held,) = [b for b, k in zip(bodies, kind) if k == 3] or [None]
        del bodies
        if held is None or not spans:
            continue
        name, span, offset, count = (np.concatenate([x[f] for x in spans]) for f in ("name", "span", "offset", "count"))
        units, begin, bits = units_of([b for x in spans for b in x["body"]])
        del spans
        # put in the order of what is held: by name and span
        order = np.lexsort((span, name))
        assert (name[order] == held["name"]).all() and (span[order] == held["span"]).all()
        offset, count, begin = offset[order].astype(np.int64), count[order].astype(np.int64), begin[order]
        owner = np.repeat(np.arange(len(order)), count)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        # the first groups: windows of one name that lie alike around it
        of_name = np.cumsum(np.diff(held["name"].astype(np.int64), prepend=-1) != 0) - 1
        at = offset[owner] + within
        low = int(at.min())
        _, group = np.unique(of_name[owner] * (int(at.max()) - low + 1) + (at - low), return_inverse=True)
        live, group = digit_passes(units, bits, begin[owner] + within, group, held["times"][owner], width)
        hit = np.zeros(len(owner), dtype=bool)
        hit[live] = True
        least = np.full(len(owner), NO_DOC, dtype=np.int64)
        if len(live):
            of_group = np.full(int(group[-1]) + 1, NO_DOC, dtype=np.int64)
            np.minimum.at(of_group, group, held["least"][owner[live]])
            least[live] = of_group[group]
        # runs of hit windows of one span with one least document
        cut = np.ones(len(owner), dtype=bool)
        cut[1:] = (owner[1:] != owner[:-1]) | (hit[1:] != hit[:-1]) | (least[1:] != least[:-1])
        start = np.flatnonzero(cut)
        length = np.diff(np.append(start, len(owner)))
        keep = hit[start]
        start, length = start[keep], length[keep]
        run_owner, run_first, run_least = owner[start], within[start], least[start]
        lo = np.searchsorted(run_owner, np.arange(len(order)))
        n_runs = np.searchsorted(run_owner, np.arange(len(order)), side="right") - lo
        of = held["of"].astype(np.int64)
        n = n_runs[of]
        sub = np.repeat(np.arange(len(of)), n)
        run = np.repeat(lo[of], n) + np.arange(len(sub)) - np.repeat(np.cumsum(n) - n, n)
        block = held["block"][sub]
        by_block = np.argsort(block, kind="stable")
        cuts = np.flatnonzero(np.diff(block[by_block])) + 1
        out = []
        for mine in np.split(by_block, cuts) if len(by_block) else []:
            r = run[mine]
            out.append((int(block[mine[0]]), 2, None, pack(bucket=int(bucket), entry=held["entry"][sub[mine]], first=run_first[r].astype(np.uint16), length=length[r].astype(np.uint16), least=run_least[r])))
        if out:
            yield _emit(out)


def marked(block: Block, answers: list[dict], more: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first window, windows, least document) of the runs that are repeated, by text."""
    a = block.anchors
    # runs by entry
    entry = [block.edges[x["bucket"]] + x["entry"].astype(np.int64) for x in answers]
    whole = np.concatenate(entry) if entry else np.zeros(0, np.int64)
    cat = lambda xs, dtype: np.concatenate(xs).astype(dtype) if xs else np.zeros(0, dtype)
    owner = np.concatenate([whole, cat([block.edges[x["bucket"]] + x["entry"].astype(np.int64) for x in more], np.int64)])
    first = np.concatenate([np.zeros(len(whole), np.int64), cat([x["first"] for x in more], np.int64)])
    length = np.concatenate([a.count[block.sample[whole]], cat([x["length"] for x in more], np.int64)])
    least = np.concatenate([cat([x["least"] for x in answers], np.int64), cat([x["least"] for x in more], np.int64)])
    order = np.argsort(owner, kind="stable")
    owner, first, length, least = owner[order], first[order], length[order], least[order]
    lo = np.searchsorted(owner, block.entry_of, side="left")
    n = np.searchsorted(owner, block.entry_of, side="right") - lo
    which = np.repeat(np.arange(len(n)), n)
    run = np.repeat(lo, n) + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    return a.text[which], a.first[which] + first[run], length[run], least[run]


def finish(batches, find: Finder, buckets: int, result: Callable[[Block, tuple], Iterator[pa.RecordBatch]]):
    for _, block, answers, more in _blocks(batches, find, buckets):
        yield from result(block, marked(block, answers, more))


def repeated(docs: DataFrame, key: str, text: str, width: int, find: Finder, units_of: Units, result: Callable, schema: str) -> DataFrame:
    """``result`` of every block, with all its repeated windows marked."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    size = shared.size_in_bytes(docs, text)
    n = buckets = shared.parts(spark, size, max(SHARE, math.isqrt(MESSAGE * size)))
    bodies = rows.select(F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(0))), F.lit(n * BLOCKS)).alias("block"), F.lit(0).alias("kind"), "doc_id", F.encode("text", "utf-8").alias("body"))

    def dealt(*frames: DataFrame, into: int) -> DataFrame:
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f.select("block", "kind", "doc_id", "body"))
        return out.repartition(into, "block").sortWithinPartitions("block", "kind")

    asked = dealt(bodies, into=n).mapInArrow(lambda b: ask(b, find, buckets), ROWS)
    first = shared.materialize(dealt(asked, into=buckets).mapInArrow(answer, ROWS), "answers")
    to_blocks, held = first.where("kind = 1"), first.where("kind = 3")
    spans = shared.materialize(dealt(bodies, to_blocks, into=n).mapInArrow(lambda b: send(b, find, buckets), ROWS), "spans")
    second = shared.materialize(dealt(spans, held, into=buckets).mapInArrow(lambda b: resolve(b, width, units_of), ROWS), "resolved")
    shared.discard(spans)
    return dealt(bodies, to_blocks, second, into=n).mapInArrow(lambda b: finish(b, find, buckets, result), schema)
