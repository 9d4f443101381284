"""Suffix-array dedup (10): depth-limited radix sort of suffixes, on bytes.

Removed is every byte under a string of ``WIDTH`` bytes that also starts in a
document with a smaller id. To find the repeated strings, suffixes are ordered
through ``WIDTH`` bytes only, by most-significant-digit passes. The first pass deals them
into buckets: of the suffixes that start inside a window, the one whose ``DIGIT`` bytes have the
least hash stands for the window (see ``repeats``), so that a bucket is told of one
suffix in about 16; what occurs once there is finished. The suffixes that are left are
then ordered by their bytes, 8 to a digit: a pass splits each group by the next digit and
drops groups of one, until ``WIDTH`` bytes are read. The equal groups are exactly the
repeated windows.

Null texts count as empty. A row without doc_id keeps its text and takes nothing
from others. Rows that repeat a doc_id don't remove each other's bytes, but lose what
a smaller id has. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import kernels as K
from . import repeats

WIDTH = 50
DIGIT = 18

SCHEMA = "doc_id long, kept binary, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>"
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("kept", pa.binary()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(_SPAN))])


def finder(width: int = WIDTH, digit: int = DIGIT, chunk: int = K.BLOCK_BYTES) -> repeats.Finder:
    digit = min(digit, max(1, width // 2))

    def find(texts: list[bytes]) -> repeats.Anchors:
        parts = []
        for at, buffer, starts, ends in K.blocks(texts, chunk):
            n = len(buffer)
            sums = K.prefix_sums(K.byte_codes(buffer))
            begin = np.arange(max(0, n - digit + 1))
            hashes = K.range_hash(sums, begin, begin + digit)
            valid = np.zeros(n + 1, dtype=np.int8)
            long = ends - starts >= width
            np.add.at(valid, starts[long], 1)
            np.add.at(valid, ends[long] - width + 1, -1)
            place, first, count = K.winnow(hashes, width - digit + 1, np.cumsum(valid)[:n] > 0)
            text = np.searchsorted(starts, first, side="right") - 1
            # mixed anew: the least of many hashes are small, and buckets go by the size of the name

            def body(which, buffer=buffer, first=first, count=count):
                return [buffer[a:b].tobytes() for a, b in zip(first[which].tolist(), (first[which] + count[which] - 1 + width).tolist())]

            parts.append(repeats.Anchors((ends - starts).tolist(), text + at, first - starts[text], first - place, count, K.mix(hashes[place], 23) >> K.U(16), K.range_hash(sums, first, first + count - 1 + width, seed=3), body))
        return repeats.Anchors.joined(parts) if parts else _none()

    return find


def _none() -> repeats.Anchors:
    i, u = np.zeros(0, np.int64), np.zeros(0, K.U)
    return repeats.Anchors([], i, i, i, i, u, u, lambda which: [])


def byte_units(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray, int]:
    """Bytes as units of 8 bits."""
    sizes = np.fromiter(map(len, bodies), dtype=np.int64, count=len(bodies))
    return np.frombuffer(b"".join(bodies), dtype=np.uint8).astype(K.U), np.cumsum(sizes) - sizes, 8


def spans_of(size: int, first: np.ndarray, count: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of units under the windows."""
    depth = np.zeros(size + 1, dtype=np.int64)
    np.add.at(depth, first, 1)
    np.add.at(depth, first + count - 1 + width, -1)
    inside = np.concatenate([[False], np.cumsum(depth[:-1]) > 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]


def result(width: int = WIDTH):
    def of(block: repeats.Block, runs: tuple) -> Iterator[pa.RecordBatch]:
        text, first, count, least = runs
        order = np.argsort(text, kind="stable")
        text, first, count, least = text[order], first[order], count[order], least[order]
        edges = np.searchsorted(text, np.arange(len(block.texts) + 1))
        out: list[tuple] = []
        held = 0
        for row, (key, t) in enumerate(zip(block.ids, block.text_of.tolist())):
            body = block.texts[t]
            mine = slice(edges[t], edges[t + 1])
            kept, spans = body, []
            if key is not None and edges[t] < edges[t + 1]:
                smaller = least[mine] < key
                if smaller.any():
                    begin, end = spans_of(len(body), first[mine][smaller], count[mine][smaller], width)
                    spans = list(zip(begin.tolist(), end.tolist()))
                    at, keep = 0, []
                    for a, b in spans:
                        keep.append(body[at:a])
                        at = b
                    kept = b"".join([*keep, body[at:]])
            out.append((key, kept, len(body), len(body) - len(kept), [{"start": a, "end": b} for a, b in spans]))
            held += len(kept)
            if held > 4 << 20:
                yield _batch(out)
                out, held = [], 0
        if out:
            yield _batch(out)

    return of


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)


def remove_repeated(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, chunk: int = K.BLOCK_BYTES) -> DataFrame:
    """Each document's kept bytes, and the spans (in bytes, end exclusive) that were removed."""
    return repeats.repeated(docs, key, text, width, finder(width, chunk=chunk), byte_units, result(width), SCHEMA)
