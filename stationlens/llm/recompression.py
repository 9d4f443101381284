"""Substring dedup (4): recompression, on words.

Removed is every word under a window of ``WIDTH`` words whose sequence also starts
anywhere else, in the same document too. Rounds of recompression name runs and
pairs: a run of exactly two equal symbols gets a name of its own, and a pair is
formed of a symbol on the left side of the alphabet followed by one on the right
side, the sides being drawn anew by hash in each round. A name is a hash of what it
stands for, so all partitions give equal content equal names without a table of
them. Whether symbols join depends on them and their neighbours only: inside equal
windows the symbols agree but for a few words at the ends (the margin), whatever
stands around. Longer runs stay as they are. Rounds go on, each letting symbols grow by
half, for as long as every window of ``WIDTH`` words still holds a whole symbol between
its margins: up to 6 words at a width of 35 (``rounds``).

The symbol of least hash of those inside a window's margins stands for the window,
with the words of a margin on either side, which lie inside the window as well.
Symbols that several places share reveal the repeats, which are then verified
word by word (see ``repeats``).

Words are the runs of bytes other than space, tab and line breaks, unchanged. A
null text has no words. Rows that repeat count as different places. Ids are carried
along only, null or not. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import kernels as K
from . import repeats
from .substrings import _none, spans_of

WIDTH = 35
SCHEMA = "doc_id long, kept string, n_words long, n_removed long, spans array<struct<start: long, end: long>>"
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("kept", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def rounds(width: int) -> tuple[tuple[int, ...], int]:
    """The words to which each round may let a symbol grow, and the words at either end of a window within which symbols may differ.

    The first round joins runs of two, whose neighbours decide too; a later one moves the margin by a symbol of the round before.
    """
    caps: tuple[int, ...] = ()
    margin = 0
    while True:
        cap, more = (2, 2) if not caps else (caps[-1] + max(1, caps[-1] // 2), margin + caps[-1])
        if 2 * more + 2 * cap - 1 > width:
            return caps, margin
        caps, margin = (*caps, cap), more


CAPS, MARGIN = rounds(WIDTH)


def _join(name: np.ndarray, start: np.ndarray, first: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols after those at ``first`` have joined the next one."""
    out = name.copy()
    out[first] = K.mix(name[first] * K.U(3) + K.mix(name[first + 1], seed), seed)
    keep = np.ones(len(name), dtype=bool)
    keep[first + 1] = False
    return out[keep], start[keep]


def symbols(words: np.ndarray, caps: tuple[int, ...] = CAPS) -> tuple[np.ndarray, np.ndarray]:
    """Names and first words of the symbols of a sequence of word hashes."""
    name, start = words, np.arange(len(words))
    for number, cap in enumerate(caps):
        if len(name) < 2:
            break
        size = np.diff(np.append(start, len(words)))
        fits = size[:-1] + size[1:] <= cap
        if number == 0:
            same = name[1:] == name[:-1]
            before = np.concatenate([[False], same[:-1]])
            after = np.concatenate([same[1:], [False]])
            first = np.flatnonzero(same & ~before & ~after & fits)
        else:
            left = (K.mix(name, 100 + number) >> K.U(63)).astype(bool)
            first = np.flatnonzero(left[:-1] & ~left[1:] & fits)
        name, start = _join(name, start, first, 200 + number)
    return name, start


def _range_least(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """min(values[lo:hi]) of each non-empty range."""
    out = np.empty(len(lo), dtype=values.dtype)
    length = hi - lo
    level = values
    step = 1
    while True:
        here = (length >= step) & (length < 2 * step)
        if here.any():
            out[here] = np.minimum(level[lo[here]], level[hi[here] - step])
        if not (length >= 2 * step).any():
            return out
        level = np.minimum(level[: len(level) - step], level[step:])
        step *= 2


def finder(width: int = WIDTH, chunk: int = K.BLOCK_BYTES) -> repeats.Finder:
    caps, margin = rounds(width)

    def find(texts: list[bytes]) -> repeats.Anchors:
        parts = []
        for at, buffer, doc_starts, _ in K.blocks(texts, chunk):
            starts, ends, first_word = K.words(buffer, doc_starts)
            words = K.word_hashes(buffer, starts, ends)
            n = len(words)
            units = np.diff(first_word)
            doc = np.repeat(np.arange(len(units)), units)
            index = np.arange(n)
            window = index[index + width <= first_word[1:][doc]]
            if not len(window):
                parts.append(_empty(units))
                continue
            name, start = symbols(words, caps)
            end = np.append(start[1:], n)
            low = K.U(0xFFFFFFFF)
            keyed = (K.mix(name, 9) & ~low) | (low - np.arange(len(name), dtype=K.U))
            lo = np.searchsorted(start, window + margin, side="left")
            hi = np.searchsorted(end, window + width - margin, side="right")
            place = (low - (_range_least(keyed, lo, hi) & low)).astype(np.int64)
            new = np.concatenate([[0], np.flatnonzero((np.diff(place) != 0) | (np.diff(window) != 1)) + 1])
            first, place = window[new], place[new]
            count = np.diff(np.append(new, len(window)))
            sums = K.prefix_sums(words)

            def body(which, buffer=buffer, first=first, count=count, starts=starts, ends=ends):
                return [buffer[a:b].tobytes() for a, b in zip(starts[first[which]].tolist(), ends[first[which] + count[which] + width - 2].tolist())]

            # a symbol's margins lie inside the windows that it stands for: its name tells them too
            named = K.range_hash(sums, np.maximum(start[place] - margin, 0), np.minimum(end[place] + margin, n), seed=21)
            text = doc[first]
            parts.append(repeats.Anchors(units.tolist(), text + at, first - first_word[text], first - start[place], count, named >> K.U(16), K.range_hash(sums, first, first + count - 1 + width, seed=3), body))
        return repeats.Anchors.joined(parts) if parts else _none()

    return find


def _empty(units: np.ndarray) -> repeats.Anchors:
    a = _none()
    a.units = units.tolist()
    return a


def word_units(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray, int]:
    """Words as numbers of their own, told apart by all their bytes."""
    known: dict[bytes, int] = {}
    split = [b.split() for b in bodies]
    sizes = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
    units = np.fromiter((known.setdefault(w, len(known)) for ws in split for w in ws), dtype=K.U, count=int(sizes.sum()))
    return units, np.cumsum(sizes) - sizes, max(1, len(known).bit_length())


def result(width: int = WIDTH):
    def of(block: repeats.Block, runs: tuple) -> Iterator[pa.RecordBatch]:
        text, first, count, _ = runs
        order = np.argsort(text, kind="stable")
        text, first, count = text[order], first[order], count[order]
        edges = np.searchsorted(text, np.arange(len(block.texts) + 1))
        made: dict[int, tuple] = {}
        times = np.bincount(block.text_of, minlength=len(block.texts))
        out: list[tuple] = []
        held = 0
        for key, t in zip(block.ids, block.text_of.tolist()):
            if (row := made.get(t)) is None:
                words = _WORD.findall(block.texts[t])
                mine = slice(edges[t], edges[t + 1])
                spans, kept = [], words
                if edges[t] < edges[t + 1]:
                    begin, end = spans_of(len(words), first[mine], count[mine], width)
                    spans = list(zip(begin.tolist(), end.tolist()))
                    at, kept = 0, []
                    for a, b in spans:
                        kept += words[at:a]
                        at = b
                    kept += words[at:]
                row = (b" ".join(kept).decode("utf-8", "replace"), len(words), len(words) - len(kept), [{"start": a, "end": b} for a, b in spans])
                if times[t] > 1:
                    made[t] = row
            out.append((key, *row))
            held += len(row[0])
            if held > 4 << 20:
                yield _batch(out)
                out, held = [], 0
        if out:
            yield _batch(out)

    return of


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)


def remove_repeated(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, chunk: int = K.BLOCK_BYTES) -> DataFrame:
    """Each document's kept words, and the spans (in words, end exclusive) that were removed."""
    return repeats.repeated(docs, key, text, width, finder(width, chunk), word_units, result(width), SCHEMA)
