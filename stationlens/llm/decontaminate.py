"""Benchmark decontamination (8): greedy string tiling by running Karp-Rabin matching.

Tokens are runs of letters, marks and digits (of any script) of the lower-cased text. A
document and a benchmark item that share enough seeds of ``SEED`` tokens are tiled: rolling
hashes of both find the longest matches among tokens that aren't marked yet, from long to
short; each is marked in both as a tile, until no match of ``SEED`` tokens is left. Of
matches of one length the leftmost of the document goes first, with the leftmost of the
item. The share of the item's tokens under tiles is its coverage. Tiles may lie in any
order, so a passage with its parts moved about is found as well. Every token of a
match is compared, so equal hashes alone mark nothing.

An item shorter than ``SEED`` tokens is matched as a whole by its own length; one of fewer
than ``SHORT`` tokens, which any text may hold by chance, only where it is all that a line
of the document holds.

Seeds are joined in Spark. A bit filter of the benchmark's seeds, of at most ``FILTER_BYTES``,
goes to the executors: documents are read once, and those with a seed that passes give their
text and such seeds. The filter only spares rows; whatever its size, the join on the seeds decides.
To cover the least share an item of n tokens needs m = ceil(share * n / SEED) of its seeds,
so it is joined without its m - 1 seeds that most documents have, and a phrase that many
documents and items share pairs few of them. The pairs that are left are tiled.

Null and empty texts and items without tokens match nothing. Items or documents
that repeat an id are matched each on its own. Empty tables give no rows.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import kernels as K
from . import shared

SEED = 5
SHORT = 3
COVERAGE = 0.5
FILTER_BYTES = 16 << 20
#: Bits of the filter for each seed of the benchmark, up to its bound.
FILTER_BITS = 16

SCHEMA = "doc_id long, item_id long, n_tiles long, n_covered long, n_item_tokens long, coverage double"


@functools.cache
def _is_token() -> np.ndarray:
    """For each code point, whether it is a letter, mark or digit."""
    return np.fromiter((unicodedata.category(chr(c))[0] in "LMN" for c in range(0x110000)), dtype=bool, count=0x110000)


_CODES = K.mix(np.arange(1 << 16, dtype=K.U), 7)


def tokens(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(index of the first text, token hashes, first token of each text and the total, line of each token)."""
    at = 0
    while at < len(texts):
        size, upto = 0, at
        while upto < len(texts) and (upto == at or size + len(texts[upto] or "") < K.BLOCK_BYTES):
            size += len(texts[upto] or "") + 1
            upto += 1
        part = [(t or "").lower() for t in texts[at:upto]]
        length = np.fromiter(map(len, part), dtype=np.int64, count=len(part))
        points = np.frombuffer(("\n".join(part) + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        inside = _is_token()[points]
        edges = np.diff(np.concatenate([[False], inside]).astype(np.int8))
        begin, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        codes = _CODES[np.minimum(points, 0xFFFF)]
        if (beyond := np.flatnonzero(points > 0xFFFF)).size:
            codes[beyond] = K.mix(points[beyond].astype(K.U), 7)
        start = np.cumsum(length + 1) - (length + 1)
        line = np.searchsorted(np.flatnonzero(points == 10), begin)
        yield at, K.range_hash(K.prefix_sums(codes), begin, end), np.append(np.searchsorted(begin, start), len(begin)), line
        at = upto


def gram_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """The rolling hash of each run of n tokens."""
    if len(codes) < n:
        return np.zeros(0, dtype=K.U)
    at = np.arange(len(codes) - n + 1)
    return K.range_hash(K.prefix_sums(codes), at, at + n)


def seeds_of(codes: np.ndarray, first: np.ndarray, line: np.ndarray, lengths: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, seed) of every seed of the given lengths in some texts: runs of tokens, or whole lines of fewer than ``SHORT`` tokens."""
    sums = K.prefix_sums(codes)
    for n in lengths:
        if n < SHORT:
            new = np.flatnonzero(np.diff(line, prepend=-1) != 0)
            size = np.diff(np.append(new, len(codes)))
            at = new[size == n]
            text = np.searchsorted(first, at, "right") - 1
            yield text, K.range_hash(sums, at, at + n, seed=1)
        elif len(codes) >= n:
            at = np.arange(len(codes) - n + 1)
            text = np.searchsorted(first, at, "right") - 1
            within = at + n <= first[text + 1]
            yield text[within], K.range_hash(sums, at[within], at[within] + n)


def tile(doc: np.ndarray, item: np.ndarray, least: int) -> tuple[int, int]:
    """(tiles, tokens of the item under tiles) of greedy string tiling."""
    free_doc, free_item = np.ones(len(doc), bool), np.ones(len(item), bool)
    sums_doc, sums_item = K.prefix_sums(doc), K.prefix_sums(item)
    tiles = covered = 0
    length = _greatest(sums_doc, sums_item, free_doc, free_item, least, min(len(doc), len(item)))
    while length:
        # whole runs of free tokens only
        at_doc, at_item = _free(free_doc, length), _free(free_item, length)
        of_doc, of_item = K.range_hash(sums_doc, at_doc, at_doc + length), K.range_hash(sums_item, at_item, at_item + length)
        order = np.argsort(of_item, kind="stable")
        at_item, of_item = at_item[order], of_item[order]
        lo, hi = np.searchsorted(of_item, of_doc, "left"), np.searchsorted(of_item, of_doc, "right")
        gone: dict[int, int] = {}  # places of a hash that are taken, which none comes back from
        for k in np.flatnonzero(hi > lo).tolist():
            d, a = int(at_doc[k]), int(lo[k])
            if not free_doc[d : d + length].all():
                continue
            for p in range(gone.get(a, a), int(hi[k])):
                i = int(at_item[p])
                if not free_item[i : i + length].all():
                    if p == gone.get(a, a):
                        gone[a] = p + 1
                elif (doc[d : d + length] == item[i : i + length]).all():
                    free_doc[d : d + length] = False
                    free_item[i : i + length] = False
                    tiles, covered = tiles + 1, covered + length
                    break
        length = _greatest(sums_doc, sums_item, free_doc, free_item, least, length - 1)
    return tiles, covered


def _free(free: np.ndarray, length: int) -> np.ndarray:
    taken = np.concatenate([[0], np.cumsum(~free)])
    return np.flatnonzero(taken[length:] == taken[: len(taken) - length])


def _greatest(sums_doc, sums_item, free_doc, free_item, least: int, most: int) -> int:
    """The greatest length with a match of free tokens, 0 if none; matches of a length hold shorter ones."""

    def matched(n: int) -> bool:
        a, b = _free(free_doc, n), _free(free_item, n)
        return bool(len(a) and len(b) and np.isin(K.range_hash(sums_doc, a, a + n), K.range_hash(sums_item, b, b + n)).any())

    if most < least or not matched(least):
        return 0
    lo, hi = least, most
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if matched(mid) else (lo, mid - 1)
    return lo


def _items(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    """item, item_id, text, n (tokens) and seeds (with how often the item has each), of items with tokens."""
    from pyspark import TaskContext

    shared.kept("decontaminate")
    number = TaskContext.get().partitionId() << 40
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        rows = []
        for at, codes, first, line in tokens(texts):
            for k in np.flatnonzero(np.diff(first)).tolist():
                mine = slice(first[k], first[k + 1])
                n = int(first[k + 1] - first[k])
                if n < SHORT:
                    found = K.range_hash(K.prefix_sums(codes[mine]), np.array([0]), np.array([n]), seed=1)
                else:
                    found = gram_hashes(codes[mine], min(seed, n))
                distinct, times = np.unique(found, return_counts=True)
                rows.append((number, ids[at + k], texts[at + k], n, [{"seed": s, "times": t} for s, t in zip(distinct.astype(np.int64).tolist(), times.tolist())]))
                number += 1
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ITEMS.types)], schema=_ITEMS)


ITEMS = "item long, item_id long, text string, n long, seeds array<struct<seed: long, times: long>>"
_ITEMS = pa.schema([("item", pa.int64()), ("item_id", pa.int64()), ("text", pa.string()), ("n", pa.int64()), ("seeds", pa.list_(pa.struct([("seed", pa.int64()), ("times", pa.int64())])))])


def _filter(items: DataFrame, most_bytes: int) -> tuple[np.ndarray, int]:
    """The bit filter of all seeds, and the shift that makes a seed a place in it."""
    seeds = items.select(F.explode("seeds.seed").alias("seed"))
    wanted = FILTER_BITS * seeds.count()
    bits = max(3, min(max(wanted, 1 << 16).bit_length(), (8 * most_bytes).bit_length() - 1))
    place = F.shiftrightunsigned("seed", 64 - bits)
    # pieces of 4 KB: at most ``most_bytes`` of them come to the driver
    pieces = seeds.select((place + 1).alias("p")).groupBy(F.expr("bitmap_bucket_number(p)").alias("piece")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(p))").alias("bits"))
    out = np.zeros(max(1 << bits, 1 << 15) // 8, dtype=np.uint8)
    for piece, found in pieces.collect():
        out[(piece - 1) * 4096 : piece * 4096] = np.frombuffer(found, dtype=np.uint8)
    return out, 64 - bits


def _candidates(batches: Iterator[pa.RecordBatch], bits, shift: int, lengths: list[int]) -> Iterator[pa.RecordBatch]:
    """row, doc_id, text and seeds of the documents with seeds that pass the filter."""
    from pyspark import TaskContext

    shared.kept("decontaminate")
    row = TaskContext.get().partitionId() << 40
    bits = bits.value
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            which: list[int] = []
            seeds: list[list[int]] = []
            for at, codes, first, line in tokens(part.column(1).to_pylist()):
                texts, found = [], []
                for text, seed in seeds_of(codes, first, line, lengths):
                    place = seed >> K.U(shift)
                    hit = (bits[(place >> K.U(3)).astype(np.int64)] >> (place & K.U(7)).astype(np.uint8)) & 1 == 1
                    texts.append(text[hit])
                    found.append(seed[hit])
                if not texts:
                    continue
                text, found = np.concatenate(texts), np.concatenate(found)
                order = np.argsort(text, kind="stable")
                text, found = text[order], found[order]
                for a, b in zip(edges := [0, *(np.flatnonzero(np.diff(text)) + 1).tolist(), len(text)], edges[1:]):
                    if a < b:
                        which.append(at + int(text[a]))
                        seeds.append(np.unique(found[a:b]).astype(np.int64).tolist())
            if which:
                some = part.take(pa.array(which))
                yield pa.RecordBatch.from_arrays([pa.array(range(row, row + len(which)), pa.int64()), some.column(0), some.column(1).cast(pa.string()), pa.array(seeds, pa.list_(pa.int64()))], names=["row", "doc_id", "text", "seeds"])
                row += len(which)


def _tiled(batches: Iterator[pa.RecordBatch], seed: int, least: float) -> Iterator[pa.RecordBatch]:
    """Tiles of each document (kind 0) and the items (kind 1) that follow it."""
    schema = pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in ("item_id", "n_tiles", "n_covered", "n_item_tokens")), ("coverage", pa.float64())])
    shared.kept("decontaminate")
    row, doc_id, doc = None, None, np.zeros(0, K.U)
    for batch in batches:
        out = []
        of_row, kind, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()
        for at, codes, first, _ in tokens(batch.column(3).to_pylist()):
            for k in range(len(first) - 1):
                mine = codes[first[k] : first[k + 1]]
                if kind[at + k] == 0:
                    row, doc_id, doc = of_row[at + k], ids[at + k], mine.copy()
                elif row == of_row[at + k]:
                    # an item under SHORT tokens was joined by whole lines
                    n, covered = tile(doc, mine, min(seed, len(mine)))
                    if covered >= least * len(mine):
                        out.append((doc_id, ids[at + k], n, covered, len(mine), covered / len(mine)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", seed: int = SEED, least: float = COVERAGE, block_bytes: int = FILTER_BYTES) -> DataFrame:
    """One row for each document and item whose coverage is at least ``least``; the filter has at most ``block_bytes``."""
    spark = docs.sparkSession
    given = benchmark.select(F.col(item).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    items = shared.materialize(given.mapInArrow(lambda b: _items(b, seed), ITEMS), "items")
    lengths = sorted(r[0] for r in items.select(F.least("n", F.lit(seed)).cast("int")).distinct().collect())  # at most ``seed`` of them
    bits, shift = _filter(items, block_bytes)
    bits = spark.sparkContext.broadcast(bits)

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    shape = "row long, doc_id long, text string, seeds array<long>"
    candidates = shared.materialize(rows.mapInArrow(lambda b: _candidates(b, bits, shift, lengths), shape), "candidates")

    hits = candidates.select("row", F.explode("seeds").alias("seed"))
    listed = items.select("item", "n", F.explode("seeds").alias("s")).select("item", "n", "s.seed", "s.times")
    often = hits.groupBy("seed").agg(F.count("*").alias("docs"))
    ranked = listed.join(often, "seed").withColumn("passed", F.sum("times").over(W.partitionBy("item").orderBy(F.desc("docs"), "seed")))
    needed = F.ceil(F.lit(least) * F.col("n") / F.least("n", F.lit(seed)))
    rare = shared.materialize(ranked.where(F.col("passed") >= needed).select("item", "seed"), "rare")
    pairs = shared.materialize(hits.join(rare, "seed").select("row", "item").distinct(), "pairs")

    texts = candidates.join(pairs.select("row").distinct(), "row", "left_semi").select("row", F.lit(0).alias("kind"), F.col("doc_id").alias("id"), "text")
    against = pairs.join(items.select("item", "item_id", "text"), "item").select("row", F.lit(1).alias("kind"), F.col("item_id").alias("id"), "text")
    return texts.unionByName(against).repartition("row").sortWithinPartitions("row", "kind", "id").mapInArrow(lambda b: _tiled(b, seed, least), SCHEMA)
