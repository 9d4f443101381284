"""Pairs of stations that play one song in a round, by blocks of stations.

Stations are dealt over blocks by hash. A task gets two blocks, packed, and makes all pairs
between them with their counts, so pairs are never shuffled: each observation is, once for each block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialize

#: Agreements of a task, and observations of a block, that are aimed at; bytes of bitmaps of a task at most.
TASK_AGREEMENTS, BLOCK_ROWS, BITMAP_BYTES = 8_000_000, 500_000, 64 << 20
#: Agreements and pairs that are held at a time, and rows of a block for which more tasks don't pay.
HELD, PIECE, LEAST_ROWS = 1 << 20, 1 << 16, 5_000


def _packed(rows: pa.Table) -> pa.Table:
    """A block in one value: columns as dictionaries, compressed."""
    held = rows.select(["uuid", "round", "song"]).sort_by([("uuid", "ascending"), ("round", "ascending")]).combine_chunks()
    held = pa.table({c: held.column(c).combine_chunks().dictionary_encode() for c in held.column_names})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, held.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(held)
    return pa.table({"block": rows.column("block").slice(0, 1).combine_chunks(), "packed": pa.array([sink.getvalue().to_pybytes()], pa.binary())})


def _ranked(column: pa.ChunkedArray):
    """The sorted distinct values of a column of dictionaries, and each row's place among them; -1 for null."""
    import numpy as np
    import pyarrow.compute as pc

    plain = column.cast(column.type.value_type).combine_chunks()
    coded = (pa.concat_arrays(plain.chunks) if isinstance(plain, pa.ChunkedArray) else plain).dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    place = np.empty(len(order) + 1, np.int64)
    place[order.to_numpy()], place[-1] = np.arange(len(order)), -1
    return coded.dictionary.take(order), place[coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)]


def _common(u, r, n_u: int, n_r: int, bitmap_bytes: int):
    """A function of (a, b, first): the rounds, from the first on, in which both stations play.

    Bitmaps of rounds; where these would be large, a's rounds are looked up among b's.
    """
    import numpy as np

    words = (n_r + 63) // 64
    if n_u * words * 8 <= bitmap_bytes:
        bits = np.zeros((words, n_u), np.uint64)
        np.bitwise_or.at(bits, (r >> 6, u), np.uint64(1) << (r & 63).astype(np.uint64))
        full = np.uint64(0xFFFFFFFFFFFFFFFF)

        def by_bits(a, b, first):
            out = np.zeros(len(a), np.int64)
            for k in range(0, len(a), PIECE):
                x, y, f = a[k : k + PIECE], b[k : k + PIECE], first[k : k + PIECE]
                word, since = f >> 6, full << (f & 63).astype(np.uint64)
                for w in range(int(word.min()), words):
                    both = bits[w][x] & bits[w][y] & np.where(word < w, full, np.where(word == w, since, np.uint64(0)))
                    out[k : k + PIECE] += np.bitwise_count(both)
            return out

        return by_bits

    plays = np.unique(u * n_r + r)
    ends = np.searchsorted(plays, (np.arange(n_u) + 1) * n_r)

    def by_lookup(a, b, first):
        out = np.zeros(len(a), np.int64)
        lo = np.searchsorted(plays, a * n_r + first)
        many = ends[a] - lo
        done = np.cumsum(many)
        cut = np.flatnonzero(np.diff(done // HELD, prepend=-1))
        for p, q in zip(cut, [*cut[1:], len(a)]):
            k = many[p:q]
            pair = np.repeat(np.arange(p, q), k)
            at = np.arange(k.sum()) + np.repeat(lo[p:q] - (np.cumsum(k) - k), k)
            wanted = plays[at] + (b[pair] - a[pair]) * n_r
            found = np.searchsorted(plays, wanted)
            hit = plays[np.minimum(found, len(plays) - 1)] == wanted
            out[p:q] = np.bincount(pair[hit] - p, minlength=q - p)
        return out

    return by_lookup


def _pairs(blocks: list[pa.Table], min_same: int, min_agreement: float, bitmap_bytes: int) -> Iterator[pa.RecordBatch]:
    """All pairs between two blocks, or within one, that agree often enough."""
    import numpy as np

    whole = pa.concat_tables(blocks, promote_options="permissive")
    (stations, u), (rounds, r), (songs, s) = (_ranked(whole.column(c)) for c in ("uuid", "round", "song"))
    n_u, n_r = len(stations), len(rounds)
    common = _common(u, r, n_u, n_r, bitmap_bytes)
    slot = np.unique(np.where(s < 0, -1, r * len(songs) + s), return_inverse=True)[1].astype(np.int64)
    named = s >= 0
    mine = np.arange(len(u)) < len(blocks[0])
    x, y = np.flatnonzero(named & mine), np.flatnonzero(named & (mine if len(blocks) == 1 else ~mine))
    x, y = x[np.argsort(u[x], kind="stable")], y[np.lexsort((u[y], slot[y]))]
    ux, rx, uy = u[x], r[x], u[y]
    hi = np.searchsorted(slot[y], slot[x], "right")
    lo = np.searchsorted(slot[y] * n_u + uy, slot[x] * n_u + ux, "right") if len(blocks) == 1 else np.searchsorted(slot[y], slot[x], "left")
    many = hi - lo
    before = np.cumsum(many) - many
    # all agreements of a station are held together, those of several up to HELD
    start = np.flatnonzero(np.diff(ux, prepend=-1))
    cut = start[np.flatnonzero(np.diff(before[start] // HELD, prepend=-1))] if len(x) else start
    shift = max(1, int(n_r - 1).bit_length())
    for p, q in zip(cut, [*cut[1:], len(x)]):
        k = many[p:q]
        if not (total := int(k.sum())):
            continue
        left, right = np.repeat(ux[p:q], k), uy[np.arange(total) + np.repeat(lo[p:q] - (before[p:q] - before[p]), k)]
        met = np.minimum(left, right) * n_u + np.maximum(left, right)
        met = (met << shift) | np.repeat(rx[p:q], k)
        met.sort()
        met = met[np.diff(met, prepend=-1) != 0]  # two songs of one round agree once
        pair = met >> shift
        begin = np.flatnonzero(np.diff(pair, prepend=-1))
        same = np.diff(begin, append=len(pair))
        end = begin + same - 1
        if min_same > 1:
            good = same >= min_same
            begin, end, same = begin[good], end[good], same[good]
        a = pair[begin] // n_u
        b = pair[begin] - a * n_u
        low = (1 << shift) - 1
        first, last = met[begin] & low, met[end] & low
        both = common(a, b, first)
        if min_agreement > 0:
            good = same / both >= min_agreement
            a, b, same, both, first, last = a[good], b[good], same[good], both[good], first[good], last[good]
        for k in range(0, len(a), PIECE):
            at = slice(k, k + PIECE)
            yield pa.RecordBatch.from_arrays(
                [stations.take(pa.array(a[at])), stations.take(pa.array(b[at])), pa.array(same[at]), pa.array(both[at]), rounds.take(pa.array(first[at])), rounds.take(pa.array(last[at]))],
                ["a", "b", "same", "both", "first", "last"],
            )


def agreements(seen: DataFrame, min_same: int = 1, min_agreement: float = 0.0, task_agreements: int = TASK_AGREEMENTS, block_rows: int = BLOCK_ROWS, bitmap_bytes: int = BITMAP_BYTES) -> DataFrame:
    """(a, b, same, both, first, last) of the pairs of ``seen``: uuid, round and song, distinct, without null stations and rounds."""
    seen = materialize(seen, "seen")
    slots = seen.groupBy("round", "song").agg(F.count("*").alias("n"))
    n, met = slots.agg(F.sum("n"), F.sum(F.when(F.col("song").isNotNull(), F.col("n") * (F.col("n") - 1.0) / 2))).first()
    n, met = n or 0, met or 0
    spread = min(math.sqrt(2 * seen.sparkSession.sparkContext.defaultParallelism), n / LEAST_ROWS)
    blocks = math.ceil(max(1, math.sqrt(2 * met / task_agreements), n / block_rows, spread))
    dealt = seen.withColumn("block", F.pmod(F.xxhash64("uuid"), F.lit(blocks))).groupBy("block").applyInArrow(_packed, "block long, packed binary")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    sent = dealt.select("block", "packed", other.alias("other")).select(F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "packed")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        i, j, packed = (sum((b.column(c).to_pylist() for b in parts), []) for parts in [list(batches)] for c in ("i", "j", "packed"))
        if len(packed) == (1 if i[0] == j[0] else 2):  # else no station is in one of the blocks
            yield from _pairs([pa.ipc.open_stream(p).read_all() for p in packed], min_same, min_agreement, bitmap_bytes)

    kind = {f.name: f.dataType.simpleString() for f in seen.schema}
    shape = f"a {kind['uuid']}, b {kind['uuid']}, same long, both long, first {kind['round']}, last {kind['round']}"
    return sent.repartition(blocks * (blocks + 1) // 2, "i", "j").groupBy("i", "j").applyInArrow(meet, shape)
