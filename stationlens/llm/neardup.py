"""MinHash near-dedup (2): multi-index Hamming join of signatures, links confirmed on full sets.

A document's set holds its distinct shingles of ``words`` words (A-Z lower-cased;
words are runs of bytes other than space, tab and line breaks); with fewer words it
holds the whole sequence; without words it is empty and linked with nothing.
Documents with 100 * intersection >= ``percent`` * union are linked.

Documents of equal sets form a class, represented by its least doc_id. A class has
a signature of chunks of b-bit MinHash values. By the pigeonhole principle two
signatures that differ in fewer than chunks * (errors + 1) values have a chunk that
differs in at most ``errors``; so each chunk is listed once for every way to leave
out that many values, and all pairs under that distance meet in a bucket. For
similar sets the chance of a greater distance is about 5e-9 at similarity 0.85 with
6 chunks of 5 and 2 errors, and 1e-7 at 0.8 with 7 chunks.

Buckets of up to ``SMALL`` classes give their pairs under the signature distance and
the size bound. In larger buckets, every class is paired with one of them, the pivot, chosen by the
least hash, so that buckets of one family mostly choose the same. All pairs are confirmed on
the full sets (of 64-bit shingle hashes), and the links make components. Large buckets that
aren't one component yet and share classes make a family. A family of up to ``SIGNED`` classes is compared
by signatures as a whole; the buckets of a larger one are compared each, what is outside the largest component
with each other and with it, in blocks of about ``SIGNED`` classes, and a pair counts in the first
bucket that it shares. Only classes with pairs under the distance that no links connect send their texts, to blocks of
about ``GROUP``, where links found so far spare others. So a family of near copies sends its texts a
few times, however many buckets hold it. Components are found by star contraction.

Rows that repeat a doc_id count as one document with the links of all its texts. A
row without doc_id is linked with nothing and kept. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from . import kernels as K
from . import shared

SMALL = 48
GROUP = 1024
SIGNED = 8192


@dataclass(frozen=True)
class Scheme:
    words: int = 3
    percent: int = 85
    chunks: int = 4
    values: int = 5
    errors: int = 2

    @property
    def slots(self) -> int:
        return self.chunks * self.values

    @property
    def distance(self) -> int:
        return self.chunks * (self.errors + 1) - 1

    @property
    def indexes(self) -> list[tuple[int, ...]]:
        """The values that each bucket key is made of."""
        return [tuple(c * self.values + v for v in kept) for c in range(self.chunks) for kept in combinations(range(self.values), self.values - self.errors)]


def sets(texts: list[bytes | None], words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, buffer, doc_starts, _ in K.blocks(texts):
        buffer = K.LOWER[buffer]
        starts, ends, first = K.words(buffer, doc_starts)
        codes = K.word_hashes(buffer, starts, ends)
        sums = K.prefix_sums(codes)
        at = np.arange(max(0, len(codes) - words + 1))
        grams = K.range_hash(sums, at, at + words)
        for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
            if hi - lo >= words:
                yield np.unique(grams[lo : hi - words + 1])
            elif hi > lo:
                yield K.range_hash(sums, np.array([lo]), np.array([hi]))
            else:
                yield np.zeros(0, K.U)


def signature(found: np.ndarray, slots: int) -> np.ndarray:
    return np.array([K.mix(found, 10 + s).min() >> K.U(48) for s in range(slots)], dtype=np.uint16)


def _sign(batches: Iterator[pa.RecordBatch], scheme: Scheme) -> Iterator[pa.RecordBatch]:
    shared.kept("neardup")
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            n, one, two, slots = [], [], [], []
            for found in sets(shared.binaries(part.column(1)), scheme.words):
                n.append(len(found))
                one.append(int(K.mix(found, 1).sum(dtype=K.U).astype(np.int64)))
                two.append(int(K.mix(found, 2).sum(dtype=K.U).astype(np.int64)))
                slots.append(signature(found, scheme.slots).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(slots, pa.binary())], names=["doc_id", "n", "h1", "h2", "slots"])


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


class _Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x


def _confirm(batches: Iterator[pa.RecordBatch], scheme: Scheme) -> Iterator[pa.RecordBatch]:
    """Links of the groups: with a star's centres (part < 0), or of two blocks of the bucket of key ``part``."""
    shared.kept("neardup")
    for gid, rows in shared.runs(batches, "gid"):
        ids = rows.column("doc_id").to_pylist()
        part = rows.column("part")[0].as_py()
        side = rows.column("side").to_numpy()
        found = list(sets(shared.binaries(rows.column("text")), scheme.words))
        links: list[tuple[int, int]] = []
        if part < 0:
            centres = np.flatnonzero(side == 0).tolist()
            links = [(ids[c], ids[k]) for k in np.flatnonzero(side == 1).tolist() for c in centres if _similar(found[c], found[k], scheme.percent)]
        elif len(ids) > 1:
            links = [(ids[a], ids[b]) for a, b in _block_links(found, side, rows.column("comp").to_numpy(), part, scheme)]
        links = [(a, b) for a, b in links if a != b]
        if links:
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], names=["a", "b"])


def _wanted(slots: np.ndarray, size: np.ndarray, component: np.ndarray, left: np.ndarray, right: np.ndarray, part: int, scheme: Scheme) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(left, right, distance) of pairs near enough that the bucket of key ``part`` is the first to hold and no links connect."""
    for at in range(0, len(left), 64):
        here = left[at : at + 64]
        same = slots[here][:, None, :] == slots[right][None, :, :]
        distance = scheme.slots - same.sum(axis=2)
        want = (distance <= scheme.distance) & (100 * np.minimum(size[here][:, None], size[right]) >= scheme.percent * np.maximum(size[here][:, None], size[right]))
        want &= component[here][:, None] != component[right]
        if right is left:
            want &= here[:, None] < right
        for earlier in scheme.indexes[:part]:
            want &= ~same[:, :, list(earlier)].all(axis=2)
        a, b = np.nonzero(want)
        yield here[a], right[b], distance[a, b]


def _parted(which: np.ndarray, ids: np.ndarray) -> list[np.ndarray]:
    """The rows in blocks of about GROUP, by their ids."""
    n = max(1, -(-len(which) // GROUP))
    of = (K.mix(ids[which].astype(K.U), 41) % K.U(n)).astype(np.int64)
    return [which[of == k] for k in range(n) if (of == k).any()]


def _needed(batches: Iterator[pa.RecordBatch], scheme: Scheme) -> Iterator[pa.RecordBatch]:
    """Of the blocks of signatures, what is to be confirmed: the classes with wanted pairs, in blocks of about GROUP."""
    shared.kept("neardup")
    for gid, rows in shared.runs(batches, "gid"):
        part = rows.column("part")[0].as_py()
        side, ids, component, size = (rows.column(c).to_numpy() for c in ("side", "doc_id", "comp", "n"))
        slots = np.frombuffer(b"".join(rows.column("slots").to_pylist()), dtype=np.uint16).reshape(len(ids), scheme.slots)
        lefts = _parted(np.flatnonzero(side == 0), ids)
        rights = _parted(np.flatnonzero(side == 1), ids)
        for i, left in enumerate(lefts):
            for j, right in enumerate(rights or lefts[i:]):
                found = list(_wanted(slots, size, component, left, right, part, scheme))
                a, b = (np.unique(np.concatenate([f[k] for f in found])) for k in (0, 1)) if found else ((), ())
                if not len(a):
                    continue
                number = int(K.mix(np.array([gid], np.int64).view(K.U) + K.U(i << 20 | j), 43).view(np.int64)[0])
                which = np.union1d(a, b) if right is left else np.concatenate([a, b])
                sides = np.zeros(len(which), np.int32) if right is left else np.repeat(np.array([0, 1], np.int32), [len(a), len(b)])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(which), number)), pa.array(np.full(len(which), part, np.int32)), pa.array(sides), pa.array(ids[which]), pa.array(component[which])], names=["gid", "part", "side", "doc_id", "comp"])


def _block_links(found: list[np.ndarray], side: np.ndarray, component: np.ndarray, part: int, scheme: Scheme) -> Iterator[tuple[int, int]]:
    slots = np.stack([signature(x, scheme.slots) for x in found])
    size = np.array([len(x) for x in found])
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1) if (side == 1).any() else left
    met = [np.stack(f) for f in _wanted(slots, size, component, left, right, part, scheme)]
    a, b, distance = np.concatenate(met, axis=1)
    _, component = np.unique(component, return_inverse=True)
    groups = _Union(len(found))  # of components
    for k in np.argsort(distance, kind="stable").tolist():
        x, y = int(a[k]), int(b[k])
        p, q = groups.find(int(component[x])), groups.find(int(component[y]))
        if p != q and _similar(found[x], found[y], scheme.percent):
            groups.up[p] = q
            yield x, y


def _differing(scheme: Scheme):
    """How many values of the signatures x and y differ."""
    return sum((F.expr(f"int(substring(x.slots, {2 * s + 1}, 2) <> substring(y.slots, {2 * s + 1}, 2))") for s in range(scheme.slots)), F.lit(0))


def _open_blocks(large: DataFrame, found: DataFrame, scratch: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """gid, part, side, doc_id, comp, n and slots of the pairs of blocks in which large buckets may hold links between components."""
    placed = large.join(found, large["rep"] == found["node"], "left").select("bucket", "part", F.col("rep").alias("doc_id"), "n", "slots", F.coalesce("component", "rep").alias("comp"))
    placed = scratch(placed, "placed")
    sizes = placed.groupBy("bucket", "comp").agg(F.count("*").alias("k"))
    main = sizes.groupBy("bucket").agg(F.max(F.struct("k", "comp")).alias("m"), F.sum("k").alias("g")).where("g > m.k")
    main = scratch(main.select("bucket", "g", F.col("m.comp").alias("main"), F.col("m.k").alias("n_main"), (F.col("g") - F.col("m.k")).alias("n_others")), "main")
    both = scratch(placed.join(main, "bucket"), "open")
    heads = both.groupBy("bucket").agg(F.min("doc_id").alias("head"))
    family = scratch(components(both.join(heads, "bucket").select(F.col("doc_id").alias("a"), F.col("head").alias("b"))), "families")
    whole = scratch(family.groupBy("component").agg(F.count("*").alias("classes")).where(f"classes <= {SIGNED}").select("component"), "whole")
    of_family = family.join(whole, "component").select(F.col("node").alias("doc_id"), F.col("component").alias("family"))
    signed = both.groupBy("doc_id").agg(F.first("n").alias("n"), F.first("slots").alias("slots"), F.first("comp").alias("comp")).join(of_family, "doc_id")
    n_blocks = lambda n: F.ceil(F.col(n) / SIGNED).cast("long")
    own = lambda n: F.pmod(F.xxhash64("doc_id", F.lit(7)), n_blocks(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n_blocks(n) - 1))
    dealt = lambda rows, gid, side: rows.select(gid.alias("gid"), "part", side.alias("side"), "doc_id", "comp", "n", "slots")
    one = dealt(signed.withColumn("part", F.lit(0)), F.xxhash64("family", F.lit("family")), F.lit(0))
    more = both.join(of_family.select("doc_id"), "doc_id", "left_anti")
    others, mains = more.where("comp <> main"), more.where("comp = main")
    among = others.withColumn("here", own("n_others")).withColumn("there", every("n_others"))
    among = dealt(among, F.xxhash64("bucket", F.least("here", "there"), F.greatest("here", "there")), F.when(F.col("here") > F.col("there"), 1).otherwise(0))
    gid = F.xxhash64("bucket", F.lit("main"), "here", "there")
    left = dealt(others.withColumn("here", own("n_others")).withColumn("there", every("n_main")), gid, F.lit(0))
    right = dealt(mains.withColumn("there", own("n_main")).withColumn("here", every("n_others")), gid, F.lit(1))
    return one.unionByName(among).unionByName(left).unionByName(right)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", scheme: Scheme = Scheme()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, of each row."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    held: list[DataFrame] = []

    def scratch(df: DataFrame, name: str) -> DataFrame:
        """A written table that goes when the components are known."""
        held.append(shared.materialize(df, name))
        return held[-1]

    signed = shared.materialize(rows.mapInArrow(lambda b: _sign(b, scheme), "doc_id long, n long, h1 long, h2 long, slots binary"), "signed")
    classes = shared.materialize(signed.where("n > 0 and doc_id is not null").groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("rep"), F.min("slots").alias("slots")), "classes")

    keys = [F.xxhash64(F.lit(i), *(F.expr(f"substring(slots, {2 * s + 1}, 2)") for s in kept)) for i, kept in enumerate(scheme.indexes)]
    listed = classes.select("rep", F.posexplode(F.array(*keys)).alias("part", "bucket"))
    shared_buckets = listed.groupBy("bucket").agg(F.count("*").alias("g")).where("g > 1")
    members = listed.join(shared_buckets, "bucket").join(classes.select("rep", "n", "slots"), "rep")
    members = scratch(members, "members")

    close = (100 * F.least("x.n", "y.n") >= scheme.percent * F.greatest("x.n", "y.n")) & (_differing(scheme) <= scheme.distance)
    small = members.where(f"g <= {SMALL}").select("bucket", "rep", "n", "slots")
    met = small.alias("x").join(small.alias("y"), (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.rep") < F.col("y.rep")))
    pairs = met.where(close).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"), F.lit(0).cast("long").alias("piece"))

    large = members.where(f"g > {SMALL}")
    # written, so that the join has an exchange on either side and AQE can split a bucket of many
    pivots = scratch(large.groupBy("bucket").agg(F.min(F.struct(F.xxhash64("rep"), "rep", "n", "slots")).alias("p")).select("bucket", "p.rep", "p.n", "p.slots"), "pivots")
    met = pivots.alias("x").join(large.alias("y"), (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.rep") != F.col("y.rep")))
    # a pivot's star is dealt in pieces of about GROUP classes; a class is in the same one in all buckets of about its size
    piece = F.pmod(F.xxhash64("y.rep", F.lit(7)), F.pow(F.lit(2.0), F.ceil(F.log2(F.col("y.g") / GROUP + 1))).cast("long"))
    pairs = scratch(pairs.unionByName(met.where(close).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"), piece.alias("piece"))).groupBy("a", "b").agg(F.min("piece").alias("piece")), "pairs")
    star = pairs.select(F.xxhash64("a", "piece").alias("gid"), "a", "b")
    stars = star.select("gid", F.lit(-1).alias("part"), F.lit(1).alias("side"), F.col("b").alias("doc_id"), F.lit(0).cast("long").alias("comp"))
    stars = scratch(stars.unionByName(star.select("gid", F.lit(-1).alias("part"), F.lit(0).alias("side"), F.col("a").alias("doc_id"), F.lit(0).cast("long").alias("comp")).distinct()), "stars")

    def confirmed(groups: DataFrame) -> DataFrame:
        # what is to be confirmed grows with the input, so texts are always dealt by id
        with_text = rows.join(groups.hint("merge"), "doc_id").select("gid", "part", "side", "doc_id", "comp", "text")
        into = max(int(spark.conf.get("spark.sql.shuffle.partitions")), groups.count() // 2000)
        return with_text.repartition(into, "part", "gid").sortWithinPartitions("part", "gid", "doc_id").mapInArrow(lambda b: _confirm(b, scheme), "a long, b long")

    found = scratch(components(confirmed(stars)), "components")
    signatures = _open_blocks(large, found, scratch).repartition("part", "gid").sortWithinPartitions("part", "gid")
    dealt = scratch(signatures.mapInArrow(lambda b: _needed(b, scheme), "gid long, part int, side int, doc_id long, comp long"), "blocks")
    if not dealt.isEmpty():
        found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(confirmed(dealt)))
    found = shared.materialize(found, "found")
    shared.discard(*held)

    of_class = classes.join(found, F.col("rep") == F.col("node"), "left").select("h1", "h2", "n", F.coalesce("component", "rep").alias("component_id"))
    out = signed.join(of_class, ["h1", "h2", "n"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("c"))
    # a doc_id that is repeated belongs to the component of all its rows
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.col("c")).alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
