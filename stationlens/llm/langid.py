"""Language ID (6): nearest of several TF-IDF centroids per language, by cosine.

Features are hashed n-grams (1 to 3 letters, word breaks included) of the whole
lower-cased text; a text's vector is log-scaled counts times inverse document
frequency, of unit length. Each language has up to ``CLUSTERS`` centroids from
spherical k-means. The prediction is the language of the nearest centroid; a text
further from it than nearly all of that language's own training texts are from
theirs is marked as rejected. How near those are depends on the length: below
``LETTERS`` letters the cosine that is asked for comes from training texts cut to
``LENGTHS`` letters, and lies between two lengths in proportion to their logarithms.
A short text with tokens (words of 16 characters or more with a digit) is rejected if
what else it has is.

The model is fitted on a bounded sample: at most about ``SAMPLE`` labelled texts of
each language, chosen by a hash of the id. Everything else covers every row. A text
that is null or has no letter gets ``und`` with score 0, and counts as rejected.
Without any labelled text the prediction is ``und`` for all.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

DIM = 4096
SAMPLE = 500
CLUSTERS = 4
#: Texts of so many letters at least are held against whole training texts, shorter ones against cut ones.
LETTERS = 200
#: Letters to which training texts are cut.
LENGTHS = (2, 4, 8, 16, 32, 64, 128, LETTERS)
#: A text is rejected beyond this share of the cosine that the least typical training texts reach.
SLACK = 0.6
UNKNOWN = "und"
#: Keys and the like, which would hide the language of a short text.
TOKEN = re.compile(r"\b(?=\w*\d)\w{16,}")

_classes: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _classes
    if _classes is None:
        _classes = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    return _classes


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed n-grams (texts x DIM) and the number of letters of each text."""
    lowered = [(t or "").lower() for t in texts]
    counts = np.zeros((len(texts), DIM), dtype=np.float32)
    letters = np.zeros(len(texts), dtype=np.int64)
    at = 0
    while at < len(lowered):
        upto, size = at, 0
        while upto < len(lowered) and (upto == at or size + len(lowered[upto]) < 1 << 19) and upto - at < 512:
            size += len(lowered[upto]) + 2
            upto += 1
        joined = " " + "  ".join(lowered[at:upto]) + " "
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        lengths = np.fromiter(map(len, lowered[at:upto]), dtype=np.int64, count=upto - at)
        doc = np.repeat(np.arange(upto - at), lengths + 2)
        is_letter = _letters()[codes]
        letters[at:upto] = np.bincount(doc[is_letter], minlength=upto - at)
        keep = is_letter | np.concatenate([[False], is_letter[:-1]])  # letters and the first break after them
        codes = np.where(is_letter, codes, 0x20)[keep].astype(np.uint64)
        doc = doc[keep]
        is_letter = is_letter[keep]
        grams = codes
        for n in (1, 2, 3):
            if n > 1:
                grams = grams[:-1] * np.uint64(0x100000001B3) + codes[n - 1 :]
                same = doc[: len(grams)] == doc[n - 1 :]
            else:
                same = is_letter
            hashed = ((grams * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(52)
            place = doc[: len(grams)][same] * DIM + hashed[same].astype(np.int64)
            counts[at:upto] += np.bincount(place, minlength=(upto - at) * DIM).reshape(-1, DIM)
        at = upto
    return counts, letters


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    out = np.log1p(counts) * idf
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out / np.where(norm == 0, 1, norm)


@dataclass
class Model:
    languages: list[str]  # of each centroid
    idf: np.ndarray
    centroids: np.ndarray
    floor: np.ndarray  # least cosine that isn't rejected, of each centroid
    short: np.ndarray  # the same for texts of each of LENGTHS letters (centroids x LENGTHS)


def cuts(text: str | None) -> list[str | None]:
    """For each of LENGTHS, a piece of the text with so many letters, from a place that the text decides; None where it has fewer."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    at = np.flatnonzero(_letters()[codes])
    lowered = (text or "").lower()
    first = zlib.crc32(codes.tobytes())
    out: list[str | None] = []
    for n in LENGTHS:
        k = first % (len(at) - n + 1) if len(at) >= n else None
        out.append(None if k is None else lowered[at[k] : at[k + n - 1] + 1])
    return out


def _cluster(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts from the first row, then from the row furthest from those chosen."""
    chosen = [0]
    near = x @ x[0]
    while len(chosen) < min(k, len(x)):
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[chosen[-1]])
    centres = x[chosen]
    for _ in range(rounds):
        own = np.argmax(x @ centres.T, axis=1)
        sums = np.stack([x[own == j].sum(axis=0) if (own == j).any() else centres[j] for j in range(len(centres))])
        centres = sums / np.maximum(np.sqrt((sums * sums).sum(axis=1, keepdims=True)), 1e-12)
    return centres


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", sample: int = SAMPLE, clusters: int = CLUSTERS) -> Model:
    """The model from rows with a text and a label, on a bounded sample of each label."""
    rows = labelled.where(F.col(text).isNotNull() & F.col(label).isNotNull()).select(F.col(label).cast("string").alias("lang"), F.col(key).cast("string").alias("k"), F.col(text).alias("text"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], np.ones(DIM, np.float32), np.zeros((0, DIM), np.float32), np.zeros(0, np.float32), np.zeros((0, len(LENGTHS)), np.float32))
    share = F.coalesce(*[F.when(F.col("lang") == lang, F.lit(min(1.0, 1.0 * sample / n))) for lang, n in sorted(sizes.items())])
    place = F.pmod(F.xxhash64(F.coalesce("k", F.lit(""))), F.lit(1 << 20)) / F.lit(float(1 << 20))

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared.kept("langid")
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column("text").to_pylist()
                for cut, of_cut in enumerate([texts, *zip(*map(cuts, texts))]):  # 0 are the whole texts
                    use = [i for i, t in enumerate(of_cut) if cut == 0 or t is not None]
                    counts, letters = features([of_cut[i] for i in use])
                    rows = [np.flatnonzero(c) for c in counts]
                    yield pa.RecordBatch.from_arrays(
                        [part.column("lang").take(pa.array(use, pa.int64())), pa.array([r.astype(np.uint16).tobytes() for r in rows], pa.binary()), pa.array([c[r].tobytes() for c, r in zip(counts, rows)], pa.binary()), pa.array(letters), pa.array([cut] * len(use), pa.int32())],
                        names=["lang", "at", "counts", "letters", "cut"],
                    )

    sample_rows = shared.materialize(rows.where(place < share).mapInArrow(sparse, "lang string, at binary, counts binary, letters long, cut int"), "langid")

    def dense(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        out = np.zeros((table.num_rows, DIM), np.float32)
        for i, (a, c) in enumerate(zip(table.column("at").to_pylist(), table.column("counts").to_pylist())):
            out[i, np.frombuffer(a, np.uint16)] = np.frombuffer(c, np.float32)
        return out, table.column("letters").to_numpy()

    def frequency(table: pa.Table) -> pa.Table:
        counts, _ = dense(table)
        return pa.table({"lang": [table.column("lang")[0].as_py()], "n": [table.num_rows], "df": [(counts > 0).sum(axis=0).astype(np.int64).tobytes()]})

    found = sample_rows.where("cut = 0").groupBy("lang").applyInArrow(frequency, "lang string, n long, df binary").collect()
    total = sum(r["n"] for r in found)
    df = sum(np.frombuffer(r["df"], np.int64) for r in found) if found else np.zeros(DIM)
    idf = np.log((1 + total) / (1 + df)).astype(np.float32) + np.float32(0.1)

    def centres(table: pa.Table) -> pa.Table:
        cut, table = table, table.filter(pc.equal(table.column("cut"), 0))
        order = np.argsort([zlib.crc32(a + c) for a, c in zip(table.column("at").to_pylist(), table.column("counts").to_pylist())], kind="stable")
        counts, letters = dense(table.take(pa.array(order)))
        use = letters > 0
        if not use.any():
            return pa.table({"lang": pa.array([], pa.string()), "centre": pa.array([], pa.binary()), "floor": pa.array([], pa.float64()), "short": pa.array([], pa.list_(pa.float64()))})
        x = vectors(counts[use], idf)
        long = letters[use] >= LETTERS
        found = _cluster(x[long] if long.sum() >= 20 else x, clusters)
        best = (x[long] if long.any() else x) @ found.T
        floor = float(np.quantile(best.max(axis=1), 0.02)) * SLACK
        short = []
        for k in range(1, len(LENGTHS) + 1):
            some = cut.filter(pc.equal(cut.column("cut"), k))
            short.append(min(floor, float(np.quantile((vectors(dense(some)[0], idf) @ found.T).max(axis=1), 0.02)) * SLACK) if some.num_rows else 0.0)
        lang = table.column("lang")[0].as_py()
        return pa.table({"lang": [lang] * len(found), "centre": [c.astype(np.float32).tobytes() for c in found], "floor": [floor] * len(found), "short": [short] * len(found)})

    got = sorted(sample_rows.groupBy("lang").applyInArrow(centres, "lang string, centre binary, floor double, short array<double>").collect(), key=lambda r: (r["lang"], r["centre"]))
    shared.discard(sample_rows)
    return Model([r["lang"] for r in got], idf, np.stack([np.frombuffer(r["centre"], np.float32) for r in got]) if got else np.zeros((0, DIM), np.float32), np.array([r["floor"] for r in got], np.float32), np.array([r["short"] for r in got], np.float32).reshape(-1, len(LENGTHS)))


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of ``df`` and lang_pred, score (the cosine) and rejected, which replace columns of those names."""
    own = [c for c in df.columns if c not in ("lang_pred", "score", "rejected")]
    shape = df.select(*own)
    out = shape.withColumns({"lang_pred": F.lit("").cast("string"), "score": F.lit(0.0), "rejected": F.lit(False)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared.kept("langid")
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lang, score, rejected = label(part.column(own.index(text)).to_pylist(), model)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], names=[*own, "lang_pred", "score", "rejected"])

    return shape.mapInArrow(run, out)


def floors(model: Model, best: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """The least cosine that isn't rejected, for the nearest centroid and the number of letters of each text."""
    size = np.log(np.clip(letters, LENGTHS[0], LETTERS))
    short = np.array([np.interp(x, np.log(LENGTHS), model.short[b]) for x, b in zip(size, best)])
    return np.where(letters >= LETTERS, model.floor[best], short)


def label(texts: list[str | None], model: Model) -> tuple[list[str], list[float], list[bool]]:
    counts, letters = features(texts)
    if not model.languages:
        return [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
    cosine = vectors(counts, model.idf) @ model.centroids.T
    best = np.argmax(cosine, axis=1)
    top = cosine[np.arange(len(texts)), best]
    far = top < floors(model, best, letters)
    again = np.array([i for i in np.flatnonzero(far & (letters < LETTERS) & (letters > 0)) if TOKEN.search(texts[i])], dtype=np.int64)
    if len(again):
        rest, n = features([TOKEN.sub(" ", texts[i]) for i in again])
        near = vectors(rest, model.idf) @ model.centroids.T
        own = np.argmax(near, axis=1)
        far[again] = (n == 0) | (near[np.arange(len(again)), own] < floors(model, own, n))
    none = letters == 0
    lang = [UNKNOWN if n else model.languages[b] for n, b in zip(none, best)]
    score = [0.0 if n else float(min(1.0, max(0.0, s))) for n, s in zip(none, top)]
    return lang, score, (far | none).tolist()
