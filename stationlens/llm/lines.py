"""Line dedup (1): content-defined chunks of lines, removed where they repeat. DataFrame functions only.

A line's hash is the first 32 bits of its MD5. A rolling hash over the last
``WINDOW`` line hashes ends a chunk after a line where it falls into a quarter of its
range and didn't at the line before, so a chunk's bounds depend on the lines around
them alone, and lines that are put in or taken out move no bounds further on. A chunk has two lines at
least, but where the document has one, and at most ``MOST`` (longer ones are split
from their start).

A chunk of two lines or more that occurs anywhere else is kept where it occurs
first, by document and line, and removed elsewhere. Candidates are found by 128 bits
of hash and then compared byte by byte with the first occurrence.

Lines end at newlines; a carriage return belongs to its line. A null text has no
lines and stays null; an empty text has one empty line. A text whose lines all go
becomes empty. Rows without doc_id come after all others. Rows of one doc_id (or
without one) and different texts are documents of their own, in the order of a hash of
the text; rows that repeat both count as the same place and are kept or removed alike.
An empty table gives no rows.
Other columns than the id and the text aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared
from .shared import let

WINDOW = 3
#: The rolling hash is taken by this modulus; the last coefficient is that of the oldest line.
MODULUS, QUARTER, FACTORS = 1009, 252, (1, 31, 961)
MOST = 32


def chunks(text: str) -> Column:
    """The line hashes of a text, and its chunks (start and end of lines)."""

    def of_hashes(hashes: Column) -> Column:
        rolling = lambda h, i: sum((F.lit(f) * (F.coalesce(F.get(hashes, i - k), F.lit(0)) if k else h) for k, f in enumerate(FACTORS)), F.lit(0))
        low = F.transform(hashes, lambda h, i: F.pmod(rolling(h, i), F.lit(MODULUS)) < QUARTER)
        return let(low, lambda low: of_low(hashes, low))

    def of_low(hashes: Column, low: Column) -> Column:
        n = F.size(hashes)
        is_end = lambda e: (e == n) | ((e >= 2) & (e <= n - 2) & F.get(low, e - 1) & ((e < 3) | ~F.get(low, e - 2)))
        return let(F.filter(F.sequence(F.lit(1), n), is_end), lambda ends: F.struct(hashes.alias("hashes"), of_ends(ends).alias("chunks")))

    def of_ends(ends: Column) -> Column:
        start = lambda k: F.coalesce(F.get(ends, k - 1), F.lit(0))
        pieces = lambda e, k: F.transform(F.sequence(start(k), e - 1, F.lit(MOST)), lambda s: F.struct(s.alias("start"), F.least(s + MOST, e).alias("end")))
        return F.flatten(F.transform(ends, pieces))

    line_hash = lambda line: F.conv(F.substring(F.md5(line.cast("binary")), 1, 8), 16, 10).cast("long")
    return let(F.transform(_lines(text), line_hash), of_hashes)


def _lines(text: str) -> Column:
    return F.split(text, "\n", -1)


def _without(removed: Column) -> Column:
    """What is left of the text without the lines of some chunks."""

    def of(lines: Column) -> Column:
        inside = F.filter(removed, lambda r: r["end"] <= F.size(lines))
        index = F.flatten(F.transform(inside, lambda r: F.sequence(r["start"], r["end"] - 1)))
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), index)
        return let(left, lambda left: F.struct(F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n").alias("text"), F.size(lines).cast("long").alias("n_lines"), (F.size(lines) - F.size(left)).cast("long").alias("n_removed")))

    return let(_lines("text"), of)


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text (what is kept), n_lines, n_removed and chunks_removed, of each row, and the columns ``carry``."""
    # a document is told by its id and 128 bits of hash of its text
    row = ["doc_id", "t1", "t2"]
    whole = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"), *(F.col(f"`{c}`").alias(f"carried_{i}") for i, c in enumerate(carry)))
    whole = whole.withColumns({"t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit(1), "text")})
    rows = whole.select(*row, "text")
    same_row = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["t1"] == b["t1"]) & (a["t2"] == b["t2"])
    place = F.struct(F.col("doc_id").isNull().alias("last"), *row, "start")

    found = rows.where(F.col("text").contains("\n")).select(*row, chunks("text").alias("c")).select(*row, "c.hashes", F.explode("c.chunks").alias("c")).where("c.end - c.start >= 2")
    found = found.select(*row, "c.start", "c.end", F.expr("slice(hashes, c.start + 1, c.end - c.start)").alias("h")).select(*row, "start", "end", F.xxhash64("h").alias("h1"), F.xxhash64(F.lit(1), "h").alias("h2"))
    # written, so that the join has an exchange on either side and AQE can split the rows of a frequent chunk
    again = shared.materialize(found.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1"), "again")
    candidates = found.join(again, ["h1", "h2"]).withColumn("is_first", place.eqNullSafe(F.col("first")))
    by_document = shared.materialize(candidates.groupBy(*row).agg(F.collect_set(F.struct("start", "end", "h1", "h2", "is_first")).alias("marks")), "marks")

    # byte comparison: only documents with candidates give their chunks' text
    one = lambda lines, m: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["h1"].alias("h1"), m["h2"].alias("h2"), m["is_first"].alias("is_first"), F.array_join(F.slice(lines, m["start"] + 1, m["end"] - m["start"]), "\n").alias("chunk"))
    marked = let(_lines("text"), lambda lines: F.transform(F.filter("marks", lambda m: m["end"] <= F.size(lines)), lambda m: one(lines, m)))
    texts = rows.join(by_document.hint("merge"), same_row(rows, by_document)).select(*(rows[c] for c in row), F.explode(marked).alias("m")).select(*row, "m.*")
    texts = shared.materialize(texts, "chunks")
    first = texts.where("is_first").groupBy("h1", "h2").agg(F.min("chunk").alias("of_first"))
    same = texts.where("not is_first").join(first, ["h1", "h2"]).where("chunk = of_first")
    gone = shared.materialize(same.groupBy(*row).agg(F.collect_set(F.struct("start", "end")).alias("removed")), "removed")
    shared.discard(again, by_document, texts)

    carried = [f"carried_{i}" for i in range(len(carry))]
    joined = whole.join(gone.hint("merge"), same_row(whole, gone), "left").select(whole["doc_id"], "text", "removed", *carried)
    all_kept = F.struct("text", F.coalesce(F.size(_lines("text")), F.lit(0)).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_removed"))
    no_lines = F.struct("text", F.lit(0).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_removed"))
    kept = F.when(F.col("text").isNull(), no_lines).when(F.col("removed").isNotNull(), _without(F.col("removed"))).otherwise(all_kept)
    return joined.select("doc_id", kept.alias("kept"), F.coalesce(F.when(F.col("removed").isNotNull(), F.size("removed")), F.lit(0)).cast("long").alias("chunks_removed"), *carried).select("doc_id", "kept.*", "chunks_removed", *(F.col(a).alias(c) for a, c in zip(carried, carry)))


#: DuckDB SQL for the rows of op1, with the chunks compared by their text.
SQL = f"""
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL),
line AS (SELECT doc_id, len(lines) AS n, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM split),
hashed AS (SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h FROM line),
rolled AS (SELECT *, ({FACTORS[0]} * h + {FACTORS[1]} * coalesce(lag(h, 1) OVER w, 0) + {FACTORS[2]} * coalesce(lag(h, 2) OVER w, 0)) % {MODULUS} < {QUARTER} AS low
  FROM hashed WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
ended AS (SELECT *, i + 1 AS e, low AND coalesce(NOT (lag(low) OVER w) OR i + 1 < 3, true) AS starts_run FROM rolled WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
ends AS (SELECT *, e = n OR (e >= 2 AND e <= n - 2 AND starts_run) AS is_end FROM ended),
numbered AS (SELECT *, coalesce(sum(is_end::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM ends),
placed AS (SELECT *, (i - min(i) OVER (PARTITION BY doc_id, c)) // {MOST} AS piece FROM numbered),
chunk AS (SELECT doc_id, c, piece, min(i) AS start, count(*) AS size, string_agg(line, chr(10) ORDER BY i) AS chunk FROM placed GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY chunk, size ORDER BY doc_id, start) AS rn FROM chunk),
kept AS (SELECT p.doc_id, count(*) AS n_lines, sum((r.size >= 2 AND r.rn > 1)::INT) AS n_removed,
    count(DISTINCT CASE WHEN r.size >= 2 AND r.rn > 1 THEN r.start END) AS chunks_removed,
    coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT (r.size >= 2 AND r.rn > 1)), '') AS text
  FROM placed p JOIN ranked r USING (doc_id, c, piece) GROUP BY p.doc_id)
SELECT d.doc_id, coalesce(k.n_lines, 0)::BIGINT AS n_lines, coalesce(k.n_removed, 0)::BIGINT AS n_removed,
  coalesce(k.chunks_removed, 0)::BIGINT AS chunks_removed, sha256(k.text) AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id)
"""
