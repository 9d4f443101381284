"""Document fingerprints (7): SpotSigs. DataFrame functions only.

The lower-cased text is taken as words of letters and digits. Each common word
(``ANCHORS``) opens a chain: the next ``CHAIN`` content words after it, anchors between
them passed over. A chain is a signature, the first 32 bits of its MD5; a text's fingerprint
is its set of signatures, in hexadecimal, ascending. A text with words but no signature
is its own one; a text without words is its own signature too, but the empty text
has the empty set.

Likeness is the Jaccard index of the sets. The next document is found by spans of ids that
hold about ``SPAN`` rows each, whatever the ids' range, and rows without an id by spans of the hash
of their text. For pairs (``alike``), sets are partitioned by length: sets whose lengths differ by more than the threshold allows can't reach it,
and are neither joined nor compared; within a partition candidates share one of the
rarest signatures of either, as many as the threshold leaves open.

A null text counts as empty. Rows that repeat a doc_id follow each other by the hash of
their texts; rows without doc_id come last. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import shared

# Common words of four languages, as any stop word list has them.
ANCHORS = "the of and to is that / der die und den das ist / le la les de et une / el los que en y las".replace("/", "").split()
CHAIN = 2
#: Rows of one window of the neighbour search, about.
SPAN = 512
#: Spans of one window over spans.
SPANS = 4096


_SIGN = "cast(conv(substring(md5(cast({} as binary)), 1, 8), 16, 10) as bigint)"


def signatures(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the sorted distinct signatures of a column that isn't null."""
    words = F.regexp_replace(F.lower(F.col(text)), r"[^\p{L}\p{N}]+", " ")
    marked = F.regexp_replace(F.concat(F.lit(" "), words, F.lit(" ")), f" (?:{'|'.join(ANCHORS)})(?= )", " #")
    tail = "".join(f", ' ', coalesce(get(pieces_, j + {k}), '')" for k in range(1, CHAIN))
    return (
        df.withColumn("cut_", F.split(marked, "#"))
        # what follows an anchor, without anchors that follow anchors
        .withColumn("pieces_", F.expr("filter(transform(slice(cut_, 2, size(cut_)), p -> trim(p)), p -> p <> '')"))
        .withColumn(out, F.expr(f"array_sort(transform(array_distinct(transform(pieces_, (p, j) -> substring_index(trim(concat(p{tail})), ' ', {CHAIN}))), c -> {_SIGN.format('c')}))"))
        .withColumn(out, F.array_distinct(out))
        .withColumn(out, F.when(F.size(out) > 0, F.col(out)).when(F.col(text) == "", F.array().cast("array<bigint>")).otherwise(F.array(F.expr(_SIGN.format(text)))))
        .drop("cut_", "pieces_")
    )


def fingerprint(signs: str) -> Column:
    return F.expr(f"array_join(transform({signs}, s -> lpad(lower(hex(s)), 8, '0')), '')")


def likeness(a: str, b: str) -> Column:
    """The Jaccard index; the intersection is only formed where neither set is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when(F.least(F.size(a), F.size(b)) == 0, F.lit(0.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def _span(docs: DataFrame, key: str) -> Column:
    """The number of a row's span, of doc_id and tie: it falls as rows follow each other by descending id, then by tie among rows without an id."""
    least, most, n, rows = docs.select(F.col(key).cast("long").alias("i")).agg(F.min("i"), F.max("i"), F.count("i"), F.count("*")).first()
    width = max(2, ((most or 0) - (least or 0)) * SPAN // max(n, 1))
    bits = max(0, ((rows - n) // SPAN).bit_length())
    of_null = F.lit(-(1 << 62) - 1) - (F.shiftright("tie", 64 - bits) + (1 << bits >> 1) if bits else F.lit(0))
    return F.coalesce(F.floor(F.col("doc_id") / F.lit(width)), of_null)


def _followers(spans: DataFrame) -> DataFrame:
    """(span, next_span): the next lower one that there is, after the least the greatest."""
    near = spans.select("span", F.floor(F.col("span") / SPANS).alias("upper"))
    below = near.select("span", "upper", F.lead("span").over(W.partitionBy("upper").orderBy(F.desc("span"))).alias("below"))
    # one row for SPANS * SPAN documents, in one window
    tops = near.groupBy("upper").agg(F.max("span").alias("top"))
    in_order = W.orderBy(F.desc("upper"))
    jump = tops.select("upper", F.coalesce(F.lead("top").over(in_order), F.first("top").over(in_order)).alias("jump"))
    return below.join(jump, "upper").select("span", F.coalesce("below", "jump").alias("next_span"))


def compared_with_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of its text with the last third taken from the next document, and how alike they are."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    rows = rows.withColumn("span", _span(docs, key))
    # the document after a span's last is the first of the next lower span
    place = F.struct(F.coalesce(F.col("doc_id"), F.lit(0)).alias("i"), (-F.col("tie").cast("decimal(20,0)")).alias("t"))
    spans = shared.materialize(rows.groupBy("span").agg(F.max(place).alias("head")), "spans")
    first = rows.join(spans, "span").where(place == F.col("head")).groupBy("span").agg(F.first("text").alias("head_text")).withColumnRenamed("span", "next_span")
    heads = _followers(spans).join(first, "next_span").select("span", "head_text")

    within = W.partitionBy("span").orderBy(F.desc_nulls_last("doc_id"), "tie")
    signed = signatures(rows, "text", "signs")
    beside = signed.withColumns({"beside": F.lead("text").over(within), "beside_signs": F.lead("signs").over(within)})
    both = beside.join(heads, "span", "left").withColumn("next", F.coalesce("beside", "head_text")).withColumn("n", F.char_length("text"))
    both = signatures(both.withColumn("at_end", F.when(F.col("beside").isNull(), F.col("head_text")).otherwise(F.lit(""))), "at_end", "head_signs")
    both = both.withColumn("next_signs", F.coalesce("beside_signs", "head_signs"))
    both = both.withColumn("edited", F.expr("concat(substring(text, 1, n - n div 3), substring(next, 1, int(n div 3)))"))
    both = signatures(both, "edited", "edited_signs")
    return both.select(
        "doc_id",
        F.col("n").cast("long").alias("n_chars"),
        F.sha2(F.encode("edited", "utf-8"), 256).alias("edited_sha256"),
        fingerprint("signs").alias("fingerprint"),
        fingerprint("edited_signs").alias("edited_fingerprint"),
        likeness("signs", "edited_signs").alias("near_edited"),
        likeness("signs", "next_signs").alias("near_next"),
    )


def alike(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.8) -> DataFrame:
    """Pairs (a, b) of representatives of equal fingerprints, a < b, whose likeness is at least ``least``, with the size of either class."""
    rows = signatures(docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")), "text", "signs")
    classes = rows.where(F.size("signs") > 0).groupBy("signs").agg(F.min("doc_id").alias("id"), F.count("*").alias("members")).withColumn("n", F.size("signs"))
    classes = shared.materialize(classes, "classes")
    # sets of likeness t share one of the first n - ceil(t n) + 1 signatures in any order that all sets have: by rarity,
    # so that a signature that many sets have is joined for few of them
    every = classes.select("id", "n", F.explode("signs").alias("sign"))
    often = shared.materialize(every.groupBy("sign").agg(F.count("*").alias("often")), "often")
    rank = F.row_number().over(W.partitionBy("id").orderBy("often", "sign"))
    open_ = every.join(often, "sign").withColumn("rank", rank).where(F.col("rank") <= F.col("n") - F.ceil(F.lit(least) * F.col("n") - 1e-9) + 1)
    # they lie in the same or the next partition of lengths
    partition = F.floor(F.log("n") / F.lit(-1).cast("double") / F.log(F.lit(least)))
    listed = shared.materialize(open_.select("id", "n", partition.alias("partition"), "sign"), "listed")
    other = listed.select(F.col("id").alias("id2"), F.col("n").alias("n2"), F.explode(F.array(F.col("partition"), F.col("partition") + 1)).alias("partition"), "sign")
    met = listed.join(other, ["partition", "sign"]).where("id <> id2").where(F.least("n", "n2") >= least * F.greatest("n", "n2") - 1e-9)
    pairs = met.select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b")).distinct()
    side = lambda name: classes.select(F.col("id").alias(name), F.col("signs").alias(f"signs_{name}"), F.col("members").alias(f"members_{name}"))
    found = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("likeness", likeness("signs_a", "signs_b"))
    return found.where(F.col("likeness") >= least).select("a", "b", "members_a", "members_b", "likeness")
