"""A corpus pipeline of the operators in stationlens.llm, one stage after the other.

Each stage works on all that the one before it kept, and its decisions take effect:
documents of unsure language go, repeated chunks of lines go (and documents of which
nothing is left), one document of each group of near duplicates stays (five words,
similarity 0.8), documents with a benchmark passage go, and the rest is packed.
Rows are told by id and text, so rows without an id or with an id that others have are
decided by their own text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stationlens.llm import decontaminate, langid, lines, neardup, packing
from stationlens.llm.shared import discard, materialize, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(6) Keep the documents whose language the model doesn't reject."""
    model = langid.fit(docs)
    return langid.predict(docs, model).where("not rejected").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(1) Take repeated chunks of lines out; documents of which nothing is left go."""
    carry = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    found = lines.dedup_lines(docs, carry=carry).where("not (n_removed > 0 and text = '')")
    return found.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def _with_row(docs: DataFrame) -> DataFrame:
    """``docs`` with row_, a hash of id and text: ids may be null, or shared by unlike texts."""
    return docs.withColumn("row_", F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(2) Keep the row of least id of each component (null last, then by hash); of rows that repeat id and text, one."""
    rows = _with_row(docs)
    found = neardup.near_duplicates(rows, key="row_", scheme=neardup.Scheme(words=5, percent=80, chunks=7))
    found = materialize(found.select(F.col("doc_id").alias("row_"), "component_id", "kept"), "kept")
    # what goes, and rows that repeat, are the few: only they are joined with the texts
    groups = found.where("not kept").select("component_id").distinct()
    members = found.join(groups, "component_id").select("row_", "component_id").distinct().join(rows.select("row_", "doc_id").distinct(), "row_")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_")
    members = materialize(members.select("row_", "component_id", place.alias("place")), "members")
    least = members.groupBy("component_id").agg(F.min("place").alias("least"))
    gone = materialize(members.join(least, "component_id").where("row_ <> least.row_").select("row_").distinct(), "gone")
    repeated = materialize(found.groupBy("row_").agg(F.count("*").alias("n")).where("n > 1").select("row_"), "repeated")
    left = rows.join(gone, "row_", "left_anti")
    if repeated.isEmpty():
        return left.select(*docs.columns)
    one = W.partitionBy("row_", "doc_id", "text").orderBy(F.xxhash64(*(F.col(c) for c in docs.columns if c not in ("doc_id", "text"))))
    first = left.join(repeated, "row_", "left_semi").withColumn("place_", F.row_number().over(one)).where("place_ = 1")
    return left.join(repeated, "row_", "left_anti").select(*docs.columns).unionByName(first.select(*docs.columns))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(8) Rows that cover half a benchmark item or more go."""
    rows = _with_row(docs)
    found = decontaminate.contaminated(rows, table(spark, sf_dir, "benchmark"), key="row_")
    gone = materialize(found.select(F.col("doc_id").alias("row_")).distinct(), "contaminated")
    return rows.join(gone, "row_", "left_anti").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(5) Pieces of token sequences."""
    return packing.pack_documents(docs)


STAGES = [("language", language), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontaminated", decontaminated), ("pack", pack)]

#: SQL can't express these stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(before)  # the stage that read it is written
    return STAGES[-1][1](spark, docs, sf_dir)
