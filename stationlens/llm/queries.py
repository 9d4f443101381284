"""One query for each operator of this subpackage, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, html, langid, lines, neardup, oracles, packing, recompression, secrets, spotsigs, substrings
from .shared import table

#: Share of documents held out of the language model: this remainder of crc32(doc_id) by HELD_OUT_OF.
HELD_OUT, HELD_OUT_OF = 2, 4


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", "chunks_removed", F.sha2(F.encode("text", "utf-8"), 256).alias("kept_sha256"))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), scheme=neardup.Scheme(words=3, percent=85, chunks=6))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    counts = [F.size(kind).cast("long").alias(f"n_{kind}") for kind in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(F.encode(secrets.joined("base"), "utf-8"), 256).alias("base_sha256"), secrets.joined("spans").alias("spans"))


def op4_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = recompression.remove_repeated(table(spark, sf_dir, "documents"), width=35)
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "utf-8"), 256).alias("kept_sha256"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = F.pmod(F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "utf-8")), F.lit(HELD_OUT_OF)) == HELD_OUT
    model = langid.fit(documents.where(~held_out))
    found = langid.predict(documents.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op7_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.compared_with_edits(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeated(table(spark, sf_dir, "documents"), width=50)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def pack_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instruction data under all three limits of op5: tokens, segments and loss-bearing tokens, which differ here."""
    return packing.pack_conversations(table(spark, sf_dir, "conversations"))


OPERATORS = (op1_line_dedup, op2_minhash, op3_secrets, op4_recompression, op5_packing, op6_langid, op7_spotsigs, op8_decontaminate, op9_html, op10_suffix_dedup)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (*OPERATORS, pack_conversations)}
ORACLES: dict[str, str] = oracles.ORACLES
