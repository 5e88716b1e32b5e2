"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.llm.codes import compress
from obsflow.llm.decontaminate import contamination
from obsflow.llm.html import extract_text
from obsflow.llm.line_dedup import line_dedup
from obsflow.llm.minhash import near_duplicates
from obsflow.llm.mixing import mix
from obsflow.llm.packing import pack
from obsflow.llm.quality import quality_scores
from obsflow.llm.spherical import near_vectors
from obsflow.llm.spelling import spelling_variants
from obsflow.llm.suffix_dedup import suffix_dedup
from obsflow.llm.toxicity import toxicity_scores
from obsflow.llm.warc import plan_records, read_archives, write_archives
from obsflow.session import work_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its quality score from the additive model and the decision at 0.3."""
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per vector: its links at cosine 0.98 within its label, and the smallest id reachable by links."""
    return near_vectors(_table(spark, sf_dir, "embeddings"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines, dropped lines and the SHA-256 of what stays."""
    out = line_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce("kept_text", "text", F.lit("")), 256).alias("kept_sha256"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its size, its source's size and target, and the words the mix takes."""
    return mix(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: what its record in the written archives says, read back through the verified boundary chain."""
    path = work_dir(spark, "warc-archives")
    write_archives(plan_records(_table(spark, sf_dir, "pages")), path)
    return read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: the text of its article, read along the wrapper of its host."""
    return extract_text(_table(spark, sf_dir, "pages"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: words covered by benchmark windows, the items found and the verdict."""
    found = contamination(_table(spark, sf_dir, "documents").select("doc_id", "text"),
                          _table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select(F.col("row_id").alias("doc_id"), "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), "contaminated")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its toxicity score over all windows and the decision at 0.3."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity_scores(docs, docs, _table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted", "n_windows")


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its four-word shingle count, the smallest id of its group of near copies, and whether it stays."""
    return near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"), k=4)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: bytes covered by repeated 400-byte strings and the SHA-256 of the rest."""
    out = suffix_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per piece of a document: where it lies in the document and in its sequence, and the CRC-32 of its token ids."""
    import public_tokenizers
    out = pack(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per kept vector: its code, its error, the error of its label and the digest of the codebooks."""
    return compress(_table(spark, sf_dir, "embeddings"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per frequent word: its more frequent form one edit away, the end of the chain of forms, and counts."""
    return spelling_variants(_table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_near_vectors": op2_near_vectors,
    "op3_line_dedup": op3_line_dedup,
    "op4_mix_sources": op4_mix_sources,
    "op5_warc": op5_warc,
    "op6_html_text": op6_html_text,
    "op7_decontaminate": op7_decontaminate,
    "op8_toxicity": op8_toxicity,
    "op9_minhash_dedup": op9_minhash_dedup,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_packing": op11_packing,
    "op12_vector_codes": op12_vector_codes,
    "op13_spelling_variants": op13_spelling_variants,
}
