"""From raw documents to a mix: toxicity, line dedup, near-duplicate dedup, decontamination, source mixing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns the documents that stay, with the columns of ``docs`` (the last one
returns the mix). ``run`` writes each stage's result to the shared folder and
reads it back for the next. Rows with a null id, null or empty text pass like
any other; columns that documents do not have are passed on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.llm.common import stash
from obsflow.llm.decontaminate import contamination
from obsflow.llm.line_dedup import line_dedup
from obsflow.llm.minhash import near_duplicates
from obsflow.llm.mixing import mix
from obsflow.llm.toxicity import toxicity_scores
from obsflow.session import prepare


def _apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with neutral names for all columns but id and text, so that an operator's own columns never clash."""
    names = {c: f"_in_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    return docs.withColumnsRenamed(names), names


def _back(out: DataFrame, names: dict[str, str], docs: DataFrame) -> DataFrame:
    return out.select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; it learns from the labels of the documents given."""
    prepare(spark)
    apart, names = _apart(docs)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity_scores(apart, docs.select("doc_id", "text"), labels, carry=True)
    return _back(scored.where("predicted = 0"), names, docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in five documents or more go from all but one; n_chars follows the text."""
    prepare(spark)
    apart, names = _apart(docs)
    out = line_dedup(apart)
    if "n_chars" in names:
        count = F.when(F.col("kept_text").isNotNull(), F.char_length("kept_text")).otherwise(F.col(names["n_chars"]))
        out = out.withColumn(names["n_chars"], count.cast(docs.schema["n_chars"].dataType))
    return _back(out.withColumn("text", F.coalesce("kept_text", "text")), names, docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays; of equal rows, one."""
    prepare(spark)
    apart, names = _apart(docs)
    gone = stash(near_duplicates(docs.select("doc_id", "text")).where("not kept").select("doc_id").distinct(),
                 "pipeline-near")
    left = apart.join(gone, "doc_id", "left_anti").withColumn("_th", F.xxhash64("text"))
    return _back(left.dropDuplicates(["doc_id", "_th"]), names, docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too much of the benchmark go."""
    prepare(spark)
    apart, names = _apart(docs)
    found = contamination(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    gone = stash(found.where("contaminated").select("row_id", "th").distinct(), "pipeline-contaminated")
    same = F.col("doc_id").eqNullSafe(F.col("row_id")) & (F.xxhash64("text") == F.col("th"))
    return _back(apart.join(gone, same, "left_anti"), names, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, size, source_size, target, taken): the words the mix takes of each document left."""
    prepare(spark)
    return mix(docs.select("doc_id", "text", "source"))


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", dedup_lines),
    ("minhash_dedup", dedup_near),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
]

#: No SQL for the toxicity model; tests/llm/test_pipeline.py checks run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
