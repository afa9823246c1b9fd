"""Corpus preparation in five stages, each on all that its predecessor kept.

1. quality rules: documents below the base or above a certified cutoff go;
2. near duplicates by SimHash: of each group the document of least ``doc_id`` stays;
3. benchmark decontamination: documents that leak an item go;
4. secret scan: secrets in texts are replaced, every document stays;
5. packing: the texts become windows of at most 4096 tokens.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return
the columns of ``documents``. Null texts fail the quality rules; an empty table stays
empty through all stages. Repeated rows and copies meet in the second stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runloom.llm.decontamination import drop_leaking
from runloom.llm.packing import pack_documents
from runloom.llm.quality_rules import judge_quality
from runloom.llm.secret_scan import redact_secrets
from runloom.llm.simhash_dedup import drop_near_duplicates
from runloom.llm.support import stored, table


SECRET_MARK = "[SECRET]"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return judge_quality(docs, table(spark, sf_dir, "labels"), keep_columns=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = redact_secrets(docs, mark=SECRET_MARK)
    redacted = F.contains("text", F.lit(SECRET_MARK))
    return clean.withColumn("n_chars", F.when(redacted, F.length("text").cast("long")).otherwise(F.col("n_chars")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: Fingerprints, the forest and the tokenizer have no SQL; tests/llm checks the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
