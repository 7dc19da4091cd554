"""The corpus pipeline: language ID, quality rules, near-dedup, secret redaction, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns
of ``documents``.  Empty tables pass through every stage; null and empty texts are rejected by the first; of rows that repeat
an id, the third keeps one of each group of near texts; further columns of ``docs``, whatever their names, pass through up to
the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm import bestfit_packing, language_id, minhash_dedup, quality_rules, secret_scan
from granary.session import small_batches, written
from granary.sources.tables import table


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those that the calibrated rejection turns away go."""
    small_batches(spark)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = language_id.train(docs.where(~F.coalesce(held, F.lit(True))))
    return language_id.recognised(docs, model)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior probability of being good is high enough."""
    return quality_rules.good(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id, then the smallest hash of its columns."""
    return minhash_dedup.one_of_each(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    return secret_scan.redact(docs, secret_scan.train(known=secret_scan.vocabulary(docs)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and the bins that hold them."""
    return bestfit_packing.best_fit(docs)


STAGES = [
    ("language_id", identify),
    ("quality_rules", quality),
    ("minhash_dedup", deduplicate),
    ("secret_scan", redact),
    ("bestfit_packing", pack),
]

#: No SQL equals it: the first, third and fourth stages are trained models and signatures; tests compare with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
