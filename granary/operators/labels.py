"""Label vocabulary: proposals, a person's decisions, and their application."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.functions.labels import label_key, review_note
from granary.sinks import DataQualityError

DECISIONS = ("keep", "merge", "drop")


def propose(instances: DataFrame, raw: str = "label_raw") -> DataFrame:
    """One row per raw label: ``label_raw, count, label_key, suggested_canon, note, spellings, key_total``.

    A key's most used spelling (ties: the first in order) names it.  Uses are counted before anything else, so windows
    see distinct labels only.
    """
    used = instances.groupBy(F.col(raw).cast("string").alias("label_raw")).agg(F.count(F.lit(1)).alias("count"))
    keyed = used.where("label_raw is not null").withColumn("label_key", label_key(F.col("label_raw")))
    own = Window.partitionBy("label_key")
    return (
        keyed.withColumn("suggested_canon", F.first("label_raw").over(own.orderBy(F.desc("count"), "label_raw")))
        .withColumn("spellings", F.count(F.lit(1)).over(own))
        .withColumn("key_total", F.sum("count").over(own))
        .withColumn("note", review_note(F.col("label_key"), F.col("spellings")))
    )


def review_sheet(proposed: DataFrame) -> DataFrame:
    """The sheet a person fills in, most used keys first."""
    blank = [F.lit("").alias(c) for c in ("label_canon", "decision", "domain", "approved_by")]
    ordered = proposed.orderBy(F.desc("key_total"), "label_key", F.desc("count"), "label_raw")
    return ordered.select("label_raw", "count", "suggested_canon", *blank, "note")


def check_review(review: DataFrame, most: int = 5) -> DataFrame:
    """The review, or an error that names rows without a canon, a decision or an approver."""
    empty = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == ""
    unfilled = review.where((empty("label_canon") & (F.trim("decision") != "drop")) | empty("decision") | empty("approved_by"))
    rows = unfilled.select("label_raw").orderBy("label_raw").limit(most).collect()
    if rows:
        raise DataQualityError(f"labels not decided or not approved: {[r.label_raw for r in rows]}")
    return review


def ontology(review: DataFrame, approved_at: str) -> DataFrame:
    """P25: one row per raw label, trimmed, with one time stamp; of repeated rows, the greatest decision by text counts."""
    trimmed = review.select("label_raw", *[F.trim(F.coalesce(F.col(c), F.lit(""))).alias(c) for c in ("label_canon", "domain", "decision", "approved_by")])
    one = trimmed.groupBy("label_raw").agg(F.max(F.struct("decision", "label_canon", "domain", "approved_by")).alias("r"))
    return one.select("label_raw", "r.label_canon", "r.domain", "r.decision", "r.approved_by", F.lit(approved_at).alias("approved_at"))


def apply(instances: DataFrame, decided: DataFrame, raw: str = "label_raw") -> DataFrame:
    """Instances with ``label_canon``, empty if undecided, without those of dropped labels."""
    known = decided.select(F.col("label_raw").alias("_raw"), F.col("label_canon").alias("_canon"), F.col("decision").alias("_decision"))
    rows = instances.drop("label_canon").join(known, F.col(raw) == F.col("_raw"), "left")
    rows = rows.where(F.coalesce("_decision", F.lit("")) != "drop")
    return rows.withColumn("label_canon", F.coalesce("_canon", F.lit(""))).drop("_raw", "_canon", "_decision")


def most_used(instances: DataFrame, label: str = "label_raw", n: int = 5) -> DataFrame:
    """The ``n`` labels with most instances, ties by label: ``label, n``."""
    per = instances.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return per.orderBy(F.desc("n"), "label").limit(n)
