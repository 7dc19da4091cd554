"""The exhaustiveness audit: which photographs a person should look at (I10: F11, W6, J18, A11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.operators.sampling import stratified_sample


def exhaustiveness_sample(manifest: DataFrame, instances: DataFrame, n: int = 30, seed: int = 0, pattern: str = "") -> DataFrame:
    """A review sheet: sampled annotated photographs whose dataset matches the pattern, their marks, and blanks to fill in."""
    pool = manifest.where("has_annotation = 1")
    if pattern:
        pool = pool.where(F.col("dataset").rlike("(?i)" + pattern))
    picked = stratified_sample(pool, n, seed, "image_uid", "dataset").select("image_uid", "image_name", "dataset", "task_status")
    marks = instances.join(picked.select("image_uid"), "image_uid", "left_semi").groupBy("image_uid").agg(F.count(F.lit(1)).alias("marked"))
    blank = [F.lit("").alias(c) for c in ("missed_count", "exhaustive", "reviewer")]
    return picked.join(marks, "image_uid", "left").select(
        F.col("image_name").alias("image"), "dataset", "task_status", F.coalesce("marked", F.lit(0)).alias("marked"), *blank
    )


def sampled_marks(sample: DataFrame, instances: DataFrame, uid: str = "image_uid") -> DataFrame:
    """The marks themselves of sampled photographs, in every column of the instances."""
    return instances.join(sample.select(uid).distinct(), uid, "left_semi")
