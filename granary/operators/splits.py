"""Whole families to balanced piles."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.schemas import SHARES, SPLITS
from granary.sinks import DataQualityError


def assign(sizes: DataFrame, splits: tuple[str, ...] = SPLITS, shares: tuple[float, ...] = SHARES) -> DataFrame:
    """``family, n, split``: families, largest first, each to the pile that is farthest below its target.

    The choice for a family needs those before it, so one task reads the sorted families as a stream; it holds five
    numbers, and sorts the families, which spills.  Ties go to the earlier pile.
    """
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    targets = [s * total for s in shares]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [0] * len(splits)
        for batch in batches:
            picks = []
            for n in batch.column(1).to_pylist():
                k = min(range(len(splits)), key=lambda j: got[j] - targets[j])
                got[k] += n
                picks.append(splits[k])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(picks, pa.string())], ["family", "n", "split"])

    ordered = sizes.select("family", F.col("n").cast("bigint").alias("n")).orderBy(F.desc("n"), "family").coalesce(1)
    kind = sizes.schema["family"].dataType.simpleString()
    return ordered.mapInArrow(run, f"family {kind}, n long, split string")


def family_sizes(members: DataFrame, family: str) -> DataFrame:
    return members.groupBy(F.col(family).alias("family")).agg(F.count(F.lit(1)).alias("n"))


def summary(assigned: DataFrame, splits: tuple[str, ...] = SPLITS, shares: tuple[float, ...] = SHARES) -> DataFrame:
    """Per split the photographs, their share, the target and the number of families."""
    spark = assigned.sparkSession
    names = spark.createDataFrame([(k, s, x) for k, (s, x) in enumerate(zip(splits, shares))], "place int, split string, target double")
    per = assigned.groupBy("split").agg(F.sum("n").alias("photographs"), F.count(F.lit(1)).alias("families"))
    out = names.join(per, "split", "left").fillna(0, ["photographs", "families"])
    whole = assigned.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("whole"))
    out = out.withColumn("_k", F.lit(1)).join(whole.withColumn("_k", F.lit(1)), "_k")
    share = F.round(F.col("photographs") / F.greatest("whole", F.lit(1)), 4)
    return out.select("split", F.col("photographs").cast("bigint").alias("photographs"), share.alias("share"), "target", F.col("families").cast("bigint").alias("families"))


def leaks(photos: DataFrame, family: str, split: str = "split") -> DataFrame:
    """Families in more than one split: ``family, splits``."""
    return photos.groupBy(F.col(family).alias("family")).agg(F.countDistinct(split).alias("splits")).where("splits > 1")


def enforce_whole_families(photos: DataFrame, family: str, split: str = "split", most: int = 5) -> DataFrame:
    """The photos, or an error that names families in more than one split, before anything is written."""
    found = leaks(photos, family, split).orderBy("family").limit(most).collect()
    if found:
        raise DataQualityError(f"families in several splits: {[r.family for r in found]}")
    return photos


def split_of_photos(photos: DataFrame, assigned: DataFrame, family: str) -> DataFrame:
    """Photos with the split of their family, empty where it has none."""
    per = assigned.select(F.col("family").alias(family), F.col("split").alias("_split"))
    return photos.drop("split").join(per, family, "left").withColumn("split", F.coalesce("_split", F.lit(""))).drop("_split")
