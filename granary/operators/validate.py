"""The validation gate (V1-V13, A17, A18, J8, J9, F8, F9): one row per check, one scan per table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check(name: str, bad: Column, total: Column, fatal: bool = True) -> Column:
    """One check as a struct; several share an aggregate, and ``checks`` turns them to rows."""
    return F.struct(
        F.lit(name).alias("check"),
        F.coalesce(bad, F.lit(0)).cast("bigint").alias("bad"),
        F.coalesce(total, F.lit(0)).cast("bigint").alias("total"),
        F.lit(fatal).alias("fatal"),
    )


def checks(df: DataFrame, *each: Column) -> DataFrame:
    """The checks of one pass over ``df``, with the percentage of bad rows."""
    rows = df.agg(F.array(*each).alias("c")).select(F.explode("c").alias("c")).select("c.*")
    return rows.withColumn("pct", F.round(100 * F.col("bad") / F.greatest("total", F.lit(1)), 6))


def unique(df: DataFrame, key: str, name: str) -> DataFrame:
    """V1: rows beyond the number of distinct keys; null keys are bad."""
    return checks(df, check(name, F.count(F.lit(1)) - F.countDistinct(key), F.count(F.lit(1))))


def missing(df: DataFrame, key: str, other: DataFrame, other_key: str, name: str, fatal: bool = True) -> DataFrame:
    """J9 (V2, V7, V9): rows whose key isn't in ``other``."""
    found = other.select(F.col(other_key).alias("_k")).where("_k is not null").distinct().withColumn("_f", F.lit(1))
    met = df.join(found, F.col(key) == F.col("_k"), "left")
    return checks(met, check(name, F.count_if(F.col("_f").isNull()), F.count(F.lit(1)), fatal))


def holds(df: DataFrame, name: str, bad: Column, fatal: bool = True) -> Column:
    """A row condition as a check for ``checks``."""
    return check(name, F.count_if(F.coalesce(bad, F.lit(False))), F.count(F.lit(1)), fatal)


def geometry_checks(instances: DataFrame, photos: DataFrame) -> DataFrame:
    """Centres inside, boxes with size, areas within 1.01 of the box, dimensions known."""
    sized = instances.join(photos.select("image_uid", F.col("width").alias("_w"), F.col("height").alias("_h")), "image_uid", "left")
    measured = (F.col("_w") > 0) & (F.col("_h") > 0)
    box = F.col("shape_type") != "points"
    outside = (F.col("x") < 0) | (F.col("y") < 0) | (F.col("x") > F.col("_w")) | (F.col("y") > F.col("_h"))
    return checks(
        sized,
        check("centre inside photo", F.count_if(measured & outside), F.count_if(measured)),
        check("box has size", F.count_if(box & ~((F.col("w") > 0) & (F.col("h") > 0))), F.count_if(box)),
        check("area within box", F.count_if(box & (F.col("area_px") > 1.01 * F.col("w") * F.col("h"))), F.count_if(box)),
        check("dimensions known", F.count_if(~F.coalesce(measured, F.lit(False))), F.count(F.lit(1)), False),
    )


def family_checks(lineage: DataFrame, most_share: float = 0.5, least: int = 30) -> DataFrame:
    """The largest family, and the number of families."""
    sizes = lineage.groupBy("leakage_group_id").agg(F.count(F.lit(1)).alias("n"))
    return checks(
        sizes,
        check("largest family", F.when(F.max("n") > most_share * F.sum("n"), F.max("n")).otherwise(0), F.sum("n")),
        check("enough families", F.greatest(F.lit(least) - F.count(F.lit(1)), F.lit(0)), F.count(F.lit(1))),
    )


def run_gate(manifest: DataFrame, instances: DataFrame, ontology: DataFrame | None = None, lineage: DataFrame | None = None) -> DataFrame:
    """All checks that the given tables allow; a missing ontology or lineage is a warning."""
    parts = [
        unique(manifest, "image_uid", "image_uid unique"),
        missing(instances, "image_uid", manifest, "image_uid", "instance has photo"),
        geometry_checks(instances, manifest),
        checks(manifest, coverage(manifest)),
    ]
    if ontology is not None:
        parts.append(missing(instances, "label_raw", ontology, "label_raw", "label approved"))
        parts.append(checks(instances, holds(instances, "canon filled", F.coalesce("label_canon", F.lit("")) == "")))
    if lineage is not None:
        parts.append(missing(manifest, "image_uid", lineage, "image_uid", "photo has family"))
        parts.append(family_checks(lineage))
    for name, there in (("ontology table", ontology), ("lineage table", lineage)):
        if there is None:
            parts.append(checks(manifest.limit(0), check(name, F.lit(1) + 0 * F.count(F.lit(1)), F.lit(1), False)))
    return reduce(DataFrame.unionByName, parts)


def coverage(manifest: DataFrame, least: float = 0.05) -> Column:
    """Completed photographs below the least share."""
    done = F.count_if(F.col("task_status") == "completed")
    return check("completed share", F.when(done < least * F.count(F.lit(1)), F.count(F.lit(1)) - done).otherwise(0), F.count(F.lit(1)), False)
