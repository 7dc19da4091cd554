"""Seeded choices that any engine and any partitioning repeats (O6-O8, W6): orders and draws from md5."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ticket(seed: int | str, *parts: Column) -> Column:
    """The md5 by which rows are ordered."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def draw(seed: int | str, n: Column, *parts: Column) -> Column:
    """A number from 0 to n - 1: the first eight hex digits modulo n."""
    return F.conv(F.substring(ticket(seed, *parts), 1, 8), 16, 10).cast("bigint") % n


def fixed_sample(rows: DataFrame, n: int, seed: int | str, key: str) -> DataFrame:
    """Exactly n rows (or all), without replacement."""
    return rows.orderBy(ticket(seed, F.col(key)), key).limit(n)


def stratified_sample(rows: DataFrame, n: int, seed: int | str, key: str, stratum: str) -> DataFrame:
    """At most n div strata of each stratum (one at least), then at most n."""
    counted = rows.agg(F.countDistinct(stratum).alias("k"))
    w = Window.partitionBy(stratum).orderBy(ticket(seed, F.col(key)), key)
    ranked = rows.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).withColumn("_one", F.lit(1))
    quota = counted.select(F.greatest(F.floor(F.lit(n) / F.greatest("k", F.lit(1))), F.lit(1)).alias("_quota"), F.lit(1).alias("_one"))
    held = ranked.join(quota, "_one").where("_rank <= _quota").drop("_one", "_quota", "_rank")
    return fixed_sample(held, n, seed, key)
