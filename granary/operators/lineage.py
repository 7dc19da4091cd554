"""Leakage families from ranked evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.operators.components import FEW_EDGES, connected_components
from granary.schemas import EVIDENCE
from granary.session import written


def evidence_edges(photos: DataFrame, keys: dict[int, Column], uid: str = "image_uid") -> DataFrame:
    """(uid, rank, key) for every known key; ranks keep unlike evidence apart."""
    parts = F.array(*[F.struct(F.lit(rank).alias("rank"), k.cast("string").alias("key")) for rank, k in sorted(keys.items())])
    edges = photos.select(F.col(uid).alias("uid"), F.explode(parts).alias("e")).select("uid", "e.rank", "e.key")
    return edges.where("key is not null and key not in ('', '-1', 'nan')").distinct()


def evidence_ranks(edges: DataFrame) -> DataFrame:
    """The strongest rank at which a photo shares a key with another: ``uid, evidence_rank``; no graph is needed."""
    shared = edges.groupBy("rank", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("rank", "key")
    return edges.join(shared, ["rank", "key"]).groupBy("uid").agg(F.min("rank").alias("evidence_rank"))


def families(photos: DataFrame, keys: dict[int, Column], site: Column | None = None, uid: str = "image_uid") -> DataFrame:
    """One row a photo: ``uid, family`` (the least uid of the family), ``evidence, evidence_rank``.

    Photos that share a key of any rank are joined, through each key's least member (a star, never pairs).  Only those
    still alone then share a family with others alone at their site (G3).
    """
    edges = evidence_edges(photos, keys, uid)
    heads = edges.groupBy("rank", "key").agg(F.min("uid").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
    stars = edges.join(heads, ["rank", "key"]).where("uid <> head").select("uid", "head").distinct()
    found = connected_components(stars, "uid", "head", one_task=FEW_EDGES)
    every = photos.select(F.col(uid).alias("uid"), (site if site is not None else F.lit(None)).cast("string").alias("site")).distinct()
    joined = every.join(found, every.uid == found.node, "left").drop("node")
    alone = F.col("component").isNull()
    least = joined.where(alone & F.col("site").isNotNull()).groupBy("site").agg(F.min("uid").alias("site_head"))
    family = F.when(~alone, F.col("component")).otherwise(F.coalesce("site_head", "uid"))
    named = joined.join(least, "site", "left").select("uid", family.alias("family"))
    ranked = named.join(evidence_ranks(edges), "uid", "left")
    rank = F.coalesce("evidence_rank", F.lit(len(EVIDENCE)))
    name = F.element_at(F.array(*[F.lit(e) for e in EVIDENCE]), rank)
    return ranked.select("uid", "family", name.alias("evidence"), rank.cast("bigint").alias("evidence_rank"))


def family_names(found: DataFrame) -> DataFrame:
    """``family, leakage_group_id`` as g and the place among all families in order, counted from 0.

    Families are numbered by a range sort and one count a partition, not in one window.
    """
    distinct = found.select("family").distinct().orderBy("family")
    numbered = distinct.select("family", F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().alias("_i"))
    numbered = written(numbered, "family-order")
    sizes = sorted((r["_p"], r["n"]) for r in numbered.groupBy("_p").agg(F.count(F.lit(1)).alias("n")).collect())
    offset, before = {}, 0
    for p, n in sizes:
        offset[p], before = before, before + n
    start = F.element_at(F.create_map(*[F.lit(x) for kv in offset.items() for x in kv]), F.col("_p")) if offset else F.lit(0)
    place = start + F.col("_i").bitwiseAND(F.lit((1 << 33) - 1))
    return numbered.select("family", F.format_string("g%06d", place.cast("bigint")).alias("leakage_group_id"))


def family_stats(found: DataFrame) -> DataFrame:
    """Per evidence: photos, families; beside the number, upper median and largest size of all families."""
    sizes = found.groupBy("family").agg(F.count(F.lit(1)).alias("n"))
    histogram = sizes.groupBy("n").agg(F.count(F.lit(1)).alias("k"))
    spread = histogram.agg(
        F.sum("k").alias("n_families"),
        F.max("n").alias("largest"),
        F.array_sort(F.collect_list(F.struct("n", "k"))).alias("by"),
    )
    # the size at place n_families div 2 of the ascending sizes
    seen = F.aggregate(
        "by",
        F.struct(F.lit(0).cast("bigint").alias("before"), F.lit(None).cast("bigint").alias("at")),
        lambda s, x: F.struct(
            (s.before + x.k).alias("before"),
            F.when(s.at.isNull() & (s.before + x.k > F.floor(F.col("n_families") / 2)), x.n).otherwise(s.at).alias("at"),
        ),
    )
    whole = spread.select("n_families", "largest", seen["at"].alias("median_size"))
    mix = found.groupBy("evidence").agg(F.count(F.lit(1)).alias("photos"), F.countDistinct("family").alias("families"))
    return mix.withColumn("_k", F.lit(1)).join(whole.withColumn("_k", F.lit(1)), "_k").drop("_k")


def site_overlay(photos: DataFrame, sheet: DataFrame, key: str, columns: list[str], site: str, fallback: Column) -> DataFrame:
    """Sheet values where they aren't blank, else the photo's own; an empty site becomes ``fallback``.

    A key's last non-null row of the sheet can't be told in a distributed read, so its rows must be unique; if not, the
    greatest value of each column counts.
    """
    one = sheet.groupBy(key).agg(*[F.max(c).alias(f"_{c}") for c in columns])
    out = photos.join(one, key, "left")
    for c in columns:
        out = out.withColumn(c, F.coalesce(F.nullif(F.trim(f"_{c}"), F.lit("")), F.col(c)))
    return out.withColumn(site, F.coalesce(F.nullif(F.col(site), F.lit("")), fallback)).drop(*[f"_{c}" for c in columns])


def reported_keys(report: DataFrame, photos: DataFrame, uid: str = "image_uid") -> DataFrame:
    """groups of an audit report (``group_key, image_uid``) as evidence: ``uid, key`` of members that the photos still have.

    Members that no photo has any more are stale and go; so do groups with fewer than two members left.
    """
    left = report.select("group_key", F.col("image_uid").alias("uid")).distinct()
    left = left.join(photos.select(F.col(uid).alias("uid")).distinct(), "uid", "left_semi")
    whole = left.groupBy("group_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("group_key")
    return left.join(whole, "group_key", "left_semi").select("uid", F.col("group_key").alias("key"))
