"""Few-shot episodes with no leakage (the composite of 2.13; A14, A15, J10, J15-J17, J19, R8, R9, V15, V17)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.functions.hashing import dedup_key
from granary.operators.dedup import keep_first
from granary.operators.sampling import draw, ticket
from granary.sinks import DataQualityError


def build_episodes(
    manifest: DataFrame, instances: DataFrame, per_split: dict[str, int], k_support: int = 10, k_query: int = 20, seed: int = 20260817,
    dedup: bool = True, order: str = "image_uid",
) -> DataFrame:
    """Episodes of every split: a label, two of its photos, at most ``k`` points of each; draws by md5 of seed, split and number.

    Copies collapse to the first photo before the annotation filter.  Each split uses canonical labels if it has any,
    else raw ones.  Labels need two photos; a split without such labels has no episodes.

    Photos are numbered within a label and labels within a split by windows over distinct (label, photo) rows; an episode
    draws a label's number and two different photo numbers, so it costs look-ups, not a pass over its label's photos.
    """
    photos = enforce_splits(manifest).where(F.col("split").isin(*per_split))
    if dedup:
        photos = keep_first(photos, F.concat_ws(":", "split", dedup_key(F.col("content_hash"), F.col("content_key"))), order)
    own = photos.select("image_uid", "split", "leakage_group_id")
    kept = instances.join(own, "image_uid")
    filled = kept.groupBy("split").agg(F.max(F.coalesce("label_canon", F.lit("")) != "").alias("canon"))
    label = F.when(F.col("canon"), F.coalesce("label_canon", F.lit(""))).otherwise(F.coalesce("label_raw", F.lit("")))
    marks = kept.join(filled, "split").select("split", label.alias("label"), "image_uid", "leakage_group_id", "instance_id", "x", "y").where("label <> ''")

    pool = marks.select("split", "label", "image_uid", "leakage_group_id").distinct()
    by_photo = Window.partitionBy("split", "label").orderBy("image_uid")
    ranked = pool.withColumn("photo", F.row_number().over(by_photo) - 1)
    labels = ranked.groupBy("split", "label").agg(F.count(F.lit(1)).alias("photos")).where("photos >= 2")
    labels = labels.withColumn("place", F.row_number().over(Window.partitionBy("split").orderBy("label")) - 1)
    wanted = labels.groupBy("split").agg(F.count(F.lit(1)).alias("labels"))
    counts = F.create_map(*[F.lit(x) for kv in per_split.items() for x in kv])
    number = F.explode(F.sequence(F.lit(0), counts[F.col("split")] - 1))
    wanted = wanted.where(counts[F.col("split")] > 0).withColumn("i", number)
    drawn = wanted.withColumn("place", draw(seed, F.col("labels"), F.col("split"), F.col("i"), F.lit("label")).cast("int"))
    chosen = drawn.join(labels, ["split", "place"]).select("split", "i", "label", "photos")

    # two different photos: one drawn, the other drawn among the rest
    first = draw(seed, F.col("photos"), F.col("split"), F.col("i"), F.lit("support"))
    step = draw(seed, F.col("photos") - 1, F.col("split"), F.col("i"), F.lit("query")) + 1
    two = chosen.withColumn("_s", first).withColumn("_q", (F.col("_s") + step) % F.col("photos"))

    def photo(side: str) -> DataFrame:
        return ranked.select("split", "label", F.col("photo").alias(f"_{side}"), F.col("image_uid").alias(f"{side}uid"), F.col("leakage_group_id").alias(f"{side}family"))

    paired = two.join(photo("s"), ["split", "label", "_s"]).join(photo("q"), ["split", "label", "_q"])

    def points(side: str, k: int) -> DataFrame:
        uid = F.col(f"{side}uid")
        met = paired.select("split", "i", "label", uid.alias("image_uid")).join(marks.drop("leakage_group_id"), ["split", "label", "image_uid"])
        w = Window.partitionBy("split", "i").orderBy(ticket(seed, F.col("split"), F.col("i"), F.lit(side), F.col("instance_id")), "instance_id", "x", "y")
        top = met.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k)
        listed = top.groupBy("split", "i").agg(F.array_sort(F.collect_list(F.struct("_rank", "x", "y"))).alias("p"))
        pick = {"x": lambda q: q.x.cast("double"), "y": lambda q: q.y.cast("double")}
        return listed.select("split", "i", *[F.transform("p", f).alias(f"{side}{c}") for c, f in pick.items()])

    full = paired.join(points("s", k_support), ["split", "i"]).join(points("q", k_query), ["split", "i"])
    return full.select(
        F.format_string("%s-%06d", "split", "i").alias("episode_id"), "split", "label",
        F.col("suid").alias("support_uid"), F.col("quid").alias("query_uid"),
        F.col("sx").alias("support_x"), F.col("sy").alias("support_y"), F.col("qx").alias("query_x"), F.col("qy").alias("query_y"),
        F.size("sx").cast("bigint").alias("n_support"), F.size("qx").cast("bigint").alias("n_query"),
        F.col("sfamily").eqNullSafe(F.col("qfamily")).cast("bigint").alias("same_family"),
        F.lit(1).cast("bigint").alias("sampler_version"), draw(seed, F.lit(2**31), F.col("split"), F.col("i"), F.lit("seed")).alias("seed"),
    )


def enforce_splits(manifest: DataFrame) -> DataFrame:
    """The manifest, or an error if no photo of it has a split; an empty one passes."""
    there = "split" in manifest.columns
    if not there or manifest.limit(1).count() and not manifest.where("coalesce(split, '') <> ''").limit(1).count():
        raise DataQualityError("the manifest has no splits; assign them before building episodes")
    return manifest


def leakage_audit(episodes: DataFrame, manifest: DataFrame) -> DataFrame:
    """One row: episodes, labels, share within one family, same-photo and cross-split counts."""
    split = lambda side: manifest.select(F.col("image_uid").alias(f"{side}_uid"), F.col("split").alias(f"_{side}"))
    met = episodes.join(split("support"), "support_uid", "left").join(split("query"), "query_uid", "left")
    off: Column = ~(F.col("_support").eqNullSafe(F.col("split")) & F.col("_query").eqNullSafe(F.col("split")))
    return met.agg(
        F.count(F.lit(1)).alias("episodes"),
        F.countDistinct("label").alias("labels"),
        F.round(F.coalesce(F.avg("same_family"), F.lit(0.0)), 6).alias("same_family"),
        F.count_if(F.col("support_uid") == F.col("query_uid")).alias("same_photo"),
        F.count_if(off).alias("cross_split"),
    )


def enforce_audit(audit: DataFrame) -> None:
    """V15."""
    r = audit.first()
    if r.same_photo or r.cross_split:
        raise DataQualityError(f"{r.same_photo} episodes use one photo twice, {r.cross_split} leave their split")


def with_members(episodes: DataFrame, manifest: DataFrame) -> DataFrame:
    """Archive and member of both photos."""
    for side in ("support", "query"):
        own = manifest.select(F.col("image_uid").alias(f"{side}_uid"), F.col("archive").alias(f"{side}_archive"), F.col("member").alias(f"{side}_member"))
        episodes = episodes.join(own, f"{side}_uid")
    return episodes
