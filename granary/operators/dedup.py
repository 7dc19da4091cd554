"""The duplicate audit: exact, overlapping, perceptual and near-size groups."""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.operators.components import FEW_EDGES, connected_components


def keyed_groups(rows: DataFrame, key: Column, uid: str, dataset: str) -> DataFrame:
    """A1, A2: keys that two rows or more share: ``group_key, members, datasets, first_uid``; counts only, no lists."""
    return (
        rows.groupBy(key.alias("group_key"))
        .agg(
            F.count(F.lit(1)).alias("members"),
            F.countDistinct(dataset).alias("datasets"),
            F.min(uid).alias("first_uid"),
        )
        .where("members > 1")
    )


def group_members(rows: DataFrame, key: Column, uid: str, kind: str = "exact") -> DataFrame:
    """A1 as tidy rows ``group_kind, group_key, image_uid``."""
    keyed = rows.select(key.alias("group_key"), F.col(uid).alias("image_uid"))
    shared = keyed.groupBy("group_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("group_key")
    return keyed.join(shared, "group_key", "left_semi").select(F.lit(kind).alias("group_kind"), "group_key", "image_uid")


def keep_first(rows: DataFrame, key: Column, *order: str) -> DataFrame:
    """The first row of each key in an explicit order."""
    w = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def report_totals(rows: DataFrame, key: Column, dataset: str) -> DataFrame:
    """One row of totals: rows, distinct keys, shared keys, rows with a copy, redundant rows, cross-dataset groups, largest."""
    per = rows.groupBy(key.alias("k")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(dataset).alias("d"))
    shared = F.col("n") > 1
    total = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    return per.agg(
        total(F.sum("n")).alias("n_rows"),
        total(F.count("k")).alias("n_keys"),
        total(F.count_if(shared)).alias("n_groups"),
        total(F.sum(F.when(shared, F.col("n")))).alias("n_members"),
        total(F.sum(F.col("n") - 1)).alias("n_redundant"),
        total(F.count_if(shared & (F.col("d") > 1))).alias("n_cross"),
        total(F.max(F.when(shared, F.col("n")))).alias("largest"),
    )


def tile_sizes(tiles: DataFrame) -> DataFrame:
    """Whole median width and height of each map's tiles, for maps of two tiles or more with both known."""
    placed = tiles.where("coalesce(source_mosaic, '') <> '' and tile_x >= 0 and tile_y >= 0")
    sizes = placed.groupBy("source_mosaic").agg(
        F.median("width").cast("bigint").alias("w"),
        F.median("height").cast("bigint").alias("h"),
        F.count(F.lit(1)).alias("tiles"),
        F.max("width").alias("_w"),
        F.max("height").alias("_h"),
    )
    return sizes.where("tiles >= 2 and w > 0 and h > 0 and _w > 0 and _h > 0").select("source_mosaic", "w", "h", "tiles")


def overlaps(tiles: DataFrame, uid: str = "image_uid") -> DataFrame:
    """Tiles that overlap another of their map: ``group_key, image_uid``.

    Tiles meet in cells as wide and high as the median tile.  All tiles of a cell that holds two or more overlap, whatever
    their places in it; only a tile alone in its cell is compared with those of the eight cells around, so a map costs a
    multiple of its tiles, however dense it is.  Joins are by shuffle: one whose sides are tiles may not be sent to all.
    """
    sized = tiles.where((F.col("tile_x") >= 0) & (F.col("tile_y") >= 0) & F.col(uid).isNotNull())
    sized = sized.join(tile_sizes(tiles).hint("shuffle_hash"), "source_mosaic")
    cell = ["source_mosaic", "bx", "by"]
    own = sized.select(
        "source_mosaic", F.col(uid).alias("image_uid"), "tile_x", "tile_y", "w", "h",
        F.expr("floor(tile_x) div w").alias("bx"), F.expr("floor(tile_y) div h").alias("by"),
    )
    cells = own.groupBy(*cell).agg((F.min("image_uid") == F.max("image_uid")).alias("alone"))
    placed = own.join(cells.hint("merge"), cell)
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j])
    alone = placed.where("alone").withColumn("step", F.explode(steps)).select(
        "source_mosaic", "image_uid", "tile_x", "tile_y", "w", "h",
        (F.col("bx") + F.col("step.i")).alias("bx"), (F.col("by") + F.col("step.j")).alias("by"),
    )
    near = own.select(*[F.col(c).alias(f"_{c}") for c in cell], F.col("image_uid").alias("other"), F.col("tile_x").alias("ox"), F.col("tile_y").alias("oy"))
    same = [F.col(c) == F.col(f"_{c}") for c in cell]
    met = alone.join(near.hint("merge"), [*same, F.expr("image_uid <> other and abs(tile_x - ox) < w and abs(tile_y - oy) < h")], "left_semi")
    key = F.col("source_mosaic").alias("group_key")
    return placed.where("not alone").select(key, "image_uid").unionByName(met.select(key, "image_uid")).distinct()


#: Probes of a band at most, share of all pairs that an index may meet, and values of a block that are compared with each other.
PROBES, SELECTIVE, BLOCK = 200, 1 / 64, 8192


def _bands(most: int) -> tuple[int, int, float]:
    """Bands, errors allowed in one, and the share of random pairs that meet, for the best index of 64 bits at this distance."""
    found = [(1, most, 1.0)]
    for bands in range(2, 17):
        errors, width = most // bands, 64 // bands  # at least one band has no more than its share of errors
        probes = sum(comb(width + 1, e) for e in range(errors + 1))
        if probes <= PROBES:
            found.append((bands, errors, bands * probes / 2**width))
    return min(found, key=lambda f: f[2])


def hamming_pairs(hashes: DataFrame, most: int = 6, value: str = "bits") -> DataFrame:
    """Pairs of distinct 64-bit values at most ``most`` bits apart: ``a, b, distance`` with a < b.

    Up to some ten bits, by a multi-index: the value is cut into bands, one of which must have no more than its share of the
    errors, so every band of one side meets the other side's under each choice of so many flipped bits (at distance 6, four
    bands of 16 bits with one error: 17 probes a band, about n^2 / 960 rows met); a pair is kept by the first such band.
    Beyond, no index thins random values, and blocks of values are compared as packed words, each pair of blocks in a task.
    """
    distinct = hashes.select(F.col(value).cast("bigint").alias("v")).where("v is not null").distinct()
    bands, errors, share = _bands(most)
    if share > SELECTIVE:
        return _blockwise(distinct, most)
    cuts = [64 * k // bands for k in range(bands + 1)]
    band = lambda c, k: F.shiftrightunsigned(c, cuts[k]).bitwiseAND(F.lit((1 << (cuts[k + 1] - cuts[k])) - 1))
    flips = [[sum(1 << p for p in at) for e in range(errors + 1) for at in combinations(range(cuts[k + 1] - cuts[k]), e)] for k in range(bands)]
    # a band's number stands above its bits
    own = F.array(*[band(F.col("v"), k) + F.lit(k << 40) for k in range(bands)])
    numbered = lambda k: lambda f: (band(F.col("v"), k).bitwiseXOR(f) + F.lit(k << 40)).cast("bigint")
    probes = F.concat(*[F.transform(F.array(*[F.lit(f).cast("bigint") for f in flips[k]]), numbered(k)) for k in range(bands)])
    a = distinct.select(F.col("v").alias("a"), F.explode(own).alias("part"))
    b = distinct.select(F.col("v").alias("b"), F.explode(probes).alias("part"))
    x = F.col("a").bitwiseXOR(F.col("b"))
    earlier = F.lit(False)
    for k in range(bands):
        earlier = earlier | ((F.col("part") >= F.lit((k + 1) << 40)) & (F.bit_count(band(x, k)) <= errors))
    met = a.join(b, "part").where((F.col("a") < F.col("b")) & (F.bit_count(x) <= most) & ~earlier)
    return met.select("a", "b", F.bit_count(x).cast("int").alias("distance"))


def _blockwise(distinct: DataFrame, most: int) -> DataFrame:
    """Pairs of values within a distance, by comparing blocks of about BLOCK values; each value goes to every block once."""
    blocks = max(1, -(-distinct.count() // BLOCK))
    dealt = distinct.withColumn("block", F.pmod(F.xxhash64("v"), F.lit(blocks)).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    met = met.select("v", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        low, high = key[0].as_py(), key[1].as_py()
        v, block = table["v"].to_numpy(), table["block"].to_numpy()
        left, right = np.sort(v[block == low]), np.sort(v[block == high])
        found = []
        for first in range(0, len(left), 128):
            part = left[first : first + 128]
            apart = np.bitwise_count(part[:, None].view(np.uint64) ^ right[None, :].view(np.uint64))
            near = apart <= most
            if low == high:
                near &= part[:, None] < right[None, :]
            i, j = np.nonzero(near)
            found.append((part[i], right[j], apart[i, j]))
        x, y, n = (np.concatenate(c) if found else np.zeros(0, np.int64) for c in (zip(*found) if found else [()] * 3))
        return pa.table({"a": np.minimum(x, y), "b": np.maximum(x, y), "distance": n.astype(np.int32)})

    return met.groupBy("low", "high").applyInArrow(run, "a long, b long, distance int")


def perceptual_groups(rows: DataFrame, uid: str = "image_uid", value: str = "bits", most: int = 6) -> DataFrame:
    """Rows whose values chain within ``most`` bits, groups of two rows or more: ``group_key`` (least value), ``image_uid``."""
    found = connected_components(hamming_pairs(rows, most, value), one_task=FEW_EDGES)
    known = rows.where(F.col(value).isNotNull()).select(F.col(uid).alias("image_uid"), F.col(value).cast("bigint").alias("v"))
    named = known.join(found, F.col("v") == F.col("node"), "left").select("image_uid", F.coalesce("component", "v").alias("group_key"))
    shared = named.groupBy("group_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("group_key")
    return named.join(shared, "group_key", "left_semi").select("group_key", "image_uid")


def skipped_blocks(rows: DataFrame, block: list[str], most: int = 4000) -> DataFrame:
    """blocks of more than ``most`` rows, in which ``near_sizes`` looks for nothing, and their rows."""
    return rows.groupBy(*block).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > most)


def perceptual_summary(rows: DataFrame, value: str = "bits") -> DataFrame:
    """One row: ``hashed`` rows, ``distinct_hashes``, and rows ``sharing`` theirs with another."""
    per = rows.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return per.agg(total("n").alias("hashed"), F.count(F.lit(1)).alias("distinct_hashes"), total(F.when(F.col("n") > 1, F.col("n"))).alias("sharing"))


def near_sizes(rows: DataFrame, block: list[str], size: str, uid: str, key: str, tolerance: float = 0.02, most: int | None = 4000) -> DataFrame:
    """Neighbours by size within a block of 2 to ``most`` rows (None: any number), of other content, sizes within the tolerance.

    Blocks beyond the limit are counted by an aggregate and never reach a sort; ``skipped_blocks`` names them.
    """
    counts = rows.groupBy(*block).agg(F.count(F.lit(1)).alias("_n")).where("_n >= 2")
    fit = counts if most is None else counts.where(F.col("_n") <= most)
    held = rows.join(fit.select(*[F.col(c).alias(f"_{c}") for c in block]), [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in block], "left_semi")
    by = Window.partitionBy(*block).orderBy(size, uid)
    step = held.select(
        *block, F.col(uid).alias("a"), F.col(size).alias("size_a"), F.col(key).alias("_key"),
        F.lead(uid).over(by).alias("b"), F.lead(size).over(by).alias("size_b"), F.lead(key).over(by).alias("_next"),
    )
    close = F.abs(F.col("size_b") - F.col("size_a")) / F.col("size_a") <= tolerance
    return step.where(F.col("b").isNotNull() & (F.col("size_a") > 0) & (F.col("_key") != F.col("_next")) & close).select(*block, "a", "b", "size_a", "size_b")


def resume_todo(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """rows whose key isn't done."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """All new rows, and the old ones whose key isn't new."""
    return resume_todo(old, new, key).unionByName(new)
