"""Tile plans and stitching."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.lattice import check_halo, grid_size
from granary.sinks import DataQualityError

FIELDS = ("read_x0", "read_y0", "read_x1", "read_y1", "keep_col0", "keep_row0", "trim_left", "trim_top")


def plan(images: DataFrame, width: Column, height: Column, core: int, halo: int, stride: int) -> DataFrame:
    """One row per image and tile, by rows then columns: what to read, where its cells go, what to trim."""
    check_halo(halo, stride)
    check_halo(core, stride, "core")
    w, h = width.cast("int"), height.cast("int")
    steps = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(core))).otherwise(F.array().cast("array<int>"))
    tiles = images.withColumn("_w", w).withColumn("_h", h)
    tiles = tiles.withColumn("_y", F.explode(steps(F.col("_h")))).withColumn("_x", F.explode(steps(F.col("_w"))))
    x, y = F.col("_x"), F.col("_y")
    zero = F.lit(0)
    x0, y0 = F.greatest(zero, x - halo), F.greatest(zero, y - halo)
    div = lambda c: F.floor(c / stride).cast("int")
    columns = (x0, y0, F.least(F.col("_w"), x + core + halo), F.least(F.col("_h"), y + core + halo), div(x), div(y), div(x - x0), div(y - y0))
    return tiles.withColumns(dict(zip(FIELDS, columns))).drop("_x", "_y", "_w", "_h")


def kept_spans(tiles: DataFrame, keys: list[str], width: Column, height: Column, core: int, stride: int) -> DataFrame:
    """The cells each tile writes, one row per tile and grid row: ``keys, row, first, end``; a sliver beyond the grid writes none."""
    rows, cols = grid_size(height, stride), grid_size(width, stride)
    last = lambda start, n: F.least(start + core // stride, n).cast("int")
    held = tiles.withColumn("_r", last(F.col("keep_row0"), rows)).withColumn("_c", last(F.col("keep_col0"), cols))
    held = held.where("_r > keep_row0 and _c > keep_col0")
    return held.select(*keys, F.explode(F.sequence("keep_row0", F.col("_r") - 1)).alias("row"), F.col("keep_col0").alias("first"), F.col("_c").alias("end"))


def write_counts(spans: DataFrame, images: DataFrame, key: str, width: Column, height: Column, stride: int) -> DataFrame:
    """Per image the cells of its grid, those never written and those written more than once.

    A grid row's spans, sorted by start, are folded once: how far the row is written at all, and how far twice.  No cell
    becomes a row.
    """
    line = spans.groupBy(key, "row").agg(F.array_sort(F.collect_list(F.struct("first", "end"))).alias("s"))
    zero = F.lit(0)
    start = F.struct(zero.alias("once"), zero.alias("twice"), zero.alias("written"), zero.alias("doubles"))

    def step(a: Column, x: Column) -> Column:
        both = F.least(x.end, a.once)
        return F.struct(
            F.greatest(a.once, x.end).alias("once"),
            F.greatest(a.twice, both).alias("twice"),
            (a.written + F.greatest(zero, x.end - F.greatest(x.first, a.once))).alias("written"),
            (a.doubles + F.greatest(zero, both - F.greatest(x.first, a.twice))).alias("doubles"),
        )

    folded = line.select(key, F.aggregate("s", start, step).alias("f"))
    per = folded.groupBy(key).agg(F.sum("f.written").alias("written"), F.sum("f.doubles").alias("doubles"))
    out = images.select(key, (grid_size(height, stride) * grid_size(width, stride)).alias("cells")).join(per, key, "left")
    written = F.coalesce("written", F.lit(0))
    return out.select(key, "cells", (F.col("cells") - written).cast("bigint").alias("holes"), F.coalesce("doubles", F.lit(0)).cast("bigint").alias("doubles"))


def stitch(
    tiles: DataFrame, key: str, width: str, height: str, core: int, stride: int, run: Callable[[int, int, int, int], np.ndarray]
) -> DataFrame:
    """``run(x0, y0, x1, y1)`` on every tile, its halo trimmed: ``key, row, col, values``.  Tiles are independent rows."""
    kind = tiles.schema[key].dataType.simpleString()

    def step(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for t in frame.itertuples(index=False):
                got = run(t.read_x0, t.read_y0, t.read_x1, t.read_y1)
                n_rows = min(core // stride, getattr(t, height) // stride - t.keep_row0)
                n_cols = min(core // stride, getattr(t, width) // stride - t.keep_col0)
                part = got[t.trim_top : t.trim_top + max(0, n_rows), t.trim_left : t.trim_left + max(0, n_cols)]
                r, c = np.indices(part.shape[:2])
                if part.size:
                    yield pd.DataFrame(
                        {key: getattr(t, key), "row": r.ravel() + t.keep_row0, "col": c.ravel() + t.keep_col0, "values": list(part.reshape(-1, part.shape[2]).astype(np.float32))}
                    )

    return tiles.mapInPandas(step, f"{key} {kind}, row long, col long, values array<float>")


def enforce_written_once(counts: DataFrame) -> None:
    r = counts.agg(F.sum("holes").alias("holes"), F.sum("doubles").alias("doubles")).first()
    if r.holes or r.doubles:
        raise DataQualityError(f"{r.holes} cells were never written and {r.doubles} more than once")
