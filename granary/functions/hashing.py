"""Content and perceptual fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def content_hash(data: Column) -> Column:
    """128 bits as 32 hex digits; unreadable (null) is empty."""
    return F.coalesce(F.md5(data), F.lit(""))


def dedup_key(hashed: Column, fallback: Column) -> Column:
    """P19."""
    return F.coalesce(F.nullif(hashed, F.lit("")), fallback)


def hamming(a: Column, b: Column) -> Column:
    """P20: bits that differ between two longs."""
    return F.bit_count(a.bitwiseXOR(b)).cast("int")


def bits_of_hex(text: Column) -> Column:
    """Sixteen hex digits as a signed long; anything else is null."""
    return F.when(text.rlike("^[0-9a-fA-F]{16}$"), F.conv(text, 16, -10).cast("bigint"))


def coarse_bits(values: Column) -> Column:
    """P21, last step: 64 coarse components to bits, those above the median of the last 63; the first bit is 0.

    The median is a field of the one element of an array, so that it is evaluated once and not for each component.
    """
    v = F.transform(values, lambda x: x.cast("double"))
    median = F.get(F.sort_array(F.slice(v, 2, 63)), 31)
    once = F.array(F.struct(v.alias("v"), median.alias("m")))
    bits = F.transform(once, lambda s: F.transform(s.v, lambda x, i: F.when((i > 0) & (x > s.m), 1).otherwise(0)))
    return F.when(values.isNotNull(), F.get(bits, 0))


def packed(bits: Column) -> Column:
    """Bits, most significant first, as a long."""
    return F.aggregate(bits, F.lit(0).cast("bigint"), lambda a, b: F.shiftleft(a, 1).bitwiseOR(b.cast("bigint")))


def hex_of_bits(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def _cosines(n: int = 32, keep: int = 8) -> np.ndarray:
    k, x = np.arange(keep)[:, None], np.arange(n)[None, :]
    basis = np.cos(np.pi * (2 * x + 1) * k / (2 * n)) * np.sqrt(2 / n)
    basis[0] /= np.sqrt(2)
    return basis


def thumbnail(grey: np.ndarray, size: int = 32) -> np.ndarray:
    """Bilinear shrink by a triangle filter as wide as the step, so no pixel is skipped."""

    def weights(n: int) -> np.ndarray:
        scale = max(1.0, n / size)
        centre = (np.arange(size)[:, None] + 0.5) * n / size - 0.5
        w = np.maximum(0, 1 - np.abs(np.arange(n)[None, :] - centre) / scale)
        return w / w.sum(axis=1, keepdims=True)

    return weights(grey.shape[0]) @ grey.astype(np.float64) @ weights(grey.shape[1]).T


def coarse_components(grey: np.ndarray) -> np.ndarray:
    """The 8 by 8 lowest cosine components of a grey image."""
    basis = _cosines()
    return (basis @ thumbnail(grey) @ basis.T).ravel()


def _components(pixels: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
    for frame in pixels:
        out = []
        for data, h, w in zip(frame["data"], frame["height"], frame["width"]):
            fine = data is not None and h > 0 and w > 0 and len(data) == h * w
            out.append(coarse_components(np.frombuffer(data, np.uint8).reshape(int(h), int(w))).tolist() if fine else None)
        yield pd.Series(out)


def image_components(pixels: Column) -> Column:
    """P21, pixel step: a struct (data binary of grey bytes, height, width) to its 64 coarse components; bad rows to null."""
    return F.pandas_udf(_components, "array<double>")(pixels)


def with_perceptual_hash(images: DataFrame) -> DataFrame:
    """Grey images (``data, height, width``) with ``bits`` and ``phash``; unreadable ones get null and an empty text."""
    seen = images.withColumn("_components", image_components(F.struct("data", "height", "width")))
    bits = F.when(F.col("_components").isNotNull(), packed(coarse_bits(F.col("_components"))))
    hashed = seen.withColumn("bits", bits).drop("_components")
    return hashed.withColumn("phash", F.coalesce(hex_of_bits(F.col("bits")), F.lit("")))
