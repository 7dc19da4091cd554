"""Cells of a strided grid."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def grid_size(pixels: Column, stride: Column | int) -> Column:
    """Whole cells of a length; a partial one is left out."""
    return F.floor(pixels / F.lit(stride)).cast("bigint")


def cell_of(pixel: Column, stride: Column | int) -> Column:
    """Floors negatives too."""
    return F.floor(pixel / F.lit(stride)).cast("bigint")


def centre_of(cell: Column, stride: Column | int) -> Column:
    """P31."""
    return (cell + 0.5) * F.lit(stride)


def rounded_halo(halo: Column, stride: Column | int) -> Column:
    """P33."""
    return (F.ceil(halo / F.lit(stride)) * F.lit(stride)).cast("bigint")


def check_halo(halo: int, stride: int, name: str = "halo") -> int:
    """``halo``, or an error that names the multiples on either side."""
    if stride <= 0 or halo < 0:
        raise ValueError(f"{name} {halo} and stride {stride} must not be negative or zero")
    if halo % stride:
        below = halo - halo % stride
        raise ValueError(f"{name} {halo} is no multiple of the stride {stride}; the nearest are {below} and {below + stride}")
    return halo
