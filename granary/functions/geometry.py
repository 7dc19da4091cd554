"""Marks to boxes and outlines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Channel means and deviations by which pixels are normalised.
MEAN = (0.485, 0.456, 0.406)
DEVIATION = (0.229, 0.224, 0.225)


def pairs(flat: Column) -> Column:
    """[x1, y1, x2, ...] as structs (x, y); an odd last number is left out."""
    n = F.floor(F.size(flat) / 2).cast("int")
    own = F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.struct(F.get(flat, 2 * k).alias("x"), F.get(flat, 2 * k + 1).alias("y")))
    return F.when(n > 0, own).otherwise(F.array().cast("array<struct<x:double,y:double>>"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shoelace(points: Column) -> Column:
    """Area inside the closed outline."""

    def area(p: Column) -> Column:
        n = F.size(p)
        step = lambda i: F.get(p, i).x * F.get(p, (i + 1) % n).y - F.get(p, (i + 1) % n).x * F.get(p, i).y
        return F.abs(F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0.0), lambda a, i: a + step(i))) / 2

    return let(points, area)


def python_float(x: Column) -> Column:
    """A double as Python writes it, for values below 1e16: 10.0, 0.5."""
    return x.cast("double").cast("string")


def outline_text(points: Column) -> Column:
    """POLYGON((x y, ...)), not closed."""
    each = F.transform(points, lambda p: F.concat_ws(" ", python_float(p.x), python_float(p.y)))
    return F.concat(F.lit("POLYGON(("), F.array_join(each, ", "), F.lit("))"))


_MARK = "array<struct<shape_type:string,x:double,y:double,w:double,h:double,area_px:double,points_wkt:string>>"


def marks(kind: Column, flat: Column) -> Column:
    """The instances of one shape: dots, one box, or one outline; other shapes and too short lists give none."""
    p = pairs(flat)
    one = lambda x, y, w, h, area, text: F.struct(
        kind.alias("shape_type"), x.alias("x"), y.alias("y"), w.alias("w"), h.alias("h"), area.alias("area_px"), text.alias("points_wkt")
    )
    zero, blank = F.lit(0.0), F.lit("")
    dots = F.transform(p, lambda q: one(q.x, q.y, zero, zero, zero, blank))
    a = [F.get(flat, k) for k in range(4)]
    left, right, top, bottom = F.least(a[0], a[2]), F.greatest(a[0], a[2]), F.least(a[1], a[3]), F.greatest(a[1], a[3])
    width, height = right - left, bottom - top
    box = F.array(one((left + right) / 2, (top + bottom) / 2, width, height, width * height, blank))

    def traced(q: Column) -> Column:
        return let(F.transform(q, lambda v: v.x), lambda xs: let(F.transform(q, lambda v: v.y), lambda ys: shape(q, xs, ys)))

    def shape(q: Column, xs: Column, ys: Column) -> Column:
        mean = lambda v: F.aggregate(v, F.lit(0.0), lambda s, x: s + x) / F.size(v)
        w, h = F.array_max(xs) - F.array_min(xs), F.array_max(ys) - F.array_min(ys)
        return one(mean(xs), mean(ys), w, h, F.when(kind == "polygon", shoelace(q)).otherwise(w * h), outline_text(q))

    outline = F.array(let(p, traced))
    n = F.size(flat)
    return (
        F.when((kind == "points") & (n >= 2), dots.cast(_MARK))
        .when((kind == "rectangle") & (n >= 4), box.cast(_MARK))
        .when(kind.isin("polygon", "polyline") & (n >= 6), outline.cast(_MARK))
        .otherwise(F.array().cast(_MARK))
    )


def mapped_point(x: Column, y: Column, width: Column, height: Column, flip_x: Column, flip_y: Column, turns: Column) -> tuple[Column, Column]:
    """I4: where a pixel goes when an image is flipped and then turned by quarters, counter-clockwise."""
    fx = F.when(flip_x, width - 1 - x).otherwise(x)
    fy = F.when(flip_y, height - 1 - y).otherwise(y)
    k = F.pmod(turns, F.lit(4))
    new_x = F.when(k == 1, fy).when(k == 2, width - 1 - fx).when(k == 3, height - 1 - fy).otherwise(fx)
    new_y = F.when(k == 1, width - 1 - fx).when(k == 2, height - 1 - fy).when(k == 3, fx).otherwise(fy)
    return new_x, new_y


def normalised(value: Column, channel: int) -> Column:
    """I1 for one 0-255 value of a channel."""
    return (value.cast("double") / 255 - MEAN[channel]) / DEVIATION[channel]
