"""Scalar functions on hand-made cases."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.functions import geometry, hashing, labels, lattice, names


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(k) for k, c in columns.items()]).first()


@pytest.mark.parametrize(
    "raw,key",
    [("Garlic Plant-2", "garlic_plant"), ("garlic_10", "garlic"), ("trees", "tree"), ("z11", "z11"), ("CNG1", "cng1"), ("black grass", "black_gras"),
     ("gas", "gas"), ("!!", "unknown"), ("", "unknown"), ("\tRipe ", "ripe"), ("abc_12", "abc_12")],
)
def test_label_key(spark, raw, key):
    assert one(spark, k=labels.label_key(F.lit(raw))).k == key


@pytest.mark.parametrize("key,n,note", [("ripe", 2, "modifier, not a species?"), ("z11", 2, "SHORT CODE -- separate plots, not spellings?"), ("garlic", 2, "2 spellings share this key"), ("garlic", 1, "")])
def test_review_note(spark, key, n, note):
    assert one(spark, n=labels.review_note(F.lit(key), F.lit(n))).n == note


@pytest.mark.parametrize(
    "name,want",
    [
        ("DJI_20250602104520_0007_D", {"sensor": "DJI", "capture_datetime": "2025-06-02 10:45:20", "capture_year": 2025, "flight_id": "DJI_20250602104520", "source_mosaic": "DJI_20250602104520_0007", "band": "D"}),
        ("DJI_0141_4", {"sensor": "DJI", "source_mosaic": "DJI_0141", "capture_datetime": "", "capture_year": -1, "tile_x": -1}),
        ("north_12 (1024, 2048)", {"source_mosaic": "north", "tile_x": 1024, "tile_y": 2048, "sensor": ""}),
        ("crop_5_10_20", {"source_mosaic": "crop_5", "tile_x": 10, "tile_y": 20}),
        ("a_PHANTOM_tile_R3_c7", {"sensor": "DJI Phantom", "tile_row": 3, "tile_col": 7, "source_mosaic": ""}),
        ("splitted_1_-12.5_33.25", {"geo_x": -12.5, "geo_y": 33.25}),
        ("crop_5_10_20 (1,2)", {"source_mosaic": "crop_5_10", "tile_x": 1, "tile_y": 2}),
    ],
)
def test_parsed_names(spark, name, want):
    got = one(spark, **names.parsed(F.lit(name)))
    assert {k: got[k] for k in want} == want


def test_paths_and_keys(spark):
    r = one(
        spark, stem=names.stem(F.lit("a.b.JPG")), ext=names.extension(F.lit("a.b.JPG")), none=names.extension(F.lit("noext")), hidden=names.stem(F.lit(".x")),
        task=names.task_of(F.lit("task_12/data/x.jpg")), image=names.is_image(F.lit("x/y.TIFF")), no=names.is_image(F.lit("x.jpg/")),
        key=names.content_key(F.lit(255).cast("bigint"), F.lit(7)), n=names.number(F.lit("abc")), ok=names.number(F.lit("2025")), blank=names.number(F.lit("")),
        mp=names.megapixels(F.lit(4000), F.lit(3000)), dedup=hashing.dedup_key(F.lit(""), F.lit("k1")), own=hashing.dedup_key(F.lit("h1"), F.lit("k1")),
    )
    assert r.asDict() == {
        "stem": "a.b", "ext": "jpg", "none": "", "hidden": ".x", "task": "task_12", "image": True, "no": False, "key": "000000ff-7", "n": -1, "ok": 2025,
        "blank": -1, "mp": 12.0, "dedup": "k1", "own": "h1",
    }


def test_hamming_and_hex(spark):
    r = one(spark, d=hashing.hamming(F.lit(0).cast("bigint"), F.lit(15).cast("bigint")), all=hashing.hamming(F.lit(0).cast("bigint"), F.lit(-1).cast("bigint")),
            v=hashing.bits_of_hex(F.lit("ffffffffffffffff")), bad=hashing.bits_of_hex(F.lit("xyz")), h=hashing.hex_of_bits(F.lit(31337).cast("bigint")))
    assert (r.d, r.all, r.v, r.bad, r.h) == (4, 64, -1, None, "0000000000007a69")


def test_image_hash_survives_brightness_and_size(spark):
    rng = np.random.default_rng(1)
    base = np.kron(rng.integers(20, 120, (8, 8)), np.ones((16, 16))).astype(np.uint8)
    images = [base, (base * 1.5).astype(np.uint8), np.kron(base, np.ones((2, 2))).astype(np.uint8), rng.integers(0, 255, (64, 64)).astype(np.uint8)]
    rows = [(k, i.tobytes(), *i.shape) for k, i in enumerate(images)] + [(9, b"", 1, 1)]
    df = spark.createDataFrame(rows, "k int, data binary, height int, width int")
    got = {r.k: r.bits for r in hashing.with_perceptual_hash(df).collect()}
    apart = lambda a, b: bin((got[a] ^ got[b]) & (2**64 - 1)).count("1")
    assert apart(0, 1) <= 4 and apart(0, 2) <= 4 and apart(0, 3) > 14 and got[9] is None


def shape(spark, kind, flat):
    df = spark.createDataFrame([(kind, [float(v) for v in flat])], "kind string, flat array<double>")
    return [tuple(r.m) for r in df.select(F.explode(geometry.marks(F.col("kind"), F.col("flat"))).alias("m")).collect()]


def test_marks(spark):
    assert [m[1:3] for m in shape(spark, "points", [1.0, 2, 3, 4, 5])] == [(1, 2), (3, 4)]
    assert shape(spark, "rectangle", [30.0, 40, 10, 20]) == [("rectangle", 20, 30, 20, 20, 400, "")]
    ((_, x, y, w, h, area, text),) = shape(spark, "polygon", [10.0, 20, 30, 20, 30, 40])
    assert (round(x, 2), round(y, 2), w, h, area, text) == (23.33, 26.67, 20, 20, 200, "POLYGON((10.0 20.0, 30.0 20.0, 30.0 40.0))")
    assert shape(spark, "polyline", [10.0, 20, 30, 20, 30, 40])[0][5] == 400
    for kind, flat in (("polyline", [1.0, 2, 3, 4]), ("ellipse", [1.0, 2, 3, 4]), ("points", [1.0]), ("points", []), ("rectangle", [1.0])):
        assert shape(spark, kind, flat) == []


def test_lattice(spark):
    r = one(spark, a=lattice.cell_of(F.lit(31), 16), b=lattice.centre_of(F.lit(3), 16), c=lattice.cell_of(F.lit(-1), 16), d=lattice.rounded_halo(F.lit(144), 32), e=lattice.grid_size(F.lit(47), 16))
    assert (r.a, r.b, r.c, r.d, r.e) == (1, 56, -1, 160, 2)
    with pytest.raises(ValueError, match="128 and 160"):
        lattice.check_halo(144, 32)
    assert lattice.check_halo(64, 32) == 64
