"""Facts in file names and paths (P1-P16, F1, S3): Column in, Column out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The patterns of names.
IMAGE = r"(?i)\.(jpg|jpeg|png|tif|tiff|bmp|webp)$"
TASK = r"^(task_\d+)/"
DJI_TIMED = r"DJI_(\d{14})_(\d{4})"
DJI_NUMBERED = r"DJI_(\d{4})(?!\d)"
TILE_XY = r"\((\d+)\s*,\s*(\d+)\)"
TILE_ROW_COL = r"(?i)tile_r(\d+)_c(\d+)"
GEO = r"splitted_\d+_(-?\d+\.\d+)_(-?\d+\.\d+)"
CROP = r"crop_(\d+)_(\d+)_(\d+)"
BAND = r"_(D|W|V)(?=[._]|$)"


def number(text: Column, kind: str = "bigint", default: float = -1) -> Column:
    """The number a text spells, else ``default``."""
    return F.coalesce(text.try_cast(kind), F.lit(default).cast(kind))


def is_image(path: Column) -> Column:
    """F1."""
    return path.rlike(IMAGE) & ~path.endswith("/")


def task_of(path: Column) -> Column:
    """S3: the task folder a path starts with, else empty."""
    return F.regexp_extract(path, TASK, 1)


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(name: Column) -> Column:
    """The name without its last extension; a leading dot starts no extension."""
    return F.regexp_replace(name, r"(?<=[^.])\.[^.]*$", "")


def extension(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"[^.]\.([^.]*)$", 1))


def dataset_of(archive: Column) -> Column:
    """An archive's name without its last extension."""
    return stem(base_name(archive))


def image_uid(dataset: Column, member: Column) -> Column:
    """P1."""
    return F.sha1(F.concat(dataset, F.lit("::"), member))


def content_key(crc: Column, size: Column) -> Column:
    """Eight hex digits of a CRC-32, a hyphen, the size in bytes."""
    return F.concat(F.lpad(F.lower(F.hex(crc)), 8, "0"), F.lit("-"), size.cast("string"))


def megapixels(width: Column, height: Column) -> Column:
    """P14."""
    known = (width > 0) & (height > 0)
    return F.when(known, F.round(width.cast("double") * height / 1e6, 3)).otherwise(F.lit(0.0))


def parsed(name: Column) -> dict[str, Column]:
    """What a name without extension tells; unknown texts are empty, unknown numbers -1."""
    got = lambda pattern, k=1: F.regexp_extract(name, pattern, k)
    stamp, flight_no, old = got(DJI_TIMED), got(DJI_TIMED, 2), got(DJI_NUMBERED)
    timed, numbered = stamp != "", old != ""
    piece = lambda at, n: F.substring(stamp, at, n)
    when = F.concat(
        piece(1, 4), F.lit("-"), piece(5, 2), F.lit("-"), piece(7, 2), F.lit(" "), piece(9, 2), F.lit(":"), piece(11, 2), F.lit(":"), piece(13, 2)
    )
    flight = F.concat(F.lit("DJI_"), stamp)
    own = F.when(timed, F.concat(flight, F.lit("_"), flight_no)).when(numbered, F.concat(F.lit("DJI_"), old)).otherwise("")
    tile_x, tile_y = got(TILE_XY), got(TILE_XY, 2)
    head = F.regexp_replace(F.regexp_replace(F.regexp_extract(name, r"^(.*?)" + TILE_XY, 1), r"[_ ]+$", ""), r"_\d+$", "")
    mosaic = F.when((own == "") & (tile_x != ""), head).otherwise(own)
    cropped = (got(CROP) != "") & (mosaic == "")
    return {
        "sensor": F.when(F.contains(F.lower(name), F.lit("phantom")), "DJI Phantom").when(timed | numbered, "DJI").otherwise(""),
        "capture_datetime": F.when(timed, when).otherwise(""),
        "capture_year": number(F.when(timed, piece(1, 4)).otherwise("")),
        "flight_id": F.when(timed, flight).otherwise(""),
        "source_mosaic": F.when(cropped, F.concat(F.lit("crop_"), got(CROP))).otherwise(mosaic),
        "band": got(BAND),
        "tile_x": number(F.when(cropped, got(CROP, 2)).otherwise(tile_x)),
        "tile_y": number(F.when(cropped, got(CROP, 3)).otherwise(tile_y)),
        "tile_row": number(got(TILE_ROW_COL)),
        "tile_col": number(got(TILE_ROW_COL, 2)),
        "geo_x": number(got(GEO), "double"),
        "geo_y": number(got(GEO, 2), "double"),
    }
