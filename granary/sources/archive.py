"""Zip archives of annotated photographs (S1-S7, K7): a Python data source, and manifest and instances made from it.

The source lists archives in order and gives each to one partition, which reads the zip directory and the small JSON
members; image bytes are read, member by member, only if asked for.  Everything after that is joins and expressions.
"""

from __future__ import annotations

import os
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from granary.functions import names
from granary.functions.geometry import marks
from granary.functions.hashing import content_hash
from granary.schemas import INSTANCES, MANIFEST
from granary.session import written

MEMBERS = "archive string, archive_ordinal int, member string, ordinal int, crc long, size_bytes long, content binary, error string"
SHAPE = "struct<frame:int,type:string,label:string,points:array<double>>"
TRACKED = "struct<frame:int,type:string,label:string,points:array<double>>"
BLOCKS = f"array<struct<shapes:array<{SHAPE}>,tracks:array<struct<label:string,shapes:array<{TRACKED}>>>>>"
_ROWS = 64


class _Archive(InputPartition):
    def __init__(self, path: str, ordinal: int):
        self.path, self.ordinal = path, ordinal


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = options["path"]
        self.bytes = options.get("include_bytes", "false").lower() == "true"
        self.limit = int(options.get("limit", 0))

    def partitions(self) -> list[_Archive]:
        found = sorted(n for n in os.listdir(self.root) if n.lower().endswith(".zip"))
        return [_Archive(os.path.join(self.root, n), k) for k, n in enumerate(found[: self.limit] if self.limit else found)]

    def read(self, part: _Archive) -> Iterator[pa.RecordBatch]:
        name = os.path.basename(part.path)
        schema = pa.schema(
            [("archive", pa.string()), ("archive_ordinal", pa.int32()), ("member", pa.string()), ("ordinal", pa.int32()), ("crc", pa.int64()),
             ("size_bytes", pa.int64()), ("content", pa.binary()), ("error", pa.string())]
        )
        rows: list[tuple] = []
        try:
            with zipfile.ZipFile(part.path) as z:
                for k, info in enumerate(z.infolist()):
                    if info.is_dir():
                        continue
                    data = error = None
                    if self.bytes or info.filename.lower().endswith((".json", ".jsonl")):
                        try:
                            data = z.read(info)
                        except Exception as e:  # one bad member must not end the archive
                            error = str(e)
                    rows.append((name, part.ordinal, info.filename, k, info.CRC, info.file_size, data, error))
                    if len(rows) == _ROWS:
                        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)
                        rows = []
        except Exception as e:  # nor one bad archive the run
            rows.append((name, part.ordinal, None, -1, None, None, None, str(e)))
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)


class ZipArchives(DataSource):
    """``spark.read.format("zip_archives").option("include_bytes", "true").load(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "zip_archives"

    def schema(self) -> str:
        return MEMBERS

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def read_members(spark: SparkSession, folder: str, include_bytes: bool = True, limit: int = 0) -> DataFrame:
    """Every member of every archive of a folder that executors can read."""
    spark.dataSource.register(ZipArchives)
    return spark.read.format("zip_archives").option("include_bytes", str(include_bytes).lower()).option("limit", str(limit)).load(folder)


def _text(content: str = "content"):
    return F.decode(content, "UTF-8")


def task_info(members: DataFrame) -> DataFrame:
    """``archive, task, task_name, task_status``; unreadable JSON gives empty texts."""
    found = members.where(F.col("member").rlike(r"^task_\d+/task\.json$"))
    d = F.from_json(_text(), "name string, status string")
    return found.select("archive", names.task_of(F.col("member")).alias("task"), F.coalesce(d["name"], F.lit("")).alias("task_name"), F.coalesce(d["status"], F.lit("")).alias("task_status"))


def frame_order(members: DataFrame) -> DataFrame:
    """``archive, task, name, frame, width, height``: frames by first appearance among the named lines, sizes by the last."""
    found = members.where(F.col("member").rlike(r"^task_\d+/data/manifest\.jsonl$"))
    lines = found.select("archive", names.task_of(F.col("member")).alias("task"), F.posexplode(F.split(_text(), r"\r\n|\r|\n")).alias("pos", "line"))
    line = F.trim("line")
    d = F.from_json(line, "name string, extension string, width string, height string")
    read = lines.where(line.startswith("{")).select("archive", "task", "pos", d.alias("d")).where("d.name is not null")
    ext = F.coalesce("d.extension", F.lit(""))
    full = F.when((ext != "") & ~F.col("d.name").endswith(ext), F.concat("d.name", ext)).otherwise(F.col("d.name"))
    sized = read.select("archive", "task", "pos", names.base_name(full).alias("name"), names.number(F.col("d.width")).alias("w"), names.number(F.col("d.height")).alias("h"))
    per = sized.groupBy("archive", "task", "name").agg(F.min("pos").alias("first"), F.max_by("w", "pos").alias("width"), F.max_by("h", "pos").alias("height"))
    order = Window.partitionBy("archive", "task").orderBy("first")
    return per.select("archive", "task", "name", (F.row_number().over(order) - 1).cast("bigint").alias("frame"), "width", "height")


def shapes(members: DataFrame) -> DataFrame:
    """``archive, task, frame, place, type, label, points``: per block its shapes, then its tracks' keyframes."""
    found = members.where(F.col("member").rlike(r"^task_\d+/annotations\.json$"))
    blocks = found.select("archive", names.task_of(F.col("member")).alias("task"), F.from_json(_text(), BLOCKS).alias("b"))
    one = blocks.select("archive", "task", F.posexplode("b").alias("block", "b"))
    none = F.array().cast(f"array<{SHAPE}>")
    keyed = lambda t: F.transform(
        F.coalesce(t.shapes, none), lambda s: F.struct(s.frame.alias("frame"), s.type.alias("type"), F.coalesce(s.label, t.label).alias("label"), s.points.alias("points"))
    )
    tracked = F.flatten(F.transform(F.coalesce(F.col("b.tracks"), F.array().cast(f"array<struct<label:string,shapes:array<{TRACKED}>>>")), keyed))
    every = F.concat(F.coalesce("b.shapes", none), tracked)
    rows = one.select("archive", "task", "block", F.posexplode(every).alias("at", "s")).where("s.frame is not null")
    w = Window.partitionBy("archive", "task", "s.frame").orderBy("block", "at")
    return rows.select(
        "archive", "task", F.col("s.frame").cast("bigint").alias("frame"), (F.row_number().over(w) - 1).alias("place"),
        F.coalesce("s.type", F.lit("")).alias("type"), F.coalesce("s.label", F.lit("")).alias("label"), F.coalesce("s.points", F.array().cast("array<double>")).alias("points"),
    )


def catalogue(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Manifest and instances of all photographs.

    A photo's frame is its place in the task's manifest.jsonl, never its place in the zip; photos not listed there follow
    the listed ones, in zip order.
    """
    photos = members.where(names.is_image(F.col("member"))).withColumn("task", names.task_of(F.col("member")))
    photos = photos.withColumn("name", names.base_name(F.col("member"))).withColumn("dataset", names.dataset_of(F.col("archive")))
    order = frame_order(members)
    known = order.groupBy("archive", "task").agg(F.count(F.lit(1)).alias("listed"))
    joined = photos.join(order, ["archive", "task", "name"], "left").join(known, ["archive", "task"], "left")
    w = Window.partitionBy("archive", "task", F.col("frame").isNull()).orderBy("ordinal")
    frame = F.coalesce("frame", F.coalesce("listed", F.lit(0)) + F.row_number().over(w) - 1).cast("bigint")
    joined = joined.withColumn("frame", frame).join(task_info(members), ["archive", "task"], "left")
    uid = names.image_uid(F.col("dataset"), F.col("member"))
    drawn = shapes(members)
    counted = drawn.groupBy("archive", "task", "frame").agg(F.count(F.lit(1)).alias("marks"))
    width, height = F.coalesce("width", F.lit(-1)).cast("bigint"), F.coalesce("height", F.lit(-1)).cast("bigint")
    n = F.coalesce("marks", F.lit(0)).cast("bigint")
    blank = {c: F.lit("") for c in ("phash", "farm", "field", "season", "site_id", "leakage_group_id", "split")}
    columns = {
        "image_uid": uid, "archive": F.col("archive"), "member": F.col("member"), "content_hash": content_hash(F.col("content")),
        "content_key": names.content_key(F.col("crc"), F.col("size_bytes")), "dataset": F.col("dataset"),
        "task_name": F.coalesce("task_name", F.lit("")), "task_status": F.coalesce("task_status", F.lit("")), "frame_index": F.col("frame"),
        "image_name": F.col("name"), "extension": names.extension(F.col("name")), "width": width, "height": height,
        "megapixels": names.megapixels(width, height), "size_bytes": F.col("size_bytes"), "has_annotation": (n > 0).cast("bigint"),
        "n_annotations": n, "exhaustive": F.lit("unknown"), **blank, **names.parsed(names.stem(F.col("name"))),
    }
    full = joined.join(counted, ["archive", "task", "frame"], "left")
    manifest = full.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in MANIFEST])
    keyed = joined.select("archive", "task", "frame", uid.alias("image_uid"))
    met = drawn.join(keyed, ["archive", "task", "frame"])
    rows = met.select("image_uid", "label", "place", F.posexplode(marks(F.col("type"), F.col("points"))).alias("i", "m"))
    own = {
        "instance_id": F.concat_ws("-", "image_uid", "place", "i"), "label_raw": F.col("label"), "label_canon": F.lit(""), "is_crowd": F.lit(0),
        "image_uid": F.col("image_uid"), **{c: F.col(f"m.{c}") for c in ("shape_type", "x", "y", "w", "h", "area_px", "points_wkt")},
    }
    instances = rows.select(*[own[f.name].cast(f.dataType).alias(f.name) for f in INSTANCES])
    return manifest, instances


def read_archives(spark: SparkSession, folder: str, include_bytes: bool = True, limit: int = 0) -> tuple[DataFrame, DataFrame]:
    """S1-S7 to manifest and instances; members are written once, since several joins read them."""
    return catalogue(written(read_members(spark, folder, include_bytes, limit), "members"))
