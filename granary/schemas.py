"""Declared tables, constants, and the check that a frame has a table's columns (V0)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: The piles, the share of each, and reasons for a family with their ranks, strongest first.
SPLITS = ("train", "dev_cal", "dev_select", "dev_confirm", "sealed_test")
SHARES = (0.60, 0.10, 0.10, 0.10, 0.10)
EVIDENCE = ("duplicate", "mosaic", "flight", "spacetime", "perceptual", "site")
TASK_STATUSES = ("annotation", "completed", "validation")
EXHAUSTIVE = ("yes", "no", "unknown")


class SchemaError(ValueError):
    """A frame lacks columns, has others than declared, or has them in other types."""


_TYPES = {"string": T.StringType(), "long": T.LongType(), "double": T.DoubleType(), "array<double>": T.ArrayType(T.DoubleType())}


def _table(spec: str) -> T.StructType:
    """Name and type pairs; parsed here, since a DDL parser needs a session."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (part.split() for part in spec.split(","))])


#: Columns and types of the tables.
MANIFEST = _table(
    "image_uid string, archive string, member string, content_hash string, phash string, content_key string, dataset string,"
    " task_name string, task_status string, frame_index long, image_name string, extension string, width long, height long,"
    " megapixels double, size_bytes long, sensor string, band string, capture_datetime string, capture_year long, flight_id string,"
    " source_mosaic string, tile_x long, tile_y long, tile_row long, tile_col long, geo_x double, geo_y double, has_annotation long,"
    " n_annotations long, farm string, field string, season string, site_id string, leakage_group_id string, split string,"
    " exhaustive string"
)
INSTANCES = _table(
    "image_uid string, instance_id string, label_raw string, label_canon string, shape_type string, x double, y double, w double,"
    " h double, area_px double, points_wkt string, is_crowd long"
)
COVERAGE = _table("image_uid string, reviewed long, exhaustive long, reviewer string, reviewed_at string, source string")
LINEAGE = _table("image_uid string, leakage_group_id string, evidence string, evidence_rank long")
ONTOLOGY = _table("label_raw string, label_canon string, domain string, decision string, approved_by string, approved_at string")
EPISODES = _table(
    "episode_id string, split string, label string, support_uid string, query_uid string, support_x array<double>,"
    " support_y array<double>, query_x array<double>, query_y array<double>, n_support long, n_query long, same_family long,"
    " sampler_version long, seed long"
)


def require(df: DataFrame, schema: T.StructType, name: str = "table", allow_extra: bool = True, types: bool = False) -> DataFrame:
    """``df``, if it has the columns of ``schema`` (and, if asked, no others and the same types); no job runs."""
    own = {f.name: f.dataType for f in df.schema}
    missing = [f.name for f in schema if f.name not in own]
    extra = [] if allow_extra else [c for c in own if c not in schema.names]
    wrong = [f.name for f in schema if types and f.name in own and own[f.name].simpleString() != f.dataType.simpleString()]
    if missing or extra or wrong:
        raise SchemaError(f"{name}: missing {missing}, unexpected {extra}, of another type {wrong}")
    return df


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """K2: no rows, all columns."""
    return spark.createDataFrame([], schema)
