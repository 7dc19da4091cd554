"""Sheets and reports that people and earlier stages leave."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.schemas import SchemaError


def read_sheet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A CSV sheet with a header, every cell as text, blanks as empty texts; an error if a needed column is missing."""
    sheet = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path, enforceSchema=False)
    lost = [c for c in columns or [] if c not in sheet.columns]
    if lost:
        raise SchemaError(f"{path}: missing {lost}")
    return sheet.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in sheet.columns])


def exploded(groups: Column, kind: str) -> Column:
    """A JSON object of groups as rows ``k, v``; text that is no such object gives none."""
    return F.explode(F.from_json(groups, f"map<string,{kind}>")).alias("k", "v")


def read_groups(spark: SparkSession, path: str, field: str) -> DataFrame:
    """The object ``field`` of a JSON report, from group to list of members: ``group_key, image_uid``."""
    text = spark.read.text(path, wholetext=True)
    named = text.select(exploded(F.get_json_object("value", f"$.{field}"), "array<string>"))
    return named.select(F.col("k").alias("group_key"), F.explode("v").alias("image_uid"))
