"""Writers (K1-K6, K8)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.schemas import SPLITS


class DataQualityError(RuntimeError):
    """A gate found rows that must not be there (K8)."""


def write_table(df: DataFrame, path: str) -> None:
    """K1, K2: replace a table; an empty one keeps its schema."""
    df.write.mode("overwrite").parquet(path)


def write_by_split(df: DataFrame, path: str, column: str = "split") -> None:
    """K3: one folder a split; folders of splits without rows go too, unlike in a per-file write."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(column).parquet(path)


def with_side_table(main: DataFrame, side: DataFrame, key: str, columns: list[str], default: dict | None = None) -> DataFrame:
    """``main`` with the columns replaced from a side table; nothing is rewritten in place."""
    picked = side.select(key, *columns)
    out = main.drop(*[c for c in columns if c in main.columns]).join(picked, key, "left")
    return out.fillna(default) if default else out


def next_version(spark: SparkSession, df: DataFrame, root: str) -> str:
    """K4: write ``root/v=N`` for the next N, so a table can be made from its last version."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(root)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    n = max([int(x[2:]) for x in found if x.startswith("v=") and x[2:].isdigit()], default=0) + 1
    df.write.parquet(f"{root}/v={n}")
    return f"{root}/v={n}"


def write_report(spark: SparkSession, summary: dict, path: str) -> None:
    """K5: a bounded summary as JSON, wherever Spark can write; groups are written as tables beside it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(json.dumps(summary, indent=2, sort_keys=True).encode()))
    finally:
        out.close()


def split_document(assigned: DataFrame, families: DataFrame, seed: int) -> dict:
    """K5: the summary of a split assignment (five rows)."""
    rows = {r.split: r.asDict() for r in assigned.collect()}
    return {
        "seed": seed,
        "photographs": sum(r["photographs"] for r in rows.values()),
        "families": families.count(),
        "splits": {s: {k: v for k, v in rows[s].items() if k != "split"} for s in SPLITS if s in rows},
    }


def write_sheet(df: DataFrame, path: str) -> None:
    """K6: a review sheet as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def enforce(checks: DataFrame, max_report: int = 5) -> DataFrame:
    """K8: raise if any fatal check has bad rows; else the checks."""
    failed = checks.where(F.col("fatal") & (F.col("bad") > 0)).orderBy(F.desc("bad")).limit(max_report).collect()
    if failed:
        raise DataQualityError("; ".join(f"{r['check']}: {r.bad} of {r.total}" for r in failed))
    return checks
