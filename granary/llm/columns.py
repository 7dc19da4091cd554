"""Columns of tables whose names are not known: any may clash, with each other or with what an operator adds."""

from __future__ import annotations

from pyspark.sql import DataFrame


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns named ``c0``, ``c1`` and so on, by place, and the new name of each first column of a name."""
    names = [f"c{k}" for k in range(len(df.columns))]
    found: dict[str, str] = {}
    for old, new in zip(df.columns, names):
        found.setdefault(old, new)
    return df.toDF(*names), found


def fresh(taken: list[str], added: list[str]) -> list[str]:
    """The names to add, with underscores behind those that are taken in whatever case."""
    low = {c.lower() for c in taken}
    out = []
    for name in added:
        while name.lower() in low:
            name += "_"
        low.add(name.lower())
        out.append(name)
    return out
