"""Label keys and review notes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters that must stay for trailing digits to go, and words that name a state, not a kind.
LEAST_STEM = 4
MODIFIERS = (
    "ripe", "unripe", "green", "dry", "dried", "fresh", "old", "young", "new", "large", "small", "big", "cut", "uncut",
    "damaged", "healthy", "dead",
)


def label_key(raw: Column) -> Column:
    """One key for spellings that differ in case, spaces, hyphens, punctuation, a final number or a plural s."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_replace(raw, r"^\s+|\s+$", "")), r"[\s\-]+", "_"), r"[^a-z0-9_]", "")
    bare = F.regexp_replace(plain, r"_?[0-9]+$", "")
    key = F.when(F.length(bare) >= LEAST_STEM, bare).otherwise(plain)
    single = F.when((F.length(key) > 3) & key.endswith("s"), F.substr(key, F.lit(1), F.length(key) - 1)).otherwise(key)
    return F.when(single == "", "unknown").otherwise(single)


def review_note(key: Column, spellings: Column) -> Column:
    """The first warning that applies to a key with so many spellings."""
    return (
        F.when(key.isin(*MODIFIERS), "modifier, not a species?")
        .when(key.rlike(r"^[a-z]{1,3}[0-9]+$"), "SHORT CODE -- separate plots, not spellings?")
        .when(spellings > 1, F.concat(spellings.cast("string"), F.lit(" spellings share this key")))
        .otherwise("")
    )
