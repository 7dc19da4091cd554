"""License notices: exact pigeonhole seeds find candidates, bounded-error regular expressions verify them and give spans.

A text is folded to its words, lower-cased and joined by one space.  A notice of the catalogue may be met with up to
``edits`` insertions, deletions or substitutions of characters, but its leading words of up to three letters must be right
(else "bit license" would be a notice).  The rest, cut into ``edits + 1`` pieces, has at least one piece unchanged in the
text.  So every place of a piece is a seed; the window that a match around it may take is handed to the ``regex`` library's
fuzzy matching, whose best match must keep within the edits and begin and end at word borders; what is left of the window
on either side is searched again.  Of matches that overlap, the one with fewest edits stays.  Windows are as long as a
notice, so the work is in proportion to the seeds.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.session import small_batches

#: Phrases (words as folded) and their labels whose exact places are counted.
BASE_PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

#: Further notices, their labels, and the edits allowed in each.
NOTICES = [
    ("gnu general public license", "gpl", 3),
    ("apache license", "apache", 1),
    ("mit license", "mit", 1),
    ("gnu lesser general public license", "lgpl", 3),
    ("gnu affero general public license", "agpl", 3),
    ("mozilla public license", "mpl", 2),
    ("eclipse public license", "epl", 2),
    ("bsd 3 clause license", "bsd", 2),
    ("bsd 2 clause license", "bsd", 2),
    ("redistribution and use in source and binary forms", "bsd", 4),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", 6),
    ("creative commons attribution", "cc-by", 2),
    ("cc by nc", "cc-by-nc", 0),
    ("cc by sa", "cc-by-sa", 0),
    ("cc by nd", "cc-by-nd", 0),
    ("creative commons zero", "cc0", 2),
    ("cc0 1 0", "cc0", 0),
]

#: Word bytes are digits, lower-case letters and everything beyond ASCII; capitals are lowered, all else separates.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

_FINDING = "struct<label string, notice string, first_word long, last_word long, edits int, exact boolean>"
SCHEMA = f"doc_id long, n_words long, findings array<{_FINDING}>"


@dataclass(frozen=True)
class Notice:
    phrase: bytes
    label: str
    edits: int
    head: int
    seeds: tuple[bytes, ...]
    pattern: regex.Pattern | None


def notice(phrase: str, label: str, edits: int) -> Notice:
    """Cut a phrase, after its short leading words, into ``edits + 1`` pieces of nearly equal length; compile its bounded-error pattern."""
    words = phrase.split(" ")
    short = next((k for k, w in enumerate(words) if len(w) > 3), 0) if edits else 0
    head, tail = " ".join(["", *words[:short], ""]).encode(), " ".join(words[short:]).encode()
    cuts = [len(tail) * k // (edits + 1) for k in range(edits + 2)]
    pattern = regex.compile(b"(?b)" + re.escape(head) + rb"(?:" + re.escape(tail) + rb"){e<=%d} " % edits) if edits else None
    return Notice(phrase.encode(), label, edits, len(head) - 1, tuple(tail[a:b] for a, b in zip(cuts, cuts[1:])), pattern)


def _places(text: bytes, piece: bytes) -> Iterator[int]:
    at = text.find(piece)
    while at >= 0:
        yield at
        at = text.find(piece, at + 1)


def fold(text: str | None) -> bytes:
    """The words of a text, joined by and padded with one space (a lone space for none)."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()
    return b" " + b" ".join(found) + b" " if found else b" "


def fuzzy_places(folded: bytes, n: Notice) -> list[tuple[int, int, int]]:
    """Start, end and edits of the notice's places in a folded text, in order, none overlapping (exact ones of itself may)."""
    if not n.edits:
        return [(p + 1, p + 1 + len(n.phrase), 0) for p in _places(folded, b" " + n.phrase + b" ")]
    windows: set[tuple[int, int]] = set()
    begin = n.head + 1
    for seed in n.seeds:
        for p in _places(folded, seed):
            # the space before, the phrase, the space after
            windows.add((max(0, p - begin - n.edits), min(len(folded), p - begin + len(n.phrase) + n.edits + 2)))
        begin += len(seed)
    found: set[tuple[int, int, int]] = set()
    least = len(n.phrase) - n.edits + 2
    todo = list(windows)
    while todo:
        low, high = todo.pop()
        if high - low < least or not (m := n.pattern.search(folded[low:high])):
            continue
        start, end = low + m.start() + 1, low + m.end() - 1
        found.add((sum(m.fuzzy_counts), start, end))
        todo += [(low, start), (end, high)]
    kept: list[tuple[int, int, int]] = []
    starts: list[int] = []
    for edits, start, end in sorted(found):
        at = bisect_left(starts, start)
        if (at == len(kept) or kept[at][0] >= end) and (not at or kept[at - 1][1] <= start):
            starts.insert(at, start)
            kept.insert(at, (start, end, edits))
    return kept


def scan(text: str | None, base: list[Notice], more: list[Notice]) -> tuple[int, list[dict]]:
    """Number of words, and findings: exact places of the base phrases, then fuzzy places of the notices."""
    folded = fold(text)
    placed = []
    for kind, notices in ((True, base), (False, more)):
        for n in notices:
            if kind or any(s in folded for s in n.seeds):
                placed += [(n, kind, *place) for place in fuzzy_places(folded, n)]
    if not placed:
        return max(0, folded.count(b" ") - 1), []
    spaces = np.flatnonzero(np.frombuffer(folded, np.uint8) == 32)
    first = np.searchsorted(spaces, [p[2] for p in placed]).tolist()  # spaces before
    last = np.searchsorted(spaces, [p[3] - 1 for p in placed]).tolist()
    return len(spaces) - 1, [
        {"label": n.label, "notice": n.phrase.decode(), "first_word": a - 1, "last_word": b - 1, "edits": edits, "exact": kind}
        for (n, kind, _, _, edits), a, b in zip(placed, first, last)
    ]


def license_findings(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    base: list[tuple[str, str]] = BASE_PHRASES,
    notices: list[tuple[str, str, int]] = NOTICES,
) -> DataFrame:
    """For each row ``doc_id, n_words, findings``: spans in words (from 0), label, edits, and whether it is an exact base place.

    Edge cases: null, empty and wordless texts have no words and no findings; very long texts are scanned whole; repeated
    rows are scanned each; a null id is carried through; an empty table gives none; other columns, whatever their names, are
    neither read nor returned.  Base places of one phrase may overlap those of another and all count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact = [notice(p, label, 0) for p, label in base]
        fuzzy = [notice(*n) for n in notices]
        kind = pa.list_(
            pa.struct(
                [("label", pa.string()), ("notice", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                 ("edits", pa.int32()), ("exact", pa.bool_())]
            )
        )
        for batch in batches:
            done = [scan(t.as_py(), exact, fuzzy) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for n, _ in done], pa.int64()), pa.array([f for _, f in done], kind)],
                ["doc_id", "n_words", "findings"],
            )

    small_batches(docs.sparkSession)
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, SCHEMA)


def license_labels(found: DataFrame) -> DataFrame:
    """One row per document: counts and spans of base places, labels, and the best likeness (0 to 1) of any finding."""
    base = F.filter("findings", lambda f: f.exact)
    joined = lambda items: F.array_join(F.array_sort(F.array_distinct(F.transform(items, lambda f: f.label))), ",")
    likeness = F.transform("findings", lambda f: 1.0 - f.edits / F.greatest(F.length(f.notice), F.lit(1)))
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda f: f.first_word)).alias("first_word"),
        F.array_max(F.transform(base, lambda f: f.first_word)).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("findings")).alias("labels"),
        F.coalesce(F.array_max(likeness), F.lit(0.0)).alias("score"),
        F.size(F.filter("findings", lambda f: ~f.exact)).cast("long").alias("n_fuzzy"),
    )
