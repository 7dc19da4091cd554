"""Conflict-constrained best-fit packing of documents into bins of a fixed number of words.

Documents are dealt to packing shards by a hash of their content and id (and, of rows that repeat both, by where they
stand), so a hot source and copies spread evenly; each shard is packed by itself in decreasing size.  Open bins are kept in order of residual room.  A bin carries two bitmaps:
one of the source slots it has given away (each source has SOURCE_SLOTS), one of the duplicate clusters in it.  A piece
goes to the tightest bin that can take it: the search starts at the first bin with enough room and goes on to the
successors until neither bitmap conflicts.  A document longer than a bin is cut into full pieces and a rest.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.wordhash import shingle_hashes, slices, word_hashes, words
from granary.session import small_batches

#: Words a bin holds; pieces of one source in a bin; documents of a packing shard, on average.
CAPACITY = 4096
SOURCE_SLOTS = 4
SHARD = 2048
#: Bins that may have moved since an equal piece was placed, for the search to go on from there.
MOVES = 64
#: Ids and clusters of which a task remembers how often it met them.
HELD_IDS = 200_000


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each text, its cluster, a hash of its lower-cased words in order, and a number that tells rows with equal ids and clusters apart."""
    task = TaskContext.get().partitionId() << 32
    met: Counter = Counter()
    for batch in batches:
        for part in slices(batch.column(2)):
            w = words(part)
            h, begin = shingle_hashes(word_hashes(part, w), w, 5)
            n = len(part)
            cluster = [xxhash.xxh3_64_intdigest(h[begin[i] : begin[i + 1]].tobytes()) - (1 << 63) for i in range(n)]
            ids = batch.column(0).slice(part.first, n).to_pylist()
            if len(met) > HELD_IDS:  # rows that repeat stand close or there are many: the rare ones forgotten share a shard
                met.clear()
            copies = []
            for row in zip(ids, cluster):
                copies.append(task + met[row] if met[row] else 0)
                met[row] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(part.first, n),
                    batch.column(1).slice(part.first, n),
                    pa.array(np.diff(w.of), pa.int64()),
                    pa.array(cluster, pa.int64()),
                    pa.array(copies, pa.int64()),
                ],
                ["doc_id", "source", "n_words", "cluster", "copy"],
            )


def pack(sizes: list[int], sources: list, clusters: list[int], capacity: int, slots: int) -> list[tuple[int, int, int, int]]:
    """(item, first word, words, bin) of every piece, for items in the given order of preference among equal sizes."""
    pieces = []
    for i, n in enumerate(sizes):
        for first in range(0, max(n, 1), capacity):
            pieces.append((min(capacity, n - first), i, first))
    pieces.sort(key=lambda p: (-p[0], p[1], p[2]))
    source_bit: dict = {}
    cluster_bit: dict = {}
    residuals: list[tuple[int, int]] = []  # (room, bin), ascending
    moves: list[tuple[int, int]] = []  # every place that a bin got in that list
    # where the search for equal pieces ended and how many moves there were: bins before can't take more of them
    searched: dict[tuple, tuple[tuple[int, int], int]] = {}
    of_source: list[int] = []
    of_cluster: list[int] = []
    out = []
    every = (1 << slots) - 1
    for size, i, first in pieces:
        place = source_bit.setdefault(sources[i], slots * len(source_bit))
        mark = 1 << cluster_bit.setdefault(clusters[i], len(cluster_bit))
        alike = size, sources[i], clusters[i]
        start, since = searched.get(alike, ((size, -1), len(moves)))
        if len(moves) - since > MOVES or any(size <= key[0] and key < start and not of_cluster[key[1]] & mark for key in moves[since:]):
            start = (size, -1)
        at = bisect_left(residuals, start)
        while at < len(residuals):
            room, b = residuals[at]
            if of_source[b] >> place & every != every and not of_cluster[b] & mark:
                del residuals[at]
                break
            at += 1
        else:
            room, b = capacity, len(of_source)
            of_source.append(0)
            of_cluster.append(0)
        taken = of_source[b] >> place & every
        of_source[b] |= (taken + 1) << place  # slots fill from the lowest bit: 0, 1, 11, ...
        of_cluster[b] |= mark
        insort(residuals, (room - size, b))
        moves.append((room - size, b))
        searched[alike] = (room, b), len(moves)
        out.append((i, first, size, b))
    return out


def best_fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", capacity: int = CAPACITY,
    slots: int = SOURCE_SLOTS, shard: int = SHARD,
) -> DataFrame:
    """One row per piece: ``doc_id, first_word, n_words, cluster, source, bin_id, bin_words``.

    Every document is packed, none is shortened.  No bin holds more than ``capacity`` words, more than ``slots`` pieces of
    one source, or two pieces of one duplicate cluster (texts of equal words in equal order, whatever case and spacing;
    pieces of one document too, and all texts without words).

    Edge cases: null and blank texts are pieces of no words and still get a bin.  Null sources are one source.  Repeated
    rows are separate documents of one cluster.  A null id is packed like others.  Ties in size go by id, then source.
    Very long texts become many full pieces.  An empty table gives no rows.  Other columns are neither read nor returned.
    """
    small_batches(docs.sparkSession)
    shards = max(1, -(-docs.count() // shard))
    sized = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text")
    ).mapInArrow(_measure, "doc_id long, source string, n_words long, cluster long, copy long")
    dealt = sized.withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster", "copy"), F.lit(shards)))

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("source", "ascending"), ("cluster", "ascending")])
        columns = {c: table[c].to_pylist() for c in ("doc_id", "source", "n_words", "cluster")}
        placed = pack(columns["n_words"], columns["source"], columns["cluster"], capacity, slots)
        fill: dict[int, int] = {}
        for _, _, n, b in placed:
            fill[b] = fill.get(b, 0) + n
        name = key[0].as_py()
        get = lambda c: [columns[c][i] for i, *_ in placed]
        return pa.table(
            {
                "doc_id": pa.array(get("doc_id"), pa.int64()),
                "first_word": pa.array([f for _, f, _, _ in placed], pa.int64()),
                "n_words": pa.array([n for _, _, n, _ in placed], pa.int64()),
                "cluster": pa.array(get("cluster"), pa.int64()),
                "source": pa.array(get("source"), pa.string()),
                "bin_id": pa.array([(name << 32) + b for *_, b in placed], pa.int64()),
                "bin_words": pa.array([fill[b] for *_, b in placed], pa.int64()),
            }
        )

    schema = "doc_id long, first_word long, n_words long, cluster long, source string, bin_id long, bin_words long"
    return dealt.groupBy("shard").applyInArrow(run, schema)
