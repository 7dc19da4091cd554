"""Exact top-k inner products by MaxScore, in resident shards of vectors that blocks of queries stream past.

A query's terms are the dimensions of its integer vector.  A term's score for a vector is lifted by a constant so that it is
never negative: for a positive query component by the least value of that dimension in the shard, for a negative one by the
greatest; the constants add up to one offset a query, so ranks don't change.  A term's bound is its largest lifted score in
the shard.  Sorted by bound, the longest run of smallest terms whose bounds together stay below the threshold, the k-th best
score so far, are non-essential: a vector without an essential term can't reach the threshold.  Vectors are taken a chunk at
a time; the postings of essential terms (the dimension's column) are traversed for all vectors of the chunk, then the
non-essential terms are probed one after the other, largest bound first, only for vectors whose score so far plus the bounds
still to come is competitive.  The threshold rises from chunk to chunk, and terms become non-essential.

It starts, in every shard, from the query's k-th best score among a pilot of PILOT vectors, so it lives across shards; the
pilot only saves work, whichever vectors it holds.  Shards' best k are merged by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Vectors of one shard at most, about, and shards that smaller tables are dealt to (of LEAST_SHARD vectors or more).
SHARD, SHARDS, LEAST_SHARD = 65_536, 16, 2048
#: Queries of one block, vectors of a chunk, vectors of the pilot.
BLOCK, CHUNK, PILOT = 256, 2048, 1024
SCALE = 256
#: Share of competitive vectors from which terms are probed for whole chunks.
FEW = 0.01
_LONG = (1 << 63) - 1


def quantised(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) with x as double, at 2^62 if beyond it."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(values.astype(np.float64) * scale), -(2.0**62), 2.0**62).astype(np.int64)


def _top(q: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each query number, ties to smaller ids, by query and rank."""
    by = np.lexsort((ids, -score, q))
    q, score, ids = q[by], score[by], ids[by]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    return q[rank < k], score[rank < k], ids[rank < k]


def best_in_shard(
    queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, thresholds: np.ndarray | None = None, chunk: int = CHUNK
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query number, score, vector id) of the k best of one shard for each query, without vectors of the query's own id.

    ``thresholds``: scores that others are known to reach; what lies below them may be left out.  Sums are exact: in doubles
    as long as none can pass 2^53, in Python integers beyond.
    """
    reach = lambda x: float(np.abs(x.astype(np.float64)).max(initial=0.0))
    kind = np.float64 if 4 * reach(queries) * reach(vectors) * max(1, queries.shape[1]) < 2**53 else object
    queries, vectors = queries.astype(kind), vectors.astype(kind)
    low, high = vectors.min(axis=0), vectors.max(axis=0)
    floors = np.where(queries > 0, low, high)
    bounds = np.abs(queries) * (high - low)
    order = np.argsort(bounds, axis=1, kind="stable")
    sums = np.cumsum(np.take_along_axis(bounds, order, axis=1), axis=1)
    place = np.argsort(order, axis=1, kind="stable")
    offsets = (queries * floors).sum(axis=1)
    least = np.full(len(queries), -np.inf, kind) if thresholds is None else thresholds.astype(kind) - offsets
    best = np.zeros(0, np.int64), np.zeros(0, kind), np.zeros(0, np.int64)
    numbers = np.arange(len(queries))
    for first in range(0, len(vectors), chunk):
        part, own = vectors[first : first + chunk], ids[first : first + chunk]
        split = (sums < least[:, None]).sum(axis=1)  # terms that are non-essential
        weights = np.where(place >= split[:, None], queries, 0)
        partial = weights @ part.T - (weights * floors).sum(axis=1)[:, None]
        alive = own[None, :] != query_ids[:, None]
        while True:
            rest = np.where(split > 0, sums[numbers, split - 1], 0)  # what the terms to come may add
            alive &= partial + rest[:, None] >= least[:, None]
            if not split.any() or np.count_nonzero(alive) < FEW * alive.size:
                break
            # while many vectors are competitive, half of the terms left, largest bounds first, are probed for all at once
            half = split // 2
            weights = np.where((place >= half[:, None]) & (place < split[:, None]), queries, 0)
            partial += weights @ part.T - (weights * floors).sum(axis=1)[:, None]
            split = half
        q, v = np.nonzero(alive)
        score = partial[q, v]
        left = split[q]  # non-essential terms still to probe
        while left.any():
            open_ = np.flatnonzero(left)
            term = order[q[open_], left[open_] - 1]
            score[open_] += queries[q[open_], term] * (part[v[open_], term] - floors[q[open_], term])
            left = np.maximum(left - 1, 0)
            fit = score + np.where(left > 0, sums[q, left - 1], 0) >= least[q]
            q, v, score, left = q[fit], v[fit], score[fit], left[fit]
        if len(q):
            q, score, found = _top(q, score, own[v], k)
            best = _top(*(np.concatenate(x) for x in zip(best, (q, score, found))), k)
            full, last = np.unique(best[0][::-1], return_index=True)
            counts = np.bincount(best[0], minlength=len(queries))
            kth = best[1][::-1][last]
            enough = counts[full] == k
            least[full[enough]] = np.maximum(least[full[enough]], kth[enough])
    return best[0], best[1] + offsets[best[0]], best[2]


def _matrix(column: pa.ChunkedArray | list) -> np.ndarray:
    """Integer components of some vectors, padded with zeros to the longest."""
    rows = [np.array(x, np.float64) for x in (column if isinstance(column, list) else column.to_pylist())]
    flat = np.zeros((len(rows), max(map(len, rows), default=0)), np.int64)
    for i, r in enumerate(rows):
        flat[i, : len(r)] = quantised(r)
    return flat


def _small(values: np.ndarray) -> tuple[int, bytes]:
    """Bytes a component and the components, in the smallest integers that hold them."""
    for kind in (np.int16, np.int32, np.int64):
        if kind is np.int64 or (values >= np.iinfo(kind).min).all() and (values <= np.iinfo(kind).max).all():
            return kind().itemsize, values.astype(kind).tobytes()
    raise AssertionError


def _padded(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1], 1)
    return tuple(np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))


_PACKED = "part long, width int, size int, ids binary, marks binary, data binary, least binary"


def _packed(k: int, pilot: tuple[np.ndarray, np.ndarray] | None = None):
    """One row for each part of a table: ids, integer components, and for queries their numbers and thresholds from the pilot."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        flat, ids = _matrix(table["v"]), table["id"].to_numpy().astype(np.int64)
        least = np.full(len(ids), -np.inf)
        if pilot is not None and len(pilot[0]):
            ours, theirs = _padded(flat, pilot[1])
            q, score, _ = best_in_shard(ours, ids, theirs, pilot[0], k)
            counts = np.bincount(q, minlength=len(ids))
            lowest = np.full(len(ids), np.inf)
            np.minimum.at(lowest, q, score.astype(np.float64))
            # a double may lie above a long that it stands for: one step down is below
            least = np.where(counts == k, np.nextafter(lowest, -np.inf), -np.inf)
        size, data = _small(flat)
        column = lambda x, kind=pa.binary(): pa.array([x], kind)
        return pa.table({
            "part": column(key[0].as_py(), pa.int64()), "width": column(flat.shape[1], pa.int32()), "size": column(size, pa.int32()),
            "ids": column(ids.tobytes()), "marks": column(table["mark"].to_numpy().astype(np.int64).tobytes()), "data": column(data),
            "least": column(least.tobytes()),
        })

    return run


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], np.int64)
    return ids, np.frombuffer(row["data"], f"i{row['size']}").reshape(len(ids), row["width"]).astype(np.int64)


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
    shard: int = SHARD, block: int = BLOCK, pilot: int = PILOT,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the k vectors of highest integer inner product, its own id left out.

    A vector is moved once, to its shard; queries are copied to every shard, and a task holds one shard and one block of
    queries at a time.

    Edge cases: vectors that are null or hold a null or non-finite component take no part, nor do null ids; every row is a
    vector of its own, also one that repeats an id (for a query, all rows of its id are its own); query rows that are equal
    in id and vector are one query, those that repeat an id with another vector have results of their own; vectors of other
    lengths count as padded with zeros; ties go to the smaller id; fewer than k others give fewer rows; an empty table gives
    none.  Components are held at 2^62 and scores at the border of long.  Other columns are neither read nor returned.
    """

    def fine(df: DataFrame) -> DataFrame:
        v = F.col(vector_col).cast("array<double>")
        known = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return df.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & known)

    def dealt(df: DataFrame, parts: int, *by: str) -> DataFrame:
        return df.withColumn("part", F.pmod(F.xxhash64(*by), F.lit(parts)).cast("long")).groupBy("part")

    n_vectors, n_queries = vectors.count(), queries.count()
    shards = max(1, -(-n_vectors // shard), min(SHARDS, -(-n_vectors // LEAST_SHARD)))
    blocks = max(1, -(-n_queries // block))
    first = fine(vectors).limit(pilot).toArrow()
    some = first["id"].to_numpy().astype(np.int64), _matrix(first["v"])
    mark = F.xxhash64("v").alias("mark")
    # equal rows are dealt by a number of their own, so that copies of one row are no hot shard
    left = dealt(fine(vectors).select("id", "v", F.lit(0).alias("mark")), shards, "id", "v").applyInArrow(_packed(k), _PACKED)
    right = dealt(fine(queries).distinct().select("id", "v", mark), blocks, "id", "mark").applyInArrow(_packed(k, some), _PACKED)
    left = left.select("*", F.col("part").alias("shard"), F.lit(-1).cast("long").alias("block"))
    right = right.select("*", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<long>")).alias("shard"), F.col("part").alias("block"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, values = None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if r["block"] < 0:
                    at = r["shard"]
                    ids, values = _unpacked(r)
                elif r["shard"] == at:
                    q_ids, q_values = _unpacked(r)
                    ours, theirs = _padded(q_values, values)
                    q, score, found = best_in_shard(ours, q_ids, theirs, ids, k, np.frombuffer(r["least"]))
                    score = np.array([max(-_LONG, min(_LONG, int(s))) for s in score], np.int64)
                    columns = [q_ids[q], np.frombuffer(r["marks"], np.int64)[q], found, score]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "mark", "vec_id", "score"])

    met = left.unionByName(right).repartition(shards, "shard").sortWithinPartitions("shard", "block")
    best = met.drop("part").mapInArrow(run, "query_id long, mark long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
