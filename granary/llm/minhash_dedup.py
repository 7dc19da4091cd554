"""MinHash near-duplicates by a multi-index Hamming join, confirmed on the full shingle sets.

A document's set holds its distinct runs of five words (the whole sequence if it has fewer).  Its signature is SYMBOLS
b-bit minhashes (b = 16), cut into chunks of CHUNK symbols.  By pigeonhole, two signatures that differ in at most
``chunks * (errors + 1) - 1`` symbols agree, in some chunk, in all symbols but ``errors``; every chunk is therefore
indexed under each choice of ``errors`` left-out symbols, and documents that share an index key are candidates.  With the
defaults (10 chunks of 4, one error) all pairs at distance 19 of 40 or less are found; of pairs at similarity 0.75
exactly, 1.5 in a million are farther apart in every chunk.

A class of equal sets is named by 64 of the 128 bits of its set's fingerprint (classes themselves are told apart by all
128): among n classes n^2 / 2^65 pairs share a name by chance, 0.03 for a billion.

No key's documents are paired with each other at large.  Documents with equal sets are one class from the start.  In each
of a few rounds, every key that still holds several components picks one class as its leader (in another order each
round), the leader is compared with the key's classes of other components, and confirmed links are merged: groups of
copies cost some comparisons a member.  Then only what is still apart in one key is compared with each other, in blocks,
each pair in the first of the keys that it shares.  So no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.columns import numbered
from granary.llm.wordhash import mix, shingle_hashes, slices, word_hashes, words
from granary.operators.components import connected_components
from granary.session import few_files, forget, small_batches, written

SHINGLE = 5
SYMBOLS = 40
CHUNK = 4
ERRORS = 1
THRESHOLD = 75
#: Symbols of the signature in all; those beyond the index serve the last step.
LENGTH = 120
#: Rounds of leaders: in the first, all keys share one order of classes; later each key has its own in each round.
ROUNDS = 2
#: A set's sketch holds the hashes with as many leading zero bits as bring it to this many on average; small sets are whole.
SKETCH = 512
#: Classes of one key that are compared with each other in one group of rows.
BLOCK = 2048

_U = np.uint64
_DIGESTS = "doc_id long, row long, fp binary, n_shingles int, signature binary"


def _sets(column: pa.Array, size: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """For some rows at a time: the number of the first, and the sorted distinct shingle hashes of each."""
    for part in slices(column):
        w = words(part)
        h, begin = shingle_hashes(word_hashes(part, w), w, size)
        yield part.first, [np.unique(h[begin[i] : begin[i + 1]]) for i in range(len(part))]


def _signatures(sets: list[np.ndarray], symbols: int) -> np.ndarray:
    """One row of 16-bit symbols for each set that isn't empty."""
    full = [s for s in sets if len(s)]
    out = np.zeros((len(full), symbols), np.uint16)
    if full:
        every = np.concatenate(full)
        begin = np.cumsum([0, *map(len, full)])[:-1]
        for j in range(symbols):
            least = np.minimum.reduceat(mix_with(every, j), begin)
            out[:, j] = (mix(least) >> _U(48)).astype(np.uint16)
    return out


def mix_with(x: np.ndarray, j: int) -> np.ndarray:
    """The j-th ordering of 64-bit hashes: an odd multiplier and a shift fold."""
    y = x * _U((0x9E3779B97F4A7C15 * (2 * j + 1) ^ (j * 0xD6E8FEB86659FD93 << 1)) & (2**64 - 1) | 1)
    y ^= y >> _U(29)
    return y * _U(0xBF58476D1CE4E5B9)


def _digest_batches(size: int, symbols: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in _sets(batch.column(2), size):
                rows = iter(_signatures(sets, symbols))
                fps = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(sets)),
                        batch.column(1).slice(first, len(sets)),
                        pa.array(fps, pa.binary()),
                        pa.array([len(s) for s in sets], pa.int32()),
                        pa.array([next(rows).tobytes() if len(s) else None for s in sets], pa.binary()),
                    ],
                    ["doc_id", "row", "fp", "n_shingles", "signature"],
                )

    return run


def _name(fp: bytes) -> int:
    return int.from_bytes(fp[:8], "big", signed=True)


def _level(n: int) -> int:
    return max(0, -(-n // SKETCH) - 1).bit_length()


def _sketch(s: np.ndarray) -> bytes:
    """Sorted 32-bit pieces of the hashes that start with ``_level`` zero bits."""
    level = _level(len(s))
    low = s[: np.searchsorted(s, _U(1 << (64 - level)))] if level else s
    return np.unique((low >> _U(8)).astype(np.uint32)).tobytes()


def _set_batches(size: int, wanted: bytes):
    """Sets of the documents whose names may be wanted; others are left out before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(wanted, np.uint8)
        places = 8 * (len(wanted) - 1)
        for batch in batches:
            for _, sets in _sets(batch.column(0), size):
                out = [(_name(xxhash.xxh3_128_digest(s.tobytes())), s) for s in sets if len(s)]
                out = [(x, s) for x, s in out if bits[(p := x % places) >> 3] >> (p & 7) & 1]
                for k in range(0, len(out), 64):
                    some = out[k : k + 64]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([x for x, _ in some], pa.int64()),
                            pa.array([s.view(np.int64) for _, s in some], pa.list_(pa.int64())),
                            pa.array([_level(len(s)) for _, s in some], pa.int32()),
                            pa.array([_sketch(s) for _, s in some], pa.binary()),
                        ],
                        ["node", "items", "level", "sketch"],
                    )

    return run


#: Powers of two between which the filter's bits are: 128 KB to 16 MB.  A full one only lets more sets through.
_LEAST_FILTER, _MOST_FILTER = 20, 27


def _filter(nodes: DataFrame) -> bytes:
    """Which remainders modulo the filter's size occur among the nodes: 16 bits a node up to 16 MB, which come to the driver in 4 KB rows."""
    power = min(_MOST_FILTER, max(_LEAST_FILTER, (16 * nodes.count()).bit_length()))
    rows = (
        nodes.select(F.pmod("node", F.lit(1 << power)).alias("p"))
        .select(F.bitmap_bucket_number("p").alias("k"), F.bitmap_bit_position("p").alias("at"))
        .groupBy("k")
        .agg(F.bitmap_construct_agg("at").alias("bits"))
        .collect()
    )
    out = np.zeros((1 << power) // 8 + 1, np.uint8)
    for r in rows:  # bucket k > 0 holds places 32768 * (k - 1) + 1 and on, bit 0 first; place 0 is bit 0 of bucket 0
        block = np.flatnonzero(np.unpackbits(np.frombuffer(r.bits, np.uint8), bitorder="little"))
        places = block + (r.k - 1) * 32768 + 1 if r.k > 0 else np.zeros(1, np.int64)
        np.bitwise_or.at(out, places >> 3, (1 << (places & 7)).astype(np.uint8))
    return out.tobytes()


def _stays(symbols: int, chunk: int, errors: int) -> list[tuple[int, ...]]:
    """For every place of the index, the symbols that stay of a chunk when ``errors`` of it are left out."""
    chunks = [range(c, min(c + chunk, symbols)) for c in range(0, symbols, chunk)]
    return [stay for own in chunks for stay in combinations(own, max(1, len(own) - errors))]


def _keys(classes: DataFrame, stays: list[tuple[int, ...]]) -> DataFrame:
    """Each class under its key in every place of the index."""
    keys = [
        F.xxhash64(F.lit(place), F.concat(*[F.substring("signature", 2 * s + 1, 2) for s in stay]))
        for place, stay in enumerate(stays)
    ]
    return classes.select("node", "n_shingles", F.posexplode(F.array(*keys)).alias("place", "key"))


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Those of the pairs (a, b) whose full sets reach the similarity."""
    one, two = (sets.select(F.col("node").alias(k), F.col("items").alias(f"items_{k}")) for k in "ab")
    shared = F.size(F.array_intersect("items_a", "items_b"))
    union = F.size("items_a") + F.size("items_b") - shared
    near = 100 * shared.cast("long") >= threshold * union.cast("long")
    return written(pairs.join(two, "b").join(one, "a").where(near).select("a", "b"), "links")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after the components that the links join have become one."""
    edges = links
    for k in "ab":
        edges = edges.join(labels.select(F.col("node").alias(k), F.col("component").alias(f"of_{k}")), k)
    found = connected_components(edges.where("of_a <> of_b").select("of_a", "of_b"), "of_a", "of_b")
    found = found.select(F.col("node").alias("component"), F.col("component").alias("joined"))
    out = labels.join(found, "component", "left").select("node", F.coalesce("joined", "component").alias("component"))
    return written(out, "labels")


def _across(stays: list[tuple[int, ...]], length: int, threshold: int, exact: bool):
    """Pairs of different components within one key (and two of its blocks) that may reach the similarity.

    A pair counts in the first key that it shares only.  Unless ``exact``, left out are pairs whose signatures differ in
    more symbols than sets of the similarity do by 4.5 standard deviations (four in a million such pairs), and pairs whose
    sketches (whole sets, if small) differ by as much; the others are still to be confirmed.
    """
    p = threshold / 100
    most = length if exact else int(length * (1 - p) + 4.5 * (length * p * (1 - p)) ** 0.5)

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        component, node = table["component"].to_numpy(), table["node"].to_numpy()
        n, block = table["n_shingles"].to_numpy(), table["block"].to_numpy()
        marks = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint16).reshape(len(node), -1)
        low, high, place = key[1].as_py(), key[2].as_py(), table["place"][0].as_py()
        level = table["level"].to_pylist()
        sketch = [np.frombuffer(x, np.uint32) for x in table["sketch"].to_pylist()]

        def alike(i: int, j: int) -> bool:
            if exact or level[i] != level[j]:
                return True
            k = len(np.intersect1d(sketch[i], sketch[j], assume_unique=True))
            union = max(1, len(sketch[i]) + len(sketch[j]) - k)
            return k / union >= p - (4.5 * (p * (1 - p) / union) ** 0.5 if level[i] else 0.01)

        found: list[tuple[int, int]] = []
        for i in np.flatnonzero(block == low).tolist():
            other = (block == high) & (component != component[i])
            if low == high:
                other[: i + 1] = False
            other &= 100 * np.minimum(n, n[i]) >= threshold * np.maximum(n, n[i])
            at = np.flatnonzero(other)
            same = marks[at] == marks[i]
            fit = same.sum(axis=1) >= length - most
            at, same = at[fit], same[fit]
            for stay in stays[:place]:
                if not len(at):
                    break
                later = ~same[:, stay].all(axis=1)
                at, same = at[later], same[later]
            found += [(min(node[i], node[j]), max(node[i], node[j])) for j in at.tolist() if alike(i, j)]
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return run


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    threshold: int = THRESHOLD,
    symbols: int = SYMBOLS,
    chunk: int = CHUNK,
    errors: int = ERRORS,
    length: int = LENGTH,
    rounds: int = ROUNDS,
    exact: bool = False,
) -> DataFrame:
    """For each document ``doc_id, n_shingles, component_id, kept, class_size``.

    ``component_id`` is the smallest id reachable over links of ``threshold`` percent; ``kept`` is whether that is the
    document's own.  Other columns of ``docs`` are neither read nor returned, so their names can't clash.  Pairs that only
    the last step meets are first thinned by estimates from their signatures; ``exact`` sends all of them to the full sets.

    Edge cases: a null, empty or blank text has the empty set and links with nothing (it keeps its own id).  Rows that
    repeat an id and a text get equal results; rows that repeat an id with other texts are separate documents.  A null id
    takes part as a text but never names a component unless nothing else is there: such a row's component is the
    smallest non-null id of its component, else null and kept.  An empty table gives an empty result.
    """
    picked = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("row"), F.col(text_col).cast("string").alias("text")
    )
    found = _components(picked, shingle, threshold, symbols, chunk, errors, length, rounds, exact)
    return found.select("doc_id", "n_shingles", "component_id", "kept", "class_size")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates, with the columns of ``docs``, whatever their names.

    It is the row with the smallest id of the group (nulls last); of rows that share that id, the one whose text and other
    columns have the smallest 64-bit hash; rows that are equal in all columns are one.  Rows whose texts have no words are
    no group and all stay.  An empty table gives an empty result.  ``options`` are those of ``near_duplicates``.
    """
    defaults = {"shingle": SHINGLE, "threshold": THRESHOLD, "symbols": SYMBOLS, "chunk": CHUNK, "errors": ERRORS, "length": LENGTH, "rounds": ROUNDS, "exact": False}
    rows, name = numbered(docs)
    text = F.col(name[text_col]).cast("string")
    rows = rows.withColumn("id", F.col(name[id_col]).cast("long")).withColumn("row", F.xxhash64(*[F.col(c).cast("string") for c in rows.columns]))
    found = _components(rows.select(F.col("id").alias("doc_id"), "row", text.alias("text")), **(defaults | options))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first")
    chosen = found.where("group is not null").groupBy("group").agg(first).select("first.doc_id", "first.row")
    copies = found.where("group is not null").groupBy("doc_id", "row").agg(F.count(F.lit(1)).alias("copies"))
    chosen = chosen.select(F.col("doc_id").alias("of"), F.col("row").alias("of_row"))
    chosen = chosen.join(copies, [F.col("doc_id").eqNullSafe(F.col("of")), F.col("row") == F.col("of_row")])
    chosen = chosen.select("of", "of_row", (F.col("copies") > 1).alias("repeated"))
    blank = found.where("group is null").select(F.col("doc_id").alias("of"), F.col("row").alias("of_row")).distinct().withColumn("repeated", F.lit(False))
    kept = written(chosen.unionByName(blank), "kept")
    same = [F.col("id").eqNullSafe(F.col("of")), F.col("row") == F.col("of_row")]
    single = rows.join(kept.where("not repeated"), same, "left_semi")
    several = rows.join(kept.where("repeated"), same, "left_semi").dropDuplicates(["id", "row"])
    return single.unionByName(several).drop("id", "row").toDF(*docs.columns)


def _components(
    docs: DataFrame, shingle: int, threshold: int, symbols: int, chunk: int, errors: int, length: int, rounds: int, exact: bool
) -> DataFrame:
    """``near_duplicates`` of (doc_id, row, text), with ``row`` and ``group``, the name of the component (null for no words)."""
    small_batches(docs.sparkSession)
    few_files(docs.sparkSession)
    length, rounds = max(length, symbols), max(1, rounds)
    digests = written(docs.mapInArrow(_digest_batches(shingle, length), _DIGESTS), "digests")
    classes = written(
        digests.where("n_shingles > 0")
        .groupBy("fp")
        .agg(
            F.min("doc_id").alias("least_id"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"),
            F.count(F.lit(1)).alias("class_size"),
        )
        .withColumn("node", F.conv(F.substring(F.hex("fp"), 1, 16), 16, -10).cast("long")),
        "classes",
    )
    stays = _stays(symbols, chunk, errors)
    keys = _keys(classes, stays)
    met = keys.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = written(keys.join(met, "key").select("key", "place", "node", "n_shingles"), "shared")
    labels = written(shared.select("node").distinct().withColumn("component", F.col("node")), "labels")
    wanted = _filter(labels)
    sets = docs.select("text").mapInArrow(_set_batches(shingle, wanted), "node long, items array<long>, level int, sketch binary")
    sets = written(sets.join(labels.select("node"), "node", "left_semi").dropDuplicates(["node"]), "sets")
    links = []

    for turn in range(rounds):
        named = shared.join(labels, "node")
        order = F.xxhash64("key", F.lit(turn)) if turn else F.lit(0).cast("long")
        kept = F.min("component").alias("low"), F.max("component").alias("high")
        least = F.min(F.struct(F.col("node").bitwiseXOR(order).alias("turned"), "n_shingles", "node", "component")).alias("first")
        mixed = named.groupBy("key").agg(least, *kept).where("low <> high")
        mixed = mixed.select("key", F.col("first.node").alias("leader"), F.col("first.n_shingles").alias("n_leader"), F.col("first.component").alias("of_leader"))
        near = 100 * F.least("n_leader", "n_shingles") >= threshold * F.greatest("n_leader", "n_shingles")
        pairs = named.join(mixed, "key").where((F.col("component") != F.col("of_leader")) & near)
        pairs = pairs.select(F.least("leader", "node").alias("a"), F.greatest("leader", "node").alias("b")).distinct()
        links.append(_confirmed(pairs, sets, threshold))
        labels = _merged(labels, links[-1])

    named = shared.join(labels, "node")
    mixed = named.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("members")
    )
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    dealt = (
        named.join(mixed.where("low <> high and members > 2").select("key", blocks.alias("blocks")), "key")
        .withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("lower", F.least("block", "other"))
        .withColumn("upper", F.greatest("block", "other"))
        .join(classes.select("node", "signature"), "node")
        .join(sets.select("node", "level", "sketch"), "node")
        .select("key", "place", "node", "component", "block", "lower", "upper", "n_shingles", "signature", "level", "sketch")
    )
    rest = dealt.groupBy("key", "lower", "upper").applyInArrow(_across(stays, length, threshold, exact), "a long, b long")
    links.append(_confirmed(rest, sets, threshold))
    merged = _merged(labels, links[-1])

    linked = classes.select("fp", "node", "least_id", "class_size")
    linked = linked.join(merged.select("node", "component"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = linked.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of_class = written(linked.join(names, "component").select("fp", "class_size", "component_id", F.col("component").alias("group")), "of-class")
    for done in (shared, sets, classes, labels, merged, *links):
        forget(done)
    out = digests.select("doc_id", "row", "fp", "n_shingles").join(of_class, "fp", "left")
    component = F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id",
        "row",
        "group",
        F.col("n_shingles").cast("long").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
    )
