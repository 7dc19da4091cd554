"""Language identification by character language models.

Each language value found in the training rows gets an interpolated Kneser-Ney model (``char_lm``); a text's language is
the one with the lowest cross-entropy a symbol.  Gram counts come from all training rows: each task counts its own rows,
and Spark adds the counts up.  Every letter of any script is its own symbol, and the order is the same at every size: a
task fits one language, the driver passes the packed models on to one file in pieces, every node gets a copy of the file,
and all Python workers of a node map that copy into memory.  One language's grams must fit the memory of a task.

Rejection is calibrated.  The counts give, exactly, the mean and deviation of a language's log-probabilities over its
training text; a text's excess is how many deviations its best cross-entropy lies above that mean, less CHANCE standard
errors at its length.  One in HELD training texts of every language with LEAST_HELD of them is held back from the counts;
a text is rejected if its excess passes the QUANTILE of the held-back texts of its language, and MARGIN.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from granary.llm import char_lm
from granary.llm.columns import fresh, numbered
from granary.llm.wordhash import slices
from granary.session import forget, small_batches, written

#: Standard errors by which a text's cross-entropy may exceed the mean of its language at its length, and deviations beyond, if not calibrated.
CHANCE, SLACK = 6.0, 1.5
#: Calibration: one in so many training texts, of languages with so many; the quantile of their excess, and deviations beyond it.
HELD, LEAST_HELD, QUANTILE, MARGIN = 20, 400, 0.95, 0.75
#: Bytes of a packed model that go through the driver at a time, and gram counts that a counting task holds, about.
PIECE, HELD_GRAMS = 8 << 20, 2_000_000
UNKNOWN = "und"


def _texts(batch_column: pa.Array, limit: int = 1 << 19) -> Iterator[tuple[int, list[str]]]:
    """Some whole texts at a time, nulls as empty ones, with the number of the first."""
    for part in slices(batch_column, limit):
        n = len(part)
        yield part.first, [t or "" for t in batch_column.slice(part.first, n).to_pylist()]


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    keys, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return [(keys, np.bincount(back, np.concatenate([n for _, n in parts])).astype(np.int64))]


def _count_grams(order: int):
    def counted(found: dict[str, list[tuple[np.ndarray, np.ndarray]]]) -> Iterator[pa.RecordBatch]:
        for name, parts in found.items():
            ((keys, n),) = _merge(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(keys), pa.string()), pa.array(keys.astype(np.int64)), pa.array(n)], ["lang", "gram", "n"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            for first, texts in _texts(batch.column(1)):
                by: dict[str, list[str]] = {}
                for name, text in zip(batch.column(0).slice(first, len(texts)).to_pylist(), texts):
                    by.setdefault(name, []).append(text)
                for name, own in by.items():
                    s = char_lm.symbols(own, char_lm.point_table())
                    parts = found.setdefault(name, [])
                    parts.append(np.unique(char_lm.grams(s, order, char_lm.POINT_BITS), return_counts=True))
                    if len(parts) > 32:
                        found[name] = _merge(parts)
            if sum(len(keys) for parts in found.values() for keys, _ in parts) > HELD_GRAMS:
                yield from counted(found)
                found.clear()
        yield from counted(found)

    return run


def _symbols() -> int:
    """How many symbols exist: all letters and the space."""
    return 1 + int(np.count_nonzero(char_lm.point_table()))


def _fit(piece: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        n = table["n"].to_numpy()
        by = np.argsort(codes := table["gram"].to_numpy())
        one = char_lm.fit_language(codes, n, char_lm.ORDER, char_lm.POINT_BITS, _symbols())
        logs, weight = -one.logs[-1].astype(float), n[by] / n.sum()
        mean = float((logs * weight).sum())
        deviation = float(((logs - mean) ** 2 * weight).sum()) ** 0.5
        lengths, data = char_lm.pack(one)
        rows = [
            pa.record_batch({
                "lang": pa.array([key[0].as_py()], pa.string()), "piece": pa.array([k], pa.int64()), "data": pa.array([data[at : at + piece]], pa.binary()),
                "lengths": pa.array([lengths], pa.list_(pa.int64())), "mean": pa.array([mean]), "deviation": pa.array([deviation]),
            })
            for k, at in enumerate(range(0, len(data), piece))
        ]
        return pa.Table.from_batches(rows)

    return run


@dataclass
class Models:
    """A file on every node with the packed models; name, first byte, array lengths, mean, deviation and greatest excess of each language."""

    file: str
    languages: list[tuple[str, int, list[int], float, float, float]]

    def opened(self) -> list[char_lm.Language]:
        data = np.memmap(SparkFiles.get(self.file), np.uint8, "r")
        return [char_lm.unpack(lengths, data[first:], char_lm.POINT_BITS, _symbols()) for _, first, lengths, *_ in self.languages]


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Models | None:
    """Models of all languages of ``docs`` with their limits of rejection; None if there is no labelled text."""
    spark = docs.sparkSession
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).where(
        "lang is not null and text is not null"
    )
    many = sorted(r.lang for r in rows.groupBy("lang").count().where(F.col("count") >= LEAST_HELD).collect())
    back = F.col("lang").isin(many) & (F.pmod(F.xxhash64("text"), F.lit(HELD)) == 0) if many else F.lit(False)
    counts = rows.where(~back).mapInArrow(_count_grams(char_lm.ORDER), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    fitted = counts.groupBy("lang").applyInArrow(
        _fit(PIECE), "lang string, piece long, data binary, lengths array<long>, mean double, deviation double"
    )
    fitted = written(fitted, "models")
    first, languages, at = {}, [], 0
    for r in fitted.select("lang", "piece", F.length("data").alias("n"), "lengths", "mean", "deviation").orderBy("lang", "piece").collect():
        if r.piece == 0:
            languages.append((r.lang, at, r.lengths, r.mean, r.deviation, SLACK))
        first[r.lang, r.piece] = at
        at += r.n
    if not languages:
        return None
    folder = tempfile.mkdtemp(prefix="granary-models-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    name = f"granary-models-{uuid.uuid4().hex}"
    with open(f"{folder}/{name}", "wb") as f:
        for r in fitted.select("lang", "piece", "data").toLocalIterator():
            f.seek(first[r.lang, r.piece])
            f.write(r.data)
    forget(fitted)
    spark.sparkContext.addFile(f"{folder}/{name}")
    trained = Models(name, languages)
    if many:
        held = _scored(rows.where(back), trained, "text", None, CHANCE, with_text=False).where("c0 = lang_pred")
        found = held.groupBy("c0").agg(F.percentile_approx("excess", QUANTILE, 10_000).alias("excess")).collect()
        limits = {r.c0: r.excess + MARGIN for r in found}
        trained = Models(name, [(*own[:5], limits.get(own[0], SLACK)) for own in languages])
    return trained


ADDED = [("lang_pred", "string"), ("score", "double"), ("cross_entropy", "double"), ("excess", "double"), ("rejected", "boolean")]


def predict(
    docs: DataFrame,
    trained: Models | None,
    text_col: str = "text",
    slack: float | None = None,
    chance: float = CHANCE,
) -> DataFrame:
    """``docs`` with four further columns: ``lang_pred, score, cross_entropy, rejected``; all others pass through unread.

    An added column whose name is taken, in whatever case, gets underscores behind it.
    """
    names = [name for name, _ in ADDED]
    return _scored(docs, trained, text_col, slack, chance).toDF(*docs.columns, *fresh(docs.columns, names))


def recognised(docs: DataFrame, trained: Models | None, text_col: str = "text", slack: float | None = None, chance: float = CHANCE) -> DataFrame:
    """The rows of ``docs`` that ``predict`` doesn't reject, with the columns of ``docs``, whatever their names."""
    found = _scored(docs, trained, text_col, slack, chance)
    return found.where("not rejected").select(*[f"c{k}" for k in range(len(docs.columns))]).toDF(*docs.columns)


def _scored(docs: DataFrame, trained: Models | None, text_col: str, slack: float | None, chance: float, with_text: bool = True) -> DataFrame:
    """Rows with columns ``c0``, ``c1``... for those of ``docs`` (the text only if asked for), and what is added."""
    docs, name = numbered(docs)
    text = name[text_col]
    rest = docs if with_text else docs.drop(text)
    if trained is None:
        return rest.select("*", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("cross_entropy"), F.lit(None).cast("double").alias("excess"), F.lit(True).alias("rejected"))
    languages = [name for name, *_ in trained.languages]
    limits = np.array([own[3:] for own in trained.languages])

    def score(models: list[char_lm.Language], texts: list[str]) -> tuple[list, ...]:
        s = char_lm.symbols(texts, char_lm.point_table())
        length = np.diff(s.begin)
        letters = np.add.reduceat(np.append(s.codes != char_lm.SPACE, False), s.begin[:-1]) if len(texts) else np.zeros(0)
        letters = np.where(length > 0, letters, 0)
        grams, at = np.unique(char_lm.grams(s, char_lm.ORDER, char_lm.POINT_BITS), return_inverse=True)
        entropy = np.zeros((len(texts), len(models)))
        sums = np.zeros(len(at) + 1)
        for j, lm in enumerate(models):
            np.cumsum(lm.log_probabilities(grams)[at], dtype=np.float64, out=sums[1:])
            entropy[:, j] = -(sums[s.begin[1:]] - sums[s.begin[:-1]]) / np.maximum(length, 1)
        best = entropy.argmin(axis=1)
        low = entropy[np.arange(len(best)), best]
        odds = np.exp(-(entropy - low[:, None]) * np.minimum(length, 40)[:, None])
        mean, deviation, own = limits[best].T
        excess = (low - mean) / deviation - chance / np.sqrt(np.maximum(length, 1))
        bad = excess > (own if slack is None else slack)
        known = letters > 0
        return (
            [languages[b] if k else UNKNOWN for b, k in zip(best, known)],
            np.where(known, 1 / odds.sum(axis=1), 0.0).tolist(),
            [float(x) if k else None for x, k in zip(low, known)],
            [float(x) if k else None for x, k in zip(excess, known)],
            (bad | ~known).tolist(),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [name for name, _ in ADDED]
        kinds = [pa.string(), pa.float64(), pa.float64(), pa.float64(), pa.bool_()]
        models = trained.opened()
        for batch in batches:
            for first, texts in _texts(batch.column(batch.schema.get_field_index(text))):
                own = [c.slice(first, len(texts)) for k, c in zip(batch.schema.names, batch.columns) if k in passed]
                new = [pa.array(x, k) for x, k in zip(score(models, texts), kinds)]
                yield pa.RecordBatch.from_arrays(own + new, passed + names)

    schema = StructType(rest.schema.fields.copy())
    passed = rest.columns
    for added, kind in ADDED:
        schema = schema.add(added, kind)
    if docs.schema[text].dataType != StringType():
        docs = docs.withColumn("as_text", F.col(text).cast("string"))
        text = "as_text"
    return docs.mapInArrow(run, schema)


def identify_languages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5, held: int = 0
) -> DataFrame:
    """For each row ``doc_id, held_out, lang_pred, score, cross_entropy, rejected``.

    Models learn from rows with a language whose crc32 of the id's text, modulo ``folds``, isn't ``held``; a prediction
    sees the text alone.  ``score`` is the winner's share of the likelihood of at most 40 symbols at the mean rate.

    Edge cases: a null text or one without a letter is ``und``, with score 0, and rejected.  A null id is held out.  A
    tie goes to the first language by name.  Without any training row all are ``und``.  Very long texts are read whole.
    Repeated rows count and are returned each time.  Other columns are neither read nor returned.
    """
    small_batches(docs.sparkSession)
    held_out = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == held, F.lit(True))
    model = train(docs.where(~held_out), text_col, lang_col)
    picked = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held_out"), F.col(text_col).cast("string").alias("text")
    )
    return _scored(picked, model, "text", None, CHANCE, with_text=False).toDF("doc_id", "held_out", *[name for name, _ in ADDED])
