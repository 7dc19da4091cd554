"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces with log scores.

The vocabulary is any SentencePiece model file; its pieces' scores are taken as log scores, whatever trained them.  White
space becomes the marker U+2581, one is put before the text, and characters without a piece of their own fall back to
their bytes' pieces.  Decoding joins pieces, turns byte pieces back into bytes and markers into spaces.

No piece of a usual vocabulary has a marker after another character.  Where that holds (it is checked), the best path of a
text is that of its units, a unit being a run of markers with the word that follows; characters that only stand alone in
pieces end units too.  Each distinct unit is solved once and kept, in a bounded table, so a text costs a look-up a word.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.session import small_batches

#: Parameter: the vocabulary; only the driver reads it.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes a vocabulary may have: its trie is sent to every executor.
MOST_BYTES = 64 << 20
MARKER = "▁"
#: Piece types of the file format, and what a character without a piece costs below the lowest score.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_PENALTY = 10.0
#: Units kept at a time in one worker.
KEPT_UNITS = 400_000


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of one protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield key >> 3, data[at : at + size]
            at += size


@dataclass
class Vocabulary:
    pieces: list[str]
    scores: list[float]
    types: list[int]
    prefix: bool = True


def read_vocabulary(path: str = VOCABULARY) -> Vocabulary:
    """Pieces, scores and types of a model file, and whether a marker is put before a text."""
    with open(path, "rb") as f:
        data = f.read(MOST_BYTES + 1)
    if len(data) > MOST_BYTES:
        raise ValueError(f"{path} has more than {MOST_BYTES} bytes")
    v = Vocabulary([], [], [])
    for number, value in _fields(data):
        if number == 1:
            own = dict(_fields(value))
            v.pieces.append(own.get(1, b"").decode())
            v.scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
            v.types.append(own.get(3, NORMAL))
        elif number == 3:
            v.prefix = bool(dict(_fields(value)).get(3, 1))
    return v


class DoubleArray:
    """A trie of byte strings in two arrays: the child of state s by byte c is base[s] + c if check there is s."""

    def __init__(self, words: list[tuple[bytes, int]]):
        children: list[dict[int, int]] = [{}]
        ends: dict[int, int] = {}
        for word, value in words:
            node = 0
            for c in word:
                node = children[node].setdefault(c, len(children))
                if node == len(children):
                    children.append({})
            ends[node] = value
        used = np.zeros(2 * len(children) + 4096, bool)
        parent, bases = np.full(len(used), -1, np.int64), np.zeros(len(used), np.int64)
        values = np.full(len(used), -1, np.int64)
        used[:257] = True
        free = top = 257
        todo = [(0, 0)]
        for node, state in todo:
            values[state] = ends.get(node, -1)
            own = children[node]
            if not own:
                continue
            letters = np.array(sorted(own))
            while free < top and used[free]:
                free += 1
            if top + 512 > len(used) - 256:
                grow = len(used)
                used = np.concatenate((used, np.zeros(grow, bool)))
                parent, bases, values = (
                    np.concatenate((x, np.full(grow, fill))) for x, fill in ((parent, -1), (bases, 0), (values, -1))
                )
            first = np.flatnonzero(~used[free : min(free + 4096, top)]) + free
            for step in letters[1:] - letters[0]:
                first = first[~used[first + step]]
            base = int((first[0] if len(first) else top) - letters[0])
            at = base + letters
            used[at] = True
            bases[state] = base
            parent[at] = state
            top = max(top, int(at[-1]) + 1)
            todo += [(own[int(c)], base + int(c)) for c in letters]
        end = top + 256
        self.base, self.check, self.value = bases[:end].tolist(), parent[:end].tolist(), values[:end].tolist()


class _Kept(dict):
    """Ids of the units met so far, as bytes; the table starts anew when it is full."""

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec = codec

    def __missing__(self, unit: str) -> bytes:
        if len(self) >= KEPT_UNITS:
            self.clear()
        ids = self[unit] = np.array(self.codec.best_path(unit), np.int32).tobytes()
        return ids

    def __reduce__(self):
        return _Kept, (self.codec,)


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, v: Vocabulary):
        self.pieces = v.pieces
        self.prefix = v.prefix
        matched = [(p.encode(), k) for k, (p, t) in enumerate(zip(v.pieces, v.types)) if t in (NORMAL, USER) and p]
        self.trie = DoubleArray(matched)
        self.scores = v.scores
        self.unknown = next((k for k, t in enumerate(v.types) if t == UNKNOWN), 0)
        self.unknown_score = min([v.scores[k] for _, k in matched], default=0.0) - UNKNOWN_PENALTY
        byte = {int(p[3:5], 16): k for k, (p, t) in enumerate(zip(v.pieces, v.types)) if t == BYTE}
        self.byte = [byte.get(b, self.unknown) for b in range(256)] if byte else None
        self.is_byte = np.array([t == BYTE for t in v.types])
        spelled = {k: bytes([b]) for b, k in byte.items()}
        texts = [
            spelled.get(k, b"" if t == CONTROL else " ⁇ ".encode() if t == UNKNOWN else p.replace(MARKER, " ").encode())
            for k, (p, t) in enumerate(zip(v.pieces, v.types))
        ]
        self.pool = np.frombuffer(b"".join(texts), np.uint8)
        self.lengths = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        texts = [p for p, t in zip(v.pieces, v.types) if t in (NORMAL, USER)]
        inner = set("".join(p for p in texts if len(p) > 1)) - {MARKER}
        self.separable = not any(MARKER in p.lstrip(MARKER) for p in texts)
        if self.separable and inner:
            own = "".join(map(re.escape, sorted(inner)))
            self.units = re.compile(f"{MARKER}*[{own}]+|{MARKER}+|[^{own}{MARKER}]")
        else:
            self.units = re.compile("(?s).+")
        self.kept = _Kept(self)

    def best_path(self, unit: str) -> list[int]:
        """Ids of the pieces of highest total score; of equal totals, the one with the longer last piece."""
        data = unit.encode("utf-8", "surrogatepass")
        n = len(data)
        base, check, value, scores = self.trie.base, self.trie.check, self.trie.value, self.scores
        best = [None] * (n + 1)
        best[0] = 0.0
        back = [(0, 0)] * (n + 1)
        start = 0
        while start < n:
            lead = data[start]
            width = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            total = best[start]
            alone = False
            state = 0
            for at in range(start, n):
                step = base[state] + data[at]
                if check[step] != state or step == 0:
                    break
                state = step
                piece = value[state]
                if piece >= 0:
                    end = at + 1
                    if end - start == width:
                        alone = True
                    new = total + scores[piece]
                    if best[end] is None or new > best[end]:
                        best[end] = new
                        back[end] = (start, piece)
            if not alone:
                end = start + width
                new = total + self.unknown_score
                if best[end] is None or new > best[end]:
                    best[end] = new
                    back[end] = (start, -1)
            start += width
        out: list[int] = []
        end = n
        while end > 0:
            start, piece = back[end]
            if piece >= 0:
                out.append(piece)
            elif self.byte is None:
                out.append(self.unknown)
            else:
                out += [self.byte[b] for b in reversed(data[start:end])]
            end = start
        out.reverse()
        return out

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        marked = (MARKER if self.prefix else "") + text.replace(" ", MARKER)
        return np.frombuffer(b"".join(map(self.kept.__getitem__, self.units.findall(marked))), np.int32)

    def decode(self, ids: np.ndarray | list[int]) -> str:
        """The text of known ids: all pieces' bytes are gathered from one pool at once."""
        ids = np.asarray(ids, np.int64)
        length = self.lengths[ids]
        ends = np.cumsum(length)
        at = np.repeat(self.starts[ids] - ends + length, length) + np.arange(ends[-1] if len(ends) else 0)
        out = self.pool[at].tobytes().decode("utf-8", "replace")
        return out[1:] if self.prefix and out[:1] == " " else out


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row ``doc_id, ids, n_byte_tokens, round_trip``: the best path's ids, and whether they decode to the text.

    Edge cases: null and empty texts have no ids (and decode to the empty text); a text that holds the marker itself
    decodes to one with spaces there, and ``round_trip`` compares with that; repeated rows are encoded each; a null id is
    carried through; very long texts are encoded whole; other columns are neither read nor returned.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(Codec(read_vocabulary(vocabulary)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.value
        for batch in batches:
            for first in range(0, batch.num_rows, 128):
                texts = [t or "" for t in batch.column(1).slice(first, 128).to_pylist()]
                ids = [codec.encode(t) for t in texts]
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                same = [codec.decode(i) == t.replace(MARKER, " ") for i, t in zip(ids, texts)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, 128),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))),
                        pa.array([int(codec.is_byte[i].sum()) for i in ids], pa.int64()),
                        pa.array(same, pa.bool_()),
                    ],
                    ["doc_id", "ids", "n_byte_tokens", "round_trip"],
                )

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, ids array<int>, n_byte_tokens long, round_trip boolean")


def decode(tokens: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """For each row ``doc_id, text``: the text of the ids; a null list is an empty text, unknown ids are left out."""
    shared = tokens.sparkSession.sparkContext.broadcast(Codec(read_vocabulary(vocabulary)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.value
        n = len(codec.lengths)
        for batch in batches:
            texts = [codec.decode([i for i in ids or [] if i is not None and 0 <= i < n]) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    picked = tokens.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return picked.mapInArrow(run, "doc_id long, text string")
