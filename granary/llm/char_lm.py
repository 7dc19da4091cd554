"""Interpolated Kneser-Ney character models, one per language, in sorted hash arrays.

Texts are reduced to symbols: every lower-cased letter has its own code, and each run of anything else is one space.  A
gram is its symbols packed into one number: code points take POINT_BITS bits each, so ORDER of them fill 63 bits of a long
and no two grams share a number.  Small alphabets may be coded densely instead, with SYMBOL_BITS bits a symbol.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np

ORDER = 3
SYMBOL_BITS, POINT_BITS = 7, 21
SPACE, OTHER = 0, 1


@dataclass
class Symbols:
    """Symbols of some texts: text ``i`` has ``codes[begin[i]:begin[i + 1]]``; ``within`` is each symbol's place in its text."""

    codes: np.ndarray
    within: np.ndarray
    begin: np.ndarray


def letter_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of lower-cased letters and how often each occurs."""
    points = np.frombuffer("".join(texts).lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    found, n = np.unique(points, return_counts=True) if len(points) > 1 << 22 else _counted(points)
    keep = [chr(p).isalpha() for p in found.tolist()]
    return found[keep], n[keep]


def _counted(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = np.bincount(points) if len(points) else np.zeros(0, np.int64)
    found = np.flatnonzero(n)
    return found, n[found]


@cache
def point_table() -> np.ndarray:
    """Code of every code point: itself for a letter, 0 for what is no letter."""
    return np.fromiter((p if chr(p).isalpha() else SPACE for p in range(0x110000)), np.uint32, 0x110000)


def code_table(alphabet: list[int]) -> np.ndarray:
    """Code of every code point: 0 for what is no letter, 1 for letters outside the alphabet, from 2 on for its letters."""
    table = np.zeros(0x110000, np.uint32)
    letters = np.fromiter((chr(p).isalpha() for p in range(0x110000)), bool, 0x110000)
    table[letters] = OTHER
    for code, p in enumerate(sorted(alphabet), OTHER + 1):
        table[p] = code
    return table


def symbols(texts: list[str], table: np.ndarray) -> Symbols:
    """Symbols of whole texts, spaces run together."""
    lowered = [t.lower() for t in texts]
    lengths = np.fromiter(map(len, lowered), np.int64, len(lowered))
    edges = np.concatenate(([0], np.cumsum(lengths)))
    codes = table[np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)]
    first = np.zeros(len(codes) + 1, bool)
    first[edges[:-1]] = True
    first = first[:-1]
    keep = codes != SPACE
    keep[1:] |= codes[:-1] != SPACE
    keep |= first
    begin = np.concatenate(([0], np.cumsum(keep)))[edges]
    codes = codes[keep]
    within = np.arange(len(codes)) - np.repeat(begin[:-1], np.diff(begin))
    return Symbols(codes, within, begin)


def grams(s: Symbols, order: int = ORDER, bits: int = SYMBOL_BITS) -> np.ndarray:
    """The gram that ends at each symbol, oldest symbol highest; spaces stand before a text's start."""
    kind = _kind(order, bits)
    out = s.codes.astype(kind)
    for lag in range(1, order):
        back = np.zeros(len(out), kind)
        back[lag:] = s.codes[:-lag] if lag < len(out) else 0
        back[s.within < lag] = SPACE
        out |= back << kind(bits * lag)
    return out


def _kind(order: int, bits: int) -> type:
    """Type of a gram's number."""
    return np.uint32 if order * bits <= 32 else np.uint64


@dataclass
class Language:
    """Per order from 1: sorted grams and their log-probabilities; sorted contexts and their log back-off weights.

    ``size`` symbols exist; below the unigrams each of them is equally likely.
    """

    keys: list[np.ndarray]
    logs: list[np.ndarray]
    contexts: list[np.ndarray]
    backs: list[np.ndarray]
    bits: int
    size: int

    def log_probabilities(self, codes: np.ndarray) -> np.ndarray:
        """Natural log of each gram of the highest order."""
        return self._at(len(self.keys) - 1, codes)

    def _at(self, n: int, codes: np.ndarray) -> np.ndarray:
        if n < 0:
            return np.full(len(codes), -np.log(self.size), np.float32)
        keys = self.keys[n]
        at = np.minimum(np.searchsorted(keys, codes), len(keys) - 1)
        out = self.logs[n][at]
        missing = np.flatnonzero(keys[at] != codes)
        if len(missing):
            lost = codes[missing]
            context = lost >> codes.dtype.type(self.bits)
            own = self.contexts[n]
            c = np.minimum(np.searchsorted(own, context), len(own) - 1)
            back = np.where(own[c] == context, self.backs[n][c], np.float32(0))
            out[missing] = back + self._at(n - 1, lost & codes.dtype.type((1 << self.bits * n) - 1))
        return out


@dataclass
class Model:
    """Languages by name, and the model of each."""

    languages: list[str]
    models: list[Language]

    def log_probabilities(self, codes: np.ndarray) -> np.ndarray:
        """A row of natural logs by language for each gram of the highest order."""
        return np.stack([m.log_probabilities(codes) for m in self.models], axis=1)


def fit(counts: dict[str, tuple[np.ndarray, np.ndarray]], order: int = ORDER, bits: int = SYMBOL_BITS, size: int = 0) -> Model:
    """Models of all languages, each fitted by itself."""
    names = sorted(counts)
    return Model(names, [fit_language(*counts[name], order, bits, size) for name in names])


def fit_language(codes: np.ndarray, n: np.ndarray, order: int = ORDER, bits: int = SYMBOL_BITS, size: int = 0) -> Language:
    """Interpolated Kneser-Ney from the highest order's gram counts: continuation counts below, one discount an order.

    Discount D = n1 / (n1 + 2 n2); P(w|h) = max(c(hw) - D, 0) / c(h) + D * types(h) / c(h) * P(w|h'); the unigrams are
    mixed with the uniform distribution over ``size`` symbols, as many as the bits tell apart by default, so every symbol
    has some probability.
    """
    size = size or 1 << bits
    kind = _kind(order, bits)
    by = np.argsort(codes)
    levels = [(codes[by].astype(kind), n[by].astype(np.float64))]
    for k in range(order - 1, 0, -1):
        lower, types = np.unique(levels[0][0] & kind((1 << bits * k) - 1), return_counts=True)
        levels.insert(0, (lower, types.astype(np.float64)))
    keys, logs, contexts, backs = [], [], [], []
    probability = np.zeros(0)
    for k, (seen, n) in enumerate(levels):
        ones, twos = float((n == 1).sum()), float((n == 2).sum())
        discount = min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.5
        heads, head = np.unique(seen >> kind(bits), return_inverse=True)
        total = np.bincount(head, n)
        gamma = discount * np.bincount(head) / total
        # every suffix of a seen gram was seen itself
        below = probability[np.searchsorted(keys[k - 1], seen & kind((1 << bits * k) - 1))] if k else 1 / size
        probability = np.maximum(n - discount, 0) / total[head] + gamma[head] * below
        keys.append(seen)
        logs.append(np.log(probability).astype(np.float32))
        contexts.append(heads)
        backs.append(np.log(gamma).astype(np.float32))
    return Language(keys, logs, contexts, backs, bits, size)


def pack(m: Language) -> tuple[list[int], bytes]:
    """Lengths of a model's arrays and their bytes; every array begins at a multiple of 8."""
    arrays = [x for level in zip(m.keys, m.contexts, m.logs, m.backs) for x in level]
    return [len(x) for x in arrays], b"".join(x.tobytes() + bytes(-x.nbytes % 8) for x in arrays)


def unpack(lengths: list[int], data: np.ndarray, bits: int, size: int) -> Language:
    """The model over packed bytes, which are viewed in place; ``bits`` must fill grams of 64 bits."""
    arrays, at = [], 0
    for k, n in enumerate(lengths):
        kind = np.dtype(np.uint64 if k % 4 < 2 else np.float32)
        arrays.append(data[at : at + n * kind.itemsize].view(kind))
        at += -(-n * kind.itemsize // 8) * 8
    keys, contexts, logs, backs = (arrays[k::4] for k in range(4))
    return Language(keys, logs, contexts, backs, bits, size)
