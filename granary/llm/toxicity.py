"""Toxicity: misspelling-tolerant lexicon matches in context.

The lexicon is learned from labelled rows of the training fold: words, and stems (beginnings of words), that are far
likelier in rows marked toxic.  Whole tokens are matched, with inner digits and symbols.  It is kept as a trie.  A
Levenshtein automaton of at most one edit (a letter too many, missing or wrong, or two swapped) is intersected with that
trie: a state is the set of (trie node, edits spent) pairs that a word read so far can be in.  States and steps are made
once, when first met, and kept, so each distinct word of a text costs a few table steps, and words far from every term die
after some letters.  Each match is weighed by the log-odds learned for its term and by its context: a match between an
opening and a closing quotation mark, or next to a word of reporting, counts as quotation and gets a usually smaller weight.
The weights of quoted and of misspelled matches are learned if at least LEAST_CONTEXT labelled rows hold only such matches;
else they are the defaults of ``Model``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import exp, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.wordhash import shingle_hashes, slices, word_hashes, words
from granary.session import small_batches

#: Labelled rows that the lexicon and the weights are learned from, at most: those with the smallest md5 of their id.
SAMPLE_ROWS = 10_000
#: Letters from which a term may be matched with one edit, and lengths of stems tried.
FUZZY_LETTERS = 5
STEMS = (2, 3, 4, 5, 6, 7)
#: A term must occur in this many toxic rows, be this many times likelier in toxic than in other rows, and have this much
#: evidence (rows times the divergence, in nats, of its share of toxic rows from the overall share): chance alone brings 9 to
#: about one word in ten thousand, and 14 to one stem in a million.
LEAST_ROWS, LEAST_RATIO, LEAST_EVIDENCE, LEAST_STEM_EVIDENCE = 3, 12.0, 9.0, 14.0
#: Share of other rows beyond which a stem, which stands for words never seen, isn't used.
MOST_IMPURE = 0.02
#: Rows from which the weight of a context is learned, at least.
LEAST_CONTEXT = 5
#: Words on either side that make a match's context, and characters in which they are looked for.
CONTEXT, CONTEXT_CHARS = 6, 72

#: Marks of quotation and words of reporting.
QUOTES = "\"“”«»‘’„`"
REPORTING = frozenset(
    "said says say called calls calling quote quoted quotes quoting wrote writes word words term insult insults slur slurs reported"
    " sagte nannte zitat wort dijo llama cita palabra dit cite mot".split()
)

_WORD = re.compile(r"[^\W\d_]+")
#: Letters and digits of a token, and what one symbol joins.
_RUN = re.compile(r"[^\W_]+")
#: An opening mark stands before a word and after none, a closing one the other way; an apostrophe inside a word is neither.
_MARK = re.compile(r"(?P<open>(?<!\w)[" + QUOTES + r"](?=\w))|(?P<close>(?<=\S)[" + QUOTES + r"](?!\w))")
_TOKEN = re.compile(r"\S+")


class Lexicon:
    """A trie of whole terms and stems, and the part of its product with the Levenshtein automaton that words have reached."""

    KEPT_STATES = 200_000

    def __init__(self, terms: dict[tuple[str, bool], float], loose: bool = False, plain: frozenset[str] = frozenset()):
        """``terms``: weight by (letters, whether it is a stem).

        Edits may not touch the first letter, and only whole terms of FUZZY_LETTERS take them.  If ``loose``, they may be
        anywhere, in whole terms of any length and stems of FUZZY_LETTERS; ``plain`` words then are no misspellings.
        """
        self.loose, self.plain = loose, plain
        self.near_stems: set[int] = set()
        self.short = {k for k, (letters, _) in enumerate(terms) if len(letters) < FUZZY_LETTERS}
        self.weights = list(terms.values())
        self.next: list[dict[str, int]] = [{}]
        self.whole: dict[int, int] = {}
        self.stem: dict[int, int] = {}
        self.fuzzy: set[int] = set()
        for k, (letters, is_stem) in enumerate(terms):
            node, path = 0, [0]
            for c in letters:
                node = self.next[node].setdefault(c, len(self.next))
                if node == len(self.next):
                    self.next.append({})
                path.append(node)
            (self.stem if is_stem else self.whole)[node] = k
            if len(letters) >= FUZZY_LETTERS and (loose or not is_stem) or loose and not is_stem:
                self.fuzzy.update(path)
                if is_stem:
                    self.near_stems.add(node)
        self._reset()

    def _reset(self) -> None:
        self.states: list[tuple[frozenset, tuple[int, int]]] = []
        self.numbers: dict[tuple, int] = {}
        self.steps: list[dict[str, int]] = []
        self.start = self._number(self._closed({(0, 0)}), (-1, -1))

    def _closed(self, pairs: set[tuple[int, int]]) -> frozenset:
        """Also what is reached by leaving out a letter of a term, but for the first unless loose."""
        return frozenset(pairs | {(n, 1) for node, e in pairs if (node or self.loose) and not e for n in self.next[node].values() if n in self.fuzzy})

    def _number(self, pairs: frozenset, stem: tuple[int, int]) -> int:
        key = (pairs, stem)
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(key)
            self.steps.append({})
        return self.numbers[key]

    def _step(self, state: int, letter: str) -> int:
        pairs, (stem, near) = self.states[state]
        reached: set[tuple[int, int]] = set()
        for node, edits in pairs:
            if isinstance(edits, str):  # the first of two swapped letters is to come
                if edits == letter:
                    reached.add((node, 1))
                continue
            n = self.next[node].get(letter)
            if n is not None and (not edits or n in self.fuzzy):
                reached.add((n, edits))
            if not edits and node in self.fuzzy and (node or self.loose):  # else the first letter must be right
                reached.add((node, 1))
                for other, m in self.next[node].items():
                    if m in self.fuzzy:
                        reached.add((m, 1))
                        swapped = self.next[m].get(letter)
                        if swapped in self.fuzzy and other != letter:
                            reached.add((swapped, other))
        if stem < 0:
            stem = max((self.stem[n] for n, e in reached if not e and n in self.stem), default=-1)
        pairs = self._closed(reached)
        if near < 0:
            near = max((self.stem[n] for n, e in pairs if e == 1 and n in self.near_stems), default=-1)
        exact = {n for n, e in pairs if not e}
        return self._number(frozenset(p for p in pairs if p[1] != 1 or p[0] not in exact), (stem, near))

    def match(self, word: str) -> tuple[int, int] | None:
        """Number of the term that a lower-case word is, begins with, or is one edit from; and 0, 1 or 2 for these three."""
        if len(self.states) > self.KEPT_STATES:
            self._reset()
        state, steps = self.start, self.steps
        for letter in word:
            step = steps[state].get(letter)
            if step is None:
                step = steps[state][letter] = self._step(state, letter)
            state = step
            if state == self.dead:
                return None
        pairs, (stem, near) = self.states[state]
        best = None
        for node, edits in pairs:
            k = None if isinstance(edits, str) else self.whole.get(node)
            if k is not None and (best is None or (2 * edits, -self.weights[k]) < (best[1], -self.weights[best[0]])):
                best = (k, 2 * edits)
        if best and not best[1]:
            return best
        if stem >= 0:
            return stem, 1
        if word in self.plain:
            return None
        return best or ((near, 2) if near >= 0 else None)

    @property
    def dead(self) -> int:
        return self.numbers.get((frozenset(), (-1, -1)), -1)


@dataclass
class Model:
    """Terms with log-odds, the weights of quoted matches and of misspelled terms, long and short, and the log-odds of a row without a match.

    ``plain`` holds words an edit from a term that clean rows use.
    """

    terms: dict[tuple[str, bool], float] = field(default_factory=dict)
    base: float = -3.0
    quoted: float = 0.35
    misspelled: float = 0.8
    short: float = 0.4
    plain: frozenset[str] = frozenset()

    def lexicon(self) -> Lexicon:
        return Lexicon(self.terms, True, self.plain)


def spellings(token: str) -> list[str]:
    """What of a lower-case token may be a term or one edit from it: its words, runs with a digit, and words around one symbol."""
    found = _WORD.findall(token)
    if "".join(found) == token:
        return found
    runs = list(_RUN.finditer(token))
    found += [r[0] for r in runs if not r[0].isalpha()]
    found += [token[a.start() : b.end()] for a, b in zip(runs, runs[1:]) if b.start() - a.end() == 1 and (a[0] + b[0]).isalpha()]
    return found


def matches(text: str, lexicon: Lexicon, known: dict[str, list[str] | None], terms: dict[str, tuple[int, int]]) -> list[tuple[int, int, bool]]:
    """Term, kind (0 whole, 1 stem, 2 misspelled) and whether it is quoted, for every match of a text.

    ``known`` keeps the matching words of every token met so far, ``terms`` the terms of those words.
    """
    low = text.lower()
    hit = False
    for token in set(low.split()):
        if token not in known:
            own = []
            for word in spellings(token):
                if (m := lexicon.match(word)) is not None:
                    terms[word] = m
                    own.append(word)
            known[token] = own or None
        hit = hit or known[token] is not None
    if not hit:
        return []
    found = []
    for token in _TOKEN.finditer(low):
        own = known.get(token[0])
        if not own:
            continue
        end = 0
        for start, length, word in sorted({(at, -len(w), w) for w in own for at in _standing(token[0], w)}):
            if start >= end:  # the first and longest of those that overlap
                end = start - length
                found.append((*terms[word], _quoted(low, token.start() + start, token.start() + end)))
    return found


def _standing(token: str, word: str) -> Iterator[int]:
    """Where a word stands in a token, with no letter beside it."""
    at = token.find(word)
    while at >= 0:
        end = at + len(word)
        if not (at and token[at - 1].isalpha()) and not token[end : end + 1].isalpha():
            yield at
        at = token.find(word, at + 1)


def _quoted(low: str, start: int, end: int) -> bool:
    """Whether the nearest marks within the context enclose a match, or a word of reporting stands near."""
    near = _WORD.findall(low[max(0, start - CONTEXT_CHARS) : start])[-3:] + _WORD.findall(low[end : end + CONTEXT_CHARS])[:2]
    return any(t in REPORTING for t in near) or _nearest_mark(low, start, -1) and _nearest_mark(low, end, 1)


def _nearest_mark(low: str, at: int, step: int) -> bool:
    """Whether going back (or on) from a match, within CONTEXT words, an opening (closing) quotation mark comes first."""
    if step < 0:
        part = low[max(0, at - CONTEXT_CHARS - 1) : at + 1]
        marks = [m for m in _MARK.finditer(part) if m.end() < len(part)]
        return bool(marks) and marks[-1][0] == marks[-1]["open"] and len(part[marks[-1].end() : -1].split()) <= CONTEXT
    part = low[at - 1 : at + CONTEXT_CHARS + 1]
    m = _MARK.search(part, 1)
    return bool(m) and m[0] == m["close"] and len(part[1 : m.start()].split()) <= CONTEXT


def likelihood(found: list[tuple[int, int, bool]], weights: list[float], model: Model, short: frozenset[int] | set[int] = frozenset()) -> float:
    """Probability of label 1: each term counts once, by its strongest context."""
    best: dict[int, float] = {}
    for term, kind, quoted in found:
        wrong = model.short if short and term in short else model.misspelled
        w = weights[term] * (wrong if kind == 2 else 1.0) * (model.quoted if quoted else 1.0)
        best[term] = max(best.get(term, 0.0), w)
    total = model.base + sum(best.values())
    return 1 / (1 + exp(-max(-30.0, min(30.0, total))))


def _one_of_each_family(rows: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """One row of those with the same label and the same smallest shingle hash: most copies of a text, which prove nothing more."""
    kept: dict[tuple[int, int], tuple[str, int]] = {}
    texts = pa.array([t or "" for t, _ in rows], pa.large_string())
    for part in slices(texts):
        w = words(part)
        h, begin = shingle_hashes(word_hashes(part, w), w, 5)
        for i in range(len(part)):
            least = int(h[begin[i] : begin[i + 1]].min()) if begin[i + 1] > begin[i] else 0
            kept.setdefault((least, rows[part.first + i][1]), rows[part.first + i])
    return list(kept.values())


def fit(rows: list[tuple[str, int]], most_terms: int | None = None) -> Model:
    """Learn terms and weights from texts and labels; at most ``most_terms`` terms, the purest, if that is given.

    Copies count once, by the first.  A term's log-odds are those of a row that holds it, smoothed by half a row.  Stems that add nothing to a chosen word or
    shorter stem are left out.  The weights of quoted and of misspelled matches come from how often rows with only such
    matches are toxic.
    """
    rows = _one_of_each_family([(t, int(bool(y))) for t, y in rows])
    toxic = sum(1 for _, y in rows if y)
    clean = len(rows) - toxic
    if not toxic or not clean:
        return Model(base=3.0 if toxic and not clean else -3.0)
    one: dict[str, str] = {}  # a word's only copy, whichever rows it is in
    bags = [({one.setdefault(w, w) for w in _WORD.findall((text or "").lower())}, bool(y)) for text, y in rows]
    cuts = lambda bag: {(w[:n], True) for n in STEMS for w in bag if len(w) > n}
    seen: Counter = Counter()
    del one
    for bag, y in bags:
        if y:
            seen.update((w, False) for w in bag if len(w) > 2)
            seen.update(cuts(bag))
    seen = Counter({t: p for t, p in seen.items() if p >= LEAST_ROWS})
    whole, stems = {w for w, s in seen if not s}, {n: {w for w, s in seen if s and len(w) == n} for n in STEMS}
    other: Counter = Counter()
    for bag, y in bags:
        if not y:
            other.update((w, False) for w in bag & whole)
            for n in STEMS:
                other.update((w, True) for w in stems[n] & {w[:n] for w in bag if len(w) > n})
    share = toxic / len(rows)
    chosen: dict[tuple[str, bool], float] = {}
    score = {}
    for t, p in seen.items():
        c = other[t]
        n, q = p + c, p / (p + c)
        evidence = n * (q * log(q / share) + ((1 - q) * log((1 - q) / (1 - share)) if c else 0.0))
        if (p + 0.5) / toxic >= LEAST_RATIO * (c + 0.5) / clean and evidence >= (LEAST_STEM_EVIDENCE if t[1] else LEAST_EVIDENCE) and not (t[1] and c > MOST_IMPURE * p):
            score[t] = log((p + 0.5) / (toxic + 1)) - log((c + 0.5) / (clean + 1))
    # the purest terms first, then the most frequent: a stem stands for all its words and longer stems, a word for its stems
    for t in sorted(score, key=lambda t: (other[t] / seen[t], -seen[t], t[1], len(t[0]), t)):
        letters, is_stem = t
        covered = any((letters[:n], True) in chosen for n in range(min(STEMS), len(letters) + 1))
        same = is_stem and any(w.startswith(letters) and seen[(w, s)] >= 0.8 * seen[t] for w, s in chosen)
        if not covered and not same:
            if is_stem:  # as long as it stays as frequent
                longer = [u for u in score if u[1] and u[0].startswith(letters) and seen[u] >= 0.95 * seen[t]]
                t = max(longer, key=lambda u: (len(u[0]), u[0]))
            chosen[t] = score[t]
        if len(chosen) == most_terms:
            break
    model = Model(chosen)
    lexicon, known, terms = model.lexicon(), {}, {}
    near: dict[str, list[int]] = {}
    for text, y in rows:
        own = {w for token in set((text or "").lower().split()) for w in spellings(token)}
        for w in own:
            if w in near or (m := lexicon.match(w)) is not None and m[1] == 2:
                near.setdefault(w, [0, 0])[y] += 1
    model.plain = frozenset(w for w, (c, p) in near.items() if c and (p + 0.5) / toxic < LEAST_RATIO * (c + 0.5) / clean)
    lexicon = model.lexicon()
    none, groups = [0, 0], {"quoted": [0, 0], "misspelled": [0, 0], "short": [0, 0], "plain": [0, 0]}
    for text, y in rows:
        if len(known) > 100_000:
            known.clear()
            terms.clear()
        found = matches(text or "", lexicon, known, terms)
        if not found:
            none[bool(y)] += 1
        elif all(q for _, _, q in found):
            groups["quoted"][bool(y)] += 1
        elif all(k == 2 for _, k, _ in found):
            groups["short" if all(t in lexicon.short for t, _, _ in found) else "misspelled"][bool(y)] += 1
        else:
            groups["plain"][bool(y)] += 1
    odds = lambda g: log((g[1] + 0.5) / (g[0] + 0.5))
    model.base = odds(none)
    gain = max(0.1, odds(groups["plain"]) - model.base)
    if sum(groups["quoted"]) >= LEAST_CONTEXT:
        model.quoted = max(0.0, min(1.0, (odds(groups["quoted"]) - model.base) / gain))
    if sum(groups["misspelled"]) >= LEAST_CONTEXT:
        model.misspelled = max(0.0, min(1.0, (odds(groups["misspelled"]) - model.base) / gain))
    if sum(groups["short"]) >= LEAST_CONTEXT:
        model.short = max(0.0, min(1.0, (odds(groups["short"]) - model.base) / gain))
    return model


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = SAMPLE_ROWS,
    most_terms: int | None = None,
) -> Model:
    """Fit on at most ``rows`` labelled ids: those with the smallest md5, whichever their labels, in that order.

    An id that is labelled twice has the greater label.  Without any row of either label the model knows no terms.
    """
    order = F.md5(F.col("id").cast("string"))
    picked = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
        .where("id is not null and y is not null")
        .groupBy("id").agg(F.max("y").alias("y")).orderBy(order, "id").limit(rows)
    )
    joined = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(picked), "id")
    found = joined.select(order.alias("k"), "text", "y").toArrow().sort_by([("k", "ascending"), ("text", "ascending")])
    return fit(list(zip(found["text"].to_pylist(), found["y"].to_pylist())), most_terms)


def toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row ``doc_id, score, n_matches, n_quoted, n_misspelled``; a score sees the text alone.

    Edge cases: null, empty and wordless texts have no match and get the score of a row without one.  Repeated rows are
    scored each, a null id is carried through, very long texts are read whole, an empty table gives none, other columns,
    whatever their names, are neither read nor returned.  A word as near to several terms counts for the heaviest.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        lexicon, weights = m.lexicon(), list(m.terms.values())
        known: dict[str, list[str] | None] = {}
        terms: dict[str, tuple[int, int]] = {}
        for batch in batches:
            out = []
            for text in batch.column(1):
                found = matches(text.as_py() or "", lexicon, known, terms)
                quoted, wrong = sum(q for _, _, q in found), sum(k == 2 for _, k, _ in found)
                out.append((likelihood(found, weights, m, lexicon.short), len(found), quoted, wrong))
                if len(known) > 100_000:
                    known.clear()
                    terms.clear()
            columns = [pa.array(x) for x in zip(*out)] if out else [pa.array([], pa.float64())] + [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "score", "n_matches", "n_quoted", "n_misspelled"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, score double, n_matches long, n_quoted long, n_misspelled long")
