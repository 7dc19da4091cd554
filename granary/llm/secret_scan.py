"""Secrets: candidates by pattern, false positives removed by a random forest.

The forest sees a candidate's length, its character transitions and classes, how much of it dictionary words cover,
whether it looks like or stands in a path or address, and the words on both sides.  ``vocabulary`` learns the dictionary and
the usual transitions between letters from a corpus; without one, a short list of words of file and field names stands in.
The forest is trained from labelled findings, given as (text, start, end, label) rows; without any, ``labelled_findings``
writes a fixed set of invented ones of known kinds.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache, cached_property
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.columns import numbered
from granary.session import forget, small_batches, written

#: Labelled findings that the forest is fitted on, at most.
MOST_FINDINGS = 6_000
TREES, DEPTH, LEAF = 32, 8, 4
#: A candidate is a secret if the forest's share of votes is at least this.
LEAST = 0.5
MASK = "<SECRET>"

#: Words that a corpus's dictionary holds, at most: the most frequent, among those of four to MOST_LETTERS letters.
MOST_WORDS, MOST_LETTERS = 20_000, 13
#: Characters on either side in which neighbouring words are looked for, candidates judged at a time.
NEAR, JUDGED = 40, 10_000

_PEM = re.compile(
    r"-----BEGIN ([A-Z0-9 ]{1,40})-----(?:(?:[A-Z][A-Za-z-]+: [^\n]*\n|[A-Za-z0-9+/=]++|\s++)*+-----END \1-----|(?:\s*+[A-Za-z0-9+/=]{20,}+(?=\s|\Z))*+)"
)
_LONG = re.compile(r"[A-Za-z0-9+/_\-]{16,}(?:\.[A-Za-z0-9_\-]{10,})*={0,2}")
_ASSIGNED = re.compile(
    r"(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_\- ]?key|access[_\- ]?key|auth|credential)s?[\"']?\s*[:=]+>?\s*[\"'`]?([^\s\"'`,;<>]{8,})", re.I
)
_BEFORE = re.compile(r"[A-Za-z]+")
_HEXADECIMAL = frozenset("0123456789abcdef")

#: Words that announce a secret, words that announce something else, and words that candidates may be made of.
SECRET_WORDS = frozenset("secret token password passwd pwd passphrase key apikey auth credential credentials bearer authorization access private aws".split())
OTHER_WORDS = frozenset(
    "commit sha md5 hash checksum digest uuid guid id integrity revision branch file path url href src image img data version build ref"
    " phone card isbn order invoice example sample placeholder".split()
)
DICTIONARY = frozenset(
    "the and for that with this from have not are was you all one can your which will about out up time data file name value user admin"
    " test example sample default config configuration setting settings index main page content image style script module package class"
    " function method object string number array list item order product customer address email phone message service server client"
    " request response error handler manager factory builder controller component element event listener model view table column row"
    " input output path local home system library resource source target build version release update install license public private"
    " static final return import export include password secret token key change placeholder your here insert enter none null true false"
    " document section chapter title header footer report project group account profile session state status type".split()
)

NAMES = [
    "length", "digits", "upper", "lower", "other", "entropy", "class_changes", "distinct", "longest_run", "vowels", "hexadecimal",
    "covered", "transitions", "slashes", "dashes", "repeated", "prefix_known", "path", "secret_before", "other_before", "other_after", "assigned",
    "quoted", "letters_only", "block",
]
_KNOWN = ("AKIA", "ASIA", "ghp_", "gho_", "github_pat_", "xoxb-", "xoxp-", "sk_live_", "sk-", "AIza", "eyJ", "glpat-", "npm_", "SG.")


def candidates(text: str) -> list[tuple[int, int, str]]:
    """Start, end and kind of each candidate, in order, none overlapping: key blocks, values assigned to a telling name, and long runs that hold a digit."""
    found = [(m.start(), m.end(), "block") for m in _PEM.finditer(text)] if "-----BEGIN " in text else []
    if "=" in text or ":" in text:
        found = _beside(found, ((m.start(1), m.end(1), "assigned") for m in _ASSIGNED.finditer(text)))
    runs = ((m.start(), m.end(), "run") for m in _LONG.finditer(text) if any(map(str.isdigit, m.group())) or m.group().startswith(_KNOWN))
    return _beside(found, runs)


def _beside(sure: list[tuple[int, int, str]], more: Iterable[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Both lists of spans in order, without those of the second that overlap one of the first."""
    out, k = [], 0
    for one in more:
        while k < len(sure) and sure[k][1] <= one[0]:
            out.append(sure[k])
            k += 1
        if k == len(sure) or one[1] <= sure[k][0]:
            out.append(one)
    return out + sure[k:]


@dataclass(frozen=True)
class Vocabulary:
    """Words that candidates may be made of, and the log-probability of each letter after another (rows and columns a to z)."""

    words: frozenset[str]
    transitions: np.ndarray

    @staticmethod
    def of(counts: dict[str, int]) -> Vocabulary:
        """From words of letters a to z, and how often each occurs."""
        pairs = np.ones((26, 26))
        for word, n in counts.items():
            at = np.frombuffer(word.encode(), np.uint8).astype(int) - 97
            np.add.at(pairs, (at[:-1], at[1:]), n)
        return Vocabulary(frozenset(counts) | DICTIONARY, np.log(pairs / pairs.sum(axis=1, keepdims=True)))

    @cached_property
    def beginnings(self) -> frozenset[str]:
        """The first four letters of the words that have so many."""
        return frozenset(w[:4] for w in self.words if len(w) >= 4)


def vocabulary(docs: DataFrame, text_col: str = "text", most: int = MOST_WORDS) -> Vocabulary:
    """The ``most`` words of four to MOST_LETTERS letters a to z that occur most often in all texts, and their transitions.

    The least count that keeps to ``most`` words is read off the number of words by count, so only words that are kept come
    to the driver; of words with one count, all are kept or none.
    """
    words = F.regexp_extract_all(F.lower(F.col(text_col).cast("string")), F.lit(r"\b([a-z]{4,%d})\b" % MOST_LETTERS), F.lit(1))
    counts = docs.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    counts = written(counts, "words")
    least, total = None, 0
    for r in counts.groupBy("n").count().orderBy(F.desc("n")).collect():
        total += r["count"]
        if total > most:
            break
        least = r.n
    kept = {} if least is None else {r.word: r.n for r in counts.where(F.col("n") >= least).collect()}
    forget(counts)
    return Vocabulary.of(kept)


def _coverage(s: str, known: Vocabulary) -> float:
    """Share of the characters that dictionary words of four letters or more cover, longest first from the left."""
    covered = 0
    for m in re.finditer("[a-z]{4,}", s.lower()):
        low, at = m.group(), 0
        while at < len(low) - 3:
            if low[at : at + 4] not in known.beginnings:
                at += 1
                continue
            for n in range(min(MOST_LETTERS, len(low) - at), 3, -1):
                if low[at : at + n] in known.words:
                    covered += n
                    at += n
                    break
            else:
                at += 1
    return covered / max(1, len(s))


def features(text: str, start: int, end: int, kind: str, known: Vocabulary | None = None) -> list[float]:
    """What the forest sees of a candidate, all of it, in time and memory in proportion to its length."""
    known = known or _plain()
    s = text[start:end]
    n = max(1, len(s))
    counts = Counter(s)
    classes = s.translate({ord(c): "d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "o" for c in counts})
    entropy = -sum(k / n * log2(k / n) for k in counts.values())
    runs = max((m.end() - m.start() for m in re.finditer(r"[a-z]+|[A-Z]+|\d+", s)), default=0)
    low = s.lower()
    pairs = [(a, b, k) for (a, b), k in Counter(zip(low, low[1:])).items() if "a" <= a <= "z" and "a" <= b <= "z"]
    steps = sum(k * known.transitions[ord(a) - 97, ord(b) - 97] for a, b, k in pairs)
    near, beyond = text[max(0, start - NEAR) : start], text[end : end + NEAR]
    if kind == "block":
        near += s[: s.find("-----", 10)]
    words = [w.lower() for w in _BEFORE.findall(near)][-4:]
    if kind == "block":
        words = [w for w in words if w != "key"]  # public keys are called so as well
    after = [w.lower() for w in _BEFORE.findall(beyond)][:3]
    tail = near.rstrip("\"'` \t=:>")
    return [
        float(end - start),
        classes.count("d") / n,
        classes.count("u") / n,
        classes.count("l") / n,
        classes.count("o") / n,
        entropy,
        sum(classes.count(a + b) for a in "dulo" for b in "dulo" if a != b) / n,
        len(counts) / n,
        runs / n,
        sum(low.count(c) for c in "aeiou") / n,
        float(set(low) <= _HEXADECIMAL),
        _coverage(s, known),
        float(steps / sum(k for _, _, k in pairs)) if pairs else -4.0,
        float(s.count("/")),
        float(s.count("-") + s.count("_")),
        max(counts.values(), default=0) / n,
        float(s.startswith(_KNOWN)),
        float("://" in near or bool(re.search(r"[./\\]$", near)) or s.count("/") > 1 or bool(re.match(r"\.\w{1,4}\b", beyond[:5]))),
        float(any(w in SECRET_WORDS for w in words)),
        float(any(w in OTHER_WORDS for w in words)),
        float(any(w in OTHER_WORDS for w in after)),
        float(kind == "assigned" or len(tail) < len(near.rstrip()) and near.rstrip()[len(tail) :].strip("\"'` ")[:1] in ("=", ":")),
        float(near[-1:] in "\"'`" and near != ""),
        float(s.isalpha()),
        float(kind == "block"),
    ]


@cache
def _plain() -> Vocabulary:
    return Vocabulary.of(dict.fromkeys(DICTIONARY, 1))


@dataclass
class Forest:
    """Trees as arrays: split feature (-1 at leaves), threshold, children, and the share of secrets; and the vocabulary of the features."""

    feature: np.ndarray
    threshold: np.ndarray
    child: np.ndarray
    share: np.ndarray
    roots: list[int]
    known: Vocabulary | None = None

    def predict(self, x: np.ndarray) -> np.ndarray:
        votes = np.zeros(len(x))
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(DEPTH + 1):
                f = self.feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(f, 0)] > self.threshold[at]
                at = np.where(inner, self.child[at, right.astype(int)], at)
            votes += self.share[at]
        return votes / max(1, len(self.roots))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, leaf: int = LEAF, seed: int = 7) -> Forest:
    """Bagged trees by Gini impurity, each split among the square root of the features."""
    rng = np.random.default_rng(seed)
    feature, threshold, child, share, roots = [], [], [], [], []

    def node(rows: np.ndarray, level: int) -> int:
        me = len(feature)
        for column, value in ((feature, -1), (threshold, 0.0), (child, (0, 0)), (share, float(y[rows].mean()))):
            column.append(value)
        if level == depth or len(rows) < 2 * leaf or share[me] in (0.0, 1.0):
            return me
        best = (np.inf, -1, 0.0)
        for f in rng.choice(x.shape[1], max(1, int(x.shape[1] ** 0.5)), replace=False):
            by = np.argsort(x[rows, f], kind="stable")
            values, ones = x[rows, f][by], np.cumsum(y[rows][by])
            n = np.arange(1, len(rows))
            left, right = ones[:-1] / n, (ones[-1] - ones[:-1]) / (len(rows) - n)
            impurity = n * left * (1 - left) + (len(rows) - n) * right * (1 - right)
            impurity[(values[1:] == values[:-1]) | (n < leaf) | (len(rows) - n < leaf)] = np.inf
            k = int(np.argmin(impurity))
            if impurity[k] < best[0]:
                middle = float((values[k] + values[k + 1]) / 2)  # of neighbouring floats, it may be the larger one
                best = (float(impurity[k]), int(f), middle if middle < values[k + 1] else float(values[k]))
        if best[1] < 0:
            return me
        feature[me], threshold[me] = best[1], best[2]
        right = x[rows, best[1]] > best[2]
        child[me] = (node(rows[~right], level + 1), node(rows[right], level + 1))
        return me

    for _ in range(trees):
        roots.append(node(rng.integers(0, len(x), len(x)), 0))
    return Forest(np.array(feature), np.array(threshold), np.array(child), np.array(share), roots)


def labelled_findings(n: int = 3000, seed: int = 11) -> list[tuple[str, int, int, int]]:
    """Invented findings of known kinds: text, start, end, and 1 for a secret; the same at every call."""
    rng = np.random.default_rng(seed)
    pick = lambda items: items[int(rng.integers(len(items)))]
    draw = lambda letters, k: "".join(letters[i] for i in rng.integers(0, len(letters), k))
    hexa, digits, lower = "0123456789abcdef", "0123456789", "abcdefghijklmnopqrstuvwxyz"
    mixed = lower + lower.upper() + digits
    words = sorted(DICTIONARY)
    syllables = "an ber con de en er est ing ion la le men on or pre re st te ti un ver".split()
    word = lambda: "".join(pick(syllables) for _ in range(int(rng.integers(1, 5))))
    prose = lambda: " ".join(word() for _ in range(int(rng.integers(2, 7))))
    out = []
    for _ in range(n):
        name = pick(["token", "api_key", "secret", "password", "access_key", "auth_token", "client_secret", "apikey", "TOKEN", "SECRET_KEY", "passwd"])
        give = pick(['{} = "{}"', "{}={}", "{}: {}", '"{}": "{}"', "{} = '{}'", "{}:{}"])
        yes = bool(rng.random() < 0.5)
        if rng.random() < 0.04:
            body = "\n".join(draw(mixed + "+/", 64) for _ in range(int(rng.integers(1, 12))))
            title = pick(["RSA PRIVATE KEY", "PRIVATE KEY", "EC PRIVATE KEY", "OPENSSH PRIVATE KEY"] if yes else ["CERTIFICATE", "PUBLIC KEY", "RSA PUBLIC KEY", "CERTIFICATE REQUEST"])
            value = f"-----BEGIN {title}-----\n{body}\n-----END {title}-----"
            text = f"{prose()}\n{value}\n{prose()}"
        elif yes:
            value = pick(
                [
                    lambda: draw(hexa, int(pick([32, 40, 64]))),
                    lambda: draw(mixed, int(rng.integers(20, 44))),
                    lambda: draw(mixed + "+/", int(rng.integers(38, 60))) + "==",
                    lambda: "AKIA" + draw(lower.upper() + digits, 16),
                    lambda: pick(["ghp_", "sk_live_", "xoxb-", "glpat-"]) + draw(mixed, int(rng.integers(20, 36))),
                    lambda: "eyJ" + draw(mixed, 30) + "." + draw(mixed, 40) + "." + draw(mixed, 30),
                    lambda: draw(mixed + "!@#%^*", int(rng.integers(10, 18))) + draw(digits, 2),
                ]
            )()
            loose = value.startswith(_KNOWN) and rng.random() < 0.5
            before, after = ("", "") if loose else give.split("{}", 1)[0], ""
            body = value if loose else before + name + give.split("{}")[1] + value
            after = "" if loose else give.split("{}")[2]
            text = f"{prose()} {body}{after} {prose()}"
        else:
            kind = int(rng.integers(10))
            value = [
                lambda: pick(words) + pick(["_", "-", ""]) + pick(words) + pick(["_", "-"]) + pick(words) + draw(digits, 2),
                lambda: "".join(pick(words).title() for _ in range(4)) + draw(digits, 1),
                lambda: "-".join(draw(hexa, k) for k in (8, 4, 4, 4, 12)),
                lambda: draw(hexa, int(pick([40, 32, 64]))),
                lambda: draw(digits, int(rng.integers(16, 20))),
                lambda: "/".join(pick(words) for _ in range(4)) + "/" + pick(words) + draw(digits, 2),
                lambda: pick(["your", "insert", "enter"]) + "_" + pick(["api_key", "token", "password", "secret"]) + "_here1",
                lambda: pick("xX0*a1") * int(rng.integers(16, 30)) + "1",
                lambda: "".join(pick(syllables) for _ in range(9)) + draw(digits, 1),
                lambda: "iVBORw0KGgo" + draw(mixed + "+/", 60),
            ][kind]()
            if kind in (6, 7):
                body = give.format(name, value)
            elif kind == 9:
                body = "src=data:image/png;base64," + value
            elif kind == 3:
                body = pick(["commit {}", "sha256:{}", "md5 = {}", "checksum: {}", "revision {}", "integrity hash {}"]).format(value)
            elif kind == 2:
                body = pick(["id {}", "uuid: {}", "guid = {}", "request {}"]).format(value)
            elif kind == 5:
                body = pick(["https://example.com/{}", "/usr/{}", "see {}.html", "path {}"]).format(value)
            else:
                body = pick(["{}", "file {}", "name = {}", "see {},", "order {}"]).format(value)
            text = f"{prose()} {body} {prose()}"
        start = text.index(value)
        out.append((text, start, start + len(value), int(yes)))
    return out


def train(
    findings: list[tuple[str, int, int, int]] | DataFrame | None = None, most: int = MOST_FINDINGS, seed: int = 7, known: Vocabulary | None = None
) -> Forest:
    """A forest from labelled findings; of a DataFrame (text, start, end, label), the ``most`` with the smallest md5."""
    if isinstance(findings, DataFrame):
        rows = findings.orderBy(F.md5(F.concat_ws(":", "text", "start", "end")), "start").limit(most).collect()
        findings = [(r["text"], r["start"], r["end"], r["label"]) for r in rows]
    findings = labelled_findings() if findings is None else findings
    x, y = [], []
    for text, start, end, label in findings[:most]:
        kind = next((k for a, _, k in candidates(text) if a == start), "run")
        x.append(features(text, start, end, kind, known))
        y.append(label)
    forest = grow(np.array(x, float), np.array(y, float), seed=seed)
    forest.known = known
    return forest


_FINDING = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("score", pa.float64()), ("secret", pa.bool_())])


def _judged(texts: list[str], forest: Forest, least: float) -> list[list[dict]]:
    found = [candidates(t) for t in texts]
    every = [(t, c) for t, own in zip(texts, found) for c in own]
    scores: list[float] = []
    for k in range(0, len(every), JUDGED):
        x = np.array([features(t, *c, forest.known) for t, c in every[k : k + JUDGED]], float)
        scores += forest.predict(x).tolist()
    left = iter(scores)
    return [[{"start": a, "end": b, "kind": k, "score": (p := next(left)), "secret": p >= least} for a, b, k in own] for own in found]


def _masked(text: str, found: list[dict], mask: str) -> str:
    pieces, at = [], 0
    for f in found:
        if f["secret"]:
            pieces += [text[at : f["start"]], mask]
            at = f["end"]
    return "".join([*pieces, text[at:]])


def scan(
    docs: DataFrame, forest: Forest, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST
) -> DataFrame:
    """For each row ``doc_id, findings``: candidates with code-point spans, kind, score, and whether they are secrets.

    Edge cases: null and empty texts have no findings; repeated rows are scanned each; a null id is carried through; very
    long texts are scanned whole; an empty table gives none; other columns, whatever their names, are neither read nor
    returned.  Spans of one text don't overlap.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _judged([t or "" for t in batch.column(1).to_pylist()], shared.value, least)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(_FINDING))], ["doc_id", "findings"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(
        run, "doc_id long, findings array<struct<start long, end long, kind string, score double, secret boolean>>"
    )


def redact(
    docs: DataFrame, forest: Forest, text_col: str = "text", chars_col: str = "n_chars", mask: str = MASK, least: float = LEAST
) -> DataFrame:
    """``docs`` with every secret of the text replaced by ``mask`` (and ``n_chars``, if there, counted again); rows all stay.

    A null text stays null, an empty one empty; repeated rows are masked each; very long texts are masked whole; an empty
    table stays empty.  Columns other than the two pass through unread, in order, whatever their names.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(forest)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for i, own in enumerate(_judged([t or "" for t in texts], shared.value, least)):
                if any(f["secret"] for f in own):
                    texts[i] = _masked(texts[i], own, mask)
            columns = list(batch.columns)
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    rows, name = numbered(docs)
    out = rows.mapInArrow(run, rows.schema)
    if chars_col in name:
        kind = docs.schema[chars_col].dataType
        out = out.withColumn(name[chars_col], F.coalesce(F.length(name[text_col]).cast(kind), F.col(name[chars_col])))
    return out.toDF(*docs.columns)
