"""Quality by weak supervision, in DataFrame expressions only.

Rules look at statistics of a whole text and vote good (1), bad (0) or abstain.  How the votes fall is counted over all
documents: with R rules there are at most 3^R patterns, so that table is small at any size.  Expectation-maximisation on
it estimates the share of good documents and, for each rule, how often it votes good on good and on bad documents, without
any label.  The posterior log-odds of a document are then a sum of one literal a rule, evaluated in the scan.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.columns import fresh, numbered
from granary.session import written

SPACES = "[\\x20\\x09-\\x0D]+"
#: A document is kept if its posterior probability of being good is at least this.
LEAST = 0.5
ITERATIONS = 50
#: Least probability of an outcome, pseudo-count of each, and the first guesses of a posterior with and without a vote for bad.
FLOOR, PSEUDO = 0.001, 0.5
FIRST_BAD, FIRST_GOOD = 0.1, 0.98


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with word, symbol, line and repetition counts of each whole text (null: none) in a struct ``stats``.

    Repeated words: three-word windows are hashed and sorted with their places; those with an equal neighbour occur twice
    or more; the words that they cover are counted from their sorted places, each once.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = docs.select("*", F.filter(F.split(text, SPACES), lambda w: w != "").alias("_w"))
    n = F.size("_w")
    windows = F.transform(
        F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)).alias("h"), i.alias("i")),
    )
    d = d.select("*", F.array_sort(windows).alias("_s"))
    met = lambda x, i: (x.h == F.get("_s", i - 1).h) | (x.h == F.get("_s", i + 1).h)
    places = F.transform(F.filter("_s", met), lambda x: x.i)
    d = d.select("*", F.sort_array(places).alias("_p"))
    covered = F.aggregate(
        F.transform("_p", lambda x, i: F.least(F.lit(3), F.coalesce(F.get("_p", i + 1) - x, F.lit(3)))), F.lit(0), lambda a, x: a + x
    )
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    d = d.select("*", lines.alias("_l"))
    counted = {
        "n_words": n,
        "word_chars": F.length(F.array_join("_w", "")),
        "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")),
        "n_dup_lines": F.size("_l") - F.size(F.array_distinct("_l")),
        "n_repeat_words": covered,
        "n_lines": F.size("_l"),
        "n_capitals": F.regexp_count(text, F.lit("[A-Z]")),
        "n_digits": F.regexp_count(text, F.lit("[0-9]")),
        "n_marked": F.regexp_count(text, F.lit("[!?]{2,}")),
    }
    stats = F.struct(*[c.cast("long").alias(k) for k, c in counted.items()])
    return d.select("*", stats.alias("stats")).drop("_w", "_s", "_p", "_l")


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, 0).when(good, 1).otherwise(-1)


def default_rules() -> dict[str, Column]:
    """The rules' votes: 1 good, 0 bad, -1 none."""
    s = {
        k: F.col(f"stats.{k}").cast("double")
        for k in "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_capitals n_digits n_marked".split()
    }
    words, chars, lines = (F.greatest(s[k], F.lit(1.0)) for k in ("n_words", "word_chars", "n_lines"))
    return {
        "long_enough": _vote(words >= 80, words < 50),
        "few_symbols": _vote(s["n_symbols"] < 0.01 * words, s["n_symbols"] > 0.1 * words),
        "symbol_share": _vote(F.lit(False), s["n_symbols"] > 0.03 * chars),
        "word_length": _vote(F.lit(False), (chars < 2.5 * words) | (chars > 13 * words)),
        "little_repeated": _vote(s["n_repeat_words"] < 0.05 * words, s["n_repeat_words"] > 0.4 * words),
        "lines_differ": _vote(F.lit(False), (s["n_dup_lines"] > 0.3 * lines) & (s["n_dup_lines"] >= 3)),
        "few_capitals": _vote(F.lit(False), s["n_capitals"] > 0.3 * chars),
        "few_digits": _vote(F.lit(False), s["n_digits"] > 0.2 * chars),
        "calm_marks": _vote(F.lit(False), s["n_marked"] > 0.1 * words),
    }


@dataclass
class LabelModel:
    """Share of good documents; by rule, the probabilities of its outcomes (bad, good, abstained) on bad and on good documents."""

    prior: float
    on_bad: dict[str, tuple[float, float, float]]
    on_good: dict[str, tuple[float, float, float]]

    def log_odds(self, votes: dict[str, Column]) -> Column:
        total = F.lit(log(self.prior / (1 - self.prior)))
        for name, vote in votes.items():
            weigh = [log(g / b) for g, b in zip(self.on_good[name], self.on_bad[name])]
            total = total + F.when(vote == 0, weigh[0]).when(vote == 1, weigh[1]).otherwise(weigh[2])
        return total

    def accuracy(self, name: str) -> float:
        """Share of the rule's votes that are right."""
        right = self.prior * self.on_good[name][1] + (1 - self.prior) * self.on_bad[name][0]
        wrong = self.prior * self.on_good[name][0] + (1 - self.prior) * self.on_bad[name][1]
        return right / (right + wrong)


def estimate(patterns: list[tuple[tuple[int, ...], int]], names: list[str], iterations: int = ITERATIONS) -> LabelModel:
    """Expectation-maximisation over (votes, count) pairs; the first guess trusts any vote for bad."""
    patterns = sorted(patterns)
    total = sum(n for _, n in patterns)
    posterior = [FIRST_BAD if 0 in votes else FIRST_GOOD for votes, _ in patterns]
    model = LabelModel(0.5, {}, {})
    for _ in range(iterations):
        good = sum(p * n for p, (_, n) in zip(posterior, patterns))
        model = LabelModel((good + 1) / (total + 2), {}, {})
        for r, name in enumerate(names):
            for table, weight, of in ((model.on_good, posterior, good), (model.on_bad, [1 - p for p in posterior], total - good)):
                cast = [sum(p * n for p, (v, n) in zip(weight, patterns) if v[r] == k) for k in (0, 1, -1)]
                held = [max(FLOOR, (c + PSEUDO) / (of + 3 * PSEUDO)) for c in cast]
                table[name] = tuple(h / sum(held) for h in held)
        posterior = []
        for votes, _ in patterns:
            x = log(model.prior / (1 - model.prior))
            for v, name in zip(votes, names):
                x += log(model.on_good[name][v] / model.on_bad[name][v])  # -1 is the last of three
            posterior.append(1 / (1 + exp(-max(-500.0, min(500.0, x)))))
    return model


def fit(counted: DataFrame, rules: dict[str, Column] | None = None) -> LabelModel:
    """The label model of all documents of ``counted`` (from ``statistics``)."""
    rules = rules or default_rules()
    names = list(rules)
    rows = counted.select(*[v.alias(k) for k, v in rules.items()]).groupBy(*names).count().collect()
    return estimate([(tuple(r[k] for k in names), r["count"]) for r in rows], names)


ADDED = ["stats", "votes", "posterior", "base_failed", "kept"]


def _judged(counted: DataFrame, rules: dict[str, Column] | None, least: float) -> DataFrame:
    """Counted rows with votes, posterior and verdict."""
    rules = rules or default_rules()
    model = fit(counted, rules)
    failed = (F.col("stats.n_words") < 50) | (100 * F.col("stats.n_repeat_words") > 50 * F.col("stats.n_words"))
    odds = model.log_odds({k: F.col(f"votes.{k}") for k in rules})
    return (
        counted.withColumn("votes", F.struct(*[v.cast("int").alias(k) for k, v in rules.items()]))
        .withColumn("posterior", 1 / (1 + F.exp(-odds)))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= least))
    )


def quality(docs: DataFrame, text_col: str = "text", rules: dict[str, Column] | None = None, least: float = LEAST) -> DataFrame:
    """``docs`` with ``stats``, ``votes`` (by rule), ``posterior``, ``base_failed`` and ``kept``.

    ``base_failed``: fewer than 50 words, or over half of the words in repeated windows.  ``kept``: not that, and a
    posterior of at least ``least``.

    The statistics are written to the shared folder before they are used: they are needed twice, and an optimizer that
    pushed them into the votes would evaluate the sorted windows once for every look at a neighbour.

    Edge cases: a null, empty or blank text has no words and fails the base; repeated rows count and are returned each;
    very long texts are counted whole; an empty table gives an empty result; a document on which all rules abstain has the
    prior.  Columns of ``docs`` pass through whatever their names; an added column whose name is taken, in whatever case,
    gets underscores behind it.
    """
    rows, name = numbered(docs)
    counted = written(statistics(rows, name[text_col]), "quality")
    return _judged(counted, rules, least).toDF(*docs.columns, *fresh(docs.columns, ADDED))


def good(docs: DataFrame, text_col: str = "text", rules: dict[str, Column] | None = None, least: float = LEAST) -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, with the columns of ``docs``, whatever their names."""
    rows, name = numbered(docs)
    counted = written(statistics(rows, name[text_col]), "quality")
    return _judged(counted, rules, least).where("kept").select(*rows.columns).toDF(*docs.columns)


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document, without its text: id, statistics, votes, posterior and verdict; the statistics are made once."""
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return _judged(written(statistics(picked).drop("text"), "quality"), None, LEAST)
