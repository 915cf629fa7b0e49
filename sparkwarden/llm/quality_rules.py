"""Quality rules under weak supervision: rules vote or abstain, and expectation-maximisation weighs them.

Each rule reads counts of a whole text and says good (1), bad (-1) or nothing (0). Rules are taken as independent given
the unknown quality, with one accuracy each. Documents with equal votes are alike to the model, so the corpus is reduced
to counts of vote patterns (at most 3 to the number of rules, whatever the corpus) before the model sees them; the
accuracies come from all documents, and the posterior probability of each pattern goes back to its documents.

Defined results: words are runs without ASCII white space. A null or empty text has no words and fails the base rules.
A
posterior equal to the threshold keeps. Repeated rows are judged alike, one row each. Extra columns stay out of the result of ``judge`` and, in ``keep_good``,
stay with their rows. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwarden.llm.common import map_texts, packed, table, unpacked
from sparkwarden.session import materialize

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
KEEP_AT = 0.5
ROUNDS = 200

RULES = ("repeats", "symbols", "shouting", "lines", "word_length", "sentences", "short_words", "bare_marks")
_ENDS = re.compile(r"[.!?…]+[\"'»”)]*(?=[ \t\n\v\f\r]|$)")


def count_repeats(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more, each word once."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    covered, end = 0, 0
    for i, window in enumerate(windows):
        if seen[window] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def measure(text: str | None) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and one vote for each rule."""
    text = text or ""
    words = text.encode().split()
    n = len(words)
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    dup_lines = len(lines) - len(set(lines))
    repeats = count_repeats(words)
    if not n:
        return (0, 0, symbols, 0, 0, *[0] * len(RULES))
    letters = sum(map(str.isalpha, text))
    upper = sum(map(str.isupper, text))
    ends = len(_ENDS.findall(text))
    shorts = [w for w in text.split() if len(w) <= 4]
    short = sum(map(str.isalpha, shorts))
    bare = sum(len(w) == 1 and not w.isalnum() for w in shorts)
    votes = (
        _vote(repeats / n, good_below=0.05, bad_above=0.2),
        _vote(symbols / n, good_below=0.05, bad_above=0.15),
        _vote(upper / max(letters, 1), good_below=0.2, bad_above=0.4),
        _vote(dup_lines / len(lines), good_below=0.1, bad_above=0.3),
        _vote(abs(chars / n - 6), good_below=3, bad_above=6),
        _vote(ends / n, good_below=0.35, bad_above=0.6),
        -_vote(short / n, good_below=0.1, bad_above=0.2),
        _vote(bare / n, good_below=0.1, bad_above=0.25),
    )
    return (n, chars, symbols, dup_lines, repeats, *votes)


def _vote(value: float, good_below: float, bad_above: float) -> int:
    return 1 if value < good_below else -1 if value > bad_above else 0


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, the counts, and the votes as one text of ``+``, ``-`` and ``0``, one for each rule."""

    def step(texts: list[str | None]) -> dict:
        rows = [measure(t) for t in texts]
        made = {c: [r[i] for r in rows] for i, c in enumerate(COUNTS)}
        made["__votes"] = ["".join("0+-"[v] for v in r[len(COUNTS) :]) for r in rows]
        return made

    return map_texts(docs, text, keep, ", ".join(f"{c} long" for c in COUNTS) + ", __votes string", step)


def fit(patterns: dict[str, int]) -> dict[str, float]:
    """Posterior probability of good quality for each vote pattern, from how often each occurs.

    For each rule and each class of documents, expectation-maximisation estimates how often the rule's votes are good or
    bad: its accuracies. An abstention says nothing. It starts from the guess that a document without a bad vote is
    good. A rule may be weak but not perverse: bad votes are never rarer among bad documents than among good ones, which
    also says which class is which. Without any document the result is empty.
    """
    if not patterns:
        return {}
    said = np.array([[[v == k for k in "+-"] for v in p] for p in patterns], dtype=float)
    weight = np.array(list(patterns.values()), dtype=float)
    good = np.where(said[:, :, 1].any(axis=1), 0.1, 0.95)
    for _ in range(ROUNDS):
        # A few documents of each class are taken as seen beforehand: good ones get good votes, bad ones any.
        for_good = np.tensordot(weight * good, said, 1) + [4, 0.1]
        for_bad = np.tensordot(weight * (1 - good), said, 1) + [2, 2]
        rates = np.stack([x / x.sum(axis=1, keepdims=True) for x in (for_good, for_bad)])
        wrong = rates[0, :, 0] < rates[1, :, 0]
        rates[:, wrong] = rates[:, wrong].mean(axis=0)
        prior = float(np.clip((weight @ good + 2) / (weight.sum() + 3), 0.05, 0.95))
        odds = np.log(prior / (1 - prior)) + np.tensordot(said, np.log(rates[0] / rates[1]), 2)
        new = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        moved = np.abs(new - good).max()
        good = new
        if moved < 1e-9:
            break
    return {p: round(float(g), 12) for p, g in zip(patterns, good, strict=True)}


def judge(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, the counts, ``base_failed``, ``kept`` and ``posterior`` for each row."""
    rows = materialize(measured(docs, keep, text), "votes")
    # At most 3 ** len(RULES) rows.
    patterns = {r[0]: r[1] for r in rows.groupBy("__votes").count().orderBy("__votes").collect()}
    spark = docs.sparkSession
    posterior = spark.createDataFrame(list(fit(patterns).items()), "__votes string, posterior double")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = rows.join(F.broadcast(posterior), "__votes").withColumn("base_failed", failed)
    kept = ~F.col("base_failed") & (F.col("posterior") >= KEEP_AT)
    out = out.select(*keep, *COUNTS, "base_failed", kept.alias("kept"), "posterior")
    return out


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass the base rules and the model, with all their columns."""
    judged = judge(packed(docs, "text"), ["__row"])
    return unpacked(judged.where("kept"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), ["doc_id"])
