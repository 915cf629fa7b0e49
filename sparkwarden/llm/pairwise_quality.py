"""Quality scores by Bradley-Terry ranking: preference pairs, logistic loss on feature differences, quantile threshold.

Every pair of a better and a worse document says that the first one's strength is the larger. Strengths are linear in
features of the whole text, so the model of a pair is a logistic regression on the difference of two feature vectors,
without intercept. Every labelled row is learnt from: rows are dealt by hash to blocks, in which each better one is paired
with each worse one, and Newton's method runs over the sums of all blocks, which tasks make. The loss is convex, so the
result does not depend on where it starts; a small fit on the driver (``SAMPLE`` of each label) only saves steps.
Features are measured once, for the model and the scores. Which strength is good enough is a quantile: the part of
labelled documents that are bad, among the strengths of all of them, found by counting.

Labels are read only from rows outside the held-out quarter. Text is the only input of a score.

Defined results: null and empty texts have the features of no words, and a score. Rows that repeat are scored alike, one
row each; a document with several labels gives several examples, rows that share a doc_id one for each of its labels. Null labels and null ids teach nothing; a null doc_id
is not held out. Without labels of both kinds every strength is zero and every score the threshold. A score equal
to the threshold predicts 1, equal texts have equal scores. Extra columns are not looked at. Empty tables give empty results.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwarden.llm.common import map_texts, table
from sparkwarden.llm.quality_rules import SYMBOLS, count_repeats
from sparkwarden.session import discard, materialize

# Labelled rows of each label that the start is fitted to, pairs made of them, strength of the pull to zero.
SAMPLE, PAIRS, RIDGE = 8_000, 60_000, 1e-3
# Rows of the rarer label in a block, and of the other one in a part of it; bins of a count, strengths collected at last.
FEW, MANY = 512, 4096
BINS, LAST = 1024, 4096
THRESHOLD = 0.7
HELD_OUT = 2
_ENDS = re.compile(r"[.!?…]+(?=\s|$)")
_LOUD = re.compile(r"!!|\?\?")
FEATURES = (
    "upper", "symbols", "marked_words", "bare_marks", "loud", "repeats", "repeated_lines", "top_word", "distinct", "digits",
    "short_words", "word_length", "long_words", "sentences", "lower_starts", "lines",
)


def features(text: str | None) -> list[float]:
    """Shares and lengths, each between 0 and some 3."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    lines = [x for x in text.split("\n") if x.strip()]
    seen = Counter(words)
    symbols = sum(map(text.count, SYMBOLS))
    short = [w for w in words if len(w) <= 4]
    return [
        sum(map(str.isupper, words)) / n,
        min(symbols / n, 3),
        sum(w[-1] in SYMBOLS for w in words) / n,
        sum(len(w) == 1 and not w.isalnum() for w in short) / n,
        min(len(_LOUD.findall(text)) / n, 1),
        count_repeats([w.encode() for w in words]) / n,
        1 - len(set(lines)) / len(lines),
        seen.most_common(1)[0][1] / n if n >= 20 else 0.0,
        1 - len(seen) / n,
        sum(map(text.count, "0123456789")) / len(text),
        sum(map(str.isalpha, short)) / n,
        min(len(text) / n / 10, 3),
        sum(len(w) > 20 for w in words) / n,
        min(len(_ENDS.findall(text)) / n, 1),
        sum(x[0].islower() for x in lines if x[0].isalpha()) / len(lines),
        min(len(lines) / n, 1),
    ]


def fit(better: np.ndarray, worse: np.ndarray, pairs: int = PAIRS, ridge: float = RIDGE) -> np.ndarray:
    """Weights of the strength, by Newton's method on the logistic loss of feature differences.

    Pairs are drawn with a fixed seed, so equal samples give equal weights.
    """
    width = better.shape[1] if len(better) else len(FEATURES)
    if not len(better) or not len(worse):
        return np.zeros(width)
    draw = np.random.default_rng(7)
    difference = better[draw.integers(0, len(better), pairs)] - worse[draw.integers(0, len(worse), pairs)]
    weights = np.zeros(width)
    for _ in range(40):
        lost = 1 / (1 + np.exp(np.clip(difference @ weights, -500, 500)))
        slope = difference.T @ lost / pairs - ridge * weights
        bend = (difference * (lost * (1 - lost))[:, None]).T @ difference / pairs + ridge * np.eye(width)
        step = np.linalg.solve(bend, slope)
        weights = weights + step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return weights


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, ``_f`` (the features) and ``_order``, which tells texts apart."""
    order = F.struct(F.xxhash64("text").alias("h"), F.md5("text").alias("d")).alias("_order")
    made = docs.select(*keep, order, "text")
    return map_texts(made, "text", [*keep, "_order"], "_f array<double>", lambda texts: {"_f": [features(t) for t in texts]})


def _blocks(rows: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """Rows in blocks, so that each meets some ``FEW`` to ``MANY`` of the other label: one row a block, features in a line."""
    rare = 1 if sizes[1] <= sizes[0] else 0
    blocks = max(1, sizes[rare] // FEW)
    parts = max(1, -(-sizes[1 - rare] // (blocks * MANY)))
    part = F.when(F.col("quality") == rare, F.sequence(F.lit(0), F.lit(parts - 1)))
    part = part.otherwise(F.array(F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(parts)).cast("int")))
    block = F.pmod(F.xxhash64("doc_id", F.lit("block")), F.lit(blocks)) * parts
    dealt = rows.select(block.alias("block"), F.explode(part).alias("part"), "quality", "doc_id", "n", "f")
    listed = dealt.groupBy((F.col("block") + F.col("part")).alias("block")).agg(F.sort_array(F.collect_list(F.struct("doc_id", "quality", "n", "f"))).alias("rows"))
    better, worse = (F.filter("rows", lambda r: r["quality"] == 1), F.filter("rows", lambda r: r["quality"] == 0))
    flat = []
    for of, name in ((better, "better"), (worse, "worse")):
        flat += [F.flatten(F.transform(of, lambda r: r["f"])).alias(name), F.transform(of, lambda r: r["n"].cast("double")).alias(f"{name}_n")]
    return listed.select("block", *flat)


def _block_sums(weights: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of each block: its pairs, and slope and bend of their logistic loss."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, *columns in zip(*batch.columns, strict=True):
                x, x_n, y, y_n = (c.values.to_numpy(zero_copy_only=False) for c in columns)
                x, y = x.reshape(-1, len(weights)), y.reshape(-1, len(weights))
                pairs = x_n[:, None] * y_n
                lost = 1 / (1 + np.exp(np.clip((x @ weights)[:, None] - y @ weights, -500, 500)))
                bent, lost = pairs * lost * (1 - lost), pairs * lost
                slope = x.T @ lost.sum(axis=1) - y.T @ lost.sum(axis=0)
                across = x.T @ bent @ y
                bend = (x.T * bent.sum(axis=1)) @ x + (y.T * bent.sum(axis=0)) @ y - across - across.T
                sums = np.concatenate([[pairs.sum()], slope, bend.ravel()])
                yield pa.RecordBatch.from_arrays([pa.array([block.as_py()]), pa.array([sums])], names=["block", "sums"])

    return run


def fit_all(blocks: DataFrame, weights: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """The weights that all pairs of all blocks give, by Newton's method from the given ones."""
    width = len(weights)
    for _ in range(40):
        rows = blocks.mapInArrow(_block_sums(weights), "block bigint, sums array<double>").collect()  # sums of some thousand rows each
        total = np.sum([r.sums for r in sorted(rows)], axis=0)
        slope = total[1 : width + 1] / total[0] - ridge * weights
        bend = total[width + 1 :].reshape(width, width) / total[0] + ridge * np.eye(width)
        step = np.linalg.solve(bend, slope)
        weights = weights + step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return weights


def quantile(strengths: DataFrame, weight: dict[int, float], part: float) -> float:
    """Between the least strength that ``part`` of all weight does not exceed and the next one.

    ``strengths``: quality, n, strength; ``weight`` is that of one of ``n`` of a quality. Bins of strengths are counted, and
    those of the bin that holds the quantile again, until few strengths are left.
    """
    of = F.col("n") * F.when(F.col("quality") == 1, F.lit(weight[1])).otherwise(F.lit(weight[0]))
    rows = strengths.select("strength", of.alias("w"))
    low, high, total, different = rows.agg(F.min("strength"), F.max("strength"), F.sum("w"), F.approx_count_distinct("strength")).first()
    wanted, below = (part - 1e-12) * total, 0.0
    inside = rows
    while different > LAST and low < high:
        width = (high - low) / BINS
        bins = F.least(F.floor((F.col("strength") - F.lit(low)) / F.lit(width)), F.lit(BINS - 1)).alias("bin")
        found = inside.groupBy(bins).agg(F.sum("w").alias("w"), F.min("strength").alias("low"), F.max("strength").alias("high"), F.approx_count_distinct("strength").alias("n"))
        found = sorted(found.collect())
        sums = below + np.cumsum([r.w for r in found])
        at = min(int(np.searchsorted(sums, wanted)), len(found) - 1)
        below = float(sums[at - 1]) if at else below
        low, high, different = found[at].low, found[at].high, found[at].n
        inside = inside.where(F.col("strength").between(low, high))
    left = sorted(inside.groupBy("strength").agg(F.sum("w").alias("w")).collect())
    at = min(int(np.searchsorted(below + np.cumsum([r.w for r in left]), wanted)), len(left) - 1)
    least = left[at].strength
    above = rows.where(F.col("strength") > least).agg(F.min("strength")).first()[0]
    return (least + (least if above is None else above)) / 2


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Weights, and the strength of the quantile."""
    texts = materialize(measured(docs, ["doc_id"]), "measured")
    found = learn_measured(texts, labels, sample)
    discard(texts)
    return found


def learn_measured(texts: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """The same from what ``measured`` gives; ``sample`` rows of each label make the start only."""
    known = labels.where("doc_id is not null and quality in (0, 1)").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id", "quality").agg(F.count(F.lit(1)).alias("n"))
    # Of rows that share a labelled doc_id, the one whose text has the least hash is learnt from.
    named = texts.join(known.select("doc_id").distinct(), "doc_id", "left_semi")
    one = named.groupBy("doc_id").agg(F.min_by("_f", "_order").alias("f"))
    rows = materialize(one.join(known, "doc_id").select("doc_id", F.col("quality").cast("int").alias("quality"), "n", "f"), "labelled")
    counts = {r[0]: r[1] for r in known.groupBy("quality").agg(F.sum("n")).collect()}
    sizes = {r[0]: (r[1], r[2]) for r in rows.groupBy("quality").agg(F.count(F.lit(1)), F.sum("n")).collect()}
    start = [rows.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select("f").collect() for q in (1, 0)]
    weights = fit(*(np.array([r.f for r in some]) for some in start))
    least = 0.0
    if len(sizes) == 2:
        blocks = materialize(_blocks(rows, {q: size[0] for q, size in sizes.items()}), "blocks")
        weights = fit_all(blocks, weights)
        strengths = materialize(rows.select("quality", "n", _strength(weights)("f").alias("strength")), "strengths")
        weight = {q: counts[q] / sizes[q][1] for q in (1, 0)}
        least = quantile(strengths, weight, counts[0] / (counts[0] + counts[1]))
        discard(blocks, strengths)
    discard(rows)
    return weights, least


def _strength(weights: np.ndarray) -> Callable[[Column | str], Column]:
    @F.arrow_udf("double")
    def strength(rows: pa.Array) -> pa.Array:
        return pa.array((rows.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(weights)) * weights).sum(axis=1))

    return strength


def score_measured(texts: DataFrame, keep: list[str], weights: np.ndarray, least: float, threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` and ``score``: the strength over the quantile on the logistic curve, which passes ``threshold`` there."""
    shift = float(np.log(threshold / (1 - threshold)))
    over = _strength(weights)("_f") - F.lit(float(least)) + F.lit(shift)
    return texts.select(*keep, (1 / (1 + F.exp(-F.greatest(F.least(over, F.lit(500.0)), F.lit(-500.0))))).alias("score"))


def score(docs: DataFrame, keep: list[str], weights: np.ndarray, least: float, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The same of texts."""
    made = docs.select(*keep, F.col(text).alias("text")) if text != "text" else docs
    return score_measured(measured(made, keep), keep, weights, least, threshold)


def op1_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = materialize(measured(table(spark, sf_dir, "documents"), ["doc_id"]), "measured")
    weights, least = learn_measured(texts, table(spark, sf_dir, "labels"))
    scored = score_measured(texts, ["doc_id"], weights, least)
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))
