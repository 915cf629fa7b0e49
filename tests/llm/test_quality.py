import re
import zlib

import numpy as np
import pytest

from sparkwarden.llm import pairwise_quality as B
from sparkwarden.llm import quality_rules as Q

DATA = "/root/testdata/sf0.01"
TEXTS = [
    "", None, " \n\t ", "one", "a b a b a b", "x y z x y z w x y z", "a a a a", "# $ % | <> & *", "l\nl\n\nl\n \n", "é ß é ß é ß",
    "w " * 60, " ".join(f"w{i}" for i in range(60)), "a b c " * 10 + " ".join(f"v{i}" for i in range(40)), "\x0bv\x0cw\rx",
]


def base(text):
    """The contract's counts, with regular expressions and sets of places."""
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), dup, len(inside)


def test_counts_equal_brute_force():
    for text in TEXTS:
        assert Q.measure(text)[:5] == base(text), text


def test_rows(spark):
    rows = [(i, t, "+") for i, t in enumerate(TEXTS)] + [(3, "one", "0"), (None, "two", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __votes string").repartition(3)
    found = Q.judge(docs, ["doc_id"]).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is not None:
            n, chars, symbols, dup, repeats = base(TEXTS[r.doc_id])
            assert tuple(r)[1:6] == (n, chars, symbols, dup, repeats)
            assert r.base_failed == (n < 50 or 100 * repeats > 50 * n)
            assert not (r.base_failed and r.kept)
    kept = Q.keep_good(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} <= {11, 12}
    assert Q.judge(docs.limit(0), ["doc_id"]).count() == 0 and Q.keep_good(docs.limit(0)).count() == 0


def test_model_finds_rare_bad_votes():
    patterns = {"+++": 900, "+-+": 40, "-++": 5, "+--": 30, "000": 20, "-+0": 2}
    good = Q.fit(patterns)
    assert good["+++"] > 0.99 and good["000"] > 0.5 and good["+--"] < 0.01 and good["+-+"] < good["+++"]
    assert Q.fit({}) == {} and 0 <= Q.fit({"---": 1})["---"] <= 1


def test_verdicts_agree_with_labels(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    judged = Q.judge(docs, ["doc_id"]).join(labels, "doc_id").where("not base_failed")
    rows = judged.select("quality", "kept").collect()
    assert np.mean([r.quality == r.kept for r in rows]) > 0.97
    assert np.mean([r.kept for r in rows if r.quality]) > 0.99


def test_held_out_accuracy(spark):
    scored = B.op1_pairwise_quality(spark, DATA)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = scored.join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    unseen = [r for r in rows if r.held_out]
    good, bad = ([r.score for r in unseen if r.quality == q] for q in (1, 0))
    assert np.mean(np.array(good)[:, None] > np.array(bad)[None, :]) > 0.98
    assert np.mean([r.predicted == r.quality for r in unseen]) > 0.95


def test_labels_of_held_out_rows_are_not_read(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    out = B.held_out(labels["doc_id"])
    turned = labels.withColumn("quality", B.F.when(out, 1 - B.F.col("quality")).otherwise(B.F.col("quality")))
    (w1, q1), (w2, q2) = B.learn(docs, labels), B.learn(docs, turned)
    assert np.array_equal(w1, w2) and q1 == q2


def test_odd_rows_and_missing_labels(spark):
    rows = [(i, t, 0.5) for i, t in enumerate(TEXTS)] + [(None, "x", None), (1, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    weights, least = B.learn(docs, labels)
    scores = [r.score for r in B.score(docs, ["doc_id"], weights, least).collect()]
    assert len(scores) == len(rows) and scores == pytest.approx([0.7] * len(rows))
    assert B.score(docs.limit(0), ["doc_id"], weights, least).count() == 0


def test_rows_that_share_a_labelled_id_stay_within_the_sample(spark, monkeypatch):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 != B.HELD_OUT][:8]
    rows = [(i, f"Text number {i} is here.") for i in ids] + [(ids[0], f"some !! other {k} words") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, n % 2) for n, i in enumerate(ids)], "doc_id long, quality int")
    sizes, fit = [], B.fit
    monkeypatch.setattr(B, "fit", lambda better, worse: sizes.append((len(better), len(worse))) or fit(better, worse))
    B.learn(docs, labels, sample=4)
    assert sizes == [(4, 4)]


def test_every_labelled_row_is_learnt_from(spark, monkeypatch):
    """Weights and threshold as all pairs of all rows give them, whatever the start is fitted to; rows in several blocks."""
    draw = np.random.default_rng(2)
    ids = [i for i in range(900) if zlib.crc32(str(i).encode()) % 4 != B.HELD_OUT]
    rows = []
    for i in ids:
        good = draw.random() < 0.7
        words = [draw.choice(["one", "two", "three", "WORD", "#", "!!"], p=[0.3, 0.3, 0.2, 0.1, 0.05, 0.05] if good else [0.2, 0.2, 0.2, 0.2, 0.1, 0.1]) for _ in range(30)]
        rows.append((i, " ".join(words), int(good)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(rows[0][0], rows[0][2])], "doc_id long, quality int")
    for name in ("MANY", "FEW"):  # one block of everything, then many
        (w1, q1), (w2, q2) = B.learn(docs, labels, sample=3), B.learn(docs, labels, sample=500)
        assert w1 == pytest.approx(w2, abs=1e-6) and q1 == pytest.approx(q2, abs=1e-6)
        if name == "MANY":
            x, y = (np.array([B.features(t) for _, t, q in [*rows, rows[0]] if q == label]) for label in (1, 0))
            d = (x[:, None, :] - y[None, :, :]).reshape(-1, x.shape[1])
            lost = 1 / (1 + np.exp(d @ w1))
            assert d.T @ lost / len(d) - B.RIDGE * w1 == pytest.approx(np.zeros(len(w1)), abs=1e-7)
            strengths = np.sort(np.concatenate([x @ w1, y @ w1]))
            assert np.mean(strengths <= q1) == pytest.approx(len(y) / (len(x) + len(y)), abs=2 / len(strengths))
        monkeypatch.setattr(B, "MANY", 40)
        monkeypatch.setattr(B, "FEW", 30)
    monkeypatch.setattr(B, "LAST", 5)
    monkeypatch.setattr(B, "BINS", 7)
    assert B.learn(docs, labels, sample=500) == (pytest.approx(w2), pytest.approx(q2))
