import hashlib
import random
from collections import Counter

import pytest

from sparkwarden.llm import suffix_dedup as S


def brute(texts, length=S.LENGTH):
    """n_bytes, n_removed, n_spans and digest of each text, from a count of all strings."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeiouñßthrn") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    prose = lambda k: " ".join(rng.choice(words) for _ in range(k))
    passages = [prose(rng.randint(30, 90)) for _ in range(4)]
    texts = []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.3:
            texts.append(prose(rng.randint(0, 60)) + rng.choice(passages) + prose(rng.randint(0, 60)))
        elif kind < 0.6 and texts:
            old = rng.choice(texts).split(" ")
            for _ in range(rng.randint(0, 3)):
                old[rng.randrange(len(old))] = rng.choice(words)
            texts.append(" ".join(old))
        else:
            texts.append(prose(rng.randint(0, 120)))
    texts += ["", None, "x" * 1000, "xy" * 300, "x" * 199, "a" * 200, "b" * 201, passages[0], passages[0][:250]]
    return texts


def found(spark, texts, **how):
    docs = spark.createDataFrame([(i, t, "n") for i, t in enumerate(texts)], "doc_id long, text string, hash string")
    rows = S.judge(docs.repartition(3), **how).collect()
    return [tuple(r)[1:] for r in sorted(rows, key=lambda r: r.doc_id)]


@pytest.mark.parametrize("hot", [S.HOT, 5, 1])
def test_equals_brute_force(spark, monkeypatch, hot):
    texts = corpus(hot)
    assert found(spark, texts, hot=hot) == brute(texts)


def test_repeated_rows_null_ids_and_other_columns(spark):
    text = corpus(3)[5] + "tail" * 60
    rows = [(1, text, "a"), (1, text, "a"), (None, "q" + text, "b"), (1, "other", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    want = brute([r[1] for r in rows])
    got = [tuple(r)[1:] for r in S.judge(docs).collect()]
    assert sorted(got) == sorted(want)
    kept = {(r.doc_id, r.spans): r.text for r in S.clean(docs).collect()}
    assert S.clean(docs).columns == docs.columns
    assert kept[(1, None)] == "other" and len(kept[(None, "b")]) <= 1


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.judge(docs).count() == 0


def test_merge_orders_front_coded_runs():
    rng = random.Random(1)
    pool = [bytes(rng.choice(b"ab") for _ in range(rng.randint(8, 20))) for _ in range(400)]
    runs, every = [], []
    for _ in range(7):
        part = sorted(set(rng.sample(pool, 50)))
        every += part
        shared = [S.common(x, y, 0) for x, y in zip([b"", *part], part)]
        runs.append((shared, [t[n:] for n, t in zip(shared, part)], [b""] * len(part), [[]] * len(part)))
    merged = list(S.merge(runs))
    assert [m[1] for m in merged] == sorted(every)
    assert all(m[0] == S.common(a[1], m[1], 0) for a, m in zip(merged, merged[1:]))


def test_pairs_and_hashes_agree(monkeypatch):
    groups = {}
    for i, text in enumerate(corpus(9, 400)):
        data = (text or "").encode()
        for h, lo, a, hi in zip(*S.anchors(S.np.frombuffer(data, dtype=S.np.uint8))):
            groups.setdefault(h, {}).setdefault((data[a : hi + S.LENGTH], data[lo:a]), []).append(((i, 0), int(a)))
    assert max(map(len, groups.values())) > 20
    for group in groups.values():
        group = dict(sorted(group.items()))
        keys = [k[0] for k in group]
        shares = [S.common(x, y, 0) for x, y in zip([b"", *keys], keys)]
        starts = []
        for pairs, size in ((10_000, 1 << 17), (0, 1 << 17), (0, 300)):
            monkeypatch.setattr(S, "PAIRS", pairs)
            monkeypatch.setattr(S, "BYTES", size)
            out = []
            S.resolve(group, shares, out)
            starts.append({(i, s) for i, _, lo, hi in out for s in range(lo, hi + 1)})
        assert starts[0] == starts[1] == starts[2]


def test_ranges_are_even():
    found = [S.anchors(S.np.frombuffer((t or "").encode(), dtype=S.np.uint8))[0] for t in corpus(4, 300)]
    part = S.np.unique(S.np.concatenate(found)) >> S.np.uint64(61)
    count = S.np.bincount(part.astype(int), minlength=8)
    assert count.min() > 0.7 * count.mean() and count.max() < 1.3 * count.mean()


def test_many_equal_rows_are_looked_at_once(spark, monkeypatch):
    text = " ".join(f"w{i * 7919 % 1000}" for i in range(350))
    rows = [(1, text)] * 3000 + [(None, text)] * 500 + [(2, "z" + text[:400]), (3, "only here " * 3 + "".join(map(str, range(90)))), (4, "short"), (4, "short"), (5, None), (5, None)]
    once = S._once(S._keyed(spark.createDataFrame(rows, "doc_id long, text string")))
    assert once[0].count() == 6 and {(r.id, r.lo, r.hi) for r in once[1].collect()} == {(1, 0, len(text) - 200), (None, 0, len(text) - 200)}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = Counter(tuple(r) for r in S.judge(docs).collect())
    want = dict(zip(dict.fromkeys(rows), brute([t for _, t in dict.fromkeys(rows)]), strict=True))
    for (doc, t), n in Counter(rows).items():
        size = len((t or "").encode())
        gone = t == text
        expected = (size, size, 1, hashlib.sha256(b"").hexdigest()) if gone else want[(doc, t)]
        assert got[(doc, *expected)] == n


def test_copies_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 300)
    texts = corpus(11, 20)
    texts.append(" ".join(t for t in texts if t))
    made = [S.anchors(S.np.frombuffer((t or "").encode(), dtype=S.np.uint8), around=True) for t in texts]
    assert all(len(m) == 5 and len(m[4]) == len(m[0]) for m in made)
    assert found(spark, texts, hot=3) == brute(texts)
