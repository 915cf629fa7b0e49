import math
import random
import re

import pyarrow as pa
import pytest

from sparkwarden.llm import near_dedup as N


def brute(rows, percent=85):
    """n_shingles and component of each (doc_id, text)."""
    sets = []
    for _, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall("[^\x20\x09-\x0d]+", low)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()})
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    ids = {}
    for i, (doc, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(doc)
    least = {r: min((x for x in d if x is not None), default=None) for r, d in ids.items()}
    return sorted((str(d), len(sets[i]), str(least[find(i)]), d == least[find(i)]) for i, (d, _) in enumerate(rows))


def corpus(seed, n=250):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeiouñßthrn") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    prose = lambda k: " ".join(rng.choice(words) for _ in range(k))
    passage, base = prose(60), prose(150)
    texts = []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.4:
            old = base.split(" ")
        elif kind < 0.6 and texts:
            old = rng.choice(texts).split(" ")
        else:
            texts.append(passage + " " + prose(rng.choice([0, 3, 10, 50, 500])) if kind < 0.8 else prose(rng.choice([0, 1, 4, 5, 40, 600])))
            continue
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
            old[rng.randrange(len(old))] = rng.choice(words)
        texts.append(rng.choice([" ", " ", "\n"]).join(old) if rng.random() < 0.7 else " ".join(old).upper().replace("SS", "ß"))
    return texts + ["", None, " \n ", "", "One", "one", "ONE two"]


def found(spark, rows, **how):
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, key string")
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in N.judge(docs.repartition(3), **how).collect())


@pytest.mark.parametrize("chunk", [N.CHUNK, 20])
def test_equals_brute_force(spark, chunk):
    rows = list(enumerate(corpus(chunk)))
    assert found(spark, rows, chunk=chunk) == brute(rows)


def test_repeated_rows_and_null_ids(spark):
    text = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    rows = [(5, text), (5, text), (None, text + " !"), (9, text + " ?"), (7, "else"), (None, "other"), (7, None), (7, None)]
    got = found(spark, rows)
    assert [g for g in got if g[0] in "59"] == [("5", 22, "5", True), ("5", 22, "5", True), ("9", 23, "5", False)]
    assert ("None", 23, "5", False) in got and ("None", 1, "None", True) in got and got.count(("7", 0, "7", True)) == 2
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, root string, component string")
    kept = N.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["5", "5", "7", "7", "7", "None"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert N.judge(docs).count() == 0 and N.keep_first(docs).count() == 0


@pytest.mark.parametrize("percent, shared", [(80, 31), (85, 36)])
def test_least_of_shared_values_follows_percent(percent, shared):
    part = percent / 100
    less = lambda s: sum(math.comb(N.LISTED, i) * part**i * (1 - part) ** (N.LISTED - i) for i in range(s))
    assert N._shared(percent) == shared and less(shared) <= N.LOSS < less(shared + 1)


def test_sketch_far_below_the_threshold_rules_no_link_out(spark):
    """Similarity 0.93, but 70 values of one set alone are the least of all: 186 of 256 in the union sketch are shared."""
    both = list(range(1000, 2000))
    sets = [(bytes([1]), 1070, list(range(70)) + both), (bytes([2]), 1000, both)]
    frame = spark.createDataFrame(sets, "key binary, n int, least array<bigint>")
    pairs = spark.createDataFrame([(bytes([1]), bytes([2]))], "a binary, b binary")
    assert N._verified(pairs, frame, 85).count() == 1
    rows = [(7, 0, 0, 0, n, k, k, least[: N.SKETCH], [7]) for k, n, least in sets]
    lists = pa.list_(pa.int64())
    types = [pa.int64(), *[pa.int32()] * 4, pa.binary(), pa.binary(), lists, lists]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    batch = pa.RecordBatch.from_arrays(columns, ["value", "i", "j", "side", "n", "key", "component", "least", "listed"])
    assert sum(b.num_rows for b in N._compare(85)(iter([batch]))) == 1
    less = lambda s, p: sum(math.comb(N.SKETCH, i) * p**i * (1 - p) ** (N.SKETCH - i) for i in range(s))
    assert all(less(math.ceil(N._floor(p) * N.SKETCH), p / 100) < 1e-9 for p in (80, 85))


def test_pairs_of_a_large_list_leave_in_small_batches():
    """200 variants of more than 256 shingles, each its own component: 19,900 candidate pairs, never held at once."""
    keys = [bytes([i]) for i in range(200)]
    rows = [(7, 0, 0, 0, 400, k, k, list(range(N.SKETCH)), [7]) for k in keys]
    lists = pa.list_(pa.int64())
    types = [pa.int64(), *[pa.int32()] * 4, pa.binary(), pa.binary(), lists, lists]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    batch = pa.RecordBatch.from_arrays(columns, ["value", "i", "j", "side", "n", "key", "component", "least", "listed"])
    found = list(N._compare(85)(iter([batch.slice(0, 90), batch.slice(90)])))
    assert max(b.num_rows for b in found) <= 16_384
    pairs = [(a, b) for part in found for a, b in zip(*(c.to_pylist() for c in part.columns), strict=True)]
    assert sorted(pairs) == [(a, b) for a in keys for b in keys if a < b]
