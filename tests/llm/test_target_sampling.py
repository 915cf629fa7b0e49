import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from sparkwarden.llm import target_sampling as R
from sparkwarden.llm.oracle import SQL
from tests.llm.fixtures import rows_of, rows_of_sql, written

TEXTS = [
    None, "", " \n.,;", "one", "Ab ab AB", "é ß É ß", "x" * 100 + " " + "y" * 200 + "z", "a-b_c d|e", "\x00\x7fa\x80b 12 3",
    "w " * 50, " ".join(f"w{i}" for i in range(40)), "日本 語 " * 15, " ".join(f"w{i}" for i in range(40)),
]


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def buckets(text):
    w = words(text)
    return [zlib.crc32(f.encode()) % R.BUCKETS for f in [*w, *(f"{a} {b}" for a, b in zip(w, w[1:], strict=False))]]


def brute(docs, items, percent=25, least=20):
    s, t = (Counter(b for x in texts for b in buckets(x)) for texts in ([x for _, x in docs], items))
    s_all, t_all = (float(sum(c.values()) + R.BUCKETS) for c in (s, t))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all)))
    rows = []
    for doc, text in docs:
        found = buckets(text)
        weight = sum(map(gain, found)) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc, len(found), weight, score, len(words(text)) >= least))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    taken = able[: percent * len(able) // 100]
    out = Counter((*r[:4], i + 1) for i, r in enumerate(taken))
    rest = Counter(r[:4] for r in rows)
    rest.subtract(r[:4] for r in taken)
    return out + Counter({(*r, None): n for r, n in rest.items()})


def result(spark, docs, items, keep=("doc_id",)):
    frames = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame([(x,) for x in items], "text string")
    taken, rest = R.select(*frames, list(keep))
    columns = ["kept.doc_id", "n_features", "weight", "score"]
    rows = taken.select(*columns, "rank").union(rest.select(*columns, R.F.lit(None).cast("long")))
    return Counter(tuple(r) for r in rows.collect())


def test_buckets_equal_crc32_of_all_features(monkeypatch):
    column = pa.array(["skipped words", *TEXTS, None], pa.string()).slice(1)
    for block in (3, 1 << 20):
        monkeypatch.setattr(R, "BLOCK", block)
        found, number = Counter(), Counter()
        for owner, made, singles in R.features(column):
            found.update(zip(owner.tolist(), made.tolist(), strict=True))
            number.update(owner[:singles].tolist())
        assert found == Counter((i, b) for i, t in enumerate(TEXTS) for b in buckets(t))
        assert number == Counter(i for i, t in enumerate(TEXTS) for _ in words(t))
    assert not list(R.features(pa.array([], pa.string()))) and not list(R.features(pa.array([None, ""], pa.string())))


def test_query_equals_brute_force_and_sql(spark, tmp_path):
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choice(["alpha", "beta", "Über", "x1", "the"]) + str(rng.randrange(9)) for _ in range(rng.randrange(60)))) for i in range(150)]
    docs += [(1000 + i, t) for i, t in enumerate(TEXTS)]
    items = ["alpha1 beta2 the3 " * 4, None, "über4 x15"]
    folder = written(spark, tmp_path, documents=(docs, "doc_id long, text string"), benchmark=([(i, t) for i, t in enumerate(items)], "item_id long, text string"))
    got = rows_of(R.op11_target_sampling(spark, folder))
    assert got == rows_of_sql(folder, SQL["op11_target_sampling"], "documents", "benchmark")
    assert Counter((r[0], r[1], r[4], r[3], r[2]) for r in got.elements()) == brute(docs, items)


def test_ties_repeats_and_nulls(spark):
    same = " ".join(f"w{i}" for i in range(30))
    docs = [(5, same)] * 40 + [(None, same)] * 30 + [(i, same) for i in range(20)] + [(7, "other " * 25), (8, None), (None, None)]
    assert result(spark, docs, ["w1 w2"]) == brute(docs, ["w1 w2"])
    assert result(spark, docs, []) == brute(docs, [])
    assert result(spark, [], ["w1"]) == Counter()


def test_kth_smallest(spark):
    rng = random.Random(1)
    values = [rng.randrange(-50, 50) for _ in range(300)] + [-(1 << 62), 1 << 62]
    rows = spark.createDataFrame([(v,) for v in values], "v long")
    for k in (1, 2, 150, 301, 302):
        want = sorted(values)[k - 1]
        assert R.smallest(rows, "v", k) == (want, sum(v < want for v in values))


def test_resample_keeps_rows_and_clashing_columns(spark):
    docs = spark.createDataFrame([(i, f"word{i} " * 25, i, "s", -i) for i in range(20)], "doc_id long, text string, score int, rank string, row int")
    taken = R.resample(docs, docs.limit(2))
    assert taken.columns == docs.columns
    rows = {tuple(r) for r in taken.collect()}
    assert len(rows) == 5 and rows <= {tuple(r) for r in docs.collect()}


@pytest.mark.parametrize("size", [1, 47, 48, 49, 5000])
def test_long_words(size):
    text = "a" * size + " " + "b" * size
    found = sorted(b for _, made, _ in R.features(pa.array([text])) for b in made.tolist())
    assert found == sorted(buckets(text))
