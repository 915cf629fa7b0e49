import hashlib
import random
import re

import pytest

from sparkwarden.llm import decontaminate as D
from sparkwarden.llm.oracle import SQL
from tests.llm.fixtures import rows_of, rows_of_sql, written

WORD = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"


def words(text):
    return re.findall(WORD, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, size=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - size, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add("null" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((str(doc), len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out)


def tables(seed):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "a", "Én", "ßa", "x1"] + [f"w{i}" for i in range(40)]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(prose(rng.choice([10, 11, 25])))) for i in range(12)]
    items += [(20, "Two words!"), (21, "the OF"), (22, ""), (23, None), (24, items[0][1]), (None, items[1][1]), (0, items[0][1])]
    docs = []
    for i in range(80):
        w = prose(rng.choice([0, 3, 9, 10, 40, 200]))
        for _ in range(rng.randint(0, 3)):
            part = (rng.choice(items)[1] or "").split(" ")
            cut = rng.randint(0, max(len(part) - 10, 0))
            at = rng.randint(0, len(w))
            w[at:at] = part[cut : cut + rng.choice([8, 10, 13])]
        docs.append((i, rng.choice([" ", "--", ", "]).join(w)))
    long = prose(30) + items[2][1].split(" ")
    docs += [(90, None), (91, "!?"), (92, " ".join(prose(1020) + items[3][1].split(" ") + prose(2000) + long)), (3, docs[3][1]), (3, "the of")]
    return docs + [(None, items[4][1])], items


@pytest.mark.parametrize("starts, broadcast", [(20_000, 64 << 20), (0, 64 << 20), (0, 0), (20_000, 0)])
def test_equals_brute_force(spark, monkeypatch, starts, broadcast):
    monkeypatch.setattr(D, "STARTS", starts)
    monkeypatch.setattr(D, "BROADCAST_BYTES", broadcast)
    docs, items = tables(starts + 1)
    left = spark.createDataFrame([(*d, "g") for d in docs], "doc_id long, text string, gram string").repartition(3)
    right = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, size int")
    want = brute(docs, items)
    got = D.judge(left, right).collect()
    assert sorted((str(r[0]), *tuple(r)[1:]) for r in got) == want
    kept = D.clean(left, right)
    assert kept.columns == left.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(w[0] for w in want if not w[-1])


def test_sql(spark, tmp_path):
    docs, items = tables(3)
    docs = list({d[0]: d for d in docs if d[0] is not None}.values())
    folder = written(spark, tmp_path, documents=(docs, "doc_id long, text string"), benchmark=(items, "item_id long, text string"))
    got = rows_of(D.op2_decontaminate(spark, folder))
    assert got == rows_of_sql(folder, SQL["op2_decontaminate"], "documents", "benchmark")


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[:4] for r in D.judge(docs, items).collect()] == [(1, 3, 0, 0)] and D.clean(docs, items).count() == 1
    assert D.judge(docs.limit(0), items).count() == 0
