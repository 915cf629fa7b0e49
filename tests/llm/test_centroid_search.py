import hashlib
import math
import random
from collections import Counter

import numpy as np

from sparkwarden.llm import centroid_search as C
from sparkwarden.llm.oracle import SQL
from tests.llm.fixtures import rows_of, rows_of_sql, written

SCHEMA = "vec_id long, embedding array<float>, cluster string"


def brute(rows, clusters=16, rounds=3):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest())
    centroids = [v for _, v in first[:clusters]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    near = lambda v: min((far(v, c), k) for k, c in enumerate(centroids))
    for _ in range(rounds):
        of = [near(v)[1] for _, v in kept]
        for k in set(of):
            own = [v for (_, v), c in zip(kept, of, strict=True) if c == k]
            centroids[k] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = [(i, *near(v)) for i, v in kept]
    inertia = Counter()
    for _, d, k in found:
        inertia[k] += d
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return Counter((names[k], k, inertia[k], d, sum(inertia.values()), i) for i, d, k in found)


def odd_rows(seed=2):
    rng = random.Random(seed)
    f = lambda x: float(np.float32(x))
    rows = [(i, [f(rng.gauss(i % 5, 1)) for _ in range(64)]) for i in range(120)]
    rows += [(200 + i, list(rows[3][1])) for i in range(60)] + [(300, [0.0] * 64), (300, [0.0] * 64), (301, [-0.0] * 64)]
    rows += [(400, None), (401, []), (402, [1.0] * 63), (403, [1.0] * 65), (404, [None] + [1.0] * 63), (405, [float("nan")] * 64), (406, [float("inf")] * 64)]
    return rows


def test_transform_keeps_distances_and_comes_back():
    rng = np.random.default_rng(1)
    x = rng.integers(-(1 << 24), 1 << 24, (50, 64))
    w = C.transform(x)
    assert np.array_equal(C.restore(w), x)
    d = ((w[:25] - w[25:]).astype(object) ** 2).sum(axis=1)
    assert np.array_equal(d, 64 * ((x[:25] - x[25:]).astype(object) ** 2).sum(axis=1))
    changes = (C.natural(np.eye(64, dtype=int))[:, C._ORDER].T)
    assert (np.diff((changes[:, 1:] != changes[:, :-1]).sum(axis=1)) == 1).all()


def test_nearest_equals_all_distances():
    rng = np.random.default_rng(3)
    for spread in (1, 3, 400):
        x, c = (rng.integers(-spread, spread + 1, (n, 64)) for n in (3000, 16))
        c[7] = c[2]  # ties go to the smaller number
        of, far = C.nearest(C.transform(x), C.transform(c))
        want = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
        assert np.array_equal(of, want.argmin(axis=1)) and np.array_equal(far, 64 * want.min(axis=1))


def test_query_equals_brute_force_and_sql(spark, tmp_path):
    rows = odd_rows()
    folder = written(spark, tmp_path, embeddings=([(*r, "x") for r in rows], SCHEMA))
    got = rows_of(C.op12_centroid_search(spark, folder))
    assert got == brute(rows)
    assert got == rows_of_sql(folder, SQL["op12_centroid_search"], "embeddings")


def test_few_none_and_large_vectors(spark, tmp_path):
    folder = written(spark, tmp_path, embeddings=([(400, None, "x")], SCHEMA))
    assert C.op12_centroid_search(spark, folder).count() == 0
    few = [(None, [0.5] * 64), (1, [3.0] * 64), (2, [0.5] * 64)]
    frame = spark.createDataFrame([(*r, "x") for r in few], SCHEMA)
    found, centroids = C.cluster(frame)
    assert len(centroids) == 3 and sorted(r.distance for r in found.collect()) == [0, 0, 0]
    large = spark.createDataFrame([(1, [3e38] * 64, "x"), (2, [-3e38] * 64, "x"), (3, [0.0] * 64, "x")], SCHEMA)
    found, centroids = C.cluster(large, clusters=1)
    assert max(r.distance for r in found.collect()) <= 64 * (2 * C.LIMIT) ** 2 and found.count() == 3
    assert C.cluster(frame.limit(0))[0].count() == 0
