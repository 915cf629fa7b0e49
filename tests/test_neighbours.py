import numpy as np
import pytest

from sparkwarden.operators import graph, ivf, lof, similarity

VECTORS = "point_id bigint, vector array<float>"


def clustered(n=600, dim=18, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    return (centres[rng.integers(0, 12, n)] + 0.4 * rng.normal(size=(n, dim))).astype(np.float32)


def frame(spark, vectors, first=0):
    return spark.createDataFrame([(first + i, v.tolist()) for i, v in enumerate(vectors)], VECTORS).repartition(3)


def hits(df):
    return {(r.query_id, r.point_id): r.score for r in df.collect()}


def brute(asked, stored, k, own=False):
    unit = lambda x: x / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    scores = np.round(unit(asked) @ unit(stored).T, 9)
    if own:
        np.fill_diagonal(scores, -np.inf)
    return {(i, int(j)): s[j] for i, s in enumerate(scores) for j in np.lexsort((np.arange(len(s)), -s))[:k] if s[j] > -2}


def test_codes_come_back_close():
    x = ivf.unit_rows(clustered())
    model = ivf.Model(ivf.means(x, 12), np.zeros((5, 1, 4)), 1, 10)
    of = model.lists(x)[:, 0]
    left = model.padded(x - model.centroids[of])
    model = ivf.Model(model.centroids, np.stack([ivf.means(left[:, m * 4 : m * 4 + 4], 64) for m in range(5)]), 1, 10)
    back = model.decode(model.encode(x, of), of)
    assert back.shape == x.shape and np.abs(back - x).mean() < 0.6 * np.abs(x - model.centroids[of]).mean()
    assert (((x - model.centroids[of]) ** 2).sum(1) <= ((x[:, None] - model.centroids[None]) ** 2).sum(2).min(1) + 1e-9).all()


@pytest.mark.parametrize("chunk", [37, 50_000])
def test_index_search_reaches_recall_with_exact_scores(spark, tmp_path, chunk):
    vectors = clustered()
    index = ivf.build(frame(spark, vectors), str(tmp_path / "i"), lists=20)
    asked = frame(spark, vectors[::20]).withColumnRenamed("point_id", "query_id")
    found = ivf.search(asked, index, 10, chunk=chunk)
    got, want = hits(found), brute(vectors[::20], vectors, 10)
    assert len(got) == 300 and len(set(got) & set(want)) / len(want) >= 0.9
    assert all(abs(s - want[key]) < 1e-8 for key, s in got.items() if key in want)
    ranks = {}
    for r in found.collect():
        ranks.setdefault(r.query_id, []).append((r.rank, -r.score, r.point_id))
    assert all([x[0] for x in sorted(v)] == list(range(1, 11)) and sorted(v) == sorted(v, key=lambda x: x[1:]) for v in ranks.values())
    work = ivf.compared(asked, index).first()
    assert work.codes < work.pairs and work.vectors < work.pairs and index.codes.count() == len(vectors)
    everything = ivf.search(asked, index, 10, probes=20, candidates=600)
    assert hits(everything) == pytest.approx(want)
    assert ivf.recall(everything, everything).first().recall == 1.0


def test_index_of_copies_few_and_none(spark, tmp_path):
    same = np.repeat(clustered(3), 40, axis=0)
    index = ivf.build(frame(spark, same), str(tmp_path / "same"), k=5)
    asked = frame(spark, same[:2], 50).withColumnRenamed("point_id", "query_id")
    got = ivf.search(asked, index, 5, exclude_self=True).collect()
    assert len(got) == 10 and all(r.point_id != r.query_id for r in got)
    one = ivf.build(frame(spark, same[:1]), str(tmp_path / "one"))
    assert [r.score for r in ivf.search(asked, one, 5).collect()] == pytest.approx([1.0, 1.0])
    none = ivf.build(frame(spark, same).limit(0), str(tmp_path / "none"))
    assert ivf.search(asked.limit(0), none, 5).count() == 0
    assert ivf.search(asked.limit(0), index, 5).count() == 0


def test_index_of_zero_vectors_and_other_lengths(spark, tmp_path):
    vectors = np.concatenate([np.zeros((3, 5)), clustered(40, 5)]).astype(np.float32)
    index = ivf.build(frame(spark, vectors), str(tmp_path / "zero"))
    asked = frame(spark, vectors[:6]).withColumnRenamed("point_id", "query_id")
    assert ivf.search(asked, index, 4).count() == 24
    again = ivf.load(spark, str(tmp_path / "zero")).model
    assert np.array_equal(again.centroids, index.model.centroids) and again.words.shape == (2, index.model.words.shape[1], 4)


@pytest.mark.parametrize("kind", ["clustered", "even", "hub"])
def test_graph_reaches_recall_with_exact_scores(spark, kind):
    vectors = clustered(500)
    if kind == "even":
        vectors = np.random.default_rng(2).normal(size=(500, 18)).astype(np.float32)
    if kind == "hub":  # one direction that a third of all points is near
        vectors[:170] = vectors[0] + 0.01 * np.random.default_rng(3).normal(size=(170, 18))
    got = hits(graph.neighbour_graph(frame(spark, vectors), 8, leaf=60))
    want = brute(vectors, vectors, 8, own=True)
    assert len(got) == len(want) and len(set(got) & set(want)) / len(want) >= 0.9
    assert all(abs(s - want[key]) < 1e-8 for key, s in got.items() if key in want)


def test_graph_of_few_points(spark):
    vectors = clustered(4)
    assert hits(graph.neighbour_graph(frame(spark, vectors), 8)) == pytest.approx(brute(vectors, vectors, 8, own=True))
    assert graph.neighbour_graph(frame(spark, vectors).limit(0), 3).count() == 0


def test_outlier_factors_by_graph(spark):
    vectors = np.concatenate([clustered(300), 30 * clustered(1, seed=9)[:, ::-1]])
    rows = frame(spark, vectors)
    exact, near = ({r.point_id: r.lof for r in lof.outlier_factors(rows, "point_id", k=10, graph=g).collect()} for g in (False, True))
    assert exact.keys() == near.keys()
    assert np.median([abs(near[i] - exact[i]) for i in exact]) < 0.02
    assert sorted(exact, key=exact.get)[-1] == sorted(near, key=near.get)[-1]


def test_ties_go_to_the_lower_id(spark, tmp_path):
    vectors = np.repeat(clustered(2), 6, axis=0)
    found = similarity.topk(frame(spark, vectors[:1]).withColumnRenamed("point_id", "query_id"), frame(spark, vectors), 3)
    index = ivf.build(frame(spark, vectors), str(tmp_path / "ties"))
    asked = frame(spark, vectors[:1]).withColumnRenamed("point_id", "query_id")
    assert hits(ivf.search(asked, index, 3, candidates=12)) == pytest.approx(hits(found)) and set(hits(found)) == {(0, 0), (0, 1), (0, 2)}
