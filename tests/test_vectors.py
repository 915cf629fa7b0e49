import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkwarden.operators import iforest, knn, lof, points, projection, similarity
from sparkwarden.operators.embedding import HashingEmbedder, ModelEmbedder


def vectors(n, d=8, seed=0, clusters=6, copies=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, d))
    x = centres[rng.integers(0, clusters, n)] + 0.1 * rng.normal(size=(n, d))
    if copies:
        x[rng.choice(n, copies, replace=False)] = x[0]
    return x


def frame(spark, x, id_name="point_id"):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], f"{id_name} bigint, vector array<double>").repartition(3)


def unit(x):
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, n, out=np.zeros_like(x), where=n > 0)


def brute(q, p, k, exclude_self=False):
    sims = np.round(unit(q) @ unit(p).T, 9)
    out = set()
    for i, row in enumerate(sims):
        order = [j for j in np.lexsort((np.arange(len(row)), -row)) if not (exclude_self and j == i)][:k]
        out |= {(i, r + 1, int(j)) for r, j in enumerate(order)}
    return out


def hits(df):
    return {(r.query_id, r.rank, r.point_id) for r in df.collect()}


@pytest.mark.parametrize("copies", [0, 60])
def test_topk_ways_agree(spark, copies):
    p, q = vectors(180, copies=copies), vectors(40, seed=1)
    points_df, queries = frame(spark, p), frame(spark, q, "query_id")
    want = brute(q, p, 7)
    assert hits(similarity.topk(queries, points_df, 7)) == want
    assert hits(similarity.scan_points(queries, points_df, 7)) == want
    assert hits(similarity.topk(queries, points_df, 7, limit=0)) == want


@pytest.mark.parametrize("rows_per_cell,chunk", [(10, 1000), (30, 7), (10_000, 1000), (3, 40)])
def test_knn_join_is_exact(spark, rows_per_cell, chunk):
    x = vectors(150, d=4, copies=50)
    df = frame(spark, x)
    queries = df.withColumnRenamed("point_id", "query_id")
    found = knn.knn_join(queries, df, 6, exclude_self=True, rows_per_cell=rows_per_cell, chunk=chunk)
    assert hits(found) == brute(x, x, 6, exclude_self=True)


def test_knn_join_with_fewer_points_than_k(spark):
    x = vectors(5, d=3)
    found = knn.knn_join(frame(spark, x, "query_id"), frame(spark, x), 9, True, rows_per_cell=2)
    assert hits(found) == brute(x, x, 9, exclude_self=True) and found.count() == 20


def test_cells_are_skipped(spark):
    """Tight clusters: the bounds rule out most cells."""
    x = vectors(300, d=6, clusters=10) * 1.0
    df = knn._with_cell(frame(spark, x), unit(x[:10]))
    cells = knn._describe(df, unit(x[:10]), 3)
    worst = df.withColumn("worst", F.lit(0.999))
    left = worst.select(F.size(knn._cells_left(cells, spark)("vector", "cell", "worst")).alias("n"))
    assert left.agg(F.avg("n")).first()[0] < 5


@pytest.mark.parametrize("rows_per_cell", [3, 25])
def test_knn_join_by_packs(spark, monkeypatch, rows_per_cell):
    """Packs of several cells, cells of several chunks, queries in chunks; few copies of a query where nothing is skipped."""
    monkeypatch.setattr(knn, "PACK", 20)
    x = np.random.default_rng(3).normal(size=(150, 5))
    x[:60] = x[0]
    df = frame(spark, x)
    queries = df.withColumnRenamed("point_id", "query_id")
    visits, search = [], knn._search
    monkeypatch.setattr(knn, "_search", lambda q, v, *rest: visits.append(q.select(F.sum(F.size(v))).first()[0] or 0) or search(q, v, *rest))
    for chunk in (7, 30):
        found = knn.knn_join(queries, df, 6, rows_per_cell=rows_per_cell, chunk=chunk)
        assert hits(found) == brute(x, x, 6)
    assert max(visits) <= 150 * 9  # a query met each of up to 50 cells before


def test_knn_join_has_a_partition_for_each_group(spark, monkeypatch):
    """Tasks grow with the chunks that meet, not with the shuffle partitions of the session."""
    monkeypatch.setattr(knn, "PACK", 20)
    x = np.random.default_rng(4).normal(size=(150, 5))
    df = frame(spark, x)
    tasks, search = [], knn._search

    def counted(*args):
        out = search(*args)
        tasks.append(out.rdd.getNumPartitions())
        return out

    monkeypatch.setattr(knn, "_search", counted)
    found = knn.knn_join(df.withColumnRenamed("point_id", "query_id"), df, 6, rows_per_cell=25, chunk=20)
    assert hits(found) == brute(x, x, 6)
    assert max(tasks) >= 7 * 7  # 150 points and 150 queries in chunks of at most 20 or so, nothing skipped


def test_search_tasks_grow_in_number_with_the_work(spark, monkeypatch):
    queries = spark.range(300).select(F.col("id").alias("query_id"), F.array(F.lit(1.0), F.col("id") * 1.0).alias("vector"))
    there = spark.range(40).select(F.col("id").alias("point_id"), F.array(F.lit(1.0), F.col("id") * 2.0).alias("vector"))
    few = similarity.topk(queries, there, 3)
    monkeypatch.setattr(similarity, "TASK_SCORES", 1000)
    many = similarity.topk(queries, there, 3)
    assert few.rdd.getNumPartitions() < 12 <= many.rdd.getNumPartitions()
    assert sorted(few.collect()) == sorted(many.collect()) and many.count() == 900


def test_top_slots_scores_few_pairs_twice(monkeypatch):
    """The bound follows what is found, also inside the first thousands of points; points without a direction stay out."""
    rng = np.random.default_rng(6)
    q, p = unit(rng.normal(size=(300, 32))), unit(rng.normal(size=(9000, 32)))
    p[6000] = np.nan
    scored, scores_of = [], similarity._scores
    monkeypatch.setattr(similarity, "_scores", lambda *a: scored.append(len(a[2])) or scores_of(*a))
    slots, scores = (np.concatenate(part) for part in zip(*[b[1:] for b in similarity.top_slots(q, p, 20)]))
    want = np.nan_to_num(np.rint(q @ p.T * 1e9) / 1e9, nan=-9.0)
    order = np.argsort(-want, axis=1, kind="stable")[:, :20]
    assert np.array_equal(slots, order) and np.array_equal(scores, np.take_along_axis(want, order, axis=1))
    assert sum(scored) < 150 * len(q)


def test_top_slots_of_many_points(monkeypatch):
    """Blocks of points after the first one, ties within and across them, left out slots; no more scores held than asked."""
    rng = np.random.default_rng(5)
    p = unit(rng.normal(size=(900, 6)))
    p[200:500] = p[3]
    p[700:720] = p[5] * (1 - 1e-8)
    q = np.concatenate([p[:40], unit(rng.normal(size=(30, 6)))])
    skip = np.concatenate([np.arange(40), np.full(30, -1)])
    monkeypatch.setattr(similarity, "_ROWS", 16)
    monkeypatch.setattr(similarity, "_COLUMNS", 64)
    monkeypatch.setattr(similarity, "_FIRST", 32)
    for k in (1, 7, 400, 900):
        slots, scores = (np.concatenate(part) for part in zip(*[b[1:] for b in similarity.top_slots(q, p, k, skip)]))
        want = np.rint(q @ p.T * 1e9) / 1e9
        want[np.arange(40), np.arange(40)] = -np.inf
        order = np.lexsort((np.broadcast_to(np.arange(900), want.shape), -want), axis=1)[:, :k]
        best = np.take_along_axis(want, order, axis=1)
        assert np.array_equal(best, scores) and (slots == order)[np.isfinite(best)].all()


def test_top_slots_of_mostly_empty_rows(monkeypatch):
    """Hashed texts: multiplied over a block's own columns, whatever the order; few pairs are scored twice; a floor cuts."""
    rng = np.random.default_rng(8)

    def texts(n, words):
        x = np.zeros((n, 256))
        x[:, :6] = 1
        np.add.at(x, (np.repeat(np.arange(n), words), rng.integers(0, 256, n * words)), 1)
        return x

    q, p = texts(700, 4), texts(3000, 20)
    q[5], q[6], p[1000:1100] = 0, -q[6], p[3]
    p[::9, 10] *= -1
    q, p = unit(q), unit(p)
    skip = np.where(np.arange(700) % 3 == 0, np.arange(700), -1)
    widths, scored = [], []
    best_of, scores_of = similarity._best_of, similarity._scores
    monkeypatch.setattr(similarity, "_best_of", lambda q, rows, *rest: widths.append(q[rows].any(axis=0).sum()) or best_of(q, rows, *rest))
    monkeypatch.setattr(similarity, "_scores", lambda *a: scored.append(len(a[2])) or scores_of(*a))
    want = np.rint(q @ p.T * 1e9) / 1e9
    want[skip >= 0, skip[skip >= 0]] = -np.inf
    order = np.lexsort((np.broadcast_to(np.arange(3000), want.shape), -want), axis=1)[:, :20]
    best = np.take_along_axis(want, order, axis=1)
    for floor in (None, best[:, -1], np.full(700, -1.0)):
        ((start, slots, scores),) = similarity.top_slots(q, p, 20, skip, floor)
        assert start == 0 and np.array_equal(best, scores) and np.array_equal(slots, order)
    assert np.mean(widths) < 200 and sum(scored) < 3 * want.size / 8
    below = np.where(np.arange(700) % 2 == 0, best[:, 0], 2.0)
    ((_, slots, scores),) = similarity.top_slots(q, p, 20, None, below)
    assert (scores[1::2] == -np.inf).all() and (scores[::2, 0] >= below[::2]).all()


def test_later_packs_get_the_bound_of_the_first(spark, monkeypatch):
    """What the second round of a join gives is at least as good as the k-th hit of the first one."""
    x = vectors(400, d=24, seed=4, clusters=400)
    df = frame(spark, x)
    found, search = [], knn._search
    monkeypatch.setattr(knn, "PACK", 40)
    monkeypatch.setattr(knn, "_search", lambda *a: found.append(search(*a)) or found[-1])
    assert hits(knn.knn_join(df.withColumnRenamed("point_id", "query_id"), df, 6, rows_per_cell=40, chunk=40)) == brute(x, x, 6)
    first, second = found
    worst = first.groupBy("query_id").agg(F.sort_array(F.collect_list("score"), False)[5].alias("worst"))
    assert second.count() and not second.join(worst, "query_id").filter("score < worst - 0.00001").count()


def test_a_search_runs_once_and_on_all_cores(spark):
    """Filters on what was found stay above the search, and a short table of queries is dealt to more tasks than files."""
    df = frame(spark, vectors(60))
    queries = df.withColumnRenamed("point_id", "query_id").coalesce(1)
    corpus = similarity.collect_corpus(df)
    listed = similarity.nearest(queries, corpus, 4).select("query_id", F.explode("hits.point_id").alias("point_id"))
    found = similarity.topk(queries, df, 4)
    for out in (listed.filter("point_id > 3"), found.filter("rank <= 2")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1
    assert "Exchange hashpartitioning(query_id" in found._jdf.queryExecution().executedPlan().toString()
    assert hits(found) == brute(vectors(60), vectors(60), 4)


def lof_brute(x, k):
    n = len(x)
    k = min(k, n - 1)
    d = 1.0 - np.round(unit(x) @ unit(x).T, 9)
    np.fill_diagonal(d, np.inf)
    same = (x[:, None, :] == x[None, :, :]).all(axis=2)
    first = np.array([int(np.flatnonzero(row)[0]) for row in same])
    near = [np.lexsort((np.arange(n), first, d[i], ~same[i]))[: k + 1] for i in range(n)]
    near = [np.array([j for j in row if j != i][:k]) for i, row in enumerate(near)]
    kd = np.array([d[i, row].max() for i, row in enumerate(near)])
    lrd = np.array([1.0 / (np.maximum(d[i, row], kd[row]).mean() + 1e-10) for i, row in enumerate(near)])
    return np.array([lrd[row].mean() / lrd[i] for i, row in enumerate(near)])


@pytest.mark.parametrize("copies,limit", [(0, 1 << 20), (3, 1 << 20), (40, 0), (90, 1 << 20)])
def test_lof_equals_brute_force(spark, copies, limit):
    x = vectors(110, d=5, copies=copies)
    x[7] = -x[7]
    df = frame(spark, x, "row_id")
    got = {r.row_id: r.lof for r in lof.outlier_factors(df, "row_id", k=35, limit=limit).collect()}
    want = lof_brute(x, 35)
    assert len(got) == 110
    assert [got[i] for i in range(110)] == pytest.approx(list(want), rel=1e-6)
    scaled = [r.ml_score for r in lof.lof_scores(df, "row_id", limit=limit).collect()]
    assert min(scaled) == 0.0 and max(scaled) == pytest.approx(1.0)


def test_lof_tiny(spark):
    assert lof.lof_scores(frame(spark, vectors(1), "row_id"), "row_id").count() == 1
    assert lof.lof_scores(frame(spark, vectors(2), "row_id"), "row_id").count() == 2
    assert lof.lof_scores(frame(spark, vectors(3)[:0], "row_id").limit(0), "row_id").count() == 0


def test_forest_ranks_outliers_first_and_repeats(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 5))
    x[:4] += 9
    df = frame(spark, x, "row_id")
    first = {r.row_id: r.ml_score for r in iforest.isolation_forest_scores(df, "row_id").collect()}
    again = {r.row_id: r.ml_score for r in iforest.isolation_forest_scores(df.repartition(7), "row_id").collect()}
    assert first == again
    assert sorted(first, key=first.get)[-4:] and set(sorted(first, key=first.get)[-4:]) == {0, 1, 2, 3}
    assert min(first.values()) == 0.0 and max(first.values()) == pytest.approx(1.0)


def test_forest_samples(spark):
    rows = spark.range(50_000).select(F.col("id").alias("row_id"), F.array(F.rand(1)).alias("vector"))
    sample = iforest._tree_samples(rows, 50_000, 20, 256, 42)
    sizes = [r["count"] for r in sample.groupBy("tree").count().collect()]
    assert len(sizes) == 20 and all(s == 256 for s in sizes)
    assert sample.select("tree", "row_id").distinct().count() == 20 * 256


def test_forest_of_equal_rows(spark):
    df = frame(spark, np.ones((20, 3)), "row_id")
    assert {r.ml_score for r in iforest.isolation_forest_scores(df, "row_id").collect()} == {0.0}


def test_path_lengths():
    assert list(iforest.expected_depth(np.array([0, 1, 2]))) == [0, 0, 1]
    assert iforest.expected_depth(256) == pytest.approx(10.2448, abs=1e-3)


def test_pca_matches_numpy(spark):
    x = vectors(200, d=6)
    out = projection.principal_components(frame(spark, x), "vector", 3).orderBy("point_id").collect()
    got = np.array([r.components for r in out])
    centred = x - x.mean(axis=0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    assert np.abs(got) == pytest.approx(np.abs(centred @ vt[:3].T), abs=1e-6)


def test_embedders(spark):
    df = spark.createDataFrame([(1, "tool=curl etc"), (2, "tool=curl etc"), (3, ""), (4, None)], "i int, t string")
    rows = {r.i: r for r in HashingEmbedder(32).embed(df, "t").collect()}
    assert rows[1].vector == rows[2].vector and np.linalg.norm(rows[1].vector) == pytest.approx(1.0)
    assert not any(rows[3].vector) and len(rows[4].vector) == 32

    def load():
        return lambda texts: np.array([[len(t), 1.0, 0.0] for t in texts])

    rows = ModelEmbedder(load, 3).embed(df, "t").collect()
    assert len(rows) == 4 and np.linalg.norm(rows[0].vector) == pytest.approx(1.0)
    with pytest.raises(RuntimeError, match="sentence_transformers"):
        ModelEmbedder.sentence_transformer("any")


def test_dense_index(spark):
    df = spark.range(1000).select(F.sha1(F.col("id").cast("string")).alias("key")).repartition(7)
    rows = points.dense_index(df, "key", "n").collect()
    assert [r.key for r in sorted(rows, key=lambda r: r.n)] == sorted(r.key for r in rows)
    assert sorted(r.n for r in rows) == list(range(1000))


def test_collections(spark, tmp_path):
    payload = F.struct(F.when(F.col("point_id") % 2 == 0, "even").otherwise("odd").alias("label"))
    stored = frame(spark, vectors(20)).withColumn("payload", payload)
    new = stored.filter("point_id < 3").withColumn("vector", F.transform("vector", lambda v: -v))
    merged = points.upsert(stored, new)
    assert merged.count() == 20
    points.save_collection(merged, str(tmp_path), "c", 8)
    loaded = points.load_collection(spark, str(tmp_path), "c")
    assert points.collection_info(loaded).first().asDict() == {"points": 20, "min_dim": 8, "dim": 8}
    points.save_collection(loaded.limit(5), str(tmp_path), "c", 8)  # stale points go
    assert points.load_collection(spark, str(tmp_path), "c").count() == 5
    with pytest.raises(ValueError, match="expected 9"):
        points.save_collection(stored, str(tmp_path), "c", 9)
    queries = frame(spark, vectors(2, seed=4), "query_id")
    found = points.search(queries, stored, 4, label="even", tool=None).collect()
    assert len(found) == 8 and all(r.point_id % 2 == 0 for r in found)
    assert points.search(queries, stored, 30, label="").count() == 40
    assert [r.point_id for r in points.scroll(stored, 3).collect()] == [0, 1, 2]
    assert points.retrieve(stored, [4, 99]).count() == 1


@pytest.mark.parametrize("exclude_self,task_bytes", [(False, 64 << 20), (True, 1)])
def test_a_join_of_many_chunks_copies_no_rows(spark, monkeypatch, exclude_self, task_bytes):
    """Chunks that meet are read where they are: each row is dealt once, and a task gives k hits for a query at most."""
    monkeypatch.setattr(knn, "PACK", 20)
    monkeypatch.setattr(knn, "COPIES", 2)
    monkeypatch.setattr(knn, "COPY_BYTES", 0)
    monkeypatch.setattr(knn, "TASK_BYTES", task_bytes)
    x = np.random.default_rng(3).normal(size=(150, 5))
    x[:60] = x[0]
    df = frame(spark, x)
    queries = df.withColumnRenamed("point_id", "query_id")
    dealt, found, blocks, search = [], [], knn._blocks, knn._search
    monkeypatch.setattr(knn, "_blocks", lambda side, *rest: dealt.append(side.count()) or blocks(side, *rest))
    monkeypatch.setattr(knn, "_search", lambda *a: found.append(search(*a)) or found[-1])
    assert hits(knn.knn_join(queries, df, 6, exclude_self, rows_per_cell=25, chunk=20)) == brute(x, x, 6, exclude_self=exclude_self)
    assert dealt and len(dealt) % 2 == 0 and max(dealt) <= 150  # some 150 x 8 rows a side before
    tasks, q_blocks = found[-1].rdd.getNumPartitions(), -(-dealt[-2] // 20)
    assert q_blocks > 2 and tasks % q_blocks == 0 and (tasks > 3 * q_blocks or task_bytes > 1)
    assert found[-1].groupBy("query_id").count().agg(F.max("count")).first()[0] <= 6 * tasks // q_blocks


def test_blocks_pass_over_packs_that_no_query_wants(spark, monkeypatch):
    """Tight clusters, named queries: few chunks are searched, and the hits are exact."""
    monkeypatch.setattr(knn, "PACK", 20)
    monkeypatch.setattr(knn, "COPIES", 0)
    monkeypatch.setattr(knn, "COPY_BYTES", 0)
    x = vectors(300, d=6, clusters=10)
    df = frame(spark, x)
    queries = df.select(F.concat(F.lit("q"), "point_id").alias("query_id"), "vector")
    found = knn.knn_join(queries, df, 5, rows_per_cell=10, chunk=30).withColumn("query_id", F.substring("query_id", 2, 9).cast("bigint"))
    assert hits(found) == brute(x, x, 5)
