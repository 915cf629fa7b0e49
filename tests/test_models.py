"""What is stored and added up: days of sessions, moments of vectors, fitted forests, row groups."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sparkwarden.operators import iforest, moments, projection, rollup
from sparkwarden.operators.enrich import enrich_events
from sparkwarden.operators.sessionize import SessionConfig, build_sessions, label_events, sessions_from_events
from sparkwarden.plans import evaluate, pipeline
from sparkwarden.sources import tables


def events(spark, days=3, ports=(1, 40_000, -5, None)):
    rows = []
    for d in range(days):
        for h in range(24):
            for i, port in enumerate(ports):
                rows.append((f"2024-02-0{d + 1}T{h:02d}:{2 * i:02d}:00Z", f"10.0.0.{h % 3}", port, "curl/8", None, None, "/etc/passwd", None, "x"))
    names = "ts string, src_ip string, src_port bigint, user_agent string, lang string, action1 string, action2 string, extra string, raw_line string"
    return enrich_events(spark.createDataFrame(rows, names))


def collected(df):
    return sorted(tuple(r) for r in df.collect())


def test_days_of_sessions_merge_exactly(spark, tmp_path):
    # A gap of four hours: each source is one session over all days.
    labelled = label_events(events(spark), SessionConfig(4 * 3600))
    want = collected(sessions_from_events(labelled))
    assert len(want) == 3 and {r[6] for r in want} != {0}
    day = F.to_date("ts_dt_utc").cast("string")
    out = str(tmp_path / "days")
    for d in ("2024-02-01", "2024-02-02", "2024-02-03", "2024-02-02"):
        rollup.write_days(labelled.filter(day == d), out)
    counts, ports = rollup.read_days(spark, out)
    assert collected(rollup.merged_sessions(counts, ports)) == want and counts.count() == 9
    first = rollup.merged_sessions(*(t.filter("day < '2024-02-03'") for t in (counts, ports)))
    assert collected(first) == collected(sessions_from_events(labelled.filter(day < "2024-02-03")))


def test_ports_over_all_numbers(spark):
    ports = [None, 0, 1, 32_767, 32_768, 32_769, 65_535, -1, -32_768, -32_769, 2**40, 2**40]
    labelled = label_events(events(spark, 1, ports), SessionConfig(4 * 3600))
    found = rollup.merged_sessions(rollup.counts_by_day(labelled), rollup.ports_by_day(labelled)).collect()
    assert {r.unique_ports for r in found} == {10}
    none = label_events(events(spark, 1, [None, None]), SessionConfig(4 * 3600))
    assert {r.unique_ports for r in rollup.merged_sessions(rollup.counts_by_day(none), rollup.ports_by_day(none)).collect()} == {0}


def vectors(spark, n=200, dim=6, far=0.0):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(n, dim)) * np.arange(1, dim + 1) + far
    return x, spark.createDataFrame([(i, f"d{i % 4}" if i % 5 else None, v.tolist()) for i, v in enumerate(x)], "point_id bigint, day string, vector array<double>").repartition(3)


@pytest.mark.parametrize("far", [0.0, 1e6])
def test_moments_of_parts_equal_the_whole(spark, far):
    x, df = vectors(spark, far=far)
    origin = np.full(6, far) if far else None
    some = moments.parts(df, "day", origin=origin)
    assert {r.part for r in some.collect()} == {None, "d0", "d1", "d2", "d3"}
    two = moments.added(some.filter("part is null or part < 'd2'")).unionByName(moments.added(some.filter("part >= 'd2'")))
    for of in (moments.moments(some, origin), moments.moments(two, origin)):
        assert of.n == 200 and np.allclose(of.mean, x.mean(axis=0)) and np.allclose(of.covariance, np.cov(x.T), atol=1e-8)
    want = {r.point_id: r.components for r in projection.principal_components(df, "vector", 3).collect()}
    got = {r.point_id: r.components for r in moments.project(df, moments.moments(some, origin), 3).collect()}
    assert all(np.allclose(got[i], want[i], atol=1e-6) for i in want)


def test_moments_of_nothing(spark):
    _, df = vectors(spark, 4)
    none = moments.moments(moments.parts(df.limit(0), "day"))
    assert none.n == 0 and none.covariance.shape == (0, 0)
    nulls = df.withColumn("vector", F.when(F.col("point_id") > 1, F.col("vector")))
    assert moments.moments(moments.parts(nulls, "day")).n == 2


def test_stored_forest_scores_as_the_fitted_one(spark, tmp_path):
    _, df = vectors(spark)
    fitted = iforest.fit_scorer(df, "point_id", seed=3)
    root = str(tmp_path / "model")
    with pytest.raises(FileNotFoundError):
        iforest.load_scorer(spark, root)
    assert [iforest.save_scorer(s, spark, root) for s in (fitted, iforest.Scorer(None, 0.0, 0.0))] == [1, 2]
    (tmp_path / "model/version=3/nodes").mkdir(parents=True)  # never finished
    assert iforest.scorer_versions(spark, root) == [1, 2] and iforest.load_scorer(spark, root).forest is None
    read = iforest.load_scorer(spark, root, 1)
    own, stored = ({r.point_id: r.ml_score for r in s.score(df).collect()} for s in (fitted, read))
    batch = {r.point_id: r.ml_score for r in iforest.isolation_forest_scores(df, "point_id", seed=3).collect()}
    assert own == stored and own == pytest.approx(batch)
    out = spark.createDataFrame([(-1, None, [1e3] * 6)], df.schema)
    assert 0 <= read.score(out).first().ml_score <= 1.0 >= max(own.values())
    assert iforest.save_scorer(fitted, spark, root) == 4
    assert {r.ml_score for r in iforest.load_scorer(spark, root, 2).score(df).collect()} == {0.0}


def test_detection_with_a_stored_model(spark):
    sessions = build_sessions(events(spark), SessionConfig(1200))
    fitted = iforest.fit_scorer(pipeline.behaviour_vectors(sessions), "session_id")
    by_model, by_batch = ({r.session_id: r for r in df.collect()} for df in (pipeline.detect_with(sessions, fitted), pipeline.detect(sessions)))
    assert by_model.keys() == by_batch.keys() and len(by_model) > 3
    for key, row in by_model.items():
        assert row.label == by_batch[key].label and row.suspicious_score == pytest.approx(by_batch[key].suspicious_score)


def test_row_groups(spark, tmp_path):
    tables.write_events(events(spark, 3, range(20)).coalesce(1), str(tmp_path / "e"), rows_per_group=500)
    (file,) = (tmp_path / "e").glob("*.parquet")
    meta = pq.ParquetFile(file).metadata
    assert [meta.row_group(i).num_rows for i in range(meta.num_row_groups)] == [500, 500, 440]


def test_every_bad_label_is_named(spark):
    labels = spark.createDataFrame([("a", "evil"), ("b", "Bad"), ("c", ""), ("d", "benign"), ("e", "evil")], "session_id string, true_label string")
    with pytest.raises(ValueError, match=r"invalid values: \['', 'bad', 'evil'\]$"):
        evaluate.check_labels(labels)
    many = spark.range(150).select(F.col("id").cast("string").alias("session_id"), F.concat(F.lit("x"), F.col("id").cast("string")).alias("true_label"))
    with pytest.raises(ValueError, match="150 in all"):
        evaluate.check_labels(many)
