import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sparkwarden import schemas
from sparkwarden.operators import mapping, points
from sparkwarden.operators.embedding import HashingEmbedder
from sparkwarden.operators.enrich import enrich_events
from sparkwarden.operators.sessionize import SessionConfig, build_sessions
from sparkwarden.plans import analytics, evaluate, pipeline
from sparkwarden.sources import tables
from sparkwarden.sources.raw_log import parse_lines, read_raw_lines
from sparkwarden.streaming import live
from tests.test_knowledge import BUNDLE, action, link, pattern, phase


def log_lines(n=400):
    rng = random.Random(5)
    agents = ["gobuster/3", "curl/8", "Mozilla/5.0", None, "sqlmap/1"]
    paths = ["/index.html", "/etc/passwd", "../x", "/wp-login.php", "q UNION x", "a|b"]
    lines = []
    for _ in range(n):
        who = rng.randint(0, 4)
        at = datetime(2024, 1, 1) + timedelta(seconds=rng.randint(0, 20_000))
        lines.append(json.dumps([None, rng.choice(paths), at.strftime("%Y-%m-%d %H:%M:%S"), f"10.0.0.{who}", str(rng.randint(1, 99)), agents[who]]))
    return lines + ["junk", ""]


def bundle():
    tactics = ["discovery", "execution", "initial-access"]
    objects = [
        pattern(i, f"T{1000 + i}", description=f"tool=gobuster reasons {t} curl", kill_chain_phases=[phase("mitre-attack", t)])
        for i, t in enumerate(tactics * 3)
    ]
    return {"objects": BUNDLE["objects"][1:2] + objects + [action(1), link("course-of-action--1", "attack-pattern--1")]}


@pytest.fixture(scope="module")
def ran(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    (root / "raw.log").write_text("\n".join(log_lines()))
    (root / "bundle.json").write_text(json.dumps(bundle()))
    out = str(root / "out")
    report = pipeline.run_all(spark, str(root / "raw.log"), str(root / "bundle.json"), out)
    return out, report


def test_run_all(spark, ran):
    out, report = ran
    scored = tables.read_table(spark, f"{out}/sessions_scored.parquet", schemas.SCORED)
    events = tables.read_table(spark, f"{out}/session_events", schemas.SESSION_EVENTS)
    assert tables.read_events(spark, f"{out}/events.parquet").count() == 400
    assert events.count() == scored.agg(F.sum("event_count")).first()[0]
    assert scored.filter(~F.col("ml_score").between(0, 1) | ~F.col("suspicious_score").between(0, 1)).count() == 0
    mapped = tables.read_table(spark, f"{out}/session_attack_mapping.parquet", schemas.MAPPING)
    assert mapped.count() == scored.filter("label != 'benign'").count() > 0
    first = mapped.first()
    assert len(first.mapped_techniques) == len(first.mapped_names) == len(first.mapped_tactics) == 3
    assert first.summary.startswith("tool=") and 0 < first.confidence <= 1
    assert report["mode"] == "proxy" and report["detection"]["n_evaluated"] > 0
    assert tables.read_report(spark, f"{out}/report") == json.loads(json.dumps(report))
    long = evaluate.report_table(spark, report)
    assert long.filter("metric = 'macro_f1' and section = 'detection'").count() == 1


def test_labeled_evaluation_from_files(spark, ran, tmp_path):
    out, _ = ran
    scored = tables.read_table(spark, f"{out}/sessions_scored.parquet", schemas.SCORED)
    mapped = tables.read_table(spark, f"{out}/session_attack_mapping.parquet", schemas.MAPPING)
    truth = evaluate.detection_template(scored, 0).withColumn("true_label", F.col("pred_label"))
    known = evaluate.mapping_template(mapped, 0).withColumn("true_technique_ids", F.col("pred_mapped_techniques"))
    tables.write_template(truth, str(tmp_path / "d.csv"))
    tables.write_template(known, str(tmp_path / "m.csv"))
    det = tables.read_labels(spark, str(tmp_path / "d.csv"), schemas.DETECTION_LABELS)
    mp = tables.read_labels(spark, str(tmp_path / "m.csv"), schemas.MAPPING_LABELS)
    techniques, _ = tables.read_knowledge(spark, f"{out}/knowledge")
    report = evaluate.run_eval(scored, mapped, techniques, "labeled", det, mp)
    assert report["detection"]["weighted_f1"] == pytest.approx(1.0)
    assert report["mapping"]["top1_accuracy"] == 1.0 and report["mapping"]["coverage_vs_labels"] == 1.0


def test_search_and_collections(spark, ran):
    out, _ = ran
    stored = points.load_collection(spark, f"{out}/collections", pipeline.SESSION_COLLECTION)
    queries = spark.createDataFrame([(1, "tool=gobuster")], "query_id int, text string")
    found = points.search_text(queries, stored, HashingEmbedder(), 5, tool="gobuster").collect()
    assert found and {r.payload.tool for r in found} == {"gobuster"}
    assert found[0].payload.start_ts.endswith("+00:00")
    techniques = points.load_collection(spark, f"{out}/collections", pipeline.TECHNIQUE_COLLECTION)
    assert sorted(r.point_id for r in techniques.collect()) == list(range(9))


def test_mapping_ways_agree_and_limit(spark, ran):
    out, _ = ran
    scored = tables.read_table(spark, f"{out}/sessions_scored.parquet", schemas.SCORED)
    corpus = points.load_collection(spark, f"{out}/collections", pipeline.TECHNIQUE_COLLECTION)
    chosen = HashingEmbedder().embed(mapping.suspicious_sessions(scored).withColumn("summary", F.concat("tool", F.lit(" curl"))), "summary")
    small = mapping.map_vectors(chosen, corpus, 5, 2).orderBy("session_id").collect()
    large = mapping.map_vectors(chosen, corpus, 5, 2, limit=0).orderBy("session_id").collect()
    assert small == large
    few = mapping.map_sessions(scored, corpus, HashingEmbedder(), limit=2).collect()
    assert {r.session_id for r in few} == {r.session_id for r in small[:2]}
    none = mapping.map_vectors(chosen, corpus.limit(0), 5, 2).first()
    assert none.mapped_techniques == [] and none.confidence == 0.0


def test_reports(spark, ran):
    out, _ = ran
    scored = tables.read_table(spark, f"{out}/sessions_scored.parquet", schemas.SCORED)
    events = tables.read_table(spark, f"{out}/session_events", schemas.SESSION_EVENTS)
    total = events.count()
    by_label = analytics.timeline_by_label(events, scored)
    assert by_label.select(F.expr("sum(benign + suspicious + attack_like)")).first()[0] == total
    five = analytics.resample(by_label, 5)
    assert five.select(F.expr("sum(benign + suspicious + attack_like)")).first()[0] == total
    assert five.agg(F.max("bucket").cast("long") - F.min("bucket").cast("long")).first()[0] == (five.count() - 1) * 300
    strangers = analytics.timeline_intensity(events, scored.limit(0))
    assert strangers.count() == analytics.timeline_intensity(events, scored).count()
    assert strangers.agg(F.sum("weight")).first()[0] == 0.0
    same = spark.createDataFrame([(2.0,), (2.0,), (None,)], "x double")
    bins = analytics.histogram(same, "x", 4).orderBy("bin").collect()
    assert [(b.low, b["count"]) for b in bins] == [(1.5, 0), (1.75, 0), (2.0, 2), (2.25, 0)]
    assert analytics.histogram(same.limit(0), "x", 4).count() == 0


def test_plans_have_no_cartesian_product(spark, ran):
    out, _ = ran
    scored = tables.read_table(spark, f"{out}/sessions_scored.parquet", schemas.SCORED)
    events = tables.read_table(spark, f"{out}/session_events", schemas.SESSION_EVENTS)
    for df in (analytics.timeline_by_label(events, scored), evaluate.confusion(evaluate.proxy_pairs(scored)), analytics.histogram(scored, "rps")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_streams(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.log").write_text("\n".join(log_lines()))
    late = json.dumps([None, "/", "2024-02-01 00:00:00", "9.9.9.9", "1", "x"])
    for name, shape in (("sessions", live.live_sessions), ("counts", live.live_counts)):
        out, state = str(tmp_path / name), str(tmp_path / f"{name}-state")
        (source / "b.log").unlink(missing_ok=True)
        for extra in (None, late):
            if extra:
                (source / "b.log").write_text(extra)
            stream = shape(live.live_events(spark, str(source)))
            query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
            query.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    sessions = spark.read.parquet(str(tmp_path / "sessions"))
    counts = spark.read.parquet(str(tmp_path / "counts"))
    assert counts.agg(F.sum("events")).first()[0] == 400
    want = build_sessions(enrich_events(parse_lines(read_raw_lines(spark, str(source / "a.log")))), SessionConfig())
    cols = ["src_ip", "tool", "start_ts", "end_ts", "event_count", "unique_ports", "indicator_hits", "rps"]
    assert sorted(sessions.select(cols).collect()) == sorted(want.select(cols).collect())


def test_late_rows_are_counted(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    line = lambda t: json.dumps([None, "/", t, "9.9.9.9", "1", "x"])
    state, late = str(tmp_path / "state"), []
    for name, time in (("a", "2024-02-01 12:00:00"), ("b", "2024-02-01 13:00:00"), ("c", "2024-02-01 09:00:00")):
        (source / f"{name}.log").write_text(line(time))
        stream = live.live_counts(live.live_events(spark, str(source))).writeStream.format("parquet")
        query = stream.option("path", str(tmp_path / "out")).option("checkpointLocation", state)
        query = query.outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()
        late.append(live.rows_too_late(query))
    assert late == [0, 0, 1]
