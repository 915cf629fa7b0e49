import gzip
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sparkwarden.functions.text import technique_text
from sparkwarden.operators.embedding import HashingEmbedder
from sparkwarden.operators.points import technique_points
from sparkwarden.plans import queries
from sparkwarden.plans.analytics import knowledge_counts
from sparkwarden.sources import stix, tables


def pattern(n, tid=None, **more):
    refs = [{"source_name": "other", "external_id": "T9"}]
    if tid:
        refs.append({"source_name": "mitre-attack", "external_id": tid})
    return {"type": "attack-pattern", "id": f"attack-pattern--{n}", "name": f"N{n}", "external_references": refs, **more}


def action(n, name=None):
    return {"type": "course-of-action", "id": f"course-of-action--{n}", "name": name or f"M{n}", "description": "d"}


def link(source, target, kind="mitigates"):
    return {"type": "relationship", "relationship_type": kind, "source_ref": source, "target_ref": target}


def phase(chain, name):
    return {"kill_chain_name": chain, "phase_name": name}


BUNDLE = {
    "type": "bundle",
    "objects": [
        pattern(1, "T1001", description="line1\nline2", x_mitre_is_subtechnique=False, x_mitre_platforms=["Linux"],
                kill_chain_phases=[phase("mitre-attack", "persistence"), phase("mitre-attack", "discovery"),
                                   phase("mitre-attack", "discovery"), phase("other", "x"), phase("mitre-attack", "")]),
        pattern(2),
        pattern(3, "T1001", name="later", x_mitre_is_subtechnique=True, revoked=True),
        pattern(4, "X1", x_mitre_platforms="Linux", kill_chain_phases="none", description=5),
        {"type": "x-mitre-tactic", "id": "tactic--1", "external_references": [{"source_name": "mitre-attack", "external_id": "TA1"}]},
        action(1), action(2), action(1, "renamed"),
        link("course-of-action--1", "attack-pattern--1"), link("course-of-action--2", "attack-pattern--3"),
        link("course-of-action--1", "attack-pattern--1"), link("course-of-action--1", "tactic--1"),
        link("x", "attack-pattern--1", "uses"), link("missing", "attack-pattern--1"), link("course-of-action--1", "nowhere"),
        link("course-of-action--1", "attack-pattern--2"), "text", 5, None, ["list"],
    ],
}


def write(tmp_path, bundle):
    path = tmp_path / "bundle.json"
    path.write_text(json.dumps(bundle, indent=1))
    return str(path)


@pytest.fixture()
def typed(spark, tmp_path):
    return stix.typed_objects(stix.read_bundle(spark, write(tmp_path, BUNDLE)))


def test_techniques(typed):
    rows = stix.techniques(typed).orderBy("pos").collect()
    assert [r.technique_id for r in rows] == ["T1001", None, "T1001", None]
    assert rows[0].tactics == ["discovery", "persistence"] and rows[0].platforms == ["Linux"]
    assert rows[1].tactics == [] and rows[1].is_subtechnique is False and rows[1].platforms == []
    # A description is copied whatever it is; lists of the wrong shape count as missing.
    assert rows[3].platforms == [] and rows[3].description == "5" and rows[3].tactics == []
    (last,) = stix.techniques_by_id(stix.techniques(typed)).collect()
    assert last.name == "later" and last.is_subtechnique


def test_mitigations(typed):
    rows = stix.mitigations(typed).orderBy("ord").collect()
    assert [(r.technique_id, r.name) for r in rows] == [("T1001", "renamed"), ("T1001", "M2"), ("T1001", "renamed"), ("TA1", "renamed")]
    names = {r.technique_id: r.names for r in stix.mitigation_names(stix.mitigations(typed)).collect()}
    assert names == {"T1001": ["renamed", "M2", "renamed"], "TA1": ["renamed"]}
    counts = knowledge_counts(stix.techniques(typed), stix.mitigations(typed)).first()
    assert (counts.techniques, counts.with_mitigations) == (4, 2)
    by_id = {r.id: json.loads(r.json) for r in stix.objects_by_id(typed).collect()}
    assert by_id["course-of-action--1"]["name"] == "renamed" and len(by_id) == 7


def test_drop_revoked_is_a_choice(spark, tmp_path):
    objects = stix.read_bundle(spark, write(tmp_path, BUNDLE))
    assert stix.techniques(stix.typed_objects(objects, drop_revoked=True)).count() == 3


def test_many_mitigations_and_text(spark, tmp_path):
    bundle = {"objects": [pattern(1, "T1", description="a\nb"), pattern(2)] + [action(i) for i in range(30)]}
    bundle["objects"] += [link(f"course-of-action--{i}", "attack-pattern--1") for i in range(30)]
    typed = stix.typed_objects(stix.read_bundle(spark, write(tmp_path, bundle)))
    names = stix.mitigation_names(stix.mitigations(typed))
    assert names.first().names == [f"M{i}" for i in range(20)]
    row = stix.techniques(typed).join(names, "technique_id").select(technique_text(F.col("names")).alias("t")).first()
    assert row.t == "T1 N1. Tactics: . Description: a b Mitigations: " + "; ".join(f"M{i}" for i in range(8))
    (point,) = technique_points(stix.techniques(typed), names, HashingEmbedder(16)).collect()
    assert point.point_id == 0 and len(point.payload.mitigations) == 20 and len(point.vector) == 16


@pytest.mark.parametrize("bundle", [{"objects": {"a": 1}}, {"objects": None}, {"objects": "x"}, [1, 2]])
def test_not_a_bundle(spark, tmp_path, bundle):
    with pytest.raises(ValueError, match="no list named objects"):
        stix.read_bundle(spark, write(tmp_path, bundle))


def test_empty_bundles(spark, tmp_path):
    for bundle in ({"objects": []}, {"type": "bundle"}):
        assert stix.read_bundle(spark, write(tmp_path, bundle)).count() == 0


def test_tables(spark, tmp_path):
    out = tables.build_knowledge(spark, write(tmp_path, BUNDLE), str(tmp_path / "out"))
    techniques, mitigations = tables.read_knowledge(spark, out)
    assert techniques.count() == 4 and mitigations.count() == 4
    assert spark.read.parquet(f"{out}/techniques_by_id").count() == 1


def test_bundle_documents_are_compressed_and_whole(spark, tmp_path, monkeypatch):
    """Several documents, a batch cut inside one of them, and one without relationships; all objects, in order."""
    key = "cast(id as bigint)"
    ones = spark.range(90)
    ones.selectExpr(f"{key} p_partkey", "'a \"b\"' p_name", "'Brand' p_brand", "'X' p_type", "int(id) p_size").write.parquet(f"{tmp_path}/part.parquet")
    ones.selectExpr(f"{key} s_suppkey", "'é' s_name", "int(1) s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    line = ones.selectExpr(f"{key} l_orderkey", "int(1) l_linenumber", f"{key} l_partkey", f"{key} l_suppkey", "'N' l_returnflag")
    monkeypatch.setattr(queries, "OBJECTS_PER_DOCUMENT", 60)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 25)
    try:
        for rows in (line, line.limit(0)):
            rows.write.mode("overwrite").parquet(f"{tmp_path}/lineitem.parquet")
            folder = queries._bundles(spark, str(tmp_path))
            files = sorted(Path(folder).glob("part-*"))
            assert len(files) > 1 and all(f.suffix == ".gz" for f in files)
            texts = [gzip.decompress(f.read_bytes()).decode() for f in files]
            assert sum(f.stat().st_size for f in files) < sum(map(len, texts)) / 2
            want = [json.loads(r.json) for r in queries._objects(spark, str(tmp_path)).orderBy("pos").collect()]
            assert [o for t in texts for o in json.loads(t)["objects"]] == want
            assert [json.loads(r.json) for r in stix.read_bundle(spark, folder).orderBy("pos").collect()] == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
