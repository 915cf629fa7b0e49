import pytest
from pyspark.sql import functions as F

from sparkwarden.functions.arrays import flat_tokens, list_from_text
from sparkwarden.plans import evaluate as E
from sparkwarden.plans.analytics import LABELS
from sparkwarden.schemas import DETECTION_LABELS, MAPPING_LABELS
from sparkwarden.sources import tables

PUBLISHED = [[810, 0, 0], [262, 6716, 56], [0, 2106, 915]]


def test_published_confusion_gives_published_scores(spark):
    cells = [(t, p, PUBLISHED[i][j]) for i, t in enumerate(LABELS) for j, p in enumerate(LABELS)]
    df = spark.createDataFrame(cells, "true_label string, pred_label string, count bigint")
    classes = E.per_class(df)
    summary = E.f1_summary(classes).first()
    assert summary.macro_f1 == pytest.approx(0.7221091160567793, abs=1e-12)
    assert summary.weighted_f1 == pytest.approx(0.740063071863536, abs=1e-12)
    by = {r.label: r for r in classes.collect()}
    assert by["attack_like"].precision == pytest.approx(915 / 971) and by["benign"].support == 810


def scored(spark):
    return spark.createDataFrame(
        [("a", "benign"), ("b", "suspicious"), ("c", "Attack_like "), ("d", None)], "session_id string, label string"
    )


def test_detection_labeled(spark):
    labels = spark.createDataFrame(
        [("a", " Benign"), ("b", "attack_like"), ("b", "suspicious"), ("c", "\tATTACK_LIKE\u00a0"), ("d", "benign"), ("zz", "benign"), ("a", None)],
        "session_id string, true_label string",
    )
    out = E.detection_metrics_labeled(scored(spark), labels)
    assert out["confusion_matrix"] == [[1, 0, 0], [0, 1, 0], [0, 1, 1]]
    assert out["n_evaluated"] == 5 and out["coverage_vs_labels"] == pytest.approx(5 / 7)
    assert out["per_class"]["suspicious"] == {"precision": 0.5, "recall": 1.0, "f1": pytest.approx(2 / 3), "support": 1}


def test_detection_guards(spark):
    with pytest.raises(ValueError, match="missing columns: .*true_label"):
        E.detection_metrics_labeled(scored(spark), spark.createDataFrame([("a",)], "session_id string"))
    for bad in ("evil", " "):
        labels = spark.createDataFrame([("a", bad)], "session_id string, true_label string")
        with pytest.raises(ValueError, match="invalid values"):
            E.detection_metrics_labeled(scored(spark), labels)


def test_absent_classes_score_zero(spark):
    pairs = spark.createDataFrame([("benign", "benign")], "truth string, pred string")
    rows = {r.label: r for r in E.per_class(E.confusion(pairs)).collect()}
    assert rows["suspicious"].f1 == 0.0 and rows["benign"].f1 == 1.0
    assert E.f1_summary(E.per_class(E.confusion(pairs))).first().macro_f1 == pytest.approx(1 / 3)
    assert E.f1_summary(E.per_class(E.confusion(pairs.limit(0)))).first().weighted_f1 == 0.0


def test_list_cells(spark):
    cases = {
        '["a", " b ", "", null, 5]': ["a", "b", "None", "5"], "['x','y']": ["['x'", "'y']"], '["x"] ["y"]': ['["x"] ["y"]'],
        '["x"],["y"]': ['["x"]', '["y"]'], "\t[true, 1.5, false]\n": ["True", "1.5", "False"], "\tT1\t|\u00a0T2\x1f": ["T1", "T2"], "a|b, c": ["a", "b, c"], "a, b,,": ["a", "b"], " a ": ["a"],
        "[bad|x]": ["[bad", "x]"], "[bad": ["[bad"], "": [], "  ": [], None: [], "[]": [],
    }
    df = spark.createDataFrame([(k,) for k in cases], "c string").select("c", list_from_text(F.col("c")).alias("l"))
    got = {r.c: r.l for r in df.collect()}
    assert got == cases


def test_flat_tokens(spark):
    df = spark.createDataFrame([([["a|b", " c "], None, ["", "d,e"]],), (None,)], "x array<array<string>>")
    assert [r[0] for r in df.select(flat_tokens(F.col("x"))).collect()] == [["a", "b", "c", "d", "e"], []]


MAPPING = "session_id string, mapped_techniques array<string>, mapped_tactics array<array<string>>, why array<string>, confidence double"


def mapping(spark):
    rows = [
        ("a", ["T1", "T2", "T3"], [["Discovery", "x"], ["execution"]], ["indicator:wp_probe"], 0.5),
        ("b", ["T4", "T5"], [["impact"], ["impact", "initial-access"]], ["indicator:/etc/passwd"], 0.7),
        ("c", [], [], [], 0.0),
        ("d", ["T9"], [["x", "y", "z"], ["discovery"]], [], 0.3),
    ]
    return spark.createDataFrame(rows, MAPPING)


def test_mapping_labeled(spark):
    labels = spark.createDataFrame(
        [("a", "T3"), ("b", "T4|T8"), ("c", "T1"), ("d", "T1,T2"), ("x", "T1"), ("a", None)],
        "session_id string, true_technique_ids string",
    )
    out = E.mapping_metrics_labeled(mapping(spark), labels, 10)
    assert out["n_evaluated"] == 3 and out["coverage_vs_labels"] == pytest.approx(0.5)
    assert out["top1_accuracy"] == pytest.approx(1 / 3) and out["top3_accuracy"] == pytest.approx(2 / 3)
    with pytest.raises(ValueError, match="nothing to evaluate"):
        E.mapping_metrics_labeled(mapping(spark), labels.filter("session_id = 'c'"))
    with pytest.raises(ValueError, match="true_technique_ids"):
        E.mapping_metrics_labeled(mapping(spark), labels.drop("true_technique_ids"))


def test_mapping_proxy(spark):
    out = E.mapping_metrics_proxy(mapping(spark))
    assert out["n_evaluated"] == 4 and out["avg_confidence"] == pytest.approx(1.5 / 4)
    # Tactics are counted one by one, so d's fourth tactic is beyond the first three.
    assert out["tactic_alignment_top1"] == 0.25 and out["tactic_alignment_top3"] == 0.5
    assert E.mapping_metrics_proxy(mapping(spark).limit(0))["avg_confidence"] == 0.0


def test_templates_round_trip(spark, tmp_path):
    rows = [(f"s{i}", "benign", 0.5, "x", "ip", ["r, 1", 'q"']) for i in range(5)]
    df = spark.createDataFrame(
        rows, "session_id string, label string, suspicious_score double, tool string, src_ip string, rule_reasons array<string>"
    )
    template = E.detection_template(df, 3)
    path = str(tmp_path / "labels.csv")
    tables.write_template(template, path)
    back = tables.read_labels(spark, path, DETECTION_LABELS)
    assert back.columns == DETECTION_LABELS.fieldNames() and back.count() == 3
    row = back.orderBy("session_id").first()
    assert row.true_label is None or row.true_label == ""
    items = back.select(list_from_text(F.col("rule_reasons")).alias("l")).first().l
    assert items == ["r, 1", 'q"'] and row.suspicious_score == 0.5
    assert E.detection_template(df, 0).count() == E.detection_template(df, None).count() == 5
    assert E.detection_metrics_labeled(df, back.withColumn("true_label", F.lit("benign")))["n_evaluated"] == 3
    columns = MAPPING_LABELS.fieldNames()
    named = mapping(spark).withColumns({"mapped_names": F.col("mapped_techniques"), "summary": F.lit("line\ntwo")})
    assert E.mapping_template(named).columns == columns


def test_run_eval_guards(spark):
    with pytest.raises(ValueError, match="mode"):
        E.run_eval(scored(spark), mapping(spark), scored(spark), mode="x")
    with pytest.raises(ValueError, match="technique table"):
        E.run_eval(scored(spark), mapping(spark), scored(spark))
    with pytest.raises(ValueError, match="labeled mode requires"):
        E.run_eval(scored(spark), mapping(spark), spark.createDataFrame([("T1",)], "technique_id string"), mode="labeled")
