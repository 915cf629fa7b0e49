import pytest
from pyspark.sql import functions as F

from sparkwarden.functions.confidence import boost, confidence
from sparkwarden.operators.rules import RULES, apply_rules, combine_scores
from sparkwarden.schemas import INDICATOR_COLUMNS

SCHEMA = "tool string, event_count bigint, unique_ports bigint, rps double, " + ", ".join(f"{c} bigint" for c in INDICATOR_COLUMNS)


def ruled(spark, tool="x", events=1, ports=1, rps=0.0, inds=(0, 0, 0, 0, 0)):
    return apply_rules(spark.createDataFrame([(tool, events, ports, rps, *inds)], SCHEMA)).first()


def test_rules_and_thresholds(spark):
    assert ruled(spark).rule_score == 0.0 and ruled(spark).rule_reasons == []
    assert ruled(spark, tool="gobuster").rule_score == 0.85
    assert ruled(spark, tool="sqlmap").rule_reasons == []
    assert ruled(spark, rps=3.0).rule_reasons == ["behavior:burst_rps>=3"]
    assert ruled(spark, rps=2.999).rule_reasons == []
    assert ruled(spark, events=299, ports=19).rule_reasons == []
    row = ruled(spark, events=300, ports=20)
    assert row.rule_score == 0.35 + 0.25 and row.rule_reasons == ["behavior:high_volume>=300", "behavior:many_ports"]
    full = ruled(spark, "curl", 300, 20, 3.0, (1, 1, 1, 1, 1))
    assert full.rule_score == 1.0 and full.rule_reasons == [r for c, _, r in RULES if "gobuster" not in c]
    assert ruled(spark, rps=None).rule_score == 0.0


@pytest.mark.parametrize(
    "rule,model,label",
    [(1.0, 0.0, "suspicious"), (1.0, 0.142, "suspicious"), (1.0, 0.143, "attack_like"), (0.0, 1.0, "benign"),
     (0.2, 0.772, "suspicious"), (0.2, 0.771, "benign"), (None, None, "benign"), (0.5, float("nan"), "benign"), (9.0, 9.0, "attack_like")],
)
def test_fusion(spark, rule, model, label):
    df = spark.createDataFrame([(rule, model, ["a"])], "rule_score double, ml_score double, rule_reasons array<string>")
    row = combine_scores(df).first()
    assert row.label == label and 0 <= row.suspicious_score <= 1


def test_model_reason(spark):
    df = spark.createDataFrame([(0.8, ["a"]), (0.79, ["a"]), (0.9, None)], "ml_score double, rule_reasons array<string>")
    rows = combine_scores(df.withColumn("rule_score", F.lit(0.0))).collect()
    assert [r.reasons for r in rows] == [["a", "ml_anomaly:high"], ["a"], ["ml_anomaly:high"]]


def test_boost_and_confidence(spark):
    cases = [
        ("gobuster", ["indicator:cmd_injection"], None, 0.30),
        ("x", ["indicator:/etc/passwd"], None, 0.0),
        ("x", [], ["behavior:many_ports"], 0.10),
        ("x", ["none"], ["behavior:many_ports"], 0.0),
        ("x", None, None, 0.0),
        ("dirbuster", ["indicator:cmd_injection", "indicator:sql_injection"], None, 0.35),
    ]
    df = spark.createDataFrame(cases, "tool string, rule_reasons array<string>, reasons array<string>, want double")
    cols = [F.col(c) for c in ("tool", "rule_reasons", "reasons")]
    for row in df.select("want", boost(*cols).alias("got"), boost(*cols, match_lfi_rule=True).alias("fixed")).collect():
        assert row.got == pytest.approx(row.want)
    fixed = df.select(boost(*cols, match_lfi_rule=True).alias("b")).collect()[1].b
    assert fixed == pytest.approx(0.20)
    sims = spark.createDataFrame([(-1.0, 0.0, 0.0), (0.5, 0.35, 0.575), (2.0, 9.0, 1.0)], "s double, b double, w double")
    for row in sims.select("w", confidence(F.col("s"), F.col("b")).alias("c")).collect():
        assert row.c == pytest.approx(row.w)
