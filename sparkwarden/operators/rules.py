"""Rule scoring of sessions and fusion with the model score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Condition, weight and reason, in the order in which weights are added and reasons listed.
RULES = [
    ("tool IN ('gobuster', 'dirbuster')", 0.85, "tool_fingerprint:dir_enum"),
    ("tool IN ('go-http-client', 'python-requests', 'curl', 'wget')", 0.20, "tool_fingerprint:automation"),
    ("ind_lfi_etc_passwd > 0", 0.90, "indicator:/etc/passwd"),
    ("ind_path_traversal > 0", 0.70, "indicator:path_traversal"),
    ("ind_sql_injection > 0", 0.70, "indicator:sql_injection"),
    ("ind_cmd_injection > 0", 0.70, "indicator:cmd_injection"),
    ("ind_wp_probe > 0", 0.40, "indicator:wp_probe"),
    ("rps >= 3.0", 0.35, "behavior:burst_rps>=3"),
    ("event_count >= 300", 0.35, "behavior:high_volume>=300"),
    ("unique_ports >= 20", 0.25, "behavior:many_ports"),
]

# Fusion weights, label thresholds, and the model score that earns a reason.
RULE_WEIGHT = 0.65
MODEL_WEIGHT = 0.35
ATTACK_FROM = 0.70
SUSPICIOUS_FROM = 0.40
MODEL_REASON_FROM = 0.80
MODEL_REASON = "ml_anomaly:high"


def clip(value: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def apply_rules(sessions: DataFrame) -> DataFrame:
    """Add ``rule_score`` in [0, 1] and the ordered ``rule_reasons``."""
    score = " + ".join(["0.0D"] + [f"CASE WHEN {c} THEN {w}D ELSE 0.0D END" for c, w, _ in RULES])
    reasons = ", ".join(f"CASE WHEN {c} THEN '{r}' END" for c, _, r in RULES)
    return sessions.withColumns(
        {"rule_score": clip(F.expr(score)), "rule_reasons": F.expr(f"array_compact(array({reasons}))")}
    )


def combine_scores(
    df: DataFrame, rule_weight: float = RULE_WEIGHT, model_weight: float = MODEL_WEIGHT
) -> DataFrame:
    """Fuse ``rule_score`` and ``ml_score``, label the result and extend the reasons."""
    cleaned = df.withColumns(
        {c: clip(F.coalesce(F.nanvl(F.col(c), F.lit(0.0)), F.lit(0.0))) for c in ("ml_score", "rule_score")}
    )
    fused = cleaned.withColumn(
        "suspicious_score",
        clip(F.lit(rule_weight) * F.col("rule_score") + F.lit(model_weight) * F.col("ml_score")),
    )
    score = F.col("suspicious_score")
    label = (
        F.when(score >= ATTACK_FROM, "attack_like")
        .when(score >= SUSPICIOUS_FROM, "suspicious")
        .otherwise("benign")
    )
    base = F.coalesce(F.col("rule_reasons"), F.array().cast("array<string>"))
    reasons = F.when(F.col("ml_score") >= MODEL_REASON_FROM, F.array_append(base, F.lit(MODEL_REASON)))
    return fused.withColumns({"label": label, "reasons": reasons.otherwise(base)})
