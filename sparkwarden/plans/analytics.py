"""Report queries over sessions, scored sessions, session events and mappings.

Every top-k carries a unique last sort key, so its rows are defined. Counts per bucket or per session are combined
before they are shuffled or joined, so one huge session or minute is a few rows by then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwarden.schemas import INDICATOR_COLUMNS

# Fixed value: label order of reports and charts.
LABELS = ["benign", "suspicious", "attack_like"]

MINUTE, DAY = 60, 86_400


def top_by(df: DataFrame, score: str, columns: list[str], n: int = 10) -> DataFrame:
    """The ``n`` highest rows, ties in order of session id."""
    return df.orderBy(F.col(score).desc(), F.col("session_id")).limit(n).select(*columns)


def largest_sessions(sessions: DataFrame, n: int = 10) -> DataFrame:
    cols = ["session_id", "src_ip", "tool", "event_count", "duration_s", "rps", "indicator_hits"]
    return top_by(sessions, "event_count", cols, n)


def top_indicator_sessions(sessions: DataFrame, n: int = 10) -> DataFrame:
    cols = ["src_ip", "tool", "indicator_hits", *INDICATOR_COLUMNS]
    return top_by(sessions.filter(F.col("indicator_hits") > 0), "indicator_hits", cols, n)


def most_suspicious(scored: DataFrame, n: int = 10) -> DataFrame:
    cols = ["src_ip", "tool", "event_count", "rps", "indicator_hits", "suspicious_score", "label", "reasons"]
    return top_by(scored, "suspicious_score", cols, n)


def value_counts(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return counts if n is None else counts.orderBy(F.col("count").desc(), F.col(column)).limit(n)


def value_counts_over(df: DataFrame, column: str, domain: list[str]) -> DataFrame:
    """Counts for exactly the values of ``domain``; null where a value does not occur."""
    wanted = df.sparkSession.createDataFrame([(v,) for v in domain], f"{column} string")
    return wanted.join(value_counts(df.filter(F.col(column).isin(domain)), column), column, "left")


def top_attack_tools(scored: DataFrame, n: int = 10) -> DataFrame:
    return value_counts(scored.filter(F.col("label") == "attack_like"), "tool", n)


def indicator_totals(scored: DataFrame, label: str = "attack_like") -> DataFrame:
    """Total hits per indicator within one label, as (indicator, total)."""
    total = scored.filter(F.col("label") == label).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in INDICATOR_COLUMNS]
    )
    return total.unpivot([], INDICATOR_COLUMNS, "indicator", "total").orderBy(F.desc("total"), "indicator")


def histogram(df: DataFrame, column: str, bins: int = 40) -> DataFrame:
    """Equal-width bins between minimum and maximum, the last one closed; empty bins are listed with 0.

    ``df`` is read twice, once for the bounds, so it should be a table or a cheap projection of one.
    """
    values = df.select(F.col(column).cast("double").alias("x")).filter(F.col("x").isNotNull())
    bounds = values.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    wide = F.col("lo") < F.col("hi")
    bounds = bounds.select(
        F.when(wide, F.col("lo")).otherwise(F.col("lo") - 0.5).alias("lo"),
        F.when(wide, F.col("hi")).otherwise(F.col("hi") + 0.5).alias("hi"),
    )

    def edge(i: Column) -> Column:
        return F.when(i == bins, F.col("hi")).otherwise(F.col("lo") + i * ((F.col("hi") - F.col("lo")) / bins))

    rough = F.floor((F.col("x") - F.col("lo")) * (F.lit(float(bins)) / (F.col("hi") - F.col("lo"))))
    both = bounds.select(F.struct("lo", "hi").alias("bounds")).scalar()
    placed = values.withColumns({"lo": both["lo"], "hi": both["hi"]})
    placed = placed.withColumn("bin", F.least(F.greatest(rough, F.lit(0)), F.lit(bins - 1)))
    # The division may land one bin off; the edges decide.
    bin_ = F.col("bin")
    exact = F.when(F.col("x") < edge(bin_), bin_ - 1).when(
        (F.col("x") >= edge(bin_ + 1)) & (bin_ < bins - 1), bin_ + 1
    )
    counts = (
        placed.withColumn("bin", exact.otherwise(bin_)).groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    )
    grid = bounds.filter(F.col("lo").isNotNull()).select(
        "lo", "hi", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint"))).alias("bin")
    )
    return grid.join(counts, "bin", "left").select(
        "bin",
        edge(F.col("bin")).alias("low"),
        edge(F.col("bin") + 1).alias("high"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def _per_session_minute(session_events: DataFrame) -> DataFrame:
    """Events per session and minute; the one place where every event is touched."""
    timed = session_events.filter(F.col("ts_dt_utc").isNotNull() & F.col("session_id").isNotNull())
    minute = F.col("ts_dt_utc").cast("timestamp")
    start = F.unix_seconds(minute) - F.pmod(F.unix_seconds(minute), F.lit(MINUTE))
    return timed.groupBy("session_id", F.timestamp_seconds(start).alias("minute")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _minutes_with_score(session_events: DataFrame, scored: DataFrame) -> DataFrame:
    marks = scored.select("session_id", "label", "suspicious_score")
    return _per_session_minute(session_events).join(marks, "session_id", "left")


def timeline_by_label(session_events: DataFrame, scored: DataFrame) -> DataFrame:
    """Events per minute and label, one column per label; events without a label are not counted."""
    known = _minutes_with_score(session_events, scored).filter(F.col("label").isNotNull())
    wide = [F.sum(F.when(F.col("label") == lab, F.col("n")).otherwise(0)).alias(lab) for lab in LABELS]
    return known.groupBy("minute").agg(*wide)


def timeline_intensity(session_events: DataFrame, scored: DataFrame) -> DataFrame:
    """Sum of the events' session scores per minute; events without a score weigh nothing but keep their minute."""
    weight = F.col("n") * F.coalesce("suspicious_score", F.lit(0.0))
    return _minutes_with_score(session_events, scored).groupBy("minute").agg(F.sum(weight).alias("weight"))


def resample(timeline: DataFrame, minutes: int = 5) -> DataFrame:
    """Sums per bucket of ``minutes``, with the empty buckets between the first and the last."""
    width = minutes * MINUTE
    second = F.unix_seconds("minute")
    bucketed = timeline.withColumn("bucket", F.timestamp_seconds(second - F.pmod(second, F.lit(width))))
    sums = bucketed.groupBy("bucket").agg(*[F.sum(lab).alias(lab) for lab in LABELS])
    # The grid grows with the covered time only. One task lists its days, all tasks share the buckets of the days.
    ends = bucketed.agg(F.unix_seconds(F.min("bucket")).alias("first"), F.unix_seconds(F.max("bucket")).alias("last"))
    span = F.lit(max(width, DAY // width * width))
    days = ends.filter(F.col("first").isNotNull()).select("last", F.explode(F.sequence("first", "last", span)).alias("day"))
    until = F.least(F.col("last"), F.col("day") + span - F.lit(width))
    grid = days.repartition("day").select(F.explode(F.sequence("day", until, F.lit(width))).alias("second"))
    grid = grid.select(F.timestamp_seconds("second").alias("bucket"))
    return grid.join(sums, "bucket", "left").na.fill(0, LABELS)


def technique_counts(mapping: DataFrame, n: int = 15) -> DataFrame:
    exploded = mapping.select(F.explode("mapped_techniques").alias("technique_id"))
    return value_counts(exploded, "technique_id", n)


def tactic_counts(mapping: DataFrame, n: int = 15) -> DataFrame:
    exploded = mapping.select(F.explode(F.flatten("mapped_tactics")).alias("tactic"))
    return value_counts(exploded, "tactic", n)


def mapping_features(mapping: DataFrame) -> DataFrame:
    """Per mapped session: how many techniques and tactics, and the hour of day (UTC, 0 where unknown)."""
    hour = F.pmod(F.floor(F.unix_seconds("start_ts") / 3600), F.lit(24))
    tactics = F.aggregate(
        "mapped_tactics", F.lit(0), lambda acc, t: acc + F.when(t.isNull(), 1).otherwise(F.size(t))
    )
    return mapping.select(
        "session_id",
        "label",
        "suspicious_score",
        "confidence",
        F.coalesce(F.size("mapped_techniques"), F.lit(0)).cast("bigint").alias("n_mapped_techniques"),
        F.coalesce(tactics, F.lit(0)).cast("bigint").alias("n_mapped_tactics"),
        F.coalesce(hour, F.lit(0)).cast("bigint").alias("hour_utc"),
    )


def rule_vs_model(scored: DataFrame) -> DataFrame:
    """Points of the rule score / model score chart."""
    return scored.select("label", F.col("rule_score").alias("x"), F.col("ml_score").alias("y"))


def score_vs_confidence(mapping: DataFrame) -> DataFrame:
    """Points of the score / confidence / number of techniques chart."""
    return mapping_features(mapping).select(
        "label",
        F.col("suspicious_score").alias("x"),
        F.col("confidence").alias("y"),
        F.col("n_mapped_techniques").alias("z"),
    )


def hour_vs_confidence(mapping: DataFrame) -> DataFrame:
    """Points of the hour / confidence / score chart."""
    return mapping_features(mapping).select(
        "label",
        F.col("hour_utc").alias("x"),
        F.col("confidence").alias("y"),
        F.col("suspicious_score").alias("z"),
    )


def peek_events(session_events: DataFrame, n: int = 5) -> DataFrame:
    return (
        session_events.orderBy("session_id", "ts", "raw_line")
        .limit(n)
        .select("session_id", "ts", "src_ip", "tool", "indicator_count")
    )


def knowledge_counts(techniques: DataFrame, mitigations: DataFrame) -> DataFrame:
    """Number of techniques, and of technique ids that have mitigations, in one row."""
    have = mitigations.agg(F.count_distinct("technique_id").alias("with_mitigations"))
    return techniques.agg(F.count(F.lit(1)).alias("techniques")).withColumn(
        "with_mitigations", have.scalar()
    )


def knowledge_sample(techniques: DataFrame, n: int = 10) -> DataFrame:
    """The first techniques with an id, in bundle order, to look at beside ``knowledge_counts``."""
    return techniques.filter(F.col("technique_id") != "").orderBy("pos").limit(n)
