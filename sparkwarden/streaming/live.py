"""The same steps on an endless log: parsing and enrichment are stateless, sessions and timelines keep state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkwarden.functions import ids
from sparkwarden.operators.enrich import enrich_events
from sparkwarden.operators.sessionize import with_event_time
from sparkwarden.schemas import INDICATOR_COLUMNS, SESSIONS
from sparkwarden.sources import raw_log


def live_events(spark: SparkSession, path: str, lateness: str = "10 minutes", files_at_once: int | None = None) -> DataFrame:
    """New log files as enriched events with a watermark."""
    lines = raw_log.stream_raw_lines(spark, path, files_at_once)
    return with_event_time(enrich_events(raw_log.parse_lines(lines))).withWatermark("ts_dt_utc", lateness)


def rows_too_late(query: StreamingQuery) -> int:
    """Rows that reached a stateful step behind its watermark and were left out, over the progress that Spark keeps."""
    operators = [o for p in query.recentProgress for o in p["stateOperators"]]
    return sum(int(o.get("numRowsDroppedByWatermark", 0)) for o in operators)


def live_counts(events: DataFrame) -> DataFrame:
    """Events and indicator hits per minute and tool, final once the watermark has passed."""
    return (
        events.groupBy(F.window("ts_dt_utc", "1 minute"), "tool")
        .agg(F.count(F.lit(1)).alias("events"), F.sum("indicator_count").alias("indicator_hits"))
        .select(F.col("window.start").alias("minute"), "tool", "events", "indicator_hits")
    )


def live_sessions(events: DataFrame, gap_seconds: int = 600, min_events: int = 2) -> DataFrame:
    """Finished sessions. A running number would need all history, so the id is made from the start time.

    State is one small buffer per open session; ports are kept as a set, because exact distinct counts are not
    available on streams.
    """
    sums = [F.sum(F.col(c).cast("bigint")).alias(c) for c in INDICATOR_COLUMNS]
    grouped = events.groupBy("src_ip", "tool", F.session_window("ts_dt_utc", f"{gap_seconds} seconds")).agg(
        F.min("ts_dt_utc").alias("start_ts"),
        F.max("ts_dt_utc").alias("end_ts"),
        F.count(F.lit(1)).alias("event_count"),
        F.size(F.collect_set("src_port")).cast("bigint").alias("unique_ports"),
        F.sum("indicator_count").alias("indicator_hits"),
        *sums,
    )
    name = ids.session_name(F.col("src_ip"), F.col("tool"), F.unix_seconds("start_ts"))
    duration = (F.unix_micros("end_ts") - F.unix_micros("start_ts")) / F.lit(1_000_000.0)
    return (
        grouped.filter(F.col("event_count") >= min_events)
        .withColumn("session_id", ids.uuid5_from_digest(ids.name_digest(name)))
        .withColumn("duration_s", duration)
        .withColumn("rps", F.col("event_count") / F.when(duration == 0.0, 1.0).otherwise(duration))
        .select(*SESSIONS.fieldNames())
    )
