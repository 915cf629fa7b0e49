"""Gap sessionization of enriched events per (source, tool).

Two events in the same stretch of ``gap_seconds`` are never further apart than the gap, hence always in one session. So
events are reduced before any shuffle to one row per stretch (earliest and latest time), the stretches are numbered by a
window, and the number is joined back. A source that holds a third of all events, even within one second, is a few rows
to the window; there is one plan for all sources. Below a gap of one second every time is a stretch of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkwarden.functions import ids
from sparkwarden.schemas import INDICATOR_COLUMNS, SESSION_EVENTS, SESSIONS, conform

KEYS = ["src_ip", "tool"]

# Times outside the range of 64-bit nanoseconds count as unparsable (compared as ISO text).
MIN_TIME = "1677-09-21T00:12:44Z"
MAX_TIME = "2262-04-11T23:47:16Z"

UTC_NAMES = {"UTC", "Etc/UTC", "Z", "+00:00", "GMT"}


@dataclass(frozen=True)
class SessionConfig:
    gap_seconds: int = 600
    min_events: int = 2

    @property
    def gap_us(self) -> int:
        return int(self.gap_seconds * 1_000_000)


def with_event_time(events: DataFrame) -> DataFrame:
    """Add ``ts_dt_utc``; events without a real time or a source are dropped.

    Without its ``Z`` a time is read much faster, in the session's time zone, which therefore has to be UTC.
    """
    zone = events.sparkSession.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_NAMES:
        raise ValueError(f"the session time zone is {zone}, but must be UTC (see sparkwarden.session.configure)")
    in_range = F.col("ts").between(MIN_TIME, MAX_TIME)
    timed = events.withColumn("ts_dt_utc", F.rtrim("ts", F.lit("Z")).try_cast("timestamp"))
    return timed.filter(in_range & F.col("ts_dt_utc").isNotNull() & F.col("src_ip").isNotNull())


def _with_stretch(timed: DataFrame, cfg: SessionConfig) -> DataFrame:
    """``_slot``: start of the stretch an event falls in."""
    micros = F.unix_micros("ts_dt_utc")
    start = micros - F.pmod(micros, F.lit(cfg.gap_us)) if cfg.gap_us >= 1_000_000 else micros
    # Never null; said aloud, so that no reader of these rows gets a filter of its own from a join.
    return timed.withColumn("_slot", start).where("_slot is not null")


def _numbered(stretches: DataFrame, cfg: SessionConfig) -> DataFrame:
    """Add ``session_idx``, which grows where a stretch starts too long after the end of the one before."""
    ordered = Window.partitionBy(*KEYS).orderBy("_slot")
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    gap = F.unix_micros("_first") - F.unix_micros("_before")
    opens = F.when(F.col("_before").isNull() | (gap > cfg.gap_us), 1).otherwise(0)
    return (
        stretches.withColumn("_before", F.lag("_last").over(ordered))
        .withColumn("_opens", opens)
        .withColumn("session_idx", F.sum("_opens").over(running).cast("bigint"))
        .drop("_before", "_opens")
    )


def _by_stretch(rows: DataFrame, numbered: DataFrame) -> DataFrame:
    """``rows`` with what their stretch was given; a null tool is a tool like any other."""
    names = [c for c in numbered.columns if c not in (*KEYS, "_slot")]
    of = numbered.select(F.col("src_ip").alias("_ip"), F.col("tool").alias("_tool"), F.col("_slot").alias("_of"), *names)
    same = (F.col("src_ip") == F.col("_ip")) & F.col("tool").eqNullSafe(F.col("_tool")) & (F.col("_slot") == F.col("_of"))
    return rows.join(of, same).drop("_ip", "_tool", "_of")


def assign_sessions(timed: DataFrame, cfg: SessionConfig) -> DataFrame:
    """Every event with its 1-based ``session_idx`` and the ``session_size`` of that session."""
    slotted = _with_stretch(timed, cfg)
    stretches = slotted.groupBy(*KEYS, "_slot").agg(
        F.min("ts_dt_utc").alias("_first"), F.max("ts_dt_utc").alias("_last"), F.count(F.lit(1)).alias("_n")
    )
    per_session = Window.partitionBy(*KEYS, "session_idx")
    sized = _numbered(stretches, cfg).withColumn("session_size", F.sum("_n").over(per_session))
    # Broadcast if the stretches turn out small; otherwise adaptive execution splits a hot stretch.
    return _by_stretch(slotted, sized.select(*KEYS, "_slot", "session_idx", "session_size")).drop("_slot")


def with_session_id(df: DataFrame) -> DataFrame:
    name = ids.session_name(F.col("src_ip"), F.col("tool"), F.col("session_idx"))
    staged = df.withColumn("_digest", ids.name_digest(name))
    return staged.withColumn("session_id", ids.uuid5_from_digest(F.col("_digest"))).drop("_digest")


def label_events(events: DataFrame, cfg: SessionConfig = SessionConfig()) -> DataFrame:
    """Events of the sessions that have at least ``min_events``, with their session id."""
    assigned = assign_sessions(with_event_time(events), cfg)
    if cfg.min_events > 1:
        assigned = assigned.filter(F.col("session_size") >= cfg.min_events)
    return conform(with_session_id(assigned), SESSION_EVENTS)


def _flag_sums() -> list[Column]:
    cols = ["indicator_count", *INDICATOR_COLUMNS]
    names = ["indicator_hits", *INDICATOR_COLUMNS]
    return [F.sum(F.col(c).cast("bigint")).alias(n) for c, n in zip(cols, names)]


def _finish(grouped: DataFrame, cfg: SessionConfig) -> DataFrame:
    """Rates, the small-session filter and the declared column order."""
    if cfg.min_events > 1:
        grouped = grouped.filter(F.col("event_count") >= cfg.min_events)
    span = (F.unix_micros("end_ts") - F.unix_micros("start_ts")) / F.lit(1_000_000.0)
    out = grouped.withColumn("duration_s", F.greatest(span, F.lit(0.0)))
    seconds = F.when(F.col("duration_s") == 0.0, 1.0).otherwise(F.col("duration_s"))
    return out.withColumn("rps", F.col("event_count") / seconds).select(*SESSIONS.fieldNames())


def build_sessions(events: DataFrame, cfg: SessionConfig = SessionConfig()) -> DataFrame:
    """One row per session, straight from enriched events, which are read once."""
    slotted = _with_stretch(with_event_time(events), cfg)
    # One row per stretch and port before anything is shuffled: counts and sums are final from here on.
    reduced = slotted.groupBy(*KEYS, "_slot", "src_port").agg(
        F.min("ts_dt_utc").alias("_first"),
        F.max("ts_dt_utc").alias("_last"),
        F.count(F.lit(1)).alias("_n"),
        *_flag_sums(),
    )
    # Both readers of ``reduced`` ask for all of its columns: only then is it one exchange, and the events are read once.
    sums = ["_n", "indicator_hits", *INDICATOR_COLUMNS]
    stretches = reduced.groupBy(*KEYS, "_slot").agg(
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
        F.count("src_port").alias("_ports"),
        F.sum(sum((F.coalesce(c, F.lit(0)) for c in sums), F.lit(0))).alias("_all"),
    )
    numbered = _numbered(stretches, cfg).where(F.col("_all") + F.col("_ports") > 0).select(*KEYS, "_slot", "session_idx")
    grouped = (
        _by_stretch(reduced, numbered)
        .groupBy(*KEYS, "session_idx")
        .agg(
            F.min("_first").alias("start_ts"),
            F.max("_last").alias("end_ts"),
            F.sum("_n").alias("event_count"),
            F.count_distinct("src_port").alias("unique_ports"),
            *[F.sum(c).alias(c) for c in ("indicator_hits", *INDICATOR_COLUMNS)],
        )
    )
    return _finish(with_session_id(grouped), cfg)


def sessions_from_events(session_events: DataFrame) -> DataFrame:
    """One row per session from labelled events, for use on the written event table."""
    grouped = session_events.groupBy("session_id").agg(
        F.min("src_ip").alias("src_ip"),
        F.min("tool").alias("tool"),
        F.min("ts_dt_utc").alias("start_ts"),
        F.max("ts_dt_utc").alias("end_ts"),
        F.count(F.lit(1)).alias("event_count"),
        F.count_distinct("src_port").alias("unique_ports"),
        *_flag_sums(),
    )
    return _finish(grouped, SessionConfig(min_events=1))
