"""Session sums kept by day, so that a day is added, or written again, without reading the others.

Counts add up, first and last times are least and greatest, and different ports cannot be added: each day keeps them as
bitmaps, one for each 32,768 numbers that occur, which merge bit by bit. Nothing is estimated. Bitmaps are mostly empty
and compress to some bytes; they stand in a table of their own, so that readers of counts do not read them.

    <out>/counts/day=2024-01-31/     session_id, src_ip, tool, first and last time, sums
    <out>/ports/day=2024-01-31/      session_id, bucket, bitmap
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwarden.operators.sessionize import SessionConfig, _finish, _flag_sums
from sparkwarden.schemas import INDICATOR_COLUMNS

SUMS = ["event_count", "indicator_hits", *INDICATOR_COLUMNS]
COUNTS = "session_id string, src_ip string, tool string, start_ts timestamp, end_ts timestamp, " + ", ".join(f"{c} bigint" for c in SUMS) + ", day date"
PORTS = "session_id string, bucket bigint, bitmap binary, day date"


def _day(events: DataFrame) -> DataFrame:
    return events.withColumn("day", F.to_date("ts_dt_utc"))


def counts_by_day(session_events: DataFrame) -> DataFrame:
    """One row for each session and day."""
    return _day(session_events).groupBy("session_id", "day").agg(
        F.min("src_ip").alias("src_ip"),
        F.min("tool").alias("tool"),
        F.min("ts_dt_utc").alias("start_ts"),
        F.max("ts_dt_utc").alias("end_ts"),
        F.count(F.lit(1)).alias("event_count"),
        *_flag_sums(),
    )


def ports_by_day(session_events: DataFrame) -> DataFrame:
    """One bitmap for each session, day and 32,768 port numbers that occur; combined before the shuffle."""
    known = _day(session_events).filter(F.col("src_port").isNotNull())
    placed = known.withColumn("bucket", F.bitmap_bucket_number("src_port"))
    return placed.groupBy("session_id", "day", "bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position("src_port")).alias("bitmap"))


def write_days(session_events: DataFrame, out: str) -> None:
    """Write the days of these events, in place of what these days had; other days are not touched.

    The events have to hold whole days.
    """
    for name, rows in (("counts", counts_by_day(session_events)), ("ports", ports_by_day(session_events))):
        writer = rows.repartition("day", F.pmod(F.xxhash64("session_id"), F.lit(16))).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("day").parquet(f"{out}/{name}")


def read_days(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    """(counts, ports) of all days; filters on ``day`` leave out whole folders."""
    return spark.read.schema(COUNTS).parquet(f"{out}/counts"), spark.read.schema(PORTS).parquet(f"{out}/ports")


def merged_sessions(counts: DataFrame, ports: DataFrame) -> DataFrame:
    """One row per session from its days, with the columns of ``sessions``."""
    whole = ports.groupBy("session_id", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    number = whole.groupBy("session_id").agg(F.sum(F.bitmap_count("bitmap")).alias("unique_ports"))
    sums = counts.groupBy("session_id").agg(
        F.min("src_ip").alias("src_ip"),
        F.min("tool").alias("tool"),
        F.min("start_ts").alias("start_ts"),
        F.max("end_ts").alias("end_ts"),
        *[F.sum(c).alias(c) for c in SUMS],
    )
    joined = sums.join(number, "session_id", "left").withColumn("unique_ports", F.coalesce("unique_ports", F.lit(0).cast("bigint")))
    return _finish(joined, SessionConfig(min_events=1))
