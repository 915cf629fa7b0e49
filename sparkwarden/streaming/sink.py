"""A log stream written exactly once: events, lines that are none, and events that came too late.

    <out>/events/batch=7/   events in time            <out>/rejects/batch=7/   other lines, with the reason
    <out>/late/batch=7/     events behind the mark    <out>/marks/7.json       the mark after batch 7

The mark is the highest event time of all batches up to this one, less ``lateness``. A batch writes its own folders anew
each time it runs, looks at the mark of the batch before it, and writes its own mark last. A batch that Spark runs again
after a crash therefore leaves what it would have left the first time, and readers see the batches that have a mark.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from sparkwarden.operators.sessionize import MAX_TIME, MIN_TIME
from sparkwarden.schemas import EVENTS
from sparkwarden.sources import raw_log

KINDS = {"events": EVENTS.simpleString(), "late": EVENTS.simpleString(), "rejects": "struct<raw_line:string,reason:string>"}


class Sink:
    """What ``foreachBatch`` calls."""

    def __init__(self, out: str, lateness_s: int = 600, column: str = "value") -> None:
        self.out, self.lateness_s, self.column = out, lateness_s, column

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = marks(spark, self.out).get(number - 1)
        lines = batch.select(self.column).persist()
        try:
            events = raw_log.parse_lines(lines, self.column)
            second = F.when(F.col("ts").between(MIN_TIME, MAX_TIME), F.unix_seconds(F.rtrim("ts", F.lit("Z")).try_cast("timestamp")))
            # An event without a real time is never late: there is nothing to compare.
            late = F.coalesce(second < (before - self.lateness_s), F.lit(False)) if before is not None else F.lit(False)
            self._write(events.filter(~late), "events", number)
            self._write(events.filter(late), "late", number)
            self._write(raw_log.rejected_lines(lines, self.column), "rejects", number)
            highest = events.agg(F.max(second)).first()[0]
        finally:
            lines.unpersist()
        known = [x for x in (before, highest) if x is not None]
        _write_text(spark, f"{self.out}/marks/{number}.json", json.dumps({"mark": max(known) if known else None}))

    def _write(self, df: DataFrame, kind: str, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.out}/{kind}/batch={number}")


def writer(lines: DataFrame, out: str, lateness_s: int = 600) -> DataStreamWriter:
    """A stream of raw lines on its way to ``out``; give it a checkpoint and a trigger, and start it."""
    return lines.writeStream.foreachBatch(Sink(out, lateness_s))


def _fs(spark: SparkSession, path: str) -> tuple[Any, Any]:
    made = spark._jvm.org.apache.hadoop.fs.Path(path)
    return made.getFileSystem(spark._jsc.hadoopConfiguration()), made


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, there as a whole or not at all."""
    files, fresh = _fs(spark, f"{path}.new")
    out = files.create(fresh, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    _, place = _fs(spark, path)
    files.delete(place, False)
    if not files.rename(fresh, place):
        raise OSError(f"{path} could not be written")


def marks(spark: SparkSession, out: str) -> dict[int, int | None]:
    """The mark of each complete batch; one small file for a batch."""
    files, folder = _fs(spark, f"{out}/marks")
    if not files.exists(folder):
        return {}
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    if not any(n.endswith(".json") for n in names):
        return {}
    rows = spark.read.text(f"{out}/marks/*.json", wholetext=True).select("value", F.input_file_name().alias("file")).collect()
    return {int(r.file.rsplit("/", 1)[1][:-5]): json.loads(r.value)["mark"] for r in rows}


def read(spark: SparkSession, out: str, kind: str) -> DataFrame:
    """``events``, ``late`` or ``rejects`` of all complete batches, with their ``batch``."""
    paths = [f"{out}/{kind}/batch={n}" for n in sorted(marks(spark, out))]
    if not paths:
        return spark.createDataFrame([], KINDS[kind]).withColumn("batch", F.lit(0).cast("bigint"))
    rows = spark.read.option("basePath", f"{out}/{kind}").parquet(*paths)
    return rows.withColumn("batch", F.col("batch").cast("bigint"))
