"""Readers and writers of the tables between the steps."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwarden import schemas
from sparkwarden.operators.sessionize import SessionConfig, label_events, sessions_from_events
from sparkwarden.session import materialize
from sparkwarden.sources import stix

# Fixed value: rows per file of the session event table.
EVENTS_PER_FILE = 250_000


def write_table(
    df: DataFrame, path: str, rows_per_file: int | None = None, rows_per_group: int | None = None
) -> None:
    """Parquet with zstd, in place of what was there. An empty table still has its schema."""
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if rows_per_group:
        # The writer looks at a group's rows now and then, by default each hundred at least.
        writer = writer.option("parquet.block.row.count.limit", rows_per_group)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, columns: list[str] | None = None
) -> DataFrame:
    """CSV with a header by suffix, Parquet otherwise; a folder of files is one table."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    suffix = path.rstrip("/").lower()
    if suffix.endswith(".csv"):
        df = reader.csv(path, header=True, multiLine=True, escape='"')
    else:
        df = reader.parquet(path)
    return df if columns is None else df.select(*columns)


def write_events(events: DataFrame, path: str, rows_per_group: int | None = None) -> None:
    write_table(schemas.conform(events, schemas.EVENTS), path, rows_per_group=rows_per_group)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.EVENTS)


def write_session_outputs(enriched: DataFrame, out_dir: str, cfg: SessionConfig = SessionConfig()) -> None:
    """Write ``session_events`` and ``sessions``.

    The events are sorted into sessions and written once; the session table is summed up from what was written,
    where a session of any size is combined before its shuffle.
    """
    events_path = f"{out_dir}/session_events"
    write_table(label_events(enriched, cfg), events_path, EVENTS_PER_FILE)
    written = read_table(enriched.sparkSession, events_path, schemas.SESSION_EVENTS)
    write_table(sessions_from_events(written), f"{out_dir}/sessions.parquet")


def read_labels(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A label file with whatever columns it has; columns known to ``schema`` get its types."""
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"')
    known = {f.name: f.dataType for f in schema}
    cols = [F.col(c).try_cast(known[c]).alias(c) if c in known else F.col(c) for c in raw.columns]
    return raw.select(*cols)


def write_template(template: DataFrame, path: str) -> None:
    """A label template as one CSV folder with headers."""
    template.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def write_report(spark: SparkSession, report: dict[str, Any], path: str) -> None:
    """The evaluation report as one JSON document."""
    text = spark.createDataFrame([(json.dumps(report),)], "value string")
    text.coalesce(1).write.mode("overwrite").text(path)


def read_report(spark: SparkSession, path: str) -> dict[str, Any]:
    return json.loads(spark.read.text(path, wholetext=True).first().value)


def build_knowledge(spark: SparkSession, bundle: str, out_dir: str, drop_revoked: bool = False) -> str:
    """Flatten a bundle into the tables ``techniques``, ``mitigations``, ``techniques_by_id``, ``objects_by_id``."""
    typed = materialize(stix.typed_objects(stix.read_bundle(spark, bundle), drop_revoked), "objects")
    write_table(stix.techniques(typed), f"{out_dir}/techniques")
    write_table(stix.mitigations(typed), f"{out_dir}/mitigations")
    write_table(stix.techniques_by_id(stix.techniques(typed)), f"{out_dir}/techniques_by_id")
    write_table(stix.objects_by_id(typed), f"{out_dir}/objects_by_id")
    return out_dir


def read_knowledge(spark: SparkSession, out_dir: str) -> tuple[DataFrame, DataFrame]:
    """(techniques, mitigations)"""
    return (
        read_table(spark, f"{out_dir}/techniques", schemas.TECHNIQUES),
        read_table(spark, f"{out_dir}/mitigations", schemas.MITIGATIONS),
    )
