"""One explicit schema per table, so that no reader or writer has to infer one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INDICATOR_COLUMNS = [
    "ind_lfi_etc_passwd",
    "ind_path_traversal",
    "ind_sql_injection",
    "ind_cmd_injection",
    "ind_wp_probe",
]


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
    "array<array<string>>": T.ArrayType(T.ArrayType(T.StringType())),
}


def _struct(columns: str) -> T.StructType:
    """``name type [not null], ...`` without a running session."""
    out = T.StructType()
    for column in columns.split(", "):
        name, kind, *rest = column.split(" ")
        out.add(name, _TYPES[kind], nullable=not rest)
    return out


EVENTS = _struct(
    "ts string not null, src_ip string, src_port bigint, user_agent string, lang string, "
    "action1 string, action2 string, extra string, raw_line string not null"
)

_FLAGS = ", ".join(f"{c} boolean" for c in INDICATOR_COLUMNS)
_COUNTS = ", ".join(f"{c} bigint" for c in INDICATOR_COLUMNS)

ENRICHED = _struct(
    ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EVENTS)
    + f", tool string, {_FLAGS}, indicator_count bigint"
)

SESSIONS = _struct(
    "session_id string, src_ip string, tool string, start_ts timestamp, end_ts timestamp, "
    f"event_count bigint, unique_ports bigint, indicator_hits bigint, {_COUNTS}, "
    "duration_s double, rps double"
)

SESSION_EVENTS = _struct(
    "session_id string, ts string, ts_dt_utc timestamp, src_ip string, src_port bigint, tool string, "
    f"user_agent string, action1 string, action2 string, extra string, indicator_count bigint, {_FLAGS}, "
    "raw_line string"
)

SCORED = T.StructType(
    SESSIONS.fields
    + _struct(
        "rule_score double, rule_reasons array<string>, ml_score double, suspicious_score double, "
        "label string, reasons array<string>"
    ).fields
)

TECHNIQUES = _struct(
    "pos bigint, stix_id string, technique_id string, name string, description string, "
    "tactics array<string>, is_subtechnique boolean, platforms array<string>"
)

MITIGATIONS = _struct("technique_id string, ord bigint, stix_id string, name string, description string")

MAPPING = _struct(
    "session_id string, src_ip string, label string, tool string, suspicious_score double, "
    "start_ts timestamp, summary string, mapped_techniques array<string>, mapped_names array<string>, "
    "mapped_tactics array<array<string>>, confidence double, why array<string>"
)

DETECTION_LABELS = _struct(
    "session_id string, pred_label string, suspicious_score double, tool string, src_ip string, "
    "rule_reasons string, true_label string"
)

MAPPING_LABELS = _struct(
    "session_id string, pred_mapped_techniques string, pred_mapped_names string, pred_confidence double, "
    "pred_why string, summary string, true_technique_ids string"
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema``, in its order: missing ones become null, others are cast where that works."""
    present = set(df.columns)
    cols: list[Column] = []
    for field in schema:
        if field.name not in present:
            col = F.lit(None).cast(field.dataType)
        elif df.schema[field.name].dataType == field.dataType:
            col = F.col(field.name)
        elif df.schema[field.name].dataType == T.StringType():
            col = F.col(field.name).try_cast(field.dataType)
        else:
            col = F.col(field.name).cast(field.dataType)
        cols.append(col.alias(field.name))
    return df.select(*cols)


def require_columns(df: DataFrame, names: list[str], what: str) -> None:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"{what} missing columns: {missing}")
