"""Fingerprint and indicator columns for parsed events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwarden.functions import patterns
from sparkwarden.schemas import INDICATOR_COLUMNS


def enrich_events(events: DataFrame) -> DataFrame:
    """Add ``tool``, five ``ind_*`` flags and ``indicator_count``. A narrow, JVM-only projection."""
    parts = [c if c in events.columns else "''" for c in ("raw_line", "action1", "action2")]
    staged = events.withColumn("_text", patterns.search_text(*parts))
    staged = staged.withColumns({"_text_low": F.lower("_text"), "_agent_low": F.lower("user_agent")})
    added = {"tool": patterns.tool_from_agent("user_agent", "_agent_low")}
    for name in patterns.INDICATOR_PATTERNS:
        added[f"ind_{name}"] = patterns.indicator_flag(name, "_text", "_text_low")
    count = " + ".join(f"cast({c} AS bigint)" for c in INDICATOR_COLUMNS)
    flagged = staged.withColumns(added).drop("_text", "_text_low", "_agent_low")
    return flagged.withColumn("indicator_count", F.expr(count))
