"""Sentences about sessions and techniques that are embedded. Numbers print with fixed decimals.

The wording of the sentences is a fixed value: embeddings and results depend on it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How many mitigations a technique's text and its payload name.
MITIGATIONS_IN_TEXT = 8
MITIGATIONS_IN_PAYLOAD = 20


def _count(name: str) -> Column:
    return F.coalesce(F.col(name).cast("bigint"), F.lit(0)).cast("string")


def _number(value: Column, decimals: int) -> Column:
    return F.format_string(f"%.{decimals}f", F.coalesce(value.cast("double"), F.lit(0.0)))


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("None"))


def printed_list(items: Column) -> Column:
    """A list printed on one line as ``['a' 'b']``."""
    quoted = F.transform(F.coalesce(items, F.array().cast("array<string>")), lambda r: F.concat(F.lit("'"), r, F.lit("'")))
    return F.concat(F.lit("["), F.array_join(quoted, " "), F.lit("]"))


def _sentence(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def behaviour_text() -> Column:
    """What the anomaly model reads about a session."""
    return _sentence(
        "tool=", F.coalesce(F.col("tool"), F.lit("")),
        "; events=", _count("event_count"),
        "; duration_s=", _number(F.col("duration_s"), 1),
        "; rps=", _number(F.col("rps"), 3),
        "; unique_ports=", _count("unique_ports"),
        "; indicator_hits=", _count("indicator_hits"),
        "; etc_passwd=", _count("ind_lfi_etc_passwd"),
        "; traversal=", _count("ind_path_traversal"),
        "; sqli=", _count("ind_sql_injection"),
        "; cmdi=", _count("ind_cmd_injection"),
        "; wp=", _count("ind_wp_probe"),
    )


def session_index_text() -> Column:
    """What the session collection stores as a vector."""
    return _sentence(
        "Session from ", _text("src_ip"),
        " tool=", _text("tool"),
        " label=", _text("label"),
        " score=", _number(F.col("suspicious_score"), 2),
        ". events=", _count("event_count"),
        " duration_s=", _number(F.col("duration_s"), 1),
        " rps=", _number(F.col("rps"), 3),
        ". indicators: hits=", _count("indicator_hits"),
        ", etc_passwd=", _count("ind_lfi_etc_passwd"),
        ", traversal=", _count("ind_path_traversal"),
        ", sqli=", _count("ind_sql_injection"),
        ", cmdi=", _count("ind_cmd_injection"),
        ", wp_probe=", _count("ind_wp_probe"),
        ". reasons=", printed_list(F.col("reasons")),
    )


def technique_query_text() -> Column:
    """What a session asks the technique collection."""
    return _sentence(
        "tool=", _text("tool"),
        " label=", _text("label"),
        " src_ip=", _text("src_ip"),
        " event_count=", _count("event_count"),
        " rps=", _number(F.col("rps"), 6),
        " unique_ports=", _count("unique_ports"),
        " indicator_hits=", _count("indicator_hits"),
        " reasons=", printed_list(F.col("rule_reasons")),
    )


def analyst_query_text() -> Column:
    """The several-line form used for one-off searches."""
    return _sentence(
        "\nsrc_ip=", _text("src_ip"),
        " tool=", _text("tool"),
        " label=", _text("label"),
        "\nevent_count=", _count("event_count"),
        " rps=", _number(F.col("rps"), 6),
        " indicator_hits=", _count("indicator_hits"),
        "\nreasons=", printed_list(F.col("rule_reasons")),
        "\n",
    )


def technique_text(mitigation_names: Column) -> Column:
    """What the technique collection stores as a vector."""
    blank = F.lit("")
    return _sentence(
        F.coalesce(F.col("technique_id"), blank), " ",
        F.coalesce(F.col("name"), blank),
        ". Tactics: ", F.array_join(F.coalesce(F.col("tactics"), F.array().cast("array<string>")), ", "),
        ". Description: ", F.replace(F.coalesce(F.col("description"), blank), F.lit("\n"), F.lit(" ")),
        " Mitigations: ", F.array_join(F.slice(mitigation_names, 1, MITIGATIONS_IN_TEXT), "; "),
    )


def iso_utc(ts: Column) -> Column:
    """ISO text with offset, microseconds only where there are any; null stays null."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    part = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    fraction = F.when(part != 0, F.concat(F.lit("."), F.lpad(part.cast("string"), 6, "0"))).otherwise("")
    return F.concat(whole, fraction, F.lit("+00:00"))
