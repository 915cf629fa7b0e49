"""Log lines and parsed events derived from the shared ``events`` table (rules in FIXTURES.md, section 6).

One user in ten is folded into one fast source, 10.0.0.0, which then owns a tenth of all rows within seconds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwarden.operators.sessionize import SessionConfig
from sparkwarden.session import spread

EPOCH = 1704067200  # 2024-01-01T00:00:00Z, the first day of the table
SESSION_GAP = 21_600
CONFIG = SessionConfig(gap_seconds=SESSION_GAP, min_events=2)

AGENTS = {
    0: "gobuster/3.1",
    1: "DirBuster-1.0",
    2: "curl/8.4.0",
    3: "python-requests/2.31",
    4: "sqlmap/1.7",
    5: None,
}
OTHER_AGENT = "Mozilla/5.0 (X11)"

ACTIONS = {0: "/etc/passwd", 1: "../../app.ini", 2: "q=1 UNION all", 3: "x|id", 4: "/wp-login.php", 5: "x||id"}
OTHER_ACTION = "/index.html"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _choice(key: str, values: dict[int, str | None], other: str) -> str:
    cases = [f"WHEN {n} THEN " + ("cast(null AS string)" if v is None else f"'{v}'") for n, v in values.items()]
    return f"CASE {key} {' '.join(cases)} ELSE '{other}' END"


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spread(read_table(spark, sf_dir, "events").select("event_id", "user_id", "ts"), "event_id")
    offset = f"(unix_seconds(cast(ts AS timestamp)) - {EPOCH})"
    return events.selectExpr(
        "event_id",
        f"timestamp_seconds({EPOCH} + IF(user_id % 10 = 0, {offset} div 200000, {offset})) AS time",
        "IF(user_id % 10 = 0, '10.0.0.0', concat('10.0.', user_id div 256, '.', user_id % 256)) AS src_ip",
        "cast(1024 + (event_id * 7919) % 64000 AS bigint) AS src_port",
        _choice("user_id % 10", AGENTS, OTHER_AGENT) + " AS user_agent",
        _choice("event_id % 41", ACTIONS, OTHER_ACTION) + " AS action2",
    ).selectExpr("*", "date_format(time, 'yyyy-MM-dd HH:mm:ss') AS time_text")


LINE = "to_json(array(cast(null AS string), action2, time_text, src_ip, cast(src_port AS string), user_agent))"


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the parser would give them, plus ``event_id``."""
    return _base(spark, sf_dir).selectExpr(
        "event_id",
        "concat(substring(time_text, 1, 10), 'T', substring(time_text, 12), 'Z') AS ts",
        "src_ip",
        "src_port",
        "user_agent",
        "cast(null AS string) AS lang",
        "cast(null AS string) AS action1",
        "action2",
        "cast(null AS string) AS extra",
        f"{LINE} AS raw_line",
    )


def clean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _base(spark, sf_dir).selectExpr(f"{LINE} AS value")


# What happens to a line, by event_id % 31: text around it, or other JSON in place of its port or its tail.
LINE_FORMS = {
    1: "  {line}\t",
    2: "{line} tail",
    3: "{line},{line}",
    4: "",
    5: "not json",
    6: '{"a":1}',
    7: "[1,2]",
    8: "[{head},64940.9,{agent}]",
    9: "[{head},true,{agent}]",
    10: '[{head}," 42 ",{agent}]',
    11: '[{head},"12.5",{agent}]',
    12: '[{head},"1_000",{agent}]',
    13: '[{head},null,{agent},"en","{ip}"]',
    14: '[{head},[1],{agent},5,{"k":[1,2]},"ninth"]',
    15: '[1,{"a":1},"{time}",5,true,7]',
    16: '["a","b",null,"{ip}","1","UA"]',
    17: '["a","b","{time}Z","{ip}","1","UA"]',
    18: '["a","b","2024-13-01 00:00:00","{ip}","1","UA"]',
    19: "['a','b','{time}','{ip}','1','UA']",
    20: "{line}]",
    21: '["a ] b","b","{time}","{ip}","-7","UA; x"]',
    22: "[{head},1,{agent},]",
}


def messy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a line, most of them well formed, each with its ``event_id``."""
    base = _base(spark, sf_dir)
    fields = {
        "{line}": F.expr(LINE),
        "{head}": F.expr("""concat('null,"', action2, '","', time_text, '","', src_ip, '"')"""),
        "{agent}": F.expr("""coalesce(concat('"', user_agent, '"'), 'null')"""),
        "{ip}": F.col("src_ip"),
        "{time}": F.col("time_text"),
    }
    form = F.pmod(F.col("event_id"), F.lit(31))
    template = F.lit("{line}")
    for number, text in LINE_FORMS.items():
        template = F.when(form == number, text).otherwise(template)
    value = template
    for name, column in fields.items():
        value = F.replace(value, F.lit(name), column)
    return base.select("event_id", value.alias("value"))
