from pyspark.sql import functions as F

from sparkwarden.functions import text

ROW = {
    "tool": "curl", "label": "suspicious", "src_ip": "1.2.3.4", "event_count": 7, "rps": 0.123456789, "duration_s": 12.25,
    "unique_ports": 3, "indicator_hits": 2, "ind_lfi_etc_passwd": 1, "ind_path_traversal": 0, "ind_sql_injection": 0,
    "ind_cmd_injection": 1, "ind_wp_probe": 0, "suspicious_score": 0.456, "rule_reasons": ["a", "b c"], "reasons": ["a"],
}
SCHEMA = (
    "tool string, label string, src_ip string, event_count bigint, rps double, duration_s double, unique_ports bigint, "
    "indicator_hits bigint, ind_lfi_etc_passwd bigint, ind_path_traversal bigint, ind_sql_injection bigint, "
    "ind_cmd_injection bigint, ind_wp_probe bigint, suspicious_score double, rule_reasons array<string>, reasons array<string>"
)


def test_session_texts(spark):
    df = spark.createDataFrame([tuple(ROW.values()), (None,) * len(ROW)], SCHEMA)
    texts = [text.behaviour_text(), text.session_index_text(), text.technique_query_text(), text.analyst_query_text()]
    full, empty = df.select(*[t.alias(f"t{i}") for i, t in enumerate(texts)]).collect()
    assert full.t0 == (
        "tool=curl; events=7; duration_s=12.3; rps=0.123; unique_ports=3; indicator_hits=2; etc_passwd=1; traversal=0; "
        "sqli=0; cmdi=1; wp=0"
    )
    assert full.t1 == (
        "Session from 1.2.3.4 tool=curl label=suspicious score=0.46. events=7 duration_s=12.3 rps=0.123. indicators: "
        "hits=2, etc_passwd=1, traversal=0, sqli=0, cmdi=1, wp_probe=0. reasons=['a']"
    )
    assert full.t2 == (
        "tool=curl label=suspicious src_ip=1.2.3.4 event_count=7 rps=0.123457 unique_ports=3 indicator_hits=2 "
        "reasons=['a' 'b c']"
    )
    assert full.t3 == (
        "\nsrc_ip=1.2.3.4 tool=curl label=suspicious\nevent_count=7 rps=0.123457 indicator_hits=2\nreasons=['a' 'b c']\n"
    )
    assert None not in empty and empty.t2.startswith("tool=None label=None") and empty.t2.endswith("reasons=[]")


def test_iso_times(spark):
    cases = {
        "2024-01-02 03:04:05": "2024-01-02T03:04:05+00:00",
        "2024-01-02 03:04:05.5": "2024-01-02T03:04:05.500000+00:00",
        None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "k string")
    rows = df.select("k", text.iso_utc(F.col("k").cast("timestamp")).alias("v")).collect()
    assert {r.k: r.v for r in rows} == cases
