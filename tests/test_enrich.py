import re

from sparkwarden.functions import patterns
from sparkwarden.operators.enrich import enrich_events
from sparkwarden.schemas import INDICATOR_COLUMNS

AGENTS = {
    "DirBuster-1.0": "dirbuster", "x GOBUSTER/3": "gobuster", "Nikto": "nikto", "SQLMap/1": "sqlmap",
    "curl/8": "curl", "xcurl/8": "browser/unknown", "a-curl/8": "curl", "_curl/1": "browser/unknown",
    "Wget/1.2": "wget", "xwget/1": "browser/unknown", "python-requests/2": "python-requests",
    "Go-http-client/1.1": "go-http-client", "nikto curl/ gobuster": "gobuster", "": "browser/unknown", None: "browser/unknown",
    "Mozilla": "browser/unknown", "éCURL/8": "browser/unknown", "é curl/8": "curl", "ſqlmap": "sqlmap", "niKto": "nikto",
}

TEXTS = [
    "/ETC/passwd", "a../b", "%2E%2e%2F", "%2e%2e/", "..%2f", "..\\x", "%5C", "q=1 UNION all", "reunion", "SELECT*",
    "selected", "drop", "or 1=1", "or   1=1", "xor 1=1", "for 1=1", "or\x1f1=1", "é or 1=1", "%27", "%22", "a;b", "a|b",
    "||", "`id`", "$(id)", "$ (", "%3B", "%7c", "/WP-ADMIN", "wp-login.php", "wp-loginxphp", "xmlrpc.php", "plain", "ünion union",
    "ſelect", "DROP TABLE é", "it's '1'",
]


def events(spark, rows):
    return spark.createDataFrame(rows, "raw_line string, user_agent string, action1 string, action2 string")


def test_tools(spark):
    rows = enrich_events(events(spark, [("l", a, None, None) for a in AGENTS])).collect()
    assert {r.user_agent: r.tool for r in rows} == AGENTS


def test_indicators_match_python_regex(spark):
    rows = enrich_events(events(spark, [(t, "UA", None, "x") for t in TEXTS])).collect()
    for row in rows:
        text = f"{row.raw_line}  x"
        want = [bool(re.search(p, text, re.I)) for p in patterns.INDICATOR_PATTERNS.values()]
        assert [row[c] for c in INDICATOR_COLUMNS] == want, row.raw_line
        assert row.indicator_count == sum(want)


# Written by hand: a lone pipe is no command, a pipe before a backtick or doubled is.
FLAGS = {
    "ind_cmd_injection": {
        "a|b": False, "x | id": False, "a||b": True, "|`id`": True, "`id`": True, "$(id)": True, "$ (id)": False, "a;b": True,
        "%7C": True, "%3b": True, "plain": False,
    },
    "ind_path_traversal": {
        "../x": True, "..%2f": True, "..%2Fx": True, "%2e%2e%2f": True, "%2e%2e/": True, "..\\x": True, "%5c": True, "..x": False,
        "./x": False, "%2e/": False,
    },
    "ind_sql_injection": {
        "union all": True, "reunion": False, "select*": True, "selected": False, "or 1=1": True, "or  1=1": True, "or1=1": False,
        "1=1": False, "%27": True, "%22": True, "drop": True, "dropped": False,
    },
    "ind_wp_probe": {"/wp-admin/": True, "wp-login.php": True, "wp-loginxphp": False, "xmlrpc.php": True, "xmlrpcphp": False},
    "ind_lfi_etc_passwd": {"/etc/passwd": True, "/ETC/PASSWD": True, "etc/passwd": False, "/etc/shadow": False},
}


def test_indicators_by_hand(spark):
    for column, cases in FLAGS.items():
        for text in ("{}", "é {}"):  # both ways: substring search and regular expression
            rows = enrich_events(events(spark, [(text.format(t), "UA", None, None) for t in cases])).collect()
            assert {r.raw_line: r[column] for r in rows} == {text.format(t): f for t, f in cases.items()}


def test_match_across_fields_and_null_fields(spark):
    rows = enrich_events(events(spark, [("x or", None, "1=1", None), ("x or", None, None, "1=1"), ("x", None, None, None)]))
    assert [r.ind_sql_injection for r in rows.collect()] == [True, True, False]


def test_missing_action_columns(spark):
    df = events(spark, [("a;b", "curl/8", "x", "y")]).drop("action1", "action2")
    row = enrich_events(df).first()
    assert row.ind_cmd_injection and row.tool == "curl"


def test_no_python_in_plan(spark):
    plan = enrich_events(events(spark, [("l", "a", "b", "c")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
