import html
import random
from urllib.parse import urljoin

from pyspark.sql import functions as F

from sparkwarden.llm import url_filter as U
from sparkwarden.llm.oracle import SQL
from tests.llm.fixtures import rows_of, rows_of_sql, written

CANONICAL = '<html><head><link rel="canonical" href="{}"></head>'
REFRESH = "<meta content='0; url={}' http-equiv=refresh>"
PAGES = [
    (1, "https://www.example.com/en/a", None),
    (2, "http://Blog.Example.COM/en/a?x=1#f", ""),
    (3, "https://x.net/es/1", "<p>"),
    (4, "https://x.net/en/1", "<p>"),
    (5, None, CANONICAL.format("https://x.net/es/1")),
    (6, "no scheme", CANONICAL.format("https://x.net/es/1")),
    (7, "https://a.org/1", CANONICAL.format("https://b.org/1")),
    (8, "http://b.org/1#top", REFRESH.format("/2")),
    (9, "https://b.org/2", CANONICAL.format("http://y.net/fr/9?a=1&amp;b=2")),
    (10, "https://shop.com/x", CANONICAL.format("https://x.net/es/7")),
    (11, "https://c.org/d/e", REFRESH.format("f")),
    (12, "https://c.org/d/f", '<LINK HREF=//z.org/q rel=canonical>'),
    (13, "https://z.org/q", "<link rel=stylesheet href=https://x.net/es/1>"),
    (14, "https://example.net?u=https://x.net/es/1", None),
    (15, "https://net/es/", None),
    (16, "https://planet/es/", None),
    (7, "https://a.org/1", "canonical"),
]


def test_rules_edges_and_sql(spark, tmp_path):
    folder = written(spark, tmp_path, pages=([(*p, "x", "y") for p in PAGES], "page_id long, url string, html string, place string, rule string"))
    found = U.op4_url_filter(spark, folder)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    rows = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found.collect()}
    assert rows[1] == ("www.example.com", "/en/a", "www.example.com/en/", "allow")
    assert rows[2] == ("blog.example.com", "/en/a", "example.com/en/", "block")
    assert rows[3] == ("x.net", "/es/1", "net/es/", "block")
    assert rows[4] == ("x.net", "/en/1", None, "allow")
    assert rows[5] == rows[6] == ("", "", None, "allow")
    # A chain of canonical, redirect, canonical ends in a blocked address that was never crawled.
    assert [rows[i][2:] for i in (7, 8, 9)] == [(None, "block")] * 3
    # An explicit allow goes before the block of an alias.
    assert rows[10][2:] == ("com/", "allow")
    assert [rows[i][3] for i in (11, 12, 13, 14, 16)] == ["allow"] * 5
    assert rows[15][2:] == ("net/es/", "block")
    assert sum(r.page_id == 7 for r in found.collect()) == 2
    assert rows_of(found) == rows_of_sql(folder, SQL["op4_url_filter"], "pages")


BASES = ["https://H.org/a/b/c?q=1", "http://h.org", "http://h.org/", "http://h.org/x/y/", "https://h.org/a/../b/c#f", "http://h.org?u=/v/w"]
TARGETS = [
    "g", "./g", "g/", "/g", "//Other.org/p/q", "?y", "g?y", "#s", "g#s", "g?y#s", "..", "../", "../g", "../..", "../../g", "../../../../g",
    "/./g", "/../g", "g.", "..g", "g..", "./../g", "./g/.", "g/./h", "g/../h", "g;x=1/../y", "g?y/../x", "https://o.net/es/1?a=1&b=2",
    "x&y", "a.html?u=http://z.org/", " g ", "é/ü", "mailto:a@b.org", "javascript:void(0)", "", "....", ".", "HTTPS://O.net/a",
]


def place(url):
    rest = url.split("://", 1)[1].split("#")[0]
    host = rest.split("?")[0].split("/")[0]
    return host.lower() + rest[len(host) :]


def test_links_are_resolved_like_the_standard_library_does(spark):
    pages, want = [], set()
    for base in BASES:
        for target in TARGETS:
            for page in (f'<link href="{html.escape(target)}" rel="canonical">', f"<base href=\"../k/m\"><link rel=canonical href='{target}'>"):
                pages.append((len(pages), base, page))
                onto = urljoin(base, "../k/m") if "<base" in page else base
                full = urljoin(onto, target.strip())
                # A page's address without a path is kept as it is.
                if target and "://" in full and place(full) != place(base):
                    want.add((place(base), place(full)))
    found = U.redirect_edges(spark.createDataFrame(pages, "page_id long, url string, html string"))
    got = {tuple(r) for r in found.collect()}
    assert got == want and len(want) > 150


def test_aliases_in_every_notation(spark, tmp_path):
    blocked = [("https://x.net/es/p", None), ("https://x.net/es/p?x=1", None)]
    aliases = [
        "//x.net/es/p", "https://x.net/./es/../es/p", "https&#58;//x.net/es/p", "https:&#x2F;/x.net/es/p", "https://X.NET/es/p#top", "&#x2f;/x.net/es/p",
    ]
    inside = ["../es/p", "./../es/p", "/es/p", "/es/q/../p", "../es/./p?x=1", "../../../es/p"]
    pages = blocked + [(f"https://o{i}.org/a", CANONICAL.format(t)) for i, t in enumerate(aliases)]
    pages += [(f"https://x.net/en/{i}", REFRESH.format(t)) for i, t in enumerate(inside)]
    n = len(pages)
    # In a comment, a script or a text area, even an open one, nothing is a link.
    pages += [
        (f"https://c{i}.org/a", before + CANONICAL.format("https://x.net/es/p") + after)
        for i, (before, after) in enumerate([("<!--", "-->"), ("<script>", "</script>"), ("<textarea>", "</TextArea>"), ("<!-- ", ""), ("<style>", "")])
    ]
    pages += [("https://d.org/a", "<!-- x -->" + CANONICAL.format("&amp;#x2F;/x.net/es/p")), ("https://d.org/b", CANONICAL.format("data:x"))]
    folder = written(spark, tmp_path, pages=([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, html string"))
    found = U.op4_url_filter(spark, folder)
    verdicts = {r.page_id: r.verdict for r in found.collect()}
    assert [verdicts[i] for i in range(n)] == ["block"] * n
    assert [verdicts[i] for i in range(n, len(pages))] == ["allow"] * (len(pages) - n)
    assert rows_of(found) == rows_of_sql(folder, SQL["op4_url_filter"], "pages")


def test_ten_thousand_chains(spark):
    """Chains of one to six links end at a blocked address or at another; each page gets its chain's verdict."""
    dealt = random.Random(3)
    lengths = [dealt.randint(1, 6) for _ in range(10_000)]
    chains = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "chain long, n int")
    steps = chains.select("chain", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("k"))
    end = F.when(F.col("chain") % 2 == 0, F.format_string("//end.net/es/%d", "chain")).otherwise(F.format_string("//end.net/en/%d", "chain"))
    target = F.when(F.col("k") == F.col("n") - 1, end).otherwise(F.format_string("../c%d/%d", "chain", F.col("k") + 1))
    pages = steps.select(
        F.monotonically_increasing_id().alias("page_id"), F.format_string("http://h.org/c%d/%d", "chain", "k").alias("url"),
        F.concat(F.lit("<link rel=canonical href='"), target, F.lit("'>")).alias("html"),
    )
    got = U.judge(pages).groupBy((F.regexp_extract("path", "c([0-9]+)", 1).cast("long") % 2).alias("odd"), "verdict").count().collect()
    want = {(odd, ["block", "allow"][odd], sum(lengths[odd::2])) for odd in (0, 1)}
    assert {tuple(r) for r in got} == want


def test_edges_from_a_log_and_empty_table(spark):
    pages = spark.createDataFrame([(1, "https://a.org/", None)], "page_id long, url string, html string")
    log = spark.createDataFrame([("a.org/", "t.co/1"), ("t.co/1", "v.net/es/")], "a string, b string")
    assert U.judge(pages, edges=log).first().verdict == "block"
    assert U.judge(pages.limit(0)).count() == 0


def test_plan_has_no_python(spark, tmp_path):
    folder = written(spark, tmp_path, pages=(PAGES, "page_id long, url string, html string"))
    plan = U.op4_url_filter(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
