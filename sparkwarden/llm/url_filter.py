"""URL verdicts by host and path rules, shared among aliases by redirect equivalence. DataFrame functions only.

Pages that redirect to each other, or name the same canonical address, are one resource. Edges from the pages' own
redirect and canonical markup are joined into connected components; a block that a rule puts on any address of a
component, crawled or only linked, reaches its aliases. An address with a rule of its own keeps it, so an explicit
allow goes before a block that comes from an alias.

Links are read from markup only, not from comments, scripts, styles or text areas; character references in them are
decoded. They are resolved as RFC 3986 says, against the page's ``base`` if it names one: schemes, ``//host``, ``/path``,
``path``, ``?query``, ``./`` and ``../``. Addresses of other kinds (``mailto:``) are no links. A page's own address is
taken as it is written.

Defined results: a null url, or one without ``://``, has an empty host and path, no rule, and is allowed. Repeated
pages are judged alike, one row each. An empty html has no edges. Components of any length are joined, in rounds.
Extra columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwarden.llm.common import ascii_lower, table
from sparkwarden.llm.components import connected_components
from sparkwarden.session import discard, materialize


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``. The list of rules is configuration."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)

# Up to the host's end; then up to the path's end; then a query.
_HOST, _PATH, _PLACE = r"^[^/?#]*", r"^[^/?#]*([^?#]*)", r"^[^#]*"
_LINK_TAG, _META_TAG, _BASE_TAG = r"(?is)<link\b[^>]*>", r"(?is)<meta\b[^>]*>", r"(?is)<base\b[^>]*\bhref\b[^>]*>"
# What looks like tags there is none.
_NO_MARKUP = r"(?is)<!--.*?(?:-->|\z)" + "".join(rf"|<{t}\b.*?(?:</{t}|\z)" for t in ("script", "style", "textarea", "title"))
_SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.-]*:"
_NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}
_CANONICAL = r"(?is)\brel\s*=\s*[\"']?\s*canonical\b"
_REFRESH = r"(?is)\bhttp-equiv\s*=\s*[\"']?\s*refresh\b"
_HREF = r"(?is)\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
_TARGET = r"(?is)\burl\s*=\s*['\"]?([^'\">\s]+)"


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty for null or an url without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(rest: Column) -> Column:
    return ascii_lower(F.regexp_extract(rest, _HOST, 0))


def path_of(rest: Column) -> Column:
    return F.regexp_extract(rest, _PATH, 1)


def place_of(rest: Column) -> Column:
    """The address that aliases share: host and what follows it, without scheme and fragment. Null if there is none."""
    place = F.concat(host_of(rest), F.regexp_replace(F.regexp_extract(rest, _PLACE, 0), _HOST, ""))
    return F.when(place != "", place)


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, or nulls."""
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def decoded(text: Column) -> Column:
    """Character references by number and the five common names are decoded once, from left to right."""

    def one(part: Column) -> Column:
        by_hex = F.regexp_extract(part, r"^#[xX]0*([0-9a-fA-F]{1,6});?", 1)
        by_number = F.regexp_extract(part, r"^#0*([0-9]{1,7});?", 1)
        code = F.when(by_hex != "", F.conv(by_hex, 16, 10).try_cast("long")).otherwise(by_number.try_cast("long"))
        good = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(good, code)), 8, "0")), "UTF-32")
        name = F.regexp_extract(part, "^(" + "|".join(_NAMED) + ");", 1)
        named = F.lit(None).cast("string")
        for known, value in _NAMED.items():
            named = F.when(name == known, F.lit(value)).otherwise(named)
        rest = F.regexp_replace(part, r"^(?:#[xX][0-9a-fA-F]+|#[0-9]+);?|^[a-z]+;", "")
        return F.coalesce(F.concat(F.coalesce(char, named), rest), F.concat(F.lit("&"), part))

    parts = F.split(text, "&")
    joined = F.array_join(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(one(p))), "")
    return F.when(F.contains(text, F.lit("&")), joined).otherwise(text)


def without_dots(path: Column) -> Column:
    """A path from ``/`` on without ``.`` and ``..``; what would climb above the root stays there."""
    steps = F.split(path, "/")
    last = F.element_at(steps, -1)
    # A place for the folder that a last dot names.
    steps = F.when(last.isin(".", ".."), F.concat(steps, F.array(F.lit("")))).otherwise(steps)
    kept = F.aggregate(
        F.slice(steps, 2, F.size(steps)),
        F.array().cast("array<string>"),
        lambda held, x: F.when(x == "..", F.slice(held, 1, F.greatest(F.size(held) - 1, F.lit(0))))
        .when(x == ".", held)
        .otherwise(F.concat(held, F.array(x))),
    )
    return F.when(path.rlike(r"/\.\.?(/|\z)"), F.concat(F.lit("/"), F.array_join(kept, "/"))).otherwise(path)


def _staged(df: DataFrame, **columns: Column) -> DataFrame:
    """With more columns, each worked out once: they leave through ``inline``, where no later step repeats them."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))


def resolved(df: DataFrame, base: str, target: str, name: str) -> DataFrame:
    """``name``: host, path and query that ``target`` names on the page ``base`` (what follows its ``://``); or null."""
    kept = df.columns
    clean = F.regexp_replace(target, r"[\t\n\r]|^ +| +$", "")
    df = _staged(df, t=F.regexp_extract(clean, r"(?s)^[^#]*", 0), b=F.regexp_extract(base, _PLACE, 0))
    df = _staged(
        df,
        whole=F.regexp_extract("t", rf"(?s)(?:{_SCHEME}|^)//(.*)", 1),
        path=F.regexp_extract("t", r"^[^?]*", 0),
        query=F.regexp_extract("t", r"(?s)\?.*", 0),
        host=F.regexp_extract("b", _HOST, 0),
        old=F.regexp_extract("b", _PATH, 1),
    )
    dotted = (
        F.when(F.col("whole") != "", F.regexp_extract("whole", _PATH, 1))
        .when(F.col("path").startswith("/"), F.col("path"))
        .otherwise(F.concat(F.regexp_replace("old", r"/[^/]*\z", ""), F.lit("/"), F.col("path")))
    )
    df = _staged(_staged(df, dotted=dotted), plain=without_dots(F.col("dotted")))
    absolute = F.concat(F.regexp_extract("whole", _HOST, 0), F.col("plain"), F.regexp_extract("whole", r"(?s)\?.*", 0))
    full = (
        F.when(F.col("whole") != "", absolute)
        .when(F.col("t").rlike(_SCHEME), F.lit(None).cast("string"))
        .when(F.col("t") == "", F.col("b"))
        .when(F.col("path") == "", F.concat("host", "old", "query"))
        .otherwise(F.concat("host", "plain", "query"))
    )
    return _staged(df, **{name: full}).select(*kept, name)


def redirect_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): a page's place, and the place that its refresh or canonical markup names."""
    found = pages.select(F.col(url).alias("url"), F.col(html).alias("html")).where(
        F.col("html").rlike("(?i)canonical|refresh") & (F.instr("url", "://") > 0)
    )
    found = _staged(found, rest=after_scheme(F.col("url")), markup=F.regexp_replace("html", _NO_MARKUP, " ")).select("rest", "markup")
    tags = lambda pattern: F.regexp_extract_all("markup", F.lit(pattern), F.lit(0))
    href = lambda t: F.concat(*(F.regexp_extract(t, _HREF, i) for i in (1, 2, 3)))
    canonical = F.transform(F.filter(tags(_LINK_TAG), lambda t: t.rlike(_CANONICAL)), href)
    refresh = F.transform(
        F.filter(tags(_META_TAG), lambda t: t.rlike(_REFRESH)), lambda t: F.regexp_extract(t, _TARGET, 1)
    )
    named = found.select(
        "rest", href(F.regexp_extract("markup", _BASE_TAG, 0)).alias("href"), F.explode(F.concat(canonical, refresh)).alias("link")
    ).where("link != ''")
    named = _staged(named, base=decoded(F.col("href")), target=decoded(F.col("link"))).select("rest", "base", "target")
    onto = _staged(resolved(named, "rest", "base", "onto"), page=F.coalesce("onto", "rest")).select("rest", "page", "target")
    full = resolved(onto, "page", "target", "full")
    return _staged(full, a=place_of(F.col("rest")), b=place_of(F.col("full"))).where("a != b").select("a", "b").distinct()


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, edges: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for each page.

    ``edges`` (a, b: places) may come from a crawler's redirect log; without it the pages' own markup is read.
    """
    edges = materialize(redirect_edges(pages) if edges is None else edges.select("a", "b"), "redirects")
    rest = after_scheme(F.col("url"))
    judged = pages.select("page_id", host_of(rest).alias("host"), path_of(rest).alias("path"), place_of(rest).alias("place"))
    text, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = judged.select("page_id", "host", "path", "place", text.alias("rule"), verdict.alias("own"))
    blocked = materialize(_blocked_places(edges, rules), "blocked")
    discard(edges)
    return judged.join(blocked, "place", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("own", F.when(F.col("blocked"), "block"), F.lit("allow")).alias("verdict")
    )


def _blocked_places(edges: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """The places of components that hold a place which a rule blocks, each once."""
    member = connected_components(edges)
    _, verdict = rule_of(host_of(F.col("node")), path_of(F.col("node")), rules)
    hit = member.where(verdict == "block").select("component").distinct()
    return member.join(hit, "component").select(F.col("node").alias("place"), F.lit(True).alias("blocked"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))
