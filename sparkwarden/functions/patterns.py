"""Tool fingerprints and attack indicators as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names and patterns, in the order in which they are tried. All match without regard to case.
TOOL_PATTERNS = [
    ("dirbuster", r"dirbuster"),
    ("gobuster", r"gobuster"),
    ("nikto", r"nikto"),
    ("sqlmap", r"sqlmap"),
    ("curl", r"\bcurl/"),
    ("wget", r"\bwget/"),
    ("python-requests", r"python-requests"),
    ("go-http-client", r"go-http-client"),
]
DEFAULT_TOOL = "browser/unknown"

# Indicator name -> pattern over the whole search text.
INDICATOR_PATTERNS = {
    "lfi_etc_passwd": r"/etc/passwd",
    "path_traversal": r"(?:\.\./|%2e%2e%2f|%2e%2e/|\.\.%2f|\.\.\\|%5c)",
    "sql_injection": r"(\bunion\b|\bselect\b|\bdrop\b|\bor\b\s+1=1|%27|%22)",
    "cmd_injection": r"(;|\|\||\|`|`|\$\(|%3b|%7c)",
    "wp_probe": r"(wp-admin|wp-login\.php|xmlrpc\.php)",
}

# Fixed values, as in the patterns above: plain lower-case text that must be present for the pattern to match. Where "exact" is set, finding it is
# already a match; otherwise the pattern decides.
_TOOL_HINTS = {"curl": ("curl/", False), "wget": ("wget/", False)}
_INDICATOR_HINTS = {
    "lfi_etc_passwd": (["/etc/passwd"], []),
    "path_traversal": (["../", "%2e%2e%2f", "%2e%2e/", "..%2f", "..\\", "%5c"], []),
    "sql_injection": (["%27", "%22"], ["union", "select", "drop", "1=1"]),
    "cmd_injection": ([";", "||", "`", "$(", "%3b", "%7c"], []),
    "wp_probe": (["wp-admin", "wp-login.php", "xmlrpc.php"], []),
}


def _literal(text: str) -> str:
    return f"r'{text}'"


def _unicode_regex(column: str, pattern: str) -> str:
    # Case folding and classes over all of Unicode; the separators FS..US count as blanks too.
    return f"{column} RLIKE {_literal('(?iU)' + pattern.replace(r'\s', r'[\s\x1c-\x1f]'))}"


def _contains_any(column: str, needles: list[str]) -> str:
    return "(" + " OR ".join(f"contains({column}, {_literal(n)})" for n in needles) + ")"


def _is_ascii(column: str) -> str:
    return f"octet_length({column}) = length({column})"


def _first_match(hits: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN {hit} THEN '{name}'" for name, hit in hits) + f" ELSE '{DEFAULT_TOOL}' END"


def tool_from_agent(agent: str, lowered: str) -> Column:
    """First matching tool, or the default for none, a blank or a null agent.

    ``lowered`` names the lower-cased agent. ASCII agents, nearly all of them, are decided by substring search;
    the regular expression runs only where case folding or a word boundary could matter.
    """
    by_regex, by_hint = [], []
    for name, pattern in TOOL_PATTERNS:
        hint, exact = _TOOL_HINTS.get(name, (name, True))
        regex, found = _unicode_regex(agent, pattern), _contains_any(lowered, [hint])
        by_regex.append((name, regex))
        by_hint.append((name, found if exact else f"({found} AND {regex})"))
    return F.expr(
        f"CASE WHEN {agent} IS NULL OR {agent} = '' THEN '{DEFAULT_TOOL}' "
        f"WHEN {_is_ascii(agent)} THEN {_first_match(by_hint)} ELSE {_first_match(by_regex)} END"
    )


def indicator_flag(name: str, text: str, lowered: str) -> Column:
    """True where the indicator occurs in column ``text`` (never null for a non-null text)."""
    exact, candidates = _INDICATOR_HINTS[name]
    regex = _unicode_regex(text, INDICATOR_PATTERNS[name])
    hit = _contains_any(lowered, exact)
    if candidates:
        hit = f"({hit} OR ({_contains_any(lowered, candidates)} AND {regex}))"
    return F.expr(f"CASE WHEN {_is_ascii(text)} THEN {hit} ELSE {regex} END")


def search_text(*parts: str) -> Column:
    """Columns joined by single blanks; null ones count as empty but keep their separator."""
    return F.expr("concat(" + ", ' ', ".join(f"coalesce({p}, '')" for p in parts) + ")")
