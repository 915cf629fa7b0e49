"""How sure a session-to-technique match is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkwarden.functions.arrays import or_empty
from sparkwarden.operators.rules import clip

# Boost per tool and reason, the cap, and the two weights. The fifth reason is spelled differently by
# the rules ("indicator:/etc/passwd"), so it never applies unless asked for.
BOOSTS = {
    "tool:gobuster": 0.15,
    "tool:dirbuster": 0.15,
    "indicator:cmd_injection": 0.15,
    "indicator:sql_injection": 0.15,
    "indicator:path_traversal": 0.15,
    "indicator:lfi_etc_passwd": 0.20,
    "behavior:burst_rps>=3": 0.10,
    "behavior:many_ports": 0.10,
}
BOOST_CAP = 0.35
SIMILARITY_WEIGHT = 0.85
BOOST_WEIGHT = 0.15
BOOSTED_TOOLS = ["gobuster", "dirbuster"]
RULE_SPELLING = "indicator:/etc/passwd"


def boost(tool: Column, rule_reasons: Column, reasons: Column, match_lfi_rule: bool = False) -> Column:
    """Sum of the boosts of the tool and the rule reasons, or all reasons where no rule fired, capped."""
    table = dict(BOOSTS)
    if match_lfi_rule:
        table[RULE_SPELLING] = table["indicator:lfi_etc_passwd"]

    def worth(reason: Column) -> Column:
        out = F.lit(0.0)
        for name, value in table.items():
            out = F.when(reason == name, value).otherwise(out)
        return out

    rules = or_empty(rule_reasons)
    used = F.when(F.size(rules) > 0, rules).otherwise(or_empty(reasons))
    start = F.when(tool.isin(BOOSTED_TOOLS), worth(F.concat(F.lit("tool:"), tool))).otherwise(0.0)
    return F.least(F.aggregate(used, start, lambda total, r: total + worth(r)), F.lit(BOOST_CAP))


def confidence(similarity: Column, boost_value: Column) -> Column:
    share = clip(boost_value, 0.0, BOOST_CAP) / F.lit(BOOST_CAP)
    return clip(F.lit(SIMILARITY_WEIGHT) * clip(similarity) + F.lit(BOOST_WEIGHT) * share)
