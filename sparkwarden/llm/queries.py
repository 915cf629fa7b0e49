"""Registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkwarden.llm.centroid_search import op12_centroid_search
from sparkwarden.llm.chat_format import op10_chat_format
from sparkwarden.llm.decontaminate import op2_decontaminate
from sparkwarden.llm.html_text import op3_html_text
from sparkwarden.llm.near_dedup import op7_near_dedup
from sparkwarden.llm.oracle import SQL
from sparkwarden.llm.pairwise_quality import op1_pairwise_quality
from sparkwarden.llm.piece_coding import op9_piece_coding
from sparkwarden.llm.quality_rules import op5_quality_rules
from sparkwarden.llm.suffix_dedup import op8_suffix_dedup
from sparkwarden.llm.target_sampling import op11_target_sampling
from sparkwarden.llm.token_counts import op6_token_counts
from sparkwarden.llm.toxicity import op13_toxicity
from sparkwarden.llm.url_filter import op4_url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pairwise_quality, op2_decontaminate, op3_html_text, op4_url_filter, op5_quality_rules, op6_token_counts,
        op7_near_dedup, op8_suffix_dedup, op9_piece_coding, op10_chat_format, op11_target_sampling, op12_centroid_search,
        op13_toxicity,
    )
}

__all__ = ["QUERIES", "SQL"]
