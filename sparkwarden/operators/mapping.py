"""Suspicious sessions to the techniques they resemble."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkwarden.functions import confidence as conf
from sparkwarden.functions.text import technique_query_text
from sparkwarden.operators.similarity import BROADCAST_BYTES, Corpus, collect_corpus, dealt, nearest, topk
from sparkwarden.schemas import MAPPING, conform
from sparkwarden.session import materialize

# Labels that are mapped, candidates retrieved and techniques kept per session.
MAPPED_LABELS = ["attack_like", "suspicious"]
TOP_K = 20
KEEP = 3


def suspicious_sessions(scored: DataFrame, limit: int | None = None) -> DataFrame:
    """Sessions to map; a limit keeps the first ones by session id."""
    chosen = scored.filter(F.col("label").isin(MAPPED_LABELS))
    return chosen if limit is None else chosen.orderBy("session_id").limit(limit)


def _hits_in_place(sessions: DataFrame, points: DataFrame, corpus: Corpus, top_k: int, keep: int) -> DataFrame:
    """``ranked``: best hits with payload, for a corpus that travels. No join.

    The sessions are written once, as they are counted and read. Payloads become one array in the corpus's own order,
    a constant of the plan; a hit's slot picks its entry, and only what is picked enters a row.
    """
    named = F.struct(*[F.col(f"payload.{c}").alias(c) for c in ("technique_id", "name", "tactics")])
    entries = F.array_sort(F.collect_list(F.struct("point_id", named.alias("payload"))))
    payloads = points.agg(F.transform(entries, lambda e: e["payload"]).alias("payloads")).scalar()
    best = []
    for place in range(min(keep, top_k)):
        hit = F.get("hits", F.lit(place))
        entry = F.struct(hit["score"].alias("score"), F.get(payloads, hit["slot"]).alias("payload"))
        best.append(F.when(F.size("hits") > place, entry))
    found = nearest(dealt(materialize(sessions, "asking"), "session_id", corpus), corpus, top_k)
    return found.withColumn("ranked", F.array_compact(F.array(*best))).drop("hits")


def _hits_by_join(sessions: DataFrame, points: DataFrame, top_k: int, keep: int, limit: int) -> DataFrame:
    """The same for a corpus of any size. The sessions are written once, as they are read several times."""
    sessions = materialize(sessions, "asking")
    queries = sessions.select(F.col("session_id").alias("query_id"), "vector")
    best = topk(queries, points, top_k, limit=limit).filter(F.col("rank") <= keep)
    with_payload = best.join(points.select("point_id", "payload"), "point_id")
    lists = with_payload.groupBy(F.col("query_id").alias("session_id")).agg(
        F.array_sort(F.collect_list(F.struct("rank", "score", "payload"))).alias("ranked")
    )
    return sessions.join(lists, "session_id", "left")


def map_vectors(
    sessions: DataFrame,
    points: DataFrame,
    top_k: int = TOP_K,
    keep: int = KEEP,
    match_lfi_rule: bool = False,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per session (given with ``vector`` and ``summary``) with its best techniques.

    The boost is the same for all of a session's candidates, so the order of confidence is the order of similarity
    and the best ``keep`` are the first ones.
    """
    corpus = collect_corpus(points, limit, "payload")
    found = (
        _hits_by_join(sessions, points, top_k, keep, limit)
        if corpus is None
        else _hits_in_place(sessions, points, corpus, top_k, keep)
    )
    lift = conf.boost(F.col("tool"), F.col("rule_reasons"), F.col("reasons"), match_lfi_rule)
    kept = F.slice("ranked", 1, min(keep, top_k))
    out = found.withColumn("_kept", kept).withColumn("_boost", lift)
    first = F.get("_kept", F.lit(0))["score"]
    empty = F.array().cast("array<string>")
    columns = {
        "mapped_techniques": F.coalesce(F.col("_kept.payload.technique_id"), empty),
        "mapped_names": F.coalesce(F.col("_kept.payload.name"), empty),
        "mapped_tactics": F.coalesce(F.col("_kept.payload.tactics"), F.array().cast("array<array<string>>")),
        "confidence": F.when(first.isNull(), 0.0).otherwise(conf.confidence(first, F.col("_boost"))),
        "why": F.coalesce(F.col("rule_reasons"), empty),
    }
    return conform(out.withColumns(columns), MAPPING)


def map_sessions(
    scored: DataFrame,
    points: DataFrame,
    embedder,
    top_k: int = TOP_K,
    keep: int = KEEP,
    limit: int | None = None,
    match_lfi_rule: bool = False,
) -> DataFrame:
    """Summarise, embed and map all suspicious sessions in one job (counts the corpus: an action)."""
    chosen = suspicious_sessions(scored, limit).withColumn("summary", technique_query_text())
    return map_vectors(embedder.embed(chosen, "summary"), points, top_k, keep, match_lfi_rule)


def rank_candidates(candidates: DataFrame, keep: int = KEEP) -> DataFrame:
    """The best ``keep`` of (session_id, point_id, sim, confidence) per session, with their rank."""
    best = Window.partitionBy("session_id").orderBy(F.desc("confidence"), F.desc("sim"), "point_id")
    return candidates.withColumn("rank", F.row_number().over(best).cast("bigint")).filter(F.col("rank") <= keep)
