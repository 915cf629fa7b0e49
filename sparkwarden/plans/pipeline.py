"""The steps as jobs over paths, and all of them in a row."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from sparkwarden import schemas
from sparkwarden.functions.text import behaviour_text
from sparkwarden.operators import points as P
from sparkwarden.operators.embedding import HashingEmbedder
from sparkwarden.operators.enrich import enrich_events
from sparkwarden.operators.iforest import Scorer, isolation_forest_scores
from sparkwarden.operators.lof import lof_scores
from sparkwarden.operators.mapping import KEEP, TOP_K, map_sessions
from sparkwarden.operators.rules import apply_rules, combine_scores
from sparkwarden.operators.sessionize import SessionConfig
from sparkwarden.plans import evaluate
from sparkwarden.session import materialize
from sparkwarden.sources import raw_log, stix, tables

TECHNIQUE_COLLECTION = "mitre_attack"
SESSION_COLLECTION = "log_sessions"


@dataclass(frozen=True)
class Options:
    sessions: SessionConfig = field(default_factory=SessionConfig)
    embedder: Any = field(default_factory=HashingEmbedder)
    use_lof: bool = False
    top_k: int = TOP_K
    keep: int = KEEP
    map_limit: int | None = None


def behaviour_vectors(sessions: DataFrame, embedder: Any = None) -> DataFrame:
    """``session_id, vector`` of the texts that the anomaly model looks at."""
    texts = sessions.select("session_id", behaviour_text().alias("text"))
    return (embedder or HashingEmbedder()).embed(texts, "text").select("session_id", "vector")


def detect_with(sessions: DataFrame, scorer: Scorer, embedder: Any = None) -> DataFrame:
    """The same with a fitted model (``iforest.load_scorer``): no action and no join, for tables and streams."""
    texts = apply_rules(sessions).withColumn("_text", behaviour_text())
    embedded = (embedder or HashingEmbedder()).embed(texts, "_text", "_vector")
    return combine_scores(scorer.score(embedded, "_vector")).select(*schemas.SCORED.fieldNames())


def detect(sessions: DataFrame, embedder: Any = None, use_lof: bool = False) -> DataFrame:
    """Rules, anomaly model and fusion (runs actions: the model is fitted to these sessions)."""
    ruled = apply_rules(sessions)
    vectors = materialize(behaviour_vectors(sessions, embedder), "session-vectors")
    model = lof_scores if use_lof else isolation_forest_scores
    scored = combine_scores(ruled.join(model(vectors, "session_id"), "session_id", "left"))
    return scored.select(*schemas.SCORED.fieldNames())


def ingest(spark: SparkSession, raw_path: str, out_dir: str) -> str:
    path = f"{out_dir}/events.parquet"
    tables.write_events(raw_log.parse_lines(raw_log.read_raw_lines(spark, raw_path)), path)
    return path


def sessionize(spark: SparkSession, out_dir: str, cfg: SessionConfig) -> None:
    events = tables.read_events(spark, f"{out_dir}/events.parquet")
    tables.write_session_outputs(enrich_events(events), out_dir, cfg)


def score(spark: SparkSession, out_dir: str, options: Options) -> DataFrame:
    sessions = tables.read_table(spark, f"{out_dir}/sessions.parquet", schemas.SESSIONS)
    path = f"{out_dir}/sessions_scored.parquet"
    tables.write_table(detect(sessions, options.embedder, options.use_lof), path)
    return tables.read_table(spark, path, schemas.SCORED)


def index_techniques(spark: SparkSession, knowledge_dir: str, out_dir: str, embedder: Any) -> DataFrame:
    techniques, mitigations = tables.read_knowledge(spark, knowledge_dir)
    points = P.technique_points(techniques, stix.mitigation_names(mitigations), embedder)
    P.save_collection(points, f"{out_dir}/collections", TECHNIQUE_COLLECTION, embedder.dim)
    return P.load_collection(spark, f"{out_dir}/collections", TECHNIQUE_COLLECTION)


def index_sessions(spark: SparkSession, out_dir: str, embedder: Any) -> DataFrame:
    scored = tables.read_table(spark, f"{out_dir}/sessions_scored.parquet", schemas.SCORED)
    points = P.session_points(scored, embedder)
    P.save_collection(points, f"{out_dir}/collections", SESSION_COLLECTION, embedder.dim)
    return P.load_collection(spark, f"{out_dir}/collections", SESSION_COLLECTION)


def map_to_techniques(spark: SparkSession, out_dir: str, options: Options) -> DataFrame:
    scored = tables.read_table(spark, f"{out_dir}/sessions_scored.parquet", schemas.SCORED)
    points = P.load_collection(spark, f"{out_dir}/collections", TECHNIQUE_COLLECTION)
    mapped = map_sessions(scored, points, options.embedder, options.top_k, options.keep, options.map_limit)
    path = f"{out_dir}/session_attack_mapping.parquet"
    tables.write_table(mapped, path)
    return tables.read_table(spark, path, schemas.MAPPING)


def run_all(
    spark: SparkSession, raw_path: str, bundle: str, out_dir: str, options: Options | None = None
) -> dict[str, Any]:
    """Raw log and knowledge bundle to the evaluation report; every step leaves its table in ``out_dir``."""
    options = options or Options()
    knowledge = tables.build_knowledge(spark, bundle, f"{out_dir}/knowledge")
    ingest(spark, raw_path, out_dir)
    sessionize(spark, out_dir, options.sessions)
    scored = score(spark, out_dir, options)
    index_techniques(spark, knowledge, out_dir, options.embedder)
    index_sessions(spark, out_dir, options.embedder)
    mapping = map_to_techniques(spark, out_dir, options)
    techniques, _ = tables.read_knowledge(spark, knowledge)
    report = evaluate.run_eval(scored, mapping, techniques, inputs={"raw_path": raw_path, "bundle": bundle})
    tables.write_report(spark, report, f"{out_dir}/report")
    return report
