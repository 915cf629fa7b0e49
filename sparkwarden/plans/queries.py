"""The registered queries: each takes (spark, sf_dir) and runs one operator over the whole shared tables.

Results are flat for comparison: times as epoch seconds, lists as joined text, floats rounded to six decimals.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwarden.functions import arrays, confidence, text
from sparkwarden.operators import collections, graph, iforest, ivf, knn, lof, mapping, moments, points, projection, rollup, similarity
from sparkwarden.operators import sessionize as S
from sparkwarden.operators.embedding import HashingEmbedder
from sparkwarden.operators.enrich import enrich_events as enrich
from sparkwarden.operators.iforest import isolation_forest_scores as forest_scores
from sparkwarden.operators.rules import apply_rules, combine_scores
from sparkwarden.operators.scaling import min_max
from sparkwarden.plans import adapter, analytics, evaluate, pipeline
from sparkwarden.schemas import DETECTION_LABELS, EVENTS, INDICATOR_COLUMNS, MAPPING_LABELS, SESSIONS, conform
from sparkwarden.session import configure, discard, materialize, scratch_root, spread
from sparkwarden.sources import raw_log, stix, tables
from sparkwarden.streaming import live, ordered, sink

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

TACTICS = ["reconnaissance", "discovery", "execution", "persistence", "initial-access",
           "collection", "exfiltration", "impact", "lateral-movement", "defense-evasion"]


def register(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    REGISTRY[query.__name__] = run
    return query


# --- shared steps ----------------------------------------------------------------------------------------------


def enriched_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(adapter.events_table(spark, sf_dir))


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.build_sessions(enriched_events(spark, sf_dir), adapter.CONFIG)


def scored_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(sessions(spark, sf_dir))


def _scored(found: DataFrame) -> DataFrame:
    """Sessions scored with a stand-in for the model: a fixed expression of the session's counts."""
    mix = F.col("event_count") * 37 + F.col("unique_ports") * 17 + F.col("indicator_hits") * 5
    model = F.pmod(mix, F.lit(101)) / F.lit(100.0)
    return combine_scores(apply_rules(found).withColumn("ml_score", model))


def _r(name: str | Column, alias: str | None = None) -> Column:
    col = F.col(name) if isinstance(name, str) else name
    return F.round(col, 6).alias(alias or name)


def _epoch(name: str) -> Column:
    return F.unix_seconds(name).alias(name)


def _joined(name: str, sep: str = ",") -> Column:
    return F.array_join(name, sep).alias(name)


def _flat_sessions(df: DataFrame) -> DataFrame:
    timed = [_epoch(c) if c in ("start_ts", "end_ts") else F.col(c) for c in SESSIONS.fieldNames()[:-2]]
    return df.select(*timed, _r("duration_s"), _r("rps"))


# --- ingest and enrichment -------------------------------------------------------------------------------------


@register
def parse_log_lines(spark, sf_dir):
    return raw_log.parse_lines(adapter.messy_lines(spark, sf_dir))


@register
def rejected_lines(spark, sf_dir):
    return raw_log.rejected_lines(adapter.messy_lines(spark, sf_dir))


@register
def conform_events(spark, sf_dir):
    """Text ports, two missing columns and another order, brought to the event schema."""
    events = adapter.events_table(spark, sf_dir)
    form = F.pmod("event_id", F.lit(3))
    port = F.when(form == 0, "port").when(form == 1, F.col("src_port").cast("string"))
    loose = events.select("raw_line", "user_agent", port.alias("src_port"), "action2", "ts", "src_ip", "action1")
    return conform(loose, EVENTS)


@register
def enrich_events(spark, sf_dir):
    cols = ["event_id", "tool", *INDICATOR_COLUMNS, "indicator_count"]
    return enriched_events(spark, sf_dir).select(*cols)


# --- sessions --------------------------------------------------------------------------------------------------


@register
def sessionize_gap(spark, sf_dir):
    return _flat_sessions(sessions(spark, sf_dir))


@register
def sessionize_hot_source(spark, sf_dir):
    """The same from events that arrive by source, so that the planted one, a tenth of all rows, is one partition."""
    return _flat_sessions(S.build_sessions(enriched_events(spark, sf_dir).repartition("src_ip"), adapter.CONFIG))


@register
def session_ids(spark, sf_dir):
    """Ids and numbers of all sessions, also of single events."""
    assigned = S.assign_sessions(S.with_event_time(enriched_events(spark, sf_dir)), adapter.CONFIG)
    keys = assigned.select("src_ip", "tool", "session_idx", "session_size").distinct()
    return S.with_session_id(keys).select("session_id", "src_ip", "tool", "session_idx", "session_size")


def _flat_events(df: DataFrame) -> DataFrame:
    return df.select(*[_epoch(c) if c == "ts_dt_utc" else F.col(c) for c in df.columns])


@register
def session_events_kept(spark, sf_dir):
    return _flat_events(S.label_events(enriched_events(spark, sf_dir), adapter.CONFIG))


@register
def session_events_hot_source(spark, sf_dir):
    return _flat_events(S.label_events(enriched_events(spark, sf_dir).repartition("src_ip"), adapter.CONFIG))


@register
def sessions_written(spark, sf_dir):
    """Both session tables written, the sessions read back."""
    out = f"{scratch_root(spark)}/sessions-{uuid.uuid4().hex}"
    tables.write_session_outputs(enriched_events(spark, sf_dir), out, adapter.CONFIG)
    return _flat_sessions(tables.read_table(spark, f"{out}/sessions.parquet", SESSIONS))


@register
def session_rollup(spark, sf_dir):
    """Sessions merged from their days, which were written in two halves and the second half twice."""
    out = f"{scratch_root(spark)}/rollup-{uuid.uuid4().hex}"
    events = materialize(S.label_events(enriched_events(spark, sf_dir), adapter.CONFIG), "events")
    day = F.date_diff(F.to_date("ts_dt_utc"), F.lit("2024-01-01").cast("date"))
    middle = events.agg(F.avg(day)).first()[0] or 0.0
    for half in (day <= middle, day > middle, day > middle):
        rollup.write_days(events.filter(half), out)
    return _flat_sessions(rollup.merged_sessions(*rollup.read_days(spark, out)))


@register
def ingested_sessions(spark, sf_dir):
    """From text files of good and bad lines, through the written event table, to sessions."""
    out = f"{scratch_root(spark)}/ingest-{uuid.uuid4().hex}"
    adapter.messy_lines(spark, sf_dir).select("value").write.text(f"{out}/raw")
    tables.write_events(raw_log.parse_lines(raw_log.read_raw_lines(spark, f"{out}/raw")), f"{out}/events.parquet")
    events = tables.read_events(spark, f"{out}/events.parquet")
    return _flat_sessions(S.build_sessions(enrich(events), adapter.CONFIG))


# --- streams ---------------------------------------------------------------------------------------------------


# Rows of a step for each of its files, at least.
ROWS_PER_FILE = 100_000


def _fed(rows: DataFrame, time: str, folder: str, kind: str, parts: int = 3, most: int = 1) -> int:
    """Rows as files in ``parts`` steps, the earlier times first.

    Gives the number of files of each step, at most ``most``: all steps have as many, as one batch reads one step.
    """
    first, last = rows.agg(F.min(time), F.max(time)).first()
    step = (last - first) // parts + 1
    nth = F.floor((F.col(time) - F.lit(first)) / step)
    files = 1
    if most > 1:
        counted = {r.nth: r.n for r in rows.groupBy(nth.alias("nth")).agg(F.count(F.lit(1)).alias("n")).collect()}
        files = max(1, min(most, min(counted.get(n, 0) for n in range(parts)) // ROWS_PER_FILE))
    for n in range(parts):
        part = rows.filter((F.col(time) - F.lit(first)).between(n * step, (n + 1) * step - 1)).drop(time)
        # Dealt in turn, so that no file of a step is without rows, which would not be written.
        part = part.coalesce(1) if files == 1 else part.repartition(files)
        part.write.mode("append").format(kind).save(folder)
    return files


def _ran(stream: DataFrame, out: str) -> DataFrame:
    """All that a stream gives for the files that are there."""
    query = stream.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state")
    query.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{out}/rows")


@register
def streamed_sessions(spark, sf_dir):
    """Sessions of log files that arrive one after the other, numbered as the batch job does; a last line ends them all."""
    out = f"{scratch_root(spark)}/stream-{uuid.uuid4().hex}"
    lines = adapter.clean_lines(spark, sf_dir).withColumn("at", F.unix_seconds(F.get_json_object("value", "$[2]").cast("timestamp")))
    lines = materialize(lines, "lines")
    files = _fed(lines, "at", f"{out}/in", "text", most=spark.sparkContext.defaultParallelism)
    discard(lines)
    end = spark.range(1).select(F.lit('[null,"/","2200-01-01 00:00:00","0.0.0.0","1","end"]').alias("value"))
    end.write.mode("append").text(f"{out}/in")
    return _flat_sessions(_ran(ordered.numbered_sessions(live.live_events(spark, f"{out}/in", files_at_once=files), adapter.CONFIG), out))


def _sunk(spark, sf_dir, kind):
    """Log files through the sink, the last batch of which runs twice."""
    out = f"{scratch_root(spark)}/sink-{uuid.uuid4().hex}"
    lines = adapter.messy_lines(spark, sf_dir)
    _fed(lines.select("value", "event_id"), "event_id", f"{out}/in", "text", 2)
    stream = sink.writer(raw_log.stream_raw_lines(spark, f"{out}/in", 1), f"{out}/sink", 1 << 40)
    stream.option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start().awaitTermination()
    again = sink.read(spark, f"{out}/sink", kind).agg(F.max("batch")).first()[0]
    held = [sink.read(spark, f"{out}/sink", k).filter(F.col("batch") == again).select("raw_line") for k in sink.KINDS]
    again_lines = materialize(held[0].union(held[1]).union(held[2]).withColumnRenamed("raw_line", "value"), "again")
    sink.Sink(f"{out}/sink", 1 << 40)(again_lines, again)
    return sink.read(spark, f"{out}/sink", kind).drop("batch")


@register
def streamed_events(spark, sf_dir):
    """Events of a stream of good and bad lines, written once although a batch ran twice."""
    return _sunk(spark, sf_dir, "events")


@register
def streamed_rejects(spark, sf_dir):
    """The other lines of the same stream, with their reasons."""
    return _sunk(spark, sf_dir, "rejects")


@register
def streamed_timeline(spark, sf_dir):
    """The timeline of session events that arrive one file after the other, empty buckets included."""
    out = f"{scratch_root(spark)}/timeline-{uuid.uuid4().hex}"
    events, scored = _timeline_inputs(spark, sf_dir)
    labelled = events.join(scored.select("session_id", "label"), "session_id").select("ts_dt_utc", "label")
    labelled = materialize(labelled.withColumn("at", F.unix_seconds("ts_dt_utc")), "labelled")
    _fed(labelled, "at", f"{out}/in", "parquet")
    end = spark.range(1).select(F.lit("2200-01-01").cast("timestamp").alias("ts_dt_utc"), F.lit("benign").alias("label"))
    end.write.mode("append").parquet(f"{out}/in")
    stream = spark.readStream.schema(end.schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/in")
    found = _ran(ordered.live_timeline(stream.withWatermark("ts_dt_utc", "10 minutes")), out)
    return found.withColumn("bucket", _epoch("bucket"))


# --- scores and reports ----------------------------------------------------------------------------------------


@register
def rule_scores(spark, sf_dir):
    ruled = apply_rules(sessions(spark, sf_dir))
    return ruled.select("session_id", _r("rule_score"), _joined("rule_reasons"))


@register
def score_labels(spark, sf_dir):
    cols = ["session_id", _r("ml_score"), _r("suspicious_score"), "label", _joined("reasons")]
    return scored_sessions(spark, sf_dir).select(*cols)


@register
def riskiest_sessions(spark, sf_dir):
    """From raw lines to the ten sessions of highest rule score, with their reasons."""
    events = raw_log.parse_lines(adapter.clean_lines(spark, sf_dir))
    ruled = apply_rules(S.build_sessions(enrich(events), adapter.CONFIG))
    cols = ["session_id", "src_ip", "tool", "event_count", "rps", "indicator_hits", "rule_score", "rule_reasons"]
    top = analytics.top_by(ruled, "rule_score", cols, 10)
    return top.withColumns({"rps": _r("rps"), "rule_score": _r("rule_score"), "rule_reasons": _joined("rule_reasons")})


@register
def top_sessions(spark, sf_dir):
    return analytics.largest_sessions(sessions(spark, sf_dir)).withColumns(
        {"duration_s": _r("duration_s"), "rps": _r("rps")}
    )


@register
def top_indicator_sessions(spark, sf_dir):
    return analytics.top_indicator_sessions(sessions(spark, sf_dir))


@register
def top_suspicious(spark, sf_dir):
    return analytics.most_suspicious(scored_sessions(spark, sf_dir)).withColumns(
        {"rps": _r("rps"), "suspicious_score": _r("suspicious_score"), "reasons": _joined("reasons")}
    )


@register
def top_attack_tools(spark, sf_dir):
    return analytics.top_attack_tools(scored_sessions(spark, sf_dir))


@register
def label_counts(spark, sf_dir):
    return analytics.value_counts_over(scored_sessions(spark, sf_dir), "label", [*analytics.LABELS, "unheard_of"])


@register
def tool_counts(spark, sf_dir):
    return analytics.value_counts(sessions(spark, sf_dir), "tool")


@register
def indicator_totals(spark, sf_dir):
    return analytics.indicator_totals(scored_sessions(spark, sf_dir))


@register
def score_histogram(spark, sf_dir):
    scores = materialize(scored_sessions(spark, sf_dir).select("suspicious_score"), "scores")
    out = analytics.histogram(scores, "suspicious_score", 40)
    return out.select("bin", _r("low"), _r("high"), "count")


@register
def value_histogram(spark, sf_dir):
    """The same bins over all order lines' prices."""
    out = analytics.histogram(adapter.read_table(spark, sf_dir, "lineitem"), "l_extendedprice", 40)
    return out.select("bin", _r("low"), _r("high"), "count")


def _timeline_inputs(spark, sf_dir):
    """Session events written once, and the scored sessions summed up from them."""
    labelled = S.label_events(enriched_events(spark, sf_dir), adapter.CONFIG)
    events = materialize(labelled.drop("ts", "user_agent", "action1", "action2", "extra", "raw_line"), "events")
    return events, _scored(S.sessions_from_events(events))


@register
def timeline_minute(spark, sf_dir):
    out = analytics.timeline_by_label(*_timeline_inputs(spark, sf_dir))
    return out.withColumn("minute", _epoch("minute"))


@register
def timeline_intensity(spark, sf_dir):
    out = analytics.timeline_intensity(*_timeline_inputs(spark, sf_dir))
    return out.select(_epoch("minute"), _r("weight"))


@register
def timeline_5min(spark, sf_dir):
    minutes = materialize(analytics.timeline_by_label(*_timeline_inputs(spark, sf_dir)), "minutes")
    return analytics.resample(minutes, 5).withColumn("bucket", _epoch("bucket"))


@register
def event_peek(spark, sf_dir):
    return analytics.peek_events(S.label_events(enriched_events(spark, sf_dir), adapter.CONFIG))


@register
def rule_vs_model(spark, sf_dir):
    return analytics.rule_vs_model(scored_sessions(spark, sf_dir)).select("label", _r("x"), _r("y"))


@register
def price_scaling(spark, sf_dir):
    """Min-max scaling, shown on all order lines' prices."""
    lines = adapter.read_table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return min_max(lines, "l_extendedprice", "scaled").select(*keys, _r("scaled"))


@register
def session_texts(spark, sf_dir):
    """The texts that are embedded; rates are moved off the ties, where printing may round either way."""
    off = {c: F.col(c) + 1.3e-8 for c in ("rps", "duration_s", "suspicious_score")}
    moved = scored_sessions(spark, sf_dir).withColumns(off)
    query = F.replace(text.analyst_query_text(), F.lit("\n"), F.lit("/"))
    return moved.select(
        "session_id", text.behaviour_text().alias("model"), text.session_index_text().alias("stored"),
        text.technique_query_text().alias("summary"), query.alias("query"),
    )


@register
def first_suspicious_sessions(spark, sf_dir):
    """The limit of a mapping run: the first sessions by id."""
    return mapping.suspicious_sessions(scored_sessions(spark, sf_dir), 25).select("session_id", "label")


# --- evaluation ------------------------------------------------------------------------------------------------


def _labeled_documents(spark, sf_dir):
    """(scored, labels): all documents with a label made from their length, and hand labels for some."""
    length = F.pmod("n_chars", F.lit(5))
    label = F.when(length == 0, "attack_like").when(length == 1, " Suspicious").otherwise("benign")
    key = F.concat(F.lit("doc-"), F.col("doc_id").cast("string"))
    docs = adapter.read_table(spark, sf_dir, "documents").select(key.alias("session_id"), label.alias("label"))
    truth = F.when(F.col("toxic") == 1, "\tAttack_like\u00a0").when(F.col("quality") == 0, "suspicious").otherwise("benign")
    labels = adapter.read_table(spark, sf_dir, "labels").select(key.alias("session_id"), truth.alias("true_label"))
    return docs, labels


def _metric_rows(spark: SparkSession, report: dict) -> DataFrame:
    """(metric, value) of a detection report."""
    rows = {f"{label}.{name}": value for label, values in report["per_class"].items() for name, value in values.items()}
    rows |= {name: report[name] for name in ("macro_f1", "weighted_f1", "n_evaluated")}
    rows["coverage"] = next(value for name, value in report.items() if name.startswith("coverage_"))
    values = spark.createDataFrame([(k, float(v)) for k, v in rows.items()], "metric string, value double")
    return values.select("metric", _r("value"))


@register
def detection_eval_labeled(spark, sf_dir):
    return _metric_rows(spark, evaluate.detection_metrics_labeled(*_labeled_documents(spark, sf_dir)))


@register
def invalid_labels(spark, sf_dir):
    """Truth that is none of the labels, with its number: languages and sources in place of some labels."""
    docs = adapter.read_table(spark, sf_dir, "documents")
    form = F.pmod("doc_id", F.lit(4))
    truth = F.when(form == 0, F.upper("lang")).when(form == 1, F.col("source")).when(form == 2, "Benign ").otherwise("")
    return evaluate.invalid_labels(docs.select(truth.alias("true_label")))


@register
def detection_eval_csv(spark, sf_dir):
    """The same with the hand labels written to CSV and read back."""
    scored, labels = _labeled_documents(spark, sf_dir)
    path = f"{scratch_root(spark)}/labels-{uuid.uuid4().hex}.csv"
    tables.write_template(labels, path)
    labels = tables.read_labels(spark, path, DETECTION_LABELS)
    return _metric_rows(spark, evaluate.detection_metrics_labeled(scored, labels))


@register
def detection_eval_proxy(spark, sf_dir):
    scored = materialize(scored_sessions(spark, sf_dir), "scored")
    return _metric_rows(spark, evaluate.detection_metrics_proxy(scored))


@register
def proxy_confusion(spark, sf_dir):
    cells = evaluate.confusion(evaluate.proxy_pairs(scored_sessions(spark, sf_dir)))
    return evaluate.confusion_chart(cells).withColumns(
        {"row": F.col("row").cast("bigint"), "col": F.col("col").cast("bigint")}
    )


@register
def proxy_truth(spark, sf_dir):
    return sessions(spark, sf_dir).select("session_id", evaluate.proxy_truth().alias("proxy_true"))


@register
def detection_template(spark, sf_dir):
    out = evaluate.detection_template(scored_sessions(spark, sf_dir), 1000)
    return out.withColumn("suspicious_score", _r("suspicious_score"))


# --- vectors ---------------------------------------------------------------------------------------------------


def _points(spark, sf_dir):
    table = spread(adapter.read_table(spark, sf_dir, "embeddings"), "vec_id")
    agent = F.concat(F.lit("tool-"), F.pmod("vec_id", F.lit(7)).cast("string"))
    payload = F.struct(F.col("label").cast("string").alias("label"), agent.alias("tool"))
    return table.select(F.col("vec_id").alias("point_id"), F.col("embedding").alias("vector"), payload.alias("payload"))


def _queries(spark, sf_dir):
    return _points(spark, sf_dir).select(F.col("point_id").alias("query_id"), "vector")


def _flat_hits(df: DataFrame) -> DataFrame:
    return df.select("query_id", "rank", "point_id", _r("score"))


@register
def vector_topk(spark, sf_dir):
    """Every vector against all vectors."""
    return _flat_hits(similarity.topk(_queries(spark, sf_dir), _points(spark, sf_dir), 10))


@register
def vector_topk_scan(spark, sf_dir):
    """The same by one pass over the points."""
    return _flat_hits(similarity.scan_points(_queries(spark, sf_dir), _points(spark, sf_dir), 10))


@register
def vector_topk_cells(spark, sf_dir):
    """The same by cells around pivots, the way for two large sides."""
    found = knn.knn_join(_queries(spark, sf_dir), _points(spark, sf_dir), 10, rows_per_cell=100, chunk=150)
    return _flat_hits(found)


@register
def vector_topk_filtered(spark, sf_dir):
    """Payload filters come before the search, so k rows remain as long as that many match."""
    hits = points.search(_queries(spark, sf_dir), _points(spark, sf_dir), 10, label="3", tool="tool-2")
    return hits.select("query_id", "rank", "point_id", _r("score"), "payload.label", "payload.tool")


def _index(spark, sf_dir):
    """(queries, points, index): every point indexed and written, every 20th point asked for."""
    stored = _points(spark, sf_dir).select("point_id", "vector")
    index = ivf.build(stored, f"{scratch_root(spark)}/index-{uuid.uuid4().hex}")
    asked = index.vectors.filter(F.pmod("point_id", F.lit(20)) == 0).withColumnRenamed("point_id", "query_id")
    return asked, index.vectors, index


def _metrics(row: DataFrame) -> DataFrame:
    """One row of numbers in long form."""
    return row.select([F.col(c).cast("double") for c in row.columns]).unpivot([], row.columns, "metric", "value")


@register
def index_search(spark, sf_dir):
    """The best ten by the inverted-file index, with exact scores, for every 20th vector."""
    asked, _, index = _index(spark, sf_dir)
    return _flat_hits(ivf.search(asked, index, 10))


@register
def index_recall(spark, sf_dir):
    """The index against the exact search: all points indexed, recall of 0.9 reached, fewer codes and vectors read."""
    asked, stored, index = _index(spark, sf_dir)
    exact = similarity.topk(asked, stored, 10)
    found = ivf.recall(ivf.search(asked, index, 10), exact)
    work = ivf.compared(asked, index)
    indexed = index.codes.agg(F.countDistinct("point_id").alias("indexed"))
    row = found.crossJoin(work).crossJoin(indexed)  # one row each
    reached = (F.col("recall") >= 0.9).alias("recall_reached")
    return _metrics(row.select("queries", "indexed", "pairs", reached, (F.col("codes") < F.col("pairs")).alias("fewer_codes"), (F.col("vectors") < F.col("pairs")).alias("fewer_vectors")))


@register
def graph_recall(spark, sf_dir):
    """The neighbour graph of all vectors against the exact one: its edges, and recall of 0.9 reached for every 20th."""
    stored = _points(spark, sf_dir).select("point_id", "vector")
    edges = materialize(graph.neighbour_graph(stored, lof.NEIGHBOURS), "graph")
    asked = stored.filter(F.pmod("point_id", F.lit(20)) == 0).withColumnRenamed("point_id", "query_id")
    exact = materialize(similarity.topk(asked, stored, lof.NEIGHBOURS, exclude_self=True), "exact")
    counted = edges.agg(F.count(F.lit(1)).alias("edges"), F.countDistinct("query_id").alias("nodes"))
    both = exact.join(edges.select("query_id", "point_id", F.col("score").alias("own")), ["query_id", "point_id"])
    wrong = both.agg(F.count_if(F.abs(F.col("own") - F.col("score")) > 1e-8).alias("wrong_scores"))
    row = ivf.recall(edges, exact).crossJoin(counted).crossJoin(wrong)  # one row each
    return _metrics(row.select("queries", "nodes", "edges", "wrong_scores", (F.col("recall") >= 0.9).alias("recall_reached")))


@register
def points_upsert(spark, sf_dir):
    """Points of one label replaced by turned ones, and new points added behind the largest id."""
    stored = _points(spark, sf_dir)
    changed = _changed(stored)
    merged = points.upsert(stored, changed)
    return merged.select("point_id", "payload.label", "payload.tool", _r(F.col("vector")[0].cast("double"), "first"))


def _changed(stored: DataFrame) -> DataFrame:
    """Points of one label turned, and those of another once more behind the largest id."""
    last = stored.agg(F.max("point_id").alias("m")).scalar()
    moved = F.when(F.col("payload.label") == "4", F.col("point_id")).otherwise(F.col("point_id") + last + 1)
    return stored.filter(F.col("payload.label").isin("4", "5")).select(
        moved.alias("point_id"),
        F.reverse("vector").alias("vector"),
        F.struct(F.lit("new").alias("label"), F.col("payload.tool")).alias("payload"),
    )


@register
def collection_versions(spark, sf_dir):
    """A stored collection made if missing, filled, refused vectors of another length, changed: both versions as read."""
    rows = _points(spark, sf_dir)
    stored = collections.Collection(spark, scratch_root(spark), f"collection-{uuid.uuid4().hex}")
    empty = stored.create(rows.agg(F.max(F.size("vector"))).first()[0], rows.schema)
    first = stored.upsert(rows)
    try:
        stored.upsert(rows.withColumn("vector", F.slice("vector", 1, 3)))
    except ValueError:
        refused = 1
    stored.create(empty.dim, rows.schema)
    second = stored.upsert(_changed(rows))
    read = [stored.read(v.number).withColumn("version", F.lit(n).cast("bigint")) for n, v in enumerate((first, second), refused)]
    both = read[0].unionByName(read[1])
    return both.select("version", "point_id", "payload.label", "payload.tool", _r(F.col("vector")[0].cast("double"), "first"))


@register
def collection_info(spark, sf_dir):
    return points.collection_info(_points(spark, sf_dir))


@register
def points_scroll(spark, sf_dir):
    page = points.scroll(_points(spark, sf_dir), 500)
    return page.select("point_id", "payload.label", F.size("vector").cast("bigint").alias("dim"))


@register
def points_retrieve(spark, sf_dir):
    """The points whose ids are keys of order lines' suppliers."""
    ids = adapter.read_table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("point_id"))
    found = points.retrieve(_points(spark, sf_dir), ids)
    return found.select("point_id", "payload.label", "payload.tool")


@register
def dense_numbers(spark, sf_dir):
    """Numbers 0, 1, 2, ... in order of session id, as the session collection uses them."""
    numbered = points.dense_index(sessions(spark, sf_dir).select("session_id"), "session_id", "point_id")
    return numbered.select("point_id", "session_id")


@register
def session_point_payloads(spark, sf_dir):
    stored = points.session_points(scored_sessions(spark, sf_dir), HashingEmbedder())
    rounded = {"suspicious_score": _r("suspicious_score"), "rps": _r("rps")}
    return stored.select("point_id", F.size("vector").cast("bigint").alias("dim"), "payload.*").withColumns(rounded)


@register
def session_search(spark, sf_dir):
    """Each tool's name, as text, against the attack-like sessions."""
    scored = materialize(scored_sessions(spark, sf_dir), "scored")
    stored = materialize(points.session_points(scored, HashingEmbedder()), "session-points")
    asked = scored.select(F.col("tool").alias("query_id")).distinct()
    asked = asked.withColumn("text", F.concat(F.lit("etc passwd traversal attempt tool="), "query_id"))
    hits = points.search_text(asked, stored, HashingEmbedder(), 10, label="attack_like", tool="")
    return hits.select("query_id", "rank", "point_id", _r("score"), "payload.session_id", "payload.tool")


@register
def lof_scores(spark, sf_dir):
    vectors = _points(spark, sf_dir).select("point_id", "vector")
    return lof.lof_scores(vectors, "point_id").select("point_id", _r("ml_score"))


@register
def lof_duplicates(spark, sf_dir):
    """Every vector once, and half of them in one to sixty copies."""
    vectors = _points(spark, sf_dir).select("point_id", "vector")
    copies = F.when(F.pmod("point_id", F.lit(2)) == 0, F.pmod("point_id", F.lit(61))).otherwise(0)
    many = vectors.select(F.explode(F.sequence(F.lit(0), copies)).alias("copy"), "point_id", "vector")
    row = (F.col("point_id") * 100 + F.col("copy")).alias("row_id")
    return lof.lof_scores(many.select(row, "vector"), "row_id").select("row_id", _r("ml_score"))


@register
def isolation_forest_scores(spark, sf_dir):
    vectors = _points(spark, sf_dir).select("point_id", "vector")
    return forest_scores(vectors, "point_id").select("point_id", _r("ml_score"))


@register
def pca_3d(spark, sf_dir):
    out = projection.principal_components(_points(spark, sf_dir), "vector", 3)
    axes = [_r(F.col("components")[i], n) for i, n in enumerate("xyz")]
    return out.select("point_id", "payload.label", *axes)


@register
def forest_properties(spark, sf_dir):
    """What holds for the scores of any forest: one for each row, from 0 to 1, nearer to 1 for a planted outlier."""
    vectors = _points(spark, sf_dir).select("point_id", "vector")
    far = vectors.agg(F.min("point_id").alias("least")).select(
        (F.col("least") - 1).alias("point_id"), F.array_repeat(F.lit(3.0).cast("float"), 64).alias("vector")
    )
    scores = materialize(forest_scores(vectors.union(far), "point_id"), "forest")
    out = scores.agg(
        F.count("*").cast("double").alias("rows"), F.min("ml_score").alias("least"), F.max("ml_score").alias("greatest"),
        (F.min("point_id") == F.max_by("point_id", "ml_score")).cast("double").alias("outlier_first"),
    )
    return out.unpivot([], out.columns, "metric", "value").select("metric", _r("value"))


@register
def pca_properties(spark, sf_dir):
    """What holds for principal components: mean zero, no covariance, variances in order."""
    found = projection.principal_components(_points(spark, sf_dir), "vector", 3)
    x, y, z = (F.col("components")[i].cast("double") for i in range(3))
    ordered = (F.variance(x) >= F.variance(y)) & (F.variance(y) >= F.variance(z)) & (F.variance(z) > 0)
    means = [F.abs(F.round(F.avg(c), 4)) for c in (x, y, z)]
    cross = [F.abs(F.round(F.covar_samp(a, b), 4)) for a, b in ((x, y), (x, z), (y, z))]
    out = found.agg(
        F.count("*").cast("double").alias("rows"), F.greatest(*cross).alias("covariance"), ordered.cast("double").alias("in_order"),
        F.greatest(*means).alias("mean"),
    )
    return out.unpivot([], out.columns, "metric", "value").select("metric", _r("value"))


@register
def vector_covariance(spark, sf_dir):
    """The covariance that components come from, added up from the parts of each label."""
    of = moments.moments(moments.parts(_points(spark, sf_dir).select("payload.label", "vector"), "label"))
    cells = [(i, j, float(of.covariance[i, j])) for i in range(len(of.mean)) for j in range(i, len(of.mean))]
    return spark.createDataFrame(cells, "i bigint, j bigint, covariance double").select("i", "j", _r("covariance"))


@register
def forest_stored(spark, sf_dir):
    """A fitted forest written twice and read back: tables and a stream are scored as by the one that was fitted."""
    out = f"{scratch_root(spark)}/forest-{uuid.uuid4().hex}"
    vectors = materialize(_points(spark, sf_dir).select("point_id", "vector"), "vectors")
    fitted = iforest.fit_scorer(vectors, "point_id")
    last = max(iforest.save_scorer(fitted, spark, f"{out}/model") for _ in range(2))
    read = iforest.load_scorer(spark, f"{out}/model")
    vectors.write.parquet(f"{out}/in")
    stream = spark.readStream.schema(vectors.schema).parquet(f"{out}/in")
    streamed = _ran(read.score(stream, out="streamed"), out).select("point_id", "streamed")
    both = streamed.join(read.score(vectors, out="stored"), "point_id").join(fitted.score(vectors, out="own").drop("vector"), "point_id")
    both = both.join(forest_scores(vectors, "point_id"), "point_id")
    row = both.agg(
        F.count(F.lit(1)).alias("rows"), F.lit(last).alias("versions"),
        F.count_if((F.col("streamed") != F.col("stored")) | (F.col("stored") != F.col("own"))).alias("differ"),
        F.count_if(F.abs(F.col("own") - F.col("ml_score")) > 1e-9).alias("differ_from_batch"),
    )
    return _metrics(row)


@register
def detect_forest(spark, sf_dir):
    found = pipeline.detect(materialize(sessions(spark, sf_dir), "sessions"))
    return found.select("session_id", _r("rule_score"), _r("ml_score"), _r("suspicious_score"), "label")


@register
def detect_lof(spark, sf_dir):
    found = pipeline.detect(materialize(sessions(spark, sf_dir), "sessions"), use_lof=True)
    return found.select("session_id", _r("rule_score"), _r("ml_score"), _r("suspicious_score"), "label")


# --- mapping ---------------------------------------------------------------------------------------------------


def _technique_points(spark, sf_dir):
    """Every vector as a technique with one or two tactics."""
    table = adapter.read_table(spark, sf_dir, "embeddings")
    names = F.array(*[F.lit(t) for t in TACTICS])
    label = F.pmod("label", F.lit(len(TACTICS)))
    second = F.get(names, F.pmod(label * 3 + 1, F.lit(len(TACTICS))))
    tactics = F.when(F.pmod("vec_id", F.lit(3)) == 0, F.array(F.get(names, label))).otherwise(
        F.array(F.get(names, label), second)
    )
    payload = F.struct(
        F.concat(F.lit("T"), (F.col("vec_id") + 1000).cast("string")).alias("technique_id"),
        F.concat(F.lit("technique "), F.col("vec_id").cast("string")).alias("name"),
        tactics.alias("tactics"),
    )
    return table.select(F.col("vec_id").alias("point_id"), F.col("embedding").alias("vector"), payload.alias("payload"))


def _session_vectors(spark, sf_dir, scored=None):
    """Suspicious sessions, each with the sum of two vectors that its counts point at."""
    table = adapter.read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    n = table.agg(F.count(F.lit(1)).alias("n")).scalar()
    chosen = mapping.suspicious_sessions(scored_sessions(spark, sf_dir) if scored is None else scored)
    one = F.pmod(F.col("event_count") * 7919 + F.unix_seconds("start_ts"), n)
    two = F.pmod(F.col("unique_ports") * 104729 + F.unix_seconds("end_ts") + 1, n)
    keyed = chosen.withColumn("one", one).withColumn("two", two).withColumn("summary", text.technique_query_text())
    first = table.select(F.col("vec_id").alias("one"), F.col("embedding").alias("e1"))
    second = table.select(F.col("vec_id").alias("two"), F.col("embedding").alias("e2"))
    added = F.zip_with("e1", "e2", lambda a, b: a.cast("double") + b.cast("double"))
    return keyed.join(first, "one").join(second, "two").withColumn("vector", added).drop("e1", "e2")


def _mapping(spark, sf_dir, scored=None):
    return mapping.map_vectors(_session_vectors(spark, sf_dir, scored), _technique_points(spark, sf_dir))


def _flat_mapping(df: DataFrame) -> DataFrame:
    tactics = F.array_join(F.transform("mapped_tactics", lambda t: F.array_join(t, "+")), ",")
    return df.select(
        "session_id", "src_ip", "label", "tool", _r("suspicious_score"), _epoch("start_ts"),
        _joined("mapped_techniques"), _joined("mapped_names"), tactics.alias("mapped_tactics"),
        _r("confidence"), _joined("why"),
    )


@register
def session_technique_mapping(spark, sf_dir):
    return _flat_mapping(_mapping(spark, sf_dir))


@register
def session_technique_mapping_join(spark, sf_dir):
    """The same with the plan for a corpus too large to travel."""
    mapped = mapping.map_vectors(_session_vectors(spark, sf_dir), _technique_points(spark, sf_dir), limit=0)
    return _flat_mapping(mapped)


@register
def boost_confidence(spark, sf_dir):
    scored = scored_sessions(spark, sf_dir)
    lift = confidence.boost(F.col("tool"), F.col("rule_reasons"), F.col("reasons"))
    fixed = confidence.boost(F.col("tool"), F.col("rule_reasons"), F.col("reasons"), match_lfi_rule=True)
    sim = F.pmod(F.col("event_count") * 13 + F.col("unique_ports"), F.lit(151)) / F.lit(100.0) - 0.2
    return scored.select(
        "session_id", _r(lift, "boost"), _r(fixed, "boost_fixed"), _r(confidence.confidence(sim, lift), "confidence")
    )


@register
def ranked_candidates(spark, sf_dir):
    """The best three of each session's candidates, all of a source's tools being candidates for it."""
    rows = scored_sessions(spark, sf_dir)
    sim = F.pmod(F.col("event_count") * 7 + F.col("indicator_hits"), F.lit(31)) / F.lit(30.0)
    lift = confidence.boost(F.col("tool"), F.col("rule_reasons"), F.col("reasons"))
    candidates = rows.select(
        F.col("src_ip").alias("session_id"),
        F.col("session_id").alias("point_id"),
        sim.alias("sim"),
        F.round(confidence.confidence(sim, lift), 9).alias("confidence"),
    )
    return mapping.rank_candidates(candidates).select("session_id", "point_id", "rank", _r("sim"), _r("confidence"))


def _mapping_and_labels(spark, sf_dir):
    """Both from one written table of scored sessions."""
    scored = materialize(scored_sessions(spark, sf_dir), "scored")
    return _mapping(spark, sf_dir, scored), _mapping_labels(spark, sf_dir, scored)


def _mapping_labels(spark, sf_dir, found=None):
    """True techniques per mapped session, as single ids, three kinds of lists, or blank."""
    table = adapter.read_table(spark, sf_dir, "embeddings")
    n = table.agg(F.count(F.lit(1)).alias("n")).scalar()
    scored = mapping.suspicious_sessions(scored_sessions(spark, sf_dir) if found is None else found)
    one = F.pmod(F.col("event_count") * 7919 + F.unix_seconds("start_ts"), n)
    two = F.pmod(F.col("unique_ports") * 104729 + F.unix_seconds("end_ts") + 1, n)
    a = F.concat(F.lit("T"), (one + 1000).cast("string"))
    b = F.concat(F.lit("T"), (two + 1001).cast("string"))
    form = F.pmod(F.unix_seconds("start_ts"), F.lit(10))
    cell = (
        F.when(form == 0, b)
        .when(form == 1, F.concat(b, F.lit(" | "), a))
        .when(form == 2, F.concat(a, F.lit(",,"), b))
        .when(form == 3, F.concat(F.lit('["'), b, F.lit('", " '), a, F.lit(' "]')))
        .when(form == 4, F.lit("  "))
        .when(form == 6, F.concat(F.lit("['"), b, F.lit("', '"), a, F.lit("']")))
        .when(form == 7, F.concat(F.lit('["'), b, F.lit('"] ["'), a, F.lit('"]')))
        .when(form == 8, F.concat(F.lit("\t"), b, F.lit("\t|\u00a0"), a, F.lit(" \t")))
        .when(form == 9, F.concat(F.lit('\t["'), b, F.lit('", true, null, 5, false]')))
        .otherwise(F.concat(F.lit("[not json "), F.lit("|"), a, F.lit("]")))
    )
    return scored.select("session_id", cell.alias("true_technique_ids"))


@register
def array_cells(spark, sf_dir):
    """List cells of all forms taken apart."""
    labels = _mapping_labels(spark, sf_dir)
    items = arrays.list_from_text(F.col("true_technique_ids"))
    return labels.select("session_id", "true_technique_ids", F.array_join(items, "/").alias("items"))


@register
def mapping_eval_labeled(spark, sf_dir):
    hits = evaluate.mapping_hits_labeled(*_mapping_and_labels(spark, sf_dir), 10)
    return hits.select("n_evaluated", _r("top1_accuracy"), _r("top3_accuracy"), _r("recall_at_k"))


@register
def mapping_eval_proxy(spark, sf_dir):
    out = evaluate.mapping_alignment(_mapping(spark, sf_dir))
    return out.select(
        "n_evaluated", _r("tactic_alignment_top1"), _r("tactic_alignment_top3"), _r("avg_confidence")
    )


@register
def mapping_score_bars(spark, sf_dir):
    bars = {"tactic_alignment_top1": "tactic_top1", "tactic_alignment_top3": "tactic_top3", "avg_confidence": "avg_conf"}
    out = evaluate.score_bars(evaluate.mapping_alignment(_mapping(spark, sf_dir)), bars)
    return out.select("metric", _r("value"))


@register
def expected_tactics(spark, sf_dir):
    ruled = apply_rules(sessions(spark, sf_dir))
    return ruled.select("session_id", F.array_join(evaluate.expected_tactics(F.col("rule_reasons")), ",").alias("tactics"))


@register
def technique_counts(spark, sf_dir):
    return analytics.technique_counts(_mapping(spark, sf_dir))


@register
def tactic_counts(spark, sf_dir):
    return analytics.tactic_counts(_mapping(spark, sf_dir))


@register
def mapping_features(spark, sf_dir):
    out = analytics.mapping_features(_mapping(spark, sf_dir))
    return out.withColumns({"suspicious_score": _r("suspicious_score"), "confidence": _r("confidence")})


@register
def score_vs_confidence(spark, sf_dir):
    return analytics.score_vs_confidence(_mapping(spark, sf_dir)).select("label", _r("x"), _r("y"), "z")


@register
def hour_vs_confidence(spark, sf_dir):
    return analytics.hour_vs_confidence(_mapping(spark, sf_dir)).select("label", "x", _r("y"), _r("z"))


@register
def mapping_template(spark, sf_dir):
    out = evaluate.mapping_template(_mapping(spark, sf_dir), 1000)
    return out.drop("summary").withColumn("pred_confidence", _r("pred_confidence"))


@register
def mapping_labels_csv(spark, sf_dir):
    """Label cells of all forms through CSV: what is read equals what was written."""
    path = f"{scratch_root(spark)}/mapping-labels-{uuid.uuid4().hex}.csv"
    tables.write_template(_mapping_labels(spark, sf_dir), path)
    labels = tables.read_labels(spark, path, MAPPING_LABELS)
    items = arrays.list_from_text(F.col("true_technique_ids"))
    return labels.select("session_id", F.array_join(items, "/").alias("items"))


@register
def map_sessions_text(spark, sf_dir):
    """Mapping by text: techniques written from parts, suppliers and order lines, sessions by their summary."""
    # Without the documents, which only a lookup by id reads; the fields are read a last time for the collection.
    typed = materialize(stix.typed_objects(_objects(spark, sf_dir)).drop("json"), "objects")
    names = stix.mitigation_names(stix.mitigations(typed))
    corpus = materialize(points.technique_points(stix.techniques(typed), names, HashingEmbedder()), "techniques")
    discard(typed)
    mapped = mapping.map_sessions(scored_sessions(spark, sf_dir), corpus, HashingEmbedder())
    return _flat_mapping(mapped)


@register
def mapping_coverage(spark, sf_dir):
    report = evaluate.mapping_metrics_labeled(*_mapping_and_labels(spark, sf_dir), 10)
    rows = [(k, float(report[k])) for k in ("n_evaluated", "coverage_vs_labels", "top1_accuracy", "top3_accuracy")]
    rows.append(("recall_at_10", float(report["retrieval_recall_at_k"]["value"])))
    return spark.createDataFrame(rows, "metric string, value double").select("metric", _r("value"))


@register
def eval_report_proxy(spark, sf_dir):
    """The whole report, written as JSON, read back, in long form."""
    scored = materialize(scored_sessions(spark, sf_dir), "scored")
    techniques = _technique_points(spark, sf_dir).select("payload.technique_id")
    mapped = _mapping(spark, sf_dir, scored)
    return _report_rows(spark, evaluate.run_eval(scored, materialize(mapped, "mapping"), techniques))


def _report_rows(spark: SparkSession, report: dict) -> DataFrame:
    out = f"{scratch_root(spark)}/report-{uuid.uuid4().hex}"
    tables.write_report(spark, report, out)
    return evaluate.report_table(spark, tables.read_report(spark, out)).select("section", "metric", _r("value"))


@register
def eval_report_labeled(spark, sf_dir):
    """The same against labels: of documents for the detection, of sessions for the mapping."""
    docs, labels = _labeled_documents(spark, sf_dir)
    scored = materialize(scored_sessions(spark, sf_dir), "scored")
    techniques = _technique_points(spark, sf_dir).select("payload.technique_id")
    mapped = _mapping(spark, sf_dir, scored)
    cells = materialize(_mapping_labels(spark, sf_dir, scored), "cells")
    report = evaluate.run_eval(docs, materialize(mapped, "mapping"), techniques, "labeled", labels, cells)
    return _report_rows(spark, report)


# --- knowledge -------------------------------------------------------------------------------------------------


def _objects(spark, sf_dir):
    """A bundle's objects from the shared tables: parts are techniques, suppliers act, order lines relate them."""
    parts = adapter.read_table(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string")

    def ref(source: str, identifier: Column) -> Column:
        return F.struct(F.lit(source).alias("source_name"), identifier.alias("external_id"))

    def phase(chain: str, name: Column) -> Column:
        return F.struct(F.lit(chain).alias("kill_chain_name"), name.alias("phase_name"))

    number = F.concat(F.lit("T"), (F.floor(F.col("p_partkey") / 2) + 1000).cast("string"))
    refs = F.when(F.col("p_size") % 10 != 0, F.array(ref("other", F.lit("T9")), ref("mitre-attack", number)))
    phases = F.array(
        phase("mitre-attack", F.lower("p_type")),
        phase("mitre-attack", F.concat(F.lit("p"), (F.col("p_size") % 5).cast("string"))),
        phase("mitre-attack", F.lower("p_type")),
        phase("other", F.lit("x")),
    )
    techniques = parts.select(
        F.col("p_partkey").alias("pos"),
        F.to_json(F.struct(
            F.lit("attack-pattern").alias("type"),
            F.concat(F.lit("attack-pattern--"), key).alias("id"),
            F.col("p_name").alias("name"),
            F.concat("p_brand", F.lit("\n"), "p_type").alias("description"),
            refs.alias("external_references"),
            phases.alias("kill_chain_phases"),
            F.when(F.col("p_size") % 3 != 0, F.col("p_size") % 2 == 0).alias("x_mitre_is_subtechnique"),
            F.when(F.col("p_size") % 4 != 0, F.array("p_brand", F.lit("Linux"))).alias("x_mitre_platforms"),
        )).alias("json"),
    )
    actions = adapter.read_table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + 10**9).alias("pos"),
        F.to_json(F.struct(
            F.lit("course-of-action").alias("type"),
            F.concat(F.lit("course-of-action--"), F.col("s_suppkey").cast("string")).alias("id"),
            F.col("s_name").alias("name"),
            F.col("s_nationkey").cast("string").alias("description"),
        )).alias("json"),
    )
    place = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 2**25 + F.col("l_partkey") * 1009 + F.col("l_suppkey")
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"]
    items = spread(adapter.read_table(spark, sf_dir, "lineitem").select(*columns), "l_orderkey")
    lines = items.select(
        (place + 2 * 10**9).alias("pos"),
        F.to_json(F.struct(
            F.lit("relationship").alias("type"),
            F.concat_ws("-", F.lit("relationship-"), "l_orderkey", "l_linenumber").alias("id"),
            F.when(F.col("l_returnflag") == "A", "uses").otherwise("mitigates").alias("relationship_type"),
            F.concat(F.lit("course-of-action--"), F.col("l_suppkey").cast("string")).alias("source_ref"),
            F.concat(F.lit("attack-pattern--"), F.col("l_partkey").cast("string")).alias("target_ref"),
        )).alias("json"),
    )
    return techniques.unionByName(actions).unionByName(lines)


def _typed(spark, sf_dir):
    return materialize(stix.typed_objects(_objects(spark, sf_dir)), "objects")


def _flat_techniques(df: DataFrame) -> DataFrame:
    return df.select(
        "stix_id", "technique_id", "name", F.replace("description", F.lit("\n"), F.lit("/")).alias("description"),
        _joined("tactics"), "is_subtechnique", _joined("platforms"),
    )


@register
def stix_techniques(spark, sf_dir):
    return _flat_techniques(stix.techniques(_typed(spark, sf_dir)))


# Fixed value: a document is some 3 MB, read as one row.
OBJECTS_PER_DOCUMENT = 20_000


def _bundles(spark, sf_dir):
    """The objects as compressed bundle documents, one for each of the ranges that they are dealt to; the folder."""
    out = f"{scratch_root(spark)}/bundles-{uuid.uuid4().hex}"

    def document(batches):
        head, between = '{"type":"bundle","id":"bundle--1","objects":[', ""
        for batch in batches:
            if len(batch):
                lines = pc.binary_join_element_wise(",", batch.column(0), "")
                lines = pa.concat_arrays([pa.array([head + between + batch.column(0)[0].as_py()]), lines.slice(1)])
                head, between = "", ","
                yield pa.RecordBatch.from_arrays([lines], ["value"])
        yield pa.RecordBatch.from_arrays([pa.array([head + "]}"])], ["value"])

    objects = _objects(spark, sf_dir)
    parts = max(objects.count() // OBJECTS_PER_DOCUMENT, 1)
    dealt = objects.repartitionByRange(parts, "pos").sortWithinPartitions("pos").select("json")
    dealt.mapInArrow(document, "value string").write.option("compression", "gzip").text(out)
    return out


@register
def bundle_techniques(spark, sf_dir):
    """From bundle documents, through the written knowledge tables, to techniques."""
    known = tables.build_knowledge(spark, _bundles(spark, sf_dir), f"{scratch_root(spark)}/knowledge-{uuid.uuid4().hex}")
    return _flat_techniques(tables.read_knowledge(spark, known)[0])


@register
def bundle_mitigations(spark, sf_dir):
    """The same for who mitigates what, with how many times each pair is there."""
    known = tables.build_knowledge(spark, _bundles(spark, sf_dir), f"{scratch_root(spark)}/knowledge-{uuid.uuid4().hex}")
    rows = tables.read_knowledge(spark, known)[1]
    return rows.groupBy("technique_id", "stix_id", "name", "description").agg(F.count(F.lit(1)).alias("times"))


@register
def stix_techniques_by_id(spark, sf_dir):
    return _flat_techniques(stix.techniques_by_id(stix.techniques(_typed(spark, sf_dir))))


@register
def stix_objects_by_id(spark, sf_dir):
    found = stix.objects_by_id(_typed(spark, sf_dir))
    return found.select("id", F.get_json_object("json", "$.target_ref").alias("target_ref"))


@register
def technique_mitigations(spark, sf_dir):
    return stix.mitigations(_typed(spark, sf_dir))


@register
def technique_texts(spark, sf_dir):
    typed = _typed(spark, sf_dir)
    names = stix.mitigation_names(stix.mitigations(typed))
    joined = stix.techniques(typed).filter(F.col("technique_id").isNotNull()).join(names, "technique_id", "left")
    listed = F.coalesce("names", F.array().cast("array<string>"))
    return joined.select(
        "stix_id", text.technique_text(listed).alias("text"), F.array_join(listed, ",").alias("mitigations")
    )


@register
def knowledge_counts(spark, sf_dir):
    typed = _typed(spark, sf_dir)
    return analytics.knowledge_counts(stix.techniques(typed), stix.mitigations(typed))


@register
def knowledge_sample(spark, sf_dir):
    """The first ten techniques of the bundle that have an id, a look at the data."""
    return _flat_techniques(analytics.knowledge_sample(stix.techniques(_typed(spark, sf_dir))))


@register
def technique_point_payloads(spark, sf_dir):
    typed = _typed(spark, sf_dir)
    names = stix.mitigation_names(stix.mitigations(typed))
    stored = points.technique_points(stix.techniques(typed), names, HashingEmbedder())
    flat = stored.select("point_id", F.size("vector").cast("bigint").alias("dim"), "payload.*")
    return flat.withColumns({c: _joined(c) for c in ("tactics", "platforms", "mitigations")})
