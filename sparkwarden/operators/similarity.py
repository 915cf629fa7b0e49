"""Exact top-k by cosine: (query_id, vector) against (point_id, vector).

Three plans, chosen by counted sizes:

* few points: they travel to every task as one matrix; queries stream past, nothing is shuffled;
* few queries: they travel, points stream past, each task keeps its best k per query, a window merges them;
* many of both: ``operators.knn``, which visits only those groups of points that can hold a better neighbour.

Scores are cosines rounded to nine decimals and ties go to the lower point id, so equal vectors rank alike
whatever the block they fall in.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkwarden.operators.embedding import list_array, rows_of, unit_rows
from sparkwarden.session import even

HITS = "query_id {kind}, point_id bigint, score double"
BROADCAST_BYTES = 64 << 20
TASK_SCORES = 1 << 29  # scores that a task makes where points travel: some seconds
_SCALE = 1_000_000_000
_ROWS, _COLUMNS = 1024, 256  # queries and points whose scores a task holds at once
_FEW_ROWS, _MANY_COLUMNS = 128, 4096  # the same where queries are mostly empty
_SPARSE = 0.25  # share of filled places up to which queries count as mostly empty
_FIRST = 512  # points that give the first bound
_HELD = 64  # slots per query that wait to be merged, at most, besides those of one block
_NONE = np.iinfo(np.int64).min


@dataclass(frozen=True)
class Corpus:
    """Points small enough to travel, in ascending order of id."""

    ids: np.ndarray
    unit: np.ndarray


def _alike(queries: np.ndarray) -> np.ndarray | None:
    """An order of mostly empty rows in which neighbours fill the same few columns; None for other rows.

    Rows meet by their two rarest columns, each taken in ranges.
    """
    filled = queries != 0
    if filled.mean() > _SPARSE:
        return None
    width = queries.shape[1]
    rank = np.empty(width, dtype=np.int16 if width < 1 << 15 else np.int64)
    rank[np.argsort(filled.sum(axis=0), kind="stable")] = np.arange(width)
    rarest = np.empty((len(queries), 2), dtype=np.int64)
    for start in range(0, len(queries), _MANY_COLUMNS):
        ranks = np.where(filled[start : start + _MANY_COLUMNS], rank, width)
        rarest[start : start + _MANY_COLUMNS] = np.partition(np.pad(ranks, ((0, 0), (0, 2)), constant_values=width), 1, axis=1)[:, :2]
    first, second = rarest.T
    side = math.isqrt(width) + 1
    return np.lexsort((second, first, second // side, first // side))


def top_slots(
    queries: np.ndarray, corpus: np.ndarray, k: int, skip: np.ndarray | None = None, floor: np.ndarray | None = None
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Blocks of (first query row, best slots, their scores); rows of both matrices have length one.

    ``skip`` names one slot per query that must not be chosen (-1: none), ``floor`` a score per query below which no
    slot is needed. Places without a slot score -inf.

    Products are made in single precision, block by block. Only pairs that reach the k-th best so far, less what the
    rounding can have taken, are scored in double precision, so the result is that of double precision throughout.
    Mostly empty queries are taken in an order in which a block has few columns, and multiplied over these only.
    """
    order = _alike(queries) if len(queries) else None
    if order is None:
        for start in range(0, len(queries), _ROWS):
            rows = np.arange(start, min(start + _ROWS, len(queries)))
            yield start, *_best_of(queries, rows, corpus, None, k, skip, floor)
        return
    wide = np.ascontiguousarray(corpus.astype(np.float32).T)
    slots = np.zeros((len(queries), min(k, len(corpus))), dtype=np.int64)
    scores = np.zeros(slots.shape)
    for start in range(0, len(queries), _FEW_ROWS):
        rows = order[start : start + _FEW_ROWS]
        slots[rows], scores[rows] = _best_of(queries, rows, corpus, wide, k, skip, floor)
    yield 0, slots, scores


def _best_of(
    queries: np.ndarray,
    rows: np.ndarray,
    corpus: np.ndarray,
    wide: np.ndarray | None,
    k: int,
    skip: np.ndarray | None,
    floor: np.ndarray | None,
) -> tuple[np.ndarray, np.ndarray]:
    """Best slots of some rows and their scores; ``wide`` is the corpus by columns, in single precision."""
    m = len(corpus)
    k = min(k, m)
    slack = (queries.shape[1] + 8) * 1.2e-7  # twice the largest error of a single precision product of unit rows
    block = queries[rows]
    rough = block.astype(np.float32)
    if wide is not None:
        columns = np.flatnonzero(block.any(axis=0))
        rough = np.ascontiguousarray(rough[:, columns])
    own = None if skip is None else skip[rows]
    # No product of unit rows is below -2, so a slot that must not be chosen, at -inf, never passes.
    lowest = np.full((len(block), 1), -2.0) if floor is None else np.maximum(floor[rows, None] - slack, -2.0)
    least = lowest.astype(np.float32)
    best = np.full((len(block), k), _NONE)  # integers that rank by score, then by slot; the least one first
    step = _COLUMNS if wide is None else _MANY_COLUMNS
    held = []  # what may be better, by row and key, since the best were last brought up to date
    low = due = 0
    while low < m:
        part = corpus[low : low + (step if low else max(_FIRST, k))]
        there = part.astype(np.float32).T if wide is None else wide[columns, low : low + len(part)]
        score = rough @ there
        if own is not None:
            mine = np.flatnonzero((own >= low) & (own < low + len(part)))
            score[mine, own[mine] - low] = -np.inf
        if not low and 0 < k < len(part):
            least = np.maximum(lowest, np.partition(score, -k, axis=1)[:, -k:][:, :1] - slack).astype(np.float32)
        # Past the first blocks few rows hold anything better; only these are looked at closely.
        hot = np.flatnonzero(~(score.max(axis=1, keepdims=True) < least))
        near = (score[hot] if len(hot) < len(block) else score) >= least[hot]
        row, column = np.divmod(np.flatnonzero(near), len(part))
        key = np.rint(_scores(block, part, hot[row], column) * _SCALE).astype(np.int64) * m + (m - 1 - low - column)
        better = key > best[hot[row], 0]
        held.append((hot[row[better]], key[better]))
        low += len(part)
        if low >= min(due, m) or sum(len(row) for row, _ in held) > _HELD * len(block):
            best = _merged(best, *(np.concatenate(side) for side in zip(*held)))
            held, due = [], low + min(low, _MANY_COLUMNS)
            worst = best[:, :1]
            least = np.maximum(lowest, np.where(worst == _NONE, -2.0, worst // m / _SCALE - slack)).astype(np.float32)
    best = np.sort(best, axis=1)[:, ::-1]
    missing = best == _NONE
    return np.where(missing, 0, m - 1 - best % max(m, 1)), np.where(missing, -np.inf, best // max(m, 1) / _SCALE)


def _merged(best: np.ndarray, row: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The best keys of each row with those that were found for it, the least one first."""
    if not len(row):
        return best
    k = best.shape[1]
    order = np.argsort(row, kind="stable")
    row, key = row[order], key[order]
    count = np.bincount(row, minlength=len(best))
    rows = np.flatnonzero(count)
    both = np.full((len(rows), k + count.max()), _NONE)
    both[:, :k] = best[rows]
    both[np.searchsorted(rows, row), k + np.arange(len(row)) - (np.cumsum(count) - count)[row]] = key
    best[rows] = np.partition(both, count.max(), axis=1)[:, -k:]
    return best


def _scores(queries: np.ndarray, corpus: np.ndarray, row: np.ndarray, column: np.ndarray) -> np.ndarray:
    """Cosines of the named pairs in double precision."""
    if len(row) * 8 > len(queries) * len(corpus):
        return (queries @ corpus.T)[row, column]
    scores = np.empty(len(row))
    for start in range(0, len(row), _MANY_COLUMNS):
        some = slice(start, start + _MANY_COLUMNS)
        scores[some] = np.einsum("ij,ij->i", queries[row[some]], corpus[column[some]])
    return scores


def vector_bytes(df: DataFrame, vector: str = "vector", payload: str | None = None) -> int:
    """Bytes of all vectors in double precision, and of payloads as text (an action)."""
    each = 8 * F.size(vector)
    if payload:
        each = each + F.length(F.to_json(payload))
    return df.agg(F.sum(each)).first()[0] or 0


def collect_corpus(points: DataFrame, limit: int = BROADCAST_BYTES, payload: str | None = None) -> Corpus | None:
    """The points as one matrix, or None where they, with ``payload`` if it travels too, exceed ``limit`` bytes."""
    if vector_bytes(points, payload=payload) > limit:
        return None
    table = points.select(F.col("point_id").cast("bigint"), "vector").toArrow()
    ids = table.column("point_id").to_numpy()
    order = np.argsort(ids, kind="stable")
    return Corpus(ids[order], unit_rows(rows_of(table.column("vector")))[order])


def dealt(queries: DataFrame, key: str, corpus: Corpus) -> DataFrame:
    """Queries that meet a travelling corpus, in so many tasks that none makes many more than TASK_SCORES scores.

    Counts the queries (an action): tasks grow in number with queries times points, not in length.
    """
    return even(queries, key, -(-queries.count() * len(corpus.ids) // TASK_SCORES))


def nearest(df: DataFrame, corpus: Corpus, k: int, vector: str = "vector", own_id: str | None = None) -> DataFrame:
    """Add ``hits``: (slot, point_id, score) of the best k points, best first. All other columns stay in the JVM.

    With ``own_id`` the point of that id is left out.
    """
    shared = df.sparkSession.sparkContext.broadcast(corpus)

    @F.arrow_udf("struct<slot:array<int>,point_id:array<bigint>,score:array<double>>")
    def search(vectors: pa.Array, own: pa.Array) -> pa.Array:
        points = shared.value
        rows = len(vectors)
        width = min(k, len(points.ids))
        slots = np.zeros((rows, width), dtype=np.int32)
        scores = np.zeros((rows, width))
        skip = None
        if own_id is not None:
            mine = own.to_numpy(zero_copy_only=False)
            at = np.minimum(np.searchsorted(points.ids, mine), max(len(points.ids) - 1, 0))
            skip = np.where(points.ids[at] == mine, at, -1)
        if rows and width:
            for start, best, score in top_slots(unit_rows(rows_of(vectors)), points.unit, k, skip):
                slots[start : start + len(best)] = best
                scores[start : start + len(best)] = score
        columns = [list_array(slots), list_array(points.ids[slots]), list_array(scores)]
        return pa.StructArray.from_arrays(columns, names=["slot", "point_id", "score"])

    own = F.col(own_id).cast("bigint") if own_id else F.lit(0).cast("bigint")
    # Called nondeterministic, so that no filter on what was found is moved below the search and runs it once more.
    found = df.withColumn("_found", search.asNondeterministic()(F.col(vector), own))
    zipped = F.arrays_zip("_found.slot", "_found.point_id", "_found.score")
    hits = F.filter(zipped, lambda h: h["score"] >= -1.5)
    return found.withColumn("hits", hits).drop("_found")


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("point_id"))
    return (
        hits.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("bigint").alias("rank"), "point_id", "score")
    )


def scan_points(queries: DataFrame, points: DataFrame, k: int, limit: int = BROADCAST_BYTES // 16) -> DataFrame:
    """Few queries against any number of points: one pass over the points, k rows per task and query.

    The queries travel, so their size is checked first (an action); more of them meet the points by join.
    """
    if vector_bytes(queries) > limit:
        from sparkwarden.operators.knn import knn_join

        return knn_join(queries, points, k)
    table = queries.select("query_id", "vector").toArrow()
    kind = queries.schema["query_id"].dataType.simpleString()
    shared = queries.sparkSession.sparkContext.broadcast((table.column("query_id").combine_chunks(), unit_rows(rows_of(table.column("vector")))))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, wanted = shared.value
        n = len(names)
        best_ids = np.full((n, k), np.iinfo(np.int64).max)
        best_scores = np.full((n, k), -np.inf)
        for batch in batches:
            if not len(batch) or not n:
                continue
            ids = batch.column(0).to_numpy()
            order = np.argsort(ids, kind="stable")
            unit = unit_rows(rows_of(batch.column(1)))[order]
            for start, slots, scores in top_slots(wanted, unit, k, floor=best_scores[:, -1]):
                rows = slice(start, start + len(slots))
                all_ids = np.concatenate([best_ids[rows], ids[order][slots]], axis=1)
                all_scores = np.concatenate([best_scores[rows], scores], axis=1)
                keep = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
                best_ids[rows] = np.take_along_axis(all_ids, keep, axis=1)
                best_scores[rows] = np.take_along_axis(all_scores, keep, axis=1)
        query, place = np.nonzero(np.isfinite(best_scores))
        if len(query):
            yield pa.RecordBatch.from_arrays(
                [names.take(pa.array(query)), pa.array(best_ids[query, place]), pa.array(best_scores[query, place])],
                names=["query_id", "point_id", "score"],
            )

    part = points.select(F.col("point_id").cast("bigint").alias("point_id"), "vector")
    return _ranked(part.mapInArrow(search, HITS.format(kind=kind)), k)


def topk(
    queries: DataFrame, points: DataFrame, k: int, exclude_self: bool = False, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """(query_id, rank, point_id, score) with the exact best k per query (counts sizes: an action)."""
    corpus = collect_corpus(points, limit)
    if corpus is not None:
        asked = dealt(queries.select("query_id", "vector"), "query_id", corpus)
        found = nearest(asked, corpus, k, own_id="query_id" if exclude_self else None)
        flat = found.select("query_id", F.posexplode("hits").alias("rank", "hit"))
        return flat.select(
            "query_id", (F.col("rank") + 1).cast("bigint").alias("rank"), "hit.point_id", "hit.score"
        )
    if not exclude_self and vector_bytes(queries) <= limit // 16:
        return scan_points(queries, points, k)
    from sparkwarden.operators.knn import knn_join

    return knn_join(queries, points, k, exclude_self)
