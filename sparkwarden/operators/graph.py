"""Neighbour graphs by descent: the neighbours of a point's neighbours are likely its own (Dong et al., WWW 2011).

1. Start. Points are dealt to groups around random pivots, ``TABLES`` times with other pivots, and every group is
   compared whole. A large group is cut by hash, so no task holds more than ``leaf`` points of one.
2. Rounds. Every point gathers those it lists and those that list it, with their vectors, and compares them with each
   other. Only pairs with a fresh edge, and only scores that better the worst neighbour of a member, leave the task. A
   window keeps the best of old and new. A point that very many list takes part with ``k`` of them in each round, others
   by hash in the next: rounds only add, so nothing that was found is lost.
3. The rounds end when fewer than ``least`` of the edges are new.

Edges carry exact cosines at nine decimals. Which edges are found is not certain: ``similarity.topk`` is the exact way,
``ivf.recall`` measures the share. The work is n x k x k scores a round, where the exact way has n x n.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkwarden.operators.embedding import rows_of, unit_rows
from sparkwarden.operators.similarity import _ranked, top_slots
from sparkwarden.session import discard, materialize

TABLES, LEAF, MAX_PIVOTS, ROUNDS, LEAST = 4, 1_000, 2048, 8, 0.01
_SCALE = 1_000_000_000
_EDGE = "query_id bigint, point_id bigint, score double"


def _groups(points: DataFrame, total: int, leaf: int, tables: int) -> DataFrame:
    """``point_id, vector, table, pivot, part``: each point once for each table."""
    n = int(np.clip(2 * total // leaf, 1, MAX_PIVOTS))
    pivots = []
    for t in range(tables):
        rows = points.orderBy(F.xxhash64("point_id", F.lit(t)), "point_id").limit(n).select("vector").toArrow()
        pivots.append(unit_rows(rows_of(rows.column("vector"))))
    shared = points.sparkSession.sparkContext.broadcast(pivots)

    @F.arrow_udf("array<int>")
    def nearest(vectors: pa.Array) -> pa.Array:
        unit = unit_rows(rows_of(vectors)) if len(vectors) else np.zeros((0, 1))
        near = [np.concatenate([(unit[i : i + 2048] @ p.T).argmax(axis=1) for i in range(0, len(unit), 2048)] or [np.zeros(0, int)]) for p in shared.value]
        flat = np.stack(near, axis=1).astype(np.int32).ravel()
        return pa.ListArray.from_arrays(np.arange(len(unit) + 1, dtype=np.int32) * len(near), pa.array(flat))

    dealt = materialize(points.select("point_id", "vector", F.posexplode(nearest("vector")).alias("table", "pivot")), "graph-groups")
    sizes = dealt.groupBy("table", "pivot").agg(F.ceil(F.count(F.lit(1)) / leaf).alias("parts"))  # at most tables x pivots rows
    part = F.pmod(F.xxhash64("point_id", "table"), "parts").cast("int").alias("part")
    return dealt.join(F.broadcast(sizes), ["table", "pivot"]).select("point_id", "vector", "table", "pivot", part)


def _whole(k: int):
    def run(group: pa.Table) -> pa.Table:
        ids = group.column("point_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, unit = ids[order], unit_rows(rows_of(group.column("vector")))[order]
        out = []
        for start, slots, scores in top_slots(unit, unit, k, np.arange(len(ids))):
            row, place = np.nonzero(np.isfinite(scores))
            out.append((ids[row + start], ids[slots[row, place]], scores[row, place]))
        return pa.table(dict(zip(("query_id", "point_id", "score"), map(np.concatenate, zip(*out, strict=True)), strict=True)))

    return run


def _best(edges: DataFrame, k: int) -> DataFrame:
    """The best ``k`` different neighbours of each point; an edge that is old in one copy is old."""
    own = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("point_id"))
    once = edges.groupBy("query_id", "point_id").agg(F.max("score").alias("score"), F.min("fresh").alias("fresh"))
    ranked = once.withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "point_id", "score", "fresh")


def _around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Better pairs among the members of each centre, from rows (centre, member, fresh, worst, vector) in its order."""
    held: list[pa.RecordBatch] = []

    def pairs(rows: pa.Table) -> tuple[np.ndarray, ...]:
        ids, fresh = rows.column("member").to_numpy(), rows.column("fresh").to_numpy(zero_copy_only=False).astype(bool)
        worst = rows.column("worst").to_numpy(zero_copy_only=False)
        unit = unit_rows(rows_of(rows.column("vector")))
        scores = np.rint(unit @ unit.T * _SCALE) / _SCALE
        better = (scores > worst[:, None]) & (fresh[:, None] | fresh[None, :]) & (ids[:, None] != ids[None, :])
        a, b = np.nonzero(better)
        return ids[a], ids[b], scores[a, b]

    def flush(table: pa.Table) -> pa.RecordBatch:
        centre = table.column("centre").to_numpy()
        edge = np.concatenate([[0], np.flatnonzero(np.diff(centre)) + 1, [len(centre)]])
        found = [pairs(table.slice(a, b - a)) for a, b in zip(edge, edge[1:], strict=False) if b - a > 1]
        a, b, s = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(s, pa.float64())], ["query_id", "point_id", "score"])

    for batch in batches:
        if not len(batch):
            continue
        # The last centre of a batch may go on in the next one.
        table = pa.Table.from_batches([*held, batch])
        centre = table.column("centre").to_numpy()
        last = int(np.searchsorted(centre, centre[-1], side="left")) if centre[0] <= centre[-1] else len(centre)
        if last:
            yield flush(table.slice(0, last))
        held = table.slice(last).to_batches()
    if held:
        yield flush(pa.Table.from_batches(held))


def _round(points: DataFrame, edges: DataFrame, k: int, turn: int) -> DataFrame:
    """Candidate edges from the neighbours of neighbours."""
    lists = edges.select(F.col("query_id").alias("centre"), F.col("point_id").alias("member"), "fresh")
    listed = edges.select(F.col("point_id").alias("centre"), F.col("query_id").alias("member"), "fresh")
    some = Window.partitionBy("centre").orderBy(F.col("fresh").desc(), F.xxhash64("member", F.lit(turn)))
    listed = listed.withColumn("n", F.row_number().over(some)).filter(F.col("n") <= k).drop("n")
    members = lists.unionByName(listed).groupBy("centre", "member").agg(F.max("fresh").alias("fresh"))
    worst = edges.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(-2.0).alias("worst"))
    known = points.join(worst, points.point_id == worst.query_id, "left")
    known = known.select(F.col("point_id").alias("member"), F.coalesce("worst", F.lit(-2.0)).alias("worst"), "vector")
    met = members.join(known, "member").select("centre", "member", "fresh", "worst", "vector")
    found = met.repartition("centre").sortWithinPartitions("centre").mapInArrow(_around, _EDGE)
    return found.distinct()


def neighbour_graph(points: DataFrame, k: int, leaf: int = LEAF, tables: int = TABLES, rounds: int = ROUNDS, least: float = LEAST) -> DataFrame:
    """(query_id, rank, point_id, score): for each of the unique ``point_id`` the best ``k`` others that were found.

    Runs actions and writes scratch tables; fewer than ``k`` others exist only where fewer points do.
    """
    points = points.select(F.col("point_id").cast("bigint").alias("point_id"), "vector")
    total = points.count()
    start = _groups(points, total, max(leaf, 4 * k), tables).groupBy("table", "pivot", "part").applyInArrow(_whole(k), _EDGE)
    edges = materialize(_best(start.withColumn("fresh", F.lit(True)), k), "graph")
    for turn in range(rounds):
        new = _round(points, edges, k, turn).withColumn("fresh", F.lit(True))
        after = materialize(_best(edges.withColumn("fresh", F.lit(False)).unionByName(new), k), "graph")
        discard(edges)
        edges = after
        count, fresh = edges.agg(F.count(F.lit(1)), F.count_if("fresh")).first()
        if fresh <= least * count:
            break
    return _ranked(edges.select("query_id", "point_id", "score"), k)
