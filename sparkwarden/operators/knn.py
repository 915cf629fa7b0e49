"""Exact nearest neighbours when both sides are large.

Points are grouped into cells around pivots. On the unit sphere the straight-line distance is a metric and falls
as the cosine rises, so distances to pivots bound distances to whole cells (Lu et al., "Efficient processing of
k nearest neighbor joins using MapReduce", VLDB 2012):

1. every query searches the cells around its own pivot that together hold at least k points;
2. its k-th best distance so far rules out every cell that lies entirely further away;
3. it searches the cells that are left, and a window keeps the best k of both rounds.

Nothing is capped: where the bounds exclude no cell, all cells are searched. Near cells that are small share a pack, and
a query goes once to each pack that holds a cell it wants, so it is not copied for every cell. A large pack is cut into
chunks and the queries that visit it into chunks as well, so no task holds more than a chunk of each.

Copies for each pair of chunks that meet grow with the product of both sides. Where they would be many times the sides,
nothing is copied: each chunk is one compressed row, dealt once, and tasks read the chunks of both sides that meet. A task
has one chunk of queries and goes through several of points, so it gives at most k hits for each query.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwarden.operators.embedding import rows_of, unit_rows
from sparkwarden.operators.similarity import HITS, _ranked, top_slots
from sparkwarden.session import materialize

MAX_PIVOTS = 4096
_HASHES = 1 << 40
_SLICE = 512  # vectors whose distances to all pivots are held at once
PACK = 2048  # rows below which a pack or a chunk is not worth its own task
PACKS = 8  # packs, and chunks of queries, for inputs that would do with fewer
CHUNK_BYTES = 32 << 20  # one side of a chunk in double precision
COPIES = 4  # copies of rows for chunks that meet, by rows of both sides, up to which rows are copied
COPY_BYTES = 1 << 30  # bytes of copies that are always few
TASK_BYTES = 64 << 20  # compressed points that a task goes through where nothing is copied
_SLACK = 1e-6  # far above rounding errors; it only makes cells look a little closer


@dataclass(frozen=True)
class Cells:
    pivots: np.ndarray  # unit rows
    count: np.ndarray  # points per cell
    inner: np.ndarray  # smallest and largest distance of a cell's points to its pivot
    outer: np.ndarray
    home: list[list[int]]  # cells around each pivot with at least k points
    pack: np.ndarray  # the pack of each cell; packs are numbered from 0


def _rows_at_once(rows: int, chunk: int, width: int) -> int:
    """Rows of one side that meet in a task: one in PACKS, so that there are tasks enough and few copies of each row.

    At most ``chunk``, unless that is below PACK and copies would cost more than the search, and within CHUNK_BYTES.
    """
    most = CHUNK_BYTES // (8 * max(width, 1))
    if chunk >= PACK:
        most = min(most, chunk)
    return max(1, min(max(PACK, -(-rows // PACKS)), most))


def _packs(between: np.ndarray, count: np.ndarray, size: int) -> np.ndarray:
    """Cells dealt to packs of at most ``size`` points, or one cell: a cell and those nearest to it."""
    pack = np.full(len(count), -1)
    number = 0
    for cell in range(len(count)):
        if pack[cell] < 0:
            free = np.flatnonzero(pack < 0)
            free = free[np.argsort(np.where(free == cell, -1.0, between[cell, free]), kind="stable")]
            fits = max(1, int(np.searchsorted(np.cumsum(count[free]), size, side="right")))
            pack[free[:fits]] = number
            number += 1
    return pack


def _distances(unit: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (unit @ pivots.T)))


def _choose_pivots(points: DataFrame, n: int, total: int) -> np.ndarray:
    """Points in hash order, so that dense regions get many pivots.

    The order is taken among the points below a hash that some four times ``n`` of them pass, not among all.
    """
    low = math.ceil(min(1.0, (4 * n + 64) / max(total, 1)) * _HASHES)
    few = points.filter(F.pmod(F.xxhash64("point_id", F.lit(1)), F.lit(_HASHES)) < low)
    rows = few.orderBy(F.xxhash64("point_id"), "point_id").limit(n).select("vector").toArrow()
    return unit_rows(rows_of(rows.column("vector")))


def _with_cell(df: DataFrame, pivots: np.ndarray) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(pivots)

    @F.arrow_udf("struct<cell:int,away:double>")
    def assign(vectors: pa.Array) -> pa.Array:
        if not len(vectors):
            return pa.StructArray.from_arrays([pa.array([], pa.int32()), pa.array([], pa.float64())], ["cell", "away"])
        unit = unit_rows(rows_of(vectors))
        cells, nearest = [], []
        for start in range(0, len(unit), _SLICE):
            away = _distances(unit[start : start + _SLICE], shared.value)
            cells.append(away.argmin(axis=1).astype(np.int32))
            nearest.append(away.min(axis=1))
        return pa.StructArray.from_arrays(
            [pa.array(np.concatenate(cells)), pa.array(np.concatenate(nearest))], names=["cell", "away"]
        )

    return df.withColumn("_near", assign("vector")).select("*", "_near.cell", "_near.away").drop("_near")


def _describe(points: DataFrame, pivots: np.ndarray, k: int, size: int = PACK) -> Cells:
    """Cell sizes and radii, at most MAX_PIVOTS rows, and the cells in packs of ``size`` points."""
    n = len(pivots)
    count, inner, outer = np.zeros(n, dtype=np.int64), np.full(n, np.inf), np.zeros(n)
    stats = points.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("away").alias("lo"), F.max("away").alias("hi"))
    for row in stats.collect():
        count[row.cell], inner[row.cell], outer[row.cell] = row.n, row.lo, row.hi
    between = _distances(pivots, pivots)
    home = []
    for i in range(n):
        order = np.argsort(between[i], kind="stable")
        order = np.concatenate([[i], order[order != i]])
        enough = int(np.searchsorted(np.cumsum(count[order]), k + 1)) + 1
        home.append([int(c) for c in order[:enough] if count[c]])
    return Cells(pivots, count, inner, outer, home, _packs(between, count, size))


def _search(
    queries: DataFrame, visits: Column, points: DataFrame, cells: Cells, k: int, exclude_self: bool, chunk: int, size: int
) -> DataFrame:
    """Best k per query within the packs it visits; ``chunk`` queries meet ``size`` points.

    Points that score less than a query's ``worst`` may be left out.
    """
    spark = queries.sparkSession
    kind = queries.schema["query_id"].dataType.simpleString()
    visiting = queries.select("query_id", "vector", "worst", F.explode(visits).alias("pack"))
    # Chunks per pack: of its points, and of the queries that come to it. One small row per pack.
    arriving = {r.pack: r.n for r in visiting.groupBy("pack").agg(F.count(F.lit(1)).alias("n")).collect()}
    held = np.bincount(cells.pack, weights=cells.count)
    plan = [(p, -(-int(held[p]) // size), -(-int(n) // chunk)) for p, n in arriving.items()]
    copies = sum(arriving[p] * p_chunks + int(held[p]) * q_chunks for p, p_chunks, q_chunks in plan)
    width = cells.pivots.shape[1]
    if copies * width * 4 > COPY_BYTES:
        asking = queries.count()
        if copies > COPIES * (asking + int(held.sum())):
            wanted = queries.select("query_id", "vector", "worst", visits.alias("packs"))
            return _search_in_blocks(wanted, -(-asking // chunk), points, {p: n for p, n, _ in plan}, k, exclude_self)
    chunks = F.broadcast(spark.createDataFrame(plan, "pack int, p_chunks int, q_chunks int"))

    def spread(df: DataFrame, key: str, own: str, other: str, own_name: str, other_name: str) -> DataFrame:
        mine = F.pmod(F.xxhash64(key), F.col(own)).cast("int").alias(own_name)
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other_name)
        rest = [c for c in df.columns if c not in (key, "pack")]
        return df.join(chunks, "pack").select(key, *rest, "pack", mine, every)

    left = spread(visiting, "query_id", "q_chunks", "p_chunks", "q", "p")
    right = spread(points.select("point_id", "vector", "pack"), "point_id", "p_chunks", "q_chunks", "p", "q")

    def search(asked: pa.Table, there: pa.Table) -> pa.Table:
        empty = pa.table({"query_id": asked.column("query_id").slice(0, 0), "point_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not asked.num_rows or not there.num_rows:
            return empty
        ids = there.column("point_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        unit = unit_rows(rows_of(there.column("vector")))[order]
        skip = _own_slots(ids, asked.column("query_id").to_numpy()) if exclude_self else None
        rows, found, scores = [], [], []
        floor = asked.column("worst").to_numpy()
        for start, slots, score in top_slots(unit_rows(rows_of(asked.column("vector"))), unit, k, skip, floor):
            row, place = np.nonzero(np.isfinite(score))
            rows.append(row + start)
            found.append(ids[slots[row, place]])
            scores.append(score[row, place])
        names = asked.column("query_id").take(pa.array(np.concatenate(rows)))
        return pa.table({"query_id": names, "point_id": np.concatenate(found), "score": np.concatenate(scores)})

    # A partition for each group of chunks that meet: a task has few of them, however many there are, and none is
    # merged with others for its few bytes.
    keys = ["pack", "q", "p"]
    groups = max(1, sum(p_chunks * q_chunks for _, p_chunks, q_chunks in plan))
    left, right = (side.repartition(groups, *keys).groupBy(*keys) for side in (left, right))
    return left.cogroup(right).applyInArrow(search, HITS.format(kind=kind))


def _own_slots(ids: np.ndarray, mine: np.ndarray) -> np.ndarray:
    """Places of ``mine`` among the sorted ``ids``, -1 where they are not there."""
    at = np.minimum(np.searchsorted(ids, mine), len(ids) - 1)
    return np.where(ids[at] == mine, at, -1)


def _blocks(df: DataFrame, block: Column, n: int) -> DataFrame:
    """Rows of each of ``n`` blocks as one row: ``block`` and a compressed table."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [batch for batch in batches if len(batch)]
        if rows:
            whole = pa.Table.from_batches(rows)
            for number in whole.column("block").unique():  # a partition has one
                part = whole.filter(pc.equal(whole.column("block"), number)).drop_columns(["block"])
                out = pa.BufferOutputStream()
                with pa.ipc.new_stream(out, part.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
                    writer.write_table(part)
                columns = [pa.array([number.as_py()], pa.int32()), pa.array([out.getvalue().to_pybytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "rows"])

    return df.withColumn("block", block.cast("int")).repartitionById(n, F.col("block")).mapInArrow(pack, "block int, rows binary")


class _Asking:
    """A chunk of queries and the best that they have met."""

    def __init__(self, rows: pa.Buffer, k: int) -> None:
        table = pa.ipc.open_stream(rows).read_all()
        self.names, self.k = table.column("query_id").combine_chunks(), k
        self.unit, self.floor = unit_rows(rows_of(table.column("vector"))), table.column("worst").to_numpy()
        packs = table.column("packs").combine_chunks()
        flat = packs.flatten().to_numpy()
        self.wants = np.zeros((len(packs), int(flat.max(initial=-1)) + 1), dtype=bool)
        self.wants[np.repeat(np.arange(len(packs)), np.diff(packs.offsets.to_numpy())), flat] = True
        self.ids = np.full((len(packs), k), np.iinfo(np.int64).max)
        self.scores = np.full((len(packs), k), -np.inf)

    def meet(self, pack: int, rows: pa.Buffer, exclude_self: bool) -> None:
        wanting = np.flatnonzero(self.wants[:, pack]) if pack < self.wants.shape[1] else []
        if not len(wanting):
            return
        table = pa.ipc.open_stream(rows).read_all()
        ids = table.column("point_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, unit = ids[order], unit_rows(rows_of(table.column("vector")))[order]
        skip = _own_slots(ids, self.names.to_numpy()[wanting]) if exclude_self else None
        floor = np.maximum(self.floor, self.scores[:, -1])[wanting]
        asked = self.unit if len(wanting) == len(self.unit) else self.unit[wanting]
        for start, slots, scores in top_slots(asked, unit, self.k, skip, floor):
            hit = np.flatnonzero(np.isfinite(scores).any(axis=1))
            at = wanting[start + hit]
            found = np.where(np.isfinite(scores[hit]), ids[slots[hit]], np.iinfo(np.int64).max)
            all_ids, all_scores = np.hstack([self.ids[at], found]), np.hstack([self.scores[at], scores[hit]])
            best = np.lexsort((all_ids, -all_scores), axis=1)[:, : self.k]
            self.ids[at], self.scores[at] = (np.take_along_axis(x, best, axis=1) for x in (all_ids, all_scores))

    def hits(self) -> pa.RecordBatch:
        row, place = np.nonzero(np.isfinite(self.scores))
        columns = [self.names.take(pa.array(row)), pa.array(self.ids[row, place]), pa.array(self.scores[row, place])]
        return pa.RecordBatch.from_arrays(columns, names=["query_id", "point_id", "score"])


def _search_in_blocks(queries: DataFrame, q_blocks: int, points: DataFrame, p_chunks: dict[int, int], k: int, exclude_self: bool) -> DataFrame:
    """Best k for each query in the packs that it names in ``packs``, of some chunks at a time.

    Both sides are dealt once. A pair of a block of queries and a partition of chunks is a task that reads them.
    """
    spark = queries.sparkSession
    kind = queries.schema["query_id"].dataType.simpleString()
    asked = _blocks(queries, F.pmod(F.xxhash64("query_id"), F.lit(q_blocks)), q_blocks)
    asked = asked.repartitionById(q_blocks, F.col("block")).withColumnRenamed("rows", "asked")

    # Chunks by number, those of a pack after each other.
    packs, starts = [*p_chunks], np.cumsum([0, *p_chunks.values()]).tolist()
    n = starts.pop()
    numbers = F.broadcast(spark.createDataFrame([(p, at, p_chunks[p]) for p, at in zip(packs, starts)], "pack int, at int, n int"))
    number = F.col("at") + F.pmod(F.xxhash64("point_id"), F.col("n"))
    there = points.select("point_id", "vector", "pack").join(numbers, "pack").withColumn("nth", number)
    chunks = materialize(_blocks(there.select("point_id", "vector", "nth"), F.col("nth"), n), "knn-chunks")
    size = chunks.agg(F.sum(F.length("rows"))).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    parts = max(1, min(n, max(-(-size // TASK_BYTES), -(-tasks // q_blocks))))
    chunks = chunks.select(F.col("block").alias("chunk"), "rows").repartitionById(parts, F.floor(F.col("chunk") * parts / n).cast("int"))
    # A task is given its queries once, with the first chunk.
    chunks = chunks.withColumn("first", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asking = None
        for batch in batches:
            for rows, chunk, points in zip(*batch.columns):
                if rows.is_valid:
                    if asking is not None:
                        yield asking.hits()
                    asking = _Asking(rows.as_buffer(), k)
                asking.meet(packs[bisect_right(starts, chunk.as_py()) - 1], points.as_buffer(), exclude_self)
        if asking is not None:
            yield asking.hits()

    pairs = asked.hint("shuffle_replicate_nl").crossJoin(chunks)
    return pairs.select(F.when(F.col("first"), F.col("asked")), "chunk", "rows").mapInArrow(search, HITS.format(kind=kind))


def _cells_left(cells: Cells, spark, packs: bool = False) -> callable:
    """UDF: cells outside the home set that may hold a point at least as near as the k-th so far.

    With ``packs`` those packs outside the home set's that hold such a cell.
    """
    order = np.argsort(cells.pack, kind="stable")  # cells by pack
    starts = np.searchsorted(cells.pack[order], np.arange(cells.pack.max(initial=-1) + 1))
    shared = spark.sparkContext.broadcast(cells)

    @F.arrow_udf("array<int>")
    def left(vectors: pa.Array, cell: pa.Array, worst: pa.Array) -> pa.Array:
        c = shared.value
        if not len(vectors):
            return pa.array([], pa.list_(pa.int32()))
        homes, units = cell.to_numpy(), unit_rows(rows_of(vectors))
        least = worst.to_numpy(zero_copy_only=False)
        parts = [reachable(c, units[i : i + _SLICE], homes[i : i + _SLICE], least[i : i + _SLICE]) for i in range(0, len(units), _SLICE)]
        offsets = np.concatenate([[0], np.cumsum(np.concatenate([n for n, _ in parts]))])
        return pa.ListArray.from_arrays(offsets.astype(np.int32), np.concatenate([cells for _, cells in parts]).astype(np.int32))

    def reachable(c: Cells, unit: np.ndarray, home: np.ndarray, worst: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        away = _distances(unit, c.pivots)
        own = away[np.arange(len(home)), home][:, None]
        between = _distances(c.pivots[home], c.pivots)
        # Three lower bounds on the distance to any point of a cell.
        plane = np.divide(away**2 - own**2, 2 * between, out=np.zeros_like(away), where=between > 0)
        bound = np.maximum.reduce([away - c.outer, c.inner - away, plane])
        reach = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * worst + 4e-9))
        maybe = (bound - _SLACK <= reach[:, None]) & (c.count > 0)
        for row, near in enumerate(home):
            maybe[row, c.home[near]] = False
        if packs:
            maybe = np.logical_or.reduceat(maybe[:, order], starts, axis=1)
            for row, near in enumerate(home):
                maybe[row, c.pack[c.home[near]]] = False
        rows, cols = np.nonzero(maybe)
        return np.bincount(rows, minlength=len(home)), cols

    return left.asNondeterministic()  # a filter on its cells is not moved below it, which would run it twice


def knn_join(
    queries: DataFrame,
    points: DataFrame,
    k: int,
    exclude_self: bool = False,
    rows_per_cell: int = 20_000,
    chunk: int = 50_000,
) -> DataFrame:
    """(query_id, rank, point_id, score): the exact best k points per query (runs actions, writes scratch tables)."""
    spark = queries.sparkSession
    points = points.select(F.col("point_id").cast("bigint").alias("point_id"), "vector")
    n, width = points.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    pivots = _choose_pivots(points, int(np.clip(n // rows_per_cell, 1, MAX_PIVOTS)), n)
    size = _rows_at_once(n, chunk, width or 1)
    points = materialize(_with_cell(points, pivots), "knn-points")
    queries = materialize(_with_cell(queries.select("query_id", "vector"), pivots), "knn-queries")
    cells = _describe(points, pivots, k, size)
    asked = _rows_at_once(queries.count(), chunk, width or 1)

    # Pack and home packs by pivot: at most MAX_PIVOTS rows.
    homes = [(c, int(cells.pack[c]), sorted({int(cells.pack[h]) for h in home})) for c, home in enumerate(cells.home)]
    homes = F.broadcast(spark.createDataFrame(homes, "cell int, pack int, home array<int>"))
    points = points.join(homes, "cell")
    at_home = queries.join(homes, "cell").withColumn("worst", F.lit(-1.0))
    first = materialize(_ranked(_search(at_home, F.col("home"), points, cells, k, exclude_self, asked, size), k), "knn-home")
    if cells.pack.max(initial=0) == 0:
        return first

    # Fewer than k points in reach means any cell may help: cosine -1 bounds everything.
    full = F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(F.lit(-1.0))
    worst = first.groupBy("query_id").agg(full.alias("worst"))
    bounded = queries.join(worst, "query_id", "left").withColumn("worst", F.coalesce("worst", F.lit(-1.0)))
    left = bounded.withColumn("rest", _cells_left(cells, spark, packs=True)("vector", "cell", "worst"))
    left = materialize(left.filter(F.size("rest") > 0).select("query_id", "vector", "worst", "rest"), "knn-rest")
    second = _search(left, F.col("rest"), points, cells, k, exclude_self, asked, size)
    return _ranked(first.select("query_id", "point_id", "score").unionByName(second), k)
