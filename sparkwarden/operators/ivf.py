"""Inverted-file index for cosine search: learnt lists, short codes of what is left, exact scores for few candidates.

Points are grouped by the nearest of some learnt centroids. What a point differs from its centroid is cut into parts of
four numbers, and each part is written as the number of a learnt code word, so a vector of 64 numbers is 16 bytes. A
search reads the lists around the query only, ranks their points by codes, and scores the best candidates with their
whole vectors.

Centroids, code words and the two numbers that trade work for recall (lists to read, candidates to score) are learnt
from at most ``SAMPLE`` points, by hash of the id; every point is indexed. ``similarity.topk`` stays the exact way, and
``recall`` measures one against the other.

The index is a folder of three tables: ``codes`` in order of list, ``vectors``, and one row of ``model``. A long list is
cut into chunks, and so are the queries that come to it, so that a list with a third of all points is many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwarden.operators.embedding import rows_of, unit_rows
from sparkwarden.operators.similarity import _ranked
from sparkwarden.session import materialize

SAMPLE, MAX_LISTS, WORDS, PART = 32_768, 1024, 256, 4
# Points of the sample that calibrate, and the share of true neighbours that each of the two steps must keep there.
PROBERS, KEEP = 512, 0.96
CHUNK = 50_000
_HASHES, _SCALE = 1 << 40, 1_000_000_000


@dataclass(frozen=True)
class Model:
    """Centroids (lists, dim), code words (parts, words, ``PART``), lists that a query reads, candidates it scores."""

    centroids: np.ndarray
    words: np.ndarray
    probes: int
    candidates: int

    def padded(self, unit: np.ndarray) -> np.ndarray:
        return np.pad(unit, ((0, 0), (0, len(self.words) * PART - unit.shape[1])))

    def lists(self, unit: np.ndarray, n: int = 1) -> np.ndarray:
        """The ``n`` nearest centroids of each row, nearest first."""
        far = (self.centroids**2).sum(axis=1)[None, :] / 2 - unit @ self.centroids.T
        if n == 1:
            return far.argmin(axis=1)[:, None]
        return np.argsort(far, axis=1, kind="stable")[:, :n]

    def encode(self, unit: np.ndarray, of: np.ndarray) -> np.ndarray:
        left = self.padded(unit - self.centroids[of])
        codes = np.empty((len(unit), len(self.words)), dtype=np.uint8)
        for m, words in enumerate(self.words):
            part = left[:, m * PART : (m + 1) * PART]
            codes[:, m] = ((words**2).sum(axis=1)[None, :] / 2 - part @ words.T).argmin(axis=1)
        return codes

    def decode(self, codes: np.ndarray, of: np.ndarray) -> np.ndarray:
        left = np.concatenate([self.words[m][codes[:, m]] for m in range(len(self.words))], axis=1)
        return left[:, : self.centroids.shape[1]] + self.centroids[of]


def means(x: np.ndarray, n: int, rounds: int = 10) -> np.ndarray:
    """``n`` centroids of the rows by Lloyd's method, from the first rows on; one without rows stays."""
    found = x[:n].copy()
    for _ in range(rounds):
        of = np.concatenate([((found**2).sum(axis=1)[None, :] / 2 - x[i : i + 4096] @ found.T).argmin(axis=1) for i in range(0, len(x), 4096)])
        number = np.bincount(of, minlength=n)
        total = np.zeros_like(found)
        np.add.at(total, of, x)
        found = np.where(number[:, None] > 0, total / np.maximum(number, 1)[:, None], found)
    return found


def _sample(points: DataFrame, total: int, size: int) -> np.ndarray:
    """Points in hash order, taken among the few whose hash is low."""
    low = math.ceil(min(1.0, (2 * size + 64) / max(total, 1)) * _HASHES)
    few = points.filter(F.pmod(F.xxhash64("point_id", F.lit(2)), F.lit(_HASHES)) < low)
    rows = few.orderBy(F.xxhash64("point_id", F.lit(3)), "point_id").limit(size).select("vector").toArrow()
    return unit_rows(rows_of(rows.column("vector")))


def fit(points: DataFrame, k: int = 10, sample: int = SAMPLE, lists: int | None = None) -> Model:
    """Centroids, code words, and how much to read, from a sample of (point_id, vector) (actions)."""
    total = points.count()
    x = _sample(points, total, sample)
    if not len(x):
        return Model(np.zeros((1, 0)), np.zeros((0, WORDS, PART)), 1, k)
    n = lists or int(np.clip(round(math.sqrt(total)), 1, max(1, min(MAX_LISTS, len(x) // 16))))
    centroids = means(x, min(n, len(x)))
    parts = -(-x.shape[1] // PART)
    model = Model(centroids, np.zeros((parts, 1, PART)), 1, k)
    some = x[: 16 * WORDS]
    left = model.padded(some - centroids[model.lists(some)[:, 0]])
    words = np.stack([means(left[:, m * PART : (m + 1) * PART], min(WORDS, len(left))) for m in range(parts)])
    probes, candidates = _calibrated(Model(centroids, words, 1, k), x, k)
    return Model(centroids, words, probes, candidates)


def _calibrated(model: Model, x: np.ndarray, k: int) -> tuple[int, int]:
    """Lists and candidates that keep ``KEEP`` of the sample's own neighbours each."""
    asked = x[:PROBERS]
    scores = asked @ x.T
    scores[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    k = min(k, len(x) - 1)
    if k < 1:
        return len(model.centroids), 1
    near = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    of = model.lists(x)[:, 0]
    place = np.argsort(model.lists(asked, len(model.centroids)), axis=1)
    probes = int(np.quantile(np.take_along_axis(place, of[near], axis=1), KEEP, method="higher")) + 1
    coded = asked @ model.decode(model.encode(x, of), of).T
    coded[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    before = (np.sort(-coded, axis=1)[:, None, :] < -np.take_along_axis(coded, near, axis=1)[:, :, None]).sum(axis=2)
    return probes, max(4 * k, 2 * (int(np.quantile(before, KEEP, method="higher")) + 1))


def encoded(points: DataFrame, model: Model) -> DataFrame:
    """``point_id, cell, code`` of every point."""
    shared = points.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            if not len(batch):
                continue
            unit = unit_rows(rows_of(batch.column(1)))
            of = model.lists(unit)[:, 0]
            codes = [c.tobytes() for c in model.encode(unit, of)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(of.astype(np.int32)), pa.array(codes, pa.binary())], ["point_id", "cell", "code"])

    rows = points.select(F.col("point_id").cast("bigint").alias("point_id"), "vector")
    return rows.mapInArrow(run, "point_id bigint, cell int, code binary")


@dataclass(frozen=True)
class Index:
    model: Model
    codes: DataFrame
    vectors: DataFrame


def build(points: DataFrame, path: str, k: int = 10, sample: int = SAMPLE, lists: int | None = None) -> Index:
    """Fit, index every point, and write the three tables (actions)."""
    spark = points.sparkSession
    model = fit(points, k, sample, lists)
    order = ["cell", F.xxhash64("point_id")]
    encoded(points, model).repartitionByRange(*order).sortWithinPartitions("cell").write.parquet(f"{path}/codes")
    points.select(F.col("point_id").cast("bigint").alias("point_id"), "vector").write.parquet(f"{path}/vectors")
    row = (model.centroids.tolist(), model.words.tolist(), model.probes, model.candidates)
    schema = "centroids array<array<double>>, words array<array<array<double>>>, probes int, candidates int"
    spark.createDataFrame([row], schema).coalesce(1).write.parquet(f"{path}/model")
    return load(spark, path)


def load(spark: SparkSession, path: str) -> Index:
    row = spark.read.parquet(f"{path}/model").first()
    words = np.array(row.words, dtype=float)
    model = Model(np.array(row.centroids, dtype=float), words.reshape(len(words), -1 if len(words) else WORDS, PART), row.probes, row.candidates)
    return Index(model, spark.read.parquet(f"{path}/codes"), spark.read.parquet(f"{path}/vectors"))


def visits(queries: DataFrame, model: Model, probes: int) -> DataFrame:
    """``query_id, vector, cell``: the lists that each query reads."""
    shared = queries.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("array<int>")
    def cells(vectors: pa.Array) -> pa.Array:
        near = shared.value.lists(unit_rows(rows_of(vectors)), probes).astype(np.int32) if len(vectors) else np.zeros((0, 1), np.int32)
        offsets = np.arange(len(near) + 1, dtype=np.int32) * near.shape[1]
        return pa.ListArray.from_arrays(offsets, pa.array(near.ravel()))

    return queries.select("query_id", "vector", F.explode(cells("vector")).alias("cell"))


def search(queries: DataFrame, index: Index, k: int, exclude_self: bool = False, probes: int | None = None, candidates: int | None = None, chunk: int = CHUNK) -> DataFrame:
    """(query_id, rank, point_id, score): the best k that the lists and codes lead to, with exact scores."""
    spark, model = queries.sparkSession, index.model
    probes = min(probes or model.probes, len(model.centroids))
    wanted = max(candidates or model.candidates, k)
    kind = queries.schema["query_id"].dataType.simpleString()
    asked = visits(queries.select("query_id", "vector"), model, probes)
    # Chunks per list, of its points and of the queries that come to it: one small row per list.
    sizes = {r.cell: r.n for r in index.codes.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    comes = {r.cell: r.n for r in asked.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = [(c, -(-sizes[c] // chunk), -(-n // chunk)) for c, n in comes.items() if c in sizes]
    chunks = F.broadcast(spark.createDataFrame(plan, "cell int, p_chunks int, q_chunks int"))

    def dealt(df: DataFrame, key: str, own: str, other: str, own_name: str, other_name: str) -> DataFrame:
        mine = F.pmod(F.xxhash64(key), F.col(own)).cast("int").alias(own_name)
        return df.join(chunks, "cell").select(*df.columns, mine, F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other_name))

    left = dealt(asked, "query_id", "q_chunks", "p_chunks", "q", "p")
    right = dealt(index.codes, "point_id", "p_chunks", "q_chunks", "p", "q")
    shared = spark.sparkContext.broadcast(model)

    def meet(asked: pa.Table, there: pa.Table) -> pa.Table:
        names = asked.column("query_id").combine_chunks()
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if asked.num_rows and there.num_rows:
            model = shared.value
            ids = there.column("point_id").to_numpy()
            codes = np.frombuffer(b"".join(there.column("code").to_pylist()), dtype=np.uint8).reshape(len(ids), -1)
            near = model.decode(codes, there.column("cell").to_numpy())
            unit = unit_rows(rows_of(asked.column("vector")))
            mine = names.to_numpy(zero_copy_only=False) if exclude_self else None
            step = max(1, 4_000_000 // len(ids))
            for start in range(0, len(unit), step):
                scores = unit[start : start + step] @ near.T
                if exclude_self:
                    scores[mine[start : start + step, None] == ids[None, :]] = -np.inf
                n = min(wanted, len(ids))
                best = np.argpartition(-scores, n - 1, axis=1)[:, :n]
                row, place = np.nonzero(np.take_along_axis(scores, best, axis=1) > -np.inf)
                at = best[row, place]
                found.append((row + start, ids[at], scores[row, at]))
        rows, points, scores = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        return pa.table({"query_id": names.take(pa.array(rows, pa.int64())), "point_id": pa.array(points, pa.int64()), "score": scores})

    keys = ["cell", "q", "p"]
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, f"query_id {kind}, point_id bigint, score double")
    best = materialize(_ranked(met, wanted).select("query_id", "point_id"), "ivf-candidates")
    both = best.join(index.vectors, "point_id").join(queries.select("query_id", F.col("vector").alias("asked")), "query_id")
    return _ranked(both.select("query_id", "point_id", cosine("asked", "vector").alias("score")), k)


@F.arrow_udf(T.DoubleType())
def cosine(x: pa.Array, y: pa.Array) -> pa.Array:
    """Cosine of two vectors, at nine decimals as everywhere."""
    if not len(x):
        return pa.array([], pa.float64())
    return pa.array(np.rint(np.einsum("ij,ij->i", unit_rows(rows_of(x)), unit_rows(rows_of(y))) * _SCALE) / _SCALE)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: queries, share of the exact neighbours that were found."""
    hit = found.select("query_id", "point_id", F.lit(1).alias("hit"))
    both = exact.join(hit, ["query_id", "point_id"], "left")
    return both.agg(F.countDistinct("query_id").alias("queries"), F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))


def compared(queries: DataFrame, index: Index, probes: int | None = None) -> DataFrame:
    """One row: codes that the search reads, vectors that it scores at most, and pairs that an exact search compares."""
    model = index.model
    sizes = index.codes.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))  # one row per list
    read = visits(queries.select("query_id", "vector"), model, min(probes or model.probes, len(model.centroids)))
    read = read.groupBy("cell").agg(F.count(F.lit(1)).alias("q")).join(sizes, "cell").agg(F.coalesce(F.sum(F.col("q") * F.col("n")), F.lit(0)).alias("codes"))
    asked = queries.agg(F.count(F.lit(1)).alias("q"))
    total = index.codes.agg(F.count(F.lit(1)).alias("n"))
    every = asked.crossJoin(total).select((F.col("q") * F.col("n")).alias("pairs"), (F.col("q") * model.candidates).alias("vectors"))  # one row each
    return read.crossJoin(every)
