"""Clustering around centroids, with nearest centroids found in the Walsh-Hadamard transform, coarse to fine.

The transform of whole numbers is whole, and keeps squared distances up to the factor ``SIZE``. Its coefficients are put
in order of their sign changes: the first ones say how the parts of a vector differ on the large, and most of a distance
sits there. For each vector the search adds up squared coefficient differences to all centroids over the first few
coefficients, finishes the leading centroid, and drops those whose sum is above that full distance already: a sum only
grows, so they are strictly worse. The others go on over the next coefficients; what is left at the end has been
compared in all ``SIZE``. All numbers are whole, so results are exact and ties are ties.

Transformed vectors are written once and read by each round. A task adds up the vectors of each cluster, so that at most
``CLUSTERS`` rows leave it; the new centroids, ``CLUSTERS`` x ``SIZE`` numbers, go back with the next round.

Defined results: vectors that are null, of another length, or with a null or non-finite component are left out. Rows
that repeat are vectors of their own; those with equal ids are in order of their components where the start needs one.
A null id hashes as an empty one. Components are clamped to 2 ** 24 either way (x to 262,144) so that all distances are
exact. With fewer than ``CLUSTERS`` vectors each is a centroid. Extra columns are not looked at. Empty tables give
empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwarden.llm.common import prepare, table
from sparkwarden.session import materialize

SIZE, CLUSTERS, ROUNDS, SEED = 64, 16, 3, 1
SCALE, LIMIT = 64, 1 << 24
# Coefficients after which worse centroids are dropped; vectors that are searched at once.
LEVELS = (4, 12, 28, 64)
STEP = 4096


def natural(v: np.ndarray) -> np.ndarray:
    """Fast transform of the rows, by butterflies; twice is the row times its length."""
    out, half = v if v.dtype == object else v.astype(np.int64), 1
    n, size = out.shape
    while half < size:
        pairs = out.reshape(n, size // (2 * half), 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, size)
        half *= 2
    return out


def by_changes(size: int) -> np.ndarray:
    """Natural places of the coefficients, those with few sign changes first."""
    rows = natural(np.eye(size, dtype=np.int64))
    return np.argsort((rows[:, 1:] != rows[:, :-1]).sum(axis=1), kind="stable")


_ORDER = by_changes(SIZE)
_BACK = np.argsort(_ORDER)


def transform(v: np.ndarray) -> np.ndarray:
    return natural(v)[:, _ORDER]


def restore(w: np.ndarray) -> np.ndarray:
    """Vectors, or sums of vectors, from their transforms."""
    return natural(w[:, _BACK]) // SIZE


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each transformed vector, the smaller at ties, and ``SIZE`` times the distance."""
    first = LEVELS[0]
    part = ((x[:, None, :first] - centroids[None, :, :first]) ** 2).sum(axis=2)
    lead = part.argmin(axis=1)
    least = ((x - centroids[lead]) ** 2).sum(axis=1)
    row, of = np.nonzero(part <= least[:, None])
    part = part[row, of]
    for low, high in zip(LEVELS, LEVELS[1:], strict=False):
        part = part + ((x[row, low:high] - centroids[of, low:high]) ** 2).sum(axis=1)
        stays = part <= least[row]
        row, of, part = row[stays], of[stays], part[stays]
    order = np.lexsort((of, part, row))
    firsts = order[np.concatenate([[True], np.diff(row[order]) > 0])] if len(order) else order
    return of[firsts], part[firsts]


def _vectors(column: pa.Array, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), SIZE)


def _transforming(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        whole = np.clip(np.floor(SCALE * _vectors(batch.column(1), np.float64)), -LIMIT, LIMIT)
        made = transform(whole.astype(np.int64)).astype(np.int32)
        offsets = pa.array(np.arange(len(made) + 1, dtype=np.int32) * SIZE)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(made.ravel()))], ["vec_id", "w"])


def whole_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """``vec_id, w``: transforms of the vectors that count."""
    prepare(vectors.sparkSession)
    v = F.col(column).cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    kept = vectors.select("vec_id", v.alias("v")).where(F.col("v").isNotNull() & (F.size("v") == SIZE) & fine)
    schema = T.StructType([kept.schema["vec_id"], *T.StructType.fromDDL("w array<int>").fields])
    return kept.mapInArrow(_transforming, schema)


def starts(rows: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """Transforms of the vectors whose ids hash lowest, in that order."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    picked = rows.orderBy(hashed, "w").select("w").limit(clusters).collect()
    return np.array([r.w for r in picked], dtype=np.int64).reshape(-1, SIZE)


def _summing(centroids: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = np.zeros(len(centroids), dtype=np.int64)
        sums = np.zeros((len(centroids), SIZE), dtype=np.int64)
        for batch in batches:
            x = _vectors(batch.column(0), np.int64)
            for at in range(0, len(x), STEP):
                part = x[at : at + STEP]
                of, _ = nearest(part, centroids)
                number += np.bincount(of, minlength=len(centroids))
                np.add.at(sums, of, part)
        used = np.flatnonzero(number)
        rows = [pa.array(used.astype(np.int32)), pa.array(number[used]), pa.array(sums[used].tolist(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(rows, ["cluster", "n", "sums"])

    return run


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Transforms of the floored means of each centroid's vectors; one without vectors stays."""
    parts = rows.select("w").mapInArrow(_summing(centroids), "cluster int, n long, sums array<long>")
    added = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(SIZE)]
    out = centroids.copy()
    for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *added).collect():  # one row for each centroid
        total = restore(np.array([r[2:]], dtype=object))  # sums may pass 64 bits on the way back
        out[r.cluster] = transform((total // r.n).astype(np.int64))[0]
    return out


def _assigning(centroids: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _vectors(batch.column(1), np.int64)
            found = [nearest(x[at : at + STEP], centroids) for at in range(0, len(x), STEP)] or [nearest(x, centroids)]
            of, far = (np.concatenate(c) for c in zip(*found, strict=True))
            arrays = [batch.column(0), pa.array(of.astype(np.int32)), pa.array(far // SIZE)]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "cluster", "distance"])

    return run


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, cluster, distance`` of each vector that counts, and the centroids."""
    rows = materialize(whole_vectors(vectors), "vectors")
    centroids = starts(rows, clusters, seed)
    schema = T.StructType([rows.schema["vec_id"], *T.StructType.fromDDL("cluster int, distance long").fields])
    if not len(centroids):
        return rows.sparkSession.createDataFrame([], schema), centroids
    for _ in range(rounds):
        centroids = moved(rows, centroids)
    return rows.mapInArrow(_assigning(centroids), schema), restore(centroids)


def op12_centroid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = cluster(table(spark, sf_dir, "embeddings"))
    placed = materialize(found, "clusters")
    sums = placed.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    sums = {r.cluster: r.cluster_inertia for r in sums.collect()}  # one row for each centroid
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    about = [(k, v, sum(sums.values()), names[k]) for k, v in sums.items()]
    about = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
