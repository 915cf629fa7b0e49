"""Sums of vectors and of their products, which add up over days, and principal components from them.

A part is a number of rows, the sum of their vectors, and the upper triangle of the sum of their outer products, both
after ``origin`` is taken off, which keeps sums small where vectors lie far from zero. Parts that are to be added need the
same origin. Each task adds up its rows, so that one row for a key leaves it; cells are then summed by position.
Components come from the covariance, ``dim`` x ``dim`` numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwarden.operators.embedding import list_array, rows_of

PARTS = "part string, n bigint, cells array<double>"


def parts(df: DataFrame, part: str, vector: str = "vector", origin: np.ndarray | None = None) -> DataFrame:
    """``part, n, cells`` for each value of the column ``part``: sums first, then products, row by row.

    ``part`` should have few values in a task, such as days; null vectors are left out.
    """
    shared = df.sparkSession.sparkContext.broadcast(origin)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, list] = {}
        for batch in batches:
            if not len(batch):
                continue
            rows = rows_of(batch.column(1)).astype(np.float64)
            if shared.value is not None:
                rows = rows - shared.value
            keys = np.array(batch.column(0).to_pylist(), dtype=object)
            upper = np.triu_indices(rows.shape[1])
            for key in dict.fromkeys(keys.tolist()):
                mine = rows[keys == key] if key is not None else rows[[k is None for k in keys]]
                cells = np.concatenate([mine.sum(axis=0), (mine.T @ mine)[upper]])
                old = held.get(key)
                held[key] = [len(mine), cells] if old is None else [old[0] + len(mine), old[1] + cells]
        if held:
            rows = [pa.array(list(held), pa.string()), pa.array([h[0] for h in held.values()], pa.int64()), list_array(np.stack([h[1] for h in held.values()]))]
            yield pa.RecordBatch.from_arrays(rows, ["part", "n", "cells"])

    rows = df.filter(F.col(vector).isNotNull()).select(F.col(part).cast("string").alias("part"), F.col(vector).cast("array<double>").alias("vector"))
    return added(rows.mapInArrow(run, PARTS), "part")


def added(some: DataFrame, *keys: str) -> DataFrame:
    """Parts as one for each value of ``keys``, or as a single one."""
    cells = some.select(*keys, F.posexplode("cells").alias("at", "value")).groupBy(*keys, "at").agg(F.sum("value").alias("value"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda c: c["value"])
    cells = cells.groupBy(*keys).agg(ordered.alias("cells"))
    numbers = some.groupBy(*keys).agg(F.sum("n").alias("n"))
    if not keys:
        return numbers.crossJoin(cells)  # one row each
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    return numbers.alias("a").join(cells.alias("b"), same).select(*[f"a.{k}" for k in keys], "a.n", "b.cells")


@dataclass(frozen=True)
class Moments:
    n: int
    mean: np.ndarray
    covariance: np.ndarray


def moments(some: DataFrame, origin: np.ndarray | None = None) -> Moments:
    """Mean and sample covariance of all parts (an action); the one row that is read has dim x (dim + 3) / 2 cells."""
    row = added(some).first()
    if row is None or not row.n:
        return Moments(0, np.zeros(0), np.zeros((0, 0)))
    cells = np.array(row.cells)
    dim = int((np.sqrt(9 + 8 * len(cells)) - 3) / 2 + 0.5)
    products = np.zeros((dim, dim))
    products[np.triu_indices(dim)] = cells[dim:]
    products = products + np.triu(products, 1).T
    mean = cells[:dim] / row.n
    covariance = (products - row.n * np.outer(mean, mean)) / max(row.n - 1, 1)
    return Moments(row.n, mean if origin is None else mean + origin, covariance)


def axes(of: Moments, k: int = 3) -> np.ndarray:
    """The first ``k`` principal axes as columns, the largest loading of each positive."""
    _, vectors = np.linalg.eigh(of.covariance)
    found = vectors[:, ::-1][:, :k]
    return found * np.sign(found[np.abs(found).argmax(axis=0), np.arange(found.shape[1])])


def project(df: DataFrame, of: Moments, k: int = 3, vector: str = "vector", out: str = "components") -> DataFrame:
    """Add the first ``k`` components of the centred vectors."""
    shared = df.sparkSession.sparkContext.broadcast((of.mean, axes(of, k)))

    @F.arrow_udf("array<double>")
    def placed(vectors: pa.Array) -> pa.Array:
        mean, columns = shared.value
        rows = rows_of(vectors).astype(np.float64)
        return list_array((rows - mean) @ columns) if len(rows) else pa.array([], pa.list_(pa.float64()))

    return df.withColumn(out, placed(vector))
