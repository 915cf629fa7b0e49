"""Isolation Forest: trees are grown in parallel from small hashed samples and scored where the rows are.

Each tree sees at most 256 rows, so growing is 300 small independent groups whatever the table's size. The finished
forest has at most 300 * 511 nodes and is broadcast; scoring is one narrow pass.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkwarden.operators.embedding import rows_of
from sparkwarden.operators.scaling import EPSILON, min_max
from sparkwarden.session import even, materialize

# Forest size, rows per tree, seed.
TREES = 300
ROWS_PER_TREE = 256
SEED = 42

_BUCKETS = 1 << 50
_MARGIN = 1.5  # a tree draws this many times its rows by hash and keeps the first ones


def expected_depth(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary tree of n rows."""
    n = np.asarray(n, dtype=np.float64)
    big = np.maximum(n, 3.0)
    harmonic = np.log(big - 1.0) + np.euler_gamma
    return np.where(n > 2, 2.0 * harmonic - 2.0 * (big - 1.0) / big, np.where(n == 2, 1.0, 0.0))


@dataclass(frozen=True)
class Forest:
    """All trees in flat arrays; a leaf points to itself and carries its path length."""

    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray  # left child; the right one follows it
    path: np.ndarray
    levels: int
    unit: float  # expected depth of a whole tree

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly score in (0, 1) per row; higher is more isolated."""
        out = np.empty(len(rows))
        step = max(1, 2_000_000 // len(self.roots))
        for start in range(0, len(rows), step):
            part = rows[start : start + step]
            node = np.broadcast_to(self.roots, (len(part), len(self.roots))).copy()
            index = np.arange(len(part))[:, None]
            for _ in range(self.levels):
                right = part[index, self.feature[node]] > self.cut[node]
                child = self.child[node]
                node = np.where(child == node, node, child + right)
            depth = self.path[node].mean(axis=1)
            out[start : start + step] = 2.0 ** (-depth / self.unit)
        return out


def grow_tree(rows: np.ndarray, rng: np.random.Generator) -> dict[str, list]:
    """One tree over ``rows``: random varying feature, uniform cut, until alone or at the height limit."""
    limit = math.ceil(math.log2(max(len(rows), 2)))
    tree: dict[str, list] = {"feature": [0], "cut": [0.0], "child": [0], "path": [0.0]}
    todo = [(0, np.arange(len(rows)), 0)]
    while todo:
        node, members, depth = todo.pop()
        part = rows[members]
        low, high = part.min(axis=0), part.max(axis=0)
        varying = np.flatnonzero(high > low)
        if depth >= limit or len(members) <= 1 or not len(varying):
            tree["child"][node] = node
            tree["path"][node] = depth + float(expected_depth(len(members)))
            continue
        f = int(rng.choice(varying))
        cut = float(rng.uniform(low[f], high[f]))
        right = part[:, f] > cut
        if right.all() or not right.any():  # the draw fell on the edge
            cut = float(low[f])
            right = part[:, f] > cut
        first = len(tree["cut"])
        tree["feature"][node], tree["cut"][node], tree["child"][node] = f, cut, first
        for name, blank in (("feature", 0), ("cut", 0.0), ("child", 0), ("path", 0.0)):
            tree[name] += [blank, blank]
        todo.append((first, members[~right], depth + 1))
        todo.append((first + 1, members[right], depth + 1))
    return tree


def _tree_samples(rows: DataFrame, n: int, trees: int, size: int, seed: int) -> DataFrame:
    """(tree, vector) with ``size`` rows per tree, drawn without replacement by hashes of the row id."""
    # Chance of a row per tree; one when the table is hardly larger than a sample.
    share = min(1.0, _MARGIN * size / n)
    draws = F.filter(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda t: F.pmod(F.xxhash64("row_id", t, F.lit(seed + 1)), F.lit(_BUCKETS)) < math.ceil(share * _BUCKETS),
    )
    drawn = rows.select("row_id", "vector", F.explode(draws).alias("tree"))
    order = Window.partitionBy("tree").orderBy(F.xxhash64("row_id", "tree", F.lit(seed + 2)), "row_id")
    return drawn.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= size)


def fit_forest(
    df: DataFrame, row_id: str, vector: str = "vector", trees: int = TREES, size: int = ROWS_PER_TREE, seed: int = SEED
) -> Forest | None:
    """Grow the forest (an action); None for an empty table."""
    rows = df.select(F.col(row_id).alias("row_id"), F.col(vector).alias("vector"))
    n = rows.count()
    if n == 0:
        return None
    size = min(size, n)

    def grow(key: tuple, part: pa.Table) -> pa.Table:
        # Same rows in the same order on every run, whatever order the shuffle delivered.
        matrix = rows_of(part.sort_by("_place").column("vector")).astype(np.float32)
        tree = grow_tree(matrix, np.random.default_rng([seed, key[0].as_py()]))
        return pa.table({"tree": pa.array([key[0].as_py()], pa.int32()), **{n: [values] for n, values in tree.items()}})

    grown = (
        _tree_samples(rows, n, trees, size, seed)
        .select("tree", "_place", "vector")
        .groupBy("tree")
        .applyInArrow(grow, "tree int, feature array<bigint>, cut array<double>, child array<bigint>, path array<double>")
    )
    parts = grown.orderBy("tree").collect()  # one small row per tree
    starts = np.concatenate([[0], np.cumsum([len(p.cut) for p in parts])])

    def joined(name: str) -> np.ndarray:
        return np.concatenate([np.asarray(p[name]) for p in parts])

    child = np.concatenate([np.asarray(p.child) + s for p, s in zip(parts, starts)])
    unit = max(float(expected_depth(size)), 1e-12)
    levels = math.ceil(math.log2(max(size, 2)))
    return Forest(starts[:-1], joined("feature"), joined("cut"), child, joined("path"), levels, unit)


def with_raw_score(df: DataFrame, forest: Forest, vector: str = "vector", out: str = "isolation") -> DataFrame:
    """Add the forest's score to every row, in place."""
    shared = df.sparkSession.sparkContext.broadcast(forest)

    @F.arrow_udf("double")
    def score(vectors: pa.Array) -> pa.Array:
        if not len(vectors):
            return pa.array([], pa.float64())
        return pa.array(shared.value.scores(rows_of(vectors).astype(np.float32)))

    return df.withColumn(out, score(F.col(vector)))


def isolation_forest_scores(df: DataFrame, row_id: str, vector: str = "vector", seed: int = SEED) -> DataFrame:
    """(row_id, ml_score): isolation scaled to [0, 1] (runs actions, writes a scratch table)."""
    forest = fit_forest(df, row_id, vector, seed=seed)
    if forest is None:
        return df.select(row_id, F.lit(0.0).alias("ml_score"))
    raw = materialize(with_raw_score(even(df.select(row_id, vector), row_id), forest, vector).drop(vector), "isolation")
    return min_max(raw, "isolation", "ml_score").select(row_id, "ml_score")


NODES = "tree int, node bigint, feature bigint, cut double, child bigint, path double"


@dataclass(frozen=True)
class Scorer:
    """A forest and the least and greatest score of the rows it was fitted to; null for a table without rows."""

    forest: Forest | None
    low: float
    high: float

    def score(self, df: DataFrame, vector: str = "vector", out: str = "ml_score") -> DataFrame:
        """Add the score of every row, from 0 to 1 as among the fitted rows, which later ones may not pass.

        A narrow pass without actions: it serves tables and streams alike.
        """
        if self.forest is None:
            return df.withColumn(out, F.lit(0.0))
        scaled = (F.col("_isolation") - F.lit(self.low)) / F.lit(self.high - self.low + EPSILON)
        raw = with_raw_score(df, self.forest, vector, "_isolation")
        return raw.withColumn(out, F.greatest(F.lit(0.0), F.least(F.lit(1.0), scaled))).drop("_isolation")


def fit_scorer(df: DataFrame, row_id: str, vector: str = "vector", seed: int = SEED) -> Scorer:
    """Grow the forest and find the bounds of its scores (actions)."""
    forest = fit_forest(df, row_id, vector, seed=seed)
    if forest is None:
        return Scorer(None, 0.0, 0.0)
    raw = with_raw_score(even(df.select(row_id, vector), row_id), forest, vector)
    low, high = raw.agg(F.min("isolation"), F.max("isolation")).first()
    return Scorer(forest, low, high)


def save_scorer(scorer: Scorer, spark: SparkSession, root: str) -> int:
    """Write the next version: nodes as rows, and one row about the forest, last; its number (actions).

    At most ``TREES`` x 511 rows leave the driver. A version without its last row was never finished and is passed over.
    """
    number = max(scorer_versions(spark, root, finished=False), default=0) + 1
    f = scorer.forest
    rows, about = [], (scorer.low, scorer.high, 0, 0.0)
    if f is not None:
        tree = np.searchsorted(f.roots, np.arange(len(f.cut)), side="right") - 1
        columns = (tree, np.arange(len(f.cut)), f.feature, f.cut, f.child, f.path)
        rows = list(zip(*[c.tolist() for c in columns], strict=True))
        about = (scorer.low, scorer.high, f.levels, f.unit)
    spark.createDataFrame(rows, NODES).coalesce(1).write.parquet(f"{root}/version={number}/nodes")
    spark.createDataFrame([about], "low double, high double, levels int, unit double").coalesce(1).write.parquet(f"{root}/version={number}/about")
    return number


def scorer_versions(spark: SparkSession, root: str, finished: bool = True) -> list[int]:
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path(root)):
        return []
    names = [s.getPath().getName() for s in files.listStatus(path(root))]
    known = sorted(int(n[8:]) for n in names if n.startswith("version="))
    return [n for n in known if not finished or files.exists(path(f"{root}/version={n}/about/_SUCCESS"))]


def load_scorer(spark: SparkSession, root: str, number: int | None = None) -> Scorer:
    """The last finished version, or the one of that number."""
    known = scorer_versions(spark, root)
    if not known or (number is not None and number not in known):
        raise FileNotFoundError(f"{root} has no version {number or ''}".strip())
    place = f"{root}/version={number or known[-1]}"
    low, high, levels, unit = spark.read.parquet(f"{place}/about").first()
    nodes = spark.read.parquet(f"{place}/nodes").orderBy("node").toArrow()
    if not nodes.num_rows:
        return Scorer(None, low, high)
    column = {n: nodes.column(n).to_numpy() for n in nodes.column_names}
    roots = np.flatnonzero(np.diff(column["tree"], prepend=-1))
    return Scorer(Forest(roots, column["feature"], column["cut"], column["child"], column["path"], levels, unit), low, high)
