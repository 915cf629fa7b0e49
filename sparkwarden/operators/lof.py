"""Local Outlier Factor by cosine distance, built from joins and sums.

Equal vectors are collapsed to one row with a weight first. They have the same distances to everything, hence the
same score, and a third of all sessions sharing one vector become a single row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkwarden.operators.graph import neighbour_graph
from sparkwarden.operators.points import dense_index
from sparkwarden.operators.scaling import min_max
from sparkwarden.operators.similarity import BROADCAST_BYTES, topk
from sparkwarden.session import materialize

# Number of neighbours, and the guard against a zero mean distance.
NEIGHBOURS = 35
GUARD = 1e-10


def outlier_factors(
    df: DataFrame,
    row_id: str,
    vector: str = "vector",
    k: int = NEIGHBOURS,
    limit: int = BROADCAST_BYTES,
    graph: bool = False,
) -> DataFrame:
    """(row_id, lof): the raw factor, about 1 for an ordinary row (runs actions, writes scratch tables).

    Neighbours at the same distance are taken in order of their lowest row id. ``graph`` takes neighbours from
    ``graph.neighbour_graph``, which compares n x k x k instead of n x n vectors and may miss some; the factor is exact
    for the neighbours that were found.
    """
    rows = df.select(F.col(row_id).alias("row_id"), F.col(vector).alias("vector"))
    total = rows.count()
    if total < 2:
        return rows.select(F.col("row_id").alias(row_id), F.lit(1.0).alias("lof"))
    k = max(1, min(k, total - 1))

    distinct = rows.groupBy("vector").agg(F.min("row_id").alias("first_id"), F.count(F.lit(1)).alias("weight"))
    distinct = dense_index(distinct, "first_id", "point_id")
    points = distinct.select("point_id", "vector")
    if graph:
        found = neighbour_graph(points, k)
    else:
        queries = points.withColumnRenamed("point_id", "query_id")
        found = topk(queries, points, k, exclude_self=True, limit=limit)

    # A row's neighbours: its own copies at distance 0, then others until k are reached.
    weights = distinct.select("point_id", "weight")
    others = found.join(weights, "point_id").select(
        "query_id", "point_id", "rank", (1.0 - F.col("score")).alias("distance"), "weight"
    )
    copies = weights.filter(F.col("weight") > 1).select(
        F.col("point_id").alias("query_id"),
        "point_id",
        F.lit(0).cast("bigint").alias("rank"),
        F.lit(0.0).alias("distance"),
        (F.col("weight") - 1).alias("weight"),
    )
    so_far = Window.partitionBy("query_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("weight").over(so_far), F.lit(0))
    edges = others.unionByName(copies).withColumn("taken", F.least("weight", F.lit(k) - before))
    edges = materialize(edges.filter(F.col("taken") > 0).select("query_id", "point_id", "distance", "taken"), "lof-edges")

    reach_to = edges.groupBy("query_id").agg(F.max("distance").alias("k_distance"))
    reach = F.greatest("distance", "k_distance") * F.col("taken")
    density = (
        edges.join(reach_to.withColumnRenamed("query_id", "point_id"), "point_id")
        .groupBy("query_id")
        .agg((1.0 / (F.sum(reach) / k + GUARD)).alias("density"))
    )
    density = materialize(density, "lof-density")
    around = (
        edges.join(density.withColumnRenamed("query_id", "point_id"), "point_id")
        .groupBy("query_id")
        .agg((F.sum(F.col("density") * F.col("taken")) / k).alias("around"))
    )
    factors = around.join(density, "query_id").select(
        F.col("query_id").alias("point_id"), (F.col("around") / F.col("density")).alias("lof")
    )
    by_vector = distinct.select("point_id", "vector").join(factors, "point_id").select("vector", "lof")
    return rows.join(by_vector, "vector").select(F.col("row_id").alias(row_id), "lof")


def lof_scores(
    df: DataFrame,
    row_id: str,
    vector: str = "vector",
    k: int = NEIGHBOURS,
    limit: int = BROADCAST_BYTES,
    graph: bool = False,
) -> DataFrame:
    """(row_id, ml_score): the factor scaled to [0, 1]."""
    factors = materialize(outlier_factors(df, row_id, vector, k, limit, graph), "lof")
    return min_max(factors, "lof", "ml_score").select(row_id, "ml_score")
