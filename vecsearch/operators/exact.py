"""Exact nearest neighbours: the yardstick for every approximate method."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rank_within
from .keyed import ANY_KEY, search_keyed


def knn_exact(base: DataFrame, queries: DataFrame, n: int, **how) -> DataFrame:
    """``n`` nearest base rows of every query: query_id, neighbor_id, distance, rank."""
    everywhere = base.select("id", "embedding", F.array(F.lit(ANY_KEY)).alias("keys"))
    probes = queries.select("query_id", F.lit(ANY_KEY).alias("key"))
    return search_keyed(everywhere, probes, queries, n, everywhere=True, **how)


def knn_self(base: DataFrame, k: int, **how) -> DataFrame:
    """``k`` nearest *other* rows of every row: src, dst, distance, rank.

    The row itself is excluded by id, so duplicates of a vector stay in the result.
    """
    queries = base.select(F.col("id").alias("query_id"), F.col("embedding").alias("query_vec"))
    near = knn_exact(base, queries, k + 1, **how).where("query_id <> neighbor_id").drop("rank")
    edges = near.select(F.col("query_id").alias("src"), F.col("neighbor_id").alias("dst"),
                        "distance")
    return rank_within(edges, ["src"], ["distance", "dst"]).where(F.col("rank") <= k)
