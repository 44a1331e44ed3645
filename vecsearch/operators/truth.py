"""Ground truth from a table of aligner hits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: hits at or above this e-value are ignored.
MAX_EVALUE = 0.01


def filter_hits(hits: DataFrame, max_evalue: float = MAX_EVALUE) -> DataFrame:
    """Hits strictly below the e-value; null and NaN drop."""
    return hits.where((F.col("evalue") < max_evalue) & ~F.isnan("evalue"))


def truth_topn(hits: DataFrame, n: int = 50, distinct: bool = True) -> DataFrame:
    """Subjects of the ``n`` best hit rows per query by bitscore (file order breaks ties).

    ``distinct`` gives a set per query (possibly fewer than ``n``); otherwise every row stays,
    with its rank, as the older evaluation counts them.
    """
    order = Window.partitionBy("query").orderBy(F.desc("bitscore"), "hit_seq")
    best = hits.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= n)
    if distinct:
        return best.select("query", "subject").distinct()
    return best.select("query", "subject", "rank")


def identity_last(hits: DataFrame) -> DataFrame:
    """Percent identity of the last hit row per pair: query, subject, pident."""
    return hits.groupBy("query", "subject").agg(F.max_by("pident", "hit_seq").alias("pident"))


def truth_counts(hits: DataFrame) -> DataFrame:
    """One row: n_queries, n_hits."""
    return hits.groupBy("query").agg(F.count("*").alias("n")).agg(
        F.count("*").alias("n_queries"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_hits"))
