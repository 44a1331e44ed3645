"""Recall, per-method summaries, running several methods, timing."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settle

SearchFn = Callable[[DataFrame, DataFrame, int], DataFrame]

# Display name per method key, and the reference row of the comparison.
METHOD_NAMES = {
    "lsh": "Euclidean LSH",
    "hypercube": "Hypercube",
    "ivfflat": "IVF-Flat",
    "ivfpq": "IVF-PQ",
    "neural": "Neural LSH",
}
REFERENCE_ROW = "BLAST (Ref)"


def select_methods(choice: str, available: Mapping[str, SearchFn]) -> dict[str, SearchFn]:
    """The chosen search functions by display name; ``all`` keeps every one."""
    if choice != "all" and choice not in METHOD_NAMES:
        raise ValueError(f"unknown method {choice!r}")
    return {METHOD_NAMES[key]: fn for key, fn in available.items() if choice in ("all", key)}


def search_all(base: DataFrame, queries: DataFrame, methods: Mapping[str, SearchFn], n: int,
               eager: bool = True) -> tuple[DataFrame, DataFrame]:
    """Run every method on the same queries: (neighbors with ``method``, errors).

    A method that raises is recorded in ``errors`` and contributes no neighbours; the others go
    on. ``eager`` settles each result so that failures inside tasks are caught as well.
    """
    spark = base.sparkSession
    found, failed = None, []
    for name, search in methods.items():
        try:
            part = search(base, queries, n).select(
                F.lit(name).alias("method"), "query_id", "neighbor_id", "distance", "rank")
            part = settle(part) if eager else part
        except Exception as error:
            failed.append((name, str(error).splitlines()[0] if str(error) else type(error).__name__))
            continue
        found = part if found is None else found.unionByName(part)
    if found is None:
        q, b = queries.schema["query_id"].dataType, base.schema["id"].dataType
        found = spark.createDataFrame([], f"method string, query_id {q.simpleString()}, "
                                          f"neighbor_id {b.simpleString()}, distance double, rank bigint")
    return found, spark.createDataFrame(failed, "method string, error string")


def hits_in_truth(neighbors: DataFrame, truth: DataFrame) -> DataFrame:
    """Neighbours that belong to the query's truth set."""
    pairs = truth.select(F.col("query").alias("query_id"), F.col("subject").alias("neighbor_id"))
    return neighbors.join(pairs, ["query_id", "neighbor_id"], "left_semi")


def queries_without_truth(queries: DataFrame, truth: DataFrame) -> DataFrame:
    """Queries that no truth row mentions."""
    known = truth.select(F.col("query").alias("query_id")).distinct()
    return queries.select("query_id").join(known, "query_id", "left_anti")


def recall(neighbors: DataFrame, truth: DataFrame, queries: DataFrame, n: int,
           methods: list[str] | None = None) -> DataFrame:
    """Per method and query: truth_size, hits, recall = hits / min(n, truth size), 0 without truth.

    Every query appears for every method, found or not.
    """
    if methods is None:  # one name per search function
        methods = sorted(r["method"] for r in neighbors.select("method").distinct().collect())
    sizes = truth.groupBy(F.col("query").alias("query_id")).agg(F.count("*").alias("truth_size"))
    good = hits_in_truth(neighbors.where(F.col("rank") <= n), truth).groupBy(
        "method", "query_id").agg(F.count("*").alias("hits"))
    frame = queries.select("query_id").join(sizes, "query_id", "left").withColumn(
        "method", F.explode(F.lit(methods).cast("array<string>")))
    joined = frame.join(good, ["method", "query_id"], "left")
    size, hits = F.coalesce("truth_size", F.lit(0)), F.coalesce("hits", F.lit(0))
    score = F.when(size > 0, hits / F.least(F.lit(n), size)).otherwise(0.0)
    return joined.select("method", "query_id", size.alias("truth_size"), hits.alias("hits"),
                         score.alias("recall"))


def eval_per_query(scored: DataFrame, timings: DataFrame | None = None) -> DataFrame:
    """Comparison rows per query and method plus the constant reference row.

    ``timings`` (method, query_id, seconds) is optional; without it time and QPS are null.
    """
    if timings is None:
        timed = scored.withColumn("seconds", F.lit(None).cast("double"))
    else:
        timed = scored.join(timings, ["method", "query_id"], "left")
    rows = timed.select("query_id", "method", "seconds",
                        F.when(F.col("seconds") > 0, 1 / F.col("seconds"))
                        .when(F.col("seconds").isNotNull(), 0.0).alias("qps"), "recall")
    ref = scored.select("query_id").distinct().select(
        "query_id", F.lit(REFERENCE_ROW).alias("method"), F.lit(None).cast("double").alias("seconds"),
        F.lit(None).cast("double").alias("qps"), F.lit(1.0).alias("recall"))
    return rows.unionByName(ref)


def method_summary(scored: DataFrame, timings: DataFrame | None = None) -> DataFrame:
    """Mean recall (and time, QPS) per method; failed queries stay in the divisor of time and recall."""
    if timings is None:
        return scored.groupBy("method").agg(
            F.count("*").alias("n_queries"), F.sum("hits").alias("hits"),
            F.avg("recall").alias("avg_recall"))
    timed = scored.join(timings, ["method", "query_id"], "left")
    return timed.groupBy("method").agg(
        F.count("*").alias("n_queries"), F.sum("hits").alias("hits"),
        F.avg("recall").alias("avg_recall"),
        (F.coalesce(F.sum("seconds"), F.lit(0.0)) / F.count("*")).alias("avg_time"),
        F.coalesce(F.avg(F.when(F.col("seconds") > 0, 1 / F.col("seconds"))), F.lit(0.0)).alias("avg_qps"))


def run_summary(scored: DataFrame, base: DataFrame, total_seconds: float | None = None,
                timings: DataFrame | None = None) -> DataFrame:
    """Closing figures per method: n_queries, db_size, avg_recall [, avg_time, avg_qps] [, total_time, total_qps]."""
    times = [] if timings is None else ["avg_time", "avg_qps"]
    out = method_summary(scored, timings).select("method", "n_queries", "avg_recall", *times,
                                                 base.agg(F.count("*")).scalar().alias("db_size"))
    if total_seconds is not None:
        out = out.withColumn("total_time", F.lit(total_seconds)).withColumn(
            "total_qps", F.col("n_queries") / F.lit(total_seconds) if total_seconds > 0 else F.lit(0.0))
    return out


def mean_timings(measured: DataFrame, queries: DataFrame) -> DataFrame:
    """Each query's share of the bulk search time of ``bench`` rows: method, query_id, seconds."""
    methods = [(r["method"], 1 / r["qps"] if r["qps"] else None) for r in measured.collect()]  # one row per method
    each = F.array(*[F.struct(F.lit(m).alias("method"), F.lit(s).cast("double").alias("seconds")) for m, s in methods])
    return queries.select("query_id", F.explode(each).alias("t")).select("t.method", "query_id", "t.seconds")


def bench(methods: Mapping[str, tuple[Callable[[], object], Callable[[object], DataFrame]]],
          n_queries: int, spark: SparkSession) -> DataFrame:
    """Build and bulk-search wall time per method: method, build_s, search_s, qps.

    Each entry is (build, search): ``build`` returns an index, ``search(index)`` a result that is
    fully evaluated but not kept.
    """
    rows = []
    for name, (build, search) in methods.items():
        start = time.perf_counter()
        index = build()
        built = time.perf_counter()
        search(index).write.format("noop").mode("overwrite").save()
        done = time.perf_counter()
        rows.append((name, built - start, done - built, n_queries / max(done - built, 1e-9)))
    return spark.createDataFrame(rows, "method string, build_s double, search_s double, qps double")
