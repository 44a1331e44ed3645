"""The whole comparison in one call: vectors, hits and annotations in, neighbours, scores, report and summary out."""

from __future__ import annotations

import time
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_annotations, read_hits, read_vectors, resolve_queries, write_report
from .common import settle
from .evaluate import SearchFn, eval_per_query, recall, run_summary, search_all
from .report import REMOTE_DISTANCE, neighbor_report, report_lines, summary_lines
from .truth import filter_hits, identity_last, truth_topn


@dataclass
class Comparison:
    """Tables of one run; each can be read on its own."""

    neighbors: DataFrame  # method, query_id, neighbor_id, distance, rank
    errors: DataFrame  # method, error
    scores: DataFrame  # method, query_id, truth_size, hits, recall
    per_query: DataFrame  # query_id, method, seconds, qps, recall, with the reference row
    report: DataFrame  # shown neighbours with identity, in_truth, comment
    lines: DataFrame  # query_id, section, line_no, line
    summary: DataFrame  # closing figures per method
    closing: DataFrame  # their lines: section, line_no, line


def compare_methods(base: DataFrame, queries: DataFrame, hits: DataFrame, methods: Mapping[str, SearchFn], *, recall_n: int = 50,
                    shown: int = 10, annotations: DataFrame | None = None, threshold: float = REMOTE_DISTANCE, timed: bool = True,
                    path: str | None = None) -> Comparison:
    """Searches ``queries`` (query_id, query_vec) in ``base`` (id, embedding) by all ``methods``, scores them against ``hits`` and reports.

    A method that fails has its error listed and an error line in the report. Times are each query's share of its method's bulk search.
    With ``path`` the report is written there as text.
    """
    spark, seconds = base.sparkSession, {}

    def measured(name: str, search: SearchFn) -> SearchFn:
        def run(base: DataFrame, queries: DataFrame, n: int) -> DataFrame:
            start = time.perf_counter()
            out = settle(search(base, queries, n))
            seconds[name] = time.perf_counter() - start
            return out
        return run

    good = settle(filter_hits(hits))
    truth = settle(truth_topn(good, recall_n))
    names, start = list(methods), time.perf_counter()
    neighbors, errors = search_all(base, queries, {k: measured(k, f) for k, f in methods.items()}, max(recall_n, shown), eager=False)
    total = time.perf_counter() - start
    scores = settle(recall(neighbors, truth, queries, recall_n, names))
    timings = None
    if timed and seconds:
        n = max(queries.count(), 1)
        each = spark.createDataFrame([(k, s / n) for k, s in seconds.items()], "method string, seconds double")
        timings = queries.select("query_id").crossJoin(F.broadcast(each)).select("method", "query_id", "seconds")  # one row per method
    per_query = eval_per_query(scores, timings)
    report = settle(neighbor_report(neighbors, truth, identity_last(good), shown, annotations, threshold))
    lines = report_lines(per_query, report, names, recall_n, shown, errors)
    summary = run_summary(scores, base, total if timed else None, timings)
    closing = summary_lines(summary, names, recall_n)
    if path is not None:
        write_report(lines, path, closing)
    return Comparison(neighbors, errors, scores, per_query, report, lines, summary, closing)


def compare_files(spark: SparkSession, vectors: str, wanted: DataFrame, hits: str, methods: Mapping[str, SearchFn],
                  annotations: str | None = None, **how) -> tuple[Comparison, DataFrame]:
    """``compare_methods`` on stored inputs: (comparison, wanted queries without a vector).

    ``vectors``: a vector table, ``wanted``: query_id of the vectors to ask with, ``hits``: tab-separated hits, ``annotations``: JSON objects.
    """
    base = read_vectors(spark, vectors)
    queries, missing = resolve_queries(wanted, base)
    notes = read_annotations(spark, annotations) if annotations else None
    return compare_methods(base, queries, read_hits(spark, hits), methods, annotations=notes, **how), missing
