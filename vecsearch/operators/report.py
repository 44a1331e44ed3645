"""Annotated neighbour reports: tables first, text lines last."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fixed
from .evaluate import REFERENCE_ROW

# Thresholds and texts of the biological comment.
REMOTE_DISTANCE, REMOTE_IDENTITY = 0.3, 30
HIGH_IDENTITY, TWILIGHT_IDENTITY = 30, 20
REMOTE_FLAG = "REMOTE HOMOLOG CANDIDATE (%s%%)"
HIGH = "High similarity"
TWILIGHT = "Twilight Zone (%s%%)"
REMOTE = "Remote homolog candidate (%s%%)"
NO_MATCH = "No BLAST match"
DOMAINS = " [Common domains: %s]"
EC_NUMBERS = " [Common EC: %s]"
SHOWN_DOMAINS = 2

# Layout of the report.
ROW = "%4d | %-11s | %7s | %13s%% | %-15s | %s"
ROW_HEAD = "Rank | Neighbor ID | L2 Dist | BLAST Identity | In BLAST Top-N? | Bio comment"
METHOD_HEAD = "Method            | Time/query (s) | QPS     | Recall@N vs BLAST Top-N"
QUERY_HEAD = "Query Protein: "
SIZE_HEAD = "N = %d (μέγεθος λίστας Top-N για την αξιολόγηση Recall@N)"
COMPARE_HEAD = "[1] Συνοπτική σύγκριση μεθόδων"
NEIGHBOR_HEAD = "[2] Top-%d γείτονες ανά μέθοδο (εδώ π.χ. N = %d για εκτύπωση)"
METHOD_TITLE = "Method: "
SHORT_RULE, LONG_RULE, END_RULE = "-" * 70, "-" * 90, "=" * 80
LEGACY_METHOD = "Method: %s | Time: %s | Top-%d  | Recall@N: %s"
LEGACY_HEAD = "Rank\tNeighbor ID\tL2 Distance"
LEGACY_ROW = "%d\t%s\t%s"
SUMMARY_HEAD = "=== ΣΥΝΟΠΤΙΚΗ ΣΤΑΤΙΣΤΙΚΗ ==="
SUMMARY_QUERIES = "Συνολικός αριθμός queries: %d"
SUMMARY_BASE = "Μέγεθος βάσης δεδομένων: %d"
SUMMARY_TIME = "Συνολικός χρόνος εκτέλεσης: %.2fs"
SUMMARY_QPS = "Συνολικό QPS: %.1f"
SUMMARY_METHOD_TIME = "  Μέσος χρόνος αναζήτησης: %.4fs"
SUMMARY_METHOD_QPS = "  Μέσος QPS: %.1f"
SUMMARY_METHOD_RECALL = "  Μέσος Recall@%d: %s"


def is_remote(identity: Column, distance: Column, threshold: float = REMOTE_DISTANCE,
              max_identity: float = REMOTE_IDENTITY) -> Column:
    """Low identity but close vectors; false when the distance is missing."""
    return F.coalesce((identity < max_identity) & (distance < threshold), F.lit(False))


def bio_comment(identity: Column, distance: Column, threshold: float = REMOTE_DISTANCE) -> Column:
    """Verdict on one neighbour; the remote flag is tested first."""
    shown = fixed(identity, 1)
    return (
        F.when(is_remote(identity, distance, threshold), F.format_string(REMOTE_FLAG, shown))
        .when(identity > HIGH_IDENTITY, F.lit(HIGH))
        .when(identity > TWILIGHT_IDENTITY, F.format_string(TWILIGHT, shown))
        .when(identity > 0, F.format_string(REMOTE, shown))
        .otherwise(F.lit(NO_MATCH))
    )


def _shared(suffix: str, a: str, b: str, most: int | None = None) -> Column:
    both = F.sort_array(F.array_intersect(F.col(a), F.col(b)))
    shown = F.slice(both, 1, most) if most else both
    return F.when(F.size(both) > 0, F.format_string(suffix, F.array_join(shown, ", "))).otherwise(F.lit(""))


def common_domains(a: str, b: str) -> Column:
    """Suffix naming at most two shared domains, in order; empty if none."""
    return _shared(DOMAINS, a, b, SHOWN_DOMAINS)


def common_ec(a: str, b: str) -> Column:
    """Suffix naming all shared EC numbers, in order; empty if none."""
    return _shared(EC_NUMBERS, a, b)


def identity_lookup(neighbors: DataFrame, identity: DataFrame) -> DataFrame:
    """Percent identity of each (query, neighbour), 0.0 without a hit."""
    known = identity.select(F.col("query").alias("query_id"), F.col("subject").alias("neighbor_id"),
                            F.col("pident").alias("identity"))
    joined = neighbors.join(known, ["query_id", "neighbor_id"], "left")
    return joined.withColumn("identity", F.coalesce("identity", F.lit(0.0)))


def in_truth(neighbors: DataFrame, truth: DataFrame) -> DataFrame:
    """``in_truth`` Yes/No: is the neighbour in the query's truth set."""
    marked = truth.select(F.col("query").alias("query_id"), F.col("subject").alias("neighbor_id"),
                          F.lit(True).alias("_known")).distinct()
    joined = neighbors.join(marked, ["query_id", "neighbor_id"], "left")
    return joined.withColumn("in_truth", F.when(F.col("_known"), "Yes").otherwise("No")).drop("_known")


def annotate_truth(neighbors: DataFrame, truth: DataFrame, identity: DataFrame) -> DataFrame:
    """Neighbours with ``identity`` and ``in_truth``."""
    return in_truth(identity_lookup(neighbors, identity), truth)


def join_annotations(neighbors: DataFrame, annot: DataFrame) -> DataFrame:
    """Annotations of both sides (q_domains, q_ec, n_domains, n_ec); null unless both exist."""
    def side(prefix: str, key: str) -> DataFrame:
        return annot.select(F.col("id").alias(key), F.col("domains").alias(f"{prefix}_domains"),
                            F.col("ec_numbers").alias(f"{prefix}_ec"))

    joined = neighbors.join(side("q", "query_id"), "query_id", "left").join(
        side("n", "neighbor_id"), "neighbor_id", "left")
    both = F.col("q_domains").isNotNull() & F.col("n_domains").isNotNull()
    columns = ["q_domains", "q_ec", "n_domains", "n_ec"]
    return joined.select(*neighbors.columns, *[F.when(both, F.col(c)).alias(c) for c in columns])


def with_comment(neighbors: DataFrame, annot: DataFrame | None = None,
                 threshold: float = REMOTE_DISTANCE) -> DataFrame:
    """Adds ``comment`` from identity, distance and, if given, shared annotations."""
    verdict = bio_comment(F.col("identity"), F.col("distance"), threshold)
    if annot is None:
        return neighbors.withColumn("comment", verdict)
    joined = join_annotations(neighbors, annot)
    return joined.select(*neighbors.columns, F.concat(
        verdict, common_domains("q_domains", "n_domains"), common_ec("q_ec", "n_ec")).alias("comment"))


def neighbor_report(neighbors: DataFrame, truth: DataFrame, identity: DataFrame, n: int,
                    annot: DataFrame | None = None, threshold: float = REMOTE_DISTANCE) -> DataFrame:
    """First ``n`` neighbours per method and query with identity, truth flag and comment."""
    shown = neighbors.where(F.col("rank") <= n)
    return with_comment(annotate_truth(shown, truth, identity), annot, threshold)


def format_rows(report: DataFrame) -> DataFrame:
    """Adds ``line``, the fixed-width text of a report row."""
    return report.withColumn("line", F.format_string(
        ROW, F.col("rank"), F.col("neighbor_id").cast("string"), fixed(F.col("distance"), 3),
        fixed(F.col("identity"), 1), F.col("in_truth"), F.col("comment")))


BLOCK = 1 << 40  # line numbers reserved per method block, more than a list can have rows


def _fixed(keys: DataFrame, lines: list[tuple[int, int, Column]]) -> DataFrame:
    """The same (section, line number, text) lines for every row of ``keys``."""
    rows = F.explode(F.array(*[
        F.struct(F.lit(section).alias("section"), F.lit(no).cast("bigint").alias("line_no"), text.alias("line"))
        for section, no, text in lines]))
    return keys.select("query_id", rows.alias("l")).select("query_id", "l.section", "l.line_no", "l.line")


def _position(methods: list[str]) -> Column:
    return F.array_position(F.array(*[F.lit(m) for m in methods]), F.col("method")).cast("bigint")


def report_lines(scored: DataFrame, report: DataFrame, methods: list[str], recall_n: int, n: int,
                 errors: DataFrame | None = None) -> DataFrame:
    """Full report text: query_id, section, line_no, line.

    ``scored``: rows of ``eval_per_query``; ``report``: rows of ``neighbor_report``.
    """
    queries = scored.select("query_id").distinct()
    text = F.lit
    last = (len(methods) + 2) * BLOCK
    frame = _fixed(queries, [
        (0, 1, F.concat(text(QUERY_HEAD), F.col("query_id").cast("string"))),
        (0, 2, text(SIZE_HEAD % recall_n)), (0, 3, text("")),
        (1, 1, text(COMPARE_HEAD)), (1, 2, text(SHORT_RULE)), (1, 3, text(METHOD_HEAD)),
        (1, 4, text(SHORT_RULE)), (1, last, text(SHORT_RULE)), (1, last + 1, text("")),
        (2, 1, text(NEIGHBOR_HEAD % (n, n))), (2, 2, text("")),
        (3, 1, text(END_RULE)), (3, 2, text(""))])
    known = methods + [REFERENCE_ROW]
    cells = [F.col("method"), F.coalesce(fixed(F.col("seconds"), 3), F.lit("-")),
             F.coalesce(fixed(F.col("qps"), 1), F.lit("-")), fixed(F.col("recall"), 3)]
    # Numbers are right-aligned, a missing time is a left-aligned dash.
    timed = F.format_string("%-16s | %12s | %7s | %s", *cells)
    untimed = F.format_string("%-16s | %-12s | %-7s | %s", *cells)
    line = F.when(F.col("seconds").isNull(), untimed).otherwise(timed)
    rows = scored
    if errors is not None:
        failed = errors.select("method", F.lit(True).alias("failed"))
        rows = scored.join(failed, "method", "left")
        line = F.when(F.col("failed"), F.format_string(
            "%-16s | ERROR        | ERROR  | ERROR", F.col("method"))).otherwise(line)
    rows = rows.select("query_id", F.lit(1).alias("section"),
                       (_position(known) * BLOCK).alias("line_no"), line.alias("line"))
    placed = report.withColumn("at", _position(methods) * BLOCK)
    blocks = placed.groupBy("query_id", "method", "at").agg(F.max("rank").alias("n"))
    frames = blocks.select("query_id", F.lit(2).alias("section"), "at", F.explode(F.array(
        F.struct(F.lit(1).cast("bigint").alias("o"), F.concat(text(METHOD_TITLE), "method").alias("line")),
        F.struct(F.lit(2).cast("bigint").alias("o"), text(LONG_RULE).alias("line")),
        F.struct(F.lit(3).cast("bigint").alias("o"), text(ROW_HEAD).alias("line")),
        F.struct(F.lit(4).cast("bigint").alias("o"), text(LONG_RULE).alias("line")),
        F.struct((F.col("n") + 5).alias("o"), text("").alias("line")),
    )).alias("f")).select("query_id", "section", (F.col("at") + F.col("f.o")).alias("line_no"), "f.line")
    body = format_rows(placed).select("query_id", F.lit(2).alias("section"),
                                      (F.col("at") + 4 + F.col("rank")).alias("line_no"), "line")
    return frame.unionByName(rows).unionByName(frames).unionByName(body)


def legacy_lines(neighbors: DataFrame, scored: DataFrame, n: int, methods: list[str],
                 timings: DataFrame | None = None) -> DataFrame:
    """Older report layout: query_id, section (method position), line_no, line."""
    keys = scored.select("query_id", "method", "recall")
    time = F.lit("-")
    if timings is not None:
        keys = keys.join(timings, ["method", "query_id"], "left")
        time = F.coalesce(F.format_string("%.4fs", F.col("seconds")), F.lit("-"))
    keys = keys.withColumn("section", _position(methods)).withColumn("time", time)
    frames = keys.select("query_id", "section", F.explode(F.array(
        F.struct(F.lit(1).cast("bigint").alias("line_no"),
                 F.concat(F.lit(QUERY_HEAD), F.col("query_id").cast("string")).alias("line")),
        F.struct(F.lit(2).cast("bigint").alias("line_no"),
                 F.format_string(LEGACY_METHOD, F.col("method"), F.col("time"), F.lit(n),
                                 fixed(F.col("recall"), 2)).alias("line")),
        F.struct(F.lit(3).cast("bigint").alias("line_no"), F.lit(LEGACY_HEAD).alias("line")),
        F.struct(F.lit(BLOCK).cast("bigint").alias("line_no"), F.lit("\n").alias("line")),
    )).alias("f")).select("query_id", "section", "f.line_no", "f.line")
    body = neighbors.where(F.col("rank") <= n).select(
        "query_id", _position(methods).alias("section"), (F.col("rank") + 3).alias("line_no"),
        F.format_string(LEGACY_ROW, F.col("rank"), F.col("neighbor_id").cast("string"),
                        fixed(F.col("distance"), 4)).alias("line"))
    return frames.unionByName(body)


def summary_lines(summary: DataFrame, methods: list[str], recall_n: int) -> DataFrame:
    """Closing block of the report from ``run_summary`` rows: section, line_no, line."""
    at = _position(methods) * BLOCK
    timed = "total_time" in summary.columns
    top = [(1, F.lit(SUMMARY_HEAD)), (2, F.format_string(SUMMARY_QUERIES, F.col("n_queries"))),
           (3, F.format_string(SUMMARY_BASE, F.col("db_size")))]
    if timed:
        top += [(4, F.format_string(SUMMARY_TIME, F.col("total_time"))),
                (5, F.format_string(SUMMARY_QPS, F.col("total_qps")))]
    top += [(6, F.lit(""))]

    def lines(items, offset):
        return F.explode(F.array(*[F.struct((offset + no).cast("bigint").alias("line_no"),
                                            text.alias("line")) for no, text in items]))

    one = summary.groupBy().agg(*[F.max(c).alias(c) for c in summary.columns if c != "method"])
    header = one.select(lines(top, F.lit(0)).alias("l"))
    per_method = [(1, F.concat(F.col("method"), F.lit(":")))]
    if "avg_time" in summary.columns:
        per_method += [(2, F.format_string(SUMMARY_METHOD_TIME, F.col("avg_time"))),
                       (3, F.format_string(SUMMARY_METHOD_QPS, F.col("avg_qps")))]
    per_method += [(4, F.format_string(SUMMARY_METHOD_RECALL, F.lit(recall_n), fixed(F.col("avg_recall"), 3))),
                   (5, F.lit(""))]
    body = summary.select(lines(per_method, at).alias("l"))
    return header.unionByName(body).select(F.lit(4).alias("section"), "l.line_no", "l.line")
