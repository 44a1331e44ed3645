"""Queries: ground truth, recall, comments and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import evaluate, report, truth
from ..operators.common import scratch_path
from ..operators.exact import knn_exact
from ..operators.ivf import search_ivfflat
from ..operators.run import compare_methods
from ..sources.tables import write_report
from . import sql
from .registry import Tables, joined_set, query, rounded
from .searching import IVF, centroids

RECALL_N, SHOWN = 10, 5
THRESHOLD = 1.2  # vectors here lie far apart, so the default distance would never fire
NAMES = ["Exact", "IVF-Flat"]

FOUND = "found AS (" + sql.methods({"Exact": sql.exact(RECALL_N, 0), "IVF-Flat": sql.ivf(RECALL_N, 0)}) + ")"
GOOD = [sql.HITS, sql.GOOD]
TRUTH = [*GOOD, sql.truth(RECALL_N)]
SCORED = f"""scored AS (SELECT m.method, q.query_id, coalesce(s.n, 0) AS truth_size, count(t.subject) AS hits,
  CASE WHEN coalesce(s.n, 0) > 0 THEN count(t.subject) / least({RECALL_N}, s.n) ELSE 0.0 END AS recall
  FROM (SELECT DISTINCT method FROM found) AS m CROSS JOIN (SELECT vec_id AS query_id FROM embeddings) AS q
  LEFT JOIN (SELECT query, count(*) AS n FROM truth GROUP BY query) AS s ON s.query = q.query_id
  LEFT JOIN found AS f ON f.method = m.method AND f.query_id = q.query_id
  LEFT JOIN truth AS t ON t.query = q.query_id AND t.subject = f.neighbor_id
  GROUP BY m.method, q.query_id, s.n)"""
MARKED = f"""marked AS (SELECT f.*, coalesce(i.pident, 0.0) AS identity, CASE WHEN t.subject IS NULL THEN 'No' ELSE 'Yes' END AS in_truth
  FROM found AS f LEFT JOIN ident AS i ON i.query = f.query_id AND i.subject = f.neighbor_id
  LEFT JOIN truth AS t ON t.query = f.query_id AND t.subject = f.neighbor_id WHERE f.rank <= {SHOWN})"""
SHARED = """shared AS (SELECT m.*, list_sort(list_intersect(a.domains, b.domains)) AS dom, list_sort(list_intersect(a.ec, b.ec)) AS ec
  FROM marked AS m LEFT JOIN annot AS a ON a.id = m.query_id LEFT JOIN annot AS b ON b.id = m.neighbor_id)"""
VERDICT = f"""CASE WHEN identity < 30 AND distance < {THRESHOLD} THEN printf('REMOTE HOMOLOG CANDIDATE (%.1f%%)', identity)
  WHEN identity > 30 THEN 'High similarity' WHEN identity > 20 THEN printf('Twilight Zone (%.1f%%)', identity)
  WHEN identity > 0 THEN printf('Remote homolog candidate (%.1f%%)', identity) ELSE 'No BLAST match' END"""
DOMAINS = "CASE WHEN len(dom) > 0 THEN ' [Common domains: ' || array_to_string(dom[1:2], ', ') || ']' ELSE '' END"
EC = "CASE WHEN len(ec) > 0 THEN ' [Common EC: ' || array_to_string(ec, ', ') || ']' ELSE '' END"
REPORT = f"report AS (SELECT method, query_id, neighbor_id, distance, rank, identity, in_truth, {VERDICT} || {DOMAINS} || {EC} AS comment FROM shared)"
ROWS = [*TRUTH, sql.IDENTITY, sql.ANNOT, FOUND, MARKED, SHARED, REPORT]
LINE = "printf('%4d | %-11s | %7.3f | %13.1f%% | %-15s | %s', rank, CAST(neighbor_id AS VARCHAR), distance, identity, in_truth, comment)"


def found(t: Tables) -> DataFrame:
    """Neighbours of all queries from an exact and an approximate method."""
    return t.once("found", _found)


def _found(t: Tables) -> DataFrame:
    exact = knn_exact(t.base, t.queries, RECALL_N).withColumn("method", F.lit("Exact"))
    near = search_ivfflat(t.base, t.queries, RECALL_N, IVF, centroids(t)).withColumn("method", F.lit("IVF-Flat"))
    return exact.unionByName(near)


def good(t: Tables) -> DataFrame:
    return truth.filter_hits(t.hits)


def top_truth(t: Tables) -> DataFrame:
    return truth.truth_topn(good(t), RECALL_N)


def scored(t: Tables) -> DataFrame:
    return t.once("scored", lambda t: evaluate.recall(found(t), top_truth(t), t.queries, RECALL_N, NAMES))


def reported(t: Tables) -> DataFrame:
    return t.once("report", lambda t: report.neighbor_report(
        found(t), top_truth(t), truth.identity_last(good(t)), SHOWN, t.annotations, THRESHOLD))


@query("evalue_filter", sql.select(GOOD, "SELECT query, subject, evalue, hit_seq FROM good"))
def q_evalue(t):
    return good(t).select("query", "subject", "evalue", "hit_seq")


@query("truth_topn", sql.select(TRUTH, "SELECT query, subject FROM truth"))
def q_truth(t):
    return top_truth(t)


@query("truth_topn_rows", sql.select(GOOD, f"""SELECT query, subject, CAST(r AS BIGINT) AS rank FROM (SELECT query, subject,
  row_number() OVER (PARTITION BY query ORDER BY bitscore DESC, hit_seq) AS r FROM good) AS s WHERE r <= {RECALL_N}"""))
def q_truth_rows(t):
    return truth.truth_topn(good(t), RECALL_N, distinct=False)


@query("identity_last", sql.select([*GOOD, sql.IDENTITY], "SELECT query, subject, pident FROM ident"))
def q_identity_last(t):
    return truth.identity_last(good(t))


@query("truth_counts", sql.select(GOOD, "SELECT count(DISTINCT query) AS n_queries, count(*) AS n_hits FROM good"))
def q_truth_counts(t):
    return truth.truth_counts(good(t))


@query("truth_semi", sql.select([*TRUTH, FOUND], """SELECT method, query_id, neighbor_id, rank FROM found
WHERE EXISTS (SELECT 1 FROM truth WHERE query = query_id AND subject = neighbor_id)"""))
def q_semi(t):
    return evaluate.hits_in_truth(found(t), top_truth(t)).select("method", "query_id", "neighbor_id", "rank")


@query("queries_without_truth", sql.select(TRUTH, "SELECT vec_id AS query_id FROM embeddings WHERE vec_id NOT IN (SELECT query FROM truth)"))
def q_without(t):
    return evaluate.queries_without_truth(t.queries, top_truth(t))


@query("recall_at_n", sql.select([*TRUTH, FOUND, SCORED], "SELECT method, query_id, truth_size, hits, round(recall, 6) AS recall FROM scored"))
def q_recall(t):
    return rounded(scored(t), "recall")


@query("method_summary", sql.select([*TRUTH, FOUND, SCORED], """SELECT method, count(*) AS n_queries, CAST(sum(hits) AS BIGINT) AS hits,
  round(avg(recall), 6) AS avg_recall FROM scored GROUP BY method"""))
def q_summary(t):
    return rounded(evaluate.method_summary(scored(t)), "avg_recall")


@query("run_summary", sql.select([*TRUTH, FOUND, SCORED], """SELECT method, count(*) AS n_queries, round(avg(recall), 6) AS avg_recall,
  (SELECT count(*) FROM embeddings) AS db_size FROM scored GROUP BY method"""))
def q_run_summary(t):
    return rounded(evaluate.run_summary(scored(t), t.base), "avg_recall")


@query("eval_per_query", sql.select([*TRUTH, FOUND, SCORED], """SELECT query_id, method, round(recall, 6) AS recall FROM scored
UNION ALL SELECT DISTINCT query_id, 'BLAST (Ref)', 1.0 FROM scored"""))
def q_eval(t):
    return rounded(evaluate.eval_per_query(scored(t)).select("query_id", "method", "recall"), "recall")


@query("identity_lookup", sql.select([*GOOD, sql.IDENTITY, FOUND], """SELECT method, query_id, neighbor_id, coalesce(pident, 0.0) AS identity
FROM found LEFT JOIN ident ON query = query_id AND subject = neighbor_id"""))
def q_identity(t):
    return report.identity_lookup(found(t), truth.identity_last(good(t))).select(
        "method", "query_id", "neighbor_id", "identity")


@query("in_truth_flag", sql.select([*TRUTH, FOUND], """SELECT method, query_id, neighbor_id, CASE WHEN subject IS NULL THEN 'No' ELSE 'Yes' END AS in_truth
FROM found LEFT JOIN truth ON query = query_id AND subject = neighbor_id"""))
def q_in_truth(t):
    return report.in_truth(found(t), top_truth(t)).select("method", "query_id", "neighbor_id", "in_truth")


@query("remote_flag", sql.select(ROWS, f"""SELECT method, query_id, neighbor_id,
  coalesce(identity < 30 AND distance < {THRESHOLD}, false) AS remote FROM report"""))
def q_remote(t):
    return reported(t).select("method", "query_id", "neighbor_id", report.is_remote(
        F.col("identity"), F.col("distance"), THRESHOLD).alias("remote"))


@query("bio_comment", f"""WITH pairs AS (SELECT o_orderkey AS pair, CAST(o_orderkey * 7 % 1001 AS DOUBLE) / 10 AS identity,
  CASE WHEN o_custkey % 13 = 0 THEN NULL ELSE o_totalprice / 300000 END AS distance FROM orders)
SELECT pair, {VERDICT} AS comment FROM pairs""")
def q_comment(t):
    """Verdict on made pairs that cover every class, also a missing distance."""
    cust = F.col("o_custkey")
    pairs = t.read("orders").select(
        F.col("o_orderkey").alias("pair"),
        (F.pmod(F.col("o_orderkey") * 7, F.lit(1001)).cast("double") / 10).alias("identity"),
        F.when(cust % 13 == 0, None).otherwise(F.col("o_totalprice") / 300000).alias("distance"))
    return pairs.select("pair", report.bio_comment(F.col("identity"), F.col("distance"), THRESHOLD).alias("comment"))


@query("annot_join", sql.select([sql.ANNOT, FOUND], """SELECT method, query_id, neighbor_id, array_to_string(list_sort(a.domains), ',') AS q_domains,
  array_to_string(list_sort(b.domains), ',') AS n_domains FROM found JOIN annot AS a ON a.id = query_id JOIN annot AS b ON b.id = neighbor_id"""))
def q_annot_join(t):
    return report.join_annotations(found(t), t.annotations).select(
        "method", "query_id", "neighbor_id", joined_set("q_domains"), joined_set("n_domains"))


@query("common_domains", sql.select([*ROWS[:-1]], f"SELECT method, query_id, neighbor_id, {DOMAINS} AS suffix FROM shared"))
def q_domains(t):
    pairs = report.join_annotations(found(t).where(F.col("rank") <= SHOWN), t.annotations)
    return pairs.select("method", "query_id", "neighbor_id",
                        report.common_domains("q_domains", "n_domains").alias("suffix"))


@query("common_ec", sql.select([*ROWS[:-1]], f"SELECT method, query_id, neighbor_id, {EC} AS suffix FROM shared"))
def q_ec(t):
    pairs = report.join_annotations(found(t).where(F.col("rank") <= SHOWN), t.annotations)
    return pairs.select("method", "query_id", "neighbor_id", report.common_ec("q_ec", "n_ec").alias("suffix"))


@query("neighbor_report", sql.select(ROWS, """SELECT method, query_id, neighbor_id, round(distance, 6) AS distance, rank, identity,
  in_truth, comment FROM report"""))
def q_report(t):
    return rounded(reported(t))


@query("row_format", sql.select(ROWS, f"SELECT method, query_id, rank, {LINE} AS line FROM report"))
def q_rows(t):
    return report.format_rows(reported(t)).select("method", "query_id", "rank", "line")


B = report.BLOCK
SHORT, LONG, END = report.SHORT_RULE, report.LONG_RULE, report.END_RULE


def _fixed(section: int, lines: list[tuple[int, str]]) -> str:
    rows = ", ".join(f"({no}, {text})" for no, text in lines)
    return f"SELECT query_id, {section} AS section, l.no AS line_no, l.line FROM ids, LATERAL (VALUES {rows}) AS l(no, line)"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


LINES = f"""{_fixed(0, [(1, "'Query Protein: ' || query_id"), (2, _q(report.SIZE_HEAD % RECALL_N)), (3, "''")])}
UNION ALL {_fixed(1, [(1, _q(report.COMPARE_HEAD)), (2, _q(SHORT)), (3, _q(report.METHOD_HEAD)), (4, _q(SHORT)),
                      (4 * B, _q(SHORT)), (4 * B + 1, "''")])}
UNION ALL SELECT query_id, 1, CASE method WHEN 'Exact' THEN {B} ELSE {2 * B} END,
  printf('%-16s | %-12s | %-7s | %.3f', method, '-', '-', recall) FROM scored
UNION ALL SELECT query_id, 1, {3 * B}, printf('%-16s | %-12s | %-7s | 1.000', 'BLAST (Ref)', '-', '-') FROM ids
UNION ALL {_fixed(2, [(1, _q(report.NEIGHBOR_HEAD % (SHOWN, SHOWN))), (2, "''")])}
UNION ALL SELECT query_id, 2, begin_no + l.no, l.line FROM (SELECT query_id, method, CASE method WHEN 'Exact' THEN {B} ELSE {2 * B} END AS begin_no,
  max(rank) AS n FROM report GROUP BY query_id, method) AS g,
  LATERAL (VALUES (1, 'Method: ' || method), (2, {_q(LONG)}), (3, {_q(report.ROW_HEAD)}), (4, {_q(LONG)}), (n + 5, '')) AS l(no, line)
UNION ALL SELECT query_id, 2, CASE method WHEN 'Exact' THEN {B} ELSE {2 * B} END + 4 + rank, {LINE} FROM report
UNION ALL {_fixed(3, [(1, _q(END)), (2, "''")])}"""
LINE_CTES = [*ROWS, SCORED, "ids AS (SELECT vec_id AS query_id FROM embeddings)", f"lines AS ({LINES})"]


def lines(t: Tables) -> DataFrame:
    return report.report_lines(evaluate.eval_per_query(scored(t)), reported(t), NAMES, RECALL_N, SHOWN)


@query("report_lines", sql.select(LINE_CTES, "SELECT query_id, CAST(section AS INTEGER) AS section, CAST(line_no AS BIGINT) AS line_no, line FROM lines"))
def q_lines(t):
    return lines(t)


@query("comparison_run", sql.select(LINE_CTES, "SELECT query_id, CAST(section AS INTEGER) AS section, CAST(line_no AS BIGINT) AS line_no, line FROM lines"))
def q_comparison(t):
    """The report of one call on vectors, hits and annotations, without times."""
    methods = {"Exact": knn_exact, "IVF-Flat": lambda base, asked, n: search_ivfflat(base, asked, n, IVF, centroids(t))}
    return compare_methods(t.base, t.queries, t.hits, methods, recall_n=RECALL_N, shown=SHOWN, annotations=t.annotations,
                           threshold=THRESHOLD, timed=False).lines


SUMMARY = f"""SELECT CAST(4 AS INTEGER) AS section, l.no::BIGINT AS line_no, l.line
FROM (SELECT method, count(*) AS n, avg(recall) AS r FROM scored GROUP BY method) AS s,
  LATERAL (VALUES (1, method || ':'), (4, printf('  Μέσος Recall@{RECALL_N}: %.3f', r)), (5, '')) AS v(o, line),
  LATERAL (SELECT CASE method WHEN 'Exact' THEN {B} ELSE {2 * B} END + o AS no, line) AS l
UNION ALL SELECT 4, l.no, l.line FROM (SELECT count(*) AS n FROM embeddings) AS e,
  LATERAL (VALUES (1, '{report.SUMMARY_HEAD}'), (2, printf('Συνολικός αριθμός queries: %d', n)),
    (3, printf('Μέγεθος βάσης δεδομένων: %d', n)), (6, '')) AS l(no, line)"""


def closing(t: Tables) -> DataFrame:
    return report.summary_lines(evaluate.run_summary(scored(t), t.base), NAMES, RECALL_N)


@query("report_sink", sql.select(LINE_CTES, f"""SELECT line, count(*) AS n FROM (SELECT line FROM lines UNION ALL
SELECT line FROM ({SUMMARY}) AS s) AS u GROUP BY line"""))
def q_sink(t):
    path = scratch_path(t.spark, "report")
    write_report(lines(t), path, closing(t))
    return t.spark.read.text(path).groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


@query("legacy_report", sql.select([*TRUTH, FOUND, SCORED], f"""SELECT query_id, CASE method WHEN 'Exact' THEN 1 ELSE 2 END::BIGINT AS section,
  l.no::BIGINT AS line_no, l.line FROM scored, LATERAL (VALUES (1, 'Query Protein: ' || query_id),
  (2, printf('Method: %s | Time: - | Top-{RECALL_N}  | Recall@N: %.2f', method, recall)),
  (3, 'Rank' || chr(9) || 'Neighbor ID' || chr(9) || 'L2 Distance'), ({B}, chr(10))) AS l(no, line)
UNION ALL SELECT query_id, CASE method WHEN 'Exact' THEN 1 ELSE 2 END, rank + 3,
  printf('%d', rank) || chr(9) || neighbor_id || chr(9) || printf('%.4f', distance) FROM found"""))
def q_legacy(t):
    return report.legacy_lines(found(t), scored(t), RECALL_N, NAMES)


@query("summary_lines", sql.select([*TRUTH, FOUND, SCORED], SUMMARY))
def q_summary_lines(t):
    return closing(t)
