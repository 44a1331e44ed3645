"""Queries: sources, sinks, sequence cleaning, pooling and graph operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.distance import sq_l2
from ..operators import graph, sequences
from ..operators.common import scratch_path
from ..sources import tables as io
from . import sql
from .registry import joined_set, query, rounded

RESIDUE = "regexp_replace(text, '[^ACDEFGHIKLMNPQRSTVWY]', '', 'g')"
CLEANED = f"cleaned AS (SELECT doc_id AS id, {RESIDUE} AS seq FROM documents)"


@query("fasta_scan", r"""SELECT CAST(doc_id AS VARCHAR) AS id, regexp_replace(text, '\s+', '', 'g') AS seq FROM documents""")
def q_fasta(t):
    path = scratch_path(t.spark, "fasta")
    named = t.read("documents").select(
        F.concat(F.lit(">"), F.col("doc_id").cast("string"), F.lit(" "), F.col("lang"), F.lit(" > "),
                 F.col("source"), F.lit("\n"), F.col("text")))
    named.write.text(path)
    return io.read_fasta(t.spark, path)


HIT_COLUMNS = """CAST(query AS VARCHAR) AS query, CAST(subject AS VARCHAR) AS subject, pident, CAST(length AS INTEGER) AS length,
  CAST(mismatch AS INTEGER) AS mismatch, CAST(gapopen AS INTEGER) AS gapopen, CAST(1 AS INTEGER) AS qstart,
  CAST(length AS INTEGER) AS qend, CAST(1 AS INTEGER) AS sstart, CAST(length AS INTEGER) AS send, evalue, bitscore"""


@query("hits_scan", sql.select([sql.HITS], f"""SELECT {HIT_COLUMNS},
  CAST(row_number() OVER (PARTITION BY query ORDER BY hit_seq) AS BIGINT) AS place FROM hits"""))
def q_hits(t):
    """Write the hits as text in order, read them back, check their order per query."""
    from ..operators.common import rank_within
    path = scratch_path(t.spark, "hits")
    io.write_hits(t.hits, path)
    back = io.read_hits(t.spark, path)
    return rank_within(back, ["query"], ["hit_seq"]).withColumnRenamed("rank", "place").drop("hit_seq")


@query("annot_scan", sql.select([sql.ANNOT], """SELECT CAST(id AS VARCHAR) AS id, array_to_string(list_sort(domains), ',') AS domains,
  array_to_string(ec, ',') AS ec_numbers FROM annot"""))
def q_annot(t):
    path = scratch_path(t.spark, "annotations")
    io.write_annotations(t.annotations.withColumn("id", F.col("id").cast("string")), path)
    return io.read_annotations(t.spark, path).select("id", joined_set("domains"), joined_set("ec_numbers"))


@query("family_scan", "SELECT CAST(p_partkey AS VARCHAR) AS accession, p_brand AS pfam, p_size AS length FROM part")
def q_family(t):
    path = scratch_path(t.spark, "families")
    t.read("part").select(F.col("p_partkey").alias("accession"), F.col("p_brand").alias("pfam"),
                          F.col("p_size").alias("length")).write.csv(path, sep="\t", header=True)
    return io.read_families(t.spark, path)


CHECKSUM = """SELECT vec_id AS id, CAST(len(embedding) AS INTEGER) AS dim,
  round(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x)), 6) AS sq_norm FROM embeddings"""


def _digest(df):
    zeros = F.transform("embedding", lambda _: F.lit(0.0))
    return rounded(df.select("id", F.size("embedding").alias("dim"),
                             sq_l2("embedding", zeros).alias("sq_norm")), "sq_norm")


@query("vectors_scan", CHECKSUM)
def q_vectors(t):
    path = scratch_path(t.spark, "vectors")
    io.write_vectors(t.base, path)
    return _digest(io.read_vectors(t.spark, path))


@query("vectors_write_verify", "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS mismatches FROM embeddings")
def q_verify(t):
    return io.write_vectors(t.base, scratch_path(t.spark, "vectors"), verify=True)


@query("query_cache", CHECKSUM)
def q_cache(t):
    """The second call must read what the first one stored."""
    def compute():
        return t.base

    def refuse():
        raise RuntimeError("cache was not used")

    path = scratch_path(t.spark, "cache")
    io.load_or_compute(t.spark, path, compute)
    return _digest(io.load_or_compute(t.spark, path, refuse))


@query("id_fallback", """SELECT o_orderkey, 'prot_' || (row_number() OVER (ORDER BY o_orderkey) - 1) AS id FROM orders""")
def q_fallback_ids(t):
    return io.with_fallback_ids(t.read("orders").select("o_orderkey"), "o_orderkey")


@query("skip_missing_queries", sql.select([sql.HITS, sql.BASE], """SELECT a.query AS query_id, CAST(b.id IS NOT NULL AS INTEGER) AS found
FROM (SELECT DISTINCT o_custkey AS query FROM orders) AS a LEFT JOIN base AS b ON b.id = a.query"""))
def q_missing(t):
    wanted = t.read("orders").select(F.col("o_custkey").alias("query_id"))
    found, missing = io.resolve_queries(wanted, t.base)
    return found.select("query_id", F.lit(1).alias("found")).unionByName(
        missing.select("query_id", F.lit(0).alias("found")))


# --- sequences ---------------------------------------------------------------------------------

@query("residue_filter", sql.select([CLEANED], "SELECT id, seq FROM cleaned"))
def q_residues(t):
    return sequences.residue_filter(t.sequences)


@query("drop_empty", sql.select([CLEANED], "SELECT id, seq FROM cleaned WHERE seq <> ''"))
def q_drop_empty(t):
    return sequences.clean_sequences(t.sequences, require_rows=True)


UPPER = "translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')"
LONG = f"long AS (SELECT doc_id AS id, regexp_replace({UPPER}, '[^ACDEFGHIKLMNPQRSTVWY]', '', 'g') AS seq FROM documents)"


def _upper(t):
    """Documents with ASCII letters raised, so that most of each text survives the filter."""
    small = "abcdefghijklmnopqrstuvwxyz"
    return t.sequences.withColumn("seq", F.translate("seq", small, small.upper()))


@query("truncate", sql.select([LONG], "SELECT id, substring(seq, 1, 1022) AS seq FROM long"))
def q_truncate(t):
    return sequences.truncate(sequences.residue_filter(_upper(t)))


EMBEDDED = sql.select([LONG, "cut AS (SELECT id, substring(seq, 1, 1022) AS seq FROM long WHERE seq <> '')"],
                      """SELECT id, CAST(i - 1 AS INTEGER) AS dim,
  round(CAST(CAST((len(seq) - len(replace(seq, letter, ''))) / len(seq) AS FLOAT) AS DOUBLE), 6) AS value
FROM cut, (SELECT i, 'ACDEFGHIKLMNPQRSTVWY'[i] AS letter FROM range(1, 21) AS r(i)) AS letters""")


def _values(vectors):
    return rounded(vectors.select("id", F.posexplode(F.col("embedding").cast("array<double>")).alias("dim", "value")), "value")


@query("embed_job", EMBEDDED)
def q_embed(t):
    return _values(sequences.embed(sequences.clean_sequences(_upper(t))))


@query("embed_rounds", EMBEDDED)
def q_embed_rounds(t):
    """In rounds: the second call must find all of them finished."""
    path = scratch_path(t.spark, "embedding")
    cleaned = sequences.clean_sequences(_upper(t))
    sequences.embed_rounds(cleaned, path, rounds=4)
    before = sequences.embed_progress(t.spark, path)
    vectors = sequences.embed_rounds(cleaned, path, rounds=4)
    if sequences.embed_progress(t.spark, path) != before:
        raise RuntimeError("a finished round was run again")
    return _values(vectors)


def _pooled(df):
    return rounded(df.select("id", F.posexplode("embedding").alias("dim", "value")), "value")


@query("mean_pool_masked", sql.select([sql.TOKENS], f"""SELECT id, CAST(i - 1 AS INTEGER) AS dim,
  round(sum(CASE WHEN pos < n THEN x[i] ELSE 0 END) / greatest(count(CASE WHEN pos < n THEN 1 END), 1e-9), 6) AS value
FROM tokens, range(1, {sql.DIM + 1}) AS d(i) GROUP BY id, i"""))
def q_pool(t):
    return _pooled(sequences.mean_pool(t.tokens))


@query("mean_pool_trimmed", sql.select([
    sql.TOKENS, "sized AS (SELECT *, count(*) FILTER (WHERE pos < n) OVER (PARTITION BY id) AS kept FROM tokens)"],
    f"""SELECT id, CAST(i - 1 AS INTEGER) AS dim,
  round(sum(CASE WHEN pos BETWEEN 1 AND kept - 2 AND pos < n THEN x[i] ELSE 0 END)
    / greatest(count(CASE WHEN pos BETWEEN 1 AND kept - 2 AND pos < n THEN 1 END), 1e-9), 6) AS value
FROM sized, range(1, {sql.DIM + 1}) AS d(i) GROUP BY id, i"""))
def q_pool_trimmed(t):
    return _pooled(sequences.mean_pool(t.tokens, exclude_special=True))


# --- graph -------------------------------------------------------------------------------------

@query("graph_clean", sql.select([sql.HITS, sql.EDGES, sql.CLEAN], "SELECT src, dst FROM clean"))
def q_clean(t):
    return graph.clean_edges(t.edges)


@query("edge_weight", sql.select([sql.HITS, sql.EDGES, sql.CLEAN, sql.WEIGHTS], "SELECT a, b, directions FROM weights"))
def q_weights(t):
    return graph.edge_weights(graph.clean_edges(t.edges))


@query("graph_symmetrize", sql.select([sql.HITS, sql.EDGES, sql.CLEAN, sql.WEIGHTS, sql.SYM], "SELECT src, dst, CAST(weight AS INTEGER) AS weight FROM sym"))
def q_symmetrize(t):
    return graph.symmetrize(t.edges)


DIRECTED = "directed AS (SELECT src, dst, count(*) AS weight FROM edges WHERE src <> dst GROUP BY src, dst)"


@query("graph_check", sql.select([sql.HITS, sql.EDGES, DIRECTED], """SELECT d.src, d.dst, d.weight, r.weight AS reverse_weight,
  CASE WHEN r.src IS NULL THEN 'missing' ELSE 'weight' END AS reason
FROM directed AS d LEFT JOIN directed AS r ON r.src = d.dst AND r.dst = d.src WHERE r.src IS NULL OR r.weight <> d.weight"""))
def q_check(t):
    """Directed edges weighted by their number of occurrences: reverse edges are often off."""
    directed = t.edges.where("src <> dst").groupBy("src", "dst").agg(F.count("*").alias("weight"))
    return graph.graph_inconsistencies(directed)


@query("csr_offsets", sql.select([sql.HITS, sql.EDGES, sql.CLEAN, sql.WEIGHTS, sql.SYM], """SELECT node, CAST(upto - degree AS BIGINT) AS start_off,
  CAST(upto AS BIGINT) AS end_off, CAST(1 AS BIGINT) AS node_weight FROM (SELECT node, degree, sum(degree) OVER (ORDER BY node) AS upto
  FROM (SELECT e.vec_id AS node, count(s.src) AS degree FROM embeddings AS e LEFT JOIN sym AS s ON s.src = e.vec_id GROUP BY e.vec_id) AS d) AS c"""))
def q_csr(t):
    return graph.csr_offsets(graph.symmetrize(t.edges), t.n)


@query("csr_adjacency", sql.select([sql.HITS, sql.EDGES, sql.CLEAN, sql.WEIGHTS, sql.SYM], """SELECT row_number() OVER (ORDER BY src, dst) - 1 AS pos,
  src AS node, dst AS neighbor, CAST(weight AS INTEGER) AS weight FROM sym"""))
def q_adjacency(t):
    return graph.csr_adjacency(graph.symmetrize(t.edges), t.n)


@query("graph_sample", sql.select([sql.HITS, sql.EDGES, sql.CLEAN, sql.WEIGHTS, sql.SYM,
                                   "kept AS (SELECT DISTINCT src AS node FROM sym ORDER BY node LIMIT 200)"], """SELECT src, dst, CAST(weight AS INTEGER) AS weight
FROM sym WHERE src IN (SELECT node FROM kept) AND dst IN (SELECT node FROM kept)"""))
def q_sample(t):
    return graph.sample_subgraph(graph.symmetrize(t.edges), 200, sampling="lowest")


@query("graph_counts", sql.select([sql.HITS, sql.EDGES, sql.CLEAN, sql.WEIGHTS, sql.SYM], """SELECT (SELECT count(DISTINCT src) FROM sym) AS n_nodes,
  (SELECT count(*) FROM weights) AS n_edges"""))
def q_counts(t):
    return graph.graph_counts(graph.symmetrize(t.edges))
