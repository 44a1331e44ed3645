"""Queries: exact and approximate search, indexes, learned partitions."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.distance import l2, to_distance
from ..functions.hashing import hash_params, hash_params_frame
from ..operators import evaluate, hypercube, ivf, learned, lsh, pq, quality
from ..operators.common import rank_within, scratch_path, settle
from ..operators.exact import knn_exact, knn_self
from ..sources.index_store import Index, get_or_build, get_or_extend, load_index, save_index
from . import sql
from .registry import Tables, joined, query, rounded

N = 10
LSH = lsh.LshParams()
NARROW = lsh.LshParams(w=1.0)
CUBE = hypercube.CubeParams()
SPARSE_CUBE = hypercube.CubeParams(k=14, probes=1)
CAPPED_CUBE = hypercube.CubeParams(max_checked=20)
IVF = ivf.IvfParams(nlist=sql.NLIST, nprobe=sql.NPROBE)
PQ = pq.PqParams(nlist=sql.NLIST, nprobe=sql.NPROBE, m=sql.M)
RADIUS = 1.15


def start_centroids(t: Tables) -> DataFrame:
    """Fixed start of the checked k-means runs: the vectors with the lowest ids."""
    return t.base.where(F.col("id") < sql.NLIST).select(
        F.col("id").cast("int").alias("cell"), F.col("embedding").cast("array<double>").alias("centroid"))


def centroids(t: Tables) -> DataFrame:
    """Two k-means steps from the fixed start."""
    first = t.once("first_centroids", lambda _: ivf.lloyd_step(t.base, start_centroids(t)))
    return t.once("centroids", lambda _: ivf.lloyd_step(t.base, first))


def quantised(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """centroids, residuals, codebook (one step from the lowest ids), codes."""
    cells = centroids(t)
    res = pq.residuals(ivf.assign_nearest(t.base, cells), cells)
    first = pq.split_subvectors(res.where(F.col("id") < sql.CODES), sql.M, sql.SUB).select(
        "m", F.col("id").cast("int").alias("code"), F.col("sub").alias("centroid"))
    book = settle(pq.pq_lloyd_step(res, settle(first)))
    return cells, res, book, pq.pq_encode(res, book)


def partitions(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Labelled base, and the most probable partitions of every query."""
    cells = centroids(t)
    assigned = ivf.assign_nearest(t.base, cells)
    labelled = learned.partition_labels(t.base, cells)
    names = assigned.select("id", "cell").join(labelled.select("id", "part"), "id").select(
        "cell", "part").distinct()
    return labelled, learned.near_partitions(t.queries, cells.join(names, "cell"), sql.TOP_T)


# --- exact -------------------------------------------------------------------------------------

@query("knn_exact", sql.exact(N))
def q_knn_exact(t):
    return rounded(knn_exact(t.base, t.queries, N))


@query("knn_self_join", sql.select([sql.BASE], """SELECT src, dst, round(distance, 6) AS distance, CAST(rank AS BIGINT) AS rank
FROM (SELECT a.id AS src, b.id AS dst, list_distance(a.x, b.x) AS distance,
  row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.x, b.x), b.id) AS rank
  FROM base AS a JOIN base AS b ON a.id <> b.id) AS s WHERE rank <= 5"""))
def q_knn_self(t):
    return rounded(knn_self(t.base, 5))


@query("l2_distance", """SELECT vec_id AS id,
  round(list_distance(embedding::DOUBLE[], list_reverse(embedding)::DOUBLE[]), 6) AS distance FROM embeddings""")
def q_l2(t):
    return rounded(t.base.select("id", l2("embedding", F.reverse("embedding")).alias("distance")))


@query("coerce_distance", """SELECT event_id, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0.0) AS k,
  coalesce(TRY_CAST(event_type AS DOUBLE), 0.0) AS kind FROM events""")
def q_coerce(t):
    return t.read("events").select(
        "event_id", to_distance(F.get_json_object("props", "$.k")).alias("k"),
        to_distance("event_type").alias("kind"))


TOP = sql.select([sql.BASE, sql.QUERIES], f"SELECT query_id, neighbor_id, CAST(rank AS BIGINT) AS rank FROM ({sql.ranked(sql.ALL_PAIRS, N)}) AS s")


@query("rank_neighbors", TOP)
def q_rank(t):
    near = knn_exact(t.base, t.queries, N).drop("rank")
    return rank_within(near, ["query_id"], ["distance", "neighbor_id"]).select(
        "query_id", "neighbor_id", "rank")


@query("topn_per_query", sql.select([sql.HITS, sql.GOOD], """SELECT query, subject, bitscore, CAST(rank AS BIGINT) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY bitscore DESC, hit_seq) AS rank FROM hits) AS s
WHERE rank <= 5"""))
def q_topn(t):
    from ..operators.common import top_n
    return top_n(t.hits, 5, ("query",), (F.desc("bitscore"), "hit_seq")).select(
        "query", "subject", "bitscore", "rank")


@query("topn_display", f"SELECT query_id, neighbor_id, distance, rank FROM ({sql.exact(N)}) AS s WHERE rank <= 3")
def q_display(t):
    return rounded(knn_exact(t.base, t.queries, N).where(F.col("rank") <= 3))


# --- hashing with tables -----------------------------------------------------------------------

@query("hash_params", sql.select([sql.BASE, sql.projections(10, 5, 4.0)], """SELECT tbl, j, round(t, 6) AS t,
  round(avg(list_inner_product(v, x)), 6) AS mean_projection FROM base, hp GROUP BY tbl, j, t"""))
def q_hash_params(t):
    """Parameters with the mean projection of the whole table on each of them."""
    dim = sql.DIM
    mean = t.base.agg(vector_to_array(Summarizer.mean(array_to_vector(
        F.col("embedding").cast("array<double>")))).alias("mean")).select(F.posexplode("mean").alias("i", "x"))
    params = hash_params_frame(t.spark, hash_params(dim, LSH.k, LSH.tables, LSH.w, LSH.seed))
    return rounded(
        params.select("tbl", "j", "t", F.posexplode("v").alias("i", "v")).join(mean, "i")
        .groupBy("tbl", "j", "t").agg(F.sum(F.col("v") * F.col("x")).alias("mean_projection")),
        "t", "mean_projection")


@query("lsh_hash", sql.select(sql.lsh_ctes(4.0)[:4], "SELECT id, tbl, code FROM bc"))
def q_lsh_hash(t):
    return lsh.lsh_codes(t.base, LSH)


def _bucket_rows(df: DataFrame) -> DataFrame:
    return df.select("query_id", "tbl", lsh.code_text(F.col("key")).alias("code"), "members")


@query("bucket_index", sql.select(sql.lsh_ctes(4.0), "SELECT tbl, code, members, first_id FROM buckets"))
def q_bucket_index(t):
    return lsh.lsh_buckets(lsh.lsh_index(t.base, LSH)).select(
        "tbl", lsh.code_text(F.col("key")).alias("code"), "members", F.col("first_ord").alias("first_id"))


@query("lsh_bucket_join", sql.select(sql.lsh_ctes(4.0, radius=0), "SELECT query_id, tbl, code, members FROM probed"))
def q_bucket_join(t):
    return _bucket_rows(lsh.lsh_probes(lsh.lsh_index(t.base, LSH), t.queries, LSH, radius=0))


@query("lsh_multiprobe", sql.select(sql.lsh_ctes(4.0, radius=2), "SELECT query_id, tbl, code, members FROM probed"))
def q_multiprobe(t):
    return _bucket_rows(lsh.lsh_probes(lsh.lsh_index(t.base, LSH), t.queries, LSH, radius=2))


@query("lsh_fallback", sql.select(sql.lsh_ctes(1.0) + sql.fallback_ctes(N, 5), """SELECT query_id, 0 AS tbl, code, members FROM add0
UNION ALL SELECT query_id, 1, code, members FROM add1"""))
def q_fallback(t):
    index = lsh.lsh_index(t.base, NARROW)
    buckets = lsh.lsh_buckets(index)
    probes = settle(lsh.lsh_probes(index, t.queries, NARROW, buckets=buckets))
    return _bucket_rows(lsh.lsh_fallback(index, t.queries, probes, buckets, N, NARROW))


@query("candidate_union", sql.select(sql.lsh_ctes(1.0) + sql.fallback_ctes(N, 5), """SELECT query_id, tbl, code, members FROM probed
UNION SELECT query_id, 0, code, members FROM add0 UNION SELECT query_id, 1, code, members FROM add1"""))
def q_union(t):
    return _bucket_rows(lsh.lsh_candidates(lsh.lsh_index(t.base, NARROW), t.queries, N, NARROW))


@query("search_lsh", sql.lsh(N))
def q_search_lsh(t):
    return rounded(lsh.search_lsh(t.base, t.queries, N, LSH))


@query("search_lsh_fallback", sql.lsh(N, w=1.0))
def q_search_lsh_narrow(t):
    return rounded(lsh.search_lsh(t.base, t.queries, N, NARROW))


# --- hypercube ---------------------------------------------------------------------------------

@query("cube_hash", sql.select(sql.cube_ctes()[:4], "SELECT id, vertex FROM bv"))
def q_cube_hash(t):
    return hypercube.cube_vertices(t.base, CUBE).select("id", "vertex")


@query("cube_probe_join", sql.select(sql.cube_ctes(probes=56), """SELECT query_id, probe_rank, vertex, count(*) AS members
FROM cand GROUP BY query_id, probe_rank, vertex"""))
def q_cube_probe(t):
    wide = hypercube.CubeParams(probes=56)
    sizes = ivf.cell_sizes(hypercube.cube_vertices(t.base, wide), "vertex")
    return hypercube.cube_probes(t.queries, wide).join(sizes, "vertex").select(
        "query_id", "probe_rank", "vertex", "members")


@query("cube_candidate_cap", sql.select(sql.cube_ctes(cap=20), """SELECT query_id, probe_rank, vertex, count(*) AS take
FROM cand GROUP BY query_id, probe_rank, vertex"""))
def q_cube_cap(t):
    members = hypercube.cube_members(t.base, CAPPED_CUBE)
    return hypercube.cube_candidates(members, t.queries, CAPPED_CUBE).drop("members")


@query("search_hypercube_capped", sql.cube(N, cap=20))
def q_search_cube_capped(t):
    return rounded(hypercube.search_hypercube(t.base, t.queries, N, CAPPED_CUBE))


@query("cube_fallback", sql.cube(N, k=14, probes=1))
def q_cube_fallback(t):
    return rounded(hypercube.search_hypercube(t.base, t.queries, N, SPARSE_CUBE))


@query("search_hypercube", sql.cube(N))
def q_search_cube(t):
    return rounded(hypercube.search_hypercube(t.base, t.queries, N, CUBE))


# --- inverted file -----------------------------------------------------------------------------

@query("assign_nearest", sql.select(sql.IVF, "SELECT id, cell FROM cells"))
def q_assign(t):
    return ivf.assign_nearest(t.base, centroids(t)).select("id", "cell")


@query("lloyd_step", sql.select(sql.IVF, f"""SELECT cell, CAST(i - 1 AS INTEGER) AS dim, round(c[i], 6) AS value
FROM c2, range(1, {sql.DIM + 1}) AS d(i)"""))
def q_lloyd(t):
    return rounded(centroids(t).select("cell", F.posexplode("centroid").alias("dim", "value")), "value")


@query("kmeans_train")
def q_kmeans(t):
    return ivf.kmeans(t.base, sql.NLIST, seed=42, restarts=10).select("cell", joined("centroid"))


@query("kmeans_given_start", sql.select(sql.IVF, f"""SELECT cell, CAST(i - 1 AS INTEGER) AS dim, round(c[i], 6) AS value
FROM c2, range(1, {sql.DIM + 1}) AS d(i)"""))
def q_kmeans_given(t):
    """Training from a given start, two steps of it."""
    trained = ivf.kmeans(t.base, sql.NLIST, max_iter=2, init=start_centroids(t))
    return rounded(trained.select("cell", F.posexplode("centroid").alias("dim", "value")), "value")


@query("kmeans_means", f"SELECT {sql.NLIST}::BIGINT AS cells, 0::BIGINT AS off_mean")
def q_kmeans_means(t):
    """Every trained centroid is the mean of its members (to a thousandth)."""
    trained = settle(ivf.kmeans(t.base, sql.NLIST, seed=42, restarts=1))
    after = ivf.lloyd_step(t.base, trained).select("cell", F.col("centroid").alias("mean"))
    far = F.exists(F.zip_with("centroid", "mean", lambda a, b: F.abs(a - b)), lambda d: d > 1e-3)
    return trained.join(after, "cell").agg(F.count("*").alias("cells"), F.count(F.when(far, 1)).alias("off_mean"))


@query("coarse_probe", sql.select([*sql.IVF, sql.PROBES], "SELECT query_id, cell FROM probes"))
def q_coarse(t):
    return ivf.probe_cells(t.queries, centroids(t), sql.NPROBE)


@query("cell_join", sql.select([*sql.IVF, sql.PROBES], """SELECT query_id, cell, count(*) AS members
FROM probes JOIN cells USING (cell) GROUP BY query_id, cell"""))
def q_cell_join(t):
    cells = centroids(t)
    return ivf.cell_candidates(ivf.probe_cells(t.queries, cells, sql.NPROBE),
                               ivf.assign_nearest(t.base, cells))


@query("search_ivfflat", sql.ivf(N))
def q_search_ivf(t):
    return rounded(ivf.search_ivfflat(t.base, t.queries, N, IVF, centroids(t)))


@query("range_search", sql.select([*sql.IVF, sql.PROBES], f"""SELECT query_id, neighbor_id, round(distance, 6) AS distance
FROM ({sql.IVF_PAIRS}) AS p WHERE distance <= {RADIUS}"""))
def q_range(t):
    cells = centroids(t)
    return rounded(ivf.range_search(ivf.assign_nearest(t.base, cells), cells, t.queries, RADIUS, sql.NPROBE))


@query("cluster_stats", sql.select(sql.IVF, """SELECT count(*) AS n_clusters, CAST(sum(n) AS BIGINT) AS total_points,
  min(n) AS min_size, max(n) AS max_size, round(avg(n), 6) AS avg_size, round(stddev_pop(n), 6) AS std_size,
  count(*) FILTER (WHERE n = 0) AS empty_clusters
FROM (SELECT c2.cell, count(cells.id) AS n FROM c2 LEFT JOIN cells ON cells.cell = c2.cell GROUP BY c2.cell) AS s"""))
def q_cluster_stats(t):
    cells = centroids(t)
    return rounded(quality.cluster_stats(ivf.assign_nearest(t.base, cells), cells), "avg_size", "std_size")


SILHOUETTE = """points AS (SELECT id, x, cell FROM cells ORDER BY id LIMIT 100),
others AS (SELECT * FROM (SELECT id, x, cell, row_number() OVER (PARTITION BY cell ORDER BY id) AS r FROM cells) AS s WHERE r <= 10),
own AS (SELECT p.id, avg(list_distance(p.x, c.x)) AS a FROM points AS p JOIN cells AS c ON c.cell = p.cell AND c.id <> p.id GROUP BY p.id),
far AS (SELECT id, min(d) AS b FROM (SELECT p.id, o.cell, avg(list_distance(p.x, o.x)) AS d FROM points AS p JOIN others AS o ON o.cell <> p.cell
  GROUP BY p.id, o.cell) AS s GROUP BY id)"""


@query("silhouette_sampled", sql.select([*sql.IVF, SILHOUETTE], """SELECT round(avg((b - a) / greatest(a, b)), 6) AS score,
  count(*) AS valid_points FROM own JOIN far USING (id) WHERE greatest(a, b) > 0"""))
def q_silhouette(t):
    return rounded(quality.silhouette(ivf.assign_nearest(t.base, centroids(t)), sampling="lowest"), "score")


# --- product quantisation ----------------------------------------------------------------------

@query("residual", sql.select([*sql.IVF, sql.RESIDUAL], f"""SELECT id, cell, CAST(i - 1 AS INTEGER) AS dim, round(r[i], 6) AS value
FROM res, range(1, {sql.DIM + 1}) AS d(i)"""))
def q_residual(t):
    cells = centroids(t)
    res = pq.residuals(ivf.assign_nearest(t.base, cells), cells)
    return rounded(res.select("id", "cell", F.posexplode("residual").alias("dim", "value")), "value")


@query("subvector_split", sql.select([*sql.IVF, sql.RESIDUAL, sql.SUBS], f"""SELECT id, cell, CAST(m AS INTEGER) AS m,
  CAST(i - 1 AS INTEGER) AS dim, round(s[i], 6) AS value FROM subs, range(1, {sql.SUB + 1}) AS d(i)"""))
def q_split(t):
    cells = centroids(t)
    res = pq.residuals(ivf.assign_nearest(t.base, cells), cells)
    pieces = pq.split_subvectors(res, sql.M, sql.SUB)
    return rounded(pieces.select("id", "cell", "m", F.posexplode("sub").alias("dim", "value")), "value")


@query("pq_train_step", sql.select(sql.PQ, f"""SELECT CAST(m AS INTEGER) AS m, code, CAST(i - 1 AS INTEGER) AS dim, round(v[i], 6) AS value
FROM book, range(1, {sql.SUB + 1}) AS d(i)"""))
def q_pq_step(t):
    _, _, book, _ = quantised(t)
    return rounded(book.select("m", "code", F.posexplode("centroid").alias("dim", "value")), "value")


@query("pq_train")
def q_pq_train(t):
    cells = centroids(t)
    res = pq.residuals(ivf.assign_nearest(t.base, cells), cells)
    return pq.pq_train(res).select("m", "code", joined("centroid"))


@query("pq_given_start", sql.select(sql.PQ, f"""SELECT CAST(m AS INTEGER) AS m, code, CAST(i - 1 AS INTEGER) AS dim, round(v[i], 6) AS value
FROM book, range(1, {sql.SUB + 1}) AS d(i)"""))
def q_pq_given(t):
    """Codebook training from a given start, one step of it."""
    cells = centroids(t)
    res = pq.residuals(ivf.assign_nearest(t.base, cells), cells)
    start = pq.split_subvectors(res.where(F.col("id") < sql.CODES), sql.M, sql.SUB).select(
        "m", F.col("id").cast("int").alias("code"), F.col("sub").alias("centroid"))
    book = pq.pq_train(res, sql.M, max_iter=1, init=settle(start))
    return rounded(book.select("m", "code", F.posexplode("centroid").alias("dim", "value")), "value")


@query("pq_means", f"SELECT CAST(m AS INTEGER) AS m, {sql.CODES}::BIGINT AS codes, 0::BIGINT AS off_mean FROM range({sql.M}) AS r(m)")
def q_pq_means(t):
    """Every trained code is the mean of the sub-vectors that it is nearest to (to a thousandth), and none is empty."""
    cells = centroids(t)
    res = settle(pq.residuals(ivf.assign_nearest(t.base, cells), cells).select("id", "cell", "residual"))
    book = settle(pq.pq_train(res, sql.M))
    after = pq.pq_lloyd_step(res, book).select("m", "code", F.col("centroid").alias("mean"))
    used = pq.pq_encode(res, book).select(F.posexplode("codes").alias("m", "code")).distinct()
    far = F.exists(F.zip_with("centroid", "mean", lambda a, b: F.abs(a - b)), lambda d: d > 1e-3)
    return book.join(after, ["m", "code"]).join(used.select("m", F.col("code").cast("int").alias("code")), ["m", "code"]).groupBy("m").agg(
        F.count("*").alias("codes"), F.count(F.when(far, 1)).alias("off_mean"))


@query("pq_encode", sql.select(sql.PQ, "SELECT id, cell, string_agg(CAST(code AS VARCHAR), ',' ORDER BY m) AS codes FROM enc GROUP BY id, cell"))
def q_pq_encode(t):
    *_, codes = quantised(t)
    return codes.select("id", "cell", joined("codes"))


@query("adc_lookup", sql.pq(N))
def q_adc(t):
    cells, _, book, codes = quantised(t)
    return rounded(pq.adc_distances(codes, ivf.probe_cells(t.queries, cells, sql.NPROBE), t.queries,
                                    cells, book, N))


@query("search_ivfpq", sql.pq(N))
def q_search_pq(t):
    cells, _, book, _ = quantised(t)
    return rounded(pq.search_ivfpq(t.base, t.queries, N, PQ, cells, book))


@query("pq_stats", sql.select(sql.PQ, f"""SELECT CAST(m AS INTEGER) AS m, (SELECT count(DISTINCT id) FROM enc) AS n_vectors,
  (SELECT count(DISTINCT cell) FROM enc) AS n_cells, CAST({sql.M} AS BIGINT) AS n_subspaces, CAST({sql.SUB} AS BIGINT) AS sub_dim,
  count(DISTINCT code) AS codes_used FROM enc GROUP BY m"""))
def q_pq_stats(t):
    _, _, book, codes = quantised(t)
    return pq.pq_stats(codes, book, sql.M, sql.SUB)


# --- learned partitions ------------------------------------------------------------------------

@query("partition_labels", sql.select(sql.LEARNED, "SELECT id, CAST(part AS INTEGER) AS part FROM labelled"))
def q_labels(t):
    return learned.partition_labels(t.base, centroids(t)).select("id", "part")


@query("partition_scores", sql.select(sql.LEARNED, """SELECT query_id, CAST(part AS INTEGER) AS part, round(prob, 6) AS prob,
  CAST(rank AS BIGINT) AS rank FROM tops"""))
def q_scores(t):
    _, tops = partitions(t)
    return rounded(tops, "prob")


@query("learned_partition_join", sql.select(sql.LEARNED, """SELECT query_id, CAST(part AS INTEGER) AS part, count(*) AS members
FROM tops JOIN labelled USING (part) GROUP BY query_id, part"""))
def q_learned_join(t):
    labelled, tops = partitions(t)
    return ivf.cell_candidates(tops, labelled, "part")


@query("search_learned", sql.learned(N))
def q_search_learned(t):
    labelled, tops = partitions(t)
    return rounded(learned.search_learned(
        t.base, t.queries, N, learned.LearnedParams(probes=sql.TOP_T), tops=tops, labelled=labelled))


@query("train_partition_model")
def q_train(t):
    model, _ = learned.train_partition_model(learned.partition_labels(t.base, centroids(t)), epochs=10)
    return learned.training_curve(model, t.spark)


@query("fit_quality")
def q_fit_quality(t):
    return learned.train_partition_model(learned.partition_labels(t.base, centroids(t)), epochs=10)[1]


@query("predict_partitions")
def q_predict(t):
    model, _ = learned.train_partition_model(learned.partition_labels(t.base, centroids(t)), epochs=10)
    return learned.probable_partitions(model, t.queries, sql.TOP_T)


@query("predicted_partition_rows", f"""SELECT vec_id AS query_id, {sql.TOP_T}::BIGINT AS parts, true AS ordered FROM embeddings""")
def q_predicted_rows(t):
    """Every query gets its most probable partitions, probabilities falling."""
    model, _ = learned.train_partition_model(learned.partition_labels(t.base, centroids(t)), epochs=10)
    tops = learned.probable_partitions(model, t.queries, sql.TOP_T)
    probs = F.transform(F.sort_array(F.collect_list(F.struct("rank", "prob"))), lambda x: x["prob"])
    return tops.groupBy("query_id").agg(F.count("*").alias("parts"), (probs == F.reverse(F.array_sort(probs))).alias("ordered"))


@query("learned_neighbors_inside", "SELECT 0::BIGINT AS outside, 0::BIGINT AS wrong")
def q_learned_inside(t):
    """All neighbours lie in predicted partitions, and their distances are exact."""
    labelled = settle(learned.partition_labels(t.base, centroids(t)))
    model, _ = learned.train_partition_model(labelled, epochs=10)
    found = learned.search_learned(t.base, t.queries, N, learned.LearnedParams(probes=sql.TOP_T), labelled=labelled, model=model)
    tops = learned.probable_partitions(model, t.queries, sql.TOP_T).select("query_id", "part", F.lit(1).alias("predicted"))
    placed = found.join(labelled.select(F.col("id").alias("neighbor_id"), "embedding", "part"), "neighbor_id").join(t.queries, "query_id")
    seen = placed.join(tops, ["query_id", "part"], "left")
    off = F.abs(l2(F.col("query_vec"), F.col("embedding")) - F.col("distance")) > 1e-6
    return seen.agg(F.count(F.when(F.col("predicted").isNull(), 1)).alias("outside"), F.count(F.when(off, 1)).alias("wrong"))


@query("search_learned_trained")
def q_search_trained(t):
    labelled = learned.partition_labels(t.base, centroids(t))
    model, _ = learned.train_partition_model(labelled, epochs=10)
    return learned.search_learned(t.base, t.queries, N, labelled=labelled, model=model)


# --- the same searches in blocks, the form that large query sets take ----------------------------

@query("knn_exact_blocks", sql.exact(N))
def q_exact_blocks(t):
    return rounded(knn_exact(t.base, t.queries, N, strategy="blocks"))


@query("search_lsh_blocks", sql.lsh(N))
def q_lsh_blocks(t):
    return rounded(lsh.search_lsh(t.base, t.queries, N, LSH, strategy="blocks"))


@query("search_hypercube_blocks", sql.cube(N))
def q_cube_blocks(t):
    return rounded(hypercube.search_hypercube(t.base, t.queries, N, CUBE, strategy="blocks"))


@query("search_ivfflat_blocks", sql.ivf(N))
def q_ivf_blocks(t):
    return rounded(ivf.search_ivfflat(t.base, t.queries, N, IVF, centroids(t), strategy="blocks"))


@query("search_ivfpq_blocks", sql.pq(N))
def q_pq_blocks(t):
    cells, _, book, _ = quantised(t)
    return rounded(pq.search_ivfpq(t.base, t.queries, N, PQ, cells, book, strategy="blocks"))


@query("search_learned_blocks", sql.learned(N))
def q_learned_blocks(t):
    labelled, tops = partitions(t)
    p = learned.LearnedParams(probes=sql.TOP_T)
    return rounded(learned.search_learned(t.base, t.queries, N, p, tops=tops, labelled=labelled, strategy="blocks"))


# --- several methods, stored indexes -----------------------------------------------------------

def method_table(t: Tables) -> dict[str, evaluate.SearchFn]:
    """The five methods with their checked parameters, keyed as on the command line."""
    cells, _, book, codes = quantised(t)
    labelled, tops = partitions(t)
    return {
        "lsh": lambda b, q, n: lsh.search_lsh(b, q, n, LSH),
        "hypercube": lambda b, q, n: hypercube.search_hypercube(b, q, n, CUBE),
        "ivfflat": lambda b, q, n: ivf.search_ivfflat(b, q, n, IVF, cells),
        "ivfpq": lambda b, q, n: pq.search_ivfpq(b, q, n, PQ, cells, book, codes),
        "neural": lambda b, q, n: learned.search_learned(
            b, q, n, learned.LearnedParams(probes=sql.TOP_T), tops=tops, labelled=labelled),
    }


ALL_METHODS = sql.methods({"Euclidean LSH": sql.lsh(N), "Hypercube": sql.cube(N), "IVF-Flat": sql.ivf(N),
                           "IVF-PQ": sql.pq(N), "Neural LSH": sql.learned(N)})


@query("search_all", ALL_METHODS)
def q_search_all(t):
    return rounded(evaluate.search_all(t.base, t.queries, evaluate.select_methods("all", method_table(t)), N)[0])


@query("method_select", f"SELECT method, count(*) AS found FROM ({sql.methods({'IVF-Flat': sql.ivf(N)})}) AS s GROUP BY method")
def q_method_select(t):
    chosen = evaluate.select_methods("ivfflat", method_table(t))
    found, _ = evaluate.search_all(t.base, t.queries, chosen, N, eager=False)
    return found.groupBy("method").agg(F.count("*").alias("found"))


@query("method_errors", sql.methods({"IVF-Flat": sql.ivf(N)}) + " UNION ALL SELECT 'Broken', NULL, NULL, NULL, NULL")
def q_method_errors(t):
    """One of two methods fails; its error is listed, the other result is whole."""
    def broken(base, queries, n):
        raise RuntimeError("no index")

    methods = {"Broken": broken, **evaluate.select_methods("ivfflat", method_table(t))}
    found, errors = evaluate.search_all(t.base, t.queries, methods, N, eager=False)
    return rounded(found).unionByName(errors.select("method"), allowMissingColumns=True)


@query("index_append", sql.ivf(N))
def q_index_append(t):
    """An index stored for part of the vectors, then asked for all of them: only the others are assigned."""
    cells, path = centroids(t), scratch_path(t.spark, "index")
    placed = lambda rows: ivf.assign_nearest(rows, cells).select("id", "embedding", "cell")
    part = t.base.where("id % 3 <> 0")
    get_or_extend(t.spark, path, {"nlist": sql.NLIST}, part, lambda: {"assigned": placed(part)}, lambda rows, _: placed(rows))
    index, state = get_or_extend(t.spark, path, {"nlist": sql.NLIST}, t.base, lambda: {"assigned": placed(t.base)}, lambda rows, _: placed(rows))
    assert state == "appended"
    return rounded(ivf.search_ivfflat(t.base, t.queries, N, IVF, cells, assigned=index.tables["assigned"]))


@query("index_save_load", sql.ivf(N))
def q_index_roundtrip(t):
    cells = centroids(t)
    path = scratch_path(t.spark, "index")
    save_index(Index({"centroids": cells, "assigned": ivf.assign_nearest(t.base, cells).select(
        "id", "embedding", "cell")}, {"nlist": sql.NLIST, "nprobe": sql.NPROBE}), path)
    stored = load_index(t.spark, path)
    return rounded(ivf.search_ivfflat(
        t.base, t.queries, N, ivf.IvfParams(nprobe=stored.params["nprobe"]),
        stored.tables["centroids"], stored.tables["assigned"]))


@query("index_reuse_or_rebuild", """SELECT step, reused, (SELECT count(*) FROM embeddings) AS rows FROM (VALUES ('first', false), ('same', true),
  ('other parameters', false), ('other data', false), ('forced', false)) AS v(step, reused)""")
def q_index_reuse(t):
    """Build, reuse, changed parameters, changed data, forced rebuild."""
    path = scratch_path(t.spark, "index")
    cells = centroids(t)
    scaled = t.base.withColumn("embedding", F.transform("embedding", lambda x: x * F.lit(2).cast("float")))

    def ask(base, params, rebuild=False):
        build = lambda: {"centroids": cells, "assigned": ivf.assign_nearest(base, cells)}
        index, reused = get_or_build(t.spark, path, params, base, build, rebuild)
        return reused, index.tables["assigned"].count()

    steps = [("first", t.base, {"nlist": 20}, False), ("same", t.base, {"nlist": 20}, False),
             ("other parameters", t.base, {"nlist": 21}, False), ("other data", scaled, {"nlist": 21}, False),
             ("forced", scaled, {"nlist": 21}, True)]
    rows = [(name, *ask(base, params, force)) for name, base, params, force in steps]
    return t.spark.createDataFrame(rows, "step string, reused boolean, rows bigint")
