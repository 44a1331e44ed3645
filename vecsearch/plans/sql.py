"""SQL building blocks: the same results written as plain SQL over the stored tables.

Every block is one or more named sub-queries; ``select`` chains them. The SQL states the rules
step by step and on (query, row) pairs, independently of how the Spark jobs are organised.
"""

from __future__ import annotations

from ..functions.hashing import hash_params
from ..operators.hypercube import probe_masks

DIM = 64
BASE = "base AS (SELECT vec_id AS id, embedding::DOUBLE[] AS x FROM embeddings)"
QUERIES = "qs AS (SELECT vec_id AS query_id, list_reverse(embedding)::DOUBLE[] AS q FROM embeddings)"
HITS = """hits AS (SELECT o_custkey % n AS query, o_orderkey % n AS subject,
  CAST((o_orderkey * 7) % 1001 AS DOUBLE) / 10 AS pident, CAST(o_custkey % 21 AS DOUBLE) / 1000 AS evalue,
  floor(o_totalprice / 1000) AS bitscore, o_orderkey AS hit_seq, 100 + o_orderkey % 50 AS length,
  o_orderkey % 7 AS mismatch, o_orderkey % 3 AS gapopen
  FROM orders, (SELECT count(*) AS n FROM embeddings) AS size)"""
GOOD = "good AS (SELECT * FROM hits WHERE evalue < 0.01)"
IDENTITY = """ident AS (SELECT query, subject, arg_max(pident, hit_seq) AS pident FROM good GROUP BY query, subject)"""
ANNOT = """annot AS (SELECT vec_id AS id,
  CASE WHEN label = 0 THEN []::VARCHAR[] ELSE list_distinct(['PF' || vec_id % 7, 'PF' || vec_id % 5, 'PF' || label]) END AS domains,
  CASE WHEN label = 0 THEN []::VARCHAR[] ELSE ['EC' || vec_id % 11] END AS ec FROM embeddings)"""
TOKENS = """tokens AS (SELECT vec_id // 8 AS id, vec_id % 8 AS pos, 3 + (vec_id // 8) % 6 AS n,
  embedding::DOUBLE[] AS x FROM embeddings)"""
EDGES = "edges AS (SELECT query AS src, subject AS dst FROM hits)"
CLEAN = "clean AS (SELECT DISTINCT src, dst FROM edges WHERE src <> dst)"
WEIGHTS = """weights AS (SELECT least(src, dst) AS a, greatest(src, dst) AS b, count(*) AS directions
  FROM clean GROUP BY 1, 2)"""
SYM = """sym AS (SELECT a AS src, b AS dst, CASE WHEN directions = 2 THEN 2 ELSE 1 END AS weight FROM weights
  UNION ALL SELECT b, a, CASE WHEN directions = 2 THEN 2 ELSE 1 END FROM weights)"""


def select(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def truth(n: int) -> str:
    return f"""truth AS (SELECT DISTINCT query, subject FROM (SELECT query, subject,
  row_number() OVER (PARTITION BY query ORDER BY bitscore DESC, hit_seq) AS r FROM good) AS t WHERE r <= {n})"""


def ranked(pairs: str, n: int, digits: int = 6) -> str:
    """Top ``n`` of (query_id, neighbor_id, distance) rows."""
    shown = f"round(distance, {digits})" if digits else "distance"
    return f"""SELECT query_id, neighbor_id, {shown} AS distance, CAST(rank AS BIGINT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank
  FROM ({pairs}) AS p) AS r WHERE rank <= {n}"""


ALL_PAIRS = """SELECT query_id, id AS neighbor_id, list_distance(q, x) AS distance FROM qs, base"""


def exact(n: int, digits: int = 6) -> str:
    return select([BASE, QUERIES], ranked(ALL_PAIRS, n, digits))


def values(rows) -> str:
    return ", ".join("(" + ", ".join(r) + ")" for r in rows)


def projections(k: int, tables: int, w: float) -> str:
    """The seeded hash parameters as a literal table hp(tbl, j, v, t)."""
    rows = [(str(t), str(j), "[" + ",".join(f"{x!r}" for x in p.v[j].tolist()) + "]::DOUBLE[]",
             f"{float(p.t[j])!r}::DOUBLE")
            for t, p in enumerate(hash_params(DIM, k, tables, w)) for j in range(k)]
    return f"hp AS (SELECT * FROM (VALUES {values(rows)}) AS x(tbl, j, v, t))"


def lsh_ctes(w: float, k: int = 10, tables: int = 5, radius: int = 1) -> list[str]:
    steps = [("-1", "0")] + [(str(i), str(d * s)) for i in range(k)
                             for d in range(1, radius + 1) for s in (1, -1)]
    return [
        BASE, QUERIES, projections(k, tables, w),
        f"""bc AS (SELECT id, tbl, string_agg(CAST(CAST(floor((list_inner_product(v, x) + t) / {w}) AS BIGINT) AS VARCHAR), ',' ORDER BY j) AS code
  FROM base, hp GROUP BY id, tbl)""",
        f"qh AS (SELECT query_id, tbl, j, CAST(floor((list_inner_product(v, q) + t) / {w}) AS BIGINT) AS h FROM qs, hp)",
        f"moves AS (SELECT * FROM (VALUES {values(steps)}) AS m(i, d))",
        """pc AS (SELECT query_id, tbl, i, d, string_agg(CAST(h + CASE WHEN j = i THEN d ELSE 0 END AS VARCHAR), ',' ORDER BY j) AS code
  FROM qh, moves GROUP BY query_id, tbl, i, d)""",
        "buckets AS (SELECT tbl, code, count(*) AS members, min(id) AS first_id FROM bc GROUP BY tbl, code)",
        "probed AS (SELECT query_id, tbl, code, members FROM pc JOIN buckets USING (tbl, code))",
        "c0 AS (SELECT DISTINCT query_id, id FROM probed JOIN bc USING (tbl, code))",
    ]


def fallback_ctes(n: int, tables: int) -> list[str]:
    """The stepwise walk over the first tables // 2 tables for queries with too few candidates."""
    out = [f"""thin AS (SELECT query_id FROM qs LEFT JOIN c0 USING (query_id) GROUP BY query_id
  HAVING count(c0.id) < {2 * n})""",
           "w0 AS (SELECT c0.* FROM c0 JOIN thin USING (query_id))"]
    for t in range(tables // 2):
        out += [
            f"have{t} AS (SELECT query_id, count(w.id) AS have FROM thin LEFT JOIN w{t} AS w USING (query_id) GROUP BY query_id)",
            f"""step{t} AS (SELECT h.query_id, b.code, b.members, b.first_id, h.have,
  b.members - (SELECT count(*) FROM w{t} AS w JOIN bc ON bc.id = w.id WHERE w.query_id = h.query_id AND bc.tbl = {t} AND bc.code = b.code) AS fresh
  FROM have{t} AS h, buckets AS b WHERE b.tbl = {t})""",
            f"""add{t} AS (SELECT query_id, code, members FROM (SELECT *, row_number() OVER o AS place,
  have + coalesce(sum(fresh) OVER (PARTITION BY query_id ORDER BY first_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM step{t} WINDOW o AS (PARTITION BY query_id ORDER BY first_id)) AS s WHERE before < {10 * n} OR place = 1)""",
            f"""w{t + 1} AS (SELECT query_id, id FROM w{t} UNION SELECT query_id, bc.id FROM add{t} JOIN bc ON bc.tbl = {t} AND bc.code = add{t}.code)""",
        ]
    return out


def lsh(n: int, w: float = 4.0, tables: int = 5, digits: int = 6) -> str:
    last = f"w{tables // 2}"
    pairs = f"""SELECT c.query_id, c.id AS neighbor_id, list_distance(q, x) AS distance
  FROM (SELECT query_id, id FROM c0 UNION SELECT query_id, id FROM {last}) AS c
  JOIN qs USING (query_id) JOIN base ON base.id = c.id"""
    return select(lsh_ctes(w, tables=tables) + fallback_ctes(n, tables), ranked(pairs, n, digits))


def cube_ctes(k: int = 10, probes: int = 5, w: float = 4.0, cap: int | None = None) -> list[str]:
    def bit(vector: str) -> str:
        parity = f"CAST(floor((list_inner_product(v, {vector}) + t) / {w}) AS BIGINT) % 2"
        return f"CAST(sum((({parity} + 2) % 2) * (1 << ({k - 1} - j))) AS BIGINT)"

    masks = [(str(r), f"{m}::BIGINT") for r, m in enumerate(probe_masks(k, probes))]
    return [
        BASE, QUERIES, projections(k, 1, w),
        f"bv AS (SELECT id, {bit('x')} AS vertex FROM base, hp GROUP BY id)",
        f"qv AS (SELECT query_id, {bit('q')} AS vertex FROM qs, hp GROUP BY query_id)",
        f"masks AS (SELECT * FROM (VALUES {values(masks)}) AS m(probe_rank, mask))",
        "probed AS (SELECT query_id, probe_rank, xor(vertex, mask) AS vertex FROM qv, masks)",
        f"""cand AS (SELECT * FROM (SELECT query_id, probe_rank, vertex, id,
  row_number() OVER (PARTITION BY query_id ORDER BY probe_rank, id) AS place
  FROM probed JOIN bv USING (vertex)) AS c {f'WHERE place <= {cap}' if cap is not None else ''})""",
    ]


def cube(n: int, k: int = 10, probes: int = 5, cap: int = 1000, digits: int = 6) -> str:
    pairs = """SELECT query_id, c.id AS neighbor_id, list_distance(q, x) AS distance FROM (
    SELECT query_id, id FROM cand UNION ALL
    SELECT query_id, id FROM qs, base WHERE query_id NOT IN (SELECT query_id FROM cand)) AS c
  JOIN qs USING (query_id) JOIN base ON base.id = c.id"""
    return select(cube_ctes(k, probes, cap=cap), ranked(pairs, n, digits))


NLIST, NPROBE = 20, 4


def lloyd(step: int) -> list[str]:
    """Assignment to centroids c{step} and the recomputed centroids c{step + 1}."""
    return [
        f"""near{step} AS (SELECT id, x, cell FROM (SELECT id, x, cell,
  row_number() OVER (PARTITION BY id ORDER BY list_distance(x, c), cell) AS r FROM base, c{step}) AS s WHERE r = 1)""",
        f"""mean{step} AS (SELECT cell, list(m ORDER BY i) AS m FROM (SELECT cell, i, avg(x[i]) AS m
  FROM near{step}, range(1, {DIM + 1}) AS d(i) GROUP BY cell, i) AS s GROUP BY cell)""",
        f"c{step + 1} AS (SELECT cell, coalesce(m, c) AS c FROM c{step} LEFT JOIN mean{step} USING (cell))",
    ]


IVF = ([BASE, QUERIES, f"c0 AS (SELECT CAST(id AS INTEGER) AS cell, x AS c FROM base WHERE id < {NLIST})"]
       + lloyd(0) + lloyd(1)
       + ["""cells AS (SELECT id, x, cell FROM (SELECT id, x, cell,
  row_number() OVER (PARTITION BY id ORDER BY list_distance(x, c), cell) AS r FROM base, c2) AS s WHERE r = 1)"""])
PROBES = f"""probes AS (SELECT query_id, q, cell, c FROM (SELECT query_id, q, cell, c,
  row_number() OVER (PARTITION BY query_id ORDER BY list_distance(q, c), cell) AS r FROM qs, c2) AS s WHERE r <= {NPROBE})"""
IVF_PAIRS = "SELECT query_id, id AS neighbor_id, list_distance(q, x) AS distance FROM probes JOIN cells USING (cell)"


def ivf(n: int, digits: int = 6) -> str:
    return select([*IVF, PROBES], ranked(IVF_PAIRS, n, digits))


M, CODES = 8, 16
SUB = DIM // M
RESIDUAL = """res AS (SELECT id, cell, list_transform(list_zip(x, c), lambda p: p[1] - p[2]) AS r
  FROM cells JOIN c2 USING (cell))"""
SUBS = f"subs AS (SELECT id, cell, m, r[m * {SUB} + 1 : (m + 1) * {SUB}] AS s FROM res, range({M}) AS x(m))"


def encoded(name: str, book: str) -> str:
    return f"""{name} AS (SELECT id, cell, m, code, s FROM (SELECT subs.id, subs.cell, subs.m, code, s,
  row_number() OVER (PARTITION BY subs.id, subs.m ORDER BY list_distance(s, v), code) AS r
  FROM subs JOIN {book} AS b ON b.m = subs.m) AS e WHERE r = 1)"""


PQ = [*IVF, RESIDUAL, SUBS,
      f"book0 AS (SELECT m, CAST(id AS INTEGER) AS code, s AS v FROM subs WHERE id < {CODES})",
      encoded("enc0", "book0"),
      f"""moved AS (SELECT m, code, list(a ORDER BY i) AS v FROM (SELECT m, code, i, avg(s[i]) AS a
  FROM enc0, range(1, {SUB + 1}) AS d(i) GROUP BY m, code, i) AS t GROUP BY m, code)""",
      "book AS (SELECT b.m, b.code, coalesce(moved.v, b.v) AS v FROM book0 AS b LEFT JOIN moved ON moved.m = b.m AND moved.code = b.code)",
      encoded("enc", "book")]
LOOKUP = f"""lut AS (SELECT query_id, cell, m, code,
  list_distance(list_transform(list_zip(q, c), lambda p: p[1] - p[2])[m * {SUB} + 1 : (m + 1) * {SUB}], v) AS d
  FROM probes, book)"""
PQ_PAIRS = """SELECT query_id, id AS neighbor_id, sqrt(sum(d * d)) AS distance
  FROM lut JOIN enc ON enc.cell = lut.cell AND enc.m = lut.m AND enc.code = lut.code GROUP BY query_id, id"""


def pq(n: int, digits: int = 6) -> str:
    return select([*PQ, PROBES, LOOKUP], ranked(PQ_PAIRS, n, digits))


TOP_T = 4
LEARNED = [*IVF,
           "parts AS (SELECT cell, row_number() OVER (ORDER BY cell) - 1 AS part FROM (SELECT DISTINCT cell FROM cells) AS s)",
           "labelled AS (SELECT id, x, part FROM cells JOIN parts USING (cell))",
           """raw AS (SELECT query_id, q, part, -list_distance(q, c) AS score FROM qs, c2 JOIN parts USING (cell))""",
           "probs AS (SELECT query_id, q, part, exp(score) / sum(exp(score)) OVER (PARTITION BY query_id) AS prob FROM raw)",
           f"""tops AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY prob DESC, part) AS rank
  FROM probs) AS s WHERE rank <= {TOP_T})"""]
LEARNED_PAIRS = "SELECT query_id, id AS neighbor_id, list_distance(q, x) AS distance FROM tops JOIN labelled USING (part)"


def learned(n: int, digits: int = 6) -> str:
    return select(LEARNED, ranked(LEARNED_PAIRS, n, digits))


def methods(parts: dict[str, str]) -> str:
    """Several result sets under their method names."""
    return " UNION ALL ".join(f"SELECT '{name}' AS method, s.* FROM ({sql}) AS s"
                              for name, sql in parts.items())
