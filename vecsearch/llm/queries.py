"""Registered queries of the pipeline operators and their SQL (where SQL can express them)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, language, learned_ann, prefix_trie, toxicity, warc, whitening
from ..operators.common import scratch_path
from .common import read_table
from .decontamination import find_overlaps
from .line_dedup import SENTENCE, drop_repeated_lines
from .minhash import near_duplicates
from .packing import pack_documents
from .sharding import shard_documents
from .token_counts import count_tokens

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return keep


@query("op7_packing")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(read_table(spark, folder, "documents"), VOCABULARY)


@query("op10_token_counts")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(read_table(spark, folder, "documents"), VOCABULARY)


NEAR_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
           ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh
  FROM w),
t AS (SELECT doc_id, unnest(sh) AS g FROM s),
n AS (SELECT doc_id, len(sh)::BIGINT AS n FROM s),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS inter FROM t a JOIN t b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * inter >= 75 * (x.n + y.n - inter)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, u.b FROM r JOIN u ON r.b = u.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY 1)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM n JOIN c USING (doc_id)
"""


@query("op6_minhash", NEAR_SQL)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(read_table(spark, folder, "documents"))


@query("op4_decontamination")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    found = find_overlaps(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"), null_ids=True)
    return found.select("doc_id", "item_id", "start", "length", "equal_words")


LINES_SQL = r"""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
x AS (SELECT doc_id, ls, unnest(range(0, len(ls) - 2)) AS pos FROM l WHERE len(ls) >= 3),
w AS (SELECT doc_id, pos, [trim(ls[pos + 1]), trim(ls[pos + 2]), trim(ls[pos + 3])] AS g FROM x),
f AS (SELECT g, min(struct_pack(d := doc_id, p := pos)) AS f FROM w WHERE array_to_string(g, '') <> '' GROUP BY g),
r AS (SELECT w.doc_id, w.pos FROM w JOIN f USING (g)
      WHERE (w.doc_id <> f.f.d) OR (w.pos >= f.f.p + 3)),
c AS (SELECT DISTINCT doc_id, pos + unnest([0, 1, 2]) AS pos FROM r),
k AS (SELECT l.doc_id, list(y.line ORDER BY y.pos) FILTER (c.pos IS NULL) AS kept, count(c.pos) AS lines_removed
      FROM l, LATERAL (SELECT unnest(l.ls) AS line, unnest(range(0, len(l.ls))) AS pos) y
      LEFT JOIN c ON c.doc_id = l.doc_id AND c.pos = y.pos GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(array_to_string(k.kept, chr(10)), '') END AS text,
       coalesce(k.lines_removed, 0)::BIGINT AS lines_removed
FROM documents d LEFT JOIN k USING (doc_id)
"""


@query("op8_line_windows", LINES_SQL)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return drop_repeated_lines(read_table(spark, folder, "documents")).select("doc_id", "text", "lines_removed")


SENTENCES_SQL = LINES_SQL.replace("string_split(text, chr(10))", f"regexp_extract_all(text, '{SENTENCE}')").replace(
    "array_to_string(k.kept, chr(10))", "array_to_string(k.kept, '')")
for _k in "123":
    SENTENCES_SQL = SENTENCES_SQL.replace(f"trim(ls[pos + {_k}])", f"trim(ls[pos + {_k}], ' ' || chr(10))")


@query("op8_sentence_windows", SENTENCES_SQL)
def op8_sentences(spark: SparkSession, folder: str) -> DataFrame:
    return drop_repeated_lines(read_table(spark, folder, "documents"), sentences=True).select("doc_id", "text", "lines_removed")


@query("op5_language_id")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    found = language.identify(docs, language.train(docs))
    return found.select("doc_id", (~language.training_part(F.col("doc_id"))).alias("held_out"), "lang_pred", "score")


@query("op9_toxicity")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    found = toxicity.score_toxicity(docs, toxicity.train(docs, read_table(spark, folder, "labels")))
    held_out = (~toxicity.training_part(F.col("doc_id"))).alias("held_out")
    return found.select("doc_id", held_out, "score", "predicted", "threshold", "rejected")


CHAT_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, 8 + length(role) + length(text) + length(text) - length(replace(text, '\', ''))
    + list_sum(list_transform(['<s>', '</s>', '[INST]', '[/INST]', '<<SYS>>', '<</SYS>>', '<|im_start|>', '<|im_end|>', '<|endoftext|>'],
        lambda k: (length(text) - length(replace(text, k, ''))) // length(k))) AS size,
  row_number() OVER w AS n, count(*) OVER (PARTITION BY conv_id) AS total FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
s AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY n) AS upto FROM e)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum(upto) FILTER (role = 'assistant' OR n = total))::BIGINT AS formatted_chars
FROM s GROUP BY conv_id
"""


@query("op3_chat_prefixes", CHAT_SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    talks = read_table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digest(chat.format_examples(talks.unionByName(planted)))


SHARD_BYTES = 1 << 20
SHARD_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents),
p AS (SELECT doc_id, n_bytes, depth::INTEGER AS depth, h >> (60 - depth) AS pre,
  sum(n_bytes) OVER w AS shard_bytes, count(*) OVER w AS rows FROM d, generate_series(0, 40) g(depth)
  WINDOW w AS (PARTITION BY depth, h >> (60 - depth))),
f AS (SELECT * FROM p WHERE shard_bytes <= {SHARD_BYTES} OR rows = 1 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth) = 1)
SELECT doc_id, n_bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(pre), depth, '0') END AS shard, depth, shard_bytes::BIGINT AS shard_bytes FROM f
"""


@query("op2_extendible_shards", SHARD_SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return shard_documents(read_table(spark, folder, "documents"), SHARD_BYTES)


@query("op1_learned_partitions")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return learned_ann.search(read_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


TRIE_SQL = r"""
WITH t AS (SELECT conv_id, coalesce(text, '') AS text,
    sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS name, turn FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, name, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, name) AS pos FROM t),
c AS (SELECT conv_id, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, 3988292384 * (v & 1))))) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
m AS (SELECT c.conv_id, h, count(b.pos) AS m FROM c LEFT JOIN o b ON b.conv_id = c.conv_id - c.conv_id % 20 AND b.pos <= h GROUP BY ALL),
r AS (SELECT m.conv_id, b.pos AS depth, b.name, b.words FROM m JOIN o b ON b.conv_id = m.conv_id - m.conv_id % 20 AND b.pos <= h
  UNION ALL SELECT m.conv_id, b.pos - h + m AS depth, b.name, b.words FROM m JOIN o b ON b.conv_id = m.conv_id AND b.pos > h),
s AS (SELECT conv_id, depth, words, string_agg(name, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM r
  UNION ALL SELECT conv_id, 0, 0, '' FROM m),
n AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words FROM s GROUP BY path, depth),
k AS (SELECT path[:64 * (depth - 1)] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
a AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (path)),
u AS (SELECT path[:64 * up] AS path, sum((n_convs - 1) * words) AS saved, count(*) FILTER (n_children = 0) AS leaves
  FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM a) GROUP BY 1),
l AS (SELECT path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY depth DESC) = 1) GROUP BY path)
SELECT a.conv_id, a.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, a.n_convs, a.n_children, u.leaves AS n_leaves,
  u.saved::BIGINT AS saved_tokens, sha256(coalesce(l.ids, '')) AS ends_sha256
FROM a JOIN u USING (path) LEFT JOIN l USING (path) LEFT JOIN n p ON a.depth > 0 AND p.depth = a.depth - 1 AND p.path = a.path[:64 * (a.depth - 1)]
"""


@query("op11_prefix_trie", TRIE_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(read_table(spark, folder, "conversations"))


ARCHIVE_BYTES = 1 << 20  # so that files roll on small tables; the default is 256 MiB
WARC_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to FROM f
"""


@query("op12_warc", WARC_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "archive")
    warc.write_archive(read_table(spark, folder, "pages"), path, ARCHIVE_BYTES)
    records = warc.read_archive(spark, path, payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op13_whitening")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(read_table(spark, folder, "embeddings"))
