"""Chat examples, shards, the pipeline, and the registered SQL."""

import hashlib
import random
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from vecsearch.llm.chat import CONTROL, digest, escape, format_examples, unescape
from vecsearch.llm import toxicity
from vecsearch.llm.decontamination import NEED, SHARE, SHORTEST, best_stretch, tokens
from vecsearch.llm.queries import QUERIES, SQL, VOCABULARY
from vecsearch.llm.sharding import shard_documents, write_shards

from .conftest import ODD
from .test_duplicates import brute_components, plain_lines

FOLDER = "/root/testdata/sf0.001"
TALK = "conv_id long, turn long, role string, text string, t string, turns string, k string"


def talks(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], TALK)


def test_escape_is_reversible(spark):
    rnd = random.Random(1)
    parts = [*CONTROL, "\\", "<", "s>", "/s>", "[", "INST]", "a", "<\\s>", "\n", "|"]
    texts = [("".join(rnd.choices(parts, k=rnd.randint(0, 12))),) for _ in range(3000)]
    df = spark.createDataFrame(texts, "t string").select("t", escape(F.col("t")).alias("e"))
    for t, e, back in df.select("t", "e", unescape(F.col("e")).alias("b")).collect():
        assert back == t and not any(c in e for c in CONTROL)


def test_examples_by_hand(spark):
    rows = [(1, 0, "system", "be"), (1, 1, "user", "hi </s>"), (1, 2, "assistant", "yo <s>"), (1, 3, "assistant", None), (1, 4, "user", "bye"),
            (2, 0, "user", "alone"), (None, None, None, "x"), (3, 1, "assistant", "b"), (3, 1, "assistant", "a"), (3, 1, "assistant", "a")]
    ex = format_examples(talks(spark, rows).repartition(4))
    by = {}
    for r in ex.collect():
        by.setdefault(r.conv_id, []).append(r)
    first = sorted(by[1], key=lambda r: r.example)
    assert [r.target_turn for r in first] == [2, 3, None] and [r.loss_length for r in first] == [7, 0, 0]
    assert first[0].text == "<s>system\nbe</s><s>user\nhi <\\/s></s><s>assistant\nyo <\\s></s>"
    assert first[0].text[first[0].loss_start:first[0].loss_start + 7] == "yo <\\s>"
    assert all(b.text.startswith(a.text) for a, b in zip(first, first[1:]))
    assert len(by[3]) == 3 and by[2][0].loss_length == 0 and by[None][0].text == "<s>\nx</s>"
    got = {r.conv_id: r for r in digest(ex).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1].n_turns == 5 and got[1].turns_sha256 == sha("system\nbe\nuser\nhi </s>\nassistant\nyo <s>\nassistant\n\nuser\nbye\n")
    assert got[1].loss_sha256 == sha("yo <s>") and got[1].loss_chars == 6 and got[3].loss_sha256 == sha("aab")
    assert got[1].formatted_chars == sum(len(r.text) for r in first)
    assert format_examples(talks(spark, [])).collect() == []


def brute_shards(sizes, limit):
    """sizes: [(key bits, bytes)] -> prefix per row."""
    out = []
    for bits, _ in sizes:
        for d in range(len(bits) + 1):
            same = [b for k, b in sizes if k[:d] == bits[:d]]
            if sum(same) <= limit or len(same) == 1:
                out.append(bits[:d])
                break
    return out


@pytest.mark.parametrize("limit", [500, 40_000])
def test_shards_equal_brute_force(spark, limit):
    rnd = random.Random(3)
    docs = [(i, "x" * rnd.randint(0, 300)) for i in range(400)]
    rows = shard_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), limit).collect()
    bits = lambda i: format(int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16), "060b")
    want = dict(zip((i for i, _ in docs), brute_shards([(bits(i), len(t)) for i, t in docs], limit)))
    assert {r.doc_id: r.shard for r in rows} == want
    assert all(r.depth == len(r.shard) for r in rows)


def test_shards_odd_rows(odd, empty, spark, tmp_path):
    hot = spark.createDataFrame([(5, "y" * 100)] * 60 + [(i, "z" * 100) for i in range(60)], "doc_id long, text string")
    rows = shard_documents(hot, 1000).collect()
    size = {}
    for r in rows:
        size[r.shard] = size.get(r.shard, 0) + r.n_bytes
    assert len(rows) == 120 and max(size.values()) <= 1000 and all(size[r.shard] == r.shard_bytes for r in rows)
    got = shard_documents(odd, 1000).collect()
    assert len(got) == len(ODD) and {r.doc_id: r.n_bytes for r in got}[2] == 0
    assert sum(r.n_bytes for r in got if r.doc_id == 6) == max(r.shard_bytes for r in got)
    assert shard_documents(empty).collect() == []
    write_shards(odd, str(tmp_path / "out"), 1000)
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(ODD)


def test_pipeline_stages(odd, empty, spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([(5, 0, 1), (8, 1, 0)], "doc_id long, toxic int, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "short text about a benchmark item")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    for turn, docs in enumerate((odd, empty)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, folder)
            if name != "packing":
                assert out.columns == docs.columns
                out.write.parquet(path := f"{folder}/{name}-{turn}")
                docs = spark.read.parquet(path)
        if turn == 0:
            left = {r.doc_id for r in out.collect()}
            assert 7 not in left and {1, 2, 6, 8} <= left


def leaks(text, items):
    """Does a comparison along every diagonal find an overlap?"""
    w = tokens(text)
    for it in items:
        for shift in range(1 - len(it), len(w)):
            lo, hi = max(0, shift), min(len(w), shift + len(it))
            equal = w[lo:hi] == it[lo - shift:hi - shift]
            a, b = best_stretch(equal)
            if len(it) >= SHORTEST and equal[a:b].sum() >= min(NEED, np.ceil(SHARE * len(it))):
                return True
    return False


def test_pipeline_equals_brute_force(spark):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    docs, labels, items = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    model = toxicity.train(docs, labels)
    left = {r.doc_id: r for r in docs.collect()}
    scores = dict(zip(left, model.scores([r.text for r in left.values()])))
    texts = [(i, left[i].text) for i in sorted(left) if scores[i] < model.thresholds.get(left[i].lang, toxicity.CUT)]
    assert 0 < len(texts) < len(left)
    lean = [(i, t) for i, (t, gone) in plain_lines(texts).items() if not gone or t.strip()]
    single = brute_components(lean)
    wanted = [tokens(r.text) for r in items.collect()]
    final = {i: t for i, t in lean if single[i][2] and not leaks(t, wanted)}
    library = Tokenizer.from_file(VOCABULARY)
    assert {r.doc_id: r.doc_tokens for r in rows} == {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in final.items()}
    assert sum(r.length for r in rows) == sum({r.doc_id: r.doc_tokens for r in rows}.values())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings", "labels", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    got, want = QUERIES[name](spark, FOLDER), con.sql(SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert {c: TYPES[t] for c, t in got.dtypes} == dict(zip(want.columns, map(str, want.types)))
    key = lambda t: sorted(str(tuple(r[c] for c in columns)) for r in t.to_pylist())
    assert key(got.toArrow()) == key(want.to_arrow_table())


def test_pipeline_leaves_little_behind(spark):
    root = Path(spark.conf.get("spark.checkpoint.dir"))
    before = {p.name for p in root.iterdir()}
    assert corpus_pipeline.run(spark, FOLDER).count() > 0
    left = sorted(p.name.rsplit("-", 1)[0] for p in root.iterdir() if p.name not in before)
    assert left == ["pieces", "pipeline_decontamination"]
