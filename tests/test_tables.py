import json
import random
import uuid
from fractions import Fraction

import numpy as np
import pytest
from helpers import base_frame, query_frame, vectors
from pyspark.sql import functions as F

from vecsearch.functions.text import fixed
from vecsearch.operators import evaluate, graph, quality, report, sequences, truth
from vecsearch.operators.exact import knn_exact
from vecsearch.operators.run import compare_files
from vecsearch.sources import index_store
from vecsearch.sources import tables as io
from vecsearch.sources.index_store import Index, get_or_build, load_index, save_index


def test_fasta_cases(spark, tmp_path):
    path = tmp_path / "a.fasta"
    path.write_text(">one first > second\nACX*\nDEac\n>two\n\n>three x\nXX\n>four\nAC DE\tF")
    got = {r["id"]: r["seq"] for r in io.read_fasta(spark, str(path)).collect()}
    assert got == {"one": "ACX*DEac", "two": "", "three": "XX", "four": "ACDEF"}
    clean = {r["id"]: r["seq"] for r in sequences.clean_sequences(io.read_fasta(spark, str(path))).collect()}
    assert clean == {"one": "ACDE", "four": "ACDEF"}
    with pytest.raises(ValueError):
        sequences.clean_sequences(spark.createDataFrame([("a", "xx")], "id string, seq string"), require_rows=True)


def test_fasta_roundtrip_over_splits(spark, tmp_path):
    rng = random.Random(1)
    want = {f"s{i}": "".join(rng.choices(sequences.RESIDUES, k=rng.randint(1, 400))) for i in range(300)}
    df = spark.createDataFrame(list(want.items()), "id string, seq string")
    io.write_fasta(df.coalesce(1), str(tmp_path / "f"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        back = io.read_fasta(spark, str(tmp_path / "f"))
        got = {r["id"]: r["seq"] for r in back.collect()}
        assert back.rdd.getNumPartitions() > 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == want


def hit(q, s, pident, evalue, bits):
    return "\t".join(map(str, [q, s, pident, 10, 0, 0, 1, 10, 1, 10, evalue, bits]))


def test_hits(spark, tmp_path):
    lines = [hit("q1", "a", 50.0, 0.001, 100), hit("q1", "b", 20.0, 0.01, 99), hit("q1", "a", 60.0, 0.002, 90),
             hit("q1", "c", 30.0, 0.0, 90), hit("q1", "d", 31.0, 0.0, 90), hit("q2", "a", 70.0, "nan", 5),
             hit("001", "z", 1.0, 0.0, 1)]
    path = tmp_path / "hits.tsv"
    path.write_text("\n".join(lines))
    hits = io.read_hits(spark, str(path))
    assert [r["subject"] for r in hits.orderBy("hit_seq").collect()] == ["a", "b", "a", "c", "d", "a", "z"]
    good = truth.filter_hits(hits)
    assert good.count() == 5
    top = {(r["query"], r["subject"]) for r in truth.truth_topn(good, 3).collect()}
    assert top == {("q1", "a"), ("q1", "c"), ("001", "z")}
    kept = [(r["subject"], r["rank"]) for r in truth.truth_topn(good, 3, distinct=False).where("query = 'q1'").orderBy("rank").collect()]
    assert kept == [("a", 1), ("a", 2), ("c", 3)]
    last = {(r["query"], r["subject"]): r["pident"] for r in truth.identity_last(good).collect()}
    assert last["q1", "a"] == 60.0
    assert truth.truth_counts(good).first().asDict() == {"n_queries": 2, "n_hits": 5}
    assert io.read_hits(spark, str(tmp_path / "none.tsv")).count() == 0


def test_hit_order_over_splits_and_files(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.tsv").write_text("\n".join(hit(name, i, 1.0, 0.0, 1) for i in range(400)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        got = io.read_hits(spark, str(tmp_path)).orderBy("hit_seq").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [(r["query"], r["subject"]) for r in got] == [(n, str(i)) for n in "ab" for i in range(400)]


def test_annotations(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text(json.dumps({"x": {"domains": ["D1"], "ec_numbers": ["E"]}, "y": {"domains": ["D2"]}, "z": {}}, indent=1))
    got = {r["id"]: (r["domains"], r["ec_numbers"]) for r in io.read_annotations(spark, str(path)).collect()}
    assert got == {"x": (["D1"], ["E"]), "y": (["D2"], []), "z": ([], [])}
    assert io.read_annotations(spark).count() == 0
    assert io.read_annotations(spark, str(tmp_path / "none.json")).count() == 0


def split_reads(spark, path, size):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        tasks = spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions()
        return tasks, {r["id"]: (r["domains"], r["ec_numbers"]) for r in io.read_annotations(spark, path).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("indent", [None, 2])
def test_annotations_of_one_large_file_are_read_in_blocks(spark, tmp_path, indent):
    """Braces, quotes, backslashes and line ends inside strings, entries longer than blocks, nested and empty objects."""
    rnd = random.Random(4)
    odd = ["}", "{", '"', "\\", '\\"}, "x": {', "\n", "é", "},", "a b", '{"q": {}}', ""]
    text = lambda: "".join(rnd.choice(odd) for _ in range(rnd.randrange(6)))
    notes = {}
    for i in range(600):
        entry = {"domains": [text() for _ in range(rnd.randrange(4))], "ec_numbers": [text() for _ in range(rnd.randrange(3))]}
        if i % 5 == 0:
            entry["more"] = {"deep": {"deeper": [text(), {"x": text()}]}}
        notes[f"{i}{text()}"] = entry
    notes["long"] = {"domains": ["}" * 5000, "x" * 9000], "ec_numbers": ['"{' * 3000]}
    notes |= {f"empty{i}": {} for i in range(40)} | {"none": None}
    want = {k: ((v or {}).get("domains", []), (v or {}).get("ec_numbers", [])) for k, v in notes.items()}
    path = str(tmp_path / "notes.json")
    (tmp_path / "notes.json").write_text(json.dumps(notes, indent=indent, ensure_ascii=False))
    for size in (1 << 30, 4096, 1000):
        tasks, got = split_reads(spark, path, size)
        assert got == want
        assert tasks == 1 if size == 1 << 30 else tasks > 8


def test_annotations_one_object_per_line_and_several_files(spark, tmp_path):
    lines = [json.dumps({f"k{i}": {"domains": [f"D{i}"]}}) for i in range(300)]
    (tmp_path / "a.json").write_text("\n".join(lines) + "\n")
    (tmp_path / "b.json").write_text(json.dumps({"k7": {"domains": ["later"]}, "m": {}}) + json.dumps({"m": {"ec_numbers": ["E"]}}))
    (tmp_path / "c.json").write_text("")
    (tmp_path / "d.json").write_text('{"whole": {"domains": ["W"]}, "torn": {"domains": ["T"')
    for size in (1 << 30, 700):
        _, got = split_reads(spark, str(tmp_path), size)
        assert got == {f"k{i}": ([f"D{i}"], []) for i in range(300)} | {"k7": (["later"], []), "m": ([], ["E"]), "whole": (["W"], [])}


def test_vector_table_checks(spark, tmp_path):
    x = vectors(20)
    check = io.write_vectors(base_frame(spark, x), str(tmp_path / "v"), verify=True).first()
    assert check.asDict() == {"rows": 20, "mismatches": 0}
    assert io.read_vectors(spark, str(tmp_path / "v")).count() == 20
    for bad, name in (([(1, [1.0]), (2, [1.0, 2.0])], "ragged"), ([(1, [1.0]), (1, [2.0])], "twice")):
        spark.createDataFrame(bad, "id bigint, embedding array<float>").write.parquet(str(tmp_path / name))
        with pytest.raises(ValueError):
            io.read_vectors(spark, str(tmp_path / name))
    spark.range(3).write.parquet(str(tmp_path / "other"))
    with pytest.raises(ValueError):
        io.read_vectors(spark, str(tmp_path / "other"))


def test_fallback_ids_keep_names(spark):
    df = spark.createDataFrame([(10, "a"), (30, None), (20, None)], "ord bigint, id string")
    got = {r["ord"]: r["id"] for r in io.with_fallback_ids(df, "ord").collect()}
    assert got == {10: "a", 20: "prot_1", 30: "prot_2"}


def test_index_reuse(spark, tmp_path):
    base = base_frame(spark, vectors(30))
    built = []

    def build():
        built.append(1)
        return {"assigned": base.withColumn("cell", (F.col("id") % 3).cast("int"))}

    path = str(tmp_path / "index")
    assert get_or_build(spark, path, {"a": 1}, base, build)[1] is False
    index, reused = get_or_build(spark, path, {"a": 1}, base, build)
    assert reused and len(built) == 1 and index.tables["assigned"].count() == 30
    assert get_or_build(spark, path, {"a": 2}, base, build)[1] is False
    assert get_or_build(spark, path, {"a": 2}, base.limit(29), build)[1] is False
    assert get_or_build(spark, path, {"a": 2}, base.limit(29), build, rebuild=True)[1] is False
    assert len(built) == 4
    save_index(Index({"centroids": base}, {"k": 1}), str(tmp_path / "other"))
    assert load_index(spark, str(tmp_path / "other")).params == {"k": 1}


def test_pooling(spark):
    tok = [(1, 0, False, [1.0, 0.0]), (1, 1, False, [2.0, 2.0]), (1, 2, False, [4.0, 6.0]), (1, 3, False, [9.0, 9.0]),
           (1, 4, True, [50.0, 50.0]), (2, 0, True, [7.0, 7.0])]
    df = spark.createDataFrame(tok, "id int, pos int, is_pad boolean, embedding array<float>")
    assert {r["id"]: r["embedding"] for r in sequences.mean_pool(df).collect()} == {1: [4.0, 4.25], 2: [0.0, 0.0]}
    inner = {r["id"]: r["embedding"] for r in sequences.mean_pool(df, exclude_special=True).collect()}
    assert inner[1] == [3.0, 4.0]
    one = {r["id"]: r["embedding"] for r in sequences.mean_pool(df, exclude_special=True, max_length=1).collect()}
    assert one[1] == [2.0, 2.0]


def test_embed_by_token_budget_pads_little(spark):
    """Batches fill their budget over the borders of Arrow batches; at most a few in a hundred of the padded tokens are padding."""
    rnd = random.Random(1)
    sizes = [rnd.randint(1, 900) for _ in range(3000)]
    df = spark.createDataFrame([(i, "A" * n) for i, n in enumerate(sizes)], "id int, seq string").repartition(2)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        look = lambda texts: np.array([[len(t), max(map(len, texts)), len(texts)] for t in texts])
        seen = {r["id"]: r["embedding"] for r in sequences.embed(df, look, token_budget=8192).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert {i: v[0] for i, v in seen.items()} == dict(enumerate(sizes))
    assert all(longest * rows <= 8192 for _, longest, rows in seen.values())
    padded = sum(longest for _, longest, _ in seen.values())
    assert padded - sum(sizes) < 0.03 * padded
    assert sum(1 / rows for _, _, rows in seen.values()) < 1.15 * padded / 8192 + 4  # batches, about as few as the budget allows
    one = sequences.embed(df.where("id < 3"), look, token_budget=1).collect()
    assert sorted(r["embedding"][2] for r in one) == [1, 1, 1]


def test_embedding_goes_on_where_a_run_broke_off(spark, tmp_path):
    path, calls = str(tmp_path / "out"), tmp_path / "calls"
    calls.mkdir()
    df = spark.createDataFrame([(i, "A" * (i % 50 + 1)) for i in range(400)] + [(None, "CC")], "id int, seq string")
    rounds = lambda i: spark.createDataFrame([(i,)], "id int").select(F.pmod(F.xxhash64("id"), F.lit(5))).first()[0]

    def counted(texts):
        (calls / uuid.uuid4().hex).write_text(str(len(texts)))
        if "A" * 33 in texts and not (tmp_path / "mended").exists():
            raise RuntimeError("lost")
        return np.array([[len(t), 1] for t in texts])

    with pytest.raises(Exception, match="lost"):
        sequences.embed_rounds(df, path, counted, rounds=5, name="count")
    finished = set(sequences.embed_progress(spark, path))
    (tmp_path / "mended").write_text("")
    for old in calls.iterdir():
        old.unlink()
    left = sum(rounds(i) not in finished for i in [*range(400), None])
    got = sequences.embed_rounds(df.limit(0), path, counted, rounds=5, name="count")
    assert {r["id"]: r["embedding"] for r in got.collect()} == {i: [i % 50 + 1, 1] for i in range(400)} | {None: [2, 1]}
    assert sum(int(f.read_text()) for f in calls.iterdir()) == left
    assert set(sequences.embed_progress(spark, path)) == {-1, 0, 1, 2, 3, 4}
    with pytest.raises(ValueError, match="was begun as"):
        sequences.embed_rounds(df, path, counted, rounds=6, name="count")
    assert sequences.embed_rounds(df.limit(0), str(tmp_path / "none"), rounds=2).count() == 0


def test_embed_passes_whole_batches(spark):
    df = spark.createDataFrame([(i, "A" * i + "C") for i in range(20)], "id int, seq string").coalesce(1)
    seen = sequences.embed(df, lambda texts: np.array([[len(t), len(texts)] for t in texts]), batch_size=8, max_length=10)
    got = {r["id"]: r["embedding"] for r in seen.collect()}
    assert len(got) == 20 and got[3] == [4.0, 8.0] and got[19][0] == 10.0
    composed = sequences.embed(df).where("id = 3").first()["embedding"]
    assert composed[0] == 0.75 and composed[1] == 0.25


def test_fixed_matches_exact_rounding(spark):
    numbers = {float(Fraction(a, b)) for b in range(1, 60) for a in range(b + 1)}
    numbers |= {i / 1000 for i in range(2000)} | {i / 16 for i in range(2000)} | {i / 10 for i in range(1001)}
    df = spark.createDataFrame([(x,) for x in sorted(numbers)], "x double")
    for digits in (1, 2, 3, 4):
        got = df.select("x", fixed(F.col("x"), digits).alias("s")).collect()
        assert [(r["x"], r["s"]) for r in got if r["s"] != f"{r['x']:.{digits}f}"] == []
    assert spark.range(1).select(fixed(F.lit(None).cast("double"), 2).alias("s")).first()["s"] is None


def comment_by_rule(identity, distance, threshold=0.3):
    if distance is not None and identity < 30 and distance < threshold:
        return f"REMOTE HOMOLOG CANDIDATE ({identity:.1f}%)"
    for bound, text in ((30, "High similarity"), (20, f"Twilight Zone ({identity:.1f}%)"),
                        (0, f"Remote homolog candidate ({identity:.1f}%)")):
        if identity > bound:
            return text
    return "No BLAST match"


def test_comments(spark):
    pairs = [(i, d) for i in (0.0, 0.05, 10.0, 20.0, 20.1, 29.95, 30.0, 30.1, 100.0) for d in (None, 0.1, 0.3, 2.0)]
    df = spark.createDataFrame(pairs, "identity double, distance double")
    got = df.select("identity", "distance", report.bio_comment(F.col("identity"), F.col("distance")).alias("c")).collect()
    assert [r["c"] for r in got] == [comment_by_rule(i, d) for i, d in pairs]


def test_annotation_suffixes(spark):
    annot = spark.createDataFrame([("q", ["B", "A", "C"], ["1"]), ("n", ["C", "A", "B", "D"], ["2"]), ("e", [], [])],
                                  io.ANNOTATION_ROW)
    near = spark.createDataFrame([("q", "n", 1.0, 50.0), ("q", "e", 1.0, 50.0), ("q", "x", 1.0, 50.0)],
                                 "query_id string, neighbor_id string, distance double, identity double")
    got = {r["neighbor_id"]: r["comment"] for r in report.with_comment(near, annot).collect()}
    assert got == {"n": "High similarity [Common domains: A, B]", "e": "High similarity", "x": "High similarity"}


@pytest.fixture(scope="module")
def evaluated(spark):
    near = spark.createDataFrame(
        [("M", "q1", "a", 0.5, 1), ("M", "q1", "b", 1.25, 2), ("M", "q2", "a", 0.5, 1)],
        "method string, query_id string, neighbor_id string, distance double, rank bigint")
    known = spark.createDataFrame([("q1", "b"), ("q1", "z"), ("q9", "a")], "query string, subject string")
    queries = spark.createDataFrame([("q1",), ("q2",), ("q3",)], "query_id string")
    return near, known, queries


def test_recall(evaluated):
    near, known, queries = evaluated
    got = {(r["method"], r["query_id"]): r["recall"] for r in evaluate.recall(near, known, queries, 10, ["M", "Lost"]).collect()}
    assert got["M", "q1"] == 0.5 and sum(got.values()) == 0.5 and len(got) == 6
    one = evaluate.recall(near, known, queries, 1).where("query_id = 'q1'").first()
    assert (one["hits"], one["recall"]) == (0, 0.0)
    lost = {r["query_id"] for r in evaluate.queries_without_truth(queries, known).collect()}
    assert lost == {"q2", "q3"}


def test_summary_with_times(spark, evaluated):
    near, known, queries = evaluated
    scored = evaluate.recall(near, known, queries, 10)
    times = spark.createDataFrame([("M", "q1", 0.5), ("M", "q2", 0.25)], "method string, query_id string, seconds double")
    row = evaluate.method_summary(scored, times).first()
    assert (row["avg_time"], row["avg_qps"], row["n_queries"]) == (0.25, 3.0, 3)
    assert row["avg_recall"] == pytest.approx(0.5 / 3)


def test_report_text(spark, evaluated, tmp_path):
    near, known, queries = evaluated
    identity = spark.createDataFrame([("q1", "b", 25.0)], "query string, subject string, pident double")
    times = spark.createDataFrame([("M", "q1", 0.5)], "method string, query_id string, seconds double")
    scored = evaluate.eval_per_query(evaluate.recall(near, known, queries, 10, ["M"]), times)
    shown = report.neighbor_report(near, known, identity, 5)
    lines = report.report_lines(scored, shown, ["M"], 10, 5)
    io.write_report(lines.where("query_id = 'q1'"), str(tmp_path / "r"))
    text = [r["value"] for r in spark.read.text(str(tmp_path / "r")).collect()]
    assert text[0] == "Query Protein: q1" and text[-2] == "=" * 80
    assert f"{'M':16} | {0.5:12.3f} | {2.0:7.1f} | 0.500" in text
    assert f"{'BLAST (Ref)':16} | {'-':12} | {'-':7} | 1.000" in text
    first = text.index("Method: M") + 4
    assert text[first] == f"{1:4} | {'a':11} | {0.5:7.3f} | {0.0:13.1f}% | {'No':15} | No BLAST match"
    assert text[first + 1] == f"{2:4} | {'b':11} | {1.25:7.3f} | {25.0:13.1f}% | {'Yes':15} | Twilight Zone (25.0%)"
    assert not any(line.startswith("Method:") for line in
                   (r["line"] for r in lines.where("query_id = 'q3'").collect()))
    failed = spark.createDataFrame([("M", "broken")], "method string, error string")
    errors = report.report_lines(scored, shown, ["M"], 10, 5, failed).where("query_id = 'q3'").collect()
    assert f"{'M':16} | ERROR        | ERROR  | ERROR" in {r["line"] for r in errors}


def test_search_all_records_errors(spark):
    x = vectors(20)
    base, queries = base_frame(spark, x), query_frame(spark, x[:3])

    def in_task(b, q, n):
        return knn_exact(b, q, n).withColumn("distance", F.raise_error(F.lit("bad task")).cast("double"))

    found, errors = evaluate.search_all(base, queries, {"bad": in_task, "good": knn_exact}, 2)
    assert [r["method"] for r in errors.collect()] == ["bad"]
    assert found.groupBy("method").count().collect()[0].asDict() == {"method": "good", "count": 6}
    with pytest.raises(ValueError):
        evaluate.select_methods("other", {})
    none, _ = evaluate.search_all(base, queries, {"bad": in_task}, 2)
    assert none.count() == 0


def test_graph(spark):
    raw = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (2, 1), (2, 3), (4, 4)], "src bigint, dst bigint")
    both = graph.symmetrize(raw)
    assert sorted(map(tuple, both.collect())) == [(1, 2, 2), (2, 1, 2), (2, 3, 1), (3, 2, 1)]
    assert graph.is_consistent(both)
    broken = spark.createDataFrame([(1, 2, 2), (2, 1, 1), (2, 3, 1)], "src bigint, dst bigint, weight int")
    bad = {(r["src"], r["dst"]): (r["reverse_weight"], r["reason"]) for r in graph.graph_inconsistencies(broken).collect()}
    assert bad == {(1, 2): (1, "weight"), (2, 1): (2, "weight"), (2, 3): (None, "missing")}
    for bucket in (2, 100):
        csr = sorted(map(tuple, graph.csr_offsets(both, 6, bucket).collect()))
        assert csr == [(0, 0, 0, 1), (1, 0, 1, 1), (2, 1, 3, 1), (3, 3, 4, 1), (4, 4, 4, 1), (5, 4, 4, 1)]
    assert graph.graph_counts(both).first().asDict() == {"n_nodes": 3, "n_edges": 2}
    assert graph.sample_subgraph(both, 10).count() == 4
    assert sorted(map(tuple, graph.sample_subgraph(both, 2, sampling="lowest").collect())) == [(1, 2, 2), (2, 1, 2)]
    assert graph.sample_subgraph(both, 2).count() in (0, 2)


def test_silhouette_by_hand(spark):
    points = np.array([[0.0], [1.0], [10.0], [11.0], [50.0]], dtype=np.float32)
    cells = spark.createDataFrame([(i, [float(p[0])], c) for i, (p, c) in enumerate(zip(points, [0, 0, 1, 1, 2]))],
                                  "id bigint, embedding array<float>, cell int")
    got = quality.silhouette(cells, sampling="lowest").first()
    want = [(10.5 - 1) / 10.5, (9.5 - 1) / 9.5, (9.5 - 1) / 9.5, (10.5 - 1) / 10.5]
    assert got["valid_points"] == 4 and got["score"] == pytest.approx(np.mean(want))
    alone = quality.silhouette(cells.where("cell = 2")).first()
    assert (alone["score"], alone["valid_points"]) == (0.0, 0)
    centres = spark.createDataFrame([(c, [0.0]) for c in range(4)], "cell int, centroid array<double>")
    stats = quality.cluster_stats(cells, centres).first().asDict()
    assert (stats["n_clusters"], stats["total_points"], stats["empty_clusters"], stats["min_size"]) == (4, 5, 1, 0)
    assert stats["std_size"] == pytest.approx(np.std([2, 2, 1, 0]))


def test_bench_and_missing_queries(spark):
    x = vectors(10)
    base, queries = base_frame(spark, x), query_frame(spark, x[:2])
    timed = evaluate.bench({"Exact": (lambda: None, lambda _: knn_exact(base, queries, 2))}, 2, spark).first()
    assert timed["method"] == "Exact" and timed["qps"] > 0
    wanted = spark.createDataFrame([(1,), (99,)], "query_id bigint")
    found, missing = io.resolve_queries(wanted, base)
    assert [r["query_id"] for r in found.collect()] == [1] and [r["query_id"] for r in missing.collect()] == [99]


def test_bad_path_leaves_later_reads_alone(spark, tmp_path):
    for _ in range(2):
        empty = io.read_hits(spark, str(tmp_path / "missing"))
        assert empty.count() == 0 and empty.columns == [*io.HIT_SCHEMA.names, "hit_seq"]
    (tmp_path / "hits.tsv").write_text("a\tb\t90\t10\t0\t0\t1\t10\t1\t10\t1e-5\t50\n")
    assert io.read_hits(spark, str(tmp_path / "hits.tsv")).columns == empty.columns


def test_broken_rebuild_leaves_the_stored_index(spark, tmp_path):
    from vecsearch.sources.index_store import Index, load_index, save_index
    path = str(tmp_path / "index")
    save_index(Index({"t": spark.range(3), "u": spark.range(4)}, {"v": 1}), path)
    fail = F.raise_error(F.lit("broken")).cast("long")
    with pytest.raises(Exception, match="broken"):
        save_index(Index({"t": spark.range(7), "u": spark.range(2).select(fail.alias("id"))}, {"v": 2}), path)
    stored = load_index(spark, path)
    assert stored.params == {"v": 1} and stored.tables["t"].count() == 3


def test_scratch_needs_a_shared_folder_unless_local(spark, monkeypatch):
    from vecsearch.operators import common

    class Conf:
        def __init__(self, master):
            self.values = {"spark.master": master}

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        def __init__(self, master):
            self.conf = Conf(master)

    assert common.scratch_path(Session("local[4]"), "x")
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="share"):
            common.scratch_path(Session(master), "x")


def test_mean_times_reach_the_summary(spark):
    from vecsearch.operators import evaluate, report
    scored = spark.createDataFrame([("A", 1, 2, 1, 0.5), ("A", 2, 2, 2, 1.0)], "method string, query_id long, truth_size long, hits long, recall double")
    measured = spark.createDataFrame([("A", 0.1, 4.0, 0.5)], "method string, build_s double, search_s double, qps double")
    times = evaluate.mean_timings(measured, scored)
    assert {r.seconds for r in times.collect()} == {2.0}
    summary = evaluate.run_summary(scored, spark.range(9), 4.0, times)
    row = summary.first()
    assert (row.avg_time, row.avg_qps, row.db_size, row.total_qps) == (2.0, 0.5, 9, 0.5)
    assert report.summary_lines(summary, ["A"], 10).count() > 6


@pytest.mark.parametrize("bucket", [2, 7, 100_000])
def test_adjacency_arrays(spark, bucket):
    rng = np.random.default_rng(3)
    pairs = {(0, int(j)) for j in range(1, 30)} | {tuple(map(int, sorted(rng.choice(30, 2, replace=False)))) for _ in range(40)}  # node 0 is a hub
    edges = sorted((a, b, 1 + (a + b) % 2) for x, y in pairs for a, b in ((x, y), (y, x)))
    df = spark.createDataFrame(edges, "src bigint, dst bigint, weight int").repartition(5)
    got = [tuple(r) for r in graph.csr_adjacency(df, 33, bucket).orderBy("pos").collect()]
    assert got == [(i, a, b, w) for i, (a, b, w) in enumerate(edges)]
    offsets = {r.node: (r.start_off, r.end_off) for r in graph.csr_offsets(df, 33, bucket).collect()}
    for node, (start, end) in offsets.items():
        assert [r[1] for r in got[start:end]] == [node] * (end - start)
    assert graph.csr_adjacency(df.limit(0), 3).count() == 0


def test_composition_counts_characters(spark):
    texts = ["ACDC", "", None, "éAß日C", "ac", "W" * 5000, "A\nC"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "seq string").coalesce(1).select(sequences.composition(F.col("seq"))).collect()]
    assert got[2] is None and len(got) == len(texts)
    for t, v in zip(texts, got):
        if t is not None:
            np.testing.assert_allclose(v, [t.count(c) / max(len(t), 1) for c in sequences.RESIDUES], atol=1e-7)


def test_old_index_versions_go_after_their_grace(spark, tmp_path):
    path = str(tmp_path / "index")
    table = lambda k: base_frame(spark, vectors(6, seed=k))
    versions = lambda: sorted(p.name for p in (tmp_path / "index").iterdir() if p.name != "params")
    save_index(Index({"t": table(1)}, {"k": 1}), path)
    first = versions()
    save_index(Index({"t": table(2)}, {"k": 2}), path, grace=3600)
    assert len(versions()) == 2  # a reader of the former one may still be at it
    (tmp_path / "index" / "00000000000000000001-broken").mkdir()
    save_index(Index({"t": table(3)}, {"k": 3}), path, grace=0)
    assert len(versions()) == 1 and versions() != first and load_index(spark, path).params == {"k": 3}
    assert load_index(spark, path).tables["t"].count() == 6


def test_one_call_from_inputs_to_report(spark, tmp_path):
    x = vectors(60, seed=4)
    io.write_vectors(base_frame(spark, x, "p"), str(tmp_path / "vectors"))
    hits = [(f"p{q}", f"p{(q * 7 + s) % 60}", 25.0 + s, 100, 1, 0, 1, 9, 1, 9, 1e-5 * (1 + s), 50.0 - s) for q in range(5) for s in range(4)]
    (tmp_path / "hits.tsv").write_text("\n".join("\t".join(map(str, h)) for h in hits))
    (tmp_path / "notes.json").write_text(json.dumps({f"p{i}": {"domains": ["PF1"], "ec_numbers": []} for i in range(60)}))

    def broken(base, queries, n):
        raise RuntimeError("no index")

    wanted = spark.createDataFrame([("p0",), ("p1",), ("p9",), ("nobody",)], "query_id string")
    run, missing = compare_files(spark, str(tmp_path / "vectors"), wanted, str(tmp_path / "hits.tsv"), {"Exact": knn_exact, "Broken": broken},
                                 annotations=str(tmp_path / "notes.json"), recall_n=4, shown=3, path=str(tmp_path / "report"))
    assert [r.query_id for r in missing.collect()] == ["nobody"] and [tuple(r) for r in run.errors.collect()] == [("Broken", "no index")]
    near = {i: [j for j, _ in v] for i, v in brute_rows(x, (0, 1, 9), 4).items()}
    got = {r.query_id: r for r in run.scores.where("method = 'Exact'").collect()}
    for q in ("p0", "p1"):
        truth_set = {h[1] for h in hits if h[0] == q}
        assert got[q].truth_size == 4 and got[q].hits == len(truth_set & set(near[q])) and got[q].recall == got[q].hits / 4
    assert got["p9"].truth_size == 0 and got["p9"].recall == 0
    assert run.report.where("method = 'Exact'").count() == 9 and all("PF1" in r.comment for r in run.report.collect())
    summary = {r.method: r for r in run.summary.collect()}
    assert summary["Exact"].n_queries == 3 and summary["Exact"].db_size == 60 and summary["Exact"].avg_time > 0
    text = [r.value for r in spark.read.text(str(tmp_path / "report")).collect()]
    assert sum("ERROR" in line for line in text) == 3 and len(text) == run.lines.count() + run.closing.count()


def brute_rows(x, asked, n):
    out = {}
    for i in asked:
        d = np.sqrt(((x.astype(np.float64) - x[i].astype(np.float64)) ** 2).sum(axis=1))
        out[f"p{i}"] = [(f"p{j}", d[j]) for j in sorted(range(len(x)), key=lambda j: (d[j], f"p{j}"))[:n]]
    return out


def test_added_rows_alone_are_assigned(spark, tmp_path, monkeypatch):
    path, seen = str(tmp_path / "index"), []
    x = vectors(30, seed=6)
    frame = lambda rows: base_frame(spark, x).where(F.col("id").isin(rows))
    place = lambda df: df.withColumn("cell", (F.col("id") % 4).cast("int"))

    def get(df, params=None):
        def assign(rows, index):
            assert index.params["k"] == 4
            seen.append(sorted(r.id for r in rows.collect()))
            return place(rows)
        index, state = index_store.get_or_extend(spark, path, params or {"k": 4}, df, lambda: {"assigned": place(df)}, assign)
        return state, sorted((r.id, r.cell) for r in index.tables["assigned"].collect())

    cells = lambda rows: [(i, i % 4) for i in rows]
    assert get(frame(list(range(10)))) == ("built", cells(range(10)))
    assert get(frame(list(range(10)))) == ("reused", cells(range(10)))
    assert get(frame(list(range(20)))) == ("appended", cells(range(20))) and seen == [list(range(10, 20))]
    real = index_store._name_state

    def breaks(*_):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(index_store, "_name_state", breaks)  # a segment that was written but never named
    with pytest.raises(RuntimeError):
        get(frame(list(range(25))))
    monkeypatch.setattr(index_store, "_name_state", real)
    assert sorted(r.id for r in load_index(spark, path).tables["assigned"].collect()) == list(range(20))
    assert get(frame(list(range(25)))) == ("appended", cells(range(25))) and seen[-1] == list(range(20, 25))
    assert get(frame(list(range(25))).where("id <> 3"))[0] == "built"  # a row went
    other = frame(list(range(25))).where("id <> 3").withColumn("embedding", F.when(F.col("id") == 5, F.reverse("embedding")).otherwise(F.col("embedding")))
    assert get(other)[0] == "built" and get(other)[0] == "reused" and get(other, {"k": 5})[0] == "built"
