"""Learned operators: held-out accuracy, recall against brute force, and defined results for odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vecsearch.llm import language, learned_ann, toxicity
from vecsearch.llm.convnet import ConvNet
from vecsearch.llm.learned_ann import best_of

from .conftest import ODD

ANN_SCHEMA = "vec_id long, embedding array<float>, part string, asks string, query_id string"


def vectors(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    rows = [(i, v, "p", "a", "q") for i, v in zip(ids, [None if v is None else [None if c is None else float(c) for c in v] for v in x])]
    return spark.createDataFrame(rows, ANN_SCHEMA)


def brute_neighbours(x, ids, asked, k):
    out = {}
    for i in asked:
        q = x[ids.index(i)]
        s = [((x[j] * q).sum(), ids[j]) for j in range(len(ids)) if ids[j] != i]
        out[i] = [b for _, b in sorted(s, key=lambda t: (-t[0], t[1]))[:k]]
    return out


def test_ann_recall_and_order(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 16))
    x = (centres[rng.integers(0, 30, 4000)] + 0.5 * rng.normal(size=(4000, 16))).astype(np.float32).astype(float)
    x[2000:3300] = x[5]  # a third of all rows is one vector
    got = {}
    for r in learned_ann.search(vectors(spark, x).repartition(6), F.col("vec_id") % 20 == 0, 10, part_rows=200).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = brute_neighbours(x, list(range(4000)), range(0, 4000, 20), 10)
    assert set(got) == set(want)
    hits = 0
    for q, rows in got.items():
        rows.sort()
        assert [r for r, _, _ in rows] == list(range(1, 11))
        assert rows == sorted(rows, key=lambda t: (-t[2], t[1]))
        for _, b, s in rows:
            assert s == pytest.approx((x[q] * x[b]).sum(), abs=1e-12)
        hits += len({b for _, b, _ in rows} & set(want[q]))
    assert hits / (10 * len(want)) >= 0.9


def test_ann_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    x = [[1, 0], [0, 1], [1, 1], None, [0, 0], [nan, 1], [inf, 1], [None, 1], [], [1, 2, 3], [1, 1], [2, 2]]
    ids = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 2, None]
    rows = learned_ann.search(vectors(spark, x, ids), F.col("vec_id") % 2 == 0, 5).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in rows] == [(0, 1, 2, 1.0), (0, 2, 1, 0.0), (2, 1, 0, 1.0), (2, 2, 1, 1.0)]
    assert learned_ann.search(vectors(spark, []), F.col("vec_id") % 2 == 0).collect() == []


def test_parts_are_balanced():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 8))
    part = learned_ann.balanced_parts(x, learned_ann.neighbour_graph(x, 10), 9, rng)
    assert np.bincount(part, minlength=9).max() <= 110


SYLLABLES = {"aa": ["bla", "kor", "tin"], "bb": ["ñue", "éau", "ção"], "cc": ["zsch", "üpf", "keit"]}


def text_of(rnd, lang, n):
    return " ".join("".join(rnd.choices(SYLLABLES[lang], k=rnd.randint(1, 4))) for _ in range(n))


def test_language_held_out(spark):
    rnd = random.Random(1)
    docs = [(i, text_of(rnd, lang := rnd.choice("aa bb cc".split()), rnd.randint(3, 400)), lang) for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = language.train(df, per_language=60, epochs=3)
    got = {r.doc_id: r for r in language.identify(df.drop("lang"), model).collect()}
    held = [(i, lang) for i, _, lang in docs if __import__("zlib").crc32(str(i).encode()) % 5 == 0]
    assert sum(got[i].lang_pred == lang for i, lang in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_windows_cover_whole_text():
    raw = bytes(range(1, 251)) * 5
    w = language.windows_of(raw)
    assert len(w) == 5 and w[-1].tobytes() == raw[-256:] and b"".join(x.tobytes() for x in w[:4]) == raw[:1024]
    assert language.windows_of(b"ab").tolist()[0][:3] == [97, 98, 0]


def test_language_odd_rows(odd, empty, spark):
    rows = language.identify(odd, language.train(odd)).collect()
    by = sorted(((r.doc_id, r.lang_pred) for r in rows), key=str)
    assert len(rows) == len(ODD) and [x for x in by if x[0] in (2, 3, 4)] == [(i, "und") for i in (2, 3, 4)]
    none = language.train(empty)
    assert language.identify(empty, none).collect() == [] and {r.lang_pred for r in language.identify(odd, none).collect()} == {"und"}


def toxic_rows(n=500):
    rnd = random.Random(2)
    out = []
    for i in range(n):
        words = text_of(rnd, "aa", rnd.randint(5, 120)).split()
        bad = i % 4 == 0
        if bad:
            for _ in range(rnd.randint(1, 3)):
                words.insert(rnd.randint(0, len(words)), rnd.choice(["grobian", "lumpazi" + rnd.choice("xyz"), "Schuft!"]))
        out.append((i, " ".join(words), "aa", int(bad)))
    return out


def test_toxicity_held_out(spark):
    rows = toxic_rows()
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, least_steps=200)
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, model).collect()}
    held = [r for r in rows if __import__("zlib").crc32(str(r[0]).encode()) % 3 == 1]
    assert sum(got[r[0]].predicted == r[3] for r in held) / len(held) > 0.97
    kept = {r.doc_id for r in toxicity.drop_toxic(docs, model).collect()}
    assert kept == {i for i, r in got.items() if not r.rejected}
    long = " ".join(text_of(random.Random(9), "aa", 70_000).split() + ["grobian"])  # beyond a chunk, at the very end
    assert model.scores([long])[0] == pytest.approx(model.scores([long[-8000:]])[0], abs=0.2)


def test_toxicity_odd_rows(odd, empty, spark):
    labels = spark.createDataFrame([(1, 1), (5, 0), (6, None), (None, 1), (7, 3)], "doc_id long, toxic int")
    for marks in (labels, labels.limit(0)):
        model = toxicity.train(odd, marks)
        rows = toxicity.score_toxicity(odd, model).collect()
        assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
        assert toxicity.score_toxicity(empty, model).collect() == []
        assert toxicity.drop_toxic(odd, model).columns == odd.columns


def test_gradient_by_differences():
    net = ConvNet(3, (1, 2), 4, 2, 0)
    for k in net.params:
        net.params[k] = net.params[k].astype(np.float64)
    x = np.random.default_rng(0).normal(size=(12, 3))
    x[[5, 11]] = 0
    begin, end, y, w = np.array([0, 6]), np.array([5, 11]), np.array([0, 1]), np.ones(2)

    def loss():
        z = net.logits(net.pooled(x, begin, end))
        p = np.exp(z) / np.exp(z).sum(1, keepdims=True)
        return -np.log(p[[0, 1], y]).mean()

    want = np.zeros_like(x)
    for i in np.ndindex(*x.shape):
        keep = x[i]
        x[i] = keep + 1e-6
        up = loss()
        x[i] = keep - 1e-6
        want[i] = (up - loss()) / 2e-6
        x[i] = keep
    rows, grad, _ = net.step(x, begin, end, y, w, 0.0)
    got = np.zeros_like(x)
    np.add.at(got, rows, grad)
    real = [i for i in range(12) if i not in (5, 11)]
    np.testing.assert_allclose(got[real], want[real], atol=1e-5)


@pytest.mark.parametrize("part_rows", [1000, 60])
def test_ann_repeated_ids_do_not_crowd(spark, part_rows):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 4)).astype(np.float32).astype(float)
    ids = [*range(100), *[7] * 200]  # two thirds of all rows share one id
    got = {}
    for r in learned_ann.search(vectors(spark, x, ids), F.col("vec_id") % 10 == 0, 8, part_rows=part_rows).collect():
        got.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    for i in range(0, 100, 10):
        best = {}
        for v, j in zip(x, ids):
            if j != i:
                best[j] = max(best.get(j, -9e9), float((v * x[i]).sum()))
        want = sorted((-s, j) for j, s in best.items())[:8]
        assert len({j for _, j in got[i]}) == len(got[i]) == 8
        if part_rows == 1000:  # one part: exact
            assert [j for _, j in sorted(got[i])] == [j for _, j in want]
        assert all(-s <= best[j] + 1e-12 for s, j in got[i])


@pytest.mark.parametrize("text, known", [("½ ²", False), ("Ⅷ 7", False), ("_", False), ("ª", True), ("½ é", True), ("12 日", True)])
def test_only_letters_make_a_language(text, known):
    model = language.LanguageModel(["en"], ConvNet(8, (2, 3, 4), 16, 1, 0), np.zeros((256, 8), np.float32))
    assert (language.predict([text], model)[0] == ["en"]) == known


def test_language_column_of_free_text_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_LANGUAGES", 2)
    rows = [(i, "some words of text here", ["en", "de", f"junk{i}", None][i % 4]) for i in range(200)] + [(i, "more", "en") for i in range(200, 220)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), epochs=1)
    assert model.names == ["de", "en"]


def test_language_scores_equal_a_plain_forward_pass():
    rng = np.random.default_rng(4)
    net, table = ConvNet(8, (2, 3, 4), 16, 3, 4), rng.normal(size=(256, 8)).astype(np.float32)
    for name in net.params:
        net.params[name] = rng.normal(size=net.params[name].shape).astype(np.float32) * 0.5
    model = language.LanguageModel(["a", "b", "c"], net, table)
    texts = ["short é", "x" * 256, "exactly one more " * 16 + "y", "".join(map(chr, rng.integers(97, 123, 3000))), "日本 " * 400]

    def plain(text):
        raw, total = text.encode(), np.zeros(3)
        full = len(raw) // 256
        cuts = [raw.ljust(256, b"\0")] if len(raw) <= 256 else [raw[i * 256:(i + 1) * 256] for i in range(full)] + [raw[-256:]] * (len(raw) % 256 > 0)
        for w in cuts:
            x = table[list(w)].astype(np.float64)
            tops = []
            for width in net.widths:
                kernel, bias = net.params[f"w{width}"].astype(np.float64), net.params[f"b{width}"]
                padded = np.vstack([x, np.tile(table[0].astype(np.float64), (net.gap, 1))])
                values = [np.maximum(sum(padded[p + j] @ kernel[j] for j in range(width)) + bias, 0) for p in range(256)]
                tops.append(np.max(values, axis=0))
            z = np.concatenate(tops) @ net.params["out"] + net.params["bias"]
            p = np.exp(z - z.max())
            total += p / p.sum() * sum(b != 0 for b in w)
        return total / total.sum()

    names, scores = language.predict(texts, model)
    for text, name, score in zip(texts, names, scores):
        p = plain(text)
        assert name == "abc"[int(p.argmax())] and abs(score - p.max()) < 1e-4


def test_ann_order_of_long_vectors():
    rng = np.random.default_rng(1)
    for _ in range(20):
        q = rng.normal(size=(1, 64)) * 1e6
        b = rng.normal(size=(200, 64)) * 1e6
        b -= (b @ q.T) * q / (q ** 2).sum()  # nearly at right angles
        exact = (b * q[0]).sum(axis=1)
        want = np.lexsort((np.arange(200), -exact))[:20]
        assert best_of(q, np.array([-1]), b, np.arange(200), 20)[1].tolist() == want.tolist()


def test_toxicity_sample_comes_from_documents_that_exist(spark, monkeypatch):
    docs = spark.createDataFrame([(i, ("bad " if i % 2 else "good ") * (30_000 if i % 4 == 0 else 30), "en") for i in range(100)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)] + [(i, i % 2) for i in range(1000, 9000)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, per_class=60, longest=1000, least_steps=60)
    assert model.net is not None
    texts = ["bad bad bad", "good good good", "", None, "good " * 50 + "bad", "new words only", "!"]
    score = model.scores(texts)
    assert score[0] > 0.7 > score[1]
    monkeypatch.setattr(toxicity, "CHUNK", 7)  # many chunks give what a plain pass over the whole text gives
    np.testing.assert_allclose(model.scores(texts), [plain_toxicity(model, t) for t in texts], atol=1e-5)
    np.testing.assert_allclose(score, model.scores(texts), atol=1e-6)


def plain_toxicity(model, text):
    net, words = model.net, toxicity.words_of(text)
    x = [model.table[model.hashed.lookup([w])[0]].sum(axis=0).astype(np.float64) for w in words] + [np.zeros(net.dim)] * net.gap
    tops = []
    for width in net.widths:
        kernel, bias = net.params[f"w{width}"], net.params[f"b{width}"]
        values = [sum(x[p + j] @ kernel[j] for j in range(width)) + bias for p in range(len(words))]
        tops.append(np.maximum(np.max(values, axis=0), 0) if values else np.zeros(net.filters))
    z = np.concatenate(tops) @ net.params["out"] + net.params["bias"]
    return 1 / (1 + np.exp(-(model.slope * (z[1] - z[0]) + model.shift)))


def test_toxicity_learns_from_every_labelled_document(spark):
    kinds = [f"kind{chr(97 + i // 8)}{chr(97 + i % 8)}word" for i in range(40)]
    tail = "x " * 500 + "tailword"  # beyond ``longest``
    rows = [(i, f"some plain text {kinds[i % 40]} here" if i % 2 else "some plain text here too " + (tail if i % 3 else ""), "en", i % 2) for i in range(900)]
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string").repartition(5)
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, per_class=10, longest=100, least_steps=40)
    assert (model.hashed.lookup([*kinds[1::2], "tailword"])[:, 0] > 0).all()
    got = {r.doc_id: r.predicted for r in toxicity.score_toxicity(docs, model).collect()}
    assert sum(got[r[0]] == r[3] for r in rows) / len(rows) > 0.97
    assert set(model.thresholds) == {"en"}


def test_toxicity_features_are_counted_over_all_rows(spark):
    rnd = random.Random(4)
    rows = [(text_of(rnd, rnd.choice("aa bb cc".split()), rnd.randint(0, 60)), rnd.randint(0, 1)) for _ in range(200)]
    want, docs = {}, [0, 0]
    for text, toxic in rows:
        words = set(toxicity.words_of(text))
        docs[toxic] += bool(words)
        for w in words:
            for f in toxicity.features(w):
                want.setdefault(f, [0, 0, 0])[0] += 1
        for f in {f for w in words for f in toxicity.features(w)}:
            want[f][1 + toxic] += 1
    table = toxicity.feature_counts(spark.createDataFrame(rows, "text string, toxic int").repartition(3)).collect()
    got = {None if r.feature is None else r.feature % (1 << 64): [r.words, r.clean, r.toxic] for r in table}
    assert got.pop(None)[1:] == docs and got == want
    z, y, n = np.array([0.5, 1.5, 1.0, 2.5, 1.5]), np.array([0, 1, 0, 1, 0]), np.array([3, 2, 1, 4, 1])
    assert toxicity._best_cut(z, y, n) == toxicity._best_cut(np.repeat(z, n), np.repeat(y, n))


def test_toxicity_step_on_chunks_equals_step_on_whole_texts(monkeypatch):
    rnd = random.Random(5)
    texts = [text_of(rnd, "aa", n).split() for n in (1, 2, 7, 30, 200)]
    counts = {w: 2 for t in texts for w in t}

    def learned():
        model = toxicity.ToxicityModel(0.5)
        model.hashed = toxicity.HashedWords.fit(counts)
        model.net = ConvNet(toxicity.DIM, toxicity.WIDTHS, toxicity.FILTERS, 2, 3)
        model.table = toxicity.Embedding(model.hashed.rows, toxicity.DIM, 3).table
        learner = toxicity._Learner(model, 3)
        for _ in range(3):
            learner.learn(texts, np.array([0, 1, 0, 1, 1]), np.ones(2, np.float32), 0.01)
        assert not np.allclose(learner.emb.table, model.table)
        return [learner.emb.table, *learner.net.params.values()]

    whole = learned()
    monkeypatch.setattr(toxicity, "CHUNK", 7)
    for a, b in zip(whole, learned()):
        np.testing.assert_allclose(a, b, atol=1e-5)
