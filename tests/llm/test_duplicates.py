"""Near duplicates, repeated lines and leaks against brute force."""

import itertools
import random

import numpy as np
import pytest

from vecsearch.llm.common import components
from vecsearch.llm.decontamination import best_stretch, drop_contaminated, find_overlaps, masks_of, products, seeds, tokens
from vecsearch.llm.line_dedup import drop_repeated_lines
from vecsearch.llm import minhash
from vecsearch.llm.minhash import PLACES, linked, minima, near_duplicates, one_of_each, pack
from vecsearch.llm.words import shingle_set

from .conftest import ODD, SCHEMA, rows_of


def plain_set(text, size=5):
    w = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = [x for x in __import__("re").split(r"[ \t-\r]+", w) if x]
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute_components(docs):
    sets = {i: plain_set(t) for i, t in docs}
    ids = sorted(sets)
    place = {i: i for i in ids}

    def find(i):
        while place[i] != i:
            i = place[i]
        return i

    for x in ids:
        for y in ids:
            both = len(sets[x] & sets[y])
            if x < y and both and 100 * both >= 75 * len(sets[x] | sets[y]):
                a, b = find(x), find(y)
                place[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def family(rnd, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(edits):
            w[rnd.randrange(len(w))] = f"e{rnd.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def near_fixture():
    rnd = random.Random(8)
    word = lambda: f"v{rnd.randrange(5000)}"
    docs = []
    for size, n, edits in ((200, 30, 2), (120, 40, 3), (60, 25, 1), (300, 12, 9)):
        docs += family(rnd, [word() for _ in range(size)], n, edits)
    passage = [word() for _ in range(120)]  # shared by many, short of a link
    docs += [" ".join(passage + [word() for _ in range(rnd.randint(25, 60))]) for _ in range(60)]
    chain = [word() for _ in range(100)]  # each near the next one only
    for _ in range(30):
        chain = chain[5:] + [word() for _ in range(5)]
        docs.append(" ".join(chain))
    docs += [docs[0]] * 40 + ["a b c", "A  b\tc", "a b", "", "   "]
    rnd.shuffle(docs)
    return list(enumerate(docs))


def test_near_duplicates_equal_brute_force(spark):
    docs = near_fixture()
    got = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute_components(docs)


def test_near_duplicates_odd_rows(odd, empty):
    got = sorted((tuple(r) for r in near_duplicates(odd).collect()), key=str)
    assert len(got) == len(ODD)
    by = {r[0]: r for r in got}
    assert by[7][2] == by[1][2] == 1 and not by[7][3] and by[1][3]
    assert by[2][1:] == (0, 2, True) and by[3][1:] == (0, 3, True) and by[4][1:] == (0, 4, True)
    assert by[None][2:] == (None, True) and by[5][1] == 1
    assert near_duplicates(empty).collect() == []
    kept = one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 3, 4, 5, 6, 8, 9, None, None, 11], key=str)
    assert one_of_each(empty).collect() == []


def test_packed_estimate_is_close():
    rng = np.random.default_rng(1)
    for share in (0.3, 0.75, 0.95):
        both, own = int(2000 * share), int(2000 * (1 - share) / 2)
        all_ = rng.integers(0, 2**64, both + 2 * own, dtype=np.uint64)
        x, y = (pack(minima(np.unique(s))) for s in (all_[:both + own], np.concatenate([all_[:both], all_[both + own:]])))
        equal = sum((int(a) >> (4 * k) & 15) == (int(b) >> (4 * k) & 15) for a, b in zip(x.view(np.uint64), y.view(np.uint64)) for k in range(16))
        assert abs((equal / PLACES - 1 / 16) / (15 / 16) - share) < 0.2


def test_threshold_counts_equality():
    x, y = np.arange(7, dtype=np.uint64), np.arange(1, 8, dtype=np.uint64)
    assert linked(x, y, 75) and not linked(x, y, 76)


def test_shingles_of_short_texts():
    assert len(shingle_set("a b", 5)) == 1 and len(shingle_set(" ", 5)) == 0
    assert shingle_set("A B c d e f", 5).tolist() == shingle_set("a  b\nc d e f", 5).tolist()


@pytest.mark.parametrize("edges", [[(i + 1, i) for i in range(200)], [(0, i) for i in range(1, 150)], [], [(5, 5)],
                                   [(random.Random(3).randrange(90), i) for i in range(90)]])
def test_components(spark, edges):
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).df.collect()}
    place = {n: n for e in edges if e[0] != e[1] for n in e}
    for _ in place:
        for a, b in edges:
            if a != b:
                place[a] = place[b] = min(place[a], place[b])
    assert got == place


def plain_lines(docs):
    first, out = {}, {}
    for i, t in docs:
        lines = t.split("\n")
        for p in range(len(lines) - 2):
            g = tuple(x.strip(" ") for x in lines[p:p + 3])
            if any(g):
                first.setdefault(g, (i, p))
    for i, t in docs:
        lines, gone = t.split("\n"), set()
        for p in range(len(lines) - 2):
            g = tuple(x.strip(" ") for x in lines[p:p + 3])
            if any(g) and (first[g][0] != i or p >= first[g][1] + 3):
                gone |= {p, p + 1, p + 2}
        out[i] = ("\n".join(x for k, x in enumerate(lines) if k not in gone), len(gone))
    return out


def test_lines_equal_brute_force(spark):
    rnd = random.Random(6)
    docs = [(i, "\n".join(rnd.choice(["", " ", "x", "y ", "z", f"u{rnd.randrange(40)}"]) for _ in range(rnd.randint(0, 30)))) for i in range(300)]
    got = drop_repeated_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: (r.text, r.lines_removed) for r in got} == plain_lines(docs)


def test_lines_odd_rows(odd, empty):
    got = drop_repeated_lines(odd)
    assert got.columns == [*odd.columns, "lines_removed"]
    rows = sorted(((r.doc_id, r.text, r.lines_removed) for r in got.collect()), key=str)
    want = [(i, "z" if i == 9 else t, 3 if i == 9 else 0) for i, t in ODD]
    assert rows == sorted(want, key=str)
    assert drop_repeated_lines(empty).collect() == []


def plain_units(t):
    """Lines, cut again after each end of a sentence, scanned by character."""
    out, cur, i = [], "", 0
    while i < len(t):
        cur += t[i]
        i += 1
        if cur[-1] in "\n。！？":
            out, cur = [*out, cur], ""
        elif cur[-1] in ".!?…" and len(cur) > 2 and cur[-3:-1].isalnum():
            j = i
            while j < len(t) and t[j] in '")]':
                j += 1
            k = j
            while k < len(t) and t[k] == " ":
                k += 1
            if k > j:
                k += t[k:k + 1] == "\n"
                out, cur, i = [*out, cur + t[i:k]], "", k
    return out + [cur] * bool(cur)


def plain_sentences(docs):
    units, first, out = {i: plain_units(t) for i, t in docs}, {}, {}
    at = lambda u, p: tuple(x.strip(" \n") for x in u[p:p + 3])
    for i, u in units.items():
        for p in range(len(u) - 2):
            first.setdefault(at(u, p), (i, p))
    for i, u in units.items():
        gone = {p + k for p in range(len(u) - 2) for k in range(3)
                if any(at(u, p)) and (first[at(u, p)][0] != i or p >= first[at(u, p)][1] + 3)}
        out[i] = ("".join(x for k, x in enumerate(u) if k not in gone), len(gone))
    return out


def test_repeated_sentences_inside_lines_go(spark):
    rnd = random.Random(9)
    passage = " ".join(" ".join(f"p{rnd.randrange(99)}" for _ in range(18)) + "." for _ in range(4))
    part = lambda: rnd.choice(["xx. ", "yy! ", "zz?) ", "J. ", "no end ", "\n", " \n", "完了。", f"u{rnd.randrange(30)}. ", 'end." \n'])
    docs = [(i, "".join(part() for _ in range(rnd.randint(0, 30)))) for i in range(200)]
    docs += [(500, f"It began so. {passage} It went on"), (501, f"Another text. {passage} and ends otherwise")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.text, r.lines_removed) for r in drop_repeated_lines(frame, sentences=True).collect()}
    assert got == plain_sentences(docs)
    assert got[501] == ("Another text. and ends otherwise", 4) and got[500] == (docs[200][1], 0)


def leak_fixture():
    rnd = random.Random(5)
    word = lambda: f"t{rnd.randrange(3000)}"
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate([40, 25, 14, 7, 5, 4, 0, 60])] + [(8, None)]
    docs, want = [], set()
    for i in range(120):
        body = [word() for _ in range(rnd.randint(0, 200))]
        if i % 3 == 0:
            k = rnd.choice([0, 1, 2, 3, 4, 7])
            w = items[k][1].split()
            if len(w) > 12:  # every seventh word is another one
                w = [f"S{rnd.randrange(99)}" if j % 7 == 3 else x.upper() for j, x in enumerate(w)]
            at = rnd.randint(0, len(body))
            body[at:at] = [*w[:-1], w[-1] + ","]
            want.add((i, k))
        docs.append((i, " ".join(body)))
    return docs, items, want


def test_leaks_are_found_and_clean_texts_not(spark):
    docs, items, want = leak_fixture()
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    rows = find_overlaps(d.repartition(3), b).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == want
    texts, parts = dict(docs), dict(items)
    for r in rows:  # every reported stretch is what a comparison along all diagonals gives
        w, it = tokens(texts[r.doc_id]), tokens(parts[r.item_id])
        best = 0
        for shift in range(1 - len(it), len(w)):
            lo, hi = max(0, shift), min(len(w), shift + len(it))
            equal = w[lo:hi] == it[lo - shift:hi - shift]
            s, e = best_stretch(equal)
            best = max(best, int(equal[s:e].sum()))
        assert r.equal_words == best


def test_leaks_odd_rows(odd, empty, spark):
    items = spark.createDataFrame([(1, "one two three four five six seven", "x"), (1, "one two three four five six seven", "x"),
                                   (2, None, "x"), (None, "no id at all here my friend", "x"), (3, "a b", "x")], "item_id long, text string, doc_id string")
    found = {(r.doc_id, r.item_id) for r in find_overlaps(odd, items).collect()}
    assert found == {(1, 1), (7, 1)}
    left = drop_contaminated(odd, items)
    assert left.columns == odd.columns and left.count() == len(ODD) - 3
    assert find_overlaps(empty, items).collect() == [] and drop_contaminated(odd, items.limit(0)).count() == len(ODD)


def test_leaks_of_items_with_repeated_or_no_id(spark):
    rnd = random.Random(12)
    texts = [" ".join(f"q{rnd.randrange(5000)}" for _ in range(n)) for n in (20, 25, 30, 7)]
    items = spark.createDataFrame([(1, texts[0]), (1, texts[1]), (2, texts[0]), (None, texts[2]), (None, texts[3])], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"before it {t} after it") for i, t in enumerate([*texts, "clean text of some words"])]
                                 + [(9, " and ".join(texts[:2]))], "doc_id long, text string").repartition(3)
    given = [(0, 1), (0, 2), (1, 1), (9, 1), (9, 1), (9, 2)]
    assert sorted((r.doc_id, r.item_id) for r in find_overlaps(docs, items).collect()) == given
    every = find_overlaps(docs, items, null_ids=True).collect()
    assert sorted(((r.doc_id, r.item_id) for r in every), key=str) == sorted([*given, (2, None), (3, None)], key=str)
    assert [r.doc_id for r in drop_contaminated(docs, items, null_ids=True).collect()] == [4]


def test_seed_ignores_masked_words():
    w = tokens("a b c d e f g h i")
    other = w.copy()
    other[3] += np.uint64(1)
    mask = masks_of(9)[0]
    assert mask[3] == "0" and seeds(products(w), mask)[0] == seeds(products(other), mask)[0] and len(seeds(products(w[:5]), mask)) == 0


@pytest.mark.parametrize("several", [True, False])
def test_no_unique_text_is_lost_where_ids_repeat(spark, several):
    a = "one two three four five six seven eight nine ten eleven twelve"
    other = [f"word{i} stands{i} alone{i} here{i} now{i} and{i} then{i}" for i in range(5)]
    rows = [(1, a), (2, a), (3, other[1]), (None, a), (None, a), (5, other[0]), (5, other[0]), (9, None), (9, None), (6, None), (7, "")]
    kept = {(1, a), (3, other[1]), (None, a), (5, other[0]), (9, None), (6, None), (7, "")}
    if several:
        rows += [(2, other[2]), (3, other[3]), (4, other[3]), (8, other[4]), (8, other[4] + " x"), (-2, a + " thirteen"), (-2, other[0])]
        kept = (kept - {(1, a), (5, other[0])}) | {(2, other[2]), (3, other[3]), (-2, a + " thirteen"), (-2, other[0])}
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, text_digest string, may_go string")
    got = one_of_each(docs.repartition(4))
    assert got.columns == docs.columns
    back = [(r.doc_id, r.text) for r in got.collect()]
    eighth = [t for i, t in back if i == 8]
    assert len(eighth) == several and set(eighth) <= {other[4], other[4] + " x"}
    rest = [r for r in back if r[0] != 8]
    assert set(rest) == kept and len(rest) == len(kept) + 1  # both rows without id stay


def test_short_items_and_unspaced_scripts(spark):
    items = [(1, "alpha beta gamma delta epsilon"), (2, "un deux trois quatre cinq six sept huit"), (3, "语言模型的评测基准问题"), (4, "too short here"),
             (5, "north south east west up down")]
    texts = {1: "x alpha beta OTHER delta epsilon y", 2: "alpha beta other other epsilon", 3: "a un x trois quatre cinq six y huit b", 4: "un x y quatre z six sept huit",
             5: "这里有语言模型的评测基准问题吗", 6: "语言模型的测评基准问题", 7: "too short here", 8: "north south east west up down", 9: "first south east west up down end",
             10: "north south east west up last", 11: "norths south east west ups down"}
    for short, n in ((items[0], 1), (items[4], 1), (items[1], 2)):
        words = short[1].split()
        for gone in itertools.combinations(range(len(words)), n):
            texts[100 * short[0] + len(texts)] = " ".join("other" if i in gone else w for i, w in enumerate(words))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {(r.doc_id, r.item_id, r.equal_words) for r in find_overlaps(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert {f for f in found if f[0] < 100} == {(1, 1, 4), (3, 2, 6), (5, 3, 11), (8, 5, 6), (9, 5, 5), (10, 5, 5)} | {f for f in found if f[0] == 6}
    assert {f[:2] for f in found if f[0] > 100} == {(i, i // 100) for i in texts if i > 100}
    assert [len(tokens(t)) for t in ("语言 ab", "ภาษา_x", "日本語のテキスト", "한국어 문장", "a_b")] == [3, 5, 8, 2, 2]


def test_passage_of_four_fifths_joins_nothing(spark, monkeypatch):
    """Texts around one passage that is 78 to 84 % of each, not linked by it, don't meet under its shingles; true links are found."""
    rnd = random.Random(5)
    passage = [f"p{i}" for i in range(400)]
    docs = [(i, " ".join(passage + [f"o{i}_{k}" for k in range(rnd.randint(78, 110))])) for i in range(1500)]
    docs += [(2000 + i, " ".join([*t.split()[:-3], "x", "y", f"z{i}"])) for i, (_, t) in enumerate(docs[:20])]
    sizes = []

    def noted(rows, percent, short=minhash.short_heads):
        kept = short(rows, percent)
        sizes.append(kept.select("shingle").join(rows.select("shingle"), "shingle").count())
        return kept

    monkeypatch.setattr(minhash, "short_heads", noted)
    placed = spark.createDataFrame([(i, i) for i, _ in docs], "id long, component long")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    pairs = {tuple(r) for r in minhash.prefix_pairs(frame, placed, 5, 75).collect()}
    assert {(i, 2000 + i) for i in range(20)} <= pairs
    assert sizes[0] < 200 * len(docs)  # a text with itself and its copy; all texts under one shingle alone would be 2,310,400


@pytest.mark.parametrize("percent", [75, 90])
def test_prefix_pairs_lose_no_link(spark, percent):
    """Against brute force, on texts of all sizes whose similarity lies around the threshold."""
    rnd = random.Random(percent)
    docs = []
    for group in range(12):
        base = [f"g{group}w{i}" for i in range(rnd.randint(6, 90))]
        for _ in range(14):
            change = len(base) * (100 - percent) // 100
            new = [f"n{rnd.randrange(10**6)}" for _ in range(rnd.randint(0, change))]
            docs.append((len(docs), " ".join(base[rnd.randint(0, change):] + new)))
    placed = spark.createDataFrame([(i, i) for i, _ in docs], "id long, component long")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    pairs = {tuple(r) for r in minhash.prefix_pairs(frame, placed, 5, percent).collect()}
    sets = {i: plain_set(t) for i, t in docs}
    links = {(x, y) for x in sets for y in sets if x < y and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y])}
    assert len(links) > 50 and links <= pairs
