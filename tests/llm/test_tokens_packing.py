"""Token counts and packed pieces against the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from vecsearch.llm.packing import CapacityTree, first_fit_decreasing, pack_documents
from vecsearch.llm.pretokens import Spans, segments
from vecsearch.llm.token_counts import Encoder, count_tokens

from .conftest import ODD

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["'s", "'re", "'ll", "'", "''", " ", "  ", "\n", "\t", " \n", "a", "Ab", "é", "1", "23", "!", "?!", "<|endoftext|>",
         "\x1c", "\x00", "日本", "😀", "aaaaaaa", "====", "\r\n", "ß", "'D", "²", "ⅷ", "́", "_", " ", " "]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_library(library):
    rnd = random.Random(4)
    texts = ["".join(rnd.choices(PARTS, k=rnd.randint(0, 40))) for _ in range(3000)] + ["", None, "a" * 5000, "ab " * 3000]
    coder = Encoder(PATH, room=500, chunk_chars=300)
    want = [ids_of(library, t) for t in texts]
    assert [x.tolist() for x in coder.ids(texts)] == want
    assert coder.counts(texts).tolist() == [len(x) for x in want]


def test_classes_of_all_planes(library):
    texts = [f"x{chr(c)}1 {chr(c)}{chr(c)}!" for c in range(0, 0x110000, 211) if not 0xD800 <= c < 0xE000]
    assert Encoder(PATH).counts(texts).tolist() == [len(ids_of(library, t)) for t in texts]


def test_counts_of_odd_rows(odd, empty, library):
    got = sorted(map(tuple, count_tokens(odd, PATH, 512).collect()), key=str)
    want = [(i, len((t or "").encode()), n := len(ids_of(library, t)), n > 512) for i, t in ODD]
    assert got == sorted(want, key=str)
    assert count_tokens(empty, PATH).collect() == []


def test_tree_finds_leftmost_bin():
    rnd = random.Random(2)
    sizes = [rnd.randint(1, 100) for _ in range(500)]
    tree, free = CapacityTree(500, 100), [100] * 500
    for s in sizes:
        b = next(i for i, f in enumerate(free) if f >= s)
        assert tree.place(s) == b
        free[b] -= s


def test_first_fit_decreasing_fills_bins():
    sizes = np.array([10, 4, 6, 10, 3, 7, 1])
    bins, offsets = first_fit_decreasing(sizes, 10)
    total = np.bincount(bins, sizes)
    assert total.max() <= 10 and len(total) == 5
    assert len(set(zip(bins.tolist(), offsets.tolist()))) == len(sizes)


@pytest.mark.parametrize("group_rows", [5, 8192])
def test_packing_round_trip(odd, library, group_rows):
    rows = pack_documents(odd, PATH, 64, group_rows, with_ids=True).collect()
    want = sorted(tuple(ids_of(library, t) + [0]) for _, t in ODD)
    docs, seqs = {}, {}
    for r in rows:
        assert r.length <= 64 and r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length
        docs.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        seqs.setdefault(r.sequence_id, []).append(r)
    for pieces in seqs.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    back = []
    for pieces in docs.values():
        copies = sum(r.start == 0 for r in pieces)
        by_start = sorted(pieces, key=lambda r: r.start)
        for c in range(copies):
            back.append(tuple(np.frombuffer(b"".join(r.ids for r in by_start[c::copies]), "<u4").tolist()))
    assert sorted(back) == want


def test_packing_empty_and_padding(empty, spark):
    assert pack_documents(empty, PATH).collect() == []
    rows = pack_documents(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), PATH).collect()
    sequences = {r.sequence_id for r in rows}
    assert sum(r.length for r in rows) / (1024 * len(sequences)) > 0.98


def thue_morse(n, letters):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_words_of_one_hash_are_told_apart(library, n):
    a, b = thue_morse(n, "ab"), thue_morse(n, "ba")
    spans = Spans([a, b])
    assert spans.key[0] == spans.key[1] and a != b
    for texts in ([a, b], [b, a, a + " x", b], [f"{a} {b} {a}"], [a * 2, b * 2, (a + b) * 2]):
        coder = Encoder(PATH)
        want = [ids_of(library, t) for t in texts]
        assert [x.tolist() for x in coder.ids(texts)] == want and [x.tolist() for x in coder.ids(texts[::-1])] == want[::-1]
        assert coder.counts(texts).tolist() == [len(x) for x in want]


def test_long_texts_are_cut_at_borders_of_classes(library):
    rnd = random.Random(8)
    signs = ["语", "言", "，", "。", "7", "'", "s", "re", "+", "/", "A", "z", "\n", "\t ", "é"]
    texts = ["".join(rnd.choices(signs[k:], k=4000)) for k in (0, 2, 4, 6)] + ["".join(rnd.choices("ABab01+/", k=6000)), "字" * 700]
    group = [g for g, _, _ in segments(texts, None, 50)]
    assert all("".join(s for g, o, _ in segments([t], None, 50) for s in g) == t for t in texts) and len(group) > 200
    coder = Encoder(PATH, chunk_chars=50)
    assert [x.tolist() for x in coder.ids(texts)] == [ids_of(library, t) for t in texts]


def test_fifty_megabytes_of_one_script_come_in_pieces():
    text = "语言模型的文本没有空格，" * 1_400_000  # 50 MB in UTF-8
    sizes = [sum(map(len, g)) for g, _, _ in segments([text], None, 1 << 19)]
    assert sum(sizes) == len(text) and max(sizes) <= (1 << 19) + 12
