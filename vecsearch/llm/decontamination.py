"""Benchmark passages in training texts, found by spaced seeds.

A seed hashes some words of a window and ignores others by a fixed mask, so a substituted word under an ignored
position leaves the hash as it is. Seeds of training texts that may occur in the benchmark (a bitmap of bounded size tells)
are joined with the benchmark's seeds on the hash; around each hit the texts are compared word by word on its
diagonal, and the best stretch decides.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stored, fresh
from .words import mix, multipliers

# Which words of a window count ("1") and which are ignored, and the letters of scripts written without spaces.
MASKS = ("111010011", "110101101", "101101110", "110011101")
SPAN = 9
SHORTEST = 5  # items with fewer words take no part
NEED, SHARE = 13, 0.75  # equal words that make an overlap; for short items this share of their words
MISS = -2  # weight of an unequal word against 1 of an equal one: a stretch has two thirds equal words at least
CONTEXT = 32
LEAST_BITS, MOST_BITS, PROBES = 16, 27, 3
MULTIPLIERS = multipliers(SPAN, 23)
ROOM = 150_000  # words a worker remembers
BATCH = 1 << 16  # words scanned at once
_UNSPACED = "\u0e00-\u0eff\u0f00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_WORD = re.compile(rf"[^\W_{_UNSPACED}]+|(?!_)[{_UNSPACED}](?<=\w)")


class _Hashes(dict):
    """A worker's memory of word hashes, of bounded size."""

    def __missing__(self, word: str) -> int:
        h = xxhash.xxh64_intdigest(word.encode(), 3)
        if len(self) < ROOM:
            self[word] = h
        return h


_hashes = _Hashes()


def tokens(text: str | None) -> np.ndarray:
    """Hashes of a text's words: letters and digits, in lower case; each letter of a script without spaces is a word."""
    words = _WORD.findall(text.lower()) if text else []
    if len(_hashes) >= ROOM:
        _hashes.clear()
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def products(words: np.ndarray) -> list[np.ndarray]:
    """Every word's share in a seed, for each place of a window."""
    with np.errstate(over="ignore"):
        return [words * m for m in MULTIPLIERS]


def seeds(shares: list[np.ndarray], mask: str) -> np.ndarray:
    """Seed of the window at every position, from the words' ``products``."""
    n = len(shares[0]) - len(mask) + 1
    if n <= 0:
        return shares[0][:0]
    h = np.full(n, np.uint64(int(mask, 2) * 2 + len(mask)))
    with np.errstate(over="ignore"):
        for k, bit in enumerate(mask):
            if bit == "1":
                h += shares[k][k:k + n]
    return mix(h)


def masks_of(length: int) -> tuple[str, ...]:
    """Masks for an item of so many words.

    An item shorter than a window is a window of its own, and its masks leave out words so that, wherever as many words
    differ as ``SHARE`` allows, some mask ignores them all: every single word in turn, or of eight words every two of the four pairs.
    """
    if length >= SPAN:
        return MASKS
    if length < SHORTEST:
        return ()
    if length < 8:
        return tuple("1" * i + "0" + "1" * (length - i - 1) for i in range(length))
    return tuple("".join("00" if p in gone else "11" for p in range(4)) for gone in combinations(range(4), 2))


def slots(h: np.ndarray, probe: int, bits: int) -> np.ndarray:
    """Place of each hash in the bitmap of 2 ** bits, for one of the probes."""
    return (h << np.uint64(18 * probe) >> np.uint64(64 - bits)).astype(np.int64)


def possible(h: np.ndarray, marks: np.ndarray, bits: int) -> np.ndarray:
    """Indexes of the hashes that the bitmap doesn't rule out."""
    may = np.arange(len(h))
    for probe in range(PROBES):
        place = slots(h[may], probe, bits)
        may = may[(marks[place >> 6] >> (place & 63).astype(np.uint64) & np.uint64(1)).astype(bool)]
    return may


def benchmark_seeds(benchmark: DataFrame) -> DataFrame:
    """(item_id, item_key, seed, item_pos, item_words, words), with one row per seed of every item; the key is a hash of its words."""
    def run(batches):
        for batch in batches:
            out = []
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
                w = tokens(text)
                shares, key = products(w), int(np.uint64(xxhash.xxh64_intdigest(w.tobytes(), 5)).view(np.int64))
                for mask in masks_of(len(w)):
                    out += [(item, key, s, p, len(w), w.view(np.int64) if not p else None)
                            for p, s in enumerate(seeds(shares, mask).view(np.int64).tolist())]
            cols = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (*[pa.int64()] * 5, pa.list_(pa.int64())))],
                                             ["item_id", "item_key", "seed", "item_pos", "item_words", "words"])

    plain = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    return plain.mapInArrow(run, "item_id long, item_key long, seed long, item_pos long, item_words long, words array<long>")


def bitmap(seed_rows: DataFrame, count: int) -> tuple[np.ndarray, int]:
    """Bitmap of the benchmark's seeds: at most 2 ** MOST_BITS bits (16 MB), whatever the benchmark's size."""
    bits = min(MOST_BITS, max(LEAST_BITS, (64 * count).bit_length()))

    def run(batches):
        for batch in batches:
            h = batch.column("seed").to_numpy().view(np.uint64)
            s = np.unique(np.concatenate([slots(h, probe, bits) for probe in range(PROBES)]))
            yield pa.RecordBatch.from_arrays([pa.array(s // 64), pa.array(s % 64)], ["word", "bit"])

    marks = seed_rows.select("seed").mapInArrow(run, "word long, bit long")
    table = marks.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, int(bit))")).alias("mask")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[table.column("word").to_numpy()] = table.column("mask").to_numpy().view(np.uint64)
    return out, bits


def best_stretch(equal: np.ndarray) -> tuple[int, int]:
    """Half-open stretch of largest weight (equal words 1, others ``MISS``)."""
    total = np.concatenate([[0], np.cumsum(np.where(equal, 1, MISS))])
    gain = total - np.minimum.accumulate(total)
    end = int(np.argmax(gain))
    return int(np.flatnonzero(total[:end + 1] == total[end] - gain[end])[-1]), end


def find_overlaps(docs: DataFrame, benchmark: DataFrame, null_ids: bool = False) -> DataFrame:
    """Overlaps of documents with benchmark items: doc_id, text_hash, item_id, start, length, equal_words.

    One row per document text and item (item_id and words): the best stretch of words on one diagonal, if at least ``NEED`` words of it (``SHARE``
    of a short item's words) are equal; ``start`` counts the document's words. Of an item shorter than a window (9 words) all words
    are compared, so 1 of 5 to 7 or 2 of 8 may differ. ``CONTEXT`` words on both sides of the hits are looked at: where a long stretch goes on
    without another hit, its end is not reported. Items with fewer than ``SHORTEST`` words, null and empty texts have no overlap. A null doc_id is reported as null (text_hash tells which text it was); repeated rows
    are reported once; further columns are ignored; an empty table on either side gives no row. Items are told apart by their words,
    so an item_id may occur with several texts. Items without an id take part with ``null_ids`` only, item_id null.
    """
    if not null_ids:
        benchmark = benchmark.where(F.col("item_id").isNotNull())
    items = Stored(benchmark_seeds(benchmark), "benchmark_seeds")
    count = items.df.count()
    marks, bits = bitmap(items.df, count)
    lengths = sorted(r[0] for r in items.df.where(F.col("item_words") < SPAN).select("item_words").distinct().collect())
    masks = (MASKS if items.df.where(F.col("item_words") >= SPAN).limit(1).count() else ()) + tuple(m for n in lengths for m in masks_of(n))

    def scan(texts: list[np.ndarray]) -> list[tuple[int, int, int]]:
        """(text, position, seed) of all windows that the bitmap doesn't rule out, over several texts at once."""
        ends = np.cumsum([len(w) for w in texts])
        shares, found = products(np.concatenate(texts)), []
        for mask in masks:
            s = seeds(shares, mask)
            at = possible(s, marks, bits)
            owner = np.searchsorted(ends, at, side="right")
            whole = at + len(mask) <= ends[owner] if len(at) else np.zeros(0, bool)  # no window reaches into the next text
            at, owner = at[whole], owner[whole]
            begin = ends[owner] - np.array([len(w) for w in texts])[owner]
            found += zip(owner.tolist(), (at - begin).tolist(), s[at].view(np.int64).tolist())
        return sorted(found)

    def run(batches):
        task, made = TaskContext.get().partitionId() << 40, 0
        for batch in batches:
            doc_ids, hashes = batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist()
            out, group, first, size = [], [], 0, 0
            for row, text in enumerate(batch.column("text").to_pylist()):
                group.append(tokens(text))
                size += len(group[-1])
                if size < BATCH and row + 1 < batch.num_rows:
                    continue
                hits = scan(group)
                i = 0
                while i < len(hits):  # hits close to one another share a stretch of words
                    j = i
                    while j + 1 < len(hits) and hits[j + 1][0] == hits[i][0] and hits[j + 1][1] - hits[j][1] <= CONTEXT:
                        j += 1
                    own, start = hits[i][0], max(0, hits[i][1] - CONTEXT)
                    words = group[own][start:hits[j][1] + SPAN + CONTEXT].view(np.int64)
                    out.append((task + made, doc_ids[first + own], hashes[first + own], start, words,
                                [{"seed": s, "pos": p} for _, p, s in hits[i:j + 1]]))
                    made += 1
                    i = j + 1
                group, first, size = [], row + 1, 0
            cols = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    names = ["stretch", "doc_id", "text_hash", "start", "words", "hits"]
    hit = pa.list_(pa.struct([("seed", pa.int64()), ("pos", pa.int64())]))
    types = [*[pa.int64()] * 4, pa.list_(pa.int64()), hit]
    schema = "stretch long, doc_id long, text_hash long, start long, words array<long>, hits array<struct<seed:long,pos:long>>"
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"))
    found = Stored(texts.mapInArrow(run, schema), "stretches")
    hits = found.df.select("stretch", F.explode("hits").alias("hit")).select("stretch", "hit.*")
    lined = (hits.join(items.df.select("seed", "item_key", "item_pos"), "seed")
             .select("stretch", "item_key", (F.col("pos") - F.col("item_pos")).alias("diagonal")).distinct())
    item_words = items.df.where("words is not null").groupBy("item_key").agg(F.first("words").alias("item"))
    both = lined.join(found.df.drop("hits"), "stretch").join(item_words, "item_key")

    def verify(batches):
        for batch in batches:
            out = []
            for doc, th, key, diagonal, start, words, item in zip(*(batch.column(c) for c in order)):
                w, it = words.values.to_numpy(), item.values.to_numpy()
                shift = diagonal.as_py() - start.as_py()  # place of the item's first word within the stretch
                lo, hi = max(0, shift), min(len(w), shift + len(it))
                if lo >= hi:
                    continue
                equal = w[lo:hi] == it[lo - shift:hi - shift]
                a, b = best_stretch(equal) if len(it) >= SPAN else (0, len(equal))
                same = int(equal[a:b].sum())
                if same >= min(NEED, int(np.ceil(SHARE * len(it)))):
                    out.append((doc.as_py(), th.as_py(), key.as_py(), start.as_py() + lo + a, b - a, same))
            cols = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], final)

    order = ["doc_id", "text_hash", "item_key", "diagonal", "start", "words", "item"]
    final = ["doc_id", "text_hash", "item_key", "start", "length", "equal_words"]
    checked = both.select(*order).mapInArrow(verify, ", ".join(f"{c} long" for c in final))
    best = F.max(F.struct("equal_words", (-F.col("start")).alias("back"), "length")).alias("best")
    ids = items.df.select("item_key", "item_id").distinct()
    return checked.groupBy("doc_id", "text_hash", "item_key").agg(best).join(ids, "item_key").select(
        "doc_id", "text_hash", "item_id", (-F.col("best.back")).alias("start"), "best.length", "best.equal_words")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, null_ids: bool = False) -> DataFrame:
    """The rows of ``docs``, all columns, whose text overlaps no benchmark item (``null_ids`` as in ``find_overlaps``)."""
    th = fresh(docs, "text_hash")
    found = find_overlaps(docs, benchmark, null_ids).select(F.col("doc_id").alias("found_id"), F.col("text_hash").alias("found_hash")).distinct()
    keyed = docs.withColumn(th, F.xxhash64(F.col("text").cast("string")))
    same = (keyed[th] == F.col("found_hash")) & keyed["doc_id"].cast("long").eqNullSafe(F.col("found_id"))
    return keyed.join(found, same, "left_anti").drop(th)
