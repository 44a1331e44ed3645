"""Near duplicates by b-bit MinHash, every link confirmed on the full shingle sets.

Texts with one and the same shingle set form a class. A class keeps ``BANDS`` x ``ROWS`` minima: bands of whole minima
name buckets, and the low ``BITS`` bits of each minimum are packed into a signature, from which the similarity of a candidate pair
is estimated by counting equal places, corrected for places equal by chance. Candidates well below the threshold go; the
rest is checked on the sets themselves.

No bucket is expanded into its pairs. First every member is compared with the bucket's first one, which joins a group of
near copies whatever its size; a pair inside one component can't change the result any more. Buckets that then still hold
several components (texts around a passage that very many share) are finished exactly: shingles are put into one
order, common ones last, and two texts can only reach the threshold if they share one of their first shingles, at places
that leave enough behind it. What is common to all of a hot group so never brings its members together.
At a similarity of 0.75 a pair misses all bands with a probability of 5e-6.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stored, components, drop_all, fresh, join_by_weight, plain_texts
from .words import mix, shingle_set

BANDS, ROWS, BITS = 32, 4, 4
PLACES = BANDS * ROWS
PER_LONG = 64 // BITS
LONGS = PLACES // PER_LONG
SLOTS = 1 << 20
GROUP = 64  # texts confirmed together with their centre in one task call
_STEP = 8192
_SEEDS = np.random.default_rng(11).integers(0, 2**31, (2, PLACES), dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def minima(shingles: np.ndarray) -> np.ndarray:
    """Minimum of every hash function over a non-empty shingle set."""
    x, low = (shingles >> np.uint64(32)).astype(np.uint32), np.full(PLACES, 2**32 - 1, np.uint32)
    for at in range(0, len(x), _STEP):
        part = x[at:at + _STEP]
        np.minimum(low, (_SEEDS[0][:, None] * part + _SEEDS[1][:, None]).min(axis=1), out=low)
    return low


def pack(low: np.ndarray) -> np.ndarray:
    """Low bits of every (mixed) minimum, packed into longs."""
    bits = mix(low.astype(np.uint64)) & np.uint64((1 << BITS) - 1)
    shifts = (np.arange(PER_LONG) * BITS).astype(np.uint64)
    return np.bitwise_or.reduce(bits.reshape(LONGS, PER_LONG) << shifts, axis=1).view(np.int64)


def band_keys(low: np.ndarray) -> np.ndarray:
    rows = low.astype(np.uint64).reshape(BANDS, ROWS)
    h = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        h = mix((h << np.uint64(1)) ^ rows[:, k] ^ (h >> np.uint64(7)))
    return h.view(np.int64)


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, and for a non-empty set its content key, packed signature and band keys."""
    def run(batches):
        for batch in batches:
            n, keys, packed, bands = [], [], [], []
            for text in batch.column("text").to_pylist():
                s = shingle_set(text, size)
                n.append(len(s))
                if len(s):
                    low = minima(s)
                    keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                    packed.append(pack(low))
                    bands.append(band_keys(low))
                else:
                    keys.append(None), packed.append(None), bands.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(packed, pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "set_key", "packed", "bands"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, set_key binary, packed array<long>, bands array<long>")


def estimate(a: Column, b: Column) -> Column:
    """Similarity estimated from two packed signatures, corrected for chance collisions of low bits."""
    ones = F.lit(int("1".zfill(BITS) * PER_LONG, 2))
    differ = F.lit(0)
    for i in range(LONGS):
        x = a[i].bitwiseXOR(b[i])
        any_bit = x
        for k in range(1, BITS):
            any_bit = any_bit.bitwiseOR(F.shiftrightunsigned(x, k))
        differ = differ + F.bit_count(any_bit.bitwiseAND(ones))
    chance = 1.0 / (1 << BITS)
    return ((F.lit(1.0) - differ / PLACES) - chance) / (1 - chance)


def near(percent: int) -> Column:
    """Can the pair (x, y) reach the threshold? By set sizes surely, by the estimate but for five standard deviations."""
    p = percent / 100
    least = p - 5 * (p * (1 - p) / PLACES) ** 0.5
    a, b = F.col("x.n"), F.col("y.n")
    return (100 * F.least(a, b) >= percent * F.greatest(a, b)) & (estimate(F.col("x.packed"), F.col("y.packed")) >= least)


def confirmed(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> Stored:
    """The pairs (a, b) whose full shingle sets reach the threshold.

    Texts travel once per centre ``a``, in groups of a bounded number of partners, so a centre with very many
    partners spreads over tasks.
    """
    pairs = Stored(pairs, "pairs")
    salts = pairs.df.groupBy("a").agg(F.ceil(F.count("b") / GROUP).alias("salts"))
    dealt = pairs.df.join(salts, "a").select("a", F.pmod(F.xxhash64("b"), F.col("salts")).alias("salt"), "b")
    roles = dealt.union(dealt.select("a", "salt", F.col("a").alias("b")).distinct())
    texts = roles.join(docs.select(F.col("doc_id").alias("b"), "text"), "b")

    def check(table: pa.Table) -> pa.Table:
        centre = table.column("a")[0].as_py()
        sets: dict[int, list[np.ndarray]] = {}
        for doc, text in zip(table.column("b").to_pylist(), table.column("text").to_pylist()):
            sets.setdefault(doc, []).append(shingle_set(text, size))
        own = sets.pop(centre, [])
        found = [doc for doc, other in sets.items() if any(linked(x, y, percent) for x in own for y in other)]
        return pa.table({"a": pa.array([centre] * len(found), pa.int64()), "b": pa.array(found, pa.int64())})

    out = Stored(texts.groupBy("a", "salt").applyInArrow(check, "a long, b long"), "links")
    pairs.drop()
    return out


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(x) + len(y) - both)


def prefix_pairs(texts: DataFrame, placed: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs (a, b) of different components, among the documents ``placed`` (id, component), that may reach the threshold.

    Shingles are ordered by how often their slot of a histogram of fixed size is hit: any order gives all pairs, this one puts
    common shingles last. Of n shingles the first n - ceil(p n) + 1 must hold one of a partner's; the smaller text of a pair needs fewer
    (``short_heads``).
    """
    def sets(batches):
        for batch in batches:
            found = [shingle_set(t, size).view(np.int64) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("component"), pa.array(found, pa.list_(pa.int64()))],
                                             ["id", "component", "shingles"])

    some = texts.select(F.col("doc_id").alias("id"), "text").join(placed, "id").select("id", "component", "text")
    held = Stored(some.mapInArrow(sets, "id long, component long, shingles array<long>"), "shingles")
    slots = held.df.select(F.explode("shingles").alias("s")).groupBy(F.col("s").bitwiseAND(SLOTS - 1).alias("slot")).count().toArrow()
    often = np.zeros(SLOTS, np.int64)
    often[slots.column("slot").to_numpy()] = slots.column("count").to_numpy()

    def heads(batches):
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for i, component, found in zip(batch.column("id").to_pylist(), batch.column("component").to_pylist(), batch.column("shingles")):
                s = found.values.to_numpy()
                n = len(s)
                first = s[np.lexsort((s, often[s & (SLOTS - 1)]))][:n - -(-percent * n // 100) + 1]
                for cells, values in zip(out, (first, np.full(len(first), i), np.full(len(first), component), np.arange(len(first)), np.full(len(first), n))):
                    cells.append(values)
            arrays = [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for c in out]
            yield pa.RecordBatch.from_arrays(arrays, ["shingle", "id", "component", "at", "n"])

    rows = Stored(held.df.mapInArrow(heads, "shingle long, id long, component long, at long, n long"), "heads")
    x, y = short_heads(rows.df, percent).alias("x"), rows.df.alias("y")
    behind = 1 + F.least(F.col("x.n") - 1 - F.col("x.at"), F.col("y.n") - 1 - F.col("y.at"))
    enough = (100 + percent) * behind >= percent * (F.col("x.n") + F.col("y.n"))
    alike = 100 * F.col("x.n") >= percent * F.col("y.n")
    smaller = (F.col("x.n") < F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.id") < F.col("y.id")))
    pairs = x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & smaller & (F.col("x.component") != F.col("y.component")) & alike & enough)
    return pairs.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()


def short_heads(rows: DataFrame, percent: int) -> DataFrame:
    """The part of the heads by which a text meets texts of at least its own size.

    Of two such texts the smaller one has 2 p / (1 + p) of its n shingles in common with the other, so their first common one is among
    its first n - ceil(2 p n / (1 + p)) + 1. A passage that makes up less of the smaller text than that share is behind them.
    """
    return rows.where((100 + percent) * (F.col("n") - F.col("at")) >= 2 * percent * F.col("n"))


def possibly_in(ids: DataFrame) -> Callable[[Column], Column]:
    """A test whether a doc_id may be among ``ids`` (doc_id): no for most others, never for one of them.

    A bitmap of at most 2 ** 27 bits, whatever the number of ids, so that a join moves the texts of those alone.
    """
    bits = min(27, max(16, (16 * ids.count()).bit_length()))
    slot = lambda c: F.shiftrightunsigned(F.xxhash64(c), 64 - bits)
    marks = ids.select(slot(F.col("doc_id")).alias("slot")).select(
        F.shiftright("slot", 6).alias("word"), F.expr("shiftleft(1L, int(slot & 63))").alias("bit"))
    table = marks.groupBy("word").agg(F.bit_or("bit").alias("mask")).toArrow()
    words = np.zeros(1 << (bits - 6), np.int64)
    words[table.column("word").to_numpy()] = table.column("mask").to_numpy()
    shared = ids.sparkSession.sparkContext.broadcast(words)

    @F.arrow_udf("boolean")
    def marked(slots: pa.Array) -> pa.Array:
        at = slots.to_numpy(zero_copy_only=False)
        return pa.array((shared.value[at >> 6] >> (at & 63) & 1).astype(bool))

    return lambda doc_id: marked(slot(F.coalesce(doc_id.cast("long"), F.lit(0))))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """Component of every document under links of 100 * |A and B| >= ``percent`` * |A or B| of word shingles.

    Returns per row: doc_id, n_shingles, component_id (smallest doc_id reachable), kept (doc_id = component_id). Texts
    without words (null, empty, white space) have no shingle and are linked with nothing. Rows of one doc_id count as one
    document. A row without doc_id is linked with nothing, has no component_id and is kept. Further columns are ignored; an
    empty table gives no row.
    """
    docs = plain_texts(docs)
    seen = Stored(sketches(docs, size), "sketches")
    named = seen.df.where("doc_id is not null and set_key is not null")
    classes = Stored(named.groupBy("set_key").agg(
        F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("packed").alias("packed"),
        F.first("bands").alias("bands")), "classes")
    rows = classes.df.select("id", F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.min("id").alias("centre"), F.count("id").alias("members")).where("members > 1")
    crowded = Stored(rows.join(shared, "key"), "crowded")
    signature = classes.df.select("id", "n", "packed")
    wanted = crowded.df.select(F.col("id").alias("doc_id")).distinct()
    texts = Stored(docs.where(possibly_in(wanted)(F.col("doc_id"))).join(wanted, "doc_id", "left_semi"), "candidate_texts")

    def candidates(pairs: DataFrame) -> DataFrame:
        with_a = pairs.join(signature.select(F.col("id").alias("a"), F.struct("n", "packed").alias("x")), "a")
        with_b = with_a.join(signature.select(F.col("id").alias("b"), F.struct("n", "packed").alias("y")), "b")
        return with_b.where(near(percent)).select("a", "b")

    stars = crowded.df.where("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct()
    first = confirmed(candidates(stars), texts.df, size, percent)
    joined = components(first.df)

    placed = crowded.df.where("members > 2").join(joined.df.withColumnRenamed("node", "id"), "id", "left")
    placed = placed.select("key", "id", F.coalesce("component", "id").alias("component"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    placed = placed.join(mixed.select("key"), "key", "left_semi").select("id", "component").distinct()
    second = confirmed(candidates(prefix_pairs(texts.df, placed, size, percent)), texts.df, size, percent)
    drop_all([crowded, texts])
    if second.df.limit(1).count():
        joined.drop()
        joined = components(first.df.union(second.df))
    drop_all([first, second])
    place = classes.df.select("set_key", "id").join(joined.df.withColumnRenamed("node", "id"), "id", "left")
    place = place.select("set_key", F.coalesce("component", "id").alias("component"))
    out = seen.df.select("doc_id", "n_shingles", "set_key").join(place, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """The rows of ``docs``, all columns, without those whose text is a near duplicate of one that comes before by (doc_id, text digest).

    Texts are told apart from one another also where they share a doc_id; of rows equal in both one is kept. Rows without
    doc_id stay.
    """
    digest, place = fresh(docs, "text_digest"), fresh(docs, "may_go")
    named, same_id = docs, F.col("doc_id").cast("long") == F.col("gone_id")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    hashes = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(97), text).alias("h2"))
    twice = Stored(hashes.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("rows"), ((F.min("h1") != F.max("h1")) | (F.min("h2") != F.max("h2"))).alias("several")).where("rows > 1"), "repeated_ids")
    several = not twice.df.where("several").isEmpty()
    if several:  # rare: only then texts are told apart by a digest
        named = docs.withColumn(digest, F.sha2(text.cast("binary"), 256))
        gone = _gone_texts(named, digest, twice.df.where("several").select("doc_id"), size, percent).df
        same = same_id & (F.col("gone_digest").isNull() | (F.col("gone_digest") == F.col(digest)))
    else:
        found = Stored(near_duplicates(docs, size, percent), "near")
        gone, same = found.df.where("not kept").select("doc_id").distinct(), same_id
    gone = gone.withColumnRenamed("doc_id", "gone_id")
    marked = named.withColumn(place, possibly_in(gone.select(F.col("gone_id").alias("doc_id")))(F.col("doc_id")))
    left = marked.where(~F.col(place)).union(marked.where(F.col(place)).join(gone, same, "left_anti")).drop(place)
    if not twice.df.isEmpty():
        again = F.col("doc_id").cast("long") == F.col("twice_id")
        ids = twice.df.select(F.col("doc_id").alias("twice_id"))
        left = left.join(ids, again, "left_anti").union(left.join(ids, again, "left_semi").dropDuplicates(["doc_id", digest] if several else ["doc_id"]))
    return left.drop(digest) if several else left


def _gone_texts(named: DataFrame, digest: str, several: DataFrame, size: int, percent: int) -> Stored:
    """(doc_id, gone_digest) of the texts to drop where some ids (``several``) have more than one text; a null digest means all of an id.

    For the search the texts of those ids get ids of their own, above all others.
    """
    plain = named.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col(digest).alias("own_digest"))
    plain = plain.where("doc_id is not null")
    most = plain.agg(F.max("doc_id")).first()[0]
    apart = Stored(plain.join(several, "doc_id", "left_semi").dropDuplicates(["doc_id", "own_digest"]).select(
        (F.lit(most + 1) + F.monotonically_increasing_id()).alias("own_id"), "doc_id", "own_digest", "text"), "texts_of_one_id")
    every = plain.join(several, "doc_id", "left_anti").select("doc_id", "text").unionByName(apart.df.select(F.col("own_id").alias("doc_id"), "text"))
    found = near_duplicates(every, size, percent).select(F.col("doc_id").alias("own_id"), "component_id").distinct()
    found = Stored(found.join(apart.df.drop("text"), "own_id", "left").withColumn("doc_id", F.coalesce("doc_id", "own_id")), "near")
    first = found.df.groupBy("component_id").agg(F.count(F.lit(1)).alias("members"), F.min(F.struct("doc_id", "own_digest")).alias("first"))
    first = Stored(first.where("members > 1"), "first")
    out = join_by_weight(found.df, first.df, "component_id", "members")
    out = out.where(~F.struct("doc_id", "own_digest").eqNullSafe(F.col("first"))).select("doc_id", F.col("own_digest").alias("gone_digest"))
    return Stored(out, "gone")
