"""Prefix trie of rebuilt conversations, from fingerprints that combine like the turns they stand for.

A rebuilt conversation is the head of a base conversation followed by a suffix of its own. Its texts are never put together: a run of turns is
an element (B ** n, t1 B + t2 B ** 2 + ... + tn B ** n) of a monoid modulo a prime, (b, g) * (c, h) = (b c, g + b h), so the fingerprint of any
rebuilt prefix is the head's element times what the own prefix leaves once its own head is divided out. Three primes make 93 bits.

Texts are read once, for the name of every stored turn (120 bits of SHA-256 of role and text) and its number of words; from then on a step
of a conversation refers to its stored turn by that name. The nodes are the groups of steps of one depth and fingerprint. A group is one
prefix exactly if all its steps refer to the same last turn: then their fingerprints without it agree too, and so on to the root. This
is checked for every group; if two prefixes ever met, the fit is repeated with another base B.

A conversation of any length is spread over range partitions: places and fingerprints are running sums within a partition, carried over the
few partitions a conversation spans. Sums over subtrees need no walk: every node belongs to the chain of its smallest member, so a node's
subtree is a tail of its own chain and the whole chains of those members that are split off further down.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Stored, drop_all, join_by_weight

GROUP, HEADS = 20, 4  # conversations of a base; heads have fewer turns than this
PRIMES = (2147483647, 2147483629, 2147483587)  # the greatest below 2 ** 31
G = ("g0", "g1", "g2")
CHAIN_BLOCK = 4096  # depths summed together before whole chains are
IDS_A_CHUNK = 512
WORD = r"[^\x20\x09-\x0D]+"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
MOST_FITS = 5


def _bases(attempt: int) -> list[int]:
    return [int(b) for b in np.random.default_rng([7, attempt]).integers(1 << 20, 1 << 30, len(PRIMES))]


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1), by doubling."""
    out = np.ones(max(n, 1), np.int64)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done:done + more] = out[:more] * pow(base, done, prime) % prime
        done += more
    return out


def _power(base: int, prime: int, exponent: Column) -> Column:
    """base ** exponent modulo prime, exponent below 2 ** 40."""
    squares = [pow(base, 1 << i, prime) for i in range(40)]
    table = F.lit(squares).cast("array<long>")

    def step(acc: Column, i: Column) -> Column:
        odd = F.call_function("shiftright", exponent, i).bitwiseAND(1) == 1
        return F.when(odd, F.pmod(acc * table[i], F.lit(prime))).otherwise(acc)

    return F.aggregate(F.sequence(F.lit(0), F.lit(39)), F.lit(1).cast("long"), step)


def head_turns(conv: Column) -> Column:
    return (F.crc32(conv.cast("string").cast("binary")) % HEADS).cast("int")


def turn_names(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, k1, k2 (120 bits of SHA-256 of role and text), words; rows without conv_id go. Texts end here."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    named = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256).alias("name"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    digits = lambda a: F.conv(F.substring("name", a, 15), 16, 10).cast("long")
    return named.select("conv_id", "turn", digits(1).alias("k1"), digits(16).alias("k2"), "words")


def places(turns: DataFrame, bases: list[int]) -> DataFrame:
    """Own turns in order, spread evenly whatever one conversation holds: part, conv_id, at, k1, k2, words, before_i, g_i.

    ``at`` counts the turns of a conversation in a partition from 1; g_i is the sum of t B ** at up to this turn, before_i without it.
    """
    ordered = turns.withColumn("row", F.monotonically_increasing_id())
    keys = ("conv_id", F.col("turn").asc_nulls_first(), "k1", "k2", "row")
    dealt = ordered.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("row", "turn")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, at, sums = TaskContext.get().partitionId(), None, 0, [0] * len(PRIMES)
        for batch in batches:
            if not batch.num_rows:
                continue
            conv, k1, k2, words = (batch.column(i).to_numpy() for i in range(4))
            rows = np.arange(len(conv))
            starts = np.concatenate([[True], conv[1:] != conv[:-1]])
            first = np.maximum.accumulate(np.where(starts, rows, 0))
            open_run = np.cumsum(starts) == 1  # may go on from the batch before
            if conv[0] != last:
                at, sums = 0, [0] * len(PRIMES)
            here = rows - first + 1
            place = here + np.where(open_run, at, 0)
            arrays = [pa.array(np.full(len(conv), part, np.int32)), *map(pa.array, (conv, place, k1, k2, words))]
            for i, (base, prime) in enumerate(zip(bases, PRIMES)):
                value = (k1 % prime * 3 + k2 % prime * 5 + k1 // prime % prime + i + 1) % prime
                powers = _powers(base, prime, int(here.max()) + 1)[here] * np.where(open_run, pow(base, at, prime), 1) % prime
                weighted = value * powers % prime
                running = np.cumsum(weighted)
                g = (running - (running - weighted)[first] + np.where(open_run, sums[i], 0)) % prime
                sums[i] = int(g[-1])
                arrays += [pa.array((g - weighted) % prime), pa.array(g)]
            last, at = conv[-1], int(place[-1])
            names = ["part", "conv_id", "at", "k1", "k2", "words", *[f"{x}{i}" for i in range(len(PRIMES)) for x in ("before", "g")]]
            yield pa.RecordBatch.from_arrays(arrays, names)

    sums_ = ", ".join(f"before{i} long, g{i} long" for i in range(len(PRIMES)))
    return dealt.mapInArrow(run, f"part int, conv_id long, at long, k1 long, k2 long, words long, {sums_}")


def steps(own: DataFrame, bases: list[int]) -> tuple[DataFrame, DataFrame, list[Stored]]:
    """Every turn of every rebuilt conversation, by reference, and how many turns each one has.

    Steps: conv_id, depth (from 1), f_i and p_i (fingerprints of the prefix and of its parent), k1, k2, words. Lengths: conv_id, depth.
    Last, the tables that both read.
    """
    def mod(c: Column, i: int) -> Column:
        return F.pmod(c, F.lit(PRIMES[i]))

    n = range(len(PRIMES))
    whole = own.groupBy("conv_id", "part").agg(F.max("at").alias("turns"), F.max_by(F.struct(*G), "at").alias("g"))
    along = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    segments = whole.withColumn("ahead", F.coalesce(F.sum("turns").over(along), F.lit(0)))
    for i in n:
        segments = segments.withColumn(f"b{i}", _power(bases[i], PRIMES[i], F.col("ahead")))
    for i in n:  # at most one term below 2 ** 31 for each partition
        segments = segments.withColumn(f"s{i}", mod(F.coalesce(F.sum(mod(F.col(f"b{i}") * F.col(f"g.{G[i]}"), i)).over(along), F.lit(0)), i))
    segments = Stored(segments.select("conv_id", "part", "turns", "ahead", *[f"b{i}" for i in n], *[f"s{i}" for i in n]), "segments")
    carry = own.where(F.col("at") < HEADS).join(segments.df, ["conv_id", "part"]).where(F.col("ahead") + F.col("at") < HEADS)
    placed = lambda x, i: mod(F.col(f"s{i}") + mod(F.col(f"b{i}") * F.col(f"{x}{i}"), i), i)
    turn = F.struct((F.col("ahead") + F.col("at")).cast("int").alias("depth"), *[placed("g", i).alias(G[i]) for i in n],
                    *[placed("before", i).alias(f"before{i}") for i in n], "k1", "k2", "words")
    firsts = carry.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("own"))  # at most three turns of a conversation
    convs = segments.df.groupBy("conv_id").agg(F.sum("turns").alias("turns")).join(firsts, "conv_id")
    base = firsts.where(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("base_id"), F.col("own").alias("base"))
    convs = convs.withColumns({"base_id": F.col("conv_id") - F.col("conv_id") % GROUP, "h": head_turns(F.col("conv_id"))}).join(base, "base_id", "left")
    head = F.slice(F.coalesce("base", F.filter("own", lambda t: F.lit(False))), F.lit(1), F.col("h"))
    convs = convs.withColumn("head", head)

    def last_sum(turns: Column, i: int) -> Column:
        return F.when(F.size(turns) > 0, F.element_at(turns, -1)[G[i]]).otherwise(0).cast("long")

    convs = convs.select("conv_id", "turns", "h", "head", F.size("head").alias("m"),
                         *[last_sum(F.col("head"), i).alias(f"head{i}") for i in n],
                         *[last_sum(F.slice("own", F.lit(1), F.col("h")), i).alias(f"cut{i}") for i in n])
    convs = Stored(convs, "conversations")
    constants = lambda base, prime, sign: F.lit([pow(base, sign * e, prime) for e in range(HEADS)]).cast("array<long>")

    def rebuilt(g: Column, i: int) -> Column:
        """Head's element times the own prefix ``g`` without its first h turns."""
        rest = mod(mod(g - F.col(f"cut{i}"), i) * constants(bases[i], PRIMES[i], -1)[F.col("h")], i)
        return mod(F.col(f"head{i}") + mod(rest * constants(bases[i], PRIMES[i], 1)[F.col("m")], i), i)

    from_head = convs.df.select("conv_id", F.inline("head")).select(
        "conv_id", F.col("depth").cast("long"), *[F.col(G[i]).alias(f"f{i}") for i in n], *[F.col(f"before{i}").alias(f"p{i}") for i in n],
        "k1", "k2", "words")
    held = segments.df.join(convs.df.drop("head", "turns"), "conv_id")
    later = own.join(held, ["conv_id", "part"]).where(F.col("ahead") + F.col("at") > F.col("h"))
    from_own = later.select(
        "conv_id", (F.col("ahead") + F.col("at") - F.col("h") + F.col("m")).alias("depth"), *[rebuilt(placed("g", i), i).alias(f"f{i}") for i in n],
        *[rebuilt(placed("before", i), i).alias(f"p{i}") for i in n], "k1", "k2", "words")
    ends = convs.df.select("conv_id", (F.greatest(F.col("turns") - F.col("h"), F.lit(0)) + F.col("m")).alias("depth"))
    return from_head.unionByName(from_own), ends, [segments, convs]


def digests(ends: DataFrame, key: list[str]) -> DataFrame:
    """``key`` and ends_sha256: SHA-256 of the conv_ids of a key in decimal, ascending, with commas.

    Ids are joined into chunks by range partitions, wherever a key's many ids lie; one task of a key then only streams its chunks
    through the digest, which has to see them one after the other.
    """
    names = [*key, "first", "ids"]
    kinds = ", ".join(f"{c} long" for c in key)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy() for c in [*key, "conv_id"]]
            rows = np.arange(batch.num_rows)
            new = np.concatenate([[True], np.any([c[1:] != c[:-1] for c in columns[:-1]], axis=0)])
            first = np.maximum.accumulate(np.where(new, rows, 0))
            cuts = np.nonzero((rows - first) % IDS_A_CHUNK == 0)[0]
            texts = [",".join(map(str, part.tolist())) for part in np.split(columns[-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(c[cuts]) for c in columns] + [pa.array(texts)], names)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None

        def out(done: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i == len(key) else pa.int64()) for i, c in enumerate(zip(*done))],
                                              [*key, "ends_sha256"])

        for batch in batches:
            done = []
            for *name, text in zip(*(batch.column(c).to_pylist() for c in [*key, "ids"])):
                if name != current:
                    if current is not None:
                        done.append((*current, state.hexdigest()))
                    current, state = name, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            if done:
                yield out(done)
        if current is not None:
            yield out([(*current, state.hexdigest())])

    order = [*key, "conv_id"]
    chunks = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(join, f"{kinds}, first long, ids string")
    return (chunks.repartition(*key).sortWithinPartitions(*key, "first").select(*key, "ids")
            .mapInArrow(digest, f"{kinds}, ends_sha256 string"))


FINGERPRINT, PARENT = [f"f{i}" for i in range(len(PRIMES))], [f"p{i}" for i in range(len(PRIMES))]
NODE = ["depth", *FINGERPRINT]


def fit(turns: DataFrame, attempt: int) -> tuple[Stored, Stored, Stored, bool]:
    """Steps (each conversation's root as depth 0 among them), lengths and nodes; whether every node is one prefix."""
    bases = _bases(attempt)
    own = Stored(places(turns, bases), "places")
    found, lengths, read = steps(own.df, bases)
    zero = F.lit(0).cast("long")
    root = lengths.select("conv_id", zero.alias("depth"), *[zero.alias(c) for c in (*FINGERPRINT, *PARENT, "k1", "k2", "words")])
    every = Stored(found.unionByName(root), "steps")
    lengths = Stored(lengths, "lengths")
    drop_all([own, *read])
    told = ("k1", "k2", *PARENT, "words")
    nodes = Stored(every.df.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("conv_id").alias("n_convs"), F.max("words").alias("words"),
        *[F.max(c).alias(c) for c in PARENT], *[(F.min(c) == F.max(c)).alias(f"same_{c}") for c in told]), "nodes")
    one = nodes.df.where(" or ".join(f"not same_{c}" for c in told)).isEmpty()
    return every, lengths, nodes, one


def parent_key(nodes: DataFrame, *columns: Column | str) -> DataFrame:
    """The key of every node's parent, with further columns."""
    return nodes.select((F.col("depth") - 1).alias("depth"), *[F.col(a).alias(b) for a, b in zip(PARENT, FINGERPRINT)], *columns)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations.

    ``conversations``: conv_id, turn, role, text. Conversation c is rebuilt as the first h = crc32(c) % 4 turns of conversation
    c - c % 20 (all it has, if fewer; none if it is absent) and its own turns after its first h. Returns conv_id (smallest
    member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves, saved_tokens (words of shared turns in the
    subtree) and ends_sha256.

    Turns go by ``turn``, null first; equal ones by the SHA-256 of role and text; repeated rows are turns of their own. Null roles and
    texts count as empty. Rows without conv_id take no part. For negative ids % has the sign of SQL. Long texts are read once, long
    conversations are spread over partitions. Further columns are ignored; an empty table has no node, not even a root.
    """
    turns = Stored(turn_names(conversations), "turns")
    for attempt in range(MOST_FITS):
        every, lengths, nodes, one = fit(turns.df, attempt)
        if one:
            break
        drop_all([every, lengths, nodes])
    else:
        raise RuntimeError("prefixes can't be told apart")
    turns.drop()
    below = parent_key(nodes.df.where("depth > 0")).groupBy(*NODE).agg(F.count(F.lit(1)).alias("n_children"))
    sized = nodes.df.select(*NODE, *PARENT, "conv_id", "n_convs", "words").join(below, NODE, "left")
    sized = Stored(sized.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "sized")
    nodes.drop()

    # Tails of chains: sums from a depth on, over blocks of depths first.
    none = F.lit(0).cast("long")
    blocked = sized.df.withColumns({"worth": (F.col("n_convs") - 1) * F.col("words"), "leaf": (F.col("n_children") == 0).cast("long"),
                                    "block": F.floor(F.col("depth") / CHAIN_BLOCK)})
    blocks = blocked.groupBy("conv_id", "block").agg(F.sum("worth").alias("worth"), F.sum("leaf").alias("leaf"), F.min("depth").alias("top"))
    after = Window.partitionBy("conv_id").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = Stored(blocks.withColumns({f"{c}_after": F.coalesce(F.sum(c).over(after), none) for c in ("worth", "leaf")}), "blocks")
    inside = Window.partitionBy("conv_id", "block").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    tails = blocked.withColumns({f"{c}_tail": F.sum(c).over(inside) for c in ("worth", "leaf")}).join(
        blocks.df.select("conv_id", "block", "worth_after", "leaf_after"), ["conv_id", "block"])

    # Whole chains split off below: every step of a conversation above the top of its own chain.
    chains = Stored(blocks.df.groupBy("conv_id").agg(F.min("top").alias("top"), F.sum("worth").alias("worth"), F.sum("leaf").alias("leaf"))
                    .where("top > 0"), "chains")
    upper = chains.df.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("top") - 1) / CHAIN_BLOCK))))
    hung = (every.df.select("conv_id", *NODE, F.floor(F.col("depth") / CHAIN_BLOCK).alias("block")).join(upper, ["conv_id", "block"])
            .where("depth < top").groupBy(*NODE).agg(F.sum("worth").alias("worth_below"), F.sum("leaf").alias("leaf_below")))

    # A parent has another smallest member only at the top of a chain.
    tops = parent_key(sized.df.join(chains.df.select("conv_id", F.col("top").alias("depth")), ["conv_id", "depth"]), F.col("conv_id").alias("top_id"))
    weighed = sized.df.where("n_children > 0").select(*NODE, F.col("conv_id").alias("parent"), F.col("n_children").alias("weight"))
    parents = join_by_weight(tops, weighed, NODE, "weight").select(F.col("top_id").alias("conv_id"), (F.col("depth") + 1).alias("depth"), "parent")
    ended = digests(every.df.join(lengths.df, ["conv_id", "depth"]).select("conv_id", *NODE), NODE)
    out = tails.join(hung, NODE, "left").join(ended, NODE, "left").join(parents, ["conv_id", "depth"], "left")
    return out.select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("parent", "conv_id")).alias("parent_conv_id"), "n_convs", "n_children",
        (F.col("leaf_tail") + F.col("leaf_after") + F.coalesce("leaf_below", none)).alias("n_leaves"),
        (F.col("worth_tail") + F.col("worth_after") + F.coalesce("worth_below", none)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))
