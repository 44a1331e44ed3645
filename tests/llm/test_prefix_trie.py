"""The prefix trie against a plain one."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from vecsearch.llm import prefix_trie as trie
from vecsearch.llm.prefix_trie import PRIMES, digests, places, prefix_trie, turn_names

TALK = "conv_id long, turn long, role string, text string, depth string, f0 string, k1 string, part string, words string"


def talks(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 5) for r in rows], TALK)


def brute(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, name, role, text))
    plain = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    built = {}
    for c in plain:
        h = zlib.crc32(str(c).encode()) % 4
        base = plain.get(c - int(abs(c) % 20) * (1 if c >= 0 else -1), [])
        built[c] = tuple(base[:h] + plain[c][h:])
    members, ends = {}, {}
    for c, turns in built.items():
        ends.setdefault(turns, []).append(c)
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    saved, leaves = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for path in members:
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] += (len(members[path]) - 1) * words
            leaves[path[:d]] += path not in children
    return sorted((min(m), len(path), min(members[path[:-1]]) if path else -1, len(m), len(children.get(path, [])), leaves[path], saved[path],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(path, [])))).encode()).hexdigest()) for path, m in members.items())


def found(df):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.select(*columns).collect())


@pytest.fixture
def many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def some(rnd, convs, turns, words="ab"):
    return [(c, t, rnd.choice(["user", "assistant"]), " ".join(rnd.choices(words, k=rnd.randint(0, 2))))
            for c in convs for t in range(rnd.randint(1, turns))]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain_trie(spark, seed):
    rnd = random.Random(seed)
    rows = some(rnd, range(70), 6) + some(rnd, range(1000, 1040), 3)
    rnd.shuffle(rows)
    assert found(prefix_trie(talks(spark, rows).repartition(5))) == brute(rows)


def test_odd_rows(spark):
    rows = [(0, None, "user", "null turn first"), (0, 0, None, "a  b\tc"), (0, 5, "user", None), (1, 1, "user", "x"), (1, 1, "assistant", "x"), (1, 1, "user", "x"),
            (None, 1, "user", "nobody's"), (-7, 0, "user", "below zero"), (-20, 0, "user", "base below zero"), (40, 0, "", ""), (43, 0, "u", "absent base"),
            (41, 3, "userx", ""), (41, 4, "user", "x"), (60, 1, "user", "lange Rede " * 100_000), (61, 1, "user", "lange Rede " * 100_000)]
    rows += [(c, t, "user", f"{c} {t}") for c in range(100, 140, 9) for t in range(2)]
    assert found(prefix_trie(talks(spark, rows).repartition(3))) == brute(rows)
    none = prefix_trie(talks(spark, [(None, 1, "user", "x")]))
    assert none.count() == 0 and none.columns[0] == "conv_id" and prefix_trie(talks(spark, [])).count() == 0


def test_hot_conversation_copies_and_first_turn(spark, many_partitions, monkeypatch):
    monkeypatch.setattr(trie, "CHAIN_BLOCK", 64)
    monkeypatch.setattr(trie, "IDS_A_CHUNK", 16)
    rnd = random.Random(7)
    long = [(t, "user", f"t{t % 20}") for t in range(300)]
    rows = [(c, *t) for c in (7, 20, 27, 333) for t in long]  # two thirds of all rows; h of some cuts into them
    rows += [(c, t, "user", "same" if t == 0 else f"{c}") for c in range(400, 600) for t in range(rnd.randint(1, 3))]
    rows += [(c, 0, "user", "one and all") for c in range(2000, 2400)]
    rows += [(5, 1, "user", "again")] * 200
    df = prefix_trie(talks(spark, rows).repartition(6))
    assert found(df) == brute(rows)


def test_places_are_running_sums_over_partitions(spark, many_partitions):
    rows = [(3, t, "u", f"{t}") for t in range(5000)] + [(c, 0, "u", "x") for c in range(10, 200)]
    bases = trie._bases(0)
    got = places(turn_names(talks(spark, rows).repartition(4)), bases).orderBy("conv_id", "part", "at").collect()
    assert len({r.part for r in got if r.conv_id == 3}) > 1  # a hot conversation is not one partition's
    for i, prime in enumerate(PRIMES):
        part, g = None, 0
        for r in got:
            if (r.conv_id, r.part) != part:
                part, g = (r.conv_id, r.part), 0
            value = (r.k1 % prime * 3 + r.k2 % prime * 5 + r.k1 // prime % prime + i + 1) % prime
            assert r[f"before{i}"] == g
            g = (g + value * pow(bases[i], r["at"], prime)) % prime
            assert r[f"g{i}"] == g


def test_meeting_prefixes_are_noticed_and_fitted_again(spark, monkeypatch):
    rows = some(random.Random(3), range(60), 5)
    real, tried = trie._bases, []

    def bases(attempt):
        tried.append(attempt)
        return [1] * len(PRIMES) if attempt == 0 else real(attempt)  # with base 1 the order of turns makes no difference

    monkeypatch.setattr(trie, "_bases", bases)
    monkeypatch.setattr(trie, "head_turns", lambda c: F.lit(0))
    monkeypatch.setattr(zlib, "crc32", lambda b: 0)
    assert found(prefix_trie(talks(spark, rows))) == brute(rows) and tried == [0, 1]


def test_digest_of_many_ids(spark, many_partitions, monkeypatch):
    monkeypatch.setattr(trie, "IDS_A_CHUNK", 7)
    ends = spark.range(3000).select(F.col("id").alias("conv_id"), (F.col("id") % 3 == 0).cast("long").alias("k"), F.lit(1).cast("long").alias("j"))
    got = {r.k: r.ends_sha256 for r in digests(ends.repartition(9), ["k", "j"]).collect()}
    want = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert got == {1: want(range(0, 3000, 3)), 0: want(i for i in range(3000) if i % 3)}
