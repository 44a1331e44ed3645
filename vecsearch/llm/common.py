"""Helpers the pipeline operators share: stored intermediate tables, plain columns, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.common import remove_path, scratch_path

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


class Stored:
    """A table written once to the shared scratch folder: cuts lineage, survives lost executors."""

    def __init__(self, df: DataFrame, name: str):
        self.spark, self.path = df.sparkSession, scratch_path(df.sparkSession, name)
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        """Delete the folder once nothing reads it any more."""
        remove_path(self.spark, self.path)


def drop_all(stored: Iterable[Stored]) -> None:
    for s in stored:
        s.drop()


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def plain_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) alone, so that further columns of any name can't clash."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    return name if name not in df.columns else f"{name}_{uuid.uuid4().hex[:8]}"


def hash_sample(df: DataFrame, group: str, key: str, n: int, most_groups: int = 256) -> DataFrame:
    """The ``n`` rows of smallest hash of ``key`` in every group; ``df`` has one row per group and key.

    A group is thinned by the hash itself to about ``4 n`` rows before its rows meet, whatever its size. Groups are the classes
    of a model: the ``most_groups`` largest are used, and one count of each reaches the driver.
    """
    largest = df.where(F.col(group).isNotNull()).groupBy(group).count().orderBy(F.desc("count"), group).limit(most_groups)
    sizes = {r[0]: r[1] for r in largest.collect()}
    if not sizes:
        return df.limit(0)
    slot = F.pmod(F.xxhash64(key), F.lit(1 << 32))
    share = F.create_map(*[F.lit(x) for g, size in sizes.items() for x in (g, int((1 << 32) * min(1.0, (4 * n + 200) / size)))])
    order = Window.partitionBy(group).orderBy(slot, key)
    place = fresh(df, "place")
    return df.where(slot <= share[F.col(group)]).withColumn(place, F.row_number().over(order)).where(F.col(place) <= n).drop(place)


HEAVY = 1000


def join_by_weight(rows: DataFrame, keyed: DataFrame, on: str | list[str], weight: str) -> DataFrame:
    """Inner join of ``rows`` with ``keyed``: one row per key, and in ``weight`` (dropped) how many of ``rows`` have that key.

    Keys with more than a thousandth of all weight are fewer than a thousand, so those are broadcast and their rows stay where they
    are; the others are joined by shuffle, where no key has more than that share. ``keyed`` is read several times.
    """
    on = [on] if isinstance(on, str) else on
    most = (keyed.agg(F.sum(weight)).first()[0] or 0) // HEAVY
    heavy, light = keyed.where(F.col(weight) > most), keyed.where(F.col(weight) <= most)
    here = rows.join(F.broadcast(heavy.drop(weight)), on)
    rest = rows.join(F.broadcast(heavy.select(*on)), on, "left_anti").join(light.drop(weight), on)
    return here.unionByName(rest)


def components(edges: DataFrame) -> Stored:
    """(node, component): the smallest node reachable over the undirected ``edges`` (a, b).

    Rounds of contraction: every node points to the neighbour (or itself) of lowest random priority,
    pointers are followed to their fourth ancestor, and the edges are rewritten between those. With new
    priorities in each round a constant share of the nodes goes, so rounds grow with the logarithm of the size
    whatever the shape (chains, stars). Sums by key combine before the shuffle; nothing reaches the
    driver but a row count.
    """
    step = Stored(edges.select("a", "b").where("a <> b").distinct(), "edges")
    start, total = step, None  # total: (node, at), the contracted place of every node so far
    turn = 0
    while step.df.limit(1).count():
        turn += 1
        both = step.df.union(step.df.select(F.col("b").alias("a"), F.col("a").alias("b")))
        mark = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("p"), F.col(c).alias("v"))
        up = (both.groupBy(F.col("a").alias("v")).agg(F.min(mark("b")).alias("low"), F.first(mark("a")).alias("own"))
              .select("v", F.least("low", "own")["v"].alias("up")))
        up = Stored(up, "parents")
        jump = up
        for _ in range(2):
            nxt = jump.df.alias("x").join(jump.df.alias("y"), F.col("x.up") == F.col("y.v"))
            nxt = Stored(nxt.select("x.v", F.col("y.up").alias("up")), "parents")
            jump.drop()
            jump = nxt
        if total is None:
            now = Stored(jump.df.select(F.col("v").alias("node"), F.col("up").alias("at")), "places")
        else:
            now = total.df.join(jump.df, F.col("at") == F.col("v"), "left")
            now = Stored(now.select("node", F.coalesce("up", "at").alias("at")), "places")
            total.drop()
        total = now
        a, b = (jump.df.select(F.col("v").alias(c), F.col("up").alias(f"up_{c}")) for c in "ab")
        left = step.df.join(a, "a").join(b, "b").where("up_a <> up_b")
        left = left.select(F.least("up_a", "up_b").alias("a"), F.greatest("up_a", "up_b").alias("b")).distinct()
        nxt = Stored(left, "edges")
        if step is not start:
            step.drop()
        jump.drop()
        step = nxt
    if total is None:
        nodes = start.df.select(F.col("a").alias("node"), F.col("a").alias("component"))
        return Stored(nodes, "components")
    least = total.df.groupBy("at").agg(F.min("node").alias("component"))
    out = Stored(total.df.join(least, "at").select("node", "component"), "components")
    drop_all({start, step, total})
    return out
