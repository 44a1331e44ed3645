"""Registry of runnable queries and their independent SQL, plus the tables they read."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.common import settle

Query = Callable[["Tables"], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is the equivalent written independently for a SQL engine."""
    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return keep


class Tables:
    """The stored tables of one data folder and the views derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._kept: dict[str, DataFrame] = {}

    def once(self, name: str, make: Callable[["Tables"], DataFrame]) -> DataFrame:
        """A derived table several steps of one query read, evaluated a single time."""
        if name not in self._kept:
            self._kept[name] = settle(make(self))
        return self._kept[name]

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def base(self) -> DataFrame:
        """All vectors: id, embedding."""
        return self.read("embeddings").select(F.col("vec_id").alias("id"), "embedding")

    @cached_property
    def queries(self) -> DataFrame:
        """One query per vector, its mirror image along the dimensions (so not itself a member)."""
        return self.read("embeddings").select(
            F.col("vec_id").alias("query_id"), F.reverse("embedding").alias("query_vec"))

    @cached_property
    def n(self) -> int:
        return self.base.count()

    @cached_property
    def hits(self) -> DataFrame:
        """Orders read as aligner hits between vectors: customer -> query, order -> subject."""
        n = self.n
        orders = self.read("orders")
        key, cust = F.col("o_orderkey"), F.col("o_custkey")
        length = (100 + F.pmod(key, F.lit(50))).cast("int")
        return orders.select(
            F.pmod(cust, F.lit(n)).alias("query"), F.pmod(key, F.lit(n)).alias("subject"),
            (F.pmod(key * 7, F.lit(1001)).cast("double") / 10).alias("pident"),
            length.alias("length"), F.pmod(key, F.lit(7)).cast("int").alias("mismatch"),
            F.pmod(key, F.lit(3)).cast("int").alias("gapopen"), F.lit(1).alias("qstart"),
            length.alias("qend"), F.lit(1).alias("sstart"), length.alias("send"),
            (F.pmod(cust, F.lit(21)).cast("double") / 1000).alias("evalue"),
            F.floor(F.col("o_totalprice") / 1000).cast("double").alias("bitscore"),
            key.alias("hit_seq"))

    @cached_property
    def annotations(self) -> DataFrame:
        """Per vector: family names from id and label, EC numbers from the id; label 0 has none."""
        name = lambda prefix, c: F.concat(F.lit(prefix), c.cast("string"))
        v, label = F.col("vec_id"), F.col("label")
        none = F.array().cast("array<string>")
        domains = F.array_distinct(F.array(name("PF", v % 7), name("PF", v % 5), name("PF", label)))
        return self.read("embeddings").select(
            v.alias("id"), F.when(label == 0, none).otherwise(domains).alias("domains"),
            F.when(label == 0, none).otherwise(F.array(name("EC", v % 11))).alias("ec_numbers"))

    @cached_property
    def sequences(self) -> DataFrame:
        """Documents read as raw sequences: id, seq."""
        return self.read("documents").select(F.col("doc_id").alias("id"), F.col("text").alias("seq"))

    @cached_property
    def tokens(self) -> DataFrame:
        """Vectors in groups of eight read as token representations, the last ones as padding."""
        group, pos = F.floor(F.col("vec_id") / 8).cast("bigint"), F.col("vec_id") % 8
        return self.read("embeddings").select(
            group.alias("id"), pos.cast("int").alias("pos"), (pos >= 3 + group % 6).alias("is_pad"),
            "embedding")

    @cached_property
    def edges(self) -> DataFrame:
        """Orders read as directed edges between vectors: src, dst (loops and repeats occur)."""
        return self.hits.select(F.col("query").alias("src"), F.col("subject").alias("dst"))


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Six decimals, the precision results are compared at."""
    return df.withColumns({c: F.round(c, 6) for c in columns or ("distance",)})


def joined(column: str) -> Column:
    """Array column as text, in the order of the array."""
    return F.array_join(column, ",").alias(column)


def joined_set(column: str) -> Column:
    """Set-like array column as text, sorted."""
    return F.array_join(F.sort_array(column), ",").alias(column)
