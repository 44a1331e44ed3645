"""Operators on the k-nearest-neighbour graph (edge tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def clean_edges(edges: DataFrame) -> DataFrame:
    """Drop self loops and repeated edges: src, dst."""
    return edges.where("src <> dst").select("src", "dst").distinct()


def edge_weights(edges: DataFrame) -> DataFrame:
    """How many directions each unordered pair occurs in: a, b, directions."""
    return edges.groupBy(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).agg(
        F.count("*").alias("directions"))


def symmetrize(edges: DataFrame) -> DataFrame:
    """Undirected graph, both directions listed: src, dst, weight (2 mutual, 1 one-way)."""
    pairs = edge_weights(clean_edges(edges)).select(
        "a", "b", F.when(F.col("directions") == 2, 2).otherwise(1).alias("weight"))
    both = F.explode(F.array(F.struct(F.col("a").alias("src"), F.col("b").alias("dst")),
                             F.struct(F.col("b").alias("src"), F.col("a").alias("dst"))))
    return pairs.select(both.alias("e"), "weight").select("e.src", "e.dst", "weight")


def graph_inconsistencies(edges: DataFrame) -> DataFrame:
    """Edges without an equal reverse edge: src, dst, weight, reverse_weight, reason.

    One shuffle: both directions of a pair meet under the unordered pair, no self join.
    """
    pair = edges.withColumn("a", F.least("src", "dst")).withColumn("b", F.greatest("src", "dst"))
    same = Window.partitionBy("a", "b")
    forward, back = F.col("src") == F.col("a"), F.col("src") == F.col("b")
    looked = pair.withColumn("w_forward", F.max(F.when(forward, F.col("weight"))).over(same)) \
                 .withColumn("w_back", F.max(F.when(back, F.col("weight"))).over(same))
    reverse = F.when(forward, F.col("w_back")).otherwise(F.col("w_forward"))
    reason = F.when(reverse.isNull(), "missing").when(reverse != F.col("weight"), "weight")
    return looked.select("src", "dst", "weight", reverse.alias("reverse_weight"),
                         reason.alias("reason")).where("reason is not null")


def is_consistent(edges: DataFrame) -> bool:
    """True if the graph is perfectly symmetric."""
    return graph_inconsistencies(edges).isEmpty()


def csr_offsets(edges: DataFrame, n: int, bucket: int = 100_000) -> DataFrame:
    """Offset range of every node 0..n-1: node, start_off, end_off, node_weight.

    The running sum is taken in two passes: inside node ranges of ``bucket`` nodes, and over the
    (short) list of range totals, so no window ever holds the whole node list.
    """
    spark = edges.sparkSession
    degree = edges.groupBy(F.col("src").alias("node")).agg(F.count("*").alias("degree"))
    nodes = (
        spark.range(n).withColumnRenamed("id", "node").join(degree, "node", "left")
        .select("node", F.coalesce("degree", F.lit(0)).alias("degree"),
                F.floor(F.col("node") / bucket).alias("part"))
    )
    inside = Window.partitionBy("part").orderBy("node").rowsBetween(Window.unboundedPreceding, 0)
    # n / bucket rows in one partition.
    over = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = nodes.groupBy("part").agg(F.sum("degree").alias("total")).select(
        "part", F.coalesce(F.sum("total").over(over), F.lit(0)).alias("offset"))
    return (
        nodes.withColumn("upto", F.sum("degree").over(inside)).join(starts, "part")
        .select("node", (F.col("offset") + F.col("upto") - F.col("degree")).alias("start_off"),
                (F.col("offset") + F.col("upto")).alias("end_off"),
                F.lit(1).cast("bigint").alias("node_weight"))
    )


def csr_adjacency(edges: DataFrame, n: int, bucket: int = 100_000) -> DataFrame:
    """The neighbour list behind the offsets: pos (0-based), node, neighbor, weight, in the order of (node, neighbor).

    ``edges``: src, dst, weight without repeats. A second running sum numbers the edges of a node: inside ranges of ``bucket``
    neighbours, and over the range totals of each node, so a node of any degree is spread over tasks.
    """
    ranged = edges.select("src", "dst", "weight", F.floor(F.col("dst") / bucket).alias("part"))
    before = Window.partitionBy("src").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("src", "part").agg(F.count("*").alias("members")).withColumn(
        "ahead", F.coalesce(F.sum("members").over(before), F.lit(0)))
    offsets = csr_offsets(edges, n, bucket).select(F.col("node").alias("src"), "start_off")
    placed = starts.join(offsets, "src").select("src", "part", (F.col("start_off") + F.col("ahead")).alias("first"))
    inside = Window.partitionBy("src", "part").orderBy("dst")
    return ranged.join(placed, ["src", "part"]).select(
        (F.col("first") + F.row_number().over(inside) - 1).alias("pos"), F.col("src").alias("node"), F.col("dst").alias("neighbor"), "weight")


def graph_counts(edges: DataFrame) -> DataFrame:
    """One row: n_nodes, n_edges (unordered pairs)."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct().agg(
        F.count("*").alias("n_nodes"))
    pairs = edges.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))
    return ends.select("n_nodes", pairs.distinct().agg(F.count("*")).scalar().alias("n_edges"))


def sample_subgraph(edges: DataFrame, max_nodes: int, seed: int = 42, sampling: str = "hash") -> DataFrame:
    """Edges among a sample of ``max_nodes`` nodes; the whole graph if it is not larger.

    ``sampling``: ``hash`` (seeded order) or ``lowest`` (smallest ids).
    """
    nodes = edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    if nodes.count() <= max_nodes:
        return edges
    order = [F.xxhash64("node", F.lit(seed)), F.col("node")] if sampling == "hash" else [F.col("node")]
    kept = nodes.orderBy(*order).limit(max_nodes)
    return edges.join(kept.withColumnRenamed("node", "src"), "src", "left_semi").join(
        kept.withColumnRenamed("node", "dst"), "dst", "left_semi").select(*edges.columns)
