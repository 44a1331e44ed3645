"""Learned partition index: k-means partitions, a classifier that predicts them, top-T lookup."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.hashing import dimension
from ..sources.index_store import Index, fingerprint, load_index, save_index
from .classifier import HISTORY, PartitionNet, train_epochs
from .common import SMALL_CENTROID_ROWS, arrow_column, evaluated, fetch_if_small, settle, type_of
from .ivf import assign_nearest, kmeans, search_cells
from .kernels import BLOCK_CELLS, matrix


@dataclass(frozen=True)
class LearnedParams:
    partitions: int = 100
    probes: int = 5
    epochs: int = 10
    seed: int = 42
    restarts: int = 10
    max_iter: int = 100


# Fixed values of the classifier: widest hidden layer, training share.
MAX_HIDDEN = 256
TRAIN_SHARE = 0.8


def partition_labels(base: DataFrame, centroids: DataFrame) -> DataFrame:
    """The input with its partition ``part``, numbered densely from 0 over non-empty cells."""
    assigned = assign_nearest(base, centroids)
    # One row per cell; the unpartitioned window only ever sees the cell list.
    dense = assigned.select("cell").distinct().select(
        "cell", (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("cell")) - 1).alias("part"))
    table = fetch_if_small(dense, SMALL_CENTROID_ROWS)
    if table is None:
        return assigned.join(dense, "cell").drop("cell")
    cells, parts = table["cell"].to_numpy(), table["part"].to_numpy().astype(np.int32)
    order = np.argsort(cells)
    cells, parts = cells[order], parts[order]

    @arrow_column("int")
    def part(column: pa.Array) -> pa.Array:
        return pa.array(parts[np.searchsorted(cells, column.to_numpy())], pa.int32())

    return assigned.withColumn("part", part(F.col("cell"))).drop("cell")


def train_partition_model(labelled: DataFrame, epochs: int = 10, seed: int = 42, path: str | None = None) -> tuple[PartitionNet, DataFrame]:
    """Two-hidden-layer classifier of ``part`` and its quality, one row per epoch (see ``fit_quality``); 80 % of the rows train it.

    ``path`` keeps the state after every epoch, so that a broken run goes on where it was.
    """
    labelled = evaluated(labelled)
    dim = dimension(labelled)
    n_parts = labelled.agg(F.max("part").alias("top")).first()["top"] + 1
    model = train_epochs(labelled, max(n_parts, 2), dim, min(MAX_HIDDEN, 2 * dim), epochs, seed, TRAIN_SHARE, path=path)
    return model, fit_quality(model, labelled.sparkSession)


def fit_quality(model: PartitionNet, spark: SparkSession) -> DataFrame:
    """One row per epoch: epoch, train_loss, val_loss, val_accuracy (percent), best_accuracy so far; nulls where no row was held out."""
    return spark.createDataFrame([(h[0], *(None if v is None else float(v) for v in h[1:])) for h in model.history], HISTORY)


def save_learned(path: str, model: PartitionNet, labelled: DataFrame, params: dict | None = None) -> None:
    """Store the classifier, its history, parameters and the labelled base (laid out by partition) as one version of an index.

    All tables get into use together, with the row that names the version; a run broken off before leaves the former pair.
    """
    spark = labelled.sparkSession
    layers = spark.createDataFrame([(i, list(w.shape), w.ravel().tolist()) for i, w in enumerate(model.weights)],
                                   "layer int, shape array<int>, weights array<double>")
    kept = {"learned": params or {}, "fingerprint": fingerprint(labelled)}
    save_index(Index({"labelled": labelled, "model": layers.coalesce(1), "history": fit_quality(model, spark).coalesce(1)}, kept), path)


def load_learned(spark: SparkSession, path: str) -> tuple[PartitionNet, DataFrame]:
    """(model, labelled) as ``save_learned`` stored them, so that nothing is trained again."""
    model, labelled, _ = open_learned(spark, path)
    return model, labelled


def open_learned(spark: SparkSession, path: str) -> tuple[PartitionNet, DataFrame, dict]:
    """(model, labelled, parameters with the data fingerprint) of the newest complete version."""
    index = load_index(spark, path)
    layers = index.tables["model"].orderBy("layer").collect()
    history = [tuple(r) for r in index.tables["history"].orderBy("epoch").collect()]
    return PartitionNet([np.array(r["weights"]).reshape(r["shape"]) for r in layers], history), index.tables["labelled"], index.params


def learned_or_train(spark: SparkSession, path: str, labelled: DataFrame, p: LearnedParams, rebuild: bool = False) -> tuple[PartitionNet, DataFrame, bool]:
    """(model, labelled, reused): the stored pair if parameters and labelled rows are unchanged, else trained and stored anew."""
    if not rebuild:
        try:
            model, stored, kept = open_learned(spark, path)
            if kept == json.loads(json.dumps({"learned": asdict(p), "fingerprint": fingerprint(labelled)})):
                return model, stored, True
        except AnalysisException:
            pass
    model, _ = train_partition_model(labelled, p.epochs, p.seed)
    save_learned(path, model, labelled, asdict(p))
    return model, load_learned(spark, path)[1], False


def _scored(model: PartitionNet, queries: DataFrame, t: int) -> DataFrame:
    """The ``t`` most probable partitions per query, taken inside the task: query_id, part, prob, rank."""
    shared = queries.sparkSession.sparkContext.broadcast(model.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = PartitionNet(shared.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                yield _top_rows(part.column("query_id"), net.probabilities(matrix(part.column("query_vec"))), np.arange(net.parts, dtype=np.int32), t)

    step = max(1, BLOCK_CELLS // model.parts)
    return queries.select("query_id", "query_vec").mapInArrow(run, f"query_id {type_of(queries, 'query_id')}, part int, prob double, rank bigint")


def _top_rows(ids: pa.Array, probs: np.ndarray, parts: np.ndarray, t: int, names=("query_id", "part", "prob", "rank")) -> pa.RecordBatch:
    """The ``t`` largest values of every row with the names of their columns (ascending), the first of equal ones first."""
    t = min(t, probs.shape[1])
    best = np.argsort(-probs, axis=1, kind="stable")[:, :t]
    rows = np.repeat(np.arange(len(probs)), t)
    return pa.RecordBatch.from_arrays(
        [ids.take(pa.array(rows)), pa.array(parts[best.ravel()]), pa.array(np.take_along_axis(probs, best, axis=1).ravel()),
         pa.array(np.tile(np.arange(1, t + 1, dtype=np.int64), len(probs)))], names=list(names))


def predict_scores(model: PartitionNet, queries: DataFrame) -> DataFrame:
    """Probability of every partition: query_id, part, prob."""
    return _scored(model, queries, model.parts).drop("rank")


def probable_partitions(model: PartitionNet, queries: DataFrame, t: int) -> DataFrame:
    """The ``t`` most probable partitions per query: query_id, part, prob, rank; only those rows arise, and nothing is shuffled."""
    return _scored(model, queries, t)


def softmax_scores(raw: DataFrame) -> DataFrame:
    """Raw (query_id, part, score) -> probabilities, shifted by the maximum for stability."""
    each = Window.partitionBy("query_id")
    powers = raw.withColumn("e", F.exp(F.col("score") - F.max("score").over(each)))
    return powers.select("query_id", "part", (F.col("e") / F.sum("e").over(each)).alias("prob"))


def top_partitions(scores: DataFrame, t: int) -> DataFrame:
    """The ``t`` most probable partitions per query: query_id, part, prob, rank."""
    order = Window.partitionBy("query_id").orderBy(F.desc("prob"), "part")
    return scores.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= t)


def search_learned(base: DataFrame, queries: DataFrame, n: int, p: LearnedParams = LearnedParams(),
                   scores: DataFrame | None = None, labelled: DataFrame | None = None,
                   model=None, tops: DataFrame | None = None, **how) -> DataFrame:
    """Approximate top ``n`` with exact distances in the predicted partitions.

    Partitions come from ``tops`` (query_id, part), from all ``scores`` (query_id, part, prob), or from a classifier.
    """
    if labelled is None:
        k = min(p.partitions, base.limit(p.partitions).count())
        centroids = kmeans(base, k, p.seed, p.restarts, p.max_iter)
        labelled = partition_labels(base, centroids)
    if tops is not None:
        return search_cells(labelled, tops.select("query_id", "part"), queries, n, by="part", **how)
    if scores is None:
        if model is None:
            model, _ = train_partition_model(labelled, p.epochs, p.seed)
        return search_cells(labelled, probable_partitions(model, queries, p.probes), queries, n, by="part", **how)
    return search_cells(labelled, top_partitions(scores, p.probes), queries, n, by="part", **how)


def _pieces(centroids: DataFrame) -> list[pa.Table]:
    """(part, centroid) in tables small enough to be shipped, by part; one after the other they may be of any size together."""
    table = fetch_if_small(centroids.select("part", "centroid"), SMALL_CENTROID_ROWS)
    if table is not None:
        return [table]
    settled = settle(centroids.select("part", "centroid"))
    n = -(-2 * settled.count() // SMALL_CENTROID_ROWS)
    while True:
        pieces = (fetch_if_small(settled.where(F.pmod(F.xxhash64("part"), F.lit(n)) == i), SMALL_CENTROID_ROWS) for i in range(n))
        out = [p for p in pieces if p is None or p.num_rows]
        if all(p is not None for p in out):
            return out
        n *= 2


def _distances(batch: pa.RecordBatch, centres: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Stretches of a batch with minus the distance to every centre."""
    step = max(1, BLOCK_CELLS // max(1, centres.size))
    for lo in range(0, batch.num_rows, step):
        part = batch.slice(lo, step)
        diff = matrix(part.column("query_vec"))[:, None, :].astype(np.float64) - centres[None]
        yield part, -np.sqrt(np.einsum("ijk,ijk->ij", diff, diff))


def centroid_scores(queries: DataFrame, centroids: DataFrame) -> DataFrame:
    """Score without a trained model, minus the distance to each centroid: query_id, part, score (one row for every pair)."""
    def scored(table: pa.Table) -> DataFrame:
        shared = queries.sparkSession.sparkContext.broadcast((table["part"].to_numpy().astype(np.int32), matrix(table["centroid"])))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts, centres = shared.value
            for batch in batches:
                for part, scores in _distances(batch, centres):
                    rows = pa.array(np.repeat(np.arange(len(scores)), len(parts)))
                    yield pa.RecordBatch.from_arrays([part.column("query_id").take(rows), pa.array(np.tile(parts, len(scores))), pa.array(scores.ravel())],
                                                     names=["query_id", "part", "score"])

        return queries.select("query_id", "query_vec").mapInArrow(run, f"query_id {type_of(queries, 'query_id')}, part int, score double")

    return reduce(DataFrame.unionByName, map(scored, _pieces(centroids)))


def near_partitions(queries: DataFrame, centroids: DataFrame, t: int) -> DataFrame:
    """The ``t`` partitions of largest softmax of ``centroid_scores``: query_id, part, prob, rank, lowest part on ties.

    Taken inside the task: ``t`` rows per query and piece of the centroid table. Pieces beyond the first bring their part of the
    softmax's sum along, which is put together by query.
    """
    schema = f"query_id {type_of(queries, 'query_id')}, part int, score double, place bigint, top double, mass double"

    def best(table: pa.Table) -> DataFrame:
        parts = table["part"].to_numpy().astype(np.int32)
        order = np.argsort(parts)
        shared = queries.sparkSession.sparkContext.broadcast((parts[order], matrix(table["centroid"])[order]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts, centres = shared.value
            if not len(parts):
                return
            for batch in batches:
                for part, scores in _distances(batch, centres):
                    top = scores.max(axis=1)
                    mass = np.exp(scores - top[:, None]).sum(axis=1)
                    rows = _top_rows(part.column("query_id"), scores, parts, t, ("query_id", "part", "score", "place"))
                    each = np.repeat(np.arange(len(scores)), min(t, len(parts)))
                    yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(top[each]), pa.array(mass[each])], names=[*rows.schema.names, "top", "mass"])

        return queries.select("query_id", "query_vec").mapInArrow(run, schema)

    pieces = [best(p) for p in _pieces(centroids)]
    share = F.exp(F.col("score") - F.col("top")) / F.col("mass")
    if len(pieces) == 1:
        return pieces[0].select("query_id", "part", share.alias("prob"), F.col("place").alias("rank"))
    each = Window.partitionBy("query_id")
    every = reduce(DataFrame.unionByName, pieces).withColumn("highest", F.max("top").over(each))
    own = F.when(F.col("place") == 1, F.col("mass") * F.exp(F.col("top") - F.col("highest")))
    every = every.withColumn("mass", F.sum(own).over(each)).withColumn("top", F.col("highest"))
    return top_partitions(every.select("query_id", "part", share.alias("prob")), t)


def training_curve(model: PartitionNet, spark: SparkSession) -> DataFrame:
    """Training loss after every epoch: epoch, train_loss."""
    return fit_quality(model, spark).select("epoch", "train_loss")
