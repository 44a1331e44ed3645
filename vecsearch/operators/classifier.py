"""A small classifier of partitions, trained by mini-batches over the cluster.

Weights are small by their parameters and travel to the tasks; a step sums the gradient of its mini-batch over all tasks, and
only that sum comes back. A mini-batch is a slice of the rows by hash, the same whatever the partitions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from .common import evaluated
from .kernels import matrix

# From so many partial sums on, groups of them are added by tasks before the rest reaches the driver.
DIRECT_SUMS = 64
RATE, DECAY_1, DECAY_2 = 0.01, 0.9, 0.99


@dataclass
class PartitionNet:
    """Two hidden layers with rectifiers and a softmax; ``history`` has the figures of every epoch."""

    weights: list[np.ndarray]
    history: list[tuple] = field(default_factory=list)

    @staticmethod
    def start(dim: int, hidden: int, parts: int, seed: int) -> "PartitionNet":
        rng, sizes = np.random.default_rng(seed), (dim, hidden, hidden, parts)
        layers = zip(sizes, sizes[1:])
        return PartitionNet([w for a, b in layers for w in (rng.normal(size=(a, b)) * math.sqrt(2 / a), np.zeros(b))])

    @property
    def parts(self) -> int:
        return len(self.weights[-1])

    def _forward(self, x: np.ndarray) -> list[np.ndarray]:
        """Inputs of every layer and, last, the logarithms of the probabilities."""
        seen = [x]
        for i in range(0, len(self.weights), 2):
            z = seen[-1] @ self.weights[i] + self.weights[i + 1]
            seen.append(np.maximum(z, 0) if i < len(self.weights) - 2 else z)
        z = seen[-1] - seen[-1].max(axis=1, keepdims=True)
        seen[-1] = z - np.log(np.exp(z).sum(axis=1, keepdims=True))
        return seen

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return np.exp(self._forward(x)[-1])

    def figures(self, x: np.ndarray, label: np.ndarray) -> np.ndarray:
        """Rows, summed loss, rows whose likeliest partition is theirs."""
        logs = self._forward(x)[-1]
        return np.array([len(x), -logs[np.arange(len(x)), label].sum(), (logs.argmax(axis=1) == label).sum()], float)

    def gradient(self, x: np.ndarray, label: np.ndarray) -> np.ndarray:
        """Rows, and the gradient of their summed loss by all weights, one after the other."""
        *seen, logs = self._forward(x)
        d = np.exp(logs)
        d[np.arange(len(x)), label] -= 1
        parts: list[np.ndarray] = []
        for i in range(len(self.weights) - 2, -1, -2):
            parts[:0] = [(seen[i // 2].T @ d).ravel(), d.sum(axis=0)]
            d = (d @ self.weights[i].T) * (seen[i // 2] > 0)
        return np.concatenate([[float(len(x))], *parts])

    def moved(self, flat: np.ndarray) -> None:
        at = 0
        for w in self.weights:
            w -= flat[at:at + w.size].reshape(w.shape)
            at += w.size


def summed(rows: DataFrame, width: int) -> np.ndarray:
    """Sum of the arrays in ``sums``: of many, groups are added by tasks first, so the driver gets about their square root."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                total += matrix(batch.column("sums")).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([total])], ["sums"])

    n = rows.rdd.getNumPartitions()
    if n > DIRECT_SUMS:
        rows = rows.repartition(math.isqrt(n)).mapInArrow(add, "sums array<double>")
    table = rows.toArrow()
    return matrix(table.column("sums")).sum(axis=0) if table.num_rows else np.zeros(width)


class Rows:
    """Labelled vectors, evaluated once: part, embedding, slot (0 to 999 by hash of id), turn (the mini-batch)."""

    def __init__(self, labelled: DataFrame, seed: int, train_share: float, steps: int, most_rows: int):
        n = labelled.count()
        share = min(1.0, most_rows / max(n, 1))
        hashed = lambda k: F.pmod(F.xxhash64("id", F.lit(seed), F.lit(k)), F.lit(1 << 30))
        some = labelled.where(hashed(1) < int(share * (1 << 30))) if share < 1 else labelled
        slot = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1000))
        self.cut, self.steps = int(train_share * 1000), steps
        self.data = evaluated(some.select("id", "part", "embedding")).select(
            "part", F.col("embedding").cast("array<double>").alias("embedding"), slot.alias("slot"), (hashed(2) % steps).alias("turn"))
        self.data = self.data.persist(StorageLevel.MEMORY_AND_DISK)

    def _pass(self, rows: DataFrame, width: int, each) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(width)
            for batch in batches:
                if batch.num_rows:
                    x, label = matrix(batch.column("embedding")), batch.column("part").to_numpy(zero_copy_only=False).astype(np.int64)
                    total += each(x, label, batch.column("slot").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([pa.array([total])], ["sums"])

        return summed(rows.mapInArrow(run, "sums array<double>"), width)

    def gradient(self, net: PartitionNet, turn: int) -> np.ndarray:
        """Mean gradient of a mini-batch of training rows."""
        shared = self.data.sparkSession.sparkContext.broadcast(net.weights)
        rows = self.data.where((F.col("slot") < self.cut) & (F.col("turn") == turn))
        total = self._pass(rows, 1 + sum(w.size for w in net.weights), lambda x, label, _: PartitionNet(shared.value).gradient(x, label))
        return total[1:] / max(total[0], 1)

    def figures(self, net: PartitionNet) -> tuple[float | None, float | None, float | None]:
        """Training loss, and loss and accuracy (percent) on the rows kept from training."""
        shared, cut = self.data.sparkSession.sparkContext.broadcast(net.weights), self.cut

        def each(x, label, slot):
            own, held = PartitionNet(shared.value), slot >= cut
            return np.concatenate([own.figures(x[~held], label[~held]), own.figures(x[held], label[held])])

        n, loss, _, held, held_loss, right = self._pass(self.data, 6, each).tolist()
        return (loss / n if n else None, held_loss / held if held else None, 100 * right / held if held else None)


def train_epochs(labelled: DataFrame, parts: int, dim: int, hidden: int, epochs: int, seed: int, train_share: float, steps: int = 4,
                 most_rows: int = 1_000_000, path: str | None = None) -> PartitionNet:
    """Trains for some epochs of ``steps`` mini-batches each and notes the figures after every epoch.

    At most about ``most_rows`` labelled rows take part, chosen by hash. With ``path`` the state after every epoch is stored there, and a run
    that was broken off goes on behind the last stored epoch.
    """
    spark = labelled.sparkSession
    net = PartitionNet.start(dim, hidden, parts, seed)
    size = sum(w.size for w in net.weights)
    first, second, best, done = np.zeros(size), np.zeros(size), None, 0
    if path and (state := _resume(spark, path, epochs)):
        done, best, flat, first, second, history = state
        net.moved(np.concatenate([w.ravel() for w in net.weights]) - flat)
        net.history = history
    rows = Rows(labelled, seed, train_share, steps, most_rows)
    try:
        for epoch in range(done + 1, epochs + 1):
            for turn in range(steps):
                t = (epoch - 1) * steps + turn + 1
                g = rows.gradient(net, turn)
                first += (1 - DECAY_1) * (g - first)
                second += (1 - DECAY_2) * (g * g - second)
                net.moved(RATE * (first / (1 - DECAY_1 ** t)) / (np.sqrt(second / (1 - DECAY_2 ** t)) + 1e-8))
            loss, held_loss, accuracy = rows.figures(net)
            best = accuracy if best is None else max(best, accuracy)
            net.history.append((epoch, loss, held_loss, accuracy, best))
            if path:
                flat = np.concatenate([w.ravel() for w in net.weights])
                spark.createDataFrame([(epoch, best, flat.tolist(), first.tolist(), second.tolist(), net.history)], STATE).coalesce(1).write.mode(
                    "overwrite").parquet(f"{path}/epoch-{epoch:04d}")
    finally:
        rows.data.unpersist()
    return net


HISTORY = "epoch int, train_loss double, val_loss double, val_accuracy double, best_accuracy double"
STATE = ("epoch int, best double, weights array<double>, first array<double>, second array<double>, "
         f"history array<struct<{HISTORY.replace(' ', ':').replace(',:', ', ')}>>")


def _resume(spark: SparkSession, path: str, epochs: int) -> tuple | None:
    """The last stored state of at most ``epochs`` epochs; an epoch whose writing broke off doesn't count."""
    for epoch in range(epochs, 0, -1):
        try:
            row = spark.read.schema(STATE).parquet(f"{path}/epoch-{epoch:04d}").first()
        except AnalysisException:
            continue
        if row is not None:
            return (epoch, row["best"], np.array(row["weights"]), np.array(row["first"]), np.array(row["second"]),
                    [tuple(h) for h in row["history"]])
    return None
