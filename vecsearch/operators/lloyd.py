"""Many k-means problems at once: restarts and subspaces advance together, one scan of the vectors per step.

A problem is a slice of the dimensions and a table of centres. A task carries the partial sums of all problems past its rows;
the driver sees sums per problem and cell only, so its share is set by the parameters and not by the rows. Problems that together would
not fit are trained in several groups.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from .common import evaluated
from .kernels import BLOCK_CELLS, matrix

# Rounds of drawing starts, and rows drawn in each of them per cell.
START_ROUNDS, OVERSAMPLE = 5, 2
# Steps on the weighted start rows alone.
START_STEPS = 20
# A problem has come to rest when no centre moves by more than this share of the spread of its rows.
REST = 1e-6
# A row lies on its centre if its squared distance is no more than this share of its squared length (rounding of means).
NOTHING = 1e-24
# Numbers of a block of rows that stay in a core's cache.
CACHED_CELLS = 65_536
# Bytes of sums a task may hold.
SUM_BYTES = 64 * 1024 * 1024


@dataclass
class Problem:
    """A slice of the dimensions and the centres found so far; ``cost`` is that of the last step's assignment."""

    lo: int
    hi: int
    seed: int
    centres: np.ndarray | None = None
    cost: float = np.inf
    resting: bool = False


def nearest(rows: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the nearest centre, the first of equal ones; squared distance) of every row."""
    shift = centres.mean(axis=0)
    c = centres - shift
    norms = np.einsum("ij,ij->i", c, c)
    label, square = np.empty(len(rows), np.int64), np.empty(len(rows))
    twice = -2 * c.T
    step = max(1, min(BLOCK_CELLS, CACHED_CELLS) // max(c.shape))
    for lo in range(0, len(rows), step):
        x = rows[lo:lo + step] - shift
        score = x @ twice
        score += norms
        label[lo:lo + step] = best = score.argmin(axis=1)
        x -= c[best]
        square[lo:lo + step] = np.einsum("ij,ij->i", x, x)
    return label, square


def grouped_sums(rows: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(labels that occur, their number of rows, their sums)."""
    # Short integers are sorted by their digits, in linear time.
    order = np.argsort(label.astype(np.uint16) if len(label) and label.max() < 1 << 16 else label, kind="stable")
    at = np.flatnonzero(np.append(True, np.diff(label[order]) != 0))
    return label[order[at]], np.diff(np.append(at, len(rows))), np.add.reduceat(rows[order], at, axis=0)


class Trainer:
    """Vectors to train on (column ``embedding``), read once per step."""

    def __init__(self, vectors: DataFrame):
        keyed = evaluated(vectors.select(F.col("embedding").cast("array<double>").alias("embedding")))
        self.data = keyed.withColumn("draw", F.xxhash64("embedding")).persist(StorageLevel.MEMORY_AND_DISK)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.data.unpersist()

    def _pass(self, problems: list[Problem], schema: str, start: Callable, each: Callable, end: Callable) -> DataFrame:
        """Rows that every task makes of its own ones: ``start`` gives its state per problem, ``each`` takes a batch, ``end`` gives tables."""
        plain = [(p.lo, p.hi, p.seed, p.centres) for p in problems]
        shared = self.data.sparkSession.sparkContext.broadcast(plain)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            work = shared.value
            states = [start(i, *w) for i, w in enumerate(work)]
            for batch in batches:
                if not batch.num_rows:
                    continue
                x, draw = matrix(batch.column("embedding")), batch.column("draw").to_numpy(zero_copy_only=False)
                for (lo, hi, seed, centres), state in zip(work, states):
                    each(state, x[:, lo:hi], draw, seed, centres)
            for i, state in enumerate(states):
                yield from end(i, state)

        return self.data.mapInArrow(run, schema)

    def sums(self, problems: list[Problem]) -> list[tuple[np.ndarray, np.ndarray, float]]:
        """Per problem: rows per centre, their sums, and the total squared distance to the nearest centres."""
        def each(state, x, draw, seed, centres):
            label, square = nearest(x, centres)
            hit, n, total = grouped_sums(x, label)
            state[0][hit] += n
            state[1][hit] += total
            state[2] += square.sum()

        def end(i, state):
            hit = np.flatnonzero(state[0])
            if len(hit):
                cost = np.zeros(len(hit))
                cost[0] = state[2]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(hit), i, np.int32)), pa.array(hit.astype(np.int32)), pa.array(state[0][hit]), pa.array(cost),
                     pa.array(list(state[1][hit]), pa.list_(pa.float64()))], ["problem", "cell", "n", "cost", "total"])

        rows = self._pass(problems, "problem int, cell int, n long, cost double, total array<double>",
                          lambda i, lo, hi, seed, c: [np.zeros(len(c), np.int64), np.zeros(c.shape), 0.0], each, end)
        table = rows.groupBy("problem", "cell").agg(
            F.sum("n").alias("n"), F.sum("cost").alias("cost"), vector_to_array(Summarizer.sum(array_to_vector("total"))).alias("total")).toArrow()
        out = [(np.zeros(len(p.centres), np.int64), np.zeros(p.centres.shape), np.zeros(1)) for p in problems]
        for i, cell, n, cost, total in zip(*(table.column(c).to_pylist() for c in ("problem", "cell", "n", "cost", "total"))):
            out[i][0][cell], out[i][1][cell] = n, total
            out[i][2][0] += cost
        return [(n, total, float(cost[0])) for n, total, cost in out]

    def farthest(self, problem: Problem, count: int) -> np.ndarray:
        """Up to ``count`` distinct rows that lie farthest from their centres, the farthest first; none lies on a centre."""
        def each(state, x, draw, seed, centres):
            _, square = nearest(x, centres)
            rows, first = np.unique(np.concatenate([state[0], x]), axis=0, return_index=True)
            far = np.concatenate([state[1], square])[first]
            far[far <= NOTHING * (rows ** 2).sum(axis=1)] = 0
            keep = np.argsort(-far, kind="stable")[:count]
            state[0], state[1] = rows[keep], far[keep]

        def end(i, state):
            yield pa.RecordBatch.from_arrays([pa.array(state[1]), pa.array(list(state[0]), pa.list_(pa.float64()))], ["far", "row"])

        rows = self._pass([problem], "far double, row array<double>",
                          lambda i, lo, hi, seed, c: [np.zeros((0, hi - lo)), np.zeros(0)], each, end)
        best = rows.where("far > 0").groupBy("row").agg(F.max("far").alias("far")).orderBy(F.desc("far"), "row").limit(count).toArrow()
        return matrix(best.column("row")) if best.num_rows else np.zeros((0, problem.hi - problem.lo))

    def draw_starts(self, problems: list[Problem], k: int) -> None:
        """Starting centres: rows drawn in a few rounds with chances by their squared distance to those drawn before, all problems side
        by side; then k-means of the drawn rows, each weighing as many rows as are nearest to it.

        Chances come from a hash of the vector, so equal vectors are drawn together (and taken once), and the draw doesn't depend on
        partitions.
        """
        seeds = sorted({p.seed for p in problems})
        first = self.data.agg(*[F.min_by("embedding", F.xxhash64(F.lit(s), "embedding")).alias(f"s{s}") for s in seeds]).first()
        if first[0] is None:
            raise ValueError("no vectors to train on")
        for p in problems:
            p.centres = np.array([first[f"s{p.seed}"][p.lo:p.hi]])
        cost = [c for _, _, c in self.sums(problems)]
        for turn in range(START_ROUNDS):
            def each(state, x, draw, seed, centres, turn=turn):
                before, _, drawn = state
                _, square = nearest(x, centres)
                state[1] += square.sum()
                mixed = (draw.view(np.uint64) ^ np.uint64(seed * 1_000_003 + turn * 7_919 + 1)) * np.uint64(0x9E3779B97F4A7C15)
                chance = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(11)) / 2.0 ** 53
                drawn.append(np.unique(x[chance * before < OVERSAMPLE * k * square], axis=0))

            def end(i, state):
                drawn = np.unique(np.concatenate(state[2]), axis=0) if state[2] else []
                rows = [None, *drawn]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), i, np.int32)), pa.array([state[1]] + [0.0] * len(drawn)),
                                                  pa.array(rows, pa.list_(pa.float64()))], ["problem", "cost", "row"])

            before = list(cost)
            made = self._pass(problems, "problem int, cost double, row array<double>",
                              lambda i, lo, hi, seed, c, before=before: [before[i], 0.0, []], each, end)
            table = made.groupBy("problem", "row").agg(F.sum("cost").alias("cost")).toArrow().to_pylist()
            for i, p in enumerate(problems):
                new = [r["row"] for r in table if r["problem"] == i and r["row"] is not None]
                cost[i] = next((r["cost"] for r in table if r["problem"] == i and r["row"] is None), 0.0)
                if new:
                    p.centres = np.unique(np.concatenate([p.centres, np.array(new)]), axis=0)
        for p, (n, _, _) in zip(problems, self.sums(problems)):
            p.centres = weighted_kmeans(p.centres, n.astype(np.float64), k, np.random.default_rng(p.seed))

    def run(self, problems: list[Problem], max_iter: int) -> None:
        """Step all problems until each is at rest; a centre without rows starts again at the row farthest from its centre."""
        for _ in range(max_iter):
            active = [p for p in problems if not p.resting]
            if not active:
                return
            for p, (n, total, cost) in zip(active, self.sums(active)):
                moved = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], p.centres)
                empty = np.flatnonzero(n == 0)
                if len(empty):
                    far = self.farthest(p, len(empty))
                    moved[empty[:len(far)]] = far
                    moved[empty[len(far):]] = moved[n.argmax()]  # fewer distinct rows than cells
                    empty = empty[:len(far)]
                spread = np.sqrt(cost / max(n.sum(), 1)) + np.abs(moved).max() * 1e-9
                p.resting = not len(empty) and np.sqrt(((moved - p.centres) ** 2).sum(axis=1)).max() <= REST * spread
                p.centres, p.cost = moved, cost


def weighted_kmeans(rows: np.ndarray, weight: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """``k`` centres of weighted rows: far rows likelier to be chosen, then a few steps; fewer rows than ``k`` are repeated."""
    if len(rows) <= k:
        return rows[np.arange(k) % len(rows)].copy()
    centres = rows[[rng.choice(len(rows), p=weight / weight.sum())]]
    while len(centres) < k:
        _, square = nearest(rows, centres)
        chance = square * weight
        if not chance.sum() > 0:
            chance = square + 1e-300
        centres = np.concatenate([centres, rows[[rng.choice(len(rows), p=chance / chance.sum())]]])
    for _ in range(START_STEPS):
        label, _ = nearest(rows, centres)
        mass = np.bincount(label, weight, k)
        hit, _, total = grouped_sums(rows * weight[:, None], label)
        moved = centres.copy()
        moved[hit] = np.where(mass[hit][:, None] > 0, total / np.maximum(mass[hit], 1e-300)[:, None], centres[hit])
        if (moved == centres).all():
            break
        centres = moved
    return centres


def train(vectors: DataFrame, slices: list[tuple[int, int]], k: int, seed: int, restarts: int, max_iter: int,
          starts: list[np.ndarray] | None = None) -> list[Problem]:
    """The best of ``restarts`` seeded runs for every slice of the dimensions (or one run from given ``starts``), all in step."""
    with Trainer(vectors) as trainer:
        if starts is not None:
            problems = [Problem(lo, hi, seed, c.astype(np.float64)) for (lo, hi), c in zip(slices, starts)]
            trainer.run(problems, max_iter)
            return problems
        every = [Problem(lo, hi, seed + r) for lo, hi in slices for r in range(restarts)]
        width = max(hi - lo for lo, hi in slices)
        # While starts are drawn a problem has up to START_ROUNDS * OVERSAMPLE + 1 times as many centres.
        group = max(1, SUM_BYTES // (8 * width * k * (START_ROUNDS * OVERSAMPLE + 1)))
        for at in range(0, len(every), group):
            trainer.draw_starts(every[at:at + group], k)
            trainer.run(every[at:at + group], max_iter)
    return [min(every[i * restarts:(i + 1) * restarts], key=lambda p: p.cost) for i in range(len(slices))]
