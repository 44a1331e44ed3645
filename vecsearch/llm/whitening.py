"""Whitening of embeddings along principal components that a block Jacobi-Davidson iteration finds.

The covariance is never formed. All that is asked of the data is its product with a few columns, ``sum of z (z' M) / n`` over the
centred vectors z: one pass of partial sums per block of columns, added up by place, of which d x b numbers reach the driver
(d: dimension of the vectors, b: at most three times the number of components). The driver keeps matrices of d rows only.

A round takes the Ritz pairs of the search space, locks leading pairs whose residuals are at rounding level, and widens the space by
corrections of the others: the projected equations ``(I - QQ')(V - e I)(I - QQ') t = -r`` of all pairs are solved by MINRES in
step, so that one inner step of all of them is one pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stored

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
BLOCK_ROWS = 4096
INNER_STEPS = 4
SPARE = 8  # columns beside the wanted ones, so that the last wanted pair has neighbours in the space
MAX_ROUNDS = 300
EPS = np.finfo(np.float64).eps
EXACT = float(1 << 53)

OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def lattice(embeddings: DataFrame) -> Stored:
    """The vectors whose entries are all finite, as whole numbers ``floor(64 c) + 1000000``, packed into blocks of one length.

    Columns: d, rows, top (largest absolute value), ids, x (rows x d doubles, exact up to 2 ** 53).
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column = batch.column("vec_id"), batch.column("embedding")
            sizes = np.diff(column.offsets.to_numpy())
            flat = column.flatten().to_numpy(zero_copy_only=False)  # null entries become nan; null lists hold nothing
            ends = np.cumsum(sizes)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            fit = (bad[ends] == bad[ends - sizes]) & (sizes > 0) & column.is_valid().to_numpy(zero_copy_only=False)
            for d in np.unique(sizes[fit]):
                rows = np.nonzero(fit & (sizes == d))[0]
                for lo in range(0, len(rows), BLOCK_ROWS):
                    part = rows[lo:lo + BLOCK_ROWS]
                    x = np.floor(flat[(ends[part] - d)[:, None] + np.arange(d)] * SCALE) + SHIFT
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([d], pa.int32()), pa.array([len(part)], pa.int64()), pa.array([np.abs(x).max()]),
                         pa.array([ids.take(pa.array(part))], pa.list_(pa.int64())), pa.array([x.tobytes()], pa.binary())],
                        ["d", "rows", "top", "ids", "x"])

    plain = embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    return Stored(plain.mapInArrow(pack, "d int, rows long, top double, ids array<long>, x binary"), "lattice")


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for x in batch.column("x"):
            yield np.frombuffer(x.as_buffer(), np.float64).reshape(-1, d)


def total(blocks: DataFrame, d: int, width: int, part: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """Sum of ``part(x)`` (``width`` numbers) over all blocks, added per task and then by place; only the sums reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(width, np.int64 if kind == "long" else np.float64)
        for x in _blocks(batches, d):
            sums += part(x).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([sums])], ["sums"])

    rows = blocks.select("x").mapInArrow(run, f"sums array<{kind}>").select(F.posexplode("sums"))
    table = rows.groupBy("pos").agg(F.sum("col").alias("sum")).toArrow()
    out = np.zeros(width, np.int64 if kind == "long" else np.float64)
    out[table.column("pos").to_numpy()] = table.column("sum").to_numpy()
    return out


def _norms(block: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->j", block, block))


def _share(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.zeros_like(a), where=b > 0)


def minres(apply: Callable[[np.ndarray], np.ndarray], rhs: np.ndarray, steps: int) -> np.ndarray:
    """Minimal-residual solutions after ``steps`` Lanczos steps, all columns of ``rhs`` side by side."""
    eta = _norms(rhs)
    v, before = _share(rhs, np.broadcast_to(eta, rhs.shape)), np.zeros_like(rhs)
    width = np.zeros_like(eta)
    cos, cos_old, sin, sin_old = np.ones_like(eta), np.ones_like(eta), np.zeros_like(eta), np.zeros_like(eta)
    w, w_old, out = np.zeros_like(rhs), np.zeros_like(rhs), np.zeros_like(rhs)
    for _ in range(steps):
        p = apply(v)
        along = np.einsum("ij,ij->j", v, p)
        p = p - along * v - width * before
        wider = _norms(p)
        left = cos * along - cos_old * sin * width
        diagonal = np.hypot(left, wider)
        second, third = sin * along + cos_old * cos * width, sin_old * width
        cos_old, sin_old = cos, sin
        cos, sin = _share(left, diagonal), _share(wider, diagonal)
        fresh = _share(v - third * w_old - second * w, np.broadcast_to(diagonal, v.shape))
        w_old, w = w, fresh
        out = out + cos * eta * w
        eta = -sin * eta
        before, v, width = v, _share(p, np.broadcast_to(wider, p.shape)), wider
    return out


def _widen(basis: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Orthonormal directions of ``block`` outside ``basis``; those that hold nothing new go."""
    for _ in range(2):
        block = block - basis @ (basis.T @ block)
        norms = _norms(block)
        block = block[:, norms > 0] / norms[norms > 0]
        if not block.shape[1]:
            return block
        left, sizes, _ = np.linalg.svd(block, full_matrices=False)
        block = left[:, sizes > 1e-8]
    return block


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], d: int, k: int, seed: int = 13,
                    report: Callable[[int, float], None] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues (falling) and unit eigenvectors of the symmetric operator behind ``product``.

    ``product`` takes d x b columns. Ends when freshly computed residuals of all pairs are below
    ``32 sqrt(d) eps`` times the largest eigenvalue; raises if that is not reached in ``MAX_ROUNDS`` rounds.
    """
    k, rng = min(k, d), np.random.default_rng(seed)
    most = min(d, 3 * k + SPARE)
    locked = np.zeros((d, 0))
    basis = np.linalg.qr(rng.normal(size=(d, min(d, k + SPARE))))[0]
    image = product(basis)
    for turn in range(MAX_ROUNDS):
        small = basis.T @ image
        values, turned = np.linalg.eigh((small + small.T) / 2)
        values, turned = values[::-1], turned[:, ::-1]
        basis, image = basis @ turned, image @ turned
        residual = image - basis * values
        residual -= locked @ (locked.T @ residual)
        scale = max(values[0], 0.0) if not locked.shape[1] else top
        top = scale
        limit = 32 * np.sqrt(d) * EPS * scale
        norms = _norms(residual)
        wanted = min(k - locked.shape[1], basis.shape[1])
        if report:
            report(turn, float(norms[:wanted].max(initial=0.0)))
        done = int(np.argmax(np.append(norms[:wanted] > limit, True)))
        if done == k - locked.shape[1]:
            # Judge by products with the vectors themselves, not by sums of old products.
            found = np.linalg.qr(np.hstack([locked, basis[:, :done]]))[0]
            fresh = product(found)
            small = found.T @ fresh
            values, turned = np.linalg.eigh((small + small.T) / 2)
            found, fresh, values = found @ turned[:, ::-1], fresh @ turned[:, ::-1], values[::-1]
            if (_norms(fresh - found * values) <= limit).all():
                return values, found
            rest = _widen(found, basis[:, done:])
            locked, basis = locked[:, :0], np.hstack([found, rest])
            image = np.hstack([fresh, product(rest)]) if rest.shape[1] else fresh
            continue
        locked = np.hstack([locked, basis[:, :done]])
        basis, image, values, residual = basis[:, done:], image[:, done:], values[done:], residual[:, done:]
        wanted -= done
        active = np.nonzero(norms[done:done + wanted] > limit)[0]
        pairs, shifts = np.hstack([locked, basis[:, active]]), values[active]

        def outside(block: np.ndarray) -> np.ndarray:
            return block - pairs @ (pairs.T @ block)

        room = d - locked.shape[1] - basis.shape[1]
        steps = basis[:, :0]
        if room:
            steps = minres(lambda t: outside(product(t) - t * shifts), -outside(residual[:, active]), INNER_STEPS)
        if locked.shape[1] + basis.shape[1] + min(room, len(active)) > most:
            keep = min(basis.shape[1], wanted + SPARE)
            basis, image = basis[:, :keep], image[:, :keep]
        known = np.hstack([locked, basis])
        steps = _widen(known, steps)
        if not steps.shape[1] and room:
            steps = _widen(known, rng.normal(size=(d, 1)))
        if steps.shape[1]:
            basis, image = np.hstack([basis, steps]), np.hstack([image, product(steps)])
    raise RuntimeError(f"no convergence in {MAX_ROUNDS} rounds")


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Every usable vector projected on the leading components of all of them, each scaled to variance one.

    ``embeddings``: vec_id, embedding. Returns per vector and component (from 1, by falling variance): vec_id, component, n (vectors),
    deviation (exact squared distance of n x from the sums S; null beyond the range of a long), whitened, explained (share of the
    trace) and identity_error (largest absolute entry of the covariance of ``whitened`` minus the identity).

    Null vectors, empty ones and those with null or non-finite entries take no part; neither do vectors of another length than the
    commonest (the greater of equally common ones). Rows that repeat a vec_id or have none count one by one. Components without
    variance (not above rounding: ``8 d eps`` of the largest) can't be scaled and are left out, so equal vectors alone, and an
    empty table, give no row. Long vectors need no more than d x (3 x ``components`` + 8) numbers in one place. Further columns are ignored.
    """
    spark, packed = embeddings.sparkSession, lattice(embeddings)
    common = (packed.df.groupBy("d").agg(F.sum("rows").alias("n"), F.max("top").alias("top"))
              .orderBy(F.desc("n"), F.desc("d")).first())
    if common is None:
        packed.drop()
        return spark.createDataFrame([], OUT)
    d, n, top = common["d"], common["n"], common["top"]
    blocks = packed.df.where(F.col("d") == d)
    whole = top < EXACT and 2 * top * n < 2 ** 62  # then n x - S is exact in longs
    if whole:
        sums = total(blocks, d, d, lambda x: x.astype(np.int64).sum(axis=0), "long")
        centred = lambda x: (x.astype(np.int64) * n - sums) / n
    else:
        means = total(blocks, d, d, lambda x: (x / n).sum(axis=0))
        means = means + total(blocks, d, d, lambda x: ((x - means) / n).sum(axis=0))
        centred = lambda x: x - means

    def product(columns: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            z = centred(x)
            return z.T @ (z @ columns)
        return total(blocks, d, columns.size, part).reshape(columns.shape) / n

    trace = total(blocks, d, 1, lambda x: np.array([(centred(x) ** 2).sum()]))[0] / n
    if not trace > 0:
        return spark.createDataFrame([], OUT)
    values, vectors = jacobi_davidson(product, d, components)
    usable = values > 8 * d * EPS * values[0]
    values, vectors = values[usable], vectors[:, usable]
    k, explained, project = len(values), values / trace, vectors / np.sqrt(values)

    def spread(x: np.ndarray) -> np.ndarray:
        w = centred(x) @ project
        return w.T @ w

    off = np.abs(total(blocks, d, k * k, spread).reshape(k, k) / n - np.eye(k)).max()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in zip(batch.column("ids"), _blocks([batch], d)):
                times, w = len(x), centred(x) @ project
                deviation = _deviations(x, sums, n) if whole else pa.nulls(times, pa.int64())
                place = pa.array(np.repeat(np.arange(times), k))
                yield pa.RecordBatch.from_arrays(
                    [ids.values.take(place), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), times)), pa.array(np.full(times * k, n)),
                     deviation.take(place), pa.array(w.ravel()), pa.array(np.tile(explained, times)), pa.array(np.full(times * k, off))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return blocks.select("ids", "x").mapInArrow(rows, OUT)


def _deviations(x: np.ndarray, sums: np.ndarray, n: int) -> pa.Array:
    far = x.astype(np.int64) * n - sums
    if float(np.abs(far).max()) ** 2 * x.shape[1] < 2.0 ** 62:
        return pa.array((far * far).sum(axis=1))
    exact = [sum(int(v) ** 2 for v in row) for row in far]
    return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())
