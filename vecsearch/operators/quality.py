"""Index quality: list sizes and sampled silhouette."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ivf import cell_sizes
from .kernels import exact_sq, id_values, matrix

# Points scored and members sampled from every other cell.
SAMPLE_SIZE = 100
OTHER_SAMPLE = 10


def cluster_stats(assigned: DataFrame, centroids: DataFrame) -> DataFrame:
    """One row: n_clusters, total_points, min/max/avg/std size, empty_clusters (empty counts as 0)."""
    sizes = centroids.select("cell").join(cell_sizes(assigned), "cell", "left").select(
        F.coalesce("members", F.lit(0)).alias("size"))
    return sizes.agg(
        F.count("*").alias("n_clusters"), F.sum("size").alias("total_points"),
        F.min("size").alias("min_size"), F.max("size").alias("max_size"),
        F.avg("size").alias("avg_size"), F.stddev_pop("size").alias("std_size"),
        F.count(F.when(F.col("size") == 0, 1)).alias("empty_clusters"))


def _sample_order(sampling: str, seed: int):
    return [F.col("id")] if sampling == "lowest" else [F.xxhash64("id", F.lit(seed)), F.col("id")]


def silhouette(assigned: DataFrame, sample_size: int = SAMPLE_SIZE, other_sample: int = OTHER_SAMPLE,
               sampling: str = "hash", seed: int = 42) -> DataFrame:
    """Mean silhouette of a point sample: one row (score, valid_points).

    The distance to the own cell uses all its members; other cells are represented by
    ``other_sample`` members. The sampled points (at most ``sample_size`` rows) travel to the
    tasks, every task returns partial sums, and the cells themselves are never collected.
    """
    order = _sample_order(sampling, seed)
    picked = assigned.select("id", "cell", "embedding").orderBy(*order).limit(sample_size).toArrow()
    if picked.num_rows == 0:
        return assigned.sparkSession.createDataFrame([(0.0, 0)], "score double, valid_points bigint")
    shared = assigned.sparkSession.sparkContext.broadcast(
        (id_values(picked["id"]), picked["cell"].to_numpy(), matrix(picked["embedding"])))
    others = (
        assigned.withColumn("place", F.row_number().over(Window.partitionBy("cell").orderBy(*order)))
        .where(F.col("place") <= other_sample)
    )
    rows = assigned.select("id", "cell", "embedding", F.lit(True).alias("own")).unionByName(
        others.select("id", "cell", "embedding", F.lit(False).alias("own")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, cells, points = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column("own").to_numpy(zero_copy_only=False)
            cell = batch.column("cell").to_numpy()
            same = cells[:, None] == cell[None, :]
            self_row = ids[:, None] == id_values(batch.column("id"))[None, :]
            p, b = np.nonzero((same == own[None, :]) & ~self_row)
            dist = np.sqrt(exact_sq(points, matrix(batch.column("embedding")), p, b))
            pairs, where = np.unique(np.stack([p, cell[b]]), axis=1, return_inverse=True)
            where = where.ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(pairs[0], pa.int32()), pa.array(pairs[1], pa.int32()),
                 pa.array(cells[pairs[0]] == pairs[1]),
                 pa.array(np.bincount(where, weights=dist, minlength=pairs.shape[1])),
                 pa.array(np.bincount(where, minlength=pairs.shape[1]), pa.int64())],
                names=["point", "cell", "own", "total", "members"])

    sums = rows.mapInArrow(run, "point int, cell int, own boolean, total double, members bigint")
    means = sums.groupBy("point", "cell", "own").agg(
        (F.sum("total") / F.sum("members")).alias("mean"))
    per_point = means.groupBy("point").agg(
        F.max(F.when(F.col("own"), F.col("mean"))).alias("a"),
        F.min(F.when(~F.col("own"), F.col("mean"))).alias("b"))
    widest = F.greatest("a", "b")
    valid = per_point.where("a is not null and b is not null").where(widest > 0)
    return valid.agg(F.coalesce(F.avg((F.col("b") - F.col("a")) / widest), F.lit(0.0)).alias("score"),
                     F.count("*").alias("valid_points"))
