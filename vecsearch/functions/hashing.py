"""Seeded random projections and the vectorised hash columns built on them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.common import arrow_column
from ..operators.kernels import matrix


@dataclass(frozen=True)
class HashTable:
    """One table of ``k`` shifted projections: ``h_j(x) = floor((v_j . x + t_j) / w)``."""

    v: np.ndarray
    t: np.ndarray


def hash_params(dim: int, k: int, tables: int, w: float, seed: int = 42) -> list[HashTable]:
    """Projections for all tables from one generator, drawn v then t for each table."""
    rng = np.random.default_rng(seed)
    drawn = []
    for _ in range(tables):
        v = rng.normal(0, 1, size=(k, dim))
        drawn.append(HashTable(v, rng.uniform(0, w, k)))
    return drawn


def hash_params_frame(spark: SparkSession, params: list[HashTable]) -> DataFrame:
    """The parameters as a table: tbl, j, v, t."""
    rows = [(tbl, j, p.v[j].tolist(), float(p.t[j]))
            for tbl, p in enumerate(params) for j in range(len(p.t))]
    return spark.createDataFrame(rows, "tbl int, j int, v array<double>, t double")


def projection_codes(vector: Column, params: list[HashTable], w: float) -> Column:
    """ARRAY<INT> of all hash values, table after table (length tables * k)."""
    v = np.concatenate([p.v for p in params]).T
    t = np.concatenate([p.t for p in params])

    @arrow_column("array<int>")
    def codes(batch: pa.Array) -> pa.Array:
        width = len(t)
        if len(batch) == 0:
            return pa.array([], type=pa.list_(pa.int32()))
        h = np.floor((matrix(batch) @ v + t) / w).astype(np.int32)
        offsets = pa.array(np.arange(len(h) + 1, dtype=np.int32) * width)
        return pa.ListArray.from_arrays(offsets, pa.array(h.ravel()))

    return codes(vector)


def dimension(df: DataFrame, column: str = "embedding") -> int:
    """Vector length, from one row."""
    first = df.select(F.size(column).alias("d")).first()
    if first is None:
        raise ValueError("no vectors")
    return first["d"]
