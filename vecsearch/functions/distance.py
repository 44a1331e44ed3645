"""Distance expressions on array columns (for narrow inputs; bulk work uses the block kernels)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _doubles(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("array<double>")


def sq_l2(a, b) -> Column:
    """Squared Euclidean distance of two vector columns."""
    squares = F.zip_with(_doubles(a), _doubles(b), lambda x, y: (x - y) * (x - y))
    return F.aggregate(squares, F.lit(0.0), lambda total, x: total + x)


def l2(a, b) -> Column:
    """Euclidean distance of two vector columns."""
    return F.sqrt(sq_l2(a, b))


def to_distance(c) -> Column:
    """Anything castable becomes a number, everything else 0.0."""
    return F.coalesce((F.col(c) if isinstance(c, str) else c).try_cast("double"), F.lit(0.0))
