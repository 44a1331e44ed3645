"""Shared helpers: proven size bounds, scratch location, ranking windows."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A query set up to this many rows is shipped to every task; a larger one is shuffled.
SMALL_QUERY_ROWS = 4096
# The same for (query, bucket) probe rows and for centroid tables.
SMALL_PROBE_ROWS = 1_000_000
SMALL_CENTROID_ROWS = 16_384
# Bytes any of these may take once collected.
SMALL_BYTES = 256 * 1024 * 1024
# A result to be settled is only tried on the driver if the tables behind it take no more than this: a trial that fails was evaluated in vain.
SETTLE_BYTES = 8 * 1024 * 1024


def _reads_little(df: DataFrame, most: int = SMALL_BYTES) -> bool:
    """Do all tables a plan reads add up to a small size? False where that cannot be told."""
    try:
        leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    except AttributeError:  # a remote session has no plan to look at
        return False
    sizes = (leaves.apply(i).stats().sizeInBytes() for i in range(leaves.size()))
    return sum(int(str(size)) for size in sizes) <= most


def _row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes once collected."""
    size = F.lit(0).cast("bigint")
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        length = (F.octet_length(column) if kind in ("string", "binary") else F.size(column) * 8 if kind.startswith(("array", "map"))
                  else F.lit(16))
        size = size + F.coalesce(length.cast("bigint"), F.lit(8))
    return size


def fetch_if_small(df: DataFrame, max_rows: int) -> pa.Table | None:
    """The rows of ``df`` if there are at most ``max_rows`` of them, else None.

    The bound is proven on the data: never more than ``max_rows + 1`` rows are fetched, and from
    large inputs nothing before the executors have summed up rows and bytes.
    """
    if not _reads_little(df):
        size = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(_row_bytes(df)).alias("bytes")).first()
        if size["rows"] > max_rows or (size["bytes"] or 0) > SMALL_BYTES:
            return None
    table = df.limit(max_rows + 1).toArrow()
    if table.num_rows > max_rows or table.nbytes > SMALL_BYTES:
        return None
    return table


def settle(df: DataFrame, max_rows: int = SMALL_PROBE_ROWS) -> DataFrame:
    """Evaluate ``df`` once and return its rows as a source later steps can read repeatedly.

    A result of small tables, itself proven small, becomes a local relation; any other is written to the
    shared scratch folder, which also cuts the lineage and survives the loss of executors.
    """
    if _reads_little(df, SETTLE_BYTES):
        table = fetch_if_small(df, max_rows)
        if table is not None:
            return df.sparkSession.createDataFrame(table, df.schema)
    path = scratch_path(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written to the shared scratch folder."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def evaluated(df: DataFrame) -> DataFrame:
    """``df`` for several readers: as it is if they would only scan a table, settled if each would run Python functions again."""
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    except AttributeError:  # a remote session has no plan to look at
        return settle(df)
    return settle(df) if "EvalPython" in plan or "InArrow" in plan or "InPandas" in plan else df


def stored_by(df: DataFrame) -> list[str]:
    """Columns by which the one table that ``df`` reads is laid out in folders; none if that can't be told."""
    try:
        leaves = df._jdf.queryExecution().analyzed().collectLeaves()
        return list(leaves.apply(0).relation().partitionSchema().fieldNames()) if leaves.size() == 1 else []
    except Exception:  # another kind of source has no such schema
        return []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint directory.

    Only when the session names none and runs in one local process (tests, trials) a temporary folder
    is used; on a cluster every executor would write to its own disk, so that is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="vecsearch-")
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


_written: list[tuple[SparkSession, str]] = []


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@atexit.register
def _remove_scratch() -> None:
    """Results are lazy and may read scratch tables until the program ends; then they go."""
    for spark, path in _written:
        try:
            remove_path(spark, path)
        except Exception:  # its session is gone already, or its store doesn't answer: the next one may
            continue


@contextmanager
def scratch_scope():
    """Scratch folders written inside go at the end, but for those ``kept`` (a list of paths that the caller adds to)."""
    mark, kept = len(_written), []
    try:
        yield kept
    finally:
        for spark, path in _written[mark:]:
            if path not in kept:
                remove_path(spark, path)
        _written[mark:] = [w for w in _written[mark:] if w[1] in kept]


def arrow_column(return_type: str):
    """Arrow UDF decorator for costly functions.

    Marked non-deterministic so that Catalyst never copies the call into the null filters it
    derives from joins and explodes, which would run the function twice per row.
    """
    return lambda fn: F.arrow_udf(fn, returnType=return_type).asNondeterministic()


def rank_within(df: DataFrame, by, order) -> DataFrame:
    """1-based ``rank`` (BIGINT) within ``by``."""
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window).cast("bigint"))


def top_n(df: DataFrame, n: int, by=("query_id",), order=("distance", "neighbor_id")) -> DataFrame:
    """First ``n`` rows per group with their rank; Spark prunes map-side (WindowGroupLimit)."""
    return rank_within(df, by, order).where(F.col("rank") <= n)


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()
