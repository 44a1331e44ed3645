"""Stored indexes: Parquet tables plus one row of parameters and a data fingerprint."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Index:
    """Named tables (for example centroids, assigned, codes, codebook) and their parameters."""

    tables: dict[str, DataFrame]
    params: dict = field(default_factory=dict)


# Tables with one of these columns are laid out by it, so a search reads only the probed cells.
LAYOUT_COLUMNS = ("cell", "part", "vertex")
LAID_OUT = ("assigned", "codes", "labelled", "members")
# One row for every state an index has been in; the newest one counts. Rows of laid out tables belong to one of its segments.
STATE = "at long, version string, params string, tables string, segments array<long>"


def fingerprint(base: DataFrame) -> str:
    """Order-free digest of a vector table: row count and xor of row hashes."""
    row = base.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("id", "embedding")).alias("x")).first()
    return f"{row['n']}:{row['x']}"


def save_index(index: Index, path: str, grace: float | None = None) -> None:
    """Write every table into a folder of its own version, then append the parameter row that points to it.

    A reader takes the newest row, so a rebuild that breaks off leaves the former index in use. With ``grace`` versions that have
    been out of use for so many seconds go afterwards (see ``remove_old``).
    """
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    for name, table in index.tables.items():
        by = next((c for c in LAYOUT_COLUMNS if c in table.columns), None)
        if name in LAID_OUT and by:
            _write_segment(table, by, 0, f"{path}/{version}/{name}")
        else:
            table.write.mode("overwrite").parquet(f"{path}/{version}/{name}")
    spark = next(iter(index.tables.values())).sparkSession
    _name_state(spark, path, version, index.params, ",".join(index.tables), [0])
    if grace is not None:
        remove_old(spark, path, grace)


def _write_segment(table: DataFrame, by: str, segment: int, path: str) -> None:
    # Rebalancing by the layout column also splits a cell that is far larger than others.
    laid = table.withColumn("segment", F.lit(segment).cast("bigint")).hint("rebalance", F.col(by))
    laid.write.mode("append").partitionBy("segment", by).parquet(path)


def _name_state(spark: SparkSession, path: str, version: str, params: dict, tables: str, segments: list[int]) -> None:
    row = (time.time_ns(), version, json.dumps(params, sort_keys=True), tables, segments)
    spark.createDataFrame([row], STATE).coalesce(1).write.mode("append").parquet(f"{path}/params")


def _newest(spark: SparkSession, path: str):
    return spark.read.schema(STATE).parquet(f"{path}/params").orderBy(F.desc("at")).first()


def remove_old(spark: SparkSession, path: str, grace: float) -> list[str]:
    """Delete what no reader needs any more: versions replaced more than ``grace`` seconds ago, and folders of broken runs as old.

    A version is out of use from the moment the next one was named; whoever opened it then has ``grace`` seconds to finish.
    Returns the versions that went.
    """
    versions = sorted(r["version"] for r in spark.read.parquet(f"{path}/params").select("version").distinct().collect())  # one row per rebuild
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    folders = [s.getPath().getName() for s in store.listStatus(root) if s.isDirectory() and s.getPath().getName() != "params"]
    now, gone = time.time_ns(), []
    for folder in sorted(folders):
        if folder == versions[-1]:
            continue
        after = next((v for v in versions if v > folder), None)
        since = int((after if folder in versions else folder).split("-")[0]) if after or folder not in versions else now
        if now - since >= grace * 1e9:
            store.delete(spark._jvm.org.apache.hadoop.fs.Path(root, folder), True)
            gone.append(folder)
    return gone


def load_index(spark: SparkSession, path: str) -> Index:
    """Read the newest complete version of a stored index; raises if there is none."""
    row = _newest(spark, path)

    def table(name: str) -> DataFrame:
        df = spark.read.parquet(f"{path}/{row['version']}/{name}")
        # A partition filter: files of a segment whose writing broke off are never opened.
        return df.where(F.col("segment").isin(row["segments"])).drop("segment") if "segment" in df.columns else df

    return Index({name: table(name) for name in row["tables"].split(",")}, json.loads(row["params"]))


def get_or_build(spark: SparkSession, path: str, params: dict, base: DataFrame,
                 build: Callable[[], dict[str, DataFrame]], rebuild: bool = False, grace: float | None = None) -> tuple[Index, bool]:
    """(index, reused). Reuses the stored index only if parameters and data are unchanged; ``grace`` as in ``save_index``."""
    wanted = json.loads(json.dumps({**params, "fingerprint": fingerprint(base)}))
    if not rebuild:
        try:
            stored = load_index(spark, path)
            if stored.params == wanted:
                return stored, True
        except AnalysisException:
            pass
    save_index(Index(build(), wanted), path, grace)
    return load_index(spark, path), False


def get_or_extend(spark: SparkSession, path: str, params: dict, base: DataFrame, build: Callable[[], dict[str, DataFrame]],
                  assign: Callable[[DataFrame, Index], DataFrame], name: str = "assigned", grace: float | None = None) -> tuple[Index, str]:
    """(index, ``reused`` or ``appended`` or ``built``): added rows alone are assigned and stored as a segment of their own.

    ``assign`` places new rows (columns of ``base``) by the tables of the stored index and returns rows of its table ``name``. Changed or
    removed rows, or other parameters, call for a new index. The segment gets into use with the row that names it.
    """
    wanted = json.loads(json.dumps(params))
    try:
        stored = load_index(spark, path)
    except AnalysisException:
        stored = None
    print_ = fingerprint(base)
    if stored is not None and {k: v for k, v in stored.params.items() if k != "fingerprint"} == wanted:
        if stored.params.get("fingerprint") == print_:
            return stored, "reused"
        known = stored.tables[name].select("id", F.xxhash64("id", "embedding").alias("was"))
        both = known.join(base.select("id", F.xxhash64("id", "embedding").alias("now")), "id", "full")
        if both.where("was is not null and (now is null or now <> was)").isEmpty():
            row = _newest(spark, path)
            by = next(c for c in LAYOUT_COLUMNS if c in stored.tables[name].columns)
            added = base.join(known.select("id"), "id", "left_anti")
            segment = time.time_ns()
            _write_segment(assign(added, stored).select(*stored.tables[name].columns), by, segment, f"{path}/{row['version']}/{name}")
            _name_state(spark, path, row["version"], {**wanted, "fingerprint": print_}, row["tables"], [*row["segments"], segment])
            return load_index(spark, path), "appended"
    save_index(Index(build(), {**wanted, "fingerprint": print_}), path, grace)
    return load_index(spark, path), "built"
