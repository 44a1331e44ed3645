"""Sequence cleaning, pluggable batch embedding and token pooling."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_column, type_of

# Residue letters that are kept, longest sequence, smallest pooling divisor.
RESIDUES = "ACDEFGHIKLMNPQRSTVWY"
MAX_LENGTH = 1022
MIN_DIVISOR = 1e-9

EmbedFn = Callable[[list[str]], np.ndarray]


def residue_filter(df: DataFrame, alphabet: str = RESIDUES) -> DataFrame:
    """Delete every character outside the alphabet (case matters); rows stay."""
    return df.withColumn("seq", F.regexp_replace("seq", f"[^{alphabet}]+", ""))


def drop_empty(df: DataFrame) -> DataFrame:
    """Drop rows whose sequence is empty."""
    return df.where(F.length("seq") > 0)


def clean_sequences(df: DataFrame, alphabet: str = RESIDUES, require_rows: bool = False) -> DataFrame:
    """Filter residues and drop what becomes empty; optionally fail if nothing is left."""
    cleaned = drop_empty(residue_filter(df, alphabet))
    if require_rows and cleaned.isEmpty():
        raise ValueError("no valid sequence left")
    return cleaned


def truncate(df: DataFrame, max_length: int = MAX_LENGTH) -> DataFrame:
    """First ``max_length`` characters of each sequence."""
    return df.withColumn("seq", F.substring("seq", 1, max_length))


def composition(seq: Column) -> Column:
    """Default embedding: share of each residue letter in the sequence."""
    width = len(RESIDUES)
    kind = np.full(256, width, np.int64)
    kind[np.frombuffer(RESIDUES.encode(), np.uint8)] = np.arange(width)

    @arrow_column("array<float>")
    def shares(texts: pa.Array) -> pa.Array:
        texts = texts.cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        data = texts.buffers()[2] if len(texts) else None
        raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
        row = np.repeat(np.arange(len(texts)), np.diff(offsets))
        counts = np.bincount(row * (width + 1) + kind[raw], minlength=len(texts) * (width + 1)).reshape(len(texts), width + 1)
        # A character is every byte that doesn't go on with another one.
        signs = np.bincount(row[raw & 0xC0 != 0x80], minlength=len(texts))
        values = (counts[:, :width] / np.maximum(signs, 1)[:, None]).astype(np.float32)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * width), pa.array(values.ravel()))

    return F.when(seq.isNotNull(), shares(F.coalesce(seq, F.lit(""))))


def embed(df: DataFrame, embed_fn: EmbedFn | None = None, batch_size: int = 8,
          max_length: int = MAX_LENGTH, token_budget: int | None = None) -> DataFrame:
    """One vector per sequence, its ``composition`` or what a batch function gives: id, embedding.

    Rows are ordered by length inside their partition only, so batches hold similar lengths
    without shuffling the texts (a range shuffle by length would pile the long ones up). A batch has
    ``batch_size`` rows, or with ``token_budget`` as many as fit when all are padded to the longest (one at least).
    """
    short = truncate(df.select("id", "seq"), max_length)
    if embed_fn is None:
        return short.select("id", composition(F.col("seq")).alias("embedding"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_batches(batches, batch_size, token_budget):
            vectors = np.ascontiguousarray(embed_fn(texts), dtype=np.float32)
            offsets = pa.array(np.arange(len(vectors) + 1, dtype=np.int32) * vectors.shape[1])
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(offsets, pa.array(vectors.ravel()))], names=["id", "embedding"])

    ordered = short.sortWithinPartitions(F.length("seq"))
    return ordered.mapInArrow(run, f"id {type_of(df, 'id')}, embedding array<float>")


def text_batches(batches: Iterator[pa.RecordBatch], batch_size: int, token_budget: int | None) -> Iterator[tuple[pa.Array, list[str]]]:
    """Batches (ids, texts) of rows (id, seq) that come by rising length; they run on over the borders of Arrow batches."""
    ids, texts = None, []
    for batch in batches:
        ids = batch["id"] if ids is None else pa.concat_arrays([ids, batch["id"]])
        texts += batch["seq"].to_pylist()
        lo = 0
        while lo < len(texts):
            hi = lo + batch_size
            if token_budget is not None:
                hi = lo + 1
                while hi < len(texts) and (hi + 1 - lo) * len(texts[hi]) <= token_budget:
                    hi += 1
            if hi >= len(texts):  # more of the same length may come
                break
            yield ids[lo:hi], texts[lo:hi]
            lo = hi
        ids, texts = ids[lo:], texts[lo:]
    if texts:
        yield ids, texts


PLAN = "at long, step int, rows long, plan string"


def embed_rounds(df: DataFrame, path: str, embed_fn: EmbedFn | None = None, rounds: int = 16, name: str = "composition", **options) -> DataFrame:
    """``embed`` in rounds below ``path``, with which a broken run goes on: id, embedding.

    The sequences are dealt to ``rounds`` by a hash of their id and written first, each round to a folder of its own; from then on a run
    reads these, whatever has become of ``df``. A round counts once a row names it, so a run that was killed repeats one round
    at most. ``name`` stands for the function: a folder begun with another name, number of rounds or ``options`` is refused.
    """
    spark = df.sparkSession
    plan = json.dumps({"name": name, "rounds": rounds} | options, sort_keys=True)
    steps = embed_progress(spark, path)

    def done(step: int, table: DataFrame) -> None:
        spark.createDataFrame([(time.time_ns(), step, table.count(), plan)], PLAN).coalesce(1).write.mode("append").parquet(f"{path}/progress")

    if any(row["plan"] != plan for row in steps.values()):
        raise ValueError(f"{path} was begun as {next(iter(steps.values()))['plan']}, not as {plan}")
    kind = type_of(df, "id")
    sequences = spark.read.schema(f"id {kind}, seq string, round int").parquet
    vectors = spark.read.schema(f"id {kind}, embedding array<float>").parquet
    if -1 not in steps:
        short = truncate(df.select("id", "seq"), options.get("max_length", MAX_LENGTH))
        dealt = short.withColumn("round", F.pmod(F.xxhash64("id"), F.lit(rounds)).cast("int"))
        # Rebalancing gives a round as many files as its size asks for, instead of one per task.
        dealt.hint("rebalance", F.col("round")).write.mode("overwrite").partitionBy("round").parquet(f"{path}/sequences")
        done(-1, sequences(f"{path}/sequences"))
    for step in sorted(set(range(rounds)) - set(steps)):
        place = f"{path}/vectors/step={step}"
        own = sequences(f"{path}/sequences").where(F.col("round") == step)
        embed(own, embed_fn, **options).write.mode("overwrite").parquet(place)
        done(step, vectors(place))
    return vectors(*(f"{path}/vectors/step={step}" for step in range(rounds)))


def embed_progress(spark: SparkSession, path: str) -> dict:
    """What ``embed_rounds`` has finished below ``path``: step (-1: the sequences are dealt) -> its row."""
    try:
        rows = spark.read.schema(PLAN).parquet(f"{path}/progress").orderBy("at").collect()
    except AnalysisException:
        return {}
    return {row["step"]: row for row in rows}


def mean_pool(tokens: DataFrame, exclude_special: bool = False, max_length: int = MAX_LENGTH) -> DataFrame:
    """Mean token vector per id over the real tokens: id, embedding ARRAY<DOUBLE>.

    ``tokens``: id, pos, is_pad, embedding. With ``exclude_special`` the begin and end tokens are
    left out too and at most ``max_length`` inner positions count.
    """
    use = ~F.col("is_pad")
    if exclude_special:
        real = F.count(F.when(~F.col("is_pad"), 1)).over(Window.partitionBy("id"))
        tokens = tokens.withColumn("inner", F.least(real - 2, F.lit(max_length)))
        use = use & F.col("pos").between(F.lit(1), F.col("inner"))
    vector = F.col("embedding").cast("array<double>")
    masked = F.when(use, vector).otherwise(F.transform(vector, lambda _: F.lit(0.0)))
    sums = tokens.groupBy("id").agg(
        vector_to_array(Summarizer.sum(array_to_vector(masked))).alias("total"),
        F.sum(use.cast("double")).alias("used"))
    return sums.select("id", F.transform(
        "total", lambda x: x / F.greatest(F.col("used"), F.lit(MIN_DIVISOR))).alias("embedding"))
