"""Corpus pipeline: toxic documents go, then repeated lines, near duplicates and benchmark leaks; the rest is packed.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecsearch.llm import toxicity as tox
from vecsearch.llm.common import Stored, read_table
from vecsearch.llm.decontamination import drop_contaminated
from vecsearch.llm.line_dedup import drop_repeated_lines
from vecsearch.llm.minhash import one_of_each
from vecsearch.llm.packing import pack_documents
from vecsearch.llm.queries import VOCABULARY
from vecsearch.operators.common import scratch_scope


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below their language's threshold; the network learns from the labelled ones among them."""
    return tox.drop_toxic(docs, tox.train(docs, read_table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later occurrences of three lines, ``n_chars`` adjusted; a document left without text goes."""
    lean = drop_repeated_lines(docs)
    changed = F.col("lines_removed") > 0
    lean = lean.where(~(changed & (F.trim("text") == "")))
    return lean.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars"))).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (smallest doc_id) of every component of near duplicates."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"), null_ids=True)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of 1024."""
    return pack_documents(docs, VOCABULARY)


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("packing", packing)]

# A learned classifier decides in the first stage, which SQL can't express; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a data folder, each written and read again before the next.

    What a stage has written for itself goes when its result is written, and that result when the next stage's is.
    """
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch_scope() as kept:
            done = Stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
            kept.append(done.path)
        if before is not None:
            before.drop()
        docs, before = done.df, done
    return STAGES[-1][1](spark, docs, sf_dir)
