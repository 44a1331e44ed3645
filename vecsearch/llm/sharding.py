"""Shards of bounded size by extendible hashing.

The directory is indexed by the leading bits of a hash; a bucket over the byte limit, and only such a one, is split on its
next bit. Sizes are summed for many bits at once: a round counts the buckets ``STEP`` bits further down, rolls them up,
and takes for each the shortest prefix that fits. Buckets too large even then go into the next round, alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stored, drop_all, fresh

KEY_BITS = 60  # of the hash of doc_id; further bits tell rows of one doc_id apart
STEP = 12
MOST_BITS = 2 * KEY_BITS


def key_hash(doc_id: Column) -> Column:
    """First 60 bits of the MD5 of doc_id as text (null: of the empty text)."""
    hex15 = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 15)
    return F.conv(hex15, 16, 10).cast("long")


def prefix(depth: Column | int) -> Column:
    """The leading ``depth`` bits of a row, as a text of 0 and 1."""
    bits = F.concat(F.lpad(F.bin("key"), KEY_BITS, "0"), F.lpad(F.bin("salt"), KEY_BITS, "0"))
    return F.substring(bits, F.lit(1), F.lit(depth) if isinstance(depth, int) else depth)


def assign(rows: DataFrame, limit: int) -> tuple[DataFrame, list[Stored]]:
    """Shard of every row (row, key, salt, n_bytes): row, shard (hash prefix), depth, shard_bytes."""
    left, base, done, kept = Stored(rows, "shard_rows"), 0, [], []
    kept.append(left)
    while base < MOST_BITS:
        deep = base + STEP
        fine = left.df.groupBy(prefix(deep).alias("leaf")).agg(F.sum("n_bytes").alias("bytes"), F.count("row").alias("rows"))
        fine = Stored(fine, "shard_leaves")
        up = fine.df.select("leaf", "bytes", "rows", F.explode(F.sequence(F.lit(base), F.lit(deep))).alias("depth"))
        up = up.withColumn("shard", F.substring(F.col("leaf"), F.lit(1), F.col("depth")))
        sizes = up.groupBy("shard", "depth").agg(F.sum("bytes").alias("shard_bytes"), F.sum("rows").alias("rows"))
        fits = sizes.where((F.col("shard_bytes") <= limit) | (F.col("rows") == 1) | (F.col("depth") == MOST_BITS))
        chosen = up.select("leaf", "shard").join(fits, "shard").groupBy("leaf").agg(F.min(F.struct("depth", "shard", "shard_bytes")).alias("s"))
        directory = Stored(chosen, "shard_directory")
        tagged = left.df.withColumn("leaf", prefix(deep)).join(directory.df, "leaf", "left")
        done.append(tagged.where("s is not null").select("row", "s.shard", "s.depth", "s.shard_bytes"))
        kept += [fine, directory]
        over = Stored(tagged.where("s is null").select("row", "key", "salt", "n_bytes"), "shard_rows")
        kept.append(over)
        if not over.df.limit(1).count():
            break
        left, base = over, deep
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out, kept


def shard_documents(docs: DataFrame, limit: int = 256 << 20) -> DataFrame:
    """doc_id, n_bytes, shard, depth and shard_bytes of every row, so that no shard holds more than ``limit`` bytes of text.

    A shard is named by its hash prefix (``depth`` bits). The hash is that of doc_id; rows that share a doc_id (or have none)
    are split by bits of their own once nothing else is left. A single text over the limit is a shard alone. Null texts have 0 bytes;
    further columns are ignored; an empty table gives no row.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long").alias("n_bytes"))
    numbered = Stored(plain.withColumn("row", F.monotonically_increasing_id()), "shard_documents")
    mask = F.lit((1 << KEY_BITS) - 1)
    rows = numbered.df.select("row", key_hash(F.col("doc_id")).alias("key"), F.xxhash64("row").bitwiseAND(mask).alias("salt"), "n_bytes")
    shards, _ = assign(rows, limit)
    return numbered.df.join(shards, "row").select("doc_id", "n_bytes", "shard", "depth", "shard_bytes")


def write_shards(docs: DataFrame, path: str, limit: int = 256 << 20) -> None:
    """Writes ``docs``, all columns, into one folder per shard (``shard=<bits>``, ``root`` if nothing was split)."""
    row, shard = fresh(docs, "row_number"), fresh(docs, "shard")
    numbered = Stored(docs.withColumn(row, F.monotonically_increasing_id()), "shard_documents")
    mask = F.lit((1 << KEY_BITS) - 1)
    size = F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long")
    rows = numbered.df.select(F.col(row).alias("row"), key_hash(F.col("doc_id")).alias("key"), F.xxhash64(row).bitwiseAND(mask).alias("salt"), size.alias("n_bytes"))
    shards, kept = assign(rows, limit)
    name = F.when(F.col("shard") == "", F.lit("root")).otherwise(F.concat(F.lit("b"), F.col("shard")))
    names = shards.select(F.col("row").alias(row), name.alias(shard))
    numbered.df.join(names, row).drop(row).repartition(shard).write.partitionBy(shard).parquet(path)
    drop_all([numbered, *kept])
