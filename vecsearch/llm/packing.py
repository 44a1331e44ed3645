"""Packing token sequences: first-fit decreasing over a tournament tree of bin capacities, in random groups."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stored, plain_texts
from .token_counts import encoder

END_ID = 0  # closes every document
PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class CapacityTree:
    """Tournament tree over bins: every inner node holds the largest free capacity below it."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, (bins - 1).bit_length())
        self.best = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """Leftmost bin with room for ``size``; its capacity shrinks."""
        best, at = self.best, 1
        while at < self.leaves:
            at *= 2
            if best[at] < size:
                at += 1
        bin_, left = at - self.leaves, best[at] - size
        best[at] = left
        while at > 1:
            at //= 2
            top = max(best[2 * at], best[2 * at + 1])
            if best[at] == top:
                break
            best[at] = top
        return bin_


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every item; bins are numbered in the order they open."""
    order = np.argsort(-sizes, kind="stable")
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    full = int((sizes == capacity).sum())
    bins[order[:full]] = np.arange(full)
    rest = order[full:]
    tree, fill = CapacityTree(max(1, len(rest)), capacity), [0] * len(rest)
    for i, size in zip(rest.tolist(), sizes[rest].tolist()):
        b = tree.place(size)
        bins[i], offsets[i] = full + b, fill[b]
        fill[b] += size
    return bins, offsets


def cut_pieces(docs: DataFrame, path: str, length: int = 1024, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``length`` ids of every document, ``END_ID`` closing it; ``ids`` (little-endian 32-bit) on demand.

    ``slot`` numbers the pieces of a task: with it even repeated rows spread over groups.
    """
    def run(batches):
        coder, task, made = encoder(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            doc_ids, out = batch.column("doc_id").to_pylist(), []
            for doc, ids in zip(doc_ids, coder.ids(batch.column("text").to_pylist())):
                ids = np.append(ids, END_ID).astype("<u4")
                for at in range(0, len(ids), length):
                    part = ids[at:at + length].tobytes()
                    out.append((doc, at, len(part) // 4, zlib.crc32(part), len(ids), task << 40 | made, part if with_ids else None))
                    made += 1
            cols = list(zip(*out)) or [()] * 7
            arrays = [pa.array(c, pa.int64()) for c in cols[:6]] + ([pa.array(cols[6], pa.binary())] if with_ids else [])
            yield pa.RecordBatch.from_arrays(arrays, names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "slot"] + ["ids"] * with_ids
    schema = f"{PIECE_SCHEMA}, slot long" + (", ids binary" if with_ids else "")
    return plain_texts(docs).mapInArrow(run, schema)


def pack_pieces(pieces: DataFrame, length: int = 1024, group_rows: int = 8192) -> DataFrame:
    """``pieces`` (as ``cut_pieces`` makes them) with sequence_id and offset.

    Pieces go to random groups of about ``group_rows``; their number follows the number of pieces, which is counted, so a
    task holds one group whatever the size of the table. ``pieces`` should be stored, as it is read twice.
    """
    groups = max(1, -(-pieces.count() // group_rows))

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("slot", "ascending")])
        bins, offsets = first_fit_decreasing(table.column("length").to_numpy(), length)
        number = pc.add(pc.multiply(table.column("group"), 1 << 32), pa.array(bins))
        table = table.append_column("sequence_id", number).append_column("offset", pa.array(offsets))
        return table.select(names)

    names = [c for c in pieces.columns if c != "slot"] + ["sequence_id", "offset"]
    kept = [f"{c} {t}" for c, t in pieces.dtypes if c != "slot"]
    grouped = pieces.withColumn("group", F.pmod(F.xxhash64("slot"), F.lit(groups)))
    return grouped.groupBy("group").applyInArrow(pack, ", ".join([*kept, "sequence_id long", "offset long"]))


def pack_documents(docs: DataFrame, path: str, length: int = 1024, group_rows: int = 8192, with_ids: bool = False) -> DataFrame:
    """Packs all documents into sequences of at most ``length`` tokens, with little padding.

    A document is its token ids by the vocabulary file at ``path`` and ``END_ID``. Longer ones are cut at multiples of
    ``length``; full pieces are sequences of their own, the rest is packed by decreasing size, each into the leftmost
    sequence with room. One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).
    Null and empty texts give one piece of ``END_ID`` alone; a null doc_id stays null; repeated rows are packed
    each; further columns are ignored; an empty table gives no row.
    """
    pieces = Stored(cut_pieces(docs, path, length, with_ids), "pieces")
    return pack_pieces(pieces.df, length, group_rows)
