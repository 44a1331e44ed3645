"""Language of a text by a byte convolution network over fixed-length windows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_sample, plain_texts
from .convnet import ConvNet, Embedding, softmax

WINDOW = 256
BATCH = 256  # windows scored at once
UNKNOWN = "und"
MOST_LANGUAGES = 256


@dataclass
class LanguageModel:
    names: list[str]
    net: ConvNet | None
    table: np.ndarray | None

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """Per window of bytes (rows, padded with 0) the probability of every language."""
        gap = self.net.gap
        wide = np.zeros((len(windows), windows.shape[1] + gap), np.uint8)
        wide[:, :windows.shape[1]] = windows
        x = self.table[wide.ravel()]
        begin = np.arange(len(windows)) * wide.shape[1]
        return softmax(self.net.logits(self.net.pooled(x, begin, begin + windows.shape[1])))


def windows_of(raw: bytes) -> np.ndarray:
    """All bytes in rows of ``WINDOW``, the last one padded; a short rest joins the last full window by overlapping it."""
    if len(raw) <= WINDOW:
        return np.frombuffer(raw.ljust(WINDOW, b"\0"), np.uint8)[None]
    full, rest = divmod(len(raw), WINDOW)
    a = np.frombuffer(raw, np.uint8)
    out = a[:full * WINDOW].reshape(full, WINDOW)
    return np.vstack([out, a[-WINDOW:]]) if rest else out


def training_part(doc_id: Column) -> Column:
    """Rows that may be learned from: crc32 of the doc_id as text, modulo 5, isn't 0."""
    return F.crc32(doc_id.cast("string")) % 5 != 0


def train(docs: DataFrame, per_language: int = 600, chars_each: int = 4096, windows_each: int = 6, epochs: int = 6,
          seed: int = 3) -> LanguageModel:
    """Fits the network on a bounded sample: ``per_language`` documents of each language, ``chars_each`` characters of each.

    The documents with the smallest hash of doc_id are taken, of each a stretch at a place that this hash gives. Only the fit
    is bounded; predictions cover whole texts. With no usable row the model knows no language. Of more than ``MOST_LANGUAGES``
    values of ``lang`` the commonest are learned (ties: the smaller), so a column of free text can't swell the model.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & training_part(F.col("doc_id")))
    rows = rows.where(F.col("text").rlike(r"\p{L}"))
    h = F.xxhash64("doc_id")
    ids = hash_sample(rows.select("doc_id", "lang").distinct(), "lang", "doc_id", per_language, MOST_LANGUAGES)
    spot = F.pmod(h, F.greatest(F.lit(1), F.length("text") - chars_each)).cast("int") + 1
    part = rows.join(F.broadcast(ids), ["doc_id", "lang"]).select("doc_id", "lang", F.substring(F.col("text"), spot, F.lit(chars_each)).alias("text"))
    sample = part.groupBy("doc_id", "lang").agg(F.min("text").alias("text")).toArrow()
    names = sorted(set(sample.column("lang").to_pylist()))
    if not names:
        return LanguageModel([], None, None)
    rng = np.random.default_rng(seed)
    x, y = [], []
    for lang, text in sorted(zip(sample.column("lang").to_pylist(), sample.column("text").to_pylist())):
        raw = text.encode()
        for at in rng.integers(0, max(1, len(raw) - WINDOW + 1), windows_each if len(raw) > WINDOW else 1).tolist():
            part = raw[at:at + int(rng.integers(24, WINDOW + 1))] if rng.random() < 0.4 else raw[at:at + WINDOW]
            x.append(np.frombuffer(part[:WINDOW].ljust(WINDOW, b"\0"), np.uint8))
            y.append(names.index(lang))
    x, y = np.stack(x), np.array(y)
    net, emb = ConvNet(8, (2, 3, 4), 16, len(names), seed), Embedding(256, 8, seed, 0.5)
    share = np.bincount(y, minlength=len(names))
    weight = (len(y) / (len(names) * share))[y].astype(np.float32)
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for i in range(0, len(order), 64):
            part = order[i:i + 64]
            wide = np.zeros((len(part), WINDOW + net.gap), np.uint8)
            wide[:, :WINDOW] = x[part]
            flat = wide.ravel()
            begin = np.arange(len(part)) * wide.shape[1]
            at, grad, _ = net.step(emb.table[flat], begin, begin + WINDOW, y[part], weight[part], 0.004 / (1 + epoch))
            emb.learn(flat[at], grad, 0.004 / (1 + epoch))
    return LanguageModel(names, net, emb.table)


def predict(texts: list[str | None], model: LanguageModel) -> tuple[list[str], list[float]]:
    """Language and its probability (mean over all windows, by their bytes) of every whole text."""
    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if not model.names:
        return names, scores
    total = np.zeros((len(texts), len(model.names)))
    waiting: list[tuple[int, np.ndarray]] = []

    def flush() -> None:
        if waiting:
            owner = np.repeat([i for i, _ in waiting], [len(w) for _, w in waiting])
            w = np.concatenate([w for _, w in waiting])
            for at in range(0, len(w), BATCH):
                part = w[at:at + BATCH]
                np.add.at(total, owner[at:at + BATCH], model.probabilities(part) * (part != 0).sum(1, keepdims=True))
            waiting.clear()

    held, known = 0, []
    for i, text in enumerate(texts):
        if text and any(map(str.isalpha, text)):  # Unicode category L
            known.append(i)
            waiting.append((i, windows_of(text.encode())))
            held += len(waiting[-1][1])
            if held >= 4 * BATCH:
                flush()
                held = 0
    flush()
    for i in known:
        p = total[i] / max(total[i].sum(), 1e-12)
        best = int(np.argmax(p))
        names[i], scores[i] = model.names[best], float(min(1.0, p[best]))
    return names, scores


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred and score (0 to 1) of every row, from its whole text alone.

    A null text or one without letters gives ``und`` and score 0, as does a model that knows no language. A null doc_id stays
    null; repeated rows give repeated rows; further columns are ignored; an empty table gives no row.
    """
    def run(batches):
        for batch in batches:
            names, scores = predict(batch.column("text").to_pylist(), model)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             ["doc_id", "lang_pred", "score"])

    return plain_texts(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")
