"""Toxicity of whole texts by a convolution network over hashed word embeddings."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from copy import deepcopy
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stored
from .convnet import ConvNet, Embedding, laid_out

DIM, WIDTHS, FILTERS = 16, (1, 2, 3), 24
BUCKET_BITS = 18
PREFIXES = (4, 5, 6)
SMOOTH, READERS = 6.0, 4
CUT = 0.7
CHUNK = 1 << 15  # words that the network sees at once
BATCH, HELD = 16, 5  # documents of a training step; one labelled document in HELD calibrates
TURNS, TASK_DOCS, TASKS_A_CORE = 4, 2000, 4
STEPS_A_UNIT, FARTHEST = 1024, 64  # log-odds of calibrating documents are counted in steps of this share, up to this size
_ROOM = 100_000
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def features(word: str) -> list[int]:
    """64-bit hashes of a word and its beginnings."""
    return [xxhash.xxh64_intdigest(word, 1)] + [xxhash.xxh64_intdigest(word[:n], n) for n in PREFIXES if len(word) > n]


def hashes_of(words: list[str]) -> np.ndarray:
    """``features`` of many words, a row each; 0: the word is too short for that beginning."""
    h = np.zeros((len(words), 1 + len(PREFIXES)), np.uint64)
    h[:, 0] = np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(1)), np.uint64, len(words))
    length = np.fromiter(map(len, words), np.int64, len(words))
    for j, n in enumerate(PREFIXES, 1):
        longer = np.flatnonzero(length > n).tolist()
        h[longer, j] = np.fromiter((xxhash.xxh64_intdigest(words[i][:n], n) for i in longer), np.uint64, len(longer))
    return h


@dataclass
class HashedWords:
    """Hash table of the features seen in training: bucket -> embedding row, with a check that tells strangers apart."""

    check: np.ndarray = field(default_factory=lambda: np.zeros(1 << BUCKET_BITS, np.uint32))
    row: np.ndarray = field(default_factory=lambda: np.zeros(1 << BUCKET_BITS, np.int32))

    @staticmethod
    def fit(counts: dict[str, int], least: int = 2) -> "HashedWords":
        """Features of at least ``least`` of the counted words; of two in one bucket the more frequent stays."""
        seen: Counter[int] = Counter()
        for word, n in counts.items():
            for f in features(word):
                seen[f] += n
        out, rows = HashedWords(), 0
        for f, n in sorted(seen.items(), key=lambda x: (-x[1], x[0])):
            b = f >> (64 - BUCKET_BITS)
            if n >= least and not out.row[b]:
                rows += 1
                out.row[b], out.check[b] = rows, f & 0xFFFFFFFF
        return out

    @staticmethod
    def of(features: np.ndarray) -> "HashedWords":
        """The table of features of different buckets, in the order of their rows."""
        out = HashedWords()
        b = (features >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        out.row[b], out.check[b] = np.arange(1, len(features) + 1), features & np.uint64(0xFFFFFFFF)
        return out

    @property
    def rows(self) -> int:
        return int(self.row.max()) + 1

    def lookup(self, words: list[str]) -> np.ndarray:
        """Embedding rows of every word's features (0: none)."""
        h = hashes_of(words)
        b = (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        return np.where((self.check[b] == (h & np.uint64(0xFFFFFFFF))) & (h != 0), self.row[b], 0)


class ToxicityModel:
    """Network, embeddings and calibration; without a network every score is ``prior``."""

    def __init__(self, prior: float):
        self.prior, self.net = prior, None
        self.slope, self.shift = 1.0, 0.0
        self.thresholds: dict[str, float] = {}
        self._memory: dict[str, int] = {}
        self._rows: np.ndarray | None = None

    def __getstate__(self):
        return self.__dict__ | {"_memory": {}, "_rows": None}

    def forget(self) -> None:
        """Drop remembered words, whose embeddings have changed."""
        self._memory, self._rows = {}, None

    def _known(self, words: set[str]) -> None:
        """Embeddings of new words join the worker's memory of words."""
        if len(self._memory) > _ROOM or self._rows is None:
            self._memory, self._rows = {}, np.zeros((1 << 12, DIM), np.float32)
        new = [w for w in words if w not in self._memory]
        if not new:
            return
        n = len(self._memory)
        while n + len(new) > len(self._rows):
            self._rows = np.concatenate([self._rows, np.zeros_like(self._rows)])
        self._rows[n:n + len(new)] = self.table[self.hashed.lookup(new)].sum(axis=1)
        self._memory.update(zip(new, range(n, n + len(new))))

    def _pooled(self, segments: list[list[str]]) -> np.ndarray:
        self._known({w for s in segments for w in s})
        get = self._memory.__getitem__
        lengths = np.array([len(s) for s in segments])
        begin, end, total = laid_out(lengths, self.net.gap)
        x = np.zeros((total, DIM), np.float32)
        for s, a, b in zip(segments, begin.tolist(), end.tolist()):
            x[a:b] = self._rows[np.fromiter(map(get, s), np.int64, len(s))]
        return self.net.pooled(x, begin, np.minimum(end, begin + CHUNK))  # what overlaps only completes the windows before it

    def logits(self, texts: Iterable[list[str]], n: int) -> np.ndarray:
        """Log-odds of ``n`` texts; any length, in chunks of ``CHUNK`` words that overlap by a filter's width.

        ``texts`` may be a generator: only the words of about two chunks are held at a time.
        """
        top = np.full((n, FILTERS * len(WIDTHS)), -1e9, np.float32)
        group, owner, size = [], [], 0

        def flush() -> None:
            if group:
                np.maximum.at(top, owner, self._pooled(group))

        for i, words in enumerate(texts):
            for at in range(0, len(words), CHUNK):
                group.append(words[at:at + CHUNK + self.net.gap])
                owner.append(i)
                size += len(group[-1])
                if size >= CHUNK:
                    flush()
                    group, owner, size = [], [], 0
        flush()
        z = self.net.logits(top).astype(np.float64)
        return z[:, 1] - z[:, 0]

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.net is None:
            return np.full(len(texts), self.prior)
        z = self.slope * self.logits(map(words_of, texts), len(texts)) + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def training_part(doc_id: Column) -> Column:
    """Rows whose labels may be learned from: crc32 of the doc_id as text, modulo 3, isn't 1."""
    return F.crc32(doc_id.cast("string")) % 3 != 1


def train(docs: DataFrame, labels: DataFrame, per_class: int = 3000, longest: int = 40_000, least_steps: int = 400, seed: int = 7) -> ToxicityModel:
    """Fits and calibrates on the whole texts of all labelled documents; a fifth of them is kept from the fit for the calibration.

    Up to ``per_class`` documents of each label, none longer than ``longest`` characters, are fitted on the driver; more or longer ones
    over the cluster (``fit_distributed``). Labels other than 0 and 1 are ignored; of several labels of a doc_id the larger counts.
    """
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    marks = marks.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & training_part(F.col("doc_id")))
    marks = marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    rows = rows.where(F.col("text").isNotNull() & training_part(F.col("doc_id"))).join(marks, "doc_id").groupBy("doc_id", "toxic").agg(
        F.min_by("text", "text").alias("text"), F.min_by("lang", "text").alias("lang"))
    kept = Stored(rows, "toxicity_labelled")
    try:
        sizes = kept.df.groupBy("toxic").agg(F.count(F.lit(1)).alias("n"), F.max(F.length("text")).alias("longest")).collect()
        if all(r["n"] <= per_class and r["longest"] <= longest for r in sizes):
            return fit(sorted(kept.df.toArrow().to_pylist(), key=lambda r: r["doc_id"]), least_steps, seed)
        return fit_distributed(kept.df, {r["toxic"]: r["n"] for r in sizes}, least_steps, seed)
    finally:
        kept.drop()


def fit_distributed(labelled: DataFrame, sizes: dict[int, int], least_steps: int, seed: int) -> ToxicityModel:
    """The model of any number of rows (doc_id, toxic, text, lang), ``sizes`` of each label.

    Features are counted over all rows. Then the rows pass in turns: every task goes over its own in small steps from the same
    weights, and the moves of all tasks are averaged. Many rows take part in one turn each, few in every turn until ``least_steps`` are
    made; then the turn of the lowest held-out loss counts. The driver sees weights and counts only, whose size the parameters bound.
    """
    model = ToxicityModel(sizes.get(1, 0) / max(1, sum(sizes.values())))
    no_net = ToxicityModel(min(0.5, model.prior))
    if len(sizes) < 2:
        return no_net
    slot = lambda k, n: F.pmod(F.xxhash64("doc_id", F.lit(seed), F.lit(k)), F.lit(n))
    apart = slot(0, HELD) == 0 if min(sizes.values()) >= 4 * HELD else F.lit(False)  # so many that the fit surely has both labels
    used, held = labelled.where(~apart), labelled.where(apart)
    counts = Stored(feature_counts(used), "toxicity_features")
    try:
        share = counts.df.where("feature is null").select("clean", "toxic").first()
        if share is None or not min(share):
            return no_net
        bucket = F.shiftrightunsigned("feature", 64 - BUCKET_BITS)
        first = F.min(F.struct((-F.col("words")).alias("order"), "feature", "clean", "toxic")).alias("first")  # in a bucket signs are alike
        best = counts.df.where("feature is not null and words >= 2").groupBy(bucket).agg(first).select("first.*").toArrow()
    finally:
        counts.drop()
    order, feature = best.column("order").to_numpy(), best.column("feature").to_numpy().view(np.uint64)
    by = np.lexsort((feature, order))
    model.hashed = HashedWords.of(feature[by])
    net, emb = ConvNet(DIM, WIDTHS, FILTERS, 2, seed), Embedding(len(by) + 1, DIM, seed)
    model.net, model.table = net, emb.table
    share = np.array(share)
    _start_from(net, emb, np.stack([np.append(0, best.column(c).to_numpy()[by]) for c in ("clean", "toxic")]), share[1] / share.sum())
    weight = (share.sum() / (2 * share)).astype(np.float32)
    few = share.sum() < TURNS * least_steps * BATCH
    turns = max(TURNS, -(-least_steps * BATCH // int(share.sum())))
    tasks = int(max(1, min(TASKS_A_CORE * labelled.sparkSession.sparkContext.defaultParallelism, share.sum() // TASK_DOCS)))
    least, kept = np.inf, None
    for turn in range(turns):
        rate = 0.003 * (1 - 0.9 * turn / turns)
        _average_turn((used if few else used.where(slot(1, turns) == turn)).coalesce(tasks), model, weight, rate, seed + turn)
        model.forget()
        if few and min(sizes.values()) >= 4 * HELD and (loss := _counted_loss(_counted(held, model).groupBy("toxic", "step").agg(F.sum("n").alias("n")))) < least:
            least, kept = loss, (deepcopy(net.params), model.table.copy())
    if kept:
        net.params, model.table = kept
        model.forget()
    if min(sizes.values()) >= 4 * HELD:
        _calibrate_counted(model, held)
    return model


def feature_counts(rows: DataFrame) -> DataFrame:
    """feature (signed), words (of documents, summed over the feature's words), clean and toxic (documents with it); the row of
    null counts the documents that have words."""
    def counted(words: list[str], own: list[np.ndarray], label: list[int]) -> pa.RecordBatch:
        hashes = hashes_of(words)
        feature, place = np.unique(hashes, return_inverse=True)
        place = place.reshape(hashes.shape)
        of_word = np.bincount(np.concatenate(own), minlength=len(words))
        n = np.bincount(place.ravel(), np.repeat(of_word, hashes.shape[1]), len(feature)).astype(np.int64)
        docs = np.zeros((2, len(feature)), np.int64)
        for w, toxic in zip(own, label):
            docs[toxic, np.unique(place[w])] += 1
        real = feature != 0
        total = np.bincount(label, minlength=2)
        last = np.append(np.zeros(real.sum(), bool), True)
        columns = [pa.array(np.append(feature[real].view(np.int64), 0), mask=last), *(pa.array(np.append(x[real], y)) for x, y in zip((n, *docs), (0, *total)))]
        return pa.RecordBatch.from_arrays(columns, ["feature", "words", "clean", "toxic"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number: dict[str, int] = {}
            own, label = [], []  # distinct words and label of every document that has words
            for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                if words := set(words_of(text.as_py())):
                    own.append(np.array([number.setdefault(w, len(number)) for w in words], np.int32))
                    label.append(toxic)
                if len(number) > _ROOM:
                    yield counted(list(number), own, label)
                    number, own, label = {}, [], []
            if number:
                yield counted(list(number), own, label)

    made = rows.select("toxic", "text").mapInArrow(count, "feature long, words long, clean long, toxic long")
    return made.groupBy("feature").agg(*[F.sum(c).alias(c) for c in ("words", "clean", "toxic")])


class _Learner:
    """What a task carries past its rows: its own copy of the weights, and the feature rows of words it has met."""

    def __init__(self, model: ToxicityModel, seed: int):
        self.hashed, self.net = model.hashed, deepcopy(model.net)
        self.net.rested()
        self.emb = Embedding(1, DIM, seed)
        self.emb.begin(model.table)
        self.rng = np.random.default_rng(seed)
        self.number: dict[str, int] = {}
        self.rows = np.zeros((0, 1 + len(PREFIXES)), np.int32)
        self.touched = np.zeros(len(model.table), bool)

    def _rows_of(self, words: set[str]) -> None:
        if len(self.number) > _ROOM:
            self.number, self.rows = {}, self.rows[:0]
        new = [w for w in words if w not in self.number]
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
        if new:
            self.rows = np.concatenate([self.rows, self.hashed.lookup(new).astype(np.int32)])

    def learn(self, texts: list[list[str]], target: np.ndarray, weight: np.ndarray, rate: float) -> None:
        """One step on some texts of any length, each with words; a tenth of the words is hidden."""
        net = self.net
        self._rows_of({w for t in texts for w in t})
        begin = np.cumsum([0] + [len(t) for t in texts])
        own = np.fromiter((self.number[w] for t in texts for w in t), np.int64, begin[-1])
        seen, own = np.unique(own, return_inverse=True)
        rows = self.rows[seen]
        vectors = self.emb.table[rows].sum(axis=1)
        shown = self.rng.random(len(own)) > 0.1
        tops = [np.full((len(texts), net.filters), -np.inf, np.float32) for _ in net.widths]
        where = [np.zeros((len(texts), net.filters), np.int64) for _ in net.widths]
        group, size = [], 0

        def flush() -> None:
            a, b, total = laid_out(np.array([hi - lo for _, lo, hi in group]), net.gap)
            x = np.zeros((total, DIM), np.float32)
            for (_, lo, hi), i, j in zip(group, a.tolist(), b.tolist()):
                x[i:j] = vectors[own[lo:hi]] * shown[lo:hi, None]
            for j, (at, top) in enumerate(zip(*net.located(x, a, np.minimum(b, a + CHUNK)))):
                for n, (i, lo, _) in enumerate(group):
                    better = top[n] > tops[j][i]
                    tops[j][i][better], where[j][i][better] = top[n][better], lo + at[n][better]

        for i in range(len(texts)):
            for lo in range(begin[i], begin[i + 1], CHUNK):
                group.append((i, lo, min(lo + CHUNK + net.gap, begin[i + 1])))
                size += group[-1][2] - lo
                if size >= CHUNK:
                    flush()
                    group, size = [], 0
        if group:
            flush()
        inside, words = [], []
        for at, w in zip(where, net.widths):
            inside.append([]), words.append([])
            for k in range(w):
                place = np.minimum(at + k, begin[1:, None] - 1)
                live = shown[place] & (at + k < begin[1:, None])
                inside[-1].append(vectors[own[place]] * live[:, :, None])
                words[-1].append(np.where(live, own[place], -1).ravel())
        back, _ = net.update(tops, inside, target, weight[target], rate)
        word = np.concatenate([w for each in words for w in each])
        grad = np.concatenate([g.reshape(-1, DIM) for each in back for g in each])
        some = (word >= 0) & grad.any(axis=1)
        near, grad = rows[word[some]], grad[some]
        self.emb.learn(near.ravel(), np.repeat(grad, near.shape[1], axis=0), rate)
        self.touched[near.ravel()] = True


def _average_turn(rows: DataFrame, model: ToxicityModel, weight: np.ndarray, rate: float, seed: int) -> None:
    """Every task learns from its rows, starting from the model; an embedding moves by the mean of the tasks that moved it, other weights by
    that of all tasks. Weights lie in rows of ``DIM``, those of the network below zero."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    names = [f"d{i}" for i in range(DIM)]

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner = None
        for batch in batches:
            learner = learner or _Learner(shared.value, seed)
            text, label = batch.column("text"), batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
            order = learner.rng.permutation(batch.num_rows)
            for at in range(0, len(order), BATCH):
                part = order[at:at + BATCH]
                texts = [words_of(text[i].as_py()) for i in part.tolist()]
                some = [j for j, t in enumerate(texts) if t]
                if some:
                    learner.learn([texts[j] for j in some], label[part[some]], weight, rate)
        if learner is not None:
            moved = np.flatnonzero(learner.touched)
            other = _laid(learner.net.params) - _laid(shared.value.net.params)
            table = np.concatenate([learner.emb.table[moved] - shared.value.table[moved], other])
            places = pa.array(np.concatenate([moved, -1 - np.arange(len(other))]).astype(np.int32))
            whole = pa.RecordBatch.from_arrays([places, *(pa.array(table[:, i]) for i in range(DIM))], ["place", *names])
            yield from (whole.slice(at, 10_000) for at in range(0, whole.num_rows, 10_000))

    made = rows.select("doc_id", "text", "toxic").mapInArrow(learn, ", ".join(["place int", *(f"{n} float" for n in names)]))
    moves = made.groupBy("place").agg(*[F.avg(n).cast("float").alias(n) for n in names]).toArrow()
    shared.unpersist()
    place, moved = moves.column("place").to_numpy(), np.stack([moves.column(n).to_numpy() for n in names], 1)
    model.table[place[place >= 0]] += moved[place >= 0]
    flat = _laid(model.net.params)
    flat[-1 - place[place < 0]] += moved[place < 0]
    at, flat = 0, flat.ravel()
    for name in sorted(model.net.params):
        p = model.net.params[name]
        p[...] = flat[at:at + p.size].reshape(p.shape)
        at += p.size


def _laid(params: dict[str, np.ndarray]) -> np.ndarray:
    """All parameters behind one another, in rows of ``DIM``."""
    flat = np.concatenate([params[k].ravel() for k in sorted(params)])
    return np.append(flat, np.zeros(-len(flat) % DIM, np.float32)).reshape(-1, DIM)


def _counted(held: DataFrame, model: ToxicityModel) -> DataFrame:
    """lang, toxic, step (of the log-odds), n documents."""
    @F.arrow_udf("int")
    def step(text: pa.Array) -> pa.Array:
        texts = text.to_pylist()
        z = np.clip(model.logits(map(words_of, texts), len(texts)), -FARTHEST, FARTHEST)
        return pa.array(np.round(z * STEPS_A_UNIT).astype(np.int32))

    return held.select("lang", "toxic", step("text").alias("step")).groupBy("lang", "toxic", "step").agg(F.count(F.lit(1)).alias("n"))


def _counted_loss(counts: DataFrame) -> float:
    """``_held_loss`` of counted documents."""
    table = counts.toArrow()
    z, y, n = table.column("step").to_numpy() / STEPS_A_UNIT, table.column("toxic").to_numpy(), table.column("n").to_numpy()
    each = np.logaddexp(0, np.where(y == 1, -z, z))
    return float(np.mean([np.average(each[y == label], weights=n[y == label]) for label in set(y.tolist())])) if len(y) else np.inf


def _calibrate_counted(model: ToxicityModel, held: DataFrame) -> None:
    """``_calibrate`` on documents counted by language, label and step of their log-odds; a language's cut is found by the cluster."""
    def cuts(table: pa.Table) -> pa.Table:
        y, n = table.column("toxic").to_numpy(), table.column("n").to_numpy()
        lang, cut = [], []
        if min(n[y == 1].sum(), n[y == 0].sum()) >= 20:
            lang, cut = [table.column("lang")[0].as_py()], [_best_cut(table.column("step").to_numpy() / STEPS_A_UNIT, y, n)]
        return pa.table({"lang": pa.array(lang, pa.string()), "cut": pa.array(cut, pa.float64())})

    counts = Stored(_counted(held, model), "toxicity_held")
    try:
        every = counts.df.groupBy("toxic", "step").agg(F.sum("n").alias("n")).toArrow()
        by_lang = counts.df.where("lang is not null").groupBy("lang").applyInArrow(cuts, "lang string, cut double").collect()
    finally:
        counts.drop()
    y, n = every.column("toxic").to_numpy(), every.column("n").to_numpy()
    if len(set(y.tolist())) < 2:
        return
    z = every.column("step").to_numpy() / STEPS_A_UNIT
    middle = _best_cut(z, y, n)
    model.slope = float(np.clip(4 / max(1e-6, np.average(np.abs(z - middle), weights=n)), 0.2, 4))
    model.shift = float(np.log(CUT / (1 - CUT)) - model.slope * middle)
    for r in sorted(by_lang):
        model.thresholds[r["lang"]] = float(np.clip(1 / (1 + np.exp(-(model.slope * r["cut"] + model.shift))), 0.5, 0.9))


def fit(sample: list[dict], least_steps: int, seed: int) -> ToxicityModel:
    """The model of some rows (doc_id, text, lang, toxic)."""
    y = np.array([r["toxic"] for r in sample], np.int64)
    if len(set(y.tolist())) < 2:
        return ToxicityModel(min(0.5, float(y.mean())) if len(y) else 0.0)
    number: dict[str, int] = {}
    texts = []  # words as numbers: each word is held once
    for r in sample:
        texts.append(np.array([number.setdefault(w, len(number)) for w in words_of(r.pop("text"))], np.int32))
    names = list(number)
    rng = np.random.default_rng(seed)
    held = np.zeros(len(y), bool)
    for label in (0, 1):
        rows_of = rng.permutation(np.flatnonzero(y == label))
        held[rows_of[:len(rows_of) // 5]] = True
    model = ToxicityModel(float(y.mean()))
    used = [i for i in np.flatnonzero(~held).tolist() if len(texts[i])]
    if not used:
        return ToxicityModel(min(0.5, float(y.mean())))
    seen = np.zeros(len(names), np.int64)
    for i in used:
        seen[np.unique(texts[i])] += 1
    model.hashed = HashedWords.fit({names[w]: int(seen[w]) for w in np.flatnonzero(seen).tolist()})
    rows_of_word = np.concatenate([model.hashed.lookup(names[at:at + CHUNK]) for at in range(0, len(names), CHUNK)]).astype(np.int32)
    net, emb = ConvNet(DIM, WIDTHS, FILTERS, 2, seed), Embedding(model.hashed.rows, DIM, seed)
    model.net, model.table = net, emb.table
    _start(net, emb, [rows_of_word[np.unique(texts[i])] for i in used], y[used])
    share = np.bincount(y[used], minlength=2)
    weight = (len(used) / (2 * np.maximum(share, 1))).astype(np.float32)
    batch = 16
    epochs = max(3, -(-least_steps * batch // max(1, len(used))))
    apart = [[names[w] for w in texts[i].tolist()] for i in np.flatnonzero(held)]
    best, kept = np.inf, None
    for epoch in range(epochs):
        rate = 0.003 * (1 - 0.9 * epoch / epochs)
        order = rng.permutation(len(used))
        for i in range(0, len(order), batch):
            part = order[i:i + batch]
            lengths = np.array([len(texts[used[j]]) for j in part])
            begin, end, total = laid_out(lengths, net.gap)
            rows = np.zeros((total, 1 + len(PREFIXES)), np.int32)
            for j, a, b in zip(part, begin.tolist(), end.tolist()):
                rows[a:b] = rows_of_word[texts[used[j]]] * (rng.random((b - a, 1)) > 0.1)  # a tenth of the words is hidden in each pass
            x = emb.table[rows].sum(axis=1)
            target = y[[used[j] for j in part]]
            at, grad, _ = net.step(x, begin, end, target, weight[target], rate)
            near = rows[at]
            emb.learn(near.ravel(), np.repeat(grad, near.shape[1], axis=0), rate)
        model.forget()
        if len(apart) and (loss := _held_loss(model.logits(apart, len(apart)), y[held])) < best:
            best, kept = loss, (deepcopy(net.params), emb.table.copy())
    if kept:
        net.params, model.table = kept
        model.forget()
    _calibrate(model, apart, y[held], [sample[i]["lang"] for i in np.flatnonzero(held)])
    return model


def _held_loss(z: np.ndarray, y: np.ndarray) -> float:
    """Logistic loss, both labels weighing alike."""
    each = np.logaddexp(0, np.where(y == 1, -z, z))
    return float(np.mean([each[y == label].mean() for label in set(y.tolist())]))


def _start(net: ConvNet, emb: Embedding, looked: list[np.ndarray], y: np.ndarray) -> None:
    """Starting weights: the first dimension is a feature's smoothed log-odds, and some filters read it."""
    seen = np.zeros((2, len(emb.table)))
    for rows, label in zip(looked, y):
        seen[label, np.unique(rows)] += 1
    _start_from(net, emb, seen, y.mean())


def _start_from(net: ConvNet, emb: Embedding, seen: np.ndarray, base: float) -> None:
    """The same from the number of documents with each feature, by label."""
    toxic = (seen[1] + SMOOTH * base) / (seen.sum(axis=0) + SMOOTH)
    emb.table[:, 0] = np.log(toxic / (1 - toxic)) - np.log(base / (1 - base))
    emb.table[0] = 0
    for j, w in enumerate(net.widths):
        net.params[f"w{w}"][:, 0, :] = 0
        net.params[f"w{w}"][0, 0, :READERS] = 1
        net.params[f"b{w}"][:READERS] = -2
        net.params["out"][j * FILTERS:j * FILTERS + READERS] = (-0.2, 0.2)


def _calibrate(model: ToxicityModel, texts: list[list[str]], y: np.ndarray, langs: list[str | None]) -> None:
    """Scales log-odds so that ``CUT`` splits the held texts best, and a threshold for each language with enough of both labels."""
    if not 0 < y.sum() < len(y):
        return
    z = model.logits(texts, len(texts))
    middle = _best_cut(z, y)
    model.slope = float(np.clip(4 / max(1e-6, np.abs(z - middle).mean()), 0.2, 4))
    model.shift = float(np.log(CUT / (1 - CUT)) - model.slope * middle)
    for lang in sorted({x for x in langs if x is not None}):
        own = np.array([x == lang for x in langs])
        if min((y[own] == 1).sum(), (y[own] == 0).sum()) >= 20:
            cut = model.slope * _best_cut(z[own], y[own]) + model.shift
            model.thresholds[lang] = float(np.clip(1 / (1 + np.exp(-cut)), 0.5, 0.9))


def _best_cut(z: np.ndarray, y: np.ndarray, n: np.ndarray | None = None) -> float:
    """Middle of the widest gap among the cuts with fewest errors; ``n``: documents that each entry stands for."""
    order = np.argsort(z)
    n = np.ones(len(z), np.int64) if n is None else n[order]
    z, y = z[order], y[order]
    low = np.cumsum(np.concatenate([[0], n * (y == 1)]))
    high = np.concatenate([np.cumsum((n * (y == 0))[::-1])[::-1], [0]])
    edge = np.concatenate([[z[0] - 1], z, [z[-1] + 1]])
    wrong = low + high
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    i = best[np.argmax(edge[best + 1] - edge[best])]
    return float((edge[i] + edge[i + 1]) / 2)


def score_column(model: ToxicityModel) -> Column:
    """Score of the column ``text`` (0 to 1)."""
    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        return pa.array(model.scores(text.to_pylist()), pa.float64())
    return score


def threshold_column(model: ToxicityModel, lang: Column) -> Column:
    """The language's own threshold, ``CUT`` for others."""
    out = F.lit(CUT)
    for name, cut in model.thresholds.items():
        out = F.when(lang == name, F.lit(cut)).otherwise(out)
    return out


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score, predicted (1 if score >= ``CUT``), threshold of the row's language, rejected (score >= threshold).

    The score comes from the whole text alone. Null and empty texts get the score of a text without words. A null lang
    has the general threshold, a null doc_id stays null, repeated rows give repeated rows, further columns are ignored; an empty
    table gives no row. A model without examples of both labels can tell nothing apart: it gives each row one score, the share of label 1 but
    0.5 at most, and so rejects none.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        F.col("lang").cast("string").alias("lang"))
    scored = plain.select("doc_id", score_column(model)(F.col("text")).alias("score"),
                          threshold_column(model, F.col("lang")).alias("threshold"))
    return scored.withColumns({"predicted": (F.col("score") >= CUT).cast("int"), "rejected": F.col("score") >= F.col("threshold")})


def drop_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows of ``docs``, all columns, that score below their language's threshold."""
    score = score_column(model)(F.col("text").cast("string"))
    return docs.where(score < threshold_column(model, F.coalesce(F.col("lang").cast("string"), F.lit(""))))
