"""Token counts by rank-synchronous merging of ragged arrays.

All distinct pre-tokens of a batch lie behind one another in one array of symbols. In every step each sequence finds
its pair of lowest merge rank, and all of them are merged at once, at all their places; sequences without a pair left
go out. What remains of a sequence are its tokens.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import plain_texts
from .pretokens import Spans, segments, stretches

_NONE = np.int32(2**31 - 1)
_SLOTS = 19
_MULT = np.uint64(0x9E3779B97F4A7C15)


def _byte_letters() -> list[str]:
    """The printable character by which a byte-level vocabulary file writes each byte (fixed values)."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b if b in set(plain) else next(rest)) for b in range(256)]


class Merges:
    """Merge table of one vocabulary file: rank and product of a pair of symbols."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        vocab = data["model"]["vocab"]
        special = [x for x in data.get("added_tokens", ()) if x.get("special")]
        if len(special) > 1:
            raise ValueError("vocabularies with at most one special token are handled")
        self.special = special[0]["content"] if special else None
        self.special_id = special[0]["id"] if special else -1
        self.first = np.array([vocab[x] for x in _byte_letters()], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"]]
        self.product = np.array([vocab[a + b] for a, b in pairs], np.int32)
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.uint64)
        self._keys = np.full(1 << _SLOTS, 2**64 - 1, np.uint64)
        self._rank = np.full(1 << _SLOTS, _NONE, np.int32)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):  # open addressing: of those that meet in a free slot one stays, the others go on
            free = self._rank[slot[left]] == _NONE
            _, one = np.unique(slot[left][free], return_index=True)
            put = left[free][one]
            self._keys[slot[put]], self._rank[slot[put]] = keys[put], put
            left = np.setdiff1d(left, put)
            slot[left] = (slot[left] + 1) & ((1 << _SLOTS) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * _MULT) >> np.uint64(64 - _SLOTS)).astype(np.int64)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)
        slot = self._slot(keys)
        out, found = self._rank[slot], self._keys[slot]
        open_ = np.flatnonzero((found != keys) & (out != _NONE))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << _SLOTS) - 1)
            out[open_] = self._rank[slot[open_]]
            open_ = open_[(self._keys[slot[open_]] != keys[open_]) & (out[open_] != _NONE)]
        return out

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Surviving symbols and their number per sequence; sequences are non-empty."""
        seq = np.repeat(np.arange(len(lengths)), lengths)
        sym = symbols.copy()
        rank = np.full(len(sym), _NONE, np.int32)
        inside = np.flatnonzero(seq[:-1] == seq[1:])
        rank[inside] = self.ranks(sym[inside], sym[inside + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            begin = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
            sizes = np.diff(np.append(begin, len(seq)))
            low = np.repeat(np.minimum.reduceat(rank, begin), sizes)
            over = low == _NONE
            if over.any():
                done.append((seq[over], sym[over]))
                go = ~over
                seq, sym, rank, low = seq[go], sym[go], rank[go], low[go]
                if not len(sym):
                    break
            hit = rank == low
            twin = hit[1:] & hit[:-1]
            if twin.any():  # a run of equal symbols is merged from its left, every second place
                at = np.arange(len(hit))
                head = hit.copy()
                head[1:] &= ~hit[:-1]
                run = np.maximum.accumulate(np.where(head, at, 0))
                hit &= ((at - run) & 1) == 0
            sym[hit] = self.product[low[hit]]
            stay = np.ones(len(sym), bool)
            stay[1:] = ~hit[:-1]
            seq, sym, rank = seq[stay], sym[stay], rank[stay]
            new = np.flatnonzero(hit[stay])
            near = np.unique(np.concatenate([new, new[new > 0] - 1]))
            inner = near[near + 1 < len(seq)]
            inner = inner[seq[inner] == seq[inner + 1]]
            rank[near] = _NONE
            rank[inner] = self.ranks(sym[inner], sym[inner + 1])
        if not done:
            return symbols[:0], np.zeros(len(lengths), np.int64)
        seqs, syms = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(seqs, kind="stable")
        return syms[order], np.bincount(seqs, minlength=len(lengths))


@lru_cache(4)
def load(path: str) -> Merges:
    return Merges(path)


class Encoder:
    """Token ids of texts; distinct pre-tokens are merged once and remembered up to ``room`` of them.

    Pre-tokens are looked up by a hash, and every one is then compared with the remembered one sign by sign.
    """

    def __init__(self, path: str, room: int = 300_000, chunk_chars: int = 1 << 19):
        self.merges, self.room, self.chunk_chars = load(path), room, chunk_chars
        self._forget()

    def _forget(self) -> None:
        self._place: dict[int, int] = {}
        self._pool, self._starts = np.zeros(1 << 16, np.uint16 if len(self.merges.product) < 65_000 else np.int32), np.zeros(1 << 14, np.int64)
        self._letters, self._letter_starts = np.zeros(1 << 16, "<u4"), np.zeros(1 << 14, np.int64)
        self._used = self._held = 0

    def _places(self, spans: Spans) -> np.ndarray:
        """Per pre-token its place in the memory of merged ones."""
        keys, first, back = np.unique(spans.key, return_index=True, return_inverse=True)
        if self._held + len(keys) > self.room:
            self._forget()
        get = self._place.get
        known = keys.tolist()
        place = np.fromiter((get(k, -1) for k in known), np.int64, len(known))
        missing = np.flatnonzero(place < 0)
        if len(missing):
            place[missing] = self._add(spans, first[missing])
            self._place.update(zip(keys[missing].tolist(), place[missing].tolist()))
        place = place[back]
        other = self._unlike(spans, place)
        if len(other):  # they share the hash of another pre-token
            texts = [spans.text(i) for i in other.tolist()]
            one = {t: i for t, i in zip(texts, other.tolist())}
            new = dict(zip(one, self._add(spans, np.fromiter(one.values(), np.int64, len(one))).tolist()))
            place[other] = [new[t] for t in texts]
        return place

    def _unlike(self, spans: Spans, place: np.ndarray) -> np.ndarray:
        """Pre-tokens that differ from the remembered one at their place."""
        begin = self._letter_starts[place]
        size = self._letter_starts[place + 1] - begin
        unlike = size != spans.end - spans.begin
        rows = np.flatnonzero(~unlike)
        if len(rows):
            wrong = spans.codes(rows) != self._letters[stretches(begin[rows], size[rows])]
            if wrong.any():
                unlike[rows[np.unique(np.repeat(np.arange(len(rows)), size[rows])[wrong])]] = True
        return np.flatnonzero(unlike)

    def _add(self, spans: Spans, rows: np.ndarray) -> np.ndarray:
        """Merges some pre-tokens and remembers them: their places."""
        raw = [spans.text(i).encode() for i in rows.tolist()]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        ids, counts = self.merges.merge(self.merges.first[np.frombuffer(b"".join(raw), np.uint8)], lengths)
        codes, n = spans.codes(rows), self._held
        self._pool = self._room(self._pool, self._used + len(ids))
        self._starts = self._room(self._starts, n + len(counts) + 1)
        self._letter_starts = self._room(self._letter_starts, n + len(counts) + 1)
        told = int(self._letter_starts[n])
        self._letters = self._room(self._letters, told + len(codes))
        self._pool[self._used:self._used + len(ids)] = ids
        self._letters[told:told + len(codes)] = codes
        self._starts[n + 1:n + 1 + len(counts)] = self._used + np.cumsum(counts)
        self._letter_starts[n + 1:n + 1 + len(counts)] = told + np.cumsum(spans.end[rows] - spans.begin[rows])
        self._used, self._held = self._used + len(ids), n + len(counts)
        return np.arange(n, n + len(counts))

    @staticmethod
    def _room(array: np.ndarray, size: int) -> np.ndarray:
        while size > len(array):
            array = np.concatenate([array, np.zeros_like(array)])
        return array

    def counts(self, texts: list[str | None]) -> np.ndarray:
        total = np.zeros(len(texts), np.int64)
        extra = np.zeros(len(texts), np.int64)
        for group, owner, extra in segments(texts, self.merges.special, self.chunk_chars):  # noqa: B007
            if not group:
                continue
            spans = Spans(group)
            place = self._places(spans)
            per = np.bincount(spans.segment, self._starts[place + 1] - self._starts[place], len(group))
            np.add.at(total, owner, per.astype(np.int64))
        return total + extra

    def ids(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids per text (a text's special strings become the special id)."""
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        for i, text in enumerate(texts):
            whole = (text or "").split(self.merges.special) if self.merges.special else [text or ""]
            if len(whole) > 1:
                for j, piece in enumerate(whole):
                    parts[i] += [np.array([self.merges.special_id], self._pool.dtype)] * (j > 0) + self.ids([piece])
        plain = [None if p else t for p, t in zip(parts, texts)]
        for group, owner, _ in segments(plain, None, self.chunk_chars):
            if not group:
                continue
            spans = Spans(group)
            place = self._places(spans)
            begin = self._starts[place]
            size = self._starts[place + 1] - begin
            flat = self._pool[stretches(begin, size)]
            per = np.bincount(spans.segment, size, len(group)).astype(np.int64)
            for i, piece in zip(owner, np.split(flat, np.cumsum(per)[:-1])):
                parts[i].append(piece)
        none = np.zeros(0, self._pool.dtype)
        return [np.concatenate(p) if p else none for p in parts]


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """The worker's own encoder: its memory of pre-tokens serves all tasks of the process."""
    return Encoder(path)


def count_tokens(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """Tokens of every whole text by the vocabulary file at ``path`` (byte-level BPE, JSON).

    Returns per row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``limit``). Null text counts as empty
    (0 bytes, 0 tokens); a null doc_id stays null; repeated rows give repeated rows; further columns are ignored; texts of
    any length are counted whole. An empty table gives no row.
    """
    def run(batches):
        coder = encoder(path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            n = coder.counts(texts)
            size = [len(t.encode()) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(n), pa.array(n > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return plain_texts(docs).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
