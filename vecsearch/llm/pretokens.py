"""Pre-tokens of a byte-level BPE vocabulary, found by array operations on code points.

The rules are those of the public pattern of byte-level vocabularies: an apostrophe ending, or an optional
space and a run of letters, of digits or of other signs, or white space of which the last character is left to what
follows. A whole batch of texts is cut at once: every decision depends on character classes of neighbours.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

LETTER, DIGIT, SPACE, OTHER, WALL = range(5)
# The code points of Unicode's White_Space property, and the apostrophe endings.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
ENDINGS_1 = "stmd"
ENDINGS_2 = ("re", "ve", "ll")

_WALL_CODE = 0x110000
_LOOK = 1 << 16
_R = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(1)
def classes() -> np.ndarray:
    kind = {"L": LETTER, "N": DIGIT}
    table = np.fromiter((kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.int8, 0x110000)
    table = np.append(table, np.int8(WALL))
    table[WHITE] = SPACE
    return table


@lru_cache(4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_R), -1, 1 << 64))
    with np.errstate(over="ignore"):
        up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, _R)]), dtype=np.uint64)
        down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, inverse)]), dtype=np.uint64)
    return up, down


def stretches(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indexes begin ... begin + size - 1 of every row, one row after the other."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begin - (ends - size), size)


def border(text: str, at: int) -> int:
    """The first place from ``at`` on where a pre-token starts whatever stands around: behind a sign of one class (no white space, no
    apostrophe) that one of another class follows; else the end of the text."""
    while at < len(text):
        part = text[at - 1:at + _LOOK]
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4")
        c = classes()[codes]
        found = np.flatnonzero((c[1:] != c[:-1]) & (c[:-1] != SPACE) & (codes[:-1] != 39))
        if len(found):
            return at + int(found[0])
        at += _LOOK
    return len(text)


class Spans:
    """Pre-tokens of some text segments: ``segment`` index, ``key`` (64-bit hash; unequal ones may share it), and their code points."""

    def __init__(self, segments: list[str]):
        codes = np.frombuffer("".join(segments).encode("utf-32-le"), "<u4")
        ends = np.cumsum([len(s) for s in segments])
        at = np.concatenate([[0], ends]).astype(np.int64)
        a = np.insert(codes, at, np.uint32(_WALL_CODE))
        c = classes()[a]
        start = np.ones(len(c), bool)
        start[1:] = c[1:] != c[:-1]
        start |= c == WALL
        last = np.zeros(len(c), bool)  # last character of white space that something follows
        last[:-1] = (c[:-1] == SPACE) & (c[1:] != SPACE) & (c[1:] != WALL)
        start |= last
        start[1:] &= ~(last & (a == 32))[:-1]
        quotes = np.flatnonzero((a == 39) & start)
        if len(quotes):
            quotes = quotes[quotes + 3 < len(a) + 1]
            one = a[np.minimum(quotes + 1, len(a) - 1)]
            two = a[np.minimum(quotes + 2, len(a) - 1)]
            short = np.isin(one, [ord(x) for x in ENDINGS_1])
            long = np.zeros(len(quotes), bool)
            for x, y in ENDINGS_2:
                long |= (one == ord(x)) & (two == ord(y))
            for found, size in ((short, 2), (long, 3)):
                start[quotes[found] + 1] = False
                start[quotes[found] + size] = True
        begin = np.flatnonzero(start)
        end = np.append(begin[1:], len(a))
        wall = c[begin] == WALL
        number = np.cumsum(wall) - 1
        real = ~wall
        self._codes, self.begin, self.end, self.segment = a, begin[real], end[real], number[real]
        room = 1 << max(16, int(len(a)).bit_length())
        up, down = _powers(room)
        with np.errstate(over="ignore"):
            sums = np.zeros(len(a) + 1, np.uint64)
            np.cumsum((a.astype(np.uint64) + np.uint64(1)) * up[: len(a)], out=sums[1:])
            h = (sums[self.end] - sums[self.begin]) * down[self.begin]
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            h += (self.end - self.begin).astype(np.uint64)
        self.key = h ^ (h >> np.uint64(32))

    def codes(self, rows: np.ndarray) -> np.ndarray:
        """Code points of some pre-tokens, one after the other."""
        return self._codes[stretches(self.begin[rows], self.end[rows] - self.begin[rows])]

    def text(self, i: int) -> str:
        return self._codes[self.begin[i]:self.end[i]].astype("<u4").tobytes().decode("utf-32-le")


def segments(texts: list[str | None], special: str | None, limit: int) -> Iterator[tuple[list[str], list[int], np.ndarray]]:
    """Groups of segments of about ``limit`` characters: (segments, their text's index, specials per text).

    A text is cut at its special strings, and beyond ``limit`` at the next border of classes (letters, digits, white space, other
    signs), where a pre-token always starts; so texts of any length are handled whole, a piece of about ``limit`` characters at a time. Only
    a run of one class that is longer, being one pre-token, is held as a whole. Null counts as empty.
    """
    group, owner, size = [], [], 0
    extra = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        parts = [text or ""]
        if special and special in parts[0]:
            parts = parts[0].split(special)
            extra[i] = len(parts) - 1
        for part in parts:
            at = 0
            while at < len(part):
                cut = len(part)
                if cut - at > limit:
                    cut = border(part, at + limit)
                group.append(part[at:cut])
                owner.append(i)
                size += cut - at
                at = cut
                if size >= limit:
                    yield group, owner, extra
                    group, owner, size = [], [], 0
    yield group, owner, extra
