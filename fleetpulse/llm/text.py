"""Words, lines and their hashes for a batch of texts at once, in numpy.

A batch lies in one buffer of UTF-8 bytes. A word is a run of bytes other than space, tab, newline, vertical tab, form
feed and carriage return, which is the pattern ``[^\\x20\\x09-\\x0D]+`` of code points. The hash of a range of bytes is
a polynomial modulo 2**64 of a table value per byte, read off prefix sums, and then mixed; it depends on the bytes only,
so that all tasks agree.

A batch takes some 60 bytes of memory per byte of text while it is read, and the table of powers grows to the longest text
seen, at 16 bytes per byte: with 2 GB a worker takes single texts of about 25 MB.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = U64(pow(int(_BASE), -1, 2**64))
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads each bit (the finaliser of splitmix64)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE_VALUE = mix(np.arange(1, 257, dtype=U64) * U64(0xD1B54A32D192ED03))
_powers = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def _power(which: str, n: int) -> np.ndarray:
    """Powers 0 to n - 1 of the base, or of its inverse."""
    if len(_powers[which]) < n:
        steps = np.full(max(n, 1 << 21), _BASE if which == "up" else _BASE_INVERSE, U64)
        steps[0] = 1
        _powers[which] = np.cumprod(steps, dtype=U64)
    return _powers[which][:n]


#: ASCII letters in lower case, ASCII punctuation as blanks.
FOLD = np.arange(256, dtype=np.uint8)
for _c in range(128):
    if chr(_c).isupper():
        FOLD[_c] = ord(chr(_c).lower())
    elif not chr(_c).isalnum() and not SPACE[_c]:
        FOLD[_c] = 32


class Batch:
    """Texts of an Arrow array (null: empty) as bytes, words and hashes."""

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_string()).fill_null("")
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        self.data = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
        self.doc_bounds = bounds - bounds[0]
        self.rows = len(texts)
        self._split()

    @classmethod
    def of(cls, data: np.ndarray, doc_bounds: np.ndarray) -> Batch:
        """From bytes and the bounds of the texts among them."""
        self = cls.__new__(cls)
        self.data, self.doc_bounds, self.rows = data, doc_bounds, len(doc_bounds) - 1
        self._split()
        return self

    def _split(self) -> None:
        word = ~SPACE[self.data]
        first = np.zeros(len(word) + 1, bool)  # where a text begins, and so a word may
        first[self.doc_bounds] = True
        before = np.concatenate(([False], word[:-1])) if len(word) else word
        self.starts = np.flatnonzero(word & (first[:-1] | ~before))
        after = np.concatenate((word[1:], [False])) if len(word) else word
        self.ends = np.flatnonzero(word & (first[1:] | ~after)) + 1
        # Row of each word.
        self.word_bounds = np.searchsorted(self.starts, self.doc_bounds)
        self.word_row = np.repeat(np.arange(self.rows), np.diff(self.word_bounds))

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a value per byte over each text."""
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[self.doc_bounds[1:]] - total[self.doc_bounds[:-1]]

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each range of bytes."""
        if not len(starts):
            return np.zeros(0, U64)
        sums = np.zeros(len(self.data) + 1, U64)
        np.cumsum(_BYTE_VALUE[self.data] * _power("up", len(self.data)), out=sums[1:])
        return mix((sums[ends] - sums[starts]) * _power("down", len(self.data) + 1)[starts] + (ends - starts).astype(U64))

    def word_hashes(self) -> np.ndarray:
        return self.hashes(self.starts, self.ends)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Start, end, row and number of words of each line; lines are what newlines separate."""
        newline = np.flatnonzero(self.data == 10)
        starts = np.concatenate((self.doc_bounds[:-1], newline + 1))
        rows = np.concatenate((np.arange(self.rows), np.searchsorted(self.doc_bounds, newline, side="right") - 1))
        ends = np.concatenate((newline, self.doc_bounds[1:]))
        end_rows = np.concatenate((rows[self.rows :], np.arange(self.rows)))
        order, end_order = np.lexsort((starts, rows)), np.lexsort((ends, end_rows))
        starts, ends, rows = starts[order], ends[end_order], rows[order]
        words = np.searchsorted(self.starts, ends) - np.searchsorted(self.starts, starts)
        return starts, ends, rows, words


def range_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each range of items, given by their hashes."""
    sums = np.zeros(len(hashes) + 1, U64)
    np.cumsum(mix(hashes) * _power("up", len(hashes)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power("down", len(hashes) + 1)[starts] + (ends - starts).astype(U64))


def windows(hashes: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each window of consecutive words of one text, and the index of its first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    at = np.flatnonzero(rows[:n] == rows[size - 1 :])
    out = np.zeros(len(at), U64)
    for j in range(size):
        out = out * _BASE + hashes[at + j]
    return mix(out), at


def occurrence(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """For each item, how many equal ones come before it in its text."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    order = np.lexsort((np.arange(len(hashes)), hashes, rows))
    h, r = hashes[order], rows[order]
    new = np.concatenate(([True], (h[1:] != h[:-1]) | (r[1:] != r[:-1])))
    begin = np.flatnonzero(new)
    count = np.arange(len(h)) - np.repeat(begin, np.diff(np.concatenate((begin, [len(h)]))))
    out = np.empty(len(h), np.int64)
    out[order] = count
    return out
