"""Words of whole Arrow batches as 64-bit hashes, without a Python step per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A-Z to a-z; ASCII other than letters and digits to blanks.  Bytes above 0x7F are parts of words.
ALNUM = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
#: A-Z to a-z; white space alone separates.
BLANK = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))

#: Texts that a task looks at together; bounds its arrays.
SLICE_BYTES = 1 << 20
_ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; equal in, equal out."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Stretches of a column that hold ``most`` bytes, or a single longer text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        yield at, to
        at = to


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, for the longest slice so far."""

    base = 0x9E3779B97F4A7C15

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, SLICE_BYTES)
            self.up, self.down = (np.full(size, np.uint64(b), np.uint64) for b in (self.base, pow(self.base, -1, 1 << 64)))
            for x in (self.up, self.down):
                x[0] = 1
                np.multiply.accumulate(x, out=x)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()
_LETTERS = mixed(np.arange(1, 257, dtype=np.uint64))


def word_hashes(texts: pa.Array, table: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in order, bounds: text i has words bounds[i]:bounds[i + 1]); null: no words.

    A word's hash is a polynomial of its bytes, read off the slice's prefix sums.
    """
    texts = pa.concat_arrays([pc.fill_null(texts, "").cast(pa.large_string())])
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(table, np.uint8)[np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]]] if raw else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    inside = data != 32
    edges = offsets[(offsets > 0) & (offsets < len(data))]  # a text's first byte begins a word, whatever is before
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    opens[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    first, last = np.flatnonzero(opens), np.flatnonzero(closes)
    up, down = _POWERS.upto(len(data))
    sums = np.cumsum(_LETTERS[data] * up)
    before = np.where(first > 0, sums[first - 1], np.uint64(0))
    return mixed((sums[last] - before) * down[first]), np.searchsorted(first, offsets)


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each place (the last k - 1 places are left out)."""
    n = max(0, len(hashes) - k + 1)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = mixed(out * np.uint64(_ODD[j % len(_ODD)]) + hashes[j:j + n] + np.uint64(j + 1)) if j else hashes[:n] * np.uint64(_ODD[0])
    return mixed(out)


def gram_starts(bounds: np.ndarray, k: int) -> np.ndarray:
    """Whether k words from a place stand in one text, for each word's place."""
    n = int(bounds[-1])
    ok = np.ones(n + 1, bool)
    for j in range(1, k):
        at = bounds[1:] - j
        ok[at[at >= bounds[:-1]]] = False
    # texts with fewer than k words: none of their places
    return ok[:n]
