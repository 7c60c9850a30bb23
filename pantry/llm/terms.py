"""Terms of whole texts as Arrow strings, without a Python step per term."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .words import ALNUM, slices

#: A-Z to a-z; all other ASCII but a-z to blanks.  Bytes above 0x7F are parts of terms.
ALPHA = bytes(32 if 48 <= b <= 57 else ALNUM[b] for b in range(256))
#: Bytes of text that a task looks at together; a longer text is cut at a blank.
PIECE_BYTES = 1 << 20


def _cut(data: np.ndarray, table: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """A long text's mapped bytes in pieces of ``most`` bytes or a little less, cut
    at blanks alone; a single longer term stays whole."""
    at, size = 0, most
    while at < len(data):
        piece = table[data[at:at + size]]
        if at + size < len(data):
            blanks = np.flatnonzero(piece == 32)
            if not len(blanks):
                size *= 2
                continue
            piece = piece[:blanks[-1] + 1]
        yield piece
        at, size = at + len(piece), most


def _terms(data: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(terms in order, bounds of each text's terms) of mapped bytes."""
    inside = data != 32
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    edges = bounds[(bounds > 0) & (bounds < len(data))]  # a text's first byte begins a term, whatever is before
    opens[edges] = inside[edges]
    first = np.flatnonzero(opens)
    letters = np.cumsum(inside) - inside  # letters before each byte
    offsets = np.append(letters[first], inside.sum()).astype(np.int64)
    terms = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(data[inside].tobytes()))
    return terms, np.searchsorted(first, bounds)


def term_pieces(texts: pa.Array, table: bytes, most: int = PIECE_BYTES) -> Iterator[tuple[int, int, pa.Array, np.ndarray]]:
    """(from, to, terms, bounds) for each stretch of texts: text ``from + i`` has
    terms bounds[i]:bounds[i + 1].  A text longer than ``most`` bytes comes alone,
    in one or more pieces.  Null: no terms."""
    lookup = np.frombuffer(table, np.uint8)
    texts = pa.concat_arrays([pc.fill_null(texts, "").cast(pa.large_string())])
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(texts.buffers()[2], np.uint8) if len(texts) and texts.buffers()[2] else np.zeros(0, np.uint8)
    for at, to in slices(texts, most):
        data = raw[offsets[at]:offsets[to]]
        if to - at == 1 and len(data) > most:
            for piece in _cut(data, lookup, most):
                yield at, to, *_terms(piece, np.array([0, len(piece)]))
        else:
            yield at, to, *_terms(lookup[data], offsets[at:to + 1] - offsets[at])
