"""Order-preserving packing by dynamic programming.

The documents of a partition, in the table's order, are one stream of tokens.
Cuts are chosen at document ends (free), sentence ends (a small penalty) or,
inside stretches without either, at a fixed grid (a larger one), so that padding
plus penalties are least.  ``best(i) = pen(i) + min over j with p(i) - p(j) <= L
of best(j) + L - (p(i) - p(j))``; the window minimum of ``best(j) + p(j)`` comes
from a monotone queue, so each cut place enters and leaves it once.

No shuffle: each partition packs its own stream, in blocks of bounded size.  A
partition's last rest is split into powers of two, which need no padding.
"""

from __future__ import annotations

import re
import sys
import types
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches

SEQUENCE = 2048
SENTENCE_PENALTY, FORCED_PENALTY, FORCED_GRID = 2, 8, 32
#: Ends each document.
END_ID = 1
#: Tokens that the optimiser sees at once; bounds memory, and only shifts a cut or two at its ends.
BLOCK_TOKENS = 1_000_000
SLICE_BYTES = 8_000_000
CACHED_WORDS = 1_200_000

SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


#: Byte-level spelling: printable Latin-1 stands for itself, other bytes for letters from U+0100 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SPELT = {b: chr(b) for b in _PRINTED} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in _PRINTED)}
#: Letters that no step before the model changes: a-z and lower-case Latin-1 letters.
_LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
BYTES = {ord(c): "".join(_SPELT[b] for b in c.encode()) for c in _LETTERS}
PLAIN = re.compile(f"[{_LETTERS}]+").fullmatch


class WordIds:
    """Ids of whole texts, word by word.

    The tokenizer drops white space and never joins across it, so a text's ids
    are those of its words one after the other; each word is encoded once and
    then looked up.  Lower-casing first is the tokenizer's own first step; texts
    that could hold special tokens are encoded as they are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [(t.content, i) for i, t in self.tokenizer.get_added_tokens_decoder().items()]
        self.mark, self.mark_id = special[0]
        self.hints = [s[:2] for s, _ in special]
        self.clear()

    def clear(self) -> None:
        self.codes: dict[str, int] = {"": 0}
        self.pool = np.zeros(1 << 16, np.uint32)
        self.starts, self.lengths = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.used = 0

    def learn(self, words: list[str]) -> None:
        """Plain words go to the tokenizer's model at once: of the steps before it,
        lower-casing and normal form leave them as they are, none cuts them, and
        bytes are spelt by BYTES.  A plain word with a full stop or comma behind it
        is the two one after the other.  All others take the whole tokenizer."""
        plain: dict[str, None] = {}
        ended, other = [], []
        for w in words:
            stem = w[:-1] if w[-1] in ".," else w
            if not PLAIN(stem):
                other.append(w)
            else:
                plain[stem] = None
                if stem is not w:
                    ended.append(w)
        tokenize = self.tokenizer.model.tokenize
        new = [w for w in plain if w not in self.codes]
        found = [[x.id for x in tokenize(w.translate(BYTES))] for w in new]
        self.add(new, np.array([i for f in found for i in f], np.uint32), np.array([len(f) for f in found], np.int64))
        other += [w for w in ".," if w not in self.codes and w not in other]
        for i in range(0, len(other), 2000):
            part = other[i:i + 2000]
            ids = np.array(self.tokenizer.encode(self.mark.join([*part, ""]), add_special_tokens=False).ids, np.uint32)
            self.add(part, ids[ids != self.mark_id], np.diff(np.flatnonzero(ids == self.mark_id), prepend=-1) - 1)
        if ended:
            pairs = np.array([(self.codes[w[:-1]], self.codes[w[-1]]) for w in ended]).ravel()
            self.add(ended, self.gather(pairs)[0], self.lengths[pairs].reshape(-1, 2).sum(1))

    def add(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        n, first = len(words), len(self.codes)
        while first + n > len(self.starts):
            self.starts, self.lengths = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lengths))
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used:self.used + len(ids)] = ids
        self.lengths[first:first + n] = lengths
        self.starts[first:first + n] = self.used + np.cumsum(lengths) - lengths
        self.used += len(ids)
        self.codes.update(zip(words, range(first, first + n), strict=True))

    def gather(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of coded words one after the other, where each word's begin)."""
        lengths = self.lengths[codes]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return self.pool[np.repeat(self.starts[codes] - ends[:-1], lengths) + np.arange(ends[-1])], ends

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each)."""
        odd = pa.array(self.special(texts))
        texts = pc.if_else(odd, "", texts)
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        flat = split.flatten().dictionary_encode()
        words = flat.dictionary.to_pylist()
        if len(self.codes) + len(words) > CACHED_WORDS:
            self.clear()
        new = [w for w in words if w not in self.codes]
        if new:
            self.learn(new)
        codes = np.fromiter(map(self.codes.__getitem__, words), np.int64, len(words))
        ids, ends = self.gather(codes[flat.indices.to_numpy(zero_copy_only=False)] if len(words) else codes)
        bounds = split.offsets.to_numpy()
        return ids, np.diff(ends[bounds - bounds[0]])

    def special(self, texts: pa.Array) -> np.ndarray:
        """Whether a text could hold a special token."""
        return np.logical_or.reduce([pc.match_substring(texts, h).to_numpy(zero_copy_only=False) for h in set(self.hints)])

    def encode_odd(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def documents(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``, with the end id after each text."""
        ids, counts = self.encode(texts)
        for i in np.flatnonzero(self.special(texts)):
            at = int(counts[:i].sum())
            own = self.encode_odd(texts[int(i)].as_py())
            ids, counts[i] = np.concatenate([ids[:at], own, ids[at:]]), len(own)
        return np.insert(ids, np.cumsum(counts), END_ID).astype(np.uint32), counts + 1


def worker_ids(path: str) -> WordIds:
    """One for each worker process, kept from task to task."""
    kept = sys.modules.setdefault("pantry_worker_cache", types.ModuleType("pantry_worker_cache"))
    if path not in vars(kept):
        vars(kept)[path] = WordIds(path)
    return vars(kept)[path]


def cut_places(ends: np.ndarray, sentence_ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (ascending, the last is n) and penalties of cuts in n tokens."""
    pen = np.full(n + 1, -1, np.int64)
    pen[sentence_ends] = SENTENCE_PENALTY
    pen[ends] = 0
    pen[0], pen[n] = -1, 0
    at = np.concatenate([[0], np.flatnonzero(pen >= 0)])
    gaps = np.diff(at)
    wide = np.flatnonzero(gaps > FORCED_GRID)
    more = (gaps[wide] - 1) // FORCED_GRID
    step = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1
    forced = np.repeat(at[wide], more) + step * FORCED_GRID
    pen[forced] = FORCED_PENALTY
    at = np.flatnonzero(pen >= 0)
    return at, pen[at]


def best_cuts(places: list[int], penalties: list[int], length: int = SEQUENCE) -> list[int]:
    """Cuts, the last one included, that minimise padding plus penalties."""
    value = [0]  # best(j); places counts from the first cut
    came = [-1]
    at = [0, *places]
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (best(j) + p(j), j), ascending in both
    for i, (p, pen) in enumerate(zip(places, penalties, strict=True), 1):
        least = p - length
        while at[queue[0][1]] < least:
            queue.popleft()
        v, j = queue[0]
        v += length - p + pen
        value.append(v)
        came.append(j)
        v += p
        while queue and queue[-1][0] >= v:
            queue.pop()
        queue.append((v, i))
    cuts, i = [], len(places)
    while i > 0:
        cuts.append(at[i])
        i = came[i]
    return cuts[::-1]


def tail_cuts(begin: int, end: int) -> list[int]:
    """A rest that is no full sequence, as powers of two."""
    cuts, left = [], end - begin
    while left:
        size = min(SEQUENCE, 1 << (left.bit_length() - 1))
        begin, left = begin + size, left - size
        cuts.append(begin)
    return cuts


def packed(batches: Iterator[pa.RecordBatch], tokenizer_path: str) -> Iterator[pa.RecordBatch]:
    words = worker_ids(tokenizer_path)
    stops = np.array([i[0] for i in (words.encode_odd(c) for c in ".!?") if len(i) == 1], np.uint32)
    sequence = TaskContext.get().partitionId() << 40
    ids = np.zeros(0, np.uint32)  # tokens not yet packed
    done = 0  # tokens packed
    doc_ids: list = []  # documents that reach into ids: id, first token, tokens
    starts, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def flush(last: bool) -> pa.RecordBatch | None:
        nonlocal ids, done, doc_ids, starts, counts, sequence
        n = len(ids)
        ends = starts + counts - done
        ends = ends[(ends > 0) & (ends <= n)]
        sentence = np.flatnonzero(np.isin(ids, stops)) + 1
        places, pen = cut_places(ends, sentence, n)
        cuts = best_cuts(places.tolist(), pen.tolist())
        if last:
            before = cuts[-2] if len(cuts) > 1 else 0
            cuts = [*cuts[:-1], *tail_cuts(before, n)]
        else:
            cuts = cuts[:-1]
        if not cuts:
            return None
        upto = cuts[-1]
        marks = np.unique(np.concatenate([[0], cuts, ends[ends < upto]]))
        begin, length = marks[:-1], np.diff(marks)
        doc = np.searchsorted(starts - done, begin, "right") - 1
        seq = np.searchsorted(cuts, begin, "right")
        first = np.array([0, *cuts[:-1]], np.int64)
        buffers = [None, pa.py_buffer((marks * 4).astype(np.int32).tobytes()), pa.py_buffer(ids[:upto].astype("<u4").tobytes())]
        out = pa.RecordBatch.from_arrays([
            pa.array([doc_ids[i] for i in doc.tolist()], pa.int64()), pa.array(begin + done - starts[doc]), pa.array(length),
            pa.BinaryArray.from_buffers(pa.binary(), len(begin), buffers), pa.array(counts[doc]),
            pa.array(seq + sequence), pa.array(begin - first[seq])],
            names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
        sequence += len(cuts)
        ids, done = ids[upto:], done + upto
        keep = starts + counts > done
        doc_ids = [x for x, k in zip(doc_ids, keep.tolist(), strict=True) if k]
        starts, counts = starts[keep], counts[keep]
        return out

    for batch in batches:
        texts = pc.fill_null(batch.column(1).cast(pa.large_string()).cast(pa.string()), "")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + SLICE_BYTES, "right")))
            new, n = words.documents(pa.concat_arrays([texts.slice(at, to - at)]))
            total = done + len(ids)
            starts = np.concatenate([starts, total + np.cumsum(n) - n])
            counts = np.concatenate([counts, n])
            doc_ids += batch.column(0).slice(at, to - at).to_pylist()
            ids = np.concatenate([ids, new])
            at = to
            if len(ids) >= BLOCK_TOKENS and (out := flush(False)):
                yield out
    if len(ids):
        yield flush(True)


def pack(docs: DataFrame, tokenizer_path: str | None = None, text: str = "text") -> DataFrame:
    """Pieces of documents in sequences of ``SEQUENCE`` tokens: doc_id, start,
    length, ids (binary, unsigned 32-bit little-endian), doc_tokens, sequence_id,
    offset.

    A null or empty text is the end id alone.  Null ids stay null; repeated rows
    are packed each; further columns are left out; an empty table gives no rows.
    The table's order is kept inside each partition of the scan.  A text must
    fit in memory.
    """
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        lambda batches: packed(batches, tokenizer_path), SCHEMA)
