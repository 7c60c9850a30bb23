"""Repeated byte strings by column-wise construction of a collection's suffix order.

Which bytes lie in a string of LENGTH bytes that also starts elsewhere?  Equal
strings have equal contents, so also their smallest GRAM-byte hash at the same
offset.  Every window of LENGTH bytes therefore belongs to an anchor (the place
of its smallest hash), and equal windows to anchors with the same gram.  So the
suffixes to be sorted are those around anchors, side by side in columns counted
from the anchor, and no deeper than their windows reach.

1. Anchors are counted by gram; one whose gram occurs once is done.
2. The others' contexts (all bytes that their windows hold) are counted by hash;
   a context that occurs twice is repeated as a whole.  Its places don't travel:
   the last pass over the texts finds them by a bitmap of such contexts, and the
   single contexts that the bitmap holds by chance are listed and left out.
3. What is left, mostly passages' edges, is sorted, one copy of each different
   context: each round inserts one symbol of every context, from the last column
   to the first, and updates the order (the collection's Burrows-Wheeler
   transform is the next column read in that order) and the common prefixes of
   neighbours.  A window is repeated if its suffix shares LENGTH bytes with a
   neighbour's.

A bucket of contexts is bounded, so its columns are arrays read in sequence, and
no file is needed.  A gram with more contexts than a bucket takes counts its
windows by hash instead, which Spark can split.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PLACE, bitmap, placed, probed, scanned, written
from .words import mixed, slices

LENGTH, GRAM = 200, 50
REACH = LENGTH - GRAM
#: Contexts that one task sorts together: arrays of about 25 MB.
BUCKET = 1 << 15

_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)
_LETTERS = mixed(np.arange(1, 257, dtype=np.uint64))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base & (2**64 - 1)), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def sums(data: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial hash modulo 2**64."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTERS[data] * odd[:len(data)], out=out[1:])
    return out


def window_hashes(prefix: np.ndarray, inverse: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each place."""
    n = len(prefix) - size
    return mixed((prefix[size:] - prefix[:n]) * inverse[:n])


#: Low bits of a key that hold the place; the last of equal hashes is the smallest.
PLACE_BITS = 24


def smallest(h: np.ndarray, size: int) -> np.ndarray:
    """For each window of ``size`` hashes the place of the smallest (the last of equal ones)."""
    n = len(h) - size + 1
    if len(h) >= 1 << PLACE_BITS:  # in stretches, so that places fit
        step = (1 << (PLACE_BITS - 1))
        return np.concatenate([smallest(h[a:a + step + size - 1], size) + a for a in range(0, n, step)])
    low = np.uint64((1 << PLACE_BITS) - 1)
    blocks = -(-len(h) // size)
    keys = np.full(blocks * size, np.iinfo(np.uint64).max, np.uint64)
    keys[:len(h)] = (h & ~low) | (low - np.arange(len(h), dtype=np.uint64))
    # smallest from a place to its block's end, and from its block's start to a place
    grid = keys.reshape(blocks, size)
    ahead = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(grid, axis=1).ravel()
    return (low - (np.minimum(ahead[:n], behind[size - 1:size - 1 + n]) & low)).astype(np.int64)


class Hasher:
    """Powers are kept for the longest text so far."""

    def __init__(self):
        self.odd, self.inverse = powers(_ODD, 1 << 17), powers(_INVERSE, 1 << 17)

    def __call__(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(anchor places, gram hashes, first and last window of each anchor) of a
        text of LENGTH bytes or more."""
        data = np.frombuffer(text, np.uint8)
        while len(data) > len(self.odd):
            self.odd, self.inverse = powers(_ODD, 2 * len(self.odd)), powers(_INVERSE, 2 * len(self.odd))
        grams = window_hashes(sums(data, self.odd), self.inverse, GRAM)
        chosen = smallest(grams, REACH + 1)
        first = np.flatnonzero(np.diff(chosen, prepend=-1))
        last = np.concatenate([first[1:] - 1, [len(chosen) - 1]])
        at = chosen[first]
        return at, grams[at].view(np.int64), first, last


def long_texts(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[tuple[int, bytes]]]]:
    """Slices of a batch whose first column is the text, with the texts that have a window."""
    for a, b in slices(batch.column(0)):
        part = batch.slice(a, b - a)
        yield part, [(i, x) for i, x in enumerate(part.column(0).to_pylist()) if x and len(x) >= LENGTH]


def anchors(rows: DataFrame) -> DataFrame:
    """gram, n: the anchors of each slice of texts by their gram."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for _, texts in long_texts(batch):
                if texts:
                    gram, n = np.unique(np.concatenate([hasher(x)[1] for _, x in texts]), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(n.astype(np.int64))], names=["gram", "n"])

    return rows.select("text").mapInArrow(run, "gram long, n long")


def digest(text: bytes, at: int, first: int, last: int) -> bytes:
    """128-bit hash of an anchor's context and of its place in it."""
    return xxhash.xxh3_128_digest(text[first:last + LENGTH] + (at - first).to_bytes(4, "little"))


def spots(file: np.ndarray, row: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit hash of a context's place."""
    out = mixed(file.astype(np.int64).view(np.uint64))
    for x in (row, first):
        out = mixed(out * np.uint64(_ODD) + x.astype(np.int64).view(np.uint64))
    return out.view(np.int64)


def contexts(rows: DataFrame, grams: np.ndarray) -> DataFrame:
    """c1, c2 (a context's hash), gram, n (how often it stands in a slice of texts),
    place, first (its first window, of one of them), for anchors whose gram may be
    among ``grams``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for part, texts in long_texts(batch):
                seen: dict[bytes, list[int]] = {}
                for i, text in texts:
                    at, gram, first, last = hasher(text)
                    maybe = np.flatnonzero(probed(gram, grams))
                    for g, p, f, e in zip(*(x[maybe].tolist() for x in (gram, at, first, last)), strict=True):
                        seen.setdefault(digest(text, p, f, e), [0, i, g, f])[0] += 1
                if seen:
                    n, row, gram, first = (pa.array(x, pa.int64()) for x in zip(*seen.values(), strict=True))
                    pair = np.frombuffer(b"".join(seen), np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(pair[::2]), pa.array(pair[1::2]), gram, n,
                                                      *(part.column(c).take(row) for c in (1, 2)), first],
                                                     names=["c1", "c2", "gram", "n", *PLACE, "first"])

    return rows.select("text", *PLACE).mapInArrow(run, f"c1 long, c2 long, gram long, n long, {PLACE[0]} long, {PLACE[1]} long, first long")


def context_bytes(rows: DataFrame, grams: np.ndarray, chosen: np.ndarray) -> DataFrame:
    """place, gram, at, first, bytes of the contexts whose place may be among ``chosen``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for part, texts in long_texts(batch):
                out: list[tuple] = []
                for i, text in texts:
                    at, gram, first, last = hasher(text)
                    where = [np.full(len(at), part.column(c)[i].as_py(), np.int64) for c in (1, 2)]
                    for j in np.flatnonzero(probed(gram, grams) & probed(spots(*where, first), chosen)).tolist():
                        f, e = int(first[j]), int(last[j])
                        out.append((i, int(gram[j]), int(at[j]), f, text[f:e + LENGTH]))
                if out:
                    row, gram, at, first, own = zip(*out, strict=True)
                    take = pa.array(row, pa.int64())
                    yield pa.RecordBatch.from_arrays([
                        *(part.column(c).take(take) for c in (1, 2)), *(pa.array(x, pa.int64()) for x in (gram, at, first)),
                        pa.array(own, pa.binary())], names=[*PLACE, "gram", "at", "first", "bytes"])

    return rows.select("text", *PLACE).mapInArrow(
        run, f"{PLACE[0]} long, {PLACE[1]} long, gram long, at long, first long, bytes binary")


def spot_bits(chosen: DataFrame, n: int) -> np.ndarray:
    """Bitmap of the places of contexts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = spots(*(batch.column(c).to_numpy() for c in range(3)))
            yield pa.RecordBatch.from_arrays([pa.array(keys)], names=["spot"])

    return bitmap(chosen.select(*PLACE, "first").mapInArrow(run, "spot long"), n)


def by_chance(single: DataFrame, often: np.ndarray) -> DataFrame:
    """place, first of contexts that occur once although the bitmap ``often`` holds them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(batch.columns[1:], names=[*PLACE, "first"]).filter(
                pa.array(probed(batch.column(0).to_numpy(), often)))

    return single.select("c1", *PLACE, "first").mapInArrow(run, f"{PLACE[0]} long, {PLACE[1]} long, first long")


def repeated_windows(texts: list[bytes], lead: np.ndarray) -> np.ndarray:
    """Whether each window is repeated: [context, offset of the window's first byte].

    ``lead`` is the anchor's place in each context; contexts stand side by side
    with their anchors in one column.
    """
    n, length = len(texts), np.array([len(t) for t in texts], np.int64)
    before = int(lead.max(initial=0))
    width = before + int((length - lead).max(initial=0))
    symbols = np.zeros((width, n), np.int16)  # by column; 0: no symbol
    for i, t in enumerate(texts):
        a = before - int(lead[i])
        symbols[a:a + len(t), i] = np.frombuffer(t, np.uint8).astype(np.int16) + 1
    found = np.zeros((n, before + 1), bool)
    order, common = np.arange(n), np.zeros(n + 1, np.int64)
    for column in range(width - 1, -1, -1):
        transform = symbols[column, order]  # the transform's symbols of this round
        moved = np.argsort(transform, kind="stable")
        symbol = transform[moved]
        prefix = np.zeros(n + 1, np.int64)
        # neighbours with one symbol: one more than the least prefix between their old places
        same = np.flatnonzero((symbol[1:] == symbol[:-1]) & (symbol[1:] > 0)) + 1
        if len(same):
            spans = np.stack([moved[same - 1] + 1, moved[same] + 1], axis=1).ravel()
            prefix[same] = np.minimum.reduceat(common, spans)[::2] + 1
        order, common = order[moved], prefix
        if column <= before:
            hit = (common[:n] >= LENGTH) | (common[1:] >= LENGTH)
            found[order[hit], column] = True
    # window w of context i starts in column before - lead[i] + w
    return found


def runs(windows: np.ndarray, first: int) -> Iterator[tuple[int, int]]:
    """(first byte, end) of the stretches that a context's repeated windows cover."""
    edges = np.flatnonzero(np.diff(windows.astype(np.int8), prepend=0, append=0))
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        yield first + a, first + b - 1 + LENGTH


def edge_spans(groups: DataFrame) -> DataFrame:
    """place, first, end of repeated bytes of single contexts, from rows bucket, place,
    first, n (how often a chosen context occurs) and rows bucket, place, first, at,
    bytes; bytes without a chosen context are left out."""
    def run(batch: pa.Table) -> pa.Table:
        keys = list(zip(*(batch.column(c).to_pylist() for c in (*PLACE, "first")), strict=True))
        data, count = batch.column("bytes").to_pylist(), batch.column("n").to_pylist()
        n = {k: c for k, c in zip(keys, count, strict=True) if c is not None}
        rows = [i for i, x in enumerate(data) if x is not None and keys[i] in n]
        out: list[tuple[int, int, int]] = []
        if rows:
            first = batch.column("first").to_numpy()[rows]
            lead = pc.fill_null(batch.column("at"), 0).to_numpy()[rows] - first
            found = repeated_windows([data[i] for i in rows], lead)
            before = found.shape[1] - 1
            for j, i in enumerate(rows):
                if n[keys[i]] == 1:
                    a = before - int(lead[j])
                    out += [(i, *x) for x in runs(found[j, a:a + len(data[i]) - LENGTH + 1], int(first[j]))]
        take = pa.array([x[0] for x in out], pa.int64())
        return pa.table([*(batch.column(c).take(take) for c in PLACE), pa.array([x[1] for x in out], pa.int64()),
                         pa.array([x[2] for x in out], pa.int64())], names=[*PLACE, "first", "end"])

    return groups.groupBy("bucket").applyInArrow(run, f"{PLACE[0]} long, {PLACE[1]} long, first long, end long")


def counted_windows(own: DataFrame) -> DataFrame:
    """place, first, end of repeated bytes of single contexts, from rows place, first, n,
    bytes of different contexts: a window that occurs once is none."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                f, r, first, own = (batch.column(c)[i].as_py() for c in range(4))
                n = len(own) - LENGTH + 1
                pair = np.frombuffer(b"".join(xxhash.xxh3_128_digest(own[w:w + LENGTH]) for w in range(n)), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pair[::2]), pa.array(pair[1::2]), *(pa.array([x] * n, pa.int64()) for x in (f, r, first)),
                                                  pa.array(range(n), pa.int32())], names=["w1", "w2", *PLACE, "first", "window"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            for i, (first, n, once) in enumerate(zip(*(batch.column(c).to_pylist() for c in (2, 3, 4)), strict=True)):
                windows = np.ones(n, bool)
                windows[once] = False
                out += [(i, *x) for x in runs(windows, first)]
            take = pa.array([x[0] for x in out], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(take) for c in (0, 1)), pa.array([x[1] for x in out], pa.int64()),
                                              pa.array([x[2] for x in out], pa.int64())], names=[*PLACE, "first", "end"])

    place = f"{PLACE[0]} long, {PLACE[1]} long, first long"
    windows = own.select(*PLACE, "first", "bytes").mapInArrow(cut, f"w1 long, w2 long, {place}, window int")
    once = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*PLACE, "first", "window")).alias("one")).where("n = 1")
    single = own.where("n = 1").select(*PLACE, "first", (F.length("bytes") - LENGTH + 1).alias("windows"), F.lit(None).cast("int").alias("window"))
    both = single.unionByName(once.select("one.*"), allowMissingColumns=True).groupBy(*PLACE, "first").agg(
        F.max("windows").alias("windows"), F.collect_list("window").alias("once")).where("windows is not null")
    return both.mapInArrow(join, f"{place}, end long")


def repeated_spans(rows: DataFrame) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """For rows text (binary), place: bitmaps of grams and of contexts that occur twice,
    and place, spans (first, end; may overlap): repeated bytes of other contexts; an
    end of -1 names a context that the bitmap holds by chance."""
    twice = written(anchors(rows).groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1").select("gram"), "grams")
    grams = bitmap(twice, twice.count())
    # the bitmap lets some anchors through whose gram occurs once: single contexts of their own
    counts = written(contexts(rows, grams).groupBy("c1", "c2").agg(
        F.sum("n").alias("n"), F.min("gram").alias("gram"), F.min(F.struct(*PLACE, "first")).alias("one")
        ).select("c1", "gram", "n", "one.*"), "context-counts")
    copied = counts.where("n > 1").select("c1")
    often = bitmap(copied, copied.count())
    spans = by_chance(counts.where("n = 1"), often).withColumn("end", F.lit(-1).cast("long"))
    several = counts.groupBy("gram").agg(F.count(F.lit(1)).alias("contexts"), F.min("n").alias("least")).where("contexts > 1 and least = 1")
    chosen = written(counts.drop("c1").join(several.drop("least"), "gram"), "mixed-contexts")
    hot = F.col("contexts") > BUCKET
    usual, many = (chosen.where(c) for c in (~hot, hot))
    if total := usual.count():
        buckets = F.pmod(F.xxhash64("gram"), F.lit(math.ceil(total / BUCKET))).alias("bucket")
        own = context_bytes(rows, grams, spot_bits(usual, total)).select(buckets, *PLACE, "first", "at", "bytes")
        spans = spans.unionByName(edge_spans(own.unionByName(usual.select(buckets, *PLACE, "first", "n"), allowMissingColumns=True)))
    if total := many.count():
        own = context_bytes(rows, grams, spot_bits(many, total)).drop("gram", "at").join(many.select(*PLACE, "first", "n"), [*PLACE, "first"])
        spans = spans.unionByName(counted_windows(written(own, "hot-contexts")))
    return spans.groupBy(*PLACE).agg(F.collect_list(F.struct("first", "end")).alias("spans")), grams, often


def without_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """For each row: ``row`` (the input row), n_bytes, spans (the maximal removed
    runs: first, end, in bytes) and kept (binary, all bytes outside them).

    Matches never cross texts; each place counts on the input as it is, overlaps
    too, so all occurrences go.  Null and empty texts have no bytes; texts of any
    length are read whole; repeated rows are repeats of each other; null ids and
    further columns play no part; an empty table gives no rows.
    """
    docs = scanned(docs)
    binary = lambda c: F.coalesce(c, F.lit("")).cast("binary").alias("text")
    spans, grams, often = repeated_spans(placed(docs, binary(F.col(text))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            kept, cuts = [], []
            for data, given in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                given = [(x["first"], x["end"]) for x in given or []]
                found = [x for x in given if x[1] >= 0]
                if len(data) >= LENGTH:
                    chance = {x[0] for x in given if x[1] < 0}
                    at, gram, first, last = hasher(data)
                    maybe = np.flatnonzero(probed(gram, grams))
                    places = list(zip(at[maybe].tolist(), first[maybe].tolist(), last[maybe].tolist(), strict=True))
                    keys = np.frombuffer(b"".join(digest(data, *x) for x in places), np.int64)[::2]
                    found += [(f, e + LENGTH) for (_, f, e), hit in zip(places, probed(keys, often).tolist(), strict=True)
                              if hit and f not in chance]
                merged: list[list[int]] = []
                for a, b in sorted(found):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                ends = [0, *(x for m in merged for x in m), len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True)))
                cuts.append([{"first": a, "end": b} for a, b in merged])
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pc.binary_length(batch.column(1)).cast(pa.int64()),
                pa.array(cuts, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                names=["row", "n_bytes", "spans", "kept"])

    joined = placed(docs, F.struct("*").alias("row")).join(spans, list(PLACE), "left").select(
        "row", binary(F.col("row").getField(text)), "spans")
    kind = joined.schema["row"].dataType.simpleString()
    return joined.mapInArrow(run, f"row {kind}, n_bytes long, spans array<struct<first:bigint,end:bigint>>, kept binary")
