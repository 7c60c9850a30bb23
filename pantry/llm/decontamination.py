"""Benchmark decontamination by winnowing.

Of each ``WINDOW`` successive k-word hashes the smallest are kept, so two texts
that share K + WINDOW - 1 words in a row share a kept hash.  The fingerprints of
documents and benchmark are joined, and each hit is extended along its diagonal,
word by word, to the whole shared spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PLACE, placed, scanned, written
from .words import ALNUM, gram_hashes, gram_starts, slices, word_hashes

#: A shared span of SPAN words is certain to be found: K + WINDOW - 1 = SPAN.
SPAN, K = 10, 4
WINDOW = SPAN - K + 1
#: Hash values that stand for a document itself, spread over as many join keys.
MARKS = 64


def kept_places(grams: np.ndarray, window: int) -> np.ndarray:
    """Places whose hash is the smallest of some window (all of equal ones).

    ``grams`` holds the greatest value where no k-gram starts, so windows at a
    text's end, and in texts with fewer than a window's hashes, are of what is there.
    """
    n = len(grams)
    top = np.iinfo(np.uint64).max
    padded = np.concatenate([grams, np.full(window - 1, top, np.uint64)])
    least = grams.copy()
    for j in range(1, window):
        np.minimum(least, padded[j:j + n], out=least)
    before = np.concatenate([np.full(window - 1, top, np.uint64), least])
    kept = np.zeros(n, bool)
    for j in range(window):
        kept |= before[j:j + n] == grams
    return np.flatnonzero(kept & (grams != top))


def fingerprints(texts: pa.Array, families: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, hash of each fingerprint; words of each text)."""
    hashes, bounds = word_hashes(texts, ALNUM)
    found = []
    for k, window in families:
        grams = np.full(len(hashes), np.iinfo(np.uint64).max, np.uint64)
        own = gram_hashes(hashes, k)
        grams[:len(own)] = own ^ np.uint64(k)
        grams[~gram_starts(bounds, k)] = np.iinfo(np.uint64).max
        at = kept_places(grams, window)
        found.append((at, grams[at]))
    at = np.concatenate([f[0] for f in found])
    row = np.searchsorted(bounds, at, "right") - 1
    return row, at - bounds[row], np.concatenate([f[1] for f in found]).view(np.int64), np.diff(bounds)


def document_fingerprints(docs: DataFrame, families: list[tuple[int, int]], text: str) -> DataFrame:
    """place, doc_id, n_words, pos, hash: a row for each fingerprint, and one with
    pos -1 and a hash from 0 to MARKS - 1 for each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to in slices(batch.column(1)):
                row, pos, h, n = fingerprints(batch.column(1).slice(at, to - at), families)
                every = np.arange(to - at)
                row, pos, h = np.concatenate([row, every]), np.concatenate([pos, every * 0 - 1]), np.concatenate([h, every % MARKS])
                take = pa.array(row)
                cols = [batch.column(c).slice(at, to - at).take(take) for c in (0, 2, 3)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(n[row]), pa.array(pos.astype(np.int32)), pa.array(h)],
                                                 names=["doc_id", *PLACE, "n_words", "pos", "hash"])

    return placed(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id long, {PLACE[0]} long, {PLACE[1]} long, n_words long, pos int, hash long")


def item_words(benchmark: DataFrame, text: str) -> DataFrame:
    """item_id, words (the item's words, one blank between): items with words alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [b" ".join((x or "").encode().translate(ALNUM).split()).decode() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.string())], names=["item_id", "words"])

    return benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col(text).alias("text")).mapInArrow(
        run, "item_id string, words string").where("words <> ''")


def item_fingerprints(items: DataFrame, families: list[tuple[int, int]]) -> DataFrame:
    """item, hash, pos: items of SPAN words or more have all their fingerprints;
    shorter ones, which are found whole, one k-gram of the second family alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, pos, h, n = fingerprints(batch.column(1), families[:1])
            long = n[row] >= SPAN
            row, pos, h = row[long], pos[long], h[long]
            if len(families) > 1:
                r2, p2, h2, _ = fingerprints(batch.column(1), families[1:])
                order = np.lexsort((p2, h2, r2))
                order = order[(n[r2[order]] < SPAN) & (np.diff(r2[order], prepend=-1) != 0)]
                row, pos, h = (np.concatenate(x) for x in ((row, r2[order]), (pos, p2[order]), (h, h2[order])))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(h), pa.array(pos.astype(np.int32))],
                                             names=["item", "item_hash", "item_pos"])

    return items.select("item", "words").mapInArrow(run, "item long, item_hash long, item_pos int")


def shared_spans(doc: list[bytes], item: list[bytes], diagonals: list[int]) -> list[tuple[int, int]]:
    """Stretches of ``doc`` that hold SPAN words or more of ``item`` in a row (a
    shorter item: all its words), on the given diagonals."""
    need, out = min(SPAN, len(item)), []
    for d in diagonals:
        begin = None
        for i in range(max(0, d), min(len(doc), len(item) + d) + 1):
            if i < min(len(doc), len(item) + d) and doc[i] == item[i - d]:
                begin = i if begin is None else begin
            else:
                if begin is not None and i - begin >= need:
                    out.append((begin, i))
                begin = None
    return out


def verified(candidates: DataFrame) -> DataFrame:
    """place, n_hit, spans, items of rows place, text, found (item, words, diagonals)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                f, r, text, found = (batch.column(c)[i].as_py() for c in range(4))
                doc = (text or "").encode().translate(ALNUM).split()
                hit, items = bytearray(len(doc)), []
                for x in found:
                    spans = shared_spans(doc, x["words"].encode().split(), x["diagonals"])
                    for a, b in spans:
                        hit[a:b] = b"\1" * (b - a)
                    if spans:
                        items.append(x["item"])
                if items:
                    edges = np.flatnonzero(np.diff(np.frombuffer(bytes(hit), np.int8), prepend=0, append=0)).reshape(-1, 2)
                    yield pa.RecordBatch.from_pylist([{
                        PLACE[0]: f, PLACE[1]: r, "n_hit": hit.count(1), "items": items,
                        "spans": [{"first": int(a), "end": int(b)} for a, b in edges]}], schema=schema)

    schema = pa.schema([(PLACE[0], pa.int64()), (PLACE[1], pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.int64())),
                        ("spans", pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())])))])
    return candidates.mapInArrow(run, f"{PLACE[0]} long, {PLACE[1]} long, n_hit long, items array<bigint>, "
                                      "spans array<struct<first:int,end:int>>")


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text") -> DataFrame:
    """For each document: place, doc_id, n_words, n_hit, spans (hit words, from 0,
    end excluded), item_ids (sorted strings, each once).

    Null and empty texts have no words and no hits; an item without words is in
    none; items with equal words are compared once; an item with a null id marks
    words but isn't listed.  Null ids and repeated rows of documents are told
    apart by place; further columns are left out; empty tables give no rows or
    no hits.
    """
    docs = scanned(docs)
    items = item_words(benchmark, item_text).groupBy("words").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    items = written(items.withColumn("item", F.xxhash64("words")).withColumn(
        "n", F.size(F.split("words", " "))), "benchmark-items")
    shortest = items.where(F.col("n") < SPAN).agg(F.min("n")).first()[0]
    families = [(K, WINDOW)] + ([(shortest, 1)] if shortest else [])
    marks = docs.sparkSession.range(MARKS).select(F.lit(None).cast("long").alias("item"), F.col("id").alias("item_hash"),
                                                  F.lit(0).alias("item_pos"))
    prints = item_fingerprints(items, families).unionByName(marks)
    hits = document_fingerprints(docs, families, text).join(prints, F.col("hash") == F.col("item_hash"))
    pair = F.when(F.col("item").isNotNull(), F.struct("item", (F.col("pos") - F.col("item_pos")).alias("diagonal")))
    base = written(hits.groupBy(*PLACE, "doc_id", "n_words").agg(F.collect_set(pair).alias("pairs")), "fingerprint-hits")
    found = base.select(*PLACE, F.explode("pairs").alias("p")).groupBy(*PLACE, F.col("p.item").alias("item")).agg(
        F.collect_list("p.diagonal").alias("diagonals"))
    found = found.join(items.select("item", "words"), "item").groupBy(*PLACE).agg(
        F.collect_list(F.struct("item", "words", "diagonals")).alias("found"))
    texts = placed(docs, F.col(text).alias("text"))
    shared = verified(texts.join(found, list(PLACE)).select(*PLACE, "text", "found"))
    listed = shared.select(*PLACE, "n_hit", "spans", F.explode("items").alias("item")).join(items.select("item", "item_ids"), "item")
    listed = listed.groupBy(*PLACE).agg(F.first("n_hit").alias("n_hit"), F.first("spans").alias("spans"), F.sort_array(
        F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"))
    return base.drop("pairs").join(listed, list(PLACE), "left").select(
        *PLACE, "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), "spans",
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))
