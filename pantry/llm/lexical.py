"""Ranked lexical search by dense blocked matrix multiplication.

Items are dealt into blocks of bounded size; a block's vocabulary goes to the tasks,
which keep each document's counts of those terms.  Then each task multiplies tiles:
documents x vocabulary (impacts) times vocabulary x items (weights), in float64, cut
so that no partial sum reaches 2**53, and keeps the best of each item.  Every score
is thus an exact integer, and every document meets every item once.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import PLACE, placed, written
from .terms import term_pieces
from .words import ALNUM

#: (item, term) pairs of a block, about; what a task holds of the items follows from it.
BLOCK_PAIRS = 1 << 18
#: Items and documents of a tile.
ITEM_TILE, DOC_TILE = 128, 512
#: No impact reaches this.
IMPACT_BOUND = 10**6
EXACT = 1 << 53
ITEM = ("item_file", "item_row")


def item_terms(items: DataFrame, text: str) -> DataFrame:
    """item place, item_id, terms (each once, sorted): items with terms alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[int, pa.Array] = {}
            for at, _, terms, bounds in term_pieces(batch.column(1), ALNUM):
                for i in range(len(bounds) - 1):
                    own = terms[bounds[i]:bounds[i + 1]]
                    found[at + i] = pc.unique(pa.concat_arrays([found[at + i], own]) if at + i in found else own)
            rows = [i for i, own in found.items() if len(own)]
            take = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*(take.column(c) for c in (0, 2, 3)), pa.array([sorted(found[i].to_pylist()) for i in rows], pa.list_(pa.string()))],
                names=["item_id", *ITEM, "terms"])

    return placed(items, "item_id", F.col(text).alias("text")).mapInArrow(
        run, f"item_id {items.schema['item_id'].dataType.simpleString()}, {ITEM[0]} long, {ITEM[1]} long, terms array<string>")


def blocks(items: DataFrame, pairs: int) -> list[DataFrame]:
    """``items`` dealt by hash into blocks of about ``pairs`` terms, twice that at
    most; an item with more stands alone."""
    place, size = F.xxhash64(*ITEM), F.size("terms").cast("long")
    total = items.agg(F.sum(size)).first()[0] or 0
    n = -(-total // pairs)
    while n > 1:
        block = F.pmod(place, F.lit(n))
        if not items.groupBy(block.alias("b")).agg(F.sum(size).alias("pairs"), F.count("*").alias("n")).where(
                (F.col("pairs") > 2 * pairs) & (F.col("n") > 1)).head(1):
            break
        n *= 2
    return [items.where(F.pmod(place, F.lit(n)) == b) for b in range(n)]


def counted(docs: DataFrame, vocabulary: list[str], text: str) -> DataFrame:
    """place, doc_id, n (all terms), ids and counts (terms of the vocabulary) of
    each document with a term."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(sent.value, pa.large_string())
        for batch in batches:
            n = np.zeros(batch.num_rows, np.int64)
            keys, counts = [], []
            for at, to, terms, bounds in term_pieces(batch.column(1), ALNUM):
                n[at:to] += np.diff(bounds)
                ids = pc.fill_null(pc.index_in(terms, value_set=known), -1).to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(at, to), np.diff(bounds))
                key, many = np.unique((row * len(known) + ids)[ids >= 0], return_counts=True)
                keys.append(key)
                counts.append(many)
            key, at = np.unique(np.concatenate([np.zeros(0, np.int64), *keys]), return_inverse=True)  # pieces of a long text
            count = np.zeros(len(key), np.int64)
            np.add.at(count, at, np.concatenate([np.zeros(0, np.int64), *counts]))
            rows = np.flatnonzero(n)
            offsets = np.append(np.searchsorted(key, rows * len(known)), len(key)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(pa.array(rows)) for c in (0, 2, 3)), pa.array(n[rows]),
                 pa.ListArray.from_arrays(offsets, pa.array((key % len(known)).astype(np.int32))),
                 pa.ListArray.from_arrays(offsets, pa.array(count))],
                names=["doc_id", *PLACE, "n", "ids", "counts"])

    return placed(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id long, {PLACE[0]} long, {PLACE[1]} long, n long, ids array<int>, counts array<bigint>")


def weight_tiles(items: list[list[int]], weights: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first item, vocabulary of the tile, weights: vocabulary x items) of each tile of items."""
    for at in range(0, len(items), ITEM_TILE):
        tile = items[at:at + ITEM_TILE]
        vocabulary, column = np.unique(np.concatenate(tile), return_inverse=True)
        out = np.zeros((len(vocabulary), len(tile)))
        out[column, np.repeat(np.arange(len(tile)), [len(x) for x in tile])] = weights[vocabulary[column]]
        yield at, vocabulary, out


def exact_product(impacts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """``impacts @ weights`` as 64-bit integers: float64 products of column blocks
    whose sums stay below 2**53."""
    step = max(1, int((EXACT - 1) // (IMPACT_BOUND * max(1, weights.max(initial=1)))))
    out = np.zeros((len(impacts), weights.shape[1]), np.int64)
    for c in range(0, weights.shape[0], step):
        out += (impacts[:, c:c + step] @ weights[c:c + step]).astype(np.int64)
    return out


class Best:
    """The ``k`` best documents of each item of a tile so far; equal scores by id (null last), then place."""

    def __init__(self, n_items: int, k: int):
        self.k, self.least = k, np.zeros(n_items, np.int64)
        self.rows = np.zeros((0, 6), np.int64)  # item, score, id is null, id, place

    def add(self, scores: np.ndarray, docs: np.ndarray) -> None:
        """``scores``: documents x items; ``docs``: null, id, place of each document."""
        least = self.least
        if len(scores) > self.k:
            least = np.maximum(least, np.partition(scores, -self.k, axis=0)[-self.k])
        doc, item = np.nonzero((scores >= least) & (scores > 0))  # equal to the least: it may still win by its id
        if not len(doc):
            return
        rows = np.concatenate([self.rows, np.column_stack([item, scores[doc, item], docs[doc]])])
        rows = rows[np.lexsort((rows[:, 5], rows[:, 4], rows[:, 3], rows[:, 2], -rows[:, 1], rows[:, 0]))]
        nth = np.arange(len(rows)) - np.searchsorted(rows[:, 0], rows[:, 0])
        self.rows = rows[nth < self.k]
        last = rows[nth == self.k - 1]
        self.least[last[:, 0]] = last[:, 1]


def best_of_tasks(table: DataFrame, items: list[list[int]], weights: np.ndarray, k: int) -> DataFrame:
    """item (its number in the block), score, doc_id, place: each task's ``k`` best of each item."""
    sent = table.sparkSession.sparkContext.broadcast((items, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = sent.value
        tiles = [(first, vocabulary, w, Best(w.shape[1], k)) for first, vocabulary, w in weight_tiles(items, weights)]
        for whole in batches:
            for at in range(0, whole.num_rows, DOC_TILE):
                batch = whole.slice(at, DOC_TILE)
                ids, counts = (batch.column(c).flatten().to_numpy() for c in (4, 5))
                row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(batch.column(4)).to_numpy())
                m = batch.column(3).to_numpy()[row]
                impacts = 1_000_000_000 * counts // (1000 * counts + 8 * m)
                docs = np.column_stack([pc.is_null(batch.column(0)).to_numpy(zero_copy_only=False).astype(np.int64),
                                        *(pc.fill_null(batch.column(c), 0).to_numpy() for c in (0, 1, 2))])
                for _, vocabulary, w, best in tiles:
                    column = np.minimum(np.searchsorted(vocabulary, ids), len(vocabulary) - 1)
                    here = vocabulary[column] == ids
                    tile = np.zeros((batch.num_rows, len(vocabulary)))
                    tile[row[here], column[here]] = impacts[here]
                    best.add(exact_product(tile, w), docs)
        for first, _, _, best in tiles:
            item, score, none, doc, *place = best.rows.T
            yield pa.RecordBatch.from_arrays(
                [pa.array(item + first), pa.array(score), pa.array(doc, mask=none == 1), *map(pa.array, place)],
                names=["item", "score", "doc_id", *PLACE])

    return table.mapInArrow(run, f"item long, score long, doc_id long, {PLACE[0]} long, {PLACE[1]} long")


def rank(docs: DataFrame, items: DataFrame, k: int = 10, text: str = "text", item_text: str = "text",
         block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score, place of the ``k`` best documents of
    each item with a score above 0.

    Each row of ``items`` is an item, with a null or repeated id too.  Null and empty
    texts, and texts of other signs alone, have no terms; they aren't counted and
    never found.  Long texts are read whole, in pieces.  Equal scores: smaller doc_id
    first, null last, then by place, so repeated rows all have ranks.  Empty tables
    give no rows; further columns are left out.
    """
    found = written(item_terms(items, item_text), "lexical-items")
    kind = items.schema["item_id"].dataType.simpleString()
    ranked, corpus = [], None
    for block in blocks(found, block_pairs):
        own = block.collect()  # about block_pairs terms
        vocabulary = sorted({t for r in own for t in r["terms"]})
        number = {t: i for i, t in enumerate(vocabulary)}
        table = written(counted(docs, vocabulary, text), "lexical-counts")
        corpus = corpus or table.agg(F.count("*"), F.sum("n")).first()
        held = dict(table.select(F.explode("ids").alias("id")).groupBy("id").count().collect())
        df = np.array([held.get(i, 0) for i in range(len(vocabulary))], float)
        weights = np.floor(1000 * np.log((2 * corpus[0] + 2) / (2 * df + 1)))
        length = F.expr(f"100 - 90 + cast((cast(90 as decimal(38,0)) * n * {corpus[0]}) div cast({corpus[1] or 1} as decimal(38,0)) as bigint)")
        best = best_of_tasks(table.select("doc_id", *PLACE, length.alias("m"), "ids", "counts"),
                             [[number[t] for t in r["terms"]] for r in own], weights, k)
        names = docs.sparkSession.createDataFrame([(i, r["item_id"], r[ITEM[0]], r[ITEM[1]]) for i, r in enumerate(own)],
                                                  f"item long, item_id {kind}, {ITEM[0]} long, {ITEM[1]} long")
        ranked.append(best.join(F.broadcast(names), "item").drop("item"))  # a block's items
    if not ranked:
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long, {PLACE[0]} long, {PLACE[1]} long")
    order = Window.partitionBy(*ITEM).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), *PLACE)
    return functools.reduce(DataFrame.unionByName, ranked).withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= k).select("item_id", "rank", "doc_id", "score", *PLACE)
