"""Source divergence audit by one-hot level products.

Each (lang, source) group's counts of the kept terms take few levels.  Of a block of
terms, the indicator columns of (group, level) times their own transpose give, for
every two groups at once, how many terms stand at each pair of levels.  A pair of
levels has one price, so a block's part of a divergence is its joint table times the
prices.  Blocks hold terms of about one frequency: rare terms have few levels, and
blocks of frequent ones are small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, written
from .terms import ALPHA, term_pieces

#: Documents of a lang that hold a kept term, at least.
LEAST_DOCUMENTS = 10
#: Terms of a block, about, by the bits of the term's count in its lang; groups of a tile, about.
RARE_BITS, RARE_TERMS, OFTEN_TERMS, GROUP_TILE = 6, 512, 256, 32
#: Indicator columns that are multiplied at once.
COLUMN_TILE = 1024
#: Rows that a task holds before it adds them up, and after that before it hands them on.
HELD_ROWS, KEPT_ROWS = 1 << 19, 1 << 18
#: Bits of a term's count in its lang, without the first.
BITS = "cast(floor(log2(lang_n)) as int)"
_COUNTS = "lang string, source string, term string, n long, n_docs long"


def term_counts(docs: DataFrame, text: str) -> DataFrame:
    """lang, source, term, n (occurrences), n_docs (documents that hold it): one row
    for each of the three."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            langs, sources = batch.column(0), batch.column(1)
            for at, to, found in _text_counts(batch.column(2)):
                row, terms, n = found
                table = pa.table({"lang": langs.slice(at, to - at).take(row), "source": sources.slice(at, to - at).take(row),
                                  "term": terms, "n": n, "n_docs": pa.array(np.ones(len(n), np.int64))})
                held.append(_added([table]))
                if sum(map(len, held)) > HELD_ROWS:
                    held = [_added(held)]
                    if len(held[0]) > KEPT_ROWS:
                        yield from held.pop().to_batches(max_chunksize=20_000)
        if held:
            yield from _added(held).to_batches(max_chunksize=20_000)

    bounded_batches(docs.sparkSession)
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    parts = docs.select(word("lang"), word("source"), F.col(text).alias("text")).mapInArrow(run, _COUNTS)
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def _added(tables: list[pa.Table]) -> pa.Table:
    out = pa.concat_tables(tables).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("n_docs", "sum")])
    return out.select(["lang", "source", "term", "n_sum", "n_docs_sum"]).rename_columns(["lang", "source", "term", "n", "n_docs"]).cast(
        pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("n_docs", pa.int64())]))


def _text_counts(texts: pa.Array) -> Iterator[tuple[int, int, tuple[pa.Array, pa.Array, pa.Array]]]:
    """(from, to, (text, term, occurrences)) of stretches of texts; a text's pieces are put together."""
    parts: list[pa.Table] = []
    last = None
    for at, to, terms, bounds in term_pieces(texts, ALPHA):
        coded = terms.dictionary_encode()
        size = max(1, len(coded.dictionary))
        key, n = np.unique(np.repeat(np.arange(to - at), np.diff(bounds)) * size + coded.indices.to_numpy(), return_counts=True)
        if last and last != (at, to):
            yield *last, _joined(parts)
            parts = []
        last = (at, to)
        parts.append(pa.table({"row": key // size, "term": coded.dictionary.take(pa.array(key % size)), "n": n}))
        if len(parts) > 8:
            parts = [parts[0].from_arrays(_joined(parts), names=["row", "term", "n"])]
    if last:
        yield *last, _joined(parts)


def _joined(parts: list[pa.Table]) -> tuple[pa.ChunkedArray, ...]:
    table = parts[0] if len(parts) == 1 else pa.concat_tables(parts).group_by(["row", "term"], use_threads=False).aggregate([("n", "sum")]).select(
        ["row", "term", "n_sum"])
    return tuple(table.columns)


def price(count: str, total: str, kept: str) -> Column:
    """1 + floor(1000000000 * (count + 2) / (total + 2 * kept)), exact for any count; null without kept terms."""
    big = "cast({} as decimal(38,0))".format
    return F.expr(f"1 + (({big(1_000_000_000)} * ({count} + 2)) div nullif({big(f'{total} + 2 * {kept}')}, 0))").cast("long")


def gap(p: str, q: str) -> Column:
    """floor((p - q) * (p - q) / (p + q)); prices are 2**30 at most, so squares fit a long."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def block_gaps(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Of one block of terms and two tiles of groups: lang, source, other, gap (what
    the terms add to the divergence, above what as many terms in neither would).

    Rows without a term name a group and its price of no occurrence; the others are
    occurrences.
    """
    empty = pc.is_null(table["term"])
    groups, cells = table.filter(empty), table.filter(pc.invert(empty))
    names = groups["source"].combine_chunks()
    tile, base = (groups[c].to_numpy() for c in ("tile", "price"))
    terms = cells["term"].combine_chunks().dictionary_encode()
    term, group = terms.indices.to_numpy(), pc.index_in(cells["source"].combine_chunks(), value_set=names).to_numpy()
    level, prices = (np.zeros((len(terms.dictionary), len(names)), np.int64) for _ in range(2))
    prices[:] = base
    level[term, group], prices[term, group] = cells["n"].to_numpy(), cells["price"].to_numpy()
    owner, tag, columns = [], [], np.zeros(level.shape, np.int64)
    for g in range(len(names)):
        _, at, code = np.unique(level[:, g], return_index=True, return_inverse=True)
        columns[:, g] = code + sum(map(len, tag))
        owner.append(np.full(len(at), g))
        tag.append(prices[at, g])
    owner, tag = np.concatenate(owner), np.concatenate(tag)
    one_hot = np.zeros((len(level), len(owner)), np.float32)  # sums of ones, exact below 2**24 terms
    one_hot[np.arange(len(level))[:, None], columns] = 1
    out = np.zeros((len(names), len(names)), np.int64)
    for a in range(0, len(owner), COLUMN_TILE):
        left = np.ascontiguousarray(one_hot[:, a:a + COLUMN_TILE].T)
        for b in range(a, len(owner), COLUMN_TILE):
            joint = left @ one_hot[:, b:b + COLUMN_TILE]
            x, y = np.nonzero(joint)
            n, x, y = joint[x, y].astype(np.int64), x + a, y + b
            g, h = owner[x], owner[y]
            use = g < h  # columns ascend by group
            n, x, y, g, h = (v[use] for v in (n, x, y, g, h))
            np.add.at(out, (g, h), n * (_gap(tag[x], tag[y]) - _gap(base[g], base[h])))
    meet = np.triu(np.ones(out.shape, bool), 1) & ((tile[:, None] != tile) | (key[-2] == key[-1]))
    g, h = np.nonzero(meet)
    return pa.table({"lang": pa.array([key[0].as_py()] * len(g), pa.string()), "source": names.take(pa.array(g)),
                     "other": names.take(pa.array(h)), "gap": out[g, h]})


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def laid_out(kept: DataFrame) -> DataFrame:
    """lang, kept (its terms), lang_total, n_buckets (of the terms of each number of bits: one map)."""
    terms = kept.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n")).select("lang", "lang_n", F.expr(BITS).alias("bits"))
    by_bits = terms.groupBy("lang", "bits").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("total"))
    size = F.when(F.col("bits") < RARE_BITS, RARE_TERMS).otherwise(OFTEN_TERMS)
    buckets = F.map_from_entries(F.collect_list(F.struct("bits", F.ceil(F.col("kept") / size).cast("long"))))
    return by_bits.groupBy("lang").agg(F.sum("kept").alias("kept"), F.sum("total").alias("lang_total"), buckets.alias("n_buckets"))


def pair_gaps(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, other (each pair once), gap: sums over all blocks."""
    cells = cells.withColumn("bits", F.expr(BITS)).withColumn("bucket", F.expr("pmod(xxhash64(term), n_buckets[bits])"))
    cells = cells.select("lang", "source", "term", "n", "price", "bits", "bucket", "n_tiles")
    named = groups.select("*", F.explode("n_buckets").alias("bits", "of")).select(
        "lang", "source", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"), F.col("none").alias("price"), "bits",
        F.explode(F.expr("sequence(0L, of - 1)")).alias("bucket"), "n_tiles")
    rows = cells.unionByName(named).withColumn("tile", F.pmod(F.xxhash64("source"), "n_tiles"))
    rows = rows.select("*", F.explode(F.expr("sequence(0L, n_tiles - 1)")).alias("met")).withColumns(
        {"i": F.least("tile", "met"), "j": F.greatest("tile", "met")})
    return rows.select("lang", "bits", "bucket", "i", "j", "tile", "source", "term", "n", "price").groupBy(
        "lang", "bits", "bucket", "i", "j").applyInArrow(block_gaps, "lang string, source string, other string, gap long").groupBy(
        "lang", "source", "other").agg(F.sum("gap").alias("gap"))


def audit(docs: DataFrame, text: str = "text", least_documents: int = LEAST_DOCUMENTS, ranks: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank.

    Part ``pair``: each other source of the lang, and the divergence of the two over
    all kept terms; part ``term``: the ``ranks`` terms by which the group exceeds its
    lang most.  Null lang, source and text are empty strings; a text without letters
    adds its group alone.  A lang without kept terms has pairs of value 0 and no
    terms; one with a single source has no pairs.  Repeated rows count as documents
    of their own; equal values are in the order of the items' bytes.  Long texts are
    read whole, in pieces.  An empty table gives no rows; further columns, null ids
    among them, aren't read.
    """
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    counts = written(term_counts(docs, text), "divergence-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("n_docs").alias("n_docs")).where(
        F.col("n_docs") >= least_documents).drop("n_docs")
    kept = written(counts.drop("n_docs").join(kept, ["lang", "term"]), "divergence-kept")
    named = docs.select(word("lang"), word("source")).distinct()
    tiles = named.groupBy("lang").agg(F.ceil(F.count("*") / GROUP_TILE).cast("long").alias("n_tiles"))
    groups = named.join(kept.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left").join(
        laid_out(kept), "lang", "left").join(tiles, "lang").withColumn("total", F.coalesce("total", F.lit(0).cast("long")))
    groups = written(groups.withColumn("none", price("0", "total", "kept")), "divergence-groups")
    cells = kept.join(groups.where("kept is not null"), ["lang", "source"]).withColumns(
        {"price": price("n", "total", "kept"), "lang_price": price("lang_n", "lang_total", "kept")})
    first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    above = cells.where("price > lang_price").select("lang", "source", "term", gap("price", "lang_price").alias("value")).withColumn(
        "rank", F.row_number().over(first)).where(F.col("rank") <= ranks)
    terms = above.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    gaps = written(pair_gaps(cells, groups.where("kept is not null")), "divergence-gaps")
    gaps = gaps.unionByName(gaps.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "gap"))
    others = groups.select("lang", F.col("source").alias("other"), F.col("none").alias("other_none"))
    pairs = groups.join(others, "lang").where("source <> other").join(gaps, ["lang", "source", "other"], "left")
    value = F.coalesce(F.col("gap"), F.lit(0)) + F.coalesce(F.col("kept") * gap("none", "other_none"), F.lit(0))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), value.alias("value")).withColumn(
        "rank", F.row_number().over(by_value))
    return pairs.unionByName(terms)
