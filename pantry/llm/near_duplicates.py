"""N-gram Jaccard join by parity sketches.

A set of shingles is hashed into a bit sketch: each shingle flips one bit, so the
Hamming distance of two sketches never exceeds the size of the sets' symmetric
difference.  Sets with Jaccard at least t differ in d = (1 - t) / (1 + t) of
their joint size at most; a sketch cut into more than d chunks therefore has
chunks that are equal in both, and d + 1 chunks chosen by one order in both sets
share one (pigeonhole).  Chunk counts depend on the size band alone; a set near
its band's upper end joins in the next band too.

The sketch is sparse (2**64 places a chunk), so a chunk's contents are the
exclusive or of its shingles' hashes.  Documents with equal sets are one class
from the start.  A key's classes are first compared with one of them, its pivot;
links between the others, where they are still in different components, are
found by how they differ from it (``across``).  So no link between components is
lost, and the pairs of a group are never listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import PLACE, placed, written
from .graph import components
from .words import BLANK, gram_hashes, mixed, slices, word_hashes

#: Bits of the dense parity sketch that each pair's distance is first bounded by.
SKETCH_BITS = 1024
#: Bits of the filters that spare rows a shuffle; a full one lets all rows pass.
FILTER_LOG = 25
FILTER_BITS = 1 << FILTER_LOG
#: Counters of shingle frequencies, which only decide the order of a set's chunks.
COUNTERS = 1 << 18


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Sorted hashes of each text's distinct k-word shingles; with fewer words,
    of the whole sequence; none without words."""
    hashes, bounds = word_hashes(texts, BLANK)
    grams = gram_hashes(hashes, k)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= k:
            yield np.unique(grams[a:b - k + 1])
        elif b > a:
            yield gram_hashes(hashes[a:b], b - a)
        else:
            yield hashes[:0]


def set_id(s: np.ndarray) -> int:
    """One 64-bit name for equal sets."""
    return int(np.sum(mixed(s ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64).view(np.int64)) if len(s) else 0


def band(size: int) -> int:
    return size.bit_length() - 1


def frequency_levels(docs: DataFrame, k: int) -> np.ndarray:
    """Base-2 logarithm of how often the shingles of each counter occur in all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for at, to in slices(batch.column(0)):
                grams = gram_hashes(word_hashes(batch.column(0).slice(at, to - at), BLANK)[0], k)
                total += np.bincount((grams % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["counter", "n"])

    got = docs.mapInArrow(run, "counter int, n long").groupBy("counter").agg(F.sum("n").alias("n")).toPandas()
    out = np.ones(COUNTERS, np.int64)
    out[got["counter"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    return np.log2(out).astype(np.uint8)


def chunk_keys(s: np.ndarray, percent: int, levels: np.ndarray) -> np.ndarray:
    """Keys of which two sets with Jaccard of ``percent`` or more share one.

    Any order that depends on a chunk's contents alone will do.  Chunks with a
    rare shingle come first, then full ones, so that what many texts share
    (a common passage, an empty chunk) is seldom a key."""
    n, out = len(s), []
    own = mixed(s ^ np.uint64(0x2545F4914F6CDD1D))
    level = levels[(s % np.uint64(COUNTERS)).astype(np.int64)]
    for t in (band(n), band(n) + 1):
        # the largest partner in this band, and the most that it can differ by
        largest = min(100 * n // percent, (2 << t) - 1)
        if largest < max(1 << t, -(-percent * n // 100)):
            continue
        differ = (n + largest) * (100 - percent) // (100 + percent)
        if not differ:
            continue  # equal sets are a class already
        most = 2 * ((2 << t) - 1) * (100 - percent) // (100 + percent)
        chunks = max((2 << t) // 4, most + 1)
        at = (own % np.uint64(chunks)).astype(np.int64)
        order = np.argsort(at, kind="stable")
        count = np.bincount(at, minlength=chunks)
        full = np.flatnonzero(count)
        content = np.zeros(chunks, np.uint64)
        content[full] = np.bitwise_xor.reduceat(own[order], (np.cumsum(count) - count)[full])
        keys = mixed(content + mixed(np.arange(chunks, dtype=np.uint64) + np.uint64(t << 40)))
        rarest = np.full(chunks, 255, np.uint8)
        rarest[full] = np.minimum.reduceat(level[order], (np.cumsum(count) - count)[full])
        out.append(keys[np.lexsort((keys, -count, rarest))[:differ + 1]])
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def parity_sketch(s: np.ndarray) -> np.ndarray:
    bits = np.bincount((s % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS).astype(np.uint8) & 1
    return np.packbits(bits).view(np.int64)


def sketched(docs: DataFrame, k: int, percent: int, levels: np.ndarray) -> DataFrame:
    """doc_id, place, n_shingles, class, keys, sketch of rows doc_id, text, place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to in slices(batch.column(1)):
                sets = list(shingle_sets(batch.column(1).slice(at, to - at), k))
                keys = [chunk_keys(s, percent, levels) if len(s) else s for s in sets]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in keys])]).astype(np.int32)
                flat = np.concatenate([*keys, np.zeros(0, np.uint64)]).view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).slice(at, to - at) for c in (0, 2, 3)),
                    pa.array([len(s) for s in sets], pa.int64()), pa.array([set_id(s) for s in sets], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                    pa.array([parity_sketch(s) for s in sets], pa.list_(pa.int64()))],
                    names=["doc_id", *PLACE, "n_shingles", "class", "keys", "sketch"])

    return docs.mapInArrow(run, f"doc_id long, {PLACE[0]} long, {PLACE[1]} long, n_shingles long, class long, "
                                "keys array<bigint>, sketch array<bigint>")


def bit(hashed: Column) -> Column:
    """The filter's bit for a 64-bit hash."""
    return F.shiftrightunsigned(hashed, 64 - FILTER_LOG)


def filter_bits(values: DataFrame) -> np.ndarray:
    """One bit for each 64-bit hash of the only column: FILTER_BITS / 8 bytes, whatever the input."""
    b = bit(F.col(values.columns[0]))
    rows = values.select(F.floor(b / 32768).cast("int").alias("n"), F.pmod(b, F.lit(32768)).alias("b")).select(
        "n", F.expr("bitmap_bit_position(b + 1)").alias("b")).groupBy("n").agg(F.expr("bitmap_construct_agg(b)").alias("bits")).collect()
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in rows:
        out[r["n"] * 4096:(r["n"] + 1) * 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def held(h: pa.Array, bits: np.ndarray) -> np.ndarray:
    """Whether each of the filter's bits is set."""
    h = h.to_numpy(zero_copy_only=False).astype(np.int64)
    return (bits[h >> 3] >> (h & 7).astype(np.uint8)) & 1 == 1


def may_hold(frame: DataFrame, column: str, bits: np.ndarray) -> DataFrame:
    """Rows of ``frame`` whose ``column``, a 64-bit hash, may be among those of ``bits``."""
    names = frame.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = pa.RecordBatch.from_arrays(batch.columns[:len(names)], names=names)
            yield part.filter(pa.array(held(batch.column(len(names)), bits)))

    return frame.select("*", bit(F.col(column)).alias("h")).mapInArrow(run, frame.schema)


def distance(a: Column, b: Column) -> Column:
    """Hamming distance of two dense sketches."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)


def likely(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes and dense sketches leave a Jaccard of ``percent`` possible."""
    side = lambda c: sketches.select(F.col("class").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.where((F.lit(100) * F.least("n_a", "n_b") >= F.lit(percent) * F.greatest("n_a", "n_b"))
                      & (distance(F.col("sketch_a"), F.col("sketch_b")) * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent))
                      ).select("a", "b")


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have Jaccard of ``percent`` or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            ok = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(c[i].as_buffer(), np.uint64) for c in (left, right))
                both = len(x) + len(y) - len(np.union1d(x, y))
                ok[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(ok))

    full = lambda c: sets.select(F.col("class").alias(c), F.col("hashes").alias(f"hashes_{c}"))
    # b's set is fetched first: a is the class that many pairs may share, and then travels to them
    both = pairs.join(full("b"), "b").join(full("a"), "a").select("a", "b", "hashes_a", "hashes_b")
    return both.mapInArrow(run, "a long, b long")


def pivoted(members: DataFrame) -> DataFrame:
    """key, class and the key's pivot ``a``: of its classes the one that meets most
    others over all its keys, which in a group of copies is near the middle."""
    weight = members.join(members.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "key").groupBy("class").agg(F.sum("n").alias("w"))
    weighed = members.join(weight, "class")
    pivot = weighed.groupBy("key").agg(F.max(F.struct("w", "class")).alias("p")).select("key", F.col("p.class").alias("a"))
    return written(members.join(pivot, "key"), "pivoted")


def torn_members(members: DataFrame, roots: DataFrame) -> DataFrame:
    """class, a, root: classes under a pivot that share a key with a class of another
    component, both compared with the pivot already."""
    at = members.where("class <> a").join(roots, members["class"] == roots["node"], "left").select(
        "key", "class", "a", F.coalesce("root", "class").alias("root"))
    torn = at.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 < r1").select("key")
    return at.join(torn, "key", "left_semi").select("class", "a", "root").distinct()


def across(at: DataFrame, sets: DataFrame, sketches: DataFrame, levels: np.ndarray, percent: int) -> DataFrame:
    """Links between classes that share a key, but are in different components
    after each was compared with the key's pivot.

    Let D(x) be the difference of x and the pivot p.  Two sets differ
    by |D(x)| + |D(y)| - 2 |D(x) and D(y)|, so a link across components needs a
    common element of D(x) and D(y) (one of the two is no link of p).  With the
    elements in one order (those that p lacks first, then by rarity) d + 1 of each
    are enough, and the first common one at places i and j bounds what may follow.  So the many sets of a
    hot key meet only where they differ from its pivot alike.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for i in range(batch.num_rows):
                x, p = (np.frombuffer(batch.column(c)[i].as_buffer(), np.uint64) for c in (3, 4))
                d = np.setxor1d(x, p, assume_unique=True)
                d = d[np.lexsort((d, levels[(d % np.uint64(COUNTERS)).astype(np.int64)], np.isin(d, p, assume_unique=True)))]
                most = (len(x) + 100 * len(x) // percent) * (100 - percent) // (100 + percent)
                parts.append((i, d[:most + 1], len(d), len(x)))
            sizes = np.array([len(e) for _, e, _, _ in parts], np.int64)
            take = pa.array(np.repeat(np.arange(len(parts)), sizes))
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c).take(take) for c in (0, 1, 2)),
                pa.array(np.concatenate([e for _, e, _, _ in parts]).view(np.int64)),
                pa.array((np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)),
                pa.array(np.repeat(np.array([n for *_, n, _ in parts], np.int64), sizes)),
                pa.array(np.repeat(np.array([n for *_, n in parts], np.int64), sizes))],
                names=["class", "a", "root", "element", "i", "d", "n"])

    full = lambda c, h: sets.select(F.col("class").alias(c), F.col("hashes").alias(h))
    pairs = at.join(full("class", "own"), "class").join(full("a", "pivot"), "a").select("class", "a", "root", "own", "pivot")
    rows = written(pairs.mapInArrow(run, "class long, a long, root long, element long, i int, d long, n long"), "differences")
    x = rows.select("a", "element", *[F.col(c).alias(f"{c}_x") for c in ("class", "root", "i", "d", "n")])
    y = rows.select("a", "element", *[F.col(c).alias(f"{c}_y") for c in ("class", "root", "i", "d", "n")])
    common = F.least(F.col("d_x") - F.col("i_x"), F.col("d_y") - F.col("i_y"))  # at most, if this is the first
    enough = (F.col("d_x") + F.col("d_y") - 2 * common) * (100 + percent) <= (F.col("n_x") + F.col("n_y")) * (100 - percent)
    found = x.join(y, (x["a"] == y["a"]) & (x["element"] == y["element"]) & (F.col("class_x") < F.col("class_y"))
                   & (F.col("root_x") != F.col("root_y")) & enough)
    found = found.select(F.col("class_x").alias("a"), F.col("class_y").alias("b")).distinct()
    return linked(likely(found, sketches, percent), sets, percent)


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, text: str = "text") -> DataFrame:
    """For each document: doc_id, place, n_shingles, component_id, class (of the
    smallest class of the component, which tells components apart without ids).

    Texts are lower-cased (A-Z) and cut at ASCII white space.  component_id is
    the smallest doc_id that links of Jaccard ``percent`` / 100 or more reach.
    Null and empty texts and texts without words have an empty set, link with
    nothing, and are their own component; a text with fewer than ``k`` words is
    one shingle.  Null ids take part but are no component's id, unless it has no
    other (then null).  Repeated rows link; further columns are left out; an
    empty table gives no rows.
    """
    rows = placed(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    levels = frequency_levels(rows.select("text"), k)
    base = written(sketched(rows, k, percent, levels), "sketches")
    sets = base.where("n_shingles > 0")
    keys = sets.select(F.explode("keys").alias("key"), "class")
    shared = written(keys.groupBy("key").agg(F.min("class").alias("a"), F.max("class").alias("z")).where("a < z").select("key"), "shared-keys")
    members = may_hold(keys, "key", filter_bits(shared)).distinct()
    members = pivoted(written(members.join(shared, "key", "left_semi"), "members"))
    # one document stands for each class that shares a key
    needed = members.select("class").distinct()
    one = F.min(F.struct(*PLACE, "n_shingles", "sketch"))
    chosen = written(sets.join(needed, "class", "left_semi").groupBy("class").agg(one.alias("one")).select("class", "one.*"), "chosen")
    near = written(likely(members.where("class <> a").select("a", F.col("class").alias("b")).distinct(), chosen, percent), "near")
    first = written(whole_sets(rows, among(chosen, near, "a", "b"), k), "sets")
    links = written(linked(near, first, percent), "links")
    torn = written(torn_members(members, components(links)), "torn")
    more = across(torn, written(whole_sets(rows, among(chosen, torn, "class", "a"), k), "sets"), chosen, levels, percent)
    links = written(links.unionByName(more), "links")
    return members_of(base, components(links))


def among(chosen: DataFrame, pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Class and place of the chosen documents of classes in either column of ``pairs``."""
    classes = pairs.select(F.col(a).alias("class")).unionByName(pairs.select(F.col(b).alias("class"))).distinct()
    return written(chosen.join(classes, "class", "left_semi").select("class", *PLACE), "among")


def whole_sets(rows: DataFrame, chosen: DataFrame, k: int) -> DataFrame:
    """class, hashes (binary) of the chosen documents."""
    bits = filter_bits(chosen.select(F.xxhash64(*PLACE)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(held(batch.column(3), bits)))
            for at, to in slices(batch.column(0)):
                sets = list(shingle_sets(batch.column(0).slice(at, to - at), k))
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).slice(at, to - at) for c in (1, 2)), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=[*PLACE, "hashes"])

    sets = rows.select("text", *PLACE, bit(F.xxhash64(*PLACE)).alias("h")).mapInArrow(
        run, f"{PLACE[0]} long, {PLACE[1]} long, hashes binary")
    return sets.join(chosen, list(PLACE)).select("class", "hashes")


def members_of(base: DataFrame, roots: DataFrame) -> DataFrame:
    """doc_id, place, n_shingles, component_id from classes and their roots."""
    classes = base.where("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("least"))
    classes = classes.join(roots, classes["class"] == roots["node"], "left").select("class", "least", F.coalesce("root", "class").alias("root"))
    # only classes with links meet under their root
    named = classes.groupBy("root").agg(F.min("least").alias("component"))
    classes = classes.join(named, "root").select(F.col("class").alias("of"), "component", F.col("root").alias("group"))
    key = F.when(F.col("n_shingles") > 0, F.col("class"))
    return base.join(classes, key == F.col("of"), "left").select(
        "doc_id", *PLACE, "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
        F.col("group").alias("class"))
