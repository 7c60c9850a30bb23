"""Toxicity of texts written to slip past word lists.

A noisy channel: the writer meant plain words, and leetspeak (1d10t), spacing
(i d i o t) and repetition (idioooot, iiddiioott) distorted them.  For each
stretch that may be distorted a lattice holds every letter that each sign may
stand for, and the sign itself; Viterbi finds the likeliest reading under a
character trigram model counted over the whole corpus.  A logistic model then
scores the restored words.

Letters are Unicode's.  The model's alphabet is the corpus's own: its most frequent
letters, and one class for all others.

Words without a sign beside a letter and without two equal signs in a row have
one reading only, themselves, so just the others are decoded.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PLACE, bounded_batches, placed, written

#: Letters that the model tells apart at most; the others share the symbol RARE, and
#: everything else is BOUND, a bound between words.
ALPHABET, BOUND, RARE = 94, 0, 1

#: Accents and vowel signs that follow a letter as characters of their own.
COMBINING = frozenset(c for c in map(chr, [*range(0x300, 0x20000), *range(0xE0100, 0xE01F0)]) if unicodedata.category(c)[0] == "M")

# Signs of leetspeak and the letters that they stand for.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e"}

#: Natural logarithms of the channel's prices.  A sign may also be itself, a bound between
#: words: a mark at a word's end often (END_COST), else seldom (SIGN_COST); a mark among
#: spaced letters may part them only (SKIP_COST).
LEET_COST, KEEP_REPEAT_COST, DROP_REPEAT_COST, BOUND_COST = -0.5, -3.0, -0.3, -3.0
SIGN_COST, END_COST, SKIP_COST = -7.0, -1.0, -2.5

SIGNS = re.escape("".join(LEET))
MARKS = re.escape("".join(x for x in LEET if not x.isalnum()))
#: Tokens of letters alone have more than one reading only with such a pair.
PAIR = re.compile(r"(.)\1")
SINGLE = r"[^\W_]"


def patterns(accents: str) -> tuple[re.Pattern, re.Pattern]:
    """Two patterns for texts with these combining characters.

    Tokens: letters and signs side by side, what stands between blanks and other marks.
    Spaced letters: three or more single letters or digits with separators between (three,
    or more where marks stand for letters), and single marks before and after.
    """
    gap = rf"(?:[^\w{MARKS}{accents}]|_){{1,3}}"
    return re.compile(rf"[\w{accents}{SIGNS}]+"), re.compile(
        rf"(?<!{SINGLE})(?=[^\W_]|[{MARKS}])(?<![{accents}])(?:(?<![{MARKS}])[{MARKS}]{gap})?{SINGLE}[{accents}]*+"
        rf"(?:(?:{gap}(?:[{MARKS}]{gap}|[{MARKS}]{{0,2}})|[{MARKS}]{{1,3}}(?:{gap})?){SINGLE}[{accents}]*+){{2,}}"
        rf"(?!{SINGLE})(?:{gap}[{MARKS}](?![\w{MARKS}]))?")


#: Sets above U+FFFF are slow, so texts without such characters have patterns of their own.
BASIC, WIDE = (patterns("".join(sorted(c for c in COMBINING if c <= most))) for most in ("\uffff", "\U0010ffff"))
#: What stands between two of them.
BETWEEN = re.compile(rf"(?<={SINGLE})[\W_]+(?={SINGLE})")
#: Letters of scripts that put no blanks between words (Thai to Khmer, kana, Chinese).
SOLID = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]+")

#: Bounds of the model: labelled rows that it is fitted on, words that it knows,
#: and as further features how many distinct words
#: begin alike (up to MOST).
FIT_ROWS, FEATURES, PREFIXES, MOST = 20_000, 2000, (4, 5, 6, 7), 4
LEAST_ROWS = 4


# -- language model ----------------------------------------------------------

class Model(NamedTuple):
    """Symbols of the letters that are told apart, and log P(c | a, b) as an array [a, b, c]."""
    index: dict[str, int]
    told: np.ndarray


def letter(c: str) -> bool:
    return c.isalpha() or c in COMBINING


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def alphabet(docs: DataFrame, text: str = "text") -> dict[str, int]:
    """Symbols of the corpus's ALPHABET most frequent letters."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0x110000, np.int64)
        for batch in batches:
            for x in batch.column(0).to_pylist():
                if x:
                    n = np.bincount(codes(x))
                    total[:n.size] += n
        found = np.array([c for c in np.flatnonzero(total) if letter(chr(c))], np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["code", "n"])

    counts = docs.select(F.col(text).alias("text")).mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    return {chr(r["code"]): i for i, r in enumerate(counts.orderBy(F.desc("n"), "code").limit(ALPHABET).collect(), RARE + 1)}


def trigram_counts(docs: DataFrame, index: dict[str, int], text: str = "text") -> DataFrame:
    """gram, n: how often each three symbols follow each other, over all texts.

    Each task adds up whole texts in one table of the symbols' cubed counts.
    """
    size = len(index) + 2

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lut = np.fromiter((RARE if letter(chr(c)) else BOUND for c in range(0x110000)), np.int32, 0x110000)
        lut[[ord(c) for c in index]] = list(index.values())
        total = np.zeros(size ** 3, np.int64)
        for batch in batches:
            for x in batch.column(0).to_pylist():
                if x:
                    c = lut[codes(f" {x} ")]
                    g = (c[:-2] * size + c[1:-1]) * size + c[2:]
                    np.add.at(total, g, 1)
        g = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(g.astype(np.int64)), pa.array(total[g])], names=["gram", "n"])

    return docs.select(F.col(text).alias("text")).mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def language_model(counts: DataFrame, index: dict[str, int]) -> Model:
    """The model of trigram counts; ALPHABET + 2 cubed values at most, whatever the input."""
    got, size = counts.toPandas(), len(index) + 2
    n = np.zeros(size ** 3)
    n[got["gram"].to_numpy(np.int64)] = got["n"].to_numpy(np.float64)
    n = n.reshape(size, size, size)
    two = n.sum(0)
    one = two.sum(0) + 1.0
    p1 = one / one.sum()
    p2 = (two + 5 * p1) / (two.sum(1, keepdims=True) + 5)
    return Model(index, np.log((n + 5 * p2) / (n.sum(2, keepdims=True) + 5)).astype(np.float32))


def lattice(stretch: str, index: dict[str, int]) -> list[list[tuple[int, float, str]]]:
    """For each sign the symbols it may stand for, their prices and characters; symbol -1: nothing."""
    out: list[list[tuple[int, float, str]]] = []
    spaced = (BASIC if max(stretch) <= "\uffff" else WIDE)[1].fullmatch(stretch) is not None
    # the same marks between all letters part them, as in i|d|i|o|t
    gaps = {"".join(c for c in x if c in LEET) for x in BETWEEN.findall(stretch)} if spaced else set()
    told = [(c, at) for at, c in enumerate(stretch) if letter(c) or c in LEET and (c.isalnum() or gaps in (set(), {""}) or len(gaps) > 1)]
    repeats = sum(a[0] == b[0] for a, b in zip(told, told[1:], strict=False))
    drawn = 5 * repeats >= 4 * (len(told) - repeats)  # nearly every letter is doubled
    tail = max((at for at, c in enumerate(stretch) if c.isalnum() or letter(c)), default=-1)
    before = -1
    for i, (c, at) in enumerate(told):
        if at > before + 1:  # separators: nothing, or a bound between words
            out.append([(-1, 0.0, ""), (BOUND, BOUND_COST, " ")] if spaced else [(BOUND, 0.0, " ")])
        before = at
        if letter(c):
            arcs = [(index.get(c, RARE), 0.0, c)]
        else:
            mark = not c.isalnum()
            arcs = [(index.get(x, RARE), LEET_COST, x) for x in LEET[c]] + [(BOUND, END_COST if mark and at > tail else SIGN_COST, " ")]
            if spaced and mark:
                arcs.append((-1, SKIP_COST, ""))
        if i and told[i - 1][0] == c:  # a repeat: a true double, or drawn out
            third = i > 1 and told[i - 2][0] == c
            run = 2 + third + (i + 1 < len(told) and told[i + 1][0] == c)
            keep, drop = (KEEP_REPEAT_COST, DROP_REPEAT_COST) if third or drawn else (DROP_REPEAT_COST, DROP_REPEAT_COST) if run > 2 else (0.0, KEEP_REPEAT_COST)
            arcs = [(x, price + keep, y) for x, price, y in arcs if x >= 0] + [(-1, drop, "")]
        out.append(arcs)
    return out


def decode(stretch: str, model: Model) -> str:
    """The likeliest reading: Viterbi over the last two symbols."""
    told = memoryview(model.told)
    best: dict[tuple[int, int], tuple[float, tuple]] = {(BOUND, BOUND): (0.0, ())}
    for arcs in lattice(stretch, model.index):
        after: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (a, b), (score, way) in best.items():
            for c, price, sign in arcs:
                if c < 0:
                    state, s, w = (a, b), score + price, way
                else:
                    state, s, w = (b, c), score + price + told[a, b, c], (way, sign)
                if state not in after or s > after[state][0]:
                    after[state] = (s, w)
        best = after
    a, b = max(best, key=lambda x: best[x][0] + told[x[0], x[1], BOUND])
    letters, way = [], best[a, b][1]
    while way:
        way, c = way
        letters.append(c)
    return "".join(reversed(letters))


class Restorer:
    """Restores the words of whole texts; each distinct stretch is decoded once."""

    def __init__(self, model: Model, remembered: int = 200_000):
        self.model, self.remembered, self.known = model, remembered, {}

    def reading(self, stretch: str) -> str:
        """``stretch`` decoded, if it has a letter; else it has no reading."""
        got = self.known.get(stretch)
        if got is None:
            got = decode(stretch, self.model).strip() if any(map(str.isalpha, stretch)) else ""
            if len(self.known) >= self.remembered:
                self.known.clear()
            if len(stretch) < 100:
                self.known[stretch] = got
        return got

    def words(self, text: str | None) -> set[str]:
        """The distinct words of the restored text, and of those in scripts without
        blanks all pairs and triples of letters."""
        out: set[str] = set()
        if not text:
            return out
        text = text.lower()
        tokens, spaced = BASIC if max(text) <= "\uffff" else WIDE
        text = spaced.sub(lambda m: f" {self.reading(m.group(0))} " if sum(map(str.isalpha, m.group(0))) > 1 else m.group(0), text)
        for s in set(tokens.findall(text)):
            if s.isalpha() and not PAIR.search(s):
                out.add(s)
            else:
                out.update(self.reading(s).split())
        for w in [w for w in out if not w.isascii()]:
            for part in SOLID.findall(w):
                out.update(part[i:i + k] for k in (2, 3) for i in range(len(part) - k + 1))
        return out


# -- classifier ------------------------------------------------------------

def features(words: set[str], known: set[str] | None = None) -> list[str]:
    """A text's distinct words, and for each beginning of a word ``beginning*n``
    for all n up to the number of distinct words that begin so (MOST at most).
    With ``known``, beginnings that it lacks are passed over."""
    out = list(words)
    for k in PREFIXES:
        begins = Counter([w[:k] for w in words if len(w) > k and (known is None or w[:k] in known)])
        out += [f"{b}*{i}" for b, n in begins.items() for i in range(1, min(n, MOST) + 1)]
    return out


def restored_features(docs: DataFrame, model: Model) -> DataFrame:
    """label, id, features (array) of rows label, id, text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                found = [sorted(features(restore.words(x))) for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, pa.list_(pa.string()))],
                                                 names=["label", "id", "features"])

    return docs.select("label", "id", "text").mapInArrow(run, "label int, id long, features array<string>")


def fit(labelled: DataFrame, model: Model) -> tuple[dict[str, float], float]:
    """Weights and intercept from rows label, id, text."""
    rows = written(restored_features(labelled, model), "toxic-features")
    totals = rows.agg(F.count(F.lit(1)), F.sum("label")).first()
    total, toxic = totals[0], totals[1] or 0
    if not toxic or toxic == total:
        return {}, math.log((toxic + 0.5) / (total - toxic + 0.5))
    by = rows.select("label", F.explode("features").alias("f")).groupBy("f").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("k")).where(F.col("n") >= LEAST_ROWS)
    p, q = (F.col("k") + 0.5) / (toxic + 1.0), (F.col("n") - F.col("k") + 0.5) / (total - toxic + 1.0)
    # the features that tell most: log-odds, weighed by the rows that have them
    gain = F.col("k") * F.log(p / q) + (F.col("n") - F.col("k")) * F.log(q / p)
    chosen = by.where(p > 2 * q).orderBy(F.desc(gain), "f").limit(FEATURES)
    vocabulary = [r["f"] for r in chosen.select("f").collect()]  # FEATURES at most
    if not vocabulary:
        return {}, math.log((toxic + 0.5) / (total - toxic + 0.5))
    vectors = CountVectorizerModel.from_vocabulary(sorted(vocabulary), "features", "x")
    vectors.setBinary(True)
    learner = LogisticRegression(featuresCol="x", labelCol="label", regParam=0.0005, maxIter=60, standardization=False)
    fitted = learner.fit(written(vectors.transform(rows).select(F.col("label").cast("double").alias("label"), "x"), "toxic-vectors"))
    weights = fitted.coefficients.toArray()
    return dict(zip(sorted(vocabulary), map(float, weights), strict=True)), float(fitted.intercept)


def score(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """For each document: doc_id, place, held_out, score, restored_words (the
    telling words and prefixes found).

    held_out: crc32 of the id as text leaves 1 by 3; such rows are never learnt
    from.  Null ids have no label, and are not held out.  Null and empty texts
    have no words, so their score is the model's base rate.  Where an id stands
    in several rows or labels, each labelled row counts; null labels don't.
    """
    out = lambda c: F.coalesce(F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))
    bounded_batches(docs.sparkSession)
    index = alphabet(docs, text)
    model = language_model(trigram_counts(docs, index, text), index)
    marks = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~out(F.col("doc_id"))).select(
        F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("label"))
    # FIT_ROWS labels, drawn by a hash of the id, bound what is fitted
    share = min(1.0, FIT_ROWS / max(marks.count(), 1))
    marks = marks.where(F.pmod(F.xxhash64("id", F.lit(17)), F.lit(10**6)) < int(share * 10**6))
    weights, base = fit(docs.select(F.col("doc_id").alias("id"), F.col(text).alias("text")).join(marks, "id"), model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore, known = Restorer(model), {f.partition("*")[0] for f in weights}
        for batch in batches:
            found = [sorted(f for f in features(restore.words(x), known) if f in weights) for x in batch.column(1).to_pylist()]
            scores = [1 / (1 + math.exp(-max(-30.0, min(30.0, base + sum(weights[f] for f in x))))) for x in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array(scores, pa.float64()),
                                              pa.array(found, pa.list_(pa.string()))],
                                             names=["doc_id", *PLACE, "score", "restored_words"])

    rows = placed(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id long, {PLACE[0]} long, {PLACE[1]} long, score double, restored_words array<string>").select(
        "doc_id", *PLACE, out(F.col("doc_id")).alias("held_out"), "score", "restored_words")
