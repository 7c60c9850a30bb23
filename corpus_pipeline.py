"""The corpus pipeline: toxicity, near duplicates, repeated passages, benchmark
decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept.
All but the last return the columns of documents.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pantry.llm import decontamination, near_duplicates, packing, suffix_dedup, toxicity  # noqa: E402
from pantry.llm.common import PLACE, placed, scanned, table, written  # noqa: E402

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOXIC = 0.7
#: What Spark puts for bytes that are no UTF-8, and a stand-in for the same sign in a text.
MARK, ESCAPED = "\N{REPLACEMENT CHARACTER}", "\x00\x01R\x01\x00"


def documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below TOXIC stay; null and empty texts too."""
    docs = scanned(docs)
    scored = toxicity.score(docs, table(spark, sf_dir, "labels"))
    return documents(keep(docs, scored.where(F.col("score") >= TOXIC)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component (five-word shingles, Jaccard 0.8 or more) the row with the
    smallest doc_id stays (null last; of equal ids the first in the table).  Texts
    without words are no one's copies and stay."""
    docs = scanned(docs)
    found = near_duplicates.near_duplicates(docs, k=5, percent=80)
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), *PLACE)
    # null ids may make a component without a name; it is then told by its class
    group = F.struct("component_id", F.when(F.col("component_id").isNull(), F.col("class")).alias("class"))
    found = written(found.where("n_shingles > 0").select(*PLACE, group.alias("group"), rank.alias("rank")), "near-duplicates")
    first = found.groupBy("group").agg(F.min("rank").alias("first"))
    return documents(keep(docs, found.join(first, "group").where("rank <> first")))


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of 200-byte strings that occur twice or more.  A cut
    inside a character takes the rest of it; n_chars counts what is left.  A text
    of which nothing is left goes; one that was empty before stays."""
    cut = suffix_dedup.without_repeats(documents(docs))
    # bytes of a character that was cut are no valid UTF-8, and marks of its own that a text may hold stay
    whole = F.regexp_replace(F.make_valid_utf8(F.replace(F.col("kept").cast("string"), F.lit(MARK), F.lit(ESCAPED))), MARK, "")
    text = F.when(F.size("spans") > 0, F.replace(whole, F.lit(ESCAPED), F.lit(MARK))).otherwise(F.col("row.text"))
    cut = cut.select("row", "spans", text.alias("text")).where("size(spans) = 0 or text <> ''")
    n_chars = F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("row.n_chars"))
    return cut.select("row.doc_id", "text", "row.lang", "row.source", n_chars.alias("n_chars"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a span of ten words of the benchmark stay."""
    docs = scanned(docs)
    found = decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return documents(keep(docs, found.where("n_hit > 0")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, with the crc32 of their ids in their place."""
    return packing.pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def keep(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose place isn't in ``gone``.  ``gone`` must stem from the same table."""
    return placed(docs, F.struct("*").alias("row")).join(gone.select(*PLACE), list(PLACE), "left_anti").select("row.*")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_dedup", drop_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: SQL can't express the stages; their operators are tested against brute force, one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
