"""Manifests of raw text files: a digest for each block of each file."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have the package on their path


def raw_blocks(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, block (first byte), lines, sha256 (of the block's lines, each with its
    line end) of every block that a scan of ``path`` has; a file is read by as many
    tasks as it has blocks.  Compare manifests made with one
    spark.sql.files.maxPartitionBytes."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n, sha = None, 0, hashlib.sha256()
        names = ["file", "block", "lines", "sha256"]
        for batch in batches:
            for file, block, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != (file, block):
                    if key:
                        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, n, sha.hexdigest())], names=names)
                    key, n, sha = (file, block), 0, hashlib.sha256()
                sha.update(line + b"\n")
                n += 1
        if key:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, n, sha.hexdigest())], names=names)

    lines = spark.read.option("lineSep", "\n").text(path)
    meta = lines.metadataColumn("_metadata")
    return lines.select(meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), F.col("value").cast("binary").alias("value")).mapInArrow(
        digest, "file string, block long, lines long, sha256 string")


def raw_manifest(blocks: DataFrame) -> DataFrame:
    """file, lines, sha256 (of the blocks' digests in order) from ``raw_blocks``."""
    return blocks.groupBy("file").agg(F.sum("lines").alias("lines"), F.sort_array(F.collect_list(F.struct("block", "sha256"))).alias("b")).select(
        "file", "lines", F.sha2(F.array_join("b.sha256", ":"), 256).alias("sha256"))


def changed_blocks(recorded: DataFrame, found: DataFrame) -> DataFrame:
    """file, block of blocks that differ or are on one side alone."""
    a, b = (x.select("file", "block", F.struct("lines", "sha256").alias(n)) for x, n in ((recorded, "a"), (found, "b")))
    return a.join(b, ["file", "block"], "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select("file", "block")
