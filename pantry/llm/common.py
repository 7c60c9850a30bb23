"""Helpers that the operators share."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: A row's place in its table: 64-bit hash of the file's path, row number in the
#: file.  It tells repeated rows and null ids apart and stays the same when a
#: lost executor's task runs again.
PLACE = ("__llm_file", "__llm_row")


def bounded_batches(spark: SparkSession) -> None:
    """Batches to and from Python of 2000 rows or 8 MB, so that a worker's memory
    doesn't follow the texts' lengths."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read again."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scanned(df: DataFrame) -> DataFrame:
    """``df`` if it is a scan whose rows know their file and row number; else
    ``df`` written to the shared folder, which also fixes its rows for retries."""
    try:
        df.select(df.metadataColumn("_metadata")["row_index"])
        return df
    except AnalysisException:
        return written(df, "input")


def placed(df: DataFrame, *cols: Column | str) -> DataFrame:
    """``cols`` of ``df`` and the place of each row."""
    bounded_batches(df.sparkSession)
    df = scanned(df)
    meta = df.metadataColumn("_metadata")
    return df.select(*cols, F.xxhash64(meta["file_path"]).alias(PLACE[0]), meta["row_index"].alias(PLACE[1]))


def utf8_bytes(col: Column) -> Column:
    """Length in UTF-8 bytes; null: 0."""
    return F.coalesce(F.octet_length(col), F.lit(0)).cast("long")


def crc32_text(col: Column) -> Column:
    return F.crc32(F.coalesce(col, F.lit("")).cast("binary"))


#: Bitmaps hold 16 bits a key, 128 kB at least and 32 MB at most.
BITMAP_LOGS = (20, 28)


def bitmap(keys: DataFrame, n: int) -> np.ndarray:
    """One bit for each 64-bit hash of the only column, sized by their number ``n``.
    Beyond 2^24 keys more and more others are held by chance; whoever asks must
    allow for them."""
    log = min(max((16 * n).bit_length(), BITMAP_LOGS[0]), BITMAP_LOGS[1])
    b = F.shiftrightunsigned(F.col(keys.columns[0]), 64 - log)
    rows = keys.select(F.floor(b / 32768).cast("int").alias("n"), F.pmod(b, F.lit(32768)).alias("b")).select(
        "n", F.expr("bitmap_bit_position(b + 1)").alias("b")).groupBy("n").agg(F.expr("bitmap_construct_agg(b)").alias("bits")).collect()
    out = np.zeros((1 << log) // 8, np.uint8)
    for r in rows:
        out[r["n"] * 4096:(r["n"] + 1) * 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def probed(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether each 64-bit hash may be among the bitmap's keys."""
    h = (keys.view(np.uint64) >> np.uint64(64 - (8 * len(bits)).bit_length() + 1)).astype(np.int64)
    return (bits[h >> 3] >> (h & 7).astype(np.uint8)) & 1 == 1
