"""Two-pass external shuffle.

Pass one scatters the rows uniformly into memory-sized buckets by a seeded hash
of each row's place.  Pass two permutes each bucket with Fisher-Yates (Spark's
``shuffle``) and writes it.  The buckets in order, each permuted, are one random
order of the whole table; shard ``s`` of ``k`` is its ``s``-th stretch, so the
row counts of shards differ by one at most (law ``rows``).
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import scanned, shared_path

#: Bytes that a row holds besides its text, for sizing buckets.
ROW_BYTES = 64


def memory_bucket_bytes(spark: SparkSession) -> int:
    """A 128th of an executor's heap, 256 MB at most: a task holds its bucket some eight
    times over (collected, handed on as bytes, collected, sorted, permuted, as a row and
    in the writer), and several tasks run at once."""
    said = spark.sparkContext.getConf().get("spark.executor.memory", "1g")
    m = re.fullmatch(r"(\d+)([kmgt]?)b?", said.strip().lower())
    heap = int(m[1]) * {"k": 2**10, "": 2**20, "m": 2**20, "g": 2**30, "t": 2**40}[m[2]] if m else 2**30
    return min(max(heap // 128, 2**20), 2**28)


def bucket_offsets(counts: DataFrame, chunk: int = 1024) -> DataFrame:
    """Rows before each bucket: prefix sums inside chunks of buckets, then over
    the chunks, so that no task sees all buckets."""
    c = counts.withColumn("chunk", F.floor(F.col("bucket") / chunk))
    inside = F.sum("count").over(W.partitionBy("chunk").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))
    before = F.sum("n").over(W.orderBy("chunk").rowsBetween(W.unboundedPreceding, -1))
    chunks = c.groupBy("chunk").agg(F.sum("count").alias("n")).select("chunk", F.coalesce(before, F.lit(0)).alias("before"))
    return c.withColumn("inside", F.coalesce(inside, F.lit(0))).join(chunks, "chunk").select(
        "bucket", (F.col("inside") + F.col("before")).alias("offset"))


def shuffle_shards(docs: DataFrame, n_shards: int, seed: int = 0, bucket_bytes: int | None = None,
                   path: str | None = None, text: str = "text") -> DataFrame:
    """Write ``docs`` in a random order as ``n_shards`` shards and read it again.

    Returns ``record`` (the whole input row as a struct, so no column can
    clash), ``slot`` (long, gapless from 0 in its shard) and ``shard`` (int).
    Null ids, null or empty texts, repeated rows and ties are rows like any
    other: the hash is over a row's place, not its content.  An empty table
    gives no rows.  A text must fit in memory, a bucket of texts must too.
    """
    spark = docs.sparkSession
    path = path or shared_path(spark, "shards")
    docs = scanned(docs)
    meta = docs.metadataColumn("_metadata")
    name, index = meta["file_name"], meta["row_index"]
    n, size = docs.agg(F.count(F.lit(1)), F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES)).first()
    schema = T.StructType([T.StructField("record", docs.schema), T.StructField("slot", T.LongType()),
                           T.StructField("shard", T.IntegerType())])
    if not n:
        return spark.createDataFrame([], schema)
    n_buckets = max(1, math.ceil(size / (bucket_bytes or memory_bucket_bytes(spark))))
    bucket = F.pmod(F.xxhash64(F.lit(seed), name, index), F.lit(n_buckets)).cast("int")
    offsets = bucket_offsets(docs.select(bucket.alias("bucket")).groupBy("bucket").count())
    scattered = docs.select(bucket.alias("bucket"), F.struct(
        F.xxhash64(F.lit(seed + 1), name, index).alias("h"), index.alias("i"), name.alias("f"),
        F.struct("*").alias("record")).alias("row")).repartitionById(n_buckets, F.col("bucket"))
    permuted = scattered.groupBy("bucket").agg(F.shuffle(F.sort_array(F.collect_list("row")), F.lit(seed)).alias("rows"))
    # one offset of 16 bytes a bucket; a bucket is a shuffle partition, so there are never more than the driver can track
    placed = permuted.join(F.broadcast(offsets), "bucket").select("offset", F.posexplode("rows").alias("pos", "row"))
    shard = F.expr(f"cast((offset + pos) * {n_shards} div {n} as int)")
    out = placed.select("row.record", (F.col("offset") + F.col("pos")).alias("at"), shard.alias("shard")).select(
        "record", (F.col("at") - F.expr(f"(cast(shard as bigint) * {n} + {n_shards - 1}) div {n_shards}")).alias("slot"), "shard")
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return spark.read.schema(schema).parquet(path)
