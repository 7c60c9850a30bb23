"""Fingerprints of datasets as trees: rows, buckets of keys, splits, version.

A row's text is unambiguous: NULL and the border of two values have signs of their
own, which are escaped inside texts, and doubles are written in full.  A bucket's digest is the
sum of its rows' digests, so neither files nor order matter, and one pass with
partial sums makes all buckets.  Two manifests that differ tell the buckets that
differ, and only those need be read to find the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

N_BUCKETS = 64


#: Signs with a meaning in a row's text, and what stands for them in a value.
ESCAPED = (("\\", "\\\\"), ("|", "\\p"), ("~", "\\t"))


def value_text(c: str, kind: str, oracle: bool = False) -> str:
    """SQL text of a column's value; NULL: ~.  A double's text is the one that gives
    the same double when read again, so no bit is lost."""
    name, text = (f'"{c}"', "VARCHAR") if oracle else (f"`{c}`", "STRING")
    if kind.startswith("timestamp"):
        told = f"strftime({name}, '%Y-%m-%d %H:%M:%S.%f')" if oracle else f"date_format({name}, 'yyyy-MM-dd HH:mm:ss.SSSSSS')"
    elif kind in ("double", "float", "int", "bigint", "boolean", "smallint", "tinyint", "date") or kind.startswith("decimal"):
        told = f"CAST({name} AS {text})"
    else:
        told = f"CASE WHEN {name} IS NOT NULL THEN to_json(struct({name})) END" if kind.startswith(("array", "map", "struct")) else f"CAST({name} AS {text})"
        for sign, code in ESCAPED:
            sign, code = (x if oracle else x.replace("\\", "\\\\") for x in (sign, code))  # Spark reads its literals' backslashes
            told = f"replace({told}, '{sign}', '{code}')"
    return f"coalesce({told}, '~')"


def row_text(cols: Sequence[tuple[str, str]], oracle: bool = False) -> str:
    return "concat_ws('|', " + ", ".join(value_text(c, t, oracle) for c, t in cols) + ")"


def bucket_of(df: DataFrame, keys: Sequence[str], n_buckets: int = N_BUCKETS) -> Column:
    """The bucket of a row: a hash of its keys' texts."""
    kinds = dict(df.dtypes)
    return F.expr(f"pmod(CAST(conv(substr(md5({row_text([(k, kinds[k]) for k in keys])}), 1, 8), 16, 10) AS BIGINT), {n_buckets})")


def row_digest(cols: Sequence[tuple[str, str]]) -> Column:
    """60 bits of a row's text."""
    return F.expr(f"CAST(conv(substr(md5({row_text(cols)}), 1, 15), 16, 10) AS BIGINT)")


#: Sums of digests are kept as three longs, each of so many bits of every digest, exact up to 2^43 rows.
PART_BITS = 20


def digest_sum(c: str) -> Column:
    """Exact sum of digests as text; no row adds to a wide decimal."""
    parts = [F.sum(F.shiftright(c, PART_BITS * i).bitwiseAND(F.lit((1 << PART_BITS) - 1))).cast("decimal(20,0)") for i in range(3)]
    unit = F.lit(1 << PART_BITS).cast("decimal(8,0)")
    return (((parts[2] * unit + parts[1]) * unit) + parts[0]).cast("decimal(38,0)").cast("string")


def _columns(df: DataFrame, leave_out: Sequence[str]) -> list[tuple[str, str]]:
    return sorted((c, t) for c, t in df.dtypes if c not in leave_out)


def bucket_digests(tagged: DataFrame, keys: Sequence[str], n_buckets: int = N_BUCKETS, split_col: str = "split",
                   date_col: str | None = None, label_col: str | None = None) -> DataFrame:
    """split, bucket, rows, digest (text) of all buckets with rows; with a date and a
    label also their bounds and sum.  Digests cover all columns but the split's."""
    more = [F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date")] if date_col else []
    more += [F.sum(F.col(label_col).cast("double")).alias("label_sum"), F.count(label_col).alias("n_labels")] if label_col else []
    read = [c for c in (date_col, label_col) if c]
    told = tagged.select(F.col(split_col).alias("split"), bucket_of(tagged, keys, n_buckets).alias("bucket"),
                         row_digest(_columns(tagged, [split_col])).alias("_digest"), *dict.fromkeys(read))
    return told.groupBy("split", "bucket").agg(F.count(F.lit(1)).alias("rows"), digest_sum("_digest").alias("digest"), *more)


def manifest_of(buckets: DataFrame, columns: Sequence[str]) -> DataFrame:
    """split, rows, content_hash, version from buckets; ``columns``: the names that the digests cover."""
    leaf = F.concat_ws(":", "bucket", "rows", "digest")
    more = {"min_date", "max_date", "label_sum", "n_labels"} <= set(buckets.columns)
    splits = buckets.groupBy("split").agg(
        F.sum("rows").alias("rows"), F.sort_array(F.collect_list(F.struct("bucket", leaf.alias("leaf")))).alias("_leaves"),  # n_buckets at most
        *([F.date_format(F.min("min_date"), "yyyy-MM-dd HH:mm:ss").alias("min_date"),
           F.date_format(F.max("max_date"), "yyyy-MM-dd HH:mm:ss").alias("max_date"),
           (F.sum("label_sum") / F.sum("n_labels")).alias("label_mean")] if more else []))
    head = ",".join(sorted(columns))
    splits = splits.withColumn("content_hash", F.sha2(F.concat_ws("|", F.lit(head), F.array_join("_leaves.leaf", "|")), 256)).drop("_leaves")
    every = splits.agg(F.sort_array(F.collect_list(F.struct("split", "content_hash"))).alias("_all"))  # the splits
    version = every.select(F.substring(F.sha2(F.array_join("_all.content_hash", ":"), 256), 1, 12).alias("version"))
    return splits.crossJoin(version)  # one row


def changed_buckets(recorded: DataFrame, found: DataFrame) -> DataFrame:
    """split, bucket, recorded_rows, found_rows of the buckets whose rows or digests differ."""
    a, b = (x.select("split", "bucket", F.struct("rows", "digest").alias(n)) for x, n in ((recorded, "a"), (found, "b")))
    return a.join(b, ["split", "bucket"], "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select(
        "split", "bucket", F.coalesce("a.rows", F.lit(0)).alias("recorded_rows"), F.coalesce("b.rows", F.lit(0)).alias("found_rows"))


def changed_rows(recorded: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of one side alone, with ``n`` (how many more) and ``side``.  Give it the rows
    of changed buckets."""
    digest = row_digest(_columns(recorded, []))
    mine = recorded.withColumn("side", F.lit(1)).unionByName(found.withColumn("side", F.lit(-1))).withColumn("_digest", digest)
    row = F.struct(*recorded.columns)
    net = mine.groupBy("_digest").agg(F.sum("side").alias("n"), F.any_value(row).alias("row")).where("n <> 0")
    return net.select("row.*", F.abs("n").alias("n"), F.when(F.col("n") > 0, "recorded").otherwise("found").alias("side"))
