"""Exact quantiles of large groups without a group's values in one task.

A mergeable sketch brackets each wanted rank; a second pass counts what lies below
the bracket and, value by value, what lies in it.  Only the bracket's values (some
ten-thousandths of a group's rows, or all of a group of ACCURACY rows at most) are put
in order.  The sketch decides what is
read, never the result: a rank outside its bracket is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: 1 / rank error of the sketch.
ACCURACY = 10_000
#: Half of a bracket's width, in rank errors.
MARGIN = 4


def exact_quantiles(df: DataFrame, groups: list[str], value: Column | str, qs: list[float], more: list[Column] = (),
                    accuracy: int = ACCURACY) -> DataFrame:
    """Per group (named columns): ``more`` aggregates and ``quantiles``, an array of
    the exact, linearly interpolated quantiles ``qs`` of the values that aren't NULL
    (NULL: none).  NULL in a grouping column is a group.  Two scans of ``df``, two
    shuffles of partial sums; no group's rows or distinct values meet in one task."""
    value = F.col(value) if isinstance(value, str) else value
    rows = df.withColumn("_v", value.cast("double"))
    width = MARGIN / accuracy
    probes = [p for q in qs for p in (max(0.0, q - width), min(1.0, q + width))]
    stats = rows.groupBy(*groups).agg(
        *more, F.count("_v").alias("_q_n"), F.min("_v").alias("_q_min"), F.max("_v").alias("_q_max"),
        F.percentile_approx("_v", probes, accuracy).alias("_q_probes"))
    small = F.col("_q_n") <= accuracy  # a bracket is wider than the next row only in larger groups
    brackets = F.array(*[F.struct(
        F.lit(i).alias("i"), F.lit(q).alias("q"),
        F.when(small | F.lit(q <= width), F.col("_q_min")).otherwise(F.col("_q_probes")[2 * i]).alias("lo"),
        F.when(small | F.lit(q >= 1 - width), F.col("_q_max")).otherwise(F.col("_q_probes")[2 * i + 1]).alias("hi")) for i, q in enumerate(qs)])
    known = stats.select(*[F.col(n).alias(f"_k{i}") for i, n in enumerate(groups)], "_q_n", brackets.alias("_b"))
    same = F.lit(True)
    for i, n in enumerate(groups):
        same = same & F.col(n).eqNullSafe(F.col(f"_k{i}"))
    seen = rows.where(F.col("_v").isNotNull()).select(*groups, "_v")
    seen = seen.join(known, same) if groups else seen.crossJoin(known)  # without groups: one row
    low = seen.select(*groups, "_q_n", "_v", F.explode(F.filter("_b", lambda b: F.col("_v") <= b["hi"])).alias("b"))
    counts = low.groupBy(*groups, "_q_n", F.col("b.i").alias("i"), F.col("b.q").alias("q"),
                         F.when(F.col("_v") >= F.col("b.lo"), F.col("_v")).alias("value")).agg(F.count(F.lit(1)).alias("c"))
    upto = F.sum("c").over(Window.partitionBy(*groups, "i").orderBy(F.asc_nulls_first("value")))  # the bracket's values
    place = F.col("q") * (F.col("_q_n") - 1)
    at = lambda rank: F.max(F.when((F.col("_upto") - F.col("c") <= rank) & (rank < F.col("_upto")), F.col("value")))
    found = counts.withColumn("_upto", upto).withColumn("_at", place).groupBy(*groups, "i").agg(
        at(F.floor("_at")).alias("lower"), at(F.ceil("_at")).alias("upper"), F.first("_at").alias("at"))
    between = (F.ceil("at") - F.col("at")) * F.col("lower") + (F.col("at") - F.floor("at")) * F.col("upper")
    exact = F.when(F.col("lower").isNull() | F.col("upper").isNull(), F.raise_error(F.lit("a rank lies outside its bracket")).cast("double")).when(
        F.col("lower") == F.col("upper"), F.col("lower")).otherwise(between)
    found = found.groupBy(*groups).agg(F.transform(F.sort_array(F.collect_list(F.struct("i", exact.alias("x")))), lambda s: s["x"]).alias("quantiles"))
    back = found.where(F.size("quantiles") > 0).select(*[F.col(n).alias(f"_k{i}") for i, n in enumerate(groups)], "quantiles")
    out = stats.join(back, same, "left")  # without groups: one row with one row
    return out.drop("_q_n", "_q_min", "_q_max", "_q_probes", *[f"_k{i}" for i in range(len(groups))])
