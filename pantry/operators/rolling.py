"""Rolling ranges, evaluated at every step up to now.

Rows are counted by pane (one step) and series.  A pane enters the range of the
evaluation at its end and leaves it a range later, so the counts of a range change at
those two times only: prefix sums over the changes give every evaluation, as
stretches of equal value.  Stretches go on to ``now``, so an outage after the last row
shows.  What one task holds follows from the time covered, not from the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rolling_counts(log: DataFrame, now: DataFrame, counts: dict[str, Column], range_s: int, step_s: int = 60,
                   series: list[str] | None = None, ts: str = "ts") -> DataFrame:
    """series, at_start, at_end (first and last evaluation of a stretch), and for each
    of ``counts`` (a condition) the rows of the ``range_s`` seconds before.

    Evaluations take place at whole steps from the end of a series' first pane up to
    ``now`` (one row: now); rows later than it are left out.  Stretches of one series
    follow each other without a gap; neighbours differ in some count.
    """
    if range_s % step_s:
        raise ValueError("a range must be whole steps")
    series, names = series or [], list(counts)
    end = F.floor(F.unix_timestamp(F.col("now").cast("timestamp")) / step_s).cast("long")
    last = now.select(end.alias("_now"))  # one row
    pane = F.floor(F.unix_timestamp(F.col(ts).cast("timestamp")) / step_s).cast("long") + 1
    panes = log.where(F.col(ts).isNotNull()).groupBy(*series, pane.alias("_at")).agg(
        *[F.count(F.when(c, 1)).alias(n) for n, c in counts.items()])
    changes = panes.select(*series, F.explode(F.array(
        F.struct("_at", *names), F.struct((F.col("_at") + range_s // step_s).alias("_at"), *[(-F.col(n)).alias(n) for n in names]))).alias("c"))
    changes = changes.groupBy(*series, F.col("c._at").alias("_at")).agg(*[F.sum(f"c.{n}").alias(n) for n in names])
    changes = changes.crossJoin(last).where(F.col("_at") <= F.col("_now"))
    by = Window.partitionBy(*series).orderBy("_at")
    told = changes.withColumns({n: F.sum(n).over(by) for n in names})
    before = F.struct(*[F.lag(n).over(by).alias(n) for n in names])
    told = told.withColumn("_same", before.eqNullSafe(F.struct(*names))).where(~F.col("_same"))
    until = F.coalesce(F.lead("_at").over(by) - 1, F.col("_now"))
    return told.select(*series, F.timestamp_seconds(F.col("_at") * step_s).alias("at_start"),
                       F.timestamp_seconds(until * step_s).alias("at_end"), *names)


def at_steps(stretches: DataFrame, step_s: int = 60) -> DataFrame:
    """One row for each evaluation (``at``) of stretches."""
    at = F.explode(F.sequence("at_start", "at_end", F.make_dt_interval(secs=F.lit(step_s)))).alias("at")
    return stretches.select(at, *[c for c in stretches.columns if c not in ("at_start", "at_end")])


def firing_for(stretches: DataFrame, firing: Column, for_s: int, series: list[str] | None = None, step_s: int = 60) -> DataFrame:
    """series, pending_at, last_at, fired: runs of evaluations that meet ``firing``; one
    fires once it has held for ``for_s`` seconds."""
    series = series or []
    hit = stretches.where(firing)
    by = Window.partitionBy(*series).orderBy("at_start")
    new = F.coalesce(F.unix_timestamp("at_start") - F.unix_timestamp(F.lag("at_end").over(by)) > step_s, F.lit(True))
    runs = hit.withColumn("_new", new.cast("int")).withColumn("_run", F.sum("_new").over(by))
    runs = runs.groupBy(*series, "_run").agg(F.min("at_start").alias("pending_at"), F.max("at_end").alias("last_at"))
    held = F.unix_timestamp("last_at") - F.unix_timestamp("pending_at")
    return runs.select(*series, "pending_at", "last_at", (held >= for_s).alias("fired"))


def ages(lasts: DataFrame, now: DataFrame, thresholds: dict[str, int]) -> DataFrame:
    """series, last_ts, age_s, threshold_s, stale for columns of the one-row ``lasts``;
    a series without any time is stale."""
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("series"), F.col(n).cast("timestamp").alias("last_ts"), F.lit(s).cast("long").alias("threshold_s"))
                               for n, s in thresholds.items()])).alias("x")
    rows = lasts.select(each).select("x.*").crossJoin(now.select(F.col("now").cast("timestamp").alias("now")))  # one row each
    age = F.unix_timestamp("now") - F.unix_timestamp("last_ts")
    return rows.select("series", "last_ts", age.alias("age_s"), "threshold_s", F.coalesce(age > F.col("threshold_s"), F.lit(True)).alias("stale"))
