"""Service-health monitoring over the request log (batch form).

Each alert rule of the reference (PromQL over rolling ranges) becomes an
event-time window aggregation.  The same functions run on a streaming
DataFrame (see ``pantry.streaming.monitor``) after ``withWatermark``.

Windows are epoch-aligned tumbling windows: ``window(ts, '5 minutes')``.
Grouping is by (window[, series]); a hot window is pre-aggregated per task by
partial aggregation.  Exact percentiles are selected between bounds from a sketch
(``quantiles``), so no task holds a group's values; ``histogram_quantile`` is the
bounded, streaming-safe estimate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from .quantiles import exact_quantiles

# FIXED VALUES: histogram buckets of the serving metrics.
SCORE_BUCKETS = [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]
BATCH_SIZE_BUCKETS = [1, 5, 10, 20, 50, 100, 200]
# Default latency buckets of the HTTP instrumentation (seconds).
LATENCY_BUCKETS = [0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0]


def _win(ts: str, width: str) -> Column:
    return F.window(F.col(ts), width)


def _ws(width: str) -> list[Column]:
    return [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]


def error_rate(log: DataFrame, width: str = "5 minutes", threshold: float = 0.05,
               ts: str = "ts") -> DataFrame:
    """5xx share per window; firing when > threshold."""
    g = log.groupBy(_win(ts, width)).agg(F.count(F.lit(1)).alias("n"),
                                        F.count(F.when(F.col("status") >= 500, 1)).alias("errors"))
    rate = F.col("errors") / F.col("n")
    return g.select(*_ws(width), "n", "errors", rate.alias("error_rate"), (rate > threshold).alias("firing"))


def windowed_quantile(log: DataFrame, col: str, q: float, width: str, ts: str = "ts") -> DataFrame:
    """Exact (linear interpolation) q-quantile of ``col`` per window."""
    w = exact_quantiles(_in_window(log, ts, width), ["window"], col, [q], [F.count(F.lit(1)).alias("n")])
    return w.select(*_ws(width), "n", F.col("quantiles")[0].alias("value"))


def _in_window(log: DataFrame, ts: str, width: str) -> DataFrame:
    """Rows with their window; those without a time have none, as in a grouped window."""
    return log.withColumn("window", _win(ts, width))


def p95_latency(log: DataFrame, width: str = "5 minutes", threshold: float = 0.5) -> DataFrame:
    w = windowed_quantile(log, "latency_s", 0.95, width)
    return w.withColumnRenamed("value", "p95_latency_s").withColumn("firing", F.col("p95_latency_s") > threshold)


def median_score(log: DataFrame, width: str = "10 minutes", threshold: float = 0.2) -> DataFrame:
    w = windowed_quantile(log, "score", 0.5, width)
    return w.withColumnRenamed("value", "median_score").withColumn("firing", F.col("median_score") < threshold)


def bucket_counts(df: DataFrame, col: str, bounds: list[float], keys: list[Column | str]) -> DataFrame:
    """Cumulative ``le`` bucket counts (+Inf) per group: one pass of count_if."""
    aggs = [F.count(F.when(F.col(col) <= F.lit(float(b)), 1)).alias(f"le_{i}") for i, b in enumerate(bounds)]
    return df.groupBy(*keys).agg(*aggs, F.count(F.col(col)).alias("le_inf"))


def histogram_quantile(q: float, bounds: list[float], prefix: str = "le_") -> Column:
    """Prometheus histogram_quantile over cumulative bucket columns le_0..le_k, le_inf:
    rank = q * total; linear interpolation inside the first bucket whose
    cumulative count reaches the rank (lower edge 0 for the first bucket);
    a rank in the +Inf bucket returns the last finite bound."""
    total = F.col(f"{prefix}inf").cast("double")
    rank = F.lit(q) * total
    expr = None
    for i, hi_b in enumerate(bounds):
        lo_b = 0.0 if i == 0 else float(bounds[i - 1])
        lo_c = F.lit(0.0) if i == 0 else F.col(f"{prefix}{i - 1}").cast("double")
        hi_c = F.col(f"{prefix}{i}").cast("double")
        val = F.lit(lo_b) + F.lit(float(hi_b) - lo_b) * (rank - lo_c) / F.nullif(hi_c - lo_c, F.lit(0.0))
        val = F.coalesce(val, F.lit(float(hi_b)))
        expr = F.when(hi_c >= rank, val) if expr is None else expr.when(hi_c >= rank, val)
    return F.when(total > 0, expr.otherwise(F.lit(float(bounds[-1]))))


def score_histogram(log: DataFrame, width: str = "1 hour", ts: str = "ts") -> DataFrame:
    """Cumulative score buckets per window (the reference's score histogram)."""
    b = bucket_counts(log, "score", SCORE_BUCKETS, [_win(ts, width)])
    return b.select(*_ws(width), *[c for c in b.columns if c.startswith("le_")])


def batch_size_histogram(log: DataFrame, request: list[str], width: str = "1 day", ts: str = "ts") -> DataFrame:
    """Cumulative buckets of the number of instances per request: rows of one
    ``request`` (its key columns) and window are one batch."""
    sizes = log.groupBy(_win(ts, width), *request).agg(F.count(F.lit(1)).alias("n_instances"))
    b = bucket_counts(sizes, "n_instances", BATCH_SIZE_BUCKETS, ["window"])
    return b.select(*_ws(width), *[c for c in b.columns if c.startswith("le_")])


def throughput(log: DataFrame, width_s: int = 600, series: str = "model_version",
               ts: str = "ts", now: DataFrame | None = None) -> DataFrame:
    """Predictions per second per (window, series), including zero-traffic
    windows from a time spine (one row per window from the first event to ``now``, a
    one-row table, or without it to the last event); ``zero_traffic`` marks the alert
    condition."""
    width = f"{width_s} seconds"
    counts = log.groupBy(_win(ts, width), series).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select(F.col("window.start").cast("timestamp").alias("window_start"), series, "n")
    bounds = log.agg(F.min(F.col(ts).cast("timestamp")).alias("_a"), F.max(F.col(ts).cast("timestamp")).alias("_b"))  # one row
    if now is not None:
        bounds = bounds.crossJoin(now.select(F.col("now").cast("timestamp").alias("_now"))).select("_a", F.greatest("_b", "_now").alias("_b"))
    spine = bounds.select(F.explode(F.sequence(
        F.timestamp_seconds(F.floor(F.unix_timestamp("_a") / width_s) * width_s),
        F.timestamp_seconds(F.floor(F.unix_timestamp("_b") / width_s) * width_s),
        F.make_dt_interval(secs=F.lit(width_s)))).alias("window_start"))
    names = log.select(series).distinct()  # bounded: number of model versions
    grid = spine.crossJoin(names)
    j = grid.join(counts, ["window_start", series], "left").fillna(0, subset=["n"])
    return j.select("window_start", series, "n", (F.col("n") / F.lit(float(width_s))).alias("rate_per_s"),
                    (F.col("n") == 0).alias("zero_traffic"))


def staleness(log: DataFrame, series: str, now: DataFrame, threshold_s: int, ts: str = "ts") -> DataFrame:
    """Age of the newest event per series against a reference time (one-row ``now``)."""
    last = log.groupBy(series).agg(F.max(ts).alias("last_ts"))
    j = last.crossJoin(now.select(F.col("now")))
    age = F.unix_timestamp("now") - F.unix_timestamp("last_ts")
    return j.select(series, "last_ts", age.alias("age_s"), (age > threshold_s).alias("stale"))


def failures_in_last(log: DataFrame, now: DataFrame, seconds: int = 3600, ts: str = "ts") -> DataFrame:
    """Failures (status >= 500) in the last ``seconds`` before now; alert when > 0."""
    # one subquery alone: two would be merged into a struct, which no scan takes
    start = X.scalar_of(now, F.col("now") - F.make_dt_interval(secs=F.lit(seconds)), log, ts)
    recent = log.filter(F.col(ts) > start).crossJoin(now.select("now")).filter(F.col(ts) <= F.col("now"))  # one row
    r = recent.agg(F.count(F.when(F.col("status") >= 500, 1)).alias("failures"))
    return r.withColumn("firing", F.col("failures") > 0)


def sustained(firing: DataFrame, width_s: int, for_s: int, series: list[str] | None = None) -> DataFrame:
    """Gaps-and-islands over firing windows: consecutive firing windows form an
    island; the alert fires for islands lasting at least ``for`` past the first
    evaluation ((n - 1) * width >= for).  Input: window_start, firing[, series]."""
    series = series or []
    f = firing.filter(F.col("firing")).withColumn(
        "_idx", (F.unix_timestamp("window_start") / width_s).cast("bigint"))
    # window over firing windows only, per series (bounded by the number of windows)
    w = Window.partitionBy(*series).orderBy("_idx") if series else Window.partitionBy(F.lit(1)).orderBy("_idx")
    f = f.withColumn("_island", F.col("_idx") - F.row_number().over(w))
    isl = f.groupBy(*series, "_island").agg(F.min("window_start").alias("island_start"),
                                           F.max("window_start").alias("island_last"),
                                           F.count(F.lit(1)).alias("n_windows"))
    return isl.select(*series, "island_start", "island_last", "n_windows",
                      ((F.col("n_windows") - 1) * width_s >= for_s).alias("fired"))


def score_quantiles(log: DataFrame, width: str = "10 minutes", qs=(0.1, 0.5, 0.9), ts: str = "ts") -> DataFrame:
    g = exact_quantiles(_in_window(log, ts, width), ["window"], "score", list(qs))
    return g.select(*_ws(width), *[F.col("quantiles")[i].alias(f"p{int(q * 100)}") for i, q in enumerate(qs)])


def latency_percentiles(log: DataFrame, group: str = "model_version", ts: str = "ts") -> DataFrame:
    """Per group: requests, throughput (per second of observed span), p50/p95/p99,
    mean/min/max latency in ms (2 dp) and error count / rate (%)."""
    ms = F.col("latency_s") * 1000.0
    g = exact_quantiles(log, [group], ms, [0.5, 0.95, 0.99], [
        F.count(F.lit(1)).alias("num_requests"),
        (F.unix_timestamp(F.max(ts)) - F.unix_timestamp(F.min(ts))).alias("_span"),
        F.avg(ms).alias("_mean"), F.min(ms).alias("_min"), F.max(ms).alias("_max"),
        F.count(F.when(F.col("status") >= 500, 1)).alias("error_count")])
    return g.select(
        group, "num_requests",
        X.rnd(F.col("num_requests") / F.nullif(F.col("_span").cast("double"), F.lit(0.0)), 2).alias("throughput_rps"),
        X.rnd(F.col("quantiles")[0], 2).alias("p50_ms"), X.rnd(F.col("quantiles")[1], 2).alias("p95_ms"),
        X.rnd(F.col("quantiles")[2], 2).alias("p99_ms"), X.rnd("_mean", 2).alias("mean_ms"),
        X.rnd("_min", 2).alias("min_ms"), X.rnd("_max", 2).alias("max_ms"), "error_count",
        X.rnd(F.col("error_count") / F.col("num_requests") * 100, 2).alias("error_rate"))


def served_impressions(predictions: DataFrame, ts: str = "ts") -> DataFrame:
    """Rank-1 predictions become interactions with a NULL rating and action 'served'."""
    return predictions.filter(F.col("rank_pos") == 1).select(
        "user_id", "recipe_id", F.lit(None).cast("int").alias("rating"), F.lit("served").alias("action"),
        F.col(ts).alias("created_at"))


def feedback_attribution(feedback: DataFrame, served: DataFrame, max_delay_s: int = 3600) -> DataFrame:
    """feedback LEFT JOIN its served recommendation on (request_id, recipe_id)
    with an event-time bound (served_ts <= feedback_ts <= served_ts + delay);
    the same condition works as a stream-stream join with watermarks."""
    s = served.select(F.col("request_id").alias("_rq"), F.col("recipe_id").alias("_rc"),
                      F.col("ts").alias("served_ts"), "model_version", F.col("score").alias("served_score"))
    cond = ((F.col("request_id") == F.col("_rq")) & (F.col("recipe_id") == F.col("_rc"))
            & (F.col("feedback_ts") >= F.col("served_ts"))
            & (F.col("feedback_ts") <= F.col("served_ts") + F.make_dt_interval(secs=F.lit(max_delay_s))))
    return feedback.join(s, cond, "left").drop("_rq", "_rc")
