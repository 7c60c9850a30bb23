"""Registered queries that run the Structured Streaming versions end to end
(Trigger.AvailableNow over day-sliced event files) and return the final sink
contents; where the result is deterministic the batch oracle applies."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import drift as D
from ..operators import monitor as M
from ..streaming import alerts as SA
from ..streaming import drift as SD
from ..streaming import monitor as SM
from ..sources.fixtures import Catalog
from .q_monitor import DRIFT_FEATURES, _sides
from .registry import REGISTRY, register, with_views


def _ts(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


@register("error_rate_5m_stream", sql=REGISTRY["error_rate_5m"].sql)
def q_error_rate_stream(spark, sf):
    log = SM.read_request_log_stream(spark, SM.stage_events_by_day(spark, sf))
    r = SM.run_to_table(spark, SM.error_rate_stream(log), "error-rate-stream")
    return (r.withColumn("window_start", _ts("window_start")).withColumn("window_end", _ts("window_end"))
            .withColumn("error_rate", X.round6("error_rate")))


def _hist_sql():
    b = "time_bucket(INTERVAL '300 seconds', ts, TIMESTAMP '1970-01-01 00:00:00')"
    cnt = ", ".join(f"count(*) FILTER (WHERE latency_s <= {x}) AS le_{i}" for i, x in enumerate(M.LATENCY_BUCKETS))
    return with_views("request_log") + f"""SELECT strftime({b}, '%Y-%m-%d %H:%M:%S') AS window_start, {cnt},
  count(latency_s) AS le_inf FROM request_log GROUP BY {b}"""


@register("latency_histogram_stream", sql=_hist_sql())
def q_latency_histogram_stream(spark, sf):
    log = SM.read_request_log_stream(spark, SM.stage_events_by_day(spark, sf))
    r = SM.run_to_table(spark, SM.latency_histogram_stream(log), "latency-hist-stream")
    return r.withColumn("window_start", _ts("window_start")).drop("window_end")


def _p95_hist_sql():
    b = "time_bucket(INTERVAL '300 seconds', ts, TIMESTAMP '1970-01-01 00:00:00')"
    bounds = M.LATENCY_BUCKETS
    cum = " UNION ALL ".join(
        f"SELECT ws, {i} AS i, {0.0 if i == 0 else float(bounds[i - 1])} AS lo_b, {float(x)} AS hi_b, "
        f"count(*) FILTER (WHERE latency_s <= {x}) AS hi_c, "
        f"{'0' if i == 0 else f'count(*) FILTER (WHERE latency_s <= {bounds[i - 1]})'} AS lo_c, count(latency_s) AS total "
        f"FROM (SELECT {b} AS ws, latency_s FROM request_log) r GROUP BY ws" for i, x in enumerate(bounds))
    return with_views("request_log", extra=[("cum", cum), ("hit", """
SELECT ws, arg_min(CASE WHEN hi_c = lo_c THEN hi_b
                        ELSE lo_b + (hi_b - lo_b) * (0.95 * total - lo_c) / (hi_c - lo_c) END, i) AS q
FROM cum WHERE hi_c >= 0.95 * total GROUP BY ws"""), ("tot", "SELECT DISTINCT ws, total FROM cum")]) + f"""
SELECT strftime(t.ws, '%Y-%m-%d %H:%M:%S') AS window_start,
  round(CASE WHEN t.total > 0 THEN coalesce(h.q, {float(bounds[-1])}) END, 6) AS p95_latency_s,
  CASE WHEN t.total > 0 THEN coalesce(h.q, {float(bounds[-1])}) END > 0.5 AS firing
FROM tot t LEFT JOIN hit h ON t.ws = h.ws"""


@register("p95_latency_histogram", sql=_p95_hist_sql())  # bounded-state estimate (histogram_quantile)
def q_p95_hist(spark, sf):
    log = Catalog(spark, sf).request_log
    b = M.bucket_counts(log, "latency_s", M.LATENCY_BUCKETS, [F.window("ts", "5 minutes")])
    q = M.histogram_quantile(0.95, M.LATENCY_BUCKETS)
    return b.select(_ts("window.start").alias("window_start"), X.round6(q).alias("p95_latency_s"),
                    (q > 0.5).alias("firing"))


@register("drift_stream")
def q_drift_stream(spark, sf):
    """The drift loop over the whole log, in order, with a check each hour; the
    baseline is the oldest 5000 rows of the first days (the reference's limit)."""
    base, _ = _sides(Catalog(spark, sf))
    values = SD.baseline_values(D.baseline_head(base, ["ts", "request_id"], 5000), DRIFT_FEATURES)
    path = SM.stage_events_by_day(spark, sf, end_marker=True, in_order=True)
    log = SM.read_request_log_stream(spark, path, files_per_trigger=40, watermark="1 day")
    rows = D.json_to_features(log, "features", ["k"], keep=["request_id", "ts", "latency_s", "score"])
    out = SD.run_checks(spark, SD.checks(rows, values))
    return out.select(*[_ts(c).alias(c) if c in ("check_at", "window_start") else c for c in out.columns if c != "batch_id"])


@register("feedback_attribution_stream", sql=REGISTRY["feedback_attribution"].sql)
def q_feedback_stream(spark, sf):
    """A replay in order, whose rows are late by less than the watermark's day; the end
    marker gives out the feedback that still waits.  What would be late all the same
    comes from the side table."""
    path = SM.stage_events_by_day(spark, sf, end_marker=True, in_order=True)
    log = SM.read_request_log_stream(spark, path, files_per_trigger=40, watermark="1 day")
    schema = spark.read.parquet(path).schema
    ev = spark.readStream.schema(schema).option("maxFilesPerTrigger", 40).parquet(path).withWatermark("ts", "1 day")
    marker = SM.never("ts")  # keeps the filters above the watermark, which so sees the end marker

    def feedback(events, more):
        return events.filter(F.col("event_type").isin("click", "purchase") | more).select(
            "event_id", (F.col("event_id") - 1).alias("request_id"),
            F.pmod(F.col("event_id") - 1, F.lit(2000)).alias("recipe_id"), F.col("ts").alias("feedback_ts"))

    joined = SM.feedback_attribution_stream(feedback(ev, marker), log.filter((F.col("rank_pos") == 1) | marker), 3600)
    done = SM.run_append(spark, joined.select("event_id", "request_id", "served_ts", "model_version", "served_score"), "feedback-stream")
    whole = spark.read.parquet(path).where(F.col("event_type") != SM.END)
    late = SM.late_attribution(feedback(whole, F.lit(False)), Catalog(spark, sf).request_log.where("rank_pos = 1"), done)
    r = SM.corrected_attribution(done, late)
    return r.select("event_id", "request_id", _ts("served_ts").alias("served_ts"), "model_version",
                    X.round6("served_score").alias("served_score"))


@register("alert_sustained_stream", sql=REGISTRY["alert_sustained"].sql)
def q_alert_sustained_stream(spark, sf):
    """The error-rate alert as a state machine over a replay in order; the end marker
    resolves what still fires."""
    path = SM.stage_events_by_day(spark, sf, end_marker=True, in_order=True)
    log = SM.read_request_log_stream(spark, path, files_per_trigger=40, watermark="1 day")
    events = SM.run_append(spark, SA.sustained(M.error_rate(log), F.col("firing"), 300, 300), "alerts")  # the marker has status 200
    return events.where("event = 'resolved'").select(
        _ts("island_start").alias("island_start"), _ts("island_last").alias("island_last"), "n_windows", "fired")
