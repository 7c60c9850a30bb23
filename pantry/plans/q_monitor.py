"""Registered queries: drift (KS), retention, look-back, and service-health
windows over the request log."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import drift as D
from ..operators import monitor as M
from ..operators import rolling as R
from ..sources.fixtures import Catalog
from ..sources.io import output_root
from ..sources.snapshots import SnapshotTable, by_day, drop_before
from .registry import register, with_views

DRIFT_FEATURES = ["k", "latency_s", "score"]
BASELINE_DAYS, LIVE_HOURS = 15, 24


def _ts(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def _feats(cat):
    log = cat.request_log
    return D.json_to_features(log, "features", ["k"], keep=["request_id", "ts", "latency_s", "score", "status"])


def _sides(cat):
    f = _feats(cat)
    b = f.agg(F.min("ts").alias("_t0"), F.max("ts").alias("_t1"))  # one row
    j = f.crossJoin(b)
    base = j.filter(F.col("ts") < F.col("_t0") + F.make_dt_interval(F.lit(BASELINE_DAYS)))
    live = j.filter(F.col("ts") >= F.col("_t1") - F.make_dt_interval(hours=F.lit(LIVE_HOURS)))
    return base, live


_SIDES_SQL = [
    ("bnd", "SELECT min(ts) AS t0, max(ts) AS t1 FROM request_log"),
    ("f", "SELECT request_id, ts, TRY_CAST(json_extract_string(features, '$.k') AS DOUBLE) AS k, latency_s, score, status FROM request_log"),
    ("base", f"SELECT f.* FROM f, bnd WHERE ts < t0 + INTERVAL {BASELINE_DAYS} DAY"),
    ("live", f"SELECT f.* FROM f, bnd WHERE ts >= t1 - INTERVAL {LIVE_HOURS} HOUR"),
    ("lng", " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, {s} AS side FROM {t} WHERE {c} IS NOT NULL"
        for c in DRIFT_FEATURES for t, s in (("base", 0), ("live", 1)))),
    ("mom", """SELECT feature, count(*) FILTER (WHERE side = 0) AS n_baseline, count(*) FILTER (WHERE side = 1) AS n_live,
  avg(value) FILTER (WHERE side = 0) AS bm, avg(value) FILTER (WHERE side = 1) AS lm,
  stddev_pop(value) FILTER (WHERE side = 0) AS bs, stddev_pop(value) FILTER (WHERE side = 1) AS ls FROM lng GROUP BY feature"""),
    ("cnt", "SELECT feature, value, count(*) FILTER (WHERE side = 0) AS c0, count(*) FILTER (WHERE side = 1) AS c1 FROM lng GROUP BY feature, value"),
    ("cdf", """SELECT feature, sum(c0) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS cum0,
  sum(c1) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS cum1 FROM cnt"""),
    ("dd", "SELECT c.feature, max(abs(cum0 / m.n_baseline - cum1 / m.n_live)) AS d FROM cdf c JOIN mom m ON c.feature = m.feature GROUP BY c.feature"),
    ("ks", """SELECT m.feature, m.n_baseline, m.n_live, m.n_baseline >= 2 AND m.n_live >= 2 AS tested, dd.d AS d,
  sqrt(m.n_baseline * m.n_live / (m.n_baseline + m.n_live)) * dd.d AS lam, bm, lm, bs, ls
FROM mom m LEFT JOIN dd ON m.feature = dd.feature"""),
    ("ksp", """SELECT *, CASE WHEN lam < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0,
  list_reduce(list_transform(range(1, 101), lambda kk: 2.0 * pow(-1.0, kk - 1) * exp(-2.0 * kk * kk * lam * lam)),
              lambda a, b: a + b, 0.0))) END AS p FROM ks"""),
    ("ksr", """SELECT feature, n_baseline, n_live, tested, CASE WHEN tested THEN round(d, 4) END AS ks_statistic,
  CASE WHEN tested THEN round(p, 6) END AS p_value, coalesce(tested AND p < 0.01 AND d >= 0.1, false) AS drift_detected,
  round(bm, 4) AS baseline_mean, round(lm, 4) AS live_mean, round(bs, 4) AS baseline_std, round(ls, 4) AS live_std FROM ksp"""),
]


@register("src_json_features", sql=with_views("request_log") + """
SELECT request_id, TRY_CAST(json_extract_string(features, '$.k') AS DOUBLE) AS k FROM request_log""")
def q_src_json_features(spark, sf):
    return D.json_to_features(Catalog(spark, sf).request_log, "features", ["k"], keep=["request_id"])


@register("ks_drift", sql=with_views("request_log", extra=_SIDES_SQL) + "SELECT * FROM ksr")
def q_ks_drift(spark, sf):
    base, live = _sides(Catalog(spark, sf))
    return D.ks_drift(base, live, DRIFT_FEATURES)


@register("feature_moments", sql=with_views("request_log", extra=_SIDES_SQL) + """
SELECT feature, side, count(*) AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std FROM lng GROUP BY feature, side""")
def q_feature_moments(spark, sf):
    base, live = _sides(Catalog(spark, sf))
    m = D.feature_moments(base, live, DRIFT_FEATURES)
    return m.select("feature", "side", "n", X.round6("mean").alias("mean"), X.round6("std").alias("std"))


@register("drift_summary", sql=with_views("request_log", extra=_SIDES_SQL) + """
SELECT count(*) AS n_features_checked, count(*) FILTER (WHERE drift_detected) AS n_drifted,
  round(count(*) FILTER (WHERE drift_detected) / greatest(count(*), 1), 3) AS drift_rate,
  count(*) FILTER (WHERE drift_detected) / greatest(count(*), 1) > 0.3 AS overall_drift_detected,
  coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (WHERE drift_detected), '') AS drifted_features FROM ksr""")
def q_drift_summary(spark, sf):
    base, live = _sides(Catalog(spark, sf))
    return D.drift_summary(D.ks_drift(base, live, DRIFT_FEATURES))


_STATE_SQL = ("st", """SELECT max(ts) AS now,
  (SELECT max(ts) FROM request_log WHERE status = 500 AND latency_s >= 3.0) AS last_trigger_at FROM request_log""")


def _state(log):
    return log.agg(F.max("ts").alias("now"),
                   F.max(F.when((F.col("status") == 500) & (F.col("latency_s") >= 3.0), F.col("ts")))
                   .alias("last_trigger_at"))


@register("lookback_since_trigger", sql=with_views("request_log", extra=[_STATE_SQL]) + """
SELECT request_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, count(*) OVER () AS n_window, count(*) OVER () < 100 AS skipped
FROM request_log, st WHERE ts >= greatest(now - INTERVAL 24 HOUR, coalesce(last_trigger_at, now - INTERVAL 24 HOUR))""")
def q_lookback(spark, sf):
    log = Catalog(spark, sf).request_log
    w = D.lookback_window(log, _state(log))
    return w.select("request_id", _ts("ts").alias("ts"), "n_window", "skipped")


def _retention(days):
    """The log as a table by day; retention drops whole days and rewrites one."""
    def build(spark, sf):
        log = Catalog(spark, sf).request_log
        table = SnapshotTable(spark, output_root(spark, "request-log"), log.schema, by_day("ts"))
        table.append_new(log)
        deleted = drop_before(table, "ts", D.retention_cutoff(log, "ts", days))
        kept = sum(p["rows"] for p in table.parts().values())
        return spark.createDataFrame([(kept, deleted)], "kept bigint, deleted bigint")
    return build


for _d in (90, 7):
    register(f"retention_delete{'' if _d == 90 else f'_{_d}d'}", sql=with_views("request_log") + f"""
SELECT count(*) FILTER (WHERE ts >= m - INTERVAL {_d} DAY) AS kept, count(*) FILTER (WHERE ts < m - INTERVAL {_d} DAY) AS deleted
FROM request_log, (SELECT max(ts) AS m FROM request_log) x""")(_retention(_d))


@register("baseline_head", sql=with_views("request_log") + """
SELECT request_id, 'baseline' AS part FROM (SELECT request_id FROM request_log ORDER BY ts, request_id LIMIT 5000) a
UNION ALL SELECT request_id, 'live' FROM (SELECT request_id FROM request_log ORDER BY ts DESC, request_id DESC LIMIT 10000) b""")
def q_baseline_head(spark, sf):
    log = Catalog(spark, sf).request_log
    a = D.baseline_head(log, ["ts", "request_id"], 5000).select("request_id", F.lit("baseline").alias("part"))
    b = D.baseline_head(log, ["ts", "request_id"], 10000, descending=True).select(
        "request_id", F.lit("live").alias("part"))
    return a.unionByName(b)


def _bucket(sec):
    return f"time_bucket(INTERVAL '{sec} seconds', ts, TIMESTAMP '1970-01-01 00:00:00')"


def _now(log):
    """One row: an hour and a half after the newest event, which leaves an outage to be seen."""
    return log.agg((F.max("ts").cast("timestamp") + F.make_dt_interval(mins=F.lit(90))).alias("now"))


_NOW_SQL = "(SELECT max(ts) + INTERVAL 90 MINUTE FROM request_log)"


def _wsql(sec):
    return (f"strftime({_bucket(sec)}, '%Y-%m-%d %H:%M:%S') AS window_start, "
            f"strftime({_bucket(sec)} + INTERVAL '{sec} seconds', '%Y-%m-%d %H:%M:%S') AS window_end")


def _fmt_windows(df):
    return df.withColumn("window_start", _ts("window_start")).withColumn("window_end", _ts("window_end"))


@register("error_rate_5m", sql=with_views("request_log") + f"""
SELECT {_wsql(300)}, count(*) AS n, count(*) FILTER (WHERE status >= 500) AS errors,
  round(count(*) FILTER (WHERE status >= 500) / count(*), 6) AS error_rate,
  count(*) FILTER (WHERE status >= 500) / count(*) > 0.05 AS firing
FROM request_log GROUP BY {_bucket(300)}""")
def q_error_rate(spark, sf):
    r = M.error_rate(Catalog(spark, sf).request_log)
    return _fmt_windows(r).withColumn("error_rate", X.round6("error_rate"))


@register("p95_latency_5m", sql=with_views("request_log") + f"""
SELECT {_wsql(300)}, count(*) AS n, round(quantile_cont(latency_s, 0.95), 6) AS p95_latency_s,
  quantile_cont(latency_s, 0.95) > 0.5 AS firing FROM request_log GROUP BY {_bucket(300)}""")
def q_p95_latency(spark, sf):
    r = M.p95_latency(Catalog(spark, sf).request_log)
    return _fmt_windows(r).withColumn("p95_latency_s", X.round6("p95_latency_s"))


@register("median_score_10m", sql=with_views("request_log") + f"""
SELECT {_wsql(600)}, count(*) AS n, round(quantile_cont(score, 0.5), 6) AS median_score,
  quantile_cont(score, 0.5) < 0.2 AS firing FROM request_log GROUP BY {_bucket(600)}""")
def q_median_score(spark, sf):
    r = M.median_score(Catalog(spark, sf).request_log)
    return _fmt_windows(r).withColumn("median_score", X.round6("median_score"))


@register("score_quantile_series", sql=with_views("request_log") + f"""
SELECT {_wsql(600)}, round(quantile_cont(score, 0.1), 6) AS p10, round(quantile_cont(score, 0.5), 6) AS p50,
  round(quantile_cont(score, 0.9), 6) AS p90 FROM request_log GROUP BY {_bucket(600)}""")
def q_score_quantiles(spark, sf):
    r = _fmt_windows(M.score_quantiles(Catalog(spark, sf).request_log))
    return r.select("window_start", "window_end", *[X.round6(c).alias(c) for c in ("p10", "p50", "p90")])


@register("score_histogram", sql=with_views("request_log") + f"""
SELECT {_wsql(3600)}, """ + ", ".join(
    f"count(*) FILTER (WHERE score <= {b}) AS le_{i}" for i, b in enumerate(M.SCORE_BUCKETS))
    + f", count(score) AS le_inf FROM request_log GROUP BY {_bucket(3600)}")
def q_score_histogram(spark, sf):
    return _fmt_windows(M.score_histogram(Catalog(spark, sf).request_log))


@register("batch_size_histogram", sql=with_views("request_log") + f"""
, b AS (SELECT {_bucket(86400)} AS ws, user_id, count(*) AS n FROM request_log GROUP BY ALL)
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(ws + INTERVAL '86400 seconds', '%Y-%m-%d %H:%M:%S') AS window_end, """ + ", ".join(
    f"count(*) FILTER (WHERE n <= {b}) AS le_{i}" for i, b in enumerate(M.BATCH_SIZE_BUCKETS)) + ", count(n) AS le_inf FROM b GROUP BY ws")
def q_batch_size_histogram(spark, sf):
    """A user's rows of a day stand for the instances of one request."""
    return _fmt_windows(M.batch_size_histogram(Catalog(spark, sf).request_log, ["user_id"], "86400 seconds"))


@register("throughput_rate", sql=with_views("request_log") + f"""
, spine AS (SELECT unnest(generate_series({_bucket(600).replace('ts,', 'min(ts),')}, {_bucket(600).replace('ts,', 'max(ts) + INTERVAL 90 MINUTE,')},
    INTERVAL '600 seconds')) AS ws FROM request_log)
, ver AS (SELECT DISTINCT model_version FROM request_log)
, cnt AS (SELECT {_bucket(600)} AS ws, model_version, count(*) AS n FROM request_log GROUP BY ALL)
SELECT strftime(s.ws, '%Y-%m-%d %H:%M:%S') AS window_start, v.model_version, coalesce(c.n, 0) AS n,
  round(coalesce(c.n, 0) / 600.0, 6) AS rate_per_s, coalesce(c.n, 0) = 0 AS zero_traffic
FROM spine s CROSS JOIN ver v LEFT JOIN cnt c ON c.ws = s.ws AND c.model_version = v.model_version""")
def q_throughput(spark, sf):
    log = Catalog(spark, sf).request_log
    r = M.throughput(log, 600, now=_now(log))
    return r.withColumn("window_start", _ts("window_start")).withColumn("rate_per_s", X.round6("rate_per_s"))


@register("staleness", sql=with_views("request_log") + """
SELECT model_version, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_ts,
  CAST(floor(epoch((SELECT max(ts) FROM request_log))) - floor(epoch(max(ts))) AS BIGINT) AS age_s,
  floor(epoch((SELECT max(ts) FROM request_log))) - floor(epoch(max(ts))) > 86400 AS stale
FROM request_log GROUP BY model_version""")
def q_staleness(spark, sf):
    log = Catalog(spark, sf).request_log
    r = M.staleness(log, "model_version", log.agg(F.max("ts").alias("now")), 86400)
    return r.withColumn("last_ts", _ts("last_ts"))


_STEP_SQL = """
, e AS (SELECT CAST(floor(epoch(ts) / 60) AS BIGINT) + 1 AS pane, status, model_version FROM request_log)
, n AS (SELECT CAST(floor(epoch({now}) / 60) AS BIGINT) AS now)
, s AS (SELECT {series}unnest(generate_series(min(pane), (SELECT now FROM n))) AS pos FROM e {by})
, c AS (SELECT {series}pane, count(*) AS c, count(*) FILTER (WHERE status >= 500) AS x FROM e GROUP BY ALL)
, r AS (SELECT s.*, coalesce(sum(c.c), 0) AS n, coalesce(sum(c.x), 0) AS errors
        FROM s LEFT JOIN c ON {on}c.pane <= s.pos AND c.pane > s.pos - {panes} GROUP BY ALL)
"""


def _steps_sql(panes, series=""):
    return with_views("request_log") + _STEP_SQL.format(
        now=_NOW_SQL, panes=panes, series=f"{series}, " if series else "", by=f"GROUP BY {series}" if series else "",
        on=f"c.{series} = s.{series} AND " if series else "")


_AT_SQL = "strftime(make_timestamp(pos * 60000000), '%Y-%m-%d %H:%M:%S')"


@register("error_rate_rolling", sql=_steps_sql(5) + f"""
SELECT {_AT_SQL} AS evaluated_at, CAST(n AS BIGINT) AS n, CAST(errors AS BIGINT) AS errors, coalesce(errors / nullif(n, 0) > 0.05, false) AS firing FROM r""")
def q_error_rate_rolling(spark, sf):
    """Errors of the last 5 minutes, evaluated each minute up to now."""
    log = Catalog(spark, sf).request_log
    r = R.at_steps(R.rolling_counts(log, _now(log), {"n": F.lit(True), "errors": F.col("status") >= 500}, 300))
    rate = F.col("errors") / F.nullif(F.col("n"), F.lit(0))
    return r.select(_ts("at").alias("evaluated_at"), "n", "errors", F.coalesce(rate > 0.05, F.lit(False)).alias("firing"))


@register("zero_traffic_rolling", sql=_steps_sql(10, "model_version") + """
, z AS (SELECT model_version, pos, pos - row_number() OVER (PARTITION BY model_version ORDER BY pos) AS run FROM r WHERE n = 0)
SELECT model_version, strftime(make_timestamp(min(pos) * 60000000), '%Y-%m-%d %H:%M:%S') AS pending_at,
  strftime(make_timestamp(max(pos) * 60000000), '%Y-%m-%d %H:%M:%S') AS last_at, (max(pos) - min(pos)) * 60 >= 600 AS fired
FROM z GROUP BY model_version, run""")
def q_zero_traffic_rolling(spark, sf):
    """Runs without a prediction in the last 10 minutes, and whether they hold for 10
    more: the outage up to now among them."""
    log = Catalog(spark, sf).request_log
    r = R.rolling_counts(log, _now(log), {"n": F.lit(True)}, 600, series=["model_version"])
    runs = R.firing_for(r, F.col("n") == 0, 600, ["model_version"])
    return runs.select("model_version", _ts("pending_at").alias("pending_at"), _ts("last_at").alias("last_at"), "fired")


STALE = {"prediction_logged": 300, "model_loaded": 86400, "last_retrain": 604800}


@register("staleness_series", sql=with_views("request_log") + f"""
, v AS (SELECT model_version, min(ts) AS a, max(ts) AS z FROM request_log GROUP BY 1)
, l AS (SELECT 'prediction_logged' AS series, max(z) AS t, 300 AS s FROM v UNION ALL SELECT 'model_loaded', max(a), 86400 FROM v
        UNION ALL SELECT 'last_retrain', min(a), 604800 FROM v)
SELECT series, strftime(t, '%Y-%m-%d %H:%M:%S') AS last_ts, CAST(floor(epoch({_NOW_SQL})) - floor(epoch(t)) AS BIGINT) AS age_s,
  CAST(s AS BIGINT) AS threshold_s, floor(epoch({_NOW_SQL})) - floor(epoch(t)) > s AS stale FROM l""")
def q_staleness_series(spark, sf):
    """The three ages that are watched: of the newest prediction, of the version that
    was loaded last (its first prediction), of the training behind it."""
    log = Catalog(spark, sf).request_log
    seen = log.groupBy("model_version").agg(F.min("ts").alias("a"), F.max("ts").alias("z"))
    lasts = seen.agg(F.max("z").alias("prediction_logged"), F.max("a").alias("model_loaded"), F.min("a").alias("last_retrain"))
    r = R.ages(lasts, _now(log), STALE)
    return r.withColumn("last_ts", _ts("last_ts"))


@register("failure_increase_1h", sql=with_views("request_log") + """
SELECT count(*) FILTER (WHERE status >= 500) AS failures, count(*) FILTER (WHERE status >= 500) > 0 AS firing
FROM request_log, (SELECT max(ts) AS now FROM request_log) n WHERE ts > now - INTERVAL 3600 SECOND AND ts <= now""")
def q_failure_increase(spark, sf):
    log = Catalog(spark, sf).request_log
    return M.failures_in_last(log, log.agg(F.max("ts").alias("now")), 3600)


@register("alert_sustained", sql=with_views("request_log") + f"""
, er AS (SELECT {_bucket(300)} AS ws FROM request_log GROUP BY ALL HAVING count(*) FILTER (WHERE status >= 500) / count(*) > 0.05)
, isl AS (SELECT ws, CAST(epoch(ws) / 300 AS BIGINT) - row_number() OVER (ORDER BY ws) AS island FROM er)
SELECT strftime(min(ws), '%Y-%m-%d %H:%M:%S') AS island_start, strftime(max(ws), '%Y-%m-%d %H:%M:%S') AS island_last,
  count(*) AS n_windows, (count(*) - 1) * 300 >= 300 AS fired FROM isl GROUP BY island""")
def q_alert_sustained(spark, sf):
    er = M.error_rate(Catalog(spark, sf).request_log)
    s = M.sustained(er, 300, 300)
    return s.select(_ts("island_start").alias("island_start"), _ts("island_last").alias("island_last"),
                    "n_windows", "fired")


@register("latency_percentiles", sql=with_views("request_log") + """
SELECT model_version, count(*) AS num_requests,
  round(count(*) / nullif(CAST(floor(epoch(max(ts))) - floor(epoch(min(ts))) AS DOUBLE), 0), 2) AS throughput_rps,
  round(quantile_cont(latency_s * 1000.0, 0.5), 2) AS p50_ms, round(quantile_cont(latency_s * 1000.0, 0.95), 2) AS p95_ms,
  round(quantile_cont(latency_s * 1000.0, 0.99), 2) AS p99_ms, round(avg(latency_s * 1000.0), 2) AS mean_ms,
  round(min(latency_s * 1000.0), 2) AS min_ms, round(max(latency_s * 1000.0), 2) AS max_ms,
  count(*) FILTER (WHERE status >= 500) AS error_count,
  round(count(*) FILTER (WHERE status >= 500) / count(*) * 100, 2) AS error_rate
FROM request_log GROUP BY model_version""")
def q_latency_percentiles(spark, sf):
    return M.latency_percentiles(Catalog(spark, sf).request_log)


@register("served_impressions", sql=with_views("request_log") + """
SELECT user_id, recipe_id, CAST(NULL AS INTEGER) AS rating, 'served' AS action, strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_at
FROM request_log WHERE rank_pos = 1""")
def q_served_impressions(spark, sf):
    s = M.served_impressions(Catalog(spark, sf).request_log)
    return s.withColumn("created_at", _ts("created_at"))


def _feedback(cat):
    return cat.events.filter(F.col("event_type").isin("click", "purchase")).select(
        "event_id", (F.col("event_id") - 1).alias("request_id"),
        F.pmod(F.col("event_id") - 1, F.lit(2000)).alias("recipe_id"), F.col("ts").alias("feedback_ts"))


@register("feedback_attribution", sql=with_views("request_log") + """
, fb AS (SELECT event_id, event_id - 1 AS request_id, (event_id - 1) % 2000 AS recipe_id, ts AS feedback_ts
         FROM events WHERE event_type IN ('click', 'purchase'))
, sv AS (SELECT * FROM request_log WHERE rank_pos = 1)
SELECT f.event_id, f.request_id, strftime(s.ts, '%Y-%m-%d %H:%M:%S') AS served_ts, s.model_version,
  round(s.score, 6) AS served_score
FROM fb f LEFT JOIN sv s ON f.request_id = s.request_id AND f.recipe_id = s.recipe_id
  AND f.feedback_ts >= s.ts AND f.feedback_ts <= s.ts + INTERVAL 3600 SECOND""")
def q_feedback_attribution(spark, sf):
    cat = Catalog(spark, sf)
    served = cat.request_log.filter(F.col("rank_pos") == 1)
    r = M.feedback_attribution(_feedback(cat), served, 3600)
    return r.select("event_id", "request_id", _ts("served_ts").alias("served_ts"), "model_version",
                    X.round6("served_score").alias("served_score"))
