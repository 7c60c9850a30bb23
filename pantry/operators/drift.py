"""Drift monitoring: JSON feature expansion, two-sample KS per feature, moments,
summary, look-back window, retention and baseline / live heads.

Scale notes (KS)
* Rows are first reduced to (feature, value) -> (count baseline, count live)
  with a hash aggregate, so a value held by a third of all rows is one row.
* The ECDF running sums are two-level: distinct values are assigned to one of
  ``n_buckets`` order-preserving buckets per feature (approximate quantile
  boundaries of the distinct values), bucket totals are prefix-summed on a
  tiny (feature x bucket) table, and the running sum inside each bucket is a
  window partitioned by (feature, bucket).  No window ever holds all values of
  a feature.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab
from ..functions import exprs as X


def json_to_features(df: DataFrame, col: str, names: list[str], keep: list[str] | None = None) -> DataFrame:
    """Expand a JSON document column into typed double columns (missing or
    non-numeric -> NULL)."""
    schema = "struct<" + ", ".join(f"`{n}`:string" for n in names) + ">"
    parsed = F.from_json(F.col(col), schema)
    return df.select(*(keep or []), *[parsed[n].try_cast("double").alias(n) for n in names])


def _long(df: DataFrame, features: list[str], side: int) -> DataFrame:
    expr = "stack({n}, {a}) AS (feature, value)".format(
        n=len(features), a=", ".join(f"'{f}', CAST(`{f}` AS DOUBLE)" for f in features))
    return df.select(F.expr(expr)).filter(F.col("value").isNotNull() & ~F.isnan("value")).withColumn(
        "side", F.lit(side))


def kolmogorov_q(lam: Column, terms: int = 100) -> Column:
    """Asymptotic two-sided KS tail Q(lambda) = 2 sum_k (-1)^(k-1) exp(-2 k^2 lambda^2)."""
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
        lambda acc, k: acc + F.lit(2.0) * F.pow(F.lit(-1.0), (k - 1).cast("double"))
        * F.exp(F.lit(-2.0) * (k * k).cast("double") * lam * lam))
    return F.when(lam < F.lit(0.2), F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), series)))


KS_SCHEMA = ("feature string, n_baseline bigint, n_live bigint, tested boolean, ks_statistic double, "
             "p_value double, drift_detected boolean, baseline_mean double, live_mean double, "
             "baseline_std double, live_std double")


def ks_drift(baseline: DataFrame, live: DataFrame, features: list[str],
             p_threshold: float = vocab.KS_P_THRESHOLD, min_stat: float = vocab.KS_MIN_STATISTIC,
             n_buckets: int = 64) -> DataFrame:
    """Per feature: n, KS statistic D, asymptotic p-value, drift flag, and the
    baseline / live mean and population std.  Features with < 2 values on a
    side are reported as not tested."""
    feats = [f for f in features if f in baseline.columns and f in live.columns]
    if not feats:
        return baseline.sparkSession.createDataFrame([], KS_SCHEMA)
    longf = _long(baseline, feats, 0).unionByName(_long(live, feats, 1))
    moments = longf.groupBy("feature").agg(
        F.count(F.when(F.col("side") == 0, 1)).alias("n_baseline"),
        F.count(F.when(F.col("side") == 1, 1)).alias("n_live"),
        F.avg(F.when(F.col("side") == 0, F.col("value"))).alias("baseline_mean"),
        F.avg(F.when(F.col("side") == 1, F.col("value"))).alias("live_mean"),
        F.stddev_pop(F.when(F.col("side") == 0, F.col("value"))).alias("baseline_std"),
        F.stddev_pop(F.when(F.col("side") == 1, F.col("value"))).alias("live_std"))
    counts = longf.groupBy("feature", "value").agg(
        F.count(F.when(F.col("side") == 0, 1)).alias("c0"), F.count(F.when(F.col("side") == 1, 1)).alias("c1"))
    # order-preserving buckets from approximate quantiles of the distinct values
    probs = [i / n_buckets for i in range(1, n_buckets)]
    bounds = counts.groupBy("feature").agg(F.percentile_approx("value", probs, 10000).alias("_bounds"))
    counts = counts.join(bounds, "feature").withColumn(
        "_bkt", F.size(F.filter("_bounds", lambda b: b < F.col("value")))).drop("_bounds")
    btot = counts.groupBy("feature", "_bkt").agg(F.sum("c0").alias("_b0"), F.sum("c1").alias("_b1"))
    wb = Window.partitionBy("feature").orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    boff = btot.select("feature", "_bkt", F.coalesce(F.sum("_b0").over(wb), F.lit(0)).alias("_o0"),
                       F.coalesce(F.sum("_b1").over(wb), F.lit(0)).alias("_o1"))
    wv = Window.partitionBy("feature", "_bkt").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    cdf = (counts.join(boff, ["feature", "_bkt"])
           .withColumn("_cum0", F.col("_o0") + F.sum("c0").over(wv))
           .withColumn("_cum1", F.col("_o1") + F.sum("c1").over(wv))
           .join(moments.select("feature", "n_baseline", "n_live"), "feature"))
    d = cdf.groupBy("feature").agg(F.max(F.abs(F.col("_cum0") / F.nullif(F.col("n_baseline"), F.lit(0))
                                               - F.col("_cum1") / F.nullif(F.col("n_live"), F.lit(0)))).alias("_d"))
    out = moments.join(d, "feature", "left")
    tested = (F.col("n_baseline") >= 2) & (F.col("n_live") >= 2)
    en = F.col("n_baseline") * F.col("n_live") / F.nullif(F.col("n_baseline") + F.col("n_live"), F.lit(0))
    p = kolmogorov_q(F.sqrt(en) * F.col("_d"))
    return out.select(
        "feature", "n_baseline", "n_live", tested.alias("tested"),
        F.when(tested, X.rnd("_d", 4)).alias("ks_statistic"),
        F.when(tested, X.rnd(p, 6)).alias("p_value"),
        F.coalesce(tested & (p < F.lit(p_threshold)) & (F.col("_d") >= F.lit(min_stat)), F.lit(False))
        .alias("drift_detected"),
        X.rnd("baseline_mean", 4).alias("baseline_mean"), X.rnd("live_mean", 4).alias("live_mean"),
        X.rnd("baseline_std", 4).alias("baseline_std"), X.rnd("live_std", 4).alias("live_std"))


def feature_moments(baseline: DataFrame, live: DataFrame, features: list[str]) -> DataFrame:
    """Mean and population std per feature, baseline vs live (one pass each side)."""
    feats = [f for f in features if f in baseline.columns and f in live.columns]
    longf = _long(baseline, feats, 0).unionByName(_long(live, feats, 1))
    return longf.groupBy("feature", "side").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


def drift_summary(ks: DataFrame, share: float = vocab.DRIFT_SHARE) -> DataFrame:
    """n checked / drifted, drift rate (3 dp), overall drift when rate > share."""
    # a feature without values on either side was not checked
    ks = ks.where((F.col("n_baseline") > 0) & (F.col("n_live") > 0)) if {"n_baseline", "n_live"} <= set(ks.columns) else ks
    s = ks.agg(F.count(F.lit(1)).alias("n_features_checked"),
               F.count(F.when(F.col("drift_detected"), 1)).alias("n_drifted"),
               F.sort_array(F.collect_list(F.when(F.col("drift_detected"), F.col("feature"))))
               .alias("drifted_features"))
    rate = F.col("n_drifted") / F.greatest(F.col("n_features_checked"), F.lit(1))
    return s.select("n_features_checked", "n_drifted", X.rnd(rate, 3).alias("drift_rate"),
                    (rate > F.lit(share)).alias("overall_drift_detected"),
                    F.array_join("drifted_features", ",").alias("drifted_features"))


def lookback_window(log: DataFrame, state: DataFrame, ts_col: str = "ts", hours: int = 24,
                    min_rows: int = 100) -> DataFrame:
    """Rows with ts >= max(now - hours, last_trigger_at); ``state`` is a one-row
    table (now, last_trigger_at).  Adds ``skipped`` when fewer than min_rows."""
    day = F.col("now") - F.make_dt_interval(hours=F.lit(hours))
    cutoff = X.scalar_of(state, F.greatest(day, F.coalesce(F.col("last_trigger_at"), day)), log, ts_col)
    win = log.filter(F.col(ts_col) >= cutoff)
    n = win.agg(F.count(F.lit(1)).alias("n_window"))  # one row, not a single-partition window
    return win.crossJoin(n).withColumn("skipped", F.col("n_window") < min_rows)


def retention_cutoff(log: DataFrame, ts_col: str, days: int = 90) -> str:
    """The newest row's time less ``days``, as text in UTC: what a log of finished
    days takes for now.  ``sources.snapshots.drop_before`` applies it."""
    newest = F.max(F.col(ts_col).cast("timestamp")) - F.make_dt_interval(F.lit(days))
    return log.agg(F.date_format(newest, "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0] or "0001-01-01"


def baseline_head(df: DataFrame, order_cols: list[str], n: int, descending: bool = False) -> DataFrame:
    """First n rows by the given order (the reference's row-limited baseline /
    newest live sample; the limit is the feature)."""
    cols = [F.desc(c) if descending else F.asc(c) for c in order_cols]
    return df.orderBy(*cols).limit(n)
