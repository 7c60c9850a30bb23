"""Registered queries: sources, sinks, set operations and small row operators."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ..functions import exprs as X
from ..operators import candidates as C
from ..operators import monitor as M
from ..operators import training as T
from ..operators import users as U
from ..sources import io as IO
from ..sources.fixtures import Catalog, production_split
from . import sqlparts as S
from .common import DIET_COLS, TARGET_COLS, out, pipeline, split_training
from .registry import register, with_views

RECIPE_CSV_SCHEMA = StructType([
    StructField("recipe_id", LongType()), StructField("name", StringType()), StructField("minutes", IntegerType()),
    StructField("tags", StringType()), StructField("nutrition", StringType()), StructField("n_steps", LongType()),
    StructField("n_ingredients", IntegerType()), StructField("ingredients", StringType()),
    StructField("description", StringType())])


@register("src_csv", sql=with_views("recipes") + """
SELECT recipe_id, name, minutes, tags, nutrition, n_steps, n_ingredients, ingredients, description FROM recipes""")
def q_src_csv(spark, sf):
    r = Catalog(spark, sf).recipes
    # messy header: surrounding spaces and upper case, columns in another order
    messy = r.select(*[F.col(c).alias(f" {c.upper()} ") for c in reversed(r.columns)])
    path = IO.output_root(spark, "recipes-csv")
    messy.write.option("header", True).option("escape", '"').csv(path)
    return IO.read_csv(spark, path, RECIPE_CSV_SCHEMA)


@register("src_table_export", sql=with_views("interactions") + """
SELECT user_id, recipe_id, rating, strftime(date, '%Y-%m-%d %H:%M:%S') AS date FROM interactions WHERE l_orderkey % 2 = 1""")
def q_src_table_export(spark, sf):
    _, prod = production_split(Catalog(spark, sf).interactions)
    e = IO.export_interactions(prod.withColumnRenamed("date", "created_at"))
    return e.withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss"))


@register("src_incremental", sql=with_views("interactions") + """
SELECT user_id, recipe_id, l_orderkey, l_linenumber, l_suppkey FROM interactions
WHERE date > (SELECT max(date) - INTERVAL 30 DAY FROM interactions)""")
def q_src_incremental(spark, sf):
    i = Catalog(spark, sf).interactions
    state = i.agg((F.max("date") - F.make_dt_interval(F.lit(30))).alias("last_ts"))  # one-row state
    return IO.read_since(i, state).select("user_id", "recipe_id", "l_orderkey", "l_linenumber", "l_suppkey")


@register("union_production", sql=with_views("interactions") + """
SELECT user_id, recipe_id, rating, strftime(date, '%Y-%m-%d %H:%M:%S') AS date, l_orderkey FROM interactions WHERE l_orderkey % 2 = 0
UNION ALL SELECT user_id, recipe_id, rating, strftime(date, '%Y-%m-%d %H:%M:%S'), CAST(NULL AS BIGINT) FROM interactions
WHERE l_orderkey % 2 = 1""")
def q_union_production(spark, sf):
    hist, prod = production_split(Catalog(spark, sf).interactions)
    prod = IO.export_interactions(prod.withColumnRenamed("date", "created_at"))
    u = hist.select("user_id", "recipe_id", "rating", "date", "l_orderkey").unionByName(
        prod, allowMissingColumns=True)
    return u.withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss"))


def _splits(spark, sf):
    return split_training(pipeline(spark, sf))


_SPLIT_COUNT_SQL = with_views("interactions", "recipes", extra=S.training_ctes() + [S.split_cte()])


@register("sink_splits", sql=_SPLIT_COUNT_SQL + "SELECT split, count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives FROM splits GROUP BY split")
def q_sink_splits(spark, sf):
    sp = _splits(spark, sf).drop("l_shipdate")
    path = IO.write_dataset(sp, IO.output_root(spark, "splits"), "parquet", partition_by=["split"])
    back = spark.read.parquet(path)
    return back.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.sum("label").cast("bigint").alias("positives"))


@register("sink_user_shards", sql=with_views("interactions", "recipes", extra=S.training_ctes()) + """
SELECT CAST(user_id % 4 AS INTEGER) AS shard, count(*) AS rows, count(DISTINCT user_id) AS users FROM training GROUP BY 1""")
def q_sink_user_shards(spark, sf):
    t = pipeline(spark, sf).training.drop("l_shipdate")
    path = IO.write_shards(t, IO.output_root(spark, "shards"), 4)
    back = spark.read.parquet(path)
    return back.groupBy(F.col("shard").cast("int").alias("shard")).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("user_id").alias("users"))


LOG_SCHEMA = StructType([StructField("request_id", LongType()), StructField("user_id", LongType()),
                         StructField("recipe_id", LongType()), StructField("score", StringType()),
                         StructField("rank", IntegerType()), StructField("log_date", StringType())])


@register("sink_log_append", sql=with_views("request_log") + """
SELECT strftime(ts, '%Y-%m-%d') AS log_date, count(*) AS rows FROM request_log GROUP BY 1""")
def q_sink_log_append(spark, sf):
    log = Catalog(spark, sf).request_log.select(
        "request_id", "user_id", "recipe_id", F.col("score").cast("string").alias("score"),
        F.col("rank_pos").alias("rank"), F.date_format("ts", "yyyy-MM-dd").alias("log_date"))
    path = IO.output_root(spark, "prediction-log")
    for parity in (0, 1):  # two appended batches
        IO.append_log(log.filter(F.pmod("request_id", F.lit(2)) == parity), path, LOG_SCHEMA)
    back = spark.read.parquet(path)  # partition values come back typed (date)
    return back.groupBy(F.col("log_date").cast("string").alias("log_date")).agg(F.count(F.lit(1)).alias("rows"))


@register("sink_versioned_release", sql=_SPLIT_COUNT_SQL + "SELECT split, count(*) AS rows FROM splits GROUP BY split")
def q_sink_versioned_release(spark, sf):
    sp = _splits(spark, sf).drop("l_shipdate")
    parts = {n: sp.filter(F.col("split") == n) for n in ("train", "val", "test")}
    ver = T.dataset_manifest_tagged(sp.withColumn("date", F.col("date").cast("timestamp"))).select("version").first()[0]
    root = IO.output_root(spark, "release")
    IO.publish(spark, parts, root, ver)
    back = None
    for n in parts:
        d = IO.resolve_latest(spark, root, n).agg(F.lit(n).alias("split"), F.count(F.lit(1)).alias("rows"))
        back = d if back is None else back.unionByName(d)
    return back


_ALLOWED = ["HighErrorRate"]


def _alerts(log):
    er = M.error_rate(log).select("window_start", F.lit("HighErrorRate").alias("alertname"),
                                  F.lit("critical").alias("severity"), "firing")
    p95 = M.p95_latency(log).select("window_start", F.lit("HighPredictionLatency").alias("alertname"),
                                    F.lit("warning").alias("severity"), "firing")
    med = M.median_score(log).select("window_start", F.lit("LowPredictionScores").alias("alertname"),
                                     F.lit("warning").alias("severity"), "firing")
    return er.unionByName(p95).unionByName(med)


@register("alert_intersection", sql=with_views("request_log") + f"""
, al AS (SELECT time_bucket(INTERVAL '300 seconds', ts, TIMESTAMP '1970-01-01') AS ws, 'HighErrorRate' AS alertname,
           'critical' AS severity, count(*) FILTER (WHERE status >= 500) / count(*) > 0.05 AS firing FROM request_log GROUP BY 1
         UNION ALL SELECT time_bucket(INTERVAL '300 seconds', ts, TIMESTAMP '1970-01-01'), 'HighPredictionLatency', 'warning',
           quantile_cont(latency_s, 0.95) > 0.5 FROM request_log GROUP BY 1
         UNION ALL SELECT time_bucket(INTERVAL '600 seconds', ts, TIMESTAMP '1970-01-01'), 'LowPredictionScores', 'warning',
           quantile_cont(score, 0.5) < 0.2 FROM request_log GROUP BY 1)
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, alertname FROM (
  SELECT ws, alertname FROM al WHERE firing AND severity = 'critical'
  INTERSECT SELECT ws, a.name FROM (SELECT DISTINCT ws FROM al) w, (SELECT {S.q(_ALLOWED[0])} AS name) a) x""")
def q_alert_intersection(spark, sf):
    log = Catalog(spark, sf).request_log
    al = _alerts(log)
    firing = al.filter(F.col("firing") & (F.col("severity") == "critical")).select("window_start", "alertname")
    allowed = spark.createDataFrame([(a,) for a in _ALLOWED], "alertname string")  # configuration, bounded
    cand = al.select("window_start").distinct().crossJoin(F.broadcast(allowed))
    return firing.intersect(cand).select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                                         "alertname")


_ORDER = ["date", "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate"]


@register("dedupe_keep_last", sql=with_views("interactions") + """
SELECT user_id, recipe_id, strftime(date, '%Y-%m-%d %H:%M:%S') AS date, l_orderkey, l_linenumber, l_suppkey FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY date, l_orderkey, l_linenumber, l_suppkey, l_shipdate) AS rn FROM (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, recipe_id
      ORDER BY date DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, l_shipdate DESC) AS last_rn
      FROM interactions) a WHERE last_rn = 1) b) c WHERE rn <= 20""")
def q_dedupe_keep_last(spark, sf):
    i = Catalog(spark, sf).interactions
    r = C.dedupe_keep_last(i, ["user_id"], "recipe_id", _ORDER, 20)
    return r.select("user_id", "recipe_id", F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("date"),
                    "l_orderkey", "l_linenumber", "l_suppkey")


@register("last_n_positive", sql=with_views("interactions", "recipes", extra=S.training_ctes()) + """
SELECT user_id, n_recent, round(daily_calorie_target, 6) AS daily_calorie_target, round(protein_target_g, 6) AS protein_target_g,
  round(carbs_target_g, 6) AS carbs_target_g, round(fat_target_g, 6) AS fat_target_g FROM (
  SELECT user_id, count(*) AS n_recent, avg(calories) AS daily_calorie_target, avg(protein_g) AS protein_target_g,
    avg(carbohydrate_g) AS carbs_target_g, avg(total_fat_g) AS fat_target_g FROM (
    SELECT v.user_id, e.calories, e.protein_g, e.carbohydrate_g, e.total_fat_g,
      row_number() OVER (PARTITION BY v.user_id ORDER BY v.date DESC, v.l_orderkey DESC, v.l_linenumber DESC, v.recipe_id DESC) AS rn
    FROM labeled v JOIN enriched e ON v.recipe_id = e.recipe_id WHERE v.label = 1) a
  WHERE rn <= 100 GROUP BY user_id) b WHERE n_recent >= 3""")
def q_last_n_positive(spark, sf):
    p = pipeline(spark, sf)
    r = U.last_n_positive(p.labeled, p.enriched)
    return out(r, ["user_id", "n_recent"] + TARGET_COLS)


@register("user_feature_lookup", sql=with_views("interactions", "recipes", "contexts", extra=S.training_ctes() + [
    ("cached", "SELECT * FROM user_features WHERE user_id % 2 = 0"),
    ("recent", """SELECT user_id, avg(calories) AS daily_calorie_target, avg(protein_g) AS protein_target_g,
    avg(carbohydrate_g) AS carbs_target_g, avg(total_fat_g) AS fat_target_g FROM (
    SELECT v.user_id, e.calories, e.protein_g, e.carbohydrate_g, e.total_fat_g,
      row_number() OVER (PARTITION BY v.user_id ORDER BY v.date DESC, v.l_orderkey DESC, v.l_linenumber DESC, v.recipe_id DESC) AS rn
    FROM labeled v JOIN enriched e ON v.recipe_id = e.recipe_id WHERE v.label = 1) a WHERE rn <= 100
    GROUP BY user_id HAVING count(*) >= 3""")]) + """
SELECT x.user_id, CASE WHEN c.user_id IS NOT NULL THEN 'cache' WHEN r.user_id IS NOT NULL THEN 'history' ELSE 'default' END AS source,
""" + ",\n".join(
    f"round(CASE WHEN c.user_id IS NOT NULL THEN c.{t} WHEN r.user_id IS NOT NULL THEN r.{t} ELSE {v} END, 6) AS {t}"
    for t, v in [("daily_calorie_target", 2000.0), ("protein_target_g", 50.0), ("carbs_target_g", 275.0),
                 ("fat_target_g", 65.0)]) + ",\n" + ",\n".join(
    f"CASE WHEN c.user_id IS NOT NULL THEN c.{t} ELSE 0 END AS {t}" for t in DIET_COLS) + """
FROM contexts x LEFT JOIN cached c ON x.user_id = c.user_id LEFT JOIN recent r ON x.user_id = r.user_id""")
def q_user_feature_lookup(spark, sf):
    p = pipeline(spark, sf)
    cached = p.user_features.filter(F.pmod("user_id", F.lit(2)) == 0)
    recent = U.last_n_positive(p.labeled, p.enriched)
    r = U.user_feature_lookup(p.cat.contexts, cached, recent)
    return out(r, ["user_id", "source"] + TARGET_COLS + DIET_COLS)  # components have no SQL; a test has them


@register("meal_context", sql=with_views("request_log") + """
SELECT request_id, CASE WHEN hour(ts) >= 5 AND hour(ts) < 10 THEN 'breakfast' WHEN hour(ts) >= 10 AND hour(ts) < 14 THEN 'lunch'
  WHEN hour(ts) >= 18 AND hour(ts) < 22 THEN 'dinner' ELSE 'snack' END AS meal_context FROM request_log""")
def q_meal_context(spark, sf):
    return Catalog(spark, sf).request_log.select("request_id", X.meal_context("ts").alias("meal_context"))


@register("rule_explanation", sql=with_views("interactions", "recipes", extra=S.training_ctes()) + """
SELECT user_id, recipe_id, l_orderkey, l_linenumber, l_suppkey, 'This recipe was recommended because: ' ||
  CASE WHEN len(r) > 0 THEN array_to_string(r, ', ') ELSE 'it matches your overall preferences.' END AS explanation
FROM (SELECT *, list_filter([CASE WHEN coalesce(avg_rating, 0.0) >= 4.0 THEN 'high community rating' END,
  CASE WHEN coalesce(calories, 9999.0) <= coalesce(daily_calorie_target, 9999.0) * 1.1 THEN 'fits your calorie target' END,
  CASE WHEN coalesce(user_vegetarian, 0) <> 0 THEN 'matches your vegetarian preference' END], lambda x: x IS NOT NULL) AS r
  FROM training) t""")
def q_rule_explanation(spark, sf):
    t = pipeline(spark, sf).training
    return C.rule_explanation(t).select("user_id", "recipe_id", "l_orderkey", "l_linenumber", "l_suppkey",
                                        "explanation")


@register("replay_window", sql=with_views("interactions") + """
SELECT user_id, recipe_id, l_orderkey, l_linenumber, l_suppkey, strftime(date, '%Y-%m-%d') AS day FROM interactions
WHERE date >= (SELECT max(date) FROM interactions) - INTERVAL 30 DAY""")
def q_replay_window(spark, sf):
    i = Catalog(spark, sf).interactions
    r = T.replay_window(i, 30)
    return r.select("user_id", "recipe_id", "l_orderkey", "l_linenumber", "l_suppkey", "day")
