"""Registered queries: labels, user features, training table, splits, encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import exprs as X

from .. import vocab
from ..operators import manifest as M
from ..operators import training as T
from ..operators import users as U
from ..sources.io import materialize
from . import sqlparts as S
from .common import split_training, DIET_COLS, DOUBLE_OUT, PC_COLS, TARGET_COLS, TRAIN_OUT, out, pipeline, sql_out
from .registry import register, with_views

V = ("interactions", "recipes")


def _w(*extra):
    return with_views(*V, extra=S.training_ctes() + list(extra))


KEYS = ["user_id", "recipe_id", "l_orderkey", "l_linenumber", "l_suppkey"]


@register("semi_valid_recipes", sql=_w() + "SELECT user_id, recipe_id, l_orderkey, l_linenumber, l_suppkey, label FROM valid")
def q_semi_valid(spark, sf):
    return pipeline(spark, sf).valid.select(*KEYS, "label")


@register("semi_active_users", sql=_w() + "SELECT user_id FROM u_active")
def q_semi_active(spark, sf):
    return U.active_users(pipeline(spark, sf).valid)


_HIST = ["user_id", "recipe_id", "l_orderkey", "l_linenumber", "l_suppkey", "calories", "protein_g",
         "carbohydrate_g", "total_fat_g", "cuisine"]


@register("join_history", sql=_w() + "SELECT " + sql_out(_HIST, set(_HIST[5:9])) + " FROM history")
def q_join_history(spark, sf):
    return out(pipeline(spark, sf).history, _HIST)


@register("user_targets", sql=_w() + "SELECT " + sql_out(["user_id"] + TARGET_COLS, set(TARGET_COLS)) + " FROM u_targets")
def q_user_targets(spark, sf):
    return out(U.user_targets(pipeline(spark, sf).history), ["user_id"] + TARGET_COLS)


@register("user_diet_flags", sql=_w() + "SELECT * FROM u_diet")
def q_user_diet(spark, sf):
    return U.user_diet_flags(pipeline(spark, sf).history)


_MIX = [f"cuisine_{c}" for c in vocab.CUISINES]


@register("user_cuisine_mix", sql=_w() + "SELECT user_id, " + ", ".join(
    f"round(avg(CASE WHEN cuisine = {S.q(c)} THEN 1.0 ELSE 0.0 END), 6) AS cuisine_{c}" for c in vocab.CUISINES)
    + " FROM history WHERE label = 1 GROUP BY user_id")
def q_user_cuisine_mix(spark, sf):
    return out(U.user_cuisine_mix(pipeline(spark, sf).history), ["user_id"] + _MIX)


@register("history_pca")  # statistical: invariants tested in tests/test_users.py
def q_history_pca(spark, sf):
    return out(U.history_pca(U.user_cuisine_mix(pipeline(spark, sf).history)), ["user_id"] + PC_COLS)


@register("user_features", sql=_w() + "SELECT " + sql_out(["user_id"] + TARGET_COLS + DIET_COLS, set(TARGET_COLS))
          + " FROM user_features")
def q_user_features(spark, sf):
    return out(pipeline(spark, sf).user_features, ["user_id"] + TARGET_COLS + DIET_COLS)


@register("training_table", sql=_w() + "SELECT " + sql_out(TRAIN_OUT, DOUBLE_OUT) + " FROM training")
def q_training_table(spark, sf):
    return out(pipeline(spark, sf).training, TRAIN_OUT)


@register("training_table_full")  # all 45 contract features incl. history PCA
def q_training_table_full(spark, sf):
    t = pipeline(spark, sf, with_pca=True).training
    return out(t, TRAIN_OUT + PC_COLS)


_PRUNED = ["recipe_id", "name", "minutes", "n_ingredients", "n_steps", "avg_rating", "n_reviews", "cuisine",
           "calories", "protein_g"]


@register("column_prune_training", sql=_w() + "SELECT " + sql_out(_PRUNED, {"avg_rating", "calories", "protein_g"})
          + " FROM (SELECT * EXCLUDE (tags, ingredients, description, allergens) FROM enriched)")
def q_column_prune(spark, sf):
    pruned = T.column_prune_training(pipeline(spark, sf).enriched)
    assert not {"tags", "ingredients", "description", "allergens"} & set(pruned.columns)
    return out(pruned, _PRUNED)


@register("label_balance", sql=_w() + """
SELECT CAST(sum(label) AS BIGINT) AS positives, CAST(count(*) - sum(label) AS BIGINT) AS negatives,
  round(avg(label), 6) AS share, count(DISTINCT user_id) AS n_users, count(DISTINCT recipe_id) AS n_recipes
FROM training""")
def q_label_balance(spark, sf):
    t = pipeline(spark, sf).training
    return t.agg(F.sum("label").cast("bigint").alias("positives"),
                 (F.count(F.lit(1)) - F.sum("label")).cast("bigint").alias("negatives"),
                 X.rnd(F.avg("label"), 6).alias("share"),
                 F.countDistinct("user_id").alias("n_users"),
                 F.countDistinct("recipe_id").alias("n_recipes"))


@register("time_split", sql=_w(S.split_cte()) + "SELECT user_id, recipe_id, l_orderkey, l_linenumber, l_suppkey, split FROM splits")
def q_time_split(spark, sf):
    return split_training(pipeline(spark, sf), KEYS).select(*KEYS, "split")


@register("time_split_raw", sql=with_views(*V, extra=[S.split_cte("interactions")])
          + "SELECT user_id, recipe_id, l_orderkey, l_linenumber, l_suppkey, split FROM splits")
def q_time_split_raw(spark, sf):
    """Split of all raw interactions (many rows share a date; exercises the
    boundary-date positioning)."""
    from ..sources.fixtures import Catalog
    return T.time_split(Catalog(spark, sf).interactions).select(*KEYS, "split")


@register("split_by_days", sql=_w() + """
SELECT user_id, recipe_id, l_orderkey, l_linenumber, l_suppkey,
  CASE WHEN date < m - INTERVAL 14 DAY THEN 'train' WHEN date < m - INTERVAL 7 DAY THEN 'test' ELSE 'val' END AS split
FROM training, (SELECT max(date) AS m FROM training) mx""")
def q_split_by_days(spark, sf):
    return T.split_by_days(pipeline(spark, sf).training).select(*KEYS, "split")


@register("label_encode", sql=_w(S.split_cte(), ("voc", """
SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS DOUBLE) AS idx
FROM (SELECT DISTINCT coalesce(cuisine, 'unknown') AS v FROM splits WHERE split = 'train') d""")) + """
SELECT s.user_id, s.recipe_id, s.l_orderkey, s.l_linenumber, s.l_suppkey, s.split,
  coalesce(voc.idx, -1.0) AS cuisine
FROM splits s LEFT JOIN voc ON coalesce(s.cuisine, 'unknown') = voc.v""")
def q_label_encode(spark, sf):
    sp = split_training(pipeline(spark, sf), [*KEYS, "cuisine"])
    enc = T.label_encode_column(sp, "cuisine", F.col("split") == "train")
    return enc.select(*KEYS, "split", "cuisine")


_CONTRACT_KEYS = ["user_id", "recipe_id", "l_orderkey", "l_linenumber", "l_suppkey"]


def _contract_sql():
    cols = []
    have = set(TRAIN_OUT)
    for c in vocab.FEATURE_COLUMNS:
        if c == "cuisine":
            cols.append("CAST(0.0 AS DOUBLE) AS cuisine")
        elif c in have:
            cols.append(f"round(coalesce(CAST({c} AS DOUBLE), CAST(0.0 AS DOUBLE)), 6) AS {c}")
        else:
            cols.append(f"CAST(0.0 AS DOUBLE) AS {c}")
    return _w() + "SELECT " + ", ".join(_CONTRACT_KEYS + cols) + " FROM training"


@register("feature_contract", sql=_contract_sql())
def q_feature_contract(spark, sf):
    t = pipeline(spark, sf).training  # without PCA: history_pc* become 0.0 (missing)
    fc = T.feature_contract(t, keep=_CONTRACT_KEYS)
    assert fc.columns[len(_CONTRACT_KEYS):] == vocab.FEATURE_COLUMNS
    return out(fc, fc.columns)


def _manifest_sql():
    """The tree of the manifest: rows, buckets by key, splits."""
    cols = [(c, "timestamp" if c == "date" else "string" if c in ("name", "cuisine") else "bigint") for c in sorted(TRAIN_OUT)]
    keys = [(k, "bigint") for k in T.MANIFEST_KEYS]
    told = ", ".join(f"CAST(floor({c} * 1000000.0 + 0.5) AS BIGINT) AS {c}" if c in DOUBLE_OUT else c for c in TRAIN_OUT)
    row, key = (M.row_text(x, oracle=True) for x in (cols, keys))
    return _w(S.split_cte(), ("b", f"""
SELECT split, CAST(('0x' || substr(md5({key}), 1, 8)) AS BIGINT) % {M.N_BUCKETS} AS bucket, count(*) AS rows,
  sum(CAST(('0x' || substr(md5({row}), 1, 15)) AS BIGINT)) AS digest, min(date) AS a, max(date) AS z, sum(label) AS s, count(label) AS n
FROM (SELECT split, {told} FROM splits) t GROUP BY split, bucket"""), ("m", f"""
SELECT split, CAST(sum(rows) AS BIGINT) AS rows, strftime(min(a), '%Y-%m-%d %H:%M:%S') AS min_date, strftime(max(z), '%Y-%m-%d %H:%M:%S') AS max_date,
  round(CAST(sum(s) AS DOUBLE) / CAST(sum(n) AS DOUBLE), 6) AS label_mean,
  sha256('{",".join(sorted(TRAIN_OUT))}|' || string_agg(bucket || ':' || rows || ':' || digest, '|' ORDER BY bucket)) AS content_hash
FROM b GROUP BY split""")) + """
SELECT m.*, substr(sha256((SELECT string_agg(content_hash, ':' ORDER BY split) FROM m)), 1, 12) AS version FROM m"""


@register("dataset_manifest", sql=_manifest_sql())
def q_dataset_manifest(spark, sf):
    sp = T.time_split(materialize(pipeline(spark, sf).training, "training"))  # read once, so not written again
    # doubles go out in millionths, which two engines sum and write alike
    sp = sp.select(*[F.floor(F.col(c) * 1000000.0 + 0.5).cast("bigint").alias(c) if c in DOUBLE_OUT else c for c in TRAIN_OUT], "split").withColumn("date", F.col("date").cast("timestamp"))
    m = T.dataset_manifest_tagged(sp)
    return m.withColumn("label_mean", X.rnd("label_mean", 6))
