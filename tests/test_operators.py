"""Operator invariants: time split, plan shapes, partition invariance, KS,
PCA, evaluation, candidate generation."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pantry.operators import drift as D
from pantry.operators import evaluate as EV
from pantry.operators import training as T
from pantry.operators import users as U
from pantry.sources.fixtures import Catalog


def _positions(df, keys):
    w = Window.orderBy(*keys)
    n = df.count()
    te, ve = int(n * 0.8), int(n * (0.8 + 0.1))
    g = df.withColumn("_p", F.row_number().over(w) - 1)
    return g.withColumn("exp", F.when(F.col("_p") < te, "train").when(F.col("_p") < ve, "val").otherwise("test"))


def test_time_split_equals_global_row_number(spark):
    i = Catalog(spark, SF_SMALL).interactions
    got = T.time_split(i)
    exp = _positions(i, T.ORDER_KEYS)
    keys = ["l_orderkey", "l_linenumber", "recipe_id", "l_suppkey", "l_shipdate"]
    j = got.join(exp.select(*keys, "exp"), keys)
    assert j.count() == i.count()
    assert j.filter(F.col("split") != F.col("exp")).count() == 0


@pytest.mark.parametrize("method", ["buckets", "sort"])
def test_time_split_hot_date(spark, method):
    """One date holding most rows: boundary positions still exact (both methods)."""
    rows = [(f"2020-01-0{1 + (k % 3 == 0)}", k) for k in range(500)]
    df = spark.createDataFrame(rows, "d string, k int").withColumn("date", F.to_timestamp("d")).drop("d")
    got = T.time_split(df, ["date", "k"], method=method, n_buckets=16)
    exp = _positions(df, ["date", "k"])
    j = got.join(exp.select("k", "exp"), "k")
    assert j.filter(F.col("split") != F.col("exp")).count() == 0


def test_partition_count_invariance(spark):
    from pantry.plans.common import pipeline
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    a = sorted(map(tuple, T.time_split(pipeline(spark, SF_SMALL).training).select(
        "user_id", "recipe_id", "l_orderkey", "l_linenumber", "split").collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    b = sorted(map(tuple, T.time_split(pipeline(spark, SF_SMALL).training).select(
        "user_id", "recipe_id", "l_orderkey", "l_linenumber", "split").collect()))
    assert a == b


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rule_candidates_has_no_nested_loop(spark):
    from pantry.plans.q_candidates import _rule_spark
    _, c = _rule_spark(spark, SF_SMALL)
    plan = _plan(c)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_time_split_plan_has_no_cartesian(spark):
    i = Catalog(spark, SF_SMALL).interactions
    assert "CartesianProduct" not in _plan(T.time_split(i))


def test_ks_statistic_matches_numpy(spark):
    rng = np.random.default_rng(0)
    a = rng.normal(0, 1, 400).round(2)
    b = rng.normal(0.3, 1, 300).round(2)
    base = spark.createDataFrame([(float(x),) for x in a], "f double")
    live = spark.createDataFrame([(float(x),) for x in b], "f double")
    r = D.ks_drift(base, live, ["f"], n_buckets=8).first()
    vals = np.sort(np.unique(np.concatenate([a, b])))
    cdf_a = np.searchsorted(np.sort(a), vals, side="right") / len(a)
    cdf_b = np.searchsorted(np.sort(b), vals, side="right") / len(b)
    d = np.max(np.abs(cdf_a - cdf_b))
    assert abs(r.ks_statistic - round(d, 4)) < 1e-9
    assert r.tested and 0.0 <= r.p_value <= 1.0


def test_ks_insufficient_data_not_tested(spark):
    base = spark.createDataFrame([(1.0,), (2.0,)], "f double")
    live = spark.createDataFrame([(1.0,)], "f double")
    r = D.ks_drift(base, live, ["f"]).first()
    assert not r.tested and r.ks_statistic is None and not r.drift_detected


def test_history_pca_invariants(spark):
    from pantry.plans.common import pipeline
    p = pipeline(spark, SF_SMALL)
    mix = U.user_cuisine_mix(p.history)
    pcs = U.history_pca(mix).toPandas().sort_values("user_id")
    m = mix.toPandas().sort_values("user_id")
    x = m[[c for c in m.columns if c.startswith("cuisine_")]].to_numpy()
    x = x[:, x.max(axis=0) > 0]
    xc = x - x.mean(axis=0)
    _, s, vt = np.linalg.svd(xc, full_matrices=False)
    k = min(6, x.shape[1], x.shape[0])
    ref = xc @ vt[:k].T
    got = pcs[[f"history_pc{i + 1}" for i in range(k)]].to_numpy()
    assert np.allclose(np.abs(got.mean(axis=0)), 0, atol=1e-8)           # centred
    var = got.var(axis=0)
    assert all(var[i] >= var[i + 1] - 1e-9 for i in range(k - 1))        # non-increasing variance
    for j in range(k):                                                    # equal to SVD up to sign
        if s[j] > 1e-6 and (j == k - 1 or abs(s[j] - s[j + 1]) > 1e-6):
            assert np.allclose(np.abs(got[:, j]), np.abs(ref[:, j]), atol=1e-6)


def test_ndcg_known_values(spark):
    df = spark.createDataFrame([(1, 10, 1, 0.9), (1, 11, 0, 0.8), (1, 12, 1, 0.1), (2, 20, 0, 0.5)],
                               "user_id int, recipe_id int, label int, score double")
    per = {r.user_id: r.ndcg for r in EV.ndcg_per_user(df).collect()}
    import math
    dcg = 1 / math.log2(2) + 1 / math.log2(4)
    idcg = 1 / math.log2(2) + 1 / math.log2(3)
    assert abs(per[1] - dcg / idcg) < 1e-12 and per[2] == 0.0  # zero-ideal user counts as 0
    assert abs(EV.ndcg_exp(df).first().ndcg_at_10 - (dcg / idcg) / 2) < 1e-12


def test_popularity_and_gates(spark):
    train = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (3, 0)], "recipe_id int, label int")
    pop = {r.recipe_id: r.score for r in EV.popularity(train).collect()}
    assert pop == {1: 1.0, 2: 0.5, 3: 0.0}
    runs = spark.createDataFrame([(1, 0.6, True, False), (2, 0.7, True, True), (3, 0.695, False, False)],
                                 "run_id int, ndcg_at_10 double, fairness_passed boolean, is_production boolean")
    g = {r.run_id: r for r in EV.model_gates(runs, 0.55, 0.01).collect()}
    assert not g[1].improvement_passed and g[3].improvement_passed and not g[3].all_passed


def test_synthetic_expand_invariants(spark):
    from pantry.operators import ml as ML
    r = Catalog(spark, SF_SMALL).recipes
    out = ML.synthetic_expand(r, seed=3)
    n = r.count()
    assert out.count() == 2 * n
    syn = out.filter("is_synthetic")
    assert syn.select("recipe_id").distinct().count() == n
    assert syn.agg(F.min("recipe_id")).first()[0] == r.agg(F.max("recipe_id")).first()[0] + 1
    assert syn.filter((F.col("minutes") < 1) | (F.col("n_steps") < 1)).count() == 0
    assert syn.filter(F.col("name").isNotNull() & ~F.col("name").startswith("[Synthetic] ")).count() == 0
    again = ML.synthetic_expand(r, seed=3).filter("is_synthetic")
    assert sorted(map(tuple, syn.collect())) == sorted(map(tuple, again.collect()))


def test_time_split_fine_timestamps(spark):
    """Second-resolution event times (many per day, some equal): exact split."""
    rows = [(f"2021-03-0{1 + k % 3} {k % 24:02d}:{(k * 7) % 60:02d}:{(k * 13) % 60:02d}", k) for k in range(700)]
    df = spark.createDataFrame(rows, "d string, k int").withColumn("date", F.to_timestamp("d")).drop("d")
    for method in ("buckets", "sort"):
        got = T.time_split(df, ["date", "k"], method=method)
        exp = _positions(df, ["date", "k"])
        assert got.join(exp.select("k", "exp"), "k").filter(F.col("split") != F.col("exp")).count() == 0


def test_rank_within_group_hot_group(spark):
    from pantry.operators import ml as ML
    rows = [(0 if k % 4 else k % 7, k, float((k * 37) % 101)) for k in range(900)]  # group 0 holds ~3/4
    df = spark.createDataFrame(rows, "g int, k int, s double")
    got = ML.rank_within_group(df, ["g"], [F.desc("s"), F.asc("k")])
    w = Window.partitionBy("g").orderBy(F.desc("s"), F.asc("k"))
    exp = df.withColumn("exp", F.row_number().over(w))
    assert got.join(exp, ["g", "k"]).filter(F.col("rank") != F.col("exp")).count() == 0


def test_null_profile_sampled_mode(spark):
    from pantry.operators import quality as Q
    rows = [(k, None if k >= 10 else "x") for k in range(40)]
    df = spark.createDataFrame(rows, "k int, v string")
    full = {r.column_name: r for r in Q.null_profile(df, "t").collect()}
    head = {r.column_name: r for r in Q.null_profile(df, "t", sample_first=10, order_cols=["k"]).collect()}
    assert full["v"].null_rate == 0.75 and full["v"].flagged and not full["v"].enough_rows
    assert head["v"].null_rate == 0.0 and not head["v"].flagged


def test_training_rows_are_not_moved_to_be_split(spark):
    """A row's day is looked up in a broadcast table; only rows of boundary days are sorted."""
    from pantry.plans.common import pipeline, split_training
    p = pipeline(spark, SF_SMALL)
    sp = split_training(p, ["cuisine"])
    assert "cuisine" in sp.columns and "calories" not in sp.columns
    again = split_training(p).select(*sp.columns)
    assert sorted(map(repr, sp.collect())) == sorted(map(repr, again.collect()))
    above = _plan(again).split("FileScan parquet")[0]  # from the union down to the scan of the days inside one split
    assert "BroadcastHashJoin" in above and "Exchange hashpartitioning" not in above


def test_training_table_columns_keep_their_order(spark):
    from pantry.operators import training as T
    from pantry.plans.common import pipeline
    p = pipeline(spark, SF_SMALL)
    cols = p.training.columns
    assert cols[:5] == ["user_id", "recipe_id", "date", "rating", "label"]
    assert cols[-10:] == p.user_features.columns[1:]
    old = p.valid.join(T.recipe_features(p.enriched), "recipe_id").join(p.user_features, "user_id")
    keys = ["user_id", "recipe_id", "l_orderkey", "l_linenumber", "l_suppkey", "calories", "daily_calorie_target"]
    assert old.select(keys).exceptAll(p.training.select(keys)).count() == 0 and old.count() == p.training.count()


def test_requests_are_dealt_out_before_the_range_join(spark):
    """All requests in one file part must not mean that one task lists all pairs."""
    from pyspark.sql import functions as F
    from pantry.operators import candidates as C
    req = spark.range(200).selectExpr("id AS request_id", "600 AS calorie_target", "60 AS time_limit").coalesce(1)
    rec = spark.range(50).selectExpr("id AS recipe_id", "500.0D AS calories", "10 AS minutes")
    pairs = C.rule_candidates(req, rec)
    assert pairs.count() == 200 * 50
    assert pairs.select(F.spark_partition_id()).distinct().count() > 4
