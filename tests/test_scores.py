"""Scores from the shared interactions, joined to the test rows."""

import re

from pantry.operators import evaluate as EV
from pantry.plans.q_eval import asked
from pantry.sources import fixtures as FX

LINES = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_shipdate date"


def views(spark):
    lines = spark.createDataFrame([(k % 5 if k % 7 else None, k % 4 if k % 9 else None, 1, k, 3.0, None) for k in range(60)] * 2, LINES)
    orders = spark.createDataFrame([(0, 3, None), (1, 3, None), (1, 4, None), (2, None, None), (3, 7, None), (None, 8, None)],
                                   "o_orderkey long, o_custkey long, o_orderdate date")
    return (spark.sql(FX.VIEW_SQL[v], **{t: f for t, f in (("lineitem", lines), ("orders", orders))}) for v in ("interactions", "scores"))


def test_scores_of_interactions_are_the_view(spark):
    interactions, scores = views(spark)
    got = FX.scores_of(interactions)
    assert got.columns == scores.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, scores.collect())) != []


def test_scores_are_dealt_out_once_and_every_test_row_stays(spark):
    interactions, scores = views(spark)
    test = spark.createDataFrame([(3, 0, 1), (3, 0, 1), (4, 2, 0), (99, 1, 1), (None, 1, 0), (3, None, 1)], "user_id long, recipe_id long, label int")
    known = {(r["user_id"], r["recipe_id"]): r["score"] for r in scores.collect() if None not in (r["user_id"], r["recipe_id"])}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables too large for it
    try:
        got = EV.join_scores(test, FX.scores_of(asked(interactions, test)))
        plan = got._jdf.queryExecution().executedPlan().toString()
        rows = got.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert not re.search(r"hashpartitioning\(user_id#\w+, recipe_id#\w+, score", plan)
    assert sorted(map(str, [(r["user_id"], r["recipe_id"], r["label"], r["score"]) for r in rows])) == sorted(
        map(str, [(u, i, y, known.get((u, i))) for u, i, y in test.collect()]))


def test_rows_kept_for_a_split_give_all_of_it(spark):
    """Uneven days, boundary days of many rows, a day both splits end in, rows without a date."""
    from pyspark.sql import functions as F

    from pantry.operators import training as T

    for days in ([k % 12 for k in range(240)], [0 if k % 3 else 1 + k % 5 for k in range(200)], [None if k % 7 == 0 else k % 3 for k in range(150)], [0] * 40, []):
        data = [(None if d is None else f"2020-01-{d + 1:02d}", k, k % 5) for k, d in enumerate(days)]
        df = spark.createDataFrame(data, "d string, k int, x int").select(F.to_timestamp("d").alias("date"), "k", "x")
        counted = T.split_days(df.select("date"))
        whole = T.time_split(df, ["date", "k"])
        for split in ("train", "val", "test"):
            kept = T.rows_for_split(df, counted, split)
            assert kept.columns == df.columns
            got = T.time_split(kept, ["date", "k"], days=counted).where(F.col("split") == split)
            assert sorted(map(repr, got.collect())) == sorted(map(repr, whole.where(F.col("split") == split).collect()))
        if len(set(days)) == 12:
            assert T.rows_for_split(df, counted, "test").count() <= len(days) // 3


def test_train_rows_are_counted_and_not_written_for_a_ranking(spark, monkeypatch):
    from pyspark.sql import functions as F

    from pantry.operators import training as T
    from pantry.plans import common as C
    from pantry.plans import q_eval as Q

    sf = "/root/testdata/sf0.001"
    written = {}

    def recorded(df, name, write=C.materialize):
        written[name] = write(df, name)
        return written[name]

    monkeypatch.setattr(C, "materialize", recorded)
    got = Q.scored_test(spark, sf, ["user_vegan", "has_milk"])
    p = C.pipeline(spark, sf)
    want = T.time_split(p.training).where(F.col("split") == "test")
    cols = ["user_id", "label", "user_vegan", "has_milk", *T.ORDER_KEYS]
    assert sorted(map(repr, got.select(*cols).collect())) == sorted(map(repr, want.select(*cols).collect())) != []
    assert written["training"].count() < 0.2 * p.training.count()
