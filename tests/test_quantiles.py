"""Exact quantiles between sketched brackets."""

import math
import random

import pytest
from pyspark.sql import functions as F

from pantry.operators import monitor as M
from pantry.operators import quantiles as QN


@pytest.mark.parametrize("accuracy", [20, 200, 10_000])
def test_equal_to_percentile(spark, accuracy):
    rng = random.Random(accuracy)
    rows = [(rng.choice("ab"), rng.gauss(0, 1)) for _ in range(3000)]
    rows += [("ties", float(rng.randint(0, 3))) for _ in range(2000)] + [("one", 5.0), (None, 1.0), (None, 2.0), ("none", None), ("a", None)]
    rows += [("hot", 7.0)] * 4000 + [("hot", 8.0), ("hot", math.inf), ("hot", -math.inf)]
    frame = spark.createDataFrame(rows, "g string, x double").repartition(7)
    qs = [0.0, 0.01, 0.5, 0.95, 0.99, 1.0]
    got = {r["g"]: (r["n"], r["quantiles"]) for r in QN.exact_quantiles(frame, ["g"], "x", qs, [F.count(F.lit(1)).alias("n")], accuracy).collect()}
    want = {r["g"]: (r["n"], r["q"]) for r in frame.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.percentile("x", qs).alias("q")).collect()}
    assert set(got) == set(want)
    for g, (n, q) in want.items():
        assert got[g][0] == n and (got[g][1] is None) == (q is None)
        assert q is None or all(math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-15) for a, b in zip(got[g][1], q, strict=True)), g


def test_without_groups_and_rows(spark):
    frame = spark.range(1, 102).select(F.col("id").cast("int").alias("x"))
    assert QN.exact_quantiles(frame, [], "x", [0.5, 0.99]).first()["quantiles"] == [51.0, 100.0]
    assert QN.exact_quantiles(frame.limit(0), [], "x", [0.5]).first()["quantiles"] is None
    assert QN.exact_quantiles(frame.withColumn("g", F.lit(1)).limit(0), ["g"], "x", [0.5]).collect() == []


def test_a_bad_bracket_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(QN, "MARGIN", -40)
    frame = spark.range(10_000).select(F.col("id").cast("double").alias("x"))
    with pytest.raises(Exception, match="outside its bracket"):
        QN.exact_quantiles(frame, [], "x", [0.5], accuracy=100).collect()


def test_no_exact_percentile_in_the_plans(spark):
    log = spark.createDataFrame([(0, None, 1.0, 0.5, 200, "v1")], "request_id int, ts timestamp, latency_s double, score double, status int, model_version string")
    log = log.withColumn("ts", F.to_timestamp(F.lit("2024-01-01 00:03:00")))
    for frame in (M.p95_latency(log), M.median_score(log), M.score_quantiles(log), M.latency_percentiles(log)):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "percentile(" not in plan and "percentile_approx(" in plan
        assert frame.count() == 1
