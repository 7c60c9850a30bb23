"""Time bounds reach the scan; moments of one scan."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from pantry.operators import candidates as C
from pantry.operators import drift as D
from pantry.operators import monitor as M
from pantry.operators import training as T
from pantry.operators import users as U
from pantry.sources import io as IO

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log") / "log.parquet")
    rows = [(i, T0 + dt.timedelta(hours=i), 500 if i % 5 == 0 else 200, i % 3, i % 7) for i in range(200)] + [(999, None, 500, 1, 1)]
    spark.createDataFrame(rows, "request_id int, ts timestamp, status int, user_id int, meal_template_id int").write.parquet(path)
    return spark.read.parquet(path)


def scans(frame):
    """Pushed filters of each scan of the plan that ran."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return [line.split("PushedFilters: ")[1].split("], ")[0] for line in plan.splitlines() if "PushedFilters" in line]


def test_bounds_are_pushed(log):
    one = log.agg(F.max("ts").alias("now"))
    state = one.withColumn("last_trigger_at", F.lit(None).cast("timestamp"))
    since = log.agg((F.max("ts") - F.expr("INTERVAL 5 HOURS")).alias("last_ts"))
    frames = {
        "since": (IO.read_since(log, since, "ts"), 5), "lookback": (D.lookback_window(log, state).select("request_id"), 25),
        "failures": (M.failures_in_last(log, one, 3600 * 10), 1), "logged": (C.recently_logged(log, 1, "ts"), None),
        "replay": (T.replay_window(log, 1, "ts"), 25)}
    for name, (frame, n) in frames.items():
        assert any("ts" in s and ("GreaterThan" in s) for s in scans(frame)), name
        assert n is None or frame.count() == n, name
    assert frames["failures"][0].first()["failures"] == sum(i % 5 == 0 for i in range(190, 200))


def test_without_times(spark, log):
    none = log.where("ts is null")
    assert IO.read_since(log, log.agg(F.lit(None).cast("timestamp").alias("last_ts")), "ts").count() == 201
    assert [r["day"] for r in T.replay_window(none, 1, "ts").collect()] == ["undated"]
    assert T.replay_window(log, 1, "ts").where("day = 'undated'").count() == 0


def test_moments_of_one_scan(spark):
    rng = np.random.default_rng(1)
    x = rng.random((500, 5)) * 1e-3 + 1e3
    frame = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)] + [(-1, None, 1.0, 1.0, 1.0, 1.0)],
                                  "user_id int, a double, b double, c double, d double, e double").repartition(7)
    n, mean, products, most = U.merged_moments(frame, list("abcde"))
    about = x - x.mean(0)
    assert n == 500 and np.allclose(mean, x.mean(0), rtol=1e-13) and np.allclose(products, about.T @ about, rtol=1e-9)
    assert np.array_equal(most, x.max(0))
    assert U.merged_moments(frame.limit(0), ["a", "b"])[0] == 0
    mix = frame.where("user_id >= 0").toDF("user_id", *[f"cuisine_{c}" for c in "abcde"])
    got = U.history_pca(mix, 3).orderBy("user_id").toPandas()[["history_pc1", "history_pc2", "history_pc3"]].to_numpy()
    _, vectors = np.linalg.eigh(about.T @ about)
    loadings = vectors[:, ::-1][:, :3]
    loadings = loadings * np.sign(loadings[np.abs(loadings).argmax(0), range(3)])
    assert np.allclose(got, about @ loadings, atol=1e-9)
