"""Rolling ranges at every step against counting anew."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pantry.operators import monitor as M
from pantry.operators import rolling as R

T0 = dt.datetime(2024, 1, 1)


def log_of(spark, rows):
    return spark.createDataFrame(rows, "ts timestamp_ntz, status int, v string").withColumn("ts", F.col("ts").cast("timestamp"))


def now_at(spark, t):
    return spark.createDataFrame([(t,)], "now timestamp_ntz").select(F.col("now").cast("timestamp").alias("now"))


@pytest.mark.parametrize(("range_s", "step"), [(300, 60), (60, 60), (600, 30)])
def test_rolling_counts(spark, range_s, step):
    rng = random.Random(range_s)
    rows = [(T0 + dt.timedelta(seconds=rng.choice([rng.randint(0, 3000), rng.randint(6000, 6500)])), rng.choice([200, 200, 500]), rng.choice("ab"))
            for _ in range(120)] + [(None, 200, "a"), (T0 + dt.timedelta(hours=9), 500, "a")]
    now = T0 + dt.timedelta(hours=3, seconds=11)
    found = R.rolling_counts(log_of(spark, rows), now_at(spark, now), {"n": F.lit(True), "x": F.col("status") >= 500}, range_s, step, ["v"])
    got = {(r["v"], r["at"]): (r["n"], r["x"]) for r in R.at_steps(found, step).withColumn("at", F.col("at").cast("timestamp_ntz")).collect()}
    want = {}
    for v in "ab":
        own = [(t, s) for t, s, w in rows if t and w == v and t <= now]
        at = min(t for t, _ in own)
        at = T0 + dt.timedelta(seconds=((at - T0).total_seconds() // step + 1) * step)
        while at <= now:
            seen = [s for t, s in own if at - dt.timedelta(seconds=range_s) <= t < at]
            want[v, at] = (len(seen), sum(s >= 500 for s in seen))
            at += dt.timedelta(seconds=step)
    assert got == want
    ordered = sorted((r["v"], r["at_start"], r["n"], r["x"]) for r in found.collect())
    assert all(a[0] != b[0] or a[2:] != b[2:] for a, b in zip(ordered, ordered[1:]))  # noqa: B905


def test_outage_after_the_last_event_fires(spark):
    log = log_of(spark, [(T0 + dt.timedelta(minutes=i), 200, "a") for i in range(30)])
    def runs(now):
        r = R.rolling_counts(log, now_at(spark, now), {"n": F.lit(True)}, 600, series=["v"])
        return [(x["fired"], x["last_at"] - x["pending_at"]) for x in R.firing_for(r, F.col("n") == 0, 600, ["v"]).collect()]
    assert runs(T0 + dt.timedelta(minutes=30)) == []
    assert runs(T0 + dt.timedelta(minutes=45)) == [(False, dt.timedelta(minutes=5))]
    assert runs(T0 + dt.timedelta(minutes=55)) == [(True, dt.timedelta(minutes=15))]
    zero = M.throughput(log, 600, "v", now=now_at(spark, T0 + dt.timedelta(minutes=55))).where("zero_traffic")
    assert zero.count() == 3 and M.throughput(log, 600, "v").where("zero_traffic").count() == 0


def test_nothing_and_ages(spark):
    log = log_of(spark, [])
    now = now_at(spark, T0)
    assert R.rolling_counts(log, now, {"n": F.lit(True)}, 300).collect() == []
    lasts = spark.createDataFrame([(T0 - dt.timedelta(seconds=301), T0 - dt.timedelta(seconds=86400), None)], "a timestamp_ntz, b timestamp_ntz, c timestamp_ntz")
    got = {r["series"]: (r["age_s"], r["stale"]) for r in R.ages(lasts, now, {"a": 300, "b": 86400, "c": 5}).collect()}
    assert got == {"a": (301, True), "b": (86400, False), "c": (None, True)}
    with pytest.raises(ValueError, match="whole steps"):
        R.rolling_counts(log, now, {}, 90, 60)
