"""Alerts as a state machine against gaps and islands."""

import datetime as dt
import random
import time

from pyspark.sql import functions as F

from pantry.operators import monitor as M
from pantry.streaming import alerts as SA
from pantry.streaming import monitor as SM

T0 = dt.datetime(2024, 1, 1)


def test_events_equal_the_batch(spark, tmp_path):
    rng, src = random.Random(1), str(tmp_path / "in")
    schema = "ts timestamp, status int, v string"
    rows = []
    for v in "ab":
        for w in range(200):
            if rng.random() < 0.8:
                bad = rng.random() < 0.7
                rows += [(T0 + dt.timedelta(minutes=5 * w, seconds=rng.randint(0, 299)), 500 if bad else 200, v) for _ in range(rng.randint(1, 3))]
    rows.sort()
    for i in range(0, len(rows), 60):
        spark.createDataFrame(rows[i:i + 60], schema).coalesce(1).write.mode("append").parquet(src)
        time.sleep(0.02)
    log = spark.read.schema(schema).parquet(src)
    batch = M.sustained(log.groupBy(F.window("ts", "5 minutes"), "v").agg(F.max("status").alias("s")).select(
        F.col("window.start").alias("window_start"), "v", (F.col("s") >= 500).alias("firing")), 300, 600, ["v"])
    want = {(r["v"], r["island_start"], r["island_last"], r["n_windows"], r["fired"]) for r in batch.collect()}
    spark.createDataFrame([(T0 + dt.timedelta(days=9), 200, "end")], schema).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src).withWatermark("ts", "10 minutes")
    windows = stream.groupBy(F.window("ts", "5 minutes"), "v").agg(F.max("status").alias("s")).select(
        F.col("window.start").alias("window_start"), "v", (F.col("s") >= 500).alias("firing"))
    events = SM.run_append(spark, SA.sustained(windows, F.col("firing"), 300, 600, F.col("v")), "alert-test").collect()
    got = [(r["series"], r["island_start"], r["island_last"], r["n_windows"], r["fired"]) for r in events if r["event"] == "resolved"]
    assert len(got) == len(set(got)) and set(got) == want and any(w[4] for w in want)
    count = lambda e: sum(r["event"] == e for r in events)
    assert count("pending") == len(want) and count("firing") == sum(w[4] for w in want)
