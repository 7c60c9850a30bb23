"""Attribution as a bounded stream, with the late rows in a side table."""

import datetime as dt
import random
import time

from pyspark.sql import functions as F

from pantry.operators import monitor as M
from pantry.streaming import monitor as SM

T0 = dt.datetime(2024, 1, 1)
EVENTS = "kind string, event_id long, request_id long, recipe_id long, ts timestamp, model_version string, score double"


def events(rng, hours):
    rows = []
    for i in range(hours * 12):
        t = T0 + dt.timedelta(minutes=5 * i, seconds=rng.randint(0, 200))
        rows.append(("served", None, i, i % 50, t, "v1", i / 7))
        if rng.random() < 0.6:
            rows.append(("feedback", i, i, i % 50, t + dt.timedelta(minutes=rng.choice([0, 3, 59, 61])), None, None))
    return rows


def sides(frame):
    feedback = frame.where("kind = 'feedback'").select("event_id", "request_id", "recipe_id", F.col("ts").alias("feedback_ts"))
    return feedback, frame.where("kind = 'served'").select("request_id", "recipe_id", "ts", "model_version", "score")


def run(spark, tmp_path, files):
    src = str(tmp_path / f"in{len(files)}-{random.random()}")
    for rows in files:
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(src)
        time.sleep(0.02)
    stream = lambda: spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(src).withWatermark("ts", "2 hours")
    end = SM.never("ts")
    feedback = stream().where((F.col("kind") == "feedback") | end).select("event_id", "request_id", "recipe_id", F.col("ts").alias("feedback_ts"))
    served = stream().where((F.col("kind") == "served") | end).select("request_id", "recipe_id", "ts", "model_version", "score")
    progress = []
    joined = SM.feedback_attribution_stream(feedback, served, 3600)
    return spark.read.schema(EVENTS).parquet(src).where("kind <> 'end'"), SM.run_append(spark, joined, "feedback-test", progress), progress


def by_day(rows, hours):
    return [[r for r in rows if lo <= r[4] < lo + dt.timedelta(hours=4)] for lo in (T0 + dt.timedelta(hours=h) for h in range(0, hours + 4, 4))]


END = [("end", -1, -1, -1, T0 + dt.timedelta(days=30), None, None)]


def test_state_is_bounded_and_late_rows_are_kept(spark, tmp_path):
    most = []
    for hours in (24, 48):
        rows = events(random.Random(1), hours)
        files = [f for f in by_day(rows, hours) if f]
        whole, done, progress = run(spark, tmp_path, [*files, END])
        feedback, served = sides(whole)
        want = sorted(map(str, M.feedback_attribution(feedback, served, 3600).select(*done.columns).collect()))
        assert sorted(map(str, done.collect())) == want and SM.late_attribution(feedback, served, done).count() == 0
        most.append(max(p[0] for p in progress))
    assert most[1] < 1.3 * most[0]  # twice the stream, no more state
    # one feedback and one served row come ten hours late
    held = [next(r for r in rows[20:] if r[0] == k and r[4] < T0 + dt.timedelta(hours=8)) for k in ("feedback", "served")]
    held[1] = next(r for r in rows if r[0] == "served" and r != held[1] and any(
        x[0] == "feedback" and x[2] == r[2] and x != held[0] and x[4] - r[4] <= dt.timedelta(hours=1) for x in rows))
    files = [[r for r in f if r not in held] for f in files]
    whole, done, progress = run(spark, tmp_path, [*files[:6], files[6] + held, *files[7:], END])
    feedback, served = sides(whole)
    late = SM.late_attribution(feedback, served, done)
    assert sorted(r["late"] for r in late.collect()) == ["feedback", "served"]
    want = sorted(map(str, M.feedback_attribution(feedback, served, 3600).select(*done.columns).collect()))
    assert sorted(map(str, SM.corrected_attribution(done, late).collect())) == want
    assert sum(p[1] for p in progress) >= 2
