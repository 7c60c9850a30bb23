"""The drift loop as a stream against a plain replay; its restart, late rows, skips and triggers."""

import datetime as dt
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from pantry import vocab
from pantry.streaming import drift as SD

T0 = dt.datetime(2024, 1, 1)
HOUR = dt.timedelta(hours=1)
SCHEMA = "request_id long, ts timestamp, a double, b double"


def day_rows(rng, day, n, shift=0.0):
    return [(i, T0 + dt.timedelta(days=day, seconds=round(float(rng.random() * 86399), 3)), float("nan") if i % 17 == 0 else float(rng.normal() + shift),
             None if i % 13 == 0 else float(rng.integers(0, 9) + round(3 * shift))) for i in range(n)]


def replay(rows, base, until):
    """Checks at the end of each hour up to ``until``, one after the other."""
    out, trigger = [], None
    at = min(r[1] for r in rows).replace(minute=0, second=0, microsecond=0) + HOUR
    while at <= until:
        if any(at - 24 * HOUR <= r[1] < at for r in rows):
            start = max(at - 24 * HOUR, trigger or at - 24 * HOUR)
            window = [r for r in rows if start <= r[1] < at]
            if len(window) < 100:
                out.append((at, start, "summary", len(window), None, None, None, True, None, False))
            else:
                drifted = 0
                for i, f in enumerate("ab"):
                    live = np.array([r[2 + i] for r in window if r[2 + i] is not None and not np.isnan(r[2 + i])])
                    x = np.concatenate([base[f], live])
                    d = np.abs((base[f][None] <= x[:, None]).sum(1) / len(base[f]) - (live[None] <= x[:, None]).sum(1) / len(live)).max()
                    p = SD.p_value(d, len(base[f]), len(live))
                    found = bool(p < vocab.KS_P_THRESHOLD and d >= vocab.KS_MIN_STATISTIC)
                    drifted += found
                    out.append((at, start, "feature", len(window), f, len(live), SD.half_up(float(d), 4), False, found, None))
                if drifted / 2 > vocab.DRIFT_SHARE:
                    trigger = at
                out.append((at, start, "summary", len(window), None, None, None, False, None, trigger == at))
        at += HOUR
    return out


def seen(log):
    cols = ["check_at", "window_start", "kind", "n_rows", "feature", "n_live", "ks_statistic", "skipped", "drift_detected", "triggered"]
    return [tuple(r) for r in log.select(F.col("check_at").cast("timestamp_ntz"), F.col("window_start").cast("timestamp_ntz"), *cols[2:]).collect()]


def order(rows):
    return sorted(rows, key=lambda r: (r[0], r[2], r[4] or ""))


@pytest.fixture(scope="module")
def base(spark):
    rng = np.random.default_rng(1)
    rows = [(float(x), float(y)) for x, y in zip(rng.normal(size=400), rng.integers(0, 9, 400), strict=True)]
    return spark.createDataFrame(rows, "a double, b double"), {"a": np.array([r[0] for r in rows]), "b": np.array([r[1] for r in rows])}


def test_stream_equals_replay_and_restarts(spark, tmp_path, base):
    rng = np.random.default_rng(2)
    days = [day_rows(rng, d, n, s) for d, (n, s) in enumerate([(300, 0), (250, 0), (300, 2), (40, 0), (200, 0.1)])]
    days.append(day_rows(rng, 8, 150, 1))  # after days without a row
    rows = [r for d in days for r in d]
    values = SD.baseline_values(base[0], ["a", "b"])
    src, out = str(tmp_path / "in"), str(tmp_path / "log")

    def run(some):
        for d in some:
            spark.createDataFrame(d, SCHEMA).coalesce(2).write.mode("append").parquet(src)
            time.sleep(0.05)
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 2).parquet(src).withWatermark("ts", "1 day")
        return SD.run_checks(spark, SD.checks(stream, values), out, str(tmp_path / "ckpt"))

    first = seen(run(days[:2]))
    assert first
    marker = [(-1, T0 + dt.timedelta(days=40), None, None)]
    got = seen(run([*days[2:], marker]))
    want = replay(rows, base[1], T0 + dt.timedelta(days=39))
    assert order(got) == order(want)
    assert set(first) <= set(got)
    summaries = [r[0] for r in got if r[2] == "summary"]
    assert len(summaries) == len(set(summaries)) and any(r[9] for r in got) and any(r[7] for r in got)
    trigger = spark.read.parquet(out).where("triggered").agg(F.max("check_at")).first()[0]
    assert SD.last_trigger(spark, out).first()[0] == trigger


def test_late_rows_are_counted(spark, tmp_path, base):
    rng = np.random.default_rng(3)
    src = str(tmp_path / "in")
    late = [(i, T0 + dt.timedelta(hours=20, minutes=i), 0.0, 1.0) for i in range(7)]
    for rows in (day_rows(rng, 0, 200), [(1, T0 + dt.timedelta(days=1, hours=6), 0.0, 1.0)], [(2, T0 + dt.timedelta(days=1, hours=6), 0.0, 1.0)], late,
                 [(-1, T0 + dt.timedelta(days=9), None, None)]):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        time.sleep(0.05)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src).withWatermark("ts", "1 hour")
    log = SD.run_checks(spark, SD.checks(stream, SD.baseline_values(base[0], ["a", "b"])), str(tmp_path / "log"))
    rows = log.where("kind = 'summary'").select(F.col("check_at").cast("timestamp_ntz").alias("t"), "n_rows", "n_late").orderBy("t").collect()
    assert sum(r["n_late"] for r in rows) == 7
    at = next(i for i, r in enumerate(rows) if r["n_late"])
    assert rows[at]["t"] > T0 + dt.timedelta(days=1, hours=5)
    hours = {r["t"]: r["n_rows"] for r in rows}
    assert hours[T0 + dt.timedelta(hours=24)] == 200  # that check came before them; those that follow see them


def test_wide_baselines_are_refused(spark, monkeypatch):
    monkeypatch.setattr(SD, "MOST_VALUES", 5)
    with pytest.raises(ValueError, match="baseline"):
        SD.baseline_values(spark.range(6).selectExpr("cast(id as double) as a"), ["a"])


def test_distance_of_cells():
    rng = np.random.default_rng(4)
    for _ in range(200):
        base, live = rng.integers(0, 12, rng.integers(1, 30)).astype(float), rng.integers(-3, 15, rng.integers(1, 30)) / rng.choice([1, 2])
        values, n = np.unique(base, return_counts=True)
        cells, counts = np.unique(SD.cells_of(values, live), return_counts=True)
        x = np.concatenate([base, live])
        want = np.abs((base[None] <= x[:, None]).mean(1) - (live[None] <= x[:, None]).mean(1)).max()
        assert abs(SD.ks_of_cells(values, np.cumsum(n), cells, counts) - want) < 1e-12
