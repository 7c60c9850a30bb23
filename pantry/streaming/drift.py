"""The drift loop as one stateful stream.

State is what a look-back needs and no more: per pane (the time between two checks)
and feature, how many live values fell on each distinct baseline value and in each gap
between two.  The Kolmogorov-Smirnov distance of the raw values is exact from these
counts, since between two baseline values only the live distribution moves, and one
way.  So state is bounded by panes x baseline values, however many rows come.

Tasks count their own rows, the counts of equal cells are added up after one shuffle,
and a single key sees the sums: a check decides on all features together, and moves
the start of the next windows when it triggers.  Event-time timers run the checks, so
a check sees every row that is not later than the watermark allows; later ones count
for the windows that still cover them, and are reported.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .. import vocab
from ..operators.drift import _long
from ..sources.io import output_root

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have the package on their path

#: Distinct baseline values of a feature that a monitor holds, at most.
MOST_VALUES = 100_000
#: The feature name under which rows themselves are counted.
ROWS = ""
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LOG_SCHEMA = ("check_at timestamp, window_start timestamp, kind string, n_rows bigint, n_late bigint, feature string, n_baseline bigint, "
              "n_live bigint, ks_statistic double, p_value double, drift_detected boolean, skipped boolean, n_features_checked int, "
              "n_drifted int, drift_rate double, triggered boolean, drifted_features string")

Baseline = dict[str, tuple[np.ndarray, np.ndarray]]


def baseline_values(baseline: DataFrame, features: list[str]) -> Baseline:
    """feature: (distinct values, rows up to each).  The reference compares with the
    first 5000 rows; more than MOST_VALUES values of a feature are an error."""
    found: dict[str, list[tuple[float, int]]] = {f: [] for f in features}
    counts = _long(baseline, features, 0).groupBy("feature", "value").count()
    for r in counts.limit(MOST_VALUES * len(features) + 1).collect():
        found[r["feature"]].append((r["value"], r["count"]))
    if any(len(x) > MOST_VALUES for x in found.values()):
        raise ValueError(f"a baseline of more than {MOST_VALUES} distinct values; take its head first")
    out = {}
    for feature, pairs in found.items():
        pairs.sort()
        out[feature] = (np.array([v for v, _ in pairs], float), np.cumsum([n for _, n in pairs], dtype=np.int64))
    return out


def cells_of(values: np.ndarray, live: np.ndarray) -> np.ndarray:
    """2 i for the gap below baseline value i, 2 i + 1 for the value itself."""
    at = np.searchsorted(values, live)
    equal = np.zeros(len(live), bool)
    inside = at < len(values)
    equal[inside] = values[at[inside]] == live[inside]
    return 2 * at + equal


def ks_of_cells(values: np.ndarray, upto: np.ndarray, cells: np.ndarray, counts: np.ndarray) -> float:
    """Greatest distance of the two distribution functions; both sides have rows."""
    dense = np.zeros(2 * len(values) + 1, np.int64)
    dense[cells] = counts
    live = np.cumsum(dense) / counts.sum()
    base = upto / upto[-1]
    at, before = np.abs(live[1::2] - base), np.abs(live[:-1:2] - np.concatenate([[0.0], base[:-1]]))
    return float(max(at.max(), before.max()))


def p_value(distance: float, n: int, m: int, terms: int = 100) -> float:
    """Asymptotic two-sided tail, as the batch test has it."""
    lam = math.sqrt(n * m / (n + m)) * distance
    if lam < 0.2:
        return 1.0
    return min(1.0, max(0.0, sum(2.0 * (-1.0) ** (k - 1) * math.exp(-2.0 * k * k * lam * lam) for k in range(1, terms + 1))))


def half_up(x: float, digits: int) -> float:
    return math.floor(x * 10 ** digits + 0.5) / 10 ** digits


def _summed(table: pa.Table) -> pa.Table:
    out = table.group_by(["pane", "feature", "cell"], use_threads=False).aggregate([("n", "sum")])
    return out.select(["pane", "feature", "cell", "n_sum"]).rename_columns(["pane", "feature", "cell", "n"])


_CELLS = "pane bigint, feature string, cell bigint, n bigint"


def pane_cells(rows: DataFrame, baseline: Baseline, pane_ms: int) -> DataFrame:
    """Columns request_id, ts, features -> rows of each (pane, feature, cell).  Rows
    with a negative request_id only move the watermark; null ts is left out, null and
    NaN values count for no feature."""
    features = list(baseline)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.and_(pc.is_valid(batch.column(1)), pc.fill_null(pc.greater_equal(batch.column(0), 0), True)))
            ms = batch.column(1).cast(pa.timestamp("ms", tz=batch.column(1).type.tz), safe=False).cast(pa.int64()).to_numpy()
            pane = ms // pane_ms * pane_ms
            parts = [(pane, ROWS, np.zeros(len(pane), np.int64))]
            for i, f in enumerate(features):
                live = batch.column(2 + i).to_numpy(zero_copy_only=False).astype(float)
                ok = ~np.isnan(live)
                parts.append((pane[ok], f, cells_of(baseline[f][0], live[ok])))
            yield from _summed(pa.concat_tables([pa.table({
                "pane": p, "feature": pa.array([f] * len(p), pa.string()), "cell": c.astype(np.int64),
                "n": np.ones(len(p), np.int64)}) for p, f, c in parts])).to_batches()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            if sum(map(len, held)) > 1 << 18:
                held = [_summed(pa.concat_tables(held))]
        if held:
            yield from _summed(pa.concat_tables(held)).to_batches()

    return rows.select("request_id", "ts", *features).mapInArrow(count, _CELLS).repartition("pane", "feature", "cell").mapInArrow(add, _CELLS)


class DriftMonitor(StatefulProcessor):
    """Checks at every end of a pane: too few rows are skipped; a share of drifted
    features above the bound triggers, and later windows start there."""

    def __init__(self, baseline: Baseline, pane_ms: int, lookback_ms: int, min_rows: int, p_threshold: float, min_stat: float, share: float):
        self.baseline, self.pane_ms, self.lookback_ms, self.min_rows = baseline, pane_ms, lookback_ms, min_rows
        self.p_threshold, self.min_stat, self.share = p_threshold, min_stat, share

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.panes = handle.getMapState("panes", "pane bigint, feature string", "counts binary")
        self.clock = handle.getValueState("clock", "next_check bigint, last_check bigint, last_trigger bigint, n_late bigint")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        table = pd.concat(list(rows)).groupby(["pane", "feature", "cell"], as_index=False)["n"].sum()  # bounded: sums of cells
        next_check, last_check, last_trigger, n_late = self.clock.get() or (None, None, None, 0)
        if last_check is not None:
            late = table["pane"] < last_check
            n_late += int(table.loc[late & (table["feature"] == ROWS), "n"].sum())
            table = table[~late | (table["pane"] >= last_check + self.pane_ms - self.lookback_ms)]
        for (pane, feature), part in table.groupby(["pane", "feature"]):
            own = part[["cell", "n"]].to_numpy(np.int64)
            held = self.panes.getValue((int(pane), feature))
            self.panes.updateValue((int(pane), feature), (self._added([own] + ([self._read(held)] if held else [])).tobytes(),))
        if next_check is None and len(table):
            next_check = max(int(table["pane"].min()) + self.pane_ms, (last_check or 0) + self.pane_ms)
            self.handle.registerTimer(next_check)
        self.clock.update((next_check, last_check, last_trigger, n_late))
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        next_check, last_check, last_trigger, n_late = self.clock.get()
        held = {tuple(k): self._read(v) for k, v in self.panes.iterator()}  # the look-back's panes, bounded
        while next_check is not None and next_check <= timerValues.getCurrentWatermarkInMs():
            out, triggered = self._check(next_check, last_trigger, held, n_late)
            yield pd.DataFrame(out)
            n_late, last_check = 0, next_check
            last_trigger = next_check if triggered else last_trigger
            next_check += self.pane_ms
            for k in [k for k in held if k[0] < next_check - self.lookback_ms]:
                self.panes.removeKey(k)
                del held[k]
            if not held:
                next_check = None
            else:  # no check before there is something to see
                next_check = max(next_check, min(held)[0] + self.pane_ms)
        if next_check is not None:
            self.handle.registerTimer(next_check)
        self.clock.update((next_check, last_check, last_trigger, n_late))

    def close(self) -> None:
        pass

    @staticmethod
    def _read(value: Any) -> np.ndarray:
        return np.frombuffer(bytes(value[0]), np.int64).reshape(-1, 2)

    @staticmethod
    def _added(parts: list[np.ndarray]) -> np.ndarray:
        every = np.concatenate([np.zeros((0, 2), np.int64), *parts])
        cells, at = np.unique(every[:, 0], return_inverse=True)
        counts = np.zeros(len(cells), np.int64)
        np.add.at(counts, at, every[:, 1])
        return np.column_stack([cells, counts])

    def _check(self, now: int, last_trigger: int | None, held: dict[tuple[int, str], np.ndarray], n_late: int) -> tuple[list[dict], bool]:
        start = max(now - self.lookback_ms, last_trigger if last_trigger is not None else now - self.lookback_ms)
        windows: dict[str, list[np.ndarray]] = {}
        for (pane, feature), counts in held.items():
            if start <= pane < now:
                windows.setdefault(feature, []).append(counts)
        n_rows = int(self._added(windows.get(ROWS, []))[:, 1].sum())
        whole = dict.fromkeys(name.split()[0] for name in LOG_SCHEMA.split(", ")) | {
            "check_at": pd.Timestamp(now, unit="ms", tz="UTC"), "window_start": pd.Timestamp(start, unit="ms", tz="UTC"),
            "n_rows": n_rows, "n_late": n_late, "skipped": n_rows < self.min_rows}
        if n_rows < self.min_rows:
            return [whole | {"kind": "summary", "triggered": False}], False
        out, drifted, checked = [], [], 0
        for feature, (values, upto) in self.baseline.items():
            window = self._added(windows.get(feature, []))
            n, m = int(upto[-1]) if len(upto) else 0, int(window[:, 1].sum())
            row = whole | {"kind": "feature", "feature": feature, "n_baseline": n, "n_live": m, "drift_detected": False}
            checked += n > 0 and m > 0
            if n >= 2 and m >= 2:
                distance = ks_of_cells(values, upto, window[:, 0], window[:, 1])
                p = p_value(distance, n, m)
                row |= {"ks_statistic": half_up(distance, 4), "p_value": half_up(p, 6),
                        "drift_detected": p < self.p_threshold and distance >= self.min_stat}
            if row["drift_detected"]:
                drifted.append(feature)
            out.append(row)
        rate = len(drifted) / max(checked, 1)
        summary = whole | {"kind": "summary", "n_features_checked": checked, "n_drifted": len(drifted), "drift_rate": half_up(rate, 3),
                           "triggered": rate > self.share, "drifted_features": ",".join(sorted(drifted))}
        return [*out, summary], rate > self.share


def checks(log: DataFrame, baseline: Baseline, pane_s: int = 3600, lookback_hours: int = 24, min_rows: int = 100,
           p_threshold: float = vocab.KS_P_THRESHOLD, min_stat: float = vocab.KS_MIN_STATISTIC, share: float = vocab.DRIFT_SHARE) -> DataFrame:
    """Streaming ``log`` (request_id, ts with a watermark, a double column for each
    feature) -> rows of LOG_SCHEMA: at each check one row for each feature and one
    summary, or the summary alone if it was skipped.

    A check takes place at the end of each pane of ``pane_s`` seconds while the
    look-back holds rows, over the rows since the later of the look-back's start and
    the last trigger.  Needs the RocksDB state store (``use_rocksdb``).
    """
    if lookback_hours * 3600 % pane_s:
        raise ValueError("the look-back must be whole panes")
    spark = log.sparkSession
    monitor = DriftMonitor(baseline, pane_s * 1000, lookback_hours * 3_600_000, min_rows, p_threshold, min_stat, share)
    cells = pane_cells(log, baseline, pane_s * 1000).withColumn("monitor", F.lit("drift"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return cells.groupBy("monitor").transformWithStateInPandas(
        statefulProcessor=monitor, outputStructType=LOG_SCHEMA, outputMode="Append", timeMode="EventTime")


def run_checks(spark: SparkSession, rows: DataFrame, out: str | None = None, checkpoint: str | None = None, after_batch=None) -> DataFrame:
    """Run until the source has no more, writing each batch's rows as one folder that
    a repeated batch replaces; returns the whole log.  With the same ``out`` and
    ``checkpoint`` a later run goes on where this one ended.  ``after_batch`` gets the
    time of each batch's last check (retention, say)."""
    out = out or output_root(spark, "drift-log")

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        if after_batch:
            last = spark.read.schema(LOG_SCHEMA).parquet(f"{out}/batch_id={batch_id}").agg(F.max("check_at")).first()[0]
            if last is not None:
                after_batch(last)

    query = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint or out + "-ckpt").trigger(
        availableNow=True).foreachBatch(sink).start()
    query.awaitTermination()
    return spark.read.schema(LOG_SCHEMA + ", batch_id bigint").parquet(out)


def last_trigger(spark: SparkSession, log_path: str) -> DataFrame:
    """One row: last_trigger_at of a written log (null if nothing triggered)."""
    return spark.read.schema(LOG_SCHEMA).parquet(log_path).where("triggered").agg(F.max("check_at").alias("last_trigger_at"))
