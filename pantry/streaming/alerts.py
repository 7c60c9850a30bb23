"""Sustained alerts as a state machine: pending, firing, resolved.

Input are evaluations that met an alert's condition, one for each window and series,
after their windows are complete.  A series' state is one run of windows; an
event-time timer resolves it when the window after the run is complete and has not
come.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .drift import ROCKSDB

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have the package on their path

SCHEMA = "series string, event string, at timestamp, island_start timestamp, island_last timestamp, n_windows bigint, fired boolean"


class SustainedAlert(StatefulProcessor):
    """Windows are numbered by ``width_s``; a run fires when it has held for ``for_s``
    past its first evaluation."""

    def __init__(self, width_s: int, for_s: int):
        self.width_s, self.for_s = width_s, for_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", "first bigint, last bigint, timer bigint")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        out: list[dict] = []
        first, last, timer = self.run.get() or (None, None, None)
        for window in sorted({int(w) for part in rows for w in part["window_number"]}):  # the windows of one batch
            if first is not None and window <= last:
                continue
            if first is not None and window > last + 1:
                out.append(self._event(key, "resolved", first, last, (last + 2) * self.width_s))
                first = None
            begins = first is None
            first, last = (window, window) if begins else (first, window)
            if begins:
                out.append(self._event(key, "pending", first, last, (last + 1) * self.width_s))
            if self._fired(first, last) and (begins or not self._fired(first, last - 1)):
                out.append(self._event(key, "firing", first, last, (last + 1) * self.width_s))
        if last is not None:
            if timer is not None:
                self.handle.deleteTimer(timer)
            timer = (last + 2) * self.width_s * 1000
            self.handle.registerTimer(timer)
            self.run.update((first, last, timer))
        yield from self._frames(out)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        run = self.run.get()
        if run and run[2] == expiredTimerInfo.getExpiryTimeInMs():
            self.run.clear()
            yield from self._frames([self._event(key, "resolved", run[0], run[1], (run[1] + 2) * self.width_s)])

    def close(self) -> None:
        pass

    def _fired(self, first: int, last: int) -> bool:
        return (last - first) * self.width_s >= self.for_s

    def _event(self, key: Any, event: str, first: int, last: int, at_s: int) -> dict:
        time = lambda s: pd.Timestamp(s, unit="s", tz="UTC")
        return {"series": key[0], "event": event, "at": time(at_s), "island_start": time(first * self.width_s),
                "island_last": time(last * self.width_s), "n_windows": last - first + 1, "fired": self._fired(first, last)}

    @staticmethod
    def _frames(events: list[dict]) -> Iterator[pd.DataFrame]:
        if events:
            yield pd.DataFrame(events)


def sustained(windows: DataFrame, firing: Column, width_s: int, for_s: int, series: Column | None = None) -> DataFrame:
    """Streaming ``windows`` (window_start, in append mode) -> events of SCHEMA.  The
    rows ``resolved`` are those of the batch ``monitor.sustained``."""
    spark = windows.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    number = F.floor(F.unix_timestamp(F.col("window_start").cast("timestamp")) / width_s).cast("long")
    hits = windows.where(firing).select((series if series is not None else F.lit("")).cast("string").alias("series"), number.alias("window_number"))
    return hits.groupBy("series").transformWithStateInPandas(
        statefulProcessor=SustainedAlert(width_s, for_s), outputStructType=SCHEMA, outputMode="Append", timeMode="EventTime")
