"""Stateful streaming operators the batch forms cannot run as-is.

:func:`stream_trends` (G8) — trend labels between consecutive closed windows of
an entity, with the previous window in keyed state
(``transformWithStateInPandas``; needs the RocksDB state store).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from trackstream.operators.trends import add_trend_labels

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _trend_processor(expiry_ms: int) -> StatefulProcessor:
    """A processor that puts the previous closed window's averages beside each
    new window of an entity.  The class is local, so it is pickled by value:
    Python workers need no import of this package to run it."""

    class PreviousWindow(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.prev = handle.getValueState(
                "prev", "avg_velocity double, avg_altitude double, start long, timer long")

        def handleInputRows(self, key, rows, timerValues):
            import pandas as pd

            pdf = pd.concat(list(rows), ignore_index=True).sort_values("window_start")
            start = pdf["window_start"].astype("datetime64[ms]").astype("int64")
            last = (None, None, None, None)
            if self.prev.exists():
                last = self.prev.get()
                self.handle.deleteTimer(last[3])
            both = pdf[["avg_velocity", "avg_altitude"]].astype("float64")
            before, at = both.shift(1), start.shift(1)
            before.iloc[0] = [float("nan") if x is None else x for x in last[:2]]
            at.iloc[0] = float("nan") if last[2] is None else last[2]
            # a window that the timer is due for counts as none, fired or not
            before[~(start - at <= expiry_ms)] = float("nan")
            # the last window that still has this one as history closes no earlier
            end = pdf["window_end"].iloc[-1:].astype("datetime64[ms]").astype("int64")
            timer = int(end.iloc[0]) + expiry_ms
            self.prev.update((*(None if pd.isna(x) else float(x) for x in both.iloc[-1]),
                              int(start.iloc[-1]), timer))
            self.handle.registerTimer(timer)
            yield pdf.assign(prev_avg_velocity=before["avg_velocity"],
                             prev_avg_altitude=before["avg_altitude"])

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            self.prev.clear()
            return iter(())

        def close(self):
            pass

    return PreviousWindow()


def stream_trends(windows: DataFrame, *, key: str = "icao24",
                  expiry: str = "1 day") -> DataFrame:
    """Windows (append, closed only, with their ``window_time``) -> windows with
    trend columns.

    State holds two averages and two times per entity.  An event-time timer clears it
    once the watermark is ``expiry`` past the entity's last window; a window that comes
    later has no history, as in ``trends.calculate_trends(max_gap=expiry)``.  Timers
    follow the watermark, so a bounded run (``availableNow``) ends."""
    out_schema = T.StructType(list(windows.schema.fields)
                              + [T.StructField("prev_avg_velocity", T.DoubleType()),
                                 T.StructField("prev_avg_altitude", T.DoubleType())])
    expiry_ms = pd.Timedelta(expiry) // pd.Timedelta("1ms")
    out = windows.groupBy(key).transformWithStateInPandas(
        statefulProcessor=_trend_processor(expiry_ms), outputStructType=out_schema,
        outputMode="Append", timeMode="EventTime")
    return add_trend_labels(out.drop("window_time").withColumns({
        "velocity_change": F.col("avg_velocity") - F.col("prev_avg_velocity"),
        "altitude_change_from_prev": F.col("avg_altitude") - F.col("prev_avg_altitude")}))
