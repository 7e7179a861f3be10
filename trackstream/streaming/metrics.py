"""Progress of the streaming queries as a table.

The listener writes one JSON file a micro-batch under ``<root>/_metrics``: rows read,
rows dropped as late, durations, state rows and the counters that the plan observes.
``metrics`` reads them back, so totals can be held against the published tables.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

SCHEMA = ("query string, query_id string, run_id string, batch_id long, at string, "
          "input_rows long, rows_per_second double, duration_ms long, late_rows long, "
          "state_rows long, observed map<string, long>")


class ProgressLog(StreamingQueryListener):
    """Register with ``spark.streams.addListener(ProgressLog(spark, root))``."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = f"{root.rstrip('/')}/_metrics"
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(self.root))

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        row = {"query": p.name, "query_id": str(p.id), "run_id": str(p.runId), "batch_id": p.batchId,
               "at": p.timestamp, "input_rows": p.numInputRows,
               "rows_per_second": _number(p.processedRowsPerSecond), "duration_ms": p.batchDuration,
               "late_rows": sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
               "state_rows": sum(s.numRowsTotal for s in p.stateOperators),
               "observed": {f"{name}.{k}": v for name, r in p.observedMetrics.items()
                            for k, v in r.asDict().items() if isinstance(v, int)}}
        out = self._fs.create(self._path(f"{self.root}/{p.runId}-{p.batchId}.json"), True)
        out.write(bytearray((json.dumps(row) + "\n").encode()))
        out.close()

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def _number(x) -> float | None:
    return float(x) if x is not None and x == x and abs(x) != float("inf") else None


def metrics(spark: SparkSession, root: str) -> DataFrame:
    """One row a micro-batch of every query."""
    return spark.read.schema(SCHEMA).json(f"{root.rstrip('/')}/_metrics")
