"""Publish ledger of the streaming tables.

A micro-batch is known by (query id, batch id).  The query id belongs to the
checkpoint folder: a restarted query keeps it, a new checkpoint gets a new one.
A batch is published in three steps:

1. its files are written to a staging folder of this attempt,
2. the folder appears in the table by one rename, as
   ``query_id=<id>/batch_id=<n>``, so a reader that follows the table as a file
   stream meets each batch whole and once,
3. an entry with its rows and event-time range goes into the ledger.

A retried batch finds its entry (or its folder, if the job was lost between
steps 2 and 3) and adds nothing.  A new checkpoint on an existing table appends
under its own id; another query's batches are never overwritten or taken for
its own.  Step 2 needs a file system that renames a folder in one step.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY = ("table string, query_id string, batch_id long, source string, rows long, "
         "min_us long, max_us long, published_at long")


class Ledger:
    """The ledger of all tables under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm.org.apache.hadoop.fs
        self._path = jvm.Path
        self._fs = jvm.Path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # -- places --------------------------------------------------------------
    def table(self, name: str) -> str:
        return f"{self.root}/{name}"

    def folder(self, table: str, query_id: str, batch_id: int) -> str:
        return f"{self.table(table)}/query_id={query_id}/batch_id={batch_id}"

    def _entry(self, table: str, query_id: str, batch_id: int) -> str:
        return f"{self.root}/_ledger/{table}/{query_id}-{batch_id}.json"

    def _exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def _move(self, source: str, target: str) -> bool:
        target_path = self._path(target)
        self._fs.mkdirs(target_path.getParent())
        return self._fs.rename(self._path(source), target_path)

    def create_table(self, name: str) -> None:
        """Make a table's folder, so that a stream can follow it before its first batch."""
        self._fs.mkdirs(self._path(self.table(name)))

    # -- publishing ----------------------------------------------------------
    def published(self, table: str, query_id: str, batch_id: int) -> bool:
        return self._exists(self._entry(table, query_id, batch_id))

    def publish(self, df: DataFrame, table: str, query_id: str, batch_id: int, *,
                time_col: str | None = None, stamp: bool = False,
                source: str | None = None) -> bool:
        """Publish a micro-batch once; returns whether this call wrote it.

        ``time_col`` names the event time whose range the entry keeps, ``source`` the
        id of the query whose batches these rows come from.  With ``stamp`` the rows carry ``published_at`` (milliseconds), by which
        readers tell versions of one row apart."""
        if self.published(table, query_id, batch_id):
            return False
        final = self.folder(table, query_id, batch_id)
        fresh = not self._exists(final)
        now = int(time.time() * 1000)
        if fresh:
            staged = f"{self.root}/_staging/{table}/{query_id}-{batch_id}-{uuid.uuid4().hex}"
            out = df.withColumn("published_at", F.lit(now)) if stamp else df
            out.write.parquet(staged)
            if not self._move(staged, final):
                raise OSError(f"batch {batch_id} of {query_id} could not be published to {table}")
        names = [F.count(F.lit(1)).alias("rows")]
        if time_col:
            names += [F.unix_micros(F.min(time_col)).alias("lo"),
                      F.unix_micros(F.max(time_col)).alias("hi")]
        found = self.spark.read.schema(df.schema).parquet(final).agg(*names).first()
        entry = {"table": table, "query_id": query_id, "batch_id": batch_id,
                 "source": source, "rows": found["rows"],
                 "min_us": found["lo"] if time_col else None,
                 "max_us": found["hi"] if time_col else None, "published_at": now}
        self._write_entry(self._entry(table, query_id, batch_id), entry)
        return fresh

    def _write_entry(self, path: str, entry: dict) -> None:
        self._fs.mkdirs(self._path(path).getParent())
        attempt = f"{self.root}/_staging/{uuid.uuid4().hex}.json"
        out = self._fs.create(self._path(attempt), True)
        out.write(bytearray((json.dumps(entry) + "\n").encode()))
        out.close()
        self._move(attempt, path)

    # -- reading -------------------------------------------------------------
    def entries(self, table: str | None = None) -> DataFrame:
        """One row a published batch."""
        where = f"{self.root}/_ledger/{table or '*'}"
        if table and not self._exists(where):
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).json(where)

    def read_batches(self, table: str, schema, batches: list) -> DataFrame:
        """Rows of the published ``(query id, batch id)`` batches."""
        folders = [self.folder(table, q, b) for q, b in batches]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def read_between(self, table: str, query_id: str, schema, time_col: str, lo, hi) -> DataFrame:
        """Rows that a query published to ``table`` with ``lo <= time_col < hi``, from
        the batches whose range meets that one only."""
        known = (self.entries(table).filter(F.col("query_id") == query_id)
                 .filter((F.col("max_us") >= F.unix_micros(F.lit(lo)))
                         & (F.col("min_us") < F.unix_micros(F.lit(hi)))))
        rows = self.read_batches(table, schema, [(query_id, r.batch_id)
                                                 for r in known.select("batch_id").collect()])
        return rows.filter((F.col(time_col) >= F.lit(lo)) & (F.col(time_col) < F.lit(hi)))


def query_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The id of the query that owns a checkpoint folder (written when it starts)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/metadata")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    reader = fs.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(reader, "UTF-8")
    finally:
        reader.close()
    return json.loads(text)["id"]
