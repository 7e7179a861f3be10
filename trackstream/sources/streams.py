"""Stream readers (S1, S8, S9): a keyed message bus or landed files.

The broker connector is optional at run time; the option set it receives is
built (and unit-tested) here.  Files (parquet / json) are the portable source
used by the tests.  Rate limits replace the dashboard's bounded consume: the
checkpoint holds the group position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def kafka_options(topic: str, bootstrap: str, *, starting: str = "earliest",
                  fail_on_data_loss: bool = False, max_offsets: int | None = None,
                  extra: dict | None = None) -> dict[str, str]:
    """Options for ``readStream.format('kafka')``: subscribe, start position,
    data-loss tolerance and an optional per-trigger cap."""
    opts = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(bool(fail_on_data_loss)).lower(),
    }
    if max_offsets is not None:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets))
    opts.update(extra or {})
    return opts


def read_stream(spark: SparkSession, kind: str = "files", *, path: str | None = None,
                fmt: str = "parquet", schema: T.StructType | str | None = None,
                topic: str | None = None, bootstrap: str | None = None,
                starting: str = "earliest", max_per_trigger: int | None = None,
                options: dict | None = None) -> DataFrame:
    """A streaming DataFrame with ``key, value, timestamp`` (kafka) or
    the landed files' columns (files)."""
    if kind == "kafka":
        if not (topic and bootstrap):
            raise ValueError("kafka source needs topic and bootstrap")
        return (spark.readStream.format("kafka")
                .options(**kafka_options(topic, bootstrap, starting=starting,
                                         max_offsets=max_per_trigger, extra=options))
                .load())
    if kind == "files":
        if path is None or schema is None:
            raise ValueError("files source needs path and schema")
        r = spark.readStream.format(fmt).schema(schema)
        if max_per_trigger is not None:
            r = r.option("maxFilesPerTrigger", str(int(max_per_trigger)))
        return r.options(**(options or {})).load(path)
    raise ValueError(f"unknown source kind {kind!r}")


MESSAGE_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("timestamp", T.TimestampType()),
])


def read_both(spark: SparkSession, processed: dict, aggregated: dict
              ) -> tuple[DataFrame, DataFrame]:
    """The processed and the aggregated feed, each with its own reader
    options (e.g. different per-trigger caps)."""
    return read_stream(spark, **processed), read_stream(spark, **aggregated)
