"""The streaming job.

Queries, each with its own checkpoint folder:

* ``dead_letters`` — stateless: messages that are not usable records (NULL,
  not JSON, wrong-typed field, no key, unreadable time) land in the dead-letter
  table with a reason.
* ``landed`` — parse -> event time -> watermark (set once, here) -> clean
  (dedup within the watermark, so its state is evicted) -> features.  Every
  cleaned row lands, out-of-range and invalid ones included.
* ``processed`` — reads the landed table as a stream and keeps the mergeable
  moments of each open z-score window; when a window closes, its landed rows
  are joined with its moments, scored, split and published to the processed
  and invalid tables, optionally printed.
* ``windows`` — reads the processed table as a stream, so the dedup state
  exists once for all outputs, and publishes closed windows with trend labels
  from keyed state.

Without z-scores (``stream_z=False``) the first stage publishes the processed
and invalid tables itself, row by row and not window by window; its z-scores
are 0.0 and their flag is False.

All tables are written through the publish ledger
(:mod:`trackstream.streaming.ledger`), by (query id, batch id): a retried batch
adds nothing, and a new checkpoint on existing tables appends to them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from trackstream import schema as S
from trackstream.operators import anomaly, clean, features, routing, summaries, windows
from trackstream.operators.anomaly import model_fallback
from trackstream.schema import PipelineConfig
from trackstream.sources import messages as M
from trackstream.streaming.ledger import Ledger, query_id
from trackstream.streaming.publish import Topics, publish
from trackstream.streaming.stateful import ROCKSDB_PROVIDER, stream_trends

#: Columns by which the published folders of a table are named.
PUBLISHED = [T.StructField("query_id", T.StringType()), T.StructField("batch_id", T.LongType())]


@dataclass(frozen=True)
class StreamLayout:
    """Output tables and per-query checkpoint folders (K12) under two roots."""

    output_root: str
    checkpoint_root: str

    def table(self, name: str) -> str:
        return f"{self.output_root.rstrip('/')}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.checkpoint_root.rstrip('/')}/{name}"


def _trigger(writer, trigger: str | None):
    if trigger in (None, "availableNow"):
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


def _published(schema: T.StructType, one_query: bool = False) -> T.StructType:
    """``schema`` as a reader of a published table, or of one query's part, sees it."""
    own = [f for f in schema.fields if f.name not in ("query_id", "batch_id")]
    return T.StructType(own + PUBLISHED[one_query:])


def _start(plan: DataFrame, layout: StreamLayout, name: str, write: Callable, *,
           trigger: str | None, mode: str = "append") -> StreamingQuery:
    """Start ``plan`` with ``write(batch, ledger, query id, batch id)`` a micro-batch."""
    spark = plan.sparkSession
    ledger = Ledger(spark, layout.output_root)

    def each(batch: DataFrame, batch_id: int) -> None:
        write(batch, ledger, query_id(spark, layout.checkpoint(name)), batch_id)

    w = (plan.writeStream.outputMode(mode).foreachBatch(each)
             .option("checkpointLocation", layout.checkpoint(name)).queryName(name))
    return _trigger(w, trigger).start()


def _run_batch(batch: DataFrame) -> None:
    """Compute a batch whose rows are published already: its state has to be committed."""
    batch.write.format("noop").mode("overwrite").save()


def _publish_all(table: str, topics: Topics | None = None, topic: str | None = None,
                 **options) -> Callable:
    """Publish each batch to a table, and its windows to a topic before that."""
    def write(batch: DataFrame, ledger: Ledger, query: str, batch_id: int) -> None:
        if topics is not None and not ledger.published(table, query, batch_id):
            batch = batch.persist()
            try:
                publish(routing.aggregate_projection(batch), topics, topic, query, batch_id)
                ledger.publish(batch, table, query, batch_id, **options)
            finally:
                batch.unpersist()
        elif not ledger.publish(batch, table, query, batch_id, **options):
            _run_batch(batch)
    return write


def cleaned_stream(raw: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Streaming plan from messages to cleaned rows with features.

    Rows outside the physical ranges stay in, 'invalid' and with a
    ``reject_reason`` (B1)."""
    cols = cfg.cols
    parsed = M.good_records(M.envelope(raw), keep_wrong_type=False)
    if cfg.require_data_valid:
        parsed = parsed.filter(F.col(cols.data_valid).eqNullSafe(F.lit(True)))
    timed = clean.parse_event_time(parsed, cols=cols)
    # G1: the one watermark of the stream, right after the event time exists.
    timed = timed.withWatermark(cols.event_time, cfg.watermark)
    c = (timed.transform(clean.drop_missing_critical, cols=cols)
              .transform(clean.dedup_events, cols=cols, null_keys=cfg.null_keys)
              .transform(clean.impute_defaults)
              .transform(clean.with_reject_reason)
              .transform(clean.quality_flag, cols=cols)
              .transform(clean.flag_rejects, cols=cols))
    c = features.add_derived_features(c, cols=cols)
    c = c if cols.tiebreak in c.columns else c.withColumn(cols.tiebreak, F.lit(None).cast("long"))
    # Per-micro-batch counters in the query progress (observedMetrics)
    return c.observe("quality",
                     F.count(F.lit(1)).alias("rows"),
                     F.count_if(F.col(cols.quality) == "valid").alias("valid"),
                     F.count_if(F.col(cols.quality) != "valid").alias("invalid"))


def _unscored(df: DataFrame, cfg: PipelineConfig) -> DataFrame:
    return df.withColumns({"velocity_zscore": F.lit(0.0), "altitude_zscore": F.lit(0.0),
                           cfg.cols.stat_flag: F.lit(False)})


def processed_stream(raw: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """The cleaned stream with z-scores of 0.0, for outputs that cannot wait for a
    window to close."""
    return _unscored(cleaned_stream(raw, cfg), cfg)


def start_dead_letters(raw: DataFrame, layout: StreamLayout,
                       cfg: PipelineConfig = PipelineConfig(), *,
                       trigger: str | None = S.TRIGGER_INTERVAL) -> StreamingQuery:
    from trackstream.functions.expressions import parse_iso_time

    critical = {"missing_key": F.col(cfg.cols.key).isNull(),
                "unreadable_time": parse_iso_time(cfg.cols.ingest_text).isNull()}
    if cfg.require_data_valid:
        critical["marked_invalid"] = ~F.col(cfg.cols.data_valid).eqNullSafe(F.lit(True))
    return _start(M.dead_letters(M.envelope(raw), critical=critical), layout, "dead_letters",
                  _publish_all("dead_letters"), trigger=trigger)


def _fan_out(cfg: PipelineConfig, model, console: bool, topics: Topics | None = None,
             source: str | None = None) -> Callable:
    """K2/K4/K5/K6: score, split and publish a batch of rows with z-scores."""
    from trackstream.operators.forest import score_frame

    cols = cfg.cols

    def write(batch: DataFrame, ledger: Ledger, query: str, batch_id: int) -> None:
        batch = batch.withColumn("processing_timestamp", F.current_timestamp()).persist()
        try:
            valid, invalid = routing.split_valid_invalid(batch, cols=cols)
            scored = score_frame(valid, model, cols=cols) if model is not None \
                else model_fallback(valid, cols=cols)
            out = routing.processed_projection(scored, extra=[cols.tiebreak])
            bad = routing.invalid_projection(invalid, extra=["reject_reason"])
            # messages first: a batch that is lost before its entry is sent again
            if topics is not None and not ledger.published("processed", query, batch_id):
                publish(routing.processed_projection(scored), topics, topics.processed, query, batch_id)
            if topics is not None and not ledger.published("invalid", query, batch_id):
                publish(routing.invalid_projection(invalid), topics, topics.invalid, query, batch_id)
            fresh = [ledger.publish(out, "processed", query, batch_id, source=source,
                                    time_col=cols.event_time),
                     ledger.publish(bad, "invalid", query, batch_id, source=source)]
            if not any(fresh):
                _run_batch(batch)
            if console:
                routing.console_projection(scored).show(10, truncate=False)
        finally:
            batch.unpersist()

    return write


def start_processed(raw: DataFrame, layout: StreamLayout,
                    cfg: PipelineConfig = PipelineConfig(), *, model=None,
                    console: bool = False, topics: Topics | None = None,
                    trigger: str | None = S.TRIGGER_INTERVAL) -> StreamingQuery:
    """One query from messages to the processed and invalid tables, without z-scores."""
    return _start(processed_stream(raw, cfg), layout, "processed", _fan_out(cfg, model, console, topics),
                  trigger=trigger)


def start_landed(raw: DataFrame, layout: StreamLayout, cfg: PipelineConfig = PipelineConfig(), *,
                 trigger: str | None = S.TRIGGER_INTERVAL) -> StreamingQuery:
    """Cleaned rows into the landed table, where they wait for their window."""
    plan = cleaned_stream(raw, cfg)
    return _start(plan, layout, "landed",
                  _publish_all("landed", time_col=cfg.cols.event_time), trigger=trigger)


def start_scored(spark: SparkSession, layout: StreamLayout, schema: T.StructType,
                 cfg: PipelineConfig = PipelineConfig(), *, model=None, console: bool = False,
                 topics: Topics | None = None, trigger: str | None = S.TRIGGER_INTERVAL,
                 max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Landed rows -> processed and invalid rows with z-scores, window by window.

    The stream's state is a window's (or a window's and entity's) moments, never its
    rows: those are read back from the landed batches that meet the closed windows.  A
    row that cleaning accepted is never older than this query's watermark, which
    follows the same rows later, so each landed row is in its window's moments and
    comes out once, when the window closes.

    The query reads the rows of the ``landed`` query beside its checkpoint only, so a
    new checkpoint root appends to existing tables.  Where those rows were published
    already and this query's own checkpoint is gone, it would publish them twice, and
    refuses to start."""
    cols = cfg.cols
    source = query_id(spark, layout.checkpoint("landed"))
    if source is None:
        raise ValueError("start the landed query first: its checkpoint names its rows")
    if query_id(spark, layout.checkpoint("scored")) is None and not Ledger(
            spark, layout.output_root).entries("processed").filter(
            F.col("source") == source).isEmpty():
        raise ValueError("the checkpoint of the scored query is gone, but rows of this landed "
                         "query are published: start the group with new checkpoints")
    src = _follow(spark, layout, "landed", schema, cfg, max_files_per_trigger, source)
    closed = anomaly.window_moments(src, window_duration=cfg.zscore_window,
                                    per_key=cfg.zscore_per_key, cols=cols)
    fan_out = _fan_out(cfg, model, console, topics, source)

    def write(batch: DataFrame, ledger: Ledger, query: str, batch_id: int) -> None:
        moments = batch.persist()
        try:
            span = moments.agg(F.min("window_start"), F.max("window_end")).first()
            if span[0] is None:
                return
            rows = ledger.read_between("landed", source, schema, cols.event_time, *span)
            scored = anomaly.apply_moments(
                rows, moments, window_duration=cfg.zscore_window,
                per_key=cfg.zscore_per_key, threshold=cfg.zscore_threshold, cols=cols)
            fan_out(scored, ledger, query, batch_id)
        finally:
            moments.unpersist()

    return _start(closed, layout, "scored", write, trigger=trigger)


def landed_schema(raw: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> T.StructType:
    return cleaned_stream(raw, cfg).schema


def processed_schema(raw: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> T.StructType:
    rows = _unscored(cleaned_stream(raw, cfg), cfg).withColumn("processing_timestamp",
                                                               F.current_timestamp())
    return routing.processed_projection(model_fallback(rows), extra=[cfg.cols.tiebreak]).schema


def _follow(spark: SparkSession, layout: StreamLayout, table: str, schema: T.StructType,
            cfg: PipelineConfig, max_files_per_trigger: int | None = None,
            source: str | None = None) -> DataFrame:
    """A published table (or what one query published to it) as a stream, with the
    watermark."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    reader = spark.readStream.schema(_published(schema, one_query=source is not None))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(int(max_files_per_trigger)))
    only = f"/query_id={source}" if source else ""
    return (reader.parquet(layout.table(table) + only).drop("query_id", "batch_id")
            .withWatermark(cfg.cols.event_time, cfg.watermark))


def start_windows(spark: SparkSession, layout: StreamLayout, schema: T.StructType,
                  cfg: PipelineConfig = PipelineConfig(), *,
                  topics: Topics | None = None, trigger: str | None = S.TRIGGER_INTERVAL,
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """K3 (append by default) + G2/G3 + G8: closed windows with trends.
    Rows older than the watermark are dropped here (G5) and counted in the
    query progress (``numRowsDroppedByWatermark``).

    A new checkpoint reads the whole processed table again and appends its windows as
    newer versions; :func:`latest_windows` keeps the newest of each."""
    cols = cfg.cols
    src = _follow(spark, layout, "processed", schema, cfg, max_files_per_trigger)
    win = windows.window_stats(src, duration=cfg.window, slide=cfg.slide, window_time=True,
                               cols=cols)
    expiry = pd.Timedelta(cfg.window) * cfg.trend_expiry
    return _start(stream_trends(win, key=cols.key, expiry=str(expiry)), layout, "windows",
                  _publish_all("windows", topics, topics and topics.aggregated, stamp=True),
                  trigger=trigger)


def start_window_updates(spark: SparkSession, layout: StreamLayout, schema: T.StructType,
                         cfg: PipelineConfig = PipelineConfig(), *,
                         topics: Topics | None = None,
                         trigger: str | None = S.TRIGGER_INTERVAL) -> StreamingQuery:
    """K3 ``update`` mode (the reference's choice): every micro-batch emits the
    windows it changed, open ones included, as newer versions in
    ``window_updates``; :func:`latest_windows` reads the newest version of each
    window.  Trend labels need final windows, so they are only in the append
    query; sliding windows are merged from closed panes, so they are too."""
    src = _follow(spark, layout, "processed", schema, cfg)
    win = windows.window_stats(src, duration=cfg.window, cols=cfg.cols)
    return _start(win, layout, "window_updates",
                  _publish_all("window_updates", topics, topics and topics.aggregated, stamp=True),
                  trigger=trigger, mode="update")


def start_summaries(spark: SparkSession, layout: StreamLayout, schema: T.StructType,
                    cfg: PipelineConfig = PipelineConfig(), *,
                    trigger: str | None = S.TRIGGER_INTERVAL,
                    max_files_per_trigger: int | None = None) -> StreamingQuery:
    """A mergeable summary row and the small dimensions' counts of every micro-batch
    of the processed table; :func:`trackstream.streaming.sinks.refresh_summaries` merges
    them.  The query has no state."""
    cols = cfg.cols
    src = _follow(spark, layout, "processed", schema, cfg, max_files_per_trigger)

    def write(batch: DataFrame, ledger: Ledger, query: str, batch_id: int) -> None:
        ledger.publish(summaries.summarize(batch, cols=cols), "summaries", query, batch_id)
        ledger.publish(summaries.dimension_counts(batch, cols=cols), "summary_counts", query,
                       batch_id)

    return _start(src, layout, "summaries", write, trigger=trigger)


def latest_windows(spark: SparkSession, path: str, *, key: str = "icao24") -> DataFrame:
    """Newest version of every window of a published windows table (a partial
    group limit runs before the shuffle, so many versions of a hot window
    cost one row per input partition)."""
    from pyspark.sql import Window
    w = Window.partitionBy("window_start", "window_end", key).orderBy(
        F.col("published_at").desc(), F.col("batch_id").desc())
    return (spark.read.parquet(path).withColumn("_rn", F.row_number().over(w))
                 .filter("_rn = 1").drop("_rn"))


def run_stream(spark: SparkSession, raw: DataFrame, layout: StreamLayout,
               cfg: PipelineConfig = PipelineConfig(), *, model=None, stream_z: bool = True,
               console: bool = False, topics: Topics | None = None,
               trigger: str | None = S.TRIGGER_INTERVAL, wait: bool = False) -> dict[str, StreamingQuery]:
    """Start the query group.

    With a bounded trigger (``availableNow`` / ``once``) each query starts after the
    one it reads from has drained its input, and ``wait`` blocks until all end.
    With a processing-time trigger all run side by side (the folders they follow are
    created first) and ``wait`` returns when any of them stops."""
    landed, processed = landed_schema(raw, cfg), processed_schema(raw, cfg)
    bounded = trigger in (None, "availableNow", "once")
    ledger = Ledger(spark, layout.output_root)
    qs = {"dead_letters": start_dead_letters(raw, layout, cfg, trigger=trigger)}
    chain = [("landed", lambda: start_landed(raw, layout, cfg, trigger=trigger)),
             ("scored", lambda: start_scored(spark, layout, landed, cfg, model=model,
                                             console=console, topics=topics,
                                             trigger=trigger))] if stream_z else [
        ("processed", lambda: start_processed(raw, layout, cfg, model=model, console=console,
                                              topics=topics, trigger=trigger))]
    chain.append(("windows", lambda: start_windows(spark, layout, processed, cfg, topics=topics,
                                                   trigger=trigger)))
    for name, start in chain:
        if name == "scored":
            ledger.create_table(f"landed/query_id={query_id(spark, layout.checkpoint('landed'))}")
        if name == "windows":
            ledger.create_table("processed")
        qs[name] = start()
        if bounded and name != "windows":
            qs[name].awaitTermination()
    if wait:
        if bounded:
            for q in qs.values():
                q.awaitTermination()
        else:
            spark.streams.awaitAnyTermination()
    return qs


def progress_metrics(query: StreamingQuery) -> dict:
    """Rate, duration and late-row counters of the last micro-batch."""
    p = query.lastProgress or {}
    dropped = sum(int(op.get("numRowsDroppedByWatermark", 0))
                  for op in p.get("stateOperators", []) or [])
    return {"batchId": p.get("batchId"), "numInputRows": p.get("numInputRows"),
            "observedMetrics": p.get("observedMetrics"),
            "inputRowsPerSecond": p.get("inputRowsPerSecond"),
            "processedRowsPerSecond": p.get("processedRowsPerSecond"),
            "durationMs": p.get("durationMs"), "numRowsDroppedByWatermark": dropped}
