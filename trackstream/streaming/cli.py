"""Run the streaming job: ``python -m trackstream.streaming.cli --help``.

Examples::

    # landed JSON-message files (key/value/timestamp parquet), no model
    python -m trackstream.streaming.cli --source files --path s3://bucket/landing \\
        --output s3://bucket/flights --checkpoint s3://bucket/checkpoints

    # broker topic, with a model written by trackstream.operators.forest.save_model
    python -m trackstream.streaming.cli --source kafka --topic flight-raw-data \\
        --bootstrap broker:9092 --model s3://bucket/models/iforest \\
        --output s3://bucket/flights --checkpoint s3://bucket/checkpoints
"""

from __future__ import annotations

import argparse

from trackstream import schema as S
from trackstream.schema import PipelineConfig
from trackstream.session import build_session
from trackstream.sources.streams import MESSAGE_SCHEMA, read_stream
from trackstream.streaming.metrics import ProgressLog
from trackstream.streaming.publish import Topics, to_broker
from trackstream.streaming.runner import StreamLayout, run_stream


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--source", choices=["files", "kafka"], default="files")
    ap.add_argument("--path", help="landed message files (files source)")
    ap.add_argument("--topic", default="flight-raw-data")
    ap.add_argument("--bootstrap", help="broker bootstrap servers (kafka source)")
    ap.add_argument("--starting", default="earliest")
    ap.add_argument("--max-per-trigger", type=int, default=None)
    ap.add_argument("--output", required=True, help="root folder of the output tables")
    ap.add_argument("--checkpoint", required=True, help="root folder of the query checkpoints")
    ap.add_argument("--model", help="model tables written by forest.save_model")
    ap.add_argument("--window", default=S.WINDOW_DURATION)
    ap.add_argument("--slide", default=None)
    ap.add_argument("--watermark", default=S.WATERMARK_DELAY)
    ap.add_argument("--trigger", default=S.TRIGGER_INTERVAL,
                    help="processing-time interval, or 'availableNow'")
    ap.add_argument("--no-zscore", action="store_true",
                    help="publish rows at once, without z-scores, and not window by window")
    ap.add_argument("--zscore-window", default=S.WINDOW_DURATION)
    ap.add_argument("--zscore-per-key", action="store_true",
                    help="z-scores per (window, entity) instead of per window")
    ap.add_argument("--null-keys", choices=["equal", "distinct"], default="equal",
                    help="whether rows without a position time are duplicates of each other")
    ap.add_argument("--require-data-valid", action="store_true",
                    help="take only records that the producer marked valid")
    ap.add_argument("--trend-expiry", type=int, default=PipelineConfig.trend_expiry,
                    help="windows after which a silent entity's trend state expires")
    ap.add_argument("--console", action="store_true", help="print ten rows of each batch")
    ap.add_argument("--publish", metavar="BOOTSTRAP",
                    help="publish processed, invalid and windowed rows to this broker too")
    ap.add_argument("--processed-topic", default=S.PROCESSED_TOPIC)
    ap.add_argument("--invalid-topic", default=S.INVALID_OUT_TOPIC)
    ap.add_argument("--aggregated-topic", default=S.AGGREGATED_TOPIC)
    ap.add_argument("--metrics", action="store_true", help="log the queries' progress as a table")
    a = ap.parse_args(argv)

    spark = build_session()
    model = None
    if a.model:
        from trackstream.operators.forest import load_model
        model = load_model(spark, a.model)
    if a.source == "kafka":
        raw = read_stream(spark, "kafka", topic=a.topic, bootstrap=a.bootstrap,
                          starting=a.starting, max_per_trigger=a.max_per_trigger)
    else:
        raw = read_stream(spark, "files", path=a.path, schema=MESSAGE_SCHEMA,
                          max_per_trigger=a.max_per_trigger)
    cfg = PipelineConfig(window=a.window, slide=a.slide, watermark=a.watermark,
                         zscore_window=a.zscore_window, zscore_per_key=a.zscore_per_key,
                         null_keys=a.null_keys, require_data_valid=a.require_data_valid,
                         trend_expiry=a.trend_expiry)
    topics = None
    if a.publish:
        topics = Topics(to_broker(a.publish), processed=a.processed_topic, invalid=a.invalid_topic,
                        aggregated=a.aggregated_topic)
    if a.metrics:
        spark.streams.addListener(ProgressLog(spark, a.output))
    run_stream(spark, raw, StreamLayout(a.output, a.checkpoint), cfg, model=model, topics=topics,
               stream_z=not a.no_zscore, console=a.console, trigger=a.trigger, wait=True)


if __name__ == "__main__":
    main()
