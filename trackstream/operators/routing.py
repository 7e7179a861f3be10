"""Routing and fixed projections: valid/invalid split, producer-side routing
with counters, and the output projections of the processed, aggregated,
invalid and console feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackstream import schema as S
from trackstream.operators.clean import validate_records
from trackstream.schema import FLIGHT, FlightColumns


def split_valid_invalid(df: DataFrame, *, cols: FlightColumns = FLIGHT
                        ) -> tuple[DataFrame, DataFrame]:
    """K8: two filters on the quality flag (never NULL by construction)."""
    q = F.col(cols.quality)
    return df.filter(q == "valid"), df.filter(q != "valid")


def route_records(df: DataFrame, *, key: str = "icao24", raw_topic: str = S.RAW_TOPIC,
                  invalid_topic: str = S.INVALID_TOPIC, raw: dict | None = None) -> DataFrame:
    """K9: validate (V7), then route: valid -> raw topic; invalid -> invalid
    topic with ``data_valid=false`` and ``validation_error``.  The message key
    is the entity key, 'unknown' when it is NULL."""
    v = validate_records(df, key=key, raw=raw)
    return v.withColumns({
        "route": F.when(F.col("validation_error").isNull(), F.lit("raw"))
                  .otherwise(F.lit("invalid")),
        "topic": F.when(F.col("validation_error").isNull(), F.lit(raw_topic))
                  .otherwise(F.lit(invalid_topic)),
        "message_key": F.coalesce(F.col(key), F.lit("unknown")),
    })


def route_stats(routed: DataFrame) -> DataFrame:
    """Total / valid / invalid / errors counters (one row).  ``errors``
    counts records whose routing failed, which a declarative route cannot do,
    so it is rows with no route."""
    return routed.agg(
        F.count(F.lit(1)).alias("total_fetched"),
        F.count_if(F.col("route") == "raw").alias("valid_sent"),
        F.count_if(F.col("route") == "invalid").alias("invalid_sent"),
        F.count_if(F.col("route").isNull()).alias("errors"))


def processed_projection(df: DataFrame, *, include_processing_time: bool = True,
                         extra: list[str] | None = None) -> DataFrame:
    """V9: the 25-column processed feed (plus ``extra`` columns, e.g. the id)."""
    names = [c for c in S.PROCESSED_COLUMNS
             if include_processing_time or c != "processing_timestamp"]
    return df.select(*names, *[c for c in (extra or []) if c not in names])


def invalid_projection(df: DataFrame, *, extra: list[str] | None = None) -> DataFrame:
    """V9: the 6-column invalid feed (plus ``extra`` columns, e.g. the reject reason)."""
    return df.select(*S.INVALID_COLUMNS, *[c for c in (extra or []) if c not in S.INVALID_COLUMNS])


def aggregate_projection(df: DataFrame) -> DataFrame:
    """V9: the 24-column windowed feed."""
    return df.select(*S.AGGREGATE_COLUMNS)


def console_projection(df: DataFrame) -> DataFrame:
    """V9: the 8-column console monitor."""
    return df.select(*S.CONSOLE_COLUMNS)


def encode_kv(df: DataFrame, *, key: str = "icao24", ignore_null_fields: bool = True
              ) -> DataFrame:
    """K1: ``key = CAST(key AS STRING), value = to_json(struct(*))``."""
    opts = {} if ignore_null_fields else {"ignoreNullFields": "false"}
    return df.select(F.col(key).cast("string").alias("key"),
                     F.to_json(F.struct(*[F.col(c) for c in df.columns]), opts).alias("value"))
