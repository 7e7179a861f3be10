"""Keyed JSON messages: envelope projection, payload parse, doubly-encoded
unwrap and dead-letter routing (S2-S4, S10, S11), plus a deterministic message
feed derived from flight rows (for the batch checks and file-fed streams)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackstream.schema import FLIGHT_SCHEMA_WITH_ID

CORRUPT = "_corrupt_record"

# Moduli of the planted message defects in derived feeds.
NOT_JSON_EVERY = 53
NULL_VALUE_EVERY = 61
WRONG_TYPE_EVERY = 59
NESTED_EVERY = 7


def envelope(df: DataFrame) -> DataFrame:
    """Key / value as text, broker timestamp as ``kafka_timestamp``."""
    return df.select(F.col("key").cast("string").alias("key"),
                     F.col("value").cast("string").alias("value"),
                     F.col("timestamp").alias("kafka_timestamp"))


def unwrap_nested_json(df: DataFrame, *, value_col: str = "value") -> DataFrame:
    """``{"value": "<json>"}`` -> ``<json>``; other text unchanged.

    Only text with the letters of the key, or with an escape that may write them, is
    parsed for it."""
    v = F.col(value_col)
    inner = F.when(v.contains("value") | v.contains("\\"), F.get_json_object(v, "$.value"))
    return df.withColumn(value_col, F.coalesce(inner, v))


def _computed(df: DataFrame, **columns) -> DataFrame:
    """``df`` with columns that are computed once a row.  A filter or projection behind a
    plain column is written through it, and its expression runs once for each of them;
    none is written through a generator."""
    for name, value in columns.items():
        df = df.withColumn(name, F.explode(F.array(value)))
    return df


def _unwrapped(df: DataFrame, value_col: str) -> DataFrame:
    return _computed(unwrap_nested_json(df, value_col=value_col), **{value_col: F.col(value_col)})


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])


def parse_payload(df: DataFrame, *, schema: T.StructType = FLIGHT_SCHEMA_WITH_ID,
                  value_col: str = "value", keep: list[str] | None = None,
                  keep_corrupt: bool = False) -> DataFrame:
    """Parse the JSON value with a fixed schema (PERMISSIVE) and flatten
    it next to the envelope columns in ``keep`` (default: every non-value
    column).  With ``keep_corrupt`` the raw text of records that did not fully
    match the schema is kept in ``_corrupt_record``."""
    keep = keep if keep is not None else [c for c in df.columns if c != value_col]
    parse_schema = _with_corrupt(schema) if keep_corrupt else schema
    opts = {"columnNameOfCorruptRecord": CORRUPT} if keep_corrupt else {}
    texts = df.select(*keep, value_col, *([F.col(value_col).alias("_raw")] if keep_corrupt else []))
    parsed = _computed(texts, _p=F.from_json(F.col(value_col), parse_schema, opts))
    fields = [F.col(f"_p.{f.name}").alias(f.name) for f in parse_schema.fields]
    return parsed.select(*keep, *fields, *(["_raw"] if keep_corrupt else []))


def classify_payload(df: DataFrame, *, value_col: str = "value") -> DataFrame:
    """``payload_error`` = 'null_value' | 'malformed_json' | NULL for a
    parseable JSON object."""
    v = F.col(value_col)
    err = (F.when(v.isNull(), F.lit("null_value"))
            .when(F.json_object_keys(v).isNull(), F.lit("malformed_json")))
    return df.withColumn("payload_error", err)


def dead_letters(df: DataFrame, *, schema: T.StructType = FLIGHT_SCHEMA_WITH_ID,
                 value_col: str = "value", critical: dict | None = None) -> DataFrame:
    """Messages that cannot be used as records — NULL value, not a JSON
    object, or a field whose JSON type does not match the schema — with the
    reason, instead of silently dropping them.

    ``critical`` maps further reasons to conditions on the parsed record, in
    order, e.g. those under which cleaning would drop it."""
    classified = classify_payload(_unwrapped(df, value_col), value_col=value_col)
    parsed = parse_payload(classified, schema=schema, value_col=value_col,
                           keep=[c for c in classified.columns if c != value_col],
                           keep_corrupt=True)
    reason = F.coalesce(F.col("payload_error"),
                        F.when(F.col(CORRUPT).isNotNull(), F.lit("wrong_type")),
                        *[F.when(c, F.lit(name)) for name, c in (critical or {}).items()])
    keep = [c for c in df.columns if c != value_col]
    return (parsed.withColumn("reason", reason).filter(F.col("reason").isNotNull())
                  .select(*keep, F.col("_raw").alias(value_col), "reason"))


def good_records(df: DataFrame, *, schema: T.StructType = FLIGHT_SCHEMA_WITH_ID,
                 value_col: str = "value", keep_wrong_type: bool = True) -> DataFrame:
    """Messages that parse as a JSON object, unwrapped and flattened.  A
    wrong-typed field becomes NULL, as in PERMISSIVE parsing; without
    ``keep_wrong_type`` such a message is left to :func:`dead_letters` alone."""
    classified = classify_payload(_unwrapped(df, value_col), value_col=value_col)
    ok = classified.filter(F.col("payload_error").isNull()).drop("payload_error")
    if keep_wrong_type:
        return parse_payload(ok, schema=schema, value_col=value_col)
    parsed = parse_payload(ok, schema=schema, value_col=value_col, keep_corrupt=True)
    return parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, "_raw")


def raw_field_text(df: DataFrame, fields: list[str], *, value_col: str = "value",
                   prefix: str = "raw_") -> DataFrame:
    """Raw JSON text of selected fields (for the wrong-type rule, V8), all
    extracted by one ``json_tuple`` parse per message."""
    return df.select("*", F.json_tuple(F.col(value_col), *fields)
                     .alias(*[prefix + f for f in fields]))


# --------------------------------------------------------------------------
# Deterministic message feed derived from flight rows
# --------------------------------------------------------------------------

def messages_from_flights(flights: DataFrame, *, id_col: str = "event_id",
                          ts_col: str | None = None, with_defects: bool = True,
                          wrong_fields: list[str] | None = None) -> DataFrame:
    """Encode flight rows as keyed JSON messages (K1 applied to the adapter):
    ``key, value, timestamp``.  With ``with_defects``, every 53rd id is not
    JSON, every 61st has a NULL value, every 59th carries latitude as the text
    'north', and every 7th is doubly encoded as ``{"value": "<json>"}``."""
    fields = [f.name for f in FLIGHT_SCHEMA_WITH_ID.fields]
    i = F.col(id_col)
    good = F.to_json(F.struct(*[F.col(f) for f in fields]))
    if with_defects:
        # One encoding per row; the defects are cheap text edits of it.
        wrong = F.regexp_replace(good, r'"latitude":[^,}]*', '"latitude":"north"')
        for n, field in enumerate(wrong_fields or []):
            here = F.regexp_replace(good, f'"{field}":[^,}}]*', f'"{field}":"n/a"')
            mine = F.expr(f"{id_col} div {WRONG_TYPE_EVERY} % {len(wrong_fields)} = {n}")
            wrong = F.when(mine, here).otherwise(wrong) if n else F.when(mine, here)
        body = F.when(i % WRONG_TYPE_EVERY == 0, wrong).otherwise(good)
        nested = F.concat(F.lit('{"value":'),
                          F.regexp_extract(F.to_json(F.array(body)), r"^\[(.*)\]$", 1),
                          F.lit("}"))
        body = F.when(i % NESTED_EVERY == 0, nested).otherwise(body)
        value = (F.when(i % NOT_JSON_EVERY == 0, F.concat(F.lit("not json #"), i.cast("string")))
                  .when(i % NULL_VALUE_EVERY == 0, F.lit(None).cast("string"))
                  .otherwise(body))
    else:
        value = good
    ts = F.col(ts_col) if ts_col else F.try_to_timestamp(F.col("ingestion_timestamp"))
    return flights.select(F.col("icao24").cast("binary").alias("key"),
                          value.cast("binary").alias("value"),
                          ts.alias("timestamp"))
