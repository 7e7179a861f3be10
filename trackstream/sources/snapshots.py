"""API snapshot documents: one JSON document holds ``time`` and ``states``, an
array of 17-slot positional, mixed-type arrays (S5-S7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackstream import schema as S
from trackstream.functions.expressions import iso_utc_text, strip_text

SNAPSHOT_DDL = "time bigint, states array<array<string>>"

# Fixed values for derived snapshot feeds.
IDS_PER_DOCUMENT = 8          # consecutive ids grouped into one document
EMPTY_DOCUMENT_EVERY = 50     # every 50th document has no 'states' member


def explode_states(docs: DataFrame, *, doc_col: str = "doc") -> DataFrame:
    """Document -> one row per state vector (``snapshot_time``, ``state``);
    a document without ``states`` yields no rows."""
    p = F.from_json(F.col(doc_col), SNAPSHOT_DDL)
    keep = [c for c in docs.columns if c != doc_col]
    return (docs.select(*keep, p.alias("_d"))
                .select(*keep, F.col("_d.time").alias("snapshot_time"),
                        F.explode(F.coalesce(F.col("_d.states"),
                                             F.array().cast("array<array<string>>")))
                         .alias("state")))


def _slot(st: Column, name: str) -> Column:
    return F.try_element_at(st, F.lit(S.STATE_VECTOR_SLOTS[name] + 1))


def decode_states(df: DataFrame, *, state_col: str = "state",
                  ingest_time: Column | None = None) -> DataFrame:
    """Positional vector -> flight record.  Values are typed with
    ``try_cast`` (bad text -> NULL), the callsign is stripped, the ingestion
    stamp is written as ``yyyy-MM-ddTHH:mm:ssZ`` (default: now) and
    ``data_valid`` is true."""
    st = F.col(state_col)
    ingest = ingest_time if ingest_time is not None else F.current_timestamp()
    typed = {
        "icao24": "string", "callsign": "string", "origin_country": "string",
        "time_position": "bigint", "longitude": "double", "latitude": "double",
        "baro_altitude": "double", "on_ground": "boolean", "velocity": "double",
        "heading": "double", "vertical_rate": "double", "geo_altitude": "double",
        "position_source": "int",
    }
    out = []
    for name, t in typed.items():
        v = _slot(st, name)
        if name == "callsign":
            v = strip_text(v)
        elif t != "string":
            v = F.try_cast(v, t) if hasattr(F, "try_cast") else v.try_cast(t)
        out.append(v.alias(name))
    keep = [c for c in df.columns if c != state_col]
    return df.select(*keep, *out, iso_utc_text(ingest).alias("ingestion_timestamp"),
                     F.lit(True).alias("data_valid"))


def bbox_filter(df: DataFrame, *, lat: str = "latitude", lon: str = "longitude",
                lat_min: float = S.DEFAULT_BBOX["lat_min"],
                lat_max: float = S.DEFAULT_BBOX["lat_max"],
                lon_min: float = S.DEFAULT_BBOX["lon_min"],
                lon_max: float = S.DEFAULT_BBOX["lon_max"]) -> DataFrame:
    """Inclusive bounding box; NULL positions are excluded.  On a parquet
    scan the bounds become pushed row-group filters."""
    return df.filter(F.col(lat).between(lat_min, lat_max)
                     & F.col(lon).between(lon_min, lon_max))


# --------------------------------------------------------------------------
# Deterministic snapshot feed derived from flight rows
# --------------------------------------------------------------------------

def _json_text(x: Column, kind: str) -> Column:
    """JSON text of one value: strings quoted/escaped, numbers and booleans
    bare, NULL as null."""
    if kind == "string":
        quoted = F.regexp_extract(F.to_json(F.array(x)), r"^\[(.*)\]$", 1)
        return F.when(x.isNull(), F.lit("null")).otherwise(quoted)
    return F.coalesce(x.cast("string"), F.lit("null"))


def snapshots_from_flights(flights: DataFrame, *, id_col: str = "event_id",
                           ts_col: str = "source_ts") -> DataFrame:
    """Pack flight rows into API-style documents: rows of
    ``IDS_PER_DOCUMENT`` consecutive ids share one document (a bounded group),
    the callsign is padded with a trailing space as at the source, and unused
    slots carry the same types the API sends.  Returns ``doc_no, doc``."""
    kinds = {"icao24": "string", "callsign": "string", "origin_country": "string",
             "time_position": "num", "longitude": "num", "latitude": "num",
             "baro_altitude": "num", "on_ground": "num", "velocity": "num",
             "heading": "num", "vertical_rate": "num", "geo_altitude": "num",
             "position_source": "num"}
    slots = [F.lit("null")] * S.STATE_VECTOR_LENGTH
    for name, kind in kinds.items():
        slots[S.STATE_VECTOR_SLOTS[name]] = _json_text(F.col(name), kind)
    slots[4] = _json_text(F.col("time_position"), "num")          # last_contact
    slots[14] = F.lit('"0000"')                                    # squawk
    slots[15] = F.lit("false")                                     # spi
    vector = F.concat(F.lit("["), F.concat_ws(",", *slots), F.lit("]"))
    doc_no = F.floor(F.col(id_col) / IDS_PER_DOCUMENT)
    g = (flights.select(doc_no.alias("doc_no"), F.unix_seconds(F.col(ts_col).cast("timestamp"))
                        .alias("_t"), vector.alias("_v"))
                .groupBy("doc_no")
                .agg(F.min("_t").alias("_time"), F.collect_list("_v").alias("_vs")))
    states = F.concat(F.lit(',"states":['), F.concat_ws(",", F.col("_vs")), F.lit("]"))
    body = F.when(F.col("doc_no") % EMPTY_DOCUMENT_EVERY == 0, F.lit("")).otherwise(states)
    return g.select("doc_no", F.concat(F.lit('{"time":'), F.col("_time").cast("string"),
                                       body, F.lit("}")).alias("doc"))
