"""Summary reports over a processed table or micro-batch: KPIs, statistics,
distributions, top-k, histograms, data quality, model evaluation.

Each report is a distributed aggregate (partial + final) or a
``orderBy().limit()`` (per-partition top-k, then a merge); none collects rows.
The only driver round-trips are fixed-size scalars: the two histogram edges
and the per-feature mean/std of the scaler.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackstream import schema as S
from trackstream.functions import expressions as X
from trackstream.operators.windows import arrival_order
from trackstream.schema import FLIGHT, FlightColumns


def present_columns(df: DataFrame, wanted: list[str]) -> list[str]:
    """The subset of ``wanted`` that exists, in the given order."""
    have = set(df.columns)
    return [c for c in wanted if c in have]


def require_columns(df: DataFrame, wanted: list[str]) -> None:
    """Raise with the list of missing columns."""
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")


def _flag(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(False)


def kpi_summary(df: DataFrame, *, flag_col: str | None = None,
                cols: FlightColumns = FLIGHT) -> DataFrame:
    """Total events, anomaly count and %, mean velocity, mean altitude,
    distinct entities (HLL++ on streams)."""
    flag = _flag(df, flag_col or cols.ml_flag)
    distinct = (F.approx_count_distinct(cols.key) if df.isStreaming
                else F.countDistinct(cols.key))
    g = df.agg(F.count(F.lit(1)).alias("total_events"),
               F.count_if(flag).alias("anomalies"),
               F.avg(cols.velocity).alias("avg_velocity"),
               F.avg(cols.altitude).alias("avg_altitude"),
               distinct.alias("unique_aircraft"))
    return g.withColumn("anomaly_rate", X.safe_ratio(F.col("anomalies") * 100,
                                                     F.col("total_events")))


def summary_stats(df: DataFrame, *, cols: FlightColumns = FLIGHT) -> DataFrame:
    """min/mean/max of velocity, altitude and vertical rate (one row)."""
    aggs = []
    for name, c in (("velocity", cols.velocity), ("altitude", cols.altitude),
                    ("vertical_rate", cols.vertical_rate)):
        aggs += [F.min(c).alias(f"min_{name}"), F.avg(c).alias(f"mean_{name}"),
                 F.max(c).alias(f"max_{name}")]
    return df.agg(*aggs)


def anomaly_stats(df: DataFrame, *, flag_col: str | None = None,
                  score_col: str | None = None, cols: FlightColumns = FLIGHT) -> DataFrame:
    """Anomaly count, rate (%), mean score, predicted-anomalous share."""
    flag = _flag(df, flag_col or cols.ml_flag)
    score = score_col or cols.ml_score
    aggs = [F.count(F.lit(1)).alias("total_events"),
            F.count_if(flag).alias("anomaly_count"),
            F.avg(flag.cast("double")).alias("anomaly_share")]
    if score in df.columns:
        aggs.append(F.avg(score).alias("avg_score"))
    g = df.agg(*aggs)
    return g.withColumn("anomaly_rate", X.safe_ratio(F.col("anomaly_count") * 100,
                                                     F.col("total_events")))


def frequency(df: DataFrame, col_name: str, *, out: str = "events",
              drop_null: bool = True) -> DataFrame:
    """Value counts of one column (NULL dropped like pandas ``value_counts``)."""
    base = df.filter(F.col(col_name).isNotNull()) if drop_null else df
    return base.groupBy(col_name).agg(F.count(F.lit(1)).alias(out))


def phase_distribution(df: DataFrame, *, cols: FlightColumns = FLIGHT) -> DataFrame:
    """A10."""
    return frequency(df, cols.phase)


def ground_status(df: DataFrame, *, cols: FlightColumns = FLIGHT) -> DataFrame:
    """Counts by on_ground with 'On Ground' / 'In Air' labels."""
    return (frequency(df, cols.on_ground)
            .withColumn("status", X.ground_label(cols.on_ground)))


def top_k(df: DataFrame, col_name: str, k: int, *, out: str = "events") -> DataFrame:
    """The ``k`` most frequent values, ties broken by value."""
    return (frequency(df, col_name, out=out)
            .orderBy(F.col(out).desc(), F.col(col_name).asc()).limit(k))


def top_countries(df: DataFrame, *, k: int = 12, cols: FlightColumns = FLIGHT) -> DataFrame:
    """A12."""
    return top_k(df, cols.category, k)


def top_aircraft(df: DataFrame, *, k: int = 15, cols: FlightColumns = FLIGHT) -> DataFrame:
    """Most active entities with the first-seen label (falling back to
    the key when that label is NULL or empty), folded into the aggregate
    instead of a per-key lookup."""
    order = arrival_order(df, cols)
    g = (df.filter(F.col(cols.key).isNotNull())
           .groupBy(cols.key)
           .agg(F.count(F.lit(1)).alias("events"),
                F.min_by(cols.label, order).alias("_first_label")))
    return (g.withColumn("aircraft", F.coalesce(F.nullif(F.col("_first_label"), F.lit("")),
                                                F.col(cols.key)))
             .drop("_first_label")
             .orderBy(F.col("events").desc(), F.col(cols.key).asc()).limit(k))


def _beside(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """``df`` with the columns of a one-row aggregate of it (a proven broadcast bound).

    Nothing runs while the plan is built, and where ``df`` holds a shuffle both sides
    read it, so its source is scanned once."""
    return (df.withColumn("_one", F.lit(1))
              .join(F.broadcast(one_row.withColumn("_one", F.lit(1))), "_one").drop("_one"))


def histogram(df: DataFrame, col_name: str, *, bins: int = 40,
              lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Equal-width histogram over [lo, hi] (measured when not given); the
    top edge falls into the last bin.  Non-empty bins only."""
    values = df.select(F.col(col_name).alias("_x"))
    rows = values.filter(F.col("_x").isNotNull() & ~F.isnan("_x"))
    if lo is None or hi is None:
        rows = _beside(rows, values.agg(F.min("_x").cast("double").alias("_lo"),
                                        F.max("_x").cast("double").alias("_hi")))
    else:
        rows = rows.withColumns({"_lo": F.lit(float(lo)), "_hi": F.lit(float(hi))})
    rows = rows.withColumn("_width", (F.col("_hi") - F.col("_lo")) / bins)
    b = F.when(F.col("_width") > 0, F.least(F.floor((F.col("_x") - F.col("_lo")) / F.col("_width")),
                                            F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")
    g = rows.groupBy(b.alias("bin_no")).agg(
        F.count(F.lit(1)).alias("events"), F.first("_lo").alias("_lo"), F.first("_width").alias("_width"))
    return g.select("bin_no", "events", (F.col("_lo") + F.col("bin_no") * F.col("_width")).alias("bin_start"),
                    (F.col("_lo") + (F.col("bin_no") + 1) * F.col("_width")).alias("bin_end"))


def velocity_histogram(df: DataFrame, *, bins: int = 40,
                       cols: FlightColumns = FLIGHT) -> DataFrame:
    return histogram(df, cols.velocity, bins=bins)


def heading_distribution(df: DataFrame, *, centered: bool = False,
                         cols: FlightColumns = FLIGHT) -> DataFrame:
    """Rows per compass direction, with ``bin_no`` for display order."""
    b = X.compass_bin(cols.heading, centered=centered)
    g = (df.select(b.alias("bin_no")).filter(F.col("bin_no").isNotNull())
           .groupBy("bin_no").agg(F.count(F.lit(1)).alias("events")))
    return g.withColumn("direction", X.compass_label("bin_no"))


def data_quality_report(df: DataFrame, *, cols: FlightColumns = FLIGHT) -> DataFrame:
    """(metric, value) rows: total events, distinct entities, events
    with a position, events with an altitude, events per entity (1 dp)."""
    g = df.agg(F.count(F.lit(1)).alias("total"),
               F.countDistinct(cols.key).alias("distinct_keys"),
               F.count(cols.lat).alias("with_position"),
               F.count(cols.altitude).alias("with_altitude"))
    g = g.withColumn("per_key", F.round(F.col("total") / F.greatest(F.col("distinct_keys"),
                                                                    F.lit(1)), 1))
    stacked = F.expr(
        "stack(5, 'Total Events Processed', cast(total as double), "
        "'Unique Aircraft', cast(distinct_keys as double), "
        "'Events with Valid Position', cast(with_position as double), "
        "'Events with Altitude', cast(with_altitude as double), "
        "'Average Events/Aircraft', cast(per_key as double)) as (metric, value)")
    return g.select(stacked)


def latest(df: DataFrame, n: int, *, order: list[str] | None = None,
           columns: list[str] | None = None, cols: FlightColumns = FLIGHT) -> DataFrame:
    """The last ``n`` rows by (event_time, tiebreak) — arrival order
    does not exist in a distributed table, so event time stands in for it."""
    order = order or [c for c in (cols.event_time, cols.tiebreak) if c in df.columns]
    out = df.orderBy(*[F.col(c).desc() for c in order]).limit(n)
    return out.select(*columns) if columns else out


def recent_anomalies(df: DataFrame, *, n: int = 10, flag_col: str | None = None,
                     score_col: str | None = None, cols: FlightColumns = FLIGHT) -> DataFrame:
    """The last ``n`` flagged rows (key, label, velocity, score)."""
    flag = flag_col or cols.ml_flag
    score = score_col or cols.ml_score
    show = present_columns(df, [cols.key, cols.label, cols.velocity, score])
    keep = show + [c for c in (cols.event_time, cols.tiebreak) if c in df.columns]
    return latest(df.filter(F.col(flag)).select(*dict.fromkeys(keep)), n,
                  columns=show, cols=cols)


def position_source_label(df: DataFrame, *, cols: FlightColumns = FLIGHT) -> DataFrame:
    """Decode the position-source enum with a broadcast join against a
    4-row dimension (fixed size, so the broadcast bound is proven)."""
    spark = df.sparkSession
    rows = F.array(*[F.struct(F.lit(k).cast("int").alias(cols.position_source),
                              F.lit(v).alias("position_source_label"))
                     for k, v in S.POSITION_SOURCE_LABELS])
    dim = spark.range(1).select(F.inline(rows))     # literal rows, JVM-side
    return df.join(F.broadcast(dim), cols.position_source, "left")


# --------------------------------------------------------------------------
# Model-side reports
# --------------------------------------------------------------------------

def scaler_stats(df: DataFrame, *, features: list[str] | None = None) -> DataFrame:
    """Per feature, mean and population std (what a standard scaler fits),
    as rows (feature, mean, std)."""
    features = features or S.MODEL_FEATURES
    aggs = []
    for f in features:
        aggs += [F.avg(F.col(f).cast("double")).alias(f"m_{f}"),
                 F.stddev_pop(F.col(f).cast("double")).alias(f"s_{f}")]
    one = df.agg(*aggs)
    parts = ", ".join(f"'{f}', `m_{f}`, `s_{f}`" for f in features)
    return one.select(F.expr(f"stack({len(features)}, {parts}) as (feature, mean, std)"))


def fit_scaler(df: DataFrame, *, features: list[str] | None = None) -> dict[str, tuple]:
    """Scaler parameters as {feature: (mean, std)} — 2 scalars per feature."""
    features = features or S.MODEL_FEATURES
    rows = scaler_stats(df, features=features).collect()
    return {r["feature"]: (r["mean"], r["std"]) for r in rows}


def standardize(df: DataFrame, *, features: list[str] | None = None,
                suffix: str = "_scaled") -> DataFrame:
    """Fit and scale in one plan: (x - mean) / std of the table itself."""
    features = features or S.MODEL_FEATURES
    stats = df.agg(*[f(F.col(c).cast("double")).alias(f"_{n}_{c}") for c in features
                     for n, f in (("m", F.avg), ("s", F.stddev_pop))])
    out = _beside(df, stats)
    scale = {c: F.when(F.col(f"_s_{c}").isNull() | (F.col(f"_s_{c}") == 0), 1.0)
             .otherwise(F.col(f"_s_{c}")) for c in features}
    scaled = {c + suffix: (F.col(c).cast("double") - F.col(f"_m_{c}")) / scale[c] for c in features}
    return out.withColumns(scaled).drop(*[f"_{n}_{c}" for c in features for n in "ms"])


def scaled_features(df: DataFrame, params: dict[str, tuple], *,
                    suffix: str = "_scaled") -> DataFrame:
    """M3 with known parameters: (x - mean) / std per feature; a zero std scales by 1."""
    out = {}
    for f, (mean, std) in params.items():
        scale = std if std not in (None, 0.0) else 1.0
        out[f + suffix] = (F.col(f).cast("double") - F.lit(mean)) / F.lit(scale)
    return df.withColumns(out)


def classification_report(df: DataFrame, *, label_col: str, pred_col: str) -> DataFrame:
    """Per class precision, recall, f1 and support (zero-division -> 0).

    One aggregate to a K x K confusion table (K = number of classes), then
    per-class sums over that tiny table — no per-row work beyond the first
    aggregate.
    """
    conf = df.groupBy(F.col(label_col).alias("_l"), F.col(pred_col).alias("_p")).count()
    as_label = conf.select(F.col("_l").alias("class"), F.col("count").alias("support"),
                           F.when(F.col("_l") == F.col("_p"), F.col("count"))
                            .otherwise(F.lit(0)).alias("tp"),
                           F.lit(0).cast("bigint").alias("predicted"))
    as_pred = conf.select(F.col("_p").alias("class"), F.lit(0).cast("bigint").alias("support"),
                          F.lit(0).cast("bigint").alias("tp"),
                          F.col("count").alias("predicted"))
    per = (as_label.unionByName(as_pred).groupBy("class")
           .agg(F.sum("support").alias("support"), F.sum("tp").alias("tp"),
                F.sum("predicted").alias("predicted")))
    p = X.safe_ratio(F.col("tp"), F.col("predicted"))
    r = X.safe_ratio(F.col("tp"), F.col("support"))
    return (per.withColumns({"precision": p, "recall": r})
               .withColumn("f1", X.safe_ratio(2 * F.col("precision") * F.col("recall"),
                                              F.col("precision") + F.col("recall")))
               .select(F.col("class").cast("string").alias("class"), "precision", "recall",
                       "f1", "support"))
