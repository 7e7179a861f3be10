"""Mergeable summaries: what the reports need of a slice of the feed, in one row.

A summary holds counts, sums and extremes, which merge exactly, and three sketches of
bounded size, which merge with a stated error:

* distinct entities (HyperLogLog): relative standard error ``1.04 / sqrt(2 ** LG_K)``;
* frequent entities (frequent items): an entity's true count is at most its estimate,
  and below it by at most :func:`top_error` rows;
* quantiles of the score and of the velocity (KLL): rank error :data:`RANK_ERROR`.

Next to it, :func:`dimension_counts` keeps the exact counts of the small dimensions
(phase, ground, compass direction, country), a row for each combination that occurs.

Summaries of days, micro-batches or partitions merge in any grouping, so a report over
the whole feed reads one small row a slice and no event twice.  Values with an error
have names of their own (``approx_...``); exact forms are in
:mod:`trackstream.operators.reports` and :func:`exact_distinct`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackstream.functions import expressions as X
from trackstream.schema import FLIGHT, FlightColumns

LG_K = 12                      # registers of the distinct sketch: 2 ** 12
TOP_ITEMS = 768                # entities that the frequent-items sketch tracks
KLL_K = 4096                   # size of the quantile sketch
RANK_ERROR = 0.002             # of a quantile at that size, with a margin
MEASURES = ("velocity", "altitude", "vertical_rate")
DIMENSIONS = ("phase", "on_ground", "compass", "country")


def _measures(cols: FlightColumns) -> dict[str, str]:
    return {"velocity": cols.velocity, "altitude": cols.altitude,
            "vertical_rate": cols.vertical_rate}


def top_error(rows, items: int = TOP_ITEMS):
    """Rows by which an estimated count may exceed the true one: 3.5 / s of all rows,
    where s is the number of the sketch's slots, a power of two that ``items`` fill to
    three quarters at most."""
    slots = 1 << (-(-items * 4 // 3) - 1).bit_length()
    return rows * 3.5 / slots


def summarize(df: DataFrame, *, by: list | None = None, flag_col: str | None = None,
              score_col: str | None = None, cols: FlightColumns = FLIGHT) -> DataFrame:
    """One summary row, or one for each value of the columns ``by``."""
    flag = flag_col or cols.ml_flag
    score = score_col or cols.ml_score
    flag = F.col(flag) if flag in df.columns else F.lit(False)
    score = (F.col(score) if score in df.columns else F.lit(None)).cast("double")
    aggs = [F.count(F.lit(1)).alias("rows"), F.count_if(flag).alias("anomalies"),
            F.count(cols.lat).alias("with_position"), F.count(cols.altitude).alias("with_altitude"),
            F.count(score).alias("scored"), F.sum(score).alias("score_sum"),
            F.hll_sketch_agg(cols.key, LG_K).alias("keys"),
            F.expr(f"approx_top_k_accumulate(`{cols.key}`, {TOP_ITEMS})").alias("top_keys"),
            F.kll_sketch_agg_double(score, F.lit(KLL_K)).alias("score_ranks"),
            F.kll_sketch_agg_double(F.col(cols.velocity), F.lit(KLL_K)).alias("velocity_ranks")]
    for name, c in _measures(cols).items():
        aggs += [F.count(c).alias(f"n_{name}"), F.sum(c).alias(f"sum_{name}"),
                 F.min(c).alias(f"min_{name}"), F.max(c).alias(f"max_{name}")]
    return df.groupBy(*(by or [])).agg(*aggs)


def merge(summaries: DataFrame, *, by: list | None = None) -> DataFrame:
    """One row from any number of summaries, of the same columns."""
    sums = ["rows", "anomalies", "with_position", "with_altitude", "scored", "score_sum"]
    aggs = [F.sum(c).alias(c) for c in sums]
    aggs += [F.hll_union_agg("keys").alias("keys"),
             F.expr(f"approx_top_k_combine(top_keys, {TOP_ITEMS})").alias("top_keys"),
             F.kll_merge_agg_double("score_ranks", F.lit(KLL_K)).alias("score_ranks"),
             F.kll_merge_agg_double("velocity_ranks", F.lit(KLL_K)).alias("velocity_ranks")]
    for name in MEASURES:
        aggs += [F.sum(f"n_{name}").alias(f"n_{name}"), F.sum(f"sum_{name}").alias(f"sum_{name}"),
                 F.min(f"min_{name}").alias(f"min_{name}"), F.max(f"max_{name}").alias(f"max_{name}")]
    # grouped by a constant: an empty partition then has no sketch to hand on
    return summaries.groupBy(*(by or [F.lit(1).alias("_all")])).agg(*aggs).drop("_all")


def dimension_counts(df: DataFrame, *, by: list | None = None,
                     cols: FlightColumns = FLIGHT) -> DataFrame:
    """Exact counts of the small dimensions, a row for each combination that occurs."""
    return df.groupBy(*(by or []), F.col(cols.phase).alias("phase"),
                      F.col(cols.on_ground).alias("on_ground"),
                      X.compass_bin(cols.heading).alias("compass"),
                      F.col(cols.category).alias("country")).agg(F.count(F.lit(1)).alias("events"))


def merge_counts(counts: DataFrame) -> DataFrame:
    return counts.groupBy(*DIMENSIONS).agg(F.sum("events").alias("events"))


def exact_distinct(windows: DataFrame, *, key: str = "icao24") -> DataFrame:
    """Distinct entities, exactly, from per-entity windows: one row an entity and window
    is counted instead of every event."""
    return windows.agg(F.countDistinct(key).alias("unique_aircraft"))


# --- reports from a merged summary ------------------------------------------

def _mean(name: str) -> Column:
    return F.try_divide(F.col(f"sum_{name}"), F.col(f"n_{name}"))


def kpi_summary(merged: DataFrame) -> DataFrame:
    """As ``reports.kpi_summary``, but for ``approx_unique_aircraft``."""
    return merged.select(
        F.col("rows").alias("total_events"), "anomalies", _mean("velocity").alias("avg_velocity"),
        _mean("altitude").alias("avg_altitude"),
        F.hll_sketch_estimate("keys").alias("approx_unique_aircraft"),
        X.safe_ratio(F.col("anomalies") * 100, F.col("rows")).alias("anomaly_rate"))


def summary_stats(merged: DataFrame) -> DataFrame:
    """A8."""
    out = []
    for name in MEASURES:
        out += [F.col(f"min_{name}"), _mean(name).alias(f"mean_{name}"), F.col(f"max_{name}")]
    return merged.select(*out)


def anomaly_stats(merged: DataFrame) -> DataFrame:
    """Counts, shares and mean score, with the score's approximate 99 % point."""
    return merged.select(
        F.col("rows").alias("total_events"), F.col("anomalies").alias("anomaly_count"),
        F.try_divide(F.col("anomalies"), F.col("rows")).alias("anomaly_share"),
        F.try_divide(F.col("score_sum"), F.col("scored")).alias("avg_score"),
        X.safe_ratio(F.col("anomalies") * 100, F.col("rows")).alias("anomaly_rate"),
        score_quantile(0.99).alias("approx_score_99"))


def score_quantile(q: float, ranks: str = "score_ranks") -> Column:
    """A quantile from a sketch (NULL where nothing was counted)."""
    return F.when(F.kll_sketch_get_n_double(ranks) > 0,
                  F.kll_sketch_get_quantile_double(ranks, F.lit(q)))


def top_aircraft(merged: DataFrame, k: int = 15) -> DataFrame:
    """Entities by estimated count with the bounds that hold for the true count."""
    error = F.ceil(top_error(F.col("rows")))
    items = merged.select(F.explode(F.expr(f"approx_top_k_estimate(top_keys, {k})")).alias("t"),
                          error.alias("error"))
    return items.select(F.col("t.item").alias("icao24"), F.col("t.count").alias("approx_events"),
                        F.greatest(F.col("t.count") - F.col("error"), F.lit(1)).alias("least_events"),
                        F.col("t.count").alias("most_events"))


def by_dimension(counts: DataFrame, dimension: str, out: str | None = None) -> DataFrame:
    """Exact counts of one dimension (NULL left out)."""
    return (counts.filter(F.col(dimension).isNotNull()).groupBy(F.col(dimension).alias(out or dimension))
            .agg(F.sum("events").alias("events")))


def top_countries(counts: DataFrame, k: int = 12) -> DataFrame:
    """A12, exact."""
    return (by_dimension(counts, "country", "origin_country")
            .orderBy(F.col("events").desc(), "origin_country").limit(k))


def flag_drift(summaries: DataFrame, by: list) -> DataFrame:
    """The flagged share and the score's 99 % point of each slice."""
    return summaries.select(*by, "rows", F.try_divide(F.col("anomalies"), F.col("rows")).alias("share"),
                            score_quantile(0.99).alias("approx_score_99"))
