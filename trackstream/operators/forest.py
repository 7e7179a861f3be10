"""Distributed isolation forest (Liu, Ting & Zhou, 2008): fit, score,
threshold, evaluation and model tables (M1-M4, U1, U2, U4, U6).

Fit, as Spark jobs:

1. Identity and features are written once as a narrow table; count, sample and
   calibration read it.  A row's identity hashes its id, key, position time and
   features, so a feed without ids works; equal rows are told apart by a number.
   Every (row, tree) pair is drawn with one probability at every input size, so
   that a tree expects ``1.25 * psi`` rows and holds a row at most once.  No rows
   go to the driver and the result does not depend on partitioning.
2. ``groupBy(tree_id).applyInPandas`` builds one tree per group from its
   ``psi`` lowest-hash rows: the algorithm's own sub-sample of
   ``psi = min(psi, rows)`` rows, a parameter and not a cap on the data.
3. The node table has at most ``trees * (2 * psi - 1)`` rows — a proven bound
   — so it is collected once and broadcast.

Scoring is an Arrow-batched pandas UDF: every batch walks all trees at once
with numpy.  The score is normalised with the *training* minimum and maximum
of the raw score, so a row's score never depends on its batch mates, and the
flag is ``raw > threshold`` with the threshold at the (1 - contamination)
quantile of the training scores (``percentile_approx``, distributed).
Per-feature affine scaling does not change an isolation forest (splits are
uniform between the node's minimum and maximum), so the scaler is a separate
operator (:func:`trackstream.operators.reports.scaled_features`).
"""

from __future__ import annotations

import hashlib
import json
import math
import uuid
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackstream import schema as S
from trackstream.functions.expressions import anomaly_reason
from trackstream.operators.reports import require_columns
from trackstream.schema import FLIGHT, FlightColumns
from trackstream.session import checkpoint_dir, ship_package

NODE_SCHEMA = T.StructType([
    T.StructField("tree_id", T.IntegerType()),
    T.StructField("node_id", T.IntegerType()),
    T.StructField("feature", T.IntegerType()),      # -1 for a leaf
    T.StructField("threshold", T.DoubleType()),
    T.StructField("left", T.IntegerType()),
    T.StructField("right", T.IntegerType()),
    T.StructField("size", T.IntegerType()),         # rows reaching a leaf
    T.StructField("depth", T.IntegerType()),
])

_HASH_SPACE = float(2 ** 31)


def average_path_length(n) -> np.ndarray:
    """c(n): mean path length of an unsuccessful BST search over n points."""
    n = np.asarray(n, dtype=np.float64)
    out = np.zeros_like(n)
    big = n > 2
    out[n == 2] = 1.0
    nb = n[big]
    out[big] = 2.0 * (np.log(nb - 1.0) + np.euler_gamma) - 2.0 * (nb - 1.0) / nb
    return out


def _fill_features(pdf: pd.DataFrame, features: list[str]) -> np.ndarray:
    """Feature matrix with the reference's fill rules: NULL -> 0, except a
    NULL day of week -> 1."""
    cols = []
    for f in features:
        s = pd.to_numeric(pdf[f], errors="coerce").astype("float64")
        cols.append(s.fillna(1.0 if f == "day_of_week" else 0.0).to_numpy())
    return np.column_stack(cols) if cols else np.zeros((len(pdf), 0))


def build_tree(x: np.ndarray, rng: np.random.Generator, height_limit: int) -> list[tuple]:
    """One isolation tree as a list of (node_id, feature, threshold, left,
    right, size, depth); iterative, so deep inputs cannot overflow the stack."""
    nodes: list[list] = []
    stack = [(np.arange(len(x)), 0, -1, 0)]     # (rows, depth, parent, side)
    while stack:
        rows, depth, parent, side = stack.pop()
        node_id = len(nodes)
        if parent >= 0:
            nodes[parent][3 if side == 0 else 4] = node_id
        sub = x[rows]
        if depth >= height_limit or len(rows) <= 1:
            nodes.append([node_id, -1, 0.0, -1, -1, len(rows), depth])
            continue
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        usable = np.flatnonzero(hi > lo)
        if usable.size == 0:
            nodes.append([node_id, -1, 0.0, -1, -1, len(rows), depth])
            continue
        f = int(rng.choice(usable))
        t = float(rng.uniform(lo[f], hi[f]))
        go_left = sub[:, f] < t
        nodes.append([node_id, f, t, -1, -1, len(rows), depth])
        stack.append((rows[~go_left], depth + 1, node_id, 1))
        stack.append((rows[go_left], depth + 1, node_id, 0))
    return [tuple(n) for n in nodes]


@dataclass
class ForestModel:
    """A fitted forest: node arrays plus the training-time calibration."""

    features: list[str]
    n_trees: int
    psi: int
    contamination: float
    seed: int
    nodes: pd.DataFrame
    raw_min: float = 0.0
    raw_max: float = 1.0
    threshold: float = 1.0
    train_rows: int = 0
    arrays: dict = field(default_factory=dict, repr=False)
    _columns: dict = field(default_factory=dict, repr=False)

    def compile(self) -> dict:
        """Flatten the node table into global numpy arrays for scoring."""
        nd = self.nodes.sort_values(["tree_id", "node_id"]).reset_index(drop=True)
        sizes = nd.groupby("tree_id").size()
        starts = np.concatenate([[0], np.cumsum(sizes.to_numpy())[:-1]]).astype(np.int64)
        base = nd["tree_id"].map(dict(zip(sizes.index, starts))).to_numpy()
        left = np.where(nd["left"] >= 0, nd["left"] + base, -1)
        right = np.where(nd["right"] >= 0, nd["right"] + base, -1)
        leaf_h = np.where(nd["feature"] < 0,
                          nd["depth"] + average_path_length(nd["size"]), 0.0)
        # Leaves point to themselves and test feature 0, so a walk needs no
        # per-level masks: a row that reached a leaf stays there.
        is_leaf = nd["feature"].to_numpy() < 0
        self_idx = np.arange(len(nd))
        left = np.where(is_leaf, self_idx, left)
        right = np.where(is_leaf, self_idx, right)
        self.arrays = {
            "feature": np.where(is_leaf, 0, nd["feature"].to_numpy()).astype(np.int32),
            "threshold": nd["threshold"].to_numpy(np.float64),
            "child": np.stack([left, right]).astype(np.int32),
            "leaf_h": leaf_h.astype(np.float64),
            "roots": np.asarray(starts, dtype=np.int32),
            "max_depth": int(nd["depth"].max()) if len(nd) else 0,
            "c_psi": float(average_path_length([self.effective_psi()])[0]) or 1.0,
        }
        return self.arrays

    def effective_psi(self) -> int:
        return int(self.nodes.loc[self.nodes["node_id"] == 0, "size"].max()) \
            if len(self.nodes) else self.psi


def raw_scores(arrays: dict, x: np.ndarray, tree_chunk: int = 16) -> np.ndarray:
    """s(x) = 2 ** (-E[h(x)] / c(psi)).  All rows walk a chunk of trees at
    once (rows x trees index matrix, cache-sized chunks); each level is four
    gathers from flat arrays: node feature, row value, threshold and child."""
    m = x.shape[0]
    roots = arrays["roots"]
    if m == 0 or roots.size == 0:
        return np.zeros(m)
    feat, thr = arrays["feature"].astype(np.intp), arrays["threshold"]
    child = arrays["child"].T.astype(np.intp).ravel()        # left and right of each node
    depth = arrays["max_depth"]
    values = np.ascontiguousarray(x).ravel()
    rows = np.arange(m)[:, None] * x.shape[1]
    total = np.zeros(m)
    for start in range(0, roots.size, tree_chunk):
        chunk = roots[start:start + tree_chunk].astype(np.intp)
        idx = np.broadcast_to(chunk, (m, chunk.size)).copy()
        for _ in range(depth):
            go_right = values.take(feat.take(idx) + rows) >= thr.take(idx)
            idx = child.take(idx * 2 + go_right)
        total += arrays["leaf_h"].take(idx).sum(axis=1)
    return np.power(2.0, -(total / roots.size) / arrays["c_psi"])


IDENTITY = ("event_id", "icao24", "time_position", "event_time")


def _row_identity(df: DataFrame, features: list[str], id_cols=IDENTITY) -> Column:
    """Hash of whatever names a row: its ids, where present and not NULL, and features."""
    cols = dict.fromkeys([c for c in id_cols if c in df.columns] + list(features))
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


def _unit_hash(*cols) -> Column:
    """Deterministic uniform value in [0, 1) from the given columns."""
    return F.pmod(F.xxhash64(*cols), F.lit(2 ** 31)).cast("double") / F.lit(_HASH_SPACE)


def stored(df: DataFrame) -> DataFrame:
    """Write a table once to the shared checkpoint folder and read it back."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/features-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _tree_sample(rows: DataFrame, n: int, n_trees: int, psi: int, seed: int) -> DataFrame:
    """(row, tree) pairs, each drawn with probability p = 1.25 * psi / n (at most 1).

    The first tree of a row comes from one geometric draw, so a row that is in no
    tree costs one hash; trees behind the first are tried one by one."""
    p, s = min(1.0, 1.25 * psi / n), F.lit(seed)
    u = _unit_hash(F.col("_rid"), F.col("_copy"), s) + F.lit(0.5 / _HASH_SPACE)
    first = F.lit(0) if p >= 1.0 else F.floor(F.log(u) / F.lit(math.log1p(-p))).cast("int")
    drawn = rows.withColumn("_first", first).filter(F.col("_first") < n_trees)
    trees = drawn.withColumn("tree_id", F.explode(F.sequence(F.col("_first"), F.lit(n_trees - 1))))
    own = _unit_hash(F.col("_rid"), F.col("_copy"), F.col("tree_id"), s + 1)
    return (trees.filter((F.col("tree_id") == F.col("_first")) | (own < F.lit(p)))
            .withColumn("_order", F.xxhash64("_rid", "_copy", "tree_id", s + 2)))


def fit_isolation_forest(df: DataFrame, *, features: list[str] | None = None,
                         n_trees: int = S.FOREST_TREES, psi: int = S.FOREST_SAMPLE,
                         contamination: float = S.FOREST_CONTAMINATION,
                         seed: int = S.FOREST_SEED, id_cols=IDENTITY,
                         store: str | None = None) -> ForestModel:
    """M1: fit the forest on ``df`` (see the module docstring for the plan).

    ``store`` names a folder of model tables: a model is written there under a key made
    of the parameters and the content of the training rows (count and hash sum of their
    identities and features), and one of the same key is read instead of fitted again.

    Calibration (score minimum and maximum, contamination threshold) scores
    every training row, whatever their number."""
    features = features or list(S.MODEL_FEATURES)
    named = df.select(_row_identity(df, features, id_cols).alias("_rid"), *features)
    # equal rows are one row with a number; a hot one is summed before the shuffle
    grouped = stored(named.groupBy("_rid", *features).agg(F.count(F.lit(1)).alias("_n")))
    content = F.sum(F.xxhash64("_rid", *features, "_n").cast("decimal(38,0)"))
    n, total = grouped.agg(F.coalesce(F.sum("_n"), F.lit(0)), content).first()
    if n == 0:
        raise ValueError("cannot fit an isolation forest on an empty table")
    if store is not None:
        key = hashlib.sha256(repr((features, n_trees, psi, contamination, seed, n, total))
                             .encode()).hexdigest()[:32]
        store = f"{store.rstrip('/')}/{key}"
        known = load_model(df.sparkSession, store)
        if known is not None:
            return known
    rows = grouped.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n")))).drop("_n")
    sampled = _tree_sample(rows, n, n_trees, min(psi, n), seed)
    height_limit = int(math.ceil(math.log2(max(psi, 2))))
    feats = list(features)
    ship_package(df.sparkSession)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_order", "_rid", "_copy"]).head(psi)
        tree_id = int(pdf["tree_id"].iloc[0])
        rng = np.random.default_rng([seed, tree_id])
        nodes = build_tree(_fill_features(pdf, feats), rng, height_limit)
        out = pd.DataFrame(nodes, columns=["node_id", "feature", "threshold", "left",
                                           "right", "size", "depth"])
        out.insert(0, "tree_id", tree_id)
        return out.astype({"tree_id": "int32", "node_id": "int32", "feature": "int32",
                           "left": "int32", "right": "int32", "size": "int32",
                           "depth": "int32"})

    node_df = (sampled.select("tree_id", "_order", "_rid", "_copy", *features)
                      .groupBy("tree_id").applyInPandas(grow, schema=NODE_SCHEMA))
    # Bounded by n_trees * (2 * psi - 1) rows: safe to bring to the driver.
    nodes = node_df.toPandas()
    model = ForestModel(features=features, n_trees=n_trees, psi=psi,
                        contamination=contamination, seed=seed, nodes=nodes, train_rows=n)
    model.compile()
    calibrate(model, rows)
    if store is not None:
        save_model(df.sparkSession, model, store)
    return model


def raw_score_column(model: ForestModel, spark: SparkSession, features: list[str]) -> Column:
    """U1 core: pandas UDF returning the raw isolation score for each row.

    The node arrays are broadcast once per model and session, and the UDF
    column is reused, so a streaming query does not re-ship the forest with
    every micro-batch."""
    key = (id(spark.sparkContext), tuple(features))
    if key in model._columns:
        return model._columns[key]
    arrays = model.arrays or model.compile()
    ship_package(spark)
    bc = spark.sparkContext.broadcast(arrays)
    feats = list(model.features)

    @F.pandas_udf(T.DoubleType())
    def _score(batch: pd.DataFrame) -> pd.Series:
        x = _fill_features(batch, feats)
        return pd.Series(raw_scores(bc.value, x))

    col = _score(F.struct(*[F.col(f).alias(m) for f, m in zip(features, feats)]))
    model._columns[key] = col
    return col


def calibrate(model: ForestModel, df: DataFrame) -> ForestModel:
    """Training-time min/max of the raw score and the contamination threshold
    (three scalars, computed by distributed aggregates)."""
    spark = df.sparkSession
    raw = df.select(raw_score_column(model, spark, model.features).alias("_raw"))
    q = 1.0 - model.contamination
    row = raw.agg(F.min("_raw").alias("lo"), F.max("_raw").alias("hi"),
                  F.percentile_approx("_raw", q, 10000).alias("thr")).first()
    model.raw_min, model.raw_max, model.threshold = float(row.lo), float(row.hi), float(row.thr)
    return model


def calibrate_from_ranks(model: ForestModel, ranks: DataFrame) -> ForestModel:
    """The contamination threshold from a merged quantile sketch of raw scores.

    ``ranks`` has one row (raw_ranks, raw_min, raw_max): sketches of slices or
    micro-batches merge (``F.kll_merge_agg_double``), so a model is calibrated on a
    feed that is never read again.  The threshold's rank is within
    ``summaries.RANK_ERROR`` of the asked one."""
    q = 1.0 - model.contamination
    row = ranks.select("raw_min", "raw_max", F.kll_sketch_get_quantile_double(
        "raw_ranks", F.lit(q)).alias("thr")).first()
    model.raw_min, model.raw_max = float(row.raw_min), float(row.raw_max)
    model.threshold = float(row.thr)
    return model


def raw_ranks(df: DataFrame, model: ForestModel, *, by: list | None = None, k: int = 4096) -> DataFrame:
    """One row, or one for each value of ``by``: sketch and extremes of the raw scores."""
    raw = df.withColumn("_raw", raw_score_column(model, df.sparkSession, model.features))
    return raw.groupBy(*(by or [])).agg(
        F.kll_sketch_agg_double("_raw", F.lit(k)).alias("raw_ranks"),
        F.min("_raw").alias("raw_min"), F.max("_raw").alias("raw_max"))


def merge_ranks(ranks: DataFrame, *, k: int = 4096) -> DataFrame:
    return ranks.agg(F.kll_merge_agg_double("raw_ranks", F.lit(k)).alias("raw_ranks"),
                     F.min("raw_min").alias("raw_min"), F.max("raw_max").alias("raw_max"))


def score_frame(df: DataFrame, model: ForestModel | None, *,
                cols: FlightColumns = FLIGHT, features: list[str] | None = None) -> DataFrame:
    """Add ml_anomaly_score (0..1, training-normalised),
    ml_is_anomaly (raw > threshold) and ml_anomaly_reason.  Without a model,
    the fallback constants (U5)."""
    if model is None:
        from trackstream.operators.anomaly import model_fallback
        return model_fallback(df, cols=cols)
    features = features or model.features
    require_columns(df, features)
    raw = raw_score_column(model, df.sparkSession, features)
    span = model.raw_max - model.raw_min
    out = df.withColumn("_raw_score", raw)
    if span > 0:
        norm = (F.col("_raw_score") - F.lit(model.raw_min)) / F.lit(span)
        score = F.least(F.greatest(norm, F.lit(0.0)), F.lit(1.0))
    else:
        score = F.lit(0.5)
    out = out.withColumns({cols.ml_score: score,
                           cols.ml_flag: F.col("_raw_score") > F.lit(model.threshold)})
    out = out.withColumn(cols.ml_reason, anomaly_reason(cols.velocity, cols.altitude,
                                                        cols.vertical_rate, cols.ml_score))
    return out.drop("_raw_score")


def train_test_split(df: DataFrame, *, label_col: str | None = None, test_fraction: float = 0.2,
                     seed: int = S.FOREST_SEED, id_cols=IDENTITY) -> DataFrame:
    """M2: stratified ``split``: in every class (value of ``label_col``) the
    round(test_fraction * n) rows of lowest identity hash are 'test'.

    Exact without gathering a class: rows are counted by the first three digits
    of the hash, the running count finds the digits at which the share is reached,
    and rows are numbered within (class, digits) only."""
    cols = [c for c in id_cols if c in df.columns] or list(df.columns)
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols],
                       F.lit(str(seed)))
    label = (F.coalesce(F.concat(F.lit("="), F.col(label_col).cast("string")), F.lit(""))
             if label_col else F.lit(""))
    rows = df.withColumns({"_h": F.md5(text), "_label": label}).withColumn(
        "_d", F.substring("_h", 1, 3))
    counts = rows.groupBy("_label", "_d").agg(F.count(F.lit(1)).alias("_n"))
    by_label = Window.partitionBy("_label")              # at most 4,096 rows a class
    plan = counts.select("_label", "_d", F.coalesce(F.sum("_n").over(
        by_label.orderBy("_d").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.round(F.sum("_n").over(by_label) * F.lit(test_fraction)).alias("_take"))
    nth = F.row_number().over(Window.partitionBy("_label", "_d").orderBy("_h"))
    return (rows.withColumn("_nth", nth).join(plan, ["_label", "_d"])
            .withColumn("split", F.when(F.col("_before") + F.col("_nth") <= F.col("_take"), "test")
                        .otherwise("train"))
            .drop("_h", "_label", "_d", "_nth", "_before", "_take"))


# --------------------------------------------------------------------------
# Model tables
# --------------------------------------------------------------------------

def model_metadata(model: ForestModel) -> dict:
    return {"model_type": "IsolationForest", "features": model.features,
            "n_trees": model.n_trees, "psi": model.psi,
            "contamination": model.contamination, "seed": model.seed,
            "raw_min": model.raw_min, "raw_max": model.raw_max,
            "threshold": model.threshold, "train_rows": model.train_rows,
            "n_nodes": int(len(model.nodes))}


def model_info(spark: SparkSession, model: ForestModel | None) -> DataFrame:
    """One-row metadata table (``loaded = false`` without a model)."""
    if model is None:
        return spark.createDataFrame([(False, "Model files not found")],
                                     "loaded boolean, reason string")
    md = model_metadata(model)
    return spark.createDataFrame([(True, md["model_type"], json.dumps(md["features"]),
                                   md["n_trees"], md["psi"], md["contamination"],
                                   md["threshold"], md["raw_min"], md["raw_max"],
                                   md["train_rows"], md["n_nodes"])],
                                 "loaded boolean, model_type string, features string, "
                                 "n_trees int, psi int, contamination double, threshold double, "
                                 "raw_min double, raw_max double, train_rows long, n_nodes long")


def save_model(spark: SparkSession, model: ForestModel, path: str) -> None:
    """Write the node table and the metadata as parquet tables under ``path``."""
    spark.createDataFrame(model.nodes, schema=NODE_SCHEMA).write.mode("overwrite") \
        .parquet(path.rstrip("/") + "/nodes")
    spark.createDataFrame([(json.dumps(model_metadata(model)),)], "meta string") \
        .write.mode("overwrite").parquet(path.rstrip("/") + "/meta")


def load_model(spark: SparkSession, path: str) -> ForestModel | None:
    """Read a model written by :func:`save_model`; ``None`` when absent."""
    try:
        meta_table = spark.read.parquet(path.rstrip("/") + "/meta")
    except AnalysisException as e:
        # only a model that is not there means fallback scoring; one that cannot
        # be read must stop the job
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    meta = json.loads(meta_table.first()["meta"])
    nodes = spark.read.parquet(path.rstrip("/") + "/nodes").toPandas()
    m = ForestModel(features=meta["features"], n_trees=meta["n_trees"], psi=meta["psi"],
                    contamination=meta["contamination"], seed=meta["seed"], nodes=nodes,
                    raw_min=meta["raw_min"], raw_max=meta["raw_max"],
                    threshold=meta["threshold"], train_rows=meta["train_rows"])
    m.compile()
    return m
