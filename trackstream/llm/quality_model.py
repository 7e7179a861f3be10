"""Quality classifier: a sparse ensemble of rules.

Statistics of a text are built-in column expressions.  Shallow trees are grown on
them; every path from a root is a conjunctive rule; a lasso logistic regression
gives each rule a weight and leaves most at zero; what remains is compiled into
one column expression, so scoring is a projection without user functions.

Fitted on at most ``train_rows`` labelled rows (documented sample, chosen by a
hash of the id; all of them if there are fewer).  Ids, languages, sources and
labels never enter a score.

Edge cases: null and empty texts have all-zero statistics and get a score like
any other; rows without a label are not learned from; repeated labels of one id
count once (the largest); with one class or nothing to learn from, the score is
the share of label 1 (0.5 without labels); texts are measured whole, whatever their
length; equal texts score alike, and a score of 0.5 predicts 1; rows that tie for the
training sample are taken by id and statistics; an empty table gives an empty result.
Only the id and text columns are read, so clashing names do no harm.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackstream.llm.common import BLANKS, let, words
from trackstream.llm.quality_rules import STOP_WORDS

TRAIN_ROWS = 20_000
TREES = 24
DEPTH = 3
LASSO = 0.002

FEATURES = ["n_words", "mean_word_chars", "distinct_ratio", "pair_ratio", "stop_ratio",
            "symbol_ratio", "exclamation_ratio", "mark_ratio", "upper_ratio", "digit_ratio",
            "line_words", "dup_line_ratio", "capital_ratio", "short_ratio", "long_ratio"]


def statistics(text: Column) -> Column:
    """The statistics of a whole text as one struct column of doubles."""
    t = F.coalesce(text, F.lit(""))

    def left(x, chars):
        # one pass of a character class; translate() looks every character up in a map
        return F.length(F.regexp_replace(x, f"[{chars}]+", "")).cast("double")

    def of(w):
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{BLANKS}]"))
        n = F.greatest(F.size(w), F.lit(1)).cast("double")
        chars = F.length(t).cast("double")
        solid = F.length(F.array_join(w, "")).cast("double")
        per_char = F.greatest(solid, F.lit(1.0))
        return let(lines, lambda ln: let(F.greatest(F.size(ln), F.lit(1)).cast("double"), lambda k: F.struct(
            F.size(w).cast("double").alias("n_words"),
            (solid / n).alias("mean_word_chars"),
            (F.size(F.array_distinct(w)) / n).alias("distinct_ratio"),
            (F.size(F.filter(w, lambda x, i: F.coalesce(F.get(w, i - 1) == x, F.lit(False)))) / n)
            .alias("pair_ratio"),
            (F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))) / n).alias("stop_ratio"),
            ((chars - left(t, "#*$%|<>&")) / n).alias("symbol_ratio"),
            ((chars - left(t, "!?")) / n).alias("exclamation_ratio"),
            ((chars - left(t, ".,;:")) / n).alias("mark_ratio"),
            ((chars - left(t, "A-Z")) / per_char).alias("upper_ratio"),
            ((chars - left(t, "0-9")) / per_char).alias("digit_ratio"),
            (F.size(w) / k).alias("line_words"),
            ((F.size(ln) - F.size(F.array_distinct(ln))) / k).alias("dup_line_ratio"),
            (F.size(F.filter(w, lambda x: F.substring(x, 1, 1) != F.lower(F.substring(x, 1, 1)))) / n)
            .alias("capital_ratio"),
            (F.size(F.filter(w, lambda x: F.length(x) <= 2)) / n).alias("short_ratio"),
            (F.size(F.filter(w, lambda x: F.length(x) >= 12)) / n).alias("long_ratio"))))

    return let(words(text), of)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool          # True: feature > threshold; False: feature <= threshold
    threshold: float


@dataclass(frozen=True)
class RuleModel:
    rules: list          # (tuple of Conditions, weight)
    bias: float

    def score(self, stats: Column) -> Column:
        """The compiled ensemble: a logistic function of the rules that hold."""
        margin = F.lit(self.bias)
        for conditions, weight in self.rules:
            margin = margin + F.when(_holds(conditions, stats), weight).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-margin))


def _holds(conditions, stats: Column) -> Column:
    out = F.lit(True)
    for c in conditions:
        v = stats[c.feature]
        out = out & ((v > c.threshold) if c.above else (v <= c.threshold))
    return out


def tree_paths(x, y, rng, features: list[str], depth: int = DEPTH) -> list[tuple]:
    """Grow one tree on a bootstrap sample and random feature subsets; its paths."""
    import numpy as np

    out = []

    def grow(rows, path):
        if path:
            out.append(tuple(path))
        if len(path) == depth or len(rows) < 20 or y[rows].min() == y[rows].max():
            return
        best = None
        for f in rng.choice(x.shape[1], max(2, math.isqrt(x.shape[1]) + 2), replace=False):
            order = np.argsort(x[rows, f], kind="stable")
            v, t = x[rows[order], f], np.cumsum(y[rows[order]])
            n = np.arange(1, len(rows) + 1)
            cut = np.flatnonzero(v[:-1] < v[1:])
            cut = cut[(cut >= 4) & (cut < len(rows) - 5)]
            if not len(cut):
                continue
            p, q = t[cut] / n[cut], (t[-1] - t[cut]) / (len(rows) - n[cut])
            gini = n[cut] * p * (1 - p) + (len(rows) - n[cut]) * q * (1 - q)
            k = int(gini.argmin())
            if best is None or gini[k] < best[0]:
                best = (gini[k], f, float((v[cut[k]] + v[cut[k] + 1]) / 2))
        if best is None:
            return
        _, f, at = best
        low = x[rows, f] <= at
        grow(rows[low], [*path, Condition(features[f], False, at)])
        grow(rows[~low], [*path, Condition(features[f], True, at)])

    grow(rng.integers(0, len(y), len(y)), [])
    return out


def lasso_logistic(z, y, penalty: float, rounds: int = 600):
    """L1-penalised logistic regression by accelerated proximal gradient steps.
    The bias is not penalised.  Returns (weights, bias)."""
    import numpy as np

    n, d = z.shape
    a = np.c_[z, np.ones(n)]
    step = 4.0 / (np.linalg.eigvalsh(a.T @ a)[-1] / n + 1e-9)
    w = v = np.zeros(d + 1)
    w[-1] = v[-1] = 0.0
    t = 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ v, -30, 30)))
        new = v - step * (a.T @ (p - y)) / n
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * penalty, 0)
        nt = (1 + math.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / nt * (new - w), new, nt
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", train_rows: int = TRAIN_ROWS, trees: int = TREES,
        depth: int = DEPTH, penalty: float = LASSO, seed: int = 11) -> RuleModel:
    """Fit on at most ``train_rows`` rows of ``labels`` (id, label) met in ``docs``."""
    import numpy as np

    known = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_y")))
    draw = F.xxhash64(F.col("_id").cast("string"), F.lit(seed))
    chosen = known.orderBy(draw, "_id").limit(train_rows)       # bounded: (id, label)
    rows = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"))
            .join(F.broadcast(chosen), "_id")
            .select("_id", "_y", statistics(F.col("_t")).alias("s"))
            .select("_id", "_y", *[F.col("s")[f].alias(f) for f in FEATURES])
            .orderBy(draw, "_id", *FEATURES).limit(train_rows).toPandas())
    y = rows["_y"].to_numpy(float)
    x = rows[FEATURES].to_numpy(float)
    if not len(y):
        return RuleModel([], 0.0)
    share = min(max(y.mean(), 1e-6), 1 - 1e-6)
    if y.min() == y.max():
        return RuleModel([], math.log(share / (1 - share)))
    rng = np.random.default_rng(seed)
    paths = dict.fromkeys(p for _ in range(trees) for p in tree_paths(x, y, rng, FEATURES, depth))
    columns, at = [], {f: i for i, f in enumerate(FEATURES)}
    kept = []
    for path in paths:
        hit = np.ones(len(y), bool)
        for c in path:
            v = x[:, at[c.feature]]
            hit &= (v > c.threshold) if c.above else (v <= c.threshold)
        if 0.002 < hit.mean() < 0.998:
            kept.append(path)
            columns.append(hit)
    if not kept:
        return RuleModel([], math.log(share / (1 - share)))
    z = np.array(columns, float).T
    center = z.mean(axis=0)
    w, bias = lasso_logistic(z - center, y, penalty)
    bias -= float(center @ w)
    return RuleModel([(p, float(k)) for p, k in zip(kept, w) if k], bias)


def score(docs: DataFrame, model: RuleModel, id_col: str = "doc_id", text_col: str = "text"
          ) -> DataFrame:
    """(doc_id, score, predicted) of every row."""
    s = docs.select(F.col(id_col).alias("doc_id"), statistics(F.col(text_col)).alias("s"))
    s = s.select("doc_id", let(F.col("s"), model.score).alias("score"))
    return s.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
