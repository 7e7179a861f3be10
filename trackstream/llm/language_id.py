"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, everything but letters becomes a single blank, and n-grams
of 1 to 3 characters are hashed into a fixed number of buckets.  The fitted
matrix of log probabilities (buckets x languages, 128 KB for each value of lang, all of
which are learned) is broadcast in slices of at most ``SLICE`` languages (32 MB): with
more, the rows are written with the best language so far and scored once a slice.
Scoring adds matrix rows over all n-grams of the whole text in numpy, a batch at a time.

The classifier is fitted on at most ``train_rows`` labelled rows of each language
(documented sample, chosen by a hash of the id); rare languages are used whole.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; rows
without a lang are not learned from; with nothing to learn from every row is
``und``; repeated rows and ties are judged alike (ties go to the language that
comes first by code point); an empty table gives an empty result; columns of the input
that clash with a result column are not carried.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackstream.llm.common import materialize, ship_package

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
TRAIN_ROWS = 2000      # labelled rows of a language at most
HELD = 256             # languages whose counts a task holds at once
SLICE = 256            # languages of a broadcast matrix at most
SMOOTHING = 0.1
CHUNK = 1 << 20        # characters scored at once


def letter_table():
    """For each code point of the basic plane: itself if a letter, else a blank."""
    import numpy as np

    points = np.arange(65536, dtype=np.uint32)
    ok = np.fromiter((chr(i).isalpha() for i in range(65536)), bool, 65536)
    return np.where(ok, points, 32).astype(np.uint32)


def buckets_of(texts: list[str], table, buckets: int = BUCKETS):
    """(bucket, text number) of every n-gram of a list of texts."""
    import numpy as np

    # a blank follows every text, so no n-gram of letters spans two; none is before it
    flat = np.frombuffer(" ".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    lens = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    own = np.repeat(np.arange(len(texts)), lens)
    c = flat[1:]
    c = np.where(c < 65536, table[np.minimum(c, 65535)], c)
    keep = (c != 32) | np.r_[False, c[:-1] != 32]       # runs of blanks become one
    c, own = c[keep].astype(np.uint64), own[keep]
    found, owner = [], []
    mix = np.uint64(0x9E3779B97F4A7C15)
    h = np.zeros(len(c), np.uint64)
    for n in ORDERS:
        h = (h[:len(c) - n + 1] + c[n - 1:] + np.uint64(n)) * mix
        h ^= h >> np.uint64(29)
        b = ((h * mix) >> np.uint64(40)).astype(np.int64) % buckets
        ok = (c[:len(b)] != 32) | (c[n - 1:] != 32)     # not blanks alone
        ok &= own[:len(b)] == own[n - 1:]
        found.append(b[ok])
        owner.append(own[:len(b)][ok])
    return found, owner


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class LanguageModel:
    """``cells`` has the n-gram counts as a written table (lang number, bucket, n)."""

    langs: list[str]
    prior: list[float]
    cells: DataFrame | None = None
    buckets: int = BUCKETS

    def weights(self, first: int, upto: int):
        """Log probabilities of some languages: a float32 matrix, buckets x languages."""
        import numpy as np

        counts = np.full((upto - first, self.buckets), SMOOTHING)
        rows = (self.cells.filter((F.col("lang") >= first) & (F.col("lang") < upto))
                .toPandas())                            # at most buckets x languages rows
        counts[rows["lang"].to_numpy(np.int64) - first, rows["bucket"].to_numpy(np.int64)] += \
            rows["n"].to_numpy(np.float64)
        logs = np.log(counts / counts.sum(axis=1, keepdims=True))
        return np.ascontiguousarray(logs.T.astype(np.float32))


def _pieces(t: str, limit: int):
    """(piece, sign): pieces of a text whose signed n-gram counts sum to its own.

    Neighbours overlap by two letters or more, and the overlap is taken off again:
    with it go the n-grams that both hold and those with the blanks at the cuts."""
    start, end = 0, limit
    while end < len(t):
        yield t[start:end], 1
        start, letters = end, 0
        while start and letters < max(ORDERS) - 1:
            start -= 1
            letters += t[start].isalpha() or ord(t[start]) > 65535
        yield t[start:end], -1
        end += limit
    yield t[start:], 1


def _batches(texts, limit: int | None = None):
    """Cut a list of (row, text) into lists (row, piece, sign) of about ``limit``
    characters (see :func:`_pieces`)."""
    limit = limit or CHUNK
    now, size = [], 0
    for i, t in texts:
        for piece, sign in _pieces(t, limit):
            now.append((i, piece, sign))
            size += len(piece)
            if size >= limit:
                yield now
                now, size = [], 0
    if now:
        yield now


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", train_rows: int = TRAIN_ROWS,
        buckets: int = BUCKETS) -> LanguageModel:
    """Fit on the rows of ``labelled`` that have a lang (bounded sample)."""
    spark = labelled.sparkSession
    ship_package(spark)
    known = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = {r[0]: r["n"] for r in known.groupBy(F.col(lang_col).cast("string").alias("lang"))
             .agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return LanguageModel([], [], None, buckets)
    langs = sorted(sizes)
    number = {lang: k for k, lang in enumerate(langs)}
    shares = spark.createDataFrame([(x, min(1.0, train_rows / sizes[x])) for x in langs],
                                   "lang string, share double")
    draw = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("lang")), F.lit(1 << 20)) / (1 << 20)
    sample = (known.select(F.col(lang_col).cast("string").alias("lang"),
                           F.col(text_col).cast("string").alias("text"), draw.alias("draw"))
              .join(F.broadcast(shares), "lang").filter("draw < share").select("lang", "text"))

    def count(batches):
        import numpy as np
        import pyarrow as pa

        from trackstream.llm import language_id as M

        table = M.letter_table()
        sums = {}

        def out():
            for k, n in sums.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k * buckets + at.astype(np.int64)), pa.array(n[at].astype(np.int64))],
                    ["cell", "n"])
            sums.clear()

        for b in batches:
            names = b.column(0).to_pylist()
            rows = ((i, x.as_py().lower()) for i, x in enumerate(b.column(1)))
            for group in M._batches(rows):
                found, owner = M.buckets_of([t for _, t, _ in group], table, buckets)
                ids = np.array([number[names[i]] for i, _, _ in group])
                sign = np.array([s for _, _, s in group], float)
                for f, o in zip(found, owner):
                    own = ids[o]
                    for k in np.unique(ids):
                        of = own == k
                        n = np.bincount(f[of], sign[o[of]], buckets)
                        sums[k] = sums[k] + n if k in sums else n
                if len(sums) > M.HELD:
                    yield from out()
        yield from out()

    cells = materialize(sample.mapInArrow(count, "cell long, n long").groupBy("cell").agg(
        F.sum("n").alias("n")).select(F.expr(f"cell div {buckets}").alias("lang"),
                                      F.expr(f"cell % {buckets}").alias("bucket"), "n"), "cells")
    rows = sum(sizes.values())
    return LanguageModel(langs, [math.log(sizes[x] / rows) for x in langs], cells, buckets)


STATE = "lang_pred string, score double, __llm_best double, __llm_total double"


def predict(df: DataFrame, model: LanguageModel, id_cols: list[str], text_col: str = "text",
            slice_of: int = SLICE) -> DataFrame:
    """id_cols + lang_pred, score (posterior of the predicted language)."""
    ship_package(df.sparkSession)
    ids = [F.col(c).alias(f"__llm_{i}") for i, c in enumerate(id_cols)]
    now = df.select(*ids, F.col(text_col).cast("string").alias("__llm_text"))
    starts = range(0, max(1, len(model.langs)), slice_of)
    for k, first in enumerate(starts):
        now = _score(now, model, first, min(first + slice_of, len(model.langs)))
        if k + 1 < len(starts):
            now = materialize(now, "languages")
    return now.select(*[F.col(f"__llm_{i}").alias(c) for i, c in enumerate(id_cols)],
                      "lang_pred", "score")


def _score(df: DataFrame, model: LanguageModel, first: int, upto: int) -> DataFrame:
    """``df`` with the best language among those before ``upto``, its log probability and
    that of all of them together; ``df`` has these columns if ``first`` is not 0."""
    spark = df.sparkSession
    langs, prior, buckets = model.langs[first:upto], model.prior[first:upto], model.buckets
    shared = spark.sparkContext.broadcast(model.weights(first, upto) if langs else None)
    own = [f for f in df.schema.fields if not first or f.name not in _names(STATE)]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own)
    text_at = [f.name for f in own].index("__llm_text")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        from trackstream.llm import language_id as M

        weights, table = shared.value, M.letter_table()
        for b in batches:
            texts = [x.as_py() for x in b.column(text_at)]
            rows = [(i, t.lower()) for i, t in enumerate(texts) if M.has_letter(t)]
            n = len(texts)
            if first:
                names, best, total = (b.column(len(own) + k).to_pylist() for k in (0, 2, 3))
                best, total = np.array(best, float), np.array(total, float)
            else:
                names, best, total = ["und"] * n, np.full(n, -np.inf), np.full(n, -np.inf)
            if rows and langs:
                logs = np.zeros((n, len(langs)))
                for group in M._batches(rows):
                    at = np.array([i for i, _, _ in group])
                    sign = np.array([s for _, _, s in group])
                    for f, o in zip(*M.buckets_of([t for _, t, _ in group], table, buckets)):
                        for k in range(len(langs)):
                            part = np.bincount(o, weights[:, k][f], len(group))
                            np.add.at(logs[:, k], at, part * sign)
                logs += prior
                top, which = logs.max(axis=1), logs.argmax(axis=1)
                here = top + np.log(np.exp(logs - top[:, None]).sum(axis=1))
                for i, _ in rows:
                    if top[i] > best[i]:
                        names[i], best[i] = langs[which[i]], top[i]
                    total[i] = np.logaddexp(total[i], here[i])
            known = np.isfinite(total)
            score = np.where(known, np.exp(np.where(known, best - np.where(known, total, 0), 0)), 0.0)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:len(own)], pa.array(names, pa.string()), pa.array(score), pa.array(best),
                 pa.array(total)], [*(f.name for f in own), *M._names(M.STATE)])

    return df.mapInArrow(run, f"{fields}, {STATE}")


def _names(schema: str) -> list:
    return [c.split()[0] for c in schema.split(", ")]
