"""Document fingerprints by SpotSigs.

Common words are anchors; after every anchor the next ``chain`` content words form
one signature.  The set of signatures is the fingerprint, written as sorted,
fixed-width hexadecimal hashes, so equal texts have equal fingerprints.  Texts
are compared by the Jaccard likeness of their sets, pruned by set length first:
no likeness can exceed the ratio of the two lengths.

A text without any anchor that is followed by a content word (another language,
a list of names) would have no signature; there every word is an anchor, so only
a text without words has the empty fingerprint.

Edge cases: a null text counts as empty; an empty set is like an empty set (1)
and unlike any other (0); rows are ordered by (doc_id descending, text), null ids
last, so ties and repeated rows have a defined next document; the only document
of a table is its own next one; a text of any length is fingerprinted whole; an empty
table gives an empty result.  Only the id and text columns are read, so clashing names do
no harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackstream.llm.common import materialize, partitions, ship_package

#: Anchors: the commonest function words of the languages at hand.
ANCHORS = frozenset(
    "the of and to in a is that for was on with by are this at be "
    "der die das und ist von zu den mit im ein eine "
    "le la les de et un une du que est des en "
    "el los las y del se con por para".split())
CHAIN = 2
HEX = 8


class Words(dict):
    """Word -> hash, filled as words are met; emptied when it grows too large."""

    def __missing__(self, word):
        import xxhash

        if len(self) > 200_000:
            self.clear()
        # bit 0 tells an anchor from a content word
        h = xxhash.xxh64_intdigest(word, 7) & ~1 | (word.strip(".,;:!?") in ANCHORS)
        self[word] = h
        return h


def signatures(text: str | None, words: Words, chain: int = CHAIN):
    """Sorted distinct 32-bit signature hashes of one text."""
    import numpy as np

    h = np.fromiter(map(words.__getitem__, (text or "").lower().split()), np.uint64)
    if not len(h):
        return np.zeros(0, np.uint32)
    anchor = (h & np.uint64(1)).astype(bool)
    content = np.flatnonzero(~anchor)
    spots = np.flatnonzero(anchor)
    at = np.searchsorted(content, spots)        # the first content word behind each anchor
    fits = at + chain <= len(content)
    if not fits.any():                          # no anchor with a whole chain
        spots, content = np.arange(len(h)), np.arange(len(h))
        at, fits = spots + 1, np.ones(len(h), bool)
        content = np.r_[content, np.full(chain, -1)]
    spots, at = spots[fits], at[fits]
    mix = np.uint64(0x9E3779B97F4A7C15)
    ext = np.r_[h, np.uint64(0)]                # -1 reads the closing 0
    s = h[spots] * mix
    for k in range(chain):
        s = (s ^ (s >> np.uint64(31))) * mix + ext[content[at + k]]
    s = (s ^ (s >> np.uint64(31))) * mix
    return np.unique((s >> np.uint64(32)).astype(np.uint32))


def to_text(sigs) -> str:
    return sigs.astype(">u4").tobytes().hex()


def from_text(fp: str):
    import numpy as np

    return np.frombuffer(bytes.fromhex(fp), ">u4")


def jaccard(a, b, least: float = 0.0) -> float:
    """Jaccard likeness of two sorted sets; 0 as soon as the lengths alone show
    that ``least`` cannot be reached."""
    import numpy as np

    if not len(a) and not len(b):
        return 1.0
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    if not len(a) or not len(b):
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def edited(text: str, following: str) -> str:
    """The last half of ``text`` replaced by as many first characters of the next."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 chain: int = CHAIN) -> DataFrame:
    """(doc_id, fingerprint, n_signatures) of every row."""
    ship_package(df.sparkSession)

    def run(batches):
        import pyarrow as pa

        from trackstream.llm import spotsigs as S

        words = S.Words()
        for b in batches:
            sets = [S.signatures(x.as_py(), words, chain) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([S.to_text(s) for s in sets], pa.string()),
                 pa.array([len(s) for s in sets], pa.int32())],
                ["doc_id", "fingerprint", "n_signatures"])

    src = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, fingerprint string, n_signatures int")


# --- near duplicates among fingerprints --------------------------------------

def length_class(length, least: float):
    """Partition by set length: sets of likeness >= ``least`` lie in the same class
    or in neighbouring ones, as class borders grow by a factor of 1 / least."""
    import math

    return F.floor(F.log(length.cast("double")) / F.lit(math.log(1.0 / least)) + 1e-9).cast("int")


def similar_classes(prints: DataFrame, least: float = 0.8) -> DataFrame:
    """Pairs (a, b, likeness) of different fingerprints with likeness >= ``least``.

    ``prints`` has a column ``fingerprint``; equal ones are one class, so copies
    are never expanded.  Sets are partitioned by length class; within a class (and
    from a class to the next) two sets meet only at a signature among the first
    ``n - ceil(least * n) + 1`` of each in order of rarity, which is exact for the
    Jaccard bound; lengths are compared before any set is."""
    classes = prints.filter("fingerprint <> ''").select("fingerprint").distinct()
    n = (F.length("fingerprint") / HEX).cast("int")
    sets = materialize(classes.select(
        F.xxhash64("fingerprint").alias("key"), "fingerprint", n.alias("n"),
        length_class(n, least).alias("cls")), "sigs")
    sigs = F.transform(F.sequence(F.lit(0), F.col("n") - 1),
                       lambda i: F.substring(F.col("fingerprint"), i * HEX + 1, F.lit(HEX)))
    flat = sets.select("key", "n", "cls", F.explode(sigs).alias("sig"))
    seen = flat.groupBy("sig").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    # a signature of one class only cannot bring two together, but keeps its place
    ranked = flat.join(seen, "sig", "left").select(
        "key", "n", "cls", "sig", F.coalesce("df", F.lit(1)).alias("df"))
    # the first signatures in order of rarity: a bounded sort within one set
    first = ranked.groupBy("key", "n", "cls").agg(
        F.sort_array(F.collect_list(F.struct("df", "sig"))).alias("s"))
    keep = (F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1).cast("int")
    first = first.select("key", "n", "cls", F.explode(F.slice("s", F.lit(1), keep)).alias("x")) \
        .filter("x.df > 1").select("key", "n", "cls", F.col("x.sig").alias("sig"))
    a = first.select(F.col("key").alias("ka"), F.col("n").alias("na"), "sig",
                     F.explode(F.array(F.col("cls"), F.col("cls") + 1)).alias("cls"))
    b = first.select(F.col("key").alias("kb"), F.col("n").alias("nb"), "sig", "cls")
    pairs = (a.join(b, ["cls", "sig"])
             .filter((F.col("na") < F.col("nb"))
                     | ((F.col("na") == F.col("nb")) & (F.col("ka") < F.col("kb"))))
             .filter(F.col("na") >= F.col("nb") * least - 1e-9).select("ka", "kb").distinct())
    full = sets.select("key", sigs.alias("s"))
    both = (pairs.join(full.withColumnRenamed("key", "ka").withColumnRenamed("s", "sa"), "ka")
            .join(full.withColumnRenamed("key", "kb").withColumnRenamed("s", "sb"), "kb"))
    common = F.size(F.array_intersect("sa", "sb"))
    like = common / (F.size("sa") + F.size("sb") - common)
    named = both.withColumn("likeness", like).filter(F.col("likeness") >= least)
    return named.select(F.col("ka").alias("a"), F.col("kb").alias("b"), "likeness")


# --- edited texts -------------------------------------------------------------

def _range_of(ids: DataFrame, n_ranges: int, knots: int = 256):
    """Number of the id range of a row: at most ``knots`` quantiles of the ids,
    each cut into equal steps, so the expression stays small at any ``n_ranges``.
    Null ids stand with the smallest."""
    known = ids.select("doc_id").filter("doc_id is not null")
    k = min(knots, n_ranges)
    at = sorted({int(q) for q in known.approxQuantile("doc_id", [i / k for i in range(k + 1)], 0.001)})
    if len(at) < 2:
        return F.lit(0)
    steps = -(-n_ranges // (len(at) - 1))

    def tree(lo, hi):                   # the knot interval of an id, by halving
        if hi - lo == 1:
            width = at[hi] - at[lo]
            into = F.floor((F.col("doc_id") - at[lo]).cast("double") * steps / width)
            return F.lit(lo * steps) + F.greatest(F.least(into, F.lit(steps - 1)), F.lit(0))
        mid = (lo + hi) // 2
        return F.when(F.col("doc_id") < at[mid], tree(lo, mid)).otherwise(tree(mid, hi))

    return F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(tree(0, len(at) - 1)).cast("int")


def compare_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 chain: int = CHAIN) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and two likenesses.

    Each document meets the next one (descending id) in one pass over the texts:
    ids are cut into ranges, each range also gets a copy of the largest document
    of the next lower range, and a task walks its sorted range once.  Only range
    borders (one id a task) come to the driver."""
    spark = df.sparkSession
    ship_package(spark)
    src = df.select(F.col(id_col).cast("long").alias("doc_id"),
                    F.col(text_col).cast("string").alias("text"))
    n_ranges = partitions(spark)
    src = src.withColumn("rng", _range_of(src, n_ranges))
    firsts = src.groupBy("rng").agg(F.max("doc_id").alias("id")).collect()   # one row a range
    firsts = sorted(((r["rng"], r["id"]) for r in firsts), reverse=True)
    if not firsts:
        return spark.createDataFrame([], OUT)
    # the head of every range is also the tail of the range above it; the head of
    # the highest is the tail of the lowest, after which the table starts again
    heads = spark.createDataFrame(
        [(i, firsts[k - 1][0]) for k, (_, i) in enumerate(firsts)], "head long, above int")
    tails = (src.join(F.broadcast(heads), src.doc_id.eqNullSafe(F.col("head")))
             .groupBy("above").agg(F.min(F.struct(
                 F.xxhash64("text").alias("tie"), "doc_id", "text")).alias("x"))
             .select(F.col("x.doc_id").alias("doc_id"), F.col("x.text").alias("text"),
                     F.col("above").alias("rng"), F.lit(True).alias("tail")))
    rows = src.withColumn("tail", F.lit(False)).unionByName(tails)
    # by range: the numbers are even, and hashes of a few numbers collide
    ordered = (rows.repartitionByRange(n_ranges, "rng")
               .sortWithinPartitions("rng", "tail", F.desc_nulls_last("doc_id"),
                                     F.xxhash64("text"))
               .select("rng", "tail", "doc_id", "text"))

    def run(batches):
        import hashlib

        import pyarrow as pa

        from trackstream.llm import spotsigs as S

        def pack(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds.types)], schema=kinds)

        words = S.Words()
        out = []
        prev = None                       # (rng, id, text, signatures) waiting for its next
        for b in batches:
            for rng, tail, doc, text in zip(*(c.to_pylist() for c in b.columns)):
                text = text or ""
                mine = S.signatures(text, words, chain)
                if prev is not None and prev[0] == rng:
                    new = S.edited(prev[2], text)
                    sig = S.signatures(new, words, chain)
                    out.append((prev[1], len(prev[2]), hashlib.sha256(
                        new.encode("utf-8", "surrogatepass")).hexdigest(), S.to_text(prev[3]),
                        S.to_text(sig), S.jaccard(prev[3], sig), S.jaccard(prev[3], mine)))
                prev = None if tail else (rng, doc, text, mine)
                if len(out) >= 512:
                    yield pack(out)
                    out = []
        if out:
            yield pack(out)

    import pyarrow as pa

    kinds = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()),
                       ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                       ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
                       ("near_next", pa.float64())])
    return ordered.mapInArrow(run, OUT)


OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
       "edited_fingerprint string, near_edited double, near_next double")
