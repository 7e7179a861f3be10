"""SimHash near-duplicates by anchor-point covering.

A fingerprint has 64 bits: bit b is 1 if more than half of the text's word
shingles have a hash with bit b set.  Texts whose fingerprints differ in at most
``max_bits`` (2) bits are linked; a component is everything reachable by links.

Anchors are the words of a covering code: the perfect Hamming code on 63 bits
(covering radius 1) with the 64th bit appended.  If two fingerprints differ in at
most 2 bits, a point between them is within 1 of both and within 1 of an anchor,
so both lie within 2 = (covering radius + half the threshold) of that anchor.
Each distinct fingerprint is therefore replicated to every anchor within 2 (at
most 33 of them) and fingerprints are compared at each anchor; no link can be
missed.  An anchor can hold at most 2,080 + 1 distinct fingerprints, whatever
the input, so comparing within one anchor is bounded, and each anchor reports a
spanning forest of its links, never all pairs.

Exact copies share a fingerprint and are collapsed before anything is compared.

Edge cases: a null, empty or blank text has fingerprint 0 and is linked like any
other; a text of fewer words than a shingle is one shingle; rows with equal
doc_id are rows of their own; a null doc_id never is a component's smallest id
(a component of null ids only has a null component_id); a text of any length is
hashed whole; an empty table gives an empty result.  Clashing column names of the input are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trackstream.llm.common import materialize, partitions, ship_package

SHINGLE = 3
MAX_BITS = 2


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """64-bit fingerprint of one text, as an unsigned number."""
    import numpy as np
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(s, 42) for s in shingles), np.uint64)
    ones = np.zeros(64, np.int64)
    for a in range(0, len(h), 1 << 16):
        part = h[a:a + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(h)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def text_hash(text_col: str) -> Column:
    """Hash of a text; a null text is an empty one."""
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def with_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      width: int = SHINGLE, hashed: bool = False) -> DataFrame:
    """(doc_id, fp): the fingerprint of every row, as a signed long; with ``hashed``
    (doc_id, th, fp), where ``th`` is the hash of the text."""
    ship_package(df.sparkSession)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        from trackstream.llm.simhash import fingerprint as one

        for b in batches:
            got = np.array([one(x.as_py(), width) for x in b.column(b.num_columns - 1)],
                           np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(got.view(np.int64), pa.int64())],
                [*b.schema.names[:-1], "fp"])

    src = df.select(F.col(id_col).cast("long").alias("doc_id"),
                    *[text_hash(text_col).alias("th")] * hashed,
                    F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, th long, fp long" if hashed else "doc_id long, fp long")


# --- the covering code -------------------------------------------------------

def syndrome(x):
    """Syndrome of the low 63 bits in the Hamming code: the XOR of the numbers
    (1 to 63) of the bits that are set; 0 for a code word."""
    import numpy as np

    s = np.zeros(len(x), np.uint64)
    for i in range(6):
        mask = np.uint64(sum(1 << (p - 1) for p in range(1, 64) if p >> i & 1))
        s |= (np.bitwise_count(x & mask) & 1).astype(np.uint64) << np.uint64(i)
    return s


def anchors(x):
    """All anchors within 2 bits of each fingerprint: (row number, anchor)."""
    import numpy as np

    one, n = np.uint64(1), len(x)
    s = syndrome(x)
    bit = np.where(s > 0, one << (np.maximum(s, one) - one), np.uint64(0))
    home = x ^ bit                                  # the code word within 1
    top = one << np.uint64(63)
    rows, out = [np.arange(n), np.arange(n)], [home, home ^ top]
    for i in range(1, 64):                          # two flips i, j with i ^ j = syndrome
        j = np.uint64(i) ^ s
        ok = (s > 0) & (j > np.uint64(i))
        r = np.flatnonzero(ok)
        rows.append(r)
        out.append(x[r] ^ (one << np.uint64(i - 1)) ^ (one << (j[r] - one)))
    return np.concatenate(rows), np.concatenate(out)


def forest(fps, max_bits: int = MAX_BITS):
    """Spanning forest of the links among distinct fingerprints: (a, b) pairs."""
    import numpy as np

    n = len(fps)
    left = np.arange(n)
    pairs = []
    while len(left):
        # breadth first from the first one left: each becomes part of one tree
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            i = queue.pop()
            near = np.bitwise_count(fps[left] ^ fps[i]) <= max_bits
            hit = left[near]
            pairs.extend((int(fps[i]), int(fps[k])) for k in hit)
            queue.extend(hit)
            left = left[~near]
    return pairs


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): links that connect all distinct fingerprints within ``max_bits``.

    ``fps`` has one column ``fp`` of distinct signed longs."""
    if max_bits not in (1, 2):
        raise ValueError("the covering code serves thresholds of 1 or 2 bits")
    spark = fps.sparkSession
    ship_package(spark)

    def replicate(batches):
        import numpy as np
        import pyarrow as pa

        from trackstream.llm.simhash import anchors as near

        for b in batches:
            col = b.column(0).to_numpy(zero_copy_only=False)
            for a in range(0, len(col), 4096):
                x = col[a:a + 4096].view(np.uint64)
                rows, at = near(x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at.view(np.int64)), pa.array(x[rows].view(np.int64))],
                    ["anchor", "fp"])

    def compare(batches):
        import numpy as np
        import pyarrow as pa

        from trackstream.llm.simhash import forest as tree

        rest_a = rest_f = np.zeros(0, np.int64)

        def found(at, fp):
            edges = np.flatnonzero(np.r_[True, at[1:] != at[:-1], True]) if len(at) else []
            got = []
            for k in np.flatnonzero(np.diff(edges) > 1) if len(at) else []:
                got += tree(fp[edges[k]:edges[k + 1]].view(np.uint64), max_bits)
            if got:
                p = np.array(got, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p[:, 0].copy()), pa.array(p[:, 1].copy())], ["a", "b"])

        for b in batches:
            at = np.concatenate([rest_a, b.column(0).to_numpy(zero_copy_only=False)])
            fp = np.concatenate([rest_f, b.column(1).to_numpy(zero_copy_only=False)])
            if not len(at):
                continue
            cut = int(np.searchsorted(at, at[-1]))  # the last anchor may go on
            yield from found(at[:cut], fp[:cut])
            rest_a, rest_f = at[cut:], fp[cut:]
        yield from found(rest_a, rest_f)

    replicas = fps.select("fp").mapInArrow(replicate, "anchor long, fp long")
    return (replicas.repartition(partitions(spark), "anchor")
            .sortWithinPartitions("anchor", "fp")
            .mapInArrow(compare, "a long, b long").distinct())


# --- components --------------------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """(node, root): connected components by alternating large and small stars.

    Each round points every node at its smallest neighbour; the edges shrink to
    stars in a logarithmic number of rounds.  Neighbourhoods are never gathered:
    a round is a minimum by key and a join, so a component that holds a third of
    all nodes is spread by partial sums and skew joins.  Every round is written
    to the shared folder, and the loop ends when a round changes no edge."""
    pairs = (edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
             .filter("u <> v").distinct())
    now = materialize(pairs, "star")
    before = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or mark[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select("v", "v").distinct())
        before = mark
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(low, "u").select(F.col("v").alias("u"),
                                                            F.col("m").alias("v")))
        large = large.filter("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"),
                                                               F.col("m").alias("v"))
                 .union(least.select("u", "m")))
        now = materialize(small.filter("u <> v").distinct(), "star")


def members(prints: DataFrame, low: Column, max_bits: int) -> DataFrame:
    """(fp, low, root): the component of each different fingerprint, and its ``low``."""
    distinct = prints.groupBy("fp").agg(low.alias("low"))
    tree = components(links(distinct.select("fp"), max_bits))
    in_tree = tree.groupBy("node").agg(F.min("root").alias("root"))
    member = (distinct.join(in_tree, distinct.fp == in_tree.node, "left")
              .select("fp", "low", F.coalesce("root", "fp").alias("root")))
    return materialize(member, "member")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row a document: doc_id, fp (signed long), component_id."""
    prints = materialize(with_fingerprints(df, id_col, text_col, width), "prints")
    member = members(prints, F.min("doc_id"), max_bits)
    lowest = member.groupBy("root").agg(F.min("low").alias("component_id"))
    class_of = member.join(lowest, "root").select("fp", "component_id")
    return prints.join(class_of, "fp").select("doc_id", "fp", "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             width: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``df`` that stand for their component: its first row by id (rows
    without an id come last), then by the hash of the text.

    Of equal rows (id and text) one stays."""
    prints = materialize(with_fingerprints(df, id_col, text_col, width, hashed=True), "prints")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")
    first = members(prints, F.min(row), max_bits).groupBy("root").agg(F.min("low").alias("low")) \
        .select(F.col("low.doc_id").alias("__llm_keep"), F.col("low.th").alias("__llm_th"))
    named = df.join(first, F.col(id_col).cast("long").eqNullSafe(F.col("__llm_keep"))
                    & (text_hash(text_col) == F.col("__llm_th")), "left_semi")
    th = text_hash(text_col)
    nth = F.row_number().over(W.partitionBy(F.col(id_col), th).orderBy(th))
    return named.withColumn("__llm_nth", nth).filter("__llm_nth = 1").drop("__llm_nth")
