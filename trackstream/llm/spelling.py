"""Spelling variants by finite-state composition.

The vocabulary is counted over whole texts.  Its pairs within one edit are what the
composition  vocabulary acceptor ∘ one-edit transducer ∘ vocabulary acceptor  accepts.
The composition is never built whole: it is enumerated for each *initial state*.  If
the shorter word of a pair has m code points, the pair shares its first ⌊m/2⌋ or its
last ⌈m/2⌉ of them, because one edit can lie in one half only.  So the words are dealt
by the state that the acceptor (or, from the right, the acceptor of the mirrored words)
reaches over that half; what they read from there on is a small language of its own.
Its acceptor is minimised by hash-consing states with equal futures, and one-edit pairs
are read off the composition: a common path, one edit arc, then the intersection of two
states' futures (kept for each pair of states, and free where both are one state).

A state that leads to more than ``MOST`` words is split the same way once more: the
rest of the words halves again, so no task meets an unbounded group and no pair is lost
(a rest of one code point leaves an alphabet at most).

Edge cases: a null or empty text has no words; a null doc_id counts as an empty id text
in the deletion hash; a text of any length is read whole; repeated rows count again;
ties for a form go to the smallest word in code-point order; an empty table gives an
empty result.  Only the id and text columns are read, so clashing names do no harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackstream.llm.common import materialize, partitions, ship_package

LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
#: A run whose hash this number divides loses one code point.
DELETE_MOD = 199
MOST = 4096
_HELD = 200_000        # words that a task counts before it passes its sums on


def count_words(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                least_length: int = LEAST_LENGTH, delete_mod: int = DELETE_MOD) -> DataFrame:
    """(word, n): letter runs of at least ``least_length`` code points over all texts."""
    ship_package(df.sparkSession)

    def run(batches):
        import re
        import zlib
        from collections import Counter

        import pyarrow as pa

        # U+00C0 to U+00FF are the two-byte sequences that begin with C3
        runs = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf]){%d,}" % least_length).findall
        counts: dict = {}

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array([w.decode() for w in counts], pa.string()),
                 pa.array(list(counts.values()), pa.int64())], ["word", "n"])

        for b in batches:
            ids = b.column(0).cast(pa.string()).to_pylist()
            for doc, text in zip(ids, b.column(1)):
                text = text.as_py()
                if not text:
                    continue
                base = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for w, k in Counter(runs(text.encode("utf-8", "replace").lower())).items():
                    h = zlib.crc32(w, base)
                    if h % delete_mod == 0:
                        t = w.decode()
                        at = h % len(t)
                        t = t[:at] + t[at + 1:]
                        if len(t) < least_length:
                            continue
                        w = t.encode()
                    counts[w] = counts.get(w, 0) + k
                if len(counts) > _HELD:
                    yield out()
                    counts.clear()
        if counts:
            yield out()

    src = df.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return src.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# --- one-edit pairs -----------------------------------------------------------

class Acceptor:
    """Minimised acceptors of sets of words; equal futures are one state."""

    def __init__(self):
        self.register, self.arcs, self.final = {}, [], []
        self.futures, self.shared = {}, {}

    def state(self, final: bool, arcs: tuple) -> int:
        key = (final, arcs)
        s = self.register.get(key)
        if s is None:
            s = self.register[key] = len(self.arcs)
            self.arcs.append(dict(arcs))
            self.final.append(final)
        return s

    def build(self, words: list) -> int:
        """The initial state of sorted, distinct words."""
        final = bool(words) and words[0] == ""
        arcs, i = [], int(final)
        while i < len(words):
            c, j = words[i][0], i
            while j < len(words) and words[j][0] == c:
                j += 1
            arcs.append((c, self.build([w[1:] for w in words[i:j]])))
            i = j
        return self.state(final, tuple(arcs))

    def future(self, p: int) -> list:
        """All that is accepted from ``p``."""
        got = self.futures.get(p)
        if got is None:
            got = [""] if self.final[p] else []
            for c, s in self.arcs[p].items():
                got += [c + x for x in self.future(s)]
            self.futures[p] = got
        return got

    def both(self, p: int, q: int) -> list:
        """All that is accepted from ``p`` and from ``q`` (the copy arcs of the composition)."""
        if p == q:
            return self.future(p)
        key = (p, q) if p < q else (q, p)
        got = self.shared.get(key)
        if got is None:
            got = [""] if self.final[p] and self.final[q] else []
            one, two = self.arcs[p], self.arcs[q]
            for c in one.keys() & two.keys():
                got += [c + x for x in self.both(one[c], two[c])]
            self.shared[key] = got
        return got

    def replaced(self, p: int, path: str = "") -> list:
        """(x, y): words from ``p`` that differ in one replaced symbol, x before y."""
        out, arcs = [], sorted(self.arcs[p].items())
        for i, (c, s) in enumerate(arcs):
            for d, t in arcs[i + 1:]:
                out += [(f"{path}{c}{x}", f"{path}{d}{x}") for x in self.both(s, t)]
            out += self.replaced(s, path + c)
        return out

    def inserted(self, p: int, q: int, path: str = "") -> list:
        """(x, y): x from ``p`` becomes y from ``q`` by one inserted symbol.

        An insertion beside an equal symbol can be read at several places; it is
        taken where the copied path is longest, so a pair comes once."""
        out, short = [], self.arcs[p]
        for d, t in self.arcs[q].items():
            for x in self.both(p, t):
                if not x.startswith(d):
                    out.append((path + x, f"{path}{d}{x}"))
            if d in short:
                out += self.inserted(short[d], t, path + d)
        return out


def pairs_of(short: list, long: list) -> list:
    """One-edit pairs of (rest, word) entries of one state: among ``short`` by a
    replacement, from ``short`` to ``long`` by an insertion."""
    net = Acceptor()
    a, b = dict(short), dict(long)
    start = net.build(sorted(a))
    out = [(a[x], a[y]) for x, y in net.replaced(start)]
    if b:
        out += [(a[x], b[y]) for x, y in net.inserted(start, net.build(sorted(b)))]
    return out


def initial_states(words: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(state, left, rest, word): ``left`` is the length of the shorter rests of a state."""
    size = F.length("word")
    m = F.explode(F.when(size > least_length, F.array(size, size - 1)).otherwise(F.array(size)))
    cut = words.select("word", m.alias("m")).withColumn("h", F.expr("m div 2"))
    return cut.select("word", "m", "h", F.explode(F.array(
        F.struct(F.format_string("%d<%s", "m", F.expr("left(word, h)")).alias("state"),
                 F.expr("m - h").alias("left"), F.expr("substr(word, h + 1)").alias("rest")),
        F.struct(F.format_string("%d>%s", "m", F.expr("right(word, m - h)")).alias("state"),
                 F.col("h").alias("left"),
                 F.expr("left(word, length(word) - (m - h))").alias("rest")))).alias("s")) \
        .select("s.*", "word")


def _split(rows: DataFrame) -> DataFrame:
    """Halve the rests of states once more."""
    cut = rows.withColumn("h", F.expr("left div 2"))
    return cut.select("word", F.explode(F.array(
        F.struct(F.format_string("%s<%s", "state", F.expr("left(rest, h)")).alias("state"),
                 F.expr("left - h").alias("left"), F.expr("substr(rest, h + 1)").alias("rest")),
        F.struct(F.format_string("%s>%s", "state", F.expr("right(rest, left - h)")).alias("state"),
                 F.col("h").alias("left"),
                 F.expr("left(rest, length(rest) - (left - h))").alias("rest")))).alias("s")) \
        .select("s.*", "word")


def near_pairs(words: DataFrame, least_length: int = LEAST_LENGTH, most: int = MOST) -> DataFrame:
    """(a, b): all pairs of distinct ``word``s that are one edit apart, each once.

    No word may be shorter than ``least_length``."""
    spark = words.sparkSession
    ship_package(spark)
    now = materialize(initial_states(words, least_length), "states")
    ready = []
    while True:
        large = materialize(now.groupBy("state", "left").count()
                            .filter((F.col("count") > most) & (F.col("left") > 1))
                            .select("state"), "large")
        if large.isEmpty():
            ready.append(now)
            break
        ready.append(now.join(large, "state", "left_anti"))
        now = materialize(_split(now.join(large, "state", "left_semi")), "states")

    def run(batches):
        import pyarrow as pa

        from trackstream.llm.spelling import pairs_of as compose

        at, short, long = None, [], []
        found: list = []

        def out():
            p = [(x, y) if x < y else (y, x) for x, y in found]
            found.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in p], pa.string()), pa.array([y for _, y in p], pa.string())],
                ["a", "b"])

        for b in batches:
            for state, left, rest, word in zip(*(c.to_pylist() for c in b.columns)):
                if state != at:
                    if short and len(short) + len(long) > 1:
                        found.extend(compose(short, long))
                        if len(found) > 50_000:
                            yield out()
                    at, short, long = state, [], []
                (short if len(rest) == left else long).append((rest, word))
        if short and len(short) + len(long) > 1:
            found.extend(compose(short, long))
        if found:
            yield out()

    every = ready[0]
    for more in ready[1:]:
        every = every.union(more)
    return (every.select("state", "left", "rest", "word")
            .repartition(partitions(spark), "state").sortWithinPartitions("state")
            .mapInArrow(run, "a string, b string").distinct())


# --- forms and roots ----------------------------------------------------------

def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: pointer doubling, so the rounds are
    the logarithm of the longest chain (a form has ``RATIO`` times its word's count)."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        to = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = materialize(now.join(to, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"),
            F.col("further").isNotNull().alias("moved")), "roots")
        if now.filter("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
             ratio: int = RATIO, delete_mod: int = DELETE_MOD) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of the vocabulary."""
    words = materialize(count_words(df, id_col, text_col, least_length, delete_mod)
                        .filter(F.col("n") >= least_count), "words")
    pairs = near_pairs(words.select("word"), least_length)
    sides = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near")))).alias("p")).select("p.*")
    of = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = (sides.join(of, "near").groupBy("word")
            .agg(F.count(F.lit(1)).alias("n_near"),
                 F.min(F.struct((-F.col("near_n")).alias("k"), "near")).alias("top")))
    formed = F.col("top.k") * -1 >= F.col("n") * ratio
    table = materialize(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, F.col("top.near")).alias("form"),
        F.when(formed, -F.col("top.k")).alias("form_n")), "variants")
    root = roots(table.filter("form is not null"))
    return table.join(root, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
