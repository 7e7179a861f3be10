"""N-gram Jaccard join by adaptive multi-match prefixes.

A document's set is its distinct word shingles; two sets link when
``den * intersection >= num * union``.  Equal sets are one *node*, so copies never
meet a join.  Under any one order of all tokens, two sets that share o tokens share
at least l tokens within their first (size - o + l): a longer prefix may ask for more
shared tokens.  The operator uses that twice, each time over all documents:

1. *Screen.*  The order is the token's hash, so a prefix is cut while the text is read
   and whole sets are never shuffled.  Prefixes are lengthened to about twice the
   slack; a node stays if enough of its prefix tokens stand in another node's prefix.
2. *Join.*  The rest is ordered by frequency, rarest first, counted exactly over the
   rest.  For every node l is chosen by estimated cost: the rows that its prefix's
   posting lists bring, and the candidates left to verify (at most rows / l).  Nodes
   with l1 and l2 must share min(l1, l2) prefix tokens, the places of their first
   common token must leave room for the overlap that the threshold asks for, and the
   pair is then verified on the whole sets.

A long posting list is never paired with itself.  First each list offers its members
one pivot only; verified links make components, and lists within one component are
done.  Members of a short list (``PAIRED``) that are in different components are paired.
Long lists of the same smallest member make a group with a *centre*, the tokens that
more than half of its members have, and a member becomes its difference d from the
centre.  Two members link exactly if their differences share at least
(F + F') / 2 (num + den) tokens, where F = (num + den) |d| - (den - num) n.  Where that is
zero or less, both also link to the member of the smallest F, which is paired with all;
every other linked pair shares a token within the first |d| - least + 1 of its
differences, rarest first.  Those prefixes are the next level's lists.  A token of a
difference belongs to at most half of a group, so lists shrink from level to level.  The
next level starts from the differences, not from the sets: two members of a group differ
in the same tokens as their differences do, so a member that is in many lists brings a
few tokens to each.  A group of near copies thus costs a few pairs a member, not its
square, and no pair that could join two components goes unverified.

Frequencies are counts with partial sums and joins on a token are ordinary joins, so a
token in a third of all documents is spread by adaptive skew handling.  Steps are
written to the shared folder; nothing is collected.

Edge cases: a null, empty or blank text has an empty set and links with nothing; with
fewer words than a shingle the whole sequence is one token; texts are read whole;
repeated rows are members of their node; rows without an id are members too but never
a component's smallest id; an empty table gives an empty result.  Only the id and text
columns are read, so clashing names do no harm.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackstream.llm.common import discard, mark, materialize, ship_package
from trackstream.llm.simhash import components, text_hash

SHINGLE = 3
NUM, DEN = 90, 100
#: Prefix tokens that a node may be asked to share, at most.
LONGEST = 8
#: Cost of verifying a candidate, in posting rows a token of its set.
VERIFY = 0.25
#: Longest list whose members are paired directly, and levels before all lists are; they
#: are earlier if the long ones hold no more than ``SPARE`` pairs a row of the prefixes.
PAIRED = 24
LEVELS = 6
SPARE = 1.0


def tokens(text: str | None, width: int = SHINGLE):
    """Sorted distinct 64-bit hashes of one text's word shingles."""
    import numpy as np
    import xxhash

    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    parts = [b" ".join(words)] if len(words) < width else \
        map(b" ".join, zip(*(words[i:] for i in range(width))))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(p, 42) for p in parts), np.uint64))


def slack(n, num: int = NUM, den: int = DEN):
    """Tokens of a set of ``n`` that a linked set may lack."""
    return n - -(-num * n // den)


def _read(df: DataFrame, schema: str, row) -> DataFrame:
    """Rows ``(id, th, *row(text))`` for the rows (id, th, text) of ``df``."""
    ship_package(df.sparkSession)
    names = [x.split()[0] for x in schema.split(",")]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for whole in batches:
            for a in range(0, whole.num_rows, 1000):
                b = whole.slice(a, 1000)
                out = [row(t.as_py()) for t in b.column(2)]
                n = pa.array([x[0] for x in out], pa.int64())
                node = pa.array([x[1] for x in out], pa.binary())
                ends = np.cumsum([0] + [len(x[2]) for x in out]).astype(np.int32)
                flat = np.concatenate([x[2] for x in out] + [np.zeros(0, np.uint64)])
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))
                yield pa.RecordBatch.from_arrays([*b.columns[:2], n, node, lists], names)

    return df.mapInArrow(run, schema)


def _source(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("doc_id"), text_hash(text_col).alias("th"),
                     F.col(text_col).cast("string").alias("text"))


def heads(df: DataFrame, id_col: str, text_col: str, width: int, num: int, den: int) -> DataFrame:
    """(doc_id, th, n, node, head): size, identity and screen prefix of every row's set."""

    def row(text):
        import xxhash

        from trackstream.llm import ngram_join as J

        t = J.tokens(text, width)
        n = len(t)
        return n, xxhash.xxh3_128_digest(t.tobytes()) if n else None, t[:2 * J.slack(n, num, den) + 1]

    return _read(_source(df, id_col, text_col),
                 "doc_id long, th long, n long, node binary, head array<long>", row)


def _slack(n: str, num: int, den: int) -> str:
    return f"({n} - ({num} * {n} + {den - 1}) div {den})"


def screen(prints: DataFrame, num: int, den: int) -> DataFrame:
    """(node, n): the nodes that share enough prefix tokens with any other nodes.

    Rows carry a hash of the node: nodes of one hash are counted together, and stay
    sooner than they need to."""
    nodes = prints.filter("n > 0").groupBy("node").agg(
        F.first("n").alias("n"), F.first("head").alias("head")).withColumn("k", F.xxhash64("node"))
    rows = nodes.select("k", F.explode("head").alias("t"))
    often = rows.groupBy("t").count().filter("count > 1").select("t")
    shared = rows.join(often, "t", "left_semi").groupBy("k").count()
    # the smallest partner's prefix is lengthened least: its l is the number to share
    least = _slack(f"(({num} * n + {den - 1}) div {den})", num, den)
    return nodes.select("k", "node", "n").join(shared, "k").filter(f"count > {least}").select("node", "n")


def sets_of(df: DataFrame, prints: DataFrame, alive: DataFrame, id_col: str, text_col: str,
            width: int) -> DataFrame:
    """(node, n, tokens): the whole sets of the nodes in ``alive``, each read from one row."""
    first = (prints.join(alive.select("node"), "node", "left_semi").groupBy("node")
             .agg(F.min(F.struct("doc_id", "th")).alias("r"))
             .select(F.col("r.doc_id").alias("rid"), F.col("r.th").alias("rth")))
    src = _source(df, id_col, text_col)
    rows = src.join(first, src.doc_id.eqNullSafe(F.col("rid")) & (src.th == F.col("rth")), "left_semi")

    def row(text):
        import xxhash

        from trackstream.llm import ngram_join as J

        t = J.tokens(text, width)
        return len(t), xxhash.xxh3_128_digest(t.tobytes()), t

    whole = _read(rows, "doc_id long, th long, n long, node binary, tokens array<long>", row)
    # rows that repeat an id and text come twice
    return whole.groupBy("node").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens"))


def prefixes(sets: DataFrame, num: int, den: int, longest: int = LONGEST) -> DataFrame:
    """(t, node, n, c, l, at): the adaptive prefix of every node, one row a token that
    other nodes have as well; ``at`` is the token's place in the node's order, ``c`` how
    many of its tokens other nodes have."""
    rows = sets.select("node", "n", F.explode("tokens").alias("t"))
    df = rows.groupBy("t").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    own = (rows.join(df, "t").groupBy("node", "n")
           .agg(F.array_sort(F.collect_list(F.struct("df", "t"))).alias("o"))
           .withColumn("c", F.size("o").cast("long"))
           .filter(f"c >= n - {_slack('n', num, den)}"))
    # a node's first n - c tokens are its own; the shared ones follow
    cost = F.expr(f"""
      array_min(transform(sequence(1L, least({longest}L, n - {_slack('n', num, den)})), l ->
        named_struct('cost', aggregate(slice(o, 1, int(greatest(0L, {_slack('n', num, den)} + l - n + c))),
                                       0D, (a, x) -> a + x.df - 1) * (1 + {VERIFY} * n / l),
                     'l', l))).l""")
    cut = own.withColumn("l", cost)
    keep = F.expr(f"slice(o, 1, int(greatest(0L, {_slack('n', num, den)} + l - n + c)))")
    return cut.select("node", "n", "c", "l", F.posexplode(keep).alias("i", "x")).select(
        F.col("x.t").alias("t"), "node", "n", "c", "l", (F.col("n") - F.col("c") + F.col("i")).alias("at"))


def _fits(overlap: Column, num: int, den: int) -> Column:
    """Whether an overlap of that size (at most) can reach the threshold."""
    return overlap * (num + den) >= (F.col("a_n") + F.col("b_n")) * num


def sets_for(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """The sets of some distinct nodes.  Those are written first: Spark then knows their
    size, and where they are few it broadcasts them and moves no other set."""
    return sets.join(materialize(nodes, "nodes"), "node", "left_semi")


def verify(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b) of the candidate pairs that link."""
    pairs = materialize(pairs, "candidates")
    sets = sets_for(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), sets)
    one = sets.select(F.col("node").alias("a"), F.col("n").alias("a_n"), F.col("tokens").alias("a_t"))
    two = sets.select(F.col("node").alias("b"), F.col("n").alias("b_n"), F.col("tokens").alias("b_t"))
    both = F.size(F.array_intersect("a_t", "b_t"))
    return pairs.join(one, "a").join(two, "b").filter(_fits(both, num, den)).select("a", "b")


def _sides(rows: DataFrame, side: str, cols: list) -> DataFrame:
    return rows.select("t", *[F.col(c).alias(f"{side}_{c}") for c in cols])


def _paired(rows: DataFrame, cols: list, num: int, den: int) -> DataFrame:
    """Members of one list in different components, side by side."""
    return _sides(rows, "a", cols).join(_sides(rows, "b", cols), "t").filter(
        (F.col("a_node") < F.col("b_node")) & (F.col("a_root") != F.col("b_root"))
        & _fits(F.least("a_n", "b_n"), num, den))


def candidates(rows: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): pairs of nodes in different components (column ``root``) that share enough
    prefix tokens and leave room for the overlap asked for.  Column ``far`` counts a
    node's tokens in lists that are not among ``rows``: those may be shared too."""
    cols = ["node", "n", "c", "l", "at", "root", "far"]
    met = _paired(rows, cols, num, den).filter(_fits(F.least("a_c", "b_c"), num, den))
    pairs = met.groupBy("a_node", "b_node").agg(
        F.count(F.lit(1)).alias("shared"), F.min("a_at").alias("a_at"), F.min("b_at").alias("b_at"),
        *[F.first(c).alias(c) for c in ("a_n", "b_n", "a_l", "b_l", "a_far", "b_far")])
    room = F.least(F.col("a_n") - F.col("a_at"), F.col("b_n") - F.col("b_at"))
    far = F.least("a_far", "b_far")
    return pairs.filter((F.col("shared") + far >= F.least("a_l", "b_l"))
                        & ((far > 0) | _fits(room, num, den))).select(
        F.col("a_node").alias("a"), F.col("b_node").alias("b"))


def differences(rows: DataFrame, known: DataFrame, num: int, den: int) \
        -> tuple[DataFrame, DataFrame, DataFrame]:
    """Candidates and next lists of long lists: (a, b) with each group's member of the
    smallest F, and (t, base, node, n, root) of the prefixes of the differences; then the
    differences themselves, (g, node, d) and more, in group g.  ``known`` is (base, node, d):
    a node's set, or its difference in an earlier group, that ``rows`` call ``base``."""
    # a list goes by its member that is in most lists: lists of one cluster share theirs
    lists = rows.groupBy("base", "node").agg((-F.count(F.lit(1))).alias("k"))
    own = rows.join(lists, ["base", "node"]).groupBy("t").agg(
        F.min(F.struct("k", F.xxhash64("base", "node").alias("g"))).alias("own"))
    member = materialize(rows.join(own.select("t", "own.g"), "t").select(
        "g", "base", "node", "n", "root").distinct(), "members")
    size = member.groupBy("g").agg(F.count(F.lit(1)).alias("size"))
    whole = member.join(sets_for(member.select("node").distinct(), known)
                        .select("base", "node", F.col("d").alias("tokens")), ["base", "node"])
    often = (whole.select("g", F.explode("tokens").alias("x")).groupBy("g", "x")
             .agg(F.count(F.lit(1)).alias("f")).filter("f > 1").join(size, "g")
             .withColumn("inside", F.col("f") * 2 > F.col("size")))
    often = materialize(often, "often")
    centre = often.filter("inside").groupBy("g").agg(F.collect_list("x").alias("centre"))
    # a centre has fewer than two mean sets' tokens; without one a difference is the set
    none = F.array().cast("array<bigint>")
    differ = whole.join(centre, "g", "left").withColumn("centre", F.coalesce("centre", none))
    differ = differ.withColumn("d", F.concat(F.array_except("tokens", "centre"),
                                             F.array_except("centre", "tokens")))
    differ = differ.select("g", "node", "n", "root", "d",
                           (F.size("d") * (num + den) - F.col("n") * (den - num)).alias("F"))
    differ = materialize(differ, "differences")
    top = differ.groupBy("g").agg(F.min(F.struct("F", "node", "n", "root")).alias("top"))
    top = top.select("g", F.col("top.F").alias("b_F"), F.col("top.node").alias("b"),
                     F.col("top.root").alias("b_root"))
    with_top = differ.join(top, "g")
    stars = with_top.filter((F.col("F") + F.col("b_F") <= 0) & (F.col("root") != F.col("b_root"))) \
        .select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b"))
    size_d = F.size("d")
    least = F.greatest(F.lit(1), F.ceil((F.col("F") + F.col("b_F")) / (2 * (num + den))))
    parts = with_top.select("g", "node", "n", "root", size_d.alias("s"),
                            (size_d - least + 1).alias("upto"), F.explode("d").alias("x")) \
        .filter("upto > 0")
    rank = often.select("g", "x", F.when(F.col("inside"), F.col("size") - F.col("f"))
                        .otherwise(F.col("f")).alias("k")).filter("k > 1")
    # tokens that no other member's difference has come first in the order
    kept = parts.join(rank, ["g", "x"]).groupBy("g", "node", "n", "root", "s", "upto").agg(
        F.array_sort(F.collect_list(F.struct("k", "x"))).alias("o"))
    first = F.expr("slice(o, 1, int(greatest(0L, upto - s + size(o))))")
    lists = kept.select("g", "node", "n", "root", F.explode(first).alias("p")).select(
        F.xxhash64("g", "p.x").alias("t"), F.col("g").alias("base"), "node", "n", "root")
    return stars, lists, differ


def pivots(rows: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): every list's members beside one of them; lists of the same members choose
    the same one."""
    mark = F.xxhash64("node")
    top = rows.groupBy("t").agg(F.min(F.struct(mark.alias("k"), "node", "n", "c", "root")).alias("p"))
    top = top.select("t", *[F.col(f"p.{c}").alias(f"b_{c}") for c in ("node", "n", "c", "root")])
    met = _sides(rows, "a", ["node", "n", "c", "root"]).join(top, "t")
    return met.filter((F.col("a_root") != F.col("b_root"))
                      & _fits(F.least("a_c", "b_c", "a_n", "b_n"), num, den)).select(
        F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")).distinct()


def _roots(edges: list) -> DataFrame:
    """(node, root) of the nodes that verified links connect."""
    tree = components(reduce(DataFrame.union, edges))
    return materialize(tree.groupBy("node").agg(F.min("root").alias("root")), "roots")


def _labelled(rows: DataFrame, tree: DataFrame | None) -> DataFrame:
    """``rows`` with each node's component so far and its list's length; lists within one
    component are done."""
    rows = rows.drop("root")
    if tree is not None:
        now = rows.join(tree, "node", "left").withColumn("root", F.coalesce("root", "node"))
    else:
        now = rows.withColumn("root", F.col("node"))
    now = materialize(now, "lists")
    open_ = now.groupBy("t").agg(F.min("root").alias("x"), F.max("root").alias("y"),
                                 F.count(F.lit(1)).alias("length")).filter("x <> y")
    return now.join(open_.select("t", "length"), "t")


def similar_nodes(df: DataFrame, prints: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  width: int = SHINGLE, num: int = NUM, den: int = DEN, every_link: bool = False,
                  paired: int = PAIRED, spare: float = SPARE) -> DataFrame:
    """(a, b): links between nodes, verified; all of them with ``every_link``, else
    enough of them to connect every component."""
    spark, start = df.sparkSession, mark()
    alive = materialize(screen(prints, num, den), "alive")
    sets = materialize(sets_of(df, prints, alive, id_col, text_col, width), "sets")
    discard(spark, start, [sets])
    rows = materialize(prefixes(sets, num, den).withColumn("base", F.lit(0).cast("long")), "prefixes")
    known = sets.select(F.lit(0).cast("long").alias("base"), "node", F.col("tokens").alias("d"))
    none = F.lit(0).alias("far")
    if every_link:
        return verify(candidates(_labelled(rows, None).select("*", none), num, den), sets, num, den)
    room = rows.count() * spare
    edges = [materialize(verify(pivots(_labelled(rows, None), num, den), sets, num, den), "links")]
    tree = _roots(edges)
    discard(spark, start, [sets, rows, tree, *edges])
    for level in range(LEVELS):
        lists = _labelled(rows, tree)
        long = lists.filter(F.col("length") > paired)
        # pairs that long lists hold, each member with the half of its list
        held = long.agg(F.sum((F.col("length") - 1) / 2)).first()[0] or 0
        last = level + 1 == LEVELS or held <= room
        near = lists if last else lists.filter(F.col("length") <= paired)
        if level == 0:
            far = long.groupBy("node").agg(F.count(F.lit(1)).alias("far"))
            near = near.select("*", none) if last else near.join(far, "node", "left").withColumn(
                "far", F.coalesce("far", F.lit(0)))
            pairs = candidates(near, num, den)
        else:
            pairs = _paired(near, ["node", "n", "root"], num, den).select(
                F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct()
        if not last:
            stars, rows, differ = differences(long, known, num, den)
            known = differ.select(F.col("g").alias("base"), "node", "d")
            pairs = pairs.union(stars).distinct()
        found = materialize(verify(pairs, sets, num, den), "links")
        edges.append(found)
        if last:
            break
        rows = materialize(rows, "prefixes")
        if not found.isEmpty():
            tree = _roots(edges)
        discard(spark, start, [sets, rows, differ, tree, *edges])
    return reduce(DataFrame.union, edges)


def join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE,
         num: int = NUM, den: int = DEN, **lists) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id.  ``lists`` are ``paired`` and
    ``spare`` of :func:`similar_nodes`: how long lists are handled, not what links."""
    start = mark()
    prints = materialize(heads(df, id_col, text_col, width, num, den), "heads")
    tree = components(similar_nodes(df, prints, id_col, text_col, width, num, den, **lists))
    tree = tree.groupBy("node").agg(F.min("root").alias("root"))
    low = prints.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("low"))
    member = materialize(low.join(tree, "node", "left").select(
        "node", "low", F.coalesce("root", "node").alias("root")), "member")
    discard(df.sparkSession, start, [prints, member])
    of = member.groupBy("root").agg(F.min("low").alias("component_id"))
    of = member.join(of, "root").select("node", "component_id")
    return prints.select("doc_id", "n", "node").join(of, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        .alias("component_id"))


def all_links(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE,
              num: int = NUM, den: int = DEN) -> DataFrame:
    """(a, b): every link between different sets, as the smallest ids that have them."""
    prints = materialize(heads(df, id_col, text_col, width, num, den), "heads")
    links = similar_nodes(df, prints, id_col, text_col, width, num, den, every_link=True)
    low = prints.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("low"))
    one = low.select(F.col("node").alias("a"), F.col("low").alias("x"))
    two = low.select(F.col("node").alias("b"), F.col("low").alias("y"))
    return links.join(one, "a").join(two, "b").select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
