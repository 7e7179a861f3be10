"""Line deduplication with a log-template tree.

Lines are parsed at a fixed depth: the number of tokens and the first ``depth``
tokens (those with a digit read as a variable field) name a leaf.  Within a leaf
that more than one document reaches, the commonest token of each position forms
the leaf's template.  A line that agrees with it in at least ``similarity`` of
its tokens belongs to it: where it differs is a variable field.  Any other line
votes again among the lines left over, which are parted by their token at one more
position, the one with fewest different tokens, as long as a part could hold a
recurring template.  A line that no shape fits is a template of its own, with only
tokens that hold a digit as fields.

A template found in ``min_docs`` or more documents is recurring.  Its first line
(lowest document, lowest place) stays; all its other lines are dropped.  With
``long_docs`` (``WHOLE``) that many documents are enough for lines of
``LONG_TOKENS`` tokens or more, which do not meet by chance.

Lines of fewer than ``min_tokens`` tokens meet by chance.  Without ``short_docs``
they are never dropped.  With it (``op7_line_dedup`` and the pipeline, ``WHOLE``)
each is a template of its own that must match in full but for its numbers, and
recurs in ``short_docs`` documents; a line of numbers and signs must match in full.  One of many characters (scripts without blanks) counts as
long as its characters: ``TOKEN_CHARS`` of them stand for a token.

Everything is built-in DataFrame work.  Only hashes leave the scan: leaves first
(partial sums make a line that a third of all documents hold cheap), then tokens
of lines in leaves that several documents share, then numbers of dropped lines.

Edge cases: a null text has no lines and stays null; an empty text stays empty;
rows that repeat an id with the same text are one document and lose the same
lines, with another text they are documents of their own; a null doc_id comes
last in order; ties between tokens go to the smallest; a text of any length is
parsed line by line as a whole; an empty table gives an empty result; a column of the
input that clashes with a result column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackstream.llm.common import BLANKS, let, materialize

DEPTH = 4
MIN_TOKENS = 5
MIN_DOCS = 3
SIMILARITY = 0.8
SHORT_DOCS = 20        # documents that make a line of few tokens recurring
LONG_TOKENS = 20       # tokens of a line that does not meet by chance
LONG_DOCS = 2          # documents that make such a line recurring
TOKEN_CHARS = 8        # characters that stand for a token in a line of few tokens
#: The rule of the query and the pipeline.
WHOLE = {"short_docs": SHORT_DOCS, "long_docs": LONG_DOCS}
FIELD = "<*>"
USUAL, LONG, SHORT = 0, 1, 2    # classes of leaves
RESULT = ["n_lines", "n_dropped"]
DOC = ["_doc", "_th"]          # a document: its id and the hash of its text


def _keys(id_col: str, text_col: str) -> list[Column]:
    last = F.lit(2 ** 63 - 1)
    return [F.coalesce(F.col(id_col).cast("long"), last).alias("_doc"),
            F.xxhash64(text_col).alias("_th"), F.col(text_col).cast("string").alias("_text")]


#: A token that holds a digit, from its first character on.
_DIGIT_TOKEN = f"(?<![^{BLANKS}])[^0-9{BLANKS}]*+[0-9][^{BLANKS}]*+"
#: Anything but lines whose tokens are parted by one space each.
_LOOSE = "[\t\x0b\x0c\r]|  | \n|\n |^ | $"


def plain_lines(keyed: DataFrame, *more: str) -> DataFrame:
    """(_doc, _th, at, line): every line in lower case, its tokens parted by one space.

    The text is put in that form as a whole, so a line is a substring and needs no
    arrays of its own."""
    low = F.lower("_text")
    tight = F.regexp_replace(F.regexp_replace(low, "[ \t\x0b\x0c\r]+", " "), " ?\n ?", "\n")
    text = F.when(low.rlike(_LOOSE), F.trim(tight)).otherwise(low)
    return keyed.select(*DOC, *more, F.posexplode(F.split(text, "\n")).alias("at", "line"))


def masked(line: Column) -> Column:
    """A plain line; a token with a digit is a variable field."""
    return F.when(line.rlike("[0-9]"), F.regexp_replace(line, _DIGIT_TOKEN, FIELD)).otherwise(line)


def classed(leaf: Column, kind) -> Column:
    """A leaf whose lowest two bits say how many documents it needs."""
    return F.shiftleft(leaf, 2).bitwiseOR(kind)


def needed(min_docs: int, short_docs: int | None, long_docs: int | None) -> Column:
    """Documents that make a template of a leaf recurring."""
    if short_docs is None and long_docs is None:
        return F.lit(min_docs)
    kind = F.col("leaf").bitwiseAND(F.lit(3).cast("long"))
    return (F.when(kind == LONG, long_docs or min_docs).when(kind == SHORT, short_docs or min_docs)
            .otherwise(min_docs))


def parsed_lines(keyed: DataFrame, depth: int, min_tokens: int,
                 short_docs: int | None = None, long_docs: int | None = None) -> DataFrame:
    """(_doc, _th, at, leaf, full) of every line with ``min_tokens`` tokens, with
    ``short_docs`` of every line with a token.

    ``leaf``: hash of the token count and the leading tokens; ``full``: hash of all
    tokens of the masked line."""
    line = F.col("line")
    n = F.length(line) - F.length(F.replace(line, F.lit(" "))) + 1
    lines = plain_lines(keyed).filter("line <> ''").withColumn("n", n)
    is_short = F.col("n") < min_tokens
    # a line of few tokens is itself but for its numbers; one of signs must match in full
    number = F.when(line.rlike(r"\p{L}"), F.regexp_replace(line, "[0-9]+", FIELD)).otherwise(line)
    if short_docs is None:
        lines = lines.filter(~is_short)
        form = masked(line)
    else:
        form = F.when(is_short, number).otherwise(masked(line))
    lines = lines.withColumn("line", form)
    leaf = F.xxhash64("n", F.substring_index("line", " ", depth))
    if short_docs is not None or long_docs is not None:
        long = F.when(F.col("n") < LONG_TOKENS, USUAL).otherwise(LONG)
        chars = F.length("line")
        short = (F.when(chars < min_tokens * TOKEN_CHARS, SHORT)
                 .when(chars < LONG_TOKENS * TOKEN_CHARS, USUAL).otherwise(LONG))
        leaf = classed(F.when(is_short, F.xxhash64(F.lit(0), "line")).otherwise(leaf),
                       F.when(is_short, short).otherwise(long).cast("long"))
    return lines.select(*DOC, "at", leaf.alias("leaf"), F.xxhash64("line").alias("full"))


def voted(reps: DataFrame, by: list[str]) -> DataFrame:
    """(by, pos, v, token, kinds): the token of most documents at each position."""
    tokens = reps.select(*by, "n_docs", F.posexplode(F.split("line", " ")).alias("pos", "token"))
    votes = tokens.groupBy(*by, "pos", "token").agg(F.sum("n_docs").alias("votes"))
    best = votes.groupBy(*by, "pos").agg(F.min(F.struct((-F.col("votes")).alias("v"), "token"))
                                         .alias("b"), F.count(F.lit(1)).alias("kinds"))
    return best.select(*by, "pos", "b.v", "b.token", "kinds")


def shapes(best: DataFrame, by: list[str]) -> DataFrame:
    """(by, shape, part): the shape, as long as one line, and the position to part at:
    that of fewest tokens, then that of the evenest parts."""
    part = F.min(F.when(F.col("kinds") > 1, F.struct("kinds", (-F.col("v")).alias("most"), "pos")))
    return best.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("pos", "token")))
                                 .alias("shape"), part["pos"].alias("part"))


def agrees(similarity: float) -> Column:
    same = F.size(F.filter(F.arrays_zip(F.split("line", " "), F.col("shape.token").alias("t")),
                           lambda z: z["0"] == z["t"]))
    return same >= similarity * F.size("shape")


def every_template(reps: DataFrame, similarity: float, need: Column) -> DataFrame:
    """(leaf, full, tmpl) of the lines that belong to some template of their leaf.

    ``reps`` has one row (leaf, full, n_docs, line) for each different line of a
    leaf.  A template takes the token of most documents at each position.  A
    round votes in each group (first a leaf); lines that agree with the shape are
    done.  The others go on in smaller groups: some line agreed, or the position
    that parts them has several tokens, so the rounds end."""
    left = reps.withColumn("tmpl", F.lit(0).cast("long"))
    found = None
    while True:
        shape = shapes(voted(left, ["leaf", "tmpl"]), ["leaf", "tmpl"])
        seen = materialize(left.join(shape, ["leaf", "tmpl"]).select(
            "leaf", "tmpl", "full", "n_docs", agrees(similarity).alias("fits"),
            F.when(~agrees(similarity), F.col("line")).alias("line"),
            F.get(F.split("line", " "), F.col("part")).alias("token"), "part"), "round")
        fits = seen.filter("fits").select("leaf", "full", "tmpl")
        found = fits if found is None else found.unionByName(fits)
        rest = seen.filter("not fits").select(
            "leaf", F.xxhash64("tmpl", "part", "token").alias("tmpl"), "full", "n_docs", "line")
        live = rest.groupBy("leaf", "tmpl").agg(
            F.count(F.lit(1)).alias("k"), F.sum("n_docs").alias("d")) \
            .filter((F.col("k") > 1) & (F.col("d") >= need)).select("leaf", "tmpl")
        left = materialize(rest.join(live, ["leaf", "tmpl"], "left_semi"), "left")
        if left.isEmpty():
            return found


def recurring(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH,
              min_tokens: int = MIN_TOKENS, min_docs: int = MIN_DOCS,
              similarity: float = SIMILARITY, short_docs: int | None = None,
              long_docs: int | None = None) -> DataFrame:
    """(_doc, _th, drop): the numbers of the lines to drop from each document."""
    need = needed(min_docs, short_docs, long_docs)
    keyed = df.select(*_keys(id_col, text_col))
    rows = materialize(parsed_lines(keyed, depth, min_tokens, short_docs, long_docs),
                       "lines")                                     # hashes and places
    per_doc = rows.groupBy("leaf", "full", *DOC).agg(F.min("at").alias("at"))
    kinds = materialize(per_doc.groupBy("leaf", "full").agg(
        F.count(F.lit(1)).alias("n_docs"), F.min(F.struct(*DOC, "at")).alias("first")), "kinds")
    # leaves in which several lines could share a template
    mixed = kinds.groupBy("leaf").agg(F.count(F.lit(1)).alias("k"), F.sum("n_docs").alias("d")) \
        .filter((F.col("k") > 1) & (F.col("d") >= need)).select("leaf")
    reps = materialize(kinds.join(mixed, "leaf", "left_semi").select(
        "leaf", "full", "n_docs", "first._doc", "first._th", "first.at"), "reps")
    # a second look at the texts, for the tokens of those lines only; one plan at any size
    of_doc = reps.groupBy(*DOC).agg(F.collect_list(F.struct("at", "leaf", "full", "n_docs"))
                                    .alias("reps"))                 # lines of one text
    theirs = keyed.join(of_doc.hint("merge"), DOC)
    shown = plain_lines(theirs, "reps").select(
        "line", F.explode(F.filter("reps", lambda r: r["at"] == F.col("at"))).alias("r")).select(
        "r.leaf", "r.full", "r.n_docs", masked(F.col("line")).alias("line")) \
        .dropDuplicates(["leaf", "full"])
    joined = materialize(every_template(materialize(shown, "shown"), similarity, need), "joined")
    named = (kinds.join(joined, ["leaf", "full"], "left")
             .withColumn("shared", F.col("tmpl").isNotNull())
             .withColumn("tmpl", F.coalesce("tmpl", "full")))
    # documents of a template; a line of its own was counted above
    own = named.filter("not shared").select("leaf", "tmpl", "n_docs", "first")
    some = (rows.join(joined, ["leaf", "full"]).groupBy("leaf", "tmpl", *DOC)
            .agg(F.min("at").alias("at"))
            .groupBy("leaf", "tmpl").agg(F.count(F.lit(1)).alias("n_docs"),
                                         F.min(F.struct(*DOC, "at")).alias("first")))
    often = own.unionByName(some).filter(F.col("n_docs") >= need)
    goes = materialize(named.select("leaf", "full", "tmpl").join(often, ["leaf", "tmpl"]).select(
        "leaf", "full", F.col("first").alias("stay")), "recurring")
    dropped = rows.join(goes, ["leaf", "full"]).filter(
        F.struct(*DOC, "at") != F.col("stay"))
    return dropped.groupBy(*DOC).agg(F.collect_set("at").alias("drop"))   # lines of one text


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """``df`` with recurring lines taken out of the text, n_lines and n_dropped."""
    goes = recurring(df, id_col, text_col, **params)
    columns = [c for c in df.columns if c.lower() not in RESULT]
    # all but the text travel in one struct, so no name of theirs can clash
    rest = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"c{i}")
                                           for i, c in enumerate(columns) if c != text_col])
    docs = df.select(*_keys(id_col, text_col), rest.alias("_rest"))
    both = docs.join(goes, DOC, "left")
    parts = F.split("_text", "\n")

    def without(p):
        keep = F.array_except(F.sequence(F.lit(0), F.size(p) - 1), F.col("drop"))
        return F.array_join(F.transform(keep, lambda i: F.get(p, i)), "\n")

    text = F.when(F.col("drop").isNull(), F.col("_text")).otherwise(let(parts, without))
    n_lines = F.when(F.col("_text").isNull(), 0).otherwise(F.size(parts))
    return both.select(
        *[(text if c == text_col else F.col("_rest")[f"c{i}"]).alias(c)
          for i, c in enumerate(columns)],
        n_lines.cast("long").alias("n_lines"),
        F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"))
