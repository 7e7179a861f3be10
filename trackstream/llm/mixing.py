"""Mixing sources to target weights by systematic sampling.

Each document expects ``target / source size`` copies.  Within a source the
documents stand in order of size; a running sum of expected copies plus one
random offset is cut at whole numbers, and a document is emitted once for each
whole number its step crosses.  Standing in order of size makes the words taken
follow the target closely, not only the number of documents.

The running sum is over (size class, salt) blocks, so a source that holds a
third of all rows is spread over many tasks: block totals are summed first
(a few thousand rows a source), then documents are numbered within their block.

Edge cases: a null text has size 0; a null source is a source of its own, last
in order; a source of size 0 gets target 0 and no copies; repeated rows are
documents of their own; ties in the order within a source go by size class, salt, size and
id, and rows equal in all of them change places without effect; a text of any length counts
all its words; an empty table gives an empty result.  Clashing column
names of the input give way to the result's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
BLOCKS = 128
RESULT = ["size", "source_size", "target", "copies", "taken"]


def size_of(text: Column) -> Column:
    """Number of words (runs of characters other than blanks)."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(src, source_size) -> target by weight, none above ``max_repeat`` sizes.

    Sources that stop at their cap are a prefix when ordered by cap / weight;
    what they leave is shared by weight among the rest.  One row a source."""
    by_name = W.orderBy("src")
    rank = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                          (rank % len(weights) + 1).cast("int"))
    s = sizes.select("src", "source_size", weight.alias("weight"),
                     (F.col("source_size") * max_repeat).cast("double").alias("cap"))
    order = W.orderBy(F.col("cap") / F.col("weight"), "src")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    whole = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    left = (F.sum(F.col("source_size").cast("double")).over(whole)
            - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    weight_left = (F.sum("weight").over(whole)
                   - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    s = s.withColumn("level", left / weight_left)
    # the first source that its share does not fill sets the level for the rest
    s = s.withColumn("_o", F.row_number().over(order))
    s = s.withColumn("stop", F.min(F.when(
        F.col("cap") > F.col("level") * F.col("weight"), F.struct("_o", "level"))).over(whole))
    level = F.col("stop")["level"]
    return s.select("src", "source_size", F.coalesce(
        F.least(F.col("cap"), level * F.col("weight")), F.col("cap")).alias("target"))


def source_key(source: Column) -> Column:
    """A key that is never null and keeps code point order, null last."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("~"))


def size_class(size: Column) -> Column:
    """Eight classes to each doubling of the size, in whole-number arithmetic."""
    bits = F.length(F.bin(size))
    return F.when(size < 8, size).otherwise(
        bits * 8 + F.call_function("shiftright", size, bits - 4).bitwiseAND(7)).cast("int")


def _offset(src: Column, seed: int) -> Column:
    """A number in [0, 1) for each source, from its name and the seed."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), src))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mix(df: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT, seed: int = 7,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        keep: list[str] | None = None) -> DataFrame:
    """Add size, source_size, target, copies and taken (copies * size) to each
    document.  ``keep`` names the input columns to carry (all of them if None)."""
    carry = [c for c in (df.columns if keep is None else keep) if c.lower() not in RESULT]
    # what is carried travels in one struct, so no name of it can clash
    row = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)])
    tie = F.xxhash64(text_col) if text_col in carry else F.lit(0)
    base = df.select(
        row.alias("_row"), tie.alias("_tie"), source_key(F.col(source_col)).alias("_src"),
        F.col(id_col).alias("_id"), size_of(F.col(text_col)).alias("size"))
    base = base.select("*", size_class(F.col("size")).alias("_class"), F.pmod(
        F.conv(F.substring(F.md5(F.coalesce(F.col("_id").cast("string"), F.lit(""))), 1, 6),
               16, 10).cast("long"), F.lit(BLOCKS)).cast("int").alias("_salt"))
    blocks = (base.groupBy("_src", "_class", "_salt")
              .agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("s")))
    in_order = (W.partitionBy("_src").orderBy("_class", "_salt")
                .rowsBetween(W.unboundedPreceding, -1))
    blocks = blocks.select("_src", "_class", "_salt", "n", "s", F.coalesce(
        F.sum("n").over(in_order), F.lit(0)).alias("_before"))
    per_source = blocks.groupBy(F.col("_src").alias("src")).agg(F.sum("s").alias("source_size"))
    t = targets(per_source, weights, max_repeat)
    plan = (blocks.select("_src", "_class", "_salt", "_before")
            .join(t.withColumnRenamed("src", "_src"), "_src"))
    numbered = base.select("*", F.row_number().over(
        W.partitionBy("_src", "_class", "_salt").orderBy("size", "_id", "_tie")).alias("_nth"))
    p, n = plan.alias("p"), numbered.alias("n")
    joined = n.join(p, [F.col(f"n.{c}") == F.col(f"p.{c}") for c in ("_src", "_class", "_salt")])
    rate = F.when(F.col("source_size") > 0,
                  F.col("target") / F.col("source_size")).otherwise(0.0)
    at, u = F.col("_before") + F.col("_nth"), _offset(F.col("n._src"), seed)
    # a rate of exactly max_repeat must not gain a copy by rounding
    copies = F.least(F.floor(at * rate + u) - F.floor((at - 1) * rate + u),
                     F.lit(max_repeat)).cast("long")
    out = joined.select(*[F.col("n._row")[f"c{i}"].alias(c) for i, c in enumerate(carry)], F.col("n.size"), "source_size",
                        "target", copies.alias("copies"))
    return out.withColumn("taken", F.col("copies") * F.col("size"))


def emit(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """One row for each copy that the mix takes."""
    return (mixed.filter(F.col("copies") > 0)
            .select(*columns, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy"))
            .drop("_copy"))
