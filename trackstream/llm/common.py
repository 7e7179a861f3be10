"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackstream.session import checkpoint_dir, ship_package  # noqa: F401

#: The six characters that part words: space, tab, line feed, vertical tab,
#: form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df.select(*cols) if cols else df


def let(value: Column, body) -> Column:
    """``body(v)`` with ``value`` computed once per row.

    A lambda variable cannot be inlined by the optimizer, so an expensive array
    is not computed again for every element of a lambda that mentions it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Maximal runs of characters outside :data:`BLANKS` (null text: none)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{BLANKS}]+"), "")


def count_of(text: Column, part: str) -> Column:
    """Occurrences of a short literal that cannot overlap itself."""
    cut = F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))
    return (cut / len(part)).cast("long")


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))


def before(values: Column, zero: Column, join) -> Column:
    """For each element of an array of longs, what ``join`` (a sum, a maximum) makes of all
    elements before it.  Runs in blocks, so the work is linear in the array's length."""
    block = 256

    def run(part, start):
        out = F.struct(start.alias("s"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(part, out, lambda a, x: F.struct(
            join(a["s"], x).alias("s"), F.concat(a["out"], F.array(a["s"])).alias("out")))["out"]

    def of(v):
        starts = F.when(F.size(v) > 0, F.sequence(F.lit(1), F.size(v), F.lit(block)))
        parts = F.transform(F.coalesce(starts, F.array().cast("array<int>")),
                            lambda i: F.slice(v, i, F.lit(block)))
        return let(parts, lambda p: let(run(F.transform(p, lambda x: F.aggregate(x, zero, join)), zero),
                                        lambda b: F.flatten(F.transform(
                                            p, lambda x, i: run(x, F.get(b, i))))))

    return let(values, of)


_own = threading.local()


def _written() -> list:
    if not hasattr(_own, "paths"):
        _own.paths = []
    return _own.paths


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    The written table cuts the lineage: work that follows survives the loss of
    any executor without repeating what came before."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written().append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def mark() -> int:
    """A place among the tables that this thread has written."""
    return len(_written())


def discard(spark: SparkSession, since: int, keep: list) -> None:
    """Remove the tables that this thread wrote behind ``since``, but for ``keep``: nothing
    that is still to be computed may read the others."""
    stay = {x.written_at for x in keep if x is not None}
    for path in _written()[since:]:
        if path not in stay:
            remove(spark, path)
    _written()[since:] = [p for p in _written()[since:] if p in stay]


def remove(spark: SparkSession, path: str) -> None:
    """Remove a written table."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tokenizer_path(name: str) -> str:
    """Place of a vocabulary file on this node: a path as it is, a bare file name in the
    folder of public tokenizers.  To be called where the file is read (in the worker)."""
    import os

    if os.sep not in name:
        import public_tokenizers

        name = public_tokenizers.path(name)
    if not os.path.exists(name):
        raise FileNotFoundError(f"tokenizer file {name} not found")
    return name
