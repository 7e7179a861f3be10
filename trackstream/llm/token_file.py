"""Token files: texts as ids of a public vocabulary, in compressed blocks.

Documents are put in ascending id order by range, each task tokenizes its range
and writes segments: whole documents, about ``SEGMENT_IDS`` ids together, coded by
:mod:`trackstream.llm.range_coder` in independent, checksummed blocks.  The files
are written by Spark's own writer (one row a segment), so a lost or repeated task
leaves nothing behind, and any store that Spark can write will do.

Columns of a file: part and seg (their order is the order of the documents),
n_ids, doc_ids and n_tokens (one entry a document), blocks (coded payloads).

Edge cases: a null or empty text has the end id only; a null doc_id comes first;
repeated rows are documents of their own, in order of their text's hash; a text
of any length is one document of one segment (its blocks stay small); an empty
table gives empty files and an empty result.  Only the id and text columns are read, so
clashing names do no harm.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trackstream.llm.common import partitions, ship_package, tokenizer_path

BLOCK_IDS = 2048
SEGMENT_IDS = 1 << 14
#: What a worker handles together: characters of texts to encode, ids to code or decode
#: (up to twice as many, so that no few are left for a round of their own).
TOGETHER_CHARS = 1 << 22
FLUSH_IDS = 3 << 20
END = 1
SCHEMA = ("part int, seg int, n_ids long, doc_ids array<long>, n_tokens array<long>, "
          "blocks array<binary>")
#: Texts of these characters alone can be cut at white space and encoded word by
#: word: the vocabulary's normaliser and pattern then see nothing across a blank.
_OTHER = "[^\t\n\r -~¡-įı-ɏ]|<\\|"


#: A letter and an ASCII sign or digit behind it are never in one word of the vocabulary.
_SIGN = r"(\p{L})([!-@\[-`{-~])"


class WordCoder:
    """Encodes texts with the tokenizers library, each different word once."""

    MOST = 500_000             # words remembered, and their characters
    MOST_CHARS = 1 << 23
    TOGETHER = 512

    def __init__(self, path: str):
        import os

        import numpy as np

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path(path))
        named = self.tokenizer.get_vocab()
        self.size = np.zeros(max(named.values()) + 1, np.int64)      # bytes of each id
        for name, i in named.items():
            self.size[i] = len(name.removesuffix("</w>"))      # a character stands for a byte
        self.clear()

    def clear(self):
        import numpy as np

        self.number, self.chars = _Numbers(), 0
        self.at, self.len = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.uses = np.zeros(1024, np.int64)                   # calls that met the word
        self.pool, self.used = np.zeros(4096, np.uint32), 0

    def shrink(self):
        """Keep the words met in two calls or more, those met most first, up to half of
        what may be remembered."""
        import numpy as np

        n, named = len(self.number), list(self.number)
        keep = np.argsort(-self.uses[:n], kind="stable")[:self.MOST // 2]
        keep = keep[self.uses[keep] > 1]
        chars = np.cumsum([len(named[i].encode()) for i in keep.tolist()])
        keep = np.sort(keep[:np.searchsorted(chars, self.MOST_CHARS // 2, side="right")])
        words = [named[i] for i in keep.tolist()]
        at, size = self.at[keep], self.len[keep]
        ends = np.cumsum(size)
        self.pool = self.pool[np.repeat(at - (ends - size), size) + np.arange(int(size.sum()))]
        self.at, self.len, self.used = ends - size, size, len(self.pool)
        self.uses = np.ones(len(keep), np.int64)               # to be met again
        self.number = _Numbers(zip(words, range(len(words))))
        self.chars = sum(len(w.encode()) for w in words)

    def _add(self, words: list):
        """Encode new words, many in one text: they are parted by a space, and ids
        belong to a word as long as their bytes make it up."""
        import numpy as np

        start = len(self.number) - len(words)
        flats, sizes = [np.zeros(0, np.uint32)], []
        for a in range(0, len(words), self.TOGETHER):
            part = words[a:a + self.TOGETHER]
            text = " ".join(part)
            ids = np.array(self.tokenizer.encode_batch_fast(
                [text], add_special_tokens=False)[0].ids, np.uint32)
            upto = np.cumsum(self.size[ids])
            lens = (np.fromiter(map(len, part), np.int64, len(part)) if text.isascii() else
                    np.array([len(w.lower().encode()) for w in part], np.int64))
            ends = np.cumsum(lens)
            cuts = np.searchsorted(upto, ends)
            if len(ids) and upto[-1] == ends[-1] and (upto[cuts] == ends).all():
                sizes.append(np.diff(cuts, prepend=-1))
            else:                       # a character in another form than the word's
                coded = self.tokenizer.encode(text, add_special_tokens=False)
                at = np.fromiter((x for x, _ in coded.offsets), np.int64, len(ids))
                places = np.cumsum([len(w) + 1 for w in part])
                sizes.append(np.bincount(np.searchsorted(places, at, side="right"),
                                         minlength=len(part)))
            flats.append(ids)
            self.chars += int(ends[-1])
        flat, size = np.concatenate(flats), np.concatenate(sizes)
        for name, need in (("at", start + len(words)), ("len", start + len(words)),
                           ("uses", start + len(words)), ("pool", self.used + len(flat))):
            old = getattr(self, name)
            if need > len(old):
                grown = np.zeros(max(need, 2 * len(old)), old.dtype)
                grown[:len(old)] = old
                setattr(self, name, grown)
        self.len[start:start + len(words)] = size
        self.at[start:start + len(words)] = self.used + np.cumsum(size) - size
        self.pool[self.used:self.used + len(flat)] = flat
        self.used += len(flat)

    def encode(self, texts: list) -> list:
        """Arrays of ids of the texts (None counts as empty)."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        if len(self.number) > self.MOST or self.chars > self.MOST_CHARS:
            self.shrink()
        out = [None] * len(texts)
        given = pa.array(texts, pa.large_string()).fill_null("")
        other = pc.match_substring_regex(given, _OTHER)
        for i in np.flatnonzero(other.to_numpy(zero_copy_only=False)).tolist():
            out[i] = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids,
                              np.uint32)
        plain = [i for i, ids in enumerate(out) if ids is None]
        if not plain:
            return out
        if len(plain) < len(texts):
            given = given.take(pa.array(plain, pa.int64()))
        # the vocabulary is of lower case; each different word of the texts is looked up once
        split = pc.ascii_split_whitespace(pc.replace_substring_regex(
            pc.ascii_lower(given), _SIGN, r"\1 \2"))
        known = split.flatten().dictionary_encode()
        named = known.dictionary.to_numpy(zero_copy_only=False).tolist()
        number = np.fromiter(map(self.number.__getitem__, named), np.int64, len(named))
        new, self.number.new = self.number.new, []
        if new:
            self._add(new)
        self.uses[number] += 1
        flat = number[known.indices.to_numpy(zero_copy_only=False)]
        size = self.len[flat]
        ends = np.cumsum(size)
        ids = self.pool[np.repeat(self.at[flat] - (ends - size), size) + np.arange(int(size.sum()))]
        counts = pc.list_value_length(split).to_numpy(zero_copy_only=False)
        cuts = np.concatenate((np.zeros(1, np.int64), ends))[
            np.cumsum(np.concatenate((np.zeros(1, np.int64), counts)))].tolist()
        for i, a, z in zip(plain, cuts[:-1], cuts[1:]):
            out[i] = ids[a:z]
        return out


class _Numbers(dict):
    def __init__(self, known=()):
        super().__init__(known)
        self.new = []

    def __missing__(self, word):
        self[word] = n = len(self)
        self.new.append(word)
        return n


@lru_cache(maxsize=2)
def coder(path: str) -> WordCoder:
    return WordCoder(path)


def together(sizes: list, most: int = TOGETHER_CHARS):
    """Ranges of rows of about ``most`` together; a larger row is alone."""
    a = size = 0
    for k, n in enumerate(sizes):
        n = (n or 0) + 64
        if size and size + n > most:
            yield a, k
            a = k
            size = 0
        size += n
    if a < len(sizes):
        yield a, len(sizes)


def even(sizes: list, least: int = FLUSH_IDS):
    """Ranges of rows of about equal totals, between ``least`` and twice as many."""
    total = sum(sizes)
    each = -(-total // max(1, total // least))
    return together(sizes, each + 2 * SEGMENT_IDS + 64 * len(sizes))


def cut(ids, size: int = BLOCK_IDS) -> list:
    return [ids[a:a + size] for a in range(0, len(ids), size)]


def write(df: DataFrame, out: str, tokenizer: str, id_col: str = "doc_id",
          text_col: str = "text", end: int = END) -> None:
    """Write the token files of ``df`` to the folder ``out``."""
    spark = df.sparkSession
    ship_package(spark)
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    ordered = (src.repartitionByRange(partitions(spark), "id")
               .sortWithinPartitions("id", F.xxhash64("t")))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        from trackstream.llm import range_coder, token_file as T

        part = TaskContext.get().partitionId()
        words = T.coder(tokenizer)
        last = np.array([end], np.uint32)
        ready, docs, pieces, size, seg, held = [], [], [], 0, 0, 0

        def flush(ready, seg):
            blocks = [T.cut(x) for _, x in ready]
            coded = iter(range_coder.encode_blocks([b for x in blocks for b in x]))
            rows = [[next(coded) for _ in x] for x in blocks]
            n = len(ready)
            yield pa.RecordBatch.from_arrays([
                pa.array([part] * n, pa.int32()), pa.array(range(seg - n, seg), pa.int32()),
                pa.array([len(x) for _, x in ready], pa.int64()),
                pa.array([[d for d, _ in k] for k, _ in ready], pa.list_(pa.int64())),
                pa.array([[m for _, m in k] for k, _ in ready], pa.list_(pa.int64())),
                pa.array(rows, pa.list_(pa.binary()))],
                ["part", "seg", "n_ids", "doc_ids", "n_tokens", "blocks"])

        for whole in batches:
            for a, z in T.together(pc.utf8_length(whole.column(1)).to_pylist()):
                b = whole.slice(a, z - a)
                for doc, ids in zip(b.column(0).to_pylist(), words.encode(b.column(1).to_pylist())):
                    docs.append((doc, len(ids) + 1))
                    pieces += [ids, last]
                    size += len(ids) + 1
                    if size >= T.SEGMENT_IDS:
                        ready.append((docs, np.concatenate(pieces)))
                        held += size
                        docs, pieces, size, seg = [], [], 0, seg + 1
                        if held >= 2 * T.FLUSH_IDS:
                            _, half = next(T.together([len(x) for _, x in ready], T.FLUSH_IDS))
                            yield from flush(ready[:half], seg - len(ready) + half)
                            ready = ready[half:]
                            held = sum(len(x) for _, x in ready)
        if docs:
            ready.append((docs, np.concatenate(pieces)))
            seg += 1
        if ready:
            yield from flush(ready, seg)

    ordered.mapInArrow(run, SCHEMA).write.parquet(out)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, part, seg, skip, ids) of the documents in token files; every block's
    checksum is verified."""
    return _decoded(spark, path, "ids array<int>")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the files.

    ``start`` counts the ids of all documents before it: sums of segments first
    (their sizes alone are read), then the place within the segment."""
    docs = _decoded(spark, path, "n_tokens long, ids_crc32 long")
    sizes = spark.read.schema(SCHEMA).parquet(path).select("part", "seg", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))          # one row a task
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("p"))
    inner = W.partitionBy("part").orderBy("seg").rowsBetween(W.unboundedPreceding, -1)
    at = (sizes.select("part", "seg", F.coalesce(F.sum("n_ids").over(inner), F.lit(0)).alias("s"))
          .join(parts, "part").select("part", "seg", (F.col("p") + F.col("s")).alias("before")))
    return docs.join(at, ["part", "seg"]).select(
        "doc_id", (F.col("before") + F.col("skip")).alias("start"), "n_tokens", "ids_crc32")


def _decoded(spark: SparkSession, path: str, columns: str) -> DataFrame:
    ship_package(spark)
    crc = "crc32" in columns
    rows = spark.read.schema(SCHEMA).parquet(path)

    def run(batches):
        import zlib

        import numpy as np
        import pyarrow as pa

        from trackstream.llm import range_coder, token_file as T

        for whole in batches:
            sizes = whole.column(2).to_pylist()
            for a, z in T.even(sizes):
                b = whole.slice(a, z - a)
                part, seg, _, doc_ids, n_tokens, blocks = (c.to_pylist() for c in b.columns)
                ids = iter(range_coder.decode_blocks([x for row in blocks for x in row]))
                out = [[], [], [], [], [], []]
                for p, s, docs, sizes, row in zip(part, seg, doc_ids, n_tokens, blocks):
                    own = np.concatenate([next(ids) for _ in row])
                    at = 0
                    for d, n in zip(docs, sizes):
                        mine = own[at:at + n]
                        if len(mine) != n:
                            raise range_coder.Damaged("a segment is shorter than its documents")
                        more = ((n, zlib.crc32(mine.astype("<u4").tobytes())) if crc
                                else (mine.astype(np.int32),))
                        for col, value in zip(out, (d, p, s, at, *more)):
                            col.append(value)
                        at += n
                types = [pa.int64(), pa.int32(), pa.int32(), pa.int64()] + (
                    [pa.int64(), pa.int64()] if crc else [pa.list_(pa.int32())])
                names = ["doc_id", "part", "seg", "skip"] + (
                    ["n_tokens", "ids_crc32"] if crc else ["ids"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, types)], names)

    return rows.mapInArrow(run, f"doc_id long, part int, seg int, skip long, {columns}")
