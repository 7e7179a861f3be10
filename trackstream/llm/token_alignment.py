"""Cross-tokenizer alignment by products of token-byte incidence matrices.

Two tokenizers cut the same bytes.  Matrix A has a row for each token of the first and
a column for each byte, with a one where the token covers the byte; B likewise.  The
row products of A·Bᵀ (Gustavson: add up the rows of Bᵀ that a row of A names) hold, for
each pair of tokens, the number of bytes they share: its entries are the *overlap
links*.  Byte offsets where both tokenizers end a token cut the tokens into groups; the
product of the two token-group incidence matrices holds the *shared-group links*.  The
matrices are compressed sparse rows built by hand from numpy arrays.

Both tokenizers begin a new token at a space that follows a non-blank, and what lies
between two such places is cut in the same way wherever it stands.  So a text is split
there, and every different segment is encoded and multiplied once a worker, many in one
product; a document adds up its segments.

Every text is read once.  Its different id pairs are written beside its numbers; link
counts are corpus-wide document counts of them, which tasks add up before the shuffle.
The counts are looked up in a broadcast table that never exceeds ``MOST_PAIRS`` rows: a
longer one is dealt into slices by hash, the written pairs are read once a slice, and
each pass adds its slice's part to the sums that the last one wrote.

Edge cases: a null or empty text, or one whose tokens do not spell out its bytes, has no
tokens (zeros and an empty digest); a text of any length is aligned whole; repeated rows
are documents of their own and count again; ties for an id's highest count all are best;
an empty table gives an empty result.  Only the id and text columns are read, so clashing
names do no harm.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackstream.llm.common import materialize, ship_package, tokenizer_path

BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
#: Rows of one broadcast slice of the pair table: 4 + 8 + 1 bytes each.
MOST_PAIRS = 4_000_000
#: Bytes of segments that a worker remembers, and bytes of texts it handles together.
MOST_BYTES = 6 << 20
TOGETHER = 4 << 20


# --- compressed sparse rows ---------------------------------------------------

class Rows(NamedTuple):
    """A sparse matrix: row r has the columns ``cols[start[r]:start[r + 1]]``."""

    start: object
    cols: object


def incidence(lengths) -> Rows:
    """Tokens × bytes: consecutive tokens of these lengths cover consecutive bytes."""
    import numpy as np

    start = np.concatenate((np.zeros(1, np.int64), np.cumsum(lengths, dtype=np.int64)))
    return Rows(start, np.arange(start[-1]))


def transposed(m: Rows, n_cols: int) -> Rows:
    import numpy as np

    row = np.repeat(np.arange(len(m.start) - 1), np.diff(m.start))
    order = np.argsort(m.cols, kind="stable")
    start = np.concatenate((np.zeros(1, np.int64), np.cumsum(np.bincount(m.cols, minlength=n_cols))))
    return Rows(start, row[order])


def product(a: Rows, b: Rows, width: int):
    """Entries of a·b as (row, column, value), by row products; ``width`` columns."""
    import numpy as np

    row = np.repeat(np.arange(len(a.start) - 1), np.diff(a.start))
    size = (b.start[1:] - b.start[:-1])[a.cols]
    ends = np.cumsum(size)
    cols = b.cols[np.repeat(b.start[a.cols] - (ends - size), size) + np.arange(int(size.sum()))]
    key = np.repeat(row, size) * width + cols
    if len(key) > 1 and not (key[1:] >= key[:-1]).all():
        key = np.sort(key)
    first = np.flatnonzero(np.concatenate((np.ones(min(len(key), 1), bool), key[1:] != key[:-1])))
    value = np.diff(np.concatenate((first, [len(key)])))
    return key[first] // width, key[first] % width, value


def group_of(ends_a, ends_b):
    """Group numbers of both sides' tokens, given the byte offsets of their ends."""
    import numpy as np

    cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
    return np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b), cuts


def overlap_links(len_a, len_b):
    """(i, j, shared bytes) of the tokens that overlap."""
    a, b = incidence(len_a), incidence(len_b)
    return product(a, transposed(b, len(a.cols)), max(1, len(len_b)))


def group_links(group_a, group_b):
    """(i, j) of the tokens in one group: the product of the group incidences."""
    import numpy as np

    groups = int(max(group_a.max(initial=-1), group_b.max(initial=-1))) + 1
    a = Rows(np.arange(len(group_a) + 1), group_a)
    b = transposed(Rows(np.arange(len(group_b) + 1), group_b), groups)
    i, j, _ = product(a, b, max(1, len(group_b)))
    return i, j


# --- segments -----------------------------------------------------------------

class Aligner:
    """Aligns texts; remembers the segments it has met."""

    def __init__(self, path_a: str, path_b: str, spelt: bool = False):
        import os

        import numpy as np

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(tokenizer_path(path_a))
        self.a.encode_special_tokens = True       # their strings are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(path_b))
        n_a, n_b = self.a.get_vocab_size(), self.b.get_piece_size()
        plain = {c: x for x, c in enumerate(_byte_characters())}
        self.bytes_a = [bytes(plain[c] for c in self.a.id_to_token(i)) if i is not None else b""
                        for i in range(n_a)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in ((i, self.b.id_to_piece(i)) for i in range(n_b))]
        self.len_a = np.fromiter(map(len, self.bytes_a), np.int64, n_a)
        self.len_b = np.fromiter(map(len, self.bytes_b), np.int64, n_b)
        self.spelt = spelt                        # whether the groups are written out
        self.blank = self.b.piece_to_id("▁")
        if any("▁" in p.lstrip("▁") for p in map(self.b.id_to_piece, range(n_b))):
            raise ValueError("pieces that hold a blank inside cannot be cut at blanks")
        self.clear()

    def clear(self):
        self.number: dict = {}
        self.held = 0
        self.parts: list = []      # arrays of stats, agreement and links, by rising number
        self.text: list = []       # the groups, written out, if asked for
        self.table = None

    def _add(self, keys: list):
        """Encode new segments: those that end in a non-blank stand behind each other in
        one text, the others (ends of texts) are encoded alone."""
        order = [k for k in keys if k and not k[-1].isspace()]
        groups = [order[a:a + 4096] for a in range(0, len(order), 4096)]
        groups += [[k] for k in keys if not k or k[-1].isspace()]
        for part in groups:
            for stats, ok, pairs, text in self._align(part):
                self.parts.append((stats, ok, pairs))
                self.text += text
            self.number.update(zip(part, range(len(self.number), len(self.number) + len(part))))
            self.held += sum(map(len, part)) + len(part)
        self.table = None

    def _align(self, keys: list) -> list:
        """(stats, agreement, links, groups) of segments that stand behind each other."""
        import numpy as np

        together = " " + " ".join(keys)
        raw = together.encode("utf-8", "replace")
        a = np.array(self.a.encode(together, add_special_tokens=False).ids, np.int64)
        b = np.array(self.b.encode(together[1:]) if len(together) > 1 else [self.blank], np.int64)
        if (b"".join(map(self.bytes_a.__getitem__, a.tolist())) != raw
                or b"".join(map(self.bytes_b.__getitem__, b.tolist())) != raw):
            if len(keys) == 1:
                return [(np.zeros((1, 5), np.int64), np.zeros(1, bool), np.zeros(0, np.uint32),
                         [""] * self.spelt)]
            half = len(keys) // 2                  # find the segment at fault
            return self._align(keys[:half]) + self._align(keys[half:])
        len_a, len_b = self.len_a[a], self.len_b[b]
        end_a, end_b = np.cumsum(len_a), np.cumsum(len_b)
        i, j, _ = overlap_links(len_a, len_b)
        group_a, group_b, cuts = group_of(end_a, end_b)
        in_a, in_b = np.bincount(group_a), np.bincount(group_b)
        blanks = np.flatnonzero(np.frombuffer(raw, np.uint8) == 32)
        if len(keys) == len(blanks):
            ends = np.append(blanks[1:], len(raw))
        else:                                      # blanks inside a segment
            ends = np.cumsum([len(k.encode("utf-8", "replace")) + 1 for k in keys])
        upto = [np.searchsorted(x, ends, "right") for x in (end_a, end_b, cuts)]
        upto.append(np.searchsorted(i, upto[0], "left"))
        shared = np.concatenate((np.zeros(1, np.int64), np.cumsum(in_a * in_b)))
        upto.append(shared[upto[2]])
        stats = np.diff(np.stack(upto, axis=1), axis=0, prepend=0)
        text = self._spell(a, b, group_a, group_b, upto[0] + upto[1]) if self.spelt else []
        return [(stats, np.ones(len(keys), bool), (a[i] << 16 | b[j]).astype(np.uint32), text)]

    def _spell(self, a, b, group_a, group_b, ends) -> list:
        """The groups of each segment as ``a1,a2|b1;a3|b2``; ``ends`` are the places in
        the tokens of both sides where segments end."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        side = np.repeat([0, 1], [len(a), len(b)])
        group = np.concatenate((group_a, group_b))
        order = np.argsort(group * 2 + side, kind="stable")
        side, group = side[order], group[order]
        last = np.append((side[1:] != side[:-1]) | (group[1:] != group[:-1]), True)
        mark = np.where(last, np.where(side == 0, 1, 2), 0)
        mark[ends - 1] = 3
        words = pc.binary_join_element_wise(
            pa.array(np.concatenate((a, b))[order]).cast(pa.string()),
            pa.array([",", "|", ";", ""]).take(pa.array(mark)), "")
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), words)
        return pc.binary_join(lists, "").to_pylist()

    def segments(self, texts: list):
        """(segment numbers of all texts in a row, how many each text has)."""
        import re

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        if self.held > MOST_BYTES:
            self.clear()
        parts: list = [None] * len(texts)
        plain = []
        for k, t in enumerate(texts):
            if not t:
                parts[k] = []
            elif t[0] == " " or re.search(r"\s ", t):
                parts[k] = re.split(r"(?<=\S) ", " " + t)
                parts[k][0] = parts[k][0][1:]
            else:
                plain.append(k)
        split = pc.split_pattern(pa.array([texts[k] for k in plain], pa.large_string()), " ")
        known = split.flatten().dictionary_encode()
        words = known.dictionary.to_pylist()
        new = dict.fromkeys(w for w in words if w not in self.number)
        new.update(dict.fromkeys(w for p in parts if p for w in p if w not in self.number))
        if new:
            self._add(list(new))
        number = self.number
        flat = np.fromiter((number[w] for w in words), np.int64, len(words))[
            known.indices.to_numpy(zero_copy_only=False).astype(np.int64)]
        sizes = np.zeros(len(texts), np.int64)
        sizes[plain] = pc.list_value_length(split).to_numpy(zero_copy_only=False)
        if len(plain) == len(texts):
            return flat, sizes
        out, at = [], 0
        for k, p in enumerate(parts):
            if p is None:
                out.append(flat[at:at + sizes[k]])
                at += sizes[k]
            else:
                out.append(np.fromiter((number[w] for w in p), np.int64, len(p)))
                sizes[k] = len(p)
        return np.concatenate(out) if out else flat, sizes

    def links(self):
        """The segments' stats (n × 5: tokens of both sides, groups, links, shared-group
        links), whether their bytes agree, and all their links in a row with the places
        where each segment's begin."""
        import numpy as np

        if self.table is None or len(self.parts) > 1:
            empty = np.zeros((0, 5), np.int64), np.zeros(0, bool), np.zeros(0, np.uint32)
            joined = tuple(np.concatenate(x) for x in zip(empty, *self.parts))
            self.parts = [joined]
            start = np.concatenate((np.zeros(1, np.int64), np.cumsum(joined[0][:, 3])))
            self.table = *joined, start
        return self.table


def _byte_characters() -> list:
    """The character that stands for each byte in a byte-level vocabulary: printable
    bytes for themselves, the others in order from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    more = iter(range(0x100, 0x200))
    return [chr(x) if x in shown else chr(next(more)) for x in range(256)]


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str, spelt: bool = False) -> Aligner:
    return Aligner(path_a, path_b, spelt)


def _per_text(flat, sizes, values):
    """Sums of ``values[segment]`` over each text's segments."""
    import numpy as np

    run = np.concatenate((np.zeros((1, *values.shape[1:]), values.dtype),
                          np.cumsum(values[flat], axis=0)))
    ends = np.cumsum(sizes)
    return run[ends] - run[ends - sizes]


def _good(flat, sizes, ok):
    """Which texts have tokens: some segments, all of whose bytes agree."""
    return (sizes > 0) & (_per_text(flat, sizes, (~ok).astype("int64")) == 0)


def pieces(texts: list, most: int = TOGETHER):
    """Ranges of ``texts`` of about ``most`` characters together."""
    a = size = 0
    for k, t in enumerate(texts):
        size += len(t or "") + 64
        if size >= most:
            yield a, k + 1
            a, size = k + 1, 0
    if a < len(texts):
        yield a, len(texts)


# --- over a table -------------------------------------------------------------

OWN = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_group_links long, "
       "groups_sha256 string")
TABLE = OWN + ", pairs binary, times binary"
COLUMNS = OWN + ", n_best long, count_sum long"


def _names(schema: str) -> list:
    return [c.split()[0] for c in schema.split(", ")]


def aligned(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            path_a: str = BYTE_BPE, path_b: str = PIECES) -> DataFrame:
    """One row a document: numbers of tokens, groups and links, the groups' digest, and
    its different id pairs (``pairs``, a << 16 | b as unsigned 32-bit numbers) with how
    often each is linked (``times``)."""
    ship_package(df.sparkSession)

    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        from trackstream.llm import token_alignment as T

        align = T.aligner(path_a, path_b, True)
        for whole in batches:
            texts = whole.column(1).to_pylist()
            for lo, hi in T.pieces(texts):
                flat, sizes = align.segments(texts[lo:hi])
                stats, ok, links, start = align.links()
                good = T._good(flat, sizes, ok)
                base = T._per_text(flat, sizes, stats)
                base[~good] = 0
                sha, z = [], 0
                for fine, s in zip(good.tolist(), sizes.tolist()):
                    sha.append(hashlib.sha256(";".join(
                        map(align.text.__getitem__, flat[z:z + s].tolist())).encode()).hexdigest()
                        if fine else "")
                    z += s
                # each segment of a document once, then each of its pairs once
                n = max(1, len(ok))
                doc = np.repeat(np.arange(len(sizes)), sizes)
                once, often = np.unique((doc * n + flat)[np.repeat(good, sizes)], return_counts=True)
                doc, seg = once // n, once % n
                size = stats[seg, 3]
                ends = np.cumsum(size)
                pair = links[np.repeat(start[seg] - (ends - size), size) + np.arange(int(size.sum()))]
                key = np.repeat(doc, size) << 32 | pair.astype(np.int64)
                order = np.argsort(key)
                key, weight = key[order], np.repeat(often, size)[order]
                first = np.flatnonzero(np.append(np.ones(min(len(key), 1), bool), key[1:] != key[:-1]))
                times = np.add.reduceat(weight, first) if len(key) else weight
                key = key[first]
                cuts = np.searchsorted(key >> 32, np.arange(len(sizes) + 1)).tolist()
                pair, times = (key & 0xFFFFFFFF).astype("<u4"), times.astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [whole.column(0).slice(lo, hi - lo), *(pa.array(base[:, k].copy()) for k in range(5)),
                     pa.array(sha, pa.string()),
                     *(pa.array([x[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:])], pa.binary())
                       for x in (pair, times))], T._names(T.TABLE))

    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, TABLE)


def pair_counts(table: DataFrame) -> DataFrame:
    """(pair, n, best) of aligned documents: ``n`` is the number of documents that hold
    the pair linked, ``best`` whether no pair of the same a has more."""
    ship_package(table.sparkSession)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def out(x):
            return pa.RecordBatch.from_arrays([pa.array(x[0]), pa.array(x[1])], ["pair", "n"])

        held = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in batches:
            met = np.frombuffer(b"".join(b.column(0).to_pylist()), "<u4").astype(np.int64)
            new = np.unique(met, return_counts=True)
            keys, at = np.unique(np.concatenate((held[0], new[0])), return_inverse=True)
            n = np.zeros(len(keys), np.int64)
            np.add.at(n, at, np.concatenate((held[1], new[1])))
            held = keys, n
            if len(keys) > 500_000:
                yield out(held)
                held = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(held[0]):
            yield out(held)

    sums = (table.select("pairs").mapInArrow(run, "pair long, n long")
            .groupBy("pair").agg(F.sum("n").alias("n")))
    sums = materialize(sums, "pairs")
    top = sums.groupBy(F.expr("shiftright(pair, 16)").alias("a")).agg(F.max("n").alias("top"))
    return sums.join(top, F.expr("shiftright(pair, 16)") == F.col("a")).select(
        "pair", "n", (F.col("n") == F.col("top")).alias("best"))


def _with_slice(df: DataFrame, counts: DataFrame) -> DataFrame:
    """``df`` with the counts of one bounded slice of the pair table added to its sums."""
    import numpy as np

    rows = counts.toArrow()
    order = np.argsort(rows["pair"].to_numpy())
    shared = df.sparkSession.sparkContext.broadcast(
        (rows["pair"].to_numpy()[order].astype(np.uint32), rows["n"].to_numpy()[order],
         rows["best"].to_numpy()[order]))
    names = df.columns

    def run(batches):
        import pyarrow as pa

        pair, n, best = shared.value
        for b in batches:
            met, times = (b.column(names.index(c)).to_pylist() for c in ("pairs", "times"))
            ends = np.cumsum([len(x) // 4 for x in met])
            at = np.frombuffer(b"".join(met), "<u4")
            times = np.frombuffer(b"".join(times), "<u4").astype(np.int64)
            sums = []
            where = np.minimum(np.searchsorted(pair, at), max(0, len(pair) - 1))
            hit = pair[where] == at if len(pair) else np.zeros(len(at), bool)
            for name, of in (("n_best", best), ("count_sum", n)):
                value = np.where(hit, of[where], 0) * times if len(pair) else times * 0
                run_ = np.concatenate((np.zeros(1, np.int64), np.cumsum(value)))
                before = np.concatenate((np.zeros(1, np.int64), ends))[:-1]
                sums.append(pa.array(run_[ends] - run_[before]
                                     + b.column(names.index(name)).to_numpy()))
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], *sums], names)

    return df.mapInArrow(run, df.schema)


def align_table(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                path_a: str = BYTE_BPE, path_b: str = PIECES,
                most_pairs: int = MOST_PAIRS) -> DataFrame:
    """One row a document: numbers of tokens, groups and links, the groups' digest, and
    what the corpus-wide counts say of its links."""
    table = materialize(aligned(df, id_col, text_col, path_a, path_b), "aligned")
    counts = materialize(pair_counts(table), "pair-counts")
    total = counts.count()
    # hash slices differ a little in size; a quarter is left free for that
    slices = 1 if total <= most_pairs else total * 4 // (most_pairs * 3) + 1
    none = F.lit(0).cast("long")
    now = table.withColumns({"n_best": none, "count_sum": none})
    for k in range(slices):
        now = _with_slice(now, counts if slices == 1 else counts.filter(
            F.pmod(F.xxhash64("pair"), F.lit(slices)) == k))
        if k + 1 < slices:
            now = materialize(now, "summed")
    return now.drop("pairs", "times")
