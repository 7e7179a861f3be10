"""SentencePiece encoding by forward filtering and backward sampling.

All ways to cut a text into pieces of the vocabulary form a lattice.  Forward
filtering sums the weight of all paths to each place; backward sampling walks from
the end and draws each piece with its exact share, so a whole segmentation is
drawn from the distribution P(pieces) ~ product of piece weights.  The draws come
from a counter hashed with the row key, so a row always gets the same cut.

Apart from runs of the blank mark, no piece holds a mark behind its first place
(checked when the vocabulary is read), so every path meets before each
word and the lattice falls apart into words: forward filtering is done once for
each different word of a batch, and the walk for all words at once in numpy.

The vocabulary stores ranks of merges instead of log probabilities; a piece of
rank r weighs (r + 2) ** -alpha, Zipf's law of rank.  Larger ``alpha`` sharpens.

Decoding is lossless for every text: characters outside the vocabulary, and a
blank mark that the text itself holds, are spelled in byte pieces; texts are not
normalised.  As in the vocabulary's own encoder a blank is put before the text,
and decoding takes it away.

Edge cases: a null text encodes to null; an empty text to no ids; a null key
seeds like the empty key, so equal texts with null keys are cut alike, as are
repeated rows; a text of any length is cut whole, word by word (one without blanks is one
word, walked a character a step); an empty table gives an empty result; clashing result columns of
the input are replaced.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackstream.llm.common import ship_package, tokenizer_path

MARK = "▁"
OWN_MARK = "\udfff"
VOCABULARY = "piece_bpe_32k.model"
ALPHA = 1.0
SEED = 17
BATCH_CHARS = 1 << 21
RESULT = ["ids", "n_pieces", "decoded"]
BASE = 0x100000001B3
_WORD = re.compile(f"{MARK}*[^{MARK}]*")


def _mix(x):
    """A 64-bit finaliser over an array of unsigned numbers."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Vocabulary:
    """Pieces, their log weights, and a table to look up substrings by hash."""

    def __init__(self, path: str, alpha: float = ALPHA):
        import numpy as np
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(path))
        n = m.get_piece_size()
        self.bytes_of, self.byte_id, pieces = [b""] * n, [0] * 256, {}
        for i in range(n):
            piece = m.id_to_piece(i)
            if m.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])
            elif not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i)):
                if MARK in piece.lstrip(MARK):
                    raise ValueError(f"piece {piece!r} spans words")
                pieces[piece] = i
                self.bytes_of[i] = piece.replace(MARK, " ").encode()
        self.longest = max(map(len, pieces))
        self.piece_len = np.array([len(x) for x in self.bytes_of], np.int64)
        self.piece_at = np.cumsum(self.piece_len) - self.piece_len
        self.pool = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        # every prefix of a piece is an entry: a walk stops where no piece goes on
        entries = sorted({p[:k] for p in pieces for k in range(1, len(p) + 1)})
        hashes = np.array([self._hash_one(p) for p in entries], np.uint64)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two prefixes of pieces have one hash")
        self.ids = np.array([pieces.get(p, -1) for p in entries], np.int32)[order]
        rank = np.array([max(-m.get_score(pieces[p]), 0.0) if p in pieces else 0.0
                         for p in entries])
        self.log_w = -alpha * np.log(rank + 2.0)[order]
        self.log_unknown = float(self.log_w.min()) - 10.0
        # a direct table over the entries; those that meet in a slot are searched
        slot = self._slot(self.hashes)
        self.table = np.zeros(1 << 21, np.int32)
        self.table[slot] = np.arange(len(slot))
        self.shared = np.bincount(slot, minlength=1 << 21) > 1

    @staticmethod
    def _slot(h):
        import numpy as np

        return (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(43)

    @staticmethod
    def _hash_one(piece: str) -> int:
        h = 0
        for ch in piece:
            h = (h * BASE + ord(ch) + 1) % (1 << 64)
        return h

    def find(self, h):
        """Index of the entry with each hash, -1 where there is none."""
        import numpy as np

        slot = self._slot(h)
        at = self.table[slot]
        out = np.where(self.hashes[at] == h, at, -1)
        again = np.flatnonzero((out < 0) & self.shared[slot])
        if len(again):
            k = np.minimum(np.searchsorted(self.hashes, h[again]), len(self.hashes) - 1)
            out[again] = np.where(self.hashes[k] == h[again], k, -1)
        return out


@lru_cache(maxsize=4)
def vocabulary(path: str = VOCABULARY, alpha: float = ALPHA) -> Vocabulary:
    return Vocabulary(path, alpha)


class Lattice:
    """The lattices of a list of different words, laid out flat.

    Node ``first[w] + j`` stands before character j of word w.  Arcs are sorted by
    the node they end in; ``share`` holds the running share among that node's arcs,
    so the first arc whose share exceeds a random number is the one drawn."""

    def __init__(self, words: list[str], v: Vocabulary):
        import numpy as np

        lens = np.fromiter(map(len, words), np.int64, len(words))
        self.first = np.r_[0, np.cumsum(lens + 1)][:-1]
        self.last = self.first + lens
        n_nodes = int(self.last[-1]) + 1 if len(words) else 0
        # a closing 0 after each word keeps node numbers and characters in step
        chars = np.frombuffer("\0".join([*words, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        chars = chars.astype(np.uint64)
        place = np.arange(n_nodes) - np.repeat(self.first, lens + 1)
        left = np.repeat(lens, lens + 1) - place          # characters from here on
        head, tail, piece, weight = [], [], [], []
        h = np.zeros(n_nodes, np.uint64)
        alive = np.flatnonzero(left >= 1)
        for k in range(1, v.longest + 1):
            alive = alive[left[alive] >= k]
            if not len(alive):
                break
            h[alive] = h[alive] * np.uint64(BASE) + chars[alive + k - 1] + np.uint64(1)
            at = v.find(h[alive])
            there = at >= 0
            if k == 1:
                unknown = alive[~there | (v.ids[at] < 0)]
                head.append(unknown)
                tail.append(unknown + 1)
                piece.append(-1 - chars[unknown].astype(np.int64))   # spelled in bytes
                weight.append(np.full(len(unknown), v.log_unknown))
            alive, at = alive[there], at[there]
            hit = v.ids[at] >= 0
            head.append(alive[hit])
            tail.append(alive[hit] + k)
            piece.append(v.ids[at[hit]])
            weight.append(v.log_w[at[hit]])
        head, tail = np.concatenate(head), np.concatenate(tail)
        piece, weight = np.concatenate(piece).astype(np.int64), np.concatenate(weight)
        # by end, then by length: one number each, no two alike
        order = np.argsort(tail * (v.longest + 1) + (tail - head))
        head, tail, piece, weight = head[order], tail[order], piece[order], weight[order]
        begin = np.searchsorted(tail, np.arange(n_nodes + 1))
        # forward filtering, all words in step: nodes by their place in the word
        alpha = np.full(n_nodes, -np.inf)
        alpha[self.first] = 0.0
        share = np.zeros(len(tail))
        by_len = np.argsort(-lens, kind="stable")
        longer = np.cumsum(np.bincount(lens)[::-1])[::-1] if len(words) else [0]
        for j in range(1, len(longer)):
            nodes = self.first[by_len[:longer[j]]] + j     # of words with j characters
            count = begin[nodes + 1] - begin[nodes]
            starts = np.cumsum(count) - count
            arcs = np.repeat(begin[nodes] - starts, count) + np.arange(int(count.sum()))
            s = alpha[head[arcs]] + weight[arcs]
            top = np.maximum.reduceat(s, starts)
            e = np.exp(s - np.repeat(top, count))
            tot = np.add.reduceat(e, starts)
            alpha[nodes] = top + np.log(tot)
            for r in range(1, int(count.max())):           # running sums, node by node, so
                more = starts[count > r] + r               # that neighbours change no bit
                e[more] += e[more - 1]
            share[arcs] = e / np.repeat(tot, count)
        ends = begin[1:][begin[1:] > begin[:-1]] - 1
        share[ends] = 1.0                                  # no draw falls behind the last
        self.head, self.piece, self.begin, self.share = head, piece, begin, share


class Numbers(dict):
    """Word -> its number in order of first use; ``new`` lists the latest."""

    def __init__(self):
        super().__init__()
        self.new = []

    def __missing__(self, word):
        self[word] = n = len(self)
        self.new.append(word)
        return n


class Lattices:
    """The lattices of all words met so far; forgotten when there are too many."""

    MOST = 400_000

    def __init__(self, v: Vocabulary):
        self.v = v
        self.clear()

    def clear(self):
        import numpy as np

        self.number = Numbers()
        self.size = {"word": 0, "node": 0, "arc": 0}
        self.first, self.last, self.begin = (np.zeros(1024, np.int32) for _ in range(3))
        self.head, self.piece = (np.zeros(1024, np.int32) for _ in range(2))
        self.share = np.zeros(1024, np.float32)

    def _append(self, name: str, kind: str, values):
        import numpy as np

        old, n = getattr(self, name), self.size[kind]
        if n + len(values) > len(old):
            grown = np.zeros(max(2 * len(old), n + len(values)), old.dtype)
            grown[:n] = old[:n]
            setattr(self, name, grown)
            old = grown
        old[n:n + len(values)] = values

    def numbers_of(self, texts_words: list) -> list:
        """The numbers of the words of each text; lattices are built for new ones."""
        import numpy as np

        if len(self.number) > self.MOST:
            self.clear()
        out = [np.fromiter(map(self.number.__getitem__, w), np.int64, len(w)) for w in texts_words]
        new, self.number.new = self.number.new, []
        for a in range(0, len(new), 50_000):
            lat = Lattice(new[a:a + 50_000], self.v)
            nodes, arcs = self.size["node"], self.size["arc"]
            for name, kind, values in (
                    ("first", "word", lat.first + nodes), ("last", "word", lat.last + nodes),
                    ("begin", "node", lat.begin[:-1] + arcs), ("head", "arc", lat.head + nodes),
                    ("piece", "arc", lat.piece), ("share", "arc", lat.share)):
                self._append(name, kind, values)
            for kind, n in (("word", len(lat.first)), ("node", len(lat.begin) - 1),
                            ("arc", len(lat.head))):
                self.size[kind] += n
        return out

    def walk(self, which, keys):
        """Draw one path for each word occurrence; (occurrence, piece) in order."""
        import numpy as np

        node, stop = self.last[which].astype(np.int64), self.first[which]
        at = np.arange(len(which))
        occ, got = [], []
        turn = 0
        while len(at):
            r = _mix(keys[at] + np.uint64((turn * 0x9E3779B97F4A7C15) % (1 << 64)))
            u = (r >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
            arc = self.begin[node[at]].astype(np.int64)
            more = np.flatnonzero(self.share[arc] <= u)
            while len(more):
                arc[more] += 1
                more = more[self.share[arc[more]] <= u[more]]
            occ.append(at)
            got.append(self.piece[arc])
            node[at] = self.head[arc]
            at = at[node[at] > stop[at]]
            turn += 1
        if not occ:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        occ, got = np.concatenate(occ)[::-1], np.concatenate(got)[::-1]
        order = np.argsort(occ, kind="stable")             # walks ran from the end
        return occ[order], got[order]


def marked(text: str) -> str:
    """The text with blanks as marks and one before it.  A mark of its own becomes
    a lone surrogate, which no text can hold, and is spelled in bytes."""
    return MARK + text.replace(MARK, OWN_MARK).replace(" ", MARK)


def encode_batch(texts: list, keys: list[int], v: Vocabulary, seed: int = SEED,
                 lattices: Lattices | None = None) -> list:
    """Ids (int32 arrays) of each text; None for None."""
    import numpy as np

    out = [None] * len(texts)
    cache = lattices or Lattices(v)
    which, sizes, rows = [], [], []
    for i, t in enumerate(texts):
        if t is None:
            continue
        if not t:
            out[i] = np.zeros(0, np.int32)
            continue
        parts = _WORD.findall(marked(t))[:-1]              # the last match is empty
        which.append(parts)
        sizes.append(len(parts))
        rows.append(i)
    if not rows:
        return out
    which = np.concatenate(cache.numbers_of(which))
    sizes = np.array(sizes)
    key = np.array([keys[i] for i in rows], np.uint64) + np.uint64(seed)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    own = _mix(np.repeat(_mix(key), sizes) + nth.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    occ, ids = cache.walk(which, own)
    unknown = np.flatnonzero(ids < 0)
    if len(unknown):
        spelled = []
        for c in (-1 - ids[unknown]).tolist():
            raw = (MARK if c == ord(OWN_MARK) else chr(c)).encode("utf-8", "surrogatepass")
            spelled.append([v.byte_id[b] for b in raw])
        count = np.ones(len(ids), np.int64)
        count[unknown] = [len(s) for s in spelled]
        occ, wide = np.repeat(occ, count), np.repeat(ids, count)
        first = np.cumsum(count) - count
        for at, s in zip(first[unknown].tolist(), spelled):
            wide[at:at + len(s)] = s
        ids = wide
    of_row = np.repeat(np.arange(len(rows)), sizes)[occ]
    cut = np.searchsorted(of_row, np.arange(len(rows) + 1))
    ids = ids.astype(np.int32)
    for k, i in enumerate(rows):
        out[i] = ids[cut[k]:cut[k + 1]]
    return out


def decode_batch(ids: list, v: Vocabulary) -> list:
    """The texts that were encoded."""
    import numpy as np

    known = [x for x in ids if x is not None]
    flat = np.concatenate(known or [np.zeros(0, np.int32)])
    size = v.piece_len[flat]
    starts = np.cumsum(size) - size
    raw = v.pool[np.repeat(v.piece_at[flat] - starts, size) + np.arange(int(size.sum()))].tobytes()
    ends = np.r_[0, np.cumsum(size)][np.cumsum([0, *map(len, known)])].tolist()
    texts = iter([raw[a + 1:z].decode("utf-8", "surrogatepass")
                  for a, z in zip(ends[:-1], ends[1:])])
    return [None if x is None else next(texts) for x in ids]


def decode(ids, v: Vocabulary) -> str | None:
    return decode_batch([ids], v)[0]


def row_key(value) -> int:
    import xxhash

    return xxhash.xxh64_intdigest("" if value is None else str(value))


def encode_frame(df: DataFrame, key_col: str = "doc_id", text_col: str = "text",
                 path: str = VOCABULARY, alpha: float = ALPHA, seed: int = SEED,
                 with_decoded: bool = True) -> DataFrame:
    """Add ids (array<int>), n_pieces and the text decoded from the ids again.

    ``path`` is a file name of the public tokenizers or a path that every node has."""
    ship_package(df.sparkSession)
    carry = [c for c in df.columns if c.lower() not in RESULT]
    src = df.select(*[F.col(f"`{c}`") for c in carry], F.col(key_col).cast("string").alias("__llm_k"),
                    F.col(text_col).cast("string").alias("__llm_t"))
    kept = df.select(*[F.col(f"`{c}`") for c in carry]).schema
    schema = kept.add("ids", T.ArrayType(T.IntegerType())).add("n_pieces", T.LongType())
    if with_decoded:
        schema = schema.add("decoded", T.StringType())

    def run(batches):
        import numpy as np
        import pyarrow as pa

        from trackstream.llm import sentencepiece_sampling as S

        v = S.vocabulary(path, alpha)
        known = S.Lattices(v)
        for whole in batches:
            lens = np.array([len(x.as_py() or "") for x in whole.column(whole.num_columns - 1)])
            # about BATCH_CHARS characters at a time bounds the memory of a task
            group = np.cumsum(lens) // S.BATCH_CHARS
            starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(lens) else []
            for a, z in zip(starts, [*starts[1:], len(lens)]):
                b = whole.slice(int(a), int(z - a))
                texts = b.column(b.num_columns - 1).to_pylist()
                keys = [S.row_key(k) for k in b.column(b.num_columns - 2).to_pylist()]
                ids = S.encode_batch(texts, keys, v, seed, known)
                null = np.array([x is None for x in ids])
                n = np.array([0 if x is None else len(x) for x in ids], np.int64)
                flat = np.concatenate([x for x in ids if x is not None] or [np.zeros(0, np.int32)])
                offsets = np.r_[0, np.cumsum(n)].astype(np.int32)
                lists = pa.ListArray.from_arrays(
                    pa.array(offsets, mask=np.r_[null, False]), pa.array(flat, pa.int32()))
                cols = [*b.columns[:-2], lists, pa.array(n, mask=null)]
                names = [*b.schema.names[:-2], "ids", "n_pieces"]
                if with_decoded:
                    cols.append(pa.array(S.decode_batch(ids, v), pa.string()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(cols, names)

    return src.mapInArrow(run, schema)
