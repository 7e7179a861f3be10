"""Adaptive context-mixing range coder for blocks of token ids.

A block is coded on its own (its models start empty) and carries a CRC-32, so any
block can be read without the others.  Three predictions drive the coder:

* order 2: the id that last followed the same two ids, with a confidence 0 to 3;
* order 1: the id that last followed the same id, with a confidence 0 to 3;
* order 0: the block's ids by frequency; an id is coded as the class of its rank
  (its number of binary digits, up to that of the dictionary's size) and the digits
  below the first.

A symbol says "as order 2 predicts", "as order 1 predicts", or a rank class.  Its
probability mixes three adaptive counts: those seen under the order-2 confidence,
under the order-1 confidence (with whether both predict alike), and overall.
Counts are added before they are normalised, so a context that has seen more
weighs more.  A carry-less range coder with 64-bit numbers and 32-bit words turns
probabilities into bits.

All blocks of a batch move in step: step k codes the k-th id of every block, each
operation being one numpy call over all blocks.  Only whole numbers are used, so
coding is the same on any machine.

Layout of a block's payload (little-endian): u32 number of ids, u32 CRC-32 of the
ids as u32, u32 size of the dictionary, u8 width w of its entries in bytes (2 or 4),
the dictionary (ids by falling frequency, then by id), then 32-bit code words.
A block holds at most 16,384 ids.
"""

from __future__ import annotations

import struct
import zlib

HEAD = struct.Struct("<IIIB")
TABLE = 1 << 12              # slots of the order-1 and order-2 tables of a block
MOST_IDS = 1 << 14           # ids of a block at most
SORTED = 1 << 9              # blocks whose dictionaries are sorted together
#: By order-2 confidence (4), by order-1 confidence and agreement (8); overall stands apart.
CONTEXTS = 12
LIMIT = 1 << 13              # counts of a context are halved beyond this total,
PACE = 64                    # looked at every so many ids: mixed totals stay below 2 ** 15
GAIN = 24


class Damaged(ValueError):
    """A block whose checksum or length does not agree with its content."""


class _Models:
    """The adaptive state of blocks that move in step; ``entries`` is the size of each
    one's dictionary, which bounds its rank classes.

    Counts are kept summed up: column k of a row is the sum of those below symbol k, the
    last column that of all.  So rows are mixed by adding them, and learning a symbol adds
    one row of ``steps``."""

    def __init__(self, entries):
        import numpy as np

        n, most = len(entries), int(max(entries, default=0))
        symbols = 2 + np.array([int(e).bit_length() for e in entries], np.int64)
        width = 16 if int(symbols.max()) < 16 else 32
        first = np.minimum(np.arange(width), symbols[:, None]).astype(np.int16)
        self.width, self.row = width, np.dtype((np.void, 2 * width))
        self.overall = first
        self.count = np.repeat(first, CONTEXTS, axis=0)
        self.steps = (np.arange(width) > np.arange(width)[:, None]).astype(np.int16) * GAIN
        # a block's tables: order 2 by a hash, order 1 by rank
        slots = min(TABLE, 1 << max(most - 1, 1).bit_length())
        self.mask = slots - 1
        rows = np.arange(n)
        self.table = np.zeros(n * (TABLE + slots), np.uint16)
        self.room = np.stack((rows * (TABLE + slots), rows * (TABLE + slots) + TABLE))
        self.base = np.stack((rows * CONTEXTS, rows * CONTEXTS + 4))
        self.at = rows * width
        self.last1, self.last2 = (np.zeros(n, np.int64) for _ in range(2))
        self.step = 0

    def predict(self, m: int):
        """Of the first ``m`` blocks: table slots and entries, predicted ranks and contexts
        (a line of order 2 and one of order 1), counts under them, and the mixed counts."""
        import numpy as np

        a = self.last1[:m]
        slots = np.empty((2, m), np.int64)
        np.multiply(a, 40503, out=slots[0])
        slots[0] += self.last2[:m] * 30011
        slots[0] >>= 3
        slots[0] &= TABLE - 1
        np.bitwise_and(a, self.mask, out=slots[1])
        slots += self.room[:, :m]
        values = self.table.take(slots)
        ranks = values >> 2
        contexts = self.base[:, :m] + (values & 3)
        contexts[1] += (ranks[0] == ranks[1]).view(np.int8) << 2
        counts = self.count.view(self.row).ravel().take(contexts).view(np.int16).reshape(
            2, m, self.width)
        mixed = counts[0] + counts[1]
        mixed += self.overall[:m]
        return slots, values, ranks, contexts, counts, mixed

    def span(self, mixed, symbol):
        """Start and size of a symbol of each block, and the whole, as u64."""
        import numpy as np

        flat = mixed.ravel()
        at = self.at[:len(mixed)] + symbol
        start = flat.take(at)
        return (start.astype(np.uint64), (flat.take(at + 1) - start).astype(np.uint64),
                mixed[:, -1].astype(np.uint64))

    def learn(self, seen, symbol, rank, hit):
        """``hit``: which of the two predicted ranks are the rank that came."""
        import numpy as np

        slots, values, _, contexts, counts, _ = seen
        m = len(rank)
        more = self.steps.take(symbol, axis=0)
        counts += more
        self.count.view(self.row).ravel().put(contexts, counts.view(self.row).ravel())
        self.overall[:m] += more
        self.step += 1
        if self.step % PACE == 0:
            for lines in (self.count, self.overall):
                full = np.flatnonzero(lines[:, -1] > LIMIT)
                if len(full):
                    half = (np.diff(lines[full], axis=1) + 1) >> 1
                    lines[full, 1:] = np.cumsum(half, axis=1, dtype=np.int16)
        # a hit raises the confidence; a miss takes it to 0, or takes the place at 0
        sure = values & 3
        missed = np.where(sure > 0, values - sure, (rank << 2).astype(np.uint16))
        self.table.put(slots, np.where(hit, values + (sure < 3), missed))
        self.last2[:m], self.last1[:m] = self.last1[:m], rank


def _digits(rank):
    """The class of a rank: the number of binary digits of rank + 1, less one."""
    import numpy as np

    return np.frexp((rank + 1).astype(np.float32))[1].astype(np.int64) - 1


def _constants():
    import numpy as np

    return np.uint64(1 << 32), np.uint64(1), np.uint64(14), np.uint64(32), np.uint64(46)


WORD, ONE, S14, S32, S46 = _constants()


def _narrow(low, rng):
    """Blocks whose range is below a word, with their low end and their range after a
    word is moved out.  One move suffices: the range is then a word or more again.  A
    range that straddles a boundary of words is cut there, so no carry arises."""
    import numpy as np

    go = np.flatnonzero(rng < WORD)
    g_low, g_rng = low[go], rng[go]
    crosses = (g_low ^ (g_low + g_rng)) >= WORD
    g_rng = np.where(crosses, (~g_low + ONE) & (WORD - ONE), g_rng)
    return go, g_low, g_rng << S32


class _Writer:
    def __init__(self, n: int, steps: int):
        import numpy as np

        self.low = np.zeros(n, np.uint64)
        self.range = np.full(n, (1 << 64) - 1, np.uint64)
        self.out = np.zeros((n, steps), np.uint32)            # a word an id at most
        self.at = np.zeros(n, np.int64)

    def put(self, start, size, whole, rest, bits):
        """Narrow the ranges of the first blocks to [start, start + size) of ``whole``,
        and within it to part ``rest`` of 2 ** bits equal parts."""
        m = len(whole)
        step = self.range[:m] // (whole << S14)
        part = size << (S14 - bits)
        low, rng = self.low[:m], step * part
        low += step * ((start << S14) + rest * part)
        go, g_low, g_rng = _narrow(low, rng)
        at = self.at[go]
        self.out[go, at] = g_low >> S32
        self.at[go] = at + 1
        low[go], rng[go] = g_low << S32, g_rng
        self.range[:m] = rng

    def close(self):
        words = []
        for i, rest in enumerate(self.low.tolist()):
            words.append(self.out[i, :self.at[i]].astype("<u4").tobytes()
                         + struct.pack("<II", rest >> 32, rest & 0xFFFFFFFF))
        return words


class _Reader:
    def __init__(self, words: list):
        import numpy as np

        n = len(words)
        longest = max(map(len, words), default=0)
        self.words = np.zeros((n, longest + 3), np.uint32)
        for i, w in enumerate(words):
            self.words[i, :len(w)] = w
        self.at = np.full(n, 2)
        self.low = np.zeros(n, np.uint64)
        self.range = np.full(n, (1 << 64) - 1, np.uint64)
        first = self.words[:, :2].astype(np.uint64)
        self.code = (first[:, 0] << S32) | first[:, 1]

    def point(self, whole):
        """Where the code stands, in parts of ``whole``."""
        import numpy as np

        m = len(whole)
        self.step = self.range[:m] // (whole << S14)
        self.spot = np.minimum((self.code[:m] - self.low[:m]) // self.step,
                               (whole << S14) - ONE)
        return (self.spot >> S14).astype(np.int16)

    def take(self, start, size, bits):
        """Follow a symbol; returns the number of the part within it."""
        import numpy as np

        m, part = len(start), size << (S14 - bits)
        rest = (self.spot - (start << S14)) // part
        low, code, rng = self.low[:m], self.code[:m], self.step * part
        low += self.step * ((start << S14) + rest * part)
        go, g_low, g_rng = _narrow(low, rng)
        at = np.minimum(self.at[go], self.words.shape[1] - 1)
        code[go] = (code[go] << S32) | self.words[go, at]
        self.at[go] = at + 1
        low[go], rng[go] = g_low << S32, g_rng
        self.range[:m] = rng
        return rest


def _dictionaries(blocks: list):
    """Of each block the different ids by falling frequency, then by id; and the ranks of
    its ids, a row a block."""
    import numpy as np

    n, books = len(blocks), []
    ranks = np.zeros((n, max(map(len, blocks), default=0)), np.uint16)
    top = max((int(b.max()) for b in blocks if len(b)), default=0)
    place = np.zeros(top + 1, np.uint16) if top < 1 << 20 else None
    for a in range(0, n, SORTED):
        part = blocks[a:a + SORTED]
        line = np.concatenate(part).astype(np.uint64)
        line |= np.repeat(np.arange(len(part), dtype=np.uint64) << S32, [len(b) for b in part])
        line.sort()
        first = np.flatnonzero(np.concatenate((np.ones(min(len(line), 1), bool),
                                               line[1:] != line[:-1])))
        known, counts = line[first], np.diff(first, append=len(line))
        # block, falling frequency and id in one number
        known = (known >> S32 << S46) | ((MOST_IDS - counts).astype(np.uint64) << S32) | (
            known & (WORD - ONE))
        known.sort()
        ends = np.searchsorted(known >> S46, np.arange(len(part) + 1, dtype=np.uint64))
        ids = known.astype(np.uint32)
        ends = ends.tolist()
        numbers = np.arange(MOST_IDS, dtype=np.uint16)
        for i, (b, x, y) in enumerate(zip(part, ends[:-1], ends[1:]), a):
            book = ids[x:y]
            books.append(book)
            if place is not None:                # ranks by a table over the ids
                place[book] = numbers[:y - x]
                ranks[i, :len(b)] = place[b]
            elif len(b):
                by = np.argsort(book)
                ranks[i, :len(b)] = by[np.searchsorted(book[by], b)]
    return books, ranks


def _bytes_sum(below):
    """How many of each row's booleans (a multiple of eight) hold: words of eight bytes are
    added, and a product brings the sum of a word's bytes to its top."""
    import numpy as np

    words = below.view(np.uint64)
    total = words[:, 0] + words[:, 1]
    for k in range(2, words.shape[1]):
        total += words[:, k]
    return (total * np.uint64(0x0101010101010101) >> np.uint64(56)).astype(np.int64)


def _turned(x):
    """The transpose of an array, copied in strips that stay in the cache."""
    import numpy as np

    out = np.empty(x.shape[::-1], x.dtype)
    for a in range(0, len(x), 64):
        out[:, a:a + 64] = x[a:a + 64].T
    return out


def _alive(lens, steps: int):
    """How many blocks, longest first, still have an id at each step."""
    import numpy as np

    return np.searchsorted(-lens, -np.arange(steps), side="left").tolist()


def encode_blocks(blocks: list) -> list[bytes]:
    """Payloads of blocks of ids (unsigned 32-bit arrays); all move in step.

    Predictions are kept as ranks in the block's dictionary, which names the ids."""
    import numpy as np

    if not blocks:
        return []
    if max(map(len, blocks)) > MOST_IDS:
        raise ValueError(f"a block holds at most {MOST_IDS} ids")
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    sized = [np.asarray(blocks[i], np.uint32) for i in order]
    lens = np.array([len(b) for b in sized])
    steps, n = int(lens[0]), len(sized)
    books, ranks = _dictionaries(sized)
    ranks = _turned(ranks)
    models, writer = _Models([len(b) for b in books]), _Writer(n, steps)
    classes = _digits(np.arange(MOST_IDS)).astype(np.uint8)
    for k, m in enumerate(_alive(lens, steps)):
        narrow = ranks[k, :m]
        rank = narrow.astype(np.int64)
        seen = models.predict(m)
        hit = seen[2] == narrow
        plain = ~(hit[0] | hit[1])
        bits = classes.take(rank)
        symbol = np.where(plain, bits + np.uint8(2), ~hit[0]).astype(np.int64)
        bits *= plain
        rest = (narrow + np.uint16(1) - (np.uint16(1) << bits)) * plain
        writer.put(*models.span(seen[5], symbol), rest.astype(np.uint64), bits.astype(np.uint64))
        models.learn(seen, symbol, rank, hit)
    out = [b""] * n
    for i, (code, ids, book) in enumerate(zip(writer.close(), sized, books)):
        wide = 4 if len(book) and int(book.max()) > 0xFFFF else 2
        out[order[i]] = (HEAD.pack(len(ids), zlib.crc32(ids.astype("<u4").tobytes()), len(book), wide)
                         + book.astype(f"<u{wide}").tobytes() + code)
    return out


def decode_blocks(payloads: list) -> list:
    """The ids of each payload; a damaged block raises :class:`Damaged`."""
    import numpy as np

    heads, books, words = [], [], []
    for raw in payloads:
        if len(raw) < HEAD.size:
            raise Damaged("block cut short")
        n, crc, entries, wide = HEAD.unpack_from(raw)
        end = HEAD.size + entries * wide
        if wide not in (2, 4) or n > MOST_IDS or len(raw) < end or (len(raw) - end) % 4:
            raise Damaged("block cut short")
        heads.append((n, crc))
        books.append(np.frombuffer(raw, f"<u{wide}", entries, HEAD.size).astype(np.uint32))
        words.append(np.frombuffer(raw, "<u4", offset=end))
    if not heads:
        return []
    order = sorted(range(len(heads)), key=lambda i: -heads[i][0])
    lens = np.array([heads[i][0] for i in order])
    steps, n = int(lens[0]), len(order)
    ranks = np.zeros((steps, n), np.uint16)
    models, reader = _Models([len(books[i]) for i in order]), _Reader([words[i] for i in order])
    for k, m in enumerate(_alive(lens, steps)):
        seen = models.predict(m)
        (p2, p1), mixed = seen[2], seen[5]
        below = mixed <= reader.point(mixed[:, -1].astype(np.uint64))[:, None]
        symbol = _bytes_sum(below) - 1                 # column 0 holds for all
        bits = np.maximum(symbol - 2, 0).astype(np.uint64)
        start, size, _ = models.span(mixed, symbol)
        rest = reader.take(start, size, bits)
        rank = np.where(symbol == 0, p2, np.where(symbol == 1, p1, (
            rest + (ONE << bits) - ONE).astype(np.int64)))
        models.learn(seen, symbol, rank, seen[2] == rank)
        ranks[k, :m] = rank
    ranks = _turned(ranks)
    out = [None] * n
    for i, at in enumerate(order):
        size, crc = heads[at]
        own, book = ranks[i, :size], books[at]
        if size and (not len(book) or own.max() >= len(book)):
            raise Damaged("an id outside the block's dictionary")
        ids = book[own] if size else np.zeros(0, np.uint32)
        if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
            raise Damaged("checksum does not agree")
        out[at] = ids
    return out
