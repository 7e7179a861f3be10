"""Operators 11 to 13 against brute force and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from test_llm import SCHEMA, SF, TEXTS
from trackstream.llm import ngram_join, spelling, token_alignment
from trackstream.llm import queries as Q


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None if i % 4 == 0 else "en", None, None, "x", 1, None, "y", 3, "z", 5)
            for i, t in enumerate(TEXTS)]
    rows += [rows[6], (None, "no id here at all", *[None] * 10), (None,) * 12]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# --- 11 n-gram join -----------------------------------------------------------

def grams(text, width=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {" ".join(w[i:i + width]) for i in range(len(w) - width + 1)} or ({" ".join(w)} if w else set())


def brute_join(texts, num=90, den=100):
    sets = {i: grams(t) for i, t in texts.items()}
    ids, root, links = sorted(sets), {i: i for i in sets}, set()

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                links.add((b, a))
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}, links, sets


def clusters(seed, n_groups=8, size=14):
    """Groups of near copies at many distances, all with one common passage."""
    rng = random.Random(seed)
    passage = [f"c{i}" for i in range(30)]
    texts = {}
    for g in range(n_groups):
        base = [f"g{g}w{rng.randrange(400)}" for _ in range(rng.choice((12, 60, 150, 300)))]
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randrange(0, 2 + len(w) // 60)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(9)}"
            if rng.random() < 0.3:
                w = w + passage
            if rng.random() < 0.2:
                base = w                                   # copies of copies: chains
            texts[len(texts)] = " ".join(w)
    return texts


@pytest.mark.parametrize("num, paired", [(90, 24), (90, 2), (80, 3)])
def test_join_finds_every_link(spark, num, paired):
    texts = clusters(num)
    want, links, sets = brute_join(texts, num)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(df, num=num, paired=paired, spare=0).collect()}
    assert got == want
    first = {}
    for i in sorted(sets):
        first.setdefault(frozenset(sets[i]), i)
    want_links = {tuple(sorted((first[frozenset(sets[a])], first[frozenset(sets[b])])))
                  for a, b in links if sets[a] != sets[b]}
    assert len(want_links) > 20
    assert {(r.a, r.b) for r in ngram_join.all_links(df, num=num).collect()} == want_links


def test_near_copies_spread_few_tokens(spark, monkeypatch):
    rng = random.Random(120)
    base = [f"w{i}" for i in range(150)]
    texts = {}
    for i in range(120):
        w = list(base)
        for _ in range(2):
            w[rng.randrange(len(w))] = f"x{i % 3}"
        texts[i] = " ".join(w)
    spread, write = [], ngram_join.materialize

    def seen(df, name):
        out = write(df, name)
        if name == "often":
            spread.append(out.agg({"f": "sum"}).first()[0] or 0)
        return out

    monkeypatch.setattr(ngram_join, "materialize", seen)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in ngram_join.join(df, paired=4, spare=0).collect()}
    want, _, sets = brute_join(texts)
    assert got == want
    # whole sets are spread on the first level; those behind it spread differences alone
    assert len(spread) > 1 and 2 * sum(spread[1:]) < sum(map(len, sets.values()))


def test_join_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    want, _, _ = brute_join(texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in Q.op11_ngram_join(spark, SF).collect()}
    assert got == want


def test_prefixes_lengthen_with_cost(spark):
    """l is the cheapest one by the stated estimate, and the prefix holds what it asks for."""
    sets = {k: list(range(60)) + [1000 + 10 * k + j for j in range(3)] for k in range(30)}
    sets |= {40: list(range(2000, 2060)), 41: list(range(2000, 2059)) + [2999]}
    sets |= {50 + k: list(range(3000, 3012)) for k in range(3)}
    often = Counter(t for s in sets.values() for t in s)
    df = spark.createDataFrame([(bytes([k]), len(t), t) for k, t in sets.items()],
                               "node binary, n long, tokens array<long>")
    rows = defaultdict(list)
    for r in ngram_join.prefixes(df, 90, 100).collect():
        rows[r.node[0]].append(r)
    chosen = set()
    for k, s in sets.items():
        order = sorted(s, key=lambda t: (often[t], t))

        def cost(l):
            lists = sum(often[t] - 1 for t in order[:ngram_join.slack(len(s)) + l])
            return lists * (1 + ngram_join.VERIFY * len(s) / l)

        best = min(range(1, 9), key=lambda l: (cost(l), l))
        prefix = [(i, t) for i, t in enumerate(order[:ngram_join.slack(len(s)) + best]) if often[t] > 1]
        assert sorted((r.at, r.t) for r in rows[k]) == prefix and {r.l for r in rows[k]} <= {best}
        chosen.add(best)
    assert len(chosen) > 1


def test_join_edges(spark, odd, empty):
    out = ngram_join.join(odd).collect()
    assert len(out) == odd.count() and ngram_join.join(empty).count() == 0
    by = defaultdict(list)
    for r in out:
        by[r.doc_id].append(r)
    assert all(by[i][0].n_shingles == 0 and by[i][0].component_id == i for i in (0, 1, 2))
    assert {r.component_id for r in by[6]} == {6} and len(by[6]) == 2
    assert by[17][0].component_id == 14
    assert {(r.n_shingles, r.component_id) for r in by[None]} == {(3, None), (0, None)}


# --- 12 alignment -------------------------------------------------------------

ODD_TEXTS = [" ", "a ", "  a  b \n c\t\n  d  ", "x ▁ y", "<|endoftext|> hi </s><s> <unk>", "\n", " \n x",
             "日本語 \U0001f600 é é", "a\x00b \x85 c\xa0 d", "日本" * 700, "a  b \x1f c　 d", "don't 'twas"]


def brute_alignment(align, text):
    """(n_a, n_b, n_groups, links, digest), token by token."""
    none = 0, 0, 0, [], ""
    if not text:
        return none
    raw = (" " + text).encode()
    a, b = align.a.encode(" " + text, add_special_tokens=False).ids, align.b.encode(text)
    if b"".join(align.bytes_a[i] for i in a) != raw or b"".join(align.bytes_b[i] for i in b) != raw:
        return none

    def spans(ids, of):
        at, out = 0, []
        for i in ids:
            out.append((at, at := at + len(of[i])))
        return out

    sa, sb = spans(a, align.bytes_a), spans(b, align.bytes_b)
    cuts = sorted({z for _, z in sa} & {z for _, z in sb})
    groups, lo = [], 0
    for hi in cuts:
        groups.append("|".join(",".join(str(i) for i, (x, z) in zip(ids, s) if lo <= x and z <= hi)
                               for ids, s in ((a, sa), (b, sb))))
        lo = hi
    links, k = [], 0
    for i, (x, z) in zip(a, sa):
        while sb[k][1] <= x:
            k += 1
        m = k
        while m < len(sb) and sb[m][0] < z:
            links.append((i, b[m]))
            m += 1
    return len(a), len(b), len(cuts), links, hashlib.sha256(";".join(groups).encode()).hexdigest()


@pytest.mark.parametrize("most", [4_000_000, 700])
def test_alignment(spark, most):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    rows = docs + [(-k - 1, t) for k, t in enumerate(TEXTS[:15] + ODD_TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    align = token_alignment.aligner(token_alignment.BYTE_BPE, token_alignment.PIECES)
    want = {i: brute_alignment(align, t) for i, t in rows}
    count = Counter(p for w in want.values() for p in set(w[3]))
    top = defaultdict(int)
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    got = token_alignment.align_table(df, most_pairs=most).collect()
    assert len(got) == len(rows) and want[-19][0] == 0            # the text with a mark of its own
    for r in got:
        n_a, n_b, n_groups, links, sha = want[r.doc_id]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256) == (n_a, n_b, n_groups, len(links), sha)
        assert r.count_sum == sum(count[p] for p in links)
        assert r.n_best == sum(count[p] == top[p[0]] for p in links)


def test_sparse_products():
    rng = np.random.default_rng(5)
    for _ in range(20):
        n = int(rng.integers(1, 40))
        ends_a = np.unique(np.append(rng.integers(1, n + 1, 8), n))
        ends_b = np.unique(np.append(rng.integers(1, n + 1, 8), n))
        len_a, len_b = np.diff(ends_a, prepend=0), np.diff(ends_b, prepend=0)
        dense_a = np.repeat(np.eye(len(len_a), dtype=int), len_a, axis=1)
        dense_b = np.repeat(np.eye(len(len_b), dtype=int), len_b, axis=1)
        i, j, v = token_alignment.overlap_links(len_a, len_b)
        got = np.zeros((len(len_a), len(len_b)), int)
        got[i, j] = v
        assert (got == dense_a @ dense_b.T).all()
        ga, gb, cuts = token_alignment.group_of(ends_a, ends_b)
        i, j = token_alignment.group_links(ga, gb)
        assert set(zip(i.tolist(), j.tolist())) == {
            (x, y) for x in range(len(ga)) for y in range(len(gb)) if ga[x] == gb[y]}


def test_alignment_edges(odd, empty):
    out = token_alignment.align_table(odd).collect()
    assert len(out) == odd.count() and token_alignment.align_table(empty).count() == 0
    assert all((r.n_a, r.n_b, r.n_links, r.groups_sha256, r.count_sum) == (0, 0, 0, "", 0)
               for r in out if r.doc_id in (0, 1))
    assert len({(r.n_a, r.groups_sha256) for r in out if r.doc_id == 6}) == 1


# --- 13 spelling variants -----------------------------------------------------

def brute_variants(rows, least_count=5):
    count = Counter()
    for doc, text in rows:
        for r in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            r = "".join(c.lower() if "A" <= c <= "Z" else c for c in r)
            h = zlib.crc32(f"{'' if doc is None else doc}:{r}".encode())
            if h % 199 == 0:
                k = h % len(r)
                r = r[:k] + r[k + 1:]
            count[r] += 1
    n = {w: k for w, k in count.items() if len(w) >= 6 and k >= least_count}
    near, holes = defaultdict(set), defaultdict(set)
    for w in n:
        for i in range(len(w)):
            holes[w[:i], w[i + 1:]].add(w)
            if w[:i] + w[i + 1:] in n:
                near[w].add(w[:i] + w[i + 1:])
                near[w[:i] + w[i + 1:]].add(w)
    for same in holes.values():
        for w in same:
            near[w] |= same - {w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= 5 * n[w]:
            form[w] = best
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = form.get(w), root, n[w], len(near[w]), n.get(form.get(w))
    return out


def test_variants_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    got = Q.op13_spelling_variants(spark, "/root/testdata/sf0.01").collect()
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == brute_variants(rows)
    assert any(r.form != r.root for r in got if r.form)


def test_states_that_lead_to_many_words_are_split(spark):
    rng = random.Random(11)
    words = {"prefix" + "".join(rng.choice("abé") for _ in range(rng.randrange(2, 7))) for _ in range(600)}
    words |= {"".join(rng.choice("ab") for _ in range(rng.randrange(1, 6))) + "ending" for _ in range(60)}
    words |= {"aaaaaa", "aaaaaaa", "aaaaaaaa", "÷×÷×÷×"}
    want = set()
    for w in words:
        for i in range(len(w) + 1):
            want |= {tuple(sorted((w, w[:i] + c + w[i:]))) for c in "abé" if w[:i] + c + w[i:] in words}
            want |= {tuple(sorted((w, w[:i] + c + w[i + 1:]))) for c in "abé"
                     if i < len(w) and c != w[i] and w[:i] + c + w[i + 1:] in words}
    df = spark.createDataFrame([(w,) for w in words], "word string")
    for most in (20, 4096):
        got = [(r.a, r.b) for r in spelling.near_pairs(df, most=most).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_acceptor_is_minimal():
    net = spelling.Acceptor()
    net.build(sorted(["ab", "cb", "abb", "cbb"]))
    # states: accepting end, before the last b, after a or c, start
    assert len(net.arcs) == 4


def test_variants_edges(spark, odd, empty):
    got = spelling.variants(odd, least_count=1).collect()
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == brute_variants(
        [(r.doc_id, r.text) for r in odd.collect()], 1)
    assert spelling.variants(empty).count() == 0
