"""The same queries in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from trackstream.llm import mixing
from trackstream.llm.quality_rules import RULES, STOP_WORDS

BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"


def _rule(r) -> str:
    ratio = {
        "n_words": "n_words", "repeat_ratio": "n_repeat_words / pw",
        "mean_word_chars": "word_chars / pw", "symbol_ratio": "n_symbols / pw",
        "exclamation_ratio": "n_ex / pw", "stop_ratio": "n_stop / pw",
        "bullet_line_ratio": "n_bullet / pl", "ellipsis_line_ratio": "n_ell / pl",
        "dup_line_ratio": "n_dup_lines / pl"}[r.measure]
    bad = [f"{ratio} < {r.low}"] * (r.low is not None) + [f"{ratio} > {r.high}"] * (r.high is not None)
    return f"(n_words >= {r.min_words} AND ({' OR '.join(bad)}))"


OP4 = f"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '{BLANK}+'), lambda x: x <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ln FROM t),
win AS (SELECT rid, i, array_to_string(w[i:i+4], ' ') AS g
    FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win)
    WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest(range(0, 5)) AS k)
    GROUP BY rid),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '{BLANK}', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(ln) - len(list_distinct(ln)))::BIGINT AS n_dup_lines,
    coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
    length(t) - length(replace(t, '!', '')) AS n_ex,
    len(list_filter(w, lambda x: list_contains({STOP_WORDS!r}, lower(x)))) AS n_stop,
    len(list_filter(ln, lambda x: list_contains(['-', '•', '*'], ltrim(x, ' ')[1]))) AS n_bullet,
    len(list_filter(ln, lambda x: rtrim(x, ' ') LIKE '%...' OR rtrim(x, ' ') LIKE '%…')) AS n_ell,
    greatest(len(w), 1)::DOUBLE AS pw, greatest(len(ln), 1)::DOUBLE AS pl
    FROM w LEFT JOIN cov USING (rid)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT ({' OR '.join(map(_rule, RULES))}) AS kept FROM b"""

OP7 = f"""
WITH RECURSIVE l AS (SELECT doc_id, raw, (ord - 1)::BIGINT AS ord FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS raw,
        generate_subscripts(string_split(text, chr(10)), 1) AS ord
    FROM documents WHERE text IS NOT NULL)),
p AS (SELECT doc_id, ord, raw, lower(array_to_string(w, ' ')) AS low, len(w) AS n,
        list_transform(w, lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE lower(x) END) AS m
    FROM (SELECT *, list_filter(string_split_regex(raw, '{BLANK}+'), lambda x: x <> '') AS w FROM l)
    WHERE len(w) > 0),
q AS (SELECT doc_id, ord, n, CASE WHEN n >= 5 THEN m WHEN regexp_matches(low, '\\p{{L}}')
        THEN [regexp_replace(low, '[0-9]+', '<*>', 'g')] ELSE [low] END AS m FROM p),
r AS (SELECT doc_id, ord, m, array_to_string(m, ' ') AS f,
        CASE WHEN n >= 5 THEN n || ' ' || array_to_string(m[1:4], ' ') ELSE '0 ' || m[1] END AS leaf,
        CASE WHEN n >= 20 OR (n < 5 AND length(m[1]) >= 160) THEN 2
             WHEN n >= 5 OR length(m[1]) >= 40 THEN 3 ELSE 20 END AS need FROM q),
kinds AS (SELECT leaf, f, any_value(m) AS m, any_value(need) AS need, count(DISTINCT doc_id) AS n_docs
    FROM r GROUP BY leaf, f),
-- a round votes in each group: lines that agree with the shape are done, the others
-- go on in groups of one more position, as long as a group could recur
vote AS (
    SELECT leaf, '' AS grp, f, m, need, n_docs, FALSE AS fits FROM kinds
    WHERE leaf IN (SELECT leaf FROM kinds GROUP BY leaf HAVING count(*) > 1 AND sum(n_docs) >= any_value(need))
    UNION ALL
    SELECT leaf, grp, f, m, need, n_docs, fits FROM (
        WITH w AS (SELECT * FROM vote WHERE NOT fits),
        tok AS (SELECT leaf, grp, f, n_docs, unnest(m) AS token, generate_subscripts(m, 1) AS pos FROM w),
        cnt AS (SELECT leaf, grp, pos, token, sum(n_docs) AS v FROM tok GROUP BY ALL),
        best AS (SELECT leaf, grp, pos, arg_min(token, (-v, token)) AS token, max(v) AS v, count(*) AS kinds
            FROM cnt GROUP BY ALL),
        part AS (SELECT leaf, grp, arg_min(pos, (kinds, v, pos)) FILTER (WHERE kinds > 1) AS cut
            FROM best GROUP BY ALL),
        fit AS (SELECT t.leaf, t.grp, t.f, count(*) FILTER (WHERE t.token = b.token) >= 0.8 * count(*) AS fits
            FROM tok AS t JOIN best AS b USING (leaf, grp, pos) GROUP BY ALL),
        next AS (SELECT w.leaf, CASE WHEN x.fits THEN w.grp ELSE w.grp || ' ' || cut || '=' || w.m[cut] END AS grp,
            w.f, w.m, w.need, w.n_docs, x.fits FROM w JOIN fit AS x USING (leaf, grp, f) JOIN part USING (leaf, grp))
        SELECT *, count(*) OVER g AS k, sum(n_docs) OVER g AS d FROM next WINDOW g AS (PARTITION BY leaf, grp, fits))
    WHERE fits OR (k > 1 AND d >= need)),
named AS (SELECT r.*, CASE WHEN v.f IS NULL THEN 'own ' || r.f ELSE 'of ' || v.grp END AS tmpl
    FROM r LEFT JOIN (SELECT * FROM vote WHERE fits) AS v ON r.leaf = v.leaf AND r.f = v.f),
often AS (SELECT leaf, tmpl, min((doc_id, ord)) AS stay FROM named GROUP BY leaf, tmpl
    HAVING count(DISTINCT doc_id) >= any_value(need)),
goes AS (SELECT n.doc_id, n.ord FROM named AS n JOIN often USING (leaf, tmpl)
    WHERE (n.doc_id, n.ord) <> stay),
done AS (SELECT l.doc_id, count(*) AS n_lines, count(g.ord) AS n_dropped,
    coalesce(string_agg(raw, chr(10) ORDER BY l.ord) FILTER (WHERE g.ord IS NULL), '') AS text
    FROM l LEFT JOIN goes AS g ON l.doc_id = g.doc_id AND l.ord = g.ord GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, done.text
FROM documents AS d LEFT JOIN done USING (doc_id)"""

_W = list(mixing.WEIGHTS)
OP9 = f"""
WITH d AS (SELECT doc_id, coalesce('s' || source, '~') AS src,
    len(list_filter(string_split_regex(coalesce(text, ''), '{BLANK}+'), lambda x: x <> ''))::BIGINT AS size
    FROM documents),
s AS (SELECT src, sum(size)::BIGINT AS source_size FROM d GROUP BY src),
w AS (SELECT *, {_W}[1 + (row_number() OVER (ORDER BY src) - 1) % {len(_W)}]::DOUBLE AS w,
    ({mixing.MAX_REPEAT} * source_size)::DOUBLE AS cap FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY cap / w, src) AS o FROM w),
l AS (SELECT *, (sum(source_size::DOUBLE) OVER () - coalesce(sum(cap) OVER prev, 0))
    / (sum(w) OVER () - coalesce(sum(w) OVER prev, 0)) AS level FROM o
    WINDOW prev AS (ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT src, source_size, coalesce(least(cap, w * first_level), cap) AS target FROM (
    SELECT *, min(level) FILTER (WHERE o = stop) OVER () AS first_level FROM (
        SELECT *, min(o) FILTER (WHERE cap > level * w) OVER () AS stop FROM l))),
b AS (SELECT d.*, CASE WHEN size < 8 THEN size ELSE length(bin(size)) * 8
        + ((size >> (length(bin(size)) - 4)) & 7) END AS cls,
    ('0x' || substr(md5(doc_id::VARCHAR), 1, 6))::BIGINT % {mixing.BLOCKS} AS salt,
    ('0x' || substr(md5('7:' || src), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM d),
n AS (SELECT b.*, source_size, target,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    row_number() OVER (PARTITION BY src ORDER BY cls, salt, size, doc_id) AS k FROM b JOIN t USING (src))
SELECT doc_id, size, source_size, target,
    (size * least(floor(k * rate + u) - floor((k - 1) * rate + u), {mixing.MAX_REPEAT}))::BIGINT AS taken
FROM n"""

SQL = {"op4_quality_rules": OP4, "op7_line_dedup": OP7, "op9_mixing": OP9}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
OP11 = f"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{BLANK}+'), lambda x: x <> '') AS w
    FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3
        THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1),
        lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS t FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s AS a JOIN s AS b
    ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM met JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b
    WHERE 100 * k >= 90 * (x.n + y.n - k)),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
low AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(low, w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN low ON low.a = w.doc_id"""

SQL["op11_ngram_join"] = OP11
