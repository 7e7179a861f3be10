"""Quality rules: a threshold table compiled into one Spark projection.

Every measure is a built-in column expression over the whole text, every rule
is one row of :data:`RULES`, and :func:`apply_rules` turns the table into one
``select``: no user function, no shuffle.

Edge cases: a null, empty or blank text has no words, all counts 0 and fails
the base test (under 10 words); repeated rows are judged alike, one result row
each; a text of any length is measured whole, and a measure at its threshold passes; an
empty table gives an empty result.  Columns of the input whose names
clash with result columns are replaced by the result (case-insensitively, as
Spark resolves names).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackstream.llm.common import BLANKS, let, total, words

#: Function words of the four languages the rules are meant for.
STOP_WORDS = [
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on", "with", "as",
    "be", "by", "are", "this", "at", "from", "or", "have", "an", "not", "which",
    "der", "die", "das", "und", "ist", "von", "zu", "den", "mit", "sich", "auf", "für", "im",
    "dem", "nicht", "ein", "eine", "als", "auch", "es", "des", "einen",
    "le", "la", "les", "de", "et", "un", "une", "du", "en", "que", "qui", "dans", "pour",
    "par", "sur", "est", "au", "ne", "pas", "ce",
    "el", "los", "las", "y", "del", "se", "con", "una", "por", "para", "no", "al", "lo", "su",
]


@dataclass(frozen=True)
class Rule:
    """``measure`` must lie in [low, high] once the text has ``min_words`` words."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None
    min_words: int = 0


#: The threshold table.  Ratios are per word or per non-blank line.
RULES = [
    Rule("few_words", "n_words", low=10),
    Rule("repeated_windows", "repeat_ratio", high=0.2),
    Rule("word_length_low", "mean_word_chars", low=1.5),
    Rule("word_length_high", "mean_word_chars", high=25),
    Rule("symbols", "symbol_ratio", high=0.25),
    Rule("exclamations", "exclamation_ratio", high=0.25),
    Rule("stop_words", "stop_ratio", low=0.01, min_words=100),
    Rule("bullet_lines", "bullet_line_ratio", high=0.9, min_words=20),
    Rule("ellipsis_lines", "ellipsis_line_ratio", high=0.5, min_words=20),
    Rule("repeated_lines", "dup_line_ratio", high=0.6, min_words=20),
]

RESULT = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
          "kept", "failed_rules"]


def repeated_window_words(w: Column, width: int = 5) -> Column:
    """Words that lie in a ``width``-word window found twice or more in the text.

    Windows are compared by 64-bit hash first: if all hashes differ, no window
    repeats.  Otherwise the windows themselves are sorted with their positions,
    so a text costs n log n, however often it repeats itself."""
    n = F.size(w)
    starts = F.sequence(F.lit(1), n - (width - 1))

    def window(i):
        return F.array_join(F.slice(w, i, width), " ")

    def covered(s):
        again = F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["g"] == x["g"], F.lit(False))
                         | F.coalesce(F.get(s, i + 1)["g"] == x["g"], F.lit(False)))
        return let(F.sort_array(F.transform(again, lambda x: x["p"])), lambda p: total(
            F.transform(p, lambda x, i: F.least(F.lit(width), F.coalesce(
                F.get(p, i + 1) - x, F.lit(width))))))

    def exact():
        return let(F.sort_array(F.transform(starts, lambda i: F.struct(
            window(i).alias("g"), i.alias("p")))), covered)

    some = let(F.transform(starts, lambda i: F.xxhash64(window(i))), lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(exact()))
    return F.when(n < width, F.lit(0).cast("long")).otherwise(some)


def measures(text: Column, stop_words: list[str] = STOP_WORDS) -> Column:
    """All measures of a text as one struct column."""
    t = F.coalesce(text, F.lit(""))

    def without(x, chars):
        return F.length(F.regexp_replace(x, f"[{chars}]+", ""))

    def of(w):
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{BLANKS}]"))
        return let(lines, lambda ln: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            (F.length(t) - without(t, "#*$%&|<>")).cast("long").alias("n_symbols"),
            (F.size(ln) - F.size(F.array_distinct(ln))).cast("long").alias("n_dup_lines"),
            repeated_window_words(w).alias("n_repeat_words"),
            (F.length(t) - without(t, "!")).cast("long").alias("n_exclamations"),
            F.size(F.filter(w, lambda x: F.lower(x).isin(stop_words))).cast("long").alias("n_stop"),
            F.size(ln).cast("long").alias("n_lines"),
            F.size(F.filter(ln, lambda x: F.ltrim(x).substr(1, 1).isin("-", "•", "*")))
            .cast("long").alias("n_bullet_lines"),
            F.size(F.filter(ln, lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…")))
            .cast("long").alias("n_ellipsis_lines")))

    return let(words(text), of)


def _ratios(m: Column) -> dict[str, Column]:
    per_word, per_line = F.greatest(m["n_words"], F.lit(1)), F.greatest(m["n_lines"], F.lit(1))
    return {
        "n_words": m["n_words"],
        "repeat_ratio": m["n_repeat_words"] / per_word,
        "mean_word_chars": m["word_chars"] / per_word,
        "symbol_ratio": m["n_symbols"] / per_word,
        "exclamation_ratio": m["n_exclamations"] / per_word,
        "stop_ratio": m["n_stop"] / per_word,
        "bullet_line_ratio": m["n_bullet_lines"] / per_line,
        "ellipsis_line_ratio": m["n_ellipsis_lines"] / per_line,
        "dup_line_ratio": m["n_dup_lines"] / per_line,
    }


def compile_rules(m: Column, rules: list[Rule] = RULES) -> Column:
    """The names of the rules that a measured text breaks, in table order."""
    values = _ratios(m)
    out = []
    for r in rules:
        v, broken = values[r.measure], F.lit(False)
        if r.low is not None:
            broken = broken | (v < r.low)
        if r.high is not None:
            broken = broken | (v > r.high)
        out.append(F.when(broken & (m["n_words"] >= r.min_words), F.lit(r.name)))
    return F.filter(F.array(*out), lambda x: x.isNotNull())


def apply_rules(df: DataFrame, text_col: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """Add the measures, the base verdict, ``failed_rules`` and ``kept`` to ``df``."""
    taken = {c.lower() for c in RESULT}
    kept_cols = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    def judged(m):
        base = (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])
        return let(compile_rules(m, rules), lambda failed: F.struct(
            *[m[c].alias(c) for c in RESULT[:5]], base.alias("base_failed"),
            (~base & (F.size(failed) == 0)).alias("kept"), failed.alias("failed_rules")))

    # one expression from text to verdict: a filter on ``kept`` that the optimizer
    # moves to the scan then measures a text once, not once for every mention
    m = F.col("__llm_m")
    return (df.select(*kept_cols, let(measures(F.col(text_col)), judged).alias("__llm_m"))
            .select(*kept_cols, *[m[c].alias(c) for c in RESULT]))
