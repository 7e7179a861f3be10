"""Licence scans: ordered signature rules over the words of a text.

A text is reduced to lower-case words with one blank between them.  A keyword
gate decides which rules are tried at all; each rule is a regular expression
over words.  Detections are intervals of words: longer ones swallow those they
contain, and of two rules on the same words, or on words that overlap in part, the
earlier rule wins.  Everything is built-in column work (no user function): the rule
list is one literal array, built from families, versions and phrasings.

Edge cases: a null or empty text has no words, no places, empty label strings
and score 0; repeated rows are scanned alike; a text of any length is scanned whole,
in time that is linear in its length and its matches; an empty table gives an empty
result.  Clashing column names of the input give way to the result's.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackstream.llm.common import UPPER, before, count_of, let

#: Fixed by the contract of the operator: phrase -> label.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Families, most specific first: (label, keyword, name as a regular expression
#: over words, versions).  The keyword must occur in every text the name matches.
FAMILIES = [
    ("agpl", "affero", r"(?:gnu )?affero general public licen[sc]e", ("1 0", "3", "3 0")),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public licen[sc]e", ("2 1", "3", "3 0")),
    ("lgpl", "library general", r"(?:gnu )?library general public licen[sc]e", ("2", "2 0")),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation licen[sc]e", ("1 1", "1 2", "1 3")),
    ("gpl", "general public", r"(?:gnu )?general public licen[sc]e", ("1", "2", "2 0", "3", "3 0")),
    ("gpl", "gpl", r"(?:gnu )?gpl", ("2", "2 0", "3", "3 0")),
    ("gpl", "gplv", r"(?:gnu )?gplv[23]", ()),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl(?:v[23])?", ("2 1", "3", "3 0")),
    ("agpl", "agpl", r"(?:gnu )?agpl(?:v3)?", ("3", "3 0")),
    ("apache", "apache", r"apache (?:software )?licen[sc]e", ("1 0", "1 1", "2 0", "2")),
    ("apache", "apache", r"apache 2(?: 0)?", ()),
    ("mit", "mit", r"mit licen[sc]e", ()),
    ("mit", "expat", r"expat licen[sc]e", ()),
    ("x11", "x11", r"x11 licen[sc]e", ()),
    ("isc", "isc", r"isc licen[sc]e", ()),
    ("bsd-2-clause", "bsd", r"(?:simplified bsd|freebsd|bsd 2 clause) licen[sc]e", ()),
    ("bsd-3-clause", "bsd", r"(?:new bsd|modified bsd|revised bsd|bsd 3 clause) licen[sc]e", ()),
    ("bsd-4-clause", "bsd", r"(?:original bsd|bsd 4 clause) licen[sc]e", ()),
    ("bsd", "bsd", r"bsd (?:style )?licen[sc]e", ()),
    ("0bsd", "0bsd", r"0bsd", ()),
    ("mpl", "mozilla", r"mozilla public licen[sc]e", ("1 0", "1 1", "2 0")),
    ("mpl", "mpl", r"mpl", ("1 1", "2 0")),
    ("epl", "eclipse", r"eclipse public licen[sc]e", ("1 0", "2 0")),
    ("edl", "eclipse", r"eclipse distribution licen[sc]e", ("1 0",)),
    ("cddl", "development and distribution", r"common development and distribution licen[sc]e",
     ("1 0", "1 1")),
    ("cpl", "common public", r"common public licen[sc]e", ("1 0",)),
    ("eupl", "european union", r"european union public licen[sc]e", ("1 1", "1 2")),
    ("artistic", "artistic", r"artistic licen[sc]e", ("1 0", "2 0")),
    ("zlib", "zlib", r"zlib (?:libpng )?licen[sc]e", ()),
    ("boost", "boost", r"boost software licen[sc]e", ("1 0",)),
    ("unlicense", "unlicense", r"(?:the )?unlicense", ()),
    ("wtfpl", "wtfpl", r"wtfpl", ("2",)),
    ("ms-pl", "microsoft", r"microsoft public licen[sc]e", ()),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[sc]e", ()),
    ("osl", "open software", r"open software licen[sc]e", ("2 1", "3 0")),
    ("afl", "academic", r"academic free licen[sc]e", ("2 1", "3 0")),
    ("ofl", "open font", r"(?:sil )?open font licen[sc]e", ("1 0", "1 1")),
    ("python", "python software", r"python software foundation licen[sc]e", ("2",)),
    ("php", "php", r"php licen[sc]e", ("3 0", "3 01")),
    ("ruby", "ruby", r"ruby licen[sc]e", ()),
    ("postgresql", "postgresql", r"postgresql licen[sc]e", ()),
    ("openssl", "openssl", r"openssl licen[sc]e", ()),
    ("odbl", "open database", r"open database licen[sc]e", ("1 0",)),
    ("pddl", "open data commons", r"open data commons public domain dedication(?: and licen[sc]e)?",
     ("1 0",)),
    ("odc-by", "open data commons", r"open data commons attribution licen[sc]e", ("1 0",)),
    ("sspl", "server side", r"server side public licen[sc]e", ("1",)),
    ("busl", "business source", r"business source licen[sc]e", ("1 1",)),
    ("elastic", "elastic", r"elastic licen[sc]e", ("1 0", "2 0")),
    ("cc-by-nc-sa", "cc by nc sa", r"cc by nc sa", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-nd", "cc by nc nd", r"cc by nc nd", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc", "cc by nc", r"cc by nc", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-sa", "cc by sa", r"cc by sa", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nd", "cc by nd", r"cc by nd", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by", "cc by", r"cc by", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc0", "cc0", r"cc0", ("1 0",)),
    ("cc-by-nc-sa", "creative commons",
     r"creative commons attribution non ?commercial share ?alike(?: licen[sc]e)?", ("3 0", "4 0")),
    ("cc-by-nc-nd", "creative commons",
     r"creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?(?: licen[sc]e)?",
     ("3 0", "4 0")),
    ("cc-by-nc", "creative commons",
     r"creative commons attribution non ?commercial(?: licen[sc]e)?", ("3 0", "4 0")),
    ("cc-by-sa", "creative commons",
     r"creative commons attribution share ?alike(?: licen[sc]e)?", ("3 0", "4 0")),
    ("cc-by", "creative commons", r"creative commons attribution(?: licen[sc]e)?", ("3 0", "4 0")),
    ("cc", "creative commons", r"creative commons(?: licen[sc]e)?", ()),
]

#: Notices that are not named licences: (label, keyword, regular expression, weight).
NOTICES = [
    ("mit", "permission is hereby granted",
     r"permission is hereby granted free of charge to any person obtaining a copy", 1.0),
    ("isc", "permission to use copy modify",
     r"permission to use copy modify and or distribute this software", 0.9),
    ("bsd", "redistribution and use",
     r"redistribution and use in source and binary forms with or without modification", 1.0),
    ("apache", "apache org licenses", r"www apache org licenses license 2 0", 1.0),
    ("gpl", "free software foundation",
     r"as published by the free software foundation", 0.9),
    ("public-domain", "public domain",
     r"(?:is|are|released|placed|dedicated)(?: hereby)?(?: in| into| to)? the public domain", 0.8),
    ("reserved", "rights reserved", r"all rights reserved", 0.7),
    ("some-rights", "rights reserved", r"some rights reserved", 0.6),
    ("proprietary", "proprietary", r"proprietary and confidential", 0.8),
    ("proprietary", "confidential", r"confidential and proprietary", 0.8),
    ("proprietary", "without permission",
     r"(?:may not be|do not) (?:reproduced?|copied|copy|distributed?)(?: \S+){0,4} without permission",
     0.7),
    ("no-warranty", "warrant", r"without (?:any )?warrant(?:y|ies)(?: of any kind)?", 0.4),
    ("as-is", "as is", r"provided as is", 0.4),
    ("copyright", "copyright", r"copyright (?:c )?(?:19|20)\d\d(?: (?:19|20)\d\d)?", 0.4),
]

#: A text without any of these holds no signature; most texts stop here.
GATES = ["licen", "rights reserved", "copyright", "public domain", " cc by", " cc0", "creative commons",
         "gpl", "wtfpl", "0bsd", " mpl", "apache", "open data commons", "permission ", "redistribution",
         "proprietary", "warrant", "as is", "free software foundation"]


def build_rules() -> list[dict]:
    """The ordered rule list: for each family grants, versions and the bare name."""
    out = []

    def add(label, keyword, regex, weight, order):
        out.append({"priority": order, "label": label, "keyword": keyword,
                    "regex": f" (?:{regex})(?= )", "weight": weight})

    grant = (r"(?:licensed|released|distributed|available|published|covered|provided)"
             r"(?: \S+){0,2} under(?: the)?(?: terms of)?(?: the)? ")
    v = r"(?: licen[sc]e)? (?:v|ver |version )?"
    order = 0
    for tier in ("grant with version", "version", "grant", "name"):
        for label, keyword, name, versions in FAMILIES:
            if tier in ("grant with version", "version"):
                for ver in versions:
                    tag = label + "-" + ver.replace(" ", ".")
                    lead = grant if tier.startswith("grant") else ""
                    add(tag, keyword, f"{lead}{name}{v}{ver}", 1.0 if lead else 0.95, order)
                    order += 1
            else:
                lead = grant if tier == "grant" else ""
                add(label, keyword, f"{lead}{name}", 0.9 if lead else 0.8, order)
                order += 1
    for label, keyword, regex, weight in NOTICES:
        add(label, keyword, regex, weight, order)
        order += 1
    return out


RULES = build_rules()
RULE_TYPE = "array<struct<priority:int,label:string,keyword:string,regex:string,weight:double>>"
RESULT = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]


def normalized(text: Column) -> Column:
    """' word word word ': ASCII lower case, words parted by single blanks."""
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    flat = F.trim(F.regexp_replace(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))
    return F.concat(F.lit(" "), flat, F.lit(" "))


def _blanks(x: Column) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))


def detections(norm: Column, rules: list[dict]) -> Column:
    """All matches of the rules whose keyword is in the text, as word intervals."""
    table = F.from_json(F.lit(json.dumps(rules)), RULE_TYPE)

    def of_rule(r):
        def spans(m):
            def placed(parts):
                # a match begins behind the words of the parts and matches before it
                own = F.transform(m, lambda x: _blanks(x).cast("long"))
                gap = F.transform(F.slice(parts, F.lit(1), F.size(m)), lambda x: _blanks(x).cast("long"))
                both = F.zip_with(gap, own, lambda g, o: g + o)
                starts = F.zip_with(before(both, F.lit(0).cast("long"), lambda a, x: a + x), gap,
                                    lambda a, g: a + g)
                return F.zip_with(starts, own, lambda s, o: F.struct(
                    s.alias("start"), (-(s + o)).alias("minus_end"),
                    r["priority"].alias("priority"), r["label"].alias("label"),
                    r["weight"].alias("weight")))
            return let(F.split(norm, r["regex"], -1), placed)
        return let(F.regexp_extract_all(norm, r["regex"], F.lit(0)), spans)

    hit = F.filter(table, lambda r: F.contains(norm, r["keyword"]))
    return F.flatten(F.transform(hit, of_rule))


SPAN = "struct<start:bigint,minus_end:bigint,priority:int,label:string,weight:double>"


def resolve(found: Column) -> Column:
    """Drop detections inside another; on equal words the earlier rule stays.  Of two that
    overlap in part, the one of the earlier rule stays: the other is dropped if its
    neighbour to either side overlaps it and has the smaller priority number."""
    zero = F.lit(0).cast("long")

    def whole(x):
        ends = F.transform(x, lambda d: -d["minus_end"])
        return F.filter(F.arrays_zip(x.alias("d"), before(ends, zero, lambda a, e: F.greatest(a, e)).alias("upto")),
                        lambda z: -z["d"]["minus_end"] > z["upto"])

    def settled(k):
        def stays(z, i):
            def loses(n):
                meets = (n["start"] < -z["minus_end"]) & (z["start"] < -n["minus_end"])
                return F.coalesce(meets & (n["priority"] < z["priority"]), F.lit(False))
            return ~loses(F.get(k, i - 1)) & ~loses(F.get(k, i + 1))
        return F.filter(k, stays)

    return let(F.transform(let(F.sort_array(found), whole), lambda z: z["d"]), settled)


def scan(df: DataFrame, text_col: str = "text", rules: list[dict] = RULES) -> DataFrame:
    """Add word counts, base places, labels, score and detected spans to ``df``."""
    drop = {c.lower() for c in RESULT}
    carry = [F.col(f"`{c}`") for c in df.columns if c.lower() not in drop]

    def of(norm):
        n_words = F.when(F.trim(norm) == "", F.lit(0)).otherwise(_blanks(norm) - 1).cast("long")
        wide = F.replace(norm, F.lit(" "), F.lit("  "))
        count, first, last, labels = [], [], [], []
        for phrase, label in BASE.items():
            sp = f" {phrase} "
            has = F.contains(norm, F.lit(sp))
            size = phrase.count(" ") + 1
            count.append(F.when(has, count_of(wide, " " + phrase.replace(" ", "  ") + " "))
                         .otherwise(F.lit(0).cast("long")))
            first.append(F.when(has, _blanks(F.substring_index(norm, sp, 1)).cast("long")))
            last.append(F.when(has, n_words - size
                               - _blanks(F.substring_index(norm, sp, -1)).cast("long")))
            labels.append(F.when(has, F.lit(label)))
        base = F.sort_array(F.filter(F.array(*labels), lambda x: x.isNotNull()))
        gate = F.lit(False)
        for g in GATES:
            gate = gate | F.contains(norm, F.lit(g))
        empty = F.from_json(F.lit("[]"), f"array<{SPAN}>")
        spans = F.when(gate, let(detections(norm, rules), resolve)).otherwise(empty)
        return let(base, lambda b: let(spans, lambda s: F.struct(
            n_words.alias("n_words"), sum(count[1:], count[0]).alias("n_base"),
            F.array_min(F.array(*first)).alias("first_word"),
            F.array_max(F.array(*last)).alias("last_word"),
            F.array_join(b, ",").alias("base_labels"),
            F.array_join(F.sort_array(F.array_distinct(F.concat(
                b, F.transform(s, lambda x: x["label"])))), ",").alias("labels"),
            F.greatest(F.coalesce(F.array_max(F.transform(s, lambda x: x["weight"])), F.lit(0.0)),
                       F.when(F.size(b) > 0, F.lit(0.5)).otherwise(0.0)).alias("score"),
            F.transform(s, lambda x: F.struct(
                x["label"].alias("label"), x["start"].alias("first_word"),
                (-x["minus_end"] - 1).alias("last_word"))).alias("spans"))))

    out = df.select(*carry, let(normalized(F.col(text_col)), of).alias("__llm_s"))
    return out.select(*carry, *[F.col("__llm_s")[c].alias(c) for c in RESULT])
