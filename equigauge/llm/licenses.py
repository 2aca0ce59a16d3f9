"""License detection by ordered signature rules.

A text is brought into words (runs of ASCII letters, digits and non-ASCII, lower
case) with single spaces. Rules are regular expressions over that line. They are
made from the table of licenses and their names below, with the wordings in which
licenses are given, and have an order: a fixed wording of a grant before a
reference, before a bare name. Only texts with a keyword of licensing are looked
at, and of them only the rules whose own keyword is among the words.

Overlaps. Every match is an interval of words. A detection inside another one's
interval is dropped if that one's order is not later; of equal intervals the
earlier order stays. What only overlaps stays. Labels of base phrases always stay.

All of it is DataFrame expressions: texts are read once and stay in their
partition; what is shuffled is a narrow row per document and its detections.

Defined results: a null text is empty and has no words and no labels. Rows with
the same doc_id are scanned each on its own. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
START, END = "\x01", "\x02"

#: Phrases that always count, and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: label: names in words; a version follows where one is given in brackets.
NAMES = {
    "mit": ["mit", "expat"],
    "apache-2": ["apache 2 0", "apache 2", "apache version 2 0", "apache version 2", "asl 2 0"],
    "apache-1": ["apache 1 1", "apache 1 0", "apache version 1 1"],
    "bsd-2": ["bsd 2 clause", "2 clause bsd", "simplified bsd", "freebsd"],
    "bsd-3": ["bsd 3 clause", "3 clause bsd", "new bsd", "modified bsd", "revised bsd"],
    "bsd-4": ["bsd 4 clause", "4 clause bsd", "original bsd"],
    "bsd": ["bsd"],
    "isc": ["isc"],
    "zlib": ["zlib", "zlib libpng"],
    "gpl-2": ["gnu general public license version 2", "gnu gpl version 2", "gnu gpl v2", "gpl version 2", "gpl v2", "gpl 2 0", "gplv2"],
    "gpl-3": ["gnu general public license version 3", "gnu gpl version 3", "gnu gpl v3", "gpl version 3", "gpl v3", "gpl 3 0", "gplv3"],
    "gpl": ["gnu general public", "gnu gpl", "gpl"],
    "lgpl-2": ["gnu lesser general public license version 2 1", "gnu library general public license version 2", "lgpl version 2 1", "lgpl v2 1", "lgpl 2 1"],
    "lgpl-3": ["gnu lesser general public license version 3", "lgpl version 3", "lgpl v3", "lgpl 3 0"],
    "lgpl": ["gnu lesser general public", "gnu library general public", "lgpl"],
    "agpl-3": ["gnu affero general public license version 3", "agpl version 3", "agpl v3", "agpl 3 0"],
    "agpl": ["gnu affero general public", "affero general public", "agpl"],
    "gfdl": ["gnu free documentation", "gfdl"],
    "mpl-2": ["mozilla public license version 2 0", "mozilla public license 2 0", "mpl 2 0", "mpl v2"],
    "mpl-1": ["mozilla public license version 1 1", "mpl 1 1"],
    "mpl": ["mozilla public", "mpl"],
    "epl-2": ["eclipse public license version 2 0", "eclipse public license 2 0", "epl 2 0"],
    "epl-1": ["eclipse public license version 1 0", "eclipse public license v1 0", "epl 1 0"],
    "epl": ["eclipse public"],
    "cddl": ["common development and distribution", "cddl 1 0", "cddl"],
    "cpl": ["common public"],
    "eupl": ["european union public", "eupl 1 2", "eupl"],
    "artistic-2": ["artistic 2 0", "artistic license 2 0"],
    "artistic": ["artistic", "perl artistic"],
    "boost": ["boost software", "boost"],
    "unlicense": ["unlicense"],
    "wtfpl": ["wtfpl", "do what the fuck you want to public"],
    "cc0": ["cc0 1 0", "cc0", "creative commons zero"],
    "cc-by-nc-nd": ["cc by nc nd 4 0", "cc by nc nd", "creative commons attribution noncommercial noderivatives", "creative commons attribution noncommercial noderivs"],
    "cc-by-nc-sa": ["cc by nc sa 4 0", "cc by nc sa", "creative commons attribution noncommercial sharealike", "creative commons attribution non commercial share alike"],
    "cc-by-nc": ["cc by nc 4 0", "cc by nc 3 0", "cc by nc", "creative commons attribution noncommercial", "creative commons attribution non commercial"],
    "cc-by-nd": ["cc by nd 4 0", "cc by nd", "creative commons attribution noderivatives"],
    "cc-by-sa": ["cc by sa 4 0", "cc by sa 3 0", "cc by sa", "creative commons attribution sharealike", "creative commons attribution share alike"],
    "cc-by": ["cc by 4 0", "cc by 3 0", "cc by", "creative commons attribution"],
    "creative-commons": ["creative commons"],
    "odbl": ["open database", "odbl"],
    "python": ["python software foundation", "psf"],
    "ruby": ["ruby"],
    "php": ["php 3 01", "php"],
    "ofl": ["sil open font", "open font", "ofl 1 1"],
    "postgresql": ["postgresql"],
    "openssl": ["openssl"],
    "ms-pl": ["microsoft public", "ms pl"],
    "bsl": ["business source", "busl 1 1"],
    "sspl": ["server side public", "sspl"],
    "x11": ["x11"],
    "ncsa": ["university of illinois ncsa open source", "ncsa"],
    "w3c": ["w3c software"],
    "afl": ["academic free"],
    "osl": ["open software"],
}

#: Wordings that need no name: label, keyword, expression, order.
FIXED = [
    ("mit", "permission", "permission is hereby granted free of charge to any person obtaining a copy of this software", 0),
    ("isc", "permission", "permission to use copy modify and or distribute this software for any purpose", 0),
    ("bsd", "redistribution", "redistribution and use in source and binary forms", 0),
    ("gpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu general public license", 0),
    ("zlib", "warranty", "provided as is without any express or implied warranty", 0),
    ("unlicense", "unencumbered", "free and unencumbered software released into the public domain", 0),
    ("public-domain", "domain", "(?:released|dedicated|placed) (?:in|into|to) the public domain", 1),
    ("all-rights-reserved", "reserved", "all rights reserved", 2),
    ("proprietary", "proprietary", "proprietary and confidential", 2),
]
SCORES = (1.0, 0.9, 0.6)


#: Words of names that tell little; no keyword if a name has another.
COMMON_WORDS = set("license version public general free software open source in the you want to do what".split())


@dataclass(frozen=True)
class SignatureRule:
    order: int  # the earlier, the stronger
    label: str
    keyword: str
    expression: str


def license_rules() -> list[SignatureRule]:
    """All rules in order: fixed wordings, grants and identifiers, names with "license"."""
    rules = [SignatureRule(order, label, keyword, pattern) for label, keyword, pattern, order in FIXED]
    for label, names in NAMES.items():
        for name in names:
            keyword = max([w for w in name.split() if w not in COMMON_WORDS] or name.split(), key=len)
            tail = "" if " license" in name else "(?: public)?(?: licen[sc]e)?"
            version = "(?: (?:version|v) [0-9]+(?: [0-9]+)?)?"
            grant = "(?:licen[sc]ed|released|distributed|available|provided|published|redistributed)"
            rules.append(SignatureRule(1, label, keyword, f"{grant} under (?:the )?(?:terms of )?(?:the )?{name}{tail}{version}"))
            rules.append(SignatureRule(1, label, keyword, f"spdx license identifier {name}"))
            rules.append(SignatureRule(1, label, keyword, f"under (?:the )?(?:terms of )?(?:the )?{name} licen[sc]e{version}"))
            rules.append(SignatureRule(2, label, keyword, f"licen[sc]e {name}"))
            if " license" in name or name.startswith(("cc", "creative", "gnu", "gpl", "lgpl", "agpl")):
                rules.append(SignatureRule(2, label, keyword, name))
            else:
                rules.append(SignatureRule(2, label, keyword, f"{name} (?:public )?licen[sc]e{version}"))
    # "under the X license" with a version behind a comma reads the same in words
    rules.append(SignatureRule(1, "apache-2", "apache", "apache licen[sc]e version 2(?: 0)?"))
    rules.append(SignatureRule(1, "apache-2", "apache", "under the apache licen[sc]e version 2(?: 0)?"))
    return rules


#: A text without any of these has no detection: each rule and phrase holds one. Of a
#: pair, the expression is looked at only where the plain word is found.
GATE_WORDS = "licen spdx gpl gnu affero creative cc0 permission redistribution unencumbered proprietary reserved warranty".split()
GATE_PAIRS = {
    "domain": f"public{SEPARATOR}domain",
    "cc": f"cc{SEPARATOR}by",
    "under": f"(?:released|distributed|available|provided|published){SEPARATOR}under",
}


def gate(lowered: Column) -> Column:
    out = F.lit(False)
    for word in GATE_WORDS:
        out = out | lowered.contains(word)
    for word, expression in GATE_PAIRS.items():
        out = out | (lowered.contains(word) & lowered.rlike(expression))
    return out


def n_words(spaced: Column) -> Column:
    """Words of a text whose separators are single spaces."""
    spaces = F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit("")))
    ends = spaced.startswith(" ").cast("int") + spaced.endswith(" ").cast("int")
    return F.when(spaced == "", F.lit(0)).otherwise(spaces + 1 - ends).cast("bigint")


def once(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def places(line: Column, expression: Column) -> Column:
    """First and last word of every match of an expression (a column of text) in a line of words."""
    whole = F.concat(F.lit("(?<![^ ])("), expression, F.lit(")(?![^ ])"))

    def numbers(words: Column, marks) -> Column:
        return F.array_compact(F.transform(words, lambda w, i: F.when(marks(w), i)))

    def found(words: Column) -> Column:
        first = numbers(words, lambda w: w.startswith(START))
        return F.arrays_zip(first.alias("first"), numbers(words, lambda w: w.endswith(END)).alias("last"))

    def of_marked(marked: Column) -> Column:
        cut = F.when(marked.contains(START), F.split(marked, " ")).otherwise(F.array().cast("array<string>"))
        return once(cut, found)

    return once(F.regexp_replace(line, whole, F.lit(f"{START}$1{END}")), of_marked)


def detections(line: Column, rules: list[SignatureRule]) -> Column:
    """All matches of all rules whose keyword is a word of the line."""
    by_keyword: dict[str, list[SignatureRule]] = {}
    for r in rules:
        by_keyword.setdefault(r.keyword, []).append(r)
    entries = []
    for keyword, own in sorted(by_keyword.items()):
        listed = [F.struct(F.lit(r.order).alias("order"), F.lit(r.label).alias("label"), F.lit(r.expression).alias("expression")) for r in own]
        entries += [F.lit(keyword), F.array(*listed)]
    present = F.array_intersect(F.split(line, " "), F.array(*[F.lit(k) for k in sorted(by_keyword)]))
    open_rules = F.flatten(F.transform(present, lambda k: F.element_at(F.create_map(*entries), k)))
    return F.flatten(
        F.transform(
            open_rules,
            lambda r: F.transform(
                places(line, r["expression"]),
                lambda p: F.struct(p["first"].alias("first"), p["last"].alias("last"), r["order"].alias("order"), r["label"].alias("label")),
            ),
        )
    )


def scan(docs: DataFrame, rules: list[SignatureRule] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections."""
    rules = license_rules() if rules is None else rules
    text = F.coalesce(F.col("text"), F.lit(""))
    seen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("t"), F.monotonically_increasing_id().alias("row"))
    # each of these is used several times below
    seen = seen.select("doc_id", "row", F.lower("t").alias("lowered"), F.regexp_replace("t", SEPARATOR, " ").alias("spaced"))
    words_line = F.translate(F.btrim("spaced", F.lit(" ")), UPPER, UPPER.lower())
    seen = seen.select("doc_id", "row", n_words(F.col("spaced")).alias("n_words"), F.when(gate(F.col("lowered")), words_line).alias("line"))
    line = F.col("line")
    phrases = F.array(*[F.struct(F.lit(label).alias("label"), F.lit(phrase).alias("phrase")) for phrase, label in BASE.items()])
    base = F.flatten(
        F.transform(
            F.filter(phrases, lambda p: line.contains(p["phrase"])),
            lambda p: F.transform(places(line, p["phrase"]), lambda x: F.struct(x["first"].alias("first"), x["last"].alias("last"), p["label"].alias("label"))),
        )
    )
    kind = "array<struct<first:int,last:int,order:int,label:string>>"
    found = seen.select(
        "doc_id",
        "row",
        "n_words",
        F.when(line.isNotNull(), base).alias("base"),
        F.when(line.isNotNull(), detections(line, rules)).cast(kind).alias("found"),
    )
    starts = F.transform("base", lambda b: b["first"])
    narrow = found.select(
        "doc_id",
        "row",
        "n_words",
        F.coalesce(F.size("base"), F.lit(0)).cast("bigint").alias("n_base"),
        F.array_min(starts).cast("bigint").alias("first_word"),
        F.array_max(starts).cast("bigint").alias("last_word"),
        F.array_sort(F.array_distinct(F.transform("base", lambda b: b["label"]))).alias("base_found"),
        F.explode_outer("found").alias("hit"),
    )
    # inside an earlier-starting interval whose end is not before the own one: the longest end so far, per order
    by_place = Window.partitionBy("row").orderBy("hit.first", F.desc("hit.last"), "hit.order", "hit.label").rowsBetween(Window.unboundedPreceding, -1)
    contained = F.lit(False)
    for order in sorted({r.order for r in rules}):
        reach = F.max(F.when(F.col("hit.order") == order, F.col("hit.last"))).over(by_place)
        contained = contained | F.coalesce((F.col("hit.order") >= order) & (reach >= F.col("hit.last")), F.lit(False))
    kept = narrow.withColumn("stays", F.col("hit").isNotNull() & ~contained)
    strength = F.element_at(F.array(*[F.lit(s) for s in SCORES]), F.col("hit.order") + 1)
    keys = ["doc_id", "row", "n_words", "n_base", "first_word", "last_word", "base_found"]
    out = kept.groupBy("row").agg(
        *[F.first(k).alias(k) for k in keys if k != "row"],
        F.collect_set(F.when(F.col("stays"), F.col("hit.label"))).alias("hit_labels"),
        F.sort_array(F.collect_list(F.when(F.col("stays"), F.col("hit")))).alias("detections"),
        F.max(F.when(F.col("stays"), strength)).alias("strength"),
    )
    base_found = F.coalesce("base_found", F.array().cast("array<string>"))
    labels = F.array_sort(F.array_union(base_found, F.col("hit_labels")))
    return out.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(base_found, ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("strength", F.lit(0.0))).alias("score"),
        "detections",
    )
