import re

from equigauge.llm import licenses
from equigauge.llm.licenses import BASE, SignatureRule

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def slow(text, rules):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    base, hits = [], []
    for phrase, label in BASE.items():
        p = phrase.split()
        base += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    line = " ".join(words)
    for r in rules:
        if r.keyword in words:
            for m in re.finditer(f"(?<![^ ])(?:{r.expression})(?![^ ])", line):
                first = line[: m.start()].count(" ")
                hits.append((first, first + m.group().count(" "), r.order, r.label))
    hits.sort(key=lambda h: (h[0], -h[1], h[2], h[3]))
    kept = [
        h for i, h in enumerate(hits)
        if not any(o[2] <= h[2] and o[0] <= h[0] and o[1] >= h[1] for o in hits[:i])
    ]
    starts = [i for i, _ in base]
    base_labels = {label for _, label in base}
    labels = base_labels | {h[3] for h in kept}
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base_labels)), ",".join(sorted(labels)))


TEXTS = [
    None,
    "",
    " \n\t",
    "nothing here",
    "Released UNDER the MIT-License. Released under the MIT License!",
    "Licensed under the Apache License, Version 2.0.",
    "Licensed under CC BY-NC 4.0.",
    "This work is licensed under the GNU General Public License, version 3.",
    "under the mit licenses; xunder the mit license; under the mit license2",
    "CC\x00BY\x7fNC é cc by nc\n" * 50,
    "spdx-license-identifier: mpl-2.0 and SPDX-License-Identifier: cc0-1.0",
    "All rights reserved. BSD 3-Clause License, or the new BSD license",
    "éunder the mit license, under the mit licenseé",
    "Kunder İ the mit license",
    "word " * 30000 + "under the mit license " * 2000 + "gpl v2",
    "Redistribution and use in source and binary forms, with or without",
    "published under the terms of the mozilla public license 2.0, creative commons attribution sharealike",
]


def test_scan_equals_brute_force(spark):
    docs = spark.createDataFrame([(i % 9, t, "z") for i, t in enumerate(TEXTS)], "doc_id bigint, text string, row string").repartition(3)
    got = licenses.scan(docs).collect()
    rules = licenses.license_rules()
    key = lambda r: tuple(str(x) for x in r)
    want = [(i % 9, *slow(t, rules)) for i, t in enumerate(TEXTS)]
    have = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) for r in got]
    assert sorted(map(key, have)) == sorted(map(key, want))
    assert all(0 <= r.score <= 1 for r in got)
    assert all(r.score == 1 for r in got if r.n_base)


def test_containment_and_order(spark):
    rules = [
        SignatureRule(1, "long", "aa", "aa license bb"),
        SignatureRule(2, "inside", "license", "license"),
        SignatureRule(0, "strong", "bb", "bb"),
        SignatureRule(2, "same", "aa", "aa license bb"),
        SignatureRule(2, "crossing", "bb", "bb cc"),
    ]
    docs = spark.createDataFrame([(1, "aa license bb cc")], "doc_id bigint, text string")
    row = licenses.scan(docs, rules).first()
    assert row.labels == "crossing,long,strong"


def test_there_are_hundreds_of_rules_and_the_gate_lets_each_through(spark):
    rules = licenses.license_rules()
    assert len(rules) > 300
    names = [(n, label) for label, ns in licenses.NAMES.items() for n in ns]
    texts = [(i, f"It is released under the {n} license") for i, (n, _) in enumerate(names)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    for r in licenses.scan(docs).collect():
        assert r.labels, names[r.doc_id]


def test_empty_table(spark):
    assert licenses.scan(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
