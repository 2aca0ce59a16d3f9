import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from equigauge.llm import boosting, quality


def slow_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)]


TEXTS = [
    None, "", " \n\t", "a", "a a a", "a a a a", "x y z x y z x", "l1\nl1\n\n \n \nl1 \nl1", "é\xa0ß #*$%&|<> 日本 \x1c b\x85c", "\r\n\x0b\x0c",
    "one two three four " * 40, "word\n" * 60, "long " + "x" * 100_000, " ".join(str(i) for i in range(70_000)),
]


def test_counts_equal_brute_force():
    rnd = random.Random(6)
    made = ["".join(rnd.choice("ab \n#é\t") for _ in range(rnd.randint(1, 120))) for _ in range(400)]
    for text in TEXTS + made:
        assert quality.statistics((text or "").encode())[0] == slow_counts(text), repr(text)[:80]


def test_very_many_distinct_words_do_not_overflow(monkeypatch):
    numbers = np.array([5, 6, 7, 1, 5, 6, 7, 2, 3])
    assert quality.n_repeated(numbers, 10) == quality.n_repeated(numbers, 1 << 22) == 6


def test_trees_are_monotone_and_flat():
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(3000, 4))
    y = (x[:, 0] + 0.5 * x[:, 1] ** 2 - x[:, 2] + rnd.normal(size=3000) > 0).astype(float)
    signs = [1, 0, -1, 1]
    trees = boosting.fit(x, y, signs, trees=40, depth=4)
    assert trees.feature.shape == trees.threshold.shape == (40, 15) and trees.value.shape == (40, 16)
    probe = rnd.normal(size=(400, 4))
    for f, s in enumerate(signs):
        if s:
            previous = None
            for v in np.linspace(-3, 3, 25):
                at = probe.copy()
                at[:, f] = v
                margin = trees.margin(at)
                if previous is not None:
                    assert (s * (margin - previous) >= -1e-12).all()
                previous = margin
    p = trees.probability(x)
    assert ((p > 0.5) == y).mean() > 0.8


def test_flat_scoring_equals_walking_each_tree():
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(500, 3))
    trees = boosting.fit(x, (x[:, 0] > 0.2).astype(float), [0, 0, 0], trees=5, depth=3)
    for row, margin in zip(x[:60], trees.margin(x[:60]), strict=True):
        total = trees.base
        for t in range(5):
            k = 0
            while k < 7:
                k = 2 * k + 1 + (row[trees.feature[t, k]] > trees.threshold[t, k])
            total += trees.value[t, k - 7]
        assert total == pytest.approx(margin)


def made_tables(spark):
    rnd = random.Random(3)
    words = [f"word{i}" for i in range(200)]
    docs, labels = [], []
    for i in range(400):
        good = i % 3 > 0
        text = " ".join(rnd.choice(words) + ("" if good else rnd.choice(["###", "%%%", ""])) for _ in range(rnd.randint(60, 200)))
        docs.append((i, text))
        if i % 2:
            labels.append((i, int(good)))
    docs += [(1000, None), (1001, ""), (1002, "short text"), (1003, "same again " * 80), (None, docs[1][1]), (1, docs[1][1])]
    labels += [(None, 1), (5, None), (7, 0), (99999, 1)]
    return (
        spark.createDataFrame([("x", d, t) for d, t in docs], "kept string, doc_id bigint, text string").repartition(3),
        spark.createDataFrame(labels, "doc_id bigint, quality int"),
        docs,
    )


def test_verdicts(spark):
    docs, labels, rows = made_tables(spark)
    model = quality.fit(docs, labels)
    got = quality.score(docs, model).collect()
    assert len(got) == len(rows)
    counts = Counter((str(d), *slow_counts(t)) for d, t in rows)
    assert Counter((str(r.doc_id), *[r[c] for c in quality.COUNTS]) for r in got) == counts
    for r in got:
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and not (failed and r.kept)
    clean = [r for r in got if r.doc_id is not None and r.doc_id < 400 and r.doc_id % 3 > 0]
    junk = [r for r in got if r.doc_id is not None and r.doc_id < 400 and r.doc_id % 3 == 0]
    assert all(r.kept for r in clean) and not any(r.kept for r in junk)
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)
    again = {(str(r.doc_id), r.score) for r in quality.score(docs.repartition(5), quality.fit(docs.repartition(7), labels)).collect()}
    assert again == {(str(r.doc_id), r.score) for r in got}


def test_without_labels_the_base_rules_decide(spark):
    docs, labels, rows = made_tables(spark)
    model = quality.fit(docs, labels.limit(0))
    got = quality.score(docs, model).collect()
    assert all(r.kept == (not r.base_failed) for r in got)
    assert quality.score(docs.limit(0), model).count() == 0 == quality.keep_good(docs.limit(0), model).count()


@pytest.mark.parametrize("wrong", [0.0, 0.01, 0.02, 0.05])
def test_wrong_labels_do_not_switch_the_trees_off(spark, wrong):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    flip = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1000)) < int(1000 * wrong)
    model = quality.fit(docs, labels.withColumn("quality", F.when(flip, 1 - F.col("quality")).otherwise(F.col("quality"))))
    assert quality.LEAST_CUT <= model.cut <= quality.CUT
    judged = quality.score(docs, model).join(labels, "doc_id").where("not base_failed")
    kept = {r.quality: r.share for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert kept[0] <= 0.05 and kept[1] >= 0.99


def test_cut_weighs_both_kinds():
    scores, good = np.array([0.01] * 98 + [0.9] * 2 + [0.99] * 97 + [0.01] * 3), np.arange(200) >= 100
    assert quality.chosen_cut(scores, good) >= quality.LEAST_CUT
    assert quality.chosen_cut(np.array([0.02, 0.07, 0.2, 0.9]), np.array([False, False, True, True])) <= 0.2
    assert quality.chosen_cut(np.array([0.2, 0.2]), np.array([False, True])) <= 0.2
