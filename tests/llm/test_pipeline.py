"""The pipeline on the smallest tables, against the stages done plainly."""

import re
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from equigauge.llm import quality, toxicity
from equigauge.llm.common import prepare_session, table
from tests.llm.test_decontam import slow as slow_leaks
from tests.llm.test_simhash import slow_components

SF = "/root/testdata/sf0.001"


def plainly(spark):
    """What run() should give: per kept document its pieces."""
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    labels = table(spark, SF, "labels")
    model = toxicity.fit(table(spark, SF, "documents"), labels)
    scanner = toxicity.Scanner(model.terms, model.harmless)
    docs = [(d, t) for d, t in docs if model.scores(np.asarray([scanner.features(t or "")[0]]))[0] < 0.5]
    left = spark.createDataFrame(docs, "doc_id bigint, text string")
    good = quality.fit(left, labels)
    kept = []
    for d, t in docs:
        counts, features = quality.statistics((t or "").encode())
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        assert counts[0] == len(words)
        if not quality.base_failed(counts) and good.scores(np.asarray([features]))[0] >= good.cut:
            kept.append((d, t))
    kept = [(d, t) for (d, t), (_, _, c) in zip(kept, slow_components(kept), strict=True) if c == d]
    bench = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    dirty = {r[0] for r in slow_leaks(kept, bench)}
    return [(d, t) for d, t in kept if d not in dirty]


def test_run_equals_the_stages_done_plainly(spark):
    prepare_session(spark)
    kept = plainly(spark)
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in rows} == {d for d, _ in kept}
    assert 100 < len(kept) < 200
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for d, t in kept:
        ids = [*whole.encode(t, add_special_tokens=False).ids, 2]
        at = 0
        for p in sorted(by_doc[d], key=lambda r: r.piece):
            assert (p.start, p.ids_crc32) == (at, zlib.crc32(np.asarray(ids[at : at + p.length], "<u4").tobytes()))
            at += p.length
        assert at == len(ids)


def test_stages_keep_the_columns(spark):
    docs = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality rules", "simhash near-dedup", "benchmark decontamination", "best-fit packing"]


def test_stages_take_empty_tables(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
