import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from equigauge.llm import token_files as tf
from equigauge.session import new_path

WORD = public_tokenizers.path("word_bpe_49k.json")


@given(st.lists(st.integers(0, 2**32 - 1), max_size=300), st.integers(1, 100))
@settings(max_examples=150, deadline=None)
def test_any_block_comes_back(values, percentile):
    if values:
        ids = np.asarray(values, np.uint32)
        assert tf.decode_block(memoryview(tf.encode_block(ids, percentile)), 0).tolist() == values


@pytest.mark.parametrize("width", range(0, 33))
def test_every_width(width):
    rnd = np.random.default_rng(width)
    for n in (1, 7, 8, 9, 64, 1001):
        values = rnd.integers(0, 2**width, n).astype(np.uint32)
        raw = tf.pack_bits(values, width)
        assert len(raw) == (n * width + 7) // 8
        assert tf.unpack_bits(memoryview(raw), width, n).tolist() == values.tolist()


def test_outliers_are_exceptions_and_blocks_are_found():
    ids = np.asarray([100 + i % 16 for i in range(10_000)], np.uint32)
    ids[::500] = 4_000_000_000
    raw = tf.encode_file([1, None, 3], np.asarray([4000, 0, 6000]), ids, block=1000)
    assert len(raw) < 10_000
    f = tf.TokenFile(raw)
    assert f.ids().tolist() == ids.tolist()
    assert f.ids(3990, 4010).tolist() == ids[3990:4010].tolist()
    assert f.doc_ids.to_pylist() == [1, None, 3]
    with pytest.raises(ValueError):
        tf.TokenFile(raw[:-1])


def want(docs):
    whole = Tokenizer.from_file(WORD)
    out, start = [], 0
    for doc_id, text in sorted(docs, key=lambda r: (r[0] is not None, r[0])):
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def made_docs():
    rnd = random.Random(2)
    words = ["Alpha", "beta,", "Ünder", "x9", "<|endoftext|>", "\n\n", "\t", "日本"]
    docs = [(i * 7 % 211, " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 3, 60, 900])))) for i in range(211)]
    return [*docs, (None, "first"), (5000, None), (5001, "")]


def test_files_come_back_in_order(spark):
    docs = made_docs()
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id bigint, text string, start string").repartition(4)
    got = [tuple(r) for r in tf.write_and_read(df, WORD).orderBy("start").collect()]
    assert got == want(docs)


def test_many_files_in_a_partition(spark):
    docs = made_docs()
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    folder = new_path(spark, "test-files")
    manifest = tf.write_files(tf.tokenize(tf.in_order(df, 3), WORD), folder, file_ids=500, file_docs=20)
    assert manifest.count() > 20
    rows = tf.read_files(spark, folder, manifest, with_ids=True).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows] == want(docs)
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in rows)


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "b"), (1, "b"), (1, "a")], "doc_id bigint, text string")
    rows = tf.write_and_read(df, WORD).orderBy("start").collect()
    assert [r.start for r in rows] == [0, 2, 4]
    assert tf.write_and_read(df.limit(0), WORD).count() == 0


def test_more_partitions_than_the_session_has(spark, monkeypatch):
    docs = made_docs()
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    monkeypatch.setattr(tf, "PARTITION_BYTES", 5000)
    asked = []
    real = tf.in_order
    monkeypatch.setattr(tf, "in_order", lambda d, partitions: real(d, asked.append(partitions) or partitions))
    got = [tuple(r) for r in tf.write_and_read(df, WORD).orderBy("start").collect()]
    assert got == want(docs)
    assert asked == [-(-sum(len((t or "").encode()) for _, t in docs) // 5000)]


def test_one_very_long_text(spark):
    docs = [(2, "Ünder the sea, x9 " * 60_000), (1, "short"), (3, None)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert sorted(tuple(r) for r in tf.write_and_read(df, WORD).collect()) == sorted(want(docs))
