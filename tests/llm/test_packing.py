import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from equigauge.llm import packing
from equigauge.llm.tokens import PieceEncoder

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
HARD = [
    "", "  a  b", "a\n\nb", " x", "x ", "\n", "a \n b", "don't, I'll  go\tnow", "<|endoftext|> a", "a<|endoftext|>b", "é à", "日本語 テキスト",
    "1234 5a6", "x\x1c y", "ΑΣ ΣΑΣ.", "İstanbul K", "a\0b c", "é x́,", "foo   bar", "end.\n", "İ. ǅ, ﬁ! ªb, ʰa.", "a'll x.'s they're_ foo'''s o'd", "a b c",
]


@pytest.mark.parametrize(("path", "spaced"), [(BYTE, True), (WORD, False)])
def test_pieces_give_the_ids_of_whole_texts(path, spaced):
    rnd = random.Random(3)
    letters = " \n\t.,!aéB'sß1 İΣ<|>#"
    texts = HARD + ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 25))) for _ in range(3000)]
    got = PieceEncoder(path, spaced).encode(texts)
    want = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    for text, a, b in zip(texts, got, want, strict=True):
        assert np.frombuffer(a, "<u4").tolist() == b.ids, repr(text)


def test_generations_do_not_change_ids(monkeypatch):
    monkeypatch.setattr("equigauge.llm.tokens.GENERATION", 8)
    e = PieceEncoder(BYTE, True)
    texts = [f"word{i % 13} and other{i % 7}, some\nmore." for i in range(60)]
    whole = Tokenizer.from_file(BYTE)
    for t in texts:
        assert np.frombuffer(e.encode([t])[0], "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids


def check_packing(rows, docs, capacity, end_id=2):
    """Pieces give back every document; sequences are gapless and within the capacity."""
    whole = Tokenizer.from_file(BYTE)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for doc_id, text in docs:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, end_id]
        pieces = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(len(pieces)))
        at = 0
        for p in pieces:
            part = np.asarray(ids[at : at + p.length], "<u4").tobytes()
            assert p.start == at and p.ids_crc32 == zlib.crc32(part)
            at += p.length
        assert at == len(ids)
        assert all(p.length == capacity for p in pieces[1:])
        assert len(pieces) == -(-len(ids) // capacity)
    for parts in by_sequence.values():
        parts.sort(key=lambda r: r.offset)
        at = 0
        for p in parts:
            assert p.offset == at
            at += p.length
        assert at <= capacity


def made_docs(n=250):
    rnd = random.Random(8)
    words = ["alpha", "beta", "Gamma,", "delta.", "εψιλον", "x1", "the", "of"]
    docs = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 1, 5, 30, 200])))) for i in range(n)]
    return [*docs, (n, None), (n + 1, ""), (n + 2, "word " * 3000)]


def test_packed_documents_come_back(spark, monkeypatch):
    docs = made_docs()
    df = spark.createDataFrame([(1, d, t) for d, t in docs], "bin_id int, doc_id bigint, text string").repartition(3)
    rows = packing.pack_documents(df, BYTE, 64).collect()
    check_packing(rows, docs, 64)
    fewest = -(-sum(r.length for r in rows) // 64)
    assert len({r.sequence_id for r in rows}) <= 1.02 * fewest + 1


def test_columns_of_the_same_names_come_back(spark):
    rows = [(i, 10 + i % 50, i * 2, "seq") for i in range(300)]
    found = spark.createDataFrame(rows, "doc_id bigint, length bigint, Offset int, sequence_id string")
    got = packing.pack(found, 64, partition_pieces=100).collect()
    back = {(r.doc_id, r.length, r.own_Offset, r.own_sequence_id) for r in got}
    assert back == set(rows) and len(got) == 300
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]


def test_rounds_of_the_tree(spark):
    rnd = random.Random(4)
    found = spark.createDataFrame([(i, rnd.randint(1, 100)) for i in range(4000)], "doc_id bigint, length bigint").repartition(4)
    from equigauge.session import materialize

    found = materialize(found, "test-pieces")
    rows = packing.pack(found, 100, partition_pieces=300, nearly_full=0.95).collect()
    assert sorted(r.doc_id for r in rows) == list(range(4000))
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= 100
    assert len(bins) <= 1.03 * sum(r.length for r in rows) / 100 + 1


def test_best_fit_takes_the_tightest_bin():
    bins, offsets, fills = packing.best_fit(np.array([7, 6, 4, 3]), 10)
    assert bins.tolist() == [0, 1, 1, 0]
    assert offsets.tolist() == [0, 0, 6, 7]
    assert fills.tolist() == [10, 10]


def test_sequences_hold_the_ids(spark):
    from equigauge.session import materialize

    df = spark.createDataFrame(made_docs(40), "doc_id bigint, text string")
    found = materialize(packing.pieces(df, BYTE, 64), "test-pieces")
    ids = {(r.doc_id, r.piece): bytes(r.ids) for r in found.collect()}
    for s in packing.sequences(packing.pack(found, 64)).collect():
        for p in s.parts:
            a = 4 * p.offset
            assert bytes(s.ids)[a : a + 4 * p.length] == ids[p.doc_id, p.piece]


def test_empty_null_ids_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert packing.pack_documents(empty, BYTE).count() == 0
    df = spark.createDataFrame([(None, "a"), (None, "a"), (5, "b"), (5, "b")], "doc_id bigint, text string")
    rows = packing.pack_documents(df, BYTE).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["5", "5", "None", "None"]
    assert sorted(r.offset for r in rows) == [0, 2, 4, 6]
    with pytest.raises(ValueError):
        packing.pack(df.withColumn("length", df.doc_id).withColumn("bin_id", df.doc_id))
