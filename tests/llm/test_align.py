import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from equigauge.llm import align

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def texts() -> list[str | None]:
    rnd = random.Random(11)
    words = ["the", "harbour", "Straße", "naïve", "日本語テキスト", "😀", "x" * 70, "a.b,c;d", "<|endoftext|>", "<s>", "<0x41>", "don't", "3.14159", "[unk]", "ÿ", "é"]
    gaps = [" ", " ", " ", "  ", "\n", "\n\n", "\t", "   ", " \n ", "\r\n", "", "\xa0", "\x1c", "\x85", "　"]
    made = ["".join(rnd.choice(words) + rnd.choice(gaps) for _ in range(rnd.randint(1, 60))) for _ in range(150)]
    odd = [None, "", " ", "  ", "\n", " \n", "a", " a", "a ", "a  ", "▁", "x▁y z", "\0", "a\0b c", "end\n", "\n\n start", "<unk>", "﻿bom", "é"]
    return [*odd, *made, "word " * 3000, "ab" * 5000]


def slow_tokens(text):
    if not text:
        return None
    t = Tokenizer.from_file(A) if not hasattr(slow_tokens, "a") else slow_tokens.a
    m = SentencePieceProcessor(model_file=B) if not hasattr(slow_tokens, "b") else slow_tokens.b
    t.encode_special_tokens = True
    slow_tokens.a, slow_tokens.b = t, m
    byte = {c: b for b, c in align.BYTE_CHARS.items()}
    raw = (" " + text).encode()
    a = [(i, bytes(byte[c] for c in t.id_to_token(i))) for i in t.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in m.encode(text):
        p = m.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if m.is_byte(i) else p.replace("▁", " ").encode()))
    return (a, b) if b"".join(x for _, x in a) == raw == b"".join(x for _, x in b) else None


def spans(tokens):
    out, at = [], 0
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def slow(docs):
    """Plain: spans, common ends, all overlaps by testing them."""
    found = []
    for text in docs:
        both = slow_tokens(text)
        if both is None:
            found.append((0, 0, [], "", None))
            continue
        a, b = spans(both[0]), spans(both[1])
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, i, j = [], 0, 0
        for e in ends:
            left, right = [], []
            while i < len(a) and a[i][2] <= e:
                left.append(a[i][0])
                i += 1
            while j < len(b) and b[j][2] <= e:
                right.append(b[j][0])
                j += 1
            groups.append(f"{','.join(map(str, left))}|{','.join(map(str, right))}")
        links, low = [], 0
        for x, s, e in a:
            while b[low][2] <= s:
                low += 1
            k = low
            while k < len(b) and b[k][1] < e:
                links.append((x, b[k][0]))
                k += 1
        found.append((len(a), len(b), links, hashlib.sha256(";".join(groups).encode()).hexdigest(), len(groups)))
    counts = Counter(link for f in found for link in f[2])
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return [
        (n_a, n_b, n or 0, len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links), h) for n_a, n_b, links, h, n in found
    ]


def shown(df) -> list[tuple]:
    return sorted((str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect())


@pytest.mark.parametrize("lookup_rows", [10**6, 0])
def test_equals_brute_force(spark, lookup_rows):
    docs = texts()
    rows = [(None if i == 3 else i // 2, t, 5, "x") for i, t in enumerate(docs + docs[-3:])]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, row int, pairs string")
    want = sorted((str(r[0]), *w) for r, w in zip(rows, slow([r[1] for r in rows]), strict=True))
    assert sum(w[1] > 0 for w in want) > 150
    assert shown(align.cross_tokenizer(table, A, B, lookup_rows=lookup_rows)) == want


def test_segments_change_nothing(monkeypatch):
    both = align.Aligner(A, B)
    docs = [t for t in texts() if t and slow_tokens(t)]
    whole = [align.summary(both.segments(align.cut_text(t))) for t in docs]
    monkeypatch.setattr(align, "SEGMENT", 15)
    cut = [align.cut_text(t) for t in docs]
    assert sum(len(c) > 1 for c in cut) > 100
    parts = [align.summary(both.segments(c)) for c in cut]
    assert [w[:5] for w in whole] == [p[:5] for p in parts]


def test_chunks_give_the_ids_of_whole_texts(monkeypatch):
    monkeypatch.setattr(align, "GENERATION", 50)
    rnd = random.Random(2)
    pieces, model = align.SpacedPieces(B), SentencePieceProcessor(model_file=B)
    alphabet = " \n\t\r\x1c\x85▁aAbé日😀.,-'<>0x1\0"
    made = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 30))) for _ in range(3000)]
    for at in range(0, len(made), 10):
        got = [np.frombuffer(x, "<u4").tolist() for x in pieces.encode([" " + t for t in made[at : at + 10]])]
        for text, ids in zip(made[at : at + 10], got, strict=True):
            plain = text.replace("▁", " ")
            if "▁" not in text or plain == text:
                assert ids == model.encode(text), text


def test_pointers_find_components():
    rnd = random.Random(6)
    for _ in range(300):
        size = rnd.randint(1, 60)
        a, b = (np.array(sorted({*rnd.sample(range(1, size + 1), rnd.randint(1, size)), size})) for _ in range(2))
        got = align.align(a, b)
        common = sorted(set(a.tolist()) & set(b.tolist()))
        assert got.a.tolist() == [sum(c < e for c in common) for e in a.tolist()]
        assert got.b.tolist() == [sum(c < e for c in common) for e in b.tolist()]
        starts = lambda x: [0, *x[:-1].tolist()]
        want = [(i, j) for i, (s, e) in enumerate(zip(starts(a), a, strict=True)) for j, (s2, e2) in enumerate(zip(starts(b), b, strict=True)) if s < e2 and s2 < e]
        assert list(zip(got.linked_a.tolist(), got.linked_b.tolist(), strict=True)) == want


def test_sums_in_small_portions(monkeypatch):
    monkeypatch.setattr(align, "PAIRS_AT_ONCE", 6)
    rnd = random.Random(9)
    rows = [np.array(sorted(rnd.sample(range(12), rnd.randint(0, 5))), "<i8") for _ in range(40)]
    times = [np.array([rnd.randint(1, 4) for _ in r], "<i8") for r in rows]
    batch = align.pa.record_batch([align.pa.array([r.tobytes() for r in rows]), align.pa.array([t.tobytes() for t in times])], names=["p", "t"])
    got = Counter()
    for out in align.summed(iter([batch])):
        for p, n in zip(*(c.to_pylist() for c in out.columns), strict=True):
            got[p] += n
    want = Counter()
    for r, t in zip(rows, times, strict=True):
        for p, n in zip(r.tolist(), t.tolist(), strict=True):
            want[p] += n
    assert got == want


def test_empty_tables(spark):
    schema = "doc_id bigint, text string"
    assert align.cross_tokenizer(spark.createDataFrame([], schema), A, B).collect() == []
    got = align.cross_tokenizer(spark.createDataFrame([(1, None), (2, "")], schema), A, B).collect()
    assert {tuple(r) for r in got} == {(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")}
