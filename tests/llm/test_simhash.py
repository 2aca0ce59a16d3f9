import random

import xxhash

from equigauge.llm import simhash


def slow_fingerprint(text: str | None) -> int:
    raw = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", raw) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def slow_components(rows: list[tuple], max_bits: int = 3) -> list[tuple]:
    fps = [slow_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    for _ in rows:
        before = list(label)
        for i in range(len(rows)):
            near = [label[j] for j in range(len(rows)) if (fps[i] ^ fps[j]).bit_count() <= max_bits]
            label[i] = min(near)
        if label == before:
            break
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        out.append((d, fps[i], min(ids, default=None)))
    return out


def made_rows() -> list[tuple]:
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(300)] + ["É", "Àb", "x\x1cy", "z\xa0z"]
    rows: list[tuple] = [(900, None), (901, ""), (902, " \t\n"), (903, "one"), (904, "One TWO"), (None, "one"), (905, "É é")]
    for i in range(60):
        text = [rnd.choice(words) for _ in range(rnd.randint(3, 400))]
        rows.append((i, " ".join(text)))
        if i % 4 == 0:
            rows.append((1000 + i, " ".join(text).upper().replace("É", "é") if i % 8 else " ".join(text)))
            for k in range(2):
                text[rnd.randrange(len(text))] = "changed"
                rows.append((2000 + 10 * i + k, "  ".join(text)))
    rows.append((0, rows[7][1]))
    return rows


def test_components_equal_brute_force(spark):
    rows = made_rows()
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id bigint, text string, fp int")
    got = simhash.near_duplicates(docs).select("doc_id", "fp", "component_id").collect()
    key = lambda r: tuple(str(x) for x in r)
    want = [(d, fp - 2**64 if fp >= 2**63 else fp, c) for d, fp, c in slow_components(rows)]
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_links_hold_every_close_pair(spark):
    rnd = random.Random(9)
    base = [rnd.getrandbits(64) for _ in range(20)]
    fps = set(base)
    for b in base[:6]:
        for _ in range(40):
            x = b
            for _ in range(rnd.randint(1, 4)):
                x ^= 1 << rnd.randrange(64)
            fps.add(x)
    df = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp bigint")
    for blocks, crowd in ((5, 30), (6, 4096)):
        found = [(r.a, r.b) for r in simhash.links(df, crowd=crowd, blocks=blocks).collect()]
        root = {simhash.signed(f): simhash.signed(f) for f in fps}

        def top(x, root=root):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in found:
            assert ((a ^ b) & (2**64 - 1)).bit_count() <= 3
            root[top(a)] = top(b)
        for f in fps:
            for g in fps:
                if (f ^ g).bit_count() <= 3:
                    assert top(simhash.signed(f)) == top(simhash.signed(g))


def test_keep_one(spark):
    rows = [*made_rows(), (None, "text of its own without an id"), (None, "another one that has no id"), (None, "another one that has no id")]
    docs = spark.createDataFrame([(t, d, "x") for d, t in rows], "text string, doc_id bigint, component_id string")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    want = sorted({c for _, _, c in slow_components(rows) if c is not None})
    got = kept.collect()
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == want
    assert sorted(r.text for r in got if r.doc_id is None) == ["another one that has no id", "text of its own without an id"]


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.keep_one(docs).count() == 0


def test_kept_rows_with_clashing_names(spark):
    rows = [(1, "a b c d", 0, "x", 5, 6), (2, "a b c d", 1, "y", 5, 6), (3, "quite another text here", 2, "z", 5, 6), (1, "a b c d", 0, "x", 5, 6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, kept_id int, KEPT_HASH string, label int, n int")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.collect()) == [rows[0], rows[2]]
