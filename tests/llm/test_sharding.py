import struct
import zlib
from collections import Counter, defaultdict

import xxhash

from equigauge.llm import sharding


def test_shards_are_even_gapless_and_keep_the_mixture(spark):
    rows = [(i, f"text {i}" if i % 5 else None, "big" if i % 3 else f"s{i % 7}") for i in range(3000)]
    rows += [(None, "", None), (None, "", None), (7, "dup", None), (7, "dup", None)]
    docs = spark.createDataFrame([(s, d, t, 1) for d, t, s in rows], "source string, doc_id bigint, text string, shard int").repartition(5)
    got = sharding.shard_documents(docs, 24).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32, r.source) for r in got) == Counter(
        (d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), s) for d, t, s in rows
    )
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r.slot for r in got if r.shard == s) == list(range(n))
    for source, total in Counter(s for _, _, s in rows).items():
        per = Counter(r.shard for r in got if r.source == source)
        assert all(abs(per[s] - total / 24) <= 2 for s in range(24))


def test_order_is_random_and_fixed_by_the_seed(spark):
    docs = spark.createDataFrame([(i, "t", "a") for i in range(500)], "doc_id bigint, text string, source string")

    def places(df, seed):
        return {r.doc_id: (r.shard, r.slot) for r in sharding.shard_documents(df, 4, seed).collect()}

    first = places(docs, 1)
    assert first == places(docs.repartition(7), 1)
    assert first != places(docs, 2)
    in_first = [d for d, (s, _) in first.items() if s == 0]
    assert min(in_first) < 50 and max(in_first) > 450


def test_few_rows_empty_table_and_written_shards(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "doc_id bigint, text string, source string")
    placed = sharding.shard_documents(docs, 24)
    rows = placed.collect()
    assert len({r.shard for r in rows}) == 2 and {r.slot for r in rows} == {0}
    assert sharding.shard_documents(docs.limit(0), 24).count() == 0
    sharding.write_shards(docs, placed, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == 2


def hashed(seed, *values):
    """XXH64 over the values one after the other, each the seed of the next; nulls are passed over."""
    h = 42
    for v in (struct.pack("<i", seed), *(struct.pack("<q", v) if isinstance(v, int) else v for v in values)):
        h = xxhash.xxh64(v, seed=h).intdigest() if v is not None else h
    return h


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def plain_shards(rows, shards, seed=7):
    """Fractional ranks by sorting everything: (doc_id, size, crc, source, shard, slot) per row."""
    strata = defaultdict(list)
    for doc_id, text, source in rows:
        data = (text or "").encode()
        key = doc_id, len(data) + 8, zlib.crc32(data)
        strata["" if source is None else "=" + source].append((hashed(seed, *key), tuple((k is not None, k or 0) for k in key), key, source))
    ranked = []
    for stratum, members in strata.items():
        phase = (hashed(seed + 1, stratum.encode()) >> 11) / float(1 << 53)
        for rank, (draw, order, key, source) in enumerate(sorted(members, key=lambda m: m[:2])):
            ranked.append(((rank + phase) / len(members), signed(draw), order, key, source))
    n, out = len(ranked), []
    for place, (_, _, _, key, source) in enumerate(sorted(ranked, key=lambda r: r[:3])):
        shard = place * shards // n
        out.append((*key, source, shard, place - -(-shard * n // shards)))
    return out


def test_places_equal_one_plain_sort(spark):
    rows = [(i % 900, f"text {i % 450}" * (i % 4), ["hot", "hot", "x", None, f"s{i % 40}"][i % 5]) for i in range(2500)]
    rows += [(None, None, "hot"), (None, "", "x"), (5, "long " * 100_000, "x"), (2**40, "é", "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(6)
    small = sharding.interleave(keys_of(docs), "source", ["doc_id", "size", "text_crc32"], 24, rows_per_bucket=50)
    want = Counter(plain_shards(rows, 24))
    assert Counter(map(tuple, small.collect())) == want
    assert Counter(map(tuple, sharding.shard_documents(docs, 24).collect())) == want


def keys_of(docs):
    return sharding.shard_documents(docs, 1).drop("shard", "slot")


def test_written_shards_keep_columns_of_the_same_names(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"t{i}", "x", -i, "mine", 7) for i in range(50)], "doc_id bigint, text string, source string, Shard int, slot string, placed_id int")
    sharding.write_shards(docs, sharding.shard_documents(docs, 3), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert set(back.columns) == {"doc_id", "text", "source", "own_Shard", "own_slot", "placed_id", "shard", "slot"}
    assert {(r.doc_id, r.own_Shard, r.own_slot, r.placed_id) for r in back.collect()} == {(i, -i, "mine", 7) for i in range(50)}
    assert {r.shard for r in back.collect()} == {0, 1, 2}
