import random
import re

from equigauge.llm import decontam


def slow(docs, items, size=5):
    def words_of(text):
        return re.findall(r"[^\W_]+", (text or "").lower())

    out = []
    for item, item_text in items:
        words = words_of(item_text)
        n = min(size, len(words))  # a short item is one shingle of its own length
        wanted = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()
        for doc, text in docs:
            own = words_of(text)
            found = [tuple(own[i : i + n]) for i in range(len(own) - n + 1)]
            both = wanted & set(found)
            if wanted and len(both) * 10 >= 8 * len(wanted):
                places = [i for i, s in enumerate(found) if s in both]
                out.append((doc, item, len(wanted), len(both), min(places), max(places) + n - 1))
    return out


def made():
    rnd = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([3, 5, 9, 14, 30, 70])))) for i in range(60)]
    items += [(100, None), (101, ""), (102, "!!"), (103, "lone"), (104, items[3][1]), (None, items[5][1]), (105, "the cat sat on the mat " * 5)]
    docs = [(900, None), (901, ""), (902, "Lone!"), (903, "a lone word"), (904, "x " * 5000 + (items[7][1] or "") + " y" * 5000)]
    for i in range(250):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 300))]
        if i % 3 == 0:
            item = items[i % 60][1].split()
            for _ in range(rnd.choice([0, 0, 1, 2, 4])):
                item[rnd.randrange(len(item))] = "altered"
            at = rnd.randrange(len(words) + 1)
            words[at:at] = [w.upper() + rnd.choice(["", ",", "."]) for w in item]
        docs.append((i, rnd.choice([" ", "\n", "  "]).join(words)))
    docs += [(None, items[9][1]), (2, docs[7][1]), (2, docs[7][1])]
    return docs, items


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(t, 7, d) for d, t in docs], "text string, item_id int, doc_id bigint").repartition(4),
        spark.createDataFrame([(i, t) for i, t in items], "item_id bigint, text string"),
    )


def test_leaks_equal_brute_force_whatever_the_blocks(spark):
    docs, items = made()
    df, bench = frames(spark, docs, items)
    key = lambda r: tuple(str(x) for x in r)
    want = sorted(map(key, slow(docs, items)))
    assert len(want) > 30
    for block in (decontam.BLOCK_BYTES, 1000):
        assert sorted(map(key, decontam.leaks(df, bench, block_bytes=block).collect())) == want


def test_contaminated_rows_go(spark):
    docs, items = made()
    df, bench = frames(spark, docs, items)
    dirty = {(str(d[0])) for d in slow(docs, items)}
    want = sorted(str(d) for d, _ in docs if str(d) not in dirty)
    kept = decontam.drop_contaminated(df, bench, block_bytes=1000)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == want


def test_empty_tables(spark):
    docs, items = made()
    df, bench = frames(spark, docs, items)
    assert decontam.leaks(df.limit(0), bench).count() == 0
    assert decontam.leaks(df, bench.limit(0)).count() == 0
    assert decontam.drop_contaminated(df, bench.limit(0)).count() == df.count()


def test_short_items_inside_long_documents(spark):
    docs = [(1, "before " * 500 + "alpha, Beta gamma" + " after" * 500), (2, "alpha beta"), (3, "alpha beta delta gamma"), (4, "x ALPHA\nbeta\ngamma")]
    df, bench = frames(spark, docs, [(1, "alpha beta gamma"), (2, "lone")])
    got = decontam.leaks(df, bench).collect()
    assert sorted((r.doc_id, r.item_id, r.first_word, r.last_word) for r in got) == [(1, 1, 500, 502), (4, 1, 1, 3)]
    assert {r.doc_id for r in decontam.drop_contaminated(df, bench).collect()} == {2, 3}
