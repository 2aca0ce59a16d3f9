import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from equigauge.llm import toxicity as tox

TERMS = ["idiot", "scum", "worthless", "pathetic", "mor*", "abcdefgh"]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def slow_lookup(word):
    """The first letter must be right; then the nearest term within its edits."""
    if not word:
        return None
    if word in TERMS:
        return word, 0
    for t in TERMS:
        if t.endswith("*") and word.startswith(t[:-1]):
            return t, 0
    near = [
        (edits(word[1:], t[1:]), t) for t in TERMS
        if not t.endswith("*") and t[0] == word[0] and edits(word[1:], t[1:]) <= tox.edits_allowed(t)
    ]
    return (min(near)[1], min(near)[0]) if near else None


AUTOMATON = tox.LexiconAutomaton(TERMS)


@given(st.sampled_from(TERMS), st.lists(st.tuples(st.integers(0, 9), st.sampled_from("abdiotscumwé_")), max_size=3))
@settings(max_examples=400, deadline=None)
def test_automaton_equals_edit_distance(term, changes):
    word = list(term.rstrip("*"))
    for at, letter in changes:
        at = min(at, len(word))
        if letter == "_":
            del word[at : at + 1]
        elif letter in "abd":
            word.insert(at, letter)
        elif at < len(word):
            word[at] = letter
    word = "".join(word)
    assert AUTOMATON.lookup(word) == slow_lookup(word)


def test_a_reset_of_the_states_changes_nothing(monkeypatch):
    small = tox.LexiconAutomaton(TERMS)
    small.LIMIT = 3
    for word in ["idiot", "idi0t", "wortless", "scum", "morning", "patheticc", "x", "abcdeh"]:
        assert small.lookup(word) == AUTOMATON.lookup(word) == slow_lookup(word)


def test_context_tells_quotation_from_abuse():
    scanner = tox.Scanner(["idiot"])
    abuse = scanner.features("you are an idiot")[0]
    quoted = scanner.features('he wrote the word "idiot" there')[0]
    denied = scanner.features("that man is not idiot at all")[0]
    assert abuse[0] > denied[0] > quoted[0] and quoted[1] > abuse[1]
    assert scanner.features("1d1ot idiiot")[1:] == (2, 1)
    assert tox.quoted_words('a "b c" d\n"e f') == {1, 2}


def made_tables(spark, n=900):
    rnd = random.Random(7)
    clean = [f"plain{i}" for i in range(150)] + ["ziot", "scumbles"]
    bad = ["grobnak", "grobnik", "zwerfulous"]
    docs, labels = [], []
    for i in range(n):
        words = [rnd.choice(clean) for _ in range(rnd.randint(5, 80))]
        toxic = i % 8 == 0
        if toxic:
            for _ in range(3):
                words.insert(rnd.randrange(len(words)), rnd.choice(bad))
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs += [(5000, None), (5001, ""), (5002, "you zwerfulos grobnak"), (None, "grobnak " * 20000), (3, docs[3][1])]
    labels += [(None, 1), (2, None), (77777, 1)]
    return (
        spark.createDataFrame([(0.5, d, t) for d, t in docs], "score double, doc_id bigint, text string").repartition(3),
        spark.createDataFrame(labels, "doc_id bigint, toxic int"),
        docs,
    )


def test_learned_model_finds_held_out_toxic_documents(spark):
    docs, labels, rows = made_tables(spark)
    model = tox.fit(docs, labels)
    got = tox.score(docs, model).collect()
    assert len(got) == len(rows)
    scores = {r.doc_id: r.score for r in got if r.doc_id not in (3, None)}
    held = [d for d in range(900) if zlib.crc32(str(d).encode()) % 5 == 0]
    assert all((scores[d] >= 0.5) == (d % 8 == 0) for d in held if d in scores)
    assert scores[5002] >= 0.5 and scores[5000] == scores[5001] < 0.5
    kept = tox.keep_clean(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.score < 0.5 for r in got)
    again = {(str(r.doc_id), round(r.score, 9)) for r in tox.score(docs, tox.fit(docs.repartition(5), labels)).collect()}
    assert again == {(str(r.doc_id), round(r.score, 9)) for r in got}


def test_held_out_rows_teach_nothing(spark):
    docs, labels, _ = made_tables(spark)
    flag = tox.held_out()
    model = tox.fit(docs, labels)
    flipped = labels.withColumn("toxic", tox.F.when(flag, 1 - labels.toxic).otherwise(labels.toxic))
    other = tox.fit(docs, flipped)
    assert model.terms == other.terms and model.weights == pytest.approx(other.weights)
    found = {r.doc_id: r.h for r in labels.select("doc_id", flag.alias("h")).collect()}
    assert all(h == (d is not None and zlib.crc32(str(d).encode()) % 5 == 0) for d, h in found.items())


def test_without_labels_and_empty_table(spark):
    docs, labels, _ = made_tables(spark, 20)
    model = tox.fit(docs, labels.limit(0))
    one = spark.createDataFrame([(1, "you worthless idiot"), (2, "fine words")], "doc_id bigint, text string")
    scores = {r.doc_id: r.score for r in tox.score(one, model).collect()}
    assert scores[1] >= 0.5 > scores[2]
    assert tox.score(docs.limit(0), model).count() == 0 == tox.keep_clean(docs.limit(0), model).count()


def near_terms(word):
    """Plain edit distance over the whole word."""
    if not word:
        return None
    for t in [t for t in TERMS if t == word] + [t for t in TERMS if t.endswith("*") and word.startswith(t[:-1])]:
        return t, 0
    near = [(edits(word, t), t) for t in TERMS if not t.endswith("*") and edits(word, t) <= tox.edits_allowed(t)]
    return (min(near)[1], min(near)[0]) if near else None


FREE = tox.LexiconAutomaton(TERMS, fixed_first=False)


@given(st.sampled_from(TERMS), st.lists(st.tuples(st.integers(0, 9), st.sampled_from("abdiotscumwé_!@")), max_size=3))
@settings(max_examples=400, deadline=None)
def test_free_first_letter_equals_plain_edit_distance(term, changes):
    word = list(term.rstrip("*"))
    for at, letter in changes:
        at = min(at, len(word))
        if letter == "_":
            del word[at : at + 1]
        elif letter in "abd":
            word.insert(at, letter)
        elif at < len(word):
            word[at] = letter
    word = "".join(word)
    assert FREE.lookup(word) == near_terms(word)


def test_a_reset_for_size_changes_nothing():
    small = tox.LexiconAutomaton(TERMS, fixed_first=False)
    small.PAIRS = 3
    for word in ["diot", "xidiot", "xorthless", "scum", "morning", "atheticc", "x", "bcdefgh", "cdefgh"]:
        assert small.lookup(word) == FREE.lookup(word) == near_terms(word)


def test_scanner_finds_wrong_first_letters_and_marks():
    scanner = tox.Scanner(tox.SEED_TERMS)
    for text in ["xdiot", "diot", "xworthless", "id!ot", "st@pid", "@sshole", "id_ot", "worth-l!ss", "(id!ot)", "fine/id!ot,fine", "w0rthl@ss"]:
        assert scanner.features(f"such {text} here")[1:] == (1, 1), text
    assert scanner.features("an idiot-like, stupid/moron a.b.c")[1:] == (3, 0)
    assert scanner.features('id"iot st pid id ! ot id://ot')[1:] == (0, 0)
    words, found = scanner.find("one two-three id!ot four")
    assert words == ["one", "two", "three", "id", "ot", "four"] == tox.WORD.findall("one two-three id!ot four")
    assert found == {3: ("id!ot", ("idiot", 1))}
    assert scanner.features("a!" * 50_000 + "b" * 100_000)[1] == 0


def test_documents_with_misspelled_terms_only_do_not_pass(spark):
    docs, labels, _ = made_tables(spark)
    model = tox.fit(docs, labels)
    odd = spark.createDataFrame([(1, "you werfulous xwerfulous"), (2, "you zwer!ulous zwerful@us"), (3, "plain1 plain2")], "doc_id bigint, text string")
    scores = {r.doc_id: r.score for r in tox.score(odd, model).collect()}
    assert min(scores[1], scores[2]) >= 0.5 > scores[3]


def test_words_that_a_stem_covers_keep_their_edits(spark):
    docs, labels, _ = made_tables(spark)
    model = tox.fit(docs, labels)
    assert {"grobnak", "grobnik"} <= set(model.terms) and any(t.endswith("*") and "grobnak".startswith(t[:-1]) for t in model.terms)
    scanner = tox.Scanner(model.terms, model.harmless)
    assert scanner.hit("gobnak") == scanner.hit("grabnak") == ("grobnak", 1) and scanner.hit("gobnik") == ("grobnik", 1)
    assert scanner.hit("grobnak") == ("grobnak", 0) and scanner.hit("grobnok")[1] == 0
