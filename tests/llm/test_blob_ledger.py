import hashlib
import random
import re
from dataclasses import replace

import pytest

from equigauge.llm import blob_ledger as bl

DOCS = "doc_id bigint, text string, blob int, spans string, key string"


def slow_base(text: str | None) -> list[tuple]:
    """Base spans as the contract words them, on the text itself."""
    text = text or ""
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    out = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def made_rows() -> list[tuple]:
    rnd = random.Random(4)
    key = "AKIA" + "ABCD1234" * 2
    parts = [
        "password=hunter2x", "PassWord : 'abc'", 'api_key="Zm9vYmFy"', "apikey = a.b=c/d", "to\u212aen=abcdefgh", "\u017fecret=abcdefgh", "token token=xxxxxx",
        key, key + "9", "AKIASHORT", "AKIA" * 6, "d41d8cd98f00b204e9800998ecf8427e", "deadbeef" * 3, "deadbeef" * 2 + "dead", "é😀ß", "secret:   =oops",
        "-----BEGIN RSA PRIVATE KEY-----\nMIIabc+/=\n-----END RSA PRIVATE KEY-----", "-----BEGIN PRIVATE KEY----- cut", "https://me:hunter2@example.com/x",
        "eyJhbGciOiJI.eyJzdWIiOiIx.abc_DEF", "ghp_" + "a1B2" * 9, "xoxb-123456789012-abc", "Bearer abcdefghijklmnop==", "api keys of tokens", "\n", "?", "passwd?=abcdef",
    ]
    rows = [(None, None), (1, ""), (2, None), (3, "x" * 200_000 + "password=abcdefg"), (None, key)]
    rows += [(10 + i, rnd.choice((" ", "", ", ")).join(rnd.choice(parts) for _ in range(rnd.randint(1, 25)))) for i in range(300)]
    return rows + [(5000 + i, rows[10][1]) for i in range(40)] + rows[20:25] * 2


def test_base_spans_equal_brute_force(spark):
    rows = made_rows()
    table = spark.createDataFrame([(d, t, 1, "x", "y") for d, t in rows], DOCS)
    got = bl.digest(bl.find_secrets(table)).collect()
    assert len(got) == len(rows)
    want = []
    for d, text in rows:
        base = slow_base(text)
        line = ",".join(f"{k}:{s}:{e}" for s, _, k, e in base)
        counts = [sum(x[2] == k for x in base) for k in ("assign", "access", "hex")]
        want.append((str(d), *counts, hashlib.sha256(line.encode()).hexdigest(), line))
    base_of = lambda spans: ",".join(x for x in spans.split(",") if x.split(":")[0] in ("assign", "access", "hex"))
    assert sorted((str(r.doc_id), r.n_assign, r.n_access, r.n_hex, r.base_sha256, base_of(r.spans)) for r in got) == sorted(want)


def test_further_kinds_are_added(spark):
    text = "see https://me:hunter2@example.com/x and ghp_" + "a1B2" * 9 + "\n-----BEGIN EC PRIVATE KEY-----\nMIIa\n-----END EC PRIVATE KEY-----"
    got = bl.digest(bl.find_secrets(spark.createDataFrame([(1, text)], "doc_id bigint, text string"))).first()
    kinds = [s.split(":")[0] for s in got.spans.split(",")]
    assert kinds == ["url_login", "code_host", "private_key"]
    for kind, start, end in (s.split(":") for s in got.spans.split(",")):
        cut = text[int(start) : int(end)]
        assert cut.startswith({"url_login": "https://me", "code_host": "ghp_", "private_key": "-----BEGIN"}[kind])
    assert text.endswith("KEY-----") and end == str(len(text))


def runs(spark, path):
    return spark.read.schema(bl.LEDGER + ", run string").parquet(path)


def test_only_unseen_pairs_are_scanned(spark, tmp_path):
    path = f"{tmp_path}/ledger"
    first = [("a", "password=abcdef"), ("b", "nothing"), ("c", "password=abcdef")]
    table = spark.createDataFrame(first, "doc_id string, text string")
    shown = {r.key: [s.kind for s in r.spans] for r in bl.find_secrets(table, path).collect()}
    assert shown == {"a": ["assign"], "b": [], "c": ["assign"]}
    assert runs(spark, path).count() == 2  # a and c share a blob

    later = spark.createDataFrame([*first, ("a", "token: 123456"), ("d", "nothing")], "doc_id string, text string")
    assert bl.find_secrets(later, path).count() == 5
    assert runs(spark, path).count() == 3  # one new blob

    bl.find_secrets(later, path).count()
    assert runs(spark, path).count() == 3

    changed = [replace(r, version=2, least=9) if r.kind == "assign" else r for r in bl.RULES]
    shown = bl.find_secrets(later, path, changed).collect()
    assert all(r.spans == [] for r in shown)  # the older version's findings are not shown
    new = runs(spark, path).where("array_contains(rules, 'assign@2')")
    assert new.count() == 3 and {tuple(r.rules) for r in new.collect()} == {("assign@2",)}


def test_blobs_scanned_twice_count_once(spark, tmp_path):
    path = f"{tmp_path}/ledger"
    table = spark.createDataFrame([(1, "password=abcdef")] * 3, "doc_id bigint, text string")
    bl.find_secrets(table, path).count()
    runs(spark, path).drop("run").write.parquet(f"{path}/run=again")  # another run wrote the same
    got = bl.digest(bl.find_secrets(table, path)).collect()
    assert [(r.n_assign, r.spans) for r in got] == [(1, "assign:0:15")] * 3


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert bl.digest(bl.find_secrets(empty)).collect() == []


@pytest.mark.parametrize("rule", bl.RULES, ids=lambda r: r.kind)
def test_no_rule_accepts_what_stands_for_other_code_points(rule):
    assert not [m for m in re.finditer(rule.pattern, b"?" * 200) if m.end() - m.start() >= max(1, rule.least)]


def test_rule_names_are_distinct():
    assert len({r.kind for r in bl.RULES}) == len(bl.RULES)
