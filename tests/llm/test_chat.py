import json

from equigauge.llm import chat

SCHEMAS = {
    "add": {
        "type": "object",
        "properties": {"a": {"type": "integer", "minimum": 0}, "b": {"type": ["integer", "null"]}, "tags": {"type": "array", "items": {"enum": ["x", "y"]}}},
        "required": ["a"],
        "additionalProperties": False,
    }
}
CALLS = "call_id string, place bigint, name string, arguments string, parent_id string"
RESULTS = "call_id string, place bigint, content string"


def linked(spark, calls, results):
    rows = chat.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), SCHEMAS).collect()
    return {(r.call_id, r.place, r.result_place): r for r in rows}


def test_statuses_errors_and_canonical_form(spark):
    calls = [
        ("c1", 1, "add", '{"b": null,  "a": 1}', None),
        ("c2", 2, "add", '{"a": -1, "z": 0}', "c1"),
        ("c3", 3, "add", "{not json", "c2"),
        ("c4", 4, "sub", "{}", "gone"),
        ("c1", 9, "add", '{"a": 2}', None),
        ("c5", 5, "add", '{"tags": ["x", "q"], "a": true}', "c3"),
        ("c5", 5, "add", '{"tags": ["x", "q"], "a": true}', "c3"),
        (None, 6, "add", '{"a": 1}', None),
        ("c6", 7, "add", None, None),
        ("c7", 8, "add", '{"a": NaN}', None),
    ]
    results = [("c1", 2, "é\n"), ("c1", 7, "late"), ("c2", 3, None), ("none", 1, "x"), (None, 4, "y")]
    got = linked(spark, calls, results)
    assert len(got) == 12
    first = got["c1", 1, 2]
    assert (first.status, first.errors, first.depth) == ("linked", None, 0)
    assert first.record == '{"arguments":{"a":1,"b":null},"id":"c1","name":"add","result":"é\\n"}'
    second = got["c2", 2, 3]
    assert (second.status, second.errors, second.depth) == ("linked", "arguments.a: less than 0; arguments.z: not allowed", 1)
    assert json.loads(second.record)["result"] is None
    assert (got["c3", 3, None].errors, got["c3", 3, None].record) == ("arguments: no JSON", None)
    assert (got["c4", 4, None].errors, got["c4", 4, None].depth) == ("name: unknown tool", 0)
    assert got["c1", 9, None].status == "duplicate" and got["c1", None, 7].status == "duplicate"
    assert got["c5", 5, None].depth == 3
    assert got["c5", 5, None].call_rows == 2 and (first.call_rows, first.result_rows) == (1, 1)
    assert got["c5", 5, None].errors == "arguments.a: not of type integer; arguments.tags[1]: not one of the allowed values"
    assert got[None, 6, None].status == "unanswered" and got[None, None, 4].status == "orphan"
    assert got["none", None, 1].status == "orphan"
    assert got["c6", 7, None].errors == "arguments: no JSON" == got["c7", 8, None].errors


def test_long_chains_forks_and_rings(spark):
    chain = [(f"k{i}", i, "add", "{}", f"k{i - 1}" if i else None) for i in range(70)]
    fork = [(f"f{i}", i, "add", "{}", "k69") for i in range(20)]
    ring = [("r0", 0, "add", "{}", "r2"), ("r1", 1, "add", "{}", "r0"), ("r2", 2, "add", "{}", "r1"), ("tail", 3, "add", "{}", "r1"), ("self", 4, "add", "{}", "self")]
    got = {r.call_id: r.depth for r in linked(spark, chain + fork + ring, []).values()}
    assert [got[f"k{i}"] for i in range(70)] == list(range(70))
    assert all(got[f"f{i}"] == 70 for i in range(20))
    assert [got[k] for k in ("r0", "r1", "r2", "tail", "self")] == [None] * 5


def test_conversations_and_empty_tables(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", ""), (1, 2, "assistant", "a"), (1, 3, "user", None), (2, 0, "assistant", "lone"), (None, 1, "user", "u")]
    messages = spark.createDataFrame([(*r, 0) for r in rows], "conv_id bigint, turn int, role string, text string, call_id int")
    out = {(r.call_id, r.status): r for r in chat.link(*chat.conversation_calls(messages), chat.REPLY_SCHEMA).collect()}
    assert out["1:1", "linked"].errors == "arguments.prompt: shorter than 1"
    assert (out["1:3", "unanswered"].errors, out["1:3", "unanswered"].depth) == ("arguments.prompt: missing", 1)
    assert out["2:-1", "orphan"].record == '{"id":"2:-1","result":"lone"}'
    assert (None, "unanswered") in out
    assert chat.link(*chat.conversation_calls(messages.limit(0)), chat.REPLY_SCHEMA).count() == 0


def test_every_turn_appears_once(spark):
    rows = [
        (1, 0, "system", "s\n"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (1, 3, "tool", None), (1, 4, "User", "case"), (1, 5, None, "n"),
        (1, 6, "function", "f"), (1, 6, "function", "f"), (None, None, "system", "x"), (2, 0, "assistant", "lone"), (2, 3, "user", "late"),
    ]
    messages = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    out = chat.all_turns(messages).collect()
    others = sorted((r.status, r.record) for r in out if r.status not in ("linked", "unanswered", "orphan", "duplicate"))
    assert [s for s, _ in others] == ["no_role", "other_role", "other_role", "other_role", "system", "system", "tool"]
    assert ("system", '{"content":"s\\n","id":"1:0","role":"system","turn":0}') in others
    assert ("tool", '{"content":null,"id":"1:3","role":"tool","turn":3}') in others
    assert ("system", '{"content":"x","id":null,"role":"system","turn":null}') in others
    assert len(others) + sum((r.place is not None) + (r.result_place is not None) for r in out if r.status in ("linked", "unanswered", "orphan")) == len(rows)
    assert chat.all_turns(messages.limit(0)).count() == 0


def test_turns_without_a_place_keep_their_text(spark):
    rows = [("c", None, "user", "lost text"), ("c", None, "user", "lost text"), ("d", 1, "assistant", None), ("d", None, "assistant", "said")]
    out = chat.all_turns(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")).collect()
    (call,) = [r for r in out if r.call_rows]
    assert (call.status, call.call_rows, call.errors) == ("unanswered", 2, "arguments.turn: missing")
    assert json.loads(call.record)["arguments"] == {"prompt": "lost text"}
    assert sorted((r.status, r.record) for r in out if r.result_rows) == [("orphan", '{"id":"d:0","result":null}'), ("orphan", '{"id":null,"result":"said"}')]


def test_hot_identifiers_and_repeated_rows_keep_their_counts(spark):
    rows = [(1, 1, "user", f"q{i % 50}") for i in range(500)] + [(1, 2, "assistant", "a")] * 300 + [(2, 1, "user", "x" * 100_000)]
    out = chat.all_turns(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")).collect()
    assert sum(r.call_rows or 0 for r in out) == 501 and sum(r.result_rows or 0 for r in out) == 300
    assert sorted(r.status for r in out) == ["duplicate"] * 49 + ["linked", "unanswered"]
    assert any(r.errors == "arguments.prompt: longer than 1000" and len(r.record) > 100_000 for r in out)


def test_turns_of_the_given_table_are_all_there(spark):
    messages = spark.read.parquet("/root/testdata/sf0.1/conversations.parquet")
    rows = "coalesce(call_rows, 0) + coalesce(result_rows, 0) + cast(call_rows is null and result_rows is null as int) as n"
    out = chat.all_turns(messages).selectExpr(rows).groupBy().sum("n").first()[0]
    assert messages.where("role NOT IN ('user', 'assistant')").count() > 0 and out == messages.count()
