"""Tool-call linking: calls and their results, in order, checked and in canonical JSON.

Calls and results meet in a hash join on the call's identifier. An identifier
belongs to one call, the first by place, and to one result, the first by place; a
hash of the row decides among equal places. Only identifiers, places and hashes
are compared for that, and the minima are combined before the shuffle, so a hot
identifier costs no task more than others, and the join is one to one. Rows that
lose are few as a rule, are told by their keys, are kept and say so. Texts are
shuffled twice: to melt equal rows, and to meet.

A call may wait for another one (``parent_id``). The topological position is the
number of calls that must be done before, found by pointer doubling: each round
doubles the stretch a call looks back, so a chain of a million calls takes twenty
rounds. Calls that wait for themselves in a ring have no position.

Arguments are parsed, checked against the schema of the tool, and written with
sorted keys and no spaces, and so is the whole linked record.

Status of a row: ``linked``, ``unanswered`` (a call without result), ``orphan`` (a
result without call), ``duplicate`` (a call or result whose identifier belongs to
another). Defined results: a row with a null identifier is unanswered or orphan;
a null or malformed text of arguments is an error and has no canonical form; a
null content is JSON null. A parent that is no call counts as none. Equal rows
are one row. Empty tables give no rows.

Of a conversation only user and assistant turns are calls and results.
``all_turns`` adds every other turn, one row each, with a status of its own:
``system``, ``tool``, ``no_role`` (null) or ``other_role``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equigauge.llm.common import arrow_schema
from equigauge.session import materialize

KINDS = {
    "string": lambda v: isinstance(v, str),
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool),
    "number": lambda v: isinstance(v, int | float) and not isinstance(v, bool),
    "boolean": lambda v: isinstance(v, bool),
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "null": lambda v: v is None,
}


def check_value(value: object, schema: dict, path: str) -> list[str]:
    """What is wrong with a value, by the usual keywords of JSON schemas."""
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(KINDS[k](value) for k in kinds):
        return [f"{path}: not of type {' or '.join(kinds)}"]
    errors = []
    if "enum" in schema and value not in schema["enum"]:
        errors.append(f"{path}: not one of the allowed values")
    if isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            errors.append(f"{path}: shorter than {schema['minLength']}")
        if "maxLength" in schema and len(value) > schema["maxLength"]:
            errors.append(f"{path}: longer than {schema['maxLength']}")
    elif KINDS["number"](value):
        if "minimum" in schema and value < schema["minimum"]:
            errors.append(f"{path}: less than {schema['minimum']}")
        if "maximum" in schema and value > schema["maximum"]:
            errors.append(f"{path}: more than {schema['maximum']}")
    elif isinstance(value, list):
        for i, item in enumerate(value):
            errors += check_value(item, schema.get("items", {}), f"{path}[{i}]")
    elif isinstance(value, dict):
        known = schema.get("properties", {})
        errors += [f"{path}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in known:
                errors += check_value(value[k], known[k], f"{path}.{k}")
            elif schema.get("additionalProperties", True) is False:
                errors.append(f"{path}.{k}: not allowed")
    return errors


def canonical(value: object) -> str:
    """Sorted keys, no spaces, characters as they are."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def no_constant(name: str) -> None:
    raise ValueError(f"{name} is no JSON")


def positions(calls: DataFrame) -> DataFrame:
    """Calls before each call: call_id, depth (null in or behind a ring). ``calls``: call_id (unique), parent_id."""
    known = calls.select(F.col("call_id").alias("parent_id"), F.lit(True).alias("is_call"))
    state = calls.select("call_id", "parent_id").join(known, "parent_id", "left")
    # at: the call looked back to, null at the front; depth: steps taken so far
    at = F.when(F.col("is_call"), F.col("parent_id"))
    state = state.select("call_id", at.alias("at"), F.when(at.isNotNull(), 1).otherwise(0).cast("bigint").alias("depth"))
    state = materialize(state, "call-order")
    # a round that gets no call to its front leaves only rings and what waits for them
    n, before = state.where("at IS NOT NULL").count(), None
    while n and n != before:
        back = state.select(F.col("call_id").alias("at"), F.col("at").alias("next_at"), F.col("depth").alias("more"))
        state = state.join(back, "at", "left").select("call_id", F.col("next_at").alias("at"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"))
        state = materialize(state, "call-order")
        n, before = state.where("at IS NOT NULL").count(), n
    return state.select("call_id", F.when(F.col("at").isNull(), F.col("depth")).alias("depth"))


def melted(rows: DataFrame, count: str, name: str) -> DataFrame:
    """Equal rows as one with their number, and a hash of the row; written once."""
    own = rows.columns[1:]
    keyed = rows.withColumn("hash", F.md5(F.to_json(F.struct(*own), {"ignoreNullFields": "false"})))
    found = keyed.groupBy("call_id", "hash").agg(*[F.first(c).alias(c) for c in own], F.count(F.lit(1)).alias(count))
    return materialize(found, name)


def owners(rows: DataFrame, place: str) -> tuple[DataFrame, DataFrame]:
    """The rows that their identifiers belong to, and the others. Only keys are compared."""
    keys = rows.where("call_id IS NOT NULL").select("call_id", place, "hash")
    first = keys.groupBy("call_id").agg(F.min(F.struct(place, "hash")).alias("owner"))
    lost = keys.join(first, "call_id").where(F.col("hash") != F.col("owner.hash")).select("call_id", "hash")
    lost = materialize(lost, "lost-keys")
    owned = rows.where("call_id IS NOT NULL").join(lost, ["call_id", "hash"], "left_anti").drop("hash")
    others = rows.join(lost, ["call_id", "hash"], "left_semi").unionByName(rows.where("call_id IS NULL"))
    return owned, others.drop("hash")


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """Linked records.

    ``calls``: call_id, place, name, arguments (JSON text), parent_id.
    ``results``: call_id, place, content.
    Returns call_id, place, result_place, name, parent_id, depth, status, call_rows, result_rows, errors, record.
    """
    calls = melted(calls.select("call_id", "place", "name", "arguments", "parent_id"), "call_rows", "calls")
    results = melted(results.select("call_id", F.col("place").alias("result_place"), "content"), "result_rows", "results")
    owned_calls, lost_calls = owners(calls, "place")
    owned_results, lost_results = owners(results, "result_place")
    order = positions(owned_calls.select("call_id", "parent_id"))
    both = owned_calls.withColumn("is_call", F.lit(True)).join(owned_results, "call_id", "full_outer")
    status = F.when(F.col("is_call").isNull(), "orphan").when(F.col("result_rows").isNotNull(), "linked").otherwise("unanswered")
    linked = both.join(order, "call_id", "left").withColumn("status", status)
    lost_calls = lost_calls.withColumns(
        {"status": F.when(F.col("call_id").isNull(), "unanswered").otherwise("duplicate"), "is_call": F.lit(True)}
    )
    lost_results = lost_results.withColumn("status", F.when(F.col("call_id").isNull(), "orphan").otherwise("duplicate"))
    rows = linked.unionByName(lost_calls, allowMissingColumns=True).unionByName(lost_results, allowMissingColumns=True)
    fields = "call_id string, place bigint, result_place bigint, name string, parent_id string, depth bigint, status string, "
    fields += "call_rows bigint, result_rows bigint, errors string, record string"
    schema = arrow_schema(fields)
    carried = ["call_id", "place", "result_place", "name", "parent_id", "depth", "status", "call_rows", "result_rows"]

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            errors, records = [], []
            for row in batch.to_pylist():
                if not row["is_call"]:
                    errors.append(None)
                    records.append(canonical({"id": row["call_id"], "result": row["content"]}))
                    continue
                try:
                    arguments = json.loads(row["arguments"] or "", parse_constant=no_constant)
                except ValueError:
                    errors.append("arguments: no JSON")
                    records.append(None)
                    continue
                wrong = check_value(arguments, schemas[row["name"]], "arguments") if row["name"] in schemas else ["name: unknown tool"]
                errors.append("; ".join(wrong) or None)
                records.append(canonical({"arguments": arguments, "id": row["call_id"], "name": row["name"], "result": row["content"]}))
            columns = [batch[c] for c in carried] + [pa.array(errors, pa.string()), pa.array(records, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    typed = rows.select(*[F.col(c).cast(f.dataType) for c, f in zip(carried, _types(fields), strict=False)], "arguments", "content", "is_call")
    return typed.mapInArrow(check, fields)


def _types(fields: str):
    from equigauge.llm.common import schema_of

    return schema_of(fields).fields


#: Conversations as calls: a user's turn asks the tool "reply" for the next turn.
REPLY_SCHEMA = {
    "reply": {
        "type": "object",
        "properties": {
            "prompt": {"type": "string", "minLength": 1, "maxLength": 1000},
            "turn": {"type": "integer", "minimum": 0},
        },
        "required": ["prompt", "turn"],
        "additionalProperties": False,
    }
}


def conversation_calls(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """User turns as calls and assistant turns as their results; a call waits for the user's turn before."""

    def ident(turn):
        return F.concat(F.col("conv_id").cast("string"), F.lit(":"), turn.cast("string"))

    turn = F.col("turn").cast("bigint")
    calls = messages.where("role = 'user'").select(
        ident(turn).alias("call_id"),
        turn.alias("place"),
        F.lit("reply").alias("name"),
        F.to_json(F.struct(F.col("text").alias("prompt"), turn.alias("turn"))).alias("arguments"),
        F.when(turn >= 2, ident(turn - 2)).alias("parent_id"),
    )
    results = messages.where("role = 'assistant'").select(ident(turn - 1).alias("call_id"), turn.alias("place"), F.col("text").alias("content"))
    return calls, results


def other_turns(messages: DataFrame) -> DataFrame:
    """Turns that ``conversation_calls`` leaves out, in the columns of ``link``: one row each, the text in the record."""
    role, turn = F.col("role").cast("string"), F.col("turn").cast("bigint")
    status = F.when(role.isin("system", "tool"), role).when(role.isNull(), "no_role").otherwise("other_role")
    rows = messages.where("role IS NULL OR role NOT IN ('user', 'assistant')").select(
        F.concat(F.col("conv_id").cast("string"), F.lit(":"), turn.cast("string")).alias("call_id"),
        turn.alias("place"),
        status.alias("status"),
        role.alias("role"),
        F.col("text").cast("string").alias("content"),
    )
    fields = "call_id string, place bigint, status string, record string"
    schema = arrow_schema(fields)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            records = [canonical({"content": r["content"], "id": r["call_id"], "role": r["role"], "turn": r["place"]}) for r in batch.to_pylist()]
            columns = [batch[c] for c in ("call_id", "place", "status")] + [pa.array(records, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return rows.mapInArrow(write, fields)


def all_turns(messages: DataFrame) -> DataFrame:
    """Linked records of a conversation's calls and results, and every other turn."""
    linked = link(*conversation_calls(messages), REPLY_SCHEMA)
    return linked.unionByName(other_turns(messages), allowMissingColumns=True)
