"""Chat formatting: tool calls linked to their results, put in order, checked, and written as canonical JSON.

An assistant message whose text is ``{"tool_calls": [{"id", "name",
"arguments"}, ...]}`` makes calls; a message whose text is ``{"tool_call_id",
"content"}`` is a result; any other message is plain.  Calls and results are
joined by (conversation, identifier).  An argument ``{"$ref": identifier}``
depends on the result of another call.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import materialise, running_sum, ship

EVENT = "part int, kind string, call_id string, name string, body string, error string, refs array<string>"
TYPES = {
    "string": lambda v: isinstance(v, str),
    "boolean": lambda v: isinstance(v, bool),
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool),
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "array": lambda v: isinstance(v, list),
    "object": lambda v: isinstance(v, dict),
    "null": lambda v: v is None,
}


def canonical(value: object) -> str:
    """JSON with sorted keys, no spaces, and characters as they are."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


NOTES = {"title", "description", "default", "examples", "deprecated", "readOnly", "writeOnly", "$comment", "$schema", "$id"}  # these check nothing
ONE, SOME, NAMED = {"items", "additionalProperties", "not"}, {"anyOf", "oneOf", "allOf"}, {"properties"}  # these hold schemas
CHECKS = ONE | SOME | NAMED | {
    "type", "enum", "const", "required", "minLength", "maxLength", "pattern", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum",
    "multipleOf", "minItems", "maxItems", "uniqueItems", "minProperties", "maxProperties",
}


def check_schema(schema: object, path: str) -> None:
    """Raise for a keyword or a type that fault() doesn't check, so nothing passes unchecked."""
    if isinstance(schema, bool):
        return
    if not isinstance(schema, dict):
        raise ValueError(f"{path}: not a schema")
    if odd := sorted(set(schema) - CHECKS - NOTES):
        raise ValueError(f"{path}: schema keywords that are not checked: {', '.join(odd)}")
    kinds = schema.get("type", [])
    if odd := sorted({kinds} - set(TYPES) if isinstance(kinds, str) else set(kinds) - set(TYPES)):
        raise ValueError(f"{path}: unknown types: {', '.join(odd)}")
    if "pattern" in schema:
        re.compile(schema["pattern"])
    inner = [(k, schema[k]) for k in ONE if k in schema]
    inner += [(f"{k}[{i}]", x) for k in SOME for i, x in enumerate(schema.get(k, []))]
    inner += [(f"{k}.{name}", x) for k in NAMED for name, x in schema.get(k, {}).items()]
    for name, x in inner:
        check_schema(x, f"{path}.{name}")


def _plain(value: object) -> object:
    """Equal for equal JSON values: 1 and 1.0 are, 1 and true are not."""
    if isinstance(value, dict):
        return "object", frozenset((k, _plain(v)) for k, v in value.items())
    return ("array", *map(_plain, value)) if isinstance(value, list) else (isinstance(value, bool), value)


def _exact(number: float) -> Fraction:
    return Fraction(number) if isinstance(number, int) else Fraction(str(number))


def fault(value: object, schema: dict | bool, path: str = "$") -> str | None:
    """First breach of a JSON schema (the keywords of CHECKS; patterns as in ``re``), or none.

    A reference to another call's result stands for any value.
    """
    if isinstance(value, dict) and set(value) == {"$ref"}:
        return None
    if isinstance(schema, bool):
        return None if schema else f"{path}: not allowed"
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(TYPES[k](value) for k in kinds):
        return f"{path}: not {' or '.join(kinds)}"
    open_ = bool(_refs(value))  # what a reference stands for may make it equal, or unequal
    if "enum" in schema and not open_ and _plain(value) not in map(_plain, schema["enum"]):
        return f"{path}: not in enum"
    if "const" in schema and not open_ and _plain(value) != _plain(schema["const"]):
        return f"{path}: not the constant"
    if isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            return f"{path}: too short"
        if len(value) > schema.get("maxLength", len(value)):
            return f"{path}: too long"
        if "pattern" in schema and not re.search(schema["pattern"], value):
            return f"{path}: not of the pattern"
    if TYPES["number"](value):
        if value < schema.get("minimum", value) or value <= schema.get("exclusiveMinimum", -math.inf) != -math.inf:
            return f"{path}: too small"
        if value > schema.get("maximum", value) or value >= schema.get("exclusiveMaximum", math.inf) != math.inf:
            return f"{path}: too large"
        if "multipleOf" in schema and not (math.isfinite(value) and _exact(value) % _exact(schema["multipleOf"]) == 0):
            return f"{path}: not a multiple"
    if isinstance(value, dict):
        fields, others = schema.get("properties", {}), schema.get("additionalProperties", True)
        for name in schema.get("required", []):
            if name not in value:
                return f"{path}.{name}: missing"
        if len(value) < schema.get("minProperties", 0):
            return f"{path}: too few properties"
        if len(value) > schema.get("maxProperties", len(value)):
            return f"{path}: too many properties"
        for name, inner in sorted(value.items()):
            if name not in fields and others is False:
                return f"{path}.{name}: unknown"
            if bad := fault(inner, fields.get(name, others), f"{path}.{name}"):
                return bad
    if isinstance(value, list):
        if len(value) < schema.get("minItems", 0):
            return f"{path}: too few items"
        if len(value) > schema.get("maxItems", len(value)):
            return f"{path}: too many items"
        if schema.get("uniqueItems") and not open_ and len(set(map(_plain, value))) < len(value):
            return f"{path}: repeated items"
        if bad := next((bad for i, v in enumerate(value) if (bad := fault(v, schema.get("items", True), f"{path}[{i}]"))), None):
            return bad
    for inner in schema.get("allOf", []):
        if bad := fault(value, inner, path):
            return bad
    if "anyOf" in schema and all(fault(value, x, path) for x in schema["anyOf"]):
        return f"{path}: none of anyOf"
    if "oneOf" in schema:
        fits = sum(not fault(value, x, path) for x in schema["oneOf"])
        if not fits or fits > 1 and not open_:
            return f"{path}: {'several' if fits else 'none'} of oneOf"
    if "not" in schema and not open_ and not fault(value, schema["not"], path):
        return f"{path}: not allowed"
    return None


def _refs(value: object) -> list[str]:
    if isinstance(value, dict):
        if set(value) == {"$ref"} and isinstance(value["$ref"], str):
            return [value["$ref"]]
        return [r for v in value.values() for r in _refs(v)]
    return [r for v in value for r in _refs(v)] if isinstance(value, list) else []


def _parsed(text: str | None) -> object:
    if text is None or not text.lstrip().startswith("{"):
        return None
    try:
        return json.loads(text)
    except (ValueError, RecursionError):
        return None


def events_of(role: str | None, text: str | None, tools: dict[str, dict]) -> list[tuple]:
    """(kind, call_id, name, body, error, refs) of a message: its calls, a result, or one plain event."""
    got = _parsed(text)
    if isinstance(got, dict) and role == "assistant" and isinstance(got.get("tool_calls"), list) and got["tool_calls"]:
        out = []
        for call in got["tool_calls"]:
            call = call if isinstance(call, dict) else {}
            ident, name, given = call.get("id"), call.get("name"), call.get("arguments")
            if isinstance(given, str):  # arguments may be JSON in a string
                given = _parsed(given)
            if not isinstance(ident, str):
                bad = "no id"
            elif name not in tools:
                bad = "unknown tool"
            else:
                bad = fault(given, {"type": "object", **tools[name]})
            try:
                body = canonical(given)
            except ValueError:
                body, bad = "null", "no JSON number"
            refs = sorted(set(_refs(given)))
            out.append(("call", ident if isinstance(ident, str) else None, name if isinstance(name, str) else None, body, bad, refs))
        return out
    if isinstance(got, dict) and role == "tool" and isinstance(got.get("tool_call_id"), str):
        try:
            return [("result", got["tool_call_id"], None, canonical(got.get("content")), None, [])]
        except ValueError:
            pass
    return [("message", None, None, canonical(text), None, [])]


def _events(tools: dict[str, dict]):
    """Messages -> events, with the conversation, turn and role of their message."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["part", "kind", "call_id", "name", "body", "error", "refs"]
        kinds = [pa.int32(), *[pa.string()] * 5, pa.list_(pa.string())]
        for batch in batches:
            rows = zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True)
            found = [(at, i, *event) for at, (role, text) in enumerate(rows) for i, event in enumerate(events_of(role, text, tools))]
            if found:
                at, *cols = zip(*found, strict=True)
                message = batch.select(["row", "conv", "turn", "role"]).take(pa.array(at))
                cols = [pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*message.columns, *cols], [*message.schema.names, *names])

    return run


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The canonical JSON line of every event."""
    for batch in batches:
        lines = []
        for e in batch.to_pylist():
            out = {"kind": e["kind"], "role": e["role"], "status": e["status"]}
            if e["kind"] == "message":
                out["text"] = json.loads(e["body"])
            else:
                out["id"] = e["call_id"]
            if e["kind"] == "call":
                out |= {"name": e["name"], "arguments": json.loads(e["body"]), "error": e["error"]}
            if e["kind"] == "result":
                out["content"] = json.loads(e["body"])
            lines.append(canonical(out))
        rest = [n for n in batch.schema.names if n not in ("body", "name")]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in rest), pa.array(lines, pa.string())], [*rest, "json"])


def format_chats(messages: DataFrame, tools: dict[str, dict], conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """One row per event: ``conv, turn, part, role, kind, call_id, status, error, position, json``.

    ``position`` counts a conversation's events from 0 in an order in which a
    result follows its call and a call follows the results it refers to,
    otherwise by turn, part and a hash of the content.  Status of a call: answered, open,
    duplicate (a later call with a taken identifier), unresolved (it refers to
    a call that is missing, comes in a circle, or is itself unresolved).  Of a result: linked or orphan.
    Null conversations form one of their own; null turns come first; null and
    empty texts are plain messages; repeated rows are events of their own.
    A tool's schema with a keyword that fault() doesn't check is refused.
    """
    for name, schema in tools.items():
        check_schema(schema, name)
    ship(messages.sparkSession)
    rows = messages.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.col("role").cast("string"), F.col("text").cast("string"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    conv = rows.schema["conv"].dataType.simpleString()
    told = rows.mapInArrow(_events(tools), f"row long, conv {conv}, turn long, role string, {EVENT}")
    # identifiers are joined within the conversation, null among nulls; ties go by a hash of what is said
    told = materialise(told.withColumn("key", F.to_json(F.struct("conv"))).withColumn("tie", F.xxhash64("body")))
    events = told.drop("body", "name")  # what is said stays aside until the end
    first = F.struct(F.coalesce("turn", F.lit(-1 << 62)).alias("t"), "part", "tie", "row")
    calls = events.where("kind = 'call' and call_id is not null").groupBy("key", "call_id")
    calls = calls.agg(F.min(first).alias("f"), F.min_by("refs", first).alias("refs"))
    results = events.where("kind = 'result'").groupBy("key", "call_id").agg(F.min(F.coalesce("turn", F.lit(-1 << 62))).alias("answered"))
    calls = materialise(calls.join(results, ["key", "call_id"], "left"))
    # a call's time is its turn or, if later, that of the results it refers to; level counts the links on the way
    done = materialise(calls.where(F.size("refs") == 0).select("key", "call_id", F.col("f.t").alias("time"), F.lit(0).alias("level"), "answered"))
    known = done
    waiting = materialise(calls.where(F.size("refs") > 0).select("key", "call_id", F.col("f.t").alias("t"), "answered", F.size("refs").alias("n"), F.explode("refs").alias("ref")))
    while not done.isEmpty() and not waiting.isEmpty():
        before = known.where("answered is not null").select(
            "key", F.col("call_id").alias("ref"), F.greatest("time", "answered").alias("ready"), F.col("level").alias("from")
        )
        ready = waiting.join(before, ["key", "ref"]).groupBy("key", "call_id").agg(
            F.greatest(F.max("t"), F.max("ready")).alias("time"), (F.max("from") + 2).cast("int").alias("level"),
            F.first("answered").alias("answered"), F.count(F.lit(1)).alias("met"), F.max("n").alias("n"),
        )
        done = materialise(ready.where("met = n").select("key", "call_id", "time", "level", "answered"))
        known = known.unionByName(done)
        waiting = materialise(waiting.join(done, ["key", "call_id"], "left_anti"))
    owner = calls.select("key", "call_id", F.col("f.row").alias("own_row"), F.col("f.part").alias("own_part"), F.col("f.t").alias("own_t"), "answered")
    timed = known.select("key", "call_id", "time", "level", F.lit(True).alias("resolved"))
    owner = owner.join(timed, ["key", "call_id"], "left")
    linked = events.join(owner, ["key", "call_id"], "left")
    mine = (F.col("own_row") == F.col("row")) & (F.col("own_part") == F.col("part"))
    status = (
        F.when((F.col("kind") == "call") & F.col("call_id").isNull(), "open")
        .when((F.col("kind") == "call") & ~mine, "duplicate")
        .when((F.col("kind") == "call") & F.col("resolved").isNull(), "unresolved")
        .when((F.col("kind") == "call") & F.col("answered").isNotNull(), "answered")
        .when(F.col("kind") == "call", "open")
        .when((F.col("kind") == "result") & F.col("own_row").isNotNull(), "linked")
        .when(F.col("kind") == "result", "orphan")
        .otherwise("plain")
    )
    turn = F.coalesce("turn", F.lit(-1 << 62))
    moved = F.col("status").isin("answered", "open", "linked") & F.col("time").isNotNull()
    linked = linked.withColumn("status", status).select(
        "row", "conv", "turn", "part", "role", "kind", "call_id", "error", "status", "key", "tie",
        F.when(moved, F.greatest(turn, "time")).when(F.col("status") == "linked", F.greatest(turn, "own_t")).otherwise(turn).alias("time"),
        F.when(moved | (F.col("status") == "linked"), F.coalesce("level", F.lit(0)) + F.when(F.col("kind") == "result", 1).otherwise(0)).otherwise(0).alias("level"),
    )
    placed = running_sum(linked, ["key"], ["time", "level", F.col("turn").asc_nulls_first(), "part", "tie"], F.lit(1), "position")
    placed = placed.join(told.select("row", "part", "name", "body"), ["row", "part"]).drop("row", "key", "tie", "time", "level")
    kinds = {f.name: f.dataType.simpleString() for f in placed.schema if f.name not in ("body", "name")}
    return placed.mapInArrow(_written, ", ".join(f"`{n}` {k}" for n, k in kinds.items()) + ", json string")
