"""Chat formatting with tool-call linking.

Calls (conv, call_id, name, arguments, after) and results (conv, call_id, content) meet in a hash join on
conversation and identifier. `after` names the call that a call waits for; calls are ordered topologically
by their depth below the first call, found by pointer doubling: the logarithm of the longest chain in
joins, with every round a written table, so no conversation is ever gathered in one task, however many
turns it has. Calls on a cycle, or that wait for one, have no depth. Arguments are checked against the
tool's schema, and every exchange is serialised as canonical JSON (keys sorted, no spaces, UTF-8, whole numbers
below 2**53 without a fraction or an exponent, so that 1, 1.0 and 1e0 are one number).

Identical calls with one identifier are one row, and so are identical results; `copies` and `answers` tell how many there
were. Of differing calls or results with one identifier the smallest by content is linked, and each of the others
is a row of its own, with status repeated_call or repeated_result and no depth. A call without a result, a result without a call, arguments that are no JSON object or break
the schema (numbers beyond a double, NaN, infinities and lone surrogates are not JSON; such arguments stand as text), and cycles each have a status of their own; nothing is dropped but rows with a null conversation
or identifier. An `after` that names no call, or the call itself as the one it waits for, is a first call
or a cycle, respectively. Empty tables give empty tables. Texts of any length are kept whole, and other
columns are not read.

Schemas are a subset of JSON Schema: {"type": "object", "required": [...], "properties": {name: {"type":
string|integer|number|boolean|array|object|null, "minLength", "maxLength", "minimum", "maximum", "enum"}},
"additionalProperties": bool}.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, claim, discard, materialize, workspace

_TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict, "null": type(None)}


def violations(value: object, schema: dict) -> list[str]:
    """What in a call's arguments breaks the schema, in the order of names."""
    if not isinstance(value, dict):
        return ["not an object"]
    properties, found = schema.get("properties", {}), []
    found += [f"{k}: missing" for k in sorted(schema.get("required", [])) if k not in value]
    for k in sorted(value):
        if k not in properties:
            found += [] if schema.get("additionalProperties", True) else [f"{k}: unknown"]
            continue
        rule, v = properties[k], value[k]
        kind = rule.get("type")
        if kind and (not isinstance(v, _TYPES[kind]) or (isinstance(v, bool) and kind in ("integer", "number"))):
            found.append(f"{k}: not {kind}")
        elif "enum" in rule and v not in rule["enum"]:
            found.append(f"{k}: not in enum")
        elif isinstance(v, str) and not rule.get("minLength", 0) <= len(v) <= rule.get("maxLength", len(v)):
            found.append(f"{k}: length")
        elif isinstance(v, (int, float)) and not rule.get("minimum", v) <= v <= rule.get("maximum", v):
            found.append(f"{k}: range")
    return found


def _number(text: str) -> int | float:
    value = float(text)
    if value - value != 0:
        raise ValueError(f"no double: {text}")
    return int(value) if value == int(value) and abs(value) < 1 << 53 else value


def _refused(text: str) -> None:
    raise ValueError(f"no JSON: {text}")


def parsed(text: str) -> object:
    """The value of a JSON text that can be serialised again, or a ValueError (RecursionError if nested too deep)."""
    value = json.loads(text, parse_float=_number, parse_constant=_refused)
    canonical(value).encode()
    return value


def canonical(value: object) -> str:
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False)


def depths(calls: DataFrame, path: str) -> DataFrame:
    """(conv, call_id, depth) by pointer doubling; depth is null on and below cycles."""
    spark, known = calls.sparkSession, calls.select(F.col("conv").alias("_c"), F.col("call_id").alias("_i"))
    start = calls.join(known, (F.col("conv") == F.col("_c")) & (F.col("after") == F.col("_i")), "left")
    state = materialize(start.select("conv", "call_id", F.col("_i").alias("up"), F.when(F.col("_i").isNull(), 0).otherwise(1).cast("long").alias("depth")), f"{path}/depth0")
    k, most = 0, max(1, state.count()).bit_length()
    while k <= most and state.where("up is not null").limit(1).count():
        above = state.select(F.col("conv").alias("_c"), F.col("call_id").alias("_i"), F.col("up").alias("_up"), F.col("depth").alias("_d"))
        moved = state.join(above, (F.col("conv") == F.col("_c")) & (F.col("up") == F.col("_i")), "left")
        k += 1
        state = materialize(moved.select("conv", "call_id", F.col("_up").alias("up"), (F.col("depth") + F.coalesce("_d", F.lit(0))).alias("depth")), f"{path}/depth{k}")
        discard(spark, f"{path}/depth{k - 1}")
    return state.select("conv", "call_id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def _apart(rows: DataFrame, content: list[str], copies: str, path: str) -> tuple[DataFrame, DataFrame]:
    """(the row of smallest content of each conv and call_id, the other rows of different content), both with the number of identical rows."""
    keys = ["conv", "call_id"]
    rows = materialize(rows.where("conv is not null and call_id is not null").groupBy(*keys, *content).agg(F.count("*").alias(copies)), f"{path}/all")
    first = rows.groupBy(*keys).agg(F.min(F.struct(*content, copies)).alias("_first"), F.count("*").alias("_n"))
    first = materialize(first, f"{path}/first")
    several = first.where("_n > 1").select(*keys, F.struct(*[F.col(f"_first.{c}").alias(c) for c in content]).alias("_linked"))
    others = rows.join(several, keys).where(~F.struct(*content).eqNullSafe(F.col("_linked"))).drop("_linked")
    return first.select(*keys, "_first.*"), others


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per different call, and per different result that is not the linked one of a call: conv, call_id, depth, copies (of the call), status, errors, json, answers (copies of the result)."""
    path, keys = workspace(calls.sparkSession), ["conv", "call_id"]
    calls, more_calls = _apart(calls, ["name", "arguments", "after"], "copies", f"{path}/calls")
    results, more_results = _apart(results, ["content"], "answers", f"{path}/results")
    called, answered = F.lit(True).alias("called"), F.lit(True).alias("answered")
    linked = calls.select("*", called).join(results.select("*", answered), keys, "full_outer").join(depths(calls, f"{path}/order"), keys, "left")
    linked = linked.unionByName(more_calls.select("*", called, F.lit("repeated_call").alias("again")), allowMissingColumns=True)
    linked = linked.unionByName(more_results.select("*", answered, F.lit("repeated_result").alias("again")), allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("chat")
        for batch in batches:
            status, errors, text = [], [], []
            for r in batch.to_pylist():
                value, wrong = None, []
                if r["called"]:
                    try:
                        value = parsed(r["arguments"] or "null")
                        wrong = violations(value, schemas[r["name"]]) if r["name"] in schemas else ["unknown tool"]
                    except (ValueError, RecursionError):
                        value, wrong = r["arguments"], ["not JSON"]
                status.append(r["again"] if r["again"] else "orphan_result" if not r["called"] else "cycle" if r["depth"] is None else "invalid" if wrong else "ok" if r["answered"] else "no_result")
                errors.append("; ".join(wrong))
                call = {"arguments": value, "id": r["call_id"], "name": r["name"]} if r["called"] else None
                text.append(canonical({"call": call, "order": r["depth"], "result": {"content": r["content"], "id": r["call_id"]} if r["answered"] else None}))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), batch.column(3), pa.array(status, pa.string()), pa.array(errors, pa.string()), pa.array(text, pa.string()), batch.column(4)], names=["conv", "call_id", "depth", "copies", "status", "errors", "json", "answers"])

    slim = bounded(linked).select("conv", "call_id", "depth", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("copies", "answers")], "again", "called", "name", "arguments", "answered", "content")
    return slim.mapInArrow(run, f"conv {dict(calls.dtypes)['conv']}, call_id string, depth long, copies long, status string, errors string, json string, answers long")


#: The one tool of plain conversations: a turn is asked for a reply.
REPLY = {"reply": {"type": "object", "required": ["text", "turn"], "additionalProperties": False, "properties": {"text": {"type": "string", "minLength": 1, "maxLength": 2000}, "turn": {"type": "integer", "minimum": 0}, "role": {"type": "string", "enum": ["user", "system"]}}}}


def exchanges(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Plain turns (conv_id, turn, role, text) as calls and results: every turn that is not the assistant's calls
    `reply` under its own number and waits for the call two turns before, or else the one before; an
    assistant's turn answers the call of the turn before it."""
    t = turns.select(turns["conv_id"].alias("conv"), turns["turn"], F.coalesce(turns["role"], F.lit("")).alias("role"), turns["text"])
    asks = t.where("role <> 'assistant'")
    numbers = asks.select(F.col("conv").alias("_c"), F.col("turn").alias("_t")).distinct()
    asks = asks.join(numbers, (F.col("conv") == F.col("_c")) & (F.col("turn") - 2 == F.col("_t")), "left")
    after = F.coalesce(F.col("_t"), F.col("turn") - 1)
    calls = asks.select("conv", F.col("turn").cast("string").alias("call_id"), F.lit("reply").alias("name"), F.to_json(F.struct("role", "text", "turn")).alias("arguments"), after.cast("string").alias("after"))
    return calls, t.where("role = 'assistant'").select("conv", (F.col("turn") - 1).cast("string").alias("call_id"), F.col("text").alias("content"))
