"""Tool calls of conversations, linked with their results and put in order.

Calls and results are joined by identifier. A call may come after another call, whose result it
uses; pointers along these references are doubled round by round, so chains of any length are
ordered in logarithmically many joins, and no conversation is gathered in one task. Arguments
are checked against a schema of their tool and every message is written as canonical JSON:
sorted keys, no spaces, UTF-8.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.session import materialize, materialize_observed

KINDS = {
    "string": str, "integer": int, "number": (int, float), "boolean": bool,
    "object": dict, "array": list, "null": type(None),
}


def canonical(value: object) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def problems(value: object, schema: dict, at: str = "$") -> list[str]:
    """What ``value`` breaks of a schema: type, enum, bounds, lengths, properties, items."""
    out = []
    kind = schema.get("type")
    if kind and (not isinstance(value, KINDS[kind]) or isinstance(value, bool) and kind in ("integer", "number")):
        return [f"{at}: not of type {kind}"]
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: not in enum")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value) or value > schema.get("maximum", value):
            out.append(f"{at}: out of bounds")
    if isinstance(value, str) and not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)):
        out.append(f"{at}: length")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in known:
                out += problems(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{at}.{k}: unknown")
    if isinstance(value, list) and "items" in schema:
        for i, v in enumerate(value):
            out += problems(v, schema["items"], f"{at}[{i}]")
    return out


OUT = ["conv_id", "turn", "status", "step", "kind", "call_id", "valid", "problems", "json"]


def _refuse(name: str) -> None:
    raise ValueError(f"{name} is no JSON")


def _messages(schemas: dict[str, dict]) -> Callable:
    """Validity, problems and canonical JSON of rows kind, id, tool, arguments, content."""

    def one(kind: str, call: str | None, tool: str | None, arguments: str | None, content: str | None):
        if kind == "result":
            return None, None, canonical({"content": content, "tool_call_id": call, "type": "tool_result"})
        if kind != "call":
            return None, None, canonical({"content": content, "type": kind})
        value, bad = arguments, []
        try:
            value = json.loads(arguments if arguments is not None else "", parse_constant=_refuse)
            canonical(value).encode()  # numbers beyond a double and lone surrogates have no canonical form
            if tool in schemas:
                bad = problems(value, schemas[tool])
            else:
                bad = ["unknown tool"]
        except (ValueError, RecursionError):
            value, bad = arguments, ["arguments are no JSON"]
        made = {"arguments": value, "id": call, "name": tool, "type": "tool_call"}
        return not bad, "; ".join(bad) or None, canonical(made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [one(*row) for row in zip(*(c.to_pylist() for c in batch.columns[-5:]))]
            columns = zip(*made) if made else [[], [], []]
            new = [pa.array(c, t) for c, t in zip(columns, (pa.bool_(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-5], *new], names=OUT)

    return run


def depths(calls: DataFrame) -> DataFrame:
    """_conv, _call and _depth: how many calls come before each; null in or after a circle.

    ``calls`` has one row per call, _after is the call it comes after or null. Only calls whose
    pointer has not reached a first call yet are joined again.
    """
    n = max(calls.count(), 2)
    known = calls.select(F.col("_conv").alias("_c"), F.col("_call").alias("_k"))
    state = calls.join(
        known, F.col("_conv").eqNullSafe(F.col("_c")) & (F.col("_after") == F.col("_k")), "left"
    ).select("_conv", "_call", F.col("_k").alias("_up"), F.when(F.col("_k").isNull(), 0).otherwise(1).cast("long").alias("_depth"))
    state, seen = materialize_observed(state, "depths", open=F.count("_up"))
    rounds = 0
    while seen["open"] and 1 << rounds <= 2 * n:
        above = state.select(
            F.col("_conv").alias("_c"), F.col("_call").alias("_k"), F.col("_up").alias("_next"), F.col("_depth").alias("_more")
        )
        met = state.join(above, F.col("_conv").eqNullSafe(F.col("_c")) & (F.col("_up") == F.col("_k")), "left")
        state, seen = materialize_observed(
            met.select("_conv", "_call", F.col("_next").alias("_up"), (F.col("_depth") + F.coalesce("_more", F.lit(0))).alias("_depth")),
            "depths",
            open=F.count("_up"),
        )
        rounds += 1
    return state.select("_conv", "_call", F.when(F.col("_up").isNull(), F.col("_depth")).alias("_depth"))


def link_calls(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per message: conv_id, turn, kind, call_id, status, step, valid, problems, json.

    ``messages`` has conv_id, turn, kind ('call', 'result' or another role), call_id, tool,
    arguments (JSON text), content and after (a call_id of the conversation, or null).

    status: 'linked', or 'no result' for a call and 'no call' for a result without partner;
    'repeated' for a call or result whose id an earlier turn has; 'no id' without one; null for
    other messages. step: twice the number of calls that a call comes after, its result one more;
    with turn it orders a conversation so that nothing precedes what it needs. It is null for
    unlinked results, in circles and for other messages. valid, problems: of a call's arguments; of
    a repeated key the last value counts, numbers beyond a double and lone surrogates are no JSON,
    and arguments that are none are kept as text.
    Messages that repeat both turn and id are alike. A null conv_id is one conversation; an empty
    table gives no rows; other columns are ignored.
    """
    rows = messages.select(
        F.col("conv_id").alias("_conv"), F.col("turn").alias("_turn"), F.col("kind").alias("_kind"),
        F.col("call_id").cast("string").alias("_call"), F.col("after").cast("string").alias("_after"),
        F.col("tool").alias("_tool"), F.col("arguments").alias("_args"), F.col("content").alias("_content"),
    )
    first = (
        rows.filter(F.col("_call").isNotNull() & F.col("_kind").isin("call", "result"))
        .groupBy("_conv", "_call")
        .agg(
            F.min(F.when(F.col("_kind") == "call", F.col("_turn"))).alias("_called"),
            F.min(F.when(F.col("_kind") == "result", F.col("_turn"))).alias("_answered"),
            F.min(F.when(F.col("_kind") == "call", F.struct("_turn", "_after")))["_after"].alias("_after"),
        )
    )
    first = materialize(first, "calls")
    depth = depths(first.filter(F.col("_called").isNotNull()).select("_conv", "_call", "_after"))
    pairs = first.select(F.col("_conv").alias("_c"), F.col("_call").alias("_k"), "_called", "_answered").join(
        depth.select(F.col("_conv").alias("_dc"), F.col("_call").alias("_dk"), "_depth"),
        F.col("_c").eqNullSafe(F.col("_dc")) & (F.col("_k") == F.col("_dk")),
        "left",
    )
    found = rows.drop("_after").join(
        pairs, F.col("_conv").eqNullSafe(F.col("_c")) & (F.col("_call") == F.col("_k")), "left"
    )
    call, result = F.col("_kind") == "call", F.col("_kind") == "result"
    own, other = F.when(call, F.col("_called")).otherwise(F.col("_answered")), F.when(call, F.col("_answered")).otherwise(F.col("_called"))
    status = (
        F.when(~(call | result) | F.col("_kind").isNull(), F.lit(None).cast("string"))
        .when(F.col("_call").isNull(), "no id")
        .when(~F.col("_turn").eqNullSafe(own), "repeated")
        .when(other.isNull(), F.when(call, "no result").otherwise("no call"))
        .otherwise("linked")
    )
    step = F.when(call & (status != "repeated"), 2 * F.col("_depth")).when(status == "linked", 2 * F.col("_depth") + 1)
    ready = found.select(
        "_conv", "_turn", status.alias("_status"), step.alias("_step"), F.col("_kind").alias("_k0"), F.col("_call").alias("_c0"),
        "_kind", "_call", "_tool", "_args", "_content",
    )
    kinds = {f.name: f.dataType.simpleString() for f in ready.schema}
    ddl = (
        f"conv_id {kinds['_conv']}, turn {kinds['_turn']}, status string, step long, kind string, call_id string, "
        "valid boolean, problems string, json string"
    )
    made = ready.mapInArrow(_messages(schemas), ddl)
    return made.select("conv_id", "turn", "kind", "call_id", "status", "step", "valid", "problems", "json")
