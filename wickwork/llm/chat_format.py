"""Chat formatting: tool calls linked with their results, ordered, validated, and written as canonical JSON.

A message is a row: conv_id, turn, calls (array of id, name, arguments as JSON text, after: ids that it
needs), results (array of id, content). Calls and results meet in a hash join by conversation and
identifier, after each side was reduced to one row an identifier, so neither a conversation nor an
identifier that holds most rows gathers in one task. A call can only need calls of earlier messages or of
its own; so the order among messages is that of turns, and only the calls of one message, which are one
row, have to be sorted topologically (by id where that leaves a choice). Arguments are validated against
the schema of the call's name: type, required, properties, additionalProperties, items, enum, const, minimum,
maximum, exclusiveMinimum, exclusiveMaximum, multipleOf, minLength, maxLength, minItems, maxItems, uniqueItems,
minProperties, maxProperties, allOf, anyOf, oneOf, not. A schema with another word that decides (LACKING: $ref,
pattern, if and so on) can't be applied, so its calls are never "ok"; words that only describe are ignored.

A call's status, the first that holds: "duplicate" (its identifier came before), "cycle", "missing_need" (a
needed call isn't in this or an earlier message), "unknown_tool", "bad_schema" (the tool's schema isn't JSON,
uses the words above in another form or one of LACKING), "bad_json", "invalid" (breaks the schema), "unanswered", else "ok". If
results repeat the first by turn counts. A result without a call is a row of its own with status "orphan".

Arguments are bad_json as well if they nest more than MAX_DEPTH deep or hold a number that JSON can't write (NaN,
1e999, an integer of more than 4,300 digits). Half of a surrogate pair is written as its escape. Values are equal
as JSON: 1 and 1.0 are, 1e16 and 10000000000000000 too, 1 and true aren't.

Defined results: null arrays hold nothing, a null id matches nothing and a call with one is unanswered at
best. Rows that repeat (conv_id, turn) count as one message each, also if all else repeats: the calls of the
second are duplicates. No messages give no rows, texts may have any length. Other columns are ignored.

Turns: a message of any role becomes a row with its whole text, its calls in order and the orphans among its
results as one line of canonical JSON, in the order of conversations and turns (op2_chat_turns).
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickwork.llm.base import cut, met_by_salt, table, words_of

TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


MAX_DEPTH = 100
# Words of JSON Schema that decide and aren't applied here.
LACKING = {
    "$ref", "$dynamicRef", "$recursiveRef", "pattern", "patternProperties", "propertyNames", "dependencies", "dependentRequired", "dependentSchemas", "if", "then", "else", "contains", "minContains", "maxContains",
    "prefixItems", "additionalItems", "unevaluatedItems", "unevaluatedProperties", "contentSchema", "disallow", "extends", "divisibleBy",
}
#: Tools whose schemas are sent to all tasks; more meet the calls by name and salt.
FEW_TOOLS = 10_000
HALF = re.compile("[\ud800-\udfff]")


def canonical(value: object) -> str:
    """JSON with sorted keys, no spaces, and whole numbers without a fraction."""

    def plain(x: object) -> object:
        if isinstance(x, float) and x.is_integer():
            return int(x)
        if isinstance(x, dict):
            return {k: plain(v) for k, v in x.items()}
        return [plain(v) for v in x] if isinstance(x, list) else x

    text = json.dumps(plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    return HALF.sub(lambda m: f"\\u{ord(m[0]):04x}", text)


def _fraction(text: str) -> int | float:
    """A number with a point or an exponent: an integer where it is one, digit by digit, however large."""
    near = float(text)
    if not math.isfinite(near) or not near.is_integer():
        return near
    exact = Decimal(text)
    return int(exact) if exact == exact.to_integral_value() else near


def parsed(text: str | None) -> object:
    """The JSON value of a text; ValueError if it is none or nests too deep."""
    try:
        value = json.loads(text if text is not None else "", parse_float=_fraction)
    except RecursionError:
        raise ValueError("too deep") from None
    level = [value]
    for _ in range(MAX_DEPTH + 1):
        level = [y for x in level if isinstance(x, (dict, list)) for y in (x.values() if isinstance(x, dict) else x)]
        if not level:
            return value
    raise ValueError("too deep")


def _number(x: object) -> bool:
    return isinstance(x, (int, float)) and not isinstance(x, bool)


def _is(x: object, kind: str) -> bool:
    if kind in ("number", "integer"):
        return _number(x) and (kind == "number" or isinstance(x, int) or x.is_integer())
    return isinstance(x, TYPES[kind])


def is_schema(s: object) -> bool:
    """Whether s is a schema that valid() can apply."""
    if not isinstance(s, dict):
        return isinstance(s, bool)
    kinds = s.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    count = lambda k: _number(s.get(k, 0)) and s.get(k, 0) >= 0
    return (
        not LACKING & s.keys()
        and isinstance(kinds, list) and all(isinstance(k, str) and (k in TYPES or k in ("number", "integer")) for k in kinds)
        and isinstance(s.get("enum", []), list)
        and isinstance(s.get("required", []), list) and all(isinstance(k, str) for k in s.get("required", []))
        and isinstance(s.get("properties", {}), dict) and all(map(is_schema, s.get("properties", {}).values()))
        and all(is_schema(s.get(k, True)) for k in ("additionalProperties", "items", "not"))
        and all(isinstance(s.get(k, [True]), list) and s.get(k, [True]) and all(map(is_schema, s.get(k, [True]))) for k in ("allOf", "anyOf", "oneOf"))
        and all(_number(s.get(k, 0)) for k in ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum"))
        and all(map(count, ("minLength", "maxLength", "minItems", "maxItems", "minProperties", "maxProperties")))
        and _number(s.get("multipleOf", 1)) and s.get("multipleOf", 1) > 0 and isinstance(s.get("uniqueItems", False), bool)
    )


def _between(n: int, schema: dict, of: str) -> bool:
    return schema.get(f"min{of}", 0) <= n <= schema.get(f"max{of}", n)


def _multiple(x: int | float, step: int | float) -> bool:
    """As decimals, as they are written: 0.3 is three times 0.1."""
    return (Fraction(repr(x)) / Fraction(repr(step))).denominator == 1


def _combined(x: object, schema: dict) -> bool:
    holds = lambda k: [valid(x, s) for s in schema[k]]
    return (
        ("allOf" not in schema or all(holds("allOf"))) and ("anyOf" not in schema or any(holds("anyOf")))
        and ("oneOf" not in schema or sum(holds("oneOf")) == 1) and ("not" not in schema or not valid(x, schema["not"]))
    )


def valid(x: object, schema: dict | bool) -> bool:
    if isinstance(schema, bool):
        return schema
    kinds = schema.get("type")
    if kinds is not None and not any(_is(x, k) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return False
    if "enum" in schema and canonical(x) not in map(canonical, schema["enum"]) or "const" in schema and canonical(x) != canonical(schema["const"]) or not _combined(x, schema):
        return False
    if isinstance(x, dict):
        known, more = schema.get("properties", {}), schema.get("additionalProperties", True)
        return _between(len(x), schema, "Properties") and all(k in x for k in schema.get("required", ())) and all(valid(v, known.get(k, more)) for k, v in x.items())
    if isinstance(x, list):
        return _between(len(x), schema, "Items") and (not schema.get("uniqueItems") or len({canonical(v) for v in x}) == len(x)) and all(valid(v, schema.get("items", True)) for v in x)
    if isinstance(x, str):
        return _between(len(x), schema, "Length")
    if _number(x):
        return schema.get("minimum", x) <= x <= schema.get("maximum", x) and ("exclusiveMinimum" not in schema or x > schema["exclusiveMinimum"]) and ("exclusiveMaximum" not in schema or x < schema["exclusiveMaximum"]) and ("multipleOf" not in schema or _multiple(x, schema["multipleOf"]))
    return True


def ordered(calls: list[dict]) -> list[tuple[int, bool]]:
    """(index into calls, whether it lies on or behind a cycle) in topological order."""
    own: dict[str, int] = {}
    for i, c in enumerate(calls):
        own.setdefault(c["id"], i)
    needs = [{own[n] for n in c["after"] or () if n in own and own[n] != i} | ({i} if c["id"] in (c["after"] or ()) else set()) for i, c in enumerate(calls)]
    users: list[list[int]] = [[] for _ in calls]
    for i, n in enumerate(needs):
        for j in n:
            users[j].append(i)
    import heapq

    rank = [(c["id"] is None, c["id"] or "", i) for i, c in enumerate(calls)]
    ready, left, out = [rank[i] for i, n in enumerate(needs) if not n], [len(n) for n in needs], []
    heapq.heapify(ready)
    while ready:
        i = heapq.heappop(ready)[2]
        out.append((i, False))
        for j in users[i]:
            left[j] -= 1
            if not left[j]:
                heapq.heappush(ready, rank[j])
    done = {i for i, _ in out}
    return out + [(i, True) for i in range(len(calls)) if i not in done]


def _calls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Messages to calls in order, with what each needs from other messages."""
    kinds = {"conv_id": pa.int64(), "turn": pa.int64(), "position": pa.int64(), "call_id": pa.string(), "name": pa.string(), "arguments": pa.string(), "cycle": pa.bool_(), "needs": pa.list_(pa.string())}
    for batch in batches:
        out: list[dict] = []
        if "row" in batch.schema.names:
            kinds["row"] = pa.int64()
        for m in batch.to_pylist():
            calls = [c for c in m["calls"] or () if c is not None]
            own = {c["id"] for c in calls}
            for place, (i, cycle) in enumerate(ordered(calls)):
                c = calls[i]
                out.append({"conv_id": m["conv_id"], "turn": m["turn"], "position": place, "call_id": c["id"], "name": c["name"], "arguments": c["arguments"], "cycle": cycle, "needs": sorted({n for n in c["after"] or () if n is not None and n not in own}), "row": m.get("row")})
        yield pa.RecordBatch.from_pylist(out, pa.schema(kinds))


@lru_cache(10_000)
def _schema(text: str) -> dict | bool | None:
    """The schema, None if it can't be applied."""
    try:
        found = parsed(text)
        canonical(found)  # its numbers are ones that JSON has
    except ValueError:
        return None
    return found if is_schema(found) else None


def checked(arguments: str | None, schema: str | None) -> tuple[str | None, str | None]:
    """The canonical arguments, and what is wrong with them."""
    known = None if schema is None else _schema(schema)
    fault = "unknown_tool" if schema is None else "bad_schema" if known is None else None
    try:
        value = parsed(arguments)
        text = canonical(value)
    except ValueError:
        return None, fault or "bad_json"
    return text, fault or (None if valid(value, known) else "invalid")


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the canonical arguments and what is wrong with them."""
    for batch in batches:
        found = [checked(*x) for x in zip(batch.column("arguments").to_pylist(), batch.column("schema").to_pylist(), strict=True)]
        keep = [c for c in batch.schema.names if c not in ("arguments", "schema")]
        yield pa.record_batch([*(batch.column(c) for c in keep), *(pa.array([x[i] for x in found], pa.string()) for i in (0, 1))], [*keep, "arguments", "wrong"])


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pylist()
        line = [canonical({"arguments": json.loads(r["arguments"]) if r["arguments"] is not None else None, "id": r["call_id"], "name": r["name"], "result": r["content"], "status": r["status"]}) for r in rows]
        yield batch.append_column("line", pa.array(line, pa.string()))


def linked(messages: DataFrame, schemas: DataFrame) -> DataFrame:
    """Per call and orphan result: conv_id, turn, position, call_id, name, status, arguments, n_results, result_turn, content, line.

    (turn, position) orders a conversation's calls. If messages have a column row (a number of their own), the
    result has that of the call's message, or of an orphan's. schemas: name, schema (JSON text); of several for a name the least counts.
    """
    row = ["row"] if "row" in messages.columns else []
    row_long = ", row long" if row else ""
    calls = messages.where(F.size("calls") > 0).select("conv_id", "turn", "calls", *row).mapInArrow(
        _calls, "conv_id long, turn long, position long, call_id string, name string, arguments string, cycle boolean, needs array<string>" + row_long
    )
    # a tool's name may be that of most calls
    one = schemas.where("name is not null").groupBy(F.col("name").alias("tool")).agg(F.min("schema").alias("schema"))
    calls = met_by_salt(calls, one, "name", "tool", F.xxhash64("conv_id", "call_id"), FEW_TOOLS, "left").select("conv_id", "turn", "position", "call_id", "name", "cycle", "needs", *row, "arguments", "schema")
    calls = calls.mapInArrow(_checked, f"conv_id long, turn long, position long, call_id string, name string, cycle boolean, needs array<string>{row_long}, arguments string, wrong string")
    # a number of its own for each call, kept in a table so that all readers see the same
    calls = cut(calls.withColumn("number", F.monotonically_increasing_id()))
    named = calls.where("call_id is not null")
    place = F.struct("turn", "position", "name", F.xxhash64("arguments").alias("hash"), "number")
    first = named.groupBy("conv_id", "call_id").agg(F.min(place).alias("first"))
    # needs of other messages: the needed call's first turn has to be earlier
    need = calls.where(F.size("needs") > 0).select("conv_id", "call_id", "turn", "number", F.explode("needs").alias("need"))
    at = first.select("conv_id", F.col("call_id").alias("need"), F.col("first.turn").alias("need_turn"))
    lacking = need.join(at, ["conv_id", "need"], "left").where("need_turn is null or need_turn >= turn").select("conv_id", "call_id", "number").distinct().withColumn("lacks", F.lit(True))
    results = messages.where(F.size("results") > 0).select("conv_id", "turn", *row, F.inline("results").alias("id", "content")).where("id is not null")
    results = results.groupBy("conv_id", F.col("id").alias("call_id")).agg(F.min(F.struct("turn", "content", *row)).alias("r"), F.count("*").alias("n_results"))
    # of an identifier's calls only the first can lack a need, the others are duplicates: so the calls' texts are dealt once
    facts = first.withColumn("number", F.col("first.number")).join(lacking, ["conv_id", "call_id", "number"], "left").drop("number")
    met = named.join(facts, ["conv_id", "call_id"], "left").join(results, ["conv_id", "call_id"], "full_outer")
    # calls without an id meet nothing and needn't be dealt
    met = met.unionByName(calls.where("call_id is null").join(lacking.select("number", "lacks"), "number", "left"), allowMissingColumns=True)
    status = (
        F.when(F.col("position").isNull(), "orphan").when(F.col("first.number") != F.col("number"), "duplicate").when(F.col("cycle"), "cycle").when(F.col("lacks"), "missing_need")
        .when(F.col("wrong").isNotNull(), F.col("wrong")).when(F.col("n_results").isNull(), "unanswered").otherwise("ok")
    )
    out = met.select(
        "conv_id", F.coalesce("turn", "r.turn").alias("turn"), F.coalesce("position", F.lit(-1)).cast("long").alias("position"), "call_id", "name", status.alias("status"), "arguments",
        F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"), F.col("r.turn").alias("result_turn"), F.col("r.content").alias("content"), *(F.coalesce(c, f"r.{c}").alias(c) for c in row),
    )
    return out.mapInArrow(_lines, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in out.schema) + ", line string")


def _turn_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines = []
        for r in batch.to_pylist():
            of = lambda orphan: ",".join(c["line"] for c in r["linked"] or () if (c["position"] < 0) == orphan)  # noqa: B023, E731
            lines.append(f'{{"calls":[{of(False)}],"content":{canonical(r["text"])},"orphans":[{of(True)}],"role":{canonical(r["role"])},"turn":{canonical(r["turn"])}}}')
        yield pa.record_batch([*(batch.column(c) for c in ("conv_id", "turn", "role")), pa.array(lines, pa.string())], ["conv_id", "turn", "role", "line"])


def turns(messages: DataFrame, schemas: DataFrame) -> DataFrame:
    """Per message, in order: conv_id, turn, role, line. messages also have role, text and row (a number of their own)."""
    calls = linked(messages, schemas).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("position", "line"))).alias("linked"))
    out = messages.select("conv_id", "turn", "role", "text", "row").join(calls, "row", "left")
    return out.orderBy("conv_id", "turn", "row").select("conv_id", "turn", "role", "text", "linked").mapInArrow(_turn_lines, "conv_id long, turn long, role string, line string")


# The schemas of the tools that the derived calls name.
SCHEMAS = [
    ("search", '{"type":"object","properties":{"query":{"type":"string","minLength":1},"limit":{"type":"integer","minimum":1,"maximum":9}},"required":["query","limit"],"additionalProperties":false}'),
    ("count", '{"type":"object","properties":{"of":{"type":"string"},"unit":{"enum":["word","line"]}},"required":["of","unit"]}'),
]


def derived(conversations: DataFrame) -> DataFrame:
    """Messages with calls and results that hold whole texts, and with every defect, from plain conversations.

    An assistant's turn searches for its text and counts in what the search finds (listed in the wrong order); the
    search needs the count of two turns before. The next user's text answers the search, and, if the number of its
    words is even, the count. By 3 conv_id + turn modulo 9, a search repeats the identifier of two turns before (0),
    needs the count that needs it (1), has an unknown name (2) or lacks the last character of its arguments (3).
    """
    body = F.coalesce("text", F.lit(""))
    n = F.size(words_of(F.col("text")))
    defect = F.pmod(3 * F.col("conv_id") + F.col("turn"), F.lit(9))
    of = lambda kind, turn: F.concat_ws("-", F.lit(kind), "conv_id", turn.cast("string"))
    text = lambda **parts: F.to_json(F.struct(*(v.alias(k) for k, v in parts.items())))
    call = lambda id, name, arguments, after: F.struct(id.alias("id"), name.alias("name"), arguments.alias("arguments"), after.alias("after"))
    none = F.array().cast("array<string>")
    turn = F.col("turn")
    a = of("a", F.when((defect == 0) & (turn >= 2), turn - 2).otherwise(turn))
    query = text(query=body, limit=n % 12)
    search = call(
        a, F.when(defect == 2, "lookup").otherwise("search"), F.when(defect == 3, F.expr("left(q, length(q) - 1)")).otherwise(F.col("q")),
        F.concat(F.when(turn >= 2, F.array(of("b", turn - 2))).otherwise(none), F.when(defect == 1, F.array(of("b", turn))).otherwise(none)),
    )
    count = call(of("b", turn), F.lit("count"), text(unit=F.element_at(F.array(F.lit("word"), F.lit("line"), F.lit("page")), n % 3 + 1), of=a), F.array(a))
    result = lambda kind: F.struct(of(kind, turn - 1).alias("id"), body.alias("content"))
    rest = [c for c in ("role", "text", "row") if c in conversations.columns]
    return conversations.withColumn("q", query).select(
        "conv_id", "turn", *rest, F.when(F.col("role") == "assistant", F.array(count, search)).alias("calls"),
        F.when(F.col("role") == "user", F.when(n % 2 == 0, F.array(result("a"), result("b"))).otherwise(F.array(result("a")))).alias("results"),
    )


def turns_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn with its whole text, formatted."""
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text", F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("row"))
    return turns(derived(conversations), spark.createDataFrame(SCHEMAS, "name string, schema string"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every call and orphan result of the whole conversations, linked."""
    schemas = spark.createDataFrame(SCHEMAS, "name string, schema string")
    return linked(derived(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")), schemas).drop("content")


SQL = r"""
with m as (
  select conv_id, turn, role, coalesce(text, '') as body, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as n, ((3 * conv_id + turn) % 9 + 9) % 9 as defect
  from conversations
), assistant as (
  select *, 'a-' || conv_id || '-' || case when defect = 0 and turn >= 2 then turn - 2 else turn end as a, 'b-' || conv_id || '-' || turn as b from m where role = 'assistant'
), calls as (
  select conv_id, turn, (defect = 1)::bigint as position, a as call_id, case when defect = 2 then 'lookup' else 'search' end as name,
    case when defect <> 3 then '{"limit":' || (n % 12) || ',"query":' || to_json(body)::varchar || '}' end as arguments,
    case when defect = 2 then 'unknown_tool' when defect = 3 then 'bad_json' when n % 12 not between 1 and 9 or body = '' then 'invalid' end as wrong,
    case when turn >= 2 then turn - 2 end as need, defect = 1 as cycle
  from assistant
  union all
  select conv_id, turn, (defect <> 1)::bigint, b, 'count', '{"of":"' || a || '","unit":"' || ['word', 'line', 'page'][n % 3 + 1] || '"}',
    case when n % 3 = 2 then 'invalid' end, null, defect = 1
  from assistant
), numbered as (
  select *, row_number() over (partition by conv_id, call_id order by turn, position) as nth from calls
), results as (
  select conv_id, turn, 'a-' || conv_id || '-' || (turn - 1) as call_id, body from m where role = 'user' union all
  select conv_id, turn, 'b-' || conv_id || '-' || (turn - 1), body from m where role = 'user' and n % 2 = 0
), met as (
  select coalesce(c.conv_id, r.conv_id) as conv_id, coalesce(c.turn, r.turn) as turn, coalesce(c.position, -1) as position, coalesce(c.call_id, r.call_id) as call_id, c.name, c.arguments,
    case when c.call_id is null then 'orphan' when c.nth > 1 then 'duplicate' when c.cycle then 'cycle' when c.need is not null and x.conv_id is null then 'missing_need'
      when c.wrong is not null then c.wrong when r.call_id is null then 'unanswered' else 'ok' end as status,
    (r.call_id is not null)::bigint as n_results, r.turn as result_turn, r.body
  from numbered c full join results r on c.conv_id = r.conv_id and c.call_id = r.call_id left join assistant x on x.conv_id = c.conv_id and x.turn = c.need
)
select conv_id, turn, position, call_id, name, status, arguments, n_results, result_turn,
  '{"arguments":' || coalesce(arguments, 'null') || ',"id":"' || call_id || '","name":' || coalesce('"' || name || '"', 'null') || ',"result":' || coalesce(to_json(body)::varchar, 'null') || ',"status":"' || status || '"}' as line
from met
"""
TURNS_SQL = f"""
with linked as ({SQL}), of_turn as (
  select conv_id, turn, string_agg(line, ',' order by position) filter (position >= 0) as calls, string_agg(line, ',' order by line) filter (position < 0) as orphans
  from linked group by conv_id, turn
)
select conv_id, turn, role,
  '{{"calls":[' || coalesce(calls, '') || '],"content":' || coalesce(to_json(text)::varchar, 'null') || ',"orphans":[' || coalesce(orphans, '') || '],"role":' || coalesce(to_json(role)::varchar, 'null') || ',"turn":' || turn || '}}' as line
from conversations left join of_turn using (conv_id, turn)
"""
