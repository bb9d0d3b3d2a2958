"""Chat formatting: linking of tool calls, their order, validation, and canonical JSON.

A message may hold calls, `<tool_call>{"id":, "name":, "arguments":}</tool_call>`, results, `<tool_result>{"id":,
"content":}</tool_result>`, and, to declare tools, `<tools>[{"name":, "parameters": schema}]</tools>`. Calls and results
are hash-joined by conversation and identifier. A call depends on the calls that its arguments name by
`{"$result": id}`; depths of a conversation of bounded size come from one pass over its links, those of larger ones from
contracting links in rounds. Messages come out as a row each, never gathered by conversation, so that one huge conversation is spread like any
other rows.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from fractions import Fraction
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, table

_TAG = re.compile(r"<(tool_call|tool_result|tools)>(.*?)</\1>", re.DOTALL)


def canonical(value) -> str:
    """JSON with sorted keys, no spaces and no escapes but the needed ones; whole floats as integers, others shortest."""

    def plain(x):
        if isinstance(x, float) and x.is_integer() and abs(x) < 2**53:
            return int(x)
        if isinstance(x, dict):
            return {k: plain(v) for k, v in x.items()}
        return [plain(v) for v in x] if isinstance(x, list) else x

    return json.dumps(plain(value), ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False)


#: What values and schemas of any kind can raise.
_BAD = (ArithmeticError, AttributeError, LookupError, RecursionError, TypeError, ValueError, re.error)
#: Levels that may be put around a value.
_AROUND = 24


def _loaded(text: str):
    """The value of a JSON text; None if it isn't JSON that can be written again: infinite numbers, halves of surrogate
    pairs, and nesting beyond what the interpreter takes are refused."""

    def refuse(name: str):
        raise ValueError(name)

    try:
        value = wrapped = json.loads(text, parse_constant=refuse)
        for _ in range(_AROUND):
            wrapped = [wrapped]
        canonical(wrapped).encode()
        references(wrapped)
    except _BAD:
        return None
    return value


def references(value) -> set[str]:
    if isinstance(value, dict):
        if set(value) == {"$result"}:
            return {str(value["$result"])}
        return set().union(*map(references, value.values()))
    return set().union(*map(references, value)) if isinstance(value, list) else set()


_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def _is(value, kind: str) -> bool:
    if kind in ("number", "integer"):
        return isinstance(value, (int, float)) and not isinstance(value, bool) and (kind == "number" or isinstance(value, int) or value.is_integer())
    return isinstance(value, _TYPES[kind]) if kind in _TYPES else True


#: Keywords that bind values and aren't checked; a schema that has one is reported.
_UNCHECKED = ("$dynamicRef", "$recursiveRef", "dependencies", "dependentSchemas", "maxContains", "minContains", "unevaluatedItems", "unevaluatedProperties")


def _pointed(root, ref) -> tuple:
    """(what a reference inside the schema points to,), empty if there is nothing."""
    if not isinstance(ref, str) or ref[:1] != "#" or ref[1:2] not in ("", "/"):
        return ()
    at = root
    for part in unquote(ref[1:]).split("/")[1:]:
        part = part.replace("~1", "/").replace("~0", "~")
        if isinstance(at, dict) and part in at:
            at = at[part]
        elif isinstance(at, list) and part.isdecimal() and int(part) < len(at):
            at = at[int(part)]
        else:
            return ()
    return (at,)


def problems(value, schema, path: str = "$", root=None, trail: frozenset = frozenset()) -> list[str]:
    """What in value is against schema; references to results stand for anything.

    Checked: type, enum, const, minimum, maximum, exclusiveMinimum and exclusiveMaximum (numbers or, with a bound, true),
    multipleOf, minLength, maxLength, pattern, properties, patternProperties, additionalProperties, propertyNames,
    required, dependentRequired, minProperties, maxProperties, items (one or a list), prefixItems, additionalItems,
    contains, minItems, maxItems, uniqueItems, allOf, anyOf, oneOf, not, if, then, else, true and false for schemas, and
    $ref within the schema. Other references and the keywords _UNCHECKED are problems themselves. format, as the standard
    has it, binds nothing. `root` is the schema that $ref starts from, `trail` the references followed for this value.
    """
    root = schema if root is None else root
    if isinstance(value, dict) and set(value) == {"$result"}:
        return []
    if schema is False:
        return [f"{path}: not allowed"]
    if not isinstance(schema, dict):
        return []
    inner = lambda v, rule, at: problems(v, rule, at, root)
    same = lambda rule: problems(value, rule, path, root, trail)
    kinds = schema.get("type", [])
    kinds = kinds if isinstance(kinds, list) else [kinds]
    if kinds and not any(_is(value, k) for k in kinds):
        return [f"{path}: not {' or '.join(map(str, kinds))}"]
    out = [f"{path}: {k} is not checked" for k in _UNCHECKED if k in schema]
    if "$ref" in schema:
        ref = schema["$ref"]
        if not (found := _pointed(root, ref)) or ref in trail:
            out.append(f"{path}: {ref} can't be followed")
        else:
            out += problems(value, found[0], path, root, trail | {ref})
    if "enum" in schema and value not in schema["enum"] or "const" in schema and value != schema["const"]:
        out.append(f"{path}: not one of the allowed values")
    if _is(value, "number"):
        low, high = schema.get("exclusiveMinimum"), schema.get("exclusiveMaximum")
        low, high = (schema.get(k) if x is True else x for k, x in (("minimum", low), ("maximum", high)))
        below = value < schema.get("minimum", value) or _is(low, "number") and value <= low
        above = value > schema.get("maximum", value) or _is(high, "number") and value >= high
        out += [f"{path}: below minimum"] * below + [f"{path}: above maximum"] * above
        step = schema.get("multipleOf")
        if _is(step, "number") and step > 0 and Fraction(repr(value)) % Fraction(repr(step)):
            out.append(f"{path}: not a multiple of {step}")
    if isinstance(value, str):
        short, long = len(value) < schema.get("minLength", 0), len(value) > schema.get("maxLength", len(value))
        out += [f"{path}: too short"] * short + [f"{path}: too long"] * long
        if "pattern" in schema and not re.search(schema["pattern"], value):
            out.append(f"{path}: against the pattern")
    if isinstance(value, dict):
        known, patterns = schema.get("properties", {}), schema.get("patternProperties", {})
        out += [f"{path}.{k}: missing" for k in schema.get("required", []) if k not in value]
        out += [f"{path}.{k}: missing" for given, ks in schema.get("dependentRequired", {}).items() if given in value for k in ks if k not in value]
        few, many = len(value) < schema.get("minProperties", 0), len(value) > schema.get("maxProperties", len(value))
        out += [f"{path}: too few properties"] * few + [f"{path}: too many properties"] * many
        for k, v in value.items():
            rules = [known[x] for x in (k,) if x in known] + [rule for p, rule in patterns.items() if re.search(p, k)]
            if rules:
                out += [x for rule in rules for x in inner(v, rule, f"{path}.{k}")]
            elif schema.get("additionalProperties", True) is False:
                out.append(f"{path}.{k}: unknown")
            else:
                out += inner(v, schema.get("additionalProperties"), f"{path}.{k}")
            if "propertyNames" in schema and inner(k, schema["propertyNames"], path):
                out.append(f"{path}.{k}: not an allowed name")
    if isinstance(value, list):
        each, heads = schema.get("items"), schema.get("prefixItems", [])
        if isinstance(each, list):
            each, heads = schema.get("additionalItems"), each
        out += [p for i, v in enumerate(value) for p in inner(v, heads[i] if i < len(heads) else each, f"{path}[{i}]")]
        few, many = len(value) < schema.get("minItems", 0), len(value) > schema.get("maxItems", len(value))
        out += [f"{path}: too few items"] * few + [f"{path}: too many items"] * many
        if schema.get("uniqueItems") is True and len({canonical(v) for v in value}) < len(value):
            out.append(f"{path}: repeated items")
        if "contains" in schema and schema.get("minContains") != 0 and all(inner(v, schema["contains"], path) for v in value):
            out.append(f"{path}: without an item that it must contain")
    out += [p for rule in schema.get("allOf", []) for p in same(rule)]
    if "anyOf" in schema and all(same(rule) for rule in schema["anyOf"]):
        out.append(f"{path}: against anyOf")
    open_ = not {"oneOf", "not", "if"}.isdisjoint(schema) and bool(references(value))  # what a result will be isn't known, so it can't be said to fit either
    if "oneOf" in schema and (fit := sum(not same(rule) for rule in schema["oneOf"])) != 1 and not (fit and open_):
        out.append(f"{path}: against oneOf")
    if "not" in schema and not open_ and not same(schema["not"]):
        out.append(f"{path}: against not")
    if "if" in schema and not open_:
        out += same(schema.get("else" if same(schema["if"]) else "then"))
    return out


_PARTS = "conv string, turn long, th long, pos int, kind string, call string, name string, body string, needs array<string>"


def checked(value, schema) -> list[str]:
    """problems(), or one that says that the schema can't be applied, if it isn't a valid one."""
    try:
        return problems(value, schema)
    except _BAD as e:
        return [f"$: the schema can't be applied: {type(e).__name__}"]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _PARTS.split(", ")]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), *[pa.string()] * 4, pa.list_(pa.string())]
    for b in batches:
        rows = []
        for conv, turn, th, text in zip(*(c.to_pylist() for c in b.columns)):
            for pos, m in enumerate(_TAG.finditer(text or "")):
                value = _loaded(m[2])
                if m[1] == "tools":
                    for tool in value if isinstance(value, list) else []:
                        if isinstance(tool, dict) and "name" in tool:
                            rows.append((conv, turn, th, pos, "tool", None, str(tool["name"]), canonical(tool.get("parameters", {})), []))
                elif not isinstance(value, dict) or "id" not in value:
                    rows.append((conv, turn, th, pos, "broken", None, None, m[2], []))
                elif m[1] == "tool_call":
                    arguments = value.get("arguments", {})
                    arguments = _loaded(arguments) if isinstance(arguments, str) else arguments
                    rows.append((conv, turn, th, pos, "call", str(value["id"]), str(value.get("name", "")), canonical(arguments), sorted(references(arguments))))
                else:
                    rows.append((conv, turn, th, pos, "result", str(value["id"]), None, canonical(value.get("content")), []))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(types), types)], names)


def _first(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Of several rows of a key the one of the least place; gathered before the shuffle."""
    return rows.groupBy(*keys).agg(F.min(F.struct("turn", "pos", "th", *values)).alias("m")).select(*keys, *(F.col(f"m.{x}").alias(x) for x in ("turn", "pos", "th", *values)))


#: Bytes of the identifiers and links of a conversation up to which its depths are found in one pass of a task.
PASS_BYTES = 4 << 20


def _settled(needs: dict[str, list[str]]) -> dict[str, int]:
    """Depths of the calls of one conversation, each call and each link met once; calls in and behind cycles are left out."""
    waits, follow = {}, {}
    for call, of in needs.items():
        of = {n for n in of if n in needs}
        waits[call] = len(of)
        for n in of:
            follow.setdefault(n, []).append(call)
    depth, ready = {}, [call for call, n in waits.items() if n == 0]
    level = 0
    while ready:
        depth |= dict.fromkeys(ready, level)
        then = []
        for call in ready:
            for f in follow.get(call, ()):
                waits[f] -= 1
                if waits[f] == 0:
                    then.append(f)
        ready, level = then, level + 1
    return depth


def _passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Depths of rows (conv, call, needs) that are sorted by conversation; one conversation is held at a time."""

    def done(conv, needs: dict) -> pa.RecordBatch:
        depth = _settled(needs)
        columns = [pa.array([conv] * len(needs), pa.string()), pa.array(list(needs), pa.string()), pa.array([depth.get(c) for c in needs], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["conv", "call", "depth"])

    at, held = None, {}
    for b in batches:
        for conv, call, needs in zip(*(b.column(i).to_pylist() for i in range(3))):
            if held and conv != at:
                yield done(at, held)
                held = {}
            at = conv
            held[call] = needs or []
    if held:
        yield done(at, held)


def depths(calls: DataFrame, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """(conv, call, depth): 0 without dependencies, else one more than the deepest of them; null in and behind cycles.
    Dependencies on unknown calls don't count. calls: (conv, call, needs), one row a call.

    A conversation whose identifiers and links have at most `pass_bytes` is settled in one pass of the task that its rows
    are sorted into, whatever its graph; no rounds. Larger ones, which no task may hold, are contracted by rounds of joins
    over all rows, with the same result. Null needs are none, repeated needs count once, rows without a conversation or a
    call aren't expected; no calls give no rows, and extra columns are ignored.
    """
    size = F.octet_length("call") + F.aggregate(F.coalesce("needs", F.array().cast("array<string>")), F.lit(16), lambda n, x: n + F.octet_length(x) + 8)
    large = cut(calls.groupBy("conv").agg(F.sum(size.cast("long")).alias("bytes")).where(F.col("bytes") > pass_bytes).select("conv"))
    of = calls.select("conv", "call", "needs")
    alone = large.isEmpty()
    small = of if alone else of.join(large, "conv", "left_anti")
    out = small.repartition("conv").sortWithinPartitions("conv").mapInArrow(_passed, "conv string, call string, depth long")
    return out if alone else out.unionByName(_contracted(of.join(large, "conv", "left_semi")))


def _contracted(calls: DataFrame) -> DataFrame:
    """depths() by rounds of joins, for conversations of any size.

    A call has a least depth a, so far, and open links (need, b): it is at least b deeper than what it needs. In a round
    all links are followed: a link to a call without open ones is settled; one to a call with a single open link is
    replaced by that one, as long as both. A chain of n calls is settled in log2(n) rounds, and so are trees. A link
    that is longer than there are calls has gone round a cycle.
    """
    most = calls.count()
    node = ["conv", "call"]
    links = calls.select("conv", "call", F.explode("needs").alias("need")).distinct()
    links = links.join(calls.select("conv", F.col("call").alias("need")), ["conv", "need"])
    links = links.groupBy(*node).agg(F.collect_list(F.struct("need", F.lit(1).cast("long").alias("b"))).alias("links"))
    nodes = cut(calls.select(*node).join(links, node, "left").select(*node, F.lit(0).cast("long").alias("a"), F.coalesce("links", F.array().cast("array<struct<need:string,b:bigint>>")).alias("links"), F.lit(False).alias("round")))
    is_open = (F.size("links") > 0) & ~F.col("round")
    while not nodes.where(is_open).isEmpty():
        each = nodes.where(is_open).select(*node, "a", F.inline("links"))
        then = nodes.select("conv", F.col("call").alias("need"), F.col("a").alias("a2"), F.col("links").alias("links2"), F.col("round").alias("round2"))
        further = F.when(F.size("links2") == 1, F.struct(F.get("links2", F.lit(0))["need"].alias("need"), (F.col("b") + F.get("links2", F.lit(0))["b"]).alias("b"))).when(
            F.size("links2") > 1, F.struct("need", "b")
        )
        met = each.join(then, ["conv", "need"]).select(*node, F.greatest("a", F.col("b") + F.col("a2")).alias("a"), "round2", further.alias("to")).repartition(*node)
        merged = met.groupBy(*node, F.col("to.need").alias("need")).agg(F.max("a").alias("a"), F.max("to.b").alias("b"), F.max("round2").alias("round"))
        left = F.collect_list(F.when(F.col("need").isNotNull(), F.struct("need", "b")))
        new = merged.groupBy(*node).agg(F.max("a").alias("a"), left.alias("links"), (F.max("round") | F.coalesce(F.max("b") > most, F.lit(False))).alias("round"))
        nodes = cut(nodes.where(~is_open).unionByName(new))
    return nodes.select(*node, F.when(~F.col("round"), F.col("a")).alias("depth"))


def _checked(defaults: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, bodies, schemas = (b.column(i).to_pylist() for i in (4, 5, 6))
            out = []
            for name, body, schema in zip(names, bodies, schemas):
                rule = json.loads(schema) if schema is not None else defaults.get(name)
                out.append(["unknown tool"] if rule is None else checked(json.loads(body), rule))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(4)), pa.array(out, pa.list_(pa.string()))], ["conv", "turn", "th", "pos", "problems"])

    return run


def linked_calls(parts: DataFrame, schemas: dict | None = None) -> DataFrame:
    """A row for each call of parts: conv, turn, th, pos, call, name, body (canonical arguments), result (of the first
    result of that identifier that comes later, else null), again (an earlier call has the identifier), depth, problems."""
    every = parts.where("kind = 'call'")
    calls = cut(_first(every, ["conv", "call"], ["name", "body", "needs"]))
    results = _first(parts.where("kind = 'result'").join(calls.select("conv", "call", F.col("turn").alias("ct"), F.col("pos").alias("cp")), ["conv", "call"]).where("turn > ct OR turn = ct AND pos > cp"), ["conv", "call"], ["body"])
    linked = calls.hint("shuffle_hash").join(results.select("conv", "call", F.col("body").alias("result")), ["conv", "call"], "left")
    linked = linked.join(depths(calls), ["conv", "call"], "left").select("conv", "call", "turn", "th", "pos", "result", "depth")
    declared = _first(parts.where("kind = 'tool'"), ["conv", "name"], ["body"]).select("conv", "name", F.col("body").alias("schema"))
    checked = every.join(declared, ["conv", "name"], "left").select("conv", "turn", "th", "pos", "name", "body", "schema").mapInArrow(_checked(schemas or {}), "conv string, turn long, th long, pos int, problems array<string>")
    place = ["conv", "turn", "th", "pos"]
    out = every.join(linked.select(*place, F.lit(True).alias("first"), "result", "depth"), place, "left").join(checked, place, "left")
    return out.select(*place, "call", "name", "body", "result", F.col("first").isNull().alias("again"), "depth", "problems")


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for conv, turn, role, text, calls in zip(*(b.column(i).to_pylist() for i in range(5))):
            message = {"conversation": conv, "turn": turn, "role": role, "content": _TAG.sub("", text or "") if calls else text}
            if calls:
                message["tool_calls"] = [
                    {"id": c["call"], "name": c["name"], "arguments": json.loads(c["body"]), "depth": c["depth"], "duplicate": c["again"], "problems": c["problems"]} | ({"result": json.loads(c["result"])} if c["result"] is not None else {})
                    for c in sorted(calls, key=lambda c: (c["depth"] is None, c["depth"] or 0, c["pos"]))
                ]
            out.append(canonical(message))
        yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(5, 8)), pa.array(out, pa.string())], ["conv", "turn", "calls", "json"])


def format_messages(chats: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", schemas: dict | None = None) -> DataFrame:
    """A row for each row of chats: its conv_id and turn, n_calls, n_linked (calls with a result), n_invalid (calls with
    problems, and tags that hold no JSON object with an id), depth (of its deepest call, else null), json: the message in canonical form, its calls in
    topological order, then by place, with depth, problems and result.

    Nulls in any column are null in the JSON. Empty texts have no calls; rows without a conversation or turn are
    formatted but not searched for calls. Of several calls or results of one identifier the first counts, later calls
    are marked as duplicates; a result before its call isn't linked. Calls in and behind cycles have no depth and come
    last. Rows that repeat each other are formatted alike and counted once as calls. A tag whose content can't be read,
    or not be written again, is broken, and a schema that can't be applied is a problem of the calls that it is for, so
    no message stops the job. Texts are read whole; an empty table gives none; extra columns are ignored.
    """
    c = chats.select(F.col(conv_id).alias("_conv"), F.col(turn).cast("long").alias("turn"), F.col(role).cast("string").alias("role"), F.col(text).alias("text"))
    c = c.withColumns({"conv": F.col("_conv").cast("string"), "th": F.xxhash64("role", "text")})
    tagged = c.where(F.contains("text", F.lit("<tool")) & F.col("conv").isNotNull() & F.col("turn").isNotNull())
    parts = cut(tagged.select("conv", "turn", "th", "text").distinct().mapInArrow(_parts, _PARTS))
    calls = linked_calls(parts, schemas)
    broken = parts.where("kind = 'broken'").groupBy("conv", "turn", "th").agg(F.count("*").alias("broken"))
    per = calls.groupBy("conv", "turn", "th").agg(F.collect_list(F.struct("pos", "call", "name", "body", "result", "again", "depth", "problems")).alias("calls"))
    full = c.join(per, ["conv", "turn", "th"], "left").join(broken, ["conv", "turn", "th"], "left")
    number = lambda test: F.coalesce(F.size(F.filter("calls", test)), F.lit(0))
    counted = F.struct(
        F.greatest(number(lambda x: F.lit(True)), F.lit(0)).alias("n_calls"),
        F.greatest(number(lambda x: x["result"].isNotNull()), F.lit(0)).alias("n_linked"),
        (F.greatest(number(lambda x: F.size(x["problems"]) > 0), F.lit(0)) + F.coalesce("broken", F.lit(0))).alias("n_invalid"),
        F.array_max(F.transform("calls", lambda x: x["depth"])).alias("depth"),
    )
    kind = dict(chats.dtypes)[conv_id]
    out = full.select(F.col("_conv").alias("c0"), "turn", "role", "text", "calls", F.col("_conv").alias("conv"), F.col("turn").alias("t2"), counted.alias("n"))
    out = out.mapInArrow(_written, f"conv {kind}, turn long, calls struct<n_calls:int,n_linked:int,n_invalid:bigint,depth:bigint>, json string")
    return out.select(F.col("conv").alias(conv_id), F.col("turn").alias(turn), *(F.col(f"calls.{x}").cast("long").alias(x) for x in ("n_calls", "n_linked", "n_invalid", "depth")), "json")


def digest(json_text: Column) -> Column:
    return F.sha2(json_text, 256)


def write_jsonl(messages: DataFrame, path: str, conv_id: str = "conv_id", turn: str = "turn") -> None:
    """One message a line, by conversation and turn, in files that split the whole range, large conversations too."""
    messages.repartitionByRange(conv_id, turn).sortWithinPartitions(conv_id, turn).select("json").write.text(path)


#: Tools that with_calls() calls.
TOOLS = {
    "measure": {"type": "object", "required": ["chars"], "properties": {"chars": {"type": "integer", "maximum": 1500}}, "additionalProperties": False},
    "follow": {"type": "object", "required": ["last", "size"], "properties": {"size": {"type": "integer"}}},
}


def with_calls(chats: DataFrame) -> DataFrame:
    """conversations with calls by a fixed rule, as the tables have none: each assistant turn calls `measure` with the
    length of its text, and before it, in the text, `follow`, which names that call and the one of the turn before the
    last; a user turn gives its own length as the result of the `measure` of the turn before."""
    turn = lambda by: (F.col("turn") - by).cast("string")
    text = F.coalesce("text", F.lit(""))
    chars = F.length(text).cast("string")
    follow = F.concat(F.lit('<tool_call>{"id":"b'), turn(0), F.lit('","name":"follow","arguments":{"size":{"$result":"a'), turn(0), F.lit('"},"last":{"$result":"b'), turn(2), F.lit('"}}}</tool_call>'))
    measure = F.concat(F.lit('<tool_call>{"id":"a'), turn(0), F.lit('","name":"measure","arguments":{"chars":'), chars, F.lit("}}</tool_call>"))
    result = F.concat(F.lit('<tool_result>{"id":"a'), turn(1), F.lit('","content":'), chars, F.lit("}</tool_result>"))
    said = F.when(F.col("role") == "assistant", F.concat(text, follow, measure)).when(F.col("role") == "user", F.concat(text, result)).otherwise(F.col("text"))
    return chats.withColumn("text", said)


def query(spark, sf_dir: str) -> DataFrame:
    r = format_messages(with_calls(table(spark, sf_dir, "conversations")), schemas=TOOLS)
    return r.select("conv_id", "turn", "n_calls", "n_linked", "n_invalid", "depth", digest(F.col("json")).alias("json_sha256"))


SQL = r"""
WITH c AS (SELECT conv_id, turn, role, text, length(coalesce(text, '')) AS chars, role = 'assistant' AS calls FROM conversations),
i AS (SELECT conv_id, turn, turn - 2 * row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS run FROM c WHERE calls),
b AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, turn % 2, run ORDER BY turn) AS depth FROM i),
m AS (SELECT c.conv_id, c.turn, c.role, c.calls, c.chars, b.depth, u.chars AS result,
  CASE WHEN c.role = 'user' THEN coalesce(c.text, '') || '<tool_result>{"id":"a' || (c.turn - 1) || '","content":' || c.chars || '}</tool_result>' WHEN c.calls THEN coalesce(c.text, '') ELSE c.text END AS said
  FROM c LEFT JOIN b USING (conv_id, turn) LEFT JOIN c u ON u.conv_id = c.conv_id AND u.turn = c.turn + 1 AND u.role = 'user')
SELECT conv_id, turn, CAST(CASE WHEN calls THEN 2 ELSE 0 END AS BIGINT) AS n_calls, CAST(CASE WHEN calls AND result IS NOT NULL THEN 1 ELSE 0 END AS BIGINT) AS n_linked,
  CAST(CASE WHEN calls AND chars > 1500 THEN 1 ELSE 0 END AS BIGINT) AS n_invalid, CAST(depth AS BIGINT) AS depth,
  sha256('{"content":' || coalesce(CAST(to_json(said) AS VARCHAR), 'null') || ',"conversation":' || coalesce(CAST(conv_id AS VARCHAR), 'null') || ',"role":' || coalesce(CAST(to_json(role) AS VARCHAR), 'null')
    || CASE WHEN calls THEN ',"tool_calls":[{"arguments":{"chars":' || chars || '},"depth":0,"duplicate":false,"id":"a' || turn || '","name":"measure","problems":['
      || CASE WHEN chars > 1500 THEN '"$.chars: above maximum"' ELSE '' END || ']' || CASE WHEN result IS NOT NULL THEN ',"result":' || result ELSE '' END
      || '},{"arguments":{"last":{"$result":"b' || (turn - 2) || '"},"size":{"$result":"a' || turn || '"}},"depth":' || depth || ',"duplicate":false,"id":"b' || turn || '","name":"follow","problems":[]}]' ELSE '' END
    || ',"turn":' || coalesce(CAST(turn AS VARCHAR), 'null') || '}') AS json_sha256
FROM m
"""
