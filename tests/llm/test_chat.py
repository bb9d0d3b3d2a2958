from __future__ import annotations

import json

from lodestack.llm import chat as c


def call(i, name="add", **arguments):
    return "<tool_call>" + json.dumps({"id": i, "name": name, "arguments": arguments}) + "</tool_call>"


def result(i, content):
    return "<tool_result>" + json.dumps({"id": i, "content": content}) + "</tool_result>"


SCHEMA = {"type": "object", "required": ["a"], "properties": {"a": {"type": "integer", "minimum": 0}, "b": {"type": ["string", "null"]}}, "additionalProperties": False}
TOOLS = "<tools>" + json.dumps([{"name": "add", "parameters": SCHEMA}]) + "</tools>"


def got(spark, rows, **more):
    r = c.format_messages(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), **more)
    return {(x.conv_id, x.turn): (x.n_calls, x.n_linked, x.n_invalid, json.loads(x.json)) for x in r.collect()}


def test_calls_are_linked_ordered_and_validated(spark):
    rows = [
        (1, 0, "system", TOOLS),
        (1, 1, "assistant", "first " + call("y", a={"$result": "x"}) + call("x", a=1) + call("z", a=-1, q=2) + " last"),
        (1, 2, "tool", result("x", {"b": 1.0, "a": "é"})),
        (1, 3, "tool", result("x", "later") + result("none", 1) + result("y", None)),
        (1, 4, "assistant", call("x", a="again")),
        (2, 1, "assistant", call("x", a=1)),
        (2, 0, "tool", result("x", "before its call")),
        (2, 2, "assistant", call("p", "other", v={"$result": "q"}) + call("q", "other", v=[{"$result": "p"}]) + call("r", "other", v={"$result": "gone"})),
        (2, 3, "assistant", "<tool_call>{broken</tool_call><tool_call>[1]</tool_call>"),
    ]
    r = got(spark, rows, schemas={"other": {}})
    n, linked, invalid, m = r[1, 1]
    assert (n, linked, invalid) == (3, 2, 1) and m["content"] == "first  last"
    assert [(x["id"], x["depth"], x["problems"]) for x in m["tool_calls"]] == [("x", 0, []), ("z", 0, ["$.a: below minimum", "$.q: unknown"]), ("y", 1, [])]
    assert m["tool_calls"][0]["result"] == {"a": "é", "b": 1} and m["tool_calls"][2]["result"] is None
    assert r[1, 4][:3] == (1, 0, 1) and r[1, 4][3]["tool_calls"][0]["duplicate"] is True
    assert r[2, 1][:3] == (1, 0, 1) and r[2, 1][3]["tool_calls"][0]["problems"] == ["unknown tool"]
    assert [(x["id"], x["depth"]) for x in r[2, 2][3]["tool_calls"]] == [("r", 0), ("p", None), ("q", None)]
    assert r[2, 3][:3] == (0, 0, 2)


def test_long_chains(spark):
    text = "".join(call(f"c{k}", "f", v={"$result": f"c{k - 1}"}) for k in reversed(range(6)))
    m = got(spark, [(1, 0, "assistant", text)], schemas={"f": {}})[1, 0][3]
    assert [x["id"] for x in m["tool_calls"]] == [f"c{k}" for k in range(6)]


def test_nulls_repeats_and_empty(spark):
    rows = [(1, 0, "user", None), (None, 1, None, call("a")), (1, None, "user", ""), (3, 0, "a", call("i", a=1)), (3, 0, "a", call("i", a=1))]
    d = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, th int")
    out = c.format_messages(d)
    assert out.count() == 5
    assert [(r.n_calls, r.n_invalid) for r in out.where("conv_id = 3").collect()] == [(1, 1)] * 2
    assert json.loads(out.where("turn = 0 AND conv_id = 1").first().json) == {"content": None, "conversation": 1, "role": "user", "turn": 0}
    assert c.format_messages(d.limit(0)).count() == 0


def test_canonical():
    assert c.canonical({"b": [1.0, 2.5, True, None], "a": "é\n/"}) == '{"a":"é\\n/","b":[1,2.5,true,null]}'
    assert c.problems([1, "x"], {"type": "array", "items": {"type": "number", "maximum": 3}}) == ["$[1]: not number"]
    assert c.problems(True, {"type": "integer"}) == ["$: not integer"] and c.problems(2.0, {"type": "integer"}) == []
    assert c.problems("ab", {"pattern": "^b", "maxLength": 1, "enum": ["x"]}) == ["$: not one of the allowed values", "$: too long", "$: against the pattern"]


def test_every_keyword_binds():
    bad = [
        (5, {"anyOf": [{"type": "string"}, {"minimum": 6}]}),
        (5, {"oneOf": [{"type": "integer"}, {"minimum": 4}]}),
        (5, {"oneOf": [{"type": "string"}]}),
        (5, {"allOf": [{"minimum": 1}, {"maximum": 4}]}),
        (5, {"not": {"type": "integer"}}),
        (5, {"exclusiveMinimum": 5}),
        (5, {"exclusiveMaximum": 5}),
        (5, {"maximum": 5, "exclusiveMaximum": True}),
        (0.35, {"multipleOf": 0.1}),
        (5, {"$ref": "#/$defs/a", "$defs": {"a": {"maximum": 4}}}),
        (5, {"$ref": "#/$defs/a~1b%20", "$defs": {"a/b ": {"maximum": 4}}}),
        (5, {"$ref": "#"}),
        (5, {"$ref": "other.json"}),
        (5, {"if": {"type": "integer"}, "then": {"maximum": 4}}),
        (5, False),
        ([], {"minItems": 1}),
        ([1, 2], {"maxItems": 1}),
        ([1, 1.0], {"uniqueItems": True}),
        ([1, "x"], {"prefixItems": [{}, {"type": "integer"}]}),
        ([1, 2], {"items": [{}], "additionalItems": False}),
        ([1], {"contains": {"type": "string"}}),
        ({"x1": "y"}, {"patternProperties": {"^x": {"type": "integer"}}}),
        ({"xy": 1}, {"propertyNames": {"maxLength": 1}}),
        ({"a": 1}, {"dependentRequired": {"a": ["b"]}}),
        ({}, {"minProperties": 1}),
        ({"a": 1}, {"maxProperties": 0}),
        ({"a": 1}, {"unevaluatedProperties": False}),
        ({"a": {"a": {"a": 1}}}, {"additionalProperties": {"$ref": "#"}, "type": "object"}),
    ]
    for value, schema in bad:
        assert len(c.problems(value, schema)) == 1, (value, schema)
    good = [
        (5, {"anyOf": [{"type": "string"}, {"minimum": 5}], "oneOf": [{"maximum": 4}, {"maximum": 5}], "not": {"type": "string"}, "multipleOf": 2.5, "exclusiveMinimum": 4.9, "exclusiveMaximum": 6}),
        (0.3, {"multipleOf": 0.1}),
        ([1, True, "1", [1], None], {"uniqueItems": True, "minItems": 5, "maxItems": 5, "contains": {"type": "null"}}),
        ({"x1": 1, "b": "s"}, {"patternProperties": {"^x": {"type": "integer"}}, "properties": {"b": {}}, "additionalProperties": False}),
        ({"a": {"a": {}}}, {"additionalProperties": {"$ref": "#"}, "type": "object"}),
        ({"a": {"$result": "x"}}, {"not": {"properties": {"a": {"type": "string"}}}, "oneOf": [{"properties": {"a": {"type": k}}} for k in ("string", "null")]}),
        (5, {"title": "t", "format": "date", "x-own": 1, "if": {"type": "string"}, "then": False}),
    ]
    for value, schema in good:
        assert c.problems(value, schema) == [], (value, schema)


def test_calls_against_other_keywords_are_invalid(spark):
    rule = {"type": "object", "properties": {"a": {"$ref": "#/$defs/few"}}, "$defs": {"few": {"type": "array", "maxItems": 1}}}
    tools = "<tools>" + json.dumps([{"name": "add", "parameters": rule}]) + "</tools>"
    r = got(spark, [(1, 0, "system", tools), (1, 1, "assistant", call("x", a=[1]) + call("y", a=[1, 2]))])
    assert r[1, 1][2] == 1 and r[1, 1][3]["tool_calls"][1]["problems"] == ["$.a: too many items"]


def test_files_split_the_range(spark, tmp_path):
    rows = [(1, k, "user", f"t{k}") for k in range(50)] + [(2, 0, "user", "x")]
    c.write_jsonl(c.format_messages(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")), str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 51


def test_depths_of_any_links(spark):
    """Chains, trees, shared needs and cycles against the definition."""
    rng = __import__("random").Random(3)
    needs = {f"c{k}": [f"c{k - 1}"] * (k > 0) for k in range(200)}
    needs |= {f"d{k}": sorted({f"d{rng.randrange(k)}" for _ in range(rng.randrange(4))}) if k else [] for k in range(60)}
    needs |= {"x": ["y"], "y": ["z"], "z": ["x"], "w": ["z", "c3"], "s": ["s"], "t": ["s"], "u": ["gone"], "v": ["u", "c150"]}
    known: dict[str, int] = {}
    while True:
        ready = {k: max((known[n] + 1 for n in v if n in needs), default=0) for k, v in needs.items() if k not in known and all(n in known for n in v if n in needs)}
        if not ready:
            break
        known |= ready
    calls = spark.createDataFrame([("1", k, v) for k, v in needs.items()], "conv string, call string, needs array<string>")
    for most in (c.PASS_BYTES, 0):
        assert {r.call: r.depth for r in c.depths(calls, most).collect()} == {k: known.get(k) for k in needs}


def test_a_ladder_takes_no_rounds(spark, monkeypatch):
    """10,000 calls that each need the two before them, beside a large conversation that is contracted."""
    made = []
    cut = c.cut
    monkeypatch.setattr(c, "cut", lambda df: made.append(1) or cut(df))
    ladder = [("1", f"c{k}", [f"c{k - j}" for j in (1, 2) if k >= j]) for k in range(10_000)]
    other = [(str(k), "a", ["a"] if k % 2 else None) for k in range(2, 40)]
    calls = spark.createDataFrame(ladder + other, "conv string, call string, needs array<string>")
    r = {(x.conv, x.call): x.depth for x in c.depths(calls).collect()}
    assert len(made) == 1 and len(r) == len(ladder) + len(other)
    assert all(r["1", f"c{k}"] == k for k in range(10_000)) and all(r[str(k), "a"] == (None if k % 2 else 0) for k in range(2, 40))
    both = spark.createDataFrame([("1", f"c{k}", [f"c{k - 1}"] * (k > 0)) for k in range(100)] + other, "conv string, call string, needs array<string>")
    r = {(x.conv, x.call): x.depth for x in c.depths(both, 500).collect()}
    assert all(r["1", f"c{k}"] == k for k in range(100)) and r["2", "a"] == 0 and r["3", "a"] is None and len(made) < 14
    assert c.depths(both.limit(0)).count() == 0


def test_messages_and_schemas_of_any_kind(spark):
    odd = ['{"id":1,"arguments":{"x":1e999}}', '{"id":"\\ud800"}', '{"id":2,"arguments":{"a":"\\udc00"}}', '{"id":3,"arguments":' + "[" * 3000 + "]" * 3000 + "}", '{"id":4,"arguments":NaN}']
    text = "".join(f"<tool_call>{x}</tool_call>" for x in odd)
    assert got(spark, [(1, 0, "assistant", text)])[1, 0][:3] == (0, 0, 5)
    bad = [{"pattern": "("}, {"properties": {"a": {"minimum": "x"}}}, {"properties": []}, {"required": 5}, {"properties": {"a": {"type": "integer", "multipleOf": 1e-320}}}]
    big = "<tool_call>" + json.dumps({"id": "n", "name": "t0", "arguments": {"a": 10**400}}) + "</tool_call>"
    rows = [(1, 0, "assistant", "".join(call(f"i{k}", f"t{k}", a="s" if k == 0 else 1) for k in range(len(bad))) + big)]
    n, _, invalid, m = got(spark, rows, schemas={f"t{k}": v for k, v in enumerate(bad)})[1, 0]
    assert n == 6 and len(m["tool_calls"]) == 6 and c.problems(10**400, {"type": "integer"}) == []
    assert c.checked("s", {"pattern": "("}) == ["$: the schema can't be applied: PatternError"] and invalid == 2


def test_calls_of_the_query(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "x" * 1501), (1, 2, "user", "abc"), (1, 3, "assistant", "é"), (1, 4, "system", None), (1, 7, "assistant", "")]
    r = c.format_messages(c.with_calls(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")), schemas=c.TOOLS)
    assert sorted((x.turn, x.n_calls, x.n_linked, x.n_invalid, x.depth) for x in r.collect()) == [(0, 0, 0, 0, None), (1, 2, 1, 1, 1), (2, 0, 0, 0, None), (3, 2, 0, 0, 2), (4, 0, 0, 0, None), (7, 2, 0, 0, 1)]
