import json

import pytest
from hypothesis import given, strategies as st
from test_components import GRAPHS

import __spark_entry__ as driver
from marketlens.llm.queries import CALL_SCHEMAS
from marketlens.llm.shared import Shared
from marketlens.llm.toolcalls import canonical, faults, levels, link_tool_calls, parsed

CALLS = "conv long, call string, seq long, name string, arguments string, after array<string>, row int"
RESULTS = "conv long, call string, seq long, content string, owner int"
SCHEMAS = {"f": {"type": "object", "required": ["x"], "additionalProperties": False,
                 "properties": {"x": {"type": "integer", "minimum": 0}, "y": {"type": "string"}}}}


def run(spark, calls, results):
    got = link_tool_calls(spark.createDataFrame([(*c, 1) for c in calls], CALLS),
                          spark.createDataFrame([(*r, 1) for r in results], RESULTS), SCHEMAS)
    return got.collect()


def test_links_order_and_validity(spark):
    calls = [
        (1, "a", 5, "f", '{"x":1}', ["b"]), (1, "b", 7, "f", '{"y":"é","x":2.0}', []),
        (1, "c", 8, "f", '{"x":-1,"z":0}', ["a", "b"]), (1, "d", 9, "g", "{}", ["nope", "d"]),
        (2, "a", 1, "f", "{", None), (2, "a", 2, "f", '{"x":3}', []),
        (3, "p", 1, "f", '{"x":1}', ["q"]), (3, "q", 2, "f", '{"x":1}', ["p"]),
        (3, "r", 3, "f", '{"x":1}', ["q"]), (None, "a", 1, "f", '{"x":1}', []),
        (4, None, 1, "f", None, [None]), (5, "t", 1, "f", '{"x":1}', []),
        (5, "t", 1, "f", '{"x":1}', []),
    ]
    results = [(1, "a", 6, "ra"), (1, "a", 6, "ra"), (1, "b", 8, None), (9, "a", 1, "o"),
               (None, "a", 2, "n"), (4, None, 1, "no id"), (5, "t", 2, "r")]
    rows = run(spark, calls, results)
    by = {}
    for r in rows:
        by.setdefault((r["conv"], r["call"], r["status"]), []).append(r)
    assert len(by["1", "a", "linked"]) == 2 and by["1", "a", "linked"][0]["level"] == 1
    b = by["1", "b", "linked"][0]
    assert (b["level"], b["valid"]) == (0, False)
    assert b["json"] == '{"arguments":{"x":2,"y":"é"},"id":"b","name":"f","result":null}'
    assert b["errors"] == "$.x: not of type integer"
    c = by["1", "c", "unanswered"][0]
    assert c["level"] == 2 and c["errors"] == "$.x: out of range; $.z: unknown"
    d = by["1", "d", "unanswered"][0]
    assert d["errors"] == "$: unknown name; after d: missing; after nope: missing"
    assert by["2", "a", "unanswered"][0]["json"].startswith('{"arguments":"{"')
    assert by["2", "a", "duplicate"][0]["seq"] == 2
    assert {by["3", k, "unanswered"][0]["level"] for k in "pqr"} == {-1}
    assert by[None, "a", "linked"][0]["result_seq"] == 2
    assert by["9", "a", "orphan"][0]["valid"] is False
    assert by["4", None, "unanswered"][0]["errors"] == "$: no arguments"
    assert by["4", None, "orphan"][0]["json"] == '{"id":null,"result":"no id"}'
    assert by["5", "t", "linked"][0]["repeats"] == 2
    assert len(rows) == 15


def test_empty_tables(spark):
    assert run(spark, [], []) == []
    assert [r["status"] for r in run(spark, [], [(1, "a", 1, "x")])] == ["orphan"]
    assert [r["status"] for r in run(spark, [(1, "a", 1, "f", "{}", [])], [])] == ["unanswered"]


@pytest.mark.parametrize("name", ["path", "random", "star", "shuffled path"])
def test_levels_are_longest_chains(spark, name):
    edges = {(a, b) for a, b in GRAPHS[name] if a > b} or {(b, a) for a, b in GRAPHS[name]}
    edges = sorted(edges)[:60] if name != "path" else sorted(edges)[:8]
    depth = {}

    def of(x):
        if x not in depth:
            depth[x] = 1 + max((of(b) for a, b in edges if a == x), default=-1)
        return depth[x]

    needs = spark.createDataFrame([("c", str(a), str(b)) for a, b in edges],
                                  "conv string, call string, dep string")
    got = {int(r["call"]): r["level"] for r in levels(Shared(spark), needs).collect()}
    assert got == {a: of(a) for a, _ in edges}


def test_levels_of_long_single_chains_and_cycles(spark):
    rows = [("c", str(i + 1), str(i)) for i in range(300)] + [(None, "b", "a"), (None, "c", "b")]
    rows += [("z", "x", "y"), ("z", "y", "x"), ("z", "w", "x")]
    needs = spark.createDataFrame(rows, "conv string, call string, dep string")
    got = {(r["conv"], r["call"]): r["level"] for r in levels(Shared(spark), needs).collect()}
    expected = {("c", str(i + 1)): i + 1 for i in range(300)} | {(None, "b"): 1, (None, "c"): 2}
    assert got == expected | {("z", k): -1 for k in "xyw"}


@given(st.recursive(st.none() | st.booleans() | st.integers() | st.text() |
                    st.floats(allow_nan=False, allow_infinity=False),
                    lambda x: st.lists(x) | st.dictionaries(st.text(), x), max_leaves=8))
def test_canonical_form_is_stable(value):
    text = canonical(value)
    assert parsed(text) == (json.loads(text), None)
    assert canonical(json.loads(text)) == text


@pytest.mark.parametrize("text", ["", "{", "NaN", '{"a":1,"a":2}', "[" * 100_000, None])
def test_no_json(text):
    assert parsed(text)[1]


def test_schema_words():
    schema = {"type": "array", "items": {"enum": [1, "a"]}}
    assert list(faults([1, "a", 2], schema)) == ["$[2]: not an allowed value"]
    assert list(faults(True, {"type": "integer"})) == ["$: not of type integer"]
    text = {"type": "string", "minLength": 2, "maxLength": 3, "pattern": "^a"}
    assert [list(faults(v, text)) for v in ("ab", "a", "bbbb")] == [
        [], ["$: too short"], ["$: too long", "$: does not match"]]


@pytest.mark.parametrize("text", [
    '{"x":"\\ud800"}', '{"\\udfff":1}', '["\\ud83d"]', '{"x":["\\ud800\\ud800"]}'])
def test_half_of_a_surrogate_pair_is_no_json(spark, text):
    assert parsed(text) == (None, "$: not JSON")
    (row,) = run(spark, [(1, "a", 1, "f", text, [])], [])
    assert row["errors"] == "$: not JSON" and json.loads(row["json"])["arguments"] == text
    assert parsed('{"x":"\\ud83d\\ude00"}') == ({"x": "\U0001f600"}, None)


@pytest.mark.parametrize("depth", [100, 400, 401, 500, 900, 1500, 5000, 50_000])
@pytest.mark.parametrize("ends", [("[", "]"), ('{"x":', "}")])
def test_nesting(spark, depth, ends):
    text = ends[0] * depth + ("1" if ends[0] != "[" else "") + ends[1] * depth
    (row,) = run(spark, [(1, "a", 1, "f", text, [])], [(1, "a", 2, "r")])
    deep = {"$: nested too deep", "$: not JSON"}
    assert (row["errors"] in deep) == (depth > 400)
    assert (json.loads(row["json"])["arguments"] == text) == (depth > 400)


def test_lists_of_types_and_strict_values():
    schema = {"type": ["object", "null"], "properties": {"v": {"enum": [1, "a", None]}}}
    assert [list(faults(v, schema)) for v in (None, {}, [])] == [
        [], [], ["$: not of type object or null"]]
    assert list(faults({"v": True}, schema)) == ["$.v: not an allowed value"]
    assert list(faults({"v": 1.0}, schema)) == list(faults({"v": None}, schema)) == []


@pytest.mark.parametrize("schema", [
    {"const": 1}, {"oneOf": []}, {"properties": {"a": {"$ref": "#"}}}, {"items": {"not": {}}},
    {"type": "text"}, {"type": ["null", "any"]}, {"additionalProperties": {}}, True])
def test_schemas_that_cannot_be_checked_are_refused(spark, schema):
    empty = spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS)
    with pytest.raises(ValueError):
        link_tool_calls(*empty, {"f": schema})


def test_a_long_chain_next_to_a_diamond(spark):
    rows = [("c", str(i + 1), str(i)) for i in range(3000)]
    rows += [("d", "e", "b"), ("d", "e", "c"), ("d", "b", "a"), ("d", "c", "x"), ("d", "x", "a"),
             ("d", "f", "e"), ("d", "g", "f"), ("d", "g", "a"), ("d", "h", "g")]
    rows += [("k", "p", "q"), ("k", "q", "p"), ("k", "r", "q"), ("k", "r", "a"), ("k", "s", "r"),
             ("k", "t", "s"), ("k", "t", "a"), (None, "m", "n"), (None, "m", "o"), (None, "n", "o")]
    needs = spark.createDataFrame(rows, "conv string, call string, dep string").repartition(4)
    told = levels(Shared(spark), needs)
    assert told._jdf.queryExecution().optimizedPlan().toString().count("Relation") < 6
    got = {(r["conv"], r["call"]): r["level"] for r in told.collect()}
    assert got == {("c", str(i + 1)): i + 1 for i in range(3000)} | {
        ("d", "b"): 1, ("d", "x"): 1, ("d", "c"): 2, ("d", "e"): 3, ("d", "f"): 4, ("d", "g"): 5,
        ("d", "h"): 6, **{("k", k): -1 for k in "pqrst"}, (None, "n"): 1, (None, "m"): 2}


def test_query_matches_brute_force(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()
    asks = {(r["conv_id"], r["turn"]): r for r in turns if r["role"] in ("system", "user")}
    answers = {(r["conv_id"], r["turn"]): r for r in turns if r["role"] not in ("system", "user")}
    expected = []
    for (conv, turn), r in asks.items():
        name = "configure" if r["role"] == "system" else "reply"
        level, at = 0, turn - 2
        while (conv, at) in asks:
            level, at = level + 1, at - 2
        arguments = {k: v for k, v in (("turn", turn), ("text", r["text"])) if v is not None}
        errors = list(faults(arguments, CALL_SCHEMAS[name]))
        if turn >= 2 and (conv, turn - 2) not in asks:
            errors.append(f"after call_{turn - 2}: missing")
        answer = answers.get((conv, turn + 1))
        body = {"arguments": arguments, "id": f"call_{turn}", "name": name,
                "result": answer["text"] if answer else None}
        expected.append((str(conv), f"call_{turn}", turn, name, turn + 1 if answer else None,
                         "linked" if answer else "unanswered", 1, level, not errors,
                         "; ".join(errors), canonical(body)))
    for (conv, turn), r in answers.items():
        if (conv, turn - 1) not in asks:
            expected.append((str(conv), f"call_{turn - 1}", None, None, turn, "orphan", 1, None, False,
                             "$: no call", canonical({"id": f"call_{turn - 1}", "result": r["text"]})))
    got = driver.queries()["op8_tool_calls"](spark, sf_dir).collect()
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
