import json

from bustrace.llm import toolcalls

CALL = "conv_id long, call_id string, turn long, name string, arguments string, needs array<string>, json string"
RESULT = "conv_id long, call_id string, turn long, content string, layer string"
TOOLS = {
    "get": {"q": ("string", True), "n": ("integer", False), "deep": ("object", False)},
    "put": {"x": ("number", True), "on": ("boolean", False), "list": ("array", False), "nil": ("null", False)},
    "none": {},
}


def link(spark, calls, results):
    calls = spark.createDataFrame([(*c, "x") for c in calls], CALL)
    results = spark.createDataFrame([(*r, "x") for r in results], RESULT)
    return toolcalls.link_tool_calls(calls, results, TOOLS)


def by_id(df):
    return {(r["conv_id"], r["call_id"]): r for r in df.collect()}


def test_links_order_and_status(spark):
    calls = [
        (1, "c", 5, "get", '{"q": "x"}', ["a", "b"]),
        (1, "b", 3, "get", '{"q": "x"}', ["a", "gone"]),
        (1, "a", 1, "get", '{"q": "x"}', None),
        (1, "late", 0, "get", '{"q": "x"}', ["c"]),
        (2, "a", 1, "get", '{"q": "x"}', ["b"]),
        (2, "b", 2, "get", '{"q": "x"}', ["a"]),
        (2, "z", 9, "get", '{"q": "x"}', []),
        (None, "a", 1, "get", "{}", []),
        (1, None, 1, "get", "{}", []),
    ]
    results = [(1, "a", 2, "r"), (1, "lost", 1, "s"), (1, "b", None, None), (None, None, None, None)]
    got = by_id(link(spark, calls, results))
    order = [i for i in sorted(got, key=lambda k: got[k]["position"]) if i[0] == 1]
    assert [i[1] for i in order] == ["a", "b", "c", "late", "lost"]
    assert [got[i]["position"] for i in order] == list(range(5))
    assert [got[i]["layer"] for i in order] == [0, 1, 2, 3, None]
    assert [got[i]["status"] for i in order] == ["linked", "linked", "unanswered", "unanswered", "orphan"]
    assert got[1, "b"]["n_missing"] == 1
    assert [(got[2, x]["layer"], got[2, x]["position"]) for x in "zab"] == [(0, 0), (None, 1), (None, 2)]
    assert len(got) == 8


def test_repeated_ids_are_reduced(spark):
    calls = [(1, "a", t, "get", '{"q": "x"}', []) for t in (4, 2, 2)]
    results = [(1, "a", 5, "second"), (1, "a", 3, "first")]
    (row,) = link(spark, calls, results).collect()
    assert (row["turn"], row["result_turn"], row["copies"]) == (2, 3, 5)
    assert json.loads(row["json"])["result"] == "first"


def test_arguments_are_validated(spark):
    cases = {
        '{"q":"a","n":3,"deep":{"z":1}}': ("get", ""),
        '{"n":3}': ("get", "missing:q"),
        '{"q":1,"n":"3","w":0}': ("get", "type:n,type:q,unknown:w"),
        '{"q":"a","n":3.5}': ("get", "type:n"),
        '{"x":3.5,"on":true,"list":[],"nil":null}': ("put", ""),
        '{"x":12345678901234567890,"on":0,"list":{},"nil":1}': ("put", "type:list,type:nil,type:on"),
        "{}": ("none", ""),
        '{"a":1}': ("none", "unknown:a"),
        "[1]": ("get", "arguments"),
        "not json": ("get", "arguments"),
        '{"b":1} ': ("other", "tool"),
    }
    calls = [(1, text, i, name, text, []) for i, (text, (name, _)) in enumerate(cases.items())]
    calls.append((1, "null", 99, None, None, []))
    got = by_id(link(spark, calls, []))
    for text, (_, errors) in cases.items():
        assert (got[1, text]["errors"], got[1, text]["valid"]) == (errors, not errors)
    assert got[1, "null"]["errors"] == "arguments"


def test_json_is_canonical(spark):
    odd = 'line\n"quoted" \\ é 漢 \U0001f642 \x01'
    arguments = json.dumps({"b": 1, "a": {"d": [1, 2, {"z": None, "y": odd}], "c": True}}, indent=2)
    (row,) = link(spark, [(1, "i", 1, "get", arguments, ["n2", "n1", "n1"])], [(1, "i", 2, odd)]).collect()
    whole = {"arguments": json.loads(arguments), "id": "i", "name": "get", "needs": ["n1", "n2"], "result": odd}
    assert json.loads(row["json"]) == whole
    plain = json.dumps(whole, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert row["json"].replace("\\u0001", "") == plain.replace("\\u0001", "")


def test_one_very_long_conversation(spark):
    n = 500
    calls = [(1, f"c{i}", i, "none", "{}", [f"c{i // 2}"] if i else []) for i in range(n)]
    got = by_id(link(spark, calls, []))
    order = sorted(got.values(), key=lambda r: r["position"])
    assert [r["position"] for r in order] == list(range(n))
    place = {r["call_id"]: r["position"] for r in order}
    assert all(place[f"c{i // 2}"] < place[f"c{i}"] for i in range(1, n))


def test_no_python_in_the_plan_and_empty_tables(spark):
    df = link(spark, [], [])
    assert df.collect() == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_repeated_keys_whatever_the_session_says(spark):
    name = "spark.sql.variant.allowDuplicateKeys"
    before, rows = spark.conf.get(name, None), []
    try:
        for value in ("true", "false"):
            spark.conf.set(name, value)
            found = link(spark, [(1, "a", 1, "get", '{"q":"x","q":"y"}', [])], [])
            rows.append(found.select("valid", "errors", "json").first())
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
    assert rows[0] == rows[1] and rows[0]["valid"] and json.loads(rows[0]["json"])["arguments"] == {"q": "y"}


def test_whole_floats(spark):
    (row,) = link(spark, [(1, "a", 1, "get", '{"q":"x","n":1.0}', [])], []).collect()
    assert row["valid"] and '"n":1,' in row["json"]


def test_a_long_chain_has_a_small_plan(spark):
    calls = [(1, f"c{i:03}", i, "get", '{"q":"x"}', [f"c{i - 1:03}"] if i else []) for i in range(25)]
    found = link(spark, calls, [])
    assert [r["layer"] for r in found.orderBy("position").collect()] == list(range(25))
    layers = toolcalls.topological_layers(spark.createDataFrame([(c[0], c[1], c[5]) for c in calls], "conv_id long, call_id string, needs array<string>"))
    assert layers._jdf.queryExecution().optimizedPlan().toString().count("parquet") <= 4
