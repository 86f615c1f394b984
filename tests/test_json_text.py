"""Exported JSON that keeps the payload's text, and JSON paths that go down to any depth."""

import base64
import json
import random

from conftest import message
from pyspark.sql import functions as F

import bustrace as b
from bustrace.functions.identifiers import correlation_ids
from bustrace.functions.jsonpath import compile_path, matches
from bustrace.functions.text import leaf_text

PAYLOADS = [
    '{"a": 1.0, "b":1e20,\n "c":  1234567890123456789012345678901234567890, "d":-0.50, "e":{"z":[1.0, 2 , {"y":1.10}],"x":null}}',
    '{"text":"a  b \\" c\\\\", "blank \\t name":"\\u00e9 {[", "order_id":"1.0"}',
    '﻿ {"b":2,"a":{"d":1,"c":2}}',
    "{}",
    "[1.0]",
    "{broken",
    None,
]


def test_export_and_import_are_inverse(bus):
    raw = bus(*[message("t", o, p, key=f"k{o}") for o, p in enumerate(PAYLOADS)])
    full = b.enrich(raw)
    lines = b.export_json(full, payload_text=True)
    for text in (r["value"] for r in lines.collect()):
        json.loads(text)
    back = b.import_json(lines)

    def seen(df):
        leaf = F.expr("try_variant_get(value, '$.a', 'variant')")
        deep = F.expr("try_variant_get(value, '$.e.z[0]', 'variant')")
        columns = ["offset", "key", "raw", leaf_text("value").alias("v"), F.expr("schema_of_variant(value)").alias("s")]
        found = df.withColumns({"_a": leaf, "_z": deep})
        return sorted(map(repr, found.select(*columns, leaf_text("_a").alias("a"), leaf_text("_z").alias("z")).collect()))

    assert seen(back) == seen(full)
    again = b.export_json(b.enrich(raw), payload_text=True)
    assert sorted(r["value"] for r in again.collect()) == sorted(r["value"] for r in lines.collect())


def test_values_are_written_as_the_payload_has_them(bus):
    raw = bus(*[message("t", o, p) for o, p in enumerate(PAYLOADS)])
    lines = {json.loads(r["value"])["offset"]: r["value"] for r in b.export_json(b.enrich(raw), payload_text=True).collect()}
    value = lines[0].split('"value":')[1].split(',"timestamp_utc"')[0]
    assert value == PAYLOADS[0].replace(" ", "").replace("\n", "")
    assert '"value":' + '{"text":"a  b \\" c\\\\","blank \\t name":"\\u00e9 {[","order_id":"1.0"}' in lines[1]
    assert '"value":{"b":2,"a":{"d":1,"c":2}}' in lines[2] and '"value":{}' in lines[3]
    assert all('"value":null' in lines[o] for o in (4, 5, 6))


def test_long_texts_need_no_stack(bus):
    text = "x y\\n" * 200_000
    raw = bus(message("t", 0, '{"a": "' + text + '"}'))
    line = b.export_json(b.enrich(raw), payload_text=True).first()["value"]
    assert json.loads(line)["value"]["a"] == json.loads(f'"{text}"')


def everything(node):
    yield node
    for child in node.values() if isinstance(node, dict) else node if isinstance(node, list) else []:
        yield from everything(child)


def test_descent_to_any_depth(bus):
    rng = random.Random(2)

    def some(depth):
        kind = rng.random()
        if depth == 0 or kind < 0.3:
            return rng.choice([1, 1.0, 2.5, "t{[", True, None, 10**20, "deep"])
        if kind < 0.6:
            return [some(depth - 1) for _ in range(rng.randint(0, 3))]
        return {rng.choice("abcx"): some(depth - 1) for _ in range(rng.randint(0, 3))}

    docs = [{"r": some(6)} for _ in range(60)]
    chain = {"x": 1.0}
    for _ in range(70):
        chain = {"a": [chain]}
    docs.append(chain)
    raw = bus(*[message("t", o, d) for o, d in enumerate(docs)])
    found = {}
    for r in correlation_ids(b.enrich(raw), jsonpath_expressions=["$..x", "$.r..a..b", "$..c[0]"]).filter("method <> 'standard'").collect():
        found.setdefault((r["offset"], r["method"]), set()).add(r["id"])

    def text(x):
        if isinstance(x, dict | list):
            return None
        return str(x)

    wanted = {}
    for o, d in enumerate(docs):
        for n in everything(d):
            if isinstance(n, dict) and "x" in n:
                wanted.setdefault((o, "jsonpath:$..x"), set()).add(text(n["x"]))
            if isinstance(n, dict) and isinstance(n.get("c"), list) and n["c"]:
                wanted.setdefault((o, "jsonpath:$..c[0]"), set()).add(text(n["c"][0]))
        for n in everything(d.get("r")):
            if isinstance(n, dict) and "a" in n:
                for m in everything(n["a"]):
                    if isinstance(m, dict) and "b" in m:
                        wanted.setdefault((o, "jsonpath:$.r..a..b"), set()).add(text(m["b"]))

    def plain(places):
        # Nested values read as JSON text, which is tested elsewhere.
        return {k: {x for x in v if x is not None and x[:1] not in "{["} for k, v in places.items()}

    assert {k: v for k, v in plain(found).items() if v} == {k: v for k, v in plain(wanted).items() if v}


def test_no_python_in_a_descent(bus):
    found = correlation_ids(b.enrich(bus(message("t", 0, {"a": 1}))), jsonpath_expressions=["$..a"])
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()


DOCUMENTS = [
    '{"a":{"b":[{"id":1},{"id":"x"},[{"id":null}]]},"id":true}',
    '{"a":"id","b":["a","id"]}',
    '{"\\u0069d":5,"a b":{"id":{"id":2.50}}}',
    '{"i\\"d":1,"é":{"id":7}}',
    '[{"id":3},4]',
    '"id"',
    "null",
    None,
]
PATHS = ["$.id", "$..id", "$.a..id", "$.a.b[*].id", "$['a b'].id", "$.*", "$..id.id", "$.b[*]", "$['é'].id", "$['i\"d']"]


def test_a_path_is_walked_only_where_the_text_names_its_members(spark):
    """Same matches with and without the document's text."""
    docs = spark.createDataFrame([(d,) for d in DOCUMENTS], "line string").selectExpr("try_parse_json(line) as doc")
    docs = docs.selectExpr("doc", "to_json(doc) as _text")
    for path in PATHS:
        steps = compile_path(path)
        row = docs.select(matches("doc", steps).alias("every"), matches("doc", steps, "_text").alias("named")).collect()
        assert [r["every"] for r in row] == [r["named"] for r in row], path
    ids = docs.select(matches("doc", compile_path("$..id"), "_text").alias("ids")).collect()
    assert [sorted(r["ids"]) for r in ids] == [["1", "None", "True", "x"], [], ['2.5', '5', '{"id":2.5}'], ["7"], ["3"], [], [], []]


def test_lines_are_made_before_they_are_read(spark, bus):
    """Between export and import stands a generator, so the line is no argument of ``from_json``."""
    plan = b.import_json(b.export_json(b.enrich(bus(message("t", 0, {"a": 1})))))._jdf.queryExecution().optimizedPlan().toString()
    reading = [line for line in plan.splitlines() if "from_json" in line]
    assert reading and not any("StructsToJson" in line for line in reading)


def test_payloads_without_a_mark_or_line_breaks_cost_no_search(spark, bus):
    messages = b.decode(b.normalize(bus(message("t", 0, {"a": 1}, key="k"))))
    assert "regexp_replace" not in messages._jdf.queryExecution().optimizedPlan().toString()
    raw = [bytes(range(n)) for n in range(200)]
    rows = b.enrich(bus(*[message("t", n, data, key=data) for n, data in enumerate(raw)]))
    for chunked in ("true", "false"):
        spark.conf.set("spark.sql.legacy.chunkBase64String.enabled", chunked)
        try:
            lines = [json.loads(r["value"]) for r in b.export_json(rows).collect()]
        finally:
            spark.conf.unset("spark.sql.legacy.chunkBase64String.enabled")
        assert {r["offset"]: (r["raw"], r["raw_key"]) for r in lines} == {
            n: (base64.b64encode(data).decode(), base64.b64encode(data).decode()) for n, data in enumerate(raw)
        }
