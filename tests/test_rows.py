"""Row operators: normalise, framing, JSON decode, leaf text, evidence, parameters."""

from datetime import datetime, timezone

import pytest
from conftest import T0, message
from pyspark.sql import functions as F

import bustrace as b
from bustrace.functions.framing import schema_id_sql
from bustrace.functions.params import parse_headers, parse_iso_utc, parse_list
from bustrace.functions.text import float_sql, leaf_sql, path_equals, payload_may_hold
from bustrace.operators.decode import _ONE_OBJECT


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "payload, expected",
    [
        (b"\0\0\0\0\x07x", 7),
        (b"\0\0\0\1\0payload", 256),
        (b"\0\xff\xff\xff\xff", 2**32 - 1),
        (b"\1\0\0\0\x07", None),
        (b"\0\1\2\3", None),
        (b"", None),
        (None, None),
    ],
)
def test_schema_id(spark, payload, expected):
    df = spark.createDataFrame([(payload,)], "p binary")
    assert df.select(F.expr(schema_id_sql("p"))).first()[0] == expected


def test_normalize(bus):
    rows = b.normalize(
        bus(
            message("t", 0, None, key=b"a\xffb", headers=[("h", "1"), ("g", None), ("h", b"2\xff")]),
            message("t", 1, "x", headers=None, ts_type=1),
            message("t", 2, "x", key="k", ts_type=-1),
        )
    ).orderBy("offset").collect()
    assert rows[0]["key"] == "a�b" and rows[0]["raw_key"] == b"a\xffb"
    assert rows[0]["headers"] == {"g": "None", "h": "2�"}
    assert rows[0]["raw"] == b"" and rows[0]["timestamp_utc"] == T0.replace(tzinfo=None)
    assert [r["timestamp_fallback"] for r in rows] == [False, True, True]
    assert rows[1]["key"] is None and rows[1]["headers"] == {} and rows[1]["timestamp_utc"] is not None
    assert rows[2]["timestamp_utc"] is None


@pytest.mark.parametrize(
    "payload, status, value",
    [
        ('{"a":1}', "ok", '{"a":1}'),
        (' \n{"a":[1,{"b":null}]} ', "ok", '{"a":[1,{"b":null}]}'),
        ("﻿{}", "ok", "{}"),
        ('{"a":1,"a":2}', "ok", '{"a":2}'),
        ("[1,2]", "non_object", None),
        ("5", "non_object", None),
        ('"text"', "non_object", None),
        ("null", "non_object", None),
        ("{broken", "error", None),
        ('{"a":1} junk', "error", None),
        ('{"a":1}{"b":2}', "error", None),
        ('{"a":1},{"b":2}', "error", None),
        ('{"a":1}]', "error", None),
        ("  ", "error", None),
        (b'{"a":"\xff"}', "error", None),
        ("", "empty", None),
        (None, "empty", None),
        (b"\0\0\0\0\1x", "error", None),
    ],
)
def test_json_decode(bus, payload, status, value):
    df = b.decode(b.normalize(bus(message("t", 0, payload))))
    row = df.select("decode_status", F.to_json("value").alias("value"), "decode_error").first()
    assert (row["decode_status"], row["value"]) == (status, value)
    assert (row["decode_error"] is not None) == (status == "error")


def test_no_registry_decodes_nothing(bus):
    row = b.enrich(bus(message("t", 0, {"order_id": "x"})), registry=False).first()
    assert row["value"] is None and row["decode_status"] == "skipped" and row["keys"]["order_id"] is None


LEAVES = [
    ('"x"', "x"), ('"true"', "true"), ("true", "True"), ("false", "False"), ("null", "None"), ("1", "1"), ("-7", "-7"),
    ("1.0", "1.0"), ("100.0", "100.0"), ("1.50", "1.5"), ("1e20", "1e+20"), ("1E2", "100.0"), ("0.00001", "1e-05"),
    ("0.0001", "0.0001"), ("0.00012", "0.00012"), ("1.5e300", "1.5e+300"), ("12345678.5", "12345678.5"), ("1e16", "1e+16"),
    ("9007199254740993.0", "9007199254740992.0"), ("12345678901234567890", "12345678901234567890"),
    ("0.1234567890123456789", "0.12345678901234568"), ('{"b": [1, 2]}', '{"b":[1,2]}'), ("[]", "[]"),
]


def test_leaf_text(spark):
    df = spark.createDataFrame(LEAVES, "j string, text string").withColumn("v", F.expr("parse_json(j)"))
    for row in df.select("j", "text", F.expr(leaf_sql("v")).alias("got")).collect():
        assert row["got"] == row["text"], row["j"]


def test_float_text(spark):
    numbers = [0.0, 1.0, -2.5, 1e7, 123456789.125, 1e15, 1e16, 1e22, 0.001, 0.0001, 0.00001, 1.25e-7, 1e100, float("inf"), float("nan")]
    df = spark.createDataFrame([(n,) for n in numbers], "d double")
    assert [r[0] for r in df.select(F.expr(float_sql("d"))).collect()] == [str(n) for n in numbers]


def test_path_equals_agrees_with_leaf_text(spark):
    """The search form of the leaf comparison and its prefilter give what comparing texts gives."""
    docs = [(f'{{"a":{{"b":{j}}}}}', text) for j, text in LEAVES] + [('{"a":[1]}', None), ('{"a":{}}', None), ("{}", None)]
    docs += [('{"a":{"b":"1"}}', "1"), ('{"a":{"b":"1.0"}}', "1.0"), ('{"a":{"b":"None"}}', "None"), ('{"a":{"b":"\\u0078"}}', "x")]
    df = spark.createDataFrame(docs, "j string, text string").withColumn("v", F.expr("parse_json(j)"))
    df = df.withColumn("raw", F.col("j").cast("binary")).cache()
    for key in sorted({t for _, t in docs if t} | {"0", "1e5", "x.y", "nan", "{", "true"}):
        hits = df.filter(path_equals("v", "a.b", key) & payload_may_hold("raw", key)).collect()
        assert sorted(r["j"] for r in hits) == sorted(j for j, t in docs if t == key), key


def test_path_segments_are_object_members(spark):
    doc = r'{"a-b":{"0":"x","":{"c\"d":"y"}},"l":["x"]}'
    df = spark.createDataFrame([(doc,)], "j string").select(F.try_parse_json("j").alias("v"))
    found = [df.filter(path_equals("v", p, k)).count() for p, k in [("a-b.0", "x"), ('a-b..c"d', "y"), ("l.0", "x"), ("", "x")]]
    assert found == [1, 1, 0, 0]


def test_evidence(bus):
    rows = b.enrich(
        bus(
            message("t", 0, {"orderId": 7, "order_id": None, "phoneNumber": "1", "customerId": True}, headers={"phone": "2"}),
            message("t", 1, None, headers={"order-id": "h", "product_id": "p"}),
            message("t", 2, {"msisdn": {"nested": 1}}),
        )
    ).orderBy("offset").select("keys.*", "source", "event_type").collect()
    assert tuple(rows[0])[:4] == ("7", "1", "True", None)
    assert tuple(rows[1]) == ("h", None, None, "p", "kafka", "kafka_message")
    assert rows[2]["msisdn"] == '{"nested":1}'


def test_parameters():
    assert parse_iso_utc("2026-06-01T00:00:00Z", "time_from") == datetime(2026, 6, 1, tzinfo=timezone.utc)
    assert parse_iso_utc("2026-06-01T02:00:00+02:00", "x") == datetime(2026, 6, 1, tzinfo=timezone.utc)
    assert parse_iso_utc("2026-06-01", "x").tzinfo is timezone.utc
    assert parse_iso_utc(None, "x") is None
    with pytest.raises(ValueError, match="time_to"):
        parse_iso_utc("yesterday", "time_to")
    assert parse_list(" a, ,b ") == ["a", "b"] and parse_list(None) is None
    assert parse_headers("k=v, x = y=z ,bad") == {"k": "v", "x": "y=z"}


def test_a_forged_end_mark_is_an_error(bus):
    raw = bus(message("t", 0, '{"a":1},"␄end-of-payload"'), message("t", 1, '{"a":1},2'), message("t", 2, '{"a":1}'))
    found = b.decode(b.normalize(raw)).select("offset", "decode_status").collect()
    assert [s for _, s in sorted(found)] == ["error", "error", "ok"]


def test_whole_objects_are_parsed_without_a_list_around_them(bus):
    objects = ['{"a":{"b":[{"c":"}"}]}}', ' {"a":"{","b":{}}\r\n', "{}", '{"a":1,"a":2}']
    others = ['{"a":1}{"b":2}', '{"a":"{"},{"b":"}"}', '{"a":{"b":1}} x', '{"a":1}]', '{"a":"x\\"}"}', '{"a":{"b":{"c":{}}}}', "{a:1}"]
    payloads = bus(*[message("t", o, text) for o, text in enumerate(objects + others)]).orderBy("offset")
    seen = [r[0] for r in payloads.select(F.col("value").cast("string").rlike(_ONE_OBJECT)).collect()]
    assert seen == [True] * len(objects) + [False] * (len(others) - 1) + [True]
    long = '{"a":[' + '"x",{"y":{}},' * 200_000 + "1]}"
    raw = bus(*[message("t", o, text) for o, text in enumerate([*objects, *others, long])])
    decoded = b.decode(b.normalize(raw)).orderBy("offset")
    status = [r["decode_status"] for r in decoded.select("decode_status").collect()]
    assert status == ["ok"] * 4 + ["error"] * 4 + ["ok", "ok", "error", "ok"]
    values = [r[0] for r in decoded.filter("offset < 4").select(F.to_json("value")).collect()]
    assert values == ['{"a":{"b":[{"c":"}"}]}}', '{"a":"{","b":{}}', "{}", '{"a":2}']
    # The list and the mark are made for other payloads only.
    assert "if (_one" in plan_of(decoded)


def test_header_texts_are_the_bytes_where_these_are_text(bus):
    kinds = {
        0: [("a", "x"), ("b", "y")], 1: [("a", "x"), ("a", "é")], 2: [("a", None), ("b", "y")], 3: [("a", b"\xc3"), ("b", b"\xa9")],
        4: [], 5: None, 6: [("a", b"\xff")], 7: [("a", ""), ("b", "é")],
    }
    raw = bus(*[message("t", o, {}, headers=h) for o, h in kinds.items()])
    rows = b.normalize(raw)
    assert "map_from_arrays" in plan_of(rows.select("headers"))
    assert [r["headers"] for r in rows.orderBy("offset").select("headers").collect()] == [
        {"a": "x", "b": "y"}, {"a": "é"}, {"a": "None", "b": "y"}, {"a": "\ufffd", "b": "\ufffd"}, {}, {}, {"a": "\ufffd"},
        {"a": "", "b": "é"},
    ]
