"""Correlation: extraction, chains, limits, hops, and both join strategies against a plain evaluation."""

import json
import random
from datetime import timedelta

import pytest
from conftest import T0, coords, message
from pyspark.sql import functions as F

import bustrace as b
from bustrace import session
from bustrace.functions.identifiers import correlation_ids
from bustrace.functions.jsonpath import compile_path
from bustrace.model import EVIDENCE_ALIASES, ID_FIELDS, SOURCE_FIELDS
from bustrace.operators.report import correlation_report
from bustrace.plans import correlate as plan


def ids_of(raw, **options):
    return {(r["id"], r["method"]) for r in correlation_ids(b.enrich(raw), **options).collect()}


def chains(df):
    return {(r["topic"], r["partition"], r["offset"]): list(r["correlation_chain"]) for r in df.collect()}


# --- Identifiers ----------------------------------------------------------------------------------------------------


def test_standard_ids(bus):
    raw = bus(
        message(
            "t", 0, {"traceId": "T", "order-id": 0, "session_id": "", "spanId": None, "phone": 5, "deep": {"trace_id": "no"}},
            key="not-an-id", headers={"correlation-id": "C", "x": "no", "productId": "P"},
        )
    )
    assert {i for i, m in ids_of(raw) if m == "standard"} == {"T", "0", "", "5", "C", "P"}


def test_regex_ids(bus):
    raw = bus(message("t", 0, {"note": "ref=ABC-12 ref=DEF-3", "é": "1"}, headers={"via": "ref=H-9"}))
    found = ids_of(raw, regex_patterns=[r"ref=(\w+)-(?P<n>\d+)", r"[A-Z]+-\d+", "(unclosed", r"(?P<a>1)\"(?P=a)?"])
    assert {i for i, m in found if m.startswith("regex:ref")} == {"ABC", "12", "DEF", "3", "H", "9"}
    assert {i for i, m in found if m == r"regex:[A-Z]+-\d+"} == {"ABC-12", "DEF-3", "H-9"}
    assert not any("unclosed" in m for _, m in found)
    with pytest.raises(ValueError, match="JVM"):
        ids_of(raw, regex_patterns=[r"(?(1)a|b)|(x)"])


PATHS = {
    "$.a.b": {"1"}, "a.b": {"1"}, "$['a']['b']": {"1"}, "$.list[0].id": {"x"}, "$.list[-1].id": {"y"}, "$.list[*].id": {"x", "y"},
    "$.list[9].id": set(), "$.a.*": {"1", "True"}, "$.*.b": {"1"}, "$..id": {"x", "y", "z"}, "$.a..id": {"z"} - {"z"},
    "$.nested..id": {"z"}, "$.a[*].b": {"1"}, "$.h": {"head"}, "$.headers.h": {"head"}, "$.nul": {"None"}, "$.f": {"1.0"},
    "$.list[0]": {'{"id":"x"}'}, "$[?(@.x)]": set(), "": set(), "$": set(),
}


def test_jsonpath_ids(bus):
    doc = {
        "a": {"b": 1, "c": True}, "list": [{"id": "x"}, {"id": "y"}], "nested": {"deep": [{"id": "z"}]}, "nul": None, "f": 1.0,
    }
    raw = bus(message("t", 0, doc, headers={"h": "head"}))
    found = ids_of(raw, jsonpath_expressions=list(PATHS))
    for path, expected in PATHS.items():
        assert {i for i, m in found if m == f"jsonpath:{path}"} == expected, path
    assert compile_path("$.a[1:2]") is None and compile_path("$x") is None


# --- One hop --------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def trace(bus):
    return bus(
        message("loans", 1, {"order_id": "LN-9"}, key="LN-9", headers={"trace_id": "RQ-77"}, ts=T0 + timedelta(minutes=1)),
        message("ledger", 2, {"payment_id": "p"}, key="PM-3", headers={"trace_id": "RQ-77"}),
        message("ledger", 3, {"causedBy": "LN-9"}, ts=T0 + timedelta(minutes=2)),
        message("ledger", 4, {"parentId": "LN-9", "source_id": "RQ-77"}, ts=T0 + timedelta(minutes=3)),
        message("ledger", 5, {}, key="LN-9", ts=T0 + timedelta(minutes=4)),
        message("misc", 6, {"order_id": "LN-9"}),
    )


def test_chain_and_details(trace):
    seeds = b.search_messages(trace, "LN-9", topics=["loans"])
    found = b.correlate(trace, seeds, ["ledger"], limit=500).collect()
    assert [(r["offset"], r["correlation_chain"]) for r in found] == [
        (2, ["RQ-77"]), (1, []), (4, ["LN-9"]), (5, ["LN-9"]),
    ]
    detail = found[0]["correlation_details"][0].asDict()
    assert detail == {
        "id": "RQ-77", "direction": "forward", "field": "header:trace_id", "extraction_method": "standard",
        "timestamp": "2026-06-08T12:00:00+00:00",
    }
    assert found[0]["headers"] == {"trace_id": "RQ-77"} and found[0]["key"] == "PM-3"
    both = {r["offset"]: r["correlation_details"] for r in b.correlate(trace, seeds, ["ledger"], bidirectional=True, limit=500).collect()}
    assert set(both) == {1, 2, 3, 4, 5}  # backward off is a subset of backward on
    assert (both[3][0]["direction"], both[3][0]["field"]) == ("backward", "value:causedBy")
    assert both[3][0]["extraction_method"] == "backward_reference"
    assert (both[4][0]["direction"], both[4][0]["field"]) == ("forward", "value:parentId")
    report = correlation_report(b.correlate(trace, seeds, ["ledger"], limit=500)).collect()
    assert report[0]["Chain"] == "RQ-77" and report[1]["Key"] == "LN-9"


def test_limits(bus):
    rows = [message("loans", 0, None, headers={"trace_id": "X"}), message("loans", 1, None, headers={"trace_id": "X"}, ts=T0 - timedelta(days=1))]
    raw = bus(*rows, *[message("logs", o, None, headers={"trace_id": "X"}, ts=T0 + timedelta(minutes=20 - o)) for o in range(10)])
    seeds = b.enrich(raw.filter("topic = 'loans'"))
    assert coords(b.correlate(raw, seeds, ["logs"], limit=5)) == [
        ("loans", 0, 1), ("loans", 0, 0), ("logs", 0, 2), ("logs", 0, 1), ("logs", 0, 0),
    ]
    assert coords(b.correlate(raw, seeds, ["logs"], limit=1)) == [("loans", 0, 1)]
    assert b.correlate(raw, seeds, ["logs"], limit=0).count() == 0
    previous = set()
    for n in (1, 2, 5, 12):  # a smaller limit gives a part of a larger one
        kept = set(coords(b.correlate(raw, seeds, ["logs"], limit=n)))
        assert len(kept) == n and previous <= kept
        previous = kept


def test_no_topics_no_ids_no_seeds(trace):
    seeds = b.enrich(trace.filter("topic = 'ledger'")).withColumn("seed_pos", -F.col("offset"))
    assert [o for _, _, o in coords(b.correlate(trace, seeds, [], limit=3))] == [5, 4, 3]  # input order
    silent = b.enrich(trace.filter("offset = 3"))
    assert chains(b.correlate(trace, silent, ["loans"], limit=500)) == {("ledger", 0, 3): []}
    assert b.correlate(trace, silent.limit(0), ["loans"]).count() == 0
    for bad in ({"max_depth": 0}, {"max_breadth": 0}):
        with pytest.raises(ValueError):
            b.correlate(trace, silent, ["loans"], **bad, limit=500)


def test_patterns_lead_to_messages(bus):
    raw = bus(
        message("a", 0, {"text": "see REF-77", "items": [{"id": "I1"}, {"id": "I2"}]}),
        message("b", 0, {}, key="REF-77"),
        message("b", 1, {"orderId": "I2"}),
    )
    found = b.correlate(raw, b.enrich(raw.filter("topic = 'a'")), ["b"], regex_patterns=[r"REF-\d+"], jsonpath_expressions=["$.items[*].id"])
    methods = {r["offset"]: r["correlation_details"][0]["extraction_method"] for r in found.collect() if r["topic"] == "b"}
    assert methods == {0: r"regex:REF-\d+", 1: "jsonpath:$.items[*].id"}


# --- Hops, and the two join strategies ------------------------------------------------------------------------------


def expected(messages, seeds, follow, depth, breadth, bidirectional):
    """Plain evaluation of the same rules over (topic, offset, key, headers, value)."""

    def ids(m):
        _, _, _, headers, value = m
        found = {str(value[f]) for f in ID_FIELDS if value.get(f) is not None} | {headers[f] for f in ID_FIELDS if f in headers}
        for names in EVIDENCE_ALIASES.values():
            options = [str(value[n]) for n in names if value.get(n) is not None] + [headers[n] for n in names if n in headers]
            found |= set(options[:1])
        return found

    def ways(m):
        _, _, key, headers, value = m
        yield from [(0, 0, key)] if key is not None else []
        yield from ((1 + i, 0, headers[f]) for i, f in enumerate(ID_FIELDS) if f in headers)
        yield from ((28 + i, 0, str(value[f])) for i, f in enumerate(ID_FIELDS) if f in value)
        if bidirectional:
            yield from ((55, i, str(value[f])) for i, f in enumerate(SOURCE_FIELDS) if f in value)

    chain = {m[:2]: [] for m in seeds}
    level = [((), m) for m in seeds]
    followed = set()
    for _ in range(depth):
        first = {}
        for rank, m in sorted(level, key=lambda x: x[0]):
            for i in ids(m) - followed:
                first.setdefault(i, chain[m[:2]])
        frontier = dict(sorted(first.items())[:breadth])
        followed |= set(frontier)
        level = []
        for m in messages:
            hits = [(i, kind, rank) for kind, rank, i in ways(m) if i in frontier]
            if m[0] in follow and m[:2] not in chain and hits:
                i, kind, rank = min(hits)
                chain[m[:2]] = [*frontier[i], i]
                level.append(((i, kind, follow.index(m[0]), rank, 0, m[1]), m))
    return chain


def random_bus(seed, n=120):
    rng = random.Random(seed)
    pool = [f"id{i}" for i in range(25)] + ["None", "7"]

    def value():
        names = rng.sample([*ID_FIELDS[:6], "orderId", "customer_id", "parent_id", "sourceId", "msisdn", "phone", "misc"], rng.randint(0, 3))
        return {f: rng.choice([*pool, 7, None, True]) if rng.random() < 0.9 else "hot" for f in names}

    return [
        (
            rng.choice(["a", "b", "c"]), o, rng.choice([*pool, None]),
            {f: rng.choice(pool) for f in rng.sample(["trace_id", "session-id", "productId"], rng.randint(0, 1))}, value(),
        )
        for o in range(n)
    ]


@pytest.mark.parametrize("shuffled", [False, True])
@pytest.mark.parametrize(
    "seed, depth, breadth, bidirectional", [(1, 1, None, False), (2, 2, None, True), (3, 3, 2, False), (4, 4, 3, True)]
)
def test_against_plain_evaluation(spark, bus, monkeypatch, seed, depth, breadth, bidirectional, shuffled):
    rows = random_bus(seed)
    raw = bus(*[message(t, o, json.dumps(v), key=k, headers=h) for t, o, k, h, v in rows])
    seeds = [m for m in rows if m[0] == "a"][:3]
    first = raw.filter(F.col("offset").isin([m[1] for m in seeds]))
    if shuffled:  # large frontier: narrow references, shuffle join, payload joined back
        monkeypatch.setattr(session, "BROADCAST_BYTES", -1)
        monkeypatch.setattr(plan, "PREFILTER_BYTES", 0)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = b.correlate(
            raw, b.enrich(first), ["b", "c", "a"], limit=None, max_depth=depth, max_breadth=breadth, bidirectional=bidirectional
        )
        got = {(t, o): c for (t, _, o), c in chains(found).items()}
        assert found.count() == len(got)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == expected(rows, seeds, ["b", "c", "a"], depth, breadth, bidirectional)


@pytest.mark.parametrize("small", [True, False])
def test_one_row_for_coordinates_held_twice(bus, monkeypatch, small):
    """An at-least-once archive: the same rows whatever the frontier's size, and the same of two different ones."""
    twice = [message("b", 1, {"order_id": "o1"}, key="k")] * 2
    differing = [message("b", 2, {"order_id": "o1", "n": n}, key="k") for n in (1, 2)]
    raw = bus(message("a", 0, {"order_id": "o1"}, key="s"), *twice, *differing)
    found = []
    for prefilter, limit in ((4096, 64 << 20), (0, -1)):
        monkeypatch.setattr(plan, "PREFILTER_BYTES", prefilter)
        monkeypatch.setattr(session, "BROADCAST_BYTES", limit)
        hits = b.correlate(raw, b.enrich(raw.filter("topic = 'a'")), ["b"], limit=10 if small else None)
        found.append(sorted((r["topic"], r["offset"], bytes(r["raw"])) for r in hits.collect()))
    assert found[0] == found[1] and [r[:2] for r in found[0]] == [("a", 0), ("b", 1), ("b", 2)]


def test_references_are_narrow_until_they_are_reduced(bus):
    raw = bus(message("a", 0, {"order_id": "o1"}, key="s"), message("b", 1, {"order_id": "o1"}, key="k"))
    decoded = b.decode(b.normalize(raw.selectExpr("*", plan._COPY), keep=["_copy"]))
    refs = plan.references(decoded, ["timestamp_utc", "_copy"], True)
    found = plan._discover(refs, refs.select("ref_id").distinct())
    assert not {"raw", "value", "headers", "raw_key"} & set(found.columns)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate variant_explode" not in text
    assert all("raw#" not in line for line in text.splitlines() if "Aggregate(" in line)


def test_hot_id_is_split(spark, bus, monkeypatch):
    """One id on a third of all rows: the shuffle join splits it over tasks, and nothing is lost."""
    rows = [message("logs", o, {"order_id": "hot" if o % 3 == 0 else f"o{o}"}, key=f"k{o}") for o in range(6000)]
    raw = bus(*rows).repartition(16, "offset")
    seeds = b.enrich(bus(*[message("loans", o, {"order_id": "hot" if o % 3 == 0 else f"o{o}"}) for o in range(0, 6000, 3)]))
    monkeypatch.setattr(session, "BROADCAST_BYTES", -1)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    plans = []
    real = session.store

    def recording(df, name):
        if name == "hits":
            df.collect()
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, name)

    monkeypatch.setattr(session, "store", recording)
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        found = b.correlate(raw, seeds, ["logs"], limit=None)
        assert found.filter("get(correlation_chain, 0) = 'hot'").count() == 2000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert any("skew=true" in p for p in plans)


def test_summary_and_investigation(trace):
    found = b.investigate(trace, "LN-9", ["ledger"], initial_topics=["loans"], bidirectional=True, limit=500)
    rows = {r["id"]: r for r in b.correlation_summary(found).collect()}
    assert rows["LN-9"]["messages"] == 3 and rows["RQ-77"]["topics"] == ["ledger"]
    by_value = b.Bus(trace).investigate("LN-9", ["ledger"], key_field="value:order_id", initial_topics=["loans"], limit=2)
    assert len(coords(by_value)) == 2


def test_export_import_is_identity_and_seeds_a_correlation(spark, trace, tmp_path):
    full = b.correlate(trace, b.search_messages(trace, "LN-9", topics=["loans"]), ["ledger"], limit=500)
    b.write_json(full, str(tmp_path / "out"))
    back = b.read_json(spark, str(tmp_path / "out"))
    columns = [c for c in back.columns if c not in ("value", "key_decoded")]

    def plain(df):
        rows = df.select(*columns, F.to_json("value").alias("v"), F.to_json("key_decoded").alias("k"))
        return sorted(map(str, rows.collect()))

    assert plain(back) == plain(full)
    again = b.correlate(trace, back.filter("topic = 'loans'"), ["ledger"], limit=500)
    assert chains(again) == chains(full)
    zulu = spark.createDataFrame([('{"topic":"t","timestamp_utc":"2026-06-08T12:00:00.5Z","raw":""}',)], "value string")
    assert str(b.import_json(zulu).first()["timestamp_utc"]) == "2026-06-08 12:00:00.500000"
