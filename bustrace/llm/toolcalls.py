"""Tool-call linking for chat data: join calls and results, order them, validate arguments, write canonical JSON.

* Calls and results are joined on (conversation, call id), each reduced to one row per id before (with a map side).
* Order: a call comes after the calls whose results it needs. Layers are peeled off, one round per layer, each round
  joining only the newest layer with the needs; what is left when nothing new comes is a cycle. Positions inside a
  conversation add up counts of short runs of turns, so a conversation of any length is never one group.
* Arguments are parsed to VARIANT and compared with the tools' schemas; canonical JSON has sorted keys and no blanks.

Everything is expressions of the JVM. Defined results: ids that are null take no part; of several calls (or results) with
one id the first by turn, then by content, stands and ``copies`` counts all; a call without result is ``unanswered``, a
result without call an ``orphan`` (layer and validity are null, it comes last); needs that no call answers to are counted
in ``n_missing`` and don't order; members of a cycle and what needs them have a null layer and come behind the others;
arguments that aren't a JSON object are invalid and written as a JSON string; of a repeated key the last value counts;
``1.0`` is an integer, as in JSON Schema, and written as ``1``; empty tables give an empty result. A chain of
calls takes a round, about half a second, for each call in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from bustrace.session import configure, scratch_path, store

#: tool -> parameter -> (type, required). Types are those of JSON Schema.
Schemas = dict[str, dict[str, tuple[str, bool]]]

RUN_OF_TURNS = 64

_KIND = {
    "string": r"^STRING$",
    "integer": r"^(BIGINT|DECIMAL\(\d+,0\))$",
    "number": r"^(BIGINT|DECIMAL.*|DOUBLE|FLOAT)$",
    "boolean": r"^BOOLEAN$",
    "object": r"^OBJECT<.*$",
    "array": r"^ARRAY<.*$",
    "null": r"^VOID$",
}


def argument_errors(name: F.Column, arguments: F.Column, schemas: Schemas) -> F.Column:
    """Sorted list of what is wrong: ``arguments``, ``tool``, ``missing:p``, ``type:p``, ``unknown:p``."""
    given = F.from_json(arguments, "map<string,variant>")

    def of(parameters: dict[str, tuple[str, bool]]) -> F.Column:
        found = [F.lit(None).cast("string")]
        for parameter, (kind, required) in parameters.items():
            value = F.try_element_at(given, F.lit(parameter))
            wrong = ~F.schema_of_variant(value).rlike(_KIND[kind])
            absent = F.lit(f"missing:{parameter}") if required else F.lit(None)
            found.append(F.when(value.isNull(), absent).when(wrong, F.lit(f"type:{parameter}")))
        known = F.array(*[F.lit(p) for p in parameters]).cast("array<string>")
        unknown = F.transform(F.array_except(F.map_keys(given), known), lambda k: F.concat(F.lit("unknown:"), k))
        return F.array_sort(F.concat(F.array_compact(F.array(*found)), unknown))

    errors = F.array(F.lit("tool"))
    for tool, parameters in schemas.items():
        errors = F.when(name == tool, of(parameters)).otherwise(errors)
    return F.when(given.isNull(), F.array(F.lit("arguments"))).otherwise(errors)


def topological_layers(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, layer, n_missing) for calls (conv_id, call_id, needs), unique by the first two."""
    needs = calls.select("conv_id", "call_id", F.explode(F.array_distinct("needs")).alias("need"))
    known = calls.select("conv_id", F.col("call_id").alias("need"), F.lit(True).alias("known"))
    needs = store(needs.join(known, ["conv_id", "need"], "left"), "calls-needs")
    degree = needs.groupBy("conv_id", "call_id").agg(
        F.count("known").alias("left"), F.count_if(F.col("known").isNull()).alias("n_missing")
    )
    zero = F.lit(0).cast("long")
    state = calls.select("conv_id", "call_id").join(degree, ["conv_id", "call_id"], "left")
    state = state.select("conv_id", "call_id", F.coalesce("left", zero).alias("left"), F.coalesce("n_missing", zero).alias("n_missing"))
    state = store(state.withColumn("layer", F.lit(0)), "calls-open")
    needs = needs.filter("known").drop("known")
    # Layers are appended to one table, so that the plan stays as small for a long chain as for a short one.
    spark, path = calls.sparkSession, scratch_path(calls.sparkSession, "calls-layers")
    while True:
        newest, seen = state.filter("left = 0"), Observation()
        newest.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(path)
        if not seen.get["n"]:
            break
        arrived = needs.join(newest.select("conv_id", F.col("call_id").alias("need"), "layer"), ["conv_id", "need"])
        arrived = arrived.groupBy("conv_id", "call_id").agg(F.count(F.lit(1)).alias("k"), F.max("layer").alias("l"))
        rest = state.filter("left > 0").join(arrived, ["conv_id", "call_id"], "left")
        state = store(
            rest.select(
                "conv_id",
                "call_id",
                (F.col("left") - F.coalesce("k", zero)).alias("left"),
                "n_missing",
                F.greatest("layer", F.col("l") + 1).alias("layer"),
            ),
            "calls-open",
        )
    layered = spark.read.schema(state.schema).parquet(path)
    return state.withColumn("layer", F.lit(None).cast("int")).unionByName(layered).drop("left")


def _positions(rows: DataFrame) -> DataFrame:
    """``rows`` with ``position``, counted from 0 inside each conversation by layer, turn and id."""
    run = F.floor(F.col("first_turn") / RUN_OF_TURNS)
    keyed = rows.withColumn("__layer", F.coalesce("layer", F.lit(2**31 - 1))).withColumn("__run", run)
    keyed = keyed.withColumn("__late", F.col("status") == "orphan")
    keys = ["conv_id", "__late", "__layer", "__run"]
    counts = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy(*keys[1:]).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*keys, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy("first_turn", "call_id"))
    left, right = keyed.withColumn("__inside", inside).alias("l"), counts.alias("r")
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    position = (F.col("__before") + F.col("__inside") - 1).cast("long").alias("position")
    return left.join(right, same).select(*[f"l.{c}" for c in rows.columns], position)


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """One row per conversation and call id.

    ``calls``: conv_id, call_id, turn, name, arguments (JSON text), needs (call ids). ``results``: conv_id, call_id, turn,
    content. Of a key that arguments repeat, the last value counts, whatever the session says. Returns conv_id, call_id, position, layer, turn, result_turn, status, copies, n_missing, valid, errors, json.
    """
    configure(calls.sparkSession)
    ids = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    needs = F.coalesce("needs", F.array().cast("array<string>"))
    call = F.min(F.struct("turn", "name", "arguments", needs.alias("needs"))).alias("call")
    calls = calls.filter(ids).groupBy("conv_id", "call_id").agg(call, F.count(F.lit(1)).alias("n_calls"))
    calls = store(calls.select("conv_id", "call_id", "call.*", "n_calls"), "calls")
    result = F.min(F.struct("turn", "content")).alias("result")
    results = results.filter(ids).groupBy("conv_id", "call_id").agg(result, F.count(F.lit(1)).alias("n_results"))
    result_turn = F.col("result.turn").alias("result_turn")
    results = store(results.select("conv_id", "call_id", result_turn, F.col("result.content").alias("content"), "n_results"), "results")
    layers = topological_layers(calls.select("conv_id", "call_id", "needs"))
    # Links and positions on narrow rows; texts are joined once, at the end.
    linked = calls.select("conv_id", "call_id", "turn", "n_calls").join(layers, ["conv_id", "call_id"], "left")
    linked = linked.join(results.drop("content"), ["conv_id", "call_id"], "full")
    status = F.when(F.col("n_calls").isNull(), "orphan").when(F.col("n_results").isNull(), "unanswered").otherwise("linked")
    copies = F.coalesce("n_calls", F.lit(0)) + F.coalesce("n_results", F.lit(0))
    linked = linked.withColumns({"status": status, "copies": copies.cast("long")}).drop("n_calls", "n_results")
    linked = linked.withColumn("first_turn", F.when(F.col("status") == "orphan", F.col("result_turn")).otherwise(F.col("turn")))
    linked = store(_positions(linked), "calls-linked")
    linked = linked.join(calls.drop("turn", "n_calls"), ["conv_id", "call_id"], "left")
    linked = linked.join(results.select("conv_id", "call_id", "content"), ["conv_id", "call_id"], "left")
    errors = argument_errors(F.col("name"), F.col("arguments"), schemas)
    linked = linked.withColumn("errors", F.when(F.col("status") != "orphan", errors))
    parsed = F.when(F.from_json("arguments", "map<string,variant>").isNotNull(), F.to_json(F.try_parse_json("arguments")))

    def text(column: str) -> F.Column:  # a JSON string, by way of a list of one
        listed = F.to_json(F.array(F.col(column)))
        return F.when(F.col(column).isNotNull(), F.substring(listed, F.lit(2), F.length(listed) - 2))

    members = {
        "arguments": F.coalesce(parsed, text("arguments")),
        "id": text("call_id"),
        "name": text("name"),
        "needs": F.to_json(F.array_sort(F.array_distinct("needs"))),
        "result": text("content"),
    }
    parts = [F.concat(F.lit(f'"{k}":'), F.coalesce(v, F.lit("null"))) for k, v in members.items()]
    return linked.select(
        "conv_id",
        "call_id",
        "position",
        "layer",
        "turn",
        "result_turn",
        "status",
        "copies",
        "n_missing",
        (F.size("errors") == 0).alias("valid"),
        F.array_join("errors", ",").alias("errors"),
        F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")).alias("json"),
    )
