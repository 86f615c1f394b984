"""The registered queries: every operator over its whole table, with the result columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bustrace.llm import bpe, codes, exact, langid, minhash, mixing, packing, phrases, sharding, tokens, toolcalls, topk, toxicity

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op4_exact_topk(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op5_extendible_shards(spark, sf_dir):
    return sharding.extendible_shards(table(spark, sf_dir, "documents"))


@query
def op6_exact_dedup(spark, sf_dir):
    return exact.exact_groups(table(spark, sf_dir, "documents"), keep="max")


@query
def op7_mix_sources(spark, sf_dir):
    columns = ("doc_id", "size", "source_size", "target", "taken")
    return mixing.mix(table(spark, sf_dir, "documents")).select(*columns)


@query
def op1_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def remainder(column: str, n: int) -> F.Column:
    return F.crc32(F.col(column).cast("string")) % n


@query
def op3_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = langid.learn(docs.filter(remainder("doc_id", 3) != 1))
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out")
    found = langid.predict(docs.select("doc_id", held_out, "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


@query
def op9_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(remainder("doc_id", 5) != 0)
    model = toxicity.learn(docs, labels)
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    return toxicity.score(docs.select("doc_id", held_out, "text"), model).drop("text")


@query
def op10_token_counts(spark, sf_dir):
    return tokens.count_tokens(table(spark, sf_dir, "documents"))


@query
def op8_minhash_near_dedup(spark, sf_dir):
    return minhash.near_groups(table(spark, sf_dir, "documents")).drop("set_id", "group")


#: What the tools of op2 take. Turns of other roles call a tool that isn't listed.
TOOLS: toolcalls.Schemas = {
    "search": {"query": ("string", True), "limit": ("integer", False)},
    "compute": {"expression": ("string", True), "precision": ("integer", True)},
    "write": {"body": ("string", True), "path": ("string", True)},
}


def derived_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that a conversation table stands for: it has no tool calls of its own.

    An assistant's turn calls a tool with its whole text, and needs the results of two earlier turns; any other turn but
    the user's calls ``configure``. A user's turn is the result of the turn before it.
    """
    turn, text = F.col("turn"), F.coalesce("text", F.lit(""))
    size = F.length(text)

    def call_id(at) -> F.Column:
        return F.format_string("call-%d-%d", F.col("conv_id"), at)

    arguments = (
        F.when(F.col("role") != "assistant", F.to_json(F.struct(text.alias("text"))))
        .when(turn % 3 == 0, F.to_json(F.struct(text.alias("query"), size.alias("limit"))))
        .when(
            (turn % 3 == 1) & (size % 2 == 0),
            F.to_json(F.struct(text.alias("expression"), size.alias("precision"))),
        )
        .when(turn % 3 == 1, F.to_json(F.struct(text.alias("expression"), F.lit("high").alias("precision"))))
        .when(size % 3 == 0, F.to_json(F.struct(text.alias("body"))))
        .otherwise(F.to_json(F.struct(F.lit("notes/").alias("path"), text.alias("body"))))
    )
    tools = F.when(turn % 3 == 0, "search").when(turn % 3 == 1, "compute").otherwise("write")
    earlier = F.array(call_id((turn / 2).cast("long")), call_id((turn / 3).cast("long")))
    none = F.array().cast("array<string>")
    calls = turns.filter("role is null or role <> 'user'").select(
        "conv_id",
        call_id(turn).alias("call_id"),
        "turn",
        F.when(F.col("role") == "assistant", tools).otherwise("configure").alias("name"),
        arguments.alias("arguments"),
        F.when((F.col("role") == "assistant") & (turn >= 2), earlier).otherwise(none).alias("needs"),
    )
    results = turns.filter("role = 'user'")
    results = results.select("conv_id", call_id(turn - 1).alias("call_id"), "turn", text.alias("content"))
    return calls, results


@query
def op2_tool_call_linking(spark, sf_dir):
    return toolcalls.link_tool_calls(*derived_calls(table(spark, sf_dir, "conversations")), TOOLS)


@query
def op11_bpe_round_trip(spark, sf_dir):
    there = bpe.encode(table(spark, sf_dir, "documents"))
    back = bpe.decode(there)
    return back.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op13_vector_codes(spark, sf_dir):
    coded, codebooks = codes.compress(table(spark, sf_dir, "embeddings"), keep=["label"])
    rows = codes.with_label_error(coded, "label")
    digest = F.lit(None if codebooks is None else codes.codebooks_sha256(codebooks)).cast("string")
    return rows.select(
        "vec_id", codes.hex_code(F.col("codes")).alias("code"), "error", "label_error", digest.alias("codebooks_sha256")
    )


@query
def op12_phrase_mining(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))
