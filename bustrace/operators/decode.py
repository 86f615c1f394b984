"""Payload decode: plain JSON in the JVM, framed bodies in one Arrow-batched UDF per side."""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bustrace.functions.framing import HEADER_LENGTH, framed_sql, schema_id_sql, schema_ids_sql
from bustrace.functions.text import quote
from bustrace.operators.wire import COMPILERS, Compiler, framed_decoder
from bustrace.session import BROADCAST_BYTES, measure

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Closes a one-element list around the payload, so that anything after the first JSON value is noticed.
_END = "␄end-of-payload"

# An object of at most three levels whose texts have no backslash, and nothing but blanks around it. Braces outside of
# texts are told apart, so the first value ends where the match does. Possessive throughout: no stack grows with the text.
_BLANKS, _MEMBERS = r"[ \t\r\n]*+", r'[-+.:,\[\]0-9A-Za-z \t\r\n]++|"[^"\\]*+"'
_INNER = rf"\{{(?:{_MEMBERS})*+\}}"
_ONE_OBJECT = rf"\A{_BLANKS}\{{(?:{_MEMBERS}|\{{(?:{_MEMBERS}|{_INNER})*+\}})*+\}}{_BLANKS}\z"

_FRAMED_TYPE = "text string, error string"


def _snapshot_udf(snapshot: dict[int, tuple], compilers: dict[str, Compiler]):
    """UDF that carries the whole (measured) schema snapshot."""
    read = framed_decoder(compilers, HEADER_LENGTH)

    @F.pandas_udf(_FRAMED_TYPE)
    def framed(payload: pd.Series) -> pd.DataFrame:
        def one(data):
            if data is None:
                return None, None
            schema_id = int.from_bytes(data[1:HEADER_LENGTH], "big")
            if schema_id not in snapshot:
                return None, f"schema {schema_id} not found"
            return read(data, *snapshot[schema_id])

        return pd.DataFrame([one(data) for data in payload], columns=["text", "error"], dtype=object)

    return framed


def _row_udf(compilers: dict[str, Compiler]):
    """UDF that takes the schema from joined columns, for a snapshot too large to ship."""
    read = framed_decoder(compilers, HEADER_LENGTH)

    @F.pandas_udf(_FRAMED_TYPE)
    def framed(
        payload: pd.Series, known: pd.Series, kind: pd.Series, text: pd.Series, descriptors: pd.Series
    ) -> pd.DataFrame:
        def one(data, found, *schema):
            if data is None:
                return None, None
            if pd.isna(found):
                return None, f"schema {int.from_bytes(data[1:HEADER_LENGTH], 'big')} not found"
            return read(data, *schema)

        rows = [one(*row) for row in zip(payload, known, kind, text, descriptors)]
        return pd.DataFrame(rows, columns=["text", "error"], dtype=object)

    return framed


def _framed_only(payload: str) -> Column:
    return F.expr(f"if({framed_sql(payload)}, {payload}, null)")


def _one_per_id(schemas: DataFrame) -> DataFrame:
    """One row per id, since a snapshot by subject and version repeats them: the largest, in which nulls come last."""
    whole = F.max(F.struct("schema_type", "schema_str", "descriptor_set")).alias("_schema")
    return schemas.groupBy("schema_id").agg(whole).select("schema_id", "_schema.*")


def _add_framed(df: DataFrame, schemas: DataFrame, compilers: dict[str, Compiler], max_bytes: int) -> DataFrame:
    """Add ``_body`` and ``_key_body`` (text, error) for framed payloads and keys."""
    sides = {"_body": "raw", "_key_body": "raw_key"}
    schemas = _one_per_id(schemas)
    if measure(schemas)[1] <= max_bytes:
        snapshot = {r[0]: tuple(r)[1:] for r in schemas.collect()}  # measured just above
        framed = _snapshot_udf(snapshot, compilers)
        return df.withColumns({out: framed(_framed_only(src)) for out, src in sides.items()})
    framed = _row_udf(compilers)
    for out, src in sides.items():
        # Every schema is offered to the join, so nothing has to be learned from the messages first and a stream works
        # like a table. One id may be in every row of a topic; the adaptive join splits it.
        lookup = schemas
        lookup = lookup.select(
            F.col("schema_id").alias("_id"),
            F.col("schema_type").alias("_type"),
            F.col("schema_str").alias("_str"),
            F.col("descriptor_set").alias("_descriptors"),
        )
        df = df.join(lookup, F.expr(schema_id_sql(src)) == F.col("_id"), "left")
        df = df.withColumn(out, framed(_framed_only(src), "_id", "_type", "_str", "_descriptors"))
        df = df.drop("_id", "_type", "_str", "_descriptors")
    return df


def decode(
    df: DataFrame,
    schemas: DataFrame | None = None,
    *,
    decoders: dict[str, Compiler] | None = None,
    registry: bool = True,
    snapshot_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``value``, ``decode_status``, ``decode_error``, ``key_decoded`` and ``schema_id`` to normalised messages.

    ``value`` is an object or null. Status: ``ok``, ``empty`` (no payload), ``non_object`` (valid JSON of another
    kind), ``error``, or ``skipped`` when ``registry`` is False. Without ``schemas`` framed payloads are errors and no
    Python runs. ``decoders`` adds compilers
    for further schema types: ``(schema text, descriptor set) -> (body -> dict)``.
    """
    ids = F.expr(schema_ids_sql("raw", "raw_key"))
    if not registry:
        return df.withColumns(
            {
                "value": F.lit(None).cast("variant"),
                "decode_status": F.lit("skipped"),
                "decode_error": F.lit(None).cast("string"),
                "key_decoded": F.lit(None).cast("variant"),
                "schema_id": ids,
            }
        )
    framed = framed_sql("raw")
    body = "cast(raw as string)"
    text = f"if(is_valid_utf8({body}), if(startswith({body}, '\\uFEFF'), substring({body}, 2), {body}), null)"
    if schemas is None:
        text = f"if({framed}, null, {text})"
        failure, key_value = f"if({framed}, 'Schema Registry not configured', null)", "cast(null as variant)"
    else:
        df = _add_framed(df, schemas, {**COMPILERS, **(decoders or {})}, snapshot_bytes)
        text = f"if({framed}, _body.text, {text})"
        failure, key_value = f"if({framed}, _body.error, null)", "try_parse_json(_key_body.text)"
    # What is seen to be one whole object is parsed as it is. Any other payload is the first element of a list, whose last
    # one is the mark: a payload that holds it itself leaves another one behind.
    closed = f"try_parse_json(if(_one, _text, concat('[', _text, {quote(f',"{_END}"]')})))"
    whole = f"try_variant_get(_doc, '$[1]', 'string') = {quote(_END)} and try_variant_get(_doc, '$[2]', 'variant') is null"
    inside = f"if({whole}, try_variant_get(_doc, '$[0]', 'variant'), null)"
    start = "trim(leading '\\uFEFF \\t\\r\\n' from cast(raw as string))"
    is_object = f"({framed} or startswith(cast(raw as string), '{{') or startswith({start}, '{{'))"
    status = (
        "case when length(raw) = 0 then 'empty' when _value is null then 'error'"
        f" when {is_object} then 'ok' else 'non_object' end"
    )
    # One projection per step, so that each is computed once. The value comes out of a generator: a filter on it then
    # stays above, instead of being pushed below together with copies of the parse.
    df = df.withColumn("_text", F.expr(text))
    df = df.withColumn("_one", F.expr(f"coalesce(_text rlike {quote(_ONE_OBJECT)}, false)"))
    df = df.withColumn("_doc", F.expr(closed)).drop("_text")
    df = df.withColumn("_value", F.expr(f"if(_one, _doc, {inside})")).drop("_one")
    df = df.withColumn("decode_status", F.expr(status))
    df = df.select("*", F.expr("explode(array(if(decode_status = 'ok', _value, null)))").alias("value"))
    return df.withColumns(
        {
            "decode_error": F.expr(f"if(decode_status = 'error', coalesce({failure}, 'json decode failed'), null)"),
            "key_decoded": F.expr(key_value),
            "schema_id": ids,
        }
    ).drop("_doc", "_value", "_body", "_key_body")
