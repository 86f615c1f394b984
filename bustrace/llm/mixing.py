"""Mixing sources to target weights by capped water-filling.

A source's target is its weight times one level, clamped at ``max_epochs`` times its size; the level rises as clamped
sources hand their excess on, until none is above its clamp. A source then repeats every document a whole number of
times; the words that are still missing come from documents in the order of a seeded hash, each once more, and the last
of them as a fraction. So the words taken of a source are its target, rounded down.

Only sums per source and slice of the hash are shuffled; the order matters only in the one slice in which the missing
words run out, so a source may hold any share of the rows. Copies of one id and size (repeated rows) are taken alike.

Defined results: a null or empty text has size 0 and is taken 0 times; a null source is a source of its own, behind all
others; without any word all targets are 0; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bustrace.session import broadcast_if_small, store

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 17
WORD = r"[^\x20\x09-\x0D]+"


def words(text: F.Column | str) -> F.Column:
    """Number of words, separated by the ASCII white space characters."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def _order(id_col: str, seed: int) -> F.Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))


def water_fill(sources: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sources`` (source, source_size; one row per source) with weight and target. Weights repeat in code point order."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))  # one row per source
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(rank - 1, F.lit(len(weights))) + 1)
    table = store(sources.withColumn("weight", weight), "mix-sources")
    first = table.agg(F.sum("source_size"), F.sum("weight")).first()
    total, level, clamped = first[0] or 0, 0.0, None
    if total:
        level = total / first[1]
        cap = F.col("source_size") * max_epochs
        while True:
            above = F.col("weight") * F.lit(level) > cap
            row = table.agg(
                F.coalesce(F.sum(F.when(above, cap)), F.lit(0)).alias("clamped"),
                F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("open"),
            ).first()
            if row["clamped"] == clamped or not row["open"]:
                break
            clamped, level = row["clamped"], (total - row["clamped"]) / row["open"]
    target = F.least(F.col("source_size").cast("double") * max_epochs, F.lit(level) * F.col("weight"))
    return table.withColumn("target", target)


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    *,
    weights=WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: id, source, size, source_size, target, whole, part, taken.

    ``whole`` counts whole repetitions, ``part`` the words of a further, incomplete one; taken = whole * size + part.
    """
    rows = store(
        docs.select(
            id_col, F.col(source_col).alias("source"), words(text_col).alias("size"), _order(id_col, seed).alias("__o")
        ).withColumn("__slice", F.substring("__o", 1, 4)),
        "mix-rows",
    )
    slices = store(rows.groupBy("source", "__slice").agg(F.sum("size").alias("n")), "mix-slices")
    filled = water_fill(slices.groupBy("source").agg(F.sum("n").alias("source_size")), weights, max_epochs)
    filled = filled.withColumn("__wanted", F.floor("target").cast("long"))
    filled = filled.withColumn("__whole", F.expr("if(source_size > 0, __wanted div source_size, 0L)"))
    filled = filled.withColumn("__missing", F.col("__wanted") - F.col("__whole") * F.col("source_size"))
    before = F.sum("n").over(Window.partitionBy("source").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1))
    at = slices.withColumn("__before", F.coalesce(before, F.lit(0).cast("long")))
    same = at["source"].eqNullSafe(filled["source"])
    last = at.join(filled, same).filter("__before < __missing and __missing <= __before + n")
    last = last.select(at["source"], F.col("__slice").alias("__last"), F.col("__missing") - F.col("__before"))
    last = last.toDF("source", "__last", "__rest")
    filled = store(
        filled.alias("f")
        .join(last.alias("l"), F.col("f.source").eqNullSafe(F.col("l.source")), "left")
        .select("f.*", "l.__last", "l.__rest"),
        "mix-filled",
    ).withColumnRenamed("source", "__source")
    joined = rows.join(broadcast_if_small(filled), rows["source"].eqNullSafe(F.col("__source"))).drop("__source")
    # The slice in which the missing words run out: one row per id and size, in hash order.
    edge = joined.filter(F.col("__slice") == F.col("__last")).groupBy("source", "__o", "size")
    edge = edge.agg(F.count(F.lit(1)).alias("m"), F.first("__rest").alias("__rest"))
    until = F.sum(F.col("size") * F.col("m")).over(
        Window.partitionBy("source").orderBy("__o", "size").rowsBetween(Window.unboundedPreceding, -1)
    )
    left = F.col("__rest") - F.coalesce(until, F.lit(0))
    share = F.greatest(F.lit(0), F.least(F.col("size"), F.floor(left / F.col("m")))).cast("long")
    edge = edge.select(
        F.col("source").alias("__es"), F.col("__o").alias("__eo"), F.col("size").alias("__en"), share.alias("__share")
    )
    on = joined["source"].eqNullSafe(F.col("__es")) & (joined["__o"] == F.col("__eo")) & (joined["size"] == F.col("__en"))
    extra = F.when(F.col("__slice") < F.col("__last"), F.col("size")).otherwise(F.coalesce("__share", F.lit(0)))
    out = joined.join(edge, on, "left").withColumn("__extra", extra.cast("long"))
    full = (F.col("__extra") == F.col("size")) & (F.col("size") > 0)
    out = out.withColumn("whole", F.col("__whole") + full.cast("long"))
    out = out.withColumn("part", F.when(full, F.lit(0)).otherwise(F.col("__extra")).cast("long"))
    taken = F.col("whole") * F.col("size") + F.col("part")
    return out.select(id_col, "source", "size", "source_size", "target", "whole", "part", taken.alias("taken"))


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> DataFrame:
    """``docs`` as the mix takes them: a row per repetition, and texts as they are.

    An incomplete repetition is taken whole or not at all, whichever is nearer to its words. So a source misses its
    target by half of one document's words at most (of one group's, where rows are repeated).
    """
    plan = mix(docs, id_col, text_col, source_col, **options).dropDuplicates([id_col, "source", "size"])
    plan = plan.select(id_col, "source", "size", "whole", "part").filter("whole > 0 or part > 0")
    plan = plan.toDF("__id", "__source", "__n", "__whole", "__part")
    rows = docs.withColumn("__size", words(text_col))
    same = rows[id_col].eqNullSafe(F.col("__id")) & rows[source_col].eqNullSafe(F.col("__source"))
    rows = rows.join(plan, same & (F.col("__size") == F.col("__n")))
    times = F.col("__whole") + F.when(F.col("__part") * 2 >= F.col("__n"), F.sign("__part").cast("long")).otherwise(F.lit(0))
    rows = rows.withColumn("__times", times.cast("int")).filter("__times > 0")
    # A number per repetition: the text is copied behind it, not into an array.
    rows = rows.withColumn("__nth", F.explode(F.sequence(F.lit(1), F.col("__times"))))
    return rows.select(*docs.columns)
