"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact budgets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uptake.llm.common import numbered, prefix_sums, written

WEIGHTS = (5, 2, 1)
#: No source gives more than so many times what it has.
EPOCHS = 3
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """``source, source_size, target`` from rows ``source, size``.

    Sources take the weights in turn, by code point, null last. A source's target is weight x level,
    but at most ``epochs`` times its size; the level is such that targets add up to all sizes. Sources
    by growing size a weight stop at their limit one after the other, so the level comes from two running sums. This
    works on one row a source.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (number % len(weights) + 1).cast("int")).cast("long")
    ranked = sums.withColumn("_number", number).withColumn("_weight", weight)
    order = Window.orderBy((F.col("source_size") / F.col("_weight")).asc(), "_number")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(Window.partitionBy()) - epochs * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    level = (left / F.sum("_weight").over(after)).alias("_level")
    # The first source, in that order, that its limit does not stop, sets the level for itself and all after it.
    free = F.col("_weight") * F.col("_level") <= epochs * F.col("source_size")
    leveled = ranked.withColumn("_level", level).withColumn("_free", free)
    chosen = F.first(F.when(F.col("_free"), F.col("_level")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    full = (epochs * F.col("source_size")).cast("double")
    return leveled.withColumn("_set", chosen).select(
        "source", "source_size", F.least(F.coalesce(F.col("_weight") * F.col("_set"), full), full).alias("target")
    )


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS, keep: Sequence[str] = ()) -> DataFrame:
    """How much each row gives: ``doc_id, source, _key, size, source_size, target, taken``, and the columns ``keep``.

    Rows are ordered within their source by a hash of id and text, so that reruns agree. The target, cut to
    whole words, holds full passes over the source and a remainder; the remainder goes to the first rows of the order, the last of them in
    part. Defined cases: null texts have size 0 and give nothing; a null source is a source of its own; rows that are equal in
    id and text share a place in the order and are told apart only by which of them the budget cuts.
    """
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("#"), F.coalesce("text", F.lit(""))))
    rows = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("_key"), *keep), "sizes")
    goal = written(targets(rows, weights, epochs), "targets").withColumnRenamed("source", "_source")
    placed = prefix_sums(rows, ["source"], ["_key", "doc_id", *keep], "size", "_before")
    budget = F.floor("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(0)
    rest = budget - passes * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_before")))
    out = placed.join(F.broadcast(goal) if _few(goal) else goal, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    return out.withColumn("taken", (passes * F.col("size") + part).cast("long")).drop("_before")


#: A table of targets with at most so many rows is sent to every task.
FEW_SOURCES = 100_000


def _few(goal: DataFrame) -> bool:
    return goal.limit(FEW_SOURCES + 1).count() <= FEW_SOURCES


def mixture(docs: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every row of ``docs``; see ``mix``."""
    return mix(docs, weights, epochs).select("doc_id", "size", "source_size", "target", "taken")


def mixed_rows(docs: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """The mix itself: each row as often as it is taken, the last time cut to its first words; ``n_chars`` follows the text.

    A cut text keeps its words and the white space between them. Rows that give nothing are left out, but rows without words, null
    texts among them, stay once. A null source is a source of its own; repeated rows are taken each for itself; columns may
    have any name; an empty table gives an empty result.
    """
    rows = numbered(docs)
    marks = mix(rows.select("uid", "whole.doc_id", "whole.source", "whole.text"), weights, epochs, ["uid"])
    joined = rows.join(marks.select("uid", "size", "taken"), "uid")
    full = F.when(F.col("size") > 0, F.expr("taken div size")).otherwise(1).cast("int")
    part = F.when(F.col("size") > 0, F.col("taken") % F.col("size")).otherwise(0).cast("int")
    lengths = F.concat(
        F.array_repeat(F.col("size").cast("int"), full), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<int>"))
    )
    taken = joined.withColumn("words", F.explode(lengths))
    pattern = F.concat(F.lit(r"^(?>[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++){"), F.col("words").cast("string"), F.lit("}"))
    whole = F.col("whole")
    cut = F.when(F.col("words") == F.col("size"), whole["text"]).otherwise(F.regexp_substr(whole["text"], pattern))
    out = taken.withColumn("text", cut)
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[new.get(c, whole[c]).alias(c) for c in docs.columns])
