"""Answers forced into category lists of any length, kept as a table.

What :func:`lacuna.operators.prompts.snap_category` does with a short list in the plan happens here by joins. Whether one text contains another is
found through grams (runs of up to ``GRAM`` characters): the shorter text's rarest gram must be one of the longer's, so only texts that have
it are compared. No list is in the plan or on the driver, and no value meets all categories.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.functions.columns import ref
from lacuna.functions.durable import durable
from lacuna.functions.joins import attach_unique
from lacuna.params import SNAP_SUFFIX

GRAM = 3


def _grams(text: str, size: int) -> Column:
    """All runs of ``size`` characters of a column."""
    return F.expr(f"IF(length({text}) < {size}, array(), transform(sequence(1, greatest(length({text}) - {size - 1}, 1)), i -> substring({text}, i, {size})))")


def contained(needles: DataFrame, haystacks: DataFrame) -> DataFrame:
    """``needle, hay`` of every pair where the text ``hay`` contains the text ``needle``; both without repeats, empty needles left out."""
    every = F.explode(F.array_distinct(F.flatten(F.array(*[_grams("hay", k) for k in range(1, GRAM + 1)]))))
    grams = durable(haystacks.select("hay", every.alias("gram")))
    frequent = durable(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("times")))
    own = F.expr(" ".join(["CASE", *(f"WHEN length(needle) = {k} THEN array(needle)" for k in range(1, GRAM)), "END"]))
    asked = needles.where("length(needle) > 0").select("needle", F.explode(F.coalesce(own, _grams("needle", GRAM))).alias("gram"))
    counted = asked.join(frequent, "gram", "left")
    # A gram that nothing has rules the needle out; else its rarest one decides what it is compared with.
    rarest = counted.groupBy("needle").agg(F.min(F.struct(F.coalesce("times", F.lit(0)).alias("times"), "gram")).alias("least"))
    rarest = rarest.where("least.times > 0").select("needle", F.col("least.gram").alias("gram"))
    return rarest.join(grams, "gram").where(F.contains("hay", F.col("needle"))).select("needle", "hay")


def snap_to_table(answers: DataFrame, categories: DataFrame) -> DataFrame:
    """Force ``value`` of ``answers`` into ``categories`` (``position, category``), changed answers losing a fifth of their confidence.

    The rules are those of the short list: the category itself, else one that differs in case only, else the first (by ``position``) that contains the
    value or is contained in it, ignoring case, else the first of all. Repeated categories count at their first position. NULL values
    take the first category. Without categories answers stay as they are.
    """
    known = durable(categories.where("category IS NOT NULL").groupBy("category").agg(F.min("position").alias("position")))
    first = known.orderBy("position").limit(1).collect()
    if not first:
        return answers
    low = durable(known.groupBy(F.lower("category").alias("low")).agg(F.min(F.struct("position", "category")).alias("best")))
    values = durable(answers.where("value IS NOT NULL").groupBy("value").agg(F.count(F.lit(1)).alias("uses")))
    exact = values.join(known, F.col("value") == F.col("category"), "left").select("value", "uses", F.col("category").isNotNull().alias("known"))
    cased = exact.withColumn("low", F.lower("value")).join(low, "low", "left")
    cased = durable(cased.select("value", "uses", "known", "low", F.when(F.col("known"), F.col("value")).otherwise(F.col("best.category")).alias("choice")))
    open_ = cased.where("choice IS NULL").select("low").distinct()
    pairs = contained(low.select(F.col("low").alias("needle")), open_.select(F.col("low").alias("hay"))).select(
        F.col("hay").alias("text"), F.col("needle").alias("low")).unionByName(
        contained(open_.select(F.col("low").alias("needle")), low.select(F.col("low").alias("hay"))).select(
            F.col("needle").alias("text"), F.col("hay").alias("low")))
    partial = pairs.join(low, "low").groupBy("text").agg(F.min("best").alias("partial"))
    # The empty category is in every value.
    empty = known.where("category = ''").agg(F.min(F.struct("position", "category")).alias("empty"))
    chosen = cased.join(partial, F.col("low") == F.col("text"), "left").withColumn("__one", F.lit(1)).join(
        F.broadcast(empty.withColumn("__one", F.lit(1))), "__one")
    nearest = F.when(F.col("low") != "", F.least("partial", "empty"))
    chosen = chosen.select("value", "uses", "known", F.coalesce("choice", nearest["category"], F.lit(first[0]["category"])).alias("__choice"))
    chosen = durable(chosen.withColumnRenamed("known", "__known").withColumnRenamed("uses", "__uses"))
    joined = attach_unique(answers, chosen, ["value"], weight="__uses")
    same = F.coalesce("__known", F.lit(False))
    changed = {
        "value": F.coalesce("__choice", F.lit(first[0]["category"])),
        "confidence": F.when(same, F.col("confidence")).otherwise(F.col("confidence") * 0.8),
        "reasoning": F.when(same, F.col("reasoning")).otherwise(F.concat("reasoning", F.lit(SNAP_SUFFIX))),
    }
    return joined.select(*[changed.get(c, ref(c)).alias(c) for c in answers.columns])
