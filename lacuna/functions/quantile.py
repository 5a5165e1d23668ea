"""Exact medians that never gather a column in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lacuna.functions.columns import data_type, is_present, ref
from lacuna.functions.joins import attach_unique


def exact_median(df: DataFrame, value: str, keys: Sequence[str] = (), accuracy: int = 10_000) -> DataFrame:
    """One row per key with the exact ``median`` of ``value`` (mean of the middle two) and its ``n``.

    ``F.median`` keeps every distinct value of a group in one aggregation buffer. Here a mergeable
    quantile sketch first brackets the two middle ranks; a second pass counts the values inside the
    bracket, so only a ``~8/accuracy`` share of a group is ever ranked.
    """
    keys = list(keys)
    kind = data_type(df, value)
    base = df.where(is_present(df, value)).select(*[ref(k).alias(k) for k in keys], ref(value).alias("__v"))
    margin = min(4.0 / accuracy, 0.25)
    brackets = base.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"),
        F.percentile_approx("__v", [0.5 - margin, 0.5 + margin], accuracy).alias("__b"),
    )
    brackets = brackets.select(
        *keys, "__n", F.col("__b")[0].alias("__lo"), F.col("__b")[1].alias("__hi")
    )
    if not keys:
        low, high, n = brackets.select("__lo", "__hi", "__n").first()
        inside = base.where(F.col("__v") <= F.lit(high)).withColumn("__n", F.lit(n)).withColumn("__lo", F.lit(low))
    else:
        inside = attach_unique(base, brackets, keys, weight="__n").where(F.col("__v") <= F.col("__hi"))
    # Everything under the bracket collapses into one NULL bucket before the shuffle.
    counts = inside.groupBy(*keys, F.when(F.col("__v") >= F.col("__lo"), F.col("__v")).alias("__v")).agg(
        F.count(F.lit(1)).alias("__c"), F.first("__n").alias("__n")
    )
    running = Window.partitionBy(*keys).orderBy(F.col("__v").asc_nulls_first())
    running = running.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumn("__cum", F.sum("__c").over(running))
    lower_rank = F.floor((F.col("__n") + 1) / 2)
    upper_rank = F.floor((F.col("__n") + 2) / 2)
    picked = ranked.groupBy(*keys).agg(
        F.max("__n").alias("n"),
        F.min(F.when(F.col("__cum") >= lower_rank, F.col("__v"))).alias("__a"),
        F.min(F.when(F.col("__cum") >= upper_rank, F.col("__v"))).alias("__z"),
        F.max(F.when(F.col("__v").isNull(), F.col("__c") >= lower_rank)).alias("__low_miss"),
        (F.max("__cum") < F.max(upper_rank)).alias("__high_miss"),
    )
    missed = F.coalesce(F.col("__low_miss"), F.lit(False)) | F.col("__high_miss")
    middle = (F.col("__a") + F.col("__z")) / F.lit(2).cast("int")
    if kind.typeName() != "decimal":
        middle = middle.cast("double")
    return picked.select(
        *keys,
        F.when(missed, F.raise_error("median bracket missed its ranks; raise accuracy"))
        .otherwise(middle).alias("median"),
        "n",
    )
