"""Numeric fills: median, mean, grouped statistics, the method gate and the range guard."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lacuna.functions.columns import (
    data_type, is_missing, is_present, number_as_text, numeric_columns, present_sql, present_value, ref,
    round_half_even, scalar_columns,
)
from lacuna.functions.durable import durable
from lacuna.functions.joins import attach_unique
from lacuna.functions.quantile import exact_median
from lacuna.operators.cells import patch
from lacuna.params import REASON_FEW_COLUMNS, REASON_FEW_ROWS

LEDGER_FIELDS = (
    "row_id", "column", "original_value", "suggested_value", "suggested_num", "confidence", "method",
    "reasoning", "timestamp",
)


class Filled(NamedTuple):
    """A filled table and the ledger of its fills."""

    table: DataFrame
    ledger: DataFrame


@dataclass(frozen=True)
class NumericChoice:
    """Outcome of the method gate for one column."""

    method: str
    reason: str = ""
    features: list[str] = field(default_factory=list)


def ledger_rows(gaps: DataFrame, row_id: Column, column: str, *, num: Column | None = None,
                text: Column | None = None, confidence: Column, method: Column, reasoning: Column,
                run_ts: datetime, by: Sequence[str] = ()) -> DataFrame:
    """Ledger rows for the cells in ``gaps``, behind their ``by`` columns; numbers also get their text form."""
    number = (num if num is not None else F.lit(None)).cast("double")
    return gaps.select(
        *[ref(b) for b in by],
        row_id.alias("row_id"), F.lit(column).alias("column"), F.lit(None).cast("string").alias("original_value"),
        (number_as_text(number) if text is None else text).alias("suggested_value"),
        number.alias("suggested_num"), confidence.cast("double").alias("confidence"),
        method.alias("method"), reasoning.alias("reasoning"), F.lit(run_ts).alias("timestamp"),
    )


def fill_digits(value: Column, kind: T.DataType) -> Column:
    """Fills carry two decimals; a DECIMAL column keeps its own scale."""
    if isinstance(kind, T.DecimalType):
        return F.round(value.cast("double"), kind.scale)
    return round_half_even(value.cast("double"), 2)


def median_statistic(df: DataFrame, target: str, by: Sequence[str] = (), approx: bool = False) -> DataFrame:
    """``median`` (unrounded) and ``n`` per key."""
    if not approx:
        return exact_median(df, target, by)
    kept = df.where(is_present(df, target))
    return kept.groupBy(*[ref(b).alias(b) for b in by]).agg(
        F.percentile_approx(ref(target), 0.5).cast("double").alias("median"), F.count(F.lit(1)).alias("n")
    )


def mean_statistic(df: DataFrame, target: str, by: Sequence[str] = ()) -> DataFrame:
    kept = df.where(is_present(df, target))
    return kept.groupBy(*[ref(b).alias(b) for b in by]).agg(
        F.avg(ref(target)).cast("double").alias("mean"), F.count(F.lit(1)).alias("n"))


def _statistic_fill(df: DataFrame, id_col: str, target: str, stats: DataFrame, value: str, by: Sequence[str],
                    method: str, confidence: float, reasoning: str, run_ts: datetime) -> Filled:
    kind = data_type(df, target)
    if not by:
        row = stats.first()  # one statistic of the whole table: a literal in both plans
        found = None if row is None or row[value] is None else float(row[value])
        fill = F.coalesce(fill_digits(F.lit(found).cast("double"), kind), F.lit(0.0))
        table = df.withColumn(target, patch(df, target, fill))
        gaps = df.where(is_missing(df, target))
    else:
        stats = durable(stats.select(*[ref(b) for b in by], ref(value).alias("__fill"), F.col("n").alias("__n")))
        fill = F.coalesce(fill_digits(F.col("__fill"), kind), F.lit(0.0))
        table = attach_unique(df, stats, by, weight="__n").select(*[
            (patch(df, c, fill) if c == target else ref(c)).alias(c) for c in df.columns
        ])
        gaps = attach_unique(df.where(is_missing(df, target)), stats, by, weight="__n")
    ledger = ledger_rows(
        gaps, ref(id_col), target, num=fill, confidence=F.lit(confidence), method=F.lit(method),
        reasoning=F.lit(reasoning), run_ts=run_ts,
    )
    return Filled(table, ledger)


def median_impute(df: DataFrame, id_col: str, target: str, run_ts: datetime, by: Sequence[str] = (),
                  approx: bool = False, reasoning: str = REASON_FEW_ROWS, method: str = "median_imputation",
                  confidence: float = 0.6) -> Filled:
    """Fill with the exact median of the table, or of the row's ``by`` group; 0 when there is none."""
    stats = median_statistic(df, target, by, approx)
    return _statistic_fill(df, id_col, target, stats, "median", by, method, confidence, reasoning, run_ts)


def mean_impute(df: DataFrame, id_col: str, target: str, run_ts: datetime, by: Sequence[str] = ()) -> Filled:
    stats = mean_statistic(df, target, by)
    return _statistic_fill(df, id_col, target, stats, "mean", by, "mean_imputation", 0.6, "Mean imputation", run_ts)


def choose_numeric(df: DataFrame, id_col: str, target: str, features: Sequence[str] | None = None) -> NumericChoice:
    """KNN when there are three complete rows and a feature that overlaps the target, else median."""
    candidates = [c for c in (features if features is not None else numeric_columns(df, [id_col])) if c != target]
    if not candidates:
        return NumericChoice("median", REASON_FEW_ROWS)
    complete = " AND ".join(present_sql(df, c) for c in scalar_columns(df, [id_col]))
    row = df.agg(F.expr(f"count_if({complete}) AS complete"), *[
        F.expr(f"count_if({present_sql(df, target)} AND {present_sql(df, f)}) AS j{i}") for i, f in enumerate(candidates)
    ]).first()
    usable = [f for i, f in enumerate(candidates) if row[f"j{i}"] >= 2]
    if row["complete"] < 3:
        return NumericChoice("median", REASON_FEW_ROWS)
    if not usable:
        return NumericChoice("median", REASON_FEW_COLUMNS)
    return NumericChoice("knn", features=usable)


def range_limits(df: DataFrame, target: str) -> DataFrame:
    """One row ``low, high``: the observed range widened by its own width on both sides."""
    value = present_value(df, target).cast("double")
    return df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).select(
        (F.col("lo") - (F.col("hi") - F.col("lo"))).alias("low"),
        (F.col("hi") + (F.col("hi") - F.col("lo"))).alias("high"),
    )


def range_guard(predictions: DataFrame, df: DataFrame, target: str, value: str = "suggested_num") -> DataFrame:
    """Replace predictions outside the plausible range by the median: ledger in, ledger out."""
    limits = range_limits(df, target).first()
    if limits is None or limits["low"] is None:
        return predictions
    median = float(exact_median(df, target).first()["median"])
    outside = (F.col(value) < F.lit(limits["low"])) | (F.col(value) > F.lit(limits["high"]))
    safe = fill_digits(F.lit(median), data_type(df, target))
    reason = f"KNN prediction outside reasonable range, used median: {median:.2f}"
    changed = {
        value: F.when(outside, safe).otherwise(F.col(value)),
        "suggested_value": F.when(outside, number_as_text(safe)).otherwise(F.col("suggested_value")),
        "confidence": F.when(outside, 0.6).otherwise(F.col("confidence")),
        "method": F.when(outside, "median_fallback").otherwise(F.col("method")),
        "reasoning": F.when(outside, reason).otherwise(F.col("reasoning")),
    }
    return predictions.select(*[changed.get(c, F.col(c)).alias(c) for c in predictions.columns])
