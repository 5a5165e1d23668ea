"""Many files of one schema in one chain of jobs: every statistic, plan and fill is keyed by file.

What :func:`lacuna.plans.fill.fill_missing` does for a table happens here for each file on its own, with the same results: profiles and plans are
tables with a row per file and column, the method gate is an aggregate per file, medians and neighbours are grouped by file, and a prompt
carries its file's categories. The number of jobs follows the columns, not the files, and nothing per file goes through the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.functions.columns import data_type, is_missing, numeric_columns, present_sql, present_value, ref, scalar_columns
from lacuna.functions.durable import durable
from lacuna.functions.joins import attach_unique
from lacuna.operators.cells import confident, row_context
from lacuna.operators.impute import fill_digits, ledger_rows, mean_statistic, median_statistic
from lacuna.operators.neighbours import knn_predictions
from lacuna.operators.profile import missing_from_counts, plan_fills, profile_columns_by
from lacuna.operators.prompts import cap_calls, parse_responses, prompts_by_plan, with_fallback_by_plan
from lacuna.operators.reports import assess_quality
from lacuna.operators.respond import Responder
from lacuna.params import REASON_FEW_COLUMNS, REASON_FEW_ROWS, STATISTICAL, FillParams, ModelParams
from lacuna.plans.fill import _working


class BatchResult(NamedTuple):
    """``table`` has the file and id columns in front of its own, ``ledger`` the file's; ``profile`` and ``plan`` have a row per file and column."""

    table: DataFrame
    ledger: DataFrame
    profile: DataFrame
    plan: DataFrame
    reports: DataFrame


def choose_numeric_by(df: DataFrame, id_col: str, by: str, target: str, features: Sequence[str], wanted: str) -> DataFrame:
    """``by, rows, method, reason`` and, for each feature, whether it is usable: the method gate of every group that misses ``target``."""
    columns = scalar_columns(df, [id_col, by])
    complete = " AND ".join(["true", *(present_sql(df, c) for c in columns)])
    joint = [f"count_if({present_sql(df, target)} AND {present_sql(df, f)}) >= 2 AS u{j}" for j, f in enumerate(features)]
    counts = df.groupBy(ref(by).alias(by)).agg(
        F.count(F.lit(1)).alias("rows"), F.expr(f"count_if(NOT {present_sql(df, target)}) AS gaps"),
        F.expr(f"count_if({complete}) AS complete"), *[F.expr(j) for j in joint]).where("gaps > 0")
    usable = F.array_size(F.filter(F.array(F.lit(False), *[F.col(f"u{j}") for j in range(len(features))]), lambda u: u))
    near = (F.lit(wanted) == "knn") & (F.col("complete") >= 3) & (usable > 0)
    few = (F.col("complete") < 3) if features else F.lit(True)
    reason = F.when(F.lit(wanted) == "mean", "Mean imputation").when(
        near, F.concat(F.lit("K-NN imputation based on "), usable.cast("string"), F.lit(" related numeric columns"))).when(
        few, REASON_FEW_ROWS).when(usable == 0, REASON_FEW_COLUMNS).otherwise("Median imputation")
    method = F.when(F.lit(wanted) == "mean", "mean_imputation").when(near, "knn_imputation").otherwise("median_imputation")
    return counts.select(by, "rows", method.alias("method"), reason.alias("reason"), *[f"u{j}" for j in range(len(features))])


def _numeric_part(df: DataFrame, now: DataFrame, id_col: str, by: str, column: str, params: FillParams, run_ts: datetime,
                  features: Sequence[str]) -> DataFrame:
    """Ledger rows of one numeric column in all files."""
    kind = data_type(df, column)
    features = [f for f in features if f != column]
    choice = durable(choose_numeric_by(now, id_col, by, column, features, params.statistical_method))
    # A feature that is not usable in a file is empty there, which leaves it out of the file's distances.
    rows = now.select(ref(by).alias(by), ref(id_col).alias("row_id"), present_value(now, column).alias("y"),
                      *[present_value(now, f).cast("double").alias(f"x{j}") for j, f in enumerate(features)])
    rows = attach_unique(rows, choice, [by], weight="rows").where("method IS NOT NULL").select(
        by, "row_id", "y", "method", "reason", *[F.when(F.col(f"u{j}"), F.col(f"x{j}")).alias(f"x{j}") for j in range(len(features))])
    rows = durable(rows)

    def ledger(gaps: DataFrame, fill: Column, confidence: float) -> DataFrame:
        return ledger_rows(gaps, F.col("row_id"), column, num=F.coalesce(fill_digits(fill, kind), F.lit(0.0)), confidence=F.lit(confidence),
                           method=F.col("method"), reasoning=F.col("reason"), run_ts=run_ts, by=[by])

    one = rows.where("method <> 'knn_imputation'")
    statistic = mean_statistic(one, "y", [by]) if params.statistical_method == "mean" else median_statistic(one, "y", [by])
    statistic = durable(statistic.toDF(by, "fill", "n"))
    part = ledger(attach_unique(one.where("y IS NULL"), statistic, [by], weight="n"), F.col("fill"), 0.6)
    near = rows.where("method = 'knn_imputation'")
    if features and near.limit(1).count():
        found = durable(knn_predictions(near, "row_id", "y", [f"x{j}" for j in range(len(features))], params.knn_neighbors, block_by=[by]))
        means = durable(mean_statistic(near, "y", [by]).toDF(by, "mean", "n"))
        gaps = near.where("y IS NULL").join(found, "row_id")
        alone = attach_unique(gaps.where("neighbours = 0"), means, [by], weight="n").withColumn("prediction", F.col("mean")).drop("mean", "n")
        part = part.unionByName(ledger(gaps.where("neighbours > 0").unionByName(alone), F.col("prediction"), 0.8))
    return durable(part)


def _text_part(df: DataFrame, now: DataFrame, id_col: str, by: str, column: str, plan: DataFrame, responder: Responder, params: FillParams,
               model: ModelParams, run_ts: datetime) -> DataFrame:
    """Ledger rows of one text column in all files."""
    own = ("method", "categories", "domain_hints", "examples")
    wanted = durable(plan.where(F.col("column") == column).select(by, *own, "missing_count"))
    gaps = now.where(is_missing(now, column))
    context = scalar_columns(now, [id_col, by])
    # The context is fixed before the plan's columns come in, as a table may have columns of their names.
    gaps = gaps.select(ref(by).alias(by), ref(id_col).alias("row_id"), row_context(now, column, context).alias("context"))
    gaps = attach_unique(gaps, wanted, [by], weight="missing_count")
    prompts = durable(prompts_by_plan(gaps, column, model))
    asked = durable(prompts.groupBy("cache_key").agg(
        F.min("row_id").alias("row_id"), F.first("column").alias("column"), F.first("prompt").alias("prompt"),
        F.first("method").alias("method"), F.first("categories").alias("categories"), F.count(F.lit(1)).alias("cells")))
    misses = asked.select("cache_key", "row_id", "column", "prompt")
    if params.max_calls_per_column is not None:
        misses = cap_calls(misses, params.max_calls_per_column)
    replies = durable(parse_responses(responder(misses)).select("cache_key", "value", "confidence", "reasoning", "is_text"))
    answers = with_fallback_by_plan(replies.join(asked.select("cache_key", "method", "categories", "cells"), "cache_key"))
    cells = prompts.select(by, "row_id", "cache_key")
    cells = attach_unique(cells, durable(answers), ["cache_key"], weight="cells").where("method IS NOT NULL")
    return durable(ledger_rows(
        cells, F.col("row_id"), column, text=F.col("value"), confidence=F.col("confidence"), method=F.col("method"),
        reasoning=F.col("reasoning"), run_ts=run_ts, by=[by]))


def fill_batch(df: DataFrame, id_col: str, file_col: str, run_ts: datetime, responders: Mapping[str, Responder] | None = None,
               params: FillParams = FillParams(), model: ModelParams = ModelParams(), features: Sequence[str] | None = None) -> BatchResult:
    """Profile, plan, fill and report every file in ``df`` (rows of all files, known by ``file_col``) on its own.

    ``id_col`` is unique over all files and orders the rows of each. Columns are filled in table order, each seeing the fills before it. Text
    columns without responder keep their gaps. ``reports``: ``file_col, rows, fills, quality_score``; the score is NULL without fills.
    """
    responders = responders or {}
    columns = scalar_columns(df, [id_col, file_col])
    profile = durable(profile_columns_by(df, id_col, [file_col], columns))
    missing = missing_from_counts(profile, F.col("n"), by=[file_col])
    plan = plan_fills(profile, missing, params.categorical_threshold, [file_col])
    plan = durable(plan.join(profile.select(file_col, "column", "examples"), [file_col, "column"]))
    features = [c for c in (features if features is not None else numeric_columns(df, [id_col, file_col]))]
    gappy = {(r["column"], r["method"]) for r in plan.select("column", "method").distinct().collect()}  # at most three a column
    parts: list[DataFrame] = []
    joined: list[str] = []
    for column in columns:
        methods = {m for c, m in gappy if c == column}
        now = _working(df, id_col, [p.drop(file_col) for p in parts], {}, joined)
        if STATISTICAL in methods:
            part = _numeric_part(df, now, id_col, file_col, column, params, run_ts, features)
        elif methods and (responder := responders.get(column, responders.get("*"))) is not None:
            part = _text_part(df, now, id_col, file_col, column, plan, responder, params, model, run_ts)
        else:
            continue
        parts.append(confident(part, params.confidence_threshold))
        joined.append(column)
    empty = ledger_rows(df.where(F.lit(False)), ref(id_col), "", num=F.lit(0.0), confidence=F.lit(0.0), method=F.lit(""),
                        reasoning=F.lit(""), run_ts=run_ts, by=[file_col])
    ledger = reduce(DataFrame.unionByName, parts, empty)
    table = durable(_working(df, id_col, [p.drop(file_col) for p in parts], {}, joined))
    fills = ledger.groupBy(file_col).agg(F.count(F.lit(1)).alias("fills"))
    scores = assess_quality(ledger, [file_col]).select(file_col, F.col("overall_quality_score").alias("quality_score"))
    reports = profile.groupBy(file_col).agg(F.max("n").alias("rows")).join(fills, file_col, "left").join(scores, file_col, "left")
    return BatchResult(table, ledger, profile, plan, reports.withColumn("fills", F.coalesce("fills", F.lit(0))))
