"""Filling a table column by column, with a ledger of every filled cell."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from lacuna.functions.columns import data_type, is_missing, is_numeric, ref, scalar_columns
from lacuna.functions.durable import durable, local_table
from lacuna.functions.joins import attach_unique
from lacuna.operators.cache import CACHE_SCHEMA, cache_lookup
from lacuna.operators.cells import apply_ledger, confident, head_values, patch
from lacuna.operators.impute import (
    choose_numeric, fill_digits, ledger_rows, mean_statistic, median_statistic, range_guard,
)
from lacuna.operators.neighbours import knn_predictions
from lacuna.operators.prompts import (
    cap_calls, categorical_prompts, contextual_prompts, distinct_prompts, parse_responses, snap_category,
    with_fallback,
)
from lacuna.operators.respond import Responder
from lacuna.params import CATEGORICAL, STATISTICAL, CacheParams, FillParams, ModelParams


@dataclass(frozen=True)
class Strategy:
    """A user's fill method: takes a column when ``can_handle(plan row)``, returns ledger rows."""

    name: str
    can_handle: Callable[[Row], bool]
    impute: Callable[[DataFrame, str, str, Row, datetime], DataFrame]
    confidence_base: float = 0.5


class FillResult(NamedTuple):
    table: DataFrame
    ledger: DataFrame
    new_cache: DataFrame


def _working(df: DataFrame, id_col: str, parts: Sequence[DataFrame], literals: Mapping[str, float],
             joined: Sequence[str]) -> DataFrame:
    """The table with all fills so far: constants in place, everything else by a single join on the id."""
    table = df  # untouched until there is something to fill in
    if parts:
        table = apply_ledger(df, id_col, reduce(DataFrame.unionByName, parts), joined)
    if literals:
        table = table.select(*[
            (patch(table, c, F.lit(literals[c])) if c in literals else ref(c)).alias(c) for c in table.columns])
    return table


def _numeric_part(df: DataFrame, now: DataFrame, id_col: str, column: str, params: FillParams, run_ts: datetime,
                  features: Sequence[str] | None) -> tuple[DataFrame, float | None]:
    """Ledger rows of one numeric column, and the constant when all of them carry the same value."""
    kind = data_type(df, column)
    if params.statistical_method == "mean":
        row, name, reason = mean_statistic(now, column).first(), "mean_imputation", "Mean imputation"
        found = row["mean"] if row else None
    else:
        choice = choose_numeric(now, id_col, column, features)
        if params.statistical_method == "knn" and choice.method == "knn":
            # Earlier fills make ``now`` a join; its few columns needed here are written out before several passes.
            narrow = now if now is df else durable(now.select(*[ref(c) for c in (id_col, column, *choice.features)]))
            found = knn_predictions(narrow, id_col, column, choice.features, params.knn_neighbors)
            reason = f"K-NN imputation based on {len(choice.features)} related numeric columns"
            rows = ledger_rows(
                found, F.col("row_id"), column, num=fill_digits(F.col("prediction"), kind), confidence=F.lit(0.8),
                method=F.lit("knn_imputation"), reasoning=F.lit(reason), run_ts=run_ts)
            return durable(rows), None  # a mean of donors cannot leave their range
        row, name, reason = median_statistic(now, column).first(), "median_imputation", choice.reason or "Median imputation"
        found = row["median"] if row else None
    spark = df.sparkSession
    rounded = spark.range(1).select(
        F.coalesce(fill_digits(F.lit(None if found is None else float(found)).cast("double"), kind), F.lit(0.0))).first()[0]
    rows = ledger_rows(
        df.where(is_missing(df, column)), ref(id_col), column, num=F.lit(rounded), confidence=F.lit(0.6),
        method=F.lit(name), reasoning=F.lit(reason), run_ts=run_ts)
    return rows, rounded


def _text_part(df: DataFrame, now: DataFrame, id_col: str, plan: Row, responder: Responder, params: FillParams,
               model: ModelParams, cache: DataFrame | None, caching: CacheParams, run_ts: datetime
               ) -> tuple[DataFrame, DataFrame]:
    """Ledger rows of one text column, and the answers that are new to the cache."""
    column, categories = plan["column"], list(plan["categories"] or [])
    categorical = plan["method"] == CATEGORICAL
    context = scalar_columns(now, [id_col])
    if categorical:
        prompts = categorical_prompts(now, id_col, column, categories, context, model)
    else:
        examples = [r["value"] for r in head_values(now, id_col, 5, [column]).orderBy("rank").collect()]
        prompts = contextual_prompts(now, id_col, column, plan["domain_hints"] or [], examples, context, model)

    if now is not df:
        prompts = durable(prompts)
    wanted = distinct_prompts(prompts)
    at = F.lit(run_ts)
    known = cache if cache is not None else local_table(df.sparkSession, [], CACHE_SCHEMA)
    looked = cache_lookup(wanted, known, caching.ttl_seconds, at)
    looked = durable(looked)  # read for misses, hits and the number of cells behind each prompt
    misses = looked.where(~F.col("hit")).select("cache_key", "row_id", "column", "prompt")
    if params.max_calls_per_column is not None:
        misses = cap_calls(misses, params.max_calls_per_column)
    # Written before use: recomputing anything below never asks the model again.
    replies = durable(parse_responses(responder(misses)).select(
        "cache_key", "value", "confidence", "reasoning", "is_text"))
    hits = looked.where("hit").select("cache_key", "value", "confidence", "reasoning", F.lit(True).alias("is_text"))
    answers = with_fallback(replies.unionByName(hits), plan["method"], categories if categorical else None)
    if categorical:
        answers = snap_category(answers, categories)
    answers = looked.select("cache_key", "cells").join(answers, "cache_key")
    cells = attach_unique(prompts.select("row_id", "cache_key"), answers, ["cache_key"], weight="cells")
    cells = cells.where(F.col("method").isNotNull())  # without an answer: beyond the call limit
    rows = ledger_rows(
        cells, F.col("row_id"), column, text=F.col("value"), confidence=F.col("confidence"), method=F.col("method"),
        reasoning=F.col("reasoning"), run_ts=run_ts)
    fresh = replies.where("value is not null").select(
        "cache_key", "value", "confidence", "reasoning", at.alias("timestamp"), at.alias("last_access"),
        F.create_map(F.lit("column"), F.lit(column)).alias("metadata"))
    return durable(rows), fresh


def fill_missing(df: DataFrame, id_col: str, plan: DataFrame, run_ts: datetime,
                 responders: Mapping[str, Responder] | None = None, params: FillParams = FillParams(),
                 model: ModelParams = ModelParams(), cache: DataFrame | None = None,
                 caching: CacheParams = CacheParams(), mode: str = "sequential",
                 strategies: Sequence[Strategy] = (), features: Sequence[str] | None = None) -> FillResult:
    """Fill every planned column; returns table, ledger and the answers to add to the cache.

    ``sequential``: each column sees the fills of the columns before it. ``independent``: every column
    is filled from the original table. A text column without responder keeps its gaps; the key ``"*"``
    names a responder for all of them. Fills live in ledger parts keyed by row id, so the table is
    joined once however many columns are filled. Fills below ``params.confidence_threshold`` are not made: their cells stay open
    and have no ledger row.
    """
    responders = responders or {}
    parts: list[DataFrame] = []
    ledgers: list[DataFrame] = []
    caches: list[DataFrame] = []
    literals: dict[str, float] = {}
    joined: list[str] = []
    spark = df.sparkSession
    for row in plan.orderBy("position").collect():  # control data: one row per gappy column
        column = row["column"]
        now = _working(df, id_col, parts, literals, joined) if mode == "sequential" else df
        custom = next((s for s in strategies if s.can_handle(row)), None)
        if custom is not None:
            part = durable(custom.impute(now, id_col, column, row, run_ts))
            if is_numeric(now, column):
                part = durable(range_guard(part, now, column))
            part = confident(part, params.confidence_threshold)
            parts.append(part)
            joined.append(column)
        elif row["method"] == STATISTICAL:
            part, constant = _numeric_part(df, now, id_col, column, params, run_ts, features)
            if params.confidence_threshold > 0 and constant is not None:
                part, constant = durable(part), None  # a constant's confidence may be too low, so it goes through the ledger
            if constant is None:
                part = confident(part, params.confidence_threshold)
                parts.append(part)
                joined.append(column)
            else:
                literals[column] = constant
        else:
            responder = responders.get(column, responders.get("*"))
            if responder is None:
                continue
            part, fresh = _text_part(df, now, id_col, row, responder, params, model, cache, caching, run_ts)
            part = confident(part, params.confidence_threshold)
            parts.append(part)
            joined.append(column)
            caches.append(fresh)
        ledgers.append(part)
        if len(parts) > params.checkpoint_every:
            parts = [durable(reduce(DataFrame.unionByName, parts))]
    empty = ledger_rows(
        df.where(F.lit(False)), ref(id_col), "", num=F.lit(0.0), confidence=F.lit(0.0), method=F.lit(""),
        reasoning=F.lit(""), run_ts=run_ts)
    ledger = reduce(DataFrame.unionByName, ledgers) if ledgers else empty
    fresh = reduce(DataFrame.unionByName, caches) if caches else local_table(spark, [], CACHE_SCHEMA)
    return FillResult(_working(df, id_col, parts, literals, joined), ledger, fresh)
