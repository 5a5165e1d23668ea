"""Prompts for missing text cells, and answers turned into ledger values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.functions.columns import is_missing, ref
from lacuna.functions.ranking import top_n
from lacuna.functions.responses import _object, _strip, read_answer, snapped
from lacuna.operators.cells import row_context
from lacuna.params import CATEGORICAL, CONTEXTUAL, ModelParams

ANSWER_FORMAT = 'Answer as JSON: {"value": "...", "confidence": 0.0-1.0, "reasoning": "..."}'


def cache_key(prompt: Column, model: ModelParams = ModelParams()) -> Column:
    """SHA-256 over the trimmed prompt, provider, model and temperature."""
    parts = [_strip(prompt), F.lit(model.provider), F.lit(model.model_name), F.lit(str(model.temperature))]
    return F.sha2(F.concat_ws("\u001f", *parts), 256)


def _listed(values: Sequence[str]) -> str:
    return ", ".join(values)


def _prompts(df: DataFrame, id_col: str, column: str, lines: Sequence[str], columns: Sequence[str] | None,
             model: ModelParams) -> DataFrame:
    head = F.concat(F.lit(f"Missing value of column {column}.\nRow: "), row_context(df, column, columns))
    prompt = F.concat_ws("\n", head, *[F.lit(line) for line in [*lines, ANSWER_FORMAT]])
    gaps = df.where(is_missing(df, column)).select(
        ref(id_col).alias("row_id"), F.lit(column).alias("column"), prompt.alias("prompt")
    )
    return gaps.withColumn("cache_key", cache_key(F.col("prompt"), model))


def categorical_prompts(df: DataFrame, id_col: str, column: str, categories: Sequence[str],
                        columns: Sequence[str] | None = None, model: ModelParams = ModelParams()) -> DataFrame:
    """``row_id, column, prompt, cache_key`` for every missing cell of a categorical column."""
    return _prompts(df, id_col, column, [f"Choose one of: {_listed(categories)}"], columns, model)


def contextual_prompts(df: DataFrame, id_col: str, column: str, hints: Sequence[str], examples: Sequence[str],
                       columns: Sequence[str] | None = None, model: ModelParams = ModelParams()) -> DataFrame:
    """The same for free text: domain hints and example values instead of a category list."""
    lines = [f"Hints: {_listed(hints)}", f"Examples: {_listed(examples)}"]
    return _prompts(df, id_col, column, lines, columns, model)


def distinct_prompts(prompts: DataFrame) -> DataFrame:
    """One row per cache key, known by its smallest row id; equal prompts combine before the shuffle."""
    return prompts.groupBy("cache_key").agg(
        F.min("row_id").alias("row_id"), F.first("column").alias("column"), F.first("prompt").alias("prompt"),
        F.count(F.lit(1)).alias("cells"),
    )


def cap_calls(misses: DataFrame, n: int) -> DataFrame:
    """The first ``n`` calls of every column; the caller reports the rest as not asked."""
    return top_n(misses, ["column"], [F.col("row_id").asc()], n)


def parse_responses(responses: DataFrame, text: str = "response_text") -> DataFrame:
    """Add ``value, confidence, reasoning, is_text, clamped`` read from the response text.

    Confidence is forced into [0, 1]; ``clamped`` marks where that changed it.
    """
    stripped = responses.withColumn("__t", _strip(F.col(text)))
    repaired = F.regexp_replace(F.regexp_replace(F.col("__t"), r",\}", "}"), "'", '"')
    # Parsed once here, read several times below.
    json = stripped.select("*", _object(F.col("__t")).alias("__strict"), _object(repaired).alias("__fixed"))
    answer = read_answer(F.col("__t"), F.col("__strict"), F.col("__fixed"))
    read = json.select(
        *[ref(c) for c in responses.columns], answer.value.alias("value"), answer.confidence.alias("__c"),
        answer.reasoning.alias("reasoning"), F.coalesce(answer.is_text, F.lit(True)).alias("is_text"),
    )
    bounded = F.least(F.greatest(F.col("__c"), F.lit(0.0)), F.lit(1.0))
    return read.select(
        *[ref(c) for c in responses.columns], "value", bounded.alias("confidence"), "reasoning", "is_text",
        (F.col("__c") != bounded).alias("clamped"),
    )


def snap_category(answers: DataFrame, categories: Sequence[str] | Column) -> DataFrame:
    """Force ``value`` into the category list; changed answers lose a fifth of their confidence."""
    if not isinstance(categories, Column):
        categories = F.array(*[F.lit(c) for c in categories]).cast("array<string>")
    value, confidence, reasoning = snapped(F.col("value"), F.col("confidence"), F.col("reasoning"), categories)
    changed = {"value": value, "confidence": confidence, "reasoning": reasoning}
    return answers.select(*[changed.get(c, ref(c)).alias(c) for c in answers.columns])


def prompts_by_plan(gaps: DataFrame, column: str, model: ModelParams = ModelParams()) -> DataFrame:
    """The same prompts where every row brings its own plan: ``row_id, context, method, categories, domain_hints, examples``."""
    joined = lambda c: F.array_join(F.coalesce(F.col(c), F.array().cast("array<string>")), ", ")
    lines = F.when(F.col("method") == CATEGORICAL, F.concat(F.lit("Choose one of: "), joined("categories"))).otherwise(
        F.concat(F.lit("Hints: "), joined("domain_hints"), F.lit("\nExamples: "), joined("examples")))
    head = F.concat(F.lit(f"Missing value of column {column}.\nRow: "), F.col("context"))
    prompt = F.concat_ws("\n", head, lines, F.lit(ANSWER_FORMAT))
    return gaps.withColumns({"column": F.lit(column), "prompt": prompt}).withColumn("cache_key", cache_key(F.col("prompt"), model))


def with_fallback_by_plan(answers: DataFrame) -> DataFrame:
    """:func:`with_fallback` and :func:`snap_category` where every answer brings its own ``method`` and ``categories``."""
    planned = [c for c in answers.columns if c not in ("method", "categories")]
    first = F.col("method") == CATEGORICAL
    categorical = answers.where(first)
    failed = (F.size("categories") > 0) & ~F.col("is_text") | F.col("value").isNull()
    reason = "Error in LLM processing, used fallback: answer is not text"
    changed = {
        "value": F.when(failed, F.coalesce(F.get("categories", F.lit(0)), F.lit("Unknown"))).otherwise(F.col("value")),
        "confidence": F.when(failed, 0.3).otherwise(F.col("confidence")),
        "reasoning": F.when(failed, reason).otherwise(F.col("reasoning")),
    }
    chosen = categorical.select(*[changed.get(c, ref(c)).alias(c) for c in planned], "categories",
                                F.when(failed, "fallback").otherwise(F.col("method")).alias("method"))
    chosen = snap_category(chosen, F.col("categories")).drop("categories")
    return chosen.unionByName(with_fallback(answers.where(~first).select(*planned), CONTEXTUAL))


def with_fallback(answers: DataFrame, method: str, categories: Sequence[str] | None = None) -> DataFrame:
    """Turn unusable answers into error rows and add the ledger ``method``.

    For a categorical column an answer that is no text fails and becomes the first category at 0.3;
    a contextual one fails only when there is no answer at all and becomes ``Unknown`` at 0.2.
    """
    if categories is not None:
        failed = ~F.col("is_text") | F.col("value").isNull() if categories else F.col("value").isNull()
        value, confidence, name = (categories[0] if categories else "Unknown"), 0.3, "fallback"
        reason = "Error in LLM processing, used fallback: answer is not text"
    else:
        failed, value, confidence, name = F.col("value").isNull() & F.col("is_text"), "Unknown", 0.2, "error_fallback"
        reason = "Processing error: no answer"
    changed = {
        "value": F.when(failed, value).otherwise(F.col("value")),
        "confidence": F.when(failed, confidence).otherwise(F.col("confidence")),
        "reasoning": F.when(failed, reason).otherwise(F.col("reasoning")),
    }
    return answers.select(
        *[changed.get(c, ref(c)).alias(c) for c in answers.columns],
        F.when(failed, name).otherwise(F.lit(method)).alias("method"),
    )
