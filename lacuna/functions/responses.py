"""Reading structured answers out of free model text, as column expressions."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from lacuna.params import SNAP_SUFFIX

# Patterns and wordings of the answer ladder.
BRACES = r"(?s)\{.*\}"
VALUE = r'"value":\s*"([^"]*)"'
CONFIDENCE = r'"confidence":\s*([0-9.]+)'
REASONING = r'"reasoning":\s*"([^"]*)"'


class Answer(NamedTuple):
    value: Column
    confidence: Column
    reasoning: Column
    is_text: Column


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def _object(text: Column) -> Column:
    """Variant of the block from the first ``{`` to the last ``}``; NULL when it is not strict JSON."""
    return F.try_parse_json(F.nullif(F.regexp_extract(text, BRACES, 0), F.lit("")))


def _field(json: Column, name: str, kind: str) -> Column:
    return F.try_variant_get(json, f"$.{name}", kind)


def read_answer(text: Column, strict: Column, repaired: Column) -> Answer:
    """Answer of a response whose ``strict`` and ``repaired`` JSON are already parsed columns."""
    clean = _strip(F.regexp_replace(text, "[\"']", ""))
    partial = F.regexp_like(text, F.lit(VALUE))
    rung = F.when(strict.isNotNull(), 1).when(partial, 2).when(repaired.isNotNull(), 3).otherwise(4)
    json = F.coalesce(strict, F.when(~partial, repaired))
    parsed = rung.isin(1, 3) & (F.to_json(json) != "{}")
    found = F.regexp_extract(text, CONFIDENCE, 1)
    why = F.regexp_extract(text, REASONING, 1)

    raw_value, raw_confidence = _field(json, "value", "variant"), _field(json, "confidence", "variant")
    confidence = (
        F.when(parsed & raw_confidence.isNull(), 0.5)
        .when(parsed, _field(json, "confidence", "double"))
        .when((rung == 2) & (found == ""), 0.5)
        .when(rung == 2, found.try_cast("double"))
        .when(F.length(clean) < 100, 0.3)
        .otherwise(0.1)
    )
    failed = confidence.isNull()
    value = (
        F.when(failed, "Error")
        .when(parsed & raw_value.isNull(), "Unknown")
        .when(parsed, _field(json, "value", "string"))
        .when(rung == 2, F.regexp_extract(text, VALUE, 1))
        .when(F.length(clean) < 100, clean)
        .otherwise("Parse_Error")
    )
    reasoning = (
        F.when(text.isNull(), "LLM error: no response").when(failed, "LLM error: confidence is not a number")
        .when(parsed, F.coalesce(_field(json, "reasoning", "string"), F.lit("LLM prediction")))
        .when((rung == 2) & ~F.regexp_like(text, F.lit(REASONING)), "Partial extraction")
        .when(rung == 2, why)
        .when(F.length(clean) < 100, "Non-JSON response, extracted text")
        .otherwise(F.concat(F.lit("Could not parse: "), F.substring(text, 1, 50), F.lit("...")))
    )
    is_text = failed | ~parsed | raw_value.isNull() | (F.schema_of_variant(raw_value) == "STRING")
    return Answer(value, F.coalesce(confidence, F.lit(0.1)), reasoning, is_text)


def closest_category(value: Column, categories: Column) -> Column:
    """Exact match ignoring case, else the first category containing or contained, else the first."""
    low = F.lower(value)
    exact = F.filter(categories, lambda c: F.lower(c) == low)
    partial = F.filter(categories, lambda c: F.contains(F.lower(c), low) | F.contains(low, F.lower(c)))
    first = F.coalesce(F.get(exact, F.lit(0)), F.get(partial, F.lit(0)), F.get(categories, F.lit(0)))
    return F.when(F.size(categories) == 0, value).otherwise(first)


def snapped(value: Column, confidence: Column, reasoning: Column, categories: Column) -> tuple[Column, Column, Column]:
    """Value, confidence and reasoning after forcing the value into the category list."""
    known = F.coalesce(F.array_contains(categories, value), F.lit(False))
    return (
        F.when(known, value).otherwise(closest_category(value, categories)),
        F.when(known, confidence).otherwise(confidence * 0.8),
        F.when(known, reasoning).otherwise(F.concat(reasoning, F.lit(SNAP_SUFFIX))),
    )
