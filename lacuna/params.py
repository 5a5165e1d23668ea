"""User-facing parameters and the fixed values that results must carry."""

from __future__ import annotations

from dataclasses import dataclass

# Tokens read as missing in delimited text.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# A domain is hinted when one of its keywords occurs in the column name.
DOMAIN_KEYWORDS = {
    "company": ("company", "business", "organization", "corp", "inc", "ltd"),
    "industry": ("industry", "sector", "vertical", "category"),
    "location": ("city", "state", "country", "location", "address"),
    "product": ("product", "item", "sku", "merchandise"),
    "person": ("name", "person", "customer", "user", "employee"),
    "status": ("status", "state", "condition", "level"),
    "category": ("category", "type", "class", "group", "segment"),
    "food": ("food", "ingredient", "nutrition", "recipe", "meal"),
    "finance": ("revenue", "cost", "price", "amount", "value"),
    "technology": ("software", "tech", "platform", "tool", "system"),
}

# Words looked for in the head values of a text column.
COMPANY_WORDS = ("inc", "corp", "llc", "ltd")
RATING_WORDS = ("high", "low", "medium", "good", "bad")

# Method names and explanations written to plans and ledgers.
STATISTICAL = "statistical"
CATEGORICAL = "llm_categorical"
CONTEXTUAL = "llm_contextual"
EXPLANATIONS = {
    STATISTICAL: "K-Nearest Neighbors imputation for numeric data",
    CATEGORICAL: "LLM classification with known category examples",
    CONTEXTUAL: "LLM contextual inference based on surrounding data",
}
APPROACHES = {
    STATISTICAL: "knn_imputation",
    CATEGORICAL: "classification_with_examples",
    CONTEXTUAL: "contextual_inference",
}
BASE_CONFIDENCE = {STATISTICAL: 0.8, CATEGORICAL: 0.7, CONTEXTUAL: 0.6}
NO_CONTEXT = "No additional context available"
REASON_FEW_COLUMNS = "Median imputation (insufficient correlated columns)"
REASON_FEW_ROWS = "Median imputation (insufficient data for KNN)"
SNAP_SUFFIX = " (adjusted to closest valid category)"
BAD_NAME_CHARACTERS = r'[/\\:*?"<>|]'
NUMERIC_TEXT = r"^-?\d+\.?\d*$"
QUALITY_STATES = ("excellent", "good", "needs_review", "poor")


@dataclass(frozen=True)
class InputLimits:
    """Limits of the input gates. ``max_rows=None`` lifts the single-machine row limit."""

    max_rows: int | None = 100_000
    max_columns: int = 1000
    max_missing_percentage: float = 90.0
    min_non_null_values: int = 2
    allowed_file_types: tuple[str, ...] = (".csv", ".xlsx", ".parquet")
    numeric_text_share: float = 0.8
    high_cardinality_ratio: float = 0.95


@dataclass(frozen=True)
class FillParams:
    """How gaps are filled. ``confidence_threshold`` 0 keeps every fill."""

    statistical_method: str = "knn"
    knn_neighbors: int = 3
    categorical_threshold: int = 20
    confidence_threshold: float = 0.0
    max_calls_per_column: int | None = None
    checkpoint_every: int = 4


@dataclass(frozen=True)
class ModelParams:
    """Identity and settings of the model a responder stands for."""

    provider: str = "offline"
    model_name: str = "mode"
    temperature: float = 0.3
    max_tokens: int = 500
    max_retries: int = 3
    retry_delay: float = 1.0
    requests_per_minute: int | None = None


@dataclass(frozen=True)
class CacheParams:
    ttl_seconds: int = 3600
    max_size: int = 1000
    eviction_buffer: int = 100
