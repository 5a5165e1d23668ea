"""The full analysis: profile, gaps, plan, effort."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame

from lacuna.operators.profile import (
    complexity, dataset_profile, estimate_time, missing_from_counts, plan_fills, profile_columns,
)


class Analysis(NamedTuple):
    dataset: DataFrame
    columns: DataFrame
    missing: DataFrame
    plan: DataFrame
    complexity: DataFrame
    time: DataFrame


def analyze(df: DataFrame, id_col: str, run_ts: datetime, threshold: int = 20, approx: bool = False,
            columns: Sequence[str] | None = None) -> Analysis:
    """Everything known about ``df`` before filling; at most one row per column in each table."""
    profile = profile_columns(df, id_col, columns, approx)
    missing = missing_from_counts(profile, df.count())  # the profile has counted the present values already
    plan = plan_fills(profile, missing, threshold)
    times = plan.select("column", "estimated_time_minutes")
    return Analysis(
        dataset_profile(df, run_ts), profile, missing.join(times, "column"), plan, complexity(plan), estimate_time(plan),
    )
