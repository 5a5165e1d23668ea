"""Reports over a filled table and its ledger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.functions.columns import percentage, round_half_even
from lacuna.operators.profile import column_counts


def completion(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per originally gappy column: missing before and after, filled, percentage filled."""
    old = column_counts(before).where("missing_count > 0").select(
        "position", "column", F.col("missing_count").alias("originally_missing"))
    new = column_counts(after).select("column", F.col("missing_count").alias("still_missing"))
    filled = F.col("originally_missing") - F.col("still_missing")
    return old.join(new, "column").select(
        "position", "column", "originally_missing", "still_missing", filled.alias("filled_count"),
        percentage(filled, F.col("originally_missing"), 1).alias("improvement_percentage"),
    )


def confidence_distribution(ledger: DataFrame) -> DataFrame:
    c = F.col("confidence")
    return ledger.agg(
        F.count_if(c >= 0.8).alias("high"), F.count_if((c >= 0.6) & (c < 0.8)).alias("medium"),
        F.count_if(~(c >= 0.6) | c.isNull()).alias("low"),
    )


def method_breakdown(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("method").agg(F.count(F.lit(1)).alias("fills"))


def method_confidence(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("method").agg(
        F.count(F.lit(1)).alias("fills"), F.avg("confidence").alias("average_confidence"))


def assess_quality(ledger: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row, or one for each ``by`` key: quality score, share of confident fills, doubtful and failed fills, status."""
    c = F.col("confidence")
    counts = ledger.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(c >= 0.8).alias("high"), F.count_if(c < 0.5).alias("low"),
        F.count_if(F.contains(F.lower("method"), F.lit("error"))).alias("errors"),
    )
    score = F.try_divide(F.col("high") + (F.col("n") - F.col("high") - F.col("low")) * 0.7, F.col("n")) * 100
    status = (
        F.when(F.col("n") == 0, "no_imputation_needed").when(score >= 85, "excellent")
        .when(score >= 70, "good").otherwise("needs_review")
    )
    some = F.col("n") > 0
    return counts.select(
        *by, round_half_even(score, 1).alias("overall_quality_score"),
        percentage(F.col("high"), F.col("n"), 1).alias("high_confidence_percentage"),
        F.when(some, F.col("low")).alias("low_confidence_count"),
        F.when(some, F.col("errors")).alias("error_count"), status.alias("status"),
    )


def recommendations(completions: DataFrame, distribution: DataFrame) -> DataFrame:
    """``position, recommendation``; both inputs are report rows (bounded by the columns)."""
    open_columns = completions.where("improvement_percentage < 100").agg(
        F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("position", "column"))), lambda s: s["column"]), ", ").alias("names"))
    total = F.col("high") + F.col("medium") + F.col("low")
    share = F.try_divide(F.col("low") * 100.0, total)
    one = distribution.withColumn("__one", F.lit(1)).join(F.broadcast(open_columns.withColumn("__one", F.lit(1))), "__one")
    some = F.array_compact(F.array(
        F.when(share > 25, F.concat(F.format_number(share, 1), F.lit("% of predictions have low confidence - consider manual review"))),
        F.when(share < 10, "High overall confidence - safe for production use with spot checking"),
        F.when(F.col("names") != "", F.concat(F.lit("Consider additional strategies for: "), F.col("names"))),
        F.lit("Validate a sample of high-confidence predictions against domain expertise"),
    ))
    none = F.array(F.lit("No missing data found - dataset is already complete!"))
    return one.select(F.posexplode(F.when(total == 0, none).otherwise(some)).alias("position", "recommendation"))


def run_summary(df: DataFrame, ledger: DataFrame) -> DataFrame:
    rows = df.agg(F.count(F.lit(1)).alias("total_rows_processed")).withColumn("__one", F.lit(1))
    fills = method_breakdown(ledger).agg(
        F.coalesce(F.sum("fills"), F.lit(0)).alias("total_fields_filled"),
        F.array_sort(F.collect_list("method")).alias("processing_methods_used"),
    ).withColumn("__one", F.lit(1))
    return rows.join(F.broadcast(fills), "__one").drop("__one")  # one row each


def batch_summary(reports: DataFrame) -> DataFrame:
    """Totals over per-file reports ``input_file, success, processing_seconds``."""
    return reports.agg(
        F.count(F.lit(1)).alias("total_files"), F.count_if("success").alias("successful_files"),
        F.count_if(~F.col("success")).alias("failed_files"),
        F.coalesce(F.sum("processing_seconds"), F.lit(0.0)).alias("total_processing_time"),
        F.coalesce(F.avg("processing_seconds"), F.lit(0.0)).alias("average_time_per_file"),
    )


