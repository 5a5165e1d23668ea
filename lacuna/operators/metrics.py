"""Run metrics as three append-only tables, and their summaries.

``performance``: operation, duration_seconds, timestamp, success.
``api_calls``: provider, model, timestamp, duration_seconds, tokens_used, cost, success, error.
``imputations``: column, method, count, average_confidence, timestamp, duration_seconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.functions.ranking import newest
from lacuna.operators.cells import last_hours


def operation_summary(performance: DataFrame, hours: int, now: Column) -> DataFrame:
    d = F.col("duration_seconds")
    return last_hours(performance, hours, now).groupBy("operation").agg(
        F.count(F.lit(1)).alias("count"), F.avg(d).alias("avg_duration"), F.min(d).alias("min_duration"),
        F.max(d).alias("max_duration"), F.sum(d).alias("total_duration"))


def api_summary(calls: DataFrame, hours: int, now: Column) -> DataFrame:
    """Per provider; tokens and cost of successful calls only. ``success_rate`` is over all providers."""
    ok = F.col("success")
    per = last_hours(calls, hours, now).groupBy("provider").agg(
        F.count(F.lit(1)).alias("calls"),
        F.coalesce(F.sum(F.when(ok, F.col("tokens_used"))), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum(F.when(ok, F.col("cost"))), F.lit(0.0)).alias("cost"),
        F.count_if(~ok).alias("errors"),
    )
    total = per.agg(((F.sum("calls") - F.sum("errors")) / F.sum("calls") * 100.0).alias("success_rate"))
    joined = per.withColumn("__one", F.lit(1)).join(F.broadcast(total.withColumn("__one", F.lit(1))), "__one")
    return joined.drop("__one")  # the total is a single row


def imputation_summary(imputations: DataFrame, hours: int, now: Column) -> DataFrame:
    """Per method; the mean of the runs' mean confidences is not weighted by their size."""
    return last_hours(imputations, hours, now).groupBy("method").agg(
        F.count(F.lit(1)).alias("operations"), F.sum("count").alias("values_filled"),
        F.avg("average_confidence").alias("avg_confidence"))


def _entries(table: DataFrame, *pairs: tuple[Column, Column]) -> DataFrame:
    entries = F.array(*[F.struct(name.alias("name"), value.cast("double").alias("value")) for name, value in pairs])
    return table.select(F.inline(entries)).where(F.col("name").isNotNull() & F.col("value").isNotNull())


def counters(performance: DataFrame, calls: DataFrame, imputations: DataFrame) -> DataFrame:
    """``name, value`` of all running counters."""
    return counter_entries(performance, calls, imputations).groupBy("name").agg(F.sum("value").alias("value"))


def counter_entries(performance: DataFrame, calls: DataFrame, imputations: DataFrame) -> DataFrame:
    """What each record, of a table or a stream, adds to the counters: ``name, value``."""
    one, lit = F.lit(1), F.lit

    def name(*parts) -> Column:
        return F.concat(*[lit(p) if isinstance(p, str) else p for p in parts])

    outcome = F.when(F.col("success"), "success").otherwise("error")
    paid = lambda c: F.when(F.col("success") & (F.col(c) != 0), F.col(c))
    op, provider = F.col("operation"), F.col("provider")
    return _entries(
        performance, (name("operations.", op, ".total"), one), (name("operations.", op, ".", outcome), one),
    ).unionByName(_entries(
        calls, (name("api.", provider, ".calls.total"), one), (name("api.", provider, ".calls.", F.col("model")), one),
        (name("api.", provider, ".calls.", outcome), one), (name("api.", provider, ".tokens.total"), paid("tokens_used")),
        (name("api.", provider, ".cost.total"), paid("cost")),
    )).unionByName(_entries(
        imputations, (name("imputation.", F.col("method"), ".total"), one),
        (lit("imputation.values_filled.total"), F.col("count")),
    ))


def newest_metrics(metrics: DataFrame, tie: str, n: int = 10_000, ts: str = "timestamp") -> DataFrame:
    """The newest ``n`` records of one kind."""
    return newest(metrics, ts, tie, n)


def metrics_summary(performance: DataFrame, calls: DataFrame, imputations: DataFrame, hours: int, now: Column,
                    cache_statistics: DataFrame | None = None) -> DataFrame:
    """All summaries in long form ``section, key, measure, value``."""
    def long(table: DataFrame, section: str, key: Column, measures: list[str]) -> DataFrame:
        return table.select(F.lit(section).alias("section"), key.alias("key"), F.inline(F.array(*[
            F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures])))

    parts = [
        long(operation_summary(performance, hours, now), "performance", F.col("operation"),
             ["count", "avg_duration", "min_duration", "max_duration", "total_duration"]),
        long(api_summary(calls, hours, now), "api_usage", F.col("provider"), ["calls", "tokens", "cost", "errors", "success_rate"]),
        long(imputation_summary(imputations, hours, now), "imputation", F.col("method"),
             ["operations", "values_filled", "avg_confidence"]),
    ]
    if cache_statistics is not None:
        parts.append(long(cache_statistics, "cache", F.col("backend"), ["size", "max_size", "ttl_seconds"]))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def pair_spans(starts: DataFrame, ends: DataFrame) -> DataFrame:
    """Performance records from start events ``operation_id, operation, start_ts`` and end events
    ``operation_id, end_ts, success, error``; an end without start is left out."""
    seconds = (F.unix_micros(F.col("end_ts").cast("timestamp")) - F.unix_micros(F.col("start_ts").cast("timestamp"))) / 1e6
    return starts.join(ends, "operation_id").select(
        "operation_id", "operation", seconds.alias("duration_seconds"), F.col("end_ts").alias("timestamp"), "success", "error")


def orphan_ends(starts: DataFrame, ends: DataFrame) -> DataFrame:
    return ends.join(starts.select("operation_id"), "operation_id", "left_anti")


def imputation_records(ledger: DataFrame, now: Column, duration_seconds: float) -> DataFrame:
    """One imputation record per method of a run."""
    return ledger.groupBy("method").agg(F.count(F.lit(1)).alias("count"), F.avg("confidence").alias("average_confidence")).select(
        F.lit("aggregated").alias("column"), "method", "count", "average_confidence", now.alias("timestamp"),
        F.lit(duration_seconds).alias("duration_seconds"))


def export_rows(performance: DataFrame, calls: DataFrame, imputations: DataFrame) -> DataFrame:
    """All metric records as ``kind, record`` with the record in JSON."""
    def packed(kind: str, table: DataFrame) -> DataFrame:
        return table.select(F.lit(kind).alias("kind"), F.to_json(F.struct(*[F.col(c) for c in table.columns])).alias("record"))

    return packed("performance_metrics", performance).unionByName(packed("api_call_metrics", calls)).unionByName(
        packed("imputation_metrics", imputations))
