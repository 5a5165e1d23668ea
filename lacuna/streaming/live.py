"""Fills, summaries and gates under Structured Streaming."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from lacuna.functions.columns import ref
from lacuna.functions.durable import durable, small_table
from lacuna.functions.joins import attach_unique
from lacuna.functions.ranking import newest
from lacuna.operators.cells import patch
from lacuna.operators.input_rules import validate_input
from lacuna.params import InputLimits


def stream_fill(stream: DataFrame, values: Mapping[str, float | str]) -> DataFrame:
    """Fill with statistics frozen at start: stateless, one constant per column."""
    return stream.select(*[
        (patch(stream, c, F.lit(values[c])) if c in values else ref(c)).alias(c) for c in stream.columns])


def stream_fill_by(stream: DataFrame, target: str, stats: DataFrame, by: str, value: str) -> DataFrame:
    """Fill from a static table of per-key statistics; broadcast only when it is small."""
    known = durable(stats.select(ref(by).alias(by), ref(value).alias("__fill")))  # frozen at start
    joined = attach_unique(stream, known, [by])
    return joined.select(*[
        (patch(stream, c, F.col("__fill")) if c == target else ref(c)).alias(c) for c in stream.columns])


def stream_summary(performance: DataFrame, watermark: str = "1 hour", width: str = "1 hour",
                   slide: str | None = None, ts: str = "timestamp") -> DataFrame:
    """Operation summary per tumbling or sliding window; rows later than the watermark are dropped."""
    timed = performance.withColumn("__ts", F.col(ts).cast("timestamp")).withWatermark("__ts", watermark)
    window = F.window("__ts", width, slide) if slide else F.window("__ts", width)
    d = F.col("duration_seconds")
    return timed.groupBy(window.alias("w"), "operation").agg(
        F.count(F.lit(1)).alias("count"), F.avg(d).alias("avg_duration"), F.min(d).alias("min_duration"),
        F.max(d).alias("max_duration"), F.sum(d).alias("total_duration"),
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "operation", "count",
             "avg_duration", "min_duration", "max_duration", "total_duration")


def stream_distinct_prompts(prompts: DataFrame, ttl: str = "1 hour", ts: str = "timestamp") -> DataFrame:
    """One prompt per cache key within the time to live."""
    timed = prompts.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, ttl)
    return timed.dropDuplicatesWithinWatermark(["cache_key"])


def stream_gate(stream: DataFrame, good: str, quarantine: str, verdicts: str, checkpoint: str,
                limits: InputLimits = InputLimits(max_rows=None)) -> DataStreamWriter:
    """Validate every micro-batch: rows go to ``good`` or ``quarantine``, its verdicts to ``verdicts``.

    How many rows a batch has is a matter of the trigger, so unless told otherwise it has no row limit.
    Paths are keyed by batch id and overwritten, so a replayed batch leaves no duplicates.
    """
    def route(batch: DataFrame, batch_id: int) -> None:
        report = validate_input(batch, limits).withColumn("batch_id", F.lit(batch_id))
        report = small_table(report)
        blocked = report.where("severity = 'error' and not passed").limit(1).count() > 0
        batch.write.mode("overwrite").parquet(f"{quarantine if blocked else good}/batch_id={batch_id}")
        report.drop("batch_id").write.mode("overwrite").parquet(f"{verdicts}/batch_id={batch_id}")

    return stream.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint).trigger(availableNow=True)


def _latest(spark: SparkSession, folder: str) -> int:
    """The newest batch that is whole in ``folder``; -1 if there is none."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    place = hadoop.Path(folder)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place):
        return -1
    names = [s.getPath() for s in system.listStatus(place)]
    whole = [p.getName() for p in names if p.getName().startswith("batch=") and system.exists(hadoop.Path(p, "_SUCCESS"))]
    return max((int(n.split("=")[1]) for n in whole), default=-1)


def read_latest(spark: SparkSession, folder: str) -> DataFrame:
    """What :func:`stream_counters` or :func:`stream_newest` has written last."""
    return spark.read.parquet(f"{folder}/batch={_latest(spark, folder)}")


def stream_counters(entries: DataFrame, target: str, checkpoint: str) -> DataStreamWriter:
    """Running sums of ``name, value`` entries, kept in Spark's state by name; ``target/batch=<n>`` has all counters after batch ``n``.

    A restart goes on from ``checkpoint``; a batch that is run again overwrites its own folder, so nothing counts twice.
    """
    def put(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    sums = entries.groupBy("name").agg(F.sum("value").alias("value"))
    return sums.writeStream.outputMode("complete").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True)


def stream_newest(stream: DataFrame, target: str, checkpoint: str, tie: str, n: int = 10_000, ts: str = "timestamp") -> DataStreamWriter:
    """The newest ``n`` records so far: ``target/batch=<n>`` has them after each batch, made of the batch before and the new rows.

    Only ``n`` records are read again, whatever has gone by. A batch that is run again starts from the same earlier one.
    """
    def put(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _latest(spark, target)
        before = before if before < batch_id else batch_id - 1
        rows = batch if before < 0 else spark.read.schema(batch.schema).parquet(f"{target}/batch={before}").unionByName(batch)
        newest(rows, ts, tie, n).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True)


def stream_spans(starts: DataFrame, ends: DataFrame, longest: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Spans as their events arrive: ``operation_id, operation, duration_seconds, timestamp, success, error, state``.

    ``starts`` has operation_id, operation, start_ts; ``ends`` operation_id, end_ts, success, error. An end belongs to a start of its id that is
    at most ``longest`` before it. Pairs come out at once (``paired``); when the watermark, ``late`` behind the newest events, has passed
    all possible partners, an end without start comes out as ``orphan`` and a start without end as ``open``, and their state goes.
    """
    left = starts.select(F.col("operation_id"), "operation", F.col("start_ts").cast("timestamp").alias("start_ts")).withWatermark("start_ts", late)
    right = ends.select(F.col("operation_id").alias("end_id"), F.col("end_ts").cast("timestamp").alias("end_ts"), "success", "error").withWatermark(
        "end_ts", late)
    both = left.join(right, F.expr(
        f"operation_id = end_id AND end_ts >= start_ts AND end_ts <= start_ts + INTERVAL {longest}"), "full_outer")
    seconds = (F.unix_micros("end_ts") - F.unix_micros("start_ts")) / 1e6
    state = F.when(F.col("start_ts").isNull(), "orphan").when(F.col("end_ts").isNull(), "open").otherwise("paired")
    return both.select(F.coalesce("operation_id", "end_id").alias("operation_id"), "operation", seconds.alias("duration_seconds"),
                       F.coalesce("end_ts", "start_ts").alias("timestamp"), "success", "error", state.alias("state"))
