"""The response cache as a table: ``cache_key, value, confidence, reasoning, timestamp, last_access, metadata``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lacuna.functions.ranking import newest

CACHE_SCHEMA = T.StructType([
    T.StructField("cache_key", T.StringType()), T.StructField("value", T.StringType()),
    T.StructField("confidence", T.DoubleType()), T.StructField("reasoning", T.StringType()),
    T.StructField("timestamp", T.TimestampType()), T.StructField("last_access", T.TimestampType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
])


def is_fresh(ttl: int, now: Column) -> Column:
    """An entry expires only when it is strictly older than ``ttl`` seconds."""
    age = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("timestamp").cast("timestamp"))
    return age <= F.lit(ttl * 1_000_000)


def cache_lookup(prompts: DataFrame, cache: DataFrame, ttl: int, now: Column) -> DataFrame:
    """Prompts with the cached answer, or NULLs and ``hit = false``."""
    answers = cache.where(is_fresh(ttl, now)).select("cache_key", "value", "confidence", "reasoning", F.lit(True).alias("hit"))
    return prompts.join(answers, "cache_key", "left").withColumn("hit", F.coalesce("hit", F.lit(False)))


def cache_misses(prompts: DataFrame, cache: DataFrame, ttl: int, now: Column) -> DataFrame:
    return prompts.join(cache.where(is_fresh(ttl, now)).select("cache_key"), "cache_key", "left_anti")


def cache_touch(cache: DataFrame, used_keys: DataFrame, now: Column) -> DataFrame:
    """Refresh ``last_access`` of the entries that were read."""
    used = used_keys.select("cache_key").distinct().withColumn("__used", F.lit(True))
    joined = cache.join(used, "cache_key", "left")
    touched = F.when(F.col("__used"), now).otherwise(F.col("last_access"))
    return joined.select(*[touched.alias(c) if c == "last_access" else F.col(c) for c in cache.columns])


def cache_upsert(cache: DataFrame, new: DataFrame) -> DataFrame:
    """The later entry of each key wins; combined before the shuffle, so repeated keys stay cheap."""
    both = cache.unionByName(new)
    payload = F.struct(*[F.col(c) for c in cache.columns if c != "cache_key"])
    # Maps cannot be ordered: the latest entry is chosen by time, then by its plain fields.
    order = F.struct("timestamp", "last_access", "value", "confidence", "reasoning")
    merged = both.groupBy("cache_key").agg(F.max_by(payload, order).alias("e"))
    return merged.select(*["cache_key" if c == "cache_key" else F.col(f"e.{c}").alias(c) for c in cache.columns])


def cache_evict_lru(cache: DataFrame, max_size: int) -> DataFrame:
    """Keep the ``max_size`` most recently used entries."""
    return newest(cache, "last_access", "cache_key", max_size)


def cache_evict_oldest(cache: DataFrame, max_size: int, buffer: int = 100) -> DataFrame:
    """A full cache loses its oldest ``size - max_size + buffer`` entries; a smaller one stays whole."""
    size = cache.count()
    if size < max_size:
        return cache
    keep = max(0, min(size, max_size - buffer))
    return newest(cache, "timestamp", "cache_key", keep)


def cache_purge(cache: DataFrame, ttl: int, now: Column) -> DataFrame:
    return cache.where(is_fresh(ttl, now))


def cache_delete(cache: DataFrame, keys: DataFrame) -> DataFrame:
    return cache.join(keys.select("cache_key"), "cache_key", "left_anti")


def cache_clear(cache: DataFrame) -> DataFrame:
    return cache.where(F.lit(False))


def cache_stats(cache: DataFrame, max_size: int, ttl: int, lookups: DataFrame | None = None) -> DataFrame:
    """Size and limits; with ``lookups`` also how many of them hit."""
    size = cache.agg(F.count(F.lit(1)).alias("size")).select(
        F.lit(True).alias("enabled"), F.lit("table").alias("backend"), "size",
        F.lit(max_size).alias("max_size"), F.lit(ttl).alias("ttl_seconds"), F.lit(1).alias("__one"),
    )
    if lookups is None:
        return size.drop("__one")
    rate = lookups.agg(
        F.count(F.lit(1)).alias("lookups"), F.count_if("hit").alias("hits"),
        F.avg(F.col("hit").cast("int")).alias("hit_rate"),
    ).withColumn("__one", F.lit(1))
    return size.join(F.broadcast(rate), "__one").drop("__one")  # one row each
