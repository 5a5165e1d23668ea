"""Reading the tables, and joins whose broadcast side has been counted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checked(df: DataFrame, most: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``most`` rows, else as it is: joins then shuffle it."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def slots(spark: SparkSession, least: int = 1) -> int:
    """Number of groups to deal work into: follows the session's shuffle partitions, which follow the data."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))
