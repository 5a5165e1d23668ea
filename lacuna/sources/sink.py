"""Writing tables and metric exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.functions.columns import as_text, scalar_columns


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A directory of part files with headers; numbers keep their plain decimal form."""
    df.select(*[as_text(df, c).alias(c) for c in scalar_columns(df)]).write.mode(mode).option(
        "header", True).option("escape", '"').csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def export_metrics(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Metric rows ``kind, record`` as JSON lines, one folder per kind."""
    rows.select(F.col("kind"), F.col("record").alias("value")).write.mode(mode).partitionBy("kind").text(path)
