"""Top-n selection that keeps hot groups out of single tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALT_BUCKETS = 64


def group_limit(df: DataFrame) -> int:
    """Largest n for which Spark trims each partition before the shuffle (WindowGroupLimit)."""
    return int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))


def top_n(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column], n: int,
          salt: Column | None = None) -> DataFrame:
    """The first ``n`` rows of every key in ``order``; exact.

    A row_number filter lets Spark keep only ``n`` rows per key in every input partition. With
    ``salt`` (any evenly spread column) the survivors are ranked per salt bucket first, so that the
    last task of a key sees at most ``SALT_BUCKETS * n`` rows.
    """
    if salt is not None:
        bucket = F.pmod(F.xxhash64(salt), F.lit(SALT_BUCKETS))
        spread = Window.partitionBy(*keys, bucket).orderBy(*order)
        df = df.withColumn("__rank", F.row_number().over(spread)).where(F.col("__rank") <= n).drop("__rank")
    ranked = df.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("__rank") <= n).drop("__rank")


def newest(df: DataFrame, ts: str, tie: str, n: int, newest_first: bool = True) -> DataFrame:
    """The ``n`` rows with the latest (or earliest) ``ts``, ties by smallest ``tie``; exact for any n.

    A small n uses :func:`top_n`. A large one finds the time bucket that holds the n-th row from
    bucket counts - first by hour, then by second - keeps all earlier buckets untouched and ranks
    only the rows of the boundary second.
    """
    def ordered(seconds: int) -> Column:
        bucket = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(seconds * 1_000_000))
        return -bucket if newest_first else bucket

    order = [F.col(ts).desc() if newest_first else F.col(ts).asc(), F.col(tie).asc()]
    if n <= 0:
        return df.where(F.lit(False))
    if n <= group_limit(df):
        return top_n(df, [F.lit(0)], order, n, salt=F.col(tie))

    kept, edge, wanted = None, df, n
    for seconds in (3600, 1):
        counts = edge.groupBy(ordered(seconds).alias("b")).agg(F.count(F.lit(1)).alias("c"))
        cum = counts.withColumn("cum", F.sum("c").over(Window.orderBy("b")))
        row = cum.where(F.col("cum") >= wanted).orderBy("b").limit(1).collect()
        if not row:
            return df
        boundary = F.lit(row[0]["b"])
        before = edge.where(ordered(seconds) < boundary)
        kept = before if kept is None else kept.unionByName(before)
        wanted -= row[0]["cum"] - row[0]["c"]
        edge = edge.where(ordered(seconds) == boundary)
    return kept.unionByName(top_n(edge, [F.lit(0)], order, wanted, salt=F.col(tie)))
