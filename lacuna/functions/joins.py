"""Joining a large table to one row per key, whatever the key distribution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.functions.columns import ref
from lacuna.functions.durable import local_table

BROADCAST_GROUPS = 10_000
HOT_KEYS = 10_000
HOT_ROWS = 1_000_000


def attach_unique(left: DataFrame, right: DataFrame, keys: Sequence[str], weight: str | None = None) -> DataFrame:
    """Left join with ``right``, which has one row per key; NULL keys match.

    Up to ``BROADCAST_GROUPS`` keys are broadcast. Beyond that, ``weight`` (about how many left rows a
    key has) singles out the hot keys: at most ``HOT_KEYS`` of them can weigh ``total / HOT_KEYS`` or
    more, so their right rows are broadcast too and the hot left rows are never shuffled. All other
    rows take an ordinary join. No row is dropped on either way.
    """
    extra = [c for c in right.columns if c not in keys]

    def match(r: DataFrame) -> tuple[DataFrame, Column]:
        # New names on the right: it may come from the same table as the left.
        renamed = r.select(*[ref(c).alias(f"__r_{c}") for c in r.columns])
        condition = F.lit(True)
        for k in keys:
            condition = condition & ref(k).eqNullSafe(ref(f"__r_{k}"))
        return renamed, condition

    def joined(l: DataFrame, r: DataFrame, how: str, small: bool = False) -> DataFrame:
        renamed, condition = match(r)
        return l.join(F.broadcast(renamed) if small else renamed, condition, how).select(
            *[ref(c) for c in left.columns], *[ref(f"__r_{c}").alias(c) for c in extra])

    rows = right.limit(BROADCAST_GROUPS + 1).collect()
    if len(rows) <= BROADCAST_GROUPS:
        return joined(left, local_table(left.sparkSession, rows, right.schema), "left", small=True)
    if weight is None:
        return joined(left, right, "left")
    total, top = right.agg(F.sum(weight), F.max(weight)).first()
    limit = max(HOT_ROWS, total / HOT_KEYS)
    if top < limit:
        return joined(left, right, "left")
    hot = right.where(ref(weight) >= limit)
    marks, condition = match(hot.select(*keys))
    cold = left.join(F.broadcast(marks), condition, "left_anti")
    return joined(left, hot, "inner", small=True).unionByName(joined(cold, right.where(ref(weight) < limit), "left"))
