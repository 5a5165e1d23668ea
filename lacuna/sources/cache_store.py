"""The response cache on disk: buckets of keys, and snapshots that name each bucket's current version.

    <path>/data/version=<v>/bucket=<b>/part-*.parquet     rows of one bucket, never changed once written
    <path>/snapshots/<v>.json                             the version of every bucket that has rows

A change rewrites the buckets it touches under a new version and then adds a snapshot; until that file is there, readers see the one before.
So a write that fails leaves the cache as it was, a write that is tried again overwrites its own leftovers, and of two
writers that start from the same snapshot the second fails. Snapshots are files that are created whole and never replaced, which needs a file
system with an atomic rename.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.functions.durable import durable
from lacuna.operators import cache as C

BUCKETS = 256


class CacheConflict(RuntimeError):
    """Another writer has added a snapshot since this one was read."""


class CacheStore:
    """A stored response cache. ``buckets`` is fixed when the cache is created."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._fs = spark._jvm.org.apache.hadoop.fs
        self._system = self._place("").getFileSystem(spark._jsc.hadoopConfiguration())
        version, self.buckets, _ = self._snapshot()
        if not version:
            self.buckets = buckets

    def _place(self, name: str):
        return self._fs.Path(f"{self.path}/{name}" if name else self.path)

    def versions(self) -> list[int]:
        """Numbers of the snapshots, oldest first."""
        if not self._system.exists(self._place("snapshots")):
            return []
        names = [s.getPath().getName() for s in self._system.listStatus(self._place("snapshots"))]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _snapshot(self, version: int | None = None) -> tuple[int, int, dict[int, int]]:
        """Number, number of buckets, and version by bucket; of the newest snapshot unless told otherwise."""
        if version is None:
            version = max(self.versions(), default=0)
        if not version:
            return 0, 0, {}
        text = self.spark.read.option("wholetext", True).text(f"{self.path}/snapshots/{version}.json").first()[0]
        body = json.loads(text)
        return version, body["buckets"], {int(b): v for b, v in body["versions"].items()}

    def _bucket(self, key: str = "cache_key") -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _rows(self, versions: dict[int, int]) -> DataFrame:
        if not versions:
            return self.spark.createDataFrame([], C.CACHE_SCHEMA)
        paths = [f"{self.path}/data/version={v}/bucket={b}" for b, v in sorted(versions.items())]
        return self.spark.read.schema(C.CACHE_SCHEMA).parquet(*paths)

    def read(self, version: int | None = None) -> DataFrame:
        """All entries of the newest snapshot, or of an earlier one."""
        return self._rows(self._snapshot(version)[2])

    def lookup(self, prompts: DataFrame, ttl: int, now: Column) -> DataFrame:
        """:func:`lacuna.operators.cache.cache_lookup`, reading only the buckets that the prompts' keys fall into."""
        versions = self._snapshot()[2]
        touched = self._touched(prompts)
        return C.cache_lookup(prompts, self._rows({b: v for b, v in versions.items() if b in touched}), ttl, now)

    def _touched(self, keys: DataFrame) -> set[int]:
        return {r[0] for r in keys.select(self._bucket()).distinct().collect()}  # at most one row per bucket

    def _change(self, keys: DataFrame, change: Callable[[DataFrame], DataFrame]) -> int:
        """Replace the buckets of ``keys`` by what ``change`` makes of their rows; the new snapshot's number."""
        base, _, versions = self._snapshot()
        touched = self._touched(keys)
        if not touched:
            return base
        mine = {b: v for b, v in versions.items() if b in touched}
        version = base + 1
        rows = change(self._rows(mine)).withColumns({"version": F.lit(version), "bucket": self._bucket()})
        # One task per bucket and part of it: a bucket is one or a few files, not one from every task.
        rows.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "version", "bucket").parquet(f"{self.path}/data")
        folder = self._place(f"data/version={version}")
        written = set()
        if self._system.exists(folder):
            names = [s.getPath().getName() for s in self._system.listStatus(folder)]
            written = {int(n.split("=")[1]) for n in names if n.startswith("bucket=")} & touched
        kept = {b: v for b, v in versions.items() if b not in touched} | {b: version for b in written}
        self._commit(version, kept)
        return version

    def _commit(self, version: int, versions: dict[int, int]) -> None:
        body = json.dumps({"buckets": self.buckets, "versions": versions}).encode()
        hidden, final = self._place(f"snapshots/.{version}-{id(body)}"), self._place(f"snapshots/{version}.json")
        out = self._system.create(hidden, True)
        out.write(bytearray(body))
        out.close()
        if self._system.exists(final) or not self._system.rename(hidden, final):
            self._system.delete(hidden, False)
            raise CacheConflict(f"snapshot {version} of {self.path} exists already")

    def upsert(self, new: DataFrame) -> int:
        """Add entries; the later one of each key stays. Only the buckets of the new keys are read and written."""
        new = durable(new.select(*[F.col(f.name).cast(f.dataType) for f in C.CACHE_SCHEMA]))
        return self._change(new, lambda rows: C.cache_upsert(rows, new))

    def touch(self, used: DataFrame, now: Column) -> int:
        """Refresh ``last_access`` of the entries that were read."""
        used = durable(used.select("cache_key").distinct())
        return self._change(used, lambda rows: C.cache_touch(rows, used, now))

    def delete(self, keys: DataFrame) -> int:
        keys = durable(keys.select("cache_key").distinct())
        return self._change(keys, lambda rows: C.cache_delete(rows, keys))

    def _keep(self, kept: Callable[[DataFrame], DataFrame]) -> int:
        """Delete what ``kept`` leaves out of the whole cache; buckets that lose nothing are not written."""
        rows = self.read()
        return self.delete(rows.join(kept(rows).select("cache_key"), "cache_key", "left_anti"))

    def evict_lru(self, max_size: int) -> int:
        return self._keep(lambda rows: C.cache_evict_lru(rows, max_size))

    def evict_oldest(self, max_size: int, buffer: int = 100) -> int:
        return self._keep(lambda rows: C.cache_evict_oldest(rows, max_size, buffer))

    def purge(self, ttl: int, now: Column) -> int:
        return self._keep(lambda rows: C.cache_purge(rows, ttl, now))

    def clear(self) -> int:
        """A snapshot without entries."""
        version = self._snapshot()[0] + 1
        self._commit(version, {})
        return version

    def expire(self, keep: int = 2) -> None:
        """Remove all snapshots but the newest ``keep``, and the bucket versions that none of these names."""
        versions = self.versions()
        live = {(b, v) for n in versions[-keep:] for b, v in self._snapshot(n)[2].items()}
        for n in versions[:-keep]:
            self._system.delete(self._place(f"snapshots/{n}.json"), False)
        if not self._system.exists(self._place("data")):
            return
        newest = versions[-1] if versions else 0
        for top in self._system.listStatus(self._place("data")):
            name = top.getPath().getName()
            if not name.startswith("version=") or int(name.split("=")[1]) > newest:  # a writer may be at work there
                continue
            for s in self._system.listStatus(top.getPath()):
                bucket = s.getPath().getName()
                if bucket.startswith("bucket=") and (int(bucket.split("=")[1]), int(name.split("=")[1])) not in live:
                    self._system.delete(s.getPath(), True)
