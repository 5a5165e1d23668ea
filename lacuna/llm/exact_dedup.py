"""Exact duplicates by exchanging compressed fingerprints, not texts.

1. Every row gets the SHA-256 of its normalised text; its leading bits are the fingerprint. The task that reads a row
   writes both to the bucket of the row's sender, so no digest is shuffled.
2. A sender reads its bucket, sorts its distinct fingerprints and sends each owner (a range of fingerprints) its
   part, Golomb-coded: about ``EXTRA_BITS`` + 2 bits for each.
3. An owner merges what it received and answers each sender with a bitmap: which fingerprints others have too.
4. Senders mark their suspects. Only suspect texts are shuffled, one row per text and task, and compared byte by byte.

A text that a third of all rows share is one fingerprint at each sender and one row of the verification per task. Senders
and owners follow the number of rows, and each task's rows are dealt to senders in runs of ``ROWS_PER_SENDER / RUNS``, so that
none holds much more than ``ROWS_PER_SENDER``, however uneven the tasks are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.functions.columns import ref
from lacuna.functions.durable import durable, durable_buckets
from lacuna.functions.joins import attach_unique
from lacuna.llm.tables import checked, slots

EXTRA_BITS = 20  # fingerprints this much longer than needed to count rows: about 1 in 2**20 unique rows is a false suspect
ROWS_PER_SENDER = 2_000_000
RUNS = 8
KEYS_BROADCAST = 250_000


def golomb_encode(values: np.ndarray) -> bytes:
    """Sorted non-negative integers as gaps, the quotients in unary and the remainders in fixed bits.

    The divisor is the power of two next to the mean gap.
    """
    n = len(values)
    if n == 0:
        return b"\0" * 5
    gaps = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    k = max(0, (int(values[-1]) // n).bit_length() - 1)
    quotient = (gaps >> np.uint64(k)).astype(np.int64)
    stops = np.cumsum(quotient + 1) - 1
    unary = np.ones(int(stops[-1]) + 1, np.uint8)
    unary[stops] = 0
    rest = np.empty((n, k), np.uint8)
    for b in range(k):
        rest[:, b] = (gaps >> np.uint64(k - 1 - b)) & np.uint64(1)
    first = np.packbits(unary).tobytes()
    return n.to_bytes(4, "little") + k.to_bytes(1, "little") + len(first).to_bytes(4, "little") + first + np.packbits(rest).tobytes()


def golomb_decode(code: bytes) -> np.ndarray:
    n, k = int.from_bytes(code[:4], "little"), code[4]
    if n == 0:
        return np.zeros(0, np.uint64)
    cut = 9 + int.from_bytes(code[5:9], "little")
    unary = np.unpackbits(np.frombuffer(code[9:cut], np.uint8))
    stops = np.flatnonzero(unary == 0)[:n]
    gaps = (np.diff(stops, prepend=-1) - 1).astype(np.uint64) << np.uint64(k)
    rest = np.unpackbits(np.frombuffer(code[cut:], np.uint8), count=n * k).reshape(n, k)
    for b in range(k):
        gaps |= rest[:, b].astype(np.uint64) << np.uint64(k - 1 - b)
    return np.cumsum(gaps, dtype=np.uint64)


def normalised(text: Column) -> Column:
    """NULL as empty; each run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _prints(shas: pa.ChunkedArray | pa.Array, bits: int) -> np.ndarray:
    raw = np.frombuffer(b"".join(shas.to_pylist()), ">u8").reshape(-1, 4)[:, 0].astype(np.uint64)
    return raw >> np.uint64(64 - bits)


def _owner(prints: np.ndarray, bits: int, owners: int) -> np.ndarray:
    return ((prints >> np.uint64(bits - 32)) * np.uint64(owners)) >> np.uint64(32)


def exact_dedup(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_col: str | None = None,
                rows_per_sender: int = ROWS_PER_SENDER) -> DataFrame:
    """One row per row: ``id_col`` (and ``key_col``), keep_id, group_size, kept, text_sha256.

    Texts are equal when they are after each run of ASCII white space becomes one space; NULL counts as empty. Of equal
    texts the row with the smallest id stays, NULL ids last; of several rows with that id one stays, the one with the
    smallest ``key_col`` (a unique row key; without it, the first as read). ``keep_id`` is the id of the row that stays.
    An empty table gives an empty result; other columns are not read.
    """
    spark = documents.sparkSession
    text = normalised(ref(text_col))
    key = F.monotonically_increasing_id() if key_col is None else ref(key_col)
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)  # of the row in its task
    run = F.spark_partition_id() + F.floor(place / max(1, rows_per_sender // RUNS))
    rows = documents.count()
    groups = max(slots(spark), -(-rows // rows_per_sender))
    bits = min(62, max(34, rows.bit_length() + EXTRA_BITS))
    held = durable_buckets(documents.select(
        F.pmod(run, F.lit(groups)).cast("int").alias("sender"), key.alias("key"), ref(id_col).alias("id"),
        F.unhex(F.sha2(text, 256)).alias("sha")), "sender", groups)

    def send(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = np.unique(np.concatenate([_prints(b.column("sha"), bits) for b in batches]))
        bounds = np.searchsorted(_owner(prints, bits, groups), np.arange(groups + 1, dtype=np.uint64))
        for owner in range(groups):
            part = prints[bounds[owner]:bounds[owner + 1]]
            if len(part):
                base = int(part[0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([owner], pa.int32()), pa.array([key[0].as_py()], pa.int32()), pa.array([base], pa.int64()),
                     pa.array([golomb_encode(part - np.uint64(base))], pa.binary())], names=["owner", "sender", "base", "code"])

    def answer(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        senders, parts = [], []
        for b in batches:
            senders += b.column("sender").to_pylist()
            parts += [golomb_decode(c) + np.uint64(base) for c, base in zip(b.column("code").to_pylist(), b.column("base").to_pylist())]
        together = np.sort(np.concatenate(parts))
        shared = np.unique(together[1:][together[1:] == together[:-1]])
        for sender, part in zip(senders, parts):
            yield pa.RecordBatch.from_arrays(
                [pa.array([sender], pa.int32()), pa.array([key[0].as_py()], pa.int32()),
                 pa.array([np.packbits(np.isin(part, shared)).tobytes()], pa.binary())], names=["sender", "owner", "bitmap"])

    def mark(left: pa.Table, right: pa.Table) -> pa.Table:
        prints = _prints(left.column("sha"), bits)
        distinct, place, times = np.unique(prints, return_inverse=True, return_counts=True)
        suspect = times > 1
        bounds = np.searchsorted(_owner(distinct, bits, groups), np.arange(groups + 1, dtype=np.uint64))
        for owner, bitmap in zip(right.column("owner").to_pylist(), right.column("bitmap").to_pylist()):
            a, b = bounds[owner], bounds[owner + 1]
            suspect[a:b] |= np.unpackbits(np.frombuffer(bitmap, np.uint8), count=int(b - a)).astype(bool)
        return left.select(["key", "id", "sha"]).append_column("suspect", pa.array(suspect[place.ravel()], pa.bool_()))

    messages = held.select("sender", "sha").groupBy("sender").applyInArrow(send, "owner int, sender int, base long, code binary")
    bitmaps = messages.groupBy("owner").applyInArrow(answer, "sender int, owner int, bitmap binary")
    types = {f.name: f.dataType.simpleString() for f in held.schema}
    marked = durable(held.groupBy("sender").cogroup(bitmaps.groupBy("sender")).applyInArrow(
        mark, f"key {types['key']}, id {types['id']}, sha binary, suspect boolean"))

    suspects = marked.where("suspect")
    keys = suspects.select(F.col("sha").alias("sha_key")).distinct()
    texts = documents.select(text.alias("text")).withColumn("sha", F.unhex(F.sha2("text", 256)))
    verified = (texts.join(checked(keys, KEYS_BROADCAST), F.col("sha") == F.col("sha_key"), "left_semi")
                .groupBy("sha", "text").agg(F.count("*").alias("n"))
                .groupBy("sha").agg(F.sum("n").alias("n"), F.count("*").alias("texts")))
    kept = suspects.groupBy("sha").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("first"),
                                       F.count("*").alias("rows"))
    # Equal digests of different texts would show here; no such pair of texts is known to anyone.
    same = (F.col("texts") == 1) & (F.col("n") == F.col("rows"))
    sound = kept.join(verified, "sha").select(
        "sha", F.col("first.id").alias("keep_id"), F.col("first.key").alias("keep_key"),
        F.when(same, F.col("rows")).otherwise(F.raise_error("texts with one digest differ").cast("long")).alias("group_size"))
    grouped = attach_unique(suspects.select("key", "id", "sha"), durable(sound), ["sha"], weight="group_size")
    alone = marked.where(~F.col("suspect")).select("key", "id", "sha", F.col("id").alias("keep_id"), F.col("key").alias("keep_key"),
                                                   F.lit(1).cast("long").alias("group_size"))
    out = grouped.unionByName(alone)
    return out.select(F.col("id").alias(id_col), *([F.col("key").alias(key_col)] if key_col else []), "keep_id", "group_size",
                      F.col("key").eqNullSafe(F.col("keep_key")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
