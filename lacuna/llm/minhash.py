"""Near duplicates by b-bit MinHash: bands propose, packed low bits of the minima judge, full sets confirm.

1. One pass hashes each different shingle set with ``BANDS * ROWS`` functions and keeps the minima only as ``BANDS`` hashes of ``ROWS``
   minima each, and as the lowest ``BITS`` bits of each minimum, packed into bit planes.
2. Sets with a common band are candidates of a bucket; buckets with the same members count once. Within a bucket, sets are
   compared by their planes: XOR, OR over planes and a bit count give the share of equal minima, and as unequal ones agree by chance
   once in 2 ** BITS, the similarity is (share - chance) / (1 - chance). Pairs below the limit are out; of the others only a
   spanning forest leaves the bucket, so no bucket ever lists its pairs.
3. A bucket with more than ``BUCKET`` sets is dealt anew by pairs of bands, since similar sets share many. What is still larger
   is tied to its smallest set without a judgement.
4. What the forests hold together is a cluster. Only sets in clusters are built again from their texts, and links are confirmed
   on them; clusters of any size are compared in bounded blocks.

A pair of the least similarity that still links shares no band with probability (1 - s ** ROWS) ** BANDS, 2e-10 for 0.85, and the limit is
set so that its estimate falls below it with probability ``MISS``; more similar pairs are missed less. Links are never
accepted by estimate.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.functions.columns import ref
from lacuna.functions.durable import durable
from lacuna.functions.joins import attach_unique
from lacuna.llm.components import components
from lacuna.llm.ngram_join import _labels, digest, shingle_sets
from lacuna.llm.tables import checked
from lacuna.llm.text import chunks, column_bytes, mix, slices

WORDS = 5
PERCENT = 85
BANDS, ROWS = 38, 5
BITS = 4
MISS = 1e-9
BUCKET = 20_000
BLOCK_TOKENS = 500_000
IDS_BROADCAST = 500_000

HASHES = BANDS * ROWS
WORDS_A_PLANE = -(-HASHES // 64)
#: Odd factors of the hash functions; the sets' tokens are spread over 64 bits already.
FACTORS = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """The least value of each function (row) over each set (column); the sets are not empty."""
    tokens = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((HASHES, len(sets)), np.uint64)
    product = np.empty_like(tokens)
    for k, factor in enumerate(FACTORS):
        np.multiply(tokens, factor, out=product)
        out[k] = np.minimum.reduceat(product, starts)
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    """One row of ``BANDS`` 64-bit keys per set; keys of different bands differ."""
    rows = least.reshape(BANDS, ROWS, least.shape[1])
    key = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[:, None], rows.shape[2], 1)
    for r in range(ROWS):
        key = mix(key * FACTORS[r] + rows[:, r])
    return np.ascontiguousarray(key.T).view(np.int64)


def planes(least: np.ndarray) -> np.ndarray:
    """One row per set: bit planes of the lowest ``BITS`` bits of its minima, ``WORDS_A_PLANE`` words each."""
    low = mix(least).T
    out = np.zeros((low.shape[0], BITS, WORDS_A_PLANE * 64), np.uint8)
    for b in range(BITS):
        out[:, b, :HASHES] = low >> np.uint64(b) & np.uint64(1)
    return np.packbits(out, axis=2, bitorder="little").reshape(low.shape[0], BITS * WORDS_A_PLANE * 8).view("<u8")


def unequal(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """How many of the minima kept in ``one`` differ from those of each row of ``many``, as far as the planes show."""
    apart = np.bitwise_or.reduce((many ^ one).reshape(len(many), BITS, WORDS_A_PLANE), axis=1)
    return np.bitwise_count(apart).sum(axis=1, dtype=np.int64)


def similarity(differing: np.ndarray | int) -> np.ndarray | float:
    """Jaccard similarity estimated from :func:`unequal`, corrected for bits that agree by chance."""
    chance = 1 / 2**BITS
    return ((HASHES - differing) / HASHES - chance) / (1 - chance)


def most_unequal(percent: int, miss: float = MISS) -> int:
    """The largest count of :func:`unequal` that a pair of this similarity exceeds with probability ``miss`` at most."""
    differ = (1 - percent / 100) * (1 - 1 / 2**BITS)
    tail, k = 0.0, HASHES
    while k > 0:
        tail += math.comb(HASHES, k) * differ**k * (1 - differ) ** (HASHES - k)
        if tail > miss:
            return k
        k -= 1
    return 0


def forest(signatures: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Edges (found from, found) that hold together what chains of pairs with at most ``limit`` unequal minima hold together."""
    rest = np.arange(len(signatures))
    edges: list[tuple[int, int]] = []
    while len(rest):
        stack, rest = [int(rest[0])], rest[1:]
        while stack and len(rest):
            at = stack.pop()
            near = unequal(signatures[at], signatures[rest]) <= limit
            found = rest[near].tolist()
            edges += [(at, f) for f in found]
            stack += found
            rest = rest[~near]
    return edges


def _measure(documents: DataFrame, words: int) -> DataFrame:
    """key, id, n, sid of each document; bands and signature only where the task has not seen the set before."""
    key, kind = (documents.schema[c].dataType.simpleString() for c in ("key", "id"))

    def lists(rows: np.ndarray, there: list[bool]) -> pa.Array:
        offsets = np.concatenate(([0], np.cumsum(there))) * rows.shape[1]
        mask = pa.array([not t for t in there])
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(rows.ravel().view(np.int64)), mask=mask)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in slices(batches):
            texts = column_bytes(batch.column(2))
            for s in chunks(texts):
                sets = shingle_sets(texts[s], words)
                sids = [digest(k) for k in sets]
                new = []
                for keys, sid in zip(sets, sids):
                    new.append(len(keys) > 0 and sid not in seen)
                    seen.add(sid)
                fresh = [k for k, n in zip(sets, new) if n]
                least = minima(fresh) if fresh else np.zeros((HASHES, 0), np.uint64)
                size = s.stop - s.start
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s.start, size), batch.column(1).slice(s.start, size), pa.array([len(k) for k in sets], pa.int64()),
                     pa.array(sids, pa.binary()), lists(band_keys(least), new), lists(planes(least), new)],
                    names=["key", "id", "n", "sid", "bands", "signature"])

    return documents.mapInArrow(work, f"key {key}, id {kind}, n long, sid binary, bands array<long>, signature array<long>")


def _buckets(rows: DataFrame) -> DataFrame:
    """bucket, size: where several sets of ``rows`` (bucket, sid, each pair once) meet; of buckets with the same members, one."""
    sizes = rows.groupBy("bucket").agg(F.min("sid").alias("low"), F.max("sid").alias("high"), F.count("*").alias("size"),
                                       F.expr("bit_xor(xxhash64(sid))").alias("print")).where("low != high")
    return durable(sizes.groupBy("low", "high", "size", "print").agg(F.min("bucket").alias("bucket")).select("bucket", "size", "low"))


def _forests(members: DataFrame, limit: int) -> DataFrame:
    """a, b: a spanning forest of the similar pairs in each bucket of ``members`` (bucket, sid, signature)."""

    def work(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sids, signatures = [], []
        for b in batches:
            sids += b.column("sid").to_pylist()
            signatures.append(b.column("signature").flatten().to_numpy().view(np.uint64).reshape(b.num_rows, -1))
        edges = forest(np.concatenate(signatures), limit)
        if edges:
            a, b = zip(*((sids[x], sids[y]) for x, y in edges))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return members.select("bucket", "sid", "signature").groupBy("bucket").applyInArrow(work, "a binary, b binary")


def candidate_clusters(sets: DataFrame, percent: int = PERCENT, bucket: int = BUCKET) -> DataFrame:
    """sid, cluster: sets that may link with others, by what holds them together. ``sets``: sid (unique), bands, signature."""
    limit = most_unequal(percent)
    judged = sets.select("sid", "signature")

    def members(rows: DataFrame, found: DataFrame) -> DataFrame:
        return attach_unique(rows, found, ["bucket"], weight="size").where("size IS NOT NULL")

    rows = sets.select("sid", F.explode("bands").alias("bucket"))
    found = _buckets(rows)
    small, large = found.where(F.col("size") <= bucket), found.where(F.col("size") > bucket)
    edges = _forests(members(rows, small).join(judged, "sid"), limit)
    if large.limit(1).count():
        inside = members(rows, large).select("sid", F.col("bucket").alias("first")).join(sets.select("sid", "bands"), "sid")
        rows = inside.select("sid", "first", F.explode("bands").alias("second")).where("first != second").select(
            "sid", F.xxhash64(F.least("first", "second"), F.greatest("first", "second")).alias("bucket")).distinct()
        rows = durable(rows)
        found = _buckets(rows)
        edges = edges.unionByName(_forests(members(rows, found.where(F.col("size") <= bucket)).join(judged, "sid"), limit))
        tied = members(rows, found.where(F.col("size") > bucket))
        edges = edges.unionByName(tied.select(F.col("low").alias("a"), F.col("sid").alias("b")))
    held = components(edges)
    return held.unionByName(held.select(F.col("label").alias("node"), "label").distinct()).select(
        F.col("node").alias("sid"), F.col("label").alias("cluster"))


def _confirmed(source: DataFrame, sets: DataFrame, words: int, percent: int, bucket: int, block_tokens: int) -> DataFrame | None:
    """node, label of all sets that confirmed links hold together; None if there are no candidates."""
    members = durable(candidate_clusters(sets, percent, bucket).join(sets.select("sid", "n", "id"), "sid"))
    if members.limit(1).count() == 0:
        return None

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = column_bytes(batch.column(0))
            for s in chunks(texts):
                built = shingle_sets(texts[s], words)
                yield pa.RecordBatch.from_arrays([pa.array([digest(k) for k in built], pa.binary()),
                                                  pa.array([k.astype("<u8").tobytes() for k in built], pa.binary())], names=["sid", "keys"])

    wanted = members.select(F.col("id").alias("wanted")).distinct()
    texts = source.join(checked(wanted, IDS_BROADCAST), F.col("id").eqNullSafe(F.col("wanted")), "left_semi").select("text")
    full = texts.mapInArrow(rebuild, "sid binary, keys binary").groupBy("sid").agg(F.first("keys").alias("keys"))
    sums = members.groupBy("cluster").agg(F.sum("n").alias("tokens"))
    return _labels(durable(members.select("sid", "n", "cluster").join(sums, "cluster").join(full, "sid")), percent, block_tokens)


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT,
                    bucket: int = BUCKET, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per row: ``id_col``, n_shingles, component_id, kept.

    Two documents link when the intersection of their sets of ``words``-word shingles has at least ``percent`` hundredths of their union;
    ``component_id`` is the smallest id that links lead to, the row's own included, and a row is ``kept`` if that is its own id. A
    text with fewer words is one shingle. NULL and wordless texts have no shingles, no links, and are kept. Rows with equal
    sets, repeated rows included, share a component; NULL ids are never the smallest unless the component has no other, and are kept
    then. No rows give no rows; other columns are not read. For ``percent`` below 80 pairs share too few bands to be found safely.
    """
    source = documents.select(F.lit(None).cast("int").alias("key"), ref(id_col).alias("id"), ref(text_col).alias("text"))
    measured = durable(_measure(source, words))
    rows = measured.select("id", "n", "sid")
    sets = durable(measured.where("n > 0").groupBy("sid").agg(
        F.max("n").alias("n"), F.min("id").alias("id"), F.count("*").alias("copies"),
        F.first("bands", True).alias("bands"), F.first("signature", True).alias("signature")))
    labels = _confirmed(source, sets, words, percent, bucket, block_tokens)
    least = sets.select("sid", "id", "copies")
    if labels is None:
        least = least.withColumn("label", F.col("sid"))
    else:
        least = attach_unique(least, labels.withColumnRenamed("node", "sid"), ["sid"]).withColumn("label", F.coalesce("label", "sid"))
    first = least.groupBy("label").agg(F.min("id").alias("component_id"), F.count("*").alias("sets"))
    named = durable(attach_unique(least, first, ["label"], weight="sets").select("sid", "component_id", "copies"))
    out = attach_unique(rows.where("n > 0"), named, ["sid"], weight="copies").select("id", "n", "component_id").unionByName(
        rows.where("n = 0").select("id", "n", F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
