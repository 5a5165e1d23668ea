"""Near duplicates by Jaccard similarity of word n-gram sets, joined in prefix trees.

Two sets can only be similar if they share one of the first tokens of a common order; with rare tokens first, few
unrelated documents do. The way to that order and on to the links:

1. One pass writes each document's set size and digest, and adds up a sketch of token counts of fixed size; tokens
   above a bound in it are *hot* and come last in the order.
2. A second pass sends every other token, sorted and Golomb-coded with its document's number within a chunk, to the owner of
   its range. Owners know which tokens several documents share, and how many, and answer the chunks with these.
   A document whose unshared tokens fill its prefix can have no partner and is out; most are.
3. The rest list their prefix tokens. Documents with a common one are candidates of one cluster.
4. Only candidates' texts are read again; their sets meet by cluster and are joined in tries. In a cluster with more than
   ``BLOCK_TOKENS`` tokens they meet by the prefix tokens they share, after one block has met all others.

Sets are compared by 64-bit hashes of their n-grams.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.functions.columns import ref
from lacuna.functions.durable import durable
from lacuna.functions.joins import attach_unique
from lacuna.llm.components import components
from lacuna.llm.exchange import MESSAGE, messages, shared_tokens
from lacuna.llm.tables import checked, slots
from lacuna.llm.text import chunks, column_bytes, mix, slices, word_hashes
from lacuna.llm.trie import Forest, similar_links

WORDS = 4
PERCENT = 85
SKETCH_BITS = 20
PIECES = 32
CHUNK_TOKENS = 600_000
CHUNK_TEXTS = 60_000
OWNER_TOKENS = 1_500_000
BLOCK_TOKENS = 500_000
IDS_BROADCAST = 500_000

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                               0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def _odd(k: int) -> np.uint64:
    return _ODD[k] if k < len(_ODD) else mix(np.array([2 * k + 1], np.uint64))[0] | np.uint64(1)


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's word n-grams, A-Z lower-cased; a shorter text is one n-gram, without words none."""
    hashes, bounds = word_hashes(texts)
    n = len(hashes)
    grams = np.zeros(max(0, n - words + 1), np.uint64)
    for k in range(words):
        grams += hashes[k:k + len(grams)] * _odd(k)
    grams = mix(grams + np.uint64(words))
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(grams[a:b - words + 1]))
        elif b > a:
            short = sum((int(h) * int(_odd(k)) for k, h in enumerate(hashes[a:b])), b - a) & (2**64 - 1)
            out.append(mix(np.array([short], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def digest(keys: np.ndarray) -> bytes:
    return hashlib.blake2b(keys.tobytes(), digest_size=16).digest()


def prefix_length(n, percent: int):
    """How many of a set's first tokens hold at least one token of any similar set."""
    return n - (percent * n + 99) // 100 + 1


def _measure(documents: DataFrame, words: int) -> DataFrame:
    """piece NULL: key, id, n and sid (digest) of each document; else a part of the sketch, in ``body``."""
    key, kind = (documents.schema[c].dataType.simpleString() for c in ("key", "id"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        names = ["piece", "key", "id", "n", "sid", "body"]
        types = None
        for batch in slices(batches):
            types = batch.schema
            texts = column_bytes(batch.column(2))
            for s in chunks(texts):
                sets = shingle_sets(texts[s], words)
                size = s.stop - s.start
                every = np.concatenate(sets) >> np.uint64(64 - SKETCH_BITS)
                counts += np.bincount(every.astype(np.int64), minlength=len(counts)).astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(size, pa.int32()), batch.column(0).slice(s.start, size), batch.column(1).slice(s.start, size),
                     pa.array([len(k) for k in sets], pa.int64()), pa.array([digest(k) for k in sets], pa.binary()),
                     pa.nulls(size, pa.binary())], names=names)
        if types is not None:
            parts = [zlib.compress(p.astype("<u4").tobytes(), 1) for p in np.split(counts, PIECES)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(PIECES), pa.int32()), pa.nulls(PIECES, types.field(0).type), pa.nulls(PIECES, types.field(1).type),
                 pa.nulls(PIECES, pa.int64()), pa.nulls(PIECES, pa.binary()), pa.array(parts, pa.binary())], names=names)

    return documents.mapInArrow(work, f"piece int, key {key}, id {kind}, n long, sid binary, body binary")


def _sketch(parts: DataFrame) -> np.ndarray:
    """Token counts by the leading bits of their hashes; 2 ** SKETCH_BITS numbers, whatever the corpus."""

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1 << SKETCH_BITS) // PIECES, np.int64)
        for b in batches:
            for body in b.column("body").to_pylist():
                total += np.frombuffer(zlib.decompress(body), "<u4")
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                         names=["piece", "body"])

    found = parts.where("piece IS NOT NULL").select("piece", "body").groupBy("piece").applyInArrow(add, "piece int, body binary")
    return np.concatenate([np.frombuffer(r.body, np.int64) for r in sorted(found.collect(), key=lambda r: r.piece)])


def _send(documents: DataFrame, words: int, percent: int, level: np.ndarray, owners: int, bits: int) -> DataFrame:
    """Messages to the owners (chunk, base, tokens, places), and each chunk's own list of documents (tokens NULL).

    ``level`` is zero for ordinary tokens and rises with the count of hot ones. Chunks list, for documents that have too few
    ordinary tokens to fill their prefix, the first hot ones. Copies within a task are left out.
    """
    cut = np.uint64(64 - bits)

    def flush(chunk: int, held: list[tuple[bytes, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        sizes = np.array([len(k) for _, k in held], np.int64)
        keys = np.concatenate([k for _, k in held])
        doc = np.repeat(np.arange(len(held)), sizes)
        heat = level[(keys >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
        hot = heat > 0
        ordinary = np.bincount(doc[~hot], minlength=len(held))
        need = np.maximum(0, prefix_length(sizes, percent) - ordinary)
        hot_doc, hot_key, hot_heat = doc[hot], keys[hot], heat[hot]
        order = np.lexsort((hot_key, hot_heat, hot_doc))
        hot_doc, hot_key = hot_doc[order], hot_key[order]
        start = np.searchsorted(hot_doc, np.arange(len(held)))
        wanted = np.arange(len(hot_doc)) - start[hot_doc] < need[hot_doc]
        listed = b"".join(sid for sid, _ in held)
        own = b"".join([len(held).to_bytes(4, "little"), listed, sizes.astype("<i4").tobytes(), ordinary.astype("<i4").tobytes(),
                        (hot_key[wanted] >> cut).astype("<u8").tobytes(), hot_doc[wanted].astype("<u2").tobytes()])
        yield messages(chunk, owners, own, keys[~hot], doc[~hot], bits)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 24
        held: list[tuple[bytes, np.ndarray]] = []
        seen: set[bytes] = set()
        tokens = 0
        for batch in slices(batches):
            texts = column_bytes(batch.column(2))
            for s in chunks(texts):
                for keys in shingle_sets(texts[s], words):
                    sid = digest(keys)
                    if len(keys) and sid not in seen:
                        seen.add(sid)
                        held.append((sid, keys))
                        tokens += len(keys)
                if tokens >= CHUNK_TOKENS or len(held) >= CHUNK_TEXTS // 2:
                    for k in range(0, len(held), CHUNK_TEXTS):
                        yield from flush(chunk, held[k:k + CHUNK_TEXTS])
                        chunk += 1
                    held, tokens = [], 0
        for k in range(0, len(held), CHUNK_TEXTS):
            yield from flush(chunk, held[k:k + CHUNK_TEXTS])
            chunk += 1

    return documents.mapInArrow(work, MESSAGE)


def _prefixes(answers: DataFrame, percent: int) -> DataFrame:
    """token, sid, n: the prefix tokens of every document whose unshared tokens do not fill its prefix."""

    def work(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, docs, counts, header = [], [], [], b""
        for b in batches:
            for shared, body in zip(b.column("shared").to_pylist(), b.column("body").to_pylist()):
                if shared is None:
                    header = body
                else:
                    tokens.append(np.frombuffer(body, "<u8", shared))
                    docs.append(np.frombuffer(body, "<u2", shared, 8 * shared))
                    counts.append(np.frombuffer(body, "<u2", shared, 10 * shared))
        n = int.from_bytes(header[:4], "little")
        at = 4 + 16 * n
        sizes, ordinary = np.frombuffer(header, "<i4", 2 * n, at).reshape(2, n).astype(np.int64)
        at += 8 * n
        hots = (len(header) - at) // 10
        hot, hot_doc = np.frombuffer(header, "<u8", hots, at), np.frombuffer(header, "<u2", hots, at + 8 * hots).astype(np.int64)
        if tokens:
            token, doc, count = np.concatenate(tokens), np.concatenate(docs).astype(np.int64), np.concatenate(counts)
            order = np.lexsort((token, count, doc))
            token, doc = token[order], doc[order]
        else:
            token, doc = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        alone = ordinary - np.bincount(doc, minlength=n)
        need = np.maximum(0, prefix_length(sizes, percent) - alone)
        wanted = np.arange(len(doc)) - np.searchsorted(doc, np.arange(n))[doc] < need[doc]
        token, doc = np.concatenate((token[wanted], hot)), np.concatenate((doc[wanted], hot_doc))
        if len(doc):
            sids = [header[4 + 16 * d:20 + 16 * d] for d in doc.tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(token.view(np.int64), pa.int64()), pa.array(sids, pa.binary()), pa.array(sizes[doc], pa.int64())],
                names=["token", "sid", "n"])

    return answers.groupBy("chunk").applyInArrow(work, "token long, sid binary, n long")


def _join_sets(rows: DataFrame, percent: int) -> DataFrame:
    """Links from the smallest set (a) of similar ones to the others (b), in each group (cluster, x, y) of sets (sid, keys)."""

    def work(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[bytes, np.ndarray] = {}
        for b in batches:
            for sid, keys in zip(b.column("sid").to_pylist(), b.column("keys").to_pylist()):
                if sid not in sets:
                    sets[sid] = np.frombuffer(keys, "<u8")
        names = sorted(sets)
        forest = Forest(len(names))
        for a, b in similar_links([sets[s] for s in names], percent):
            forest.union(a, b)
        joined = [(names[r], names[k]) for k in range(len(names)) if (r := forest.find(k)) != k]
        if joined:
            a, b = zip(*joined)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return rows.select("cluster", "x", "y", "sid", "keys").groupBy("cluster", "x", "y").applyInArrow(work, "a binary, b binary")


def _labels(clustered: DataFrame, percent: int, block_tokens: int, prefixes: DataFrame | None = None) -> DataFrame:
    """node, label of the sets that similar ones hold together. ``clustered``: cluster, tokens (its total), sid, n, keys; written, since it is read again.

    A large cluster's sets are dealt into blocks, and block 0 meets every block, which joins what is similar to many. Then sets meet by
    the tokens of ``prefixes`` (token, sid), of which similar sets have one in common; without it, by cluster. Of
    tokens with the same sets one counts, and one whose sets are joined already needs no comparison. If a token's sets are too many for
    one task, those outside the heaviest joined group meet all of them in blocks.
    """
    none = F.lit(0)
    small = _join_sets(clustered.where(F.col("tokens") <= block_tokens).select("cluster", none.alias("x"), none.alias("y"), "sid", "keys"),
                       percent)
    large = clustered.where(F.col("tokens") > block_tokens).withColumn("blocks", F.ceil(F.col("tokens") / (block_tokens / 2)).cast("int"))
    if large.limit(1).count() == 0:  # every group was whole in one task
        return durable(small.select(F.col("b").alias("node"), F.col("a").alias("label")))
    block = F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int")
    to_all = F.when(block == 0, F.sequence(none, F.col("blocks") - 1)).otherwise(F.array(block))
    near = durable(_join_sets(large.select("cluster", none.alias("x"), F.explode(to_all).alias("y"), "sid", "keys"), percent))
    labels = components(near)
    marked = large.select("cluster", "sid", "n").join(labels.withColumnRenamed("node", "sid"), "sid", "left").withColumn(
        "label", F.coalesce("label", "sid"))
    if prefixes is not None:
        marked = prefixes.select(F.col("token").alias("cluster"), "sid").distinct().join(marked.drop("cluster"), "sid")
    met = _meetings(durable(marked), block_tokens).join(large.select("sid", "keys"), "sid")
    return components(small.unionByName(near).unionByName(_join_sets(met, percent)))


def _meetings(marked: DataFrame, block_tokens: int) -> DataFrame:
    """cluster, x, y, sid: groups of bounded size in which all sets of one cluster meet that have different labels.

    ``marked``: cluster, sid, n, label, each pair of cluster and set once. A cluster's sets outside its heaviest label are dealt into few blocks
    (x), each of which meets every block (y) of the cluster.
    """
    named = marked.groupBy("cluster", "label").agg(
        F.sum("n").alias("n"), F.count("*").alias("sets"), F.min("sid").alias("low"), F.max("sid").alias("high"),
        F.expr("bit_xor(xxhash64(sid))").alias("print"))
    whole = named.groupBy("cluster").agg(
        F.sum("n").alias("total"), F.sum("sets").alias("sets"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.expr("bit_xor(print)").alias("print"), F.count("*").alias("labels"), F.max("n").alias("heaviest"),
        F.max_by("label", F.struct("n", "label")).alias("main")).where("labels > 1")
    one = durable(whole.groupBy("sets", "low", "high", "print").agg(
        F.min("cluster").alias("cluster"), F.first("total").alias("total"), F.first("heaviest").alias("heaviest"), F.first("main").alias("main")))
    half = block_tokens / 2
    fits = F.col("total") <= block_tokens
    one = one.select("cluster", "sets", "main", F.when(fits, 1).otherwise(F.ceil(F.col("total") / half)).cast("int").alias("blocks"),
                     F.when(fits, 1).otherwise(F.ceil((F.col("total") - F.col("heaviest")) / half)).cast("int").alias("outs"))
    rows = attach_unique(marked, one, ["cluster"], weight="sets").where("main IS NOT NULL")
    block, out = (F.pmod(F.xxhash64("sid", F.lit(salt)), F.col(n)).cast("int") for salt, n in ((2, "blocks"), (1, "outs")))
    as_any = F.transform(F.sequence(F.lit(0), F.col("outs") - 1), lambda x: F.struct(x.alias("x"), F.col("block").alias("y")))
    as_out = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda y: F.struct(F.col("out").alias("x"), y.alias("y")))
    places = F.when(F.col("label") == F.col("main"), as_any).otherwise(F.array_union(as_any, as_out))
    return (rows.withColumns({"block": block, "out": out}).select("cluster", "sid", F.explode(places).alias("place"))
            .select("cluster", "place.x", "place.y", "sid"))


def ngram_components(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT,
                     block_tokens: int = BLOCK_TOKENS, key_col: str | None = None) -> DataFrame:
    """One row per row: ``id_col``, n_shingles, component_id; with a unique row key ``key_col`` also that and kept.

    Two documents link when their shingle sets' intersection has at least ``percent`` hundredths of their union;
    ``component_id`` is the smallest id that links lead to, the row's own included. NULL and wordless texts have no
    shingles and no links. Rows with equal sets, repeated rows included, share a component; NULL ids are never the smallest
    unless the component has no other. Of each component the row of the smallest id, then key, is ``kept``; rows without shingles
    are. An empty table gives an empty result; other columns are not read.
    """
    spark = documents.sparkSession
    key = F.lit(None).cast("long") if key_col is None else ref(key_col)
    source = documents.select(key.alias("key"), ref(id_col).alias("id"), ref(text_col).alias("text"))
    measured = durable(_measure(source, words))
    meta = measured.where("piece IS NULL").select("key", "id", "n", "sid")
    total = meta.agg(F.sum("n")).first()[0]
    if not total:
        labels = None
    else:
        labels = _cluster(spark, source, measured, meta, total, words, percent, block_tokens)
    grouped = meta.where("n > 0")
    grouped = grouped.withColumn("g", F.col("sid")) if labels is None else attach_unique(
        grouped, labels.withColumnRenamed("node", "sid"), ["sid"], weight="copies").drop("copies").withColumn("g", F.coalesce("label", "sid"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key"))
    least = durable(grouped.groupBy("g").agg(first.alias("first"), F.count("*").alias("size")).select(
        "g", "size", F.col("first.id").alias("component_id"), F.col("first.key").alias("keep")))
    names = ["key", "id", "n", "component_id", "keep"]
    named = attach_unique(grouped, least, ["g"], weight="size").select(names).unionByName(
        meta.where("n = 0").withColumns({"component_id": F.col("id"), "keep": F.col("key")}).select(names))
    kept = [F.col("key").alias(key_col), F.col("key").eqNullSafe(F.col("keep")).alias("kept")] if key_col else []
    return named.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", *kept)


def _cluster(spark, source: DataFrame, measured: DataFrame, meta: DataFrame, total: int, words: int, percent: int,
             block_tokens: int) -> DataFrame | None:
    """node, label, copies (rows) of all sets that similar sets hold together; None if there are no candidates."""
    counts = _sketch(measured)
    hot = 4 * total / len(counts) + 1000
    level = np.where(counts > hot, np.ceil(4 * np.log2(np.maximum(counts, 1))), 0).astype(np.uint8)
    owners = max(slots(spark), -(-total // OWNER_TOKENS))
    bits = min(63, max(40 if total < 1 << 28 else 0, int(total).bit_length() + 10))
    prefixes = durable(_prefixes(shared_tokens(_send(source, words, percent, level, owners, bits)), percent))
    hubs = prefixes.groupBy("token").agg(F.min("sid").alias("hub"), F.max("sid").alias("other"), F.count("*").alias("times"))
    hubs = durable(hubs.where("hub != other").select("token", "hub", "times"))
    edges = attach_unique(prefixes.select("token", "sid"), hubs, ["token"], weight="times").where("hub IS NOT NULL AND sid != hub")
    clusters = components(edges.select(F.col("sid").alias("a"), F.col("hub").alias("b")))
    members = durable(clusters.unionByName(clusters.select(F.col("label").alias("node"), "label").distinct())
                      .join(meta.where("n > 0").groupBy("sid").agg(F.max("n").alias("n"), F.min("id").alias("id"), F.count("*").alias("copies")),
                            F.col("node") == F.col("sid")).select("sid", "n", "id", "copies", F.col("label").alias("cluster")))
    if members.limit(1).count() == 0:
        return None
    wanted = members.select(F.col("id").alias("wanted")).distinct()

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = column_bytes(batch.column(0))
            for s in chunks(texts):
                sets = shingle_sets(texts[s], words)
                yield pa.RecordBatch.from_arrays([pa.array([digest(k) for k in sets], pa.binary()),
                                                  pa.array([k.astype("<u8").tobytes() for k in sets], pa.binary())], names=["sid", "keys"])

    texts = source.join(checked(wanted, IDS_BROADCAST), F.col("id").eqNullSafe(F.col("wanted")), "left_semi").select("text")
    # Rows with one text, or with NULL and repeated ids, give one set each task.
    sets = texts.mapInArrow(rebuild, "sid binary, keys binary").groupBy("sid").agg(F.first("keys").alias("keys"))
    sums = members.groupBy("cluster").agg(F.sum("n").alias("tokens"))
    clustered = durable(members.select("sid", "n", "cluster").join(sums, "cluster").join(sets, "sid"))
    labels = _labels(clustered, percent, block_tokens, prefixes)
    return durable(labels.join(members.select(F.col("sid").alias("node"), "copies"), "node"))
