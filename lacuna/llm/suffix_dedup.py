"""Removing repeated byte strings, by suffix order built column by column.

Inserting one symbol of every document per round into a Burrows-Wheeler transform takes as many rounds as the longest
document has bytes, each a pass over all data. Here the text is first cut so that the rounds are few and independent:

1. Every window of ``LENGTH`` bytes has an anchor, the least hash of its ``GRAM``-byte substrings (leftmost if tied). Equal
   windows have equal anchors at equal places. Consecutive windows with one anchor are a *run*.
2. Chunks of documents tell owners their anchors (sorted, Golomb-coded), and learn which occur more than once. Only runs
   with such an anchor can hold a repeated window; equal runs are one, with a count.
3. Runs meet by anchor, aligned at it. From the last column to the first, one symbol of each run is inserted: a stable
   sort of the present order by the new symbol gives the order of the longer suffixes (the symbols in that order are
   the column's part of the collection's transform), and the common prefixes of neighbours follow from the former ones by
   range minima. Each round reads and writes the order, the prefixes and one column, in sequence. Where a neighbour's
   common prefix reaches ``LENGTH``, the window that starts in this column occurs elsewhere.
4. Repeated windows go back to their documents, whose covered bytes are removed.

An anchor with more than ``HOT_RUNS`` different runs is split by salt; what is not found repeated within a salt is
compared across salts by the digests of single windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.functions.columns import ref
from lacuna.functions.durable import durable
from lacuna.functions.joins import attach_unique
from lacuna.llm.exchange import MESSAGE, messages, shared_tokens
from lacuna.llm.tables import checked, slots
from lacuna.llm.text import column_bytes, mix, slices

LENGTH = 200
GRAM = 64
SEGMENT = 1 << 17  # bytes that are hashed together: the arrays stay in the processor's cache
CHUNK_ANCHORS = 300_000
CHUNK_TEXTS = 60_000
OWNER_ANCHORS = 2_000_000
RUNS_PER_GROUP = 20_000
HOT_RUNS = 20_000
RUNS_HELD = 100_000  # different runs that a task combines before it passes them on
TEXTS_BROADCAST = 250_000
TEXT_BYTES_PER_GROUP = 32 << 20

_PLACE_BITS = np.uint64(22)
_PRIME = 0x9E3779B97F4A7C15 | 1
_BYTES = mix(np.arange(1, 257, dtype=np.uint64))


class Roller:
    """Hashes of all substrings of one length, from prefix sums; powers are kept for the longest segment so far."""

    def __init__(self, gram: int) -> None:
        self.gram, self.inverse = gram, pow(_PRIME, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            steps = np.full(size, _PRIME, np.uint64)
            steps[0] = 1
            self.up = np.cumprod(steps, dtype=np.uint64)
            steps[1:] = self.inverse
            self.down = np.cumprod(steps, dtype=np.uint64)

    def hashes(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        self.grow(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTES[data] * self.up[:n], out=sums[1:])
        return mix((sums[self.gram:] - sums[:-self.gram]) * self.down[:n - self.gram + 1])


def runs_of(texts: list[bytes], roller: Roller, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per slice of texts: document number, first window, number of windows, anchor's place and anchor's hash of each run.

    Places are byte offsets in the document. A document longer than a segment is taken in overlapping parts.
    """
    gram = roller.gram
    parts: list[tuple[int, int, bytes]] = []  # document, offset, bytes
    size = 0

    def flush() -> Iterator[tuple[np.ndarray, ...]]:
        if not parts:
            return
        data = np.frombuffer(b"".join(p for _, _, p in parts), np.uint8)
        if len(data) < length:
            return
        hashed = roller.hashes(data)
        mask = (np.uint64(1) << _PLACE_BITS) - np.uint64(1)
        best = (hashed & ~mask) | np.arange(len(hashed), dtype=np.uint64)
        width, span = 1, length - gram + 1
        while 2 * width <= span:
            best = np.minimum(best[:-width], best[width:])
            width *= 2
        if span > width:
            best = np.minimum(best[:width - span], best[span - width:])
        anchor = (best & mask).astype(np.int64)
        # A run ends where the anchor changes, and at the last window inside its part.
        starts = np.cumsum([0] + [len(p) for _, _, p in parts])
        ends = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
        first = np.unique(np.concatenate((ends, starts[:-1])))
        first = first[first < len(anchor)]
        number = np.searchsorted(starts, first, "right") - 1
        stop = np.minimum(np.append(first[1:], len(anchor)), starts[number + 1] - length + 1)
        whole = stop > first
        first, stop, number = first[whole], stop[whole], number[whole]
        anchor = anchor[first]
        doc = np.array([d for d, _, _ in parts], np.int64)[number]
        shift = np.array([o for _, o, _ in parts], np.int64)[number] - starts[number]
        yield doc, first + shift, stop - first, anchor + shift, hashed[anchor]

    for d, text in enumerate(texts):
        if len(text) < length:
            continue
        for at in range(0, max(1, len(text) - length + 1), SEGMENT):
            part = text[at:at + SEGMENT + length - 1]
            if size + len(part) > 2 * SEGMENT:
                yield from flush()
                parts, size = [], 0
            parts.append((d, at, part))
            size += len(part)
    yield from flush()


def column_order(rows: list[bytes], columns: np.ndarray, width: int, length: int, firsts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each row and column, whether the ``length`` bytes from there also start, in that column, in another row.

    ``rows`` are byte strings that begin in ``columns``; only windows from ``firsts`` on, ``counts`` of them, are asked for.
    """
    m = len(rows)
    symbols = np.full((width, m), 256, np.uint16)
    for k, (row, c) in enumerate(zip(rows, columns.tolist())):
        symbols[c:c + len(row), k] = np.frombuffer(row, np.uint8)
    found = np.zeros((m, width), bool)
    order = np.arange(m)
    common = np.zeros(m, np.int32)  # with the one before, in the present order
    position = np.empty(m, np.int64)
    for c in range(width - 1, -1, -1):
        inserted = symbols[c][order]
        by = np.argsort(inserted, kind="stable")  # a counting sort for 16-bit keys
        sorted_symbols = inserted[by]
        same = np.flatnonzero((sorted_symbols[1:] == sorted_symbols[:-1]) & (sorted_symbols[1:] < 256)) + 1
        longer = np.zeros(m, np.int32)
        if len(same):
            spans = np.empty(2 * len(same), np.int64)
            spans[0::2], spans[1::2] = by[same - 1] + 1, by[same] + 1
            least = np.minimum.reduceat(np.append(common, 0), spans)
            longer[same] = least[0::2] + 1
        order, common = order[by], longer
        asked = (firsts <= c) & (c < firsts + counts)
        if asked.any():
            long = common >= length
            long[:-1] |= long[1:]
            position[order] = np.arange(m)
            found[:, c] = asked & long[position]
    return found


def _anchors(documents: DataFrame, length: int, gram: int, owners: int, bits: int) -> DataFrame:
    """Messages of the anchors. A chunk names an anchor once; those that it holds twice are in its note, with documents."""

    def flush(chunk: int, shas: list[bytes], keys: list[np.ndarray], docs: list[np.ndarray]) -> pa.RecordBatch:
        key = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        doc = np.concatenate(docs) if docs else np.zeros(0, np.int64)
        order = np.argsort(key, kind="stable")
        key, doc = key[order], doc[order]
        first = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.zeros(0, bool)
        times = np.diff(np.append(np.flatnonzero(first), len(key)))
        twice = np.repeat(times > 1, times)
        note = b"".join([len(shas).to_bytes(4, "little"), *shas, (key[twice] >> np.uint64(64 - bits)).astype("<u8").tobytes(),
                         doc[twice].astype("<u2").tobytes()])
        return messages(chunk, owners, note, key[first], np.where(twice[first], 65535, doc[first]), bits)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller(gram)
        chunk = TaskContext.get().partitionId() << 24
        shas: list[bytes] = []
        keys: list[np.ndarray] = []
        docs: list[np.ndarray] = []
        seen: set[bytes] = set()
        held = 0
        for batch in slices(batches):
            fresh = []
            for sha, text in zip(batch.column(0).to_pylist(), column_bytes(batch.column(1))):
                if len(text) >= length and sha not in seen:
                    seen.add(sha)
                    fresh.append((sha, text))
            for at in range(0, len(fresh), 1000):
                part = fresh[at:at + 1000]
                for doc, _, _, _, hashed in runs_of([t for _, t in part], roller, length):
                    keys.append(hashed)
                    docs.append(doc + len(shas))
                    held += len(hashed)
                shas += [s for s, _ in part]
                if held >= CHUNK_ANCHORS or len(shas) > CHUNK_TEXTS:
                    yield flush(chunk, shas, keys, docs)
                    chunk += 1
                    shas, keys, docs, held = [], [], [], 0
        if shas:
            yield flush(chunk, shas, keys, docs)

    return documents.mapInArrow(work, MESSAGE)


def _suspects(answers: DataFrame) -> DataFrame:
    """sha and the sorted anchors (8 bytes each) that the text shares."""

    def work(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, docs, shas = [], [], []
        for b in batches:
            for shared, body in zip(b.column("shared").to_pylist(), b.column("body").to_pylist()):
                if shared is None:
                    n = int.from_bytes(body[:4], "little")
                    at = 4 + 32 * n
                    shas = [body[4 + 32 * k:36 + 32 * k] for k in range(n)]
                    twice = (len(body) - at) // 10
                    tokens.append(np.frombuffer(body, "<u8", twice, at))
                    docs.append(np.frombuffer(body, "<u2", twice, at + 8 * twice))
                else:
                    tokens.append(np.frombuffer(body, "<u8", shared))
                    docs.append(np.frombuffer(body, "<u2", shared, 8 * shared))
        token, doc = np.concatenate(tokens), np.concatenate(docs).astype(np.int64)
        named = doc < 65535
        token, doc = token[named], doc[named]
        order = np.lexsort((token, doc))
        token, doc = token[order], doc[order]
        bounds = np.searchsorted(doc, np.arange(len(shas) + 1)).tolist()
        found = [(s, token[a:b].astype("<u8").tobytes()) for s, a, b in zip(shas, bounds, bounds[1:]) if b > a]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in found], pa.binary()), pa.array([t for _, t in found], pa.binary())],
                                             names=["sha", "anchors"])

    return answers.groupBy("chunk").applyInArrow(work, "sha binary, anchors binary")


def _first_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose first column has not been seen in this task."""
    seen: set[bytes] = set()
    for batch in batches:
        keep = []
        for k, sha in enumerate(batch.column(0).to_pylist()):
            if sha not in seen:
                seen.add(sha)
                keep.append(k)
        yield batch if len(keep) == batch.num_rows else batch.take(pa.array(keep, pa.int64()))


def _part(groups: int):
    return F.pmod(F.xxhash64("sha"), F.lit(groups)).alias("part")


def _with_anchors(found: DataFrame, suspects: DataFrame, groups: int) -> DataFrame:
    """sha, text, anchors: each text once, however many tasks have read it."""

    def attach(left: pa.Table, right: pa.Table) -> pa.Table:
        anchors = dict(zip(right.column("sha").to_pylist(), right.column("anchors").to_pylist()))
        keep, with_ = [], []
        for k, sha in enumerate(left.column("sha").to_pylist()):
            if (mine := anchors.pop(sha, None)) is not None:
                keep.append(k)
                with_.append(mine)
        return left.select(["sha", "text"]).take(pa.array(keep, pa.int64())).append_column("anchors", pa.array(with_, pa.binary()))

    return found.select(_part(groups), "sha", "text").groupBy("part").cogroup(
        suspects.select(_part(groups), "sha", "anchors").groupBy("part")).applyInArrow(attach, "sha binary, text string, anchors binary")


def _suspect_runs(texts: DataFrame, length: int, gram: int, bits: int) -> DataFrame:
    """Runs with a shared anchor, each once per text (sha, first, run), and once per task with its bytes (sha NULL)."""

    def told(seen: dict[tuple[int, bytes], list]) -> pa.RecordBatch:
        n = len(seen)
        return pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64()), pa.array([r for _, r in seen], pa.binary()),
             pa.array([t for t, _ in seen], pa.int64()), pa.array([v[0] for v in seen.values()], pa.int32()),
             pa.array([v[1] for v in seen.values()], pa.binary()), pa.array([v[2] for v in seen.values()], pa.int64())], names=names)

    names = ["sha", "first", "run", "anchor", "lead", "body", "times"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller(gram)
        seen: dict[tuple[int, bytes], list] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                bodies, shas = column_bytes(batch.column(1)), batch.column(0).to_pylist()
                wanted = [np.frombuffer(a, "<u8") for a in batch.column(2).to_pylist()]
                places: list[tuple[bytes, int, bytes]] = []
                for doc, first, count, anchor, hashed in runs_of(bodies, roller, length):
                    token = hashed >> np.uint64(64 - bits)
                    kept = []
                    for d in np.unique(doc).tolist():
                        a, b = np.searchsorted(doc, [d, d + 1]).tolist()
                        kept.append(a + np.flatnonzero(np.isin(token[a:b], wanted[d])))
                    kept = np.concatenate(kept) if kept else np.zeros(0, np.int64)
                    for d, f, n, lead, t in zip(*(x[kept].tolist() for x in (doc, first, count, anchor - first, token))):
                        body = bodies[d][f:f + n + length - 1]
                        run = hashlib.blake2b(lead.to_bytes(2, "little") + body, digest_size=16).digest()
                        seen.setdefault((t, run), [lead, body, 0])[2] += 1
                        places.append((shas[d], f, run))
                if len(seen) >= RUNS_HELD:
                    yield told(seen)
                    seen = {}
                if places:
                    n = len(places)
                    sha, first_, run_ = zip(*places)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(sha, pa.binary()), pa.array(first_, pa.int64()), pa.array(run_, pa.binary()), pa.nulls(n, pa.int64()),
                         pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64())], names=names)
        if seen:
            yield told(seen)

    return texts.mapInArrow(work, "sha binary, first long, run binary, anchor long, lead int, body binary, times long")


def _repeated(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """run, windows: bits of the run's windows that occur more than once; and single windows to compare across salts.

    ``rows`` have a group (part, salt) and the runs in it; salt -1 means that the anchor is in this group alone.
    """
    before = length - gram
    width = 2 * before + gram

    def work(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        for b in batches:
            for run, lead, body, times in zip(*(b.column(c).to_pylist() for c in ("run", "lead", "body", "times"))):
                if run in held:
                    held[run][2] += times
                else:
                    held[run] = [lead, body, times]
        runs = list(held)
        # Runs that share an anchor with none but themselves need no order; they repeat if they occur twice.
        leads = np.array([held[r][0] for r in runs], np.int64)
        counts = np.array([len(held[r][1]) - length + 1 for r in runs], np.int64)
        times = np.array([held[r][2] for r in runs], np.int64)
        columns = before - leads
        found = column_order([held[r][1] for r in runs], columns, width, length, columns, counts)
        found |= (times > 1)[:, None]
        names, bits, digests, places = [], [], [], []
        split = key[1].as_py() >= 0
        told: set[bytes] = set()
        for k, run in enumerate(runs):
            c, n = int(columns[k]), int(counts[k])
            mine = found[k, c:c + n]
            if mine.any():
                names.append(run)
                bits.append(np.packbits(mine).tobytes())
                digests.append(None)
                places.append(-1)
            if split:
                for j in range(n):
                    window = hashlib.blake2b(held[run][1][j:j + length], digest_size=16).digest()
                    if not mine[j] or window not in told:
                        told.add(window)
                        names.append(run)
                        bits.append(None)
                        digests.append(window)
                        places.append(-2 - j if mine[j] else j)
        if names:
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(bits, pa.binary()), pa.array(digests, pa.binary()),
                                              pa.array(places, pa.int32())], names=["run", "windows", "digest", "place"])

    return rows.groupBy("part", "salt").applyInArrow(work, "run binary, windows binary, digest binary, place int")


def _remove(texts: DataFrame, marks: DataFrame, length: int, groups: int) -> DataFrame:
    """sha, n_removed, spans (removed bytes, as start and end) and kept_sha256 of each text with repeated windows."""
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    types = [pa.binary(), pa.int64(), pa.list_(span), pa.string()]

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        shas, bodies = left.column("sha").to_pylist(), column_bytes(left.column("text").combine_chunks())
        at = {s: k for k, s in enumerate(shas)}
        text = np.array([at[s] for s in right.column("sha").to_pylist()], np.int64)
        order = np.argsort(text, kind="stable")
        bounds = np.searchsorted(text[order], np.arange(len(shas) + 1)).tolist()
        first, place = (right.column(c).to_numpy()[order] for c in ("first", "place"))
        windows = right.column("windows").to_pylist()
        for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
            if a == b:
                continue
            body = np.frombuffer(bodies[k], np.uint8)
            sets = [windows[j] for j in order[a:b].tolist()]
            many = np.array([w is not None for w in sets])
            sizes = np.array([len(w) * 8 for w in sets if w is not None], np.int64)
            base = np.repeat(first[a:b][many] - (np.cumsum(sizes) - sizes), sizes)
            hit = np.flatnonzero(np.unpackbits(np.frombuffer(b"".join(w for w in sets if w is not None), np.uint8)))
            starts = np.concatenate((base[hit] + hit, (first + place)[a:b][~many]))
            edges = np.bincount(starts, minlength=len(body) + 1) - np.bincount(starts + length, minlength=len(body) + 1)
            gone = np.cumsum(edges[:-1]) > 0
            ends = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0])))).reshape(-1, 2).tolist()
            out.append((shas[k], int(gone.sum()), [{"start": x, "end": y} for x, y in ends], hashlib.sha256(body[~gone].tobytes()).hexdigest()))
        columns = zip(*out) if out else [[]] * 4
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["sha", "n_removed", "spans", "kept_sha256"])

    return texts.select(_part(groups), "sha", "text").groupBy("part").cogroup(marks.select(_part(groups), "*").groupBy("part")).applyInArrow(
        cut, "sha binary, n_removed long, spans array<struct<start: long, end: long>>, kept_sha256 string")


def drop_repeats(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                 hot_runs: int = HOT_RUNS, runs_per_group: int = RUNS_PER_GROUP) -> DataFrame:
    """One row per row: ``id_col``, n_bytes, n_removed, n_spans, kept_sha256 and spans.

    Every byte covered by a string of ``length`` bytes that also starts elsewhere, in this or another row, is removed;
    overlaps count, matches do not cross rows, and all are judged on the texts as given (UTF-8, NULL as empty). ``spans``
    are the removed runs of bytes (array of start and end). Texts shorter than ``length`` stay. Equal texts and repeated
    rows lose all their bytes if they are long enough. An empty table gives an empty result; other columns are not read.
    """
    spark = documents.sparkSession
    text = F.coalesce(ref(text_col), F.lit(""))
    source = documents.select(F.unhex(F.sha2(text, 256)).alias("sha"), text.alias("text"))
    meta = durable(documents.select(ref(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"),
                                    F.unhex(F.sha2(text, 256)).alias("sha")))
    total = meta.agg(F.sum("n_bytes")).first()[0] or 0
    anchors = 2 * total // (length - gram + 1)
    owners = max(slots(spark), -(-anchors // OWNER_ANCHORS))
    bits = min(62, max(42, int(anchors).bit_length() + 16))
    suspects = _suspects(shared_tokens(_anchors(source, length, gram, owners, bits)))
    # A text that several tasks read has the same list from each: all its anchors that occur more than once.
    suspects = durable(suspects.groupBy("sha").agg(F.min("anchors").alias("anchors")))
    # Only digests are broadcast; the anchors meet the texts that are left.
    wanted = suspects.select(F.col("sha").alias("wanted"))
    found = source.mapInArrow(_first_copies, source.schema).join(checked(wanted, TEXTS_BROADCAST), F.col("sha") == F.col("wanted"), "left_semi")
    parts = max(slots(spark), -(-total // TEXT_BYTES_PER_GROUP))
    texts = durable(_with_anchors(found, suspects, parts))
    runs = durable(_suspect_runs(texts, length, gram, bits))
    places, pieces = runs.where("sha IS NOT NULL").select("sha", "first", "run"), runs.where("sha IS NULL")
    n_runs = places.count()
    groups = max(slots(spark), -(-n_runs // runs_per_group))
    if n_runs == 0:
        return _finish(meta, None, id_col, length)
    # Anchors with very many different runs are split; how many each task holds bounds the number from above.
    hot = pieces.groupBy("anchor").agg(F.count("*").alias("runs")).where(F.col("runs") > hot_runs)
    hot = hot.withColumn("salts", F.ceil(F.col("runs") / (hot_runs / 2)).cast("int"))
    dealt = attach_unique(pieces, durable(hot.select("anchor", "runs", "salts")), ["anchor"], weight="runs").select(
        F.when(F.col("salts").isNull(), F.pmod(F.xxhash64("anchor"), F.lit(groups))).otherwise(F.col("anchor")).alias("part"),
        F.when(F.col("salts").isNull(), -1).otherwise(F.pmod(F.xxhash64("run"), F.col("salts"))).cast("int").alias("salt"),
        "run", "lead", "body", "times")
    seen = durable(_repeated(dealt, length, gram))
    single = seen.where("digest IS NOT NULL")
    again = single.groupBy("digest").agg(F.count("*").alias("times")).where("times > 1").select("digest", "times")
    across = attach_unique(single.where("place >= 0"), durable(again), ["digest"], weight="times").where("times IS NOT NULL")
    marks = seen.where("windows IS NOT NULL").select("run", "windows", "place").unionByName(across.select("run", "windows", "place"))
    marks = marks.groupBy("run").agg(F.collect_list(F.struct("windows", "place")).alias("marks"))
    uses = places.groupBy("run").agg(F.count("*").alias("uses"))
    marks = durable(marks.join(uses, "run"))
    placed = attach_unique(places, marks, ["run"], weight="uses").where("marks IS NOT NULL").select(
        "sha", "first", F.explode("marks").alias("mark")).select("sha", "first", "mark.windows", "mark.place")
    return _finish(meta, _remove(texts, placed, length, parts), id_col, length)


def _finish(meta: DataFrame, removed: DataFrame | None, id_col: str, length: int) -> DataFrame:
    """Results of texts, given to every row that has the text; texts that several rows have go whole."""
    copies = meta.groupBy("sha").agg(F.count("*").alias("copies"), F.first("n_bytes").alias("size"))
    if removed is None:
        removed = meta.sparkSession.createDataFrame([], "sha binary, n_removed long, spans array<struct<start: long, end: long>>, kept_sha256 string")
    known = removed.join(copies, "sha", "full")
    whole = (F.col("copies") > 1) & (F.col("size") >= length)
    known = durable(known.where(whole | F.col("n_removed").isNotNull()).select(
        "sha", "copies", whole.alias("whole"), "n_removed", "spans", "kept_sha256"))
    rows = attach_unique(meta, known, ["sha"], weight="copies")
    n = F.when(F.col("whole"), F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long")
    all_of_it = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    none = F.expr("cast(array() as array<struct<start: bigint, end: bigint>>)")
    spans = F.when(F.col("whole"), all_of_it).otherwise(F.coalesce("spans", none))
    kept = F.when(F.col("whole"), F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("sha"))))
    return rows.select(F.col("id").alias(id_col), "n_bytes", n.alias("n_removed"), F.size(spans).cast("long").alias("n_spans"),
                       kept.alias("kept_sha256"), spans.alias("spans"))
