"""How the sources of a language differ from each other and from the language, term by term.

Only terms in several documents count, and most different terms of a corpus are not among them. They are found by prefix refinement:
a prefix is in at least as many documents as anything that extends it, so a prefix in too few documents ends the search
below it. Each level extends the prefixes that are left (4, 8, 16, ... bytes), counts the documents of each, and drops
those below the threshold, until only complete terms are left; a term is complete at the first level that is as long as it.

1. One pass cuts the texts. Each chunk (some MB of text) keeps its different terms and, for each, its documents and counts.
2. At each level a chunk sends one row for each extended prefix, with its documents, and for each complete term, with
   its documents and occurrences in each source. Rows meet by (language, prefix) in sorted partitions, where
   they are added up as they stream by. What is left goes back as a bit set of fixed size. A prefix that is only in it by chance
   is counted again at the next level and goes then; counts are never estimated.
3. Sums over all kept terms of a pair of sources are taken over the terms both have; what the others add follows from how
   many terms of a source have which count, as all of them meet the same share of the other source.

All arithmetic is on whole numbers. A document belongs to one chunk, so counts of documents add up. The list of (language,
source) groups is held by the driver and every task and bounded by ``MOST_GROUPS``: the result has their pairs, so more would be out of
reach anyway.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lacuna.functions.columns import ref
from lacuna.functions.durable import durable, local_table
from lacuna.functions.joins import attach_unique
from lacuna.functions.ranking import top_n
from lacuna.llm.text import column_bytes, hash_ranges, join_texts, mix, slices, word_ranges

MIN_DOCUMENTS = 3
TERM_RANKS = 200
#: Fixed value: shares are counted in parts of this.
SCALE = 10**9
FIRST_LENGTH = 4
CHUNK_BYTES = 12 << 20
CHUNK_DOCUMENTS = 65_000
BIT_SET = 26  # bits of a prefix's place in the bit set
PAIRS_AT_ONCE = 1 << 20
MOST_GROUPS = 1_000_000

#: Bytes of terms: ASCII letters and everything beyond ASCII.
MEMBER = np.zeros(256, bool)
MEMBER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_ENTRY = np.dtype([("g", "<u4"), ("docs", "<u4"), ("n", "<u8")])  # of one chunk, or of all
_COUNT = np.dtype([("g", "<u4"), ("n", "<u8")])


def _ranges(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Binary values that lie one behind the other in ``data``."""
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _sums(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each different key in order, and the sum of its ``values``; without values, how often it occurs."""
    if not values:
        return np.unique(keys, return_counts=True)
    if not len(keys):
        return (keys, *values)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    start = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[start], *(np.add.reduceat(v[order], start) for v in values)


CHUNK = "words binary, lengths binary, spread binary, docs binary, counts binary, groups binary, langs binary"


def _chunks(documents: DataFrame) -> DataFrame:
    """Of each chunk: its different terms one behind the other and their lengths; how many documents each has; these and its counts there;
    the documents' group and language numbers. ``documents``: g, l, text."""

    def packed(held: list[tuple[bytes, int, int]]) -> pa.RecordBatch:
        texts, groups, langs = zip(*held)
        data, first = join_texts(list(texts), lower=True)
        starts, ends = word_ranges(data, MEMBER)
        terms = _ranges(data[MEMBER[data]], ends - starts).dictionary_encode()
        doc = np.searchsorted(first, starts, "right") - 1
        places, counts = np.unique(terms.indices.to_numpy().astype(np.int64) * len(held) + doc, return_counts=True)
        words = terms.dictionary.to_pylist()
        spread = np.bincount(places // len(held), minlength=len(words))
        columns = (b"".join(words), np.array([len(w) for w in words], "<i4"), spread.astype("<i4"), (places % len(held)).astype("<u2"),
                   counts.astype("<u4"), np.array(groups, "<u4"), np.array(langs, "<u4"))
        return pa.RecordBatch.from_arrays([pa.array([c if isinstance(c, bytes) else c.tobytes()], pa.binary()) for c in columns],
                                          names=[f.split(" ")[0] for f in CHUNK.split(", ")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, int, int]] = []
        size = 0
        for batch in slices(batches):
            for text, g, l in zip(column_bytes(batch.column(2)), batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held and (size + len(text) > CHUNK_BYTES or len(held) >= CHUNK_DOCUMENTS):
                    yield packed(held)
                    held, size = [], 0
                held.append((text, g, l))
                size += len(text)
        if held:
            yield packed(held)

    return documents.select("g", "l", "text").mapInArrow(work, CHUNK)


def _bit(hashes: np.ndarray, langs: np.ndarray) -> np.ndarray:
    return (mix(hashes + langs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BIT_SET)).astype(np.int64)


PREFIX = "l int, term binary, open boolean, entries binary"


def _extended(chunks: DataFrame, before: int, length: int, kept: np.ndarray | None) -> DataFrame:
    """Of each chunk, what extends the prefixes of ``before`` bytes in the bit set ``kept``: open prefixes of ``length`` bytes, and terms
    that are complete with them, with their ``_ENTRY``s (open ones have one, of documents only)."""

    def rows(terms: pa.Array, langs: np.ndarray, is_open: bool, entries: np.ndarray, each: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(langs.astype(np.int32), pa.int32()), terms.cast(pa.binary()), pa.array(np.full(len(langs), is_open)),
             _ranges(entries.view(np.uint8), each * _ENTRY.itemsize).cast(pa.binary())], names=["l", "term", "open", "entries"])

    def one(words: bytes, *columns: bytes) -> Iterator[pa.RecordBatch]:
        lengths, spread, docs, counts, groups, langs = (np.frombuffer(c, t).astype(np.int64) for c, t in zip(
            columns, ("<i4", "<i4", "<u2", "<u4", "<u4", "<u4")))
        data = np.frombuffer(words + b"\0" * 8, np.uint8)
        starts = np.cumsum(lengths) - lengths
        term = np.repeat(np.arange(len(lengths)), spread)
        alive = np.ones(len(term), bool)
        if kept is not None:
            longer = np.flatnonzero(lengths > before)
            hashes = np.zeros(len(lengths), np.uint64)
            hashes[longer] = hash_ranges(data, starts[longer], np.full(len(longer), before))
            bit = _bit(hashes[term], langs[docs])
            alive = (lengths[term] > before) & (kept[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)
        whole = lengths[term] <= length
        use = np.flatnonzero(alive & whole)
        if len(use):
            width = int(groups.max()) + 1
            key, seen, n = _sums(term[use] * width + groups[docs[use]], np.ones(len(use), np.int64), counts[use])
            lang_of = np.zeros(width, np.int64)
            lang_of[groups] = langs
            entries = np.empty(len(key), _ENTRY)
            entries["g"], entries["docs"], entries["n"] = key % width, seen, n
            pair = key // width * (int(langs.max()) + 1) + lang_of[key % width]  # groups of one language have neighbouring numbers
            start = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
            which = (key // width)[start]
            table = _ranges(data[:-8], lengths)
            yield rows(table.take(pa.array(which)), lang_of[(key % width)[start]], False, entries, np.diff(np.append(start, len(key))))
        use = np.flatnonzero(alive & ~whole)
        if len(use):
            chosen, place = np.unique(term[use], return_inverse=True)
            cut = data[starts[chosen][:, None] + np.arange(length)]
            prefixes = _ranges(cut.ravel(), np.full(len(chosen), length)).dictionary_encode()
            number = prefixes.indices.to_numpy().astype(np.int64)[place.ravel()]
            there = np.unique(number * len(groups) + docs[use])
            width = int(langs.max()) + 1
            pair, seen = _sums(there // len(groups) * width + langs[there % len(groups)])
            entries = np.zeros(len(pair), _ENTRY)
            entries["docs"] = seen
            yield rows(prefixes.dictionary.take(pa.array(pair // width)), pair % width, True, entries, np.ones(len(pair), np.int64))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield from one(*(c[k].as_py() for c in batch.columns))

    return chunks.mapInArrow(work, PREFIX)


FOUND = "l int, term binary, open boolean, n long, entries binary, bit long"


def _left(rows: DataFrame, min_documents: int) -> DataFrame:
    """What is in at least ``min_documents`` documents of a language: complete terms with their occurrences ``n`` in it and ``_COUNT``s, and
    open prefixes with their place in the bit set."""

    def added(l: np.ndarray, is_open: np.ndarray, terms: pa.Array, entries: list[bytes]) -> tuple:
        """Runs of equal neighbours: their first row, the run of each sum, and the sums of each group."""
        code = terms.dictionary_encode().indices.to_numpy()
        new = np.concatenate(([True], (l[1:] != l[:-1]) | (is_open[1:] != is_open[:-1]) | (code[1:] != code[:-1])))
        each = np.array([len(e) for e in entries]) // _ENTRY.itemsize
        every = np.frombuffer(b"".join(entries), _ENTRY)
        run = np.repeat(np.cumsum(new) - 1, each)
        key, docs, n = _sums(run << 32 | every["g"].astype(np.int64), every["docs"].astype(np.int64), every["n"].astype(np.int64))
        sums = np.empty(len(key), _ENTRY)
        sums["g"], sums["docs"], sums["n"] = key & 0xFFFFFFFF, docs, n
        return np.flatnonzero(new), key >> 32, sums

    def kept(l: np.ndarray, is_open: np.ndarray, terms: pa.Array, run: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        start = np.searchsorted(run, np.arange(len(l) + 1))
        total = np.add.reduceat(sums["docs"].astype(np.int64), start[:-1])
        n = np.add.reduceat(sums["n"].astype(np.int64), start[:-1])
        good = np.flatnonzero(total >= min_documents)
        chosen = terms.take(pa.array(good))
        counts = np.empty(len(sums), _COUNT)
        counts["g"], counts["n"] = sums["g"], sums["n"]
        joined = b"".join(w for w in chosen.to_pylist()) + b"\0" * 8
        lengths = np.array([len(w) for w in chosen.to_pylist()], np.int64)
        bits = _bit(hash_ranges(np.frombuffer(joined, np.uint8), np.cumsum(lengths) - lengths, lengths), l[good]) if len(good) else []
        opened = is_open[good].tolist()
        return pa.RecordBatch.from_arrays(
            [pa.array(l[good].astype(np.int32), pa.int32()), chosen, pa.array(opened, pa.bool_()), pa.array(n[good], pa.int64()),
             pa.array([None if o else counts[start[k]:start[k + 1]].tobytes() for k, o in zip(good.tolist(), opened)], pa.binary()),
             pa.array([b if o else None for b, o in zip(bits, opened)], pa.int64())], names=["l", "term", "open", "n", "entries", "bit"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # the last run of a batch may go on in the next one
        for batch in batches:
            l, is_open = batch.column(0).to_numpy(), np.array(batch.column(2).to_pylist(), bool)
            terms, entries = batch.column(1), batch.column(3).to_pylist()
            if rest is not None:
                l, is_open = np.concatenate(([rest[0]], l)), np.concatenate(([rest[1]], is_open))
                terms, entries = pa.concat_arrays([pa.array([rest[2]], pa.binary()), terms]), [rest[3], *entries]
            if not len(l):
                continue
            first, run, sums = added(l, is_open, terms, entries)
            last = first[-1]
            done = int(np.searchsorted(run, len(first) - 1))
            rest = (l[last], is_open[last], terms[int(last)].as_py(), sums[done:].tobytes())
            if len(first) > 1:
                yield kept(l[first[:-1]], is_open[first[:-1]], terms.take(pa.array(first[:-1])), run[:done], sums[:done])
        if rest is not None:
            sums = np.frombuffer(rest[3], _ENTRY)
            yield kept(np.array(rest[:1]), np.array(rest[1:2]), pa.array(rest[2:3], pa.binary()), np.zeros(len(sums), np.int64), sums)

    return rows.repartition("l", "term").sortWithinPartitions("l", "term", "open").mapInArrow(work, FOUND)


def _bit_set(found: DataFrame) -> np.ndarray | None:
    """The open prefixes of ``found`` as a bit set of 2 ** BIT_SET bits, whatever their number; None if there are none."""
    place = F.col("bit") + 1  # Spark's bitmaps count from 1
    parts = found.where("open").groupBy(F.bitmap_bucket_number(place).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    if not parts:
        return None
    out = np.zeros((1 << BIT_SET) // 8, np.uint8)
    for p in parts:
        out[(p.part - 1) * 4096:p.part * 4096] = np.frombuffer(p.bits, np.uint8)
    return out


def frequent_terms(numbered: DataFrame, min_documents: int = MIN_DOCUMENTS, first_length: int = FIRST_LENGTH) -> DataFrame:
    """l, term, n, entries: each language's terms in at least ``min_documents`` of its documents, with packed counts by group.

    ``numbered`` has g (group), l (its language) and text; groups of one language have neighbouring numbers.
    """
    chunks = durable(_chunks(numbered))
    before, length, bits, kept = 0, first_length, None, None
    while True:
        found = durable(_left(_extended(chunks, before, length, bits), min_documents))
        complete = found.where("NOT open").select("l", "term", "n", "entries")
        kept = complete if kept is None else kept.unionByName(complete)
        bits = _bit_set(found)
        if bits is None:
            return kept
        before, length = length, 2 * length


def share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total)."""
    if len(count) and int(count.max()) >= 9 * 10**9:  # beyond 64 bits
        return np.array([1 + SCALE * (int(c) + 1) // int(t) for c, t in zip(*np.broadcast_arrays(count, total))], np.int64)
    return 1 + SCALE * (count + 1) // total


def deviation(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q) ** 2 / q)."""
    return (p - q) * (p - q) // q


def _counts(kept: DataFrame) -> DataFrame:
    """g, n, times: how many terms of a group have which count."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = np.frombuffer(b"".join(batch.column(0).to_pylist()), _COUNT)
            pairs, times = np.unique(every, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pairs["g"].astype(np.int32)), pa.array(pairs["n"].astype(np.int64)), pa.array(times)],
                                             names=["g", "n", "times"])

    return kept.select("entries").mapInArrow(work, "g int, n long, times long").groupBy("g", "n").agg(F.sum("times").alias("times"))


def _parts(kept: DataFrame, totals: np.ndarray, lang_totals: np.ndarray, ranks: int) -> DataFrame:
    """Sums over shared terms (g, h, value), and terms that stand out (g, term, value; h NULL): of each batch those up to rank ``ranks``.

    ``totals`` and ``lang_totals``: what a group's and a language's counts are divided by.
    """
    none = share(np.zeros(len(totals), np.int64), np.maximum(totals, 1))

    def made(g: np.ndarray, h: np.ndarray | None, terms: pa.Array | None, value: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(g.astype(np.int32), pa.int32()), pa.nulls(len(g), pa.int32()) if h is None else pa.array(h.astype(np.int32), pa.int32()),
             pa.nulls(len(g), pa.binary()) if terms is None else terms, pa.array(value, pa.int64())], names=["g", "h", "term", "value"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            l, n_lang, entries = batch.column(0).to_numpy(), batch.column(2).to_numpy(), batch.column(3).to_pylist()
            each = np.array([len(e) for e in entries]) // _COUNT.itemsize
            every = np.frombuffer(b"".join(entries), _COUNT)
            row, g = np.repeat(np.arange(len(l)), each), every["g"].astype(np.int64)
            p = share(every["n"].astype(np.int64), totals[g])
            q = share(n_lang, lang_totals[l])[row]
            more = np.flatnonzero(p > q)
            value = deviation(p[more], q[more])
            order = np.lexsort((-value, g[more]))
            place = np.arange(len(order)) - np.searchsorted(g[more][order], g[more][order])
            edge = np.full(len(totals), -1, np.int64)  # value at the last rank of each group; terms equal to it stay
            at = order[place == ranks - 1]
            edge[g[more][at]] = value[at]
            chosen = value >= edge[g[more]]
            yield made(g[more][chosen], None, batch.column(1).take(pa.array(row[more][chosen])), value[chosen])
            # Each entry meets all entries of its row, some at a time.
            size = each[row]
            start = (np.cumsum(each) - each)[row]
            upto = np.cumsum(size)
            a = 0
            while a < len(row):
                b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + PAIRS_AT_ONCE, "right")))
                left = np.repeat(np.arange(a, b), size[a:b])
                right = np.arange(len(left)) - np.repeat(np.cumsum(size[a:b]) - size[a:b], size[a:b]) + start[left]
                other = g[left] != g[right]
                left, right = left[other], right[other]
                x, y, p0, q0 = p[left], p[right], none[g[left]], none[g[right]]
                over = deviation(x, y) - deviation(x, q0) - deviation(p0, y) + deviation(p0, q0)
                key, sums = _sums(g[left] * len(totals) + g[right], over)
                yield made(key // len(totals), key % len(totals), None, sums)
                a = b

    return kept.select("l", "term", "n", "entries").mapInArrow(work, "g int, h int, term binary, value long")


def _deviation(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) DIV {q})"


def source_divergence(documents: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
                      min_documents: int = MIN_DOCUMENTS, term_ranks: int = TERM_RANKS) -> DataFrame:
    """lang, source, part, item, value, rank.

    Terms are runs of ASCII letters and characters beyond ASCII, A-Z lower-cased; of each language the V terms in at least ``min_documents`` of
    its rows are kept. A group (lang, source) or language gives a kept term the share p = 1 + floor(10^9 * (count + 1) / (N + V)), N being its
    occurrences of kept terms. Part ``pair``: each other source of the language, with the sum of floor((p - q)^2 / q) over all kept terms, q the
    other source's shares (0 without kept terms). Part ``term``: kept terms of the group with p > q, q the language's share, and that
    value, up to rank ``term_ranks``. Ranks go by value descending, then item in UTF-8 order. NULL lang, source and text are empty. Equal rows
    are documents of their own; a group without terms has its pairs; a language with one source has none. No rows give no rows; other columns
    are not read.
    """
    spark = documents.sparkSession
    empty = F.lit("")
    base = documents.select(*(F.coalesce(ref(c), empty).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    sizes = durable(base.groupBy("lang", "source").agg(F.count("*").alias("size")))
    if sizes.limit(MOST_GROUPS + 1).count() > MOST_GROUPS:
        raise ValueError(f"more than {MOST_GROUPS} groups of language and source")
    listed = sorted(sizes.collect(), key=lambda r: (r.lang.encode(), r.source.encode()))
    langs = list(dict.fromkeys(r.lang for r in listed))
    number = {l: k for k, l in enumerate(langs)}
    lang_of = np.array([number[r.lang] for r in listed], np.int64)
    names = local_table(spark, [(r.lang, r.source, g, number[r.lang], r.size) for g, r in enumerate(listed)],
                        "lang string, source string, g int, l int, size bigint")
    numbered = attach_unique(base, names, ["lang", "source"], weight="size")
    kept = frequent_terms(numbered, min_documents)
    counts = durable(_counts(kept))
    vocabulary, lang_totals, group_totals = (np.zeros(n, np.int64) for n in (len(langs), len(langs), len(listed)))
    for r in kept.groupBy("l").agg(F.count("*").alias("v"), F.sum("n").alias("n")).collect():
        vocabulary[r.l], lang_totals[r.l] = r.v, r.n + r.v
    for r in counts.groupBy("g").agg(F.sum(F.col("n") * F.col("times")).alias("n")).collect():
        group_totals[r.g] = r.n
    group_totals += vocabulary[lang_of] if len(listed) else 0
    none = share(np.zeros(len(listed), np.int64), np.maximum(group_totals, 1))
    found = durable(_parts(kept, group_totals, lang_totals, term_ranks))

    groups = local_table(spark, [(r.lang, r.source, g, number[r.lang], int(group_totals[g]), int(vocabulary[number[r.lang]]), int(none[g]))
                                 for g, r in enumerate(listed)],
                         "lang string, source string, g int, l int, total bigint, v bigint, p0 bigint")
    terms = found.where("h IS NULL").select("g", F.col("term").cast("string").alias("item"), "value")
    terms = attach_unique(top_n(terms, ["g"], [F.col("value").desc(), F.col("item").asc()], term_ranks, salt=F.col("item")), groups, ["g"])

    other = groups.select(F.col("l").alias("l_"), F.col("g").alias("h"), F.col("source").alias("item"), F.col("p0").alias("q0"))
    two = lambda rows: rows.join(other, (F.col("l") == F.col("l_")) & (F.col("g") != F.col("h")))
    # Terms of one group only: as one that has them against one without (ours), and the other way round (theirs).
    having = two(attach_unique(counts, groups, ["g"]).withColumn(
        "p", F.expr(f"1 + CAST({SCALE} AS DECIMAL(20, 0)) * (n + 1) DIV total")))
    alone = having.groupBy("g", "h").agg(
        F.expr(f"sum(times * ({_deviation('p', 'q0')} - {_deviation('p0', 'q0')}))").alias("ours"),
        F.expr(f"sum(times * ({_deviation('q0', 'p')} - {_deviation('q0', 'p0')}))").alias("theirs"))
    shared = found.where("h IS NOT NULL").groupBy("g", "h").agg(F.sum("value").alias("both"))
    added = alone.select("g", "h", F.col("ours").alias("more")).unionByName(
        alone.select(F.col("h").alias("g"), F.col("g").alias("h"), F.col("theirs").alias("more"))).unionByName(
        shared.select("g", "h", F.col("both").alias("more"))).groupBy("g", "h").agg(F.sum("more").alias("more"))
    pairs = two(groups).join(added, ["g", "h"], "left").withColumn(
        "value", F.expr(f"v * {_deviation('p0', 'q0')} + coalesce(more, 0)"))

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        order = Window.partitionBy("g").orderBy(F.col("value").desc(), F.col("item").asc())
        return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    return ranked(pairs, "pair").unionByName(ranked(terms, "term"))
