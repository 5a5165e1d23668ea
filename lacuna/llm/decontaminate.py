"""Benchmark passages in documents, found by word windows with DataFrame functions only.

The benchmark's windows become a broadcast hash set: a bit set of fixed largest size (``MOST_BITS``), as a literal of the
plan. Every document's windows are hashed where the document is read; those whose bit is set are carried on as text
and verified by an exact join with the benchmark's windows. So texts are never shuffled, rows leave a document only
where a window probably is, and a larger benchmark than the bit set is made for only lets more windows through to the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.functions.columns import quoted, ref
from lacuna.llm.tables import checked
from lacuna.llm.url_filter import LOWER, UPPER

WINDOW = 10
MOST_BITS = 1 << 26
WINDOWS_BROADCAST = 100_000
#: All ASCII that is in no word, once A-Z are lower-cased.
BETWEEN = r"[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def _words(column: str) -> str:
    """SQL of a text's words; empty for NULL."""
    return (f"filter(split(translate(coalesce({quoted(column)}, ''), '{UPPER}', '{LOWER}'), '{BETWEEN}'), x -> x != '')")


def _starts(length: str) -> str:
    """SQL of the positions where a window of ``length`` words can start in the words ``w``; from 1."""
    return f"if(size(w) >= {length}, sequence(1, size(w) - {length} + 1), cast(array() as array<int>))"


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """length, words (joined by a space), items (distinct ids as strings) of each distinct window.

    An item with fewer words than ``window``, but not none, is one window. An item without id marks words, but is not listed.
    """
    found = benchmark.select(ref(id_col).cast("string").alias("item"), F.expr(
        f"transform(array({_words(text_col)}), w -> if(size(w) >= {window}, transform({_starts(str(window))}, "
        f"i -> struct({window} AS length, array_join(slice(w, i, {window}), ' ') AS words)), "
        f"if(size(w) > 0, array(struct(size(w) AS length, array_join(w, ' ') AS words)), array())))[0]").alias("found"))
    return found.select("item", F.inline("found")).groupBy("length", "words").agg(F.collect_set("item").alias("items"))


def _hash(start: str, length: str) -> str:
    return f"xxhash64(slice(w, {start}, {length}))"


def bit_set(windows: DataFrame) -> tuple[str, int]:
    """The windows' hashes as comma-separated 64-bit words, and the number of bits (a power of two)."""
    n = windows.count()
    log = min(MOST_BITS.bit_length() - 1, max(12, (64 * n).bit_length()))
    h = "xxhash64(split(words, ' '))"
    filled = windows.select(F.expr(f"cast(shiftrightunsigned({h}, {64 - log + 6}) as int)").alias("at"),
                            F.expr(f"shiftleft(1L, cast({h} & 63 as int))").alias("bit"))
    # At most MOST_BITS / 64 rows, whatever the benchmark.
    rows = dict(filled.groupBy("at").agg(F.bit_or("bit").alias("bits")).collect())
    return ",".join(str(rows.get(k, 0)) for k in range(1 << (log - 6))), log


def window_hits(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                item_col: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per row: id, n_words, hits (array of first word, from 1, and length), items (sorted strings).

    Rows are told apart by position, so repeated and NULL ids keep their own results. NULL and empty texts have no words;
    with an empty benchmark nothing is hit.
    """
    windows = benchmark_windows(benchmark, item_col, item_text, window)
    lengths = [r[0] for r in windows.select("length").distinct().collect()]  # 1 to ``window``
    words = _words(text_col)
    if lengths:
        bits, log = bit_set(windows)
        held = f"from_json('[{bits}]', 'array<bigint>')"
        test = (f"(shiftrightunsigned(element_at({held}, cast(shiftrightunsigned(s.h, {64 - log + 6}) as int) + 1), "
                f"cast(s.h & 63 as int)) & 1) = 1")
        parts = ", ".join(
            f"transform(filter(transform({_starts(str(m))}, i -> struct(i AS start, {_hash('i', str(m))} AS h)), s -> {test}), "
            f"s -> struct(s.start AS start, {m} AS length, array_join(slice(w, s.start, {m}), ' ') AS words))" for m in sorted(lengths))
        near = f"concat({parts})"
    else:
        near = "cast(array() as array<struct<start: int, length: int, words: string>>)"
    # The words are bound once per row as a lambda variable; everything about them is computed there.
    read = documents.select(
        F.monotonically_increasing_id().alias("row"), ref(id_col).alias("id"),
        F.expr(f"transform(array({words}), w -> struct(size(w) AS n_words, {near} AS near))[0]").alias("found"))
    rows = read.select("row", "id", F.col("found.n_words").cast("long").alias("n_words"), F.explode_outer("found.near").alias("near"))
    # A row without candidates gets a key of its own that no window has, so that clean rows are spread where the join is shuffled.
    nothing = F.concat(F.lit("\0"), F.col("row").cast("string"))
    rows = rows.select("row", "id", "n_words", F.col("near.start").alias("start"), F.coalesce("near.length", F.lit(0)).alias("length"),
                       F.coalesce("near.words", nothing).alias("words"))
    verified = rows.join(checked(windows, WINDOWS_BROADCAST), ["length", "words"], "left")
    hit = F.when(F.col("items").isNotNull(), F.struct("start", "length"))
    return verified.groupBy("row", "id", "n_words").agg(F.collect_set(hit).alias("hits"), F.collect_set("items").alias("items")).select(
        "id", "n_words", "hits", F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"))


def hit_words() -> Column:
    """Distinct positions of the words in any hit."""
    return F.expr("array_distinct(flatten(transform(hits, h -> sequence(h.start, h.start + h.length - 1))))")


def find_contaminated(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``id_col``, n_words, n_hit, n_items, items_sha256 and contaminated of each row; see ``window_hits``."""
    found = window_hits(documents, benchmark, id_col, text_col, **options)
    counted = found.withColumn("n_hit", F.size(hit_words()).cast("long"))
    return counted.select(F.col("id").alias(id_col), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                          F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def remove_spans(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``id_col`` and the text without the words that are hit; what stands between words stays.

    ``id_col`` must be unique and not NULL here, since texts are joined to their hits by it. Only texts with hits are taken
    apart; others, NULL included, come back as they are.
    """
    found = window_hits(documents, benchmark, id_col, text_col, **options).where(F.size("hits") > 0).select(
        F.col("id").alias("hit_id"), hit_words().alias("places"))
    pieces = r"regexp_extract_all(text, '([0-9A-Za-z]|[^\\x00-\\x7F])+|[^0-9A-Za-z\\x80-\\x{10FFFF}]+', 0)"
    # Words and what stands between them alternate, so a word's number follows from its place.
    cleaned = (f"transform(array({pieces}), p -> array_join(filter(p, (x, j) -> NOT (x RLIKE '^([0-9A-Za-z]|[^\\\\x00-\\\\x7F])' AND "
               "array_contains(places, cast(floor((j + 2 - if(p[0] RLIKE '^([0-9A-Za-z]|[^\\\\x00-\\\\x7F])', 0, 1)) / 2) as int)))), ''))[0]")
    joined = documents.select(ref(id_col).alias("id"), ref(text_col).alias("text")).join(
        checked(found, WINDOWS_BROADCAST), F.col("id") == F.col("hit_id"), "left")
    return joined.select(F.col("id").alias(id_col), F.when(F.col("places").isNull(), F.col("text")).otherwise(F.expr(cleaned)).alias(text_col))
