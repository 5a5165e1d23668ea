"""Byte-level BPE encoding and decoding; long unsplit text by tree concatenation.

Texts are split into pre-tokens by the tokenizer's own pattern, and short pre-tokens are merged as they are, with the
ranks read from the tokenizer's file. A pre-token longer than ``LEAF`` bytes (no pattern boundary for that long) is halved down to leaves,
the leaves are encoded independently of each other, and neighbours are put together pairwise: around each join a growing
window of tokens is encoded anew until both of its ends agree with the tokens that are already there. Ends agree when
the pair of tokens across each seam encodes to itself, which for merge-ordered BPE makes the whole sequence the
encoding of the joined text; so the result is exact, and no step handles more than a window of a long text at once.

A text of more than ``LONG`` bytes is cut into rows of at most about ``PIECE`` bytes, between pre-tokens where it can be and inside them where
they are longer. The rows are encoded by as many tasks as there are, and the parts of one pre-token are joined in the same
way, ``FAN`` neighbours to a task, level by level, until each pre-token is whole.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from array import array
from collections.abc import Callable, Iterator, Sequence
from functools import cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.functions.columns import ref
from lacuna.functions.durable import durable
from lacuna.llm.tables import slots

LEAF = 256  # bytes of unsplit text that are encoded in one piece
ROWS = 500  # texts of one output batch
LONG = 4 << 20  # bytes of a text beyond which several tasks encode it
PIECE = 1 << 18  # bytes of one row of a long text
FAN = 16  # neighbours that one task joins
TASK_BYTES = 32 << 20  # bytes of long texts that one task takes
#: Fixed value: the split pattern of byte-level BPE tokenizers of this family.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def join_encoded(left: array, right: array, encode: Callable[[bytes], list[int]], spell: Sequence[bytes]) -> array:
    """Encoding of two neighbouring texts from their encodings."""

    def fits(a: int, b: int) -> bool:
        return encode(spell[a] + spell[b]) == [a, b]

    if not left or not right:
        return left + right
    i, j, width = len(left), 0, 1  # the window covers left[i:] and right[:j]
    window = array("I")
    while True:
        before = i == 0 or fits(left[i - 1], window[0] if window else right[j])
        after = j == len(right) or fits(window[-1] if window else left[i - 1], right[j])
        if before and after:
            return left[:i] + window + right[j:]
        if not before:
            i = max(0, i - width)
        if not after:
            j = min(len(right), j + width)
        width *= 2
        window = array("I", encode(b"".join(spell[t] for t in left[i:] + right[:j])))


#: Only a text with such a run can hold a pre-token of more than LEAF bytes.
_RUN = re.compile(rf"\S{{{LEAF // 4 + 1},}}|\s{{{LEAF // 4 + 1},}}")


def ids_bytes(ids: Sequence[int]) -> bytes:
    return array("I", ids).tobytes() if sys.byteorder == "little" else np.array(ids, "<u4").tobytes()


def ids_array(raw: bytes) -> array:
    return array("I", np.frombuffer(raw, "<u4").astype("=u4").tobytes())


class Codec:
    """Texts to ids and back, for one Python worker.

    A file whose merges are not in the order of their ids, or with another split pattern, raises ValueError.
    """

    def __init__(self, path: str) -> None:
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.words = regex.compile(PATTERN).finditer
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.at_special = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) \
            if self.special else None
        alphabet = byte_alphabet()
        self.letters = [alphabet[b] for b in range(256)]
        back = {c: b for b, c in alphabet.items()}
        self.spell: list[bytes] = [b""] * self.tokenizer.get_vocab_size()
        for token, i in self.tokenizer.get_vocab().items():
            self.spell[i] = token.encode() if token in self.special else bytes(back[c] for c in token)
        self.model = self.tokenizer.model
        spec = json.loads(self.tokenizer.to_str())
        merged = [self.tokenizer.token_to_id("".join(m.split(" ") if isinstance(m, str) else m)) for m in spec["model"]["merges"]]
        if merged != sorted(merged) or spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" \
                or spec["pre_tokenizer"]["add_prefix_space"] or not spec["pre_tokenizer"]["use_regex"]:
            raise ValueError(f"{path} is no plain byte-level BPE in the order of its ids")
        special = set(self.special.values())
        self.plain = tiktoken.Encoding(
            "ranks", pat_str=PATTERN, mergeable_ranks={b: i for i, b in enumerate(self.spell) if i not in special},
            special_tokens={}).encode_ordinary

    def leaf(self, raw: bytes) -> list[int]:
        """Merge one piece of bytes, whatever the split pattern would do with it."""
        return [t.id for t in self.model.tokenize("".join(map(self.letters.__getitem__, raw)))] if raw else []

    def joined(self, parts: list[array]) -> array:
        """Encoding of neighbouring parts of one pre-token: pairs of neighbours up the tree."""
        while len(parts) > 1:
            parts = [join_encoded(parts[k], parts[k + 1], self.leaf, self.spell) if k + 1 < len(parts) else parts[k]
                     for k in range(0, len(parts), 2)]
        return parts[0]

    def long(self, raw: bytes) -> array:
        """Ids of a long pre-token or a part of one: leaves first, then joined."""
        return self.joined([array("I", self.leaf(raw[k:k + LEAF])) for k in range(0, len(raw), LEAF)])

    def segment(self, text: str) -> bytes:
        """Ids of a text in which special strings count as ordinary text."""
        if not _RUN.search(text):
            return ids_bytes(self.plain(text))
        out, short = [], []
        for found in self.words(text):
            word = found[0]
            if 4 * len(word) > LEAF and len(word.encode()) > LEAF:
                out += [ids_bytes(short), ids_bytes(self.long(word.encode()))]
                short = []
            else:
                short += self.plain(word)
        return b"".join([*out, ids_bytes(short)])

    def around_special(self, text: str) -> Iterator[tuple[str, bytes]]:
        """The ordinary text before each special string with that string's id, and the rest with no id."""
        at = 0
        if any(s in text for s in self.special):
            for m in self.at_special.finditer(text):
                yield text[at:m.start()], self.special[m[0]].to_bytes(4, "little")
                at = m.end()
        yield text[at:], b""

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; special strings become their special id."""
        return b"".join(part for plain, special in self.around_special(text) for part in (self.segment(plain), special))

    def pieces(self, text: str, size: int) -> Iterator[tuple[int, int, bool, bytes, bytes]]:
        """word, place, cut, bytes to encode, ids behind them: a text in rows of about ``size`` bytes.

        A row that is not ``cut`` holds whole pre-tokens and is a word of its own; the rows of a pre-token of more than ``size`` bytes
        are one word, in the order of their places.
        """
        word = 0
        for plain, special in self.around_special(text):
            start, length = 0, 0
            for m in self.words(plain):
                a, b = m.span()
                raw = m[0].encode()
                if len(raw) > size:
                    if a > start:
                        yield word, 0, False, plain[start:a].encode(), b""
                    for k in range(0, len(raw), size):
                        yield word + 1, k // size, True, raw[k:k + size], b""
                    word, start, length = word + 2, b, 0
                elif length + len(raw) >= size:
                    yield word, 0, False, plain[start:b].encode(), b""
                    word, start, length = word + 1, b, 0
                else:
                    length += len(raw)
            yield word, 0, False, plain[start:].encode(), special
            word += 1

    def piece(self, cut: bool, raw: bytes, behind: bytes) -> bytes:
        return ids_bytes(self.long(raw)) if cut else self.segment(raw.decode()) + behind

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 bytes that the ids spell, with replacement characters where they are not UTF-8; ids outside the vocabulary spell nothing."""
        known = np.frombuffer(ids, "<u4")
        raw = b"".join(map(self.spell.__getitem__, known[known < len(self.spell)].tolist()))
        return raw.decode("utf-8", "replace").encode()


def _mapped(df: DataFrame, id_col: str, value_col: str, work: Callable, schema: str) -> DataFrame:
    rows = df.select(ref(id_col).alias("id"), ref(value_col).alias("value"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(work, f"id {kind}, {schema}").withColumnRenamed("id", id_col)


def _loader(path: str) -> Callable[[], Codec]:
    """The codec, loaded when a task first has a row for it: of the tasks that join, most have none."""
    return cache(lambda: Codec(path))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield tuple(c[k].as_py() for c in batch.columns)


def _long_ids(texts: DataFrame, path: str, tasks: int, piece_bytes: int) -> DataFrame:
    """key and ids of each text (key, value); written."""
    names = ["key", "word", "place", "cut"]

    def batch(key, word, place, cut, *binary) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([key], pa.int64()), pa.array([word], pa.int64()), pa.array([place], pa.int64()), pa.array([cut], pa.bool_()),
             *(pa.array([b], pa.binary()) for b in binary)], names=[*names, *(["raw", "behind"] if len(binary) > 1 else ["ids"])])

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _loader(path)
        for key, text in _rows(batches):
            for piece in codec().pieces(text, piece_bytes):
                yield batch(key, *piece)

    def encode_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _loader(path)
        for key, word, place, cut, raw, behind in _rows(batches):
            yield batch(key, word, place, cut, codec().piece(cut, raw, behind))

    def join_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _loader(path)
        for (key, word, place), rows in groupby(_rows(batches), lambda r: (r[0], r[1], r[2] // FAN)):
            yield batch(key, word, place, True, ids_bytes(codec().joined([ids_array(r[4]) for r in rows])))

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in groupby(_rows(batches), lambda r: r[0]):
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([b"".join(r[4] for r in rows)], pa.binary())],
                                             names=["key", "ids"])

    kinds = "key long, word long, place long, cut boolean"
    pieces = durable(texts.repartition(tasks).mapInArrow(cut_up, f"{kinds}, raw binary, behind binary"))
    encoded = durable(pieces.repartition(tasks, "key", "word", "place").mapInArrow(encode_pieces, f"{kinds}, ids binary"))
    whole, parts = encoded.where("NOT cut"), encoded.where("cut")
    last = parts.agg(F.max("place")).first()[0] or 0
    while last:
        parts = parts.repartition(tasks, "key", "word", F.floor(F.col("place") / FAN)).sortWithinPartitions(
            "key", "word", "place").mapInArrow(join_neighbours, f"{kinds}, ids binary")
        last //= FAN
    together = whole.unionByName(parts).repartition(tasks, "key").sortWithinPartitions("key", "word", "place")
    return durable(together.mapInArrow(put_together, "key long, ids binary"))


def _encoded(df: DataFrame, path: str, id_col: str, text_col: str, long_bytes: int, piece_bytes: int,
             finish: Callable[[Codec, list[bytes]], list[pa.Array]], schema: str) -> DataFrame:
    """``id_col`` and what ``finish`` makes of the ids of each row's text, texts of more than ``long_bytes`` in pieces."""
    names = ["id", *(c.split()[0] for c in schema.split(", "))]

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for part in _parts(batches):
            ids = [codec.encode(t or "") for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), *finish(codec, ids)], names=names)

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _loader(path)
        for part in _parts(batches, 1):
            yield pa.RecordBatch.from_arrays([part.column(0), *finish(codec(), part.column(1).to_pylist())], names=names)

    size = F.coalesce(F.octet_length(ref(text_col)), F.lit(0))
    long = durable(df.where(size > long_bytes).select(
        F.monotonically_increasing_id().alias("key"), ref(id_col).alias("id"), ref(text_col).alias("value")))
    total = long.agg(F.sum(F.octet_length("value").cast("long"))).first()[0]
    if not total:
        return _mapped(df, id_col, text_col, whole, schema)
    tasks = max(slots(df.sparkSession), -(-total // TASK_BYTES))
    ids = _long_ids(long.select("key", "value"), path, tasks, piece_bytes).join(long.select("key", "id"), "key")
    return _mapped(df.where(size <= long_bytes), id_col, text_col, whole, schema).unionByName(
        _mapped(ids.select(F.col("id").alias(id_col), F.col("ids").alias("value")), id_col, "value", finished, schema))


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", long_bytes: int = LONG,
           piece_bytes: int = PIECE) -> DataFrame:
    """``id_col`` and ids (binary, little-endian unsigned 32-bit) of each row's whole text.

    ``path`` is the tokenizer's file, readable where tasks run. NULL and empty texts have no ids; special strings inside
    a text become their special id. One row for each row that goes in, NULL and repeated ids included; other columns are
    not read. Texts of more than ``long_bytes`` are encoded in rows of about ``piece_bytes`` each; the ids do not depend on either.
    """
    return _encoded(df, path, id_col, text_col, long_bytes, piece_bytes, lambda codec, ids: [pa.array(ids, pa.binary())], "ids binary")


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col`` and text of each row's ids; NULL ids spell the empty text, ids outside the vocabulary nothing.

    One row for each row that goes in, NULL and repeated ``id_col`` included; other columns are not read.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for part in _parts(batches):
            texts = [codec.decode(ids or b"").decode() for ids in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    return _mapped(df, id_col, ids_col, work, "text string")


def round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
               long_bytes: int = LONG, piece_bytes: int = PIECE) -> DataFrame:
    """``id_col``, n_tokens, ids_sha256, decoded_sha256 (and ids): encode and decode in one pass.

    Rows, NULLs and long texts as in ``encode``.
    """

    def finish(codec: Codec, ids: list[bytes]) -> list[pa.Array]:
        return [pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                pa.array([hashlib.sha256(codec.decode(i)).hexdigest() for i in ids], pa.string()),
                *([pa.array(ids, pa.binary())] if with_ids else [])]

    return _encoded(df, path, id_col, text_col, long_bytes, piece_bytes, finish,
                    "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids)


def _parts(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
