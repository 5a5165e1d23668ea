"""Texts as byte arrays: batches, words and their hashes, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Text bytes handled at a time inside a task; a longer single document is handled alone.
CHUNK_BYTES = 4 << 20

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes that belong to a word when words are whatever ASCII white space leaves.
NOT_WHITE = ~_WHITE

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def column_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, NULL as empty."""
    return [b"" if v is None else v for v in column.cast(pa.large_binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that only few texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[slice]:
    """Slices of consecutive texts with at most ``limit`` bytes, or with one text."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > limit:
            yield slice(start, i)
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield slice(start, len(texts))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_ranges(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range; ``data`` must have 8 spare bytes at its end."""
    eights = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    out = lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    active = np.arange(len(starts))
    offset = 0
    while len(active):
        left = lengths[active] - offset
        part = eights[starts[active] + offset]
        short = left < 8
        part[short] &= (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        out[active] = mix(out[active] ^ part) + np.uint64(offset + 1)
        offset += 8
        active = active[left > 8]
    return out


def join_texts(texts: list[bytes], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, a line feed and spare bytes behind each; and where each starts."""
    data = np.frombuffer(b"\n".join(texts) + b"\n" * 9, np.uint8)
    starts = np.zeros(len(texts), np.int64)
    np.cumsum([len(t) + 1 for t in texts[:-1]], out=starts[1:])
    return (_LOWER[data] if lower else data), starts


def word_ranges(data: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes in ``member``; the last byte of ``data`` must be outside."""
    inside = member[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edges = np.concatenate(([0], edges))
    return edges[0::2], edges[1::2]


def word_hashes(texts: list[bytes], member: np.ndarray = NOT_WHITE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, A-Z lower-cased, and the bounds of each text in them (one more than texts)."""
    data, first = join_texts(texts, lower=True)
    starts, ends = word_ranges(data, member)
    bounds = np.concatenate((np.searchsorted(starts, first), [len(starts)]))
    return hash_ranges(data, starts, ends - starts), bounds
