"""Finding shared tokens by messages to the owners of token ranges.

A chunk is a part of one task's rows, with at most 65 535 places (documents) to name. It sends every owner the sorted,
Golomb-coded tokens of the owner's range with their places, and one note to itself. Owners see all occurrences of a
token and answer the chunks with those that occur more than once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lacuna.llm.exact_dedup import golomb_decode, golomb_encode

MESSAGE = "owner int, chunk long, base long, tokens binary, places binary"


def messages(chunk: int, owners: int, note: bytes, keys: np.ndarray, places: np.ndarray, bits: int) -> pa.RecordBatch:
    """All messages of one chunk. ``keys`` are 64-bit hashes, of which the leading ``bits`` are sent."""
    rows = [(int(chunk % owners), None, None, note)]
    order = np.argsort(keys, kind="stable")
    keys, places = keys[order], places[order].astype("<u2")
    owner = ((keys >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)
    bounds = np.searchsorted(owner, np.arange(owners + 1, dtype=np.uint64)).tolist()
    tokens = keys >> np.uint64(64 - bits)
    for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
        if b > a:
            rows.append((k, int(tokens[a]), golomb_encode(tokens[a:b] - tokens[a]), places[a:b].tobytes()))
    owner_, base, code, place = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(owner_, pa.int32()), pa.array([chunk] * len(rows), pa.int64()), pa.array(base, pa.int64()),
         pa.array(code, pa.binary()), pa.array(place, pa.binary())], names=["owner", "chunk", "base", "tokens", "places"])


def shared_tokens(sent: DataFrame) -> DataFrame:
    """What each chunk gets: its own note (shared NULL), and its tokens that occur more than once anywhere.

    ``body`` holds ``shared`` tokens (8 bytes each), then their places (2), then how often each occurs (2, at most 65535).
    """

    def work(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["chunk", "shared", "body"]
        senders, tokens, places = [], [], []
        for b in batches:
            for chunk, base, code, place in zip(*(b.column(c).to_pylist() for c in ("chunk", "base", "tokens", "places"))):
                if code is None:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([chunk], pa.int64()), pa.array([None], pa.int32()), pa.array([place], pa.binary())], names=names)
                else:
                    senders.append(chunk)
                    tokens.append(golomb_decode(code) + np.uint64(base))
                    places.append(np.frombuffer(place, "<u2"))
        if not tokens:
            return
        sender = np.repeat(np.arange(len(tokens), dtype=np.int32), [len(t) for t in tokens])
        every, place = np.concatenate(tokens), np.concatenate(places)
        del tokens, places
        order = np.argsort(every, kind="stable")
        every = every[order]
        first = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))
        times = np.diff(np.append(first, len(every)))
        count = np.repeat(np.minimum(times, 65535).astype("<u2"), times)
        many = count > 1
        order, every, count = order[many], every[many], count[many]
        back = np.argsort(sender[order], kind="stable")
        order, every, count = order[back], every[back], count[back]
        bounds = np.searchsorted(sender[order], np.arange(len(senders) + 1))
        for k, chunk in enumerate(senders):
            a, b = int(bounds[k]), int(bounds[k + 1])
            if b > a:
                body = every[a:b].astype("<u8").tobytes() + place[order[a:b]].astype("<u2").tobytes() + count[a:b].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk], pa.int64()), pa.array([b - a], pa.int32()), pa.array([body], pa.binary())], names=names)

    return sent.groupBy("owner").applyInArrow(work, "chunk long, shared int, body binary")
