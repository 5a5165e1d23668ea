"""URL rules as one bit-parallel wildcard automaton.

All glob rules are packed side by side into 64-bit words, one bit for each pattern position. A canonical URL
(lower-cased host followed by its path) is read byte by byte; one shift, two masks and an or move every pattern
at once. Urls of a batch advance together, so the work per byte is a few vector operations.

Globs: ``*`` is any run of bytes without ``/``, ``**`` any run, ``?`` one byte other than ``/``; a glob must match
the whole canonical URL.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.functions.columns import ref
from lacuna.llm.text import column_bytes

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BATCH = 4096


@dataclass(frozen=True)
class Rule:
    """A rule's name, its verdict and the globs that stand for it; a fallback only judges what no other rule fits."""

    name: str
    verdict: str
    globs: tuple[str, ...]
    fallback: bool = False


def host_rule(name: str, verdict: str) -> Rule:
    """``host/path``: the host and all its subdomains, if the URL's path starts with the rule's."""
    return Rule(name, verdict, (f"{name}**", f"*.{name}**"))


def host_glob(glob: str, verdict: str) -> Rule:
    """A fallback for hosts that match ``glob``, whatever their path."""
    return Rule(glob, verdict, (glob, f"{glob}/**"), fallback=True)


class Automaton:
    """Masks of all globs: which bits a byte lets through, which bits it lets stay."""

    def __init__(self, globs: Sequence[str]) -> None:
        bits: list[tuple[str, int]] = []  # (what enters the position: a byte, "?" or "" for a start; pattern)
        loops: dict[int, bool] = {}  # position: whether its loop takes "/" as well
        self.last: list[int] = []
        starts = []
        for k, glob in enumerate(globs):
            starts.append(len(bits))
            bits.append(("", k))
            i, raw = 0, glob.encode()
            while i < len(raw):
                c = raw[i:i + 1]
                if c == b"*":
                    deep = raw[i:i + 2] == b"**"
                    loops[len(bits) - 1] = loops.get(len(bits) - 1, False) or deep
                    i += 2 if deep else 1
                    continue
                bits.append(("?" if c == b"?" else f"={c[0]}", k))
                i += 1
            self.last.append(len(bits) - 1)
        self.words = (len(bits) + 63) // 64
        self.enter = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        self.begin = np.zeros(self.words, np.uint64)

        def put(mask: np.ndarray, position: int) -> None:
            mask[..., position // 64] |= np.uint64(1) << np.uint64(position % 64)

        for position in starts:
            put(self.begin, position)
        slash = ord("/")
        for position, (what, _) in enumerate(bits):
            if what == "?":
                put(self.enter[:slash], position)
                put(self.enter[slash + 1:], position)
            elif what:
                put(self.enter[int(what[1:])], position)
            if position in loops:
                put(self.stay[:slash], position)
                put(self.stay[slash + 1:], position)
                if loops[position]:
                    put(self.stay[slash], position)

    def run(self, urls: list[bytes]) -> np.ndarray:
        """For each URL and glob, whether the whole URL matches."""
        size = np.array([len(u) for u in urls], np.int64)
        order = np.argsort(-size, kind="stable")
        size = size[order]
        data = np.frombuffer(b"".join(urls) + b"\0", np.uint8)
        offset = np.concatenate(([0], np.cumsum([len(u) for u in urls])))[order]
        state = np.repeat(self.begin[None, :], len(urls), axis=0)
        one, top = np.uint64(1), np.uint64(63)
        for column in range(int(size[0]) if len(size) else 0):
            active = int(np.searchsorted(-size, -column, side="left"))  # urls longer than this column come first
            byte = data[offset[:active] + column]
            now = state[:active]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            state[:active] = (moved & self.enter[byte]) | (now & self.stay[byte])
        out = np.zeros((len(urls), len(self.last)), bool)
        for k, position in enumerate(self.last):
            out[order, k] = (state[:, position // 64] >> np.uint64(position % 64)) & one
        return out


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def filter_urls(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url",
                default: str = "allow") -> DataFrame:
    """Judge every URL: ``id_col``, host, path, rule, verdict, fallback.

    Of the rules that match, the one with the longest name wins, then the one listed first. If none does, ``rule`` is NULL
    and the fallbacks decide in the same way (``fallback`` names the one that did); then the verdict is ``default``. That
    also holds for NULL, empty and malformed URLs, whose host and path are empty. One row comes out for each row that goes in, repeated and NULL ids included; other columns
    are not read. The rules travel with the tasks; their masks take 4 KB for 64 pattern positions.
    """
    ranked = sorted(enumerate(rules), key=lambda x: (x[1].fallback, -len(x[1].name), x[0]))
    globs = [g for _, r in ranked for g in r.globs]
    owner = np.array([k for k, (_, r) in enumerate(ranked) for _ in r.globs], np.int64)
    names = [None if r.fallback else r.name for _, r in ranked] + [None]
    fallbacks = [r.name if r.fallback else None for _, r in ranked] + [None]
    verdicts = [r.verdict for _, r in ranked] + [default]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(globs)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                urls = [a + b for a, b in zip(column_bytes(batch.column(1)), column_bytes(batch.column(2)))]
                hits = automaton.run(urls)
                best = np.where(hits.any(axis=1), owner[hits.argmax(axis=1)], len(ranked)) if globs else \
                    np.full(len(urls), len(ranked))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array([names[k] for k in best], pa.string()),
                     pa.array([verdicts[k] for k in best], pa.string()), pa.array([fallbacks[k] for k in best], pa.string())],
                    names=["id", "host", "path", "rule", "verdict", "fallback"])

    url = ref(url_col)
    parts = pages.select(ref(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    kind = parts.schema["id"].dataType.simpleString()
    judged = parts.mapInArrow(judge, f"id {kind}, host string, path string, rule string, verdict string, fallback string")
    return judged.withColumnRenamed("id", id_col)
