"""Secrets in text: known forms, and high-entropy strings by a sliding window.

Candidate strings are maximal runs of key characters, cut at the ``=`` before a value and at the slashes of paths; a
slash within base64 is no cut. A window of ``WINDOW`` characters slides over each; the counts of the two characters that
enter and leave update the sum of ``c * log2(c)``, from which the window's Shannon entropy follows in constant time. Each
window has the first character class (lower-case hex, upper-case hex, mixed) that holds all of it, with a threshold of its
own; windows above it are merged to spans by kind. Candidates whose whole form is on the allow-list are left alone, and so are windows
that touch a placeholder word; neither depends on what else a long candidate holds.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lacuna.functions.columns import ref
from lacuna.llm.text import chunks, column_bytes, slices, word_ranges

KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_mixed")
BASE = 3  # the first kinds are the known forms
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24
WINDOW = 20

#: Candidates that look random but are no secret: UUIDs, digits only, words or numbers joined by hyphens, and the key of many manuals.
ALLOWED = (
    r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", r"[0-9_+/=-]+",
    r"(?:(?:[A-Z]?[a-z]{1,16}|[A-Z]{1,16}|[0-9]{1,12})[-_]){2,}(?:[A-Z]?[a-z]{1,16}|[A-Z]{1,16}|[0-9]{1,12})", r"[A-Za-z0-9+/]{0,33}EXAMPLE(?:KEY)?",
)
#: Words that no window may touch: placeholders and alphabets. What else a candidate holds is judged without them.
PLACEHOLDERS = re.compile(r"example|placeholder|changeme|dummy|x{4,}|0123456789|abcdefghij", re.I)
#: Segments between slashes as paths have them, and the bits per character by which random base64 is unlikelier to have them.
#: Standard base64 has no hyphens and underscores.
SEGMENTS = tuple((re.compile(p), bits) for p, bits in (
    (r"[0-9]+", 2.6), (r"[A-Z]?[a-z]+|[A-Z]+", 1.25), (r"[a-z0-9]+|[A-Z0-9]+", 0.8), (r"(?:[A-Z]?[a-z]{2,}|[A-Z]{2,}|[0-9]+)*", 0.0)))
SLASH_BITS, PATH_BITS = 3.0, 10.0  # of one more slash; from which neighbouring segments are a path
_VALUES = re.compile(r"=+(?=[^=]{20})")  # a shorter value holds no window of its own and stays with its name
_TOKEN = re.compile(r"(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9+=]{12,}")
_HEX_RUNS = tuple(re.compile(f"[{chars}]{{20,}}") for chars in ("0-9a-f", "0-9A-F"))
_HOST, _HOST_END = re.compile(rb"[A-Za-z0-9-]\.$"), re.compile(r"[a-z]{2,10}/")


@dataclass(frozen=True)
class CharClass:
    """Characters of a window of this class, the least entropy in bits, and whether digits and letters must mix."""

    kind: str
    members: str
    bits: float


CLASSES = (
    CharClass("entropy_hex", "0123456789abcdef", 3.0),
    CharClass("entropy_hex", "0123456789ABCDEF", 3.0),
    CharClass("entropy_mixed", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=", 3.75),
)


def _member(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_URL_STOP = _member(" \t\n\r\f\v?#\"'<>")
_HEX, _KEY, _DIGIT = _member(CLASSES[0].members), _member(CLASSES[2].members), _member("0123456789")
_F = [0.0] + [c * math.log2(c) for c in range(1, 4096)]


def windows_above(text: str, bits: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """Maximal spans covered by windows with a digit, a letter and an entropy of at least ``bits``."""
    counts: dict[str, int] = {}
    total = digits = letters = 0.0
    spans: list[list[int]] = []
    for i, c in enumerate(text):
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += _F[n + 1] - _F[n]
        digits += c.isdigit()
        letters += c.isalpha()
        if i >= window:
            old = text[i - window]
            n = counts[old]
            counts[old] = n - 1
            total += _F[n - 1] - _F[n]
            digits -= old.isdigit()
            letters -= old.isalpha()
        if i >= window - 1 and digits and letters and math.log2(window) - total / window >= bits - 1e-9:
            if spans and i - window + 1 <= spans[-1][1]:
                spans[-1][1] = i + 1
            else:
                spans.append([i - window + 1, i + 1])
    return [(a, b) for a, b in spans]


def merged(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans with those of one kind that overlap or touch made one."""
    out: dict[str, list[list[int]]] = {}
    for kind, a, b in sorted(spans):
        own = out.setdefault(kind, [])
        if own and a <= own[-1][1]:
            own[-1][1] = max(own[-1][1], b)
        else:
            own.append([a, b])
    return [(kind, a, b) for kind, own in out.items() for a, b in own]


def class_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the windows of a candidate, each judged by the first class that has all its characters."""
    hexes = sorted(m.span() for p in _HEX_RUNS for m in p.finditer(text))
    spans = [(CLASSES[0].kind, a + s, a + e) for a, b in hexes for s, e in windows_above(text[a:b], CLASSES[0].bits)]
    at = 0
    for a, b in [*hexes, (len(text), len(text))]:
        # Windows that lie in no run of hex digits: they start before this run and end after the last one.
        until = min(len(text), a + WINDOW - 1)
        spans += [(CLASSES[2].kind, at + s, at + e) for s, e in windows_above(text[at:until], CLASSES[2].bits)]
        at = max(at, b - WINDOW + 1)
    return merged(spans)


def candidates(run: str, in_url: bool) -> Iterator[tuple[int, str]]:
    """Offset and text of the parts of a run that are judged alone: it is cut at ``=`` before a value and at path slashes.

    All slashes in a URL are cuts. Elsewhere a chain of segments that paths have is cut off if random base64 is
    unlikely to have it. What has one or two slashes and only parts
    too short for a window is judged as a whole if one of them may be a token.
    """
    bounds = [(0, 0), *(m.span() for m in _VALUES.finditer(run)), (len(run), len(run))]
    for (_, start), (end, _) in zip(bounds, bounds[1:]):
        value = run[start:end]
        parts = list(_path_parts(value, in_url)) if "/" in value else [(0, value)]
        if value.count("/") < 3 and all(len(part) < WINDOW for _, part in parts) and any(_TOKEN.fullmatch(part) for _, part in parts):
            parts = [(0, value)]
        yield from ((start + at, part) for at, part in parts)


def _path_parts(value: str, in_url: bool) -> Iterator[tuple[int, str]]:
    segments = value.split("/")
    cut = [in_url] * len(segments)
    chain, total = [], 0.0
    for k, segment in enumerate([*segments, None]):
        bits = None if segment is None else _path_bits(segment)
        if bits is not None:
            chain.append(k)
            total += bits + SLASH_BITS
            continue
        if total >= PATH_BITS:
            for c in chain:
                cut[c] = True
        chain, total = [], 0.0
    at = first = 0
    part: list[str] = []
    for segment, alone in zip(segments, cut):
        if alone and part:
            yield first, "/".join(part)
            part = []
        if alone:
            yield at, segment
        else:
            first = first if part else at
            part.append(segment)
        at += len(segment) + 1
    if part:
        yield first, "/".join(part)


def _path_bits(segment: str) -> float | None:
    """By how much likelier a path has this segment than random base64; None if paths do not have it."""
    if "-" in segment or "_" in segment:
        return PATH_BITS
    return next((bits * len(segment) for p, bits in SEGMENTS if p.fullmatch(segment)), None)


class Scanner:
    def __init__(self, allowed: Sequence[str]) -> None:
        self.allowed = [re.compile(p) for p in allowed]

    def runs(self, texts: list[bytes], member: np.ndarray, least: int, need_digit: bool) -> list[list[tuple[int, int]]]:
        """Per text, the byte ranges of runs of ``member`` bytes of at least ``least`` bytes."""
        out: list[list[tuple[int, int]]] = [[] for _ in texts]
        data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        first = np.cumsum([0] + [len(t) + 1 for t in texts])
        starts, ends = word_ranges(data, member)
        long = ends - starts >= least
        starts, ends = starts[long], ends[long]
        for a, b, k in zip(starts.tolist(), ends.tolist(), (np.searchsorted(first, starts, "right") - 1).tolist()):
            if not need_digit or _DIGIT[data[a:b]].any():
                out[k].append((a - int(first[k]), b - int(first[k])))
        return out

    def entropy(self, raw: bytes, runs: list[tuple[int, int]]) -> Iterator[tuple[str, int, int]]:
        """Spans of the runs of a text, each candidate in them judged by itself."""
        urls = self.in_urls(raw, runs)
        for (a, b), in_url in zip(runs, urls):
            run = raw[a:b].decode()
            for at, found in candidates(run, in_url):
                if len(found) < WINDOW or any(p.fullmatch(found.rstrip("=")) for p in self.allowed):
                    continue
                edges = [0, *(x for m in PLACEHOLDERS.finditer(found) for x in m.span()), len(found)]
                for s, e in zip(edges[::2], edges[1::2]):
                    if e - s >= WINDOW:
                        yield from ((kind, a + at + s + x, a + at + s + y) for kind, x, y in class_spans(found[s:e]))

    def in_urls(self, raw: bytes, runs: list[tuple[int, int]]) -> list[bool]:
        """Whether each run with a slash is in a URL: its scheme is somewhere before, with nothing between that ends a URL."""
        slashed = [b"/" in raw[a:b] for a, b in runs]
        if not any(slashed):
            return slashed
        data = np.frombuffer(raw, np.uint8)
        stops = np.flatnonzero(_URL_STOP[data])
        schemes = np.flatnonzero((data[:-2] == 0x3A) & (data[1:-1] == 0x2F) & (data[2:] == 0x2F)) if len(data) > 2 else stops[:0]
        out = []
        for (a, b), slash in zip(runs, slashed):
            found = False
            if slash:
                k = int(np.searchsorted(schemes, a - 3, "right"))
                last = int(np.searchsorted(stops, a, "left"))
                found = k > 0 and (last == 0 or stops[last - 1] < schemes[k - 1] + 3)
                run = raw[a:b]
                found = found or a > 0 and raw[a - 1:a] == b":" and run.startswith(b"//")
                found = found or bool(_HOST_END.match(run.decode()) and _HOST.search(raw[max(0, a - 2):a]))
            out.append(found)
        return out

    def scan(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """Per text: (start, kind's index, end) in code points, sorted."""
        out = []
        hexes, keys = self.runs(texts, _HEX, HEX_LENGTH, False), self.runs(texts, _KEY, WINDOW, True)
        for raw, hex_runs, key_runs in zip(texts, hexes, keys):
            spans: list[tuple[int, int, int]] = []
            if b":" in raw or b"=" in raw or b"AKIA" in raw:
                text = raw.decode()
                spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= ASSIGN_VALUE]
                spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH]
            found = [(a, 2, b) for a, b in hex_runs]
            found += [(s, KINDS.index(kind), e) for kind, s, e in self.entropy(raw, key_runs)]
            if found and not raw.isascii():
                found.sort()
                at = points = 0
                moved = []
                for a, kind, b in found:
                    points += len(raw[at:a].decode())
                    at = a
                    moved.append((points, kind, points + b - a))
                found = moved
            out.append(sorted(spans + found))
        return out


def write_spans(spans: Sequence[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", allowed: Sequence[str] = ALLOWED) -> DataFrame:
    """``id_col``, n_assign, n_access, n_hex, n_entropy, base_sha256 and spans of each row's whole text.

    ``spans`` lists kind:start:end (code points, end exclusive) by start, then kind, joined by commas; ``base_sha256`` is
    the digest of the same list of the known forms alone. NULL and empty texts have none. One row for each row that
    goes in, NULL and repeated ids included; other columns are not read.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(allowed)
        for batch in slices(batches):
            texts = column_bytes(batch.column(1))
            for s in chunks(texts):
                found = scanner.scan(texts[s])
                count = [[sum(k == kind for _, k, _ in f) for f in found] for kind in range(BASE)]
                more = [sum(k >= BASE for _, k, _ in f) for f in found]
                digest = [hashlib.sha256(write_spans([x for x in f if x[1] < BASE]).encode()).hexdigest() for f in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s.start, s.stop - s.start), *(pa.array(c, pa.int64()) for c in (*count, more)),
                     pa.array(digest, pa.string()), pa.array([write_spans(f) for f in found], pa.string())],
                    names=["id", "n_assign", "n_access", "n_hex", "n_entropy", "base_sha256", "spans"])

    rows = df.select(ref(id_col).alias("id"), ref(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(work, f"id {kind}, n_assign long, n_access long, n_hex long, n_entropy long, "
                                 "base_sha256 string, spans string").withColumnRenamed("id", id_col)
