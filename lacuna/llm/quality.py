"""Quality classifier: a linear support vector machine over naive-Bayes-scaled n-gram indicators.

Features are indicators of n-grams, hashed into ``BUCKETS``: single words, and one to three consecutive word shapes (which
kinds of characters a word has, and whether it repeats the word before it). Each indicator is scaled by its log-count
ratio between the classes; the hinge loss is minimised by dual coordinate descent.

Class counts cover all labelled training rows, each task sums its own and only bucket sums are shuffled. The support
vectors come from at most ``sample`` training rows (those of smallest hash of each class), fitted in one task. The model is two arrays of
``BUCKETS`` numbers, whatever the corpus size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.functions.columns import ref
from lacuna.functions.durable import durable
from lacuna.llm.tables import checked
from lacuna.llm.text import NOT_WHITE, chunks, column_bytes, hash_ranges, join_texts, mix, slices, word_ranges

BUCKETS = 1 << 18
SAMPLE = 12_000
LABELS_BROADCAST = 500_000
PIECES = 16  # parts that a count vector is summed in
EPOCHS = 12
COST = 1.0

#: Kinds of characters that make a word's shape; each kind is one bit.
_KINDS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".", ",", "!", "?", "#", "$", "%", "&", "*", "|",
          ":;\"'()-")
_SHAPE = np.zeros(256, np.uint16)
_SHAPE[0x80:] = 1 << 14
_SHAPE[0x21:0x7F] = 1 << 15
for _bit, _chars in enumerate(_KINDS):
    _SHAPE[list(_chars.encode())] = 1 << _bit
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def features(texts: list[bytes]) -> list[np.ndarray]:
    """The distinct feature buckets of each text; none for a text without words."""
    data, first = join_texts(texts, lower=False)
    starts, ends = word_ranges(data, NOT_WHITE)
    if not len(starts):
        return [np.zeros(0, np.int64) for _ in texts]
    bounds = np.concatenate((np.searchsorted(starts, first), [len(starts)]))
    words = hash_ranges(data, starts, ends - starts)
    shape = np.bitwise_or.reduceat(_SHAPE[data], starts).astype(np.uint64)
    same = np.zeros(len(words), bool)
    same[1:] = words[1:] == words[:-1]
    same[bounds[:-1][bounds[:-1] < len(words)]] = False
    shape |= same.astype(np.uint64) << np.uint64(17)
    top = np.uint64(64 - 18)
    pad = np.concatenate((shape, np.zeros(2, np.uint64)))
    one = pad[:-2] * _ODD[0]
    two = one + pad[1:-1] * _ODD[1]
    three = two + pad[2:] * _ODD[2]
    hashed = [(mix(x + np.uint64(k)) >> top).astype(np.int64) for k, x in ((1, words), (2, one), (3, two), (4, three))]
    out, last = [], np.zeros(BUCKETS, np.int64)
    for a, b in zip(bounds[:-1], bounds[1:]):
        found = np.concatenate([h[a:max(a, b - less)] for h, less in zip(hashed, (0, 0, 1, 2))])
        position = np.arange(len(found))
        last[found] = position
        out.append(found[last[found] == position])
    return out


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # of each bucket, log-count ratio included
    slope: float
    offset: float

    def margin(self, found: np.ndarray) -> float:
        return float(self.weights[found].sum()) / max(1.0, len(found)) ** 0.5

    def score(self, found: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(found) + self.offset, -60, 60))))


def descend(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, epochs: int = EPOCHS, cost: float = COST) -> np.ndarray:
    """Weights (over scaled indicators) that minimise the hinge loss; rows are feature buckets, y is -1 or 1.

    Dual coordinate descent: each row's multiplier is moved to its optimum within [0, C], rows in a fixed random order;
    C is weighted so that both classes count the same. A last constant feature takes the bias.
    """
    w = np.zeros(len(ratio) + 1)
    values = [np.append(ratio[r], 1.0) / max(1.0, len(r)) ** 0.5 for r in rows]
    index = [np.append(r, len(ratio)) for r in rows]
    norm = np.array([float(v @ v) for v in values])
    positive = max(1, int((y > 0).sum()))
    limit = np.where(y > 0, cost * len(y) / (2 * positive), cost * len(y) / (2 * max(1, len(y) - positive)))
    alpha = np.zeros(len(y))
    random = np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in random.permutation(len(y)):
            if norm[i] == 0:
                continue
            gradient = y[i] * float(w[index[i]] @ values[i]) - 1
            new = min(max(alpha[i] - gradient / norm[i], 0.0), limit[i])
            if new != alpha[i]:
                w[index[i]] += (new - alpha[i]) * y[i] * values[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


def calibrate(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through the margins, both classes counting the same."""
    target = (y > 0).astype(float)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum()))
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -30, 30)))
        error, h = weight * (p - target), weight * p * (1 - p) + 1e-9
        g = np.array([error @ margins + 1e-3 * slope, error.sum()])
        hess = np.array([[h @ margins ** 2 + 1e-3, h @ margins], [h @ margins, h.sum() + 1e-6]])
        step = np.linalg.solve(hess, g)
        slope, offset = slope - step[0], offset - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return max(float(slope), 1e-3), float(offset)


def fit(counts: np.ndarray, rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """Model from the class counts of all buckets (2 x BUCKETS) and the sampled rows; needs rows of both classes."""
    p, q = counts[1] + 1.0, counts[0] + 1.0
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    ratio[counts.sum(axis=0) == 0] = 0.0
    y = np.where(labels > 0, 1.0, -1.0)
    w = descend(rows, y, ratio)
    weights = ratio * w[:-1]
    model = Model(weights, 1.0, 0.0)
    margins = np.array([model.margin(r) for r in rows])
    return Model(weights, *calibrate(margins, y))


def held_out(id_col: str = "doc_id"):
    """Rows whose labels must not be learnt: crc32 of the id as text leaves remainder 1 by 3."""
    return F.coalesce(F.crc32(F.encode(ref(id_col).cast("string"), "utf-8")) % 3 == 1, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          sample: int = SAMPLE) -> Model | float:
    """Fit on the labelled rows that are not held out; a plain number if they have no or only one label.

    Labels other than 0 and 1 and NULL ids are ignored; a repeated id counts as often as it is labelled. ``sample``
    bounds the rows that the support vectors come from; the class counts use all. They are drawn from the rows of
    ``documents`` that are labelled, half from each class, or more from one if the other has fewer.
    """
    known = labels.where(ref(label_col).isin(0, 1) & ref(id_col).isNotNull()).where(~held_out(id_col)).select(
        ref(id_col).alias("id"), ref(label_col).cast("int").alias("label"), F.xxhash64(ref(id_col), F.lit(5)).alias("draw"))
    drawn = durable(documents.select(ref(id_col).alias("id")).join(checked(known, LABELS_BROADCAST), "id").select("label", "draw"))
    count = {r["label"]: r["count"] for r in drawn.groupBy("label").count().collect()}
    if len(count) < 2:
        return float(next(iter(count), 0.5))
    sampled = F.lit(False)
    for label, other in ((0, 1), (1, 0)):
        share = max(1, sample // 2, sample - count[other])
        if count[label] > share:
            last = drawn.where(F.col("label") == label).select("draw").orderBy("draw").limit(share).agg(F.max("draw")).first()[0]
            sampled |= (F.col("label") == label) & (F.col("draw") <= last)
        else:
            sampled |= F.col("label") == label
    marked = known.withColumn("sampled", sampled).drop("draw")
    rows = documents.select(ref(id_col).alias("id"), ref(text_col).alias("text")).join(checked(marked, LABELS_BROADCAST), "id").select(
        "label", "sampled", "text")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sampled rows as features, and at the end this task's class counts in pieces."""
        counts = np.zeros((2, BUCKETS), np.int64)
        seen = False
        names = ["piece", "label", "body"]
        for batch in slices(batches):
            label, sampled = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            texts = column_bytes(batch.column(2))
            for s in chunks(texts):
                found = features(texts[s])
                keep = []
                for row, f in enumerate(found, s.start):
                    counts[label[row], f] += 1
                    seen = True
                    if sampled[row]:
                        keep.append((int(label[row]), f.astype("<u4").tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([-1] * len(keep), pa.int32()), pa.array([k for k, _ in keep], pa.int32()),
                     pa.array([b for _, b in keep], pa.binary())], names=names)
        if seen:
            cut = counts.reshape(2, PIECES, -1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(PIECES), 2), pa.int32()), pa.array(np.repeat([0, 1], PIECES), pa.int32()),
                 pa.array([cut[c, k].astype("<i8").tobytes() for c in (0, 1) for k in range(PIECES)], pa.binary())], names=names)

    def add(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sum of one piece of the counts; sampled rows pass."""
        piece, label = key[0].as_py(), key[1].as_py()
        total = None
        for b in parts:
            if piece < 0:
                yield b
                continue
            for body in b.column(2).to_pylist():
                total = np.frombuffer(body, "<i8") if total is None else total + np.frombuffer(body, "<i8")
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([label], pa.int32()),
                                              pa.array([total.astype("<i8").tobytes()], pa.binary())], names=["piece", "label", "body"])

    def solve(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, PIECES, BUCKETS // PIECES), np.int64)
        found, y = [], []
        for b in parts:
            for piece, label, body in zip(*(c.to_pylist() for c in b.columns)):
                if piece >= 0:
                    counts[label, piece] = np.frombuffer(body, "<i8")
                else:
                    found.append(np.frombuffer(body, "<u4").astype(np.int64))
                    y.append(label)
        # The rows arrive in any order; the fit must not depend on it.
        order = sorted(range(len(y)), key=lambda i: (y[i], len(found[i]), found[i].tobytes()))
        model = fit(counts.reshape(2, -1), [found[i] for i in order], np.array([y[i] for i in order]))
        numbers = np.concatenate((model.weights, [model.slope, model.offset]))
        yield pa.RecordBatch.from_arrays([pa.array([numbers.astype("<f8").tobytes()], pa.binary())], names=["model"])

    # The piece keys bound the groups: PIECES per class, and the sampled rows, at most ``sample``, one group per class.
    summed = rows.mapInArrow(gather, "piece int, label int, body binary").groupBy("piece", "label").applyInArrow(
        add, "piece int, label int, body binary")
    body = summed.coalesce(1).mapInArrow(solve, "model binary").first()[0]
    numbers = np.frombuffer(body, "<f8")
    return Model(numbers[:-2].copy(), float(numbers[-2]), float(numbers[-1]))


def score_quality(documents: DataFrame, model: Model | float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, held_out, score (0 to 1, higher: label 1 likelier) and predicted (score >= 0.5).

    Empty and NULL texts get the score of a text without features. A NULL id is not held out. One row for each row
    that goes in, repeated ids included; other columns are not read.
    """

    def work(batches: Iterator[pa.RecordBatch], m: Model | float = model) -> Iterator[pa.RecordBatch]:
        # The model comes with the function: BUCKETS numbers, whatever the corpus size.
        for batch in slices(batches):
            texts = column_bytes(batch.column(2))
            for s in chunks(texts):
                scores = [m if isinstance(m, float) else m.score(f) for f in features(texts[s])]
                n = s.stop - s.start
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s.start, n), batch.column(1).slice(s.start, n), pa.array(scores, pa.float64()),
                     pa.array([int(x >= 0.5) for x in scores], pa.int32())], names=["id", "held_out", "score", "predicted"])

    rows = documents.select(ref(id_col).alias("id"), held_out(id_col).alias("held_out"), ref(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(work, f"id {kind}, held_out boolean, score double, predicted int").withColumnRenamed("id", id_col)


def keep_quality(documents: DataFrame, model: Model | float, text_col: str = "text") -> DataFrame:
    """The rows whose text is not rejected (score >= 0.5), all columns as they are; rows are judged where they are read."""
    at = documents.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch], m: Model | float = model) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = column_bytes(batch.column(at))
            for s in chunks(texts):
                good = [(m if isinstance(m, float) else m.score(f)) >= 0.5 for f in features(texts[s])]
                yield batch.slice(s.start, s.stop - s.start).filter(pa.array(good, pa.bool_()))

    return documents.mapInArrow(work, documents.schema)
