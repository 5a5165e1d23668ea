"""Token counts with a shortcut for whole words.

The vocabulary is examined once per Python worker ("offline"): which strings encode alone as a single token, and at
which characters no merge can ever cross. Texts are cut there; pre-tokens that are proven whole tokens count one
without any merging, and only the remaining distinct ones are merged by the tokenizer, once each.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.functions.columns import ref

SPACE = "▁"  # what the vocabulary writes for a space
KNOWN = 400_000  # merged pre-tokens remembered by one worker
ROWS = 500  # texts whose new pre-tokens are merged together


class PieceCounter(dict):
    """Token count of each pre-token, filled on demand.

    A pre-token is the text after a space up to the next one. That cut is safe because no vocabulary entry has a
    space behind another character, so no merge can cross it; the same holds on both sides of a character that is in
    no entry of two or more characters. Both are read off the vocabulary, not assumed.
    """

    def __init__(self, model: str) -> None:
        import sentencepiece

        super().__init__()
        self.tails: dict[str, int] = {}
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=model)
        normal = range(self.pieces.get_piece_size())
        vocabulary = [self.pieces.id_to_piece(i) for i in normal
                      if not (self.pieces.is_control(i) or self.pieces.is_unknown(i) or self.pieces.is_byte(i))]
        if any(SPACE in p.lstrip(SPACE) for p in vocabulary):
            raise ValueError("a vocabulary entry crosses a space: texts cannot be cut there")
        if self.pieces.encode("\n", out_type=str)[:1] != [SPACE] or self.pieces.encode("x  y", out_type=str) == \
                self.pieces.encode("x y", out_type=str):
            raise ValueError("the model does not prefix a space or drops repeated spaces")
        inner = set("".join(p for p in vocabulary if len(p) > 1))
        self.lines = "\n" not in inner  # a line feed takes part in no merge: texts are cut there too
        self.line_feed = len(self.pieces.encode("\n")) - 1
        words = [p[1:] for p in vocabulary if p.startswith(SPACE) and len(p) > 1 and p[1] != SPACE]
        self.whole = {w: 1 for w, ids in zip(words, self.pieces.encode(words)) if len(ids) == 1}
        self.update(self.whole)

    def learn(self, words: set[str]) -> None:
        """Merge the pre-tokens that are not known yet, all in one call."""
        new = {w for w in words if w not in self}
        if len(self) + len(new) > max(KNOWN, len(self.whole) + 2 * len(new)):
            self.clear()
            self.update(self.whole)
            self.tails.clear()
            new = {w for w in words if w not in self}
        plain = [w for w in new if not (self.lines and "\n" in w)]
        broken = [w.split("\n") for w in new if self.lines and "\n" in w]
        plain += {first for first, *_ in broken if first not in self and first not in new}
        self.update(zip(plain, (len(ids) if w else 1 for w, ids in zip(plain, self.pieces.encode(plain)))))
        # What follows a line feed has no space in front: it is encoded behind one, which is then taken off.
        tails = list({r for _, *rest in broken for r in rest if r and r not in self.tails})
        less = 1 + self.line_feed
        self.tails.update(zip(tails, (len(ids) - less for ids in self.pieces.encode(["\n" + r for r in tails]))))
        for first, *rest in broken:
            self["\n".join((first, *rest))] = self[first] + sum(self.line_feed + (self.tails[r] if r else 0) for r in rest)

    def __missing__(self, word: str) -> int:
        self.learn({word})
        return self[word]

    def counts(self, texts: list[str | None]) -> list[int]:
        split = [None if self.runs(t) else t.replace(SPACE, " ").split(" ") for t in (t or "" for t in texts)]
        words: set[str] = set()
        for w in split:
            words.update(w or ())
        self.learn(words)
        return [self.spaced(t.replace(SPACE, " ")) if w is None else 0 if not t else sum(map(self.__getitem__, w))
                for t, w in zip(texts, split)]

    @staticmethod
    def runs(text: str) -> bool:
        """Whether a space begins or ends the text or follows another; then pre-tokens are not just words."""
        text = text.replace(SPACE, " ") if SPACE in text else text
        return bool(text) and ("  " in text or text[0] == " " or text[-1] == " ")

    def spaced(self, text: str) -> int:
        """Runs of spaces belong to the word behind them, so they are encoded together with it."""
        total, run = 0, 0
        for i, word in enumerate(text.split(" ")):
            if word:
                if run == 0:
                    total += self[word]
                else:
                    first, feed, rest = word.partition("\n") if self.lines else (word, "", "")
                    total += len(self.pieces.encode(" " * run + first))
                    if feed:
                        total += self["\n" + rest] - self[""]
                run = 0
            else:
                run += 1
        # A text that ends in spaces has one empty word more than it has spaces behind the last word.
        return total + (len(self.pieces.encode(" " * (run - 1))) if run > 1 else 1 if run else 0)


def count_tokens(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """``id_col``, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of each row's whole text.

    ``model`` is a sentencepiece BPE model file, readable where tasks run. NULL and empty texts have no bytes and no
    tokens. One row comes out for each row that goes in, repeated and NULL ids included; other columns are not read.
    A model whose vocabulary does not allow the cuts raises ValueError.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(model)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                n = pa.array(counter.counts(part.column(2).to_pylist()), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), n], names=["id", "n_bytes", "n_tokens"])

    text = F.coalesce(ref(text_col), F.lit(""))
    rows = df.select(ref(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), ref(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    counted = rows.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
