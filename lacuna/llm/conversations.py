"""Faults of conversations, and the cheapest edits that give them the structure of a dialogue.

A sound conversation has role initials ``(s?(ua)+)?``. Each turn is Kept, Reroled to user or assistant, or Deleted; turns
without text may be Inserted. Which edits are cheapest, and which of equally cheap ones come first, is one question
to integers: a way through the rows weighs ``cost`` in its high digits and its letters in the low ones, one digit of fixed
place for each letter, the first letter highest, zeros behind the last. The smaller integer is the cheaper way, or
the one whose letters come first, so the plain minimum over the ways into each (row, state) decides everything.

The numbers must not grow with the conversation. Rows are therefore taken in blocks, from the last to the first. A block
needs of all that follows it only each state's cost, and the order of the states' further letters, which is the lowest
digit of its weights. This is exact, as ways through the same rows never are one another's beginnings: inserted turns
belong to the row behind them, so every way ends in a row's own letter.

Two passes: a thin one (a digest and a few flags for each row, no text) finds the edits; the texts then stream
through a sorted partition behind their conversation's edits. A task holds a few letters for each row of one
conversation, never its texts. A conversation is one task's work in both, as its audit is one cell and its hash one chain.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lacuna.functions.columns import literal, ref

#: Costs of edits, of an undeleted truncated turn, and the letters in the order of their digits 1 to 4.
RETYPE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
LETTERS = "\0DIKR"
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
ENDS = (".", "!", "?")
#: Rows of a conversation that are decided together; the width of the integers, not the result, follows it.
BLOCK_ROWS = 48
#: Ties of turn and role are ordered by the text's first characters, then by its digest.
HEAD = 32

D, I, K, R = 1, 2, 3, 4
# States: nothing so far, after a system turn, after a user, after an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where a user or assistant turn, whichever is due, leads.
DUE = (USER, USER, ASSISTANT, USER)
#: Where a kept turn of the initial s, u or a (1, 2, 3) leads from a state.
KEPT = ({}, {START: SYSTEM}, {START: USER, SYSTEM: USER, ASSISTANT: USER}, {USER: ASSISTANT})
#: What closes a conversation that has no more rows: how many inserted turns.
CLOSING = (0, 2, 1, 0)
INITIAL, BAD, CUT = 3, 4, 8  # bits of a row's code: its initial's number, must be deleted, truncated


def block_edits(codes: bytes, tail: list[tuple[int, int]]) -> list[tuple[int, int, str, int]]:
    """For each state before the rows ``codes``: cost, order, letters of the best way through them and the state behind.

    ``tail`` has, for each state behind them, the cost of what follows and the order of its letters.
    """
    digits = 3 * 3 * len(codes)  # three letters a row at most: two inserted turns and its own
    width = digits + 2
    low, top = (1 << digits) - 1, 3 * (3 * len(codes) - 1) + 2

    def step(letter: int, cost: int, rest: int) -> int:
        """The way ``rest`` behind one more edit: cost added, its letters one digit down."""
        return ((rest >> width) + cost << width) + (letter << top) + (((rest >> 2 & low) >> 3) << 2) + (rest & 3)

    value = [(cost << width) + order for cost, order in tail]
    for code in reversed(codes):
        best = [step(D, DELETE, v) for v in value]
        if not code & BAD:
            cut = TRUNCATED if code & CUT else 0
            kept = KEPT[code & INITIAL]
            for s in range(4):
                best[s] = min(best[s], step(R, RETYPE + cut, value[DUE[s]]))
                if s in kept:
                    best[s] = min(best[s], step(K, cut, value[kept[s]]))
        for _ in range(2):  # up to two inserted turns before the row; more leave the state as it was
            best = [min(best[s], step(I, INSERT, best[DUE[s]])) for s in range(4)]
        value = best
    lows = [v & (1 << width) - 1 for v in value]
    order = {v: k for k, v in enumerate(sorted(set(lows)))}
    out = []
    for s, v in enumerate(value):
        letters, place = [], top
        while place >= 2 and (digit := v >> place & 7):
            letters.append(digit)
            place -= 3
        state, row = s, 0
        for digit in letters:
            if digit == I or digit == R:
                state = DUE[state]
            elif digit == K:
                state = KEPT[codes[row] & INITIAL][state]
            row += digit != I
        out.append((v >> width, order[lows[s]], "".join(LETTERS[d] for d in letters), state))
    return out


def cheapest_edits(codes: bytes, block_rows: int = BLOCK_ROWS) -> tuple[int, str]:
    """Cost and letters of the cheapest edits of a whole conversation, ties to the letters that come first."""
    tail = [(INSERT * n, n) for n in CLOSING]
    blocks = []
    for at in range((len(codes) - 1) // block_rows * block_rows, -1, -block_rows):
        ways = block_edits(codes[at:at + block_rows], tail)
        blocks.append(ways)
        tail = [w[:2] for w in ways]
    state, audit = START, []
    for ways in reversed(blocks):
        _, _, letters, state = ways[state]
        audit.append(letters)
    return tail[START][0], "".join(audit) + "I" * CLOSING[state]


class Replay:
    """Turns of the repaired conversation, as its rows come by."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, START

    def _due(self) -> str:
        self.state = DUE[self.state]
        return "user" if self.state == USER else "assistant"

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield "I", self._due(), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self.state = KEPT[" sua".index(role[0])][self.state]
            yield "K", role, text
        elif letter == "R":
            yield "R", self._due(), text


def _prepared(rows: DataFrame, names: tuple[str, str, str, str], present: Column | None) -> DataFrame:
    """conv, present, turn, role, text, and the last character that is no white space (empty if none)."""
    conv, turn, role, text = names
    out = rows.select(ref(conv).alias("conv"), (F.lit(True) if present is None else F.coalesce(present, F.lit(False))).alias("present"),
                      ref(turn).alias("turn"), F.coalesce(ref(role), F.lit(" ")).alias("role"), F.coalesce(ref(text), F.lit(" ")).alias("text"))
    white = literal(WHITE)
    return out.withColumn("last", F.expr(f"right(trim(TRAILING {white} FROM text), 1)")).withColumns(
        {"head": F.expr(f"left(text, {HEAD})"), "digest": F.unhex(F.sha2("text", 256))})


def _in_order(rows: DataFrame, first: Sequence[str] = (), last: Sequence[str] = ()) -> DataFrame:
    """Each conversation in one partition, its rows in order."""
    order = [F.col("conv").asc_nulls_first(), *first, F.col("turn").asc_nulls_first(), "role", "head", "digest", *last]
    return rows.repartition("conv").sortWithinPartitions(*order)


FAULTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class _Tally:
    """Faults of one conversation, counted as its rows come by in order."""

    def __init__(self) -> None:
        self.codes = bytearray()
        self.first = self.last = self.before = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn: int | None, initial: int, blank: bool, duplicate: bool, cut: bool) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.turns += 1
        if self.before is not None and (self.before, initial) not in ((1, 2), (2, 3), (3, 2)):
            self.illegal += 1
        self.before = initial
        self.blank += blank
        self.duplicate += duplicate and not blank
        cut = cut and not blank and not duplicate
        self.truncated += cut
        self.codes.append(initial | (BAD if blank or duplicate else 0) | (CUT if cut else 0))

    def row(self) -> tuple:
        cost, audit = cheapest_edits(bytes(self.codes))
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def conversation_faults(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                        present: Column | None = None) -> DataFrame:
    """One row per conversation: ``id_col``, gaps, blank, duplicate, truncated, illegal, cost, audit.

    Rows are taken by turn, NULL first, then role, then text. A row's first fault counts: blank (no character but ASCII white
    space), duplicate (role and text of an earlier row of the conversation), truncated (the last such character is none of
    ``.!?``). ``illegal`` counts neighbours whose initials are not su, ua or au; ``gaps`` is the number of turns missing between
    the first and the last one, NULL ones left out. Kept turns cost 0, reroled ones 2, deleted ones 3, inserted ones 2, and a truncated turn
    that stays 1; blank and duplicate ones are deleted. ``audit`` has the initials of the cheapest edits in order, of equally
    cheap ones the least. NULL roles and texts are one space; rows with a NULL id are one conversation; a conversation without
    rows has zeros and an empty audit. With ``present``, rows where it is not true only name their conversation. No rows give
    no rows; other columns are not read.
    """
    prepared = _prepared(rows, (id_col, turn_col, role_col, text_col), present)
    earlier = Window.partitionBy("conv", "present", "role", "digest").orderBy(F.col("turn").asc_nulls_first())
    initial = F.when(F.col("role").startswith("s"), 1).when(F.col("role").startswith("u"), 2).when(F.col("role").startswith("a"), 3).otherwise(0)
    thin = prepared.drop("text").withColumns({"duplicate": F.row_number().over(earlier) > 1, "initial": initial, "blank": F.col("last") == "",
                                              "cut": ~F.col("last").isin(*ENDS)})
    thin = _in_order(thin.select("conv", "present", "turn", "role", "head", "digest", "initial", "blank", "duplicate", "cut"), last=["duplicate"])
    kind = thin.schema["conv"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
        held, name, tally, type_ = [], None, None, None

        def flush() -> pa.RecordBatch:
            convs, *columns = zip(*held)
            held.clear()
            kinds = [type_] + [pa.int64()] * 6 + [pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((convs, *columns), kinds)], names=names)

        for batch in batches:
            type_ = batch.schema.field("conv").type
            columns = [batch.column(c).to_pylist() for c in ("conv", "present", "turn", "initial", "blank", "duplicate", "cut")]
            for conv, there, *row in zip(*columns):
                if tally is None or conv != name:
                    if tally is not None:
                        held.append((name, *tally.row()))
                    name, tally = conv, _Tally()
                if there:
                    tally.add(*row)
            if held:
                yield flush()
        if tally is not None:
            held.append((name, *tally.row()))
            yield flush()

    return thin.mapInArrow(work, f"conv {kind}, {FAULTS}").withColumnRenamed("conv", id_col)


def _beside_edits(rows: DataFrame, faults: DataFrame, names: tuple[str, str, str, str], present: Column | None) -> tuple[DataFrame, str]:
    """Each conversation's row of ``faults`` (in ``info``), then its rows in order; and the type of the ids."""
    info = faults.select(ref(names[0]).alias("conv"), F.struct(*[c for c in faults.columns if c != names[0]]).alias("info"))
    texts = _prepared(rows, names, present).where("present").select("conv", "turn", "role", "head", "digest", "text")
    both = info.withColumn("row", F.lit(False)).unionByName(texts.withColumn("row", F.lit(True)), allowMissingColumns=True)
    return _in_order(both, first=["row"]).select("conv", "info", "role", "text"), texts.schema["conv"].dataType.simpleString()


def repaired_turns(rows: DataFrame, faults: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text", present: Column | None = None) -> DataFrame:
    """The repaired conversations: ``id_col``, place (from 0), edit (K, R or I), role, text. ``faults`` as :func:`conversation_faults` gives it.

    Conversations of which nothing stays have no rows.
    """
    sorted_, kind = _beside_edits(rows, faults, (id_col, turn_col, role_col, text_col), present)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = replay = None
        place = 0
        for batch in batches:
            out = []
            for conv, info, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "info", "role", "text"))):
                if info is not None:
                    out += [] if replay is None else [(name, place + k, *x) for k, x in enumerate(replay.inserted())]
                    name, replay, place = conv, Replay(info["audit"]), 0
                else:
                    for x in replay.row(role, text):
                        out.append((conv, place, *x))
                        place += 1
            yield made(batch, out)
        if replay is not None:
            yield made(batch, [(name, place + k, *x) for k, x in enumerate(replay.inserted())])

    def made(batch: pa.RecordBatch, out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * 5
        kinds = [batch.schema.field("conv").type, pa.int64(), pa.string(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["conv", "place", "edit", "role", "text"])

    return sorted_.mapInArrow(work, f"conv {kind}, place long, edit string, role string, text string").withColumnRenamed("conv", id_col)


def with_repaired_digest(rows: DataFrame, faults: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", present: Column | None = None) -> DataFrame:
    """``faults`` with repaired_sha256: lowercase hex over the repaired ``role:text``, joined by line feeds; of nothing, the empty text's."""
    sorted_, kind = _beside_edits(rows, faults, (id_col, turn_col, role_col, text_col), present)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = info = replay = chain = types = None
        joint = b""

        def feed(turns: Iterator[tuple[str, str, str]]) -> None:
            nonlocal joint
            for _, role, text in turns:
                chain.update(joint + f"{role}:{text}".encode("utf-8", "surrogatepass"))
                joint = b"\n"

        def done() -> tuple:
            feed(replay.inserted())
            return name, info, chain.hexdigest()

        def made(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (*types, pa.string()))], names=["conv", "info", "sha"])

        for batch in batches:
            types = [batch.schema.field(c).type for c in ("conv", "info")]
            out = []
            for conv, found, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "info", "role", "text"))):
                if found is not None:
                    if replay is not None:
                        out.append(done())
                    name, info, replay, chain, joint = conv, found, Replay(found["audit"]), hashlib.sha256(), b""
                else:
                    feed(replay.row(role, text))
            if out:
                yield made(out)
        if replay is not None:
            yield made([done()])

    found = sorted_.mapInArrow(work, f"conv {kind}, info struct<{FAULTS.replace(' ', ':').replace(',:', ',')}>, sha string")
    return found.select(F.col("conv").alias(id_col), "info.*", F.col("sha").alias("repaired_sha256"))


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, there: ``rows`` with faults by crc32 of ``conv_id:turn`` modulo 20, a stand-in for what goes wrong.

    0 marks the row as not there, 1 empties the text, 2 takes its ``.!?`` away, 3 repeats the row, 4 makes its role user.
    NULLs in the hashed name, the role and the text are one space.
    """
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.pmod(F.crc32(name), F.lit(20))
    text = F.coalesce("text", space)
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, "".join(ENDS), "")).otherwise(text).alias("text"), (kind != 0).alias("there"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


def repair_damaged(rows: DataFrame) -> DataFrame:
    """conv_id, faults, cost, audit and repaired_sha256 of every conversation in ``rows`` after :func:`damage`."""
    damaged = damage(rows)
    there = F.col("there")
    return with_repaired_digest(damaged, conversation_faults(damaged, present=there), present=there)
