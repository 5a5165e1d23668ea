import hashlib
import random
import re
import zlib

import cases
import pytest

from lacuna.llm.conversations import (
    BAD, CUT, cheapest_edits, conversation_faults, damage, repair_damaged, repaired_turns, with_repaired_digest,
)

SOUND, BEGUN = re.compile("(s?(ua)+)?"), re.compile("s?(ua)*u?")
NAMES = ("conv_id", "turn", "role", "text")
KINDS = ("bigint", "bigint", "string", "string")


def all_repairs(rows):
    """Every audit with its cost and turns, tried one by one; ``rows`` has role, text, must be deleted, truncated."""
    out = []

    def go(k, cost, audit, made, inserted):
        if made and (not made[-1][0] or not BEGUN.fullmatch("".join(r[:1] for r, _ in made))):
            return
        if k == len(rows) and SOUND.fullmatch("".join(r[:1] for r, _ in made)):
            out.append((cost, audit, made))
        if inserted < 2:
            for role in ("user", "assistant"):
                go(k, cost + 2, audit + "I", made + [(role, "")], inserted + 1)
        if k == len(rows):
            return
        role, text, bad, cut = rows[k]
        go(k + 1, cost + 3, audit + "D", made, 0)
        if not bad:
            go(k + 1, cost + cut, audit + "K", made + [(role, text)], 0)
            for other in ("user", "assistant"):
                go(k + 1, cost + 2 + cut, audit + "R", made + [(other, text)], 0)

    go(0, 0, "", [], 0)
    return out


def judged(rows):
    """Faults of sorted (turn, role, text), and the cheapest repair among all."""
    seen, marked, count = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]+", "", text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            count[fault] += 1
        marked.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, made = min(all_repairs(marked), key=lambda x: x[:2])
    body = "\n".join(f"{r}:{t}" for r, t in made)
    return (gaps, *count.values(), illegal, cost, audit, hashlib.sha256(body.encode()).hexdigest()), made


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        group = out.setdefault(conv, [])
        if kind:
            row = (turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
            group += [row, row] if kind == 3 else [row]
    return {c: sorted(g, key=lambda r: (r[0] is not None, r[0], r[1], r[2])) for c, g in out.items()}


def talks(seed=3, convs=40):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "why", "", " \n", "Done? \t", "a ", "Ja.\u0085", "é.", None, "x" * 40 + "1.", "x" * 40 + "2."]
    rows = []
    for conv in [None, *range(convs)]:
        for turn in range(rng.randint(1, 5)):
            number = rng.choice([turn, turn, turn, None, turn + 3])
            rows.append((conv, number, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]), rng.choice(texts)))
    return rows + rows[:4]


@pytest.mark.parametrize("block", [1, 2, 3, 48])
def test_edits_are_the_least_of_all(block):
    rng = random.Random(5)
    role = {0: "tool", 1: "system", 2: "user", 3: "assistant"}
    for _ in range(80):
        codes = bytes(rng.choice([0, 1, 2, 3, 2, 3, 2 | BAD, 3 | BAD, 2 | CUT, 3 | CUT, 1 | CUT]) for _ in range(rng.randint(0, 4)))
        every = all_repairs([(role[c & 3], "t", bool(c & BAD), bool(c & CUT)) for c in codes])
        assert cheapest_edits(codes, block) == min(every)[:2]


def test_blocks_do_not_change_long_conversations():
    rng = random.Random(6)
    codes = bytes(rng.choice([2, 3, 2, 3, 1, 6, 7, 10, 11, 0]) for _ in range(3000))
    assert len({cheapest_edits(codes, n) for n in (7, 48, 3000)}) == 1


def test_repair_damaged(spark):
    rows = talks()
    got = {r.conv_id: tuple(r)[1:] for r in repair_damaged(cases.frame(spark, rows, NAMES, KINDS)).collect()}
    assert got == {c: judged(g)[0] for c, g in damaged(rows).items()}


def test_repaired_turns(spark):
    rows = talks(4)
    df = damage(cases.frame(spark, rows, NAMES, KINDS))
    there = df["there"]
    faults = conversation_faults(df, present=there)
    got = {}
    for r in repaired_turns(df, faults, present=there).orderBy("conv_id", "place").collect():
        got.setdefault(r.conv_id, []).append((r.role, r.text))
    assert got == {c: made for c, g in damaged(rows).items() if (made := judged(g)[1])}


def test_empty_and_untouched(spark):
    empty = cases.frame(spark, [], NAMES, KINDS)
    assert repair_damaged(empty).collect() == [] and repaired_turns(empty, conversation_faults(empty)).collect() == []
    rows = [(1, 0, "system", "Be brief."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Hello."), (2, None, "user", " ")]
    df = cases.frame(spark, rows, NAMES, KINDS)
    got = {r.conv_id: r for r in with_repaired_digest(df, conversation_faults(df)).collect()}
    assert got[1].audit == "KKK" and got[1].cost == 0
    assert got[1].repaired_sha256 == hashlib.sha256(b"system:Be brief.\nuser:Hi.\nassistant:Hello.").hexdigest()
    assert (got[2].audit, got[2].gaps, got[2].repaired_sha256) == ("D", 0, hashlib.sha256(b"").hexdigest())


def test_one_long_conversation(spark):
    rows = [(7, k, "user" if k % 2 == 0 else "assistant", f"Turn {k}.") for k in range(20_001)] + [(None, None, None, None)]
    df = cases.frame(spark, rows, NAMES, KINDS)
    got = {r.conv_id: r for r in conversation_faults(df).collect()}
    assert (got[7].cost, got[7].audit) == (2, "K" * 20_001 + "I") and got[None].audit == "D"
