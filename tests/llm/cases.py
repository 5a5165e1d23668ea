"""Small tables with every awkward case, and brute-force answers."""

import hashlib
import random
import re
from collections import Counter, defaultdict

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Extra columns named like the columns that operators make for themselves.
CLASHES = {"id": "x", "key": 1, "sha": "s", "sid": "t", "row": 2, "value": "v", "n": 3, "words": "w", "hits": "h", "part": 4,
           "item": "i", "items": "j", "host": "k", "rule": "l", "label": 5, "kept": True, "n_tokens": 6, "spans": "m", "score": 0.5}


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnoprstuvwéß") for _ in range(rng.randint(2, 9))) for _ in range(words))


def documents() -> list[tuple[int | None, str | None]]:
    base = prose(1, 400)
    words = base.split(" ")
    near = " ".join(w if k not in (50, 51, 300) else "anders" for k, w in enumerate(words))
    shared = prose(2, 60)
    rows = [(10, base), (2, base), (3, base.replace(" ", "\n\t ", 40)), (4, near), (5, None), (6, ""), (7, " \n\t "), (8, "one two"),
            (9, "one two"), (12, "One  TWO"), (8, "one two"), (None, base), (None, "alone here and nowhere else"), (None, None),
            (13, prose(3, 30) + shared + prose(4, 20) + shared), (14, prose(5, 50) + " " + shared.upper()), (15, prose(6, 9000)),
            (16, "x" * 30_000), (17, "ab" * 200), (18, prose(7, 100) + shared), (19, "a\x00b \u2028 c\u00a0d \U0001f642 <|endoftext|> e")]
    rng = random.Random(9)
    for k in range(30):  # a group of near copies that differ from each other
        edited = list(words[:150])
        for _ in range(rng.randint(1, 4)):
            edited[rng.randrange(150)] = f"edit{k}"
        rows.append((100 + k, " ".join(edited)))
    return rows


def frame(spark, rows, names=("doc_id", "text"), kinds=("bigint", "string")):
    """A DataFrame with the clashing columns behind and in front of the real ones."""
    extra = {k: v for k, v in CLASHES.items() if k not in names}
    front, behind = list(extra)[::2], list(extra)[1::2]
    kind = {str: "string", int: "int", bool: "boolean", float: "double"}
    schema = ", ".join([*(f"`{c}` {kind[type(extra[c])]}" for c in front), *(f"{n} {k}" for n, k in zip(names, kinds)),
                        *(f"`{c}` {kind[type(extra[c])]}" for c in behind)])
    return spark.createDataFrame([(*(extra[c] for c in front), *r, *(extra[c] for c in behind)) for r in rows], schema).repartition(3)


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def sha(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def dedup(rows):
    groups = defaultdict(list)
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    for k, n in enumerate(norm):
        groups[n].append(k)
    out = []
    for k, (i, _) in enumerate(rows):
        members = groups[norm[k]]
        ids = [rows[m][0] for m in members if rows[m][0] is not None]
        out.append((i, min(ids) if ids else None, len(members), sha(norm[k].encode())))
    return out, len(groups)


def shingles(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    return frozenset(tuple(w[k:k + words]) for k in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else [])


def components(rows, words, percent):
    sets = [shingles(t, words) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    members = defaultdict(list)
    for k in range(len(rows)):
        members[find(k)].append(k)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[m][0] for m in members[find(k)] if rows[m][0] is not None]
        out.append((i, len(sets[k]), min(ids) if ids else None))
    return out


def contaminated(rows, items, window=10):
    split = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(UPPER)) if w]
    wins = defaultdict(set)
    for item, text in items:
        w = split(text)
        m = min(window, len(w))
        for k in range(len(w) - m + 1 if w else 0):
            wins[tuple(w[k:k + m])].add(item)
    out = []
    for i, text in rows:
        w = split(text)
        hit, found = set(), set()
        for m in {len(x) for x in wins}:
            for k in range(len(w) - m + 1):
                if tuple(w[k:k + m]) in wins:
                    hit.update(range(k, k + m))
                    found |= {str(x) for x in wins[tuple(w[k:k + m])] if x is not None}
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found)).encode()), bool(hit)))
    return out


def repeats(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(t[k:k + length] for t in texts for k in range(len(t) - length + 1))
    out = []
    for (i, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if count[t[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        spans = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone))]
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i, len(t), sum(gone), len(spans), sha(kept), spans))
    return out
