import random
import re
from collections import Counter

import cases
import numpy as np
import pytest

from lacuna.functions.durable import durable
from lacuna.llm import divergence
from lacuna.llm.divergence import frequent_terms, share, source_divergence

NAMES, KINDS = ("lang", "source", "text"), ("string", "string", "string")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall((text or "").translate(cases.UPPER))


def kept_of(rows, least):
    docs = {}
    for lang, _, text in rows:
        docs.setdefault(lang or "", Counter()).update(set(terms_of(text)))
    return {lang: {t for t, n in c.items() if n >= least} for lang, c in docs.items()}


def audit(rows, least=3, ranks=200):
    kept, counts = kept_of(rows, least), {}
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        for key in ((lang, source), (lang, None)):
            counts.setdefault(key, Counter()).update(t for t in terms_of(text) if t in kept[lang])
    p = {key: {t: 1 + 10**9 * (c[t] + 1) // (c.total() + len(kept[key[0]])) for t in kept[key[0]]} for key, c in counts.items()}
    f = lambda a, b: (a - b) ** 2 // b
    out = []
    for lang, source in counts:
        if source is None:
            continue
        mine = p[lang, source]
        pairs = [(s, sum(f(mine[t], p[lang, s][t]) for t in mine)) for l, s in counts if l == lang and s not in (None, source)]
        terms = [(t, f(mine[t], p[lang, None][t])) for t in mine if counts[lang, source][t] and mine[t] > p[lang, None][t]]
        for part, items, most in (("pair", pairs, None), ("term", terms, ranks)):
            for rank, (item, value) in enumerate(sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]):
                out.append((lang, source, part, item, value, rank + 1))
    return sorted(out, key=repr)


def corpus(seed=1):
    rng = random.Random(seed)
    words = [cases.prose(k, 1) for k in range(60)] + ["The", "THE", "é", "Éa", "x" * 3000, "x" * 2999, "日本語", "a", "ab", "abc", "abcd", "abcde"]
    rows = []
    for _ in range(120):
        lang, source = rng.choice(["en", "en", "de", None, "fr"]), rng.choice(["s1", "s1", "s2", "s3", None, "ß"])
        rows.append((lang, source, rng.choice([" ", "-", "\n", "1"]).join(rng.choice(words) for _ in range(rng.randint(0, 30)))))
    rows += [("xx", "lonely", "one two"), ("yy", "s1", None), ("yy", "s2", ""), ("yy", "s2", "rare")]
    return rows + rows[:5]


def test_source_divergence(spark):
    rows = corpus()
    assert cases.rows_of(source_divergence(cases.frame(spark, rows, NAMES, KINDS))) == audit(rows)


def test_ranks_ties_and_thresholds(spark, monkeypatch):
    monkeypatch.setattr(divergence, "PAIRS_AT_ONCE", 3)
    rows = corpus(2)
    got = source_divergence(cases.frame(spark, rows, NAMES, KINDS), min_documents=2, term_ranks=3)
    assert cases.rows_of(got) == audit(rows, 2, 3)


def test_many_chunks_and_levels(spark, monkeypatch):
    monkeypatch.setattr(divergence, "CHUNK_BYTES", 500)
    monkeypatch.setattr(divergence, "BIT_SET", 16)
    rows = corpus(3)
    numbered = spark.createDataFrame([(0, 0, text) for lang, _, text in rows], "g int, l int, text string").repartition(4)
    for first in (1, 2, 5):
        got = {(r.term.decode(), r.n) for r in frequent_terms(durable(numbered), 3, first).collect()}
        kept = kept_of([("", "", t) for _, _, t in rows], 3)[""]
        every = Counter(t for _, _, text in rows for t in terms_of(text))
        assert got == {(t, every[t]) for t in kept}


def test_nothing_to_compare(spark):
    assert source_divergence(cases.frame(spark, [], NAMES, KINDS)).collect() == []
    rows = [("a", "s", None), ("a", "t", "once only"), ("b", None, "1 2 3")]
    assert cases.rows_of(source_divergence(cases.frame(spark, rows, NAMES, KINDS))) == audit(rows)


@pytest.mark.parametrize("count", [0, 7, 9 * 10**9, 10**12])
def test_share_is_exact(count):
    total = 10**13 + 7
    assert share(np.array([count]), np.array([total]))[0] == 1 + 10**9 * (count + 1) // total
