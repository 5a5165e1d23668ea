import random
from collections import defaultdict

import cases
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lacuna.llm.exact_dedup import exact_dedup, golomb_decode, golomb_encode
from lacuna.llm.components import components
from lacuna.llm import exact_dedup as exact_dedup_module
from lacuna.llm import ngram_join
from lacuna.llm.ngram_join import _meetings, ngram_components
from lacuna.llm.suffix_dedup import column_order, drop_repeats
from lacuna.llm.trie import Forest, similar_links


@given(st.lists(st.integers(0, 2**60), max_size=200))
def test_golomb_round_trip(values):
    values = np.array(sorted(values), np.uint64)
    assert golomb_decode(golomb_encode(values)).tolist() == values.tolist()


def test_exact_dedup(spark):
    rows = cases.documents()
    got = exact_dedup(cases.frame(spark, rows)).collect()
    expected, groups = cases.dedup(rows)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == sorted(expected, key=repr)
    kept = [r for r in got if r.kept]
    assert len(kept) == groups == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_exact_dedup_deals_one_task_to_many_senders(spark, monkeypatch):
    held, plans = [], []
    buckets, plain = exact_dedup_module.durable_buckets, exact_dedup_module.durable
    monkeypatch.setattr(exact_dedup_module, "durable_buckets", lambda *a: (held.append(buckets(*a)), held[-1])[1])
    monkeypatch.setattr(exact_dedup_module, "durable", lambda df: (
        plans.append(df._jdf.queryExecution().executedPlan().toString()), plain(df))[1])
    rows = [(k, f"text {k % 700}") for k in range(2_000)]
    got = exact_dedup(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), rows_per_sender=100).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == sorted(cases.dedup(rows)[0])
    assert held[0].groupBy("sender").count().agg({"count": "max"}).first()[0] <= 2 * 100
    assert plans[0].count("Exchange hashpartitioning") == 2  # messages and bitmaps, not the rows


def test_ngram_components(spark):
    rows = cases.documents()
    df = cases.frame(spark, rows)
    expected = sorted(cases.components(rows, 4, 85), key=repr)
    assert cases.rows_of(ngram_components(df)) == expected


def test_ngram_components_in_blocks(spark):
    rows = cases.documents()
    got = ngram_components(cases.frame(spark, rows), words=5, percent=80, block_tokens=600)
    assert cases.rows_of(got) == sorted(cases.components(rows, 5, 80), key=repr)


def templates(pages: int) -> list[tuple[int, str]]:
    """Pages of passages from one small pool, which makes one cluster of candidates, and a near copy of every 20th."""
    rng = random.Random(4)
    pool = [cases.prose(1000 + k, 40) for k in range(60)]
    rows = [(k, " ".join(rng.choice(pool) for _ in range(8))) for k in range(pages)]
    return rows + [(1000 + k, text.replace(text.split(" ")[20], f"other{k}")) for k, text in rows[::20]] + [(5000, rows[0][1]), (None, rows[1][1])]


def test_ngram_components_of_templates(spark, monkeypatch):
    moved = []
    plain = ngram_join._join_sets
    monkeypatch.setattr(ngram_join, "_join_sets", lambda rows, percent: (moved.append(rows), plain(rows, percent))[1])
    rows = templates(300)
    got = ngram_components(cases.frame(spark, rows), block_tokens=8_000)
    assert cases.rows_of(got) == sorted(cases.components(rows, 4, 85), key=repr)
    assert len(moved) == 3  # small clusters, the first block, shared prefix tokens
    # All sets in blocks against all would move each set some 30 times.
    assert sum(m.count() for m in moved) < 12 * len(rows)


def test_meetings_bring_all_labels_together(spark):
    rng = random.Random(7)
    rows = [(c, f"{s:03}".encode(), rng.randint(1, 30), f"{rng.choice([0, 0, 0, s]):03}".encode())
            for c in range(6) for s in rng.sample(range(90), 5 + 15 * c)]
    rows += [(9, *r[1:]) for r in rows if r[0] == 5]  # the same sets under another token
    rows += [(7, b"a", 5, b"a"), (7, b"b", 5, b"a"), (8, b"a", 900, b"a")]  # joined already, and alone
    label = {(c, s): l for c, s, _, l in rows}
    weight = {(c, s): n for c, s, n, _ in rows}
    marked = spark.createDataFrame(rows, "cluster long, sid binary, n long, label binary")
    groups = defaultdict(set)
    for r in _meetings(marked, 100).collect():
        assert bytes(r.sid) not in groups[r.cluster, r.x, r.y]
        groups[r.cluster, r.x, r.y].add(bytes(r.sid))
    assert {c for c, _, _ in groups} == {0, 1, 2, 3, 4, 5}
    met = {(c, a, b) for (c, _, _), sids in groups.items() for a in sids for b in sids}
    for c in range(6):
        sids = [s for k, s in label if k == c]
        assert all((c, a, b) in met for a in sids for b in sids if label[c, a] != label[c, b])
    assert max(sum(weight[c, s] for s in sids) for (c, _, _), sids in groups.items()) < 400


@pytest.mark.parametrize("hot", [20_000, 3])
def test_drop_repeats(spark, hot):
    rows = cases.documents()
    got = drop_repeats(cases.frame(spark, rows), hot_runs=hot, runs_per_group=50)
    found = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, [(s.start, s.end) for s in r.spans]) for r in got.collect()]
    assert sorted(found, key=repr) == sorted(cases.repeats(rows, 200), key=repr)


def test_empty_tables(spark):
    empty = cases.frame(spark, [])
    assert exact_dedup(empty).collect() == []
    assert ngram_components(empty).collect() == []
    assert drop_repeats(empty).collect() == []
    assert drop_repeats(cases.frame(spark, [(1, None), (2, "")])).select("n_removed").distinct().collect()[0][0] == 0


def test_components(spark):
    links = [(f"{a:03}", f"{b:03}") for a, b in [(k, k + 1) for k in range(40, 70)] + [(5, 9), (9, 7), (3, 3), (1, 70), (90, 91)]]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a string, b string")).collect()}
    assert got == {**{f"{k:03}": "001" for k in range(40, 71)}, "009": "005", "007": "005", "091": "090"}
    assert components(spark.createDataFrame([], "a string, b string")).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 25), min_size=1, max_size=12), min_size=1, max_size=14), st.integers(50, 95))
def test_trie_against_all_pairs(sets, percent):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    got, expected = Forest(len(sets)), Forest(len(sets))
    for a, b in similar_links(arrays, percent):
        got.union(a, b)
    for a in range(len(sets)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                expected.union(a, b)
    assert [got.find(k) for k in range(len(sets))] == [expected.find(k) for k in range(len(sets))]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.binary(min_size=1, max_size=10)), min_size=1, max_size=12), st.integers(1, 4))
def test_column_order_against_all_pairs(rows, length):
    rows = [(c, bytes(b % 3 for b in body)) for c, body in rows]
    width = 14
    columns = np.array([c for c, _ in rows])
    counts = np.array([max(0, len(b) - length + 1) for _, b in rows])
    got = column_order([b for _, b in rows], columns, width, length, columns, counts)
    for k, (c, body) in enumerate(rows):
        for w in range(counts[k]):
            others = [b[c + w - c2:c + w - c2 + length] for j, (c2, b) in enumerate(rows) if j != k and c + w >= c2]
            assert got[k, c + w] == (body[w:w + length] in others)
