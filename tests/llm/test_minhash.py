import random

import cases
import numpy as np
import pytest

from lacuna.llm.minhash import BANDS, ROWS, band_keys, forest, minima, most_unequal, near_duplicates, planes, similarity, unequal
from lacuna.llm.ngram_join import shingle_sets


def expected(rows):
    return sorted(((i, n, c, i == c) for i, n, c in cases.components(rows, 5, 85)), key=repr)


@pytest.mark.parametrize("bucket, block_tokens", [(20_000, 500_000), (2, 600)])
def test_near_duplicates(spark, bucket, block_tokens):
    rows = cases.documents()
    got = near_duplicates(cases.frame(spark, rows), bucket=bucket, block_tokens=block_tokens)
    assert cases.rows_of(got) == expected(rows)


def test_nothing_to_find(spark):
    assert near_duplicates(cases.frame(spark, [])).collect() == []
    rows = [(1, None), (2, ""), (None, None), (3, "one two"), (4, cases.prose(1, 50))]
    assert cases.rows_of(near_duplicates(cases.frame(spark, rows))) == expected(rows)


def test_estimate_is_corrected_for_chance():
    rng = random.Random(1)
    tokens = [rng.getrandbits(64) for _ in range(3000)]
    for share in (0.0, 0.5, 0.85, 1.0):
        found = []
        for k in range(40):
            common = int(100 * 2 * share / (1 + share))
            both = rng.sample(tokens, 200 - common)
            a, b = both[:100], both[100 - common:]
            sets = [np.unique(np.array(x, np.uint64)) for x in (a, b)]
            signatures = planes(minima(sets))
            found.append(similarity(int(unequal(signatures[0], signatures[1:])[0])))
        true = common / (200 - common)
        assert abs(np.mean(found) - true) < 0.02


def test_similar_pairs_share_bands_and_pass():
    rng = random.Random(2)
    limit = most_unequal(85)
    for _ in range(200):
        base = [rng.getrandbits(64) for _ in range(185)]
        sets = [np.unique(np.array(base[:170] + base[170 + k * 15:185 + k * 15], np.uint64)) for k in (0, 1)]
        sets[1] = np.unique(np.concatenate((sets[1], np.array([rng.getrandbits(64) for _ in range(15)], np.uint64))))
        least = minima(sets)
        keys = band_keys(least)
        assert keys.shape == (2, BANDS) and least.shape[0] == BANDS * ROWS
        assert (keys[0] == keys[1]).sum() >= 2
        signatures = planes(least)
        assert unequal(signatures[0], signatures[1:])[0] <= limit


def test_forest_holds_chains_together():
    rng = random.Random(3)
    tokens = [np.uint64(rng.getrandbits(64)) for _ in range(400)]
    chain = [np.unique(np.array(tokens[k * 4:k * 4 + 100], np.uint64)) for k in range(60)]
    signatures = planes(minima(chain))
    limit = most_unequal(85)
    near = [[int(unequal(s, signatures[[k]])[0]) <= limit for k in range(60)] for s in signatures]
    label = list(range(60))
    for _ in range(60):
        label = [min(label[j] for j in range(60) if near[i][j]) for i in range(60)]
    edges = forest(signatures, limit)
    up = list(range(60))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        assert near[a][b] and find(a) != find(b)
        up[find(a)] = find(b)
    assert len({(find(k), label[k]) for k in range(60)}) == len(set(label)) == 60 - len(edges)


def test_short_sets():
    sets = shingle_sets([b"one two", b"One  TWO", b"a b c d e f"], 5)
    assert np.array_equal(planes(minima(sets))[0], planes(minima(sets))[1])
