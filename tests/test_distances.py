"""Distances of many pairs at once against the full matrix, and the plans that use them."""

import random

import pytest

from conftest import SF_SMALL
from palimpsest.functions import lanes
from palimpsest.functions.distance import far_apart, fast_levenshtein, long_edit_distance, sliding_levenshtein, total_distance
from palimpsest.plans.catalog import REGISTRY


def dp(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def some_pairs(seed, longest):
    rng = random.Random(seed)
    out = [("", ""), ("", "ab"), ("a", "a"), ("kitten", "sitting")]
    for _ in range(60):
        alphabet = rng.choice(["ab", "abcdefgh ", "xyé😀中文"])
        a = "".join(rng.choices(alphabet, k=rng.choice([1, 63, 64, 65, rng.randint(0, longest)])))
        b = list(a if rng.random() < 0.6 else rng.choices(alphabet, k=rng.randint(0, longest)))
        for _ in range(rng.choice([0, 1, 6, 40])):
            at = rng.randint(0, len(b))
            b[at:at + rng.randint(0, 1)] = rng.choice([[], [rng.choice(alphabet)]])
        out.append((a, "".join(b)))
    return out


@pytest.mark.parametrize("full,words,table", [(4096, 4096, 1 << 22), (100, 8, 3000)])
def test_distances_equal_the_full_matrix(monkeypatch, full, words, table):
    monkeypatch.setattr(lanes, "FULL", full)
    monkeypatch.setattr(lanes, "WORDS", words)
    monkeypatch.setattr(lanes, "TABLE", table)
    pairs = some_pairs(full, 250)
    want = [dp(a, b) for a, b in pairs]
    left, right = [a for a, _ in pairs] + [None, "a"], [b for _, b in pairs] + ["b", None]
    assert lanes.distances(left, right) == [*want, None, None]
    for limit in (0, 1, 5, 70):
        got = lanes.distances(left, right, limit)[:-2]
        assert all(g == d if d <= limit else g > limit for g, d in zip(got, want))
    assert lanes.distances([], []) == []


@pytest.mark.parametrize("words,step", [(4096, 0), (4096, 10 ** 9), (8, 0)])
def test_long_pairs_in_bands_equal_the_full_matrix(monkeypatch, words, step):
    monkeypatch.setattr(lanes, "BAND", 1)
    monkeypatch.setattr(lanes, "WORDS", words)
    monkeypatch.setattr(lanes, "STEP", step)  # together, or one by one
    pairs = some_pairs(words + step, 400)
    assert lanes.distances([a for a, _ in pairs], [b for _, b in pairs]) == [dp(a, b) for a, b in pairs]


def test_lopsided_band_is_exact_within_its_width():
    for a, b in some_pairs(11, 300):
        x, y = lanes.stripped(a, b)
        if len(x):
            d = dp(a, b)
            for p in (0, 1, 9, 50):
                got, most = lanes._advance([(x, y)], p, len(y) - len(x) + p)[0], len(y) - len(x) + 2 * p
                assert got == d if d <= most else got > most


def test_long_related_pairs_go_together_in_a_narrow_band(monkeypatch):
    rng, seen, advance = random.Random(5), [], lanes._advance
    monkeypatch.setattr(lanes, "_advance", lambda pairs, k, right=None: seen.append((len(pairs), k, right)) or advance(pairs, k, right))
    texts = ["".join(rng.choices("abcdefgh ", k=2000 + i)) for i in range(80)]
    assert lanes.distances(texts, [f"{t[:9]}zz{t[9:1500]}{t[1520:]}z" for t in texts]) == [fast_levenshtein(t, f"{t[:9]}zz{t[9:1500]}{t[1520:]}z") for t in texts]
    assert seen and max(size for size, _, _ in seen) > 1 and all(k + right < 400 for _, k, right in seen)


def test_sliding_band_is_exact_within_its_width():
    for a, b in some_pairs(7, 200):
        assert fast_levenshtein(a, b) == (d := dp(a, b))
        a, b = sorted((a, b), key=len)
        if a:
            for p in (0, 1, 9, 50):
                got, most = sliding_levenshtein(a, b, p, 16), len(b) - len(a) + 2 * p
                assert got == d if d <= most else got > most


def test_distance_columns(spark):
    df = spark.createDataFrame([("ab", "ac", ["a", ""], ["b", "xyz"]), ("same", "same", [], []), (None, "a", ["q"], ["q"])],
                               "a string, b string, l array<string>, r array<string>")
    got = df.select(long_edit_distance("a", "b"), far_apart("a", "b", 0), total_distance("l", "r")).collect()
    assert [tuple(r) for r in got] == [(1, True, 4), (0, False, 0), (None, None, 0)]


@pytest.mark.parametrize("name", ["document_metrics", "paragraph_distances", "levchar_flags", "chapter_changes", "significant_changes"])
def test_no_distance_is_taken_cell_by_cell(spark, name):
    assert "levenshtein(" not in REGISTRY[name][0](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString().replace("_levenshtein_udf(", "")
