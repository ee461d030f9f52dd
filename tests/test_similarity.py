import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from linkloom.functions import similarity as sim

words = st.text("abc d", max_size=9)


def plain_lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


@settings(max_examples=200, deadline=None)
@given(words, words)
def test_lcs(a, b):
    assert sim.lcs_length(a, b) == plain_lcs(a, b)
    for f in (sim.indel_ratio, sim.token_sort_ratio, sim.token_set_ratio, sim.partial_ratio, sim.jaro_winkler, sim.osa_similarity):
        assert 0 <= f(a, b) <= 1 + 1e-12
        assert f(a, b) == pytest.approx(f(b, a)) or f is sim.jaro_winkler


def test_known_values():
    assert sim.osa_distance("ca", "abc") == 3 and sim.osa_distance("bsigaman", "bisgaman") == 1
    assert sim.jaro_winkler("martha", "marhta") == pytest.approx(0.961111, abs=1e-6)
    assert sim.token_sort_ratio("b a", "a b") == 1 and sim.token_set_ratio("a b", "a b c") == 1
    assert sim.partial_ratio("abc", "xxabcxx") == 1
    assert sim.indel_ratio("", "") == sim.partial_ratio("", "") == sim.jaro_winkler("", "") == sim.osa_similarity("", "") == 1
    assert sim.token_set_ratio("", "a") == 0 and sim.partial_ratio("", "a") == 0


def test_udf(spark):
    random.seed(0)
    rows = [("acme corp", "corp acme"), ("", ""), (None, "x")]
    got = spark.createDataFrame(rows, "a string, b string").select(sim.string_similarities("a", "b").alias("s")).select("s.*").collect()
    assert got[0]["token_sort"] == 1 and got[1]["ratio"] == 1 and got[2]["ratio"] == 0


def plain_windows(a, b):
    """Every window by itself."""
    n = len(a)
    return max(2 * plain_lcs(a, w) / (n + len(w)) for s in range(1 - n, len(b)) if (w := b[max(0, s) : s + n]))


@settings(max_examples=200, deadline=None)
@given(st.text("abc \u00df\U0001f600", min_size=1, max_size=20), st.text("abc \u00df\U0001f600", min_size=1, max_size=30), st.sampled_from([1, 64, 1 << 20]))
def test_windows_side_by_side(a, b, lanes):
    before, sim.LANES = sim.LANES, lanes
    try:
        assert sim._best_window(a, b) == plain_windows(a, b)
    finally:
        sim.LANES = before


@settings(max_examples=200, deadline=None)
@given(st.text("abc \u00df\U0001f600", min_size=1, max_size=20), st.text("abc \u00df\U0001f600", min_size=1, max_size=30))
def test_windows_combed(a, b):
    assert sim._best_combed(a, b) == plain_windows(a, b)


def plain_jaro_winkler(a, b):
    reach, used, hits = max(max(len(a), len(b)) // 2 - 1, 0), set(), []
    for i, c in enumerate(a):
        if (j := next((j for j in range(max(0, i - reach), min(len(b), i + reach + 1)) if j not in used and b[j] == c), None)) is not None:
            used.add(j)
            hits.append(c)
    m = len(hits)
    if not m:
        return 0.0
    jaro = (m / len(a) + m / len(b) + (m - sum(x != b[j] for x, j in zip(hits, sorted(used), strict=True)) // 2) / m) / 3
    same = next((k for k in range(min(4, len(a), len(b))) if a[k] != b[k]), min(4, len(a), len(b)))
    return jaro + (0.1 * same * (1 - jaro) if jaro > 0.7 else 0.0)


@settings(max_examples=200, deadline=None)
@given(st.text("abc d", min_size=1, max_size=20), st.text("abc d", min_size=1, max_size=20))
def test_jaro_winkler_by_bits(a, b):
    assert sim.jaro_winkler(a, b) == pytest.approx(plain_jaro_winkler(a, b), abs=1e-12)


def test_sentences_cost_steps_not_windows():
    """Two sentences of 400 characters: 799 windows of 400 steps each took over 300,000 steps one by one."""
    r = random.Random(3)
    a, b = ("".join(r.choices("abcdefgh ", k=400)) for _ in range(2))
    began = time.process_time()
    assert 0 < sim.partial_ratio(a, b) < 1
    assert time.process_time() - began < 0.05
