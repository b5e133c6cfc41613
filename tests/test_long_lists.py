"""Decoding of all candidates, however unlikely and many they are."""

import time

import numpy as np
import pytest

from kinmesh.operators import decode


def law(q):
    out = np.ones(1)
    for p in q:
        out = np.convolve(out, [1 - p, p])
    return out


def brute(q, k):
    inside, outside = law(q[:k]), law(q[k:])
    a, b = np.arange(len(inside))[:, None], np.arange(len(outside))[None, :]
    return outside[0] if k == 0 else float((inside[:, None] * outside[None, :] * 1.25 * a / (0.25 * (a + b) + k)).sum())


def test_unlikely_candidates_enter(spark):
    """A hundred candidates below the floor of 0.02 hold 1.9 expected matches, which lower the value of every set."""
    pi = [("m1", "a", 0.9)] + [("m1", f"x{i:03}", 0.019) for i in range(100)] + [("m2", "b", 0.015)]
    got = decode.decode(spark.createDataFrame(pi, "s1_id string, frag_id string, pi double")).collect()
    q = [0.9] + [0.019] * 100
    values = [round(brute(q, k), 12) for k in range(len(q) + 1)]
    assert {r.s1_id for r in got} == {"m1"} and len(got) == values.index(max(values))
    assert got[0].ef == pytest.approx(max(values), abs=1e-11) and got[0].ef < 0.8


def test_long_lists(spark):
    """The integral gives what the laws give: lists of equal, of different, of sure and of impossible candidates, with an unseen rate too."""
    rng = np.random.default_rng(4)
    lists = [np.full(150, 0.3), np.sort(rng.random(90))[::-1], np.sort(rng.choice([1.0, 0.6, 0.2, 0.01, 0.0], 200))[::-1], np.full(70, 0.0), np.array([1.0] * 80), np.sort(rng.random(130) ** 8)[::-1]]
    for q in lists:
        for rate in (0.0, 1.5):
            k, ef = decode.best_k(q[None, :].copy(), np.array([rate]))
            assert decode.best_of_long(q, rate) == (k[0], pytest.approx(ef[0], abs=2e-12))
        values = [round(brute(q, k), 12) for k in range(len(q) + 1)]
        assert decode.best_of_long(q, 0.0)[1] == pytest.approx(max(values), abs=2e-12)
    rows = spark.createDataFrame([(i, [float(x) for x in q]) for i, q in enumerate(lists)], "i int, q array<double>")
    for r in decode.best_sets(rows).collect():
        assert (r.k, pytest.approx(r.ef, abs=2e-12)) == tuple(x[0] for x in decode.best_k(np.array([r.q]), np.zeros(1)))


def test_a_list_of_many_thousands():
    """Equally likely candidates give no early end; the cube of the length would take hours."""
    began = time.monotonic()
    k, ef = decode.best_of_long(np.full(15_000, 0.146), 0.0)
    assert k == 15_000 and ef == pytest.approx(1.25 * 0.146 / (0.25 * 0.146 + 1), abs=1e-4)
    assert time.monotonic() - began < 20
