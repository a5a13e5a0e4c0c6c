"""Bit-sliced scatter against products of whole numbers, and whitening against its definition."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, x long, n long, component string, v string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "c", "v") for i, v in rows], SCHEMA)


def plain(vectors):
    """Distinct whole vectors, their sums and covariance in exact arithmetic."""
    whole = [tuple(math.floor(256 * float(np.float32(c))) for c in v) for v in vectors]
    fit = sorted(set(whole))
    n, d = len(fit), len(fit[0])
    sums = [sum(x[i] for x in fit) for i in range(d)]
    centred = [[n * sum(x[i] * x[j] for x in fit) - sums[i] * sums[j] for j in range(d)] for i in range(d)]
    return whole, fit, n, sums, np.array([[c / n**2 for c in row] for row in centred])


@given(st.integers(1, 5), st.integers(0, 9), st.integers(1, 130), st.integers(0, 2**32))
@settings(max_examples=60, deadline=None)
def test_counts_of_planes_give_products(d, widest, n, seed):
    r = np.random.default_rng(seed)
    bits = r.integers(0, widest + 1, d)
    x = np.stack([r.integers(0, 1 << int(b), n) for b in bits], 1).astype(np.uint64)
    counts = whitening.scatter(x, bits)
    weights = 1 << np.arange(counts.shape[2], dtype=np.int64)
    signed = x.astype(np.int64)
    assert ((counts[d] * weights).sum(1) == signed.sum(0)).all()
    assert (np.triu((counts[:d] * weights).sum(2)) == np.triu(signed.T @ signed)).all()


def test_moments_are_exact_in_blocks_and_for_wide_numbers(spark):
    r = random.Random(4)
    rows = [[r.randrange(-(2**62), 2**62), r.randrange(-5, 5), 7, r.randrange(2**40)] for _ in range(150)]
    fit = spark.createDataFrame([(x,) for x in rows], "x array<long>").repartition(3)
    n, sums, products = whitening.moments(fit, block_rows=20)
    assert n == 150 and sums == [sum(x[i] for x in rows) for i in range(4)]
    assert products == [[sum(x[i] * x[j] for x in rows) for j in range(4)] for i in range(4)]


def test_whitening_against_its_definition(spark):
    r = random.Random(5)
    vectors = [[r.gauss(0, 1) * s + 0.3 for s in (3, 1, 0.5, 2, 0.2, 0)] for _ in range(300)]
    vectors += vectors[:40] + [vectors[0]] * 30
    found = whitening.whiten(frame(spark, list(enumerate(vectors)))).collect()
    whole, fit, n, sums, v = plain(vectors)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    assert len(found) == 4 * len(vectors) and {r["component"] for r in found} == {1, 2, 3, 4}
    by = {(r["vec_id"], r["component"]): r for r in found}
    sign = {}
    for i, x in enumerate(whole):
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        for k in range(1, 5):
            row = by[i, k]
            expected = sum((c - s / n) * u[d, k - 1] for d, (c, s) in enumerate(zip(x, sums))) / math.sqrt(e[k - 1])
            sign.setdefault(k, 1 if row["whitened"] * expected > 0 else -1)
            assert row["whitened"] == pytest.approx(sign[k] * expected, abs=1e-9)
            assert row["n"] == n and row["deviation"] == deviation
            assert row["explained"] == pytest.approx(e[k - 1] / np.trace(v), rel=1e-9)
    assert len({r["identity_error"] for r in found}) == 1 and found[0]["identity_error"] < 1e-9


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [3.0, -2.0]), (3, None), (4, []), (5, [1.0, None]), (6, [nan, 1.0]), (7, [1.0, -inf]), (8, [1.0]), (1, [0.5, 0.25]), (9, [-0.001, 5.0])]
    found = whitening.whiten(frame(spark, rows)).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["component"]) for r in found) == sorted((i is None, i or 0, k) for i in (1, 2, None, 1, 9) for k in (1, 2))
    assert {r["n"] for r in found} == {4}
    # two distinct vectors have one component; one has none
    assert {r["component"] for r in whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [2.0, 4.0])])).collect()} == {1}
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert whitening.whiten(frame(spark, [])).count() == 0


def test_large_entries_do_not_fail(spark):
    rows = [(i, [float(10.0 ** (i * 5)), 1.0, float(i)]) for i in range(7)] + [(9, [3e38, 1.0, 2.0])]
    found = whitening.whiten(frame(spark, rows)).collect()
    assert {r["vec_id"] for r in found} == {*range(7), 9} and all(math.isfinite(r["whitened"]) for r in found)
    assert {r["deviation"] for r in found if r["vec_id"] == 9} == {None}
