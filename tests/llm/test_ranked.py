"""Best positions against scoring every document."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedloom.llm import ranked

DOCS = "doc_id long, text string, n long, terms string, tf int, shard int, block int"
ITEMS = "item_id long, text string, term string, w long, rank int"


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda c: c.group().lower(), text or ""))


def plain(docs, items, k=20):
    held = [(i, terms_of(t)) for i, t in docs]
    held = [(i, Counter(t), len(t)) for i, t in held if t]
    n_docs, total = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    found = []
    for item in sorted({i for i, _ in items if i is not None}):
        query = Counter(t for text in {t for i, t in items if i == item} for t in terms_of(text))
        scores = []
        for i, counts, n in held:
            m = 75 + 25 * n * n_docs // total
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * counts[t] // (1000 * counts[t] + 12 * m)) for t, q in query.items() if counts[t])
            if score > 0 and i is not None:
                scores.append((-score, i))
        found += [(item, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return found


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(i, t, 1, "t", 2, 3, 4) for i, t in docs], DOCS),
        spark.createDataFrame([(i, t, "x", 5, 6) for i, t in items], ITEMS),
    )


@given(st.integers(1, 60), st.integers(1, 6), st.integers(1, 5), st.integers(1, 3), st.integers(0, 2**32))
@settings(max_examples=200, deadline=None)
def test_a_shard_returns_the_best(documents, terms, k, step, seed):
    r = np.random.default_rng(seed)
    held = r.random((documents, terms)) < 0.6
    document, term = np.nonzero(held)
    impact = r.integers(0, 6, len(document))  # many ties, some of nothing
    times = r.integers(1, 3, terms)
    index = ranked.Shard(np.arange(documents) * 3, document, term, impact, terms)
    places, scores, _ = index.best(np.arange(terms), times, k, step)
    full = np.zeros(documents, np.int64)
    np.add.at(full, document, impact * times[term])
    expected = [(-s, i) for i, s in enumerate(full) if s > 0]
    assert list(zip((-scores).tolist(), places.tolist())) == sorted(expected)[:k]


def test_reading_stops_early():
    r = np.random.default_rng(1)
    n = 20_000
    document, term = np.tile(np.arange(n), 2), np.repeat([0, 1], n)
    impact = (1e6 / (1 + r.permutation(n))).astype(np.int64)
    index = ranked.Shard(np.arange(n), document, term, np.r_[impact, impact], 2)
    places, scores, read = index.best(np.array([0, 1]), np.array([1, 1]), 20)
    assert places.tolist() == np.argsort(-impact, kind="stable")[:20].tolist() and read < 200
    # equal scores beyond the k-th have to be met: the bound must fall strictly below
    flat = ranked.Shard(np.arange(n), np.arange(n), np.zeros(n, np.int64), np.full(n, 7), 1)
    places, scores, read = flat.best(np.array([0]), np.array([1]), 20)
    assert places.tolist() == list(range(20)) and read == n


def test_impacts_of_huge_tables_do_not_wrap():
    n = np.array([10**7, 3], np.int64)
    found = ranked.impacts(np.array([5, 1]), n, np.array([9000, 9000]), 10**12, 10**15)
    assert found.tolist() == [9000 * (10**9 * t // (1000 * t + 12 * (75 + 25 * x * 10**12 // 10**15))) for t, x in ((5, 10**7), (1, 3))]


@pytest.mark.parametrize("settings_", [{}, {"shard_postings": 40, "block_pairs": 7}])
def test_rows_of_all_kinds(spark, settings_):
    r = np.random.default_rng(2)
    vocabulary = ["the", "river", "Stone", "é", "漢字", "a1", "quiet", "winter", "x", "rare"]
    docs = [(i, " ".join(r.choice(vocabulary[:9], r.integers(1, 25)))) for i in range(90)]
    docs += [(5, docs[5][1]), (200, docs[7][1]), (201, docs[7][1]), (300, None), (301, ""), (302, "... !"), (None, "rare river"), (7, "rare THE stone-river"), (400, "the " * 30_000 + "rare")]
    items = [(1, "The river, stone"), (1, "The river, stone"), (1, "rare"), (2, None), (3, ""), (4, "unheard"), (None, "the"), (5, "x x x a1 É é"), (6, "the " * 500)]
    d, i = frames(spark, docs, items)
    found = sorted(tuple(row) for row in ranked.search(d, i, **settings_).collect())
    assert found == sorted(plain(docs, items))
    assert {r[0] for r in found} == {1, 5, 6}


def test_empty_tables(spark):
    d, i = frames(spark, [(1, "some words")], [(1, "some")])
    assert ranked.search(d.where("false"), i).count() == 0
    assert ranked.search(d, i.where("false")).count() == 0
    assert ranked.search(d, i).count() == 1
