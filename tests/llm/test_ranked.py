"""Ranked search against scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from affilspark.llm import ranked

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in _TERM.findall(text or "")]


def brute(docs, items, k):
    texts = [(i, plain(t)) for i, t in docs]
    texts = [(i, t) for i, t in texts if t]
    n, length = len(texts), sum(len(t) for _, t in texts)
    counts = [Counter(t) for _, t in texts]
    df = Counter(x for c in counts for x in c)
    out = []
    for item, text in items:
        scored = []
        for (i, t), c in zip(texts, counts, strict=True):
            m = 100 - 50 + (50 * len(t) * n) // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * ((10**9 * c[x]) // (1000 * c[x] + 20 * m)) for x in set(plain(text)) if c[x])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return out


def rows(rng, n, vocabulary=40, longest=30):
    return " ".join(f"T{min(int(rng.expovariate(0.12)), vocabulary)}" for _ in range(rng.randint(0, longest)))


@pytest.mark.parametrize("small", [False, True])
def test_search(spark, monkeypatch, small):
    if small:  # several blocks, and items in several groups
        monkeypatch.setattr(ranked, "DOCS", 16)
        monkeypatch.setattr(ranked, "POSTINGS", 100)
        monkeypatch.setattr(ranked, "TERMS", 30)
    rng = random.Random(5)
    docs = [(i, rows(rng, i)) for i in range(300)] + [(400 + i, "t1 t2 t3") for i in range(30)]
    docs += [(7, "t1 t9"), (7, "t1 t9"), (None, "t1 t2 t39"), (500, None), (501, ""), (502, " .,; "), (503, "Éa_éa-T1 ÉA"), (504, "t5 " * 5000), (505, "x" * 100_000 + " T2")]
    items = [(i, rows(rng, i, 40, 12)) for i in range(25)] + [(100, "t1 t2 t3"), (101, None), (102, "?"), (103, "nowhere"), (104, "éa éa Éa t1"), (100, "t1 t2 t3")]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as id", "2 as n", "3 as terms", "4 as score", "5 as item")
    q = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as uid", "2 as doc_id", "3 as terms")
    for k in (3, 50):
        got = [tuple(r) for r in ranked.search(d, q, k=k).collect()]
        assert sorted(got, key=str) == sorted(brute(docs, items, k), key=str)


def test_text_ids_and_empty_tables(spark):
    docs, items = [("b", "x y"), ("a", "x y"), ("c", "y")], [("q", "x")]
    d, q = spark.createDataFrame(docs, "doc_id string, text string"), spark.createDataFrame(items, "item_id string, text string")
    assert [tuple(r)[:3] for r in ranked.search(d, q).orderBy("rank").collect()] == [("q", 1, "a"), ("q", 2, "b")]
    assert ranked.search(d.limit(0), q).count() == 0 and ranked.search(d, q.limit(0)).count() == 0


def test_bounds():
    """No document outside the candidates reaches the threshold; pair lists stand in for term lists where they can."""
    rng, used = np.random.default_rng(2), 0
    for _ in range(300):
        terms = rng.integers(2, 7)
        hold = rng.random((60, terms)) < np.linspace(0.5, 0.1, terms)
        impact = rng.integers(1, 60, (60, terms)) * hold * np.linspace(1, 3, terms).astype(int)
        joint = np.array([(impact[:, i] + impact[:, i + 1]).max() for i in range(terms - 1)])
        own = impact.max(axis=0).tolist()
        bound = ranked._joined(own, joint.tolist())
        assert (bound[1:] <= np.cumsum(own)).all() and (bound[-1] >= impact.sum(axis=1)).all() and bound == sorted(bound)
        theta = int(np.quantile(impact.sum(axis=1), 0.9)) + 1
        if bound[-1] < theta:
            continue
        both = [int((hold[:, i] & hold[:, i + 1]).sum()) for i in range(terms - 1)]
        m, p = ranked.candidates(bound, own, hold.sum(axis=0).tolist(), both, theta)
        used += p > m
        seen = hold[:, p:].any(axis=1)
        for i in range(m, p, 2):
            seen |= hold[:, i] & hold[:, i + 1]
        assert (impact.sum(axis=1)[~seen] < theta).all()
    assert used > 20
