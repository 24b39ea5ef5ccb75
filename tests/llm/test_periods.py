"""Periodic runs against brute force, and extensions over the grammar against plain comparison."""

import hashlib
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from affilspark.llm import periods
from affilspark.llm.recompression import Grammar

SF = "/root/testdata/sf0.001"


def brute(w, repeats=4, shortest=6):
    """Every maximal run, from the equality of words q apart."""
    n, ends = len(w), {}
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(shortest, repeats * q):
                ends.setdefault((i, j - i + q), q)
            i = j
    return sorted((s, length, q) for (s, length), q in ends.items())


def mined(texts, **k):
    doc, *rest = periods.runs_of([np.array(t, np.int64) for t in texts], **k)
    out = [[] for _ in texts]
    for d, *run in zip(doc, *rest, strict=True):
        out[d].append(tuple(int(x) for x in run))
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=7), st.integers(1, 9)), max_size=6), max_size=5))
def test_runs(parts):
    texts = [[x for unit, k in p for x in unit * k] for p in parts]
    assert mined(texts) == [brute(t) for t in texts]
    assert mined(texts, repeats=2, shortest=2) == [brute(t, 2, 2) for t in texts]


def test_extensions():
    rng = np.random.default_rng(0)
    for size, kinds in ((300, 2), (500, 5), (200, 1), (400, 60)):
        text = rng.integers(0, kinds, size)
        text[size // 2 :] = text[: size - size // 2]
        s = np.r_[1000, text, 1001]
        g = Grammar(s, np.array([0, size + 1]))
        a, b = rng.integers(1, size + 1, (2, 2000))
        a, b = np.minimum(a, b)[a != b], np.maximum(a, b)[a != b]
        plain = lambda x, y, d: next(k for k in range(size + 2) if s[x + d * k] != s[y + d * k])
        assert g.extend(a, b).tolist() == [plain(x, y, 1) for x, y in zip(a, b, strict=True)]
        assert g.extend_back(a, b).tolist() == [plain(x, y, -1) for x, y in zip(a, b, strict=True)]


def test_grid_in_chunks(monkeypatch):
    monkeypatch.setattr(periods, "POINTS", 7)
    texts = [[0] * 40, [0, 1] * 20 + [2], [], [3]]
    assert mined(texts) == [brute(t) for t in texts]


def want(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_op12(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40).select("doc_id", "text").collect()
    rows = [tuple(r) for r in docs]
    tenth = [i for i in range(1000, 1200) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows += [(i, " ".join(f"w{k % 37}" for k in range(i % 60))) for i in tenth]
    rows += [(2000, None), (2001, ""), (2002, " \t\n"), (2003, "a " * 5), (2004, "a " * 6), (2005, "é x " * 4), (2005, "é x " * 4), (None, "b " * 9), (2006, "z z z z " * 8), (tenth[0], None), (tenth[1], " "), (tenth[2], "one")]
    table = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "2 as runs", "3 as n", "4 as w", "5 as h", "6 as collapsed", "7 as n_words")
    (tmp_path / "x").mkdir()
    table.write.parquet(str(tmp_path / "x/documents.parquet"))
    got = [tuple(r) for r in periods.op12_periodic_runs(spark, str(tmp_path / "x")).collect()]
    assert sorted(got, key=str) == sorted((want(*r) for r in rows), key=str)


def test_long_text_and_empty_table(spark):
    unit = [f"w{i}" for i in range(2000)]
    words = unit * 300 + ["end"] + ["x"] * 100_000
    table = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    (row,) = periods.periodic_runs(table).collect()
    assert [tuple(r) for r in row.runs] == [(0, 600_000, 2000), (600_001, 100_000, 1)]
    assert row.collapsed == " ".join([*unit, "end", "x"]) and row.n_words == 700_001
    assert periods.periodic_runs(table.limit(0)).count() == 0
