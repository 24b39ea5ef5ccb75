"""Personal data: patterns against plain regular expressions, messages against enumeration, planted mentions."""

import hashlib
import itertools
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from affilspark.llm import personal, skipchain
from affilspark.llm.skipchain import EDGES, K

SF = "/root/testdata/sf0.001"
KINDS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(d[::-1])) % 10 == 0


def base(text):
    out = []
    for kind, pattern in KINDS.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else 0, "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(["@", ".", "a", "B-", "é", "1", "25", "300", "0", "+", "+4", " ", "(", ")", "-", "4111 1111", "11111111", "\n", "a@b.c", "_x@d.e", "1.2.3.4", "[at]", " (dot) ", "+1 (743) 555-3824", "😀"]), max_size=14).map("".join))
def test_patterns(text):
    assert [f"{skipchain.LABELS[k]}:{s}:{e}" for k, s, e in personal.graph(text)[0]] == base(text)
    _, nodes, features, edges = personal.graph(text)
    assert len(nodes) == len(features) and all(0 <= u < v < len(nodes) for u, v, _ in edges)
    free = [(s, e) for s, e, k in nodes if not k]
    given_ = [(s, e) for s, e, k in nodes if k]
    assert all(e <= a or s >= b for s, e in free for a, b in given_)


def test_beliefs_on_trees():
    rng = np.random.default_rng(1)
    for n in (2, 4, 5):
        edges = np.array([(rng.integers(0, i), i, rng.integers(0, EDGES)) for i in range(1, n)])
        unary, pot = rng.normal(size=(n, K)), rng.normal(size=(EDGES, K, K))
        node, pair = np.zeros((n, K)), np.zeros((n - 1, K, K))
        for y in itertools.product(range(K), repeat=n):
            p = np.exp(sum(unary[i, y[i]] for i in range(n)) + sum(pot[k, y[u], y[v]] for u, v, k in edges))
            node[np.arange(n), y] += p
            pair[np.arange(n - 1), [y[u] for u, _, _ in edges], [y[v] for _, v, _ in edges]] += p
        got_node, got_pair = skipchain.beliefs(unary, edges, pot, rounds=40)
        assert np.allclose(got_node, node / node.sum(axis=1, keepdims=True), atol=1e-4)
        assert np.allclose(got_pair, pair / pair.sum(axis=(1, 2), keepdims=True), atol=1e-4)


def test_gradient():
    """Against differences of the log-likelihood by enumeration, with one node fixed."""
    rng = np.random.default_rng(2)
    features, edges = np.array([[0, 1], [1, 2], [0, 2]]), np.array([[0, 1, 0], [1, 2, 1]])
    labels, fixed = np.array([1, 2, 1]), np.array([-1, 2, -1])
    w = rng.normal(size=4 * K + EDGES * K * K)  # the fourth feature is filler

    def value(w):
        unary, pot = w[: 4 * K].reshape(4, K)[features].sum(axis=1), w[4 * K :].reshape(EDGES, K, K)
        s = lambda y: sum(unary[i, y[i]] for i in range(3)) + sum(pot[k, y[u], y[v]] for u, v, k in edges)
        return s(labels) - np.log(sum(np.exp(s((a, 2, b))) for a in range(K) for b in range(K)))

    g = skipchain.gradient(w, features, edges, labels, fixed)
    for i in range(0, len(w), 7):
        d = np.zeros(len(w))
        d[i] = 1e-5
        assert abs((value(w + d) - value(w - d)) / 2e-5 - g[i]) < 1e-3


PLANTED = [
    ("call +1 (743) 555-3824 today. Again: 743-555-3824 or 743 555 3824, in 2024.", ["phone:5:22", "phone:37:49", "phone:53:65"]),
    ("write to ann.lee9@mail2.example.com or ann.lee9 [at] mail2 [dot] example [dot] com", ["email:9:35", "email:39:82"]),
    ("the name ann.lee9 is of Ann.Lee9@mail2.example.com", ["email:9:17", "email:24:50"]),
    ("host 152.143.123.131 alias 152-143-123-131", ["ip:5:20", "ip:27:42"]),
]
CLEAN = ["order 743-555-3824 of 1999", "999.1.2.3 and 4111111111111112", "ann.lee9 at home, a@b", "tel 555-3824, room 12, 3 4 5 6 7 8 9", "x [at] y [dot] z", "+12 and 1.2.3"]


def test_planted_and_clean(spark):
    rows = [(i, t) for i, (t, _) in enumerate(PLANTED)] + [(100 + i, t) for i, t in enumerate(CLEAN)]
    more = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id + 1000 as doc_id", "text")
    got = {r.id: r for r in personal.personal_data(spark.createDataFrame(rows, "doc_id long, text string").union(more)).collect()}
    shown = lambda spans: [f"{s.kind}:{s.start}:{s.end}" for s in spans]
    for i, (_, want) in enumerate(PLANTED):
        assert shown(got[i].spans) == want
    for i in range(len(CLEAN)):
        assert got[100 + i].spans == got[100 + i].base == []
    assert all(set(shown(r.base)) <= set(shown(r.spans)) for r in got.values())


def test_op11(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate([None, "", " \n", "é😀 a@b.co", "+1 (743) 555-3824 " * 3000, "x" * 300_000, "1" * 300_000, "@" * 2000, "1 " * 50_000, "a@b.co, a@b.co", "a@b.co, a@b.co"])] + [(None, "1.2.3.4"), (3, "é😀 a@b.co")]
    d = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "2 as base", "3 as spans", "4 as nodes", "5 as features")
    (tmp_path / "x").mkdir()
    d.write.parquet(str(tmp_path / "x/documents.parquet"))
    got = personal.op11_personal_data(spark, str(tmp_path / "x")).collect()
    want = []
    for i, t in rows:
        b = base(t if t is None or len(t) < 100_000 else t[:10])  # the plain patterns are quadratic on long runs, which hold nothing
        n = {k: sum(x.startswith(k + ":") for x in b) for k in KINDS}
        want.append((i, *n.values(), hashlib.sha256(",".join(b).encode()).hexdigest()))
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(want, key=str)
    assert personal.personal_data(d.limit(0)).count() == 0
