"""Personal data: patterns with checks, and a skip-chain CRF that finds their other mentions in a document."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affilspark.llm import skipchain
from affilspark.llm._spark import cut, small_batches, table
from affilspark.llm.skipchain import LABELS

#: Documents with spans that the weights are learned from (those of least hash), passes over them, and the
#: posterior from which a linked mention is reported.
SAMPLE, STEPS, SURE = 2000, 10, 0.5

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*+")
_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")  # a digit run that fails at its first digit fails at all
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_CARRIER = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+")
_AT = re.compile(r"\x20?[\[({]\x20?at\x20?[\])}]\x20?", re.I)
_DOTTED = re.compile(r"[A-Za-z0-9-]+(?:(?:\.|\x20?[\[({]\x20?dot\x20?[\])}]\x20?)[A-Za-z0-9-]+)+", re.I)
_NUMBER = re.compile(r"[+(0-9][0-9().+-]*[.,;:]?")
_LOCALS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")

_BIAS, _FAILED, _SHAPE, _DIGITS, _GROUPS, _SIGNS, _BEFORE = 0, 1, 6, 10, 32, 40, 48
FEATURES, WIDTH = 48 + 64 + 1, 12  # the last one says nothing
_NOTHING = FEATURES - 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int, bool]]:
    """Each @ with what stands before it since the last match, and a host; those without are failures."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCALS:
            start -= 1
        host = _HOST.match(text, at + 1)
        if start < at and host:
            end = host.end()
            yield start, end, True
        elif start < at:
            yield start, at + 1, False
        at = text.find("@", max(at + 1, end))


def matches(text: str) -> list[list[tuple[int, int, bool]]]:
    """(start, end, whether its check holds) of the leftmost non-overlapping matches of email, ip, card and phone."""
    ip = [(m.start(), m.end(), all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m[0].split("."))) for m in _IP.finditer(text)]
    card = [(m.start(), m.end(), 13 <= len(d := _digits(m[0])) <= 19 and _luhn(d)) for m in _CARD.finditer(text)]
    phone = [(m.start(), m.end(), 9 <= len(_digits(m[0])) <= 15) for m in _PHONE.finditer(text)]
    return [list(_emails(text)), ip, card, phone]


def _mentions(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, shape) of what might be a mention outside the base spans: runs of number words (0), words with @ (1), with digits (2), spelled-out addresses (3)."""
    taken, spelled, i = sorted(taken), [], 0
    for m in _AT.finditer(text):
        start, host = m.start(), _DOTTED.match(text, m.end())
        while start > (spelled[-1][1] if spelled else 0) and text[start - 1] in _LOCALS:
            start -= 1
        if start < m.start() and host:
            while i < len(taken) and taken[i][1] <= start:
                i += 1
            if i == len(taken) or taken[i][0] >= host.end():
                spelled.append((start, host.end(), 3))
    taken, found, i = sorted(taken + [x[:2] for x in spelled]), list(spelled), 0
    for m in _CARRIER.finditer(text):
        start, end = m.span()
        while i < len(taken) and taken[i][1] <= start:
            i += 1
        if i < len(taken) and taken[i][0] < end:
            continue
        if _NUMBER.fullmatch(m[0]):
            if found and found[-1][2] == 0 and 0 <= start - found[-1][1] == 1 and text[start - 1] in " -":
                found[-1] = (found[-1][0], end, 0)
            else:
                found.append((start, end, 0))
        else:
            found.append((start, end, 1 if "@" in m[0] else 2))
    trimmed = []
    for start, end, shape in found:
        while start < end and not (text[start].isalnum() or text[start] in "+("):
            start += 1
        while end > start and not text[end - 1].isalnum():
            end -= 1
        if start < end:
            trimmed.append((start, end, shape))
    return trimmed


def _names(text: str, shape: int) -> tuple[str | None, str | None]:
    """What equal mentions share, and what similar ones share: the last 7 digits of a number, the part of an address before its @."""
    plain = text.lower()
    if shape == 3:
        plain = re.sub(r"\x20?[\[({]\x20?dot\x20?[\])}]\x20?", ".", _AT.sub("@", plain, count=1))
    if "@" in plain:
        return plain, "@" + plain.split("@")[0]
    digits = _digits(plain)
    if any(c.isalpha() for c in plain):
        return plain, "@" + plain if len(plain) > 4 else None
    return (plain, digits[-7:]) if len(digits) >= 7 else (None, None)


def graph(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], list[list[int]], list[tuple[int, int, int]]]:
    """Base spans (label, start, end), then all nodes (start, end, label, 0 where not base), their features, and edges (node, node, kind)."""
    if not text or not re.search("[0-9@]|" + _AT.pattern, text, re.I):
        return [], [], [], []
    each = matches(text)
    base = [(k, s, e) for k, ms in enumerate(each, 1) for s, e, ok in ms if ok]
    failed = [(s, e, k) for k, ms in enumerate(each, 1) for s, e, ok in ms if not ok]
    nodes = sorted([(s, e, k, -1) for k, s, e in base] + [(s, e, 0, shape) for s, e, shape in _mentions(text, [(s, e) for _, s, e in base])])
    fails: dict[int, set[int]] = {}
    failed.sort()
    j = 0
    for i, (s, e, _, _) in enumerate(nodes):
        while j < len(failed) and failed[j][1] <= s:
            j += 1
        for f in failed[j : j + 8]:
            if f[0] < e and f[1] > s:
                fails.setdefault(i, set()).add(f[2])
    features, edges, held = [], [], {}
    for i, (s, e, label, shape) in enumerate(nodes):
        own = text[s:e]
        shape = shape if shape >= 0 else 1 if label == 1 else 0
        digits = _digits(own)
        before = text[max(0, s - 24) : s].split()
        row = [_BIAS, _SHAPE + shape, _DIGITS + min(len(digits), 21), _GROUPS + min(len(re.findall("[0-9]+", own[:200])), 7), _BEFORE + (zlib.crc32(before[-1].lower().encode("utf-8", "replace")) % 64 if before else 0)]
        row += [_SIGNS + k for k, c in enumerate("+(.-") if c in own]
        row += [_FAILED + k for k in sorted(fails.get(i, ())) if not label][:3]
        features.append((row + [_NOTHING] * WIDTH)[:WIDTH])
        if i and s - nodes[i - 1][1] <= 40:
            edges.append((i - 1, i, 0))
        for kind, name in zip((1, 2), _names(own, shape), strict=True):
            if name is not None:
                last, first_base = held.get((kind, name), (None, None))
                if last is not None:
                    edges.append((last, i, kind))
                if first_base is not None and first_base != last:
                    edges.append((first_base, i, kind))
                held[kind, name] = (i, i if first_base is None and label else first_base)
    return base, [(s, e, k) for s, e, k, _ in nodes], features, edges


_INTS = ("base", "nodes", "features", "edges")


def _graphs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column(1)
        rows = [[[x for row in part for x in row] for part in graph(column[i].as_py())] for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([r[k] for r in rows], pa.list_(pa.int32())) for k in range(4)]], names=["id", *_INTS])


def _together(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Nodes (start, end, label), features and edges of all documents of a batch, and each document's first node (and the end)."""
    nodes, features, edges = (batch.column(c) for c in ("nodes", "features", "edges"))
    size = np.diff(nodes.offsets.to_numpy()) // 3
    first = np.r_[0, np.cumsum(size)]
    links = edges.flatten().to_numpy().reshape(-1, 3).astype(np.int64)
    links[:, :2] += np.repeat(first[:-1], np.diff(edges.offsets.to_numpy()) // 3)[:, None]
    return nodes.flatten().to_numpy().reshape(-1, 3).astype(np.int64), features.flatten().to_numpy().reshape(-1, WIDTH).astype(np.int64), links, first


def _evidence(nodes: np.ndarray) -> np.ndarray:
    """Training: of the base spans about half, by their place, are given; the others and all else are to be told."""
    place = (nodes[:, 0] * 2654435761 >> 7) & 1
    return np.where((nodes[:, 2] > 0) & (place == 1), nodes[:, 2], -1)


def learned(graphs: DataFrame, sample: int = SAMPLE, steps: int = STEPS) -> np.ndarray:
    """Weights from at most `sample` documents that have base spans and another node.

    Each step sums the gradients of the documents in the tasks; the driver sees a row of weights a task. Labels are
    the base spans and "none" elsewhere, but not known for nodes that equal or resemble a base span. Without
    such documents the prior stays.
    """
    weights = start = skipchain.prior(FEATURES, _BIAS, {_FAILED + k: k for k in range(1, len(LABELS))})
    chosen = graphs.where((F.size("base") > 0) & (F.size("nodes") > 3)).select("nodes", "features", "edges")
    chosen = cut(chosen.orderBy(F.xxhash64("nodes", "features"), "nodes").limit(sample).repartition(8))
    if chosen.isEmpty():
        return weights
    for _ in range(steps):

        def summed(batches, weights=weights):
            total, n = np.zeros(len(weights)), 0
            for batch in batches:
                for lo in range(0, batch.num_rows, 64):
                    nodes, features, edges, _ = _together(pa.RecordBatch.from_struct_array(batch.slice(lo, 64).to_struct_array()))
                    labels = np.where(_linked(len(nodes), edges, nodes[:, 2] > 0) & (nodes[:, 2] == 0), -1, nodes[:, 2])
                    total += skipchain.gradient(weights, features, edges, labels, _evidence(nodes))
                    n += len(nodes)
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64())), pa.array([n], pa.int64())], names=["g", "n"])

        parts = chosen.mapInArrow(summed, "g array<double>, n long").orderBy("n", "g").toArrow()
        slope = np.sum([np.array(g) for g in parts.column(0).to_pylist()], axis=0) / max(1, sum(parts.column(1).to_pylist())) - 0.01 * (weights - start)
        weights = weights + 2 * slope
    return weights


def _linked(n: int, edges: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Nodes that a path of equal or similar ones joins to a known node."""
    seen = known.copy()
    skip = edges[edges[:, 2] > 0]
    while True:
        more = seen.copy()
        np.logical_or.at(more, skip[:, 0], seen[skip[:, 1]])
        np.logical_or.at(more, skip[:, 1], seen[skip[:, 0]])
        if (more == seen).all():
            return seen
        seen = more


def _labelled(weights: np.ndarray):
    """All spans (label, start, end), by label and start, base ones and linked mentions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = pa.RecordBatch.from_struct_array(batch.slice(lo, 256).to_struct_array())
                nodes, features, edges, first = _together(part)
                fixed = np.where(nodes[:, 2] > 0, nodes[:, 2], -1)
                skips = edges[:, 2] > 0
                free = np.flatnonzero(_linked(len(nodes), edges, fixed > 0) & (fixed < 0)) if skips.any() else np.zeros(0, np.int64)
                added = []
                if len(free):
                    unary, potentials = skipchain.scores(weights, features, fixed)
                    node, _ = skipchain.beliefs(unary, edges, potentials)
                    label = node[free].argmax(axis=1)
                    hit = (label > 0) & (node[free, label] >= SURE)
                    doc = np.searchsorted(first, free[hit], "right") - 1
                    added = list(zip(doc.tolist(), label[hit].tolist(), *nodes[free[hit], :2].T.tolist(), strict=True))
                spans = [np.array(b, np.int64).reshape(-1, 3).tolist() for b in part.column("base").to_pylist()]
                for doc, *span in added:
                    spans[doc].append(span)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("base"), pa.array([[x for s in sorted(d) for x in s] for d in spans], pa.list_(pa.int32()))], names=["id", "base", "spans"])

    return run


def _structs(c: str):
    """array of (kind, start, end) from flat triples."""
    names = F.array(*[F.lit(x) for x in LABELS])
    return F.transform(F.sequence(F.lit(0), (F.size(c) / 3).cast("int") - 1), lambda i: F.struct(F.get(names, F.get(c, (3 * i).cast("int"))).alias("kind"), F.get(c, (3 * i + 1).cast("int")).alias("start"), F.get(c, (3 * i + 2).cast("int")).alias("end")))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, base, spans (arrays of kind, start, end in code points, by kind and start), one row for each row of docs.

    base: emails, IP addresses, card and phone numbers by pattern and check. spans: these and their other mentions in the
    document: numbers with the same last seven digits, spelled-out addresses, address names alone. The
    nodes of a document's graph are its base spans (given) and words with digits or an @; neighbours, equal and similar
    nodes share potentials, and loopy message passing gives each free node's posterior. A node is added
    at SURE or more if a path of equal or similar nodes joins it to a base span, so documents without base spans
    gain none. Weights are learned on at most SAMPLE documents. Texts are read once; rows do not see each
    other. Null, empty and blank texts have no spans; repeated rows give a row each; an empty table gives no rows; other
    columns are ignored, whatever their names.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(rows.dtypes)["id"]
    graphs = cut(rows.mapInArrow(_graphs, f"id {kind}, " + ", ".join(f"{c} array<int>" for c in _INTS)))
    found = graphs.mapInArrow(_labelled(learned(graphs)), f"id {kind}, base array<int>, spans array<int>")
    none = F.array().cast("array<struct<kind: string, start: int, end: int>>")
    return found.select("id", *[F.when(F.size(c) > 0, _structs(c)).otherwise(none).alias(c) for c in ("base", "spans")])


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the base spans of all documents, and all spans."""
    found = personal_data(table(spark, sf_dir, "documents"))
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    count = [of(k).alias(f"n_{k}") for k in LABELS[1:]]
    return found.select(F.col("id").alias("doc_id"), *count, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
