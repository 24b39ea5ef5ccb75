"""Ranked lexical search: MaxScore over blocks of documents, with bounds of term pairs beside those of terms.

An item's terms stand in one order, from frequent to rare. Each block of documents has a list per term and
one per pair of neighbours in an item's order (the documents that hold both, with their joint impact).
Bounds of a prefix combine single and joint maxima; a term list that only its partner could lift over
the threshold is replaced by the pair's list.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from affilspark.llm._spark import cut, small_batches, table, union

#: Documents and postings of a block, terms of the items that one pass over the documents serves.
DOCS, POSTINGS, TERMS = 8192, 1 << 20, 1 << 17
_SPLIT = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of all other characters, in UTF-8, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_SPLIT).split() if text else []


class Asked:
    """Items of one pass: distinct terms by number, from frequent to rare within an item, and the pairs of neighbours."""

    def __init__(self, items: list[list[int]], n_docs: int, n_terms: int, df: np.ndarray):
        self.n_docs, self.n_terms = n_docs, n_terms
        self.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        self.items = [np.array(sorted(x, key=lambda t: (self.weight[t], t)), np.int64) for x in items]
        width = len(df)
        near = [x[:-1] * width + x[1:] for x in self.items]
        self.pairs = np.unique(np.concatenate(near)) if near else np.zeros(0, np.int64)
        self.left, self.right = self.pairs // max(width, 1), self.pairs % max(width, 1)
        self.near = [np.searchsorted(self.pairs, x) for x in near]

    def impacts(self, term: np.ndarray, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 50 + (50 * n * self.n_docs) // self.n_terms
        return self.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def _lists(key: np.ndarray, doc: np.ndarray, impact: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """keys, starts (and the end), documents and impacts of lists, from entries ordered by key and document."""
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return key[start], np.r_[start, len(key)], doc, impact


def _block(asked: Asked, term: np.ndarray, doc: np.ndarray, tf: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """Term lists and pair lists of a block's postings (document positions ascending)."""
    order = np.lexsort((doc, term))
    term, doc, tf = term[order], doc[order], tf[order]
    keys, starts, doc, impact = _lists(term, doc, asked.impacts(term, tf, n[doc]))
    size = np.zeros(len(asked.weight), np.int64)
    size[keys] = np.diff(starts)
    head = np.zeros(len(asked.weight), np.int64)
    head[keys] = starts[:-1]
    swap = size[asked.left] > size[asked.right]
    short, long = np.where(swap, asked.right, asked.left), np.where(swap, asked.left, asked.right)
    place = term * np.int64(len(n)) + doc
    got = []
    count = np.where(size[long] > 0, size[short], 0)
    total = np.cumsum(count)
    lo = 0
    while lo < len(count):  # the shorter list of each pair is looked up in the longer one
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + POSTINGS, "right")))
        c = count[lo:hi]
        pair = np.repeat(np.arange(lo, hi), c)
        at = head[short[pair]] + np.arange(len(pair)) - np.repeat(np.cumsum(c) - c, c)
        want = long[pair] * np.int64(len(n)) + doc[at]
        to = np.minimum(np.searchsorted(place, want), len(place) - 1)
        hit = place[to] == want
        got.append((pair[hit], doc[at[hit]], impact[at[hit]] + impact[to[hit]]))
        lo = hi
    pairs = _lists(*(np.concatenate([g[i] for g in got]) if got else np.zeros(0, np.int64) for i in range(3)))
    return [keys, starts, doc, impact, *pairs]


_PARTS = ("term", "term_at", "term_doc", "term_impact", "pair", "pair_at", "pair_doc", "pair_impact")


def _counted(vocabulary):
    """(id, n, terms, tfs) of each text that has a term; terms of the items only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value.get
        for batch in batches:
            texts, n, term, tf, ends = batch.column(1), [], [], [], [0]
            for i in range(batch.num_rows):
                found = terms_of(texts[i].as_py())
                count = Counter(map(known, found))
                count.pop(None, None)
                n.append(len(found))
                term.extend(count.keys())
                tf.extend(count.values())
                ends.append(len(term))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (term, tf)]
            out = pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), *lists], names=["id", "n", "terms", "tfs"])
            yield out.filter(pc.greater(out.column(1), 0))

    return run


def _indexed(shared):
    """A row per block: document ids in order, and its lists."""

    def make(asked: Asked, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(parts).combine_chunks()
        whole = whole.take(pc.sort_indices(whole, sort_keys=[("id", "ascending")])).combine_chunks()
        ids, n, terms, tfs = (whole.column(i).combine_chunks() for i in range(4))
        size = np.diff(terms.offsets.to_numpy())
        flat = lambda x: x.flatten().to_numpy().astype(np.int64)
        lists = _block(asked, flat(terms), np.repeat(np.arange(len(size)), size), flat(tfs), n.to_numpy())
        held = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        return pa.RecordBatch.from_arrays([held(ids), *[held(pa.array(x, pa.int64())) for x in lists]], names=["ids", *_PARTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, parts, docs, postings = shared.value, [], 0, 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                part = part.filter(pc.greater(pc.list_value_length(part.column(2)), 0))
                if not part.num_rows:
                    continue
                parts.append(part)
                docs, postings = docs + part.num_rows, postings + len(part.column(2).flatten())
                if docs >= DOCS or postings >= POSTINGS:
                    yield make(asked, parts)
                    parts, docs, postings = [], 0, 0
        if parts:
            yield make(asked, parts)

    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.column(0)[i].values, [batch.column(j)[i].values.to_numpy() for j in range(1, 9)]


def _levels(width: int):
    """(key, level, n, least): how many documents of a term (key < width) or pair have an impact of each level, and the least of these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (term, term_at, _d, term_impact, pair, pair_at, _e, pair_impact) in _blocks(batches):
            key = np.r_[np.repeat(term, np.diff(term_at)), width + np.repeat(pair, np.diff(pair_at))]
            impact = np.r_[term_impact, pair_impact]
            key, impact = key[impact > 0], impact[impact > 0]
            level = np.floor(8 * np.log2(impact)).astype(np.int64)
            order = np.lexsort((impact, level, key))
            key, level, impact = key[order], level[order], impact[order]
            first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (level[1:] != level[:-1])][: len(key)])
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (key[first], level[first], np.diff(np.r_[first, len(key)]), impact[first])], names=["key", "level", "n", "least"])

    return run


def thresholds(asked: Asked, levels: pa.Table, k: int) -> np.ndarray:
    """For each item a score that k documents reach, by one of its terms or pairs alone; 1 where none has k."""
    width = len(asked.weight)
    out = np.ones(width + len(asked.pairs), np.int64)
    key, level, n, least = (levels.column(c).to_numpy() for c in ("key", "level", "n", "least"))
    order = np.lexsort((-level, key))
    key, n, least = key[order], n[order], least[order]
    begin = np.searchsorted(key, key)
    sofar = np.cumsum(n)
    sofar = sofar - (sofar - n)[begin]
    enough = np.flatnonzero(sofar >= k)
    np.maximum.at(out, key[enough], least[enough])
    return np.array([max([1, *out[t].tolist(), *out[width + p].tolist()]) for t, p in zip(asked.items, asked.near, strict=True)], np.int64)


def candidates(bound: list[int], most: list[int], terms: list[int], pairs: list[int], theta: int) -> tuple[int, int]:
    """(m, p): a document below theta for sure unless it holds a term from p on, or both terms of (m, m+1), (m+2, m+3) ... before p.

    bound[i]: what the first i terms can add up to, rising; most: each term's maximum; terms and pairs: the lengths of
    the lists, of which those with the fewest documents are chosen.
    """
    last = bisect_left(bound, theta) - 1
    best = (sum(terms[last:]), last, last)
    for m in range(last - 1, max(last - 9, -1), -1):
        p, total, docs = m, bound[m], 0
        while p + 2 <= len(most) and total + max(most[p], most[p + 1]) < theta:
            total += max(most[p], most[p + 1])
            docs += pairs[p]
            p += 2
        if p > last:
            best = min(best, (docs + sum(terms[p:]), m, p))
    return best[1:]


def _joined(most: list[int], joint: list[int]) -> list[int]:
    """Bounds of prefixes: the least sum over all ways to cover the terms one by one or as pairs of neighbours."""
    out = [0]
    for i, x in enumerate(most):
        out.append(max(out[-1], min(out[-1] + x, out[-2] + joint[i - 1])) if i else x)
    return out


def _best_of(terms: np.ndarray, near: np.ndarray, lists: list[np.ndarray], of_term: np.ndarray, of_pair: np.ndarray, most: np.ndarray, joint: np.ndarray, theta: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and scores of a block's documents that reach theta for one item, the k best at most, ties to smaller positions."""
    _, term_at, term_doc, term_impact, _, pair_at, pair_doc, _ = lists
    own = most[terms]
    bound = _joined(own.tolist(), np.maximum(joint[near], np.maximum(own[:-1], own[1:])).tolist())
    none = np.zeros(0, np.int64)
    if bound[-1] < theta:
        return none, none
    held = lambda at, which: [int(at[i + 1] - at[i]) if i >= 0 else 0 for i in which.tolist()]
    m, p = candidates(bound, own.tolist(), held(term_at, of_term[terms]), held(pair_at, of_pair[near]), theta)
    span = lambda at, i: slice(at[i], at[i + 1]) if i >= 0 else slice(0, 0)
    docs = [pair_doc[span(pair_at, of_pair[near[i]])] for i in range(m, p, 2)] + [term_doc[span(term_at, of_term[t])] for t in terms[p:]]
    docs = np.unique(np.concatenate(docs)) if docs else none
    score = np.zeros(len(docs), np.int64)
    for i in range(len(terms) - 1, -1, -1):
        live = score + bound[i + 1] >= theta
        docs, score = docs[live], score[live]
        if not len(docs):
            return none, none
        at = span(term_at, of_term[terms[i]])
        mine = term_doc[at]
        if len(mine):
            to = np.minimum(np.searchsorted(mine, docs), len(mine) - 1)
            score = score + np.where(mine[to] == docs, term_impact[at][to], 0)
    docs, score = docs[score >= theta], score[score >= theta]
    if len(docs) > k:
        order = np.lexsort((docs, -score))[:k]
        docs, score = docs[order], score[order]
    return docs, score


def _search(shared, theta: np.ndarray, k: int):
    """The k best documents of a partition for each item, of those that reach the item's threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, least = shared.value, theta.copy()
        best: pa.Table | None = None
        for ids, lists in _blocks(batches):
            term, term_at, _, term_impact, pair, pair_at, _, pair_impact = lists
            of_term, of_pair = np.full(len(asked.weight), -1), np.full(len(asked.pairs), -1)
            of_term[term], of_pair[pair] = np.arange(len(term)), np.arange(len(pair))
            most, joint = np.zeros(len(asked.weight), np.int64), np.zeros(len(asked.pairs), np.int64)
            if len(term):
                most[term] = np.maximum.reduceat(term_impact, term_at[:-1])
            if len(pair):
                joint[pair] = np.maximum.reduceat(pair_impact, pair_at[:-1])
            found = [_best_of(t, p, lists, of_term, of_pair, most, joint, int(x), k) for t, p, x in zip(asked.items, asked.near, least, strict=True)]
            item = np.repeat(np.arange(len(found)), [len(d) for d, _ in found])
            if not len(item):
                continue
            docs, score = (np.concatenate([f[i] for f in found]) for i in range(2))
            rows = pa.table({"item": item, "id": ids.take(pa.array(docs)), "score": score})
            rows = rows if best is None else pa.concat_tables([best, rows])
            rows = rows.take(pc.sort_indices(rows, sort_keys=[("item", "ascending"), ("score", "descending"), ("id", "ascending")]))
            item = rows.column("item").to_numpy()
            place = np.arange(len(item)) - np.searchsorted(item, item)
            best = rows.filter(pa.array(place < k)).combine_chunks()
            full = place == k - 1
            np.maximum.at(least, item[full], rows.column("score").to_numpy()[full])
        if best is not None:
            yield from best.to_batches()

    return run


def _of_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([sorted(set(terms_of(x.as_py()))) for x in batch.column(1)], pa.list_(pa.binary()))], names=["item_id", "terms"])


def search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k documents of highest score above 0 for each row of items, equal scores by id (null last).

    A score sums over the item's distinct terms weight * saturated frequency, in whole numbers. The pass over
    the texts keeps the counts of the items' terms; N, lengths and document frequencies cover all
    documents. An index of blocks has the list of each term and of each pair of neighbours, and a first
    threshold per item is the k-th best impact of one of its terms or pairs. Tasks then search their
    blocks and send at most k rows an item. Items are broadcast in groups of about TERMS terms, each with a
    pass over the documents. Items or documents that are null or without terms give no rows; repeated rows
    are rows of their own, so an item_id that occurs twice gets its ranks twice; empty tables give
    no rows; other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind, item_kind = dict(texts.dtypes)["id"], items.select(F.col(item_col).alias("i")).dtypes[0][1]
    wanted = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text")).mapInArrow(_of_items, f"item_id {item_kind}, terms array<binary>")
    wanted = cut(wanted.where(F.size("terms") > 0).withColumn("uid", F.monotonically_increasing_id()))
    chunks = math.ceil((wanted.agg(F.sum(F.size("terms"))).first()[0] or 0) / TERMS)
    found = []
    for chunk in range(chunks):
        own = wanted.where(F.pmod(F.xxhash64("uid"), F.lit(chunks)) == chunk)
        got = own.select("uid", "terms").toArrow().to_pylist()
        if not got:
            continue
        number: dict[bytes, int] = {}
        lists = [[number.setdefault(t, len(number)) for t in x["terms"]] for x in got]
        counted = cut(texts.mapInArrow(_counted(spark.sparkContext.broadcast(number)), f"id {kind}, n long, terms array<int>, tfs array<int>"))
        n_docs, n_terms = counted.agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            break
        df = np.zeros(len(number), np.int64)
        each = counted.select(F.explode("terms").alias("t")).groupBy("t").count().toArrow()
        df[each.column(0).to_numpy()] = each.column(1).to_numpy()
        asked = Asked(lists, n_docs, n_terms, df)
        shared = spark.sparkContext.broadcast(asked)
        index = cut(counted.mapInArrow(_indexed(shared), f"ids array<{kind}>, " + ", ".join(f"{c} array<long>" for c in _PARTS)))
        levels = index.mapInArrow(_levels(len(number)), "key long, level long, n long, least long").groupBy("key", "level").agg(F.sum("n").alias("n"), F.min("least").alias("least"))
        theta = thresholds(asked, levels.toArrow(), k)
        rows = index.mapInArrow(_search(shared, theta, k), f"item long, id {kind}, score long")
        rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id")))
        rows = rows.withColumn("rank", rank).where(F.col("rank") <= k)
        uids = spark.createDataFrame([(i, x["uid"]) for i, x in enumerate(got)], "item long, uid long")
        found.append(rows.join(uids, "item").join(own.select("uid", "item_id"), "uid").select("item_id", "rank", F.col("id").alias("doc_id"), "score"))
    return union(found) if found else spark.createDataFrame([], f"item_id {item_kind}, rank int, doc_id {kind}, score long")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of all for each benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"list_transform(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))"
#: DuckDB: every posting of every item's terms, summed.
OP13_SQL = f"""
WITH d AS (SELECT doc_id, len(t) AS n, t FROM (SELECT doc_id, {_TERMS} AS t FROM documents WHERE text IS NOT NULL) WHERE len(t) > 0),
s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM d),
i AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark WHERE text IS NOT NULL),
p AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM i) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
w AS (SELECT doc_id, term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // terms))) AS impact
  FROM p JOIN f USING (term), s),
r AS (SELECT item_id, doc_id, CAST(sum(impact) AS BIGINT) AS score FROM i JOIN w USING (term) GROUP BY ALL HAVING sum(impact) > 0),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 50
"""
