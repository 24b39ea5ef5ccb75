"""Hidden Markov language model: Baum-Welch over all training texts, exact scores by the scaled forward recursion.

A token is a word (A-Z lowered) or the end of a text. In the rounds of training frequent words are symbols
of their own and any other word is its class (a hash of its last bytes). A last pass counts the states
of every other word in a table that grows with the vocabulary: a state emits the class, then a word of it
by the word's smoothed count and its own states, with one share for unseen words. So the model
is a distribution over the same tokens as the smoothed unigram base, and the two scores compare.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affilspark.llm import _words as W
from affilspark.llm._spark import cut, fold, small_batches, table, widen

#: Latent states, most words with a symbol of their own in the rounds, word classes, most words whose
#: emissions are sent to every task (the rest are looked up by a join), tokens of a training piece and of its
#: overlap on either side, documents of the start sample, rounds on the sample.
STATES, OWN, CLASSES, HEAD, PIECE, OVERLAP, SAMPLE, WARM = 8, 1 << 14, 1024, 1 << 18, 112, 12, 1000, 12
#: Rounds on all documents end when one gains less than this many log10 a token, or after so many.
GAIN, ROUNDS = 0.005, 8
SMOOTH = 0.1
#: Tokens of its class's states that a word's own states are smoothed with.
PRIOR = 8.0


class Lookup:
    """Positions of 64-bit keys in a fixed set: a direct table, with a search where keys share a slot."""

    def __init__(self, keys: np.ndarray):
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.shift = np.uint64(64 - max(8, int(len(keys)).bit_length() + 2))
        slot = (self.keys >> self.shift).astype(np.int64)
        size = 1 << (64 - int(self.shift))
        self.many = np.bincount(slot, minlength=size) > 1
        self.first = np.zeros(size, np.int64)
        self.first[slot[::-1]] = np.arange(len(keys))[::-1]

    def __call__(self, q: np.ndarray) -> np.ndarray:
        """The number of each key in the given order, -1 where it is none."""
        if not len(self.keys) or not len(q):
            return np.full(len(q), -1)
        slot = (q >> self.shift).astype(np.int64)
        at = self.first[slot]
        hit = self.keys[at] == q
        rest = np.flatnonzero(~hit & self.many[slot])
        if len(rest):
            place = np.minimum(np.searchsorted(self.keys, q[rest]), len(self.keys) - 1)
            at[rest], hit[rest] = place, self.keys[place] == q[rest]
        return np.where(hit, self.order[at], -1)


def _classes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    x = np.zeros(len(starts), np.uint64)
    for back in (1, 2, 3):
        at = np.maximum(ends - back, starts)
        x = x * np.uint64(256) + data[at].astype(np.uint64)
    return (W.mix(x + np.uint64(1)) % np.uint64(CLASSES)).astype(np.int64)


def _tokens(data: np.ndarray, offsets: np.ndarray):
    """Lowered bytes, words, and where each word and each row's end goes in the row-by-row token sequence."""
    low = W.LOWER[data]
    starts, ends, first = W.spans(low, offsets)
    n = np.diff(first)
    rows = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(starts)) + rows
    stop = first[1:] + np.arange(len(n))
    return low, starts, ends, n, rows, place, stop


def word_counts(docs: DataFrame, text_col: str = "text", flush: int = 200_000) -> DataFrame:
    """word, c over all rows; counted in the tasks first, at most `flush` words at a time."""

    def run(batches):
        count: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(count), pa.binary()).cast(pa.string()), pa.array(list(count.values()), pa.int64())], names=["word", "c"])

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                count.update("\n".join(t for t in batch.column(0).slice(lo, 256).to_pylist() if t).encode().lower().split())
                if len(count) > flush:
                    yield out()
                    count = Counter()
        yield out()

    return docs.select(text_col).mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _hash_words(words: list[str]) -> np.ndarray:
    data = np.frombuffer("\n".join(words).encode(), np.uint8)
    starts, ends, _ = W.spans(data, np.array([0, len(data)]))
    return W.hashes(data, starts, ends)


def _threshold(histogram: list, most: int) -> int:
    """The least count such that at most `most` words occur that often."""
    total, least = 0, 1 << 62
    for c, n in sorted(histogram, reverse=True):
        if total + n > most:
            break
        total, least = total + n, c
    return least


def _read(data, offsets, own: Lookup):
    """Lowered bytes, words, their token places and hashes, the symbols of all tokens and each row's number of tokens."""
    low, starts, ends, n, _, place, stop = _tokens(data, offsets)
    s, h = np.empty(len(starts) + len(n), np.int64), np.zeros(0, np.uint64)
    if len(starts):
        h = W.hashes(low, starts, ends)
        at = own(h)
        s[place] = np.where(at >= 0, at, OWN + _classes(low, starts, ends))
    s[stop] = OWN + CLASSES
    return low, starts, ends, place, h, s, n + 1


def _symbols(data, offsets, own: Lookup):
    return _read(data, offsets, own)[-2:]


def expect(s: np.ndarray, n: np.ndarray, model: dict, counts: dict) -> float:
    """Adds the expected counts of one block to `counts` and returns the log10 likelihood of its tokens."""
    gain, gamma = posteriors(s, n, model, counts)
    for j in range(gamma.shape[1]):
        counts["emit"][:, j] += np.bincount(s, gamma[:, j], len(counts["emit"]))
    return gain


def posteriors(s: np.ndarray, n: np.ndarray, model: dict, counts: dict) -> tuple[float, np.ndarray]:
    """The log10 likelihood of one block's tokens and each token's states; adds all counts but emissions to `counts`.

    Texts are taken in pieces of PIECE tokens. A piece also reads OVERLAP tokens before it, from the mean
    state `later` on, and as many after it, so that the states at its edges are those of the whole
    text but for what is forgotten in that distance; each token and each transition, also from piece to
    piece, counts once.
    """
    a, b = model["move"], model["emit"]
    k = len(a)
    begin = np.cumsum(n) - n
    pieces = -(-n // PIECE)
    row = np.repeat(np.arange(len(n)), pieces)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    at, to = nth * PIECE, np.minimum((nth + 1) * PIECE, n[row])
    low, high = np.maximum(at - OVERLAP, 0), np.minimum(to + OVERLAP, n[row])
    size = high - low
    order = np.argsort(-size, kind="stable")
    start, size, head = (begin[row] + low)[order], size[order], (nth == 0)[order]
    own_lo, own_hi = (at - low)[order], (to - low)[order]
    live = np.searchsorted(-size, -np.arange(1, PIECE + 2 * OVERLAP + 1), "right")
    steps = int(size[0]) if len(size) else 0
    forward, scale, seen, gain = [], [], [], 0.0
    for t in range(steps):
        m = live[t]
        seen.append(b[s[start[:m] + t]])
        x = (np.where(head[:, None], model["first"], model["later"]) if t == 0 else forward[-1][:m] @ a) * seen[-1]
        z = x.sum(axis=1)
        forward.append(x / z[:, None])
        scale.append(z)
        gain += float(np.log10(z[(own_lo[:m] <= t) & (t < own_hi[:m])]).sum())
    back = np.ones((0, k), np.float32)
    states = np.zeros((len(s), k), np.float32)
    for t in range(steps - 1, -1, -1):
        m = live[t]
        beta = np.ones((m, k), np.float32)
        if t + 1 < steps:
            w = seen[t + 1] * back / scale[t + 1][:, None]
            beta[: len(w)] = w @ a.T
            into = (own_lo[: len(w)] <= t + 1) & (t + 1 < own_hi[: len(w)])
            counts["move"] += (forward[t][: len(w)].T @ (w * into[:, None])) * a
        own = ((own_lo[:m] <= t) & (t < own_hi[:m]))[:, None]
        gamma = forward[t] * beta * own
        states[start[:m][own[:, 0]] + t] = gamma[own[:, 0]]
        if t == 0:
            counts["first"] += gamma[head].sum(axis=0)
        counts["later"] += gamma.sum(axis=0)
        back = beta
    return gain, states


def _zero(k: int) -> dict:
    return {"move": np.zeros((k, k)), "first": np.zeros(k), "later": np.zeros(k), "emit": np.zeros((OWN + CLASSES + 1, k))}


def maximise(counts: dict) -> dict:
    """The next model: expected counts, smoothed towards their mean over states."""
    emit = counts["emit"].T
    mean = (emit.sum(axis=0) + 0.01) / (emit.sum() + 0.01 * emit.shape[1])
    emit = emit + 50 * mean
    move = counts["move"] + 0.1
    first, later = counts["first"] + 0.1, counts["later"] + 0.1
    return {"move": (move / move.sum(axis=1, keepdims=True)).astype(np.float32), "emit": np.ascontiguousarray((emit / emit.sum(axis=1, keepdims=True)).T.astype(np.float32)), "first": (first / first.sum()).astype(np.float32), "later": (later / later.sum()).astype(np.float32)}


def _start(states: int, own_keys: np.ndarray):
    """A model from a bounded sample: texts get random states first, then WARM rounds."""

    def run(g: pd.DataFrame) -> pd.DataFrame:
        rng = np.random.default_rng(5)
        texts = pa.array(g.sort_values(["_h", "_text"])["_text"].tolist(), pa.large_string())
        own = Lookup(own_keys)
        blocks = [_symbols(data, offsets, own) for _, _, data, offsets in W.blocks(texts, 2 << 20)]
        counts = _zero(states)
        for s, n in blocks:
            state = np.repeat(rng.integers(0, states, len(n)), n)
            for j in range(states):
                counts["emit"][:, j] += np.bincount(s[state == j], minlength=OWN + CLASSES + 1)
        counts["move"] += np.full((states, states), 1.0) + 8 * states * np.eye(states)
        model = maximise(counts)
        for _ in range(WARM):
            counts = _zero(states)
            for s, n in blocks:
                expect(s, n, model, counts)
            model = maximise(counts)
        return pd.DataFrame({k: [v.astype(np.float32).tobytes()] for k, v in model.items()})

    return run


def _round(docs: DataFrame, text_col: str, shared, states: int) -> tuple[dict, float]:
    """Expected counts over all rows, summed in each task, then by Spark over the tasks; and the log10 likelihood."""
    names = [f"e{j}" for j in range(states)]

    def run(batches):
        model, own = shared.value
        own, counts, gain = Lookup(own), _zero(states), np.zeros(states)
        for batch in batches:
            for _, _, data, offsets in W.blocks(batch.column(0), 2 << 20):
                s, n = _symbols(data, offsets, own)
                gain[0] += expect(s, n, model, counts)
        rows = np.vstack([counts["emit"], counts["move"], counts["first"], counts["later"], gain])
        at = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(at), *[pa.array(rows[at, j]) for j in range(states)]], names=["i", *names])

    parts = docs.select(text_col).mapInArrow(run, "i long, " + ", ".join(f"{x} double" for x in names))
    got = parts.groupBy("i").agg(*[F.sum(x).alias(x) for x in names]).toPandas()  # at most OWN + CLASSES + states + 4 rows
    rows = np.zeros((OWN + CLASSES + 1 + states + 3, states))
    rows[got["i"].to_numpy()] = got[names].to_numpy()
    s = OWN + CLASSES + 1
    return {"emit": rows[:s], "move": rows[s : s + states], "first": rows[s + states], "later": rows[s + states + 1]}, float(rows[s + states + 2, 0])


def _lexicon(docs: DataFrame, text_col: str, shared, states: int) -> DataFrame:
    """word, c, q: how often each word without a symbol of its own occurs, and its share of each state in 255ths, a byte a state."""
    names = [f"e{j}" for j in range(states)]

    def run(batches):
        model, own = shared.value
        own, counts = Lookup(own), _zero(states)
        for batch in batches:
            for _, _, data, offsets in W.blocks(batch.column(0), 2 << 20):
                low, starts, ends, place, h, s, n = _read(data, offsets, own)
                rare = np.flatnonzero(s[place] >= OWN)
                if not len(rare):
                    continue
                gamma = posteriors(s, n, model, counts)[1][place[rare]]
                each, at, which, c = np.unique(h[rare], return_index=True, return_inverse=True, return_counts=True)
                at, text = rare[at], low.tobytes()
                words = [text[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
                # whole numbers, whose zero bytes the shuffle's compression removes
                sums = [pa.array(np.rint(255 * np.bincount(which, gamma[:, j], len(each))).astype(np.int64)) for j in range(states)]
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()).cast(pa.string()), pa.array(c), *sums], names=["word", "c", *names])

    found = docs.select(text_col).mapInArrow(run, "word string, c long, " + ", ".join(f"{x} long" for x in names))
    found = found.groupBy("word").agg(F.sum("c").alias("c"), *[F.sum(x).alias(x) for x in names])
    share = [F.lpad(F.hex(F.least(F.lit(255), F.round(F.col(x) / F.col("c"))).cast("long")), 2, "0") for x in names]
    return found.select("word", "c", F.unhex(F.concat(*share)).alias("q"))


def _states(c: np.ndarray, q: pa.Array, states: int) -> np.ndarray:
    """Expected counts of words in each state from their counts and shares; none for a word without shares."""
    out = np.zeros((len(c), states))
    have = np.flatnonzero(q.is_valid().to_numpy(zero_copy_only=False))
    if len(have):
        share = np.frombuffer(b"".join(q.drop_null().to_pylist()), np.uint8).reshape(-1, states).astype(float)
        out[have] = c[have, None] * share / np.maximum(share.sum(axis=1, keepdims=True), 1)
    return out


def _kinds(words: pa.Array) -> np.ndarray:
    found = [_classes(data, cuts[:-1], cuts[1:]) for _, _, data, cuts in W.blocks(words)]
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _choice(lexicon: DataFrame, states: int) -> dict:
    """What the choice of a word in its class needs of all words of the class: a few numbers for each of CLASSES."""
    names = [f"x{j}" for j in range(2 + 2 * states)]

    def run(batches):
        sums = np.zeros((CLASSES, len(names)))
        for batch in batches:
            kind, c = _kinds(batch.column(0)), batch.column(1).to_numpy()
            e, part = _states(c, batch.column(2), states), (c + SMOOTH) / (c + PRIOR)
            rows = np.column_stack([c + SMOOTH, part * PRIOR, e, part[:, None] * e])
            for j in range(len(names)):
                sums[:, j] += np.bincount(kind, rows[:, j], CLASSES)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), *[pa.array(x) for x in sums.T]], names=["kind", *names])

    got = lexicon.mapInArrow(run, "kind long, " + ", ".join(f"{x} double" for x in names)).groupBy("kind").agg(*[F.sum(x).alias(x) for x in names]).toPandas()
    sums = np.zeros((CLASSES, len(names)))
    sums[got["kind"].to_numpy()] = got[names].to_numpy()
    mass, lent = sums[:, 0] + SMOOTH, sums[:, 1] + SMOOTH  # unseen words have SMOOTH
    spread = sums[:, 2 : 2 + states] + 0.001
    spread /= spread.sum(axis=1, keepdims=True)
    return {"mass": mass, "spread": spread, "norm": (sums[:, 2 + states :] + spread * lent[:, None]) / mass[:, None]}


def _emissions(words: pa.Array, c: np.ndarray, q: pa.Array, classes: np.ndarray, choice: dict) -> np.ndarray:
    """Each word's probability in each state: of its class there, times its share of the class there."""
    kind = _kinds(words)
    own = (_states(c, q, classes.shape[1]) + PRIOR * choice["spread"][kind]) / (c + PRIOR)[:, None]
    return (classes[kind] * ((c + SMOOTH) / choice["mass"][kind])[:, None] * own / choice["norm"][kind]).astype(np.float32)


def train(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", states: int = STATES) -> dict:
    """Counts and model from all rows of docs; null texts count as empty. An empty table gives uniform states.

    Rounds of Baum-Welch over all texts go on until one gains less than GAIN a token; then one more pass counts
    the states of every word that had no symbol of its own. Very long texts are taken in pieces (see
    posteriors); repeated rows count as often as they occur; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    vocabulary = cut(word_counts(docs, text_col))
    n_docs = docs.count()
    words, distinct = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    total, types = words + n_docs, distinct + (n_docs > 0)
    whole = total + SMOOTH * (types + 1)
    histogram = [tuple(r) for r in vocabulary.groupBy("c").count().collect()]
    cut_head, cut_own = _threshold(histogram, HEAD), _threshold(histogram, OWN)
    top = vocabulary.where(F.col("c") >= cut_own).orderBy(F.desc("c"), "word").toPandas()  # at most OWN rows
    keys = _hash_words(top["word"].tolist())
    spark = docs.sparkSession
    h = F.pmod(F.xxhash64(F.lit(17), F.col(id_col), F.col(text_col)), F.lit(1 << 20))
    some = docs.where(h < min(1.0, 1.3 * SAMPLE / max(n_docs, 1) + 0.0001) * (1 << 20)).select(F.coalesce(F.col(text_col), F.lit("")).alias("_text"), h.alias("_h")).orderBy("_h", "_text").limit(SAMPLE)
    fields = "move binary, emit binary, first binary, later binary"
    got = some.withColumn("_one", F.lit(1)).groupBy("_one").applyInPandas(_start(states, keys), fields).first()
    shape = {"move": (states, states), "emit": (OWN + CLASSES + 1, states), "first": (states,), "later": (states,)}
    model = {k: np.frombuffer(got[k], np.float32).reshape(v) for k, v in shape.items()} if got else maximise(_zero(states))
    before = -np.inf
    for _ in range(ROUNDS if n_docs else 0):
        shared = spark.sparkContext.broadcast((model, keys))
        counts, likelihood = _round(docs, text_col, shared, states)
        shared.unpersist()
        model = maximise(counts)
        if likelihood - before < GAIN * total:
            break
        before = likelihood
    lexicon = cut(_lexicon(docs, text_col, spark.sparkContext.broadcast((model, keys)), states))
    choice, classes = _choice(lexicon, states), model["emit"][OWN : OWN + CLASSES].astype(float)
    head = lexicon.where(F.col("c") >= cut_head).orderBy(F.desc("c"), "word").toPandas()  # at most HEAD rows
    more = _emissions(pa.array(head["word"], pa.string()), head["c"].to_numpy(np.int64), pa.array(head["q"], pa.binary()), classes, choice)
    emit = np.vstack([model["emit"][: len(keys)], more, model["emit"][OWN + CLASSES :]])
    c = np.concatenate([top["c"].to_numpy(np.int64), head["c"].to_numpy(np.int64)])
    keys = np.concatenate([keys, _hash_words(head["word"].tolist())])
    return {"move": model["move"], "first": model["first"], "emit": emit, "classes": classes, "choice": choice, "keys": keys, "c": c, "rest": lexicon.where(F.col("c") < cut_head), "total": int(total), "whole": float(whole), "ends": int(n_docs)}


def forward(s: np.ndarray, n: np.ndarray, model: dict) -> np.ndarray:
    """log10 of each text's symbol likelihood, exactly: all texts of a block take a step at once."""
    a, b = model["move"].astype(float), model["emit"].astype(float)
    order = np.argsort(-n, kind="stable")
    start, size = (np.cumsum(n) - n)[order], n[order]
    live = np.searchsorted(-size, -np.arange(1, (size[0] if len(size) else 0) + 1), "right")
    out, x = np.zeros(len(n)), None
    for t, m in enumerate(live.tolist()):
        e = b[s[start[:m] + t]]
        x = (model["first"].astype(float) if t == 0 else x[:m] @ a) * e
        z = x.sum(axis=1)
        x /= z[:, None]
        out[:m] += np.log10(z)
    got = np.empty(len(n))
    got[order] = out
    return got


def score(docs: DataFrame, trained: dict, text_col: str = "text") -> DataFrame:
    """docs without the text, with n_tokens, n_known, train_tokens, base_score and score (log10).

    Emissions of the HEAD most frequent words are in every task; a text with other words meets theirs
    in a join on the word, whatever their number, before its recursion. Null texts are empty; very long texts are
    scored whole; repeated rows get equal scores; an empty table gives no rows. Other columns pass;
    columns of the result's names are replaced.
    """
    rest = [c for c in docs.columns if c not in (text_col, "n_tokens", "n_known", "train_tokens", "base_score", "score")]
    spark, whole, ends, lexicon = docs.sparkSession, trained["whole"], trained["ends"], trained["rest"]
    shared = spark.sparkContext.broadcast({k: trained[k] for k in ("move", "first", "emit", "classes", "choice", "keys", "c")})
    named = [F.col(c).alias(f"_{i}") for i, c in enumerate(rest)]
    plain = [c for c in (*rest, text_col) if "map<" not in docs.schema[c].dataType.simpleString()]
    # rows that agree in all columns share a key and have the same words; copies with other ids do not
    key = [F.xxhash64(F.lit(i), *plain).alias(f"_k{i}") for i in (1, 2)]
    rows = docs.select(*key, *named, F.col(text_col).alias("_text"))
    kept = [f"_{i}" for i in range(len(rest))]

    def unlisted(batches):
        find = Lookup(shared.value["keys"])
        for batch in batches:
            for lo, _, data, offsets in W.blocks(batch.column(2), 1 << 20):
                low, starts, stops, _, row, _, _ = _tokens(data, offsets)
                if not len(starts):
                    continue
                h = W.hashes(low, starts, stops)
                lost = np.flatnonzero(find(h) < 0)
                lost = lost[np.unique(W.mix(h[lost] + row[lost].astype(np.uint64) * W.BASE), return_index=True)[1]]  # once a row
                text, take = low.tobytes(), pa.array(row[lost] + lo)
                words = [text[a:b] for a, b in zip(starts[lost].tolist(), stops[lost].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(words, pa.binary()).cast(pa.string())], names=["_k1", "_k2", "word"])

    def run(batches):
        t = shared.value
        find = Lookup(t["keys"])
        held, symbols, counts, seen, emit = [], [], [], [], []

        def flush():
            """The recursion takes all held texts a token at a time."""
            s, n, c = np.concatenate(symbols), np.concatenate(counts), np.concatenate([t["c"], [ends], *seen])
            row, base = np.repeat(np.arange(len(n)), n), np.log10((c + SMOOTH) / whole)
            likelihood = forward(s, n, {"move": t["move"], "first": t["first"], "emit": np.vstack([t["emit"], *emit])})
            own = [pa.concat_arrays([b.column(i) for b in held]) for i in range(len(kept))]
            out = [*own, pa.array(n), pa.array(np.bincount(row, c[s] > 0, len(n)).astype(np.int64)), pa.array(np.bincount(row, base[s], len(n))), pa.array(likelihood)]
            for x in (held, symbols, counts, seen, emit):
                x.clear()
            return pa.RecordBatch.from_arrays(out, names=[*kept, "n_tokens", "n_known", "base_score", "score"])

        for batch in batches:
            for lo, hi, data, offsets in W.blocks(batch.column(len(kept)), 1 << 20):
                low, starts, stops, n, _, place, stop = _tokens(data, offsets)
                tail = batch.column(len(kept) + 1).slice(lo, hi - lo).flatten()
                h, begin = np.zeros(0, np.uint64), len(t["emit"]) + sum(map(len, emit))
                if len(tail):
                    _, _, raw, cuts = next(W.blocks(tail.field(0), 1 << 62))
                    h, at = np.unique(W.hashes(raw, cuts[:-1], cuts[1:]), return_index=True)
                    each = tail.take(pa.array(at))
                    c = each.field(1).fill_null(0).to_numpy()
                    seen.append(c)
                    emit.append(_emissions(each.field(0), c, each.field(2), t["classes"], t["choice"]))
                s = np.empty(len(starts) + len(n), np.int32)
                if len(starts):
                    q = W.hashes(low, starts, stops)
                    head = find(q)
                    s[place] = np.where(head >= 0, head, begin + np.searchsorted(h, q))
                s[stop] = len(t["keys"])
                held.append(batch.slice(lo, hi - lo).select(kept))
                symbols.append(s)
                counts.append(n + 1)
                if sum(map(len, symbols)) > 2_000_000:
                    yield flush()
        if held:
            yield flush()

    tail = rows.select("_k1", "_k2", "_text").mapInArrow(unlisted, "_k1 long, _k2 long, word string").join(lexicon, "word", "left")
    tail = tail.groupBy("_k1", "_k2").agg(F.collect_set(F.struct("word", "c", "q")).alias("tail"))
    met = rows.join(tail, ["_k1", "_k2"], "left").select(*kept, "_text", "tail")
    out = met.mapInArrow(run, widen(docs.select(*named), n_tokens="long", n_known="long", base_score="double", score="double"))
    return out.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(rest)], "n_tokens", "n_known", F.lit(trained["total"]).cast("long").alias("train_tokens"), "base_score", "score")


def is_training(id_col: str = "doc_id") -> Column:
    return fold(id_col, 10) != 0


def op7_hmm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trained = train(docs.where(is_training()))
    return score(docs.select("doc_id", "text", (~is_training()).alias("held_out")), trained)
