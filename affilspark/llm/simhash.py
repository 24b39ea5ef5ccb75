"""SimHash near-duplicates: fingerprints, pigeonhole blocks, verified links, components."""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from affilspark.llm import _words as W
from affilspark.llm._spark import cut, parts, row_hashes, small_batches, table, widen, with_hint
from affilspark.llm.components import connected_components, with_least

#: Most distinct fingerprints of a bucket that one comparison takes; larger buckets are split in pairs of chunks.
BUCKET = 512


def _block_fingerprints(data: np.ndarray, offsets: np.ndarray, words: int, seed: int) -> np.ndarray:
    data = W.LOWER[data]
    starts, ends, first = W.spans(data, offsets)
    out = np.zeros(len(offsets) - 1, np.uint64)
    if not len(starts):
        return out
    keep = ~W.SPACE[data]
    gap = starts[starts > 0] - 1
    keep[gap] = True  # the byte before a word stands for the whole gap; before a row's first word it is never read
    data = np.where(W.SPACE[data], np.uint8(32), data)
    place = np.cumsum(keep) - 1
    text = data[keep].tobytes()
    starts, ends = place[starts], place[ends - 1] + 1
    n = np.diff(first)
    at, rows = W.whole(first, words)
    short = np.flatnonzero((n > 0) & (n < words))
    begin = np.concatenate([starts[at], starts[first[:-1][short]]])
    end = np.concatenate([ends[at + words - 1], ends[first[1:][short] - 1]])
    rows = np.concatenate([rows, short])
    order = np.argsort(rows, kind="stable") if len(short) else slice(None)
    begin, end, rows = begin[order], end[order], rows[order]
    h = np.fromiter((xxh64_intdigest(text[a:b], seed) for a, b in zip(begin.tolist(), end.tolist(), strict=True)), np.uint64, len(begin))
    cuts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    sums = np.empty((len(cuts), 64), np.int64)
    edges = np.r_[cuts, len(h)]
    step = 1 << 16  # shingles expanded to bits at once
    sums[:] = 0
    for lo in range(0, len(h), step):
        bits = np.unpackbits(h[lo : lo + step].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        a, b = np.searchsorted(edges, lo, "right") - 1, np.searchsorted(edges, min(lo + step, len(h)), "left")
        inside = np.maximum(edges[a:b] - lo, 0)
        sums[a:b] += np.add.reduceat(bits, inside, axis=0, dtype=np.int64)
    bits = (2 * sums > np.diff(edges)[:, None]).astype(np.uint8)
    out[rows[cuts]] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def fingerprints(docs: DataFrame, text_col: str = "text", words: int = 4, seed: int = 42) -> DataFrame:
    """docs without the text and with `fp`, a 64-bit SimHash as a signed long.

    Shingles are `words` neighbouring words of the text, A-Z lowered, one space between, repeats
    counted; a text with fewer words is one shingle, one with none (or null) has 0. A bit is 1 if
    it is in over half of the shingles' XXH64. Existing columns named `fp` are replaced.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop("fp")
    rest = [c for c in docs.columns if c != text_col]
    schema = widen(docs.select(*rest), fp="long")

    def run(batches):
        for batch in batches:
            fp = np.zeros(batch.num_rows, np.uint64)
            for lo, hi, data, offsets in W.blocks(batch.column(batch.schema.get_field_index(text_col))):
                fp[lo:hi] = _block_fingerprints(data, offsets, words, seed)
            yield pa.RecordBatch.from_arrays([*batch.select(rest).columns, pa.array(fp.view(np.int64))], names=[*rest, "fp"])

    return docs.mapInArrow(run, schema)


def masks(n: int, distance: int, bits: int = 64) -> list[int]:
    """Masks of block choices for pigeonhole tables over n fingerprints.

    With b blocks, two fingerprints at most `distance` bits apart agree on some choice of b-distance
    blocks. b is the least whose kept bits reach log2(n), so chance meetings stay linear in n.
    """
    b = distance + 1
    while bits * (b - distance) / b < math.log2(max(n, 2)) and b < 12:
        b += 1
    edge = [round(i * bits / b) for i in range(b + 1)]
    block = [((1 << (edge[i + 1] - edge[i])) - 1) << edge[i] for i in range(b)]
    return [sum(block[i] for i in take) for take in combinations(range(b), b - distance)]


def _span(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of links between numbers below n, one from each number to the least of its component, if that is another."""
    label = np.arange(n)
    while len(a):
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            break
        label = new
    hung = np.flatnonzero(label != np.arange(n))
    return hung, label[hung]


def _forest(fp: np.ndarray, run: np.ndarray, side: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span what lies within `distance` bits inside each run of equal numbers; fp may have several columns.

    A run with rows of two sides gives only links between the two sides' components, one from each but the
    least of those that hang together, at their least rows: the sides' own runs give the links inside them.
    """
    a, b, lag = [], [], 1
    at = np.arange(len(fp))
    while True:
        at = at[: np.searchsorted(at, len(fp) - lag)]
        at = at[run[at] == run[at + lag]]
        if not len(at):
            break
        far = np.bitwise_count(fp[at] ^ fp[at + lag])
        near = (far.sum(axis=1, dtype=np.int64) if far.ndim > 1 else far) <= distance
        a.append(at[near])
        b.append(at[near] + lag)
        lag += 1
    if not a:
        return at, at
    a, b = np.concatenate(a), np.concatenate(b)
    inside = side[a] == side[b]
    hung, root = _span(len(fp), a[inside], b[inside])
    label = np.arange(len(fp))
    label[hung] = root
    across, least = _span(len(fp), label[a[~inside]], label[b[~inside]])
    first = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    two = np.maximum.reduceat(side, first) != np.minimum.reduceat(side, first)
    number = np.cumsum(np.r_[False, run[1:] != run[:-1]])
    own = ~two[number[hung]]
    return np.concatenate([hung[own], across]), np.concatenate([root[own], least])


def _compare(distance: int):
    def run(batches):
        held_fp, held_key, held_side = np.zeros(0, np.uint64), None, np.zeros(0, np.int64)

        def links(fp, key, side):
            number = np.cumsum(np.r_[0, (key[1:] != key[:-1]).any(axis=1)]) if len(key) else np.zeros(0, int)
            a, b = _forest(fp, number, side, distance)
            return pa.RecordBatch.from_arrays([pa.array(fp[a].view(np.int64)), pa.array(fp[b].view(np.int64))], names=["a", "b"])

        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            key = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(1, 5)], axis=1)
            side = batch.column(5).to_numpy(zero_copy_only=False).astype(np.int64)
            if held_key is not None:
                fp, key, side = np.concatenate([held_fp, fp]), np.concatenate([held_key, key]), np.concatenate([held_side, side])
            last = np.flatnonzero((key != key[-1]).any(axis=1))
            stop = last[-1] + 1 if len(last) else 0
            yield links(fp[:stop], key[:stop], side[:stop])
            held_fp, held_key, held_side = fp[stop:], key[stop:], side[stop:]
        if held_key is not None:
            yield links(held_fp, held_key, held_side)

    return run


def links(fps: DataFrame, distance: int = 4, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that join all within `distance` bits.

    fps: one row per distinct `fp`. Each table keeps some blocks of the fingerprint as its key; a
    bucket of up to `bucket` fingerprints is compared at once, a larger one as pairs of hashed
    chunks, so no task gets a hot bucket (n fingerprints are read n / `bucket` times each). A chunk emits a
    spanning forest, fewer links than it has rows; a pair of chunks only one link for each two of their
    components that hang together. So no component is lost, and beyond a forest of n links a bucket makes one for
    a component of a chunk and a chunk that it reaches; never more than its close pairs. Buckets of 1,240 to
    20,000 fingerprints were measured to make less than one link for each fingerprint and table.
    """
    spark = fps.sparkSession
    n = fps.count()
    tables = masks(n, distance)
    signed = [m - (1 << 64) if m >> 63 else m for m in tables]
    keyed = fps.select("fp", F.posexplode(F.array(*[F.lit(m).cast("long") for m in signed])).alias("t", "mask")).select("fp", "t", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    hot = keyed.groupBy("t", "key").count().where(F.col("count") > bucket).select("t", "key", F.ceil(F.col("count") / bucket).cast("int").alias("chunks"))
    dealt = keyed.join(hot, ["t", "key"], "left").withColumn("c", F.when(F.col("chunks").isNotNull(), F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")).otherwise(0))
    dealt = dealt.select("fp", "t", "key", "c", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("chunks"), F.lit(1)) - 1)).alias("d"))
    dealt = dealt.select("fp", "t", "key", F.least("c", "d").alias("x"), F.greatest("c", "d").alias("y"), "c")
    dealt = dealt.repartition(parts(spark), "t", "key", "x", "y").sortWithinPartitions("t", "key", "x", "y", "fp")
    return dealt.mapInArrow(_compare(distance), "a long, b long").distinct()


def components_of(fps: DataFrame, distance: int = 4) -> DataFrame:
    """fp and component (its least linked fingerprint) of distinct fingerprints."""
    roots = connected_components(links(fps, distance)).withColumnRenamed("a", "fp")
    return fps.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, distance: int = 4) -> DataFrame:
    """id, fp and component_id (smallest id reachable over links of at most `distance` bits) of each row.

    Equal fingerprints always link, that of empty and null texts (0) too. Repeated rows come back
    repeated. A null id gets a component as others do but never names one; a component whose ids
    are all null has a null component_id. An empty table gives no rows.
    """
    fps = cut(fingerprints(docs.select(F.col(id_col), F.col(text_col)), text_col, words))
    nodes = fps.groupBy("fp").agg(F.min(id_col).alias("least"))
    named = nodes.join(components_of(nodes.select("fp"), distance), "fp")
    named = with_least(named, "component", "least").select("fp", F.col("m").alias("component_id"))
    named = cut(named)  # so that Spark can split the join's hot fingerprints
    return fps.join(named, "fp").select(id_col, "fp", "component_id")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: Bits of a wide fingerprint, and how many standard deviations a pair at the least similarity may lie beyond its mean distance.
WIDE, MARGIN = 256, 5
CHECKS = [f"c{i}" for i in range(WIDE // 64)]
#: So many buckets' worth of nodes may share a shingle before they meet on parts of their sets instead.
CROWD = 64
#: Most shingles of a set that is compared by its whole prefix; fingerprints of few shingles are too coarse.
FEW = 32


def _shingles(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's set of word shingles in rising order, and for each row its first (one more at the end)."""
    data = W.LOWER[data]
    starts, ends, first = W.spans(data, offsets)
    n = np.diff(first)
    h = W.hashes(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    at, rows = W.whole(first, words)
    gram = W.mix(W.rolling(h, words))[at] if len(at) else h[:0]
    few = np.flatnonzero((n > 0) & (n < words))
    whole = [np.bitwise_xor.reduce(W.mix(h[first[i] : first[i + 1]] + np.arange(1, n[i] + 1, dtype=np.uint64))) for i in few.tolist()]
    gram, rows = np.concatenate([gram, np.array(whole, np.uint64)]), np.concatenate([rows, few])
    order = np.lexsort((gram, rows))
    gram, rows = gram[order], rows[order]
    new = np.r_[True, (gram[1:] != gram[:-1]) | (rows[1:] != rows[:-1])][: len(gram)]
    gram, rows = gram[new], rows[new]
    return gram, np.searchsorted(rows, np.arange(len(offsets)))


def _set_keys(gram: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name each row's set: two sums of mixed hashes; an empty set has zeros."""
    out = []
    for salt in (1, 2):
        total = np.r_[np.zeros(1, np.uint64), np.cumsum(W.mix(gram ^ W.mix(np.full(1, salt, np.uint64))))]
        out.append((total[edge[1:]] - total[edge[:-1]]).view(np.int64))
    return out[0], out[1]


def _wide_fingerprints(gram: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """WIDE SimHash bits of each row's set of shingles, as a row of longs.

    Shingles are hashed with a sign into WIDE sums; a Walsh-Hadamard transform of the sums gives all
    bits at once, each the sign of a random projection. A tie goes by a fixed coin of the bit.
    """
    rows_all = len(edge) - 1
    rows = np.repeat(np.arange(rows_all), np.diff(edge))
    coin = (W.mix(np.arange(WIDE, dtype=np.uint64)) & np.uint64(1)).astype(np.float32) - np.float32(0.5)
    out = np.empty((rows_all, WIDE // 8), np.uint8)
    for lo in range(0, rows_all, 1024):
        hi = min(lo + 1024, rows_all)
        a, b = edge[lo], edge[hi]
        g = gram[a:b]
        cell = (rows[a:b] - lo) * WIDE + (g % np.uint64(WIDE)).astype(np.int64)
        x = np.bincount(cell, 1.0 - 2.0 * ((g >> np.uint64(40)) & np.uint64(1)).astype(float), (hi - lo) * WIDE).astype(np.float32)
        step = 1
        while step < WIDE:
            x = x.reshape(-1, 2, step)
            x = np.stack([x[:, 0] + x[:, 1], x[:, 0] - x[:, 1]], axis=1)
            step *= 2
        out[lo:hi] = np.packbits(x.reshape(hi - lo, WIDE) + coin > 0, axis=1)
    return out.view(np.int64)


def _loose(similarity: float) -> int:
    """A bound on the differing bits of two sets with that Jaccard similarity: the mean and MARGIN standard deviations."""
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return int(WIDE * share + MARGIN * math.sqrt(WIDE * share * (1 - share)))


def _lead(n: np.ndarray, similarity: float) -> np.ndarray:
    """Of how many of its least shingles a set of n must share one with every set that is alike."""
    return n - np.ceil(similarity * n - 1e-9).astype(np.int64) + (n > 0)


def _classes(largest: int, similarity: float) -> list[int]:
    """Sizes at which classes begin: two sets that are alike lie in one class or in neighbouring ones."""
    edge = [1]
    while edge[-1] <= largest:
        edge.append(max(int((edge[-1] - 1) / similarity), edge[-1]) + 1)
    return [*edge, max(int((edge[-1] - 1) / similarity), edge[-1]) + 1]


def _part_keys(gram: np.ndarray, edge: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pigeonhole blocks of each row's set: row, kind (1, or 2 for prefixes) and key.

    The hash range is cut in more parts than two alike sets of a size class can differ in shingles, so
    some part agrees; its shingles and the class are the key. A set serves its class and the next. Empty parts give
    no key; a set with too few others for the guarantee also gives its prefix, where any two such sets meet.
    """
    n = np.diff(edge)
    start = np.array(_classes(int(n.max(initial=1)), similarity))
    own = np.searchsorted(start, n, "right") - 1
    total = np.r_[np.zeros(1, np.uint64), np.cumsum(W.mix(gram))]
    rows, kinds, keys = [], [], []
    for level in (own, own + 1):
        differ = ((1 - similarity) / (1 + similarity) * 2 * (start[level + 1] - 1) + 1e-9).astype(np.int64)
        m = differ + differ // 4 + 2
        row = np.repeat(np.arange(len(n)), n)
        part = (((gram >> np.uint64(32)) * m[row].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        begin = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (part[1:] != part[:-1])][: len(row)])
        end = np.r_[begin[1:], len(row)][: len(begin)]
        place = W.mix((level[row[begin]] << 32).astype(np.uint64) + part[begin].astype(np.uint64))
        rows.append(row[begin])
        kinds.append(np.ones(len(begin), np.int32))
        keys.append(W.mix((total[end] - total[begin]) ^ place))
        poor = np.flatnonzero(np.bincount(row[begin], minlength=len(n)) <= differ)
        lead = _lead(n[poor], similarity)
        rows.append(np.repeat(poor, lead))
        kinds.append(np.full(lead.sum(), 2, np.int32))
        keys.append(gram[np.repeat(edge[poor] - np.cumsum(lead) + lead, lead) + np.arange(lead.sum())] if len(poor) else gram[:0])
    return np.concatenate(rows), np.concatenate(kinds), np.concatenate(keys)


def _compare_wide(most: int):
    n_check = len(CHECKS)

    def run(batches):
        held = None

        def links(node, check, key, side):
            number = np.cumsum(np.r_[0, (key[1:] != key[:-1]).any(axis=1)]) if len(key) else np.zeros(0, int)
            a, b = _forest(check, number, side, most)
            return pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], names=["a", "b"])

        for batch in batches:
            node = batch.column(0).to_numpy()
            check = np.stack([batch.column(i).to_numpy() for i in range(1, 1 + n_check)], axis=1).view(np.uint64)
            key = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(1 + n_check, 5 + n_check)], axis=1)
            side = batch.column(5 + n_check).to_numpy().astype(np.int64)
            if held is not None:
                node, check, key, side = (np.concatenate(x) for x in zip(held, (node, check, key, side), strict=True))
            last = np.flatnonzero((key != key[-1]).any(axis=1))
            stop = last[-1] + 1 if len(last) else 0
            yield links(node[:stop], check[:stop], key[:stop], side[:stop])
            held = node[stop:], check[stop:], key[stop:], side[stop:]
        if held is not None:
            yield links(*held)

    return run


def _alike(sets: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the sets whose Jaccard similarity is `similarity` or more, counted over all pairs."""
    m = len(sets)
    sizes = np.array([len(x) for x in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner, shared = np.repeat(np.arange(m), sizes), times[column] > 1
    owner, column = owner[shared], (np.cumsum(times > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((m, m), np.float32)
    width = 4096
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        i, j = np.searchsorted(column, (lo, lo + width))
        has = np.zeros((m, min(width, int(column[j - 1]) - lo + 1)), np.float32)
        has[owner[i:j], column[i:j] - lo] = 1
        both += has @ has.T
    both = both.astype(np.float64)
    return _span(m, *np.nonzero(np.triu(both >= similarity * (sizes[:, None] + sizes[None, :] - both) - 1e-9, 1)))


def _compare_sets(similarity: float):
    """Rows node, set, and four key columns in order: the links of each key's sets."""

    def run(batches):
        held = None

        def links(node, sets, key):
            edge = np.r_[0, np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1, len(node)]
            a, b = [node[:0]], [node[:0]]
            for i, j in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                if j - i > 1:
                    x, y = _alike([np.frombuffer(v, np.uint64) for v in sets[i:j]], similarity)
                    a.append(node[i + x])
                    b.append(node[i + y])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

        for batch in batches:
            node, sets = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            key = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(2, 6)], axis=1)
            if held is not None:
                node, sets, key = np.concatenate([held[0], node]), held[1] + sets, np.concatenate([held[2], key])
            last = np.flatnonzero((key != key[-1]).any(axis=1))
            stop = last[-1] + 1 if len(last) else 0
            yield links(node[:stop], sets[:stop], key[:stop])
            held = node[stop:], sets[stop:], key[stop:]
        if held is not None:
            yield links(*held)

    return run


def _in_chunks(sized: DataFrame, bucket: int) -> DataFrame:
    """sized(node, ..., t, key, n) sorted by t, key and pair of hashed chunks x, y; n: the rows of t and key, c: a row's own chunk.

    A bucket of up to `bucket` rows is one chunk; a larger one meets as pairs of chunks, so no task gets a hot one.
    """
    rest = [c for c in sized.columns if c not in ("t", "key", "n")]
    chunks = F.ceil(F.col("n") / bucket).cast("int")
    dealt = sized.withColumn("c", F.pmod(F.xxhash64("node"), chunks).cast("int")).withColumn("d", F.explode(F.sequence(F.lit(0), chunks - 1)))
    dealt = dealt.select(*rest, "t", "key", F.least("c", "d").alias("x"), F.greatest("c", "d").alias("y"), "c")
    return dealt.repartition(parts(sized.sparkSession), "t", "key", "x", "y").sortWithinPartitions("t", "key", "x", "y", "node")


def _set_parts(similarity: float, words: int):
    """Rows node, text, ... to node, t and key of the blocks of the text's set."""

    def run(batches):
        for batch in batches:
            for lo, _, data, offsets in W.blocks(batch.column(1)):
                row, kind, key = _part_keys(*_shingles(data, offsets, words), similarity)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row + lo)), pa.array(kind), pa.array(key.view(np.int64))], names=["node", "t", "key"])

    return run


def similar_links(nodes: DataFrame, texts_of, similarity: float = 0.8, bucket: int = BUCKET, words: int = 5, crowd: int = CROWD) -> DataFrame:
    """Edges (a, b) that span the candidate pairs of nodes(node, lead, c0, ...): those that share a block and are within a loose bound.

    Any two alike sets share one of their `lead` least shingles, so these are the blocks that they meet on; a
    block of more than `bucket` nodes meets as pairs of hashed chunks. A shingle that more than
    crowd * bucket nodes lead with is no block: its nodes meet on parts of their sets instead (see _part_keys;
    texts_of gives the texts of a table of nodes), as a passage that many texts hold seldom fills a part
    alone. A block emits a spanning forest of all its pairs within _loose() differing bits, so edges are
    linear in the rows and each pair lies in one component. alike_pairs() then decides.
    """
    keyed = nodes.select("node", F.explode("lead").alias("key"))
    counts = cut(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    bits = nodes.select("node", *CHECKS)
    compare = _compare_wide(_loose(similarity))
    most = crowd * bucket
    block = keyed.join(counts.where(F.col("n") <= most), "key").select("node", F.lit(0).alias("t"), "key", "n")
    if counts.where(F.col("n") > most).limit(1).count():
        crowded = keyed.join(counts.where(F.col("n") > most), "key").select("node").distinct()
        part = texts_of(crowded).mapInArrow(_set_parts(similarity, words), "node long, t int, key long")
        block = block.unionByName(part.join(part.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1"), ["t", "key"]).select("node", "t", "key", "n"))
    block = _in_chunks(block.join(bits, "node").select("node", *CHECKS, "t", "key", "n"), bucket)
    return block.mapInArrow(compare, "a long, b long").distinct()


def fingerprint_links(nodes: DataFrame, distance: int = 4, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) that join all of nodes(node, fp) whose SimHash fingerprints are within `distance` bits: the pigeonhole tables of links(), and equal fingerprints."""
    first = cut(nodes.groupBy("fp").agg(F.min("node").alias("node"), F.count("*").alias("n")))
    near = links(first.select("fp"), distance, bucket)
    for side in ("a", "b"):
        near = near.join(first.select(F.col("fp").alias(side), F.col("node").alias(f"{side}_node")), side)
    same = nodes.join(first.where("n > 1").select("fp", F.col("node").alias("b")), "fp").select(F.col("node").alias("a"), "b")
    return near.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).unionByName(same).where("a <> b")


def alike_links(sets: DataFrame, similarity: float = 0.8, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) that span the pairs within each group of sets(node, set, t, key) of at least that Jaccard similarity.

    All pairs of a group are compared on their whole sets.
    """
    sizes = sets.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    return _in_chunks(sets.join(sizes, ["t", "key"]), bucket).mapInArrow(_compare_sets(similarity), "a long, b long").distinct()


def _like_first(similarity: float):
    """Rows node, key, set, first to node, key and whether the two sets are alike."""

    def run(batches):
        for batch in batches:
            ok = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                both = len(np.intersect1d(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), assume_unique=True))
                ok.append(both >= similarity * ((len(a) + len(b)) // 8 - both) - 1e-9)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ok, pa.bool_())], names=["node", "key", "alike"])

    return run


def alike_pairs(sets: DataFrame, similarity: float = 0.8, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) that span the pairs of alike sets within each group of sets(node, set, key); key: the group's least node.

    Sets that are alike to the group's first one need no other link to it, so a large family of copies costs
    a comparison a member. What is not is compared with the whole group, as pairs of hashed chunks.
    """
    first = sets.where("node = key").groupBy("key").agg(F.first("set").alias("first"))
    star = cut(sets.join(first, "key").select("node", "key", "set", "first").mapInArrow(_like_first(similarity), "node long, key long, alike boolean").distinct())
    found = star.where("alike and node <> key").select(F.col("node").alias("a"), F.col("key").alias("b"))
    if not star.where("not alike").limit(1).count():
        return found
    chunks = lambda n: F.ceil(n / bucket).cast("int")
    sizes = star.groupBy("key").agg(chunks(F.count("*")).alias("every"), chunks(F.count_if(~F.col("alike"))).alias("some")).where("some > 0")
    marks = star.join(sizes, "key").select("node", "every", "some", (~F.col("alike")).alias("lone"))
    h = F.xxhash64("node")
    at = lambda x, y: F.struct(x.cast("int").alias("x"), y.cast("int").alias("y"))
    own = F.transform(F.sequence(F.lit(0), F.col("some") - 1), lambda x: at(x, F.pmod(h, "every")))
    lone = F.transform(F.sequence(F.lit(0), F.col("every") - 1), lambda y: at(F.pmod(h, "some"), y))
    places = F.when(F.col("lone"), F.array_union(own, lone)).otherwise(own)
    dealt = sets.join(marks, "node").select("node", "set", F.lit(0).alias("t"), "key", F.explode(places).alias("p")).select("node", "set", "t", "key", "p.x", "p.y")
    dealt = dealt.repartition(parts(sets.sparkSession), "key", "x", "y").sortWithinPartitions("key", "x", "y", "node")
    return found.unionByName(dealt.mapInArrow(_compare_sets(similarity), "a long, b long")).where("a <> b").distinct()


def _prefixes(similarity: float):
    """For each small set the shingles of which two alike sets must share one: the least n - ceil(similarity n) + 1."""

    def run(batches):
        for batch in batches:
            node, sets = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            n = np.array([len(x) // 8 for x in sets], np.int64)
            take = _lead(n, similarity)
            key = [np.frombuffer(x, np.int64)[:k] for x, k in zip(sets, take.tolist(), strict=True)]
            at = np.repeat(np.arange(len(n)), take)
            yield pa.RecordBatch.from_arrays([pa.array(node[at]), batch.column(1).take(pa.array(at)), pa.array(np.zeros(len(at), np.int32)), pa.array(np.concatenate([np.zeros(0, np.int64), *key]))], names=["node", "set", "t", "key"])

    return run


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8, bucket: int = BUCKET, crowd: int = CROWD, distance: int = 4) -> DataFrame:
    """One row of docs for each group of near duplicates: that of the group's smallest id.

    Near duplicates have shingle sets (A-Z lowered, `words` words; fewer words are one shingle) of
    Jaccard similarity of `similarity` or more, or are linked by such. Equal sets are found by a 128-bit
    hash; pairs of up to FEW shingles share one of their least shingles. Of others, those whose SimHash
    fingerprints (the first 64 bits) are within `distance` bits are candidates by pigeonhole tables of the fingerprints; as
    these find only a fifth of the pairs, pairs that share a pigeonhole block of their sets and are within a
    loose distance of all bits are candidates as well. All are decided on the sets. Null texts and
    texts without words are one group. Very long texts are treated as others. Null ids come last; of rows that share
    the id the one whose text has the least hash stays, and of equal rows one. Columns
    may have any names and pass as they are; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    marked = docs.toDF(*[f"u{i}" for i in range(len(docs.columns))])
    own = dict(zip(docs.columns, marked.columns, strict=True))
    marked = marked.select("*", *row_hashes(own[id_col], own[text_col]))
    plain = marked.select("k1", "k2", F.col(own[id_col]).alias("id"), F.xxhash64(own[text_col]).alias("tie"), F.col(own[text_col]).alias("text"))
    low = int(FEW * similarity)

    def run(batches):
        for batch in batches:
            one, two, n, wide, few, lead = [], [], [], [], [], []
            for _, _, data, offsets in W.blocks(batch.column(4)):
                gram, edge = _shingles(data, offsets, words)
                size = np.diff(edge)
                for out, x in zip((one, two, n, wide), (*_set_keys(gram, edge), size, _wide_fingerprints(gram, edge)), strict=True):
                    out.append(x)
                few += [gram[a:b].tobytes() if b - a <= FEW else None for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
                take = np.where(size >= low, _lead(size, similarity), 0)
                at = np.repeat(edge[:-1] - np.cumsum(take) + take, take) + np.arange(take.sum())
                lead.append(pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(take)].astype(np.int32)), pa.array(gram[at].view(np.int64))))
            if not n:
                continue
            bits = np.concatenate(wide)
            columns = [*batch.columns[:4], *[pa.array(np.concatenate(x)) for x in (one, two)], pa.array(np.concatenate(n).astype(np.int64)), pa.array(few, pa.binary()), pa.concat_arrays(lead), *[pa.array(np.ascontiguousarray(bits[:, i])) for i in range(len(CHECKS))]]
            yield pa.RecordBatch.from_arrays(columns, names=["k1", "k2", "id", "tie", "one", "two", "n", "few", "lead", *CHECKS])

    def sets_of(batches):
        for batch in batches:
            sets = []
            for _, _, data, offsets in W.blocks(batch.column(1)):
                gram, edge = _shingles(data, offsets, words)
                sets += [gram[a:b].tobytes() for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary()), *batch.columns[2:]], names=["node", "set", "key"])

    more = {c: "long" for c in ("one", "two", "n")} | {"few": "binary", "lead": "array<long>"} | {c: "long" for c in CHECKS}
    rows = plain.mapInArrow(run, widen(plain.drop("text"), **more))
    order = F.struct(F.col("id").isNull().alias("no"), "id", "tie", "k1", "k2")
    kept = [F.first(c).alias(c) for c in ("n", "few", "lead", *CHECKS)]
    nodes = cut(rows.groupBy("one", "two").agg(F.min(order).alias("first"), *kept).withColumn("node", F.monotonically_increasing_id()))

    def texts_of(some: DataFrame) -> DataFrame:
        named = cut(some.join(nodes.select("node", "first.k1", "first.k2"), "node"))
        texts = with_hint(plain.select("k1", "k2", "text"), named, "k1", "met").where("met").drop("met")
        return texts.join(named, ["k1", "k2"]).select("node", "text", *[c for c in some.columns if c != "node"])

    short = nodes.where((F.col("n") > 0) & F.col("few").isNotNull()).select("node", "few").mapInArrow(_prefixes(similarity), "node long, set binary, t int, key long")
    long = nodes.where(F.col("n") >= low)
    near = fingerprint_links(long.select("node", F.col(CHECKS[0]).alias("fp")), distance, bucket)
    near = near.unionByName(similar_links(long, texts_of, similarity, bucket, words, crowd)).distinct()
    near = connected_components(near).select(F.col("a").alias("node"), F.col("root").alias("key"))
    sets = cut(texts_of(near).mapInArrow(sets_of, "node long, set binary, key long"))
    found = alike_links(short, similarity, bucket).unionByName(alike_pairs(sets, similarity, bucket))
    roots = connected_components(found).withColumnRenamed("a", "node")
    first = nodes.select("node", "first").join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("first").alias("m"))
    kept = cut(first.select("m.k1", "m.k2"))
    gone = cut(marked.select("k1", "k2").join(kept, ["k1", "k2"], "left_anti"))
    hinted = with_hint(marked, gone, "k1", "_doubtful")  # the rows of other keys stay where they are
    out = hinted.where("not _doubtful").unionByName(hinted.where("_doubtful").join(gone, ["k1", "k2"], "left_anti")).drop("_doubtful").select(*marked.columns)
    again = plain.groupBy("k1", "k2").count().where("count > 1").select("k1", "k2")
    if again.limit(1).count():  # rows that agree in id and text: the first by their other columns stays
        rest = [c for c in marked.columns if c not in ("k1", "k2", own[text_col]) and not isinstance(marked.schema[c].dataType, (T.MapType, T.VariantType))]
        place = F.row_number().over(Window.partitionBy("k1", "k2").orderBy(F.xxhash64(*rest)))
        twice = out.join(again, ["k1", "k2"], "left_semi").withColumn("place", place).where("place = 1").drop("place")
        out = out.join(again, ["k1", "k2"], "left_anti").unionByName(twice)
    return out.drop("k1", "k2").toDF(*docs.columns)
