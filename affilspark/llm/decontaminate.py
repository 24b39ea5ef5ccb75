"""Benchmark decontamination by templates: typed placeholders, hashed windows, consistent slots."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from affilspark.llm import _words as W
from affilspark.llm._spark import cut, row_hashes, small_batches, table, widen

#: Units of measure that become a placeholder after a number.
UNITS = "% cm day days dollar dollars eur euro euros feet ft g gram grams h hour hours inch inches kg kilometers km l lb litre litres m meter meters mile miles minute minutes ml mm month months pound pounds s second seconds usd week weeks year years".split()
#: Most benchmark windows that are sent to every task as a filter (8 bytes each); beyond it all windows are joined.
FILTER_MAX = 4_000_000

WORD, NUMBER, NAME, UNIT = 0, 1, 2, 3
_EDGE = np.zeros(256, bool)
_EDGE[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
_EDGE[[ord(c) for c in "%+"]] = False
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in '.!?:"']] = True
#: Code points of scripts written without blanks (Thai to Lao, Myanmar, Khmer, kana, Han and its extensions).
UNSPACED = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3041, 0x30FA), (0x30FC, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x3FFFF)]
#: Code points of quotes, dashes and wide punctuation, which part words as blanks do.
PARTING = [(0x00A0, 0x00A1), (0x00AB, 0x00AB), (0x00BB, 0x00BB), (0x00BF, 0x00BF), (0x2013, 0x2015), (0x2018, 0x2018), (0x201A, 0x201F), (0x2026, 0x2026), (0x2039, 0x203A), (0x3000, 0x3004), (0x3008, 0x303F), (0x30FB, 0x30FB), (0xFF01, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65)]


def _within(ranges: list[tuple[int, int]]) -> np.ndarray:
    """For each code point below 0x40000 whether a range holds it."""
    out = np.zeros(0x40000, bool)
    for lo, hi in ranges:
        out[lo : hi + 1] = True
    return out


def _lowered() -> np.ndarray:
    """For each code point below 0x10000 its lower case, where that is one code point of as many UTF-8 bytes; else itself."""
    out = np.arange(0x10000)
    for c in range(0x80, 0x10000):
        low = chr(c).lower()
        if len(low) == 1 and ord(low) != c and (c < 0x800) == (ord(low) < 0x800) and 0x80 <= ord(low) < 0x10000:
            out[c] = ord(low)
    return out


_UNSPACED, _PARTING, _LOWERED = _within(UNSPACED), _within(PARTING), _lowered()


def _read(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A block's bytes with parting marks as blanks, these in lower case, where a capital begins, and breaks at characters that are words alone."""
    low, capital = W.LOWER[data], (data >= 65) & (data <= 90)
    if not (data > 127).any():
        return data, low, capital, np.zeros(0, np.int64)
    data, breaks = data.copy(), []
    more = lambda at, i: (data[at + i] & 0x3F).astype(np.int64)
    found = []
    for size, lo, hi in ((2, 0xC2, 0xDF), (3, 0xE0, 0xEF), (4, 0xF0, 0xF4)):
        at = np.flatnonzero((data >= lo) & (data <= hi))
        at = at[at + size <= len(data)]
        point = (data[at] & (0x7F >> size)).astype(np.int64)
        for i in range(1, size):
            point = point << 6 | more(at, i)
        found.append((size, at, point))
    for size, at, point in found:
        known = point < 0x40000
        at, point = at[known], point[known]
        alone = at[_UNSPACED[point]]
        breaks += [alone, alone + size]
        if size < 4:
            lower = _LOWERED[point]
            big, to = at[lower != point], lower[lower != point]
            capital[big] = True
            low[big] = (to >> 6 | 0xC0) if size == 2 else (to >> 12 | 0xE0)
            for i in range(1, size):
                low[big + i] = to >> 6 * (size - 1 - i) & 0x3F | 0x80
        part = at[_PARTING[point]]
        for i in range(size):
            data[part + i] = low[part + i] = 32
    return data, low, capital, np.concatenate(breaks)


def _unit_hashes() -> np.ndarray:
    data = np.frombuffer(" ".join(UNITS).encode(), np.uint8)
    starts, ends, _ = W.spans(data, np.array([0, len(data)]))
    return W.hashes(data, starts, ends)


def canonical(data: np.ndarray, offsets: np.ndarray):
    """The template words of a block: hash, type, start, end, each row's first word, the hash as a literal, and doubt.

    Words lie between blanks, quotes and wide punctuation; a character of a script without blanks is a word. Edge
    punctuation goes and capitals of any script are lowered; words of punctuation alone are left out. Words with a leading digit (or sign and digit) are numbers; a unit is a listed word
    after a number; a capital inside a sentence is a name, one at the start of a row, line or sentence is a
    literal in doubt: it may be a name.
    """
    data, low, upper, breaks = _read(data)
    starts, ends, first = W.spans(data, offsets, breaks)
    s, e = starts.copy(), ends.copy()
    if not len(s):
        return np.zeros(0, np.uint64), np.zeros(0, np.int8), s, e, first, np.zeros(0, np.uint64), np.zeros(0, bool)
    live = np.arange(len(s))
    while len(live):
        live = live[(s[live] < e[live])]
        live = live[_EDGE[data[s[live]]]]
        s[live] += 1
    live = np.arange(len(s))
    while len(live):
        live = live[(s[live] < e[live])]
        live = live[_EDGE[data[e[live] - 1]]]
        e[live] -= 1
    lead = np.ones(len(s), bool)
    lead[1:] = _STOP[data[ends[:-1] - 1]]
    line = np.r_[0, np.cumsum(data == 10)]
    lead[1:] |= line[starts[1:]] != line[ends[:-1]]
    lead[first[:-1][first[:-1] < len(lead)]] = True
    full = s < e
    count = np.r_[0, np.cumsum(full)]
    first = count[first]
    s, e, lead = s[full], e[full], lead[full]
    h = W.hashes(low, s, e)
    kind = np.zeros(len(s), np.int8)
    if not len(s):
        return h, kind, s, e, first, h, np.zeros(0, bool)
    head = data[s]
    second = data[np.minimum(s + 1, len(data) - 1)]
    digit = lambda x: (x >= 48) & (x <= 57)
    number = digit(head) | (((head == 43) | (head == 45)) & (e - s > 1) & digit(second))
    capital = upper[s]
    kind[capital & ~lead] = NAME
    kind[number] = NUMBER
    after = np.zeros(len(s), bool)
    after[1:] = number[:-1]
    after[first[:-1][first[:-1] < len(after)]] = False
    kind[after & np.isin(h, _unit_hashes())] = UNIT
    marks = W.mix(np.arange(1, 5, dtype=np.uint64))
    return np.where(kind == WORD, h, marks[kind]), kind, s, e, first, h, capital & lead & (kind == WORD)


#: How a window is read: as its types say, by its plain words, or (from here on, plus how many) with words in doubt as names.
TYPED, PLAIN, DOUBT = 0, 1, 2


def _readings(h, plain, doubt, literal, at, k: int, least: int):
    """The readings of the windows of k words that begin at `at`: how, the words read as names, which windows, their hashes."""
    finish = lambda x: W.mix(x + np.uint64(k))
    raw = W.rolling(h, k)[at]
    yield TYPED, [], literal >= least, finish(raw)
    yield PLAIN, [], literal < k, finish(W.rolling(plain, k)[at])
    code = sum((doubt[at + j].astype(np.int64) << j for j in range(k)), np.zeros(len(at), np.int64))
    masks = set()
    for full in np.unique(code).tolist():
        sub = full
        while sub:
            masks.add(sub)
            sub = (sub - 1) & full
    name = W.mix(np.arange(1, 5, dtype=np.uint64))[NAME]
    for mask in sorted(masks):
        names = [j for j in range(k) if mask >> j & 1]
        ok = ((code & mask) == mask) & (literal - len(names) >= least)
        x = raw[ok]
        for j in names:
            x = x + (name - h[at[ok] + j]) * np.uint64(pow(int(W.BASE), k - 1 - j, 1 << 64))
        out = np.zeros(len(at), np.uint64)
        out[ok] = finish(x)
        yield DOUBT + len(names), names, ok, out


def windows(df: DataFrame, keys: list[str], text_col: str, lengths: list[int], wanted=None, whole_only: bool = False, min_literals: int = 2) -> DataFrame:
    """Readings of the windows of each row: keys, k, h, w, how, low, pos, slots (array of type:value).

    `lengths`: window lengths; whole_only: lengths below the longest only as a whole text. Each window is
    read with its types, by its plain words (also of numbers and names), and with each choice of words in
    doubt as names; h is the reading's hash, w the window's. Windows with fewer than `min_literals`
    literal words (or than their length) carry no template: they are `low` and have their plain reading
    only. wanted: a broadcast of sorted hashes; other readings are left out.
    """
    schema = widen(df.select(*keys), k="int", h="long", w="long", how="int", low="boolean", pos="int", slots="array<string>")
    longest = max(lengths)

    def run(batches):
        want = wanted.value if wanted is not None else None
        for batch in batches:
            own = batch.select(keys)
            for lo, hi, data, offsets in W.blocks(batch.column(batch.schema.get_field_index(text_col))):
                h, kind, s, e, first, plain, doubt = canonical(data, offsets)
                n = np.diff(first)
                literals = np.r_[0, np.cumsum(kind == WORD)]
                text = data.tobytes()
                for k in lengths:
                    every, row_of = W.whole(first, k)
                    if not len(every):
                        continue
                    least = min(k, min_literals)
                    literal = literals[every + k] - literals[every]
                    whose = literal < least
                    itself = np.where(whose, W.mix(W.rolling(plain, k)[every] + np.uint64(k)), W.mix(W.rolling(h, k)[every] + np.uint64(k)))
                    for how, names, ok, roll in _readings(h, plain, doubt, literal, every, k, least):
                        if whole_only and k < longest:
                            ok = ok & (n[row_of] == k)  # a benchmark item shorter than the window is one window
                        if want is not None:
                            place = np.searchsorted(want, roll)
                            ok = ok & (want[np.minimum(place, len(want) - 1)] == roll) if len(want) else ok & False
                        at, rows = every[ok], row_of[ok]
                        if not len(at):
                            continue
                        slots = [[] for _ in range(len(at))]
                        if how != PLAIN:
                            types = kind[at[:, None] + np.arange(k)]
                            types[:, names] = NAME
                            for i in np.flatnonzero((types != WORD).any(axis=1)).tolist():
                                j = at[i] + np.flatnonzero(types[i] != WORD)
                                slots[i] = [f"{types[i, x - at[i]]}:{text[s[x]:e[x]].decode('utf-8', 'replace')}" for x in j.tolist()]
                        columns = [c.take(pa.array(rows + lo)) for c in own.columns]
                        yield pa.RecordBatch.from_arrays(
                            [*columns, pa.array(np.full(len(at), k, np.int32)), pa.array(roll[ok].view(np.int64)), pa.array(itself[ok].view(np.int64)), pa.array(np.full(len(at), how, np.int32)), pa.array(whose[ok]), pa.array((at - first[rows]).astype(np.int32)), pa.array(slots, pa.list_(pa.string()))],
                            names=schema.names,
                        )

    return df.select(*keys, text_col).where(F.col(text_col).isNotNull()).mapInArrow(run, schema)


def _filter(index: DataFrame, most: int):
    """A broadcast of the index's sorted window hashes if a count finds at most `most` of its rows (8 bytes each), else None."""
    if index.limit(most + 1).count() > most:
        return None
    hashes = index.select("h").distinct().toArrow().column(0).to_numpy().view(np.uint64)
    return index.sparkSession.sparkContext.broadcast(np.sort(hashes))


def _candidates(found: DataFrame, index: DataFrame, similarity: float) -> DataFrame:
    """Pairs (k1, k2, item) that share one of the item's least frequent windows.

    A pair that holds `similarity` of an item's n windows holds one of any n - ceil(similarity n) + 1 of
    them. With the rarest ones a stock phrase of many items and documents makes no pairs.
    """
    often = found.groupBy("k", "h").agg(F.count("*").alias("n"))
    each = index.select("item", "k", "h", "w").join(often, ["k", "h"], "left").groupBy("item", "k", "w").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    place = F.row_number().over(Window.partitionBy("item").orderBy("n", "k", "w"))
    whole = F.count("*").over(Window.partitionBy("item"))
    rare = each.withColumn("place", place).withColumn("whole", whole).where(F.col("place") <= F.col("whole") - F.ceil(similarity * F.col("whole") - 1e-9) + 1)
    lead = index.select("item", "k", "h", "w").join(rare.select("item", "k", "w"), ["item", "k", "w"]).select("item", "k", "h")
    return found.select("k1", "k2", "k", "h").join(lead, ["k", "h"]).select("k1", "k2", "item").distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", words: int = 5, similarity: float = 0.8, drift: int = 64, filter_max: int = FILTER_MAX) -> DataFrame:
    """Pairs of a document and a benchmark item whose template one of its passages holds.

    Rows: id, text_key (a hash of the text), item, n_windows (the item's distinct template windows),
    matched, containment, n_slots, slot_consistent, reparameterised (some value differs). A passage is what
    matches at offsets (place in the document less place in the item) up to `drift` words apart, for each
    place of the item the match nearest to the passage's main offset, or what matches at the main
    offset alone. A pair is reported if a passage holds `similarity` of the item's windows and each value of
    the item stands for one value in it; the best such passage is the one described.

    Windows have `words` words; an item with fewer is one window. A window also matches by its plain words in
    any case, and with capitals in doubt as names; a pair that holds without these names is reported
    so. Capitals are those of any script; where a script has no blanks each character is a word, so an item is
    found inside a longer run, but names have no capitals there and count as literals. Numbers written as words are
    literals too. An item none of whose windows carries a template (numbers, names) is matched by its plain words.
    Items of one template are all reported. Null or empty texts on either side give nothing; very long
    texts are searched whole; null ids are ids; repeated rows count once; other columns are ignored; an empty
    table on either side gives no rows.

    The benchmark's window hashes go to every task as a filter while there are at most filter_max,
    checked by a count; beyond it all document windows meet the benchmark's in Spark's join.
    """
    small_batches(docs.sparkSession)
    items = benchmark.select(F.xxhash64(F.col(item_col), F.col(text_col)).alias("item"), F.col(item_col).alias("item_id"), F.col(text_col).alias("text"))
    index = windows(items, ["item", "item_id"], "text", list(range(1, words + 1)), whole_only=True).distinct()
    index = cut(index.join(index.where("not low").select("item").distinct().withColumn("any", F.lit(True)), "item", "left").where("not low or any is null").drop("any", "low"))
    lengths = sorted(r[0] for r in index.select("k").distinct().collect()) or [words]
    keyed = docs.select(*row_hashes(id_col, text_col), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    found = cut(windows(keyed, ["k1", "k2", "id", "key"], "text", lengths, _filter(index, filter_max)))
    pairs = _candidates(found, index, similarity)
    left = index.select("item", "k", "h", "w", F.col("how").alias("ihow"), F.col("pos").alias("ipos"), F.col("slots").alias("islots"))
    met = found.select("k1", "k2", "k", "h", "how", "pos", "slots").join(pairs, ["k1", "k2"]).join(left, ["item", "k", "h"])
    best = F.min(F.struct((F.col("how") + F.col("ihow")).alias("how"), "islots", "slots")).alias("best")
    met = met.groupBy("k1", "k2", "item", "k", "w", "pos", "ipos").agg(best).select("k1", "k2", "item", "k", "w", "pos", "ipos", "best.*")
    tiers = F.when(F.col("how") < DOUBT, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))  # tier 0 is without words in doubt as names
    off = F.col("pos") - F.col("ipos")
    bands = F.array(F.floor(off / (2 * drift)) * 2, F.floor((off + drift) / (2 * drift)) * 2 + 1)  # two offsets up to drift apart share one
    hits = cut(met.withColumn("off", off).withColumn("band", F.explode(bands)).withColumn("tier", F.explode(tiers)))
    band = ["k1", "k2", "item", "tier", "band"]
    main = hits.groupBy(*band, "off").agg(F.countDistinct("k", "w").alias("n")).groupBy(*band).agg(F.max(F.struct("n", (-F.col("off")).alias("off"))).alias("m")).select(*band, (-F.col("m.off")).alias("main"))
    away = F.abs(F.col("off") - F.col("main"))
    near = hits.join(main, band).groupBy(*band, "k", "w", "ipos").agg(F.min(F.struct(away.alias("away"), "off", "islots", "slots")).alias("hit")).select(*band, "k", "w", "hit.*")
    near = near.withColumn("only", F.explode(F.when(F.col("away") == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))))
    passage = [*band, "only"]
    size = index.groupBy("item").agg(F.countDistinct("k", "w").alias("n_windows"), F.first("item_id").alias("item_id"))
    have = near.groupBy(*passage).agg(F.countDistinct("k", "w").alias("matched")).join(size, "item").where(F.col("matched") >= similarity * F.col("n_windows"))
    slot = near.where(F.size("slots") > 0).select(*passage, F.explode(F.arrays_zip("islots", "slots")).alias("z"))
    value = slot.groupBy(*passage, F.col("z.islots").alias("mine")).agg(F.min("z.slots").alias("least"), F.max("z.slots").alias("most"))
    slots = value.groupBy(*passage).agg(F.count("*").alias("n_slots"), F.min(F.col("least") == F.col("most")).alias("one"), F.max(F.col("least") != F.col("mine")).alias("other"))
    held = have.join(slots, passage, "left").where(F.coalesce("one", F.lit(True)))
    rest = {"n_windows": F.col("n_windows"), "matched": F.col("matched"), "containment": F.col("matched") / F.col("n_windows"), "n_slots": F.coalesce("n_slots", F.lit(0)).cast("long"), "slot_consistent": F.lit(True), "reparameterised": F.coalesce("other", F.lit(False))}
    first = F.min(F.struct("tier", (-F.col("matched")).alias("less"), *[c.alias(n) for n, c in rest.items()])).alias("first")
    named = found.groupBy("k1", "k2").agg(F.first("id").alias("id"), F.first("key").alias("key"))
    out = held.groupBy("k1", "k2", "item", "item_id").agg(first).join(named, ["k1", "k2"])
    out = out.groupBy(F.col("id").alias(id_col), F.col("key").alias("text_key"), F.col("item_id").alias(item_col)).agg(F.min("first").alias("first"))
    return out.select(id_col, "text_key", item_col, *[F.col(f"first.{n}").alias(n) for n in rest])


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs without the rows that hold a benchmark item; null texts stay, and columns of any name pass."""
    bad = contaminated(docs, benchmark, id_col, text_col, **options).select(id_col, "text_key").distinct().toDF("bad", "text_key")
    own = docs.toDF(*[f"u{i}" for i in range(len(docs.columns))])
    the_id, text = (own[f"u{docs.columns.index(c)}"] for c in (id_col, text_col))
    return own.join(bad, the_id.eqNullSafe(bad["bad"]) & (F.xxhash64(text) == bad["text_key"]), "left_anti").toDF(*docs.columns)
