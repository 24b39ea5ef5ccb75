"""Operators on texts against brute force on small tables with nulls, empties, ties and repeated rows."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from affilspark.llm import _spark, chat, decontaminate, hmm, language, mixing, quality, simhash, substrings, svm, tokens
from affilspark.llm.automaton import SuffixAutomaton, spans

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, groups long, score double, label int"


def words(text):
    return (text or "").encode().split()


def corpus(seed=1, n=60):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 6))) for _ in range(300)]
    texts = [" ".join(r.choice(vocabulary) for _ in range(r.randint(1, 160))) for _ in range(n)]
    texts += [texts[0], texts[1] + " tail", "x " + texts[2].replace(" ", "\t\n", 3), "word " * 90, "", " \n", None, "one", "a b", texts[3][:40] + texts[4]]
    rows = [(i, t, r.choice(["en", "fr", None]), r.choice(["s1", "s2", None]), len(t or ""), 7, 0.5, 3) for i, t in enumerate(texts)]
    return rows + [rows[0], (None, texts[5], None, None, None, None, None, None), (900, texts[6], "en", "s1", 1, 1, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_automaton_matches_brute_force():
    for seed in range(60):
        r = random.Random(seed)
        texts = [[r.choice("abc") for _ in range(r.randint(1, 12))] for _ in range(4)]
        times = [r.randint(1, 2) for _ in texts]
        a = SuffixAutomaton()
        for t, n in zip(texts, times, strict=True):
            a.add(t, n)
        a.count()
        seen = lambda x: sum(n * sum(t[i : i + len(x)] == x for i in range(len(t))) for t, n in zip(texts, times, strict=True))  # noqa: E731, B023
        for t in texts:
            assert list(a.match(t, 2)) == [max(k for k in range(i + 2) if not k or seen(t[i + 1 - k : i + 1]) >= 2) for i in range(len(t))]
    assert spans([1, 2, 3, 0, 0, 1, 2, 3, 4], 3) == [(0, 3), (5, 9)] and spans([1, 2, 3, 1, 2, 3], 3) == [(0, 6)]


@pytest.mark.parametrize("shard", [1000, 2])
def test_substring_dedup(docs, shard):
    rows = docs.collect()
    starts = Counter()
    for r in rows:
        w = words(r.text)
        starts.update(tuple(w[i : i + 20]) for i in range(len(w) - 19))
    want = Counter()
    for r in rows:
        w = words(r.text)
        gone = [False] * len(w)
        for i in range(len(w) - 19):
            if starts[tuple(w[i : i + 20])] > 1:
                gone[i : i + 20] = [True] * 20
        want[(r.doc_id, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode())] += 1
    got = Counter(map(tuple, substrings.strip_repeats(docs, window=20, shard=shard).collect()))
    assert got == want


def test_substring_dedup_empty(empty):
    assert substrings.strip_repeats(empty).count() == 0


def test_decontaminate(spark):
    item = "The train leaves Bonn at 9 and covers 120 km in 2 hours . How far does the train go in 9 minutes if Anna keeps the pace ?"
    docs = [
        (1, "noise before this . " + item + " noise after"),
        (2, item.replace("9", "11").replace("120", "350").replace("Anna", "Peter")),
        (3, item.replace("leaves Bonn at 9", "leaves Bonn at 7").replace("120", "77")),  # 9 stands for 7 and for 9
        (4, "The train was late and nobody knew how far the next one would go in the rain"),
        (5, None), (6, ""), (1, "noise before this . " + item + " noise after"), (None, item), (7, "What is it"),
    ]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' as item_id", "1 as h")
    b = spark.createDataFrame([(1, item), (2, "what is it"), (3, None), (4, "")], "item_id long, text string")
    for most in (100, 0):
        got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(d, b, filter_max=most).collect()}
        assert set(got) == {(1, 1), (2, 1), (None, 1), (7, 2)}
        assert got[2, 1].reparameterised and not got[1, 1].reparameterised and got[1, 1].containment == 1.0
    assert sorted(r.doc_id for r in decontaminate.drop_contaminated(d, b).collect()) == [3, 4, 5, 6]
    assert decontaminate.contaminated(d.limit(0), b).count() == 0 and decontaminate.contaminated(d, b.limit(0)).count() == 0


def test_decontaminate_beyond_latin(spark):
    russian = "поезд выходит из города Москва в 9 часов и проходит 120 километров за 2 часа . Сколько времени едет Анна до города Тверь ?"
    chinese = "一列火车早上九点从北京出发,每小时行驶120公里,请问它需要多长时间才能到达上海。"
    thai = "รถไฟออกจากสถานีตอนเก้าโมงเช้าและวิ่งไปถึงเชียงใหม่ในตอนเย็น"
    german = "Wie weit fährt die Straßenbahn von Ärlen nach Überlingen , wenn sie 9 Minuten lang gleich schnell fährt ?"
    docs = [
        (1, "шум «до» этого . " + russian + " и после"),
        (2, russian.replace("Анна", "Ольга").replace("120", "350").replace("Москва", "Самара")),
        (3, russian.upper()),
        (4, "这是前面的文字" * 20 + chinese + "后面还有别的内容" * 20),
        (5, "“" + chinese.replace("120", "350").replace(",", "，") + "”"),
        (6, "ข่าวก่อนหน้า" + thai + "ข่าวหลัง"),
        (7, german.replace("Ärlen", "Öhringen").replace("9", "12")),
        (8, "这是一篇完全不同的文章,讲的是北京的天气和上海的饮食文化。"),
        (9, "Сегодня в городе Москва шёл дождь , и поезд опоздал на два часа"),
        (10, "รถไฟสายใหม่เปิดให้บริการแล้ววันนี้"),
        (11, "\u00a0…“”"),
    ]
    items = [(1, russian), (2, chinese), (3, thai), (4, german)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(d, b).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 2), (5, 2), (6, 3), (7, 4)}


def test_words_beyond_latin_against_characters():
    r = random.Random(4)
    alphabet = "aZ9 ,.\nÄéßЖяΩœŒ漢字かナー々ไทยກ𠀀😀«»“…，。！\u00a0ẞİ"
    inside = lambda c, ranges: any(lo <= ord(c) <= hi for lo, hi in ranges)
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 40))) for _ in range(300)]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    _, _, s, e, first, _, _ = decontaminate.canonical(data, np.cumsum([0, *map(len, raw)]))
    held = data.tobytes()
    for i, t in enumerate(texts):
        spaced = "".join(" " if inside(c, decontaminate.PARTING) else f" {c} " if inside(c, decontaminate.UNSPACED) else c for c in t)
        edge = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in "%+")
        want = [w for w in (x.strip(edge) for x in re.split(r"[ \t-\r]+", spaced)) if w]
        assert [held[s[j] : e[j]].decode() for j in range(first[i], first[i + 1])] == want
    low = decontaminate._read(data)[1].tobytes()
    assert "жяωœ".encode() in decontaminate._read(np.frombuffer("ЖяΩŒ".encode(), np.uint8))[1].tobytes() and len(low) == len(data)


def fingerprint(text):
    w = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    shingles = [b" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def test_simhash(docs, empty):
    rows = docs.collect()
    fps = [fingerprint(r.text) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = defaultdict(lambda: 1 << 60)
    for g, r in zip(group, rows, strict=True):
        least[g] = min(least[g], r.doc_id if r.doc_id is not None else 1 << 60)
    want = Counter((r.doc_id, f - (1 << 64) if f >> 63 else f, least[g]) for r, f, g in zip(rows, fps, group, strict=True))
    assert Counter(map(tuple, simhash.near_duplicates(docs).collect())) == want
    assert simhash.near_duplicates(empty).count() == 0


def test_keep_one(spark, docs, empty):
    r = random.Random(9)
    fresh = lambda n: [str(r.random()) for _ in range(n)]
    rows, group = [], {}
    for g in range(12):
        base = fresh(300)
        for k in range(r.randint(1, 6)):
            near = list(base)
            for _ in range(3 if k else 0):  # each change costs about 5 of 296 shingles
                near[r.randrange(300)] = str(r.random())
            group[len(rows)] = g
            rows.append((len(rows), " ".join(near).upper() if k == 2 else "  ".join(near)))
    half = fresh(200)
    lone = [half + fresh(100), half + fresh(100)]  # half alike: both stay
    rows += [(700, " ".join(lone[0])), (701, " ".join(lone[1])), (800, None), (801, ""), (None, rows[0][1]), (0, rows[0][1]), (802, "two words"), (803, "Two words")]
    table = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as fp", "2 as node", "3 as k1", "4 as u0", "5 as lead", "map('a', 1) as _uid")
    want = sorted({g: i for i, g in sorted(group.items(), reverse=True)}.values()) + [700, 701, 800, 802]
    got = simhash.keep_one(table)
    assert got.columns == table.columns and sorted(x.doc_id for x in got.collect()) == want
    assert simhash.keep_one(empty).count() == 0 and simhash.keep_one(docs).columns == docs.columns


def held(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(x.doc_id, x.item_id) for x in decontaminate.contaminated(docs, bench).collect()}


def test_decontaminate_capitals_in_doubt(spark):
    items = ["Anna has 5 apples. Anna gives Tom 3 apples. How many apples does Anna have left?", "Name the largest river of Peru today."]
    texts = [
        items[0].replace("Anna", "Peter"), items[0].upper(), items[0].lower(), "He said Name the largest river of Peru today. Then he left.",
        "Peter has 5 apples. Maria gives Tom 3 apples. How many apples does Julia have left?", "Nothing of the kind is in this text, not a single window.",
    ]
    assert held(spark, texts, items) == {(0, 0), (1, 0), (2, 0), (3, 1)}


def test_decontaminate_items_without_templates(spark):
    items = ["Compute 12 * 7 - 3", "3 5 7 11 13 17 19 23"]
    texts = ["We ask: Compute 12 * 7 - 3 and wait", "Compute 12 * 8 - 3", "see 3 5 7 11 13 17 19 23 there", "3 5 7 12 13 17 19 24"]
    assert held(spark, texts, items) == {(0, 0), (2, 1)}


def test_decontaminate_by_passage(spark):
    item = "The train leaves Bonn at 5 and covers 120 km in 2 hours . How far does the train go in 5 minutes if it keeps the pace ?"
    broken = item.replace("at 5", "at 7")  # 5 stands for 7 and for 5
    fill = " ".join(f"word{i}" for i in range(300))
    middle = item.split()
    texts = [
        broken, broken + " leaves Bonn at 5 and", "how far does the train go in 5 " + fill + " " + broken, broken + " then the train go in 5 minutes if it goes",
        " ".join(middle[:12]) + " " + fill + " " + " ".join(middle[12:]),  # two halves far apart are no passage
        " ".join([*middle[:13], "and", "more", *middle[13:]]), item.replace("5", "8") + " " + broken, fill,
    ]
    assert held(spark, texts, [item]) == {(5, 0), (6, 0)}


def test_decontaminate_stock_phrases(spark):
    stock = "choose the right answer from the list below and explain it in two full sentences please"
    items = [f"{stock} question{i} alpha{i} beta{i} gamma{i} delta{i} epsilon{i} zeta{i} eta{i} theta{i} iota{i} kappa{i} lambda{i}" for i in range(40)]
    texts = [stock] * 3 + [f"see {items[k]} there" for k in (3, 17)]
    assert held(spark, texts, items) == {(3, 3), (4, 17)}
    twice = spark.createDataFrame([(None, items[5], 1), (None, items[5], 2)], "item_id long, text string, h int")
    docs = spark.createDataFrame([(None, items[5]), (None, items[5]), (1, "x")], "doc_id long, text string").selectExpr("*", "1 as k1", "2 as bad", "3 as text_key", "4 as u0")
    assert decontaminate.contaminated(docs, twice).count() == 1
    kept = decontaminate.drop_contaminated(docs, twice)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [1]


def test_keep_one_short_texts(spark):
    rows = [(i, f"w{i} x{i}") for i in range(10_000)] + [(20_000 + i, f"W{i}  x{i}") for i in range(50)]
    got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(x.doc_id for x in got.collect()) == list(range(10_000))


def test_keep_one_family_below_the_bound(spark):
    base = [f"b{i}" for i in range(244)]
    tail = lambda k, n=40: [f"t{k}x{i}" for i in range(n)]
    rows = [(i, " ".join(base + tail(i))) for i in range(1500)]  # 0.75 alike
    rows += [(5000 + i, " ".join(base + tail(i, 20) + tail(5000 + i, 20))) for i in range(60)]  # each 0.87 like row i
    got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(x.doc_id for x in got.collect()) == list(range(1500))


def test_keep_one_decides_on_exact_similarity(spark):
    rows, want = [], []
    for g in range(40):
        n = 5 * (g + 1)  # shingles; 4 of 5 of them are exactly 0.8, one fewer is not
        text = [f"g{g}w{i}" for i in range(n + 4)]
        rows += [(10 * g, " ".join(text)), (10 * g + 1, " ".join(text[: n * 4 // 5 + 4])), (10 * g + 2, " ".join(text[-(n * 4 // 5 + 3) :] if n > 25 else ["lone", str(g)]))]
        want += [10 * g, 10 * g + 2]
    got = {x.doc_id for x in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == set(want)


def jaccard_groups(rows, similarity=0.8):
    """The smallest id of each group of rows linked by exact similarity of their five-word shingle sets."""
    sets = []
    for _, text in rows:
        w = (text or "").lower().split()
        sets.append(frozenset(" ".join(w[i : i + 5]) for i in range(len(w) - 4)) or frozenset([" ".join(w)] if w else []))
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for g, (i, _) in zip(group, rows, strict=True):
        least[g] = min(least.get(g, i), i)
    return sorted(least.values())


@pytest.mark.parametrize(("bucket", "crowd"), [(512, 64), (4, 1), (5, 64)])
def test_keep_one_brute_force(spark, bucket, crowd):
    r = random.Random(bucket)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = []
    for g in range(25):
        base = [f"g{g}w{i}" for i in range(r.choice([3, 20, 35, 80, 200, 500]))]
        for _ in range(6):
            near, n = list(base), len(base)
            for _ in range(r.randint(0, max(1, n // 45))):
                near[r.randrange(n)] = str(r.random())
            rows.append((len(rows), " ".join([passage, *near] if g % 2 else near)))
    rows += [(len(rows) + i, passage + " " + " ".join(f"l{i}x{j}" for j in range(90))) for i in range(40)]
    rows += [(len(rows), passage), (len(rows) + 1, passage + " end")]
    got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), bucket=bucket, crowd=crowd)
    assert sorted(x.doc_id for x in got.collect()) == jaccard_groups(rows)


def test_part_keys_guarantee():
    rng = np.random.default_rng(4)
    for _ in range(300):
        n = int(rng.integers(26, 400))
        both = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
        most = int(n * 0.25)  # so many shingles more on either side leave 0.8
        left = int(rng.integers(0, most + 1))
        a, b = (np.unique(np.r_[both, rng.integers(0, 1 << 63, k, dtype=np.uint64)]) for k in (left, most - left))
        row, kind, key = simhash._part_keys(np.r_[a, b], np.cumsum([0, len(a), len(b)]), 0.8)
        one, two = (set(zip(kind[row == i].tolist(), key[row == i].tolist(), strict=True)) for i in (0, 1))
        assert one & two


def test_links_in_hot_buckets(spark):
    r = random.Random(3)
    centre = r.getrandbits(64)
    fps = {centre ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 3))) for _ in range(300)} | {r.getrandbits(64) for _ in range(300)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    table = spark.createDataFrame([(f,) for f in signed], "fp long")
    group = {f: f for f in fps}
    ordered = sorted(fps)
    for i, a in enumerate(ordered):
        for b in ordered[:i]:
            if (a ^ b).bit_count() <= 4 and group[a] != group[b]:
                old, new = group[a], group[b]
                group = {k: new if v == old else v for k, v in group.items()}
    want = len(set(group.values()))
    for bucket in (512, 8):
        got = simhash.components_of(table, 4).select("component").distinct().count() if bucket == 512 else None
        edges = simhash.links(table, 4, bucket).collect()
        parent = {f: f for f in signed}

        def root(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for e in edges:
            a, b = root(e.a), root(e.b)
            parent[max(a, b)] = min(a, b)
        assert len({root(f) for f in signed}) == want
        assert got in (None, want)


@pytest.mark.parametrize("flips", [(1, 6), (6, 14), (1, 20)])
def test_links_of_one_bucket_stay_few(spark, flips):
    r = random.Random(5)
    low = lambda: sum(1 << b for b in r.sample(range(40), r.randint(*flips)))
    fps = np.array(sorted({(9 << 58) ^ low() for _ in range(6000)}), np.uint64)  # all agree in 24 bits
    label = np.arange(len(fps))
    a, b = (np.concatenate(x) for x in zip(*[(np.full(len(j), i), j) for i in range(len(fps)) for j in [i + 1 + np.flatnonzero(np.bitwise_count(fps[i + 1 :] ^ fps[i]) <= 4)]], strict=True))
    hung, root = simhash._span(len(fps), a, b)
    label[hung] = root
    table = spark.createDataFrame(pa.table({"fp": fps.view(np.int64)}))
    edges = simhash.links(table, 4).toArrow()
    place = {f: i for i, f in enumerate(fps.view(np.int64).tolist())}
    x, y = (np.array([place[v] for v in edges.column(c).to_pylist()], np.int64) for c in ("a", "b"))
    assert (label[x] == label[y]).all()
    hung, root = simhash._span(len(fps), x, y)
    mine = np.arange(len(fps))
    mine[hung] = root
    assert (mine == label).all()
    assert len(x) <= len(simhash.masks(len(fps), 4)) * len(fps)  # no more than a forest in each table


def test_mixing_says_when_rates_do_not_settle(spark):
    sized = spark.createDataFrame([("a", 10), ("b", 30)], "source string, size long")
    goal = spark.createDataFrame([("a", 29.0), ("b", 11.0)], "source string, target double")
    with pytest.raises(RuntimeError, match="settle"):
        mixing.rates(sized, goal, steps=2)
    got = {r.source: r.rate for r in mixing.rates(sized, goal).collect()}
    assert got["a"] == pytest.approx(2.9) and got["b"] == pytest.approx(11 / 30)


def test_language(docs, spark, empty):
    r = random.Random(2)
    kinds = {"en": "the and thing with", "de": "und der schön nicht", "fr": "être çela une que", "es": "niño que ción los"}
    rows = [(i, " ".join(r.choice(kinds[k].split()) for _ in range(r.randint(3, 40))), k) for i in range(240) for k in [r.choice(list(kinds))]]
    rows += [(1000, None, "en"), (1001, "12 ;; 7", "fr"), (1002, "", None), (1003, "the thing with", None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "0.5 as score", "'q' as lang_pred")
    models = language.train(table.where("doc_id % 4 <> 2"))
    got = {x.doc_id: x for x in language.identify(table, models).collect()}
    assert np.mean([got[i].lang_pred == k for i, _, k in rows[:240] if i % 4 == 2]) > 0.97
    assert all(0 <= x.score <= 1 for x in got.values())
    assert [got[i].lang_pred for i in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "en"]
    assert {x.lang_pred for x in language.identify(table, language.train(empty)).collect()} == {"und"}
    one = language.train(table.where("lang = 'en'"))
    assert {x.lang_pred for x in language.identify(table, one).collect()} == {"und", "en"}
    kept = language.keep_identified(table)
    assert kept.columns == table.columns and kept.count() == 241


def test_language_learns_every_value(spark):
    r = random.Random(12)
    own = {f"q{i:02d}": ["".join(r.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(12)] for i in range(40)}
    own |= {"en-GB": "the and thing with".split(), "de_AT": "und der nicht ein".split()}
    rows = [(i, " ".join(r.choice(own[k]) for _ in range(25)), k) for i in range(42 * 14) for k in [sorted(own)[i % 42]]]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    models = language.train(table.where("doc_id < 504"))
    assert {x for m in models if m[0] for x in m[1:3] if x} == set(own) and len({m[0] for m in models if m[0]}) == 5
    got = language.identify(table.where("doc_id >= 504"), models).collect()
    assert np.mean([x.lang_pred == x.lang for x in got]) > 0.95


def test_quality(spark, empty):
    r = random.Random(4)
    good = lambda: " ".join(r.choice(["the", "house", "Stands", "there,", "is", "nice."]) for _ in range(r.randint(5, 80)))
    bad = lambda: " ".join(r.choice(["BUY!!", "NOW!!", "|", "###", "the"]) for _ in range(r.randint(5, 80)))
    rows = [(i, good() if i % 3 else bad(), int(i % 3 > 0)) for i in range(200)] + [(500, None, 1), (501, "", None), (502, "x", 7)]
    table = spark.createDataFrame(rows, "doc_id long, text string, label int").selectExpr("*", "'s' as score")
    model = quality.train(table.where("doc_id % 5 <> 0"))
    got = {x.doc_id: x.score for x in quality.score(table, model).collect()}
    assert np.mean([(got[i] >= 0.5) == bool(y) for i, _, y in rows[:200] if i % 5 == 0]) > 0.95
    assert len(got) == 203 and all(0 < s < 1 for s in got.values())
    assert quality.score(table, quality.train(empty)).select("score").distinct().count() == 1


def test_quality_sees_words(spark):
    r = random.Random(7)
    words_of = [["".join(r.choice("abcdefghij") for _ in range(8)) for _ in range(400)] for _ in range(2)]
    rows = [(i, " ".join(r.choice(words_of[i % 2]) for _ in range(30)), i % 2) for i in range(400)]
    table = spark.createDataFrame(rows, "doc_id long, text string, label int")
    got = quality.score(table.where("doc_id >= 300"), quality.train(table.where("doc_id < 300"))).collect()
    assert np.mean([(g.score >= 0.5) == bool(g.label) for g in got]) >= 0.95


def test_quality_features_of_a_row_do_not_depend_on_its_neighbours():
    texts = ["A small text, here.", "", "here HERE here", "x"]
    block = lambda t: quality.features(np.frombuffer("".join(t).encode(), np.uint8), np.cumsum([0, *[len(x) for x in t]]))
    for t, got in zip(texts, block(texts), strict=True):
        if t:
            assert (got == block([t])[0]).all()


def test_svm_meets_the_optimality_conditions_of_its_dual():
    rng = np.random.default_rng(3)
    x, c = rng.normal(size=(80, 6)), 0.7
    y = np.where(x[:, 0] + 0.8 * rng.normal(size=80) > 0, 1.0, -1.0)
    rows = [(np.arange(6), v) for v in x]
    w = svm.fit(rows, 6, y, c, epochs=3000, tol=1e-9)
    margin = y * (np.c_[x, np.ones(80)] @ w)
    free = np.c_[x, np.ones(80)][np.abs(margin - 1) < 1e-5] * y[np.abs(margin - 1) < 1e-5, None]
    inside = c * (np.c_[x, np.ones(80)] * y[:, None])[margin < 1 - 1e-5].sum(axis=0)
    alpha = np.linalg.lstsq(free.T, w - inside, rcond=None)[0]  # w is the sum of alpha y x: c below the margin, 0 above it
    assert np.allclose(free.T @ alpha + inside, w, atol=1e-5) and (alpha > -1e-4).all() and (alpha < c + 1e-4).all()
    a, b = svm.platt(svm.margins(rows, w), y)
    p = 1 / (1 + np.exp(-(a * svm.margins(rows, w) + b)))
    assert a > 0 and abs(p.mean() - (y > 0).mean()) < 0.02


def test_mixing(docs, empty):
    got = mixing.mix(docs).collect()
    assert len(got) == docs.count() and all(0 <= g._copies <= 3 and g._size == len(words(g.text)) for g in got)
    size, target, taken = defaultdict(int), {}, defaultdict(int)
    for g in got:
        size[g.source] += g._size
        taken[g.source] += g._size * g._copies
        target[g.source] = g._target
    weight = dict(zip(sorted(size, key=lambda s: (s is None, s or "")), (5, 2, 1), strict=False))
    free, whole, fixed = dict(weight), sum(size.values()), {}
    while over := [s for s in free if (whole - sum(fixed.values())) * free[s] / sum(free.values()) > 3 * size[s] + 1e-9]:
        for s in over:
            fixed[s] = 3 * size[s]
            del free[s]
    for s in size:
        want = fixed.get(s) if s in fixed else (whole - sum(fixed.values())) * free[s] / sum(free.values())
        assert target[s] == pytest.approx(want) and abs(taken[s] - want) <= max(3, 0.01 * want)
    again = mixing.mix(docs.repartition(5)).select("doc_id", "text", "_copies").collect()
    assert Counter(map(tuple, again)) == Counter((g.doc_id, g.text, g._copies) for g in got)
    assert mixing.mix(empty).count() == 0
    assert mixing.mixed(docs).columns == docs.columns and mixing.mixed(docs).count() == sum(g._copies for g in got)


def test_mixing_passes_columns_of_any_name(spark):
    inner = ["_size", "_rate", "_src", "size", "rate", "tilt", "target", "copies", "k1", "k2", "s", "n", "u0", "u1", "source_size", "groups", "part", "nth", "a", "b", "t", "copy"]
    rows = [(None if i == 5 else str(i), "w " * (i % 7), None if i % 3 == 0 else "s", *[7] * len(inner)) for i in range(40)] + [("9", "w w", "s", *[7] * len(inner))] * 5
    docs = spark.createDataFrame(rows, "doc_id string, text string, source string, " + ", ".join(f"`{c}` int" for c in inner))
    got = mixing.mixed(docs)
    assert got.columns == docs.columns and set(map(tuple, got.collect())) <= set(map(tuple, docs.collect()))
    assert mixing.mix(docs).drop("_size", "_source_size", "_target", "_copies").columns == [c for c in docs.columns if c != "_size"]
    size, taken = (mixing.mix(docs).selectExpr(x).first()[0] for x in ("sum(_size)", "sum(_size * _copies)"))
    assert abs(size - taken) <= 6


def test_mixing_reshares_the_excess(spark):
    rows = [(i, "w " * (10 if s == "a" else 200), s) for i in range(30) for s in ["a", "b", "c"]]
    got = {r.source: r._target for r in mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    whole = 30 * 410
    assert got["a"] == 900 and got["b"] == pytest.approx((whole - 900) * 2 / 3) and got["c"] == pytest.approx((whole - 900) / 3)


def test_hmm_base_and_likelihood(docs, empty):
    train = docs.where("doc_id % 10 <> 0")
    count, n = Counter(), 0
    for r in train.collect():
        count.update((r.text or "").encode().lower().split())
        n += 1
    total, whole = sum(count.values()) + n, sum(count.values()) + n + 0.1 * (len(count) + 2)
    model = hmm.train(train)
    got = hmm.score(docs.selectExpr("doc_id", "text", "score", "1 as tail", "2 as n_tokens"), model).collect()
    want = Counter()
    for r in docs.collect():
        w = (r.text or "").encode().lower().split()
        base = sum(math.log10((count[x] + 0.1) / whole) for x in w) + math.log10((n + 0.1) / whole)
        want[(r.doc_id, len(w) + 1, sum(x in count for x in w) + 1, total, round(base, 6))] += 1
    assert Counter((g.doc_id, g.n_tokens, g.n_known, g.train_tokens, round(g.base_score, 6)) for g in got) == want
    assert all(g.score < 0 for g in got)
    assert hmm.score(empty.select("doc_id", "text"), model).count() == 0
    assert hmm.score(docs.select("doc_id", "text"), hmm.train(empty)).where("n_known > 0").count() == 0


def test_forward_is_exact():
    rng = np.random.default_rng(0)
    k, s = 3, hmm.OWN + hmm.CLASSES + 1
    norm = lambda x: (x / x.sum(axis=-1, keepdims=True)).astype(np.float32)
    m = {"move": norm(rng.random((k, k))), "emit": np.ascontiguousarray(norm(rng.random((k, s))).T), "first": norm(rng.random(k)), "later": norm(rng.random(k))}
    seqs = [rng.integers(0, s, n) for n in (5, 1, 9)]
    got = hmm.forward(np.concatenate(seqs), np.array([5, 1, 9]), m)
    for q, g in zip(seqs, got, strict=True):
        x = m["first"].astype(float) * m["emit"][q[0]]
        for t in q[1:]:
            x = x @ m["move"].astype(float) * m["emit"][t]
        assert g == pytest.approx(math.log10(x.sum()))
    counts, gains = hmm._zero(k), []
    n = np.array([len(q) for q in seqs])
    for _ in range(5):  # texts are shorter than a piece, so each round must not lose likelihood
        counts = hmm._zero(k)
        gains.append(hmm.expect(np.concatenate(seqs), n, m, counts))
        assert counts["emit"].sum() == pytest.approx(n.sum(), rel=1e-3)
        m = {x: norm(counts[x] + 1e-9) for x in ("move", "first", "later")} | {"emit": np.ascontiguousarray(norm(counts["emit"].T + 1e-9).T)}
    assert all(b >= a - 1e-3 for a, b in zip(gains, gains[1:], strict=False))


def test_expected_counts_of_long_texts():
    rng = np.random.default_rng(2)
    k, symbols = 3, hmm.OWN + hmm.CLASSES + 1
    norm = lambda x: x / x.sum(axis=-1, keepdims=True)
    m = {"move": norm(rng.random((k, k)) + 2 * np.eye(k)), "emit": np.ascontiguousarray(norm(rng.random((k, symbols)) ** 4).T), "first": norm(rng.random(k)), "later": norm(rng.random(k))}
    texts = [rng.integers(0, 50, size) for size in (1, hmm.PIECE, hmm.PIECE + 1, 3 * hmm.PIECE + 5, 700)]
    got = hmm._zero(k)
    hmm.expect(np.concatenate(texts), np.array([len(t) for t in texts]), m, got)
    want = hmm._zero(k)
    for q in texts:  # forward and backward over the whole text
        e = m["emit"][q]
        f = np.empty((len(q), k))
        for t in range(len(q)):
            f[t] = norm((m["first"] if t == 0 else f[t - 1] @ m["move"]) * e[t])
        g = np.ones(k)
        for t in range(len(q) - 1, -1, -1):
            gamma = norm(f[t] * g)
            want["emit"][q[t]] += gamma
            if t:
                want["move"] += (x := np.outer(f[t - 1], e[t] * g) * m["move"]) / x.sum()
            g = norm(m["move"] @ (e[t] * g))
        want["first"] += gamma
    assert got["move"].sum() == pytest.approx(sum(len(t) - 1 for t in texts), rel=1e-3)  # no transition is lost
    for x in ("move", "first", "emit"):
        assert np.abs(got[x] - want[x]).max() < 0.01 * want[x].max()


def test_hmm_words_beyond_the_symbols(spark, monkeypatch):
    """Every word of a vocabulary larger than OWN and HEAD has its own emissions; they sum to one, and the recursion uses them."""
    monkeypatch.setattr(hmm, "HEAD", 300)
    r = random.Random(4)
    topics = [[f"{a}{i:x}{'xyz'[i % 3]}" for i in range(11_000)] for a in ("ka", "lo")]
    texts = [" ".join(r.choice(topics[i % 2][: r.choice([50, 11_000])]) for _ in range(r.randint(1, 400))) for i in range(400)]
    docs = spark.createDataFrame([*enumerate(texts), (400, None), (401, ""), (402, texts[1].upper()), (403, "never seen " + texts[0]), (403, "never seen " + texts[0])], "doc_id long, text string").repartition(3)
    model = hmm.train(docs.where("doc_id < 400"))
    assert model["rest"].count() > 2000
    rest = {x["word"]: x for x in model["rest"].collect()}
    seen = set(" ".join(texts).split())
    have = dict(zip(model["keys"].tolist(), range(len(model["keys"])), strict=True))
    one = lambda w, c, q: hmm._emissions(pa.array([w]), np.array([c]), pa.array([q], pa.binary()), model["classes"], model["choice"])[0]
    emit, unseen = {}, {}
    for w in [*sorted(seen), "never", "seen", *map(str, range(10_000))]:
        at = have.get(int(hmm._hash_words([w])[0]))
        assert at is not None or w in rest or w not in seen
        x = rest.get(w)
        emit[w] = model["emit"][at] if at is not None else one(w, x["c"], x["q"]) if x else one(w, 0, None)
        if w not in seen:
            unseen[int(hmm._kinds(pa.array([w]))[0])] = emit[w]
    for kind in range(hmm.CLASSES):  # of each class all unseen words have one share
        if kind not in unseen:
            unseen[kind] = model["classes"][kind] * hmm.SMOOTH / model["choice"]["mass"][kind] * model["choice"]["spread"][kind] / model["choice"]["norm"][kind]
    assert np.sum([emit[w] for w in seen], axis=0) + np.sum(list(unseen.values()), axis=0) + model["emit"][-1] == pytest.approx(np.ones(hmm.STATES), abs=1e-3)

    def likelihood(text):
        out, x = 0.0, None
        for e in [*(emit[w] for w in (text or "").lower().split()), model["emit"][-1]]:
            x = (model["first"] if x is None else x @ model["move"].astype(float)) * e.astype(float)
            out, x = out + math.log10(x.sum()), x / x.sum()
        return out

    got = hmm.score(docs, model).collect()
    whole = {r.doc_id: r.text for r in docs.collect()}
    assert sorted(g.doc_id for g in got) == sorted([*range(404), 403])
    for g in got:
        assert g.score == pytest.approx(likelihood(whole[g.doc_id]), abs=1e-3)
        w = (whole[g.doc_id] or "").lower().split()
        assert (g.n_tokens, g.n_known) == (len(w) + 1, sum(x in seen for x in w) + 1)


def test_lookup():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2)
    find = hmm.Lookup(keys)
    assert (find(keys) == np.arange(5000)).all() and (find(keys + np.uint64(1)) == -1).all()
    assert (hmm.Lookup(keys[:0])(keys[:3]) == -1).all()


def test_permutation():
    for n in (1, 2, 5, 1000, 4097):
        p = tokens.permute(np.arange(n), n, 11)
        assert sorted(p.tolist()) == list(range(n))
    assert (tokens.permute(np.arange(1000), 1000, 1) != tokens.permute(np.arange(1000), 1000, 2)).any()


def test_training_order_round_trip(docs, empty, tmp_path):
    out = tokens.materialise(docs, length=16, per_shard=10)
    rows = out.collect()
    assert [r.slot for r in rows] == list(range(len(rows)))
    assert all(r.shard == r.slot // 10 and r.byte_offset == r.slot % 10 * 32 and len(r.tokens) == 32 for r in rows)
    encode = tokens._Encoder(ranks := open(tokens.TOKENIZER, "rb").read()).encode
    odd = ["a\nb c", "a\n\nb", " a", "a ", "\na", "a\tb", "a \nb", "a\n b", "don't\nstop 12\n34", "\u00a0x y", "x\u2003y", "é è\nü", "", "\n", " ", "a\rb", "x" * 500]
    for t in odd:
        assert list(np.frombuffer(tokens._Encoder(ranks).ids(t), "<u2")) == encode(t)
    want = Counter()
    for r in docs.collect():
        ids = [*encode(r.text or ""), tokens.END]
        for i in range(0, len(ids), 16):
            part = ids[i : i + 16]
            want[(r.doc_id, i // 16, len(part), tuple(part + [tokens.END] * (16 - len(part))))] += 1
    assert Counter((r.doc_id, r.part, r.n_tokens, tuple(np.frombuffer(r.tokens, "<u2").tolist())) for r in rows) == want
    again = {(r.slot, r.doc_id, r.part) for r in tokens.materialise(docs.repartition(7), length=16, per_shard=10).collect()}
    assert again == {(r.slot, r.doc_id, r.part) for r in rows}
    where = str(tmp_path / "shards")
    tokens.write_shards(out, where, 16, 10)
    for slot in (0, 13, len(rows) - 1, len(rows), len(rows) + 5):
        assert [x.tobytes() for x in tokens.read_from(where, slot)] == [bytes(r.tokens) for r in rows[slot:]]
    bad = out.withColumn("shard", F.when(F.col("slot") == len(rows) - 1, F.raise_error(F.lit("lost"))).otherwise(F.col("shard")))
    with pytest.raises(Exception, match="lost"):
        tokens.write_shards(bad, where, 16, 10)
    assert len(list(tokens.read_from(where))) == len(rows)  # the former run is whole
    few = tokens.materialise(docs.limit(3), length=16, per_shard=10)
    tokens.write_shards(few, where, 16, 10)  # fewer shards than before: none of the former ones is read
    assert [x.tobytes() for x in tokens.read_from(where)] == [bytes(r.tokens) for r in few.collect()]
    assert len([x for x in (tmp_path / "shards").iterdir() if x.is_dir()]) == 1
    tokens.write_shards(tokens.materialise(empty), where)
    assert list(tokens.read_from(where)) == []
    assert tokens.materialise(empty).count() == 0
    named = docs.selectExpr("cast(doc_id as string) as doc_id", "text", "1 as uid", "2 as id", "3 as tie", "4 as start", "5 as slot")
    assert Counter((r.doc_id, r.part) for r in tokens.materialise(named).collect()) == Counter((r.doc_id and str(r.doc_id), r.part) for r in tokens.materialise(docs.select("doc_id", "text").withColumn("doc_id", docs.doc_id.cast("string"))).collect())


def test_chat(spark):
    rows = [
        (1, 0, "system", "be <|im_end|> kind"), (1, 1, "user", None), (1, 2, "user", "<\\|x<|<\\\\|"), (1, 3, "assistant", "<|text|><|part|>\n"), (1, 4, "assistant", "b"),
        (2, 1, "assistant", "late"), (2, 0, None, "first"), (None, 0, "user", ""), (3, 0, "as<|x\ny", "é\\"), (4, 5, "user", "same"), (4, 5, "user", "same"),
    ]
    out = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").selectExpr("*", "1 as segments"))
    got = {r.conv_id: r for r in out.withColumn("back", chat.read_chats(out.formatted)).withColumn("loss", chat.loss_text(out.segments)).collect()}
    for c in (1, 2, None, 3, 4):
        want = [(r or "", t or "") for _, _, r, t in sorted((x for x in rows if x[0] == c), key=lambda x: x[1])]
        assert [(t.role, t.text) for t in got[c].back] == want
        assert got[c].loss == "".join(t for r, t in want if r == "assistant")
        assert "".join(s.text for s in got[c].segments) == got[c].formatted
    assert got[1].formatted.count(chat.START) == 3
    assert chat.format_chats(spark.createDataFrame([], "conv_id long, turn int, role string, text string")).count() == 0


def test_string_ids_and_nulls(spark):
    """A row without an id and one without a text are not taken for each other."""
    t = " ".join(f"w{i}" for i in range(50))
    rows = spark.createDataFrame([(None, t), (t, None), ("a", t)], "doc_id string, text string")
    assert {(r.doc_id, r.n_words, r.n_removed) for r in substrings.strip_repeats(rows).collect()} == {(None, 50, 50), (t, 0, 0), ("a", 50, 50)}


def test_row_keys_tell_a_null_id_from_a_null_text(spark):
    text = "one two three four five six seven eight"
    rows = spark.createDataFrame([(None, text, "s"), (text, None, "s"), (None, text, "s"), ("b", None, "s")], "doc_id string, text string, source string")
    keys = {(r["k1"], r["k2"]) for r in rows.select(*_spark.row_hashes("doc_id", "text")).collect()}
    assert len(keys) == 3
    kept = [tuple(r) for r in simhash.keep_one(rows, "doc_id", "text").select("doc_id", "text").collect()]
    assert sorted(kept, key=str) == sorted([(None, text), ("b", None)], key=str)
    taken = mixing.mix(rows, keep_text=False).select("doc_id", "_size", "_copies").collect()
    assert sorted((str(r["doc_id"]), r["_size"]) for r in taken) == sorted([("None", 8), ("None", 8), (text, 0), ("b", 0)])
    assert sum(r["_copies"] for r in taken) == 2 and all(not r["_copies"] for r in taken if not r["_size"])
    bench = spark.createDataFrame([("x", text), (text, None)], "item_id string, text string")
    found = decontaminate.contaminated(rows, bench).select("doc_id", "item_id").collect()
    assert [tuple(r) for r in found] == [(None, "x")]


def test_kept_digest(docs):
    plain = {(r.doc_id, hashlib.sha256(r.kept.encode()).hexdigest()) for r in substrings.strip_repeats(docs).collect()}
    assert plain == {(r.doc_id, r.kept) for r in substrings.strip_repeats(docs, digest=True).collect()}


def test_keep_one_by_fingerprints(spark, monkeypatch):
    """Close copies are found by the pigeonhole tables of their fingerprints, with nothing from the blocks of their sets; the sets decide."""
    rng = random.Random(8)
    texts = [[f"w{rng.randrange(5000)}" for _ in range(3000)] for _ in range(6)]
    rows = [(10 * i, " ".join(t)) for i, t in enumerate(texts)] + [(10 * i + 1, " ".join([*t[:1500], "other", *t[1501:]])) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(simhash, "similar_links", lambda nodes, *_: nodes.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0))
    kept = {r.doc_id for r in simhash.keep_one(frame).collect()}
    assert {10 * i for i in range(6)} <= kept and len(kept) < 9
    assert {r.doc_id for r in simhash.keep_one(frame, similarity=0.9999).collect()} == {r[0] for r in rows}


def test_fingerprint_links(spark):
    """All within 4 bits lie in one component, equal fingerprints too; no link joins others."""
    rng = random.Random(9)
    base = [rng.getrandbits(63) for _ in range(20)]
    nodes = [(i, b ^ (1 << rng.randrange(60)) ^ (1 << rng.randrange(60))) for i, b in enumerate(base * 6)] + [(200 + i, b) for i, b in enumerate(base * 2)]
    fp = dict(nodes)
    edges = [tuple(r) for r in simhash.fingerprint_links(spark.createDataFrame(nodes, "node long, fp long"), bucket=8).collect()]
    assert all((fp[a] ^ fp[b]).bit_count() <= 4 for a, b in edges)
    root = {n: n for n in fp}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        root[top(a)] = top(b)
    assert all(top(a) == top(b) for a in fp for b in fp if (fp[a] ^ fp[b]).bit_count() <= 4)


def test_with_hint(spark):
    """No row whose key occurs is missed, few others are named, also with full bitmaps and without keys; repeats stay."""
    rows = spark.range(20000).select(F.xxhash64("id").alias("k"), "id").unionByName(spark.range(5).select(F.xxhash64("id").alias("k"), "id"))
    keys = rows.where("id % 10 = 0").select("k")
    for most, others in ((4096, 0.1), (1, 0.1)):
        got = [(r.id, r.met) for r in _spark.with_hint(rows, keys, "k", "met", most).collect()]
        assert len(got) == 20005 and all(met for i, met in got if i % 10 == 0)
        assert sum(met for i, met in got if i % 10) < others * 18000
    assert not _spark.with_hint(rows, keys.limit(0), "k", "met").where("met").count()


def test_keep_one_leaves_texts_in_place(spark):
    """Texts that have no near copy meet no shuffle: only marks and shingles of them do."""
    rng = random.Random(12)
    rows = [(i, " ".join("%040x" % rng.getrandbits(160) for _ in range(400))) for i in range(240)]
    frame = spark.createDataFrame([*rows, (900, rows[7][1] + " tail")], "doc_id long, text string")
    store, none = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0)

    def written():
        stages = store.stageList(None, False, False, none, spark.sparkContext._jvm.java.util.ArrayList())
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        start = written()
        got = sorted(tuple(r) for r in simhash.keep_one(frame).collect())
        assert got == rows and written() - start < 0.5 * sum(len(t) for _, t in rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
