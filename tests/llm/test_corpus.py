from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import leakage, mixing, readlevel

WORDS = "river market ledger copper window garden barrel village harbour lantern meadow orchard candle timber bridge".split()
HAN = "河市账铜窗园桶村港灯草果烛木桥山田水火土金石云雨风雪花鸟鱼虫"


def passage(seed: int, n: int, han: bool = False) -> str:
    r = random.Random(seed)
    return "".join(r.choice(HAN) for _ in range(n)) if han else " ".join(r.choice(WORDS) + str(r.randrange(90)) for _ in range(n))


# -- leakage ------------------------------------------------------------------
def test_leaks(spark):
    item, han = passage(1, 60), passage(2, 200, True)
    noisy = item.upper().replace(" ", "  \n", 5)
    noisy = noisy[:120] + "X" + noisy[121:]
    docs = [
        (1, "Start. " + item + " End."), (2, passage(9, 30) + noisy + passage(10, 30)), (3, "序" + han[40:170] + "尾"),
        (4, passage(5, 200)), (5, item[: len(item) // 6] + passage(6, 60)), (6, None), (7, ""), (1, "Start. " + item + " End."),
        (8, han[:30] + passage(11, 100, True)),
    ]
    items = [(70, item), (71, han), (72, None), (73, ""), (74, passage(77, 50))]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    found = leakage.leaked_items(d, i)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(1, 70), (2, 70), (3, 71)}
    assert {r.doc_id for r in leakage.without_leaks(d, found).collect()} == {4, 5, 6, 7, 8}
    assert leakage.leaked_items(d.limit(0), i).count() == 0 and leakage.leaked_items(d, i.limit(0)).count() == 0


def test_leaks_in_documents_of_another_script(spark):
    item, han, thai = passage(1, 60), passage(2, 200, True), "".join(random.Random(3).choice("กขคงจชซดตถทนบปผพฟมยรลวสห") for _ in range(300))
    docs = [
        (1, passage(9, 600) + han + passage(10, 600)), (2, passage(11, 1500, True) + item + passage(12, 1500, True)),
        (3, thai * 3 + han), (4, passage(13, 1500, True) + thai), (5, passage(14, 600)), (6, passage(15, 1500, True)),
    ]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame([(70, item), (71, han), (72, thai)], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in leakage.leaked_items(d, i).collect()}
    assert found == {(1, 71), (2, 70), (3, 71), (3, 72), (4, 72)}


def test_follow():
    assert leakage.follow("abcdefgh--ijklmnop", "abcdefgh+ijklmnopq", 4) == (18, 17)
    assert leakage.follow("abcd", "xxxxabcd", 4) == (4, 8) and leakage.follow("", "abcd", 4) == leakage.follow("wxyz", "abcd", 4) == (0, 0)


def noisy(text: str, r: random.Random, rate: float = 0.02) -> str:
    """Characters replaced, left out and doubled, blanks for line breaks."""
    out = []
    for c in text:
        x = r.random()
        out.append(c if x > rate else r.choice(["", c + c, "·" + c, "e" if c != "e" else "c"]))
    return "".join(out).replace(" ", "\n", 3)


@pytest.mark.parametrize("kind", ["whole", "half", "noisy"])
@pytest.mark.parametrize("item_script", ["han", "latin", "thai"])
def test_recall_by_kind_and_script(spark, kind, item_script):
    r = random.Random(f"{kind}{item_script}")
    thai = lambda n: "".join(r.choice("กขคงจชซดตถทนบปผพฟมยรลวสห") for _ in range(n))
    make = {"han": lambda k: passage(k, 240, True), "latin": lambda k: passage(k, 60), "thai": lambda k: thai(360)}
    items = [(k, make[item_script](1000 + k)) for k in range(30)]
    docs, want = [], set()
    for n, (k, item) in enumerate(items):
        part = {"whole": item, "half": item[len(item) // 5 : len(item) // 5 + int(len(item) * 0.58)], "noisy": noisy(item, r)}[kind]
        around = make[("han", "latin", "thai")[n % 3]]
        docs += [(n, around(5000 + n) + " " + part + " " + around(6000 + n)), (100 + n, around(7000 + n) + item[: len(item) // 5] + around(8000 + n))]
        want.add((n, k))
    found = leakage.leaked_items(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(x.doc_id, x.item_id) for x in found.collect()}
    assert got <= want and len(got) >= 0.95 * len(want)


def test_suffix_search_against_brute_force():
    r = random.Random(3)
    a = "".join(r.choice("abc") for _ in range(400))
    b = "".join(r.choice("abc") for _ in range(300)) + a[100:180]
    codes, _ = leakage.encode([b])
    shard = leakage.Suffixes(codes, 6, 1)
    items = leakage.Items([1], [a], 6)
    which, there = shard.find(items.keys)
    here = items.at[which]
    length = leakage.extend(items.codes, here, codes, there, 6)
    x, y = items.codes, codes
    want = {}
    for i in range(len(x) - 1):
        for j in range(len(y) - 1):
            n = 0
            while i + n < len(x) - 1 and j + n < len(y) - 1 and x[i + n] == y[j + n]:
                n += 1
            if n >= 6:
                want[i, j] = n
    assert {(i, j): n for i, j, n in zip(here.tolist(), there.tolist(), length.tolist(), strict=True)} == want


# -- mixing -------------------------------------------------------------------
def test_rake_reaches_the_shares_within_the_caps():
    tokens = np.array([100.0, 300, 50, 50, 10])
    source = np.array([0, 0, 1, 1, 2])
    lang = np.array([0, 1, 0, 1, 0])
    w, total, rounds, error = mixing.rake(tokens, source, [lang], np.array([0.5, 0.4, 0.1]), np.array([2.0, 3, 4]))
    got = np.bincount(source, tokens * w, 3)
    assert np.allclose(got / got.sum(), [0.5, 0.4, 0.1], atol=1e-6) and total == pytest.approx(400)
    assert (w <= np.array([2, 2, 3, 3, 4]) + 1e-9).all()
    assert rounds <= mixing.ROUNDS and error < 1e-6
    w, total, *_ = mixing.rake(tokens, source, [lang], np.array([0.0, 0, 0]), np.array([1.0, 1, 1]))
    assert total == 0 and not w.any()
    assert mixing.rake(tokens, source, [lang], np.array([0.5, 0.5, 0]), np.array([0.0, 1, 1])).total == 0


def test_mixture(spark, monkeypatch):
    docs = [(i, f"word number {i} of a text that goes on", "en", ("big" if i < 300 else "small"), None) for i in range(400)]
    docs += [(900, None, None, "big", "t"), (901, "x", "ZH-Hans", None, "t"), (902, "y y y", "zh", "other", None)]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, title string")
    rows = [("p", "big", 0.5, 1), ("p", "small", 0.5, 2), ("p", "none", 0.3, None), ("p", "nothing", None, None)]
    t = spark.createDataFrame(rows, "plan string, source string, target_share double, max_repeats int")
    rows = mixing.mix_report(mixing.mixture(d, t)).collect()
    report = {r.name: r for r in rows if r.margin == "source"}
    for m in ("source", "lang", "topic"):
        assert sum(r.actual_share for r in rows if r.margin == m) == pytest.approx(1, abs=1e-5)
    assert {r.name for r in rows if r.margin == "lang"} == {"en"} and all(r.error < 1e-6 for r in rows)
    assert abs(report["big"].actual_share - 0.5) < 0.03 and report["small"].most_copies <= 2
    assert report["none"].mixed_tokens == 0 and report["none"].documents == 0
    mixed = mixing.mixture(d, t, topic=F.col("source")).mixed
    assert mixed.where("source NOT IN ('big', 'small')").count() == 0
    a, b = (sorted(map(tuple, mixing.mixture(d, t)[0].collect())) for _ in range(2))
    assert a == b
    assert mixing.mixture(d.limit(0), t)[0].count() == 0
    none = mixing.mixture(d, t.limit(0))
    assert none.mixed.count() == 0 == mixing.mix_report(none).count()
    odd = spark.createDataFrame([(None, "big", 0.5, 1), ("p", None, 0.5, 1), ("p", "big", -1.0, 1), ("p", "small", 0.5, 0)], t.schema)
    assert mixing.mixture(d, odd).mixed.count() == 0
    extra = d.withColumns({"tokens": F.lit(7), "topic": F.lit("x"), "plan": F.lit("q"), "copies": F.lit(9)})
    assert sorted(map(tuple, mixing.mixture(extra, t).mixed.collect())) == a


def test_topics(spark):
    from quire.llm import topics

    r = random.Random(4)
    themes = [WORDS[:5], WORDS[5:10], WORDS[10:]]
    german = {w: f"das{w[::-1]}e" for w in WORDS}
    docs = []
    for i in range(600):
        words = [r.choice(themes[i % 3]) for _ in range(60)]
        de = i % 2 == 1
        docs.append((i, "de" if de else "en", " ".join(("der die und " if de else "the of and ") + (german[w] if de else w) for w in words)))
    docs += [(900, None, None), (901, "en", ""), (902, "en", "short"), (903, "xx", "entirely other words stand in this one " * 9)]
    d = spark.createDataFrame(docs, "doc_id long, lang string, text string")
    model = topics.fit(d, mixing.encoder(), topics=6)
    got = {x.doc_id: x.topic for x in mixing.token_sizes(d, ["doc_id", "lang"], model=model).collect()}
    assert got[900] == got[901] == got[902] == "none" != got[903]
    for lang in (0, 1):  # each topic holds one theme of a language
        for name in set(got.values()):
            mine = [i % 3 for i in range(lang, 600, 2) if got[i] == name]
            assert not mine or max(map(mine.count, range(3))) > 0.95 * len(mine)
    again = topics.fit(d.repartition(7), mixing.encoder(), topics=6)
    assert np.allclose(again.centres, model.centres, atol=1e-4)
    assert len(topics.fit(d.limit(0), mixing.encoder()).centres) == 0
    assert {x.topic for x in mixing.token_sizes(d, ["doc_id", "lang"], model=topics.fit(d.limit(0), mixing.encoder())).collect()} == {"none"}


def test_topics_are_of_all_documents(spark, monkeypatch):
    from quire.llm import topics

    r = random.Random(8)
    themes = [WORDS[:5], WORDS[5:10], WORDS[10:]]
    docs = [(i, ("en", "de", None)[i % 3 if i % 50 else 2], " ".join(r.choice(themes[i % 7 % 3]) + str(r.randrange(9)) for _ in range(14))) for i in range(6_000)]
    docs = [*docs, (6_000, "en", None), (6_001, "en", "short"), docs[5], docs[5]]
    d = spark.createDataFrame(docs, "doc_id long, lang string, text string")
    model = topics.fit(d, mixing.encoder(), topics=3)
    size, encode = mixing.encoder()()
    ids = [encode(x[2]) for x in docs]
    n = np.bincount(np.concatenate([np.array(sorted(set(x)), int) for x in ids]), minlength=size)
    rarity = np.where(n > 1, np.log((len(docs) + 1) / (n + 1)), 0)
    assert np.allclose(model.rarity, rarity, atol=1e-5)
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    directions = np.random.default_rng(7).standard_normal((size, topics.WIDTH), np.float32) * rarity[:, None]
    kept = [i for i, x in enumerate(ids) if len(x) >= topics.LEAST]
    langs = np.array([docs[i][1] or "" for i in kept])
    v = np.stack([unit(directions[sorted(set(ids[i]))].sum(0)) for i in kept])
    assert len(kept) > 5_900
    for x in ("en", "de"):
        assert np.allclose(model.means[x], v[langs == x].mean(0), atol=1e-4)
    v = unit(v - np.stack([v[langs == x].mean(0) if x else v.mean(0) for x in langs]))
    near = (v @ model.centres.T).argmax(1)
    for i, c in enumerate(model.centres):  # each centre is the mean of all documents next to it
        assert np.allclose(c, unit(v[near == i].sum(0)), atol=1e-3)
    assert sorted(np.bincount(near), reverse=True) == np.bincount(near).tolist()
    sized = {(x.doc_id, x.lang, x.tokens, x.topic) for x in mixing.token_sizes(d, ["doc_id", "lang"], model=model).collect()}
    for here in (0, 10_000):  # on the executors or on the driver
        monkeypatch.setattr(topics, "HERE", here)
        again, table = topics.learn(topics.bags(d.repartition(5), mixing.encoder(), ["doc_id", "lang"]), 3)
        assert np.array_equal(again.rarity, model.rarity) and np.array_equal(again.centres, model.centres)
        assert sorted(again.means) == sorted(model.means) and all(np.array_equal(again.means[x], model.means[x]) for x in model.means)
        got = table.collect()
        assert len(got) == len(docs) and {(x.doc_id, x.lang, x.tokens, x.topic) for x in got} == sized


def test_sizes(spark):
    long = "word " * 60_000
    d = spark.createDataFrame([(1, "hello world"), (2, None), (3, ""), (4, long)], "k long, text string")
    got = {r.k: r.tokens for r in mixing.token_sizes(d, ["k"]).collect()}
    assert got[1] == 2 and got[2] == got[3] == 0 and abs(got[4] - 60_000) < 10


# -- reading level ------------------------------------------------------------
EASY = "The red dog ran home. A cat saw two fish. He took the old box. "
HARD = "The presupposed allocation mechanism of the intertemporal hedging regime circumscribes that which a procurement hypothesis attenuates in the aggregate. "


def graded():
    r = random.Random(1)
    docs, labels = [], []
    for i in range(250):
        g = i % 5 + 1
        text = "".join(HARD if r.random() < (g - 1) / 4 else EASY for _ in range(12))
        docs.append((i, text))
        labels.append((i, "a", g))
        labels.append((i, "a", g))
    return docs, [*labels, (0, "b", None), (1, "b", 9), (None, "b", 3)]


def test_levels(spark):
    docs, labels = graded()
    item = passage(5, 60)
    docs += [(900, None), (901, ""), (902, "TODO"), (903, "# Only a heading"), (904, EASY * 10 + item), (905, "日本語の文。" * 30)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, rater string, grade int")
    items = spark.createDataFrame([(item,), (None,)], "text string")
    got = {r.doc_id: r.level for r in readlevel.reading_levels(d, lab, items).collect()}
    right = sum((got[i] >= 4) == (i % 5 + 1 >= 4) for i in range(250))
    assert right > 215 and not {900, 901, 902, 903} & set(got) and got[904] <= 2 and 905 in got
    assert readlevel.reading_levels(d.limit(0), lab).count() == 0
    assert readlevel.reading_levels(d, lab.limit(0)).count() == 252


def test_items_in_blocks_mask_as_one(spark, monkeypatch):
    docs, labels = graded()
    items = [passage(50 + i, 60) for i in range(6)]
    docs += [(910 + i, EASY * 8 + x + EASY + items[(i + 1) % 6]) for i, x in enumerate(items)]
    labels += [(910 + i, "a", 1) for i in range(6)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, rater string, grade int")
    it = spark.createDataFrame([(x,) for x in items], "text string")
    want = sorted(map(tuple, readlevel.reading_levels(d, lab, it).collect()))
    monkeypatch.setattr(readlevel, "BLOCK", 2 * max(map(len, items)))
    assert len(readlevel._item_blocks(it, "text")) >= 3
    assert sorted(map(tuple, readlevel.reading_levels(d, lab, it).collect())) == want
    monkeypatch.setattr(readlevel, "BLOCK", 10)  # each item alone, however long
    assert len(readlevel._item_blocks(it, "text")) == 6


def test_gold_levels(spark):
    rows = [(1, "a", 2), (1, "a", 2), (1, "b", 3), (2, "a", 3), (2, "b", 4), (2, "c", 4), (3, "a", None), (4, "a", 0), (5, None, 5), (None, "a", 1)]
    lab = spark.createDataFrame(rows, "doc_id long, rater string, grade int")
    assert {tuple(r) for r in readlevel.gold_levels(lab).collect()} == {(2, 4), (5, 5)}


def test_held_out(spark):
    docs, labels = graded()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame([x for x in labels if x[0] is not None and x[0] < 150], "doc_id long, rater string, grade int")
    model = readlevel.fit(d, lab)
    got = {r.doc_id: r.level for r in readlevel.reading_levels(d, lab, model=model).collect()}
    assert sum((got[i] >= 4) == (i % 5 + 1 >= 4) for i in range(150, 250)) > 80
