from __future__ import annotations

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.llm import counts, repair, skeleton, splitting


# -- splitting ----------------------------------------------------------------
@settings(max_examples=120, deadline=None)
@given(st.text(alphabet="ab1_ 甲乙。，.\n#-　́", max_size=400), st.integers(5, 60), st.integers(0, 20))
def test_pieces(text, limit, overlap):
    pieces = splitting.split(text, limit, overlap)
    at = 0
    for a, b, shared in pieces:
        assert splitting.tokens(text[a:b]) <= limit and shared <= overlap
        assert not text[at:a].strip() if a > at else True
        at = max(at, b)
    assert not text[at:].strip()


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab1_ 甲。\n", max_size=60), st.data())
def test_meter_counts_slices(text, data):
    a = data.draw(st.integers(0, len(text)))
    b = data.draw(st.integers(a, len(text)))
    assert splitting.Meter(text).count(a, b) == splitting.tokens(text[a:b])


def test_cuts_lie_at_headings_first():
    text = "# A\n" + "甲乙。" * 20 + "\n# B\n" + "丙丁。" * 20
    pieces = [text[a:b] for a, b, _ in splitting.split(text, 80, 0)]
    assert [p[:3] for p in pieces] == ["# A", "# B"]


def nodes(n):
    yield n
    for c in n.children:
        yield from nodes(c)


LINES = st.sampled_from(["# A", "## B b", "### C", "- item one.", "  - item two, 甲乙丙。", "    1. deep", "|a|b|", "|甲|乙丙丁|", "", "```", "Text goes on. It ends.", "甲乙丙丁。戊己庚辛，壬癸。", "wrapped text line"])


@settings(max_examples=200, deadline=None)
@given(st.lists(LINES, max_size=30), st.integers(12, 60))
def test_pieces_follow_the_tree(lines, limit):
    text = "\n".join(lines)
    meter, tree = splitting.Meter(text), splitting.parse(text)
    every = list(nodes(tree))
    assert all(x.start <= y.start and y.end <= x.end for x in every for y in x.children)
    assert all(y.end <= z.start for x in every for y, z in zip(x.children, x.children[1:], strict=False))
    pieces = splitting.pack(meter, tree, limit)
    assert all(meter.count(a, b) <= limit for a, b in pieces)
    assert all(x[1] <= y[0] for x, y in zip(pieces, pieces[1:], strict=False))
    for n in every:
        if meter.count(n.start, n.end) > limit:  # an opened node: no piece goes over its edge
            for a, b in pieces:
                if a < n.end and b > n.start:
                    before = text[a : n.start].strip().splitlines() if a < n.start else []
                    assert b <= n.end and all(x.startswith("#") for x in before if x)
    for n in every:  # a heading stays with the text that it heads
        if n.kind == "section" and len(n.children) > 1 and n.children[0].kind == "heading" and n.children[1].kind != "section":
            if meter.count(n.start, n.children[0].end) <= limit // 2:
                assert any(a <= n.start and b > n.children[0].end for a, b in pieces)


def test_headings_lists_and_tables_keep_together():
    text = "# One\n\n" + "甲乙丙丁。" * 30 + "\n\n## Two\n- a b\n  - c d\n- e f\n\n| x | y |\n| 1 | 2 |\n\n## Three\nshort end.\n"
    pieces = [text[a:b] for a, b, _ in splitting.split(text, 60, 0)]
    assert pieces[0].startswith("# One\n\n甲乙") and not any(p.strip() in ("# One", "## Two", "## Three") for p in pieces)
    assert any(p.startswith("## Two") and p.endswith("| 1 | 2 |") for p in pieces) or pieces[-1].startswith("## Two")


def test_split_items(spark):
    rows = [(1, "甲" * 1000, "s", 3), (2, "short", None, None), (3, None, "s", 1), (4, " ", "s", 1), (1, "甲" * 1000, "s", 3)]
    df = spark.createDataFrame(rows, "k long, content_text string, section string, page int")
    got = splitting.split_items(df, "k", "content_text", ("section", "page")).collect()
    assert {r.k for r in got} == {1, 2} and all(r.token_count == splitting.tokens(r.content) <= 480 for r in got)
    assert {(r.section, r.page) for r in got if r.k == 1} == {("s", 3)}
    clash = splitting.split_items(df.withColumnRenamed("section", "content"), "k", "content_text", ("content", "page")).where("k = 2").first()
    assert clash.content == "short" and clash.content_of_item is None and clash.page is None
    same = splitting.split_items(df.select("k", F.col("content_text").alias("content")), "k", "content").where("k = 2").first()
    assert same.content == "short" and same.pieces == 1
    assert splitting.split_items(df.limit(0), "k", "content_text").count() == 0


def test_tokens_column(spark):
    texts = ["abcde f_1 甲乙，　x y", "", None, " "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(splitting.tokens_column(df.t)).collect()]
    assert got == [splitting.tokens(t) if t is not None else None for t in texts]


# -- look-alikes --------------------------------------------------------------
@pytest.mark.parametrize(
    ("a", "b"),
    [("Ａｂ１，", "Ab1,"), ("é", "é"), ("a​b­", "ab"), ("a b　", "a b "), ("рауе", "paye"), ("内⽣", "内生"), ("不", "不"), ("ﬁ", "fi"), ("が", "が"), ("ｶﾞ", "ガ"), ("a\r\nb", "a\nb"), ("Οο", "Oo")],
)
def test_look_alike(a, b):
    assert skeleton.skeleton(a) == skeleton.skeleton(b)


@pytest.mark.parametrize(("a", "b"), [("é", "e"), ("3", "³"), ("①", "1"), ("A", "a"), ("国", "國"), ("a b", "ab"), ("a\nb", "a b"), ("a  b", "a b")])
def test_visibly_different(a, b):
    assert skeleton.skeleton(a) != skeleton.skeleton(b)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=30))
def test_skeleton_is_a_fixed_point(text):
    once = skeleton.skeleton(text)
    assert skeleton.skeleton(once) == once


def test_pairs_against_brute_force(spark):
    rows = [(1, "ab"), (2, "ａb"), (3, "ab"), (4, "а​b"), (5, "AB"), (6, None), (7, None), (8, ""), (9, "​"), (10, "x"), (10, "ｘ")]
    df = spark.createDataFrame(rows, "k long, t string")
    want = {
        (a, b) for a, x in rows for b, y in rows
        if a < b and x is not None and y is not None and x != y and skeleton.skeleton(x) == skeleton.skeleton(y)
    }
    got = [(r.key_a, r.key_b) for r in skeleton.look_alike_pairs(df, "k", "t", "f").collect()]
    assert set(got) == want and len(got) == len(want)
    classes = {(r.key, r.class_id) for r in skeleton.look_alike_classes(df, "k", "t", "f").collect()}
    assert {(1, 1), (2, 1), (3, 1), (4, 1), (8, 8), (9, 8)} <= classes
    assert skeleton.look_alike_pairs(df.limit(0), "k", "t", "f").count() == 0
    assert skeleton.with_skeleton(df.withColumnRenamed("k", "skeleton"), "t").columns == ["t", "skeleton"]


def test_many_copies_meet_only_other_texts(spark):
    copies = spark.range(50_000).selectExpr("id AS k", "'a placeholder' AS t")
    df = copies.unionByName(spark.createDataFrame([(-1, "ａ placeholder"), (-2, "a\u200b placeholder")], "k long, t string"))
    rows = skeleton.hashed(df, "k", "t", "f")
    assert skeleton.pairs_of(rows).count() == 2 * 50_000 + 1
    assert skeleton.pairs_of(rows, hot=1000).distinct().count() == 2 * 50_000 + 1
    assert skeleton.classes_of(rows).where("class_id = -2 AND members = 50002").count() == 50_002


# -- page repair --------------------------------------------------------------
def pages(spark):
    body = [
        "The procurement schema keeps the long-run inference of the old procurement market and the half-full jars",
        "在统计上先于制度约束下的历史识别前提，不完全契约下的契约定价过程",
    ]
    rows = []
    for n in range(1, 31):
        text = f"Book of Tests · {n}\n{body[0]}.\n{body[1]}。\n- {n} -"
        if n == 5:
            text = "Book of Tests · 5\nThe procure-\nment schema keeps the half-\nfull jars in the long-run.\n在 统 计 上先于制度约束干的历史\n~ ‖ .\n5"
        if n == 6:
            text = "B0ok of Tests · 6\nThe procurcment schema\nand the infe�ence.\n在统计上失于制度约束下的"
        rows.append((n, "b1", n, text, None if n % 2 else text))
    rows += [(100, None, None, None, None), (101, "b2", 1, "", " \n"), (102, "b1", 7, "[本页未提取到文本，可能需要 OCR。]", None)]
    return spark.createDataFrame(rows, "page_key long, book_id string, page int, text_layer string, native_text string")


def test_faults(spark):
    got = {(r.page_key, r.line_no, r.kind) for r in repair.line_faults(pages(spark)).where("field = 'text_layer'").collect()}
    assert {(1, 1, "furniture"), (1, 4, "furniture"), (6, 1, "furniture"), (5, 1, "furniture"), (5, 6, "furniture"), (5, 7, "furniture")} <= got
    assert {(5, 2, "broken_word"), (5, 5, "spaced_letters"), (6, 2, "misread"), (6, 3, "misread"), (6, 4, "misread")} <= got
    assert (5, 3, "broken_word") not in got
    assert not {k for k, *_ in got} & {100, 101, 102}
    assert not {x for x in got if x[0] == 1 and x[1] in (2, 3)}


def test_long_running_lines_are_furniture(spark):
    header = "The Collected Notes on Procurement and Allocation of the Upper River Markets in the Years of the Copper Lantern and After It"
    rows = [(n, "b1", n, f"{header} {n}\nText of page {'x' * n} goes on here.\nIt ends here.", None) for n in range(1, 13)]
    rows.append((90, "b2", 1, f"Text begins here and then it goes on for longer than anything else that stands upon this page of the book, to its end, {'x' * 110}.\na\nb\n{header}\nc\nd\nIt ends.", None))
    df = spark.createDataFrame(rows, "page_key long, book_id string, page int, text_layer string, native_text string")
    got = {(r.page_key, r.line_no) for r in repair.line_faults(df).where("kind = 'furniture'").collect()}
    assert got >= {(n, 1) for n in range(1, 13)} | {(90, 4)} and not {(n, 2) for n in range(1, 13)} & got


def test_counts_are_exact_in_a_large_vocabulary(spark):
    heads, tails = ["market", "garden", "copper", "window", "harbour", "timber"], ["bridge", "village", "lantern", "candle"]
    common = " ".join(heads + tails) + ".\n"
    rows = [(n, "b1", n, common + " ".join(str(7_000_000 + 2000 * n + i) for i in range(2000)) + ".", None) for n in range(500)]
    cuts = [f"The {a}-\n{b} stands." for a in heads for b in tails]  # two common words each, never seen as one
    rows.append((900, "b1", 900, "\n".join(cuts), None))
    df = spark.createDataFrame(rows, "page_key long, book_id string, page int, text_layer string, native_text string")
    assert repair.line_faults(df).where("page_key = 900 AND kind = 'broken_word'").count() == 0


def test_ten_deliveries_are_decided_as_one(spark):
    one = pages(spark).unionByName(spark.createDataFrame([(40, "b1", 40, "The market stands and the inter-", None)], pages(spark).schema))
    ten = one.crossJoin(spark.range(10)).withColumn("page_key", F.col("page_key") + 1000 * F.col("id")).drop("id")
    want = {tuple(r) for r in repair.line_faults(one).collect()}
    got = {tuple(r) for r in repair.line_faults(ten).collect()}
    assert (40, "text_layer", 1, "broken_word") in want
    assert got == {(k + 1000 * n, *rest) for k, *rest in want for n in range(10)}


@pytest.mark.parametrize("times", [1, 10, 100])
def test_bounds_follow_the_corpus(times):
    seen = {"that": 11349, "tliat": 37, "inter": 3, "inter-": 3, "long": 400, "long-": 2, "边旳灯": 1, "边的灯": 3, "边旳": 1, "边的": 40, "旳灯~": 1, "的灯~": 30}
    digests = np.array([xxhash.xxh3_64_intdigest(k) for k in seen], np.uint64)
    order = np.argsort(digests)
    words = counts.Words(digests[order], np.array(list(seen.values()))[order] * times)
    reader = repair.Reader(repair.Corpus(words, counts.Lines(set(), set())))
    assert reader.undo("tliat") == "that" and reader.undo("that") == ""
    assert reader.context("边", "旳", "灯") == "的"
    assert reader.cut("inter", "") and not reader.cut("long", "")


def test_repaired(spark):
    got = {r.page_key: r.text_layer for r in repair.repaired_pages(pages(spark)).collect()}
    assert got[5].startswith("The procurement schema keeps the half-full jars in the long-run.")
    assert "‖" not in got[5] and "在统计上先于" in got[5] and got[100] is None and got[101] == ""
    empty = pages(spark).limit(0)
    assert repair.line_faults(empty).count() == 0 and repair.repaired_pages(empty).count() == 0
