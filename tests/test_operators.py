from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from quire.functions import rewrite as R
from quire.functions import text as X
from quire.operators import compare, ingest, ledger, retrieval, validate
from quire.sources import files, sinks
from quire.streaming import events as streams


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(f(F.col("c"))).first()[0]


@pytest.mark.parametrize(
    ("a", "b", "expected"),
    [
        ("甲\n乙", "甲 乙", "exact_after_layout_whitespace_only"),
        ("甲，", "甲,", "character_difference_requires_review"),
        ("[本页未提取到文本，可能需要 OCR。]", "", "both_empty_requires_visual_or_ocr"),
        ("", "abc", "text_missing_native_available"),
        ("abc", None, "source_image_requires_visual"),
        (None, None, "both_empty_requires_visual_or_ocr"),
    ],
)
def test_compare(spark, a, b, expected):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(X.compare_texts(F.col("a"), F.col("b"))).first()[0] == expected


def test_clean_scan_keeps_one_blank_line(spark):
    df = spark.createDataFrame([("正文第一行  \n印记\n\n\n正文第二行\n", "印记"), (None, "x"), ("", None)], "t string, w string")
    got = [r[0] for r in df.select(X.clean_scan(F.col("t"), F.col("w"))).collect()]
    assert got == ["正文第一行\n\n正文第二行", None, ""]


def test_hybrid(spark):
    assert one(spark, "字" * 80, lambda c: X.hybrid(c, F.lit("扫" * 200))) == "字" * 80
    assert one(spark, "字" * 3, lambda c: X.hybrid(c, F.lit("扫" * 80))) == "扫" * 80
    assert one(spark, None, lambda c: X.hybrid(c, F.lit(None).cast("string"))) == ""


def test_rules(spark):
    assert one(spark, "甲 乙 丙", R.rule_a) == "甲乙丙"
    assert one(spark, "甲 乙 丙", R.count_inner_spaces) == 1
    assert one(spark, "甲,乙. a.b (甲)", R.rule_b) == "甲，乙。 a.b （甲）"
    assert one(spark, "好。。好，，，", R.rule_c) == "好。好，"
    assert one(spark, "甲‖…o 乙\n第 3 页\n- 4 -\n5/9\n丙", R.rule_d) == "甲乙\n\n\n\n丙"
    assert one(spark, "这羲书 我口 目己 还翻要", R.rule_e) == "这是书 我们 自己 还需要"
    assert one(spark, "白羲书 牛口", R.rule_e) == "白羲书 牛口"
    assert one(spark, None, R.rewrite) is None


def test_frontmatter_last_key_counts(spark):
    m = one(spark, "---\na: 1\na: '2'\n b: 3\n---\ntext", X.frontmatter_map)
    assert m == {"a": "2"}
    assert one(spark, "no front", X.frontmatter_map) == {}


def test_links(spark):
    assert one(spark, "[[a/b.md|x]] [[c#d]]\n```\n[[e]]\n```\n[[%41+b]] [[ ]]", X.wiki_targets) == ["a/b", "c", "A+b"]
    assert one(spark, "[x](../n.md) [y](http://e.org/a.md) [z](b.txt)", X.markdown_targets) == ["../n.md"]
    df = spark.createDataFrame([("a/b", "../c.md"), ("a", "../../c.md"), ("", "./d.md")], "f string, t string")
    assert [r[0] for r in df.select(X.normal_path(F.col("f"), F.col("t"))).collect()] == ["a/c.md", None, "d.md"]


def test_similarity(spark):
    df = spark.createDataFrame(
        [(1, "甲乙丙丁", "甲乙丙丁"), (2, "甲乙丙丁", "甲乙丙戊"), (3, "", "x"), (4, None, None), (5, "ab", "abc")], "k int, a string, b string"
    )
    got = {r.k: r.score for r in compare.similarity(df, "a", "b", ["k"]).collect()}
    assert got == {1: 1.0, 2: 0.5, 3: 0.0, 4: 1.0, 5: 0.0}


def test_chunks_keep_to_the_limit_and_pages_apart(spark):
    text = "---\ntitle: x\n---\n# T\n\n## Page 1\n\n" + "价格终究会回来的。" * 200 + "\n\n## Page 2\n\nshort\n"
    df = spark.createDataFrame([("a/b.md", text), ("c.md", None), ("d.md", "  "), ("e.md", "x" * 9000)], "path string, text string")
    got = retrieval.chunk_markdown(df).collect()
    assert {r.path for r in got} == {"a/b.md", "e.md"}
    assert all(r.token_count <= 480 for r in got)
    first = [r for r in got if r.path == "a/b.md"]
    assert {r.page for r in first} == {1, 2} and [r.ordinal for r in first] == list(range(1, len(first) + 1))
    assert len({r.chunk_id for r in got}) == len(got) and not any("title:" in r.content for r in got)


def test_tier_beats_score(spark):
    rows = [(1, "a", "t", "s", "剩余价值", "article", 1), (2, "b", "t", "s", "剩余价值" * 20, "topic", 1), (3, "c", None, None, None, None, None)]
    chunks = spark.createDataFrame(rows, "chunk_key int, path string, title string, section string, content string, source_kind string, ordinal int")
    s = retrieval.bm25(retrieval.postings(chunks), retrieval.statistics_of(chunks), retrieval.query_terms(spark, "剩余价值"))
    assert [r.chunk_key for r in retrieval.top_k(chunks, s, 5).orderBy("rank").collect()] == [1, 2]
    empty = retrieval.bm25(retrieval.postings(chunks), retrieval.statistics_of(chunks), retrieval.query_terms(spark, "的"))
    assert empty.count() == 0
    with pytest.raises(ValueError):
        retrieval.top_k(chunks, s, 0)


def test_index_is_rebuilt_and_swapped(spark, tmp_path):
    cols = "chunk_key int, title string, section string, content string"
    retrieval.write_index(spark.createDataFrame([(1, "t", "s", "alpha"), (2, "t", "s", "beta")], cols), f"{tmp_path}/i")
    retrieval.write_index(spark.createDataFrame([(2, "t", "s", "beta")], cols), f"{tmp_path}/i")
    assert {r.term for r in spark.read.parquet(f"{tmp_path}/i/postings").collect()} == {"t", "s", "beta"}
    assert spark.read.parquet(f"{tmp_path}/i/statistics").first().chunks == 1


def test_ledger(spark):
    ev = spark.createDataFrame(
        [("a", 1, False, -1, "e1"), ("a", 2, True, 0, None), ("a", 3, False, 4, "late"), ("b", 1, False, 4, "gone"), ("c", 1, False, -1, "x"),
         ("d", 1, False, 1, "1"), ("d", 2, False, 1, "2"), ("d", 3, False, 1, "3"), ("d", 4, True, 0, None)],
        "k string, i int, ok boolean, rc int, message string",
    )
    got = {r.k: (r.status, r.attempts, r.first_error, r.last_error) for r in ledger.final_states(ev, ["k"], ["i"]).collect()}
    assert got == {"a": ("done", 2, "e1", "e1"), "b": ("skipped", 1, "gone", "gone"), "c": ("pending", 1, "x", "x"), "d": ("skipped", 3, "1", "3")}
    books = spark.createDataFrame([("a", 3), ("z", 0), ("n", None)], "book_id string, pages int")
    have = spark.createDataFrame([("a", 2)], "book_id string, page int")
    assert sorted((r.book_id, r.page) for r in ledger.expand_tasks(books, have).collect()) == [("a", 1), ("a", 3)]
    assert {r.book_id for r in ledger.empty_books(books).collect()} == {"z", "n"}


def test_pages_and_selection(spark):
    df = spark.createDataFrame([("1,3-5", 8), ("0-2", 8), ("2,2,1", 8), ("5-3", 8), ("x", 8), ("7-9", 8)], "s string, n int")
    assert [r[0] for r in df.select(ingest.page_selection(F.col("s"), F.col("n"))).collect()] == [[1, 3, 4, 5], None, [1, 2], None, None, None]
    gaps = ingest.page_gaps(spark.createDataFrame([("a", 1), ("a", 3), ("a", 3), ("b", None)], "p string, page int"), "p").collect()
    assert [(r.p, r.missing, r.repeated) for r in gaps] == [("a", [2], 1)]


def test_wiki_resolution(spark):
    names = spark.createDataFrame([("a/X.md", "X"), ("b/y.md", "Y"), ("c/y.md", "Y"), ("d/z.md", None)], "path string, name string")
    links = spark.createDataFrame([("a/q.md", t) for t in ("a/X", "x", "Y", "none", "b/Y", "z")], "path string, target string")
    got = {r.target: (r.state, r.to_path) for r in validate.resolve_wiki(links, names).collect()}
    assert got == {"a/X": ("ok", "a/X.md"), "x": ("case", "a/X.md"), "Y": ("ambiguous", None), "none": ("broken", None), "b/Y": ("case", "b/y.md"), "z": ("broken", None)}


def test_secret_is_not_shown(spark):
    df = spark.createDataFrame([("a", "token: " + "k" * 24), ("b/.env", ""), ("c", None)], "path string, text string")
    out = validate.secrets(df, "path", "text")
    assert out.columns == ["path", "code"] and {tuple(r) for r in out.collect()} == {("a", "secret_pattern"), ("b/.env", "sensitive_file_tracked")}


def test_files_and_sinks(spark, tmp_path):
    (tmp_path / "d/.hidden").mkdir(parents=True)
    (tmp_path / "d/art").mkdir()
    (tmp_path / "d/art/一 a+b.md").write_text("text")
    (tmp_path / "d/art/AGENT.md").write_text("no")
    (tmp_path / "d/.hidden/h.md").write_text("no")
    root = f"{tmp_path}/d"
    assert [(r.path, r.source_kind) for r in files.markdown_files(spark, root, {"art": ("article", "high")}).collect()] == [("art/一 a+b.md", "article")]
    assert {"art/AGENT.md", "art/一 a+b.md"} <= {r.path for r in files.file_listing(spark, root).collect()}
    assert files.file_listing(spark, root, ["art"]).where("path LIKE 'art/%'").count() == 0
    (tmp_path / "m.json").write_text(json.dumps({"books": [{"id": "b", "source": "s", "pages": 3}]}))
    row = files.manifest(spark, f"{tmp_path}/m.json").first()
    assert (row.mode, row.enabled, row.pages) == ("redo", True, 3)
    target = tmp_path / "out.txt"
    assert sinks.write_files({str(target): b"1"}) == [str(target)] and sinks.write_files({str(target): b"1"}) == []
    with pytest.raises(OSError):
        sinks.write_files({str(target): b"2", f"{tmp_path}/none/x": b"3"})
    assert target.read_bytes() == b"1"


def test_stream_equals_batch(spark, tmp_path):
    rows = [(1, "2025-01-01 00:00:00", "a", 1.0), (2, "2025-01-03 00:00:00", "a", 2.0), (3, "2025-01-09 00:00:00", "b", 2.0)]
    df = spark.createDataFrame(rows, "event_id int, ts string, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    df.write.parquet(f"{tmp_path}/in")
    stream = streams.windowed_counts(streams.stream_parquet(spark, f"{tmp_path}/in", df.schema))
    streams.run_once(stream, f"{tmp_path}/out", f"{tmp_path}/state")
    streams.run_once(stream, f"{tmp_path}/out", f"{tmp_path}/state")
    got = spark.read.parquet(f"{tmp_path}/out").count()
    assert 2 <= got <= streams.windowed_counts(df).count() == 3


def test_bm25_takes_all_terms(spark):
    from quire.operators import retrieval

    index = spark.range(10_050).selectExpr("id AS chunk_key", "concat('t', id) AS term", "1L AS tf", "1 AS length")
    statistics = spark.sql("SELECT 10050L AS chunks, 1.0D AS average")
    assert retrieval.bm25(index, statistics, index.select("term")).count() == 10_050
