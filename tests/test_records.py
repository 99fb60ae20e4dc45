"""Readers and sinks, and the parts of ledger, review and validation that have
no table of their own."""

from __future__ import annotations

import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from quire import storage
from quire.functions import rewrite as R
from quire.functions import text as X
from quire.operators import ingest, ledger, retrieval, review, validate
from quire.operators.ordering import placed
from quire.session import checkpoint_dir, spread, written
from quire.sources import files, sinks
from quire.streaming import events as streams

EVENTS = "k string, i int, ok boolean, rc int, message string, at string, size long"


def events(spark):
    rows = [
        ("a", 1, False, -1, "e1", "t1", 0), ("a", 2, True, 0, None, "t2", 9), ("a", 3, False, 4, "late", "t3", 0),
        ("b", 1, False, 4, "gone", "t1", 0), ("c", 1, False, -1, "x" * 600, "t1", 0),
        ("d", 1, False, 1, "1", "t1", 0), ("d", 2, False, 1, "2", "t2", 0), ("d", 3, False, 1, "3", "t3", 0), ("d", 4, True, 0, None, "t4", 1),
        ("e", 1, False, 1, "1", "t1", 0), ("e", 2, False, 6, "2", "t2", 0), ("f", 1, False, None, None, None, None), ("g", 1, True, 0, None, "t1", 0),
    ]
    df = spark.createDataFrame(rows, EVENTS)
    return df.withColumn("ok", ledger.succeeded(F.col("ok"), F.col("size")))


def test_ledger_rows_and_skipped(spark):
    e = events(spark)
    got = {r.k: (r.status, r.failed_attempts, r.finished_at, r.wait_seconds) for r in ledger.task_rows(e, ["k"], ["i"], "at").collect()}
    assert got == {
        "a": ("done", 1, "t2", None), "b": ("skipped", 1, "t1", None), "c": ("pending", 1, "t1", 4.0), "d": ("skipped", 3, "t3", None),
        "e": ("skipped", 2, "t2", None), "f": ("pending", 1, None, 4.0), "g": ("pending", 1, "t1", 4.0),  # an empty output is a failure
    }
    rows = {r.k: r for r in ledger.task_rows(e, ["k"], ["i"], "at", source_hash="message").collect()}
    assert rows["a"].error_message is None and len(rows["c"].error_message) == 500
    skipped = {r.k: (r.attempts, r.first_error, r.last_error, r.skipped_at) for r in ledger.skipped_rows(e, ["k"], ["i"], "at").collect()}
    assert skipped == {"b": (1, "gone", "gone", "t1"), "d": (3, "3", "3", "t3"), "e": (2, "1", "2", "t2")}
    assert ledger.task_rows(e.limit(0), ["k"], ["i"], "at").count() == 0 == ledger.skipped_rows(e.limit(0), ["k"], ["i"], "at").count()


def test_a_task_with_very_many_attempts(spark):
    many = spark.range(200_000).selectExpr("id % 2 AS k", "id AS i", "false AS ok", "1 AS rc", "cast(id AS string) AS message")
    assert ledger.final_states(many, ["k"], ["i"]).where("k = 0").first()[1:] == (3, "skipped", "0", "4")
    plan = ledger.final_states(many, ["k"], ["i"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_reset_and_import(spark):
    skipped = spark.createDataFrame([("a", 1), ("b", 1)], "book_id string, page int")
    assert [r.book_id for r in ledger.reset_skipped(skipped, spark.createDataFrame([("a",), ("a",)], "book_id string")).collect()] == ["b"]
    tasks = spark.createDataFrame([("a", 1, "done", 2, "o", "h")], "book_id string, page int, status string, attempts int, output_path string, source_hash string")
    row = ledger.reset(tasks, F.lit(True)).first()
    assert row[2:] == ("pending", 0, None, None)
    books = spark.createDataFrame([("a", "A")], "book_id string, title string")
    old = spark.createDataFrame([("A", 1, "failed", "m", "t"), ("A", 2, "failed", "m", "t"), ("A", 3, "done", None, "t"), ("Z", 1, "done", None, "t")],
                                "book_name string, page int, status string, error_message string, timestamp string")
    got = sorted(ledger.import_legacy(tasks.select("book_id", "page", "status", "attempts"), old, books).collect())
    assert [(r.page, r.status, r.attempts, r.finished_at) for r in got] == [(1, "done", 2, None), (2, "pending", 0, None), (3, "done", 0, "t")]
    n = spark.createDataFrame([("a", 3)], "book_id string, pages int")
    assert ledger.incomplete(tasks, n).first()[0] and not ledger.incomplete(tasks, n.limit(0)).first()[0]


def test_rewrite_log(spark):
    text = "甲 乙 丙,丁\n好。。好……\n这羲书　我口\n- 4 -\n"
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "k long, key string")
    log = [(r.key, r.rule, r.line, r.before, r.after) for r in review.rewrite_log(df, "k", "key").orderBy("rule", "line").collect()]
    assert log == [
        (1, "A", 1, " ", ""), (1, "A", 1, " ", ""), (1, "B", 1, ",", "，"), (1, "C", 2, "。。", "。"),
        (1, "D", 4, "- 4 -\n", ""), (1, "E", 3, "羲", "是"), (1, "E", 3, "口", "们"), (1, "G", 3, "　", " "),
    ]
    totals = {r.rule: r.edits for r in review.edit_totals(df, "key").collect()}
    assert totals == {"A": 2, "B": 1, "C": 1, "D": 1, "E": 2, "G": 1}
    assert df.where("k = 1").select(R.rewrite(F.col("key"))).first()[0] == "甲乙丙，丁\n好。好……\n这是书 我们\n"


def test_patches(spark):
    df = spark.createDataFrame([("n: 1\nm: 2",), ("n: 1\nn: 1",), (None,)], "t string")
    p = review.patch_once(F.col("t"), [(r"(?m)^(n: )\d+$", F.lit("$19")), (r"m: \d", F.lit("m: 3"))])
    assert [tuple(r.p) for r in df.select(p.alias("p")).collect()] == [("n: 9\nm: 3", []), (None, [1, 2]), (None, [])]
    notes = spark.createDataFrame([("a old b",), ("a new b",), ("old old",), ("x",)], "t string")
    assert [r[0] for r in notes.select(review.swap_note(F.col("t"), "old", "new")).collect()] == ["a new b", "a new b", None, None]


def test_places(spark):
    df = spark.range(1000).selectExpr("id", "CASE WHEN id % 7 = 0 THEN NULL ELSE (id * 37) % 100 END AS v", "0 AS place").repartition(8)
    got = {r.id: r.place for r in placed(df, ["v", "id"]).collect()}
    want = sorted(df.collect(), key=lambda r: (r.v is not None, r.v or 0, r.id))
    assert got == {r.id: n for n, r in enumerate(want, 1)}
    assert placed(df.limit(0), ["v"]).count() == 0


def test_chunks_by_running_sums():
    old = ["甲乙丙。" * 3, "x" * 3000, "短。", "丁" * 500]
    got = list(retrieval.packed("\n".join(old), 400, 480, 60))
    assert all(retrieval._tokens(x) <= 480 for x in got)
    assert any("短。" in x for x in got) and len(got) > 5
    assert list(retrieval.packed("", 400, 480, 60)) == [] == list(retrieval.packed(" \n ", 400, 480, 60))
    assert list(retrieval.packed("甲。" * 300, 400, 480, 0))[0].count("甲") == 200


def test_counted_words(spark):
    df = spark.createDataFrame([(1, ["b", "a", "b"]), (2, []), (3, None)], "k int, w array<string>").withColumn("w", F.array_sort("w"))
    got = {r.k: r.c for r in df.select("k", retrieval.counted(F.col("w")).alias("c")).collect()}
    assert [tuple(x) for x in got[1]] == [("a", 1), ("b", 2)] and got[2] == [] and not got[3]


def test_many_front_matter_keys(spark):
    text = "---\n" + "\n".join(f"k{i % 500}: v{i}" for i in range(2000)) + "\n---\n"
    m = spark.createDataFrame([(text,)], "t string").select(X.frontmatter_map(F.col("t"))).first()[0]
    assert len(m) == 500 and m["k0"] == "v1500" and m["k499"] == "v1999"


def test_path_states(spark):
    df = spark.createDataFrame([("r/层/a.md",), ("r/../层/a.md",), ("x/层/a.md",), ("r/a.md",), ("r/层/原/a.md",), ("r/层/a.txt",), (None,)], "p string")
    got = [r[0] for r in df.select(X.path_state(F.col("p"), "r", "层", "原")).collect()]
    assert got == ["ok", "outside", "outside", "not_in_layer", "original", "suffix", "outside"]


def test_broken_markdown(spark):
    docs = spark.createDataFrame([("a/x.md", "[1](y.md) [2](../../z.md) [3](no.md)"), ("a/y.md", None)], "path string, text string")
    got = {(r.target, r.code) for r in validate.broken_markdown(validate.links(docs, "path", "text"), docs).collect()}
    assert {c for _, c in got} == {"markdown_link_escape", "broken_markdown_link"} and ("a/no.md", "broken_markdown_link") in got and len(got) == 2


def test_long_files_are_not_searched_for_secrets(spark):
    df = spark.createDataFrame([("a", "x" * validate.SECRET_BYTES + " token: " + "k" * 30), ("b", "token: " + "k" * 30)], "path string, text string")
    assert [r.path for r in validate.secrets(df, "path", "text").collect()] == ["b"]


def test_many_pages_in_a_text(spark):
    df = spark.createDataFrame([(1, "".join(f"## Page {i}\n\nt\n" for i in range(1, 3001)))], "k int, text string")
    assert ingest.pages_of_markdown(df, "k").count() == 3000


# -- readers --------------------------------------------------------------------
@pytest.fixture
def folder(tmp_path):
    (tmp_path / "d/sub").mkdir(parents=True)
    for name, data in (("a.md", "one"), ("sub/b.md", "one"), ("c.md", "two"), ("README.md", "r"), ("page_001.txt", "p1"), ("page_x.txt", "px")):
        (tmp_path / "d" / name).write_text(data)
    return tmp_path / "d"


def test_hashes_and_pages(spark, folder):
    found = files.hashed_files(spark, str(folder), "*.md")
    copies = {tuple(r.paths) for r in files.hash_multimap(found).where("copies > 1").collect()}
    assert copies == {("a.md", "sub/b.md")} and found.where("path = 'c.md'").first().size == 3
    assert tuple(files.folder_size(files.file_listing(spark, str(folder))).first())[0] == 6
    assert {(r.page, r.text) for r in files.page_files(spark, str(folder), "page_").collect()} == {(1, "p1"), (None, "px")}
    assert {r.path for r in files.markdown_files(spark, str(folder)).collect()} == {"a.md", "sub/b.md", "c.md", "README.md"}
    less = files.markdown_files(spark, str(folder), excluded=files.README, layers=["sub"])
    assert {r.path for r in less.collect()} == {"a.md", "c.md"}


def test_tracked_files(folder):
    import subprocess

    (folder / ".hid").mkdir()
    (folder / ".hid/x").write_text("x")
    assert "a.md" in files.tracked_files(str(folder)) and ".hid/x" not in files.tracked_files(str(folder))
    subprocess.run(["git", "init", "-q", str(folder)], check=True)
    subprocess.run(["git", "-C", str(folder), "add", "a.md", "sub/b.md"], check=True)
    assert files.tracked_files(str(folder)) == ["a.md", "sub/b.md"]


def test_manifests(spark, tmp_path):
    for name, rows in (("x.json", [{"id": "b", "source": "s", "pages": 30}, {"id": "a", "source": "s", "enabled": False}]), ("y.json", [{"id": "c", "priority": 1, "pages": 2}])):
        (tmp_path / name).write_text(json.dumps({"books": rows}))
    m = files.manifest(spark, f"{tmp_path}/x.json", f"{tmp_path}/y.json")
    assert [r.source for r in files.known_sources(m, m).collect()] == ["s"]
    assert [(r.book_id, r.pages) for r in ingest.planned_books(m, sample=20).collect()] == [("c", 2), ("b", 20)]
    assert ingest.planned_books(m, ids=["b", "a"]).count() == 1
    (tmp_path / "t.csv").write_bytes("﻿Hash,Source\r\nA,\"x\ny\"\r\n".encode())
    assert tuple(files.text_manifest(spark, f"{tmp_path}/t.csv").first()) == ("A", "x\ny")


def test_transcript(spark, tmp_path):
    lines = [
        {"message": {"role": "user", "content": "first"}}, {"message": {"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "image"}, {"type": "text", "text": "b"}]}},
        {"role": "tool", "content": "no"}, {"role": "assistant", "content": "z" * 3000}, {"role": "user", "content": " "},
    ]
    (tmp_path / "s.jsonl").write_text("\n".join([*map(json.dumps, lines), "not json"]))
    got = {(r.role, r.content[:5], len(r.content)) for r in files.transcript(spark, f"{tmp_path}/s.jsonl").collect()}
    assert got == {("user", "a\nb", 3), ("assistant", "zzzzz", 2000)}


def test_json_readers(spark, tmp_path):
    (tmp_path / "lock.json").write_text(json.dumps({"version": 1, "files": {"a": "1", "b": "2"}}))
    assert {tuple(r) for r in files.lock_entries(spark, f"{tmp_path}/lock.json").collect()} == {("a", "1"), ("b", "2")}
    (tmp_path / "bad.json").write_text("[]")
    with pytest.raises(Exception, match="corpus_lock_invalid"):
        files.lock_entries(spark, f"{tmp_path}/bad.json").collect()
    plan = {
        "version": 1, "root": "r", "text_path": "t.md", "text_sha256": "H", "source_sha256": "S",
        "pages": [{"page": 2, "approved": True, "reviewer": "x", "reason": "y", "replacement": "new", "evidence": [{"path": "e.png", "sha256": "E"}]}, {"page": 2}],
    }
    (tmp_path / "plan.json").write_text(json.dumps(plan))
    plans, entries, evidence = files.review_plans(spark, f"{tmp_path}/plan.json")
    docs = spark.createDataFrame([("t.md", "r", "h", "s", "s", 2, [1, 2])], "path string, root string, text_hash string, source_hash string, stated_hash string, pages int, headings array<int>")
    assert review.plan_problems(plans, docs).count() == 0
    pages = spark.createDataFrame([("t.md", 2)], "path string, page int")
    shown = spark.createDataFrame([("e.png", "e")], "path string, hash string")
    got = {(r.page, r.code) for r in review.page_problems(plans, entries, evidence, shown, pages).collect()}
    assert got == {(2, "double_page"), (2, "not_approved"), (2, "no_reviewer"), (2, "no_reason")}
    other = docs.withColumn("headings", F.array(F.lit(1), F.lit(3))).withColumn("root", F.lit("q"))
    assert {r.code for r in review.plan_problems(plans, other).collect()} == {"root", "page_sequence"}
    assert {r.code for r in review.plan_problems(plans, docs.limit(0)).collect()} == {"unknown_path"}
    assert {r.code for r in review.page_problems(plans, entries.limit(0), evidence.limit(0), shown, pages).collect()} == {"no_pages"}


def test_docx(spark, tmp_path):
    ns = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    body = f'<w:document xmlns:w="{ns}"><w:body><w:p><w:r><w:t>甲</w:t></w:r><w:r><w:t>乙</w:t></w:r></w:p><w:p/><w:p><w:r><w:t>丙</w:t></w:r></w:p></w:body></w:document>'
    with zipfile.ZipFile(tmp_path / "a.docx", "w") as z:
        z.writestr("word/document.xml", body)
    (tmp_path / "b.docx").write_text("no")
    assert {tuple(r) for r in files.docx_texts(spark, str(tmp_path)).collect()} == {("a.docx", "甲乙\n丙"), ("b.docx", None)}


# -- sinks ------------------------------------------------------------------------
def test_csv_and_json_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 'x"y\nz'), ("b", None)], "k string, v string")
    sinks.write_csv(df, f"{tmp_path}/c", mark=True)
    part = next(p for p in (tmp_path / "c").iterdir() if p.suffix == ".csv")
    assert part.read_bytes().startswith("﻿k,v".encode())
    assert {tuple(r) for r in files.text_manifest(spark, f"{tmp_path}/c").collect()} == {("a", 'x"y\nz'), ("b", None)}
    sinks.write_json(df, f"{tmp_path}/j")
    assert spark.read.json(f"{tmp_path}/j").count() == 2
    assert sorted(r.json for r in sinks.as_json(df.select("k")).collect()) == ['{"k":"a"}', '{"k":"b"}']
    lock = spark.createDataFrame([("b", "2"), ("a", "1")], "path string, hash string")
    assert [r.json for r in sinks.lock_json(lock).collect()] == ['{"path":"a","hash":"1"}', '{"path":"b","hash":"2"}']
    assert json.loads(sinks.counters(df, ["k", "v"]).first()[0]) == {"k": {"a": 1, "b": 1}, "v": {'x"y\nz': 1, "none": 1}}
    assert json.loads(sinks.counters(df, ["v"], "k").first()[0])["b"] == {"v": {"none": 1}}


def test_patch_csv():
    data = "﻿Hash,status,pages\r\nA,new,1\r\nb,old,\"2,3\"\r\n".encode()
    same, counts = sinks.patch_csv(data, "Hash", {"A": {"status": "new"}})
    assert same is data and counts == {"new": 1, "old": 1}
    out, counts = sinks.patch_csv(data, "Hash", {"B": {"status": "new"}})
    assert out == data.replace(b"old", b"new") and counts == {"new": 2}
    with pytest.raises(ValueError, match="exactly one row: C"):
        sinks.patch_csv(data, "Hash", {"C": {}})
    with pytest.raises(ValueError, match="header"):
        sinks.patch_csv(b"", "Hash", {})


def test_swap_and_storage(spark, tmp_path):
    df = spark.range(3)
    assert sinks.swap_parquet(df, f"{tmp_path}/t") == 3
    with pytest.raises(ValueError):
        sinks.swap_parquet(df.limit(1), f"{tmp_path}/t", least_rows=2)
    assert spark.read.parquet(f"{tmp_path}/t").count() == 3 and sinks.swap_parquet(df.limit(1), f"{tmp_path}/t") == 1
    assert os.listdir(tmp_path) == ["t"] and not storage.exists(spark, f"{tmp_path}/none") and storage.names(spark, f"{tmp_path}/none") == []


def test_driver_side_sinks(tmp_path):
    lock = str(tmp_path / "lock")
    with sinks.work_lock(lock), pytest.raises(FileExistsError), sinks.work_lock(lock):
        pass
    with sinks.work_lock(lock):
        pass
    for n, want in ((0, "o.failed"), (1, "o.1.failed"), (2, "o.2.failed")):
        (tmp_path / "o").write_text(str(n))
        assert sinks.quarantine(str(tmp_path / "o")) == str(tmp_path / want)
    assert sinks.quarantine(str(tmp_path / "o")) is None
    target = str(tmp_path / "w")
    assert sinks.write_files({target: b"1"}, apply=False) == [target] and not os.path.exists(target)


def test_post_rows(spark, tmp_path):
    folder = str(tmp_path)

    def send(rows):
        import uuid

        with open(f"{folder}/{uuid.uuid4().hex}.json", "w") as f:
            json.dump(rows, f)

    assert sinks.post_rows(spark.range(250), send, 100) == 250
    assert sum(len(json.load(open(p))) for p in tmp_path.iterdir()) == 250
    assert sinks.post_rows(spark.range(0), send) == 0


def test_session_folders(spark, monkeypatch):
    assert written(spark.range(5), "t").count() == 5
    wide = spark.range(10, numPartitions=1)
    assert spread(wide).rdd.getNumPartitions() > 1
    from quire import session

    monkeypatch.setattr(session, "SPREAD_BYTES", 0)
    assert spread(wide).rdd.getNumPartitions() == 1
    assert checkpoint_dir(spark) == checkpoint_dir(spark)
    monkeypatch.undo()
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    once = spread(spark.range(1000).selectExpr("id % 7 AS k").distinct())  # runs nothing
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before and once.count() == 7


def test_comparisons_stream(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "a"), (2, "a", "b")], "page_key long, text_layer string, native_text string")
    df.write.parquet(f"{tmp_path}/in")
    streams.run_once(streams.comparisons(streams.stream_parquet(spark, f"{tmp_path}/in", df.schema)), f"{tmp_path}/out", f"{tmp_path}/state")
    assert {r.comparison for r in spark.read.parquet(f"{tmp_path}/out").collect()} == {"exact_after_layout_whitespace_only", "character_difference_requires_review"}
