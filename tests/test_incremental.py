from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quire import storage
from quire.operators.incremental import IncrementalJob, ScanHistory, commit_bound, due_documents

T = lambda d: dt.datetime(2025, 1, d)
LEDGER = "ledger_id long, run_id long, path string, status string, text_hash string, source_hash string, finished_at timestamp, extra string"
RUNS = "run_id long, committed_at timestamp"
DOCS = "doc_id long, path string, text_hash string, source_hash string, status string"


def due(spark, ledger, runs, docs, upper=None):
    return {
        r.doc_id: r.reason
        for r in due_documents(
            spark.createDataFrame(docs, DOCS), spark.createDataFrame(ledger, LEDGER), spark.createDataFrame(runs, RUNS), upper
        ).collect()
    }


def test_reasons(spark):
    runs = [(1, T(1)), (2, None), (3, T(3))]
    ledger = [
        (1, 1, "same", "complete", " AB ", None, T(1), "x"),
        (2, 1, "text", "complete", "old", "s", T(1), "x"),
        (3, 2, "text", "complete", "new", "s", T(2), "x"),  # its run never committed
        (4, 1, "source", "complete", "t", None, T(1), "x"),
        (5, 3, "broken", "error", "t", "s", T(3), "x"),
        (6, 1, "broken", "complete", "t", "s", T(1), "x"),
        (7, 1, None, "complete", "t", "s", T(1), "x"),
        (8, 1, "open", None, "t", "s", None, "x"),
    ]
    docs = [
        (1, "same", "ab", None, None), (2, "text", "new", "s", None), (3, "source", "t", "s", None),
        (4, "broken", "t", "s", None), (5, "never", "t", "s", None), (6, None, "t", "s", None), (7, "open", "t", "s", None),
    ]
    assert due(spark, ledger, runs, docs) == {
        2: "text_changed", 3: "source_changed", 4: "unfinished", 5: "new", 6: "new", 7: "unfinished",
    }


def test_latest_by_commit_then_finish_then_id(spark):
    runs = [(1, T(5)), (2, T(4))]
    ledger = [
        (1, 2, "a", "error", "t", "s", T(9), "x"),
        (2, 1, "a", "complete", "t", "s", None, "x"),
        (3, 1, "a", "complete", "t", "s", T(1), "x"),
        (4, 1, "a", "complete", "u", "s", T(1), "x"),
    ]
    assert due(spark, ledger, runs, [(1, "a", "u", "s", None)]) == {}


def test_bound_is_fixed_at_the_start(spark):
    runs = [(1, T(1)), (2, T(2))]
    ledger = [(1, 1, "a", "error", "t", "s", T(1), "x"), (2, 2, "a", "complete", "t", "s", T(2), "x")]
    docs = [(1, "a", "t", "s", None)]
    assert due(spark, ledger, runs, docs) == {}
    assert due(spark, ledger, runs, docs, T(1)) == {1: "unfinished"}
    assert commit_bound(spark.createDataFrame(runs, RUNS)) == T(2)


def test_empty_tables(spark):
    assert due(spark, [], [], []) == {}
    assert due(spark, [], [], [(1, "a", None, None, None)]) == {1: "new"}
    assert commit_bound(spark.createDataFrame([], RUNS)) is None


def source(spark, rows):
    return spark.createDataFrame(rows, "id long, seq long")


def crash(*_):
    raise OSError("killed")


def test_job_neither_skips_nor_repeats(spark, tmp_path, monkeypatch):
    job = IncrementalJob(spark, f"file://{tmp_path}/job", "seq")
    rows = [(1, 1), (2, 1), (3, 2), (4, None)]
    assert job.output() is None and job.last() is None
    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(storage, "create_once", crash)  # the output is written, the commit is not
        job.run(source(spark, rows))
    assert job.last() is None and job.output() is None
    assert job.run(source(spark, rows))["high"] == {"type": "bigint", "value": "2"}
    assert job.run(source(spark, rows)) is None and job.run(source(spark, rows[:2])) is None
    rows += [(5, 3), (6, 4)]
    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(storage, "create_once", crash)
        job.run(source(spark, rows))
    assert job.run(source(spark, rows))["low"]["value"] == "2"
    assert sorted(r.id for r in job.output().collect()) == [1, 2, 3, 5, 6]
    job.compact(lambda d: d)
    assert len(job.last()["parts"]) == 1 and job.run(source(spark, rows)) is None
    assert sorted(r.id for r in job.output().collect()) == [1, 2, 3, 5, 6]


def test_job_refuses_a_second_commit_of_one_batch(spark, tmp_path):
    a = IncrementalJob(spark, f"file://{tmp_path}/job", "seq")
    b = IncrementalJob(spark, f"file://{tmp_path}/job", "seq")

    def overtaken(d):
        b.run(source(spark, [(1, 1)]))
        return d

    with pytest.raises(RuntimeError):
        a.run(source(spark, [(1, 1)]), overtaken)
    assert a.output().count() == 1


def test_a_file_is_created_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    path = f"file://{tmp_path}/c/one.json"
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda i: storage.create_once(spark, path, str(i)), range(16)))
    assert made.count(True) == 1
    assert storage.read_text(spark, path) == str(made.index(True)) and storage.names(spark, f"file://{tmp_path}/c") == ["one.json"]


def test_a_rename_never_overwrites(spark, tmp_path):
    for n in (1, 2):
        storage.write_text(spark, f"file://{tmp_path}/s{n}", str(n))
    storage._rename_once(spark, f"file://{tmp_path}/s1", f"file://{tmp_path}/t")
    with pytest.raises(Exception, match="(?i)exist"):
        storage._rename_once(spark, f"file://{tmp_path}/s2", f"file://{tmp_path}/t")
    assert storage.read_text(spark, f"file://{tmp_path}/t") == "1"


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "decimal(20,3)", "string", "double"])
def test_watermarks_of_any_type(spark, tmp_path, kind):
    values = {"double": ["1.5", "2.25"], "decimal(20,3)": ["1.500", "2.250"]}.get(kind, ["2024-02-28 23:59:59.123456", "2024-02-29 00:00:00.000001"])
    rows = spark.createDataFrame([(1, values[0]), (2, values[1])], "id long, s string").withColumn("seq", F.col("s").cast(kind))
    job = IncrementalJob(spark, f"file://{tmp_path}/{kind}", "seq")
    job.run(rows.where("id = 1"))
    assert IncrementalJob(spark, job.folder, "seq").run(rows)["sequence"] == 1
    assert sorted(r.id for r in job.output().collect()) == [1, 2] and job.run(rows) is None


def test_history_by_watermark_equals_the_whole_history(spark, tmp_path):
    ledger_cols = LEDGER + ", recorded_at timestamp"
    runs = [(1, T(1)), (2, T(3)), (3, None), (4, T(5))]
    ledger = [
        (1, 1, "a", "error", "t", "s", T(1), "x", T(1)),
        (2, 2, "a", "complete", "t", "s", T(2), "x", T(2)),
        (3, 1, "b", "complete", "t", "s", T(1), "x", T(4)),  # recorded after a later run committed
        (4, 3, "b", "error", "t", "s", T(4), "x", T(4)),
        (5, 4, "c", "complete", "u", "s", T(4), "x", None),
        (6, 1, "c", "error", "t", "s", T(9), "x", T(9)),  # late, but of an older commit
    ]
    docs = spark.createDataFrame([(1, "a", "t", "s", None), (2, "b", "t", "s", None), (3, "c", "t", "s", None), (4, "d", "t", "s", None)], DOCS)
    history = ScanHistory(spark, f"file://{tmp_path}/h")
    history.MERGE = 3
    assert {r.reason for r in history.due(docs).collect()} == {"new"}
    for day in (1, 3, 4, 5, 9, 9):
        now = [x for x in ledger if (x[8] or T(5)) <= T(day)]
        r = spark.createDataFrame([x for x in runs if x[1] and x[1] <= T(day)], RUNS)
        led = spark.createDataFrame(now, ledger_cols)
        history.run(led, r)
        want = {(x.doc_id, x.reason) for x in due_documents(docs, led, r).collect()}
        assert {(x.doc_id, x.reason) for x in history.due(docs).collect()} == want
    assert len(history.job.last()["parts"]) < 5 and history.run(led, r) is None
    assert history.due(docs.limit(0)).count() == 0
