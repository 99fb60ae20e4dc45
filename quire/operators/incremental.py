"""Processing only what is new or changed since the last successful run.

* ``IncrementalJob`` keeps a high watermark on a monotonic commit sequence and
  publishes a run's output together with its watermark.
* ``ScanHistory`` is such a job over the run history: each run takes only
  history above its watermark, up to a bound fixed when it starts, so a commit
  that lands meanwhile belongs wholly to the next run.
* ``due_documents`` states the same from the whole history at once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage


def plain_hash(c: Column) -> Column:
    """A hash without regard to letter case and outer blanks."""
    return F.lower(F.trim(c))


def commit_bound(runs: DataFrame):
    """The highest commit of the history right now: the run's upper limit."""
    return runs.agg(F.max("committed_at")).first()[0]


def committed_attempts(ledger: DataFrame, runs: DataFrame, upper=None) -> DataFrame:
    """Ledger rows of committed runs with their commit, up to ``upper``, and
    ``seq``, from when on they count.  A null path is no path.  The run table
    joins by broadcast only if Spark's own size threshold allows it."""
    done = runs.where(F.col("committed_at").isNotNull())
    if upper is not None:
        done = done.where(F.col("committed_at") <= F.lit(upper))
    recorded = [c for c in ("recorded_at",) if c in ledger.columns]
    rows = ledger.where(F.col("path").isNotNull()).select(
        "path", "run_id", "ledger_id", "status", "text_hash", "source_hash", "finished_at", *recorded
    )
    seq = F.greatest("committed_at", *recorded) if recorded else F.col("committed_at")
    return rows.join(done.select("run_id", "committed_at"), "run_id").withColumn("seq", seq).drop("run_id", *recorded)


def latest(attempts: DataFrame) -> DataFrame:
    """The latest row of each path, in the columns of ``attempts``.

    Latest is by (committed_at, finished_at), null finished_at first; among
    equal times the row of the highest ledger_id.  max_by combines on the map
    side, so a path with very many attempts is no hot key.
    """
    order = F.struct("committed_at", F.col("finished_at").isNotNull(), "finished_at", "ledger_id")
    kept = F.struct(*[c for c in attempts.columns if c != "path"])
    return attempts.groupBy("path").agg(F.max_by(kept, order).alias("last")).select("path", "last.*")


def outcomes(attempts: DataFrame) -> DataFrame:
    """path, status and hashes of the latest attempt of each path."""
    return latest(attempts).select("path", "status", "text_hash", "source_hash")


def due_documents(
    documents: DataFrame, ledger: DataFrame, runs: DataFrame, upper=None
) -> DataFrame:
    """Documents that the next run must process, with the reason, from the
    whole history up to ``upper``; ``ScanHistory`` does so by watermark.

    Result: doc_id, path, reason ('new', 'unfinished', 'text_changed' or
    'source_changed', the first that holds).  Hashes compare without regard to
    letter case and outer blanks; two nulls are equal, a null and a value
    differ.  A document with a null path has no history and is always due.
    """
    return _due(documents, outcomes(committed_attempts(ledger, runs, upper)))


def _due(documents: DataFrame, last: DataFrame) -> DataFrame:
    last = last.select(
        "path",
        F.lit(True).alias("seen_"),
        F.col("status").alias("status_"),
        plain_hash(F.col("text_hash")).alias("text_"),
        plain_hash(F.col("source_hash")).alias("source_"),
    )
    now = documents.select(
        "doc_id",
        "path",
        plain_hash(F.col("text_hash")).alias("text_now"),
        plain_hash(F.col("source_hash")).alias("source_now"),
    )
    reason = (
        F.when(F.col("seen_").isNull(), "new")
        .when(~F.col("status_").eqNullSafe("complete"), "unfinished")
        .when(~F.col("text_").eqNullSafe(F.col("text_now")), "text_changed")
        .when(~F.col("source_").eqNullSafe(F.col("source_now")), "source_changed")
    )
    return (
        now.join(last, "path", "left")
        .select("doc_id", "path", reason.alias("reason"))
        .where(F.col("reason").isNotNull())
    )


def _stored(df: DataFrame, column: str) -> dict | None:
    """The highest value of a column as a record that JSON can hold; its type
    comes with it, so that it is the same value when it is read again."""
    kind = df.schema[column].dataType.simpleString()
    top = F.max(column)
    value = F.unix_micros(top).cast("string") if kind == "timestamp" else top.cast("string")
    found = df.agg(value).first()[0]
    return None if found is None else {"type": kind, "value": found}


def _literal(mark: dict) -> Column:
    if mark["type"] == "timestamp":
        return F.timestamp_micros(F.lit(int(mark["value"])))
    return F.lit(mark["value"]).cast(mark["type"])


class IncrementalJob:
    """Exactly-once batches over a table with a monotonic commit column.

    State folder (any Hadoop file system)::

        data/<batch>/      output of a batch, written before it counts
        commits/<seq>.json one file per committed batch: watermark and the
                           batches that make up the output

    A run reads rows with ``low < commit <= high``; ``high`` is fixed at the
    start.  The output is written to a fresh folder and the batch counts from
    the moment its commit file appears, which also is what moves the
    watermark: both or neither.  A run that dies before leaves an orphan
    folder that no reader sees, and the next run takes the same rows again.
    Two runs at once meet at the same commit name, which only one of them can
    make (``storage.create_once``); the other raises and has changed nothing.

    Only the last commit is read.  Rows with a null commit wait; an empty
    source commits nothing.
    """

    def __init__(self, spark: SparkSession, folder: str, column: str):
        self.spark, self.folder, self.column = spark, folder.rstrip("/"), column

    def last(self) -> dict | None:
        """The last commit: sequence, low, high, batch, parts."""
        names = [n for n in storage.names(self.spark, f"{self.folder}/commits") if n.endswith(".json")]
        return json.loads(storage.read_text(self.spark, f"{self.folder}/commits/{names[-1]}")) if names else None

    def pending(self, source: DataFrame, low: dict | None, high: dict) -> DataFrame:
        """Rows above the watermark and up to the bound."""
        rows = source.where(F.col(self.column) <= _literal(high))
        return rows if low is None else rows.where(F.col(self.column) > _literal(low))

    def run(self, source: DataFrame, transform: Callable[[DataFrame], DataFrame] = lambda d: d) -> dict | None:
        """Processes one batch; None if nothing is new."""
        last = self.last()
        low = last and last["high"]
        new = source if low is None else source.where(F.col(self.column) > _literal(low))
        high = _stored(new, self.column)  # the bound, fixed before any row is taken
        if high is None:
            return None
        batch = self._write(transform(self.pending(source, low, high)), last)
        return self._commit(last, low, high, batch, [*(last["parts"] if last else []), batch])

    def compact(self, merge: Callable[[DataFrame], DataFrame]) -> dict | None:
        """Rewrites the output as one batch; the watermark stays."""
        last = self.last()
        if last is None:
            return None
        batch = self._write(merge(self.output()), last)
        return self._commit(last, last["low"], last["high"], batch, [batch])

    def _write(self, rows: DataFrame, last: dict | None) -> str:
        batch = f"{last['sequence'] + 1 if last else 0:012d}-{uuid.uuid4().hex}"
        rows.write.mode("errorifexists").parquet(f"{self.folder}/data/{batch}")
        return batch

    def _commit(self, last, low, high, batch: str, parts: list[str]) -> dict:
        sequence = last["sequence"] + 1 if last else 0
        record = {"sequence": sequence, "low": low, "high": high, "batch": batch, "parts": parts}
        if not storage.create_once(self.spark, f"{self.folder}/commits/{sequence:012d}.json", json.dumps(record)):
            storage.remove(self.spark, f"{self.folder}/data/{batch}")
            raise RuntimeError(f"batch {sequence} was committed by another run")
        return record

    def output(self) -> DataFrame | None:
        """The committed output: exactly the batches that the last commit names."""
        last = self.last()
        return self.spark.read.parquet(*(f"{self.folder}/data/{b}" for b in last["parts"])) if last else None


class ScanHistory:
    """Which documents are due, kept up by watermark.

    A run folds only ledger rows that have come since the one before.  The
    sequence of a row is the moment from which it counts: the later of its
    run's commit and of its own recording, so that a row recorded long after
    its run committed is not passed over.  The fold (the latest row of each
    path) is the output of an ``IncrementalJob``, committed with the watermark.
    Every ``MERGE``-th run folds the batches into one.
    """

    MERGE = 32

    def __init__(self, spark: SparkSession, folder: str):
        self.job = IncrementalJob(spark, folder, "seq")

    def run(self, ledger: DataFrame, runs: DataFrame) -> dict | None:
        """Takes what is new up to now; None if nothing is."""
        done = self.job.run(committed_attempts(ledger, runs), latest)
        if done and len(done["parts"]) >= self.MERGE:
            self.job.compact(latest)
        return done

    def due(self, documents: DataFrame) -> DataFrame:
        """Documents due by the history taken so far (see ``due_documents``)."""
        output = self.job.output()
        if output is None:
            return _due(documents, self.job.spark.createDataFrame([], OUTCOME))
        return _due(documents, outcomes(output))


OUTCOME = "path string, status string, text_hash string, source_hash string"
