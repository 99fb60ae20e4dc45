"""Named queries of the general (core) training-data operator."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..operators.incremental import ScanHistory
from ..session import checkpoint_dir, table


def _due(spark: SparkSession, sf: str) -> DataFrame:
    """The documents due now, by a history that begins here: its first run
    takes all commits up to the bound, in a folder of its own."""
    documents, ledger, runs = (table(spark, sf, t) for t in ("documents", "scan_ledger", "scan_runs"))
    history = ScanHistory(spark, f"{checkpoint_dir(spark)}/quire-history-{uuid.uuid4().hex}")
    history.run(ledger, runs)
    return history.due(documents)


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return _due(spark, sf).select("doc_id")


def p2_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return _due(spark, sf).select("doc_id", "reason")


QUERIES = {"p2_found": p2_found, "p2_reasons": p2_reasons}

_DUE = """
    WITH last AS (
      SELECT path, l.status, lower(trim(text_hash)) AS th, lower(trim(source_hash)) AS sh
      FROM scan_ledger l JOIN scan_runs r USING (run_id)
      WHERE r.committed_at IS NOT NULL AND path IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY path ORDER BY r.committed_at DESC,
        l.finished_at DESC NULLS LAST, ledger_id DESC) = 1),
    due AS (
      SELECT d.doc_id, CASE WHEN last.path IS NULL THEN 'new'
        WHEN last.status IS DISTINCT FROM 'complete' THEN 'unfinished'
        WHEN th IS DISTINCT FROM lower(trim(d.text_hash)) THEN 'text_changed'
        WHEN sh IS DISTINCT FROM lower(trim(d.source_hash)) THEN 'source_changed' END AS reason
      FROM documents d LEFT JOIN last ON d.path = last.path)
"""
SQL = {
    "p2_found": _DUE + "SELECT doc_id FROM due WHERE reason IS NOT NULL",
    "p2_reasons": _DUE + "SELECT doc_id, reason FROM due WHERE reason IS NOT NULL",
}
