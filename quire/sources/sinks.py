"""Sinks: CSV, JSON, lock files and atomic sets of small files."""

from __future__ import annotations

import csv
import io
import itertools
import os
import tempfile
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import storage


BOM = "\ufeff"


def write_csv(df: DataFrame, folder: str, mark: bool = False) -> None:
    """CSV with a header; large results keep their partitions.  With ``mark``
    each file begins with a byte-order mark, as spreadsheets want it."""
    if mark:
        df = df.withColumnRenamed(df.columns[0], BOM + df.columns[0])
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("encoding", "UTF-8").csv(folder)


def patch_csv(data: bytes, key: str, updates: dict[str, dict[str, str]]) -> tuple[bytes, dict[str, int]]:
    """A small CSV table with cells of some rows replaced, and the number of
    rows of each status.  updates: upper-case key -> column -> value; each key
    must be that of exactly one row.  Byte-order mark and line ends stay; where
    nothing changes the very bytes come back."""
    newline = "\r\n" if b"\r\n" in data else "\n"
    text = data.decode("utf-8-sig")
    table = csv.DictReader(io.StringIO(text, newline=""))
    rows = list(table)
    if not table.fieldnames:
        raise ValueError("the table has no header")
    found = Counter((r.get(key) or "").upper() for r in rows)
    if wrong := sorted(k for k in updates if found[k] != 1):
        raise ValueError(f"not exactly one row: {', '.join(wrong)}")
    new = [r | updates.get((r.get(key) or "").upper(), {}) for r in rows]
    statuses = Counter(r.get("status", "") for r in new)
    if new == rows:
        return data, statuses
    out = io.StringIO(newline="")
    writer = csv.DictWriter(out, table.fieldnames, lineterminator=newline)
    writer.writeheader()
    writer.writerows(new)
    return (BOM if data.startswith(BOM.encode()) else "").encode() + out.getvalue().encode(), statuses


def counters(df: DataFrame, columns: list[str], within: str | None = None) -> DataFrame:
    """One row of JSON: for each column how many rows each value has; with
    ``within`` a second level for the values of that column.  Null is 'none'."""
    named = F.array(*[F.struct(F.lit(c).alias("name"), F.coalesce(F.col(c).cast("string"), F.lit("none")).alias("value")) for c in columns])
    outer = F.coalesce(F.col(within).cast("string"), F.lit("none")) if within else F.lit("all")
    counts = df.select(outer.alias("within"), F.inline(named)).groupBy("within", "name", "value").agg(F.count("*").alias("n"))
    as_map = lambda k, v: F.map_from_entries(F.collect_list(F.struct(k, v)))
    inner = counts.groupBy("within", "name").agg(as_map("value", "n").alias("values"))
    named_maps = inner.groupBy("within").agg(as_map("name", "values").alias("columns"))
    whole = as_map("within", "columns") if within else F.first("columns")
    return named_maps.agg(F.to_json(whole).alias("json"))


def write_json(df: DataFrame, folder: str) -> None:
    df.write.mode("overwrite").json(folder)


def as_json(df: DataFrame, into: str = "json") -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns)).alias(into))


def lock_json(lock: DataFrame) -> DataFrame:
    """path -> hash as JSON lines sorted by path: a lock of any size."""
    return lock.orderBy("path").select(F.to_json(F.struct("path", "hash")).alias("json"))


def swap_parquet(df: DataFrame, folder: str, least_rows: int = 0) -> int:
    """Writes beside the folder, checks the count, swaps it in."""
    spark, staged = df.sparkSession, f"{folder}.new-{uuid.uuid4().hex[:8]}"
    df.write.parquet(staged)
    n = spark.read.parquet(staged).count()
    if n < least_rows:
        storage.remove(spark, staged)
        raise ValueError(f"{n} rows, at least {least_rows} expected; {folder} is unchanged")
    storage.swap(spark, staged, folder)
    return n


@contextmanager
def work_lock(path: str) -> Iterator[None]:
    """One process at a time; a second one raises FileExistsError."""
    fd = os.open(path, os.O_CREAT | os.O_EXCL | os.O_WRONLY)
    try:
        os.write(fd, str(os.getpid()).encode())
        os.close(fd)
        yield
    finally:
        os.unlink(path)


def quarantine(path: str) -> str | None:
    """Moves a failed output aside under a free name; None if there is none."""
    if not os.path.exists(path):
        return None
    names = itertools.chain([f"{path}.failed"], (f"{path}.{n}.failed" for n in itertools.count(1)))
    free = next(n for n in names if not os.path.exists(n))
    os.replace(path, free)
    return free


def post_rows(df: DataFrame, send: Callable[[list[dict]], None], size: int = 100) -> int:
    """Hands rows to a service in blocks and returns how many there were.
    ``send`` runs on the executors and may be called again for a block after a
    failure, so it must not mind repeats."""

    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            for i in range(0, len(rows), size):
                send(rows[i : i + size])
            yield pa.RecordBatch.from_arrays([pa.array([len(rows)], pa.int64())], names=["n"])

    return df.mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_files(files: dict[str, bytes], apply: bool = True) -> list[str]:
    """Writes several small files all or none; unchanged ones are not touched.
    Returns the paths that change; without ``apply`` nothing is written.

    Every file is staged first; if a replacement fails, those done before it
    get their former contents back.
    """
    changed = {}
    for path, data in files.items():
        old = None
        if os.path.exists(path):
            with open(path, "rb") as f:
                old = f.read()
        if old != data:
            changed[path] = (data, old)
    if not apply:
        return sorted(changed)
    staged, done = {}, []
    try:
        for path, (data, _) in changed.items():
            fd, name = tempfile.mkstemp(dir=os.path.dirname(os.path.abspath(path)))
            staged[path] = name
            with os.fdopen(fd, "wb") as f:
                f.write(data)
                f.flush()
                os.fsync(f.fileno())
        for path, name in staged.items():
            os.replace(name, path)
            done.append(path)
    except OSError:
        for path in done:
            old = changed[path][1]
            if old is None:
                os.unlink(path)
            else:
                with open(path, "wb") as f:
                    f.write(old)
        raise
    finally:
        for name in staged.values():
            if os.path.exists(name):
                os.unlink(name)
    return sorted(changed)
