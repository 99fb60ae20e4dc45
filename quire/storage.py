"""File operations that a job needs around Spark's writers, on any file
system that Hadoop knows (local, HDFS, object stores)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """(file system, path)"""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Sorted names of what lies in a folder; none if there is no such folder."""
    fs, p = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _at(spark, path)
    fs.mkdirs(p.getParent())
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def _rename_once(spark: SparkSession, staged: str, path: str) -> None:
    """A rename that raises if the name is taken."""
    jvm, p = spark.sparkContext._jvm, _at(spark, path)[1]
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    context.rename(_at(spark, staged)[1], p, options)


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Makes a file appear whole, or not at all if one of that name is there.

    A local file gets its name by a hard link, which fails if the name is
    taken; elsewhere a rename that never overwrites decides, which HDFS does in
    one step.  Of two writers exactly one returns True.
    """
    fs, p = _at(spark, path)
    staged = f"{path}.{uuid.uuid4().hex}.staged"
    write_text(spark, staged, text)
    try:
        if fs.getUri().getScheme() == "file":
            local = [fs.makeQualified(_at(spark, x)[1]).toUri().getPath() for x in (staged, path)]
            try:
                os.link(*local)
            except FileExistsError:
                return False
            return True
        try:
            _rename_once(spark, staged, path)
        except Exception:
            if fs.exists(p):
                return False
            raise
        return True
    finally:
        fs.delete(_at(spark, staged)[1], False)


def swap(spark: SparkSession, staged: str, target: str) -> None:
    """Puts a finished folder in place of another, which is kept until then."""
    fs, new = _at(spark, staged)
    at = _at(spark, target)[1]
    old = _at(spark, f"{target}.old-{uuid.uuid4().hex[:8]}")[1]
    had = fs.exists(at)
    if had and not fs.rename(at, old):
        raise OSError(f"{target} cannot be moved")
    if not fs.rename(new, at):
        if had:
            fs.rename(old, at)
        raise OSError(f"{staged} cannot be moved to {target}")
    if had:
        fs.delete(old, True)
