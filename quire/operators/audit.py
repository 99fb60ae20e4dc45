"""Reconciling two file sets by content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Kinds of files by suffix and folder.
MEDIA = ".mp3 .mp4 .mov .flv .wav .m4a .avi .mkv".split()
ARCHIVES = ".zip .rar .7z .tar .gz".split()
TEMPORARY = ".log .tmp .temp .pyc".split()
REBUILDABLE = (
    "tmp __pycache__ node_modules .venv venv site-packages .cache .pytest_cache .vite .next".split()
)
SAMPLE = 20  # match paths shown for one file


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(F.element_at(F.split(path, "/"), -1), r"(\.[^.]+)$", 1))


def category(path: Column, matched: Column, unreadable: Column) -> Column:
    s = suffix(path)
    return (
        F.when(unreadable, "read_error")
        .when(matched, "matched")
        .when(s.isin(*TEMPORARY) | F.arrays_overlap(F.split(F.lower(path), "/"), F.array(*map(F.lit, REBUILDABLE))), "temporary_or_rebuildable")
        .when(s.isin(*MEDIA) | s.isin(*ARCHIVES), "media_or_archive")
        .otherwise("pending")
    )


def reconcile(old: DataFrame, new: DataFrame) -> DataFrame:
    """Every old file with the new files of equal content (path, size, hash).

    New files of a size that no old file has drop out before anything is
    compared by hash; matches are grouped first, so an old file stays one row.
    A null hash matches nothing; size -1 marks an unreadable file.  ``listed``
    shows the first ``SAMPLE`` matches; ``matched_files`` has them all.
    """
    same_size = new.join(old.select("size").distinct(), "size", "left_semi").where("hash IS NOT NULL")
    w = Window.partitionBy("hash").orderBy("path")
    shown = (
        same_size.withColumn("r_", F.row_number().over(w)).where(F.col("r_") <= SAMPLE)
        .groupBy("hash")
        .agg(F.array_join(F.array_sort(F.collect_list("path")), " | ").alias("listed"))
    )
    counted = same_size.groupBy("hash").agg(F.count("*").alias("matches"), F.min("path").alias("first_match"))
    by_hash = counted.join(shown, "hash")
    doubles = old.where("hash IS NOT NULL").groupBy("hash").agg(F.count("*").alias("old_copies"))
    return (
        old.join(by_hash, "hash", "left")
        .join(doubles, "hash", "left")
        .withColumns(
            {
                "matches": F.coalesce("matches", F.lit(0)),
                "old_copies": F.coalesce("old_copies", F.lit(0)),
                "category": category(F.col("path"), F.col("first_match").isNotNull(), F.col("size") < 0),
            }
        )
    )


def matched_files(old: DataFrame, new: DataFrame) -> DataFrame:
    """side, path, hash of all files whose content is on both sides: the files
    of one hash are a class, so copies make no pairs."""
    both = old.where("hash IS NOT NULL").select("hash").intersect(new.where("hash IS NOT NULL").select("hash"))
    rows = old.select(F.lit("old").alias("side"), "path", "hash").unionByName(new.select(F.lit("new").alias("side"), "path", "hash"))
    return rows.join(both, "hash", "left_semi").select("side", "path", "hash")


def totals(files: DataFrame) -> DataFrame:
    """Files, bytes and GiB of each category."""
    size = F.sum(F.greatest("size", F.lit(0)))
    return files.groupBy("category").agg(
        F.count("*").alias("files"), size.alias("bytes"), F.round(size / F.lit(1024.0**3), 3).alias("gib")
    )


def top_suffixes(files: DataFrame, k: int = 25) -> DataFrame:
    """The suffixes with most unmatched bytes."""
    return (
        files.where(F.col("category") != "matched")
        .groupBy(suffix(F.col("path")).alias("suffix"))
        .agg(F.count("*").alias("files"), F.sum(F.greatest("size", F.lit(0))).alias("bytes"))
        .orderBy(F.desc("bytes"), "suffix")
        .limit(k)
    )
