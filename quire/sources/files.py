"""Readers: files and small configuration to DataFrames."""

from __future__ import annotations

import io
import json
import os
import subprocess
import zipfile
from collections.abc import Iterable
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Notes for agents, which are no documents.
EXCLUDED_NAMES = ("agent.md", "agents.md")
README = ("readme.md",)
BOOK = "book_id string, title string, source string, mode string, pages int, language string, priority int, extra_args array<string>, enabled boolean"


def _relative(root: str):
    """Path below the root; hidden folders keep their names."""
    prefix = "^(?:file:)?/*" + "\\Q" + root.strip("/").removeprefix("file:").strip("/") + "\\E/"
    return F.url_decode(F.regexp_replace(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")), prefix, ""))


def markdown_files(
    spark: SparkSession,
    root: str,
    collections: dict[str, tuple[str, str]] | None = None,
    excluded: Iterable[str] = EXCLUDED_NAMES,
    layers: Iterable[str] = (),
) -> DataFrame:
    """path, text, source_kind, confidence of all Markdown files below root.

    Hidden folders, excluded names (proofreading adds ``README``) and paths
    with a folder of the given layers are left out.  With collections (path
    prefix -> kind and confidence) only files below a prefix come, the longest
    prefix counts.
    """
    files = (
        spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.md")
        .text(root)
        .select(_relative(root).alias("path"), F.col("value").alias("text"))
    )
    parts = F.split("path", "/")
    hidden = F.exists(parts, lambda p: p.startswith(".") | p.isin(*layers))
    files = files.where(~hidden & ~F.lower(F.element_at(parts, -1)).isin(*excluded))
    if not collections:
        return files
    kind = F.lit(None).cast("string")
    confidence = F.lit(None).cast("string")
    for prefix, (k, c) in sorted(collections.items(), key=lambda x: len(x[0])):
        at = F.col("path").startswith(prefix.rstrip("/") + "/")
        kind, confidence = F.when(at, k).otherwise(kind), F.when(at, c).otherwise(confidence)
    return files.withColumns({"source_kind": kind, "confidence": confidence}).where("source_kind IS NOT NULL")


def file_listing(spark: SparkSession, root: str, excluded: Iterable[str] = ()) -> DataFrame:
    """path, size, modified of all files; contents are not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        .select(_relative(root).alias("path"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    )
    names = list(excluded)
    return files.where(~F.arrays_overlap(F.split("path", "/"), F.array(*map(F.lit, names)))) if names else files


def hashed_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """path, size, hash.  A file is read as one value: up to 2 GB each."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
        .select(_relative(root).alias("path"), F.col("length").alias("size"), F.sha2("content", 256).alias("hash"))
    )


def hash_multimap(files: DataFrame) -> DataFrame:
    """hash -> sorted paths.  The paths of one hash are exact copies of a file."""
    return files.groupBy("hash").agg(F.array_sort(F.collect_list("path")).alias("paths"), F.count("*").alias("copies"))


def folder_size(files: DataFrame) -> DataFrame:
    return files.agg(F.count("*").alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))


def page_files(spark: SparkSession, root: str, prefix: str) -> DataFrame:
    """page, text of files '<prefix><number>.txt'."""
    return (
        spark.read.option("wholetext", True).option("pathGlobFilter", f"{prefix}*.txt").text(root)
        .select(
            F.regexp_extract(F.element_at(F.split("_metadata.file_path", "/"), -1), r"(\d+)\.txt$", 1).try_cast("int").alias("page"),
            F.col("value").alias("text"),
        )
    )


def manifest(spark: SparkSession, *paths: str) -> DataFrame:
    """Book manifests (YAML or JSON) with their defaults.  Small: one list."""
    rows = []
    for p in paths:
        with open(p, encoding="utf-8") as f:
            raw = f.read()
        if p.endswith(".json"):
            data = json.loads(raw)
        else:
            try:
                import yaml
            except ImportError as e:
                raise RuntimeError("YAML manifests need PyYAML; JSON ones do not") from e
            data = yaml.safe_load(raw)
        books = (data or {}).get("books") or []
        if not books:
            raise ValueError(f"no books in {p}")
        for b in books:
            rows.append(
                (
                    b.get("id"), b.get("title"), b.get("source"), b.get("mode", "redo"), int(b.get("pages") or 0),
                    b.get("language", "chi_sim+eng"), int(b.get("priority", 100)), list(b.get("extra_args") or []), bool(b.get("enabled", True)),
                )
            )
    return spark.createDataFrame(rows, BOOK)


def known_sources(*manifests: DataFrame) -> DataFrame:
    out = manifests[0].select("source")
    for m in manifests[1:]:
        out = out.unionByName(m.select("source"))
    return out.where("source IS NOT NULL").distinct()


def text_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A CSV manifest: UTF-8 with or without a byte-order mark."""
    df = spark.read.csv(path, header=True, multiLine=True, escape='"', encoding="UTF-8")
    return df.toDF(*[c.lstrip("\ufeff") for c in df.columns])


def transcript(spark: SparkSession, path: str, last: int = 2, length: int = 2000) -> DataFrame:
    """The last messages of user and assistant of each JSON-lines transcript."""
    from pyspark.sql.window import Window

    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"), F.try_parse_json("value").alias("v")
    )
    def content_of(at: str):
        """A string, or the texts of a list of parts."""
        parts = F.try_variant_get("v", at, "array<struct<text:string>>")
        texts = F.array_join(F.filter(F.transform(parts, lambda x: x["text"]), lambda x: x.isNotNull()), "\n")
        return F.coalesce(F.when(parts.isNotNull(), texts), F.try_variant_get("v", at, "string"))

    content = F.coalesce(content_of("$.message.content"), content_of("$.content"))
    role = F.coalesce(F.try_variant_get("v", "$.message.role", "string"), F.try_variant_get("v", "$.role", "string"))
    rows = lines.select("file", "at", role.alias("role"), F.substring(content, 1, length).alias("content")).where(
        F.col("role").isin("user", "assistant") & (F.trim("content") != "")
    )
    w = Window.partitionBy("file").orderBy(F.desc("at"))
    return rows.withColumn("n", F.row_number().over(w)).where(f"n <= {int(last)}").drop("n")


def page_rows(spark: SparkSession, rows: Iterable[tuple[str, int, str]]) -> DataFrame:
    """path, page, text from an extractor of another library (PDF, DOCX)."""
    return spark.createDataFrame(list(rows), T.StructType.fromDDL("path string, page int, text string"))


def tracked_files(root: str) -> list[str]:
    """Paths below root, sorted (driver side): those that git knows, or, where
    there is no repository, all but those in hidden folders."""
    try:
        done = subprocess.run(["git", "-C", root, "ls-files", "-z"], capture_output=True, check=True, timeout=60)
        return sorted(p for p in done.stdout.decode().split("\0") if p)
    except (OSError, subprocess.SubprocessError):
        pass
    out = []
    for at, folders, names in os.walk(root):
        folders[:] = sorted(d for d in folders if not d.startswith("."))
        out += [os.path.relpath(os.path.join(at, n), root) for n in sorted(names)]
    return sorted(out)


def lock_entries(spark: SparkSession, path: str) -> DataFrame:
    """path, hash of a lock: one JSON object whose ``files`` maps paths to
    hashes.  A file that is no such object raises."""
    rows = spark.read.option("wholetext", True).text(path).select(F.from_json("value", "files map<string,string>").alias("v"))
    files = F.when(F.col("v.files").isNull(), F.raise_error(F.lit("corpus_lock_invalid"))).otherwise(F.col("v.files"))
    return rows.select(F.explode(files).alias("path", "hash"))


REVIEW = """version int, root string, text_path string, source_path string, text_sha256 string, source_sha256 string,
pages array<struct<page: int, replacement: string, approved: boolean, reviewer: string, reason: string,
evidence: array<struct<path: string, sha256: string>>>>"""


def review_plans(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Review plans (JSON files) as rows: plans, their pages, and the evidence
    of each page; review_id is the file's name."""
    rows = spark.read.option("wholetext", True).text(path).select(
        F.element_at(F.split("_metadata.file_path", "/"), -1).alias("review_id"), F.from_json("value", REVIEW).alias("v")
    )
    plans = rows.select(
        "review_id", "v.version", "v.root", F.col("v.text_path").alias("path"), F.col("v.text_sha256").alias("text_hash"),
        F.col("v.source_path").alias("source_path"), F.col("v.source_sha256").alias("source_hash"),
    )
    pages = rows.select("review_id", F.col("v.text_path").alias("path"), F.explode("v.pages").alias("p"))
    entries = pages.select("review_id", "path", *[f"p.{c}" for c in ("page", "approved", "reviewer", "reason", "replacement")])
    evidence = pages.select("review_id", "p.page", F.explode("p.evidence").alias("e")).select(
        "review_id", "page", F.col("e.path").alias("path"), F.col("e.sha256").alias("hash")
    )
    return plans, entries, evidence


def docx_texts(spark: SparkSession, root: str) -> DataFrame:
    """path, text of Word files: their paragraphs that are not blank, one a
    line.  A file that is no Word file has a null text."""
    word = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"

    def paragraphs(data: bytes) -> str | None:
        try:
            with zipfile.ZipFile(io.BytesIO(data)) as z:
                body = ElementTree.fromstring(z.read("word/document.xml"))
        except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
            return None
        lines = ("".join(t.text or "" for t in p.iter(f"{word}t")) for p in body.iter(f"{word}p"))
        return "\n".join(x for x in lines if x.strip())

    def run(batches):
        for batch in batches:
            texts = [paragraphs(x) for x in batch.column("content").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(texts, pa.string())], names=["path", "text"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.docx").load(root)
    return files.select(_relative(root).alias("path"), "content").mapInArrow(run, "path string, text string")
