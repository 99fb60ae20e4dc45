"""Named queries of the training-data operators, and SQL where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import leakage, mixing, readlevel, repair, sentences, skeleton, splitting


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    sketch = sentences.page_sketch(pages, ("text_layer",))
    a = sentences.sentence_units(pages, "page_key", "text_layer", "text_layer", sketch)
    b = sentences.sentence_units(table(spark, sf, "chunks"), "chunk_key", "content", "content")
    return a.unionByName(b).select("field", "unit_key", "end_char")


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    chunks = table(spark, sf, "chunks")
    return splitting.oversized(chunks, "chunk_key", "content")


def p3_pieces(spark: SparkSession, sf: str) -> DataFrame:
    chunks = table(spark, sf, "chunks").select("chunk_key", "content", "section", "page")
    return splitting.split_items(chunks, "chunk_key", "content", ("section", "page"))


def _hashed(spark: SparkSession, sf: str) -> DataFrame:
    a = skeleton.hashed(table(spark, sf, "pages"), "page_key", "text_layer", "text_layer")
    return a.unionByName(skeleton.hashed(table(spark, sf, "chunks"), "chunk_key", "content", "content"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return skeleton.pairs_of(_hashed(spark, sf))


def p4_classes(spark: SparkSession, sf: str) -> DataFrame:
    return skeleton.classes_of(_hashed(spark, sf))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return repair.line_faults(table(spark, sf, "pages"))


def p5_repaired(spark: SparkSession, sf: str) -> DataFrame:
    return repair.repaired_pages(table(spark, sf, "pages"))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    found = leakage.leaked_items(table(spark, sf, "documents"), table(spark, sf, "eval_items"))
    return found.select("doc_id", "item_id")


def p6_matches(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.leaked_items(table(spark, sf, "documents"), table(spark, sf, "eval_items"))


def _mix(spark: SparkSession, sf: str) -> mixing.Mix:
    return mixing.mixture(table(spark, sf, "documents"), table(spark, sf, "mix_targets"))


def p7_mix(spark: SparkSession, sf: str) -> DataFrame:
    return _mix(spark, sf).mixed


def p7_shares(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix_report(_mix(spark, sf))


def _levels(spark: SparkSession, sf: str) -> DataFrame:
    return readlevel.reading_levels(
        table(spark, sf, "documents"), table(spark, sf, "grade_labels"), table(spark, sf, "eval_items")
    )


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return _levels(spark, sf).where("level >= 4").select("doc_id")


def p8_levels(spark: SparkSession, sf: str) -> DataFrame:
    return _levels(spark, sf)


def p8_profile(spark: SparkSession, sf: str) -> DataFrame:
    return _levels(spark, sf).groupBy("lang", "level").agg(F.count("*").alias("documents"))


QUERIES = {
    f.__name__: f
    for f in (
        p1_found, p3_found, p3_pieces, p4_found, p4_classes, p5_found, p5_repaired, p6_found,
        p6_matches, p7_mix, p7_shares, p8_found, p8_levels, p8_profile,
    )
}

_WHITE = r"\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
SQL = {
    "p3_found": rf"""
        SELECT chunk_key FROM chunks
        WHERE coalesce(list_sum(list_transform(
                regexp_extract_all(content, '[A-Za-z0-9_]+'), lambda w: (length(w) + 3) // 4)), 0)
            + length(regexp_replace(content, '[A-Za-z0-9_{_WHITE}]', '', 'g')) > 480
    """,
}
