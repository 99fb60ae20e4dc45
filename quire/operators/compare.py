"""Page-level comparison of text versions."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..session import spread


def match_sources(documents: DataFrame, sources: DataFrame) -> DataFrame:
    """Documents with the first path among the sources of equal hash; null if
    there is none.  Hashes compare in lower case; sources are grouped first,
    so no row multiplies."""
    by_hash = (
        sources.where("source_hash IS NOT NULL")
        .groupBy(F.lower(F.trim("source_hash")).alias("h"))
        .agg(F.min("path").alias("source_path"), F.count("*").alias("copies"))
    )
    return documents.join(by_hash, F.lower(F.trim(documents["source_hash"])) == by_hash["h"], "left").drop("h")


def align_pages(text: DataFrame, native: DataFrame, keys: list[str]) -> DataFrame:
    """Native pages with the text of the same page, '' where there is none."""
    return native.join(text, keys, "left").withColumn("text_layer", F.coalesce("text_layer", F.lit("")))


def compared(pages: DataFrame) -> DataFrame:
    """Adds comparison, sizes without white space and fault names."""
    t, n = F.coalesce("text_layer", F.lit("")), F.coalesce("native_text", F.lit(""))
    return pages.withColumns(
        {
            "comparison": X.compare_texts(t, n),
            "text_size": X.compact_length(t),
            "native_size": X.compact_length(n),
            "faults": F.array_union(X.diagnostics(t), X.diagnostics(n)),
        }
    )


def dice(a: str, b: str, size: int = 3) -> float:
    """Dice similarity of the multisets of n-grams: 1 for equal texts, 0 if
    one is shorter than ``size``."""
    if a == b:
        return 1.0
    if min(len(a), len(b)) < size:
        return 0.0
    x, y = (Counter([t[i : i + size] for i in range(len(t) - size + 1)]) for t in (a, b))
    return 2.0 * sum(min(n, y[g]) for g, n in x.items() if g in y) / (len(a) + len(b) - 2 * (size - 1))


def similarity(pairs: DataFrame, left: str, right: str, keep: Sequence[str] = (), size: int = 3) -> DataFrame:
    """The kept columns, ``score``, the similarity of two cleaned texts,
    their lengths, ``left_chars`` and ``right_chars``, and ``same``.

    Both texts lie in one row, so each row is scored where it is: no n-gram
    and no text is shuffled.  Nulls count as empty.
    """
    a, b = (X.clean(F.coalesce(c, F.lit(""))) for c in (left, right))
    kept = pairs.select(*keep)
    names = kept.columns
    fields = [T.StructField("score", T.DoubleType()), T.StructField("left_chars", T.LongType()), T.StructField("right_chars", T.LongType())]
    fields.append(T.StructField("same", T.BooleanType()))

    def run(batches):
        for batch in batches:
            t = pa.Table.from_batches([batch])
            x, y = t.column("a_").to_pylist(), t.column("b_").to_pylist()
            out = t.select(names).append_column("score", pa.array([dice(v, w, size) for v, w in zip(x, y, strict=True)], pa.float64()))
            for name, texts in (("left_chars", x), ("right_chars", y)):
                out = out.append_column(name, pa.array(list(map(len, texts)), pa.int64()))
            same = pa.array([v == w for v, w in zip(x, y, strict=True)], pa.bool_())
            yield from out.append_column("same", same).to_batches()

    rows = spread(pairs.select(*dict.fromkeys([*keep, left, right]))).select(*keep, a.alias("a_"), b.alias("b_"))
    return rows.mapInArrow(run, T.StructType([*kept.schema.fields, *fields]))


def scored_pages(pages: DataFrame, keep: Sequence[str] = ("page_key", "path")) -> DataFrame:
    """The kept columns, score (6 places), seven-way class and has_text."""
    has_text = F.coalesce(F.col("text_layer").rlike(r"(?U)\S"), F.lit(False))
    scored = similarity(pages.withColumn("has_text", has_text), "text_layer", "native_text", [*keep, "has_text"])
    left, right = F.col("left_chars"), F.col("right_chars")
    by_score = (
        F.when(F.col("same"), BANDS[0]).when(F.col("near") >= 0.98, BANDS[1]).when(F.col("near") >= 0.90, BANDS[2]).otherwise(BANDS[3])
    )
    name = (
        F.when((left == 0) & (right == 0), "both_empty").when(left == 0, "text_layer_missing").when(right == 0, "recognition_missing")
    ).otherwise(by_score)
    return scored.withColumn("near", F.round("score", 6)).select(*keep, F.col("near").alias("score"), name.alias("class"), "has_text")


BANDS = ("exact_ignoring_layout_whitespace", "near_match_review", "difference_review", "major_difference_review")


def document_rollup(scored: DataFrame, by: str = "path") -> DataFrame:
    """One row per document: pages, pages with a scan, band counts, least score."""
    return scored.groupBy(by).agg(
        F.count("*").alias("pages"),
        F.count_if("has_text").alias("read_pages"),
        *[F.count_if(F.col("class") == b).alias(b) for b in BANDS],
        F.min("score").alias("least_score"),
    )


def review_priority(scored: DataFrame, k: int, key: str = "page_key") -> DataFrame:
    """The k pages that differ most, worst first."""
    return scored.where(F.col("class").isin(*BANDS[1:])).orderBy("score", key).limit(k)
