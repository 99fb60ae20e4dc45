"""From scanned and native pages to governed page texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X


def pages_of_markdown(documents: DataFrame, key: str, text: str = "text") -> DataFrame:
    """key, page, page_text of '## Page N' sections; texts without one have no
    rows.  Page texts are cleaned."""
    body = X.body(F.col(text))
    parts = F.split(body, r"(?m)^(?=## Page \d+[ \t]*$)")
    return (
        documents.select(key, F.explode(parts).alias("part"))
        .where(F.col("part").rlike(r"\A## Page \d+[ \t]*(?:\n|\z)"))
        .select(
            key,
            F.regexp_extract("part", r"\A## Page (\d+)", 1).cast("int").alias("page"),
            X.clean_native(F.regexp_replace("part", r"\A## Page \d+[ \t]*\n?", "")).alias("page_text"),
        )
    )


def document_issues(documents: DataFrame, key: str, text: str = "text") -> DataFrame:
    """key, code of texts: 'missing_frontmatter', 'invalid_yaml' (a line of the
    front matter that is no 'key: value', list item, comment or indented line),
    'invalid_page_sequence' (page headings that are not 1..n, or none) and
    'repeated_page'.  A null text has no front matter and no pages."""
    t = F.coalesce(text, F.lit(""))
    front = X.frontmatter(t)
    lines = F.filter(F.split(front, "\n"), lambda x: (F.trim(x) != "") & ~x.rlike(r"^(?:[^\s:][^:]*:(?:\s.*)?|\s.*|-\s.*|#.*)$"))
    pages = F.transform(F.regexp_extract_all(X.body(t), F.lit(r"(?m)^## Page (\d+)[ \t]*$"), F.lit(1)), lambda x: x.cast("int"))
    in_order = F.coalesce(F.forall(F.transform(pages, lambda x, i: x == i + 1), lambda ok: ok) & (F.size(pages) > 0), F.lit(False))
    codes = F.array_compact(
        F.array(
            F.when(~X.newlines(t).rlike(r"(?s)\A---\n.*?\n---(?:\n|\z)"), "missing_frontmatter"),
            F.when(F.size(lines) > 0, "invalid_yaml"),
            F.when(~in_order, "invalid_page_sequence"),
            F.when(F.size(F.array_distinct(pages)) < F.size(pages), "repeated_page"),
        )
    )
    return documents.select(key, F.explode(codes).alias("code"))


def headings(documents: DataFrame, key: str, text: str = "text") -> DataFrame:
    """key, i (number of the line), level, heading of the Markdown headings of
    a text's body."""
    lines = documents.select(key, F.posexplode(F.split(X.body(F.col(text)), "\n")).alias("i", "x"))
    return lines.where(F.col("x").rlike(r"^#{1,6}\s+.")).select(
        key,
        "i",
        F.length(F.regexp_extract("x", r"^(#{1,6})\s+.+$", 1)).alias("level"),
        F.regexp_extract("x", r"^#{1,6}\s+(.+?)\s*$", 1).alias("heading"),
    )


def signature(version: str, *parts: Column) -> Column:
    """What a result of a document was made from: program version and parts
    (hashes, path of the source); nulls count as empty."""
    return F.sha2(F.concat_ws("\x00", F.lit(version), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def outdated(documents: DataFrame, store: DataFrame, keys: list[str]) -> DataFrame:
    """Documents of which the store (complete results) holds no equal signature."""
    return documents.join(store.select(*keys).distinct(), keys, "left_anti")


def page_gaps(pages: DataFrame, by: str, page: str = "page") -> DataFrame:
    """Groups whose pages are not 1..n: what is missing, doubled, outside.
    ``n`` is the highest page."""
    one = pages.where(F.col(page).isNotNull()).groupBy(by, page).agg(F.count("*").alias("k"))
    return (
        one.groupBy(by)
        .agg(
            F.max(page).alias("last_page"),
            F.array_sort(F.collect_set(page)).alias("have"),
            F.count_if(F.col("k") > 1).alias("repeated"),
        )
        .select(
            by,
            "last_page",
            F.array_except(F.sequence(F.lit(1), F.greatest(F.col("last_page"), F.lit(1))), "have").alias("missing"),
            "repeated",
        )
    )


def page_differences(pages: DataFrame, books: DataFrame) -> DataFrame:
    """book_id, page, code: 'missing' and 'unexpected' pages of books against
    1..pages.  Books without a page count expect none."""
    have = pages.where("page IS NOT NULL").select("book_id", "page").distinct()
    want = books.where("pages > 0").select("book_id", F.explode(F.sequence(F.lit(1), F.col("pages"))).alias("page"))
    ours = have.join(books.select("book_id"), "book_id", "left_semi")
    return want.join(have, ["book_id", "page"], "left_anti").withColumn("code", F.lit("missing")).unionByName(
        ours.join(want, ["book_id", "page"], "left_anti").withColumn("code", F.lit("unexpected"))
    )


def coalesce_pages(
    pages: DataFrame, manual: DataFrame, blank: DataFrame, short: DataFrame, threshold: Column | int = 50
) -> DataFrame:
    """One text for each page: a manual override, else nothing if the page is
    verified blank, else the hybrid of native and scanned text.

    Adds origin, final_text and needs_review (short, and on no list).  The
    lists hold (book_id, page[, text]); they join by key, whatever their size.
    """
    keys = ["book_id", "page"]
    rows = (
        pages.join(manual.select(*keys, F.col("text").alias("manual_text")), keys, "left")
        .join(blank.select(*keys).distinct().withColumn("is_blank", F.lit(True)), keys, "left")
        .join(short.select(*keys).distinct().withColumn("is_short", F.lit(True)), keys, "left")
    )
    limit = threshold if isinstance(threshold, Column) else F.lit(threshold)
    rows = X.with_hybrid(rows, "native_text", "text_layer", limit, "taken_", "hybrid_")
    given = F.col("manual_text").isNotNull()
    final = F.when(given, X.clean_scan(F.col("manual_text"))).when(F.col("is_blank"), F.lit("")).otherwise(F.col("hybrid_"))
    origin = F.when(given, "manual").when(F.col("is_blank"), "blank").when(F.col("taken_"), "scan").otherwise("native")
    listed = given | F.col("is_blank").isNotNull() | F.col("is_short").isNotNull()
    out = rows.withColumns({"origin": origin, "final_text": final}).drop("taken_", "hybrid_")
    return out.withColumn("needs_review", ~listed & (X.compact_length(F.col("final_text")) < limit))


def list_conflicts(manual: DataFrame, blank: DataFrame, short: DataFrame, books: DataFrame) -> DataFrame:
    """Rows of the three lists that contradict each other or the books:
    'overlap', 'out_of_range', 'manual_empty'."""
    keys = ["book_id", "page"]
    lists = [d.select(*keys, F.lit(n).alias("list")) for n, d in (("manual", manual), ("blank", blank), ("short", short))]
    every = lists[0].unionByName(lists[1]).unionByName(lists[2])
    overlap = every.distinct().groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(*keys, F.lit("overlap").alias("code"))
    outside = (
        every.join(books.select("book_id", "pages"), "book_id", "left")
        .where("pages IS NULL OR page < 1 OR page > pages")
        .select(*keys, F.lit("out_of_range").alias("code"))
        .distinct()
    )
    empty = manual.where(X.compact_length(F.coalesce("text", F.lit(""))) == 0).select(*keys, F.lit("manual_empty").alias("code"))
    return overlap.unionByName(outside).unionByName(empty)


def text_statistics(pages: DataFrame, by: str, text: str) -> DataFrame:
    """Pages, pages with text, characters with and without white space."""
    t = F.coalesce(F.col(text), F.lit(""))
    return pages.groupBy(by).agg(
        F.count("*").alias("pages"),
        F.count_if(X.compact_length(t) > 0).alias("text_pages"),
        F.sum(F.length(t)).alias("characters"),
        F.sum(X.compact_length(t)).alias("visible_characters"),
    )


def update_manifest(manifest: DataFrame, compiled: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Manifest rows with the columns of the one compiled row of equal key
    (upper case); rows without one or with several stay as they are."""
    one = (
        compiled.groupBy(F.upper(F.trim(key)).alias("k_"))
        .agg(F.count("*").alias("n_"), *[F.first(c).alias(f"{c}_new_") for c in columns])
        .where("n_ = 1")
        .drop("n_")
    )
    joined = manifest.withColumn("k_", F.upper(F.trim(key))).join(one, "k_", "left")
    return joined.withColumns({c: F.coalesce(f"{c}_new_", c) for c in columns}).drop("k_", *[f"{c}_new_" for c in columns])


def manifest_problems(books: DataFrame) -> DataFrame:
    """Problems of manifest rows: mode, pages, threshold, double ids."""
    single = books.select(
        "book_id",
        F.array_compact(
            F.array(
                F.when(~F.col("strategy").isin("ocr", "native", "hybrid"), "bad_mode"),
                F.when(F.coalesce(F.col("expected_pages"), F.lit(0)) <= 0, "bad_pages"),
                F.when(F.col("title").isNull() | (F.trim("title") == ""), "no_title"),
                F.when(F.col("source_hash").isNull(), "no_source"),
                F.when(F.length(F.trim("source_hash")) != 64, "bad_source_hash"),
            )
        ).alias("codes"),
    ).where(F.size("codes") > 0).select("book_id", F.explode("codes").alias("code"))
    double = books.groupBy("book_id").agg(F.count("*").alias("n")).where("n > 1").select("book_id", F.lit("double_id").alias("code"))
    return single.unionByName(double)


def manifest_cardinality(manifest: DataFrame, compiled: DataFrame, key: str) -> DataFrame:
    """key, found: compiled documents that have not exactly one manifest row."""
    k = F.upper(F.trim(key))
    rows = manifest.where(F.col(key).isNotNull()).groupBy(k.alias(key)).agg(F.count("*").alias("n"))
    want = compiled.where(F.col(key).isNotNull()).select(k.alias(key)).distinct()
    return want.join(rows, key, "left").select(key, F.coalesce("n", F.lit(0)).alias("found")).where("found <> 1")


def planned_books(books: DataFrame, ids: list[str] | None = None, sample: int | None = None) -> DataFrame:
    """Enabled books (all of them, or those of the ids) with their pages, at
    most ``sample`` of each; by priority and id."""
    rows = books.where(F.coalesce("enabled", F.lit(True)))
    rows = rows.where(F.col("book_id").isin(*ids)) if ids is not None else rows
    pages = F.col("pages") if sample is None else F.least("pages", F.lit(sample))
    return rows.withColumn("pages", pages).orderBy("priority", "book_id")


def sample_range(pages: Column, sample: Column | int) -> Column:
    """'1-n' with n at most ``sample``; null (all pages) for no sample."""
    sample = sample if isinstance(sample, Column) else F.lit(sample)
    return F.when(sample > 0, F.concat(F.lit("1-"), F.least(sample, pages).cast("string")))


def select_documents(files: DataFrame, folder: str, order: str, path: str = "path") -> DataFrame:
    """Files directly in a folder, readme files left out, the first by
    ``order`` of each path."""
    inside = F.regexp_replace(F.col(path), r"/?[^/]*$", "") == folder
    readme = F.lower(F.element_at(F.split(F.col(path), "/"), -1)) == "readme.md"
    columns = files.columns
    best = F.min_by(F.struct(*columns), order)
    return files.where(inside & ~readme).groupBy(F.col(path).alias("k_")).agg(best.alias("r")).select("r.*")


def first_across(files: DataFrame, roots: list[str], limit: int, root: str = "root", path: str = "path") -> DataFrame:
    """The first files over all roots, in the order of the roots, then by path."""
    rank = F.array_position(F.array(*map(F.lit, roots)), F.col(root))
    return files.where(F.col(root).isin(*roots)).orderBy(rank, path).limit(limit)


def short_empty(coalesced: DataFrame, short: DataFrame) -> DataFrame:
    """book_id, page of pages verified as short whose final text is empty."""
    listed = short.select("book_id", "page").distinct()
    return coalesced.join(listed, ["book_id", "page"], "left_semi").where(X.compact_length(F.col("final_text")) == 0).select("book_id", "page").distinct()


def provenance(layers: DataFrame, books: DataFrame, text: str = "text") -> DataFrame:
    """book_id, path, code of text layers whose front matter contradicts the
    manifest (book_id, pages, source_hash): 'bad_source_hash', 'page_count',
    'source_changed'."""
    m = X.frontmatter_map(F.coalesce(text, F.lit("")))
    stated = F.upper(F.trim(F.coalesce(F.try_element_at("m", F.lit("source_sha256")), F.lit(""))))
    rows = layers.select("book_id", "path", m.alias("m")).join(
        books.select("book_id", F.col("pages").alias("want"), F.upper(F.trim("source_hash")).alias("now")), "book_id"
    )
    codes = F.array_compact(
        F.array(
            F.when(~stated.rlike("^[0-9A-F]{64}$"), "bad_source_hash"),
            F.when(~F.try_element_at("m", F.lit("pages")).try_cast("int").eqNullSafe(F.col("want")), "page_count"),
            F.when(stated.rlike("^[0-9A-F]{64}$") & ~stated.eqNullSafe(F.col("now")), "source_changed"),
        )
    )
    return rows.select("book_id", "path", F.explode(codes).alias("code"))


def changed_meanwhile(before: DataFrame, after: DataFrame, path: str = "path") -> DataFrame:
    """Paths whose hash is another one at the end of a run than at its start."""
    a = before.select(path, F.lower(F.trim("hash")).alias("a")).distinct()
    b = after.select(path, F.lower(F.trim("hash")).alias("b")).distinct()
    return a.join(b, path).where("a <> b").select(path).distinct()


def cached(tasks: DataFrame, cache: DataFrame, keys: list[str], ok: Column) -> DataFrame:
    """Tasks whose result the cache holds: equal signature, and no failure."""
    return tasks.join(cache.where(ok).select(*keys).distinct(), keys, "left_semi")


def page_selection(c: Column, last: Column) -> Column:
    """'1,3-5' -> [1,3,4,5], distinct and sorted; null if a part is out of
    1..last or malformed."""
    parts = F.transform(F.split(F.regexp_replace(c, r"\s+", ""), ","), lambda p: F.split(p, "-"))
    fits = F.forall(
        parts,
        lambda p: F.forall(p, lambda x: x.rlike(r"^\d{1,9}$"))
        & (F.size(p) <= 2)
        & (F.try_element_at(p, F.lit(1)).try_cast("int") >= 1)
        & (F.try_element_at(p, F.lit(-1)).try_cast("int") <= last)
        & (F.try_element_at(p, F.lit(1)).try_cast("int") <= F.try_element_at(p, F.lit(-1)).try_cast("int")),
    )
    numbers = F.flatten(
        F.transform(
            parts,
            lambda p: F.sequence(F.try_element_at(p, F.lit(1)).try_cast("int"), F.try_element_at(p, F.lit(-1)).try_cast("int")),
        )
    )
    return F.when(fits, F.array_sort(F.array_distinct(numbers)))


def tiles(low: Column, high: Column, height: int = 1600, overlap: int = 60) -> Column:
    """Overlapping windows [from, to] that cover low..high, the last one cut."""
    step = height - overlap
    last = F.greatest(high - overlap - 1, low)
    return F.transform(
        F.sequence(low, last, F.lit(step)), lambda y: F.struct(y.alias("from"), F.least(y + height, high).alias("to"))
    )


def compose_text_layer(pages: DataFrame, by: str, text: str = "final_text", head: Column | None = None) -> DataFrame:
    """One Markdown text for each document from its pages in order, after a
    head if one is given.  A group is one document, whose pages fit one row by
    contract."""
    ordered = F.array_sort(F.collect_list(F.struct("page", F.coalesce(F.col(text), F.lit("")).alias("t"))))
    part = lambda p: F.concat(F.lit("## Page "), p["page"].cast("string"), F.lit("\n\n"), p["t"])
    markdown = F.array_join(F.transform(ordered, part), "\n\n")
    if head is not None:
        markdown = F.concat(F.first(F.coalesce(head, F.lit(""))), markdown)
    return pages.groupBy(by).agg(markdown.alias("markdown"))


def layer_head(fields: dict[str, Column], title: Column) -> Column:
    """Front matter of the fields that are not null, and the title."""
    lines = F.array_compact(F.array(*[F.concat(F.lit(f"{k}: "), v.cast("string")) for k, v in fields.items()]))
    return F.concat(F.lit("---\n"), F.array_join(lines, "\n"), F.lit("\n---\n\n# "), F.coalesce(title, F.lit("")), F.lit("\n\n"))


def is_text_file(size: Column, first_page: Column) -> Column:
    """Files over 80 MiB are taken for scans; else the first page decides."""
    return (size <= 80 * 1024 * 1024) & (F.length(F.coalesce(first_page, F.lit(""))) > 100)
