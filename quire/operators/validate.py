"""Integrity of a document collection: links, numbering, locks, secrets."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as X


SECRET_BYTES = 5 * 1024 * 1024  # longer files are not searched for secrets


def links(documents: DataFrame, path: str, text: str) -> DataFrame:
    """path, kind ('wiki', 'markdown'), target of every link."""
    folder = F.regexp_replace(F.col(path), r"/?[^/]*$", "")
    wiki = documents.select(path, F.lit("wiki").alias("kind"), F.explode(X.wiki_targets(F.col(text))).alias("target"))
    markdown = documents.select(
        path, F.lit("markdown").alias("kind"), folder.alias("f"), F.explode(X.markdown_targets(F.col(text))).alias("t")
    ).select(path, "kind", F.coalesce(X.normal_path(F.col("f"), F.col("t")), F.concat(F.lit("../"), "t")).alias("target"))
    return wiki.unionByName(markdown)


def stem(path: Column) -> Column:
    return F.regexp_replace(path, r"\.md$", "")


def resolve_wiki(found: DataFrame, names: DataFrame, path: str = "path") -> DataFrame:
    """Every wiki link with its state and the path it leads to.

    names: path and name of all documents (a name is what links may call it).
    Order: the path from the root, exactly or else without regard to case; the
    path from the source's folder, likewise; a name that only one document has.
    States: ok, case, ambiguous, broken.  Index sides are grouped to one row
    for a key before they join, so no link multiplies.
    """
    base = names.select(stem(F.col("path")).alias("full"), F.col("path").alias("to"), "name")
    exact = base.groupBy("full").agg(F.min("to").alias("exact_to"))
    folded = base.groupBy(F.lower("full").alias("low")).agg(F.min("to").alias("case_to"))
    named = base.where("name IS NOT NULL").groupBy(F.lower("name").alias("called")).agg(
        F.min("to").alias("name_to"), F.count_distinct("to").alias("n")
    )
    folder = F.regexp_replace(F.col(path), r"/?[^/]*$", "")
    rows = found.withColumns(
        {"root_": X.normal_path(F.lit(""), F.col("target")), "sibling": X.normal_path(folder, F.col("target"))}
    ).withColumns({"low_r": F.lower("root_"), "low_s": F.lower("sibling"), "called": F.when(~F.col("target").contains("/"), F.lower("target"))})
    rows = (
        rows.join(exact.toDF("root_", "a"), "root_", "left")
        .join(folded.toDF("low_r", "b"), "low_r", "left")
        .join(exact.toDF("sibling", "c"), "sibling", "left")
        .join(folded.toDF("low_s", "d"), "low_s", "left")
        .join(named, "called", "left")
    )
    state = (
        F.when(F.col("a").isNotNull(), "ok")
        .when(F.col("b").isNotNull(), "case")
        .when(F.col("c").isNotNull(), "ok")
        .when(F.col("d").isNotNull(), "case")
        .when(F.col("n") == 1, "ok")
        .when(F.col("n") > 1, "ambiguous")
        .otherwise("broken")
    )
    to = F.coalesce("a", "b", "c", "d", F.when(F.col("n") == 1, F.col("name_to")))
    return rows.select(path, "target", state.alias("state"), to.alias("to_path"))


def link_issues(resolved: DataFrame, path: str = "path", log: str = "log.md") -> DataFrame:
    """path, target, code of wiki links that do not resolve as written; a link
    to nothing is none in the log, which tells of pages that are gone."""
    name = F.element_at(F.split(F.col(path), "/"), -1)
    code = (
        F.when((F.col("state") == "broken") & (name != log), "broken_wiki_link")
        .when(F.col("state") == "ambiguous", "ambiguous_wiki_link")
        .when(F.col("state") == "case", "wiki_link_case")
    )
    return resolved.select(path, "target", code.alias("code")).where("code IS NOT NULL")


def missing_backlinks(resolved: DataFrame, path: str, first: str, second: str) -> DataFrame:
    """path, target, code: links between articles (first folder) and courses
    (second) that are not returned.  Links that differ in case count."""
    edges = resolved.where("to_path IS NOT NULL").select(F.col(path).alias("path"), F.col("to_path").alias("target"))
    across = edges.where(
        (F.col("path").startswith(f"{first}/") & F.col("target").startswith(f"{second}/"))
        | (F.col("path").startswith(f"{second}/") & F.col("target").startswith(f"{first}/"))
    )
    code = F.when(F.col("path").startswith(f"{first}/"), "missing_course_backlink").otherwise("missing_article_backlink")
    return one_sided(across, "path", "target").withColumn("code", code)


def broken_markdown(found: DataFrame, documents: DataFrame, path: str = "path") -> DataFrame:
    """Markdown links to no document, and links that leave the root."""
    rows = found.where("kind = 'markdown'")
    escaped = rows.where(F.col("target").startswith("../")).select(path, "target", F.lit("markdown_link_escape").alias("code"))
    missing = (
        rows.where(~F.col("target").startswith("../"))
        .join(documents.select(F.col(path).alias("target")), "target", "left_anti")
        .select(path, "target", F.lit("broken_markdown_link").alias("code"))
    )
    return escaped.unionByName(missing)


def one_sided(edges: DataFrame, a: str = "source", b: str = "target") -> DataFrame:
    """Edges whose opposite is missing; a self-link is its own opposite."""
    e = edges.select(a, b).distinct()
    back = e.select(F.col(b).alias(a), F.col(a).alias(b))
    return e.join(back, [a, b], "left_anti")


def sequence_gaps(rows: DataFrame, by: str, number: str, first: int = 1) -> DataFrame:
    """Groups whose numbers are not first..last, each once."""
    return (
        rows.where(F.col(number).isNotNull())
        .groupBy(by)
        .agg(
            F.min(number).alias("low"),
            F.max(number).alias("high"),
            F.count("*").alias("n"),
            F.count_distinct(number).alias("distinct_n"),
        )
        .where(f"low <> {first} OR high - low + 1 <> n OR n <> distinct_n")
    )


def lock_of(documents: DataFrame, path: str, text: str) -> DataFrame:
    """path, hash: the lock of a corpus."""
    return documents.select(path, F.sha2(text, 256).alias("hash"))


def lock_diff(lock: DataFrame, now: DataFrame, path: str = "path") -> DataFrame:
    """path, code: 'missing', 'unexpected' or 'mismatch' against the lock."""
    a = lock.select(path, F.col("hash").alias("locked"), F.lit(True).alias("in_lock"))
    b = now.select(path, F.col("hash").alias("present"), F.lit(True).alias("in_now"))
    code = (
        F.when(F.col("in_now").isNull(), "missing")
        .when(F.col("in_lock").isNull(), "unexpected")
        .when(~F.col("locked").eqNullSafe(F.col("present")), "mismatch")
    )
    return a.join(b, path, "full").select(path, code.alias("code")).where("code IS NOT NULL")


def secrets(documents: DataFrame, path: str, text: str) -> DataFrame:
    """path, code of documents that hold a secret or have a sensitive name;
    the secret itself is never part of a result."""
    small = F.octet_length(text) <= SECRET_BYTES
    a = documents.where(small & X.has_secret(F.col(text))).select(path, F.lit("secret_pattern").alias("code"))
    b = documents.where(X.sensitive_name(F.col(path))).select(path, F.lit("sensitive_file_tracked").alias("code"))
    return a.unionByName(b)


def required(documents: DataFrame, paths: list[str], path: str = "path") -> DataFrame:
    spark = documents.sparkSession
    want = spark.createDataFrame([(p,) for p in paths], f"{path} string")
    return want.join(documents.select(path), path, "left_anti").select(path, F.lit("required_file_missing").alias("code"))


def numbered_issues(documents: DataFrame, path: str = "path", status: str = "status") -> DataFrame:
    """Issues of numbered documents: name, status, marks of front matter."""
    name = F.element_at(F.split(F.col(path), "/"), -1)
    codes = F.array_compact(
        F.array(
            F.when(~name.rlike(r"^\d{2,}.*\.md$"), "filename"),
            F.when(~F.coalesce(F.col(status), F.lit("")).isin("complete", "pending"), "status"),
            F.when(F.regexp_extract(name, r"^(\d+)", 1).try_cast("int") == 0, "number"),
        )
    )
    return documents.select(path, F.explode(codes).alias("code"))


class Numbered(NamedTuple):
    """What the documents of one numbered collection must be like."""

    kind: str  # first part of the issue codes
    folder: str
    name: str  # expression of file names; group 1 is the number
    types: tuple[str, ...]
    status: str | None = None  # the one status allowed; None: any, but one
    number: str | None = None  # field that repeats the number
    fields: tuple[str, ...] = ()  # further fields that must be there
    markers: tuple[str, str] | None = None
    first: int = 0
    last: int = 0


def numbered_corpus(documents: DataFrame, rules: list[Numbered], path: str = "path", text: str = "text") -> DataFrame:
    """path, code: every breach of the rules by the documents directly in
    their folders.

    Codes by kind: '_filename' (and nothing else for that file), '_type',
    '_status', '_frontmatter_number', '_<field>', 'marker_count',
    'marker_order', and '_numbering' on the folder unless the numbers are
    first..last, each once.
    """
    name = F.element_at(F.split(F.col(path), "/"), -1)
    folder = F.regexp_replace(F.col(path), r"/?[^/]*$", "")
    kind = F.lit(None).cast("string")
    for r in rules:
        kind = F.when(folder == r.folder, r.kind).otherwise(kind)
    rows = documents.select(path, kind.alias("kind"), name.alias("name"), F.col(text).alias("t")).where("kind IS NOT NULL AND name LIKE '%.md'")
    rows = rows.select(path, "kind", "name", "t", X.frontmatter_map(F.coalesce("t", F.lit(""))).alias("m"))
    codes, number = F.lit(None).cast("array<string>"), F.lit(None).cast("int")
    for r in rules:
        field = lambda k: F.coalesce(F.try_element_at("m", F.lit(k)), F.lit(""))
        n = F.regexp_extract("name", r.name, 1).try_cast("int")
        status = field("status") == "" if r.status is None else field("status") != r.status
        tests = [F.when(~field("type").isin(*r.types), f"{r.kind}_type"), F.when(status, f"{r.kind}_status")]
        if r.number:
            tests.append(F.when(~field(r.number).try_cast("int").eqNullSafe(n), f"{r.kind}_frontmatter_number"))
        tests += [F.when(~F.array_contains(F.map_keys("m"), f), f"{r.kind}_{f}") for f in r.fields]
        if r.markers:
            state = X.marker_state(F.coalesce("t", F.lit("")), *r.markers)
            tests.append(F.when(state != "ok", state))
        mine = F.when(F.col("name").rlike(r.name), F.array_compact(F.array(*tests))).otherwise(F.array(F.lit(f"{r.kind}_filename")))
        codes, number = F.when(F.col("kind") == r.kind, mine).otherwise(codes), F.when(F.col("kind") == r.kind, n).otherwise(number)
    rows = rows.select(path, "kind", codes.alias("codes"), number.alias("number"))
    single = rows.select(path, F.explode("codes").alias("code"))
    want = documents.sparkSession.createDataFrame([(r.kind, r.folder, r.first, r.last) for r in rules], "kind string, folder string, first int, last int")
    have = rows.where("number IS NOT NULL").groupBy("kind").agg(
        F.min("number").alias("low"), F.max("number").alias("high"), F.count("*").alias("n"), F.count_distinct("number").alias("d")
    )
    whole = (F.col("low") == F.col("first")) & (F.col("high") == F.col("last")) & (F.col("n") == F.col("last") - F.col("first") + 1) & (F.col("n") == F.col("d"))
    gaps = want.join(have, "kind", "left").where(~F.coalesce(whole, F.lit(False)))
    return single.unionByName(gaps.select(F.col("folder").alias(path), F.concat("kind", F.lit("_numbering")).alias("code")))


def samples(issues: DataFrame, by: str, path: str, k: int = 12) -> DataFrame:
    """by, n, first: the number of issues of each kind and the first k paths,
    the rest cut before anything is shuffled."""
    w = Window.partitionBy(by).orderBy(path)
    few = issues.withColumn("r_", F.row_number().over(w)).where(F.col("r_") <= k)
    shown = few.groupBy(by).agg(F.array_join(F.array_sort(F.collect_list(path)), ", ").alias("first"))
    return report(issues, by).join(shown, by)


def mismatch(wanted: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """key, side: 'missing' or 'extra'; no row if both hold the same keys."""
    a, b = wanted.select(key).distinct(), found.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("missing")).unionByName(
        b.join(a, key, "left_anti").withColumn("side", F.lit("extra"))
    )


def report(issues: DataFrame, by: str = "code") -> DataFrame:
    return issues.groupBy(by).agg(F.count("*").alias("n"))
