"""Editing under review: upserts, splices, diffs, edit logs, guards."""

from __future__ import annotations

import difflib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rewrite as R
from ..functions import text as X
from ..session import spread


def upsert_front(c: Column, key: str, value: Column) -> Column:
    """The frontmatter with ``key: value``: replaced where the key stands,
    else added as last line; texts without frontmatter stay as they are."""
    front = X.frontmatter(c)
    line = F.concat(F.lit(f"{key}: "), value)
    has = front.rlike(rf"(?m)^{re.escape(key)}:")
    new = F.when(has, F.regexp_replace(front, F.lit(rf"(?m)^{re.escape(key)}:.*$"), line)).otherwise(
        F.concat(front, F.lit("\n"), line)
    )
    return F.when(front == "", c).otherwise(F.concat(F.lit("---\n"), new, F.lit("\n---\n"), X.body(c)))


def splice_pages(pages: DataFrame, replacements: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Pages with the replacement of equal key where there is one."""
    new = replacements.groupBy(*keys).agg(F.max("replacement").alias("replacement"))
    return pages.join(new, keys, "left").withColumn(text, F.coalesce("replacement", text)).drop("replacement")


def unified_diff(pairs: DataFrame, key: str, before: str, after: str) -> DataFrame:
    """key, added, removed, diff of each pair of texts that differ."""

    def run(batches):
        for batch in batches:
            ks, add, rem, out = [], [], [], []
            for k, a, b in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if a == b:
                    continue
                lines = list(difflib.unified_diff((a or "").splitlines(), (b or "").splitlines(), "before", "after", lineterm=""))
                ks.append(k)
                add.append(sum(x.startswith("+") for x in lines[2:]))
                rem.append(sum(x.startswith("-") for x in lines[2:]))
                out.append("\n".join(lines))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ks, pa.int64()), pa.array(add, pa.int32()), pa.array(rem, pa.int32()), pa.array(out, pa.string())],
                names=["key", "added", "removed", "diff"],
            )

    rows = spread(pairs.select(F.col(key).cast("long"), before, after))
    return rows.mapInArrow(run, "key long, added int, removed int, diff string")


def marked(c: Column, pattern: str) -> Column:
    """The text with each match between \\x01 and \\x02."""
    return F.regexp_replace(c, f"({pattern})", "\x01$1\x02")


def logged(df: DataFrame, key: str, steps: dict[str, Column]) -> DataFrame:
    """key, rule, line, before: one row for each mark that ``marked`` set in
    the steps' texts; line is 1 and the line feeds before it.  Matching is
    done in expressions; a marked text is then read once from end to end."""
    rules = list(steps)

    def run(batches):
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [])
            for k, *texts in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True):
                for rule, text in zip(rules, texts, strict=True):
                    pieces = text.split("\x01") if text else [""]
                    line = 1 + pieces[0].count("\n")
                    for piece in pieces[1:]:
                        before, _, _ = piece.partition("\x02")
                        for column, value in zip(out, (k, rule, line, before), strict=True):
                            column.append(value)
                        line += piece.count("\n")
            types = (pa.int64(), pa.string(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types, strict=True)], names=["key", "rule", "line", "before"])

    columns = [c.alias(f"t{i}_") for i, c in enumerate(steps.values())]
    names = [c for c in df.columns if c != key]
    rows = spread(df.select(F.col(key).cast("long").alias("key_of_row_"), *names)).select("key_of_row_", *columns)
    return rows.mapInArrow(run, "key long, rule string, line long, before string")


def edit_log(df: DataFrame, key: str, text: str, rules: dict[str, str]) -> DataFrame:
    """``logged`` for expressions that are each applied to the text itself."""
    return logged(df, key, {name: marked(F.col(text), pattern) for name, pattern in rules.items()})


def _staged(df: DataFrame, rules: str) -> tuple[DataFrame, list[tuple[str, int, str]]]:
    """The text c0_ as each part of the rules finds it: c0_, c1_, ...; each is
    made once from the one before.  And (rule, part, expression) of each."""
    parts = [(name, k, pattern) for name in R.RULES if name in rules for k, (pattern, _, _) in enumerate(R.PATTERNS[name])]
    for i, (name, k, pattern) in enumerate(parts):
        c = F.col(f"c{i}_")
        df = df.withColumn(f"c{i + 1}_", R.rule_b(c) if name == "B" else F.regexp_replace(c, pattern, R.PATTERNS[name][k][1]))
    return df, parts


def rewrite_log(df: DataFrame, key: str, text: str, rules: str = "ABCDEG") -> DataFrame:
    """key, rule, line, before, after, reason of every edit of the rewriting
    rules, in their order, each on the text that the one before leaves."""
    staged, parts = _staged(df.select(key, F.col(text).alias("c0_")), rules)
    steps = {f"{name}{k}": marked(F.col(f"c{i}_"), pattern) for i, (name, k, pattern) in enumerate(parts)}
    log = logged(staged, key, steps)
    after, reason = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, parts in R.PATTERNS.items():
        for n, (_, new, why) in enumerate(parts):
            here = F.col("rule") == f"{name}{n}"
            made = F.translate("before", "".join(R.FULL_WIDTH), "".join(R.FULL_WIDTH.values())) if name == "B" else F.substring("before", 1, 1) if new == "${mark}" else F.lit(new)
            after, reason = F.when(here, made).otherwise(after), F.when(here, why).otherwise(reason)
    return log.select("key", F.substring("rule", 1, 1).alias("rule"), "line", "before", after.alias("after"), reason.alias("reason"))


def edit_totals(df: DataFrame, text: str, rules: str = "ABCDEG") -> DataFrame:
    """rule, edits: how often each rule of a whole pass changes the texts."""
    staged, parts = _staged(df.select(F.col(text).alias("c0_")), rules)
    counts: dict[str, Column] = {}
    for i, (name, _, pattern) in enumerate(parts):
        counts[name] = counts.get(name, F.lit(0)) + F.regexp_count(f"c{i}_", F.lit(pattern))
    rows = staged.select(F.inline(F.array(*[F.struct(F.lit(name).alias("rule"), c.cast("long").alias("n")) for name, c in counts.items()])))
    return rows.groupBy("rule").agg(F.sum("n").alias("edits"))


def patch_once(c: Column, patches: list[tuple[str, Column]]) -> Column:
    """A text with the matches of several expressions replaced, as struct
    (text, failed).  Each must match exactly once; ``failed`` numbers (from 1)
    those that do not, and then the text is null.  In a replacement $1 is the
    first group."""
    out, failed = c, []
    for n, (pattern, new) in enumerate(patches, 1):
        failed.append(F.when(F.regexp_count(c, F.lit(pattern)) != 1, F.lit(n)))
        out = F.regexp_replace(out, F.lit(pattern), new)
    bad = F.array_compact(F.array(*failed))
    return F.struct(F.when(F.size(bad) == 0, out).alias("text"), bad.alias("failed"))


def swap_note(c: Column, old: str, new: str) -> Column:
    """The text with one note put in place of another: null unless it holds
    exactly one of the two, exactly once."""
    count = lambda x: F.regexp_count(c, F.lit("\\Q" + x + "\\E"))
    return F.when((count(old) == 1) & (count(new) == 0), F.replace(c, F.lit(old), F.lit(new))).when((count(old) == 0) & (count(new) == 1), c)


def review_problems(plans: DataFrame, documents: DataFrame) -> DataFrame:
    """Problems of review rows (path, text_hash, source_hash, page, replacement,
    approved, reviewer) against the documents now: 'unknown_path',
    'text_changed', 'source_changed', 'not_approved', 'no_reviewer',
    'empty_replacement', 'page_heading'."""
    now = documents.groupBy("path").agg(
        F.max(F.lower(F.trim("text_hash"))).alias("text_now"), F.max(F.lower(F.trim("source_hash"))).alias("source_now"), F.lit(True).alias("known")
    )
    codes = F.array_compact(
        F.array(
            F.when(F.col("known").isNull(), "unknown_path"),
            F.when(~F.lower(F.trim("text_hash")).eqNullSafe(F.col("text_now")), "text_changed"),
            F.when(~F.lower(F.trim("source_hash")).eqNullSafe(F.col("source_now")), "source_changed"),
            F.when(~F.coalesce("approved", F.lit(False)), "not_approved"),
            F.when(F.trim(F.coalesce("reviewer", F.lit(""))) == "", "no_reviewer"),
            F.when(F.trim(F.coalesce("replacement", F.lit(""))) == "", "empty_replacement"),
            F.when(F.col("replacement").rlike(r"(?m)^## Page \d+"), "page_heading"),
        )
    )
    return plans.join(now, "path", "left").select("review_id", F.explode(codes).alias("code"))


def plan_problems(plans: DataFrame, documents: DataFrame) -> DataFrame:
    """review_id, code of whole review plans (review_id, version, root, path,
    text_hash, source_hash) against the documents now (path, root, text_hash,
    source_hash, stated_hash, pages, headings).

    Codes: 'version', 'unknown_path', 'root', 'text_changed',
    'source_changed', 'provenance' (the text states another source),
    'page_sequence' (its page headings are not 1..n), 'page_count'.
    """
    plain = lambda c: F.lower(F.trim(c))
    now = documents.groupBy("path").agg(F.max_by(F.struct(*[c for c in documents.columns if c != "path"]), "text_hash").alias("now"))
    d = F.col("now")
    codes = F.array_compact(
        F.array(
            F.when(~F.col("version").eqNullSafe(1), "version"),
            F.when(d.isNull(), "unknown_path"),
            F.when(d.isNotNull() & ~F.col("root").eqNullSafe(d["root"]), "root"),
            F.when(d.isNotNull() & ~plain("text_hash").eqNullSafe(plain(d["text_hash"])), "text_changed"),
            F.when(d.isNotNull() & ~plain("source_hash").eqNullSafe(plain(d["source_hash"])), "source_changed"),
            F.when(d.isNotNull() & ~plain("source_hash").eqNullSafe(plain(d["stated_hash"])), "provenance"),
            F.when(d.isNotNull() & ~F.coalesce(d["headings"] == F.transform(d["headings"], lambda _, i: i + 1), F.lit(False)), "page_sequence"),
            F.when(d.isNotNull() & ~F.size(d["headings"]).eqNullSafe(d["pages"]), "page_count"),
        )
    )
    return plans.join(now, "path", "left").select("review_id", F.explode(codes).alias("code"))


def page_problems(plans: DataFrame, entries: DataFrame, evidence: DataFrame, files: DataFrame, pages: DataFrame) -> DataFrame:
    """review_id, page, code of the pages that plans select.

    entries: review_id, path, page, approved, reviewer, reason, replacement;
    evidence: review_id, page, path, hash; files: path, hash of what is there
    now; pages: path, page of the texts' pages.  Codes: 'no_pages' (page null),
    'unknown_page', 'double_page', 'not_approved', 'no_reviewer', 'no_reason',
    'no_evidence', 'evidence_changed', 'page_heading'.
    """
    blank = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == ""
    keys = ["review_id", "page"]
    there = pages.select("path", "page").distinct().withColumn("known", F.lit(True))
    shown = evidence.groupBy(*keys).agg(F.count("*").alias("shown"))
    single = (
        entries.join(there, ["path", "page"], "left")
        .join(shown, keys, "left")
        .select(
            *keys,
            F.array_compact(
                F.array(
                    F.when(F.col("known").isNull(), "unknown_page"),
                    F.when(~F.coalesce("approved", F.lit(False)), "not_approved"),
                    F.when(blank("reviewer"), "no_reviewer"),
                    F.when(blank("reason"), "no_reason"),
                    F.when(F.col("shown").isNull(), "no_evidence"),
                    F.when(F.col("replacement").rlike(r"(?m)^## Page \d+"), "page_heading"),
                )
            ).alias("codes"),
        )
        .select(*keys, F.explode("codes").alias("code"))
    )
    double = entries.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(*keys, F.lit("double_page").alias("code"))
    now = files.select("path", F.lower(F.trim("hash")).alias("now")).distinct()
    held = evidence.withColumn("now", F.lower(F.trim("hash"))).join(now, ["path", "now"], "left_anti")
    changed = held.select(*keys, F.lit("evidence_changed").alias("code")).distinct()
    none = plans.select("review_id").distinct().join(entries.select("review_id"), "review_id", "left_anti")
    empty = none.select("review_id", F.lit(None).cast(entries.schema["page"].dataType).alias("page"), F.lit("no_pages").alias("code"))
    return single.unionByName(double).unionByName(changed).unionByName(empty)


def receipts(before: DataFrame, after: DataFrame, key: str, text: str) -> DataFrame:
    """key, before_hash, after_hash, changed of edited texts."""
    b = before.select(key, F.sha2(text, 256).alias("before_hash"))
    return b.join(after.select(key, F.sha2(text, 256).alias("after_hash")), key).withColumn(
        "changed", ~F.col("before_hash").eqNullSafe(F.col("after_hash"))
    )


def job_id(*parts: Column) -> Column:
    """A stable id of a job from its parts, as sorted JSON."""
    named = [p.alias(f"p{i}") for i, p in enumerate(parts)]
    return F.substring(F.sha2(F.to_json(F.struct(*named)), 256), 1, 16)


def insert_or_replace(store: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The union, of equal keys the row that is last by ``order``; a new row
    wins over a stored one of equal order."""
    both = store.withColumn("n_", F.lit(0)).unionByName(new.withColumn("n_", F.lit(1)), allowMissingColumns=True)
    columns = [c for c in both.columns if c != "n_"]
    best = F.max_by(F.struct(*columns), F.struct(F.col(order).isNotNull(), order, "n_"))
    return both.groupBy(*[F.col(k).alias(f"k_{k}") for k in keys]).agg(best.alias("r")).select("r.*")


def insert_or_ignore(store: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return store.unionByName(new.join(store.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def rewritten_path(c: Column, moves: dict[str, str]) -> Column:
    """Literal replacements in order, then numbered names get two digits."""
    for old, new in moves.items():
        c = F.replace(c, F.lit(old), F.lit(new))
    return F.regexp_replace(c, r"/(\d)([-_.])", "/0$1$2")
