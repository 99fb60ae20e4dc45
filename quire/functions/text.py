"""Column expressions over Markdown, page texts, paths and ids.

All are built-in expressions that stay in generated code; nulls give nulls
unless a docstring says otherwise.  Regular expressions are Java's: ``(?U)``
makes ``\\s`` Unicode, ``(?d)`` makes ``$`` see line feeds only.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CJK = "\\x{4E00}-\\x{9FFF}\\x{3400}-\\x{4DBF}"
CJK_TOKEN = "\\x{3400}-\\x{9FFF}"
# Lines that stand for a page without text.
EMPTY_MARKERS = (
    "[本页未提取到文本，可能需要 OCR。]",
    "[本页 OCR 未识别到文本，请对照原始 PDF。]",
    "[经原始 PDF 视觉核验，本页无独立正文（空白页或背页透印）。]",
)
WARNING_PREFIX = "> [!warning] 本页"
# Words that no search is made for.
STOPWORDS = "的 了 是 在 和 与 及 或 对 由 将 这 那 一个 一种".split()
PRIMARY_KINDS = ("article", "course")
# What keys and tokens of services look like.
SECRETS = (
    r"\bgh[pousr]_[A-Za-z0-9_]{20,}\b",
    r"\bsk-[A-Za-z0-9_-]{20,}\b",
    r"(?i)\b(?:api[_-]?key|token|secret)\s*[:=]\s*[\"']?[A-Za-z0-9_-]{20,}",
)


def _quote(s: str) -> str:
    return "\\Q" + s + "\\E"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def newlines(c: Column) -> Column:
    return F.regexp_replace(c, "\r\n?", "\n")


# -- frontmatter ------------------------------------------------------------
def frontmatter(c: Column) -> Column:
    """The block between a first line '---' and the next line '---', or ''."""
    return F.regexp_extract(newlines(c), r"(?s)\A---\n(.*?)\n---(?:\n|\z)", 1)


def body(c: Column) -> Column:
    """The text after the frontmatter; the whole text without one."""
    return F.regexp_replace(newlines(c), r"(?s)\A---\n.*?\n---(?:\n|\z)", "")


def frontmatter_map(c: Column) -> Column:
    """key -> value of unindented 'key: value' lines, quotes stripped; the
    last of equal keys counts.  No frontmatter: an empty map."""
    lines = F.filter(F.split(frontmatter(c), "\n"), lambda x: x.rlike(r"^[^\s:#][^:]*:"))
    entries = F.transform(
        lines,
        lambda x, i: F.struct(
            F.trim(F.regexp_extract(x, r"^([^:]+):", 1)).alias("key"),
            i.alias("i"),
            F.regexp_replace(F.trim(F.regexp_extract(x, r"^[^:]+:(.*)$", 1)), r"^[\"'](.*)[\"']$", "$1").alias("value"),
        ),
    )
    # sorted by key and place, the last of each key is the one before another key
    last = let(
        F.array_sort(entries),
        lambda e: F.filter(e, lambda x, i: ~F.coalesce(F.get(e, i + 1)["key"] == x["key"], F.lit(False))),
    )
    return F.map_from_entries(F.transform(last, lambda e: F.struct(e["key"], e["value"])))


def frontmatter_lenient(c: Column) -> Column:
    """For blocks that are no valid scalar frontmatter: the 'key: value' pairs
    of lower-case keys that can be recovered, as 'key=value'."""
    keys = F.regexp_extract_all(frontmatter(c), F.lit(r"(?m)^([a-z0-9_]+):[ \t]*(.*)$"), F.lit(1))
    values = F.regexp_extract_all(frontmatter(c), F.lit(r"(?m)^([a-z0-9_]+):[ \t]*(.*)$"), F.lit(2))
    return F.zip_with(keys, values, lambda k, v: F.concat(k, F.lit("="), F.trim(v)))


# -- cleaning ---------------------------------------------------------------
def without_space(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+", "")


def clean(c: Column) -> Column:
    """Without placeholder lines and without any white space."""
    markers = "|".join(_quote(m) for m in EMPTY_MARKERS)
    return without_space(F.regexp_replace(c, f"(?md)^(?:{markers})$", ""))


def compact_length(c: Column) -> Column:
    return F.length(without_space(c))


def clean_scan(c: Column, watermark: Column | None = None) -> Column:
    """One kind of line end, no trailing blanks, no watermark lines, at most
    one blank line in a row, none outside."""
    lines = F.transform(F.split(newlines(c), "\n"), lambda x: F.regexp_replace(x, r"(?U)\s+$", ""))
    if watermark is not None:
        mark = F.lower(F.trim(watermark))
        strip = lambda x: F.lower(F.regexp_replace(x, r"(?U)^\s+", ""))
        lines = F.filter(lines, lambda x: mark.isNull() | (mark == "") | (strip(x) != mark))
    text = F.regexp_replace(F.array_join(lines, "\n"), "\n{3,}", "\n\n")
    return F.regexp_replace(text, r"(?U)\A\s+|\s+\z", "")


def clean_native(c: Column) -> Column:
    """``clean_scan`` without placeholder and generated warning lines."""
    lines = F.filter(
        F.split(clean_scan(c), "\n"),
        lambda x: ~F.trim(x).isin(*EMPTY_MARKERS) & ~F.trim(x).startswith(WARNING_PREFIX),
    )
    return clean_scan(F.array_join(lines, "\n"))


def longer_scan(native: Column, scan: Column, threshold: Column | int = 50) -> Column:
    """Of two cleaned texts, whether the scanned one is taken: the native one
    is short and the scanned one is longer."""
    n, s = compact_length(native), compact_length(scan)
    threshold = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return (n < threshold) & (s > n)


def with_hybrid(df: DataFrame, native: str, scan: str, threshold: Column | int = 50, taken: str = "from_scan", text: str = "hybrid_text") -> DataFrame:
    """Adds whether the scanned text is taken, and the text taken.  Each text
    is cleaned once; nulls count as empty."""
    empty = F.lit("")
    cleaned = df.withColumns({"nat_": clean_native(F.coalesce(native, empty)), "scan_": clean_scan(F.coalesce(scan, empty))})
    decided = cleaned.withColumn(taken, longer_scan(F.col("nat_"), F.col("scan_"), threshold))
    return decided.withColumn(text, F.when(F.col(taken), F.col("scan_")).otherwise(F.col("nat_"))).drop("nat_", "scan_")


def prefers_scan(native: Column, scan: Column, threshold: Column | int = 50) -> Column:
    """``longer_scan`` of the cleaned texts.  Nulls count as empty."""
    empty = F.lit("")
    return longer_scan(clean_native(F.coalesce(native, empty)), clean_scan(F.coalesce(scan, empty)), threshold)


def hybrid(native: Column, scan: Column, threshold: Column | int = 50) -> Column:
    empty = F.lit("")
    return F.when(prefers_scan(native, scan, threshold), clean_scan(F.coalesce(scan, empty))).otherwise(
        clean_native(F.coalesce(native, empty))
    )


def without_code(c: Column) -> Column:
    """Without fenced code blocks."""
    c = F.regexp_replace(c, r"(?ms)^[ \t]*```.*?^[ \t]*```[^\n]*$", "")
    return F.regexp_replace(c, r"(?ms)^[ \t]*~~~.*?^[ \t]*~~~[^\n]*$", "")


# -- links ------------------------------------------------------------------
def _decoded(c: Column) -> Column:
    """Percent-decoding that leaves '+' and undecodable text alone."""
    plain = F.replace(c, F.lit("+"), F.lit("%2B"))
    return F.coalesce(F.try_url_decode(plain), c)


def wiki_targets(c: Column) -> Column:
    """Targets of [[target|alias#anchor]] links: decoded, slashes forward, no
    '.md', no outer slashes; empty ones left out."""
    raw = F.regexp_extract_all(without_code(c), F.lit(r"\[\[([^\]]+)\]\]"), F.lit(1))
    target = F.transform(
        raw,
        lambda x: F.regexp_replace(
            F.regexp_replace(
                F.replace(_decoded(F.trim(F.substring_index(F.substring_index(x, "|", 1), "#", 1))), F.lit("\\"), F.lit("/")),
                r"\.md$",
                "",
            ),
            r"^/+|/+$",
            "",
        ),
    )
    return F.filter(target, lambda x: x != "")


def markdown_targets(c: Column) -> Column:
    """Targets of [text](target) links to Markdown files, decoded."""
    raw = F.regexp_extract_all(without_code(c), F.lit(r"!?\[[^\]]*\]\((<[^>]+>|[^)]+)\)"), F.lit(1))
    plain = F.transform(
        raw, lambda x: _decoded(F.substring_index(F.regexp_replace(F.trim(x), r"^<|>$", ""), "#", 1))
    )
    return F.filter(
        plain, lambda x: (x != "") & ~x.rlike(r"(?i)^(?:https?:|mailto:)") & F.lower(x).endswith(".md")
    )


def normal_path(base: Column, target: Column) -> Column:
    """target seen from the folder ``base``: '.' and '..' resolved; null if it
    leaves the root."""
    parts = F.split(
        F.when(target.startswith("/"), target).otherwise(F.concat_ws("/", base, target)), "/"
    )
    start = F.struct(F.array().cast("array<string>").alias("at"), F.lit(False).alias("out"))
    done = F.aggregate(
        parts,
        start,
        lambda s, p: F.when((p == "") | (p == "."), s)
        .when(
            p == "..",
            F.struct(
                F.when(F.size(s["at"]) > 0, F.slice(s["at"], 1, F.greatest(F.size(s["at"]) - 1, F.lit(0)))).otherwise(s["at"]).alias("at"),
                (s["out"] | (F.size(s["at"]) == 0)).alias("out"),
            ),
        )
        .otherwise(F.struct(F.concat(s["at"], F.array(p)).alias("at"), s["out"].alias("out"))),
    )
    return F.when(~done["out"], F.array_join(done["at"], "/"))


# -- tokens and sentences -----------------------------------------------------
def token_estimate(c: Column) -> Column:
    """Each Chinese character 1, each run of ASCII letters, digits and
    underscores a quarter of its length rounded up, any other visible 1."""
    found = F.regexp_extract_all(c, F.lit(rf"(?U)[{CJK_TOKEN}]|[A-Za-z0-9_]+|[^\s]"), F.lit(0))
    return F.aggregate(
        found,
        F.lit(0),
        lambda n, w: n
        + F.when(w.rlike(r"^[A-Za-z0-9_]"), F.ceil(F.length(w) / 4).cast("int")).otherwise(F.lit(1)),
    )


def sentence_pieces(c: Column) -> Column:
    """Pieces after 。！？!?；; and line feeds, marks kept, blanks trimmed."""
    pieces = F.transform(F.split(c, r"(?<=[。！？!?；;\n])"), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", ""))
    return F.filter(pieces, lambda x: x != "")


def _plain_letters() -> tuple[str, str]:
    """Lower-case Latin letters with marks, and the letters without them."""
    pairs = []
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        d = unicodedata.normalize("NFD", chr(code))
        if len(d) > 1 and d[0].isascii() and chr(code).islower() and len(chr(code)) == 1:
            pairs.append((chr(code), d[0]))
    return "".join(x for x, _ in pairs), "".join(y for _, y in pairs)


MARKED, UNMARKED = _plain_letters()


def search_tokens(c: Column) -> Column:
    """Lower-case words of any script, Latin ones without accents, and the
    overlapping pairs of Chinese characters that stand for words where no
    dictionary is at hand."""
    text = F.translate(F.lower(c), MARKED, UNMARKED)
    words = F.regexp_extract_all(text, F.lit(rf"[\p{{L}}\p{{M}}\p{{N}}&&[^{CJK_TOKEN}]]+"), F.lit(0))
    pairs = F.regexp_extract_all(text, F.lit(rf"(?=([{CJK_TOKEN}]{{2}}))"), F.lit(1))
    return F.filter(F.concat(words, pairs), lambda w: ~w.isin(*STOPWORDS))


def excerpt(c: Column, length: int = 240) -> Column:
    return F.substring(F.regexp_replace(F.regexp_replace(c, r"(?U)\s+", " "), "^ | $", ""), 1, length)


# -- ids and names ------------------------------------------------------------
def document_id(path: Column) -> Column:
    return F.substring(F.sha2(path, 256), 1, 24)


def chunk_id(path: Column, section: Column, page: Column, ordinal: Column, content_hash: Column) -> Column:
    """Page 0 and no page are one; null parts count as empty."""
    part = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    joined = F.concat_ws(
        "\x00", part(path), part(section), part(F.nullif(page, F.lit(0))), part(ordinal), part(content_hash)
    )
    return F.substring(F.sha2(joined, 256), 1, 32)


def safe_name(c: Column) -> Column:
    return F.regexp_replace(F.trim(F.regexp_replace(c, r'[<>:"/\\|?*]', "_")), " ", "_")


def book_id(stem: Column, digest: Column) -> Column:
    """First 32 characters of the cleaned stem and 12 hex digits."""
    clean_stem = F.regexp_replace(stem, r"[^0-9A-Za-z\x{3400}-\x{9FFF}]+", "_")
    return F.concat(F.substring(clean_stem, 1, 32), F.lit("_"), F.upper(F.substring(digest, 1, 12)))


def page_name(title: Column, page: Column) -> Column:
    return F.concat(safe_name(title), F.lit("_"), F.format_string("%03d", page), F.lit(".txt"))


def output_path(path: Column, layer: str = "成稿") -> Column:
    """The second folder replaced, the suffix '.md' put in place."""
    parts = F.split(path, "/")
    new = F.transform(parts, lambda p, i: F.when(i == 1, F.lit(layer)).otherwise(p))
    return F.regexp_replace(F.array_join(new, "/"), r"\.[^./]+$", ".md")


def in_layer(path: Column, layers: list[str]) -> Column:
    return F.arrays_overlap(F.split(path, "/"), F.array(*[F.lit(x) for x in layers]))


def path_state(path: Column, root: str, layer: str, original: str, suffix: str = ".md") -> Column:
    """'ok', or why a path may not be edited: 'outside' the root (or leaving
    it), 'not_in_layer', 'original' or 'suffix'."""
    parts = F.split(path, "/")
    return (
        F.when(path.isNull() | ~path.startswith(root.rstrip("/") + "/") | F.array_contains(parts, "..") , "outside")
        .when(~F.array_contains(parts, layer), "not_in_layer")
        .when(F.array_contains(parts, original), "original")
        .when(~F.lower(path).endswith(suffix), "suffix")
        .otherwise("ok")
    )


def protected_part(path: Column, c: Column, head: str, start: str, end: str) -> Column:
    """What an edit must leave as it is: for paths under ``head`` the text
    before the start marker, under 'course' what is between both markers, else
    all."""
    return (
        F.when(path.contains(head), F.substring_index(c, start, 1))
        .when(path.contains("课程"), F.substring_index(F.substring_index(c, end, 1), start, -1))
        .otherwise(c)
    )


# -- flags --------------------------------------------------------------------
def diagnostics(c: Column) -> Column:
    """Names of the faults of an extracted text, in fixed order."""
    return F.array_compact(
        F.array(
            F.when(c.rlike(r"/G[0-9A-Fa-f]{2,}"), "glyph_encoding"),
            F.when(c.contains("�"), "replacement_character"),
            F.when(c.rlike(r"[\x00-\x08\x0B\x0C\x0E-\x1F]"), "control_character"),
        )
    )


def has_secret(c: Column) -> Column:
    out = F.lit(False)
    for pattern in SECRETS:
        out = out | c.rlike(pattern)
    return out


def sensitive_name(path: Column) -> Column:
    name = F.element_at(F.split(path, "/"), -1)
    return (name == ".env") | (name == ".github.env") | (name.startswith(".env.") & (name != ".env.example"))


def marker_state(c: Column, start: str, end: str) -> Column:
    """'ok', 'marker_count' (not exactly one of each) or 'marker_order'."""
    count = lambda m: F.regexp_count(c, F.lit(_quote(m)))
    return (
        F.when((count(start) != 1) | (count(end) != 1), "marker_count")
        .when(F.locate(start, c) > F.locate(end, c), "marker_order")
        .otherwise("ok")
    )


def compare_texts(a: Column, b: Column) -> Column:
    """Five-way comparison that looks through layout; nulls count as empty."""
    a, b = (clean(F.coalesce(x, F.lit(""))) for x in (a, b))
    return (
        F.when((a == "") & (b == ""), "both_empty_requires_visual_or_ocr")
        .when(a == "", "text_missing_native_available")
        .when(b == "", "source_image_requires_visual")
        .when(a == b, "exact_after_layout_whitespace_only")
        .otherwise("character_difference_requires_review")
    )


def compare_scored(a: Column, b: Column, score: Column) -> Column:
    """Seven-way comparison with a similarity; nulls count as empty."""
    a, b = (clean(F.coalesce(x, F.lit(""))) for x in (a, b))
    return (
        F.when((a == "") & (b == ""), "both_empty")
        .when(a == "", "text_layer_missing")
        .when(b == "", "recognition_missing")
        .when(a == b, "exact_ignoring_layout_whitespace")
        .when(score >= 0.98, "near_match_review")
        .when(score >= 0.90, "difference_review")
        .otherwise("major_difference_review")
    )


# Lengths at which recalled texts are cut, and facts shown.
SUMMARY, SUBJECT, FACT, FACTS = 300, 80, 150, 2


def recalled(at: Column, subject: Column, summary: Column, facts: Column) -> Column:
    """The lines that show one recalled episode: its date, subject and summary,
    then its first facts; an empty array if it has neither.  facts: an array
    of texts."""
    cut = lambda c, n: F.substring(F.trim(F.coalesce(c, F.lit(""))), 1, n)
    s, m = cut(subject, SUBJECT), cut(summary, SUMMARY)
    head = F.concat(F.lit("- [情景 "), F.substring(F.coalesce(at.cast("string"), F.lit("")), 1, 10), F.lit("] "), s, F.lit("："), m)
    shown = F.filter(F.transform(F.slice(F.coalesce(facts, F.array().cast("array<string>")), 1, FACTS), lambda f: cut(f, FACT)), lambda f: f != "")
    lines = F.concat(F.array(head), F.transform(shown, lambda f: F.concat(F.lit("- [事实] "), f)))
    return F.when((s == "") & (m == ""), F.array().cast("array<string>")).otherwise(lines)


def question_kind(c: Column) -> Column:
    """Kind of a question by the first keyword list with a hit."""
    # Words of each kind, in order.
    kinds = (
        ("knowledge_search", "查找|搜索|检索|查询"),
        ("knowledge_organize", "整理|组织|分类|归纳"),
        ("database_create", "创建base|数据库|表|视图"),
        ("document_edit", "编辑|修改|添加|删除"),
        ("system_maintenance", "检查|维护|验证|清理"),
    )
    q = F.lower(c)
    out = F.when(q.isNull(), F.lit(None).cast("string"))
    for name, words in kinds:
        out = out.when(q.rlike(words), name)
    return out.otherwise("knowledge_search")
