"""Named queries over the tables, each with its SQL where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import rewrite as R
from ..functions import text as X
from ..operators import audit, compare, ingest, ledger, retrieval, review, validate
from ..operators.ordering import placed
from ..session import spread, table
from ..streaming import events as streams
from . import sqltext as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
LONG = "long"


TEXTS = ("pages", "chunks")


def query(sql: str | None = None):
    """Registers a function under its name, with its SQL.  Tables of texts are
    worked on by all cores, however few files they lie in."""

    def source(spark: SparkSession, sf: str):
        return lambda name: spread(table(spark, sf, name)) if name in TEXTS else table(spark, sf, name)

    def add(f):
        QUERIES[f.__name__] = lambda spark, sf: f(source(spark, sf))
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def n(c):
    return c.cast(LONG)


# -- retrieval ----------------------------------------------------------------
QUESTION = "流动性溢价 hedging allocation 資本 Kapitalbindung"
_TEXT = "concat_ws(chr(10), title, section, content)"


@query(f"""
WITH t AS (SELECT chunk_key, {S.tokens(_TEXT)} AS w FROM chunks),
st AS (SELECT count(*) AS n, avg(len(w)) AS average FROM t),
q AS (SELECT DISTINCT unnest({S.tokens(S.literal(QUESTION))}) AS term),
tf AS (SELECT chunk_key, term, len(w) AS length, len(list_filter(w, lambda x: x = term)) AS tf
       FROM t, q WHERE list_contains(w, term)),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
sc AS (SELECT chunk_key, sum(greatest(ln((n - df + 0.5) / (df + 0.5)), 1e-6) * tf * 2.2
         / (tf + 1.2 * (0.25 + 0.75 * length / average))) AS score
       FROM tf JOIN df USING (term), st GROUP BY chunk_key)
SELECT chunk_key, path, source_kind, round(score, 6) AS score,
  row_number() OVER (ORDER BY CASE WHEN source_kind IN ('article', 'course') THEN 0 ELSE 1 END,
    round(score, 6) DESC, path, ordinal, chunk_key) AS rank
FROM sc JOIN chunks USING (chunk_key) ORDER BY rank LIMIT 20""")
def retrieval_topk(t):
    chunks = t("chunks")
    spark = chunks.sparkSession
    index, statistics = retrieval.scan_index(chunks, QUESTION)
    scores = retrieval.bm25(index, statistics, retrieval.query_terms(spark, QUESTION))
    return retrieval.top_k(chunks, scores, 20).select("chunk_key", "path", "source_kind", "score", n(F.col("rank")).alias("rank"))


@query(f"""
SELECT term, count(DISTINCT chunk_key) AS df, count(*) AS cf FROM
  (SELECT chunk_key, unnest({S.tokens(_TEXT)}) AS term FROM chunks) GROUP BY term""")
def index_terms(t):
    p = retrieval.postings(t("chunks"))
    return p.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


@query(f"SELECT book_id, array_to_string(list_sort(list_distinct({S.tokens('title')})), ' ') AS terms FROM books")
def search_terms(t):
    terms = F.array_sort(F.array_distinct(X.search_tokens(F.col("title"))))
    return t("books").select("book_id", F.array_join(terms, " ").alias("terms"))


@query("""SELECT (SELECT count(*) FROM documents) AS documents,
  (SELECT coalesce(sum(length(text)), 0)::BIGINT FROM documents) AS characters, (SELECT count(*) FROM chunks) AS chunks""")
def retrieval_index_stats(t):
    return retrieval.index_stats(t("documents"), t("chunks"))


@query("""
SELECT doc_id, substr(sha256(path), 1, 24) AS document_id,
  substr(sha256(concat(path, chr(0), coalesce(title, ''), chr(0), '', chr(0), '1', chr(0), coalesce(sha256(text), ''))), 1, 32) AS chunk_id
FROM documents""")
def document_ids(t):
    return t("documents").select(
        "doc_id",
        X.document_id(F.col("path")).alias("document_id"),
        X.chunk_id(F.col("path"), F.col("title"), F.lit(0), F.lit(1), F.sha2("text", 256)).alias("chunk_id"),
    )


@query(f"SELECT chunk_key, ({S.estimate('content')})::BIGINT AS estimate, token_count::BIGINT AS stored FROM chunks")
def token_estimate(t):
    return t("chunks").select(
        "chunk_key", n(X.token_estimate(F.col("content"))).alias("estimate"), n(F.col("token_count")).alias("stored")
    )


@query(f"SELECT chunk_key, substr(regexp_replace(regexp_replace(content, '{S.WS}+', ' ', 'g'), '^ | $', '', 'g'), 1, 240) AS excerpt FROM chunks")
def search_excerpt(t):
    return t("chunks").select("chunk_key", X.excerpt(F.col("content")).alias("excerpt"))


@query(None)
def chunk_documents(t):
    return retrieval.chunk_markdown(t("documents"), title="title")


@query("""
SELECT source, count(*) AS documents, count(*) FILTER (confidence IS NULL) AS defaulted,
  count(*) FILTER (coalesce(confidence, CASE WHEN source IN ('article', 'course') THEN 'high'
    WHEN source = 'practice_transcript' THEN 'low' ELSE 'medium' END) = 'high') AS high
FROM documents GROUP BY source""")
def collection_confidence(t):
    default = F.when(F.col("source").isin(*X.PRIMARY_KINDS), "high").when(F.col("source") == "practice_transcript", "low").otherwise("medium")
    return t("documents").groupBy("source").agg(
        F.count("*").alias("documents"),
        F.count_if(F.col("confidence").isNull()).alias("defaulted"),
        F.count_if(F.coalesce("confidence", default) == "high").alias("high"),
    )


# -- Markdown -----------------------------------------------------------------
@query(f"SELECT doc_id, {S.front('text')} AS front, length({S.body('text')})::BIGINT AS body_chars FROM documents")
def frontmatter_split(t):
    c = F.col("text")
    return t("documents").select("doc_id", X.frontmatter(c).alias("front"), n(F.length(X.body(c))).alias("body_chars"))


@query(f"""
WITH l AS (SELECT doc_id, unnest(list_filter(string_split({S.front('text')}, chr(10)),
    lambda x: regexp_matches(x, '^[^\\s:#][^:]*:'))) AS x FROM documents)
SELECT doc_id, trim(regexp_extract(x, '^([^:]+):', 1)) AS key,
  regexp_replace(trim(regexp_extract(x, '^[^:]+:(.*)$', 1)), '^["''](.*)["'']$', '\\1') AS value FROM l""")
def frontmatter_fields(t):
    return t("documents").select("doc_id", F.explode(X.frontmatter_map(F.col("text"))).alias("key", "value"))


@query(f"""
SELECT doc_id, unnest(list_transform(list_zip(
    regexp_extract_all({S.front('text')}, '(?m)^([a-z0-9_]+):[ \\t]*(.*)$', 1),
    regexp_extract_all({S.front('text')}, '(?m)^([a-z0-9_]+):[ \\t]*(.*)$', 2)), lambda z: z[1] || '=' || trim(z[2]))) AS pair FROM documents""")
def frontmatter_recovered(t):
    return t("documents").select("doc_id", F.explode(X.frontmatter_lenient(F.col("text"))).alias("pair"))


_PARTS = "regexp_replace({b}, '(?m)^(## Page \\d+[ \\t]*)$', chr(1) || '\\1', 'g')"


@query(f"""
WITH p AS (SELECT doc_id, unnest(string_split({_PARTS.format(b=S.body('text'))}, chr(1))[2:]) AS part FROM documents)
SELECT doc_id, regexp_extract(part, '\\A## Page (\\d+)', 1)::INT AS page,
  {S.clean_native("regexp_replace(part, '\\A## Page \\d+[ \\t]*\\n?', '')")} AS page_text FROM p""")
def markdown_pages(t):
    return ingest.pages_of_markdown(t("documents"), "doc_id")


@query(f"""
WITH l AS (SELECT doc_id, unnest(string_split({S.body('text')}, chr(10))) AS x, generate_subscripts(string_split({S.body('text')}, chr(10)), 1) AS i FROM documents),
h AS (SELECT doc_id, i, length(regexp_extract(x, '^(#{{1,6}})\\s+.+$', 1)) AS level, regexp_extract(x, '^#{{1,6}}\\s+(.+?)\\s*$', 1) AS heading FROM l WHERE regexp_matches(x, '^#{{1,6}}\\s+.'))
SELECT doc_id, count(*) AS headings, min(heading) FILTER (level = 1 AND i = f) AS title, count(*) FILTER (level = 2 AND regexp_matches(heading, '(?i)^page\\s+\\d+$')) AS pages
FROM (SELECT *, min(CASE WHEN level = 1 THEN i END) OVER (PARTITION BY doc_id) AS f FROM h) GROUP BY doc_id""")
def headings(t):
    h = ingest.headings(t("documents"), "doc_id")
    return h.groupBy("doc_id").agg(
        F.count("*").alias("headings"),
        F.min_by("heading", F.when(F.col("level") == 1, F.col("i"))).alias("title"),
        F.count_if((F.col("level") == 2) & F.col("heading").rlike(r"(?i)^page\s+\d+$")).alias("pages"),
    )


@query(f"""
WITH p AS (SELECT chunk_key, unnest(string_split(regexp_replace(content, '([。！？!?；;\\n])', '\\1' || chr(1), 'g'), chr(1))) AS x FROM chunks)
SELECT chunk_key, count(*) AS pieces, max(length({S.strip('x')}))::BIGINT AS longest FROM p WHERE {S.strip('x')} <> '' GROUP BY chunk_key""")
def sentence_pieces(t):
    p = t("chunks").select("chunk_key", F.explode(X.sentence_pieces(F.col("content"))).alias("x"))
    return p.groupBy("chunk_key").agg(F.count("*").alias("pieces"), n(F.max(F.length("x"))).alias("longest"))


# -- cleaning -----------------------------------------------------------------
@query(f"""SELECT page_key, {S.clean_scan('text_layer', 'watermark')} AS cleaned
FROM pages LEFT JOIN books USING (book_id) WHERE text_layer IS NOT NULL""")
def clean_text(t):
    # the book table is small; Spark broadcasts it if its size allows
    p = t("pages").where("text_layer IS NOT NULL").join(t("books").select("book_id", "watermark"), "book_id", "left")
    return p.select("page_key", X.clean_scan(F.col("text_layer"), F.col("watermark")).alias("cleaned"))


@query(f"SELECT page_key, length({S.squeeze('text_layer')})::BIGINT AS size, {S.clean('text_layer')} AS plain FROM pages")
def compact_length(t):
    c = F.col("text_layer")
    return t("pages").select("page_key", n(X.compact_length(c)).alias("size"), X.clean(c).alias("plain"))


_NAT, _SCAN = S.clean_native("coalesce(native_text, '')"), S.clean_scan("coalesce(text_layer, '')")
_PICK = f"""WITH c AS (SELECT p.*, review_threshold AS th, {_NAT} AS nat, {_SCAN} AS sc FROM pages p LEFT JOIN books USING (book_id)),
d AS (SELECT *, length({S.squeeze('nat')}) < th AND length({S.squeeze('sc')}) > length({S.squeeze('nat')}) AS scan FROM c)"""


@query(f"{_PICK} SELECT page_key, coalesce(scan, false) AS from_scan, CASE WHEN scan THEN sc ELSE nat END AS text FROM d")
def hybrid_select(t):
    p = t("pages").join(t("books").select("book_id", "review_threshold"), "book_id", "left")
    out = X.with_hybrid(p, "native_text", "text_layer", F.col("review_threshold"))
    return out.select("page_key", F.coalesce("from_scan", F.lit(False)).alias("from_scan"), F.col("hybrid_text").alias("text"))


def _lists(t):
    """Manual, blank and short lists as the table itself gives them."""
    p = t("pages")
    manual = p.where("result = 'character_difference_requires_review' AND page = 1").groupBy("book_id", "page").agg(F.min("native_text").alias("text"))
    blank = p.where("result = 'both_empty_requires_visual_or_ocr'").select("book_id", "page")
    short = p.where("result = 'source_image_requires_visual' AND text_chars < 50").select("book_id", "page")
    return manual, blank, short


_LISTS = """man AS (SELECT book_id, page, min(native_text) AS mt FROM pages
  WHERE result = 'character_difference_requires_review' AND page = 1 GROUP BY ALL),
bl AS (SELECT DISTINCT book_id, page FROM pages WHERE result = 'both_empty_requires_visual_or_ocr'),
sh AS (SELECT DISTINCT book_id, page FROM pages WHERE result = 'source_image_requires_visual' AND text_chars < 50)"""


@query(f"""{_PICK}, {_LISTS},
e AS (SELECT d.*, mt, bl.page IS NOT NULL AS isb, sh.page IS NOT NULL AS iss FROM d LEFT JOIN man USING (book_id, page)
  LEFT JOIN bl USING (book_id, page) LEFT JOIN sh USING (book_id, page)),
f AS (SELECT *, CASE WHEN mt IS NOT NULL THEN {S.clean_scan('mt')} WHEN isb THEN '' WHEN scan THEN sc ELSE nat END AS ft FROM e)
SELECT page_key, CASE WHEN mt IS NOT NULL THEN 'manual' WHEN isb THEN 'blank' WHEN scan THEN 'scan' ELSE 'native' END AS origin,
  length(ft)::BIGINT AS chars, NOT (mt IS NOT NULL OR isb OR iss) AND length({S.squeeze('ft')}) < th AS needs_review FROM f""")
def page_coalesce(t):
    p = t("pages").join(t("books").select("book_id", "review_threshold"), "book_id", "left")
    out = ingest.coalesce_pages(p, *_lists(t), F.col("review_threshold"))
    return out.select("page_key", "origin", n(F.length("final_text")).alias("chars"), "needs_review")


@query(f"""WITH {_LISTS}, a AS (SELECT book_id, page, 'manual' AS l FROM man UNION ALL SELECT *, 'blank' FROM bl UNION ALL SELECT *, 'short' FROM sh)
SELECT book_id, page, 'overlap' AS code FROM (SELECT DISTINCT * FROM a) GROUP BY book_id, page HAVING count(*) > 1
UNION ALL SELECT DISTINCT book_id, a.page, 'out_of_range' FROM a LEFT JOIN books USING (book_id)
  WHERE expected_pages IS NULL OR a.page < 1 OR a.page > expected_pages
UNION ALL SELECT book_id, page, 'manual_empty' FROM man WHERE length({S.squeeze("coalesce(mt, '')")}) = 0""")
def list_conflicts(t):
    books = t("books").select("book_id", F.col("expected_pages").alias("pages"))
    return ingest.list_conflicts(*_lists(t), books)


@query(f"""SELECT book_id, count(*) AS pages, count(*) FILTER (length({S.squeeze("coalesce(text_layer, '')")}) > 0) AS text_pages,
  sum(length(coalesce(text_layer, '')))::BIGINT AS characters, sum(length({S.squeeze("coalesce(text_layer, '')")}))::BIGINT AS visible_characters
FROM pages GROUP BY book_id""")
def text_statistics(t):
    return ingest.text_statistics(t("pages"), "book_id", "text_layer")


@query(None)
def compose_layers(t):
    p = t("pages").select("book_id", "path", "page", X.hybrid(F.col("native_text"), F.col("text_layer")).alias("final_text"))
    return ingest.compose_text_layer(p, "path")


# -- proofreading -------------------------------------------------------------
_COUNTS = {
    "inner_spaces": S.count("c", f"{S.CJK} {S.CJK}"),
    "half_width": S.count("c", f"{S.CJK}[(),.;:?!]"),
    "repeated": S.count("c", "|".join(f"(?:{m}{m}+)" for m in ("。", "，", "、", "；", "：", "？", "！", ",", r"\.", ";", ":", r"\?", "!", "“", "”"))),
    "footers": S.count("c", r"(?m)^第\s*\d+\s*页[\s/上中下]*$|^-\s*\d+\s*-\s*$|^\d+/\d+$"),
    "suspects": "length(c) - length(translate(c, '砚口义巳已目戡仁场习丽宫乾趴讥翻戍芸', ''))",
    "wide_spaces": S.count("c", r"\x{3000}"),
    "invisible": S.count("c", r"[\x{200B}-\x{200D}\x{2060}\x{FEFF}]"),
}
_COUNTERS = {
    "inner_spaces": R.count_inner_spaces, "half_width": R.count_half_width, "repeated": R.count_repeated,
    "footers": R.count_footers, "suspects": R.count_suspects, "wide_spaces": R.count_wide_spaces, "invisible": R.count_invisible,
}
_PAGES_C = "(SELECT page_key, path, lang, text_layer AS c FROM pages WHERE text_layer IS NOT NULL)"


@query(f"SELECT page_key, {', '.join(f'({s})::BIGINT AS {k}' for k, s in _COUNTS.items())} FROM {_PAGES_C}")
def scan_counters(t):
    c = F.col("text_layer")
    return t("pages").where(c.isNotNull()).select("page_key", *[n(f(c)).alias(k) for k, f in _COUNTERS.items()])


@query(f"SELECT count(*) AS pages, sum(length(c))::BIGINT AS chars, {', '.join(f'sum({s})::BIGINT AS {k}' for k, s in _COUNTS.items())} FROM {_PAGES_C}")
def scan_totals(t):
    c = F.col("text_layer")
    return t("pages").where(c.isNotNull()).agg(
        F.count("*").alias("pages"), F.sum(F.length(c)).alias("chars"), *[F.sum(n(f(c))).alias(k) for k, f in _COUNTERS.items()]
    )


@query(f"""SELECT path, sum({_COUNTS['footers']} + {_COUNTS['invisible']})::BIGINT AS noise FROM {_PAGES_C}
GROUP BY path HAVING sum({_COUNTS['footers']} + {_COUNTS['invisible']}) > 0 ORDER BY path LIMIT 30""")
def noisy_files(t):
    noise = R.count_footers(F.col("text_layer")) + R.count_invisible(F.col("text_layer"))
    return (
        t("pages").where("text_layer IS NOT NULL").groupBy("path").agg(F.sum(n(noise)).alias("noise"))
        .where("noise > 0").orderBy("path").limit(30)
    )


_PAIRS = f"""WITH m AS (SELECT path, unnest(regexp_extract_all(c, '({S.CJK}) {S.CJK}', 1)) AS a, unnest(regexp_extract_all(c, '{S.CJK} ({S.CJK})', 1)) AS b FROM {_PAGES_C}),
f AS (SELECT path, a || b AS pair, count(*) AS n FROM m GROUP BY ALL)"""


def _pairs(t):
    c = F.col("text_layer")
    both = F.arrays_zip(
        F.regexp_extract_all(c, F.lit(f"([{X.CJK}]) [{X.CJK}]"), F.lit(1)).alias("a"),
        F.regexp_extract_all(c, F.lit(f"[{X.CJK}] ([{X.CJK}])"), F.lit(1)).alias("b"),
    )
    m = t("pages").where(c.isNotNull()).select("path", F.explode(both).alias("p"))
    return m.groupBy("path", F.concat("p.a", "p.b").alias("pair")).agg(F.count("*").alias("n"))


@query(f"{_PAIRS} SELECT pair, sum(n)::BIGINT AS n FROM f GROUP BY pair ORDER BY n DESC, pair LIMIT 30")
def scan_pairs_topk(t):
    return _pairs(t).groupBy("pair").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "pair").limit(30)


@query(f"""{_PAIRS} SELECT pair, sum(n)::BIGINT AS n FROM (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY path ORDER BY n DESC, pair) <= 20)
GROUP BY pair ORDER BY n DESC, pair LIMIT 30""")
def scan_pairs_by_file(t):
    w = Window.partitionBy("path").orderBy(F.desc("n"), "pair")
    top = _pairs(t).withColumn("r", F.row_number().over(w)).where("r <= 20")
    return top.groupBy("pair").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "pair").limit(30)


@query(f"SELECT mark, count(*) AS n FROM (SELECT unnest(regexp_extract_all(c, '{S.CJK}([(),.;:?!])', 1)) AS mark FROM {_PAGES_C}) GROUP BY mark")
def punctuation_histogram(t):
    m = F.regexp_extract_all("text_layer", F.lit(f"[{X.CJK}]([(),.;:?!])"), F.lit(1))
    return t("pages").select(F.explode(m).alias("mark")).groupBy("mark").agg(F.count("*").alias("n"))


@query(f"SELECT c AS suspect, count(*) AS n FROM (SELECT unnest(regexp_extract_all(c, '[砚口义巳已目戡仁场习丽宫乾趴讥翻戍芸]')) AS c FROM {_PAGES_C}) GROUP BY c")
def suspect_histogram(t):
    m = F.regexp_extract_all("text_layer", F.lit(f"[{R.SUSPECTS}]"), F.lit(0))
    return t("pages").select(F.explode(m).alias("suspect")).groupBy("suspect").agg(F.count("*").alias("n"))


def _rule(name: str, rule, sql: str, source="c"):
    def f(t):
        return t("pages").where("text_layer IS NOT NULL").select("page_key", rule(F.col("text_layer")).alias("text"))

    f.__name__ = name
    query(f"SELECT page_key, {sql} AS text FROM {_PAGES_C}")(f)


_A = f"regexp_replace(regexp_replace(c, '({S.CJK}) ({S.CJK})', '\\1\\2', 'g'), '({S.CJK}) ({S.CJK})', '\\1\\2', 'g')"
_ASCII = "[A-Za-z0-9]"
_l = "coalesce(s[i - 1], '')"
_r = "coalesce(s[i + 1], '')"
_B = (
    "array_to_string(list_transform(range(1, len(s) + 1), lambda i: CASE WHEN regexp_full_match(s[i], '[,.;:?!()]') "
    f"AND (regexp_full_match({_l}, '{S.CJK}') OR regexp_full_match({_r}, '{S.CJK}')) AND NOT regexp_full_match({_l}, '{_ASCII}') "
    f"AND NOT regexp_full_match({_r}, '{_ASCII}') THEN translate(s[i], ',.;:?!()', '，。；：？！（）') ELSE s[i] END), '')"
)
_C = "c"
for _m in "。，、；：？！":
    _C = f"regexp_replace({_C}, '{_m}{_m}+', '{_m}', 'g')"
_rule("rewrite_a", R.rule_a, _A)


@query(f"SELECT page_key, {_B} AS text FROM (SELECT page_key, string_split(c, '') AS s FROM {_PAGES_C})")
def rewrite_b(t):
    return t("pages").where("text_layer IS NOT NULL").select("page_key", R.rule_b(F.col("text_layer")).alias("text"))


_rule("rewrite_c", R.rule_c, _C)
_D = (
    f"regexp_replace(regexp_replace(c, '(?m)‖…*[oO]? *|‖ *|\\.{{3,}}{S.WS}*[oO]?{S.WS}*$', '', 'g'), "
    f"'(?m)^{S.WS}*(第{S.WS}*\\p{{Nd}}+{S.WS}*页({S.WS}|[/上中下])*|-{S.WS}*\\p{{Nd}}+{S.WS}*-|\\p{{Nd}}+/\\p{{Nd}}+){S.WS}*$', '', 'g')"
)
_rule("rewrite_d", R.rule_d, _D)
_SUB = ("是而们自则需", "羲场口目习翻")
_G = "[ \\t\\x{3000}]{0,16}"
_E = f"translate(c, '{_SUB[0]}', '{_SUB[1]}')"
for _w, _y, _a, _b in (
    ("羲", "是", "[这那就不才会都]", S.CJK), ("场", "而", "[,.;:?!，。；：？！以及反而或并因]", "[是且]"), ("口", "们", "[我你他她它]", ""),
    ("目", "自", "", "己"), ("习", "则", S.CJK, "是"), ("习", "则", "习", "[的是在来去]"), ("翻", "需", "[还只]", S.CJK),
):
    _left = f"({_a}{_G})" if _a else "()"
    _right = f"({_G}{_b})" if _b else "()"
    for _ in range(2):
        _E = f"regexp_replace({_E}, '{_left}{_w}{_right}', '\\1{_y}\\2', 'g')"
_rule("rewrite_e", lambda c: R.rule_e(F.translate(c, *_SUB)), _E)
_rule("rewrite_g", R.rule_g, "translate(c, '　', ' ')")


@query(None)
def rewrite_all(t):
    return t("pages").where("text_layer IS NOT NULL").select("page_key", R.rewrite(F.col("text_layer")).alias("text"))


@query(f"""SELECT count(*) AS changed, sum(length(c) - length(a))::BIGINT AS chars, sum(strlen(c) - strlen(a))::BIGINT AS bytes
FROM (SELECT c, {_A} AS a FROM {_PAGES_C}) WHERE a <> c""")
def rewrite_delta(t):
    c = t("pages").where("text_layer IS NOT NULL").select(F.col("text_layer").alias("c"), R.rule_a(F.col("text_layer")).alias("a"))
    return c.where("a <> c").agg(
        F.count("*").alias("changed"),
        F.sum(F.length("c") - F.length("a")).cast(LONG).alias("chars"),
        F.sum(F.octet_length("c") - F.octet_length("a")).cast(LONG).alias("bytes"),
    )


@query(f"""SELECT 'A' AS rule, sum(length(c) - length({_A}))::BIGINT AS edits FROM {_PAGES_C}
UNION ALL SELECT 'C', sum({S.count('c', '|'.join(f'(?:{m}{m}+)' for m in '。，、；：？！'))})::BIGINT FROM {_PAGES_C}
UNION ALL SELECT 'G', sum({_COUNTS['wide_spaces']})::BIGINT FROM {_PAGES_C}""")
def edit_counts(t):
    c = F.col("text_layer")
    edits = F.create_map(
        F.lit("A"), n(F.length(c) - F.length(R.rule_a(c))),
        F.lit("C"), n(F.regexp_count(c, F.lit(r"([。，、；：？！])\1+"))),
        F.lit("G"), n(R.count_wide_spaces(c)),
    )
    rows = t("pages").where(c.isNotNull()).select(F.explode(edits).alias("rule", "k"))
    return rows.groupBy("rule").agg(F.sum("k").alias("edits"))


# -- comparison ---------------------------------------------------------------
_AB = f"""WITH ab AS (SELECT page_key, path, book_id, result, {S.clean("coalesce(text_layer, '')")} AS a, {S.clean("coalesce(native_text, '')")} AS b,
  coalesce(text_layer, '') AS t, coalesce(native_text, '') AS nt FROM pages)"""


@query(f"{_AB} SELECT page_key, {S.compare5('a', 'b')} AS comparison, length({S.squeeze('t')})::BIGINT AS text_size, length({S.squeeze('nt')})::BIGINT AS native_size FROM ab")
def page_compare(t):
    return compare.compared(t("pages")).select("page_key", "comparison", n(F.col("text_size")).alias("text_size"), n(F.col("native_size")).alias("native_size"))


@query(f"{_AB} SELECT comparison, count(*) AS n, count(*) FILTER (result IS DISTINCT FROM comparison) AS differs FROM (SELECT *, {S.compare5('a', 'b')} AS comparison FROM ab) GROUP BY comparison")
def compare_counts(t):
    return compare.compared(t("pages")).groupBy("comparison").agg(
        F.count("*").alias("n"), F.count_if(~F.col("result").eqNullSafe(F.col("comparison"))).alias("differs")
    )


@query("SELECT result, count(*) AS n FROM pages GROUP BY result")
def result_counts(t):
    return t("pages").groupBy("result").agg(F.count("*").alias("n"))


@query("""SELECT page_key, f AS fault FROM (SELECT page_key, unnest([
  CASE WHEN regexp_matches(coalesce(native_text, ''), '/G[0-9A-Fa-f]{2,}') OR regexp_matches(coalesce(text_layer, ''), '/G[0-9A-Fa-f]{2,}') THEN 'glyph_encoding' END,
  CASE WHEN contains(coalesce(native_text, ''), chr(65533)) OR contains(coalesce(text_layer, ''), chr(65533)) THEN 'replacement_character' END,
  CASE WHEN regexp_matches(coalesce(native_text, ''), '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]') OR regexp_matches(coalesce(text_layer, ''), '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]') THEN 'control_character' END]) AS f FROM pages) WHERE f IS NOT NULL""")
def diagnostic_flags(t):
    return compare.compared(t("pages")).select("page_key", F.explode("faults").alias("fault"))


_SIM = f"""{_AB},
g AS (SELECT page_key, 1 AS x, unnest(list_transform(range(1, length(a) - 1), lambda i: substr(a, i, 3))) AS g FROM ab WHERE a <> b AND length(a) >= 3 AND length(b) >= 3
  UNION ALL SELECT page_key, 2, unnest(list_transform(range(1, length(b) - 1), lambda i: substr(b, i, 3))) FROM ab WHERE a <> b AND length(a) >= 3 AND length(b) >= 3),
k AS (SELECT page_key, g, count(*) FILTER (x = 1) AS x, count(*) FILTER (x = 2) AS y FROM g GROUP BY ALL),
s AS (SELECT page_key, 2.0::DOUBLE * sum(least(x, y)) / (sum(x) + sum(y)) AS s FROM k GROUP BY page_key),
z AS (SELECT ab.*, round(CASE WHEN a = b THEN 1.0 ELSE coalesce(s, 0.0) END::DOUBLE, 6) AS score FROM ab LEFT JOIN s USING (page_key)),
cl AS (SELECT *, CASE WHEN a = '' AND b = '' THEN 'both_empty' WHEN a = '' THEN 'text_layer_missing' WHEN b = '' THEN 'recognition_missing'
  WHEN a = b THEN 'exact_ignoring_layout_whitespace' WHEN score >= 0.98 THEN 'near_match_review' WHEN score >= 0.90 THEN 'difference_review'
  ELSE 'major_difference_review' END AS class FROM z)"""


@query(f"{_SIM} SELECT page_key, score, class FROM cl")
def trigram_similarity(t):
    return compare.scored_pages(t("pages"), ["page_key"]).select("page_key", "score", "class")


@query(f"""{_SIM} SELECT path, count(*) AS pages, count(*) FILTER (length({S.squeeze('t')}) > 0) AS read_pages,
{', '.join(f"count(*) FILTER (class = '{b}') AS {b}" for b in compare.BANDS)}, min(score) AS least_score FROM cl GROUP BY path""")
def compare_rollup(t):
    return compare.document_rollup(compare.scored_pages(t("pages"), ["path"]))


@query(f"""{_SIM} SELECT page_key, score, class FROM cl WHERE class IN ('near_match_review', 'difference_review', 'major_difference_review')
ORDER BY score, page_key LIMIT 50""")
def review_priority(t):
    return compare.review_priority(compare.scored_pages(t("pages"), ["page_key"]), 50).select("page_key", "score", "class")


@query("""WITH s AS (SELECT lower(trim(source_hash)) AS h, min(book_id) AS source_path, count(*) AS copies FROM books WHERE source_hash IS NOT NULL GROUP BY 1)
SELECT doc_id, source_path, copies FROM documents LEFT JOIN s ON lower(trim(source_hash)) = h""")
def source_match(t):
    sources = t("books").select("source_hash", F.col("book_id").alias("path"))
    return compare.match_sources(t("documents"), sources).select("doc_id", "source_path", "copies")


@query("""WITH tx AS (SELECT path, page, min(text_layer) AS text_layer FROM pages WHERE text_layer <> '' GROUP BY ALL),
nv AS (SELECT path, page, min(native_text) AS native_text FROM pages GROUP BY ALL)
SELECT path, page, coalesce(length(text_layer), 0)::BIGINT AS text_chars, length(native_text)::BIGINT AS native_chars FROM nv LEFT JOIN tx USING (path, page)""")
def page_alignment(t):
    p = t("pages")
    tx = p.where("text_layer <> ''").groupBy("path", "page").agg(F.min("text_layer").alias("text_layer"))
    nv = p.groupBy("path", "page").agg(F.min("native_text").alias("native_text"))
    out = compare.align_pages(tx, nv, ["path", "page"])
    return out.select("path", "page", n(F.length("text_layer")).alias("text_chars"), n(F.length("native_text")).alias("native_chars"))


# -- audit --------------------------------------------------------------------
def _files(t):
    """Old files: scan attempts of the ledger; new files: the documents."""
    old = t("scan_ledger").select(
        F.concat_ws("/", F.col("ledger_id").cast("string"), "path").alias("path"), F.lower(F.trim("text_hash")).alias("hash"), F.length("path").alias("size")
    )
    new = t("documents").select("path", F.lower(F.trim("text_hash")).alias("hash"), F.length("path").alias("size"))
    return old, new


_OLDNEW = """WITH o AS (SELECT concat_ws('/', ledger_id, path) AS path, lower(trim(text_hash)) AS hash, length(path) AS size FROM scan_ledger),
nw AS (SELECT path, lower(trim(text_hash)) AS hash, length(path) AS size FROM documents),
m AS (SELECT hash, count(*) AS matches, min(path) AS first_match FROM nw WHERE hash IS NOT NULL AND size IN (SELECT size FROM o) GROUP BY hash),
d AS (SELECT hash, count(*) AS old_copies FROM o WHERE hash IS NOT NULL GROUP BY hash),
r AS (SELECT o.*, coalesce(matches, 0) AS matches, first_match, coalesce(old_copies, 0) AS old_copies FROM o LEFT JOIN m USING (hash) LEFT JOIN d USING (hash)),
c AS (SELECT *, CASE WHEN size < 0 THEN 'read_error' WHEN first_match IS NOT NULL THEN 'matched'
  WHEN lower(regexp_extract(path, '(\\.[^./]+)$', 1)) IN ('.log', '.tmp', '.temp', '.pyc') OR list_has_any(string_split(lower(path), '/'), ['tmp', 'venv', '.cache']) THEN 'temporary_or_rebuildable'
  WHEN lower(regexp_extract(path, '(\\.[^./]+)$', 1)) IN ('.mp3', '.zip') THEN 'media_or_archive' ELSE 'pending' END AS category FROM r)"""


@query(f"{_OLDNEW} SELECT path, category, matches, first_match, old_copies FROM c")
def audit_match(t):
    return audit.reconcile(*_files(t)).select("path", "category", "matches", "first_match", "old_copies")


@query(f"{_OLDNEW} SELECT category, count(*) AS files, sum(size)::BIGINT AS bytes, round(sum(size) / 1024.0**3, 3)::DOUBLE AS gib FROM c GROUP BY category")
def audit_totals(t):
    return audit.totals(audit.reconcile(*_files(t)))


@query(f"""{_OLDNEW} SELECT lower(regexp_extract(path, '(\\.[^./]+)$', 1)) AS suffix, count(*) AS files, sum(size)::BIGINT AS bytes FROM c
WHERE category <> 'matched' GROUP BY 1 ORDER BY bytes DESC, suffix LIMIT 25""")
def audit_top_suffixes(t):
    return audit.top_suffixes(audit.reconcile(*_files(t)))


@query("""SELECT sha256(text) AS hash, count(*) AS copies, min(doc_id) AS first_doc FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1""")
def hash_duplicates(t):
    d = t("documents").where("text IS NOT NULL").groupBy(F.sha2("text", 256).alias("hash"))
    return d.agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_doc")).where("copies > 1")


@query("SELECT source, count(*) AS files, coalesce(sum(strlen(text)), 0)::BIGINT AS bytes FROM documents GROUP BY source")
def folder_sizes(t):
    return t("documents").groupBy("source").agg(F.count("*").alias("files"), F.coalesce(F.sum(n(F.octet_length("text"))), F.lit(0)).alias("bytes"))


# -- ledger -------------------------------------------------------------------
_RC = {"timeout after 300 s": -1, "file changed during scan": 1, "page count mismatch": 4}


def _attempts(t):
    rc = F.when(F.col("status") == "complete", 0)
    for m, code in _RC.items():
        rc = rc.when(F.col("error_message") == m, code)
    return t("scan_ledger").select(
        "path", "started_at", "ledger_id", (F.col("status") == "complete").alias("ok"), rc.otherwise(-1).alias("rc"), F.col("error_message").alias("message")
    )


@query("""WITH a AS (SELECT path, started_at, ledger_id, status = 'complete' AS ok, error_message AS message,
    CASE WHEN status = 'complete' THEN 0 WHEN error_message = 'file changed during scan' THEN 1 WHEN error_message = 'page count mismatch' THEN 4 ELSE -1 END AS rc FROM scan_ledger),
b AS (SELECT *, row_number() OVER w AS n, coalesce(max(CASE WHEN ok OR rc IN (4, 6, 11, 30) THEN 1 ELSE 0 END) OVER p, 0) AS over, coalesce(sum(CASE WHEN ok THEN 0 ELSE 1 END) OVER p, 0) AS fails
  FROM a WINDOW w AS (PARTITION BY path ORDER BY started_at, ledger_id), p AS (PARTITION BY path ORDER BY started_at, ledger_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT * FROM b WHERE over = 0 AND fails < 3),
d AS (SELECT path, count(*)::INT AS attempts, arg_max(ok, n) AS ok, arg_max(rc, n) AS rc, first(message ORDER BY n) FILTER (NOT ok) AS first_error, last(message ORDER BY n) FILTER (NOT ok) AS last_error FROM c GROUP BY path)
SELECT path, attempts, CASE WHEN ok THEN 'done' WHEN rc IN (4, 6, 11, 30) OR attempts >= 3 THEN 'skipped' ELSE 'pending' END AS status, first_error, last_error FROM d""")
def ledger_final_state(t):
    return ledger.final_states(_attempts(t), ["path"], ["started_at", "ledger_id"])


@query("SELECT book_id, status, count(*) AS n FROM scan_ledger GROUP BY ALL")
def ledger_summary(t):
    return ledger.status_counts(t("scan_ledger"), "book_id")


@query("SELECT DISTINCT book_id FROM scan_ledger")
def ledger_books(t):
    return t("scan_ledger").select("book_id").distinct()


@query("SELECT book_id, count(*) AS n, count(*) FILTER (status = 'complete') AS done, count(*) FILTER (status = 'complete') = count(*) AS is_complete FROM documents GROUP BY book_id")
def ledger_complete(t):
    return ledger.completeness(t("documents"), "book_id")


@query("SELECT book_id, min(path) AS path FROM documents WHERE status = 'pending' GROUP BY book_id")
def ledger_next(t):
    return ledger.next_tasks(t("documents"), "book_id", "path")


@query("SELECT ledger_id, CASE WHEN status = 'processing' THEN 'pending' ELSE status END AS status, CASE WHEN status <> 'processing' THEN started_at END AS started_at FROM scan_ledger")
def ledger_recovered(t):
    return ledger.recovered(t("scan_ledger")).select("ledger_id", "status", "started_at")


@query("""SELECT ledger_id, CASE WHEN r THEN 'pending' ELSE status END AS status, CASE WHEN r THEN 0 ELSE attempts END AS attempts, CASE WHEN NOT r THEN error_message END AS error_message
FROM (SELECT *, coalesce(b.status = 'review', false) AS r, l.status AS status FROM scan_ledger l LEFT JOIN (SELECT book_id, status FROM books) b USING (book_id))""".replace("SELECT *, coalesce", "SELECT l.ledger_id, l.attempts, l.error_message, coalesce"))
def ledger_reset(t):
    rows = t("scan_ledger").join(t("books").select("book_id", (F.col("status") == "review").alias("r")), "book_id", "left")
    return ledger.reset(rows, F.coalesce("r", F.lit(False))).select("ledger_id", "status", "attempts", "error_message")


@query("""SELECT book_id, page::INT AS page, 'pending' AS status, 0 AS attempts FROM (SELECT book_id, unnest(range(1, expected_pages + 1)) AS page FROM books WHERE expected_pages > 0)
WHERE NOT EXISTS (SELECT 1 FROM pages p WHERE p.book_id = books.book_id AND p.page = page)""".replace("FROM (SELECT", "FROM (SELECT").replace("WHERE NOT EXISTS (SELECT 1 FROM pages p WHERE p.book_id = books.book_id AND p.page = page)", "q ANTI JOIN (SELECT DISTINCT book_id, page FROM pages) d USING (book_id, page)"))
def ledger_expand(t):
    books = t("books").select("book_id", F.col("expected_pages").alias("pages"))
    return ledger.expand_tasks(books, t("pages"))


@query("""SELECT DISTINCT d.doc_id FROM documents d JOIN scan_ledger l ON d.path = l.path AND upper(trim(d.source_hash)) = upper(trim(l.source_hash)) WHERE l.status = 'complete'""")
def ledger_unchanged(t):
    done = t("scan_ledger").where("status = 'complete'")
    return ledger.unchanged(t("documents"), done, "path").select("doc_id")


@query("SELECT event_id, (CASE WHEN v < 800 THEN 0 WHEN v < 1500 THEN 1 WHEN v < 2500 THEN 2 ELSE 6 END)::INT AS workers FROM (SELECT event_id, value * 40 AS v FROM events)")
def worker_bands(t):
    return t("events").select("event_id", ledger.workers_for_memory(F.col("value") * 40, 6).cast("int").alias("workers"))


@query("SELECT ledger_id, CASE WHEN status IN ('failed', 'processing') THEN 'pending' ELSE status END AS status FROM scan_ledger")
def legacy_status(t):
    return t("scan_ledger").select("ledger_id", ledger.legacy_status(F.col("status")).alias("status"))


# -- ingest and manifest ------------------------------------------------------
@query("""SELECT path, max(page) AS last_page, len(list_filter(range(1, max(page) + 1), lambda i: NOT list_contains(list(page), i)))::BIGINT AS missing,
  (count(*) - count(DISTINCT page) > 0) AS repeated FROM pages WHERE page IS NOT NULL GROUP BY path""")
def missing_pages(t):
    return ingest.page_gaps(t("pages"), "path").select("path", "last_page", n(F.size("missing")).alias("missing"), (F.col("repeated") > 0).alias("repeated"))


@query("""WITH c AS (SELECT upper(trim(source_hash)) AS k, count(*) AS n, first(status) AS st FROM documents GROUP BY 1)
SELECT book_id, CASE WHEN n = 1 THEN coalesce(st, status) ELSE status END AS status FROM books LEFT JOIN c ON upper(trim(source_hash)) = k""")
def manifest_update(t):
    compiled = t("documents").select("source_hash", "status")
    return ingest.update_manifest(t("books"), compiled, "source_hash", ["status"]).select("book_id", "status")


@query("SELECT status, count(*) AS n FROM books GROUP BY status")
def manifest_counts(t):
    return t("books").groupBy("status").agg(F.count("*").alias("n"))


@query("""SELECT book_id, code FROM (SELECT book_id, unnest([CASE WHEN strategy NOT IN ('ocr', 'native', 'hybrid') THEN 'bad_mode' END,
  CASE WHEN coalesce(expected_pages, 0) <= 0 THEN 'bad_pages' END, CASE WHEN title IS NULL OR trim(title) = '' THEN 'no_title' END,
  CASE WHEN source_hash IS NULL THEN 'no_source' END, CASE WHEN length(trim(source_hash)) <> 64 THEN 'bad_source_hash' END]) AS code FROM books) WHERE code IS NOT NULL
UNION ALL SELECT book_id, 'double_id' FROM books GROUP BY book_id HAVING count(*) > 1""")
def manifest_problems(t):
    return ingest.manifest_problems(t("books"))


@query("""SELECT book_id, least(expected_pages, 20) AS pages, row_number() OVER (ORDER BY CASE status WHEN 'review' THEN 1 WHEN 'queued' THEN 2 ELSE 3 END, book_id) AS place
FROM books WHERE status <> 'done'""")
def manifest_books(t):
    priority = F.when(F.col("status") == "review", 1).when(F.col("status") == "queued", 2).otherwise(3)
    w = Window.orderBy("priority", "book_id")  # the manifest is one small file
    return t("books").where("status <> 'done'").withColumn("priority", priority).select(
        "book_id", F.least("expected_pages", F.lit(20)).alias("pages"), n(F.row_number().over(w)).alias("place")
    )


@query("SELECT book_id FROM books WHERE source_hash IS NOT NULL AND NOT EXISTS (SELECT 1 FROM documents d WHERE d.source_hash = books.source_hash)")
def skip_sources(t):
    done = t("documents").select("source_hash").where("source_hash IS NOT NULL").distinct()
    return t("books").where("source_hash IS NOT NULL").join(done, "source_hash", "left_anti").select("book_id")


@query("""WITH s(doc_id, k) AS (SELECT doc_id, '1,3-' || (least(length(coalesce(title, '')), 30)) FROM documents)
SELECT doc_id, CASE WHEN split_part(k, '-', 2)::INT BETWEEN 3 AND 25 THEN array_to_string(list_sort(list_distinct(list_concat([1], range(3, split_part(k, '-', 2)::INT + 1)))), ',') END AS pages FROM s""")
def page_selection(t):
    spec = F.concat(F.lit("1,3-"), F.least(F.length(F.coalesce("title", F.lit(""))), F.lit(30)).cast("string"))
    return t("documents").select("doc_id", F.array_join(ingest.page_selection(spec, F.lit(25)), ",").alias("pages"))


@query("""SELECT book_id, y AS "from", least(y + 1600, expected_pages * 100) AS "to" FROM
  (SELECT book_id, expected_pages, unnest(range(0, greatest(expected_pages * 100 - 61, 0) + 1, 1540)) AS y FROM books)""")
def tiles(t):
    w = F.explode(ingest.tiles(F.lit(0).cast(LONG), (F.col("expected_pages") * 100).cast(LONG))).alias("w")
    return t("books").select("book_id", w).select("book_id", n(F.col("w.from")).alias("from"), n(F.col("w.to")).alias("to"))


@query("""SELECT doc_id, regexp_replace(array_to_string(list_transform(range(1, len(p) + 1), lambda i: CASE WHEN i = 2 THEN '成稿' ELSE p[i] END), '/'), '\\.[^./]+$', '.md') AS output,
  regexp_replace(trim(regexp_replace(coalesce(title, ''), '[<>:"/\\\\|?*]', '_', 'g')), ' ', '_', 'g') || '_' || lpad('7', 3, '0') || '.txt' AS page_name,
  substr(regexp_replace(coalesce(title, ''), '[^0-9A-Za-z\\x{3400}-\\x{9FFF}]+', '_', 'g'), 1, 32) || '_' || upper(substr(text_hash, 1, 12)) AS book_id,
  list_contains(p, '文字层') AS derived FROM (SELECT *, string_split(path, '/') AS p FROM documents)""")
def derived_names(t):
    title = F.coalesce("title", F.lit(""))
    return t("documents").select(
        "doc_id",
        X.output_path(F.col("path")).alias("output"),
        X.page_name(title, F.lit(7)).alias("page_name"),
        X.book_id(title, F.col("text_hash")).alias("book_id"),
        X.in_layer(F.col("path"), ["文字层"]).alias("derived"),
    )


@query("SELECT doc_id, strlen(text) <= 80 * 1024 * 1024 AND length(split_part(text, '## Page 2', 1)) > 100 AS is_text FROM documents WHERE text IS NOT NULL")
def text_file_test(t):
    first = F.substring_index("text", "## Page 2", 1)
    return t("documents").where("text IS NOT NULL").select("doc_id", ingest.is_text_file(F.octet_length("text"), first).alias("is_text"))


# -- validation ---------------------------------------------------------------
_LINKS = """WITH l AS (SELECT path, unnest(regexp_extract_all(text, '\\[\\[([^\\]]+)\\]\\]', 1)) AS raw FROM documents),
k AS (SELECT path, regexp_replace(regexp_replace(trim(split_part(split_part(raw, '|', 1), '#', 1)), '\\.md$', ''), '^/+|/+$', '', 'g') AS target FROM l)"""


@query(f"{_LINKS} SELECT path, 'wiki' AS kind, target FROM k WHERE target <> ''")
def link_extract(t):
    return validate.links(t("documents").select("path", "text"), "path", "text")


def _resolved(t):
    names = t("books").select(F.concat("book_id", F.lit(".md")).alias("path"), F.col("title").alias("name"))
    found = validate.links(t("documents").select("path", "text"), "path", "text").where("kind = 'wiki'")
    return validate.resolve_wiki(found, names)


_RESOLVED = f"""{_LINKS}, nm AS (SELECT lower(title) AS t, min(book_id || '.md') AS p, count(DISTINCT book_id) AS n FROM books GROUP BY 1),
rs AS (SELECT path, target, CASE WHEN n = 1 THEN 'ok' WHEN n > 1 THEN 'ambiguous' ELSE 'broken' END AS state, CASE WHEN n = 1 THEN p END AS to_path
  FROM k LEFT JOIN nm ON lower(target) = t AND NOT contains(target, '/') WHERE target <> '')"""


@query(f"{_RESOLVED} SELECT * FROM rs")
def link_resolve(t):
    return _resolved(t)


@query(f"""{_RESOLVED}, e AS (SELECT DISTINCT book_id AS source, replace(to_path, '.md', '') AS target FROM rs JOIN documents USING (path) WHERE to_path IS NOT NULL)
SELECT source, target FROM e WHERE NOT EXISTS (SELECT 1 FROM e b WHERE b.source = e.target AND b.target = e.source)""")
def link_symmetry(t):
    r = _resolved(t).where("to_path IS NOT NULL")
    edges = r.join(t("documents").select("path", F.col("book_id").alias("source")), "path").select(
        "source", F.regexp_replace("to_path", r"\.md$", "").alias("target")
    )
    return validate.one_sided(edges)


@query("""SELECT path, min(ordinal) AS low, max(ordinal) AS high, count(*) AS n, count(DISTINCT ordinal) AS distinct_n FROM chunks WHERE ordinal IS NOT NULL GROUP BY path
HAVING min(ordinal) <> 1 OR max(ordinal) - min(ordinal) + 1 <> count(*) OR count(*) <> count(DISTINCT ordinal)""")
def sequence_gaps(t):
    return validate.sequence_gaps(t("chunks"), "path", "ordinal")


@query("""WITH lk AS (SELECT path, lower(trim(text_hash)) AS h FROM scan_ledger JOIN scan_runs USING (run_id) WHERE committed_at IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY path ORDER BY committed_at DESC, ledger_id DESC) = 1)
SELECT coalesce(l.path, d.path) AS path, CASE WHEN d.path IS NULL THEN 'missing' WHEN l.path IS NULL THEN 'unexpected' ELSE 'mismatch' END AS code
FROM lk l FULL JOIN documents d ON l.path = d.path WHERE d.path IS NULL OR l.path IS NULL OR l.h IS DISTINCT FROM lower(trim(d.text_hash))""")
def lock_diff(t):
    runs = t("scan_runs").where("committed_at IS NOT NULL").select("run_id", "committed_at")
    lock = (
        t("scan_ledger").join(runs, "run_id").groupBy("path")
        .agg(F.max_by(F.lower(F.trim("text_hash")), F.struct("committed_at", "ledger_id")).alias("hash"))
    )
    now = t("documents").select("path", F.lower(F.trim("text_hash")).alias("hash"))
    return validate.lock_diff(lock, now)


@query("SELECT path, sha256(text) AS hash FROM documents")
def corpus_lock(t):
    return validate.lock_of(t("documents"), "path", "text")


@query("""SELECT path, 'secret_pattern' AS code FROM documents WHERE regexp_matches(text, '\\bgh[pousr]_[A-Za-z0-9_]{20,}\\b')
  OR regexp_matches(text, '\\bsk-[A-Za-z0-9_-]{20,}\\b') OR regexp_matches(text, '(?i)\\b(api[_-]?key|token|secret)\\s*[:=]\\s*["'']?[A-Za-z0-9_-]{20,}')
UNION ALL SELECT path, 'sensitive_file_tracked' FROM documents WHERE regexp_matches(path, '(^|/)(\\.env|\\.github\\.env)$')""")
def secret_scan(t):
    return validate.secrets(t("documents"), "path", "text")


@query("""SELECT doc_id, CASE WHEN a <> 1 OR b <> 1 THEN 'marker_count' WHEN strpos(text, '---' || chr(10) || 'title') > strpos(text, chr(10) || '---' || chr(10)) THEN 'marker_order' ELSE 'ok' END AS state
FROM (SELECT doc_id, text, len(regexp_extract_all(text, '---\\ntitle')) AS a, len(regexp_extract_all(text, '\\n---\\n')) AS b FROM documents WHERE text IS NOT NULL)""")
def marker_pairs(t):
    return t("documents").where("text IS NOT NULL").select("doc_id", X.marker_state(F.col("text"), "---\ntitle", "\n---\n").alias("state"))


@query("""SELECT path, code FROM (SELECT path, unnest([CASE WHEN NOT regexp_matches(nm, '^\\d{2,}.*\\.md$') THEN 'filename' END,
  CASE WHEN coalesce(status, '') NOT IN ('complete', 'pending') THEN 'status' END, CASE WHEN try_cast(regexp_extract(nm, '^(\\d+)', 1) AS INT) = 0 THEN 'number' END]) AS code
  FROM (SELECT *, string_split(path, '/')[-1] AS nm FROM documents)) WHERE code IS NOT NULL""")
def numbered_issues(t):
    return validate.numbered_issues(t("documents"))


@query("""SELECT p AS path, 'required_file_missing' AS code FROM (SELECT unnest(['文库/index.md', '文库/README.md']) AS p) WHERE p NOT IN (SELECT path FROM documents WHERE path IS NOT NULL)""")
def required_files(t):
    return validate.required(t("documents"), ["文库/index.md", "文库/README.md"])


@query("""SELECT doc_id, length(CASE WHEN contains(path, '文章') THEN split_part(text, '## Page', 1) WHEN contains(path, '课程') AND contains(text, '# ') THEN string_split(text, '# ')[-1] ELSE text END)::BIGINT AS protected FROM documents WHERE text IS NOT NULL""")
def protected_parts(t):
    part = X.protected_part(F.col("path"), F.col("text"), "文章", "## Page", "\x01")
    part = F.when(F.col("path").contains("课程") & ~F.col("path").contains("文章"), F.substring_index("text", "# ", -1)).otherwise(part)
    return t("documents").where("text IS NOT NULL").select("doc_id", n(F.length(part)).alias("protected"))


# -- routing, sessions, refresh ------------------------------------------------
@query("""SELECT doc_id, CASE WHEN title IS NULL THEN NULL WHEN regexp_matches(lower(title), '查找|搜索|检索|查询') THEN 'knowledge_search' WHEN regexp_matches(lower(title), '整理|组织|分类|归纳') THEN 'knowledge_organize'
  WHEN regexp_matches(lower(title), '创建base|数据库|表|视图') THEN 'database_create' WHEN regexp_matches(lower(title), '编辑|修改|添加|删除') THEN 'document_edit'
  WHEN regexp_matches(lower(title), '检查|维护|验证|清理') THEN 'system_maintenance' ELSE 'knowledge_search' END AS kind FROM documents""")
def router_classify(t):
    return t("documents").select("doc_id", X.question_kind(F.col("title")).alias("kind"))


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 2")
def session_tail(t):
    w = Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id"))
    return t("events").withColumn("r", F.row_number().over(w)).where("r <= 2").select("user_id", "event_id", "event_type")


@query("SELECT event_id, substr(props, 1, 80) AS shown, (props::JSON->>'k')::INT AS k FROM events WHERE length(props) >= 4")
def recall_format(t):
    k = F.get_json_object("props", "$.k").try_cast("int")
    return t("events").where("length(props) >= 4").select("event_id", F.substring("props", 1, 80).alias("shown"), k.alias("k"))


@query("""WITH st AS (SELECT path, sha256(concat('v1', chr(0), coalesce(lower(trim(text_hash)), ''), chr(0), coalesce(lower(trim(source_hash)), ''))) AS sig FROM scan_ledger WHERE status = 'complete' GROUP BY ALL)
SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM st WHERE st.path = d.path AND st.sig = sha256(concat('v1', chr(0), coalesce(lower(trim(d.text_hash)), ''), chr(0), coalesce(lower(trim(d.source_hash)), ''))))""")
def signature_refresh(t):
    part = lambda c: F.coalesce(F.lower(F.trim(c)), F.lit(""))
    sign = F.sha2(F.concat_ws("\x00", F.lit("v1"), part("text_hash"), part("source_hash")), 256).alias("sig")
    store = t("scan_ledger").where("status = 'complete'").select("path", sign).distinct()
    return t("documents").select("doc_id", "path", sign).join(store, ["path", "sig"], "left_anti").select("doc_id")


@query("SELECT path, count(*) AS attempts FROM scan_ledger WHERE path IN (SELECT path FROM documents) GROUP BY path")
def purge_vanished(t):
    live = t("documents").select("path").distinct()
    return t("scan_ledger").join(live, "path", "left_semi").groupBy("path").agg(F.count("*").alias("attempts"))


@query("SELECT book_id FROM books EXCEPT SELECT book_id FROM documents")
def books_without_documents(t):
    return t("books").select("book_id").subtract(t("documents").select("book_id"))


@query("SELECT book_id FROM books INTERSECT SELECT book_id FROM pages INTERSECT SELECT book_id FROM documents")
def books_everywhere(t):
    return t("books").select("book_id").intersect(t("pages").select("book_id")).intersect(t("documents").select("book_id"))


@query("""SELECT doc_id, n_chars, row_number() OVER (ORDER BY n_chars, doc_id) AS place FROM documents WHERE n_chars IS NOT NULL ORDER BY n_chars, doc_id LIMIT 40 OFFSET 10""")
def size_batches(t):
    d = t("documents").where("n_chars IS NOT NULL").select("doc_id", "n_chars").orderBy("n_chars", "doc_id").limit(50)
    w = Window.orderBy("n_chars", "doc_id")  # over 50 rows
    return d.withColumn("place", n(F.row_number().over(w))).where("place > 10")


@query("""SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL""")
def event_windows(t):
    out = streams.windowed_counts(t("events"))
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


# -- review ---------------------------------------------------------------------
@query(f"""WITH f AS (SELECT doc_id, text, status, {S.front('text')} AS fr FROM documents WHERE text IS NOT NULL)
SELECT doc_id, CASE WHEN fr = '' THEN text ELSE '---' || chr(10) || CASE WHEN regexp_matches(fr, '(?m)^pages:')
  THEN regexp_replace(fr, '(?m)^pages:.*$', 'pages: ' || coalesce(status, ''), 'g') ELSE fr || chr(10) || 'pages: ' || coalesce(status, '') END
  || chr(10) || '---' || chr(10) || {S.body('text')} END AS text FROM f""")
def frontmatter_upsert(t):
    value = F.coalesce("status", F.lit(""))
    return t("documents").where("text IS NOT NULL").select("doc_id", review.upsert_front(F.col("text"), "pages", value).alias("text"))


@query("""WITH r AS (SELECT path, page, max(native_text) AS r FROM pages WHERE native_text IS NOT NULL GROUP BY ALL)
SELECT page_key, coalesce(r, text_layer) AS text_layer FROM pages LEFT JOIN r USING (path, page)""")
def page_splice(t):
    p = t("pages")
    new = p.where("native_text IS NOT NULL").select("path", "page", F.col("native_text").alias("replacement"))
    return review.splice_pages(p.select("page_key", "path", "page", "text_layer"), new, ["path", "page"], "text_layer").select("page_key", "text_layer")


@query(None)
def page_diff(t):
    return review.unified_diff(t("pages").where("native_text IS NOT NULL"), "page_key", "native_text", "text_layer")


@query(f"""WITH m AS (SELECT page_key, string_split(regexp_replace(c, '([。，、；：？！]{{2,}})', chr(1) || '\\1' || chr(2), 'g'), chr(1)) AS s FROM {_PAGES_C}),
e AS (SELECT page_key, s, unnest(range(2, len(s) + 1)) AS i FROM m)
SELECT page_key AS key, 'marks' AS rule, 1 + length(array_to_string(s[:i - 1], '')) - length(replace(array_to_string(s[:i - 1], ''), chr(10), '')) AS line, split_part(s[i], chr(2), 1) AS before FROM e""")
def edit_log(t):
    return review.edit_log(t("pages").where("text_layer IS NOT NULL"), "page_key", "text_layer", {"marks": "[。，、；：？！]{2,}"})


@query("""WITH now AS (SELECT path, max(lower(trim(text_hash))) AS th, max(lower(trim(source_hash))) AS sh FROM documents GROUP BY path),
p AS (SELECT ledger_id AS review_id, l.path, text_hash, source_hash, status = 'complete' AS approved, book_id AS reviewer, error_message AS replacement, now.path AS known, th, sh FROM scan_ledger l LEFT JOIN now USING (path))
SELECT review_id, code FROM (SELECT review_id, unnest([CASE WHEN known IS NULL THEN 'unknown_path' END, CASE WHEN lower(trim(text_hash)) IS DISTINCT FROM th THEN 'text_changed' END,
  CASE WHEN lower(trim(source_hash)) IS DISTINCT FROM sh THEN 'source_changed' END, CASE WHEN NOT coalesce(approved, false) THEN 'not_approved' END,
  CASE WHEN trim(coalesce(reviewer, '')) = '' THEN 'no_reviewer' END, CASE WHEN trim(coalesce(replacement, '')) = '' THEN 'empty_replacement' END]) AS code FROM p) WHERE code IS NOT NULL""")
def review_problems(t):
    plans = t("scan_ledger").select(
        F.col("ledger_id").alias("review_id"), "path", "text_hash", "source_hash", (F.col("status") == "complete").alias("approved"),
        F.col("book_id").alias("reviewer"), F.col("error_message").alias("replacement"),
    )
    return review.review_problems(plans, t("documents"))


@query("""WITH n AS (SELECT path, text_hash, recorded_at AS latest, 0 AS n FROM scan_ledger WHERE status <> 'complete' UNION ALL SELECT path, text_hash, recorded_at, 1 FROM scan_ledger WHERE status = 'complete')
SELECT path, max(latest) AS latest FROM n GROUP BY path""")
def insert_or_replace(t):
    rows = t("scan_ledger").select("path", "text_hash", F.col("recorded_at").alias("latest"), "status")
    out = review.insert_or_replace(rows.where("status <> 'complete'"), rows.where("status = 'complete'"), ["path"], "latest")
    return out.select("path", "latest")


@query("""SELECT book_id FROM books WHERE status = 'done' UNION ALL SELECT DISTINCT book_id FROM documents WHERE book_id NOT IN (SELECT book_id FROM books WHERE status = 'done')""")
def insert_or_ignore(t):
    store = t("books").where("status = 'done'").select("book_id")
    return review.insert_or_ignore(store, t("documents").where("book_id IS NOT NULL").select("book_id").distinct(), ["book_id"])


@query("SELECT doc_id, regexp_replace(replace(replace(path, '文库/', '库/'), '正文', '稿'), '/(\\d)([-_.])', '/0\\1\\2', 'g') AS path FROM documents")
def rewritten_paths(t):
    return t("documents").select("doc_id", review.rewritten_path(F.col("path"), {"文库/": "库/", "正文": "稿"}).alias("path"))


@query("""SELECT doc_id, starts_with(path, '文库/') AS inside, contains(path, '/文字层/') AS text_layer, path LIKE '%.md' AND NOT contains(path, '..') AS safe FROM documents""")
def path_guards(t):
    p = F.col("path")
    return t("documents").select(
        "doc_id", p.startswith("文库/").alias("inside"), p.contains("/文字层/").alias("text_layer"), (p.endswith(".md") & ~p.contains("..")).alias("safe")
    )


@query("SELECT doc_id, row_number() OVER (ORDER BY lower(title) NULLS FIRST, doc_id) AS place FROM documents")
def title_places(t):
    return placed(t("documents").select("doc_id", F.lower("title").alias("t")), ["t", "doc_id"]).select("doc_id", "place")


@query("""SELECT book_id, substr(sha256('{"p0":"' || book_id || '","p1":' || expected_pages || '}'), 1, 16) AS job FROM books""")
def job_ids(t):
    return t("books").select("book_id", review.job_id(F.col("book_id"), F.col("expected_pages")).alias("job"))
