"""Named queries of the ledger, review, ingest and validation operators whose
cases the tables do not hold as they are: inputs are derived in the query, over
whole tables, so that every rule meets rows that keep and rows that break it."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import rewrite as R
from ..functions import text as X
from ..operators import audit, ingest, ledger, review, validate
from ..session import checkpoint_dir
from . import catalog as K
from . import sqltext as S
from .catalog import QUERIES, SQL, n, query  # noqa: F401

# -- ledger -------------------------------------------------------------------
_FOLD = """WITH a AS (SELECT path, started_at, ledger_id, finished_at, source_hash, status = 'complete' AS ok, error_message AS message,
    CASE WHEN status = 'complete' THEN 0 WHEN error_message = 'file changed during scan' THEN 1 WHEN error_message = 'page count mismatch' THEN 4 ELSE -1 END AS rc FROM scan_ledger),
b AS (SELECT *, row_number() OVER w AS n, coalesce(max(CASE WHEN ok OR rc IN (4, 6, 11, 30) THEN 1 ELSE 0 END) OVER p, 0) AS over, coalesce(sum(CASE WHEN ok THEN 0 ELSE 1 END) OVER p, 0) AS fails
  FROM a WINDOW w AS (PARTITION BY path ORDER BY started_at, ledger_id), p AS (PARTITION BY path ORDER BY started_at, ledger_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT * FROM b WHERE over = 0 AND fails < 3),
d AS (SELECT path, arg_max(ok, n) AS ok, arg_max(rc, n) AS rc, last(message ORDER BY n) AS message, last(finished_at ORDER BY n) AS finished_at,
  last(source_hash ORDER BY n) AS source_hash, count(*) FILTER (NOT ok) AS failures, list(message ORDER BY n) FILTER (NOT ok) AS f FROM c GROUP BY path),
e AS (SELECT *, CASE WHEN ok THEN 'done' WHEN rc IN (4, 6, 11, 30) OR failures >= 3 THEN 'skipped' ELSE 'pending' END AS status FROM d)"""


def _attempts(t):
    rc = F.when(F.col("status") == "complete", 0)
    for m, code in K._RC.items():
        rc = rc.when(F.col("error_message") == m, code)
    return t("scan_ledger").select(
        "path", "started_at", "ledger_id", "finished_at", "source_hash",
        (F.col("status") == "complete").alias("ok"), rc.otherwise(-1).alias("rc"), F.col("error_message").alias("message"),
    )


@query(f"""{_FOLD} SELECT path, status, failures::INT AS failed_attempts, CASE WHEN NOT ok THEN message END AS error_message, finished_at,
  CASE WHEN ok THEN source_hash END AS source_hash, CASE WHEN status = 'pending' THEN 2.0::DOUBLE * pow(2.0, failures) END AS wait_seconds FROM e""")
def ledger_rows(t):
    out = ledger.task_rows(_attempts(t), ["path"], ["started_at", "ledger_id"], "finished_at", source_hash="source_hash")
    return out.drop("output_path")


@query(f"""{_FOLD} SELECT path, 'ocr_failed' AS reason, failures::INT AS attempts, f[len(f)] AS last_error, finished_at AS skipped_at,
  CASE WHEN rc IN (4, 6, 11, 30) THEN coalesce(f[len(f) - 1], f[len(f)]) ELSE f[len(f)] END AS first_error FROM e WHERE status = 'skipped'""")
def ledger_skipped(t):
    return ledger.skipped_rows(_attempts(t), ["path"], ["started_at", "ledger_id"], "finished_at")


@query("""SELECT coalesce(bool_or(coalesce(n, 0) <> coalesce(expected_pages, 0)), false) AS incomplete FROM books LEFT JOIN
  (SELECT book_id, count(*) AS n FROM pages WHERE text_layer IS NOT NULL GROUP BY book_id) USING (book_id)""")
def ledger_incomplete(t):
    tasks = t("pages").where("text_layer IS NOT NULL").select("book_id", F.lit("done").alias("status"))
    return ledger.incomplete(tasks, t("books").select("book_id", F.col("expected_pages").alias("pages")))


@query("""WITH b AS (SELECT title, min(book_id) AS book_id FROM books WHERE title IS NOT NULL GROUP BY title HAVING count(*) = 1),
t AS (SELECT DISTINCT book_id, page FROM pages WHERE text_layer IS NULL AND page IS NOT NULL),
g AS (SELECT b.book_id, p.page, max(result) AS result, max(loaded_at) AS seen FROM pages p JOIN books USING (book_id) JOIN b ON b.title = books.title WHERE p.page IS NOT NULL GROUP BY ALL)
SELECT book_id, page, 'pending' AS status, 0 AS attempts, NULL::VARCHAR AS error_message, NULL::TIMESTAMP AS finished_at FROM t
UNION ALL SELECT book_id, page, CASE WHEN result IS NULL THEN 'pending' ELSE 'done' END, 0, CASE WHEN result IS NOT NULL THEN result END, CASE WHEN result IS NOT NULL THEN seen END
FROM g WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.book_id = g.book_id AND t.page = g.page)""")
def legacy_import(t):
    pages = t("pages").where("page IS NOT NULL")
    titled = t("books").where("title IS NOT NULL").groupBy("title").agg(F.min("book_id").alias("book_id"), F.count("*").alias("k")).where("k = 1").drop("k")
    tasks = pages.where("text_layer IS NULL").select("book_id", "page").distinct().select("book_id", "page", F.lit("pending").alias("status"), F.lit(0).alias("attempts"))
    old = (
        pages.join(t("books").select("book_id", F.col("title").alias("book_name")), "book_id").groupBy("book_name", "page")
        .agg(F.max("result").alias("error_message"), F.max("loaded_at").alias("timestamp"))
        .withColumn("status", F.when(F.col("error_message").isNull(), "failed").otherwise("done"))
    )
    return ledger.import_legacy(tasks, old, titled)


# -- proofreading ---------------------------------------------------------------
_NOISE = r"(?m)(?:‖…?\s*[oO]?\s*|\.{3,}\s*[oO]?\s*$|‖|…{2,})"


@query(f"""SELECT page_key, ({S.count('c', _NOISE)})::BIGINT AS noise, len(regexp_split_to_array(c, '\\r\\n|[\\n\\r]'))::BIGINT AS lines,
  length(c)::BIGINT AS chars FROM {K._PAGES_C}""")
def scan_details(t):
    c = F.col("text_layer")
    return t("pages").where(c.isNotNull()).select(
        "page_key", n(R.count_noise(c)).alias("noise"), n(F.size(F.split(c, "\r\n|[\n\r]", -1))).alias("lines"), n(F.length(c)).alias("chars")
    )


_RUNS = "|".join(f"(?:{m}{m}+)" for m in ("。", "，", "、", "；", "：", "？", "！", ",", r"\.", ";", ":", r"\?", "!", "“", "”"))


@query(f"""WITH l AS (SELECT path, page, page_key, unnest(string_split(c, chr(10))) AS x, generate_subscripts(string_split(c, chr(10)), 1) AS line
  FROM (SELECT path, page, page_key, text_layer AS c FROM pages WHERE text_layer IS NOT NULL)),
m AS (SELECT path, page, page_key, line, unnest(regexp_extract_all(x, '{_RUNS}')) AS mark, generate_subscripts(regexp_extract_all(x, '{_RUNS}'), 1) AS i FROM l)
SELECT page_key, line::BIGINT AS line, mark FROM m QUALIFY row_number() OVER (PARTITION BY path ORDER BY page NULLS FIRST, page_key, line, i) <= 5""")
def repeated_samples(t):
    lines = t("pages").where("text_layer IS NOT NULL").select("path", "page", "page_key", F.posexplode(F.split("text_layer", "\n", -1)).alias("line", "x"))
    runs = lines.select("path", "page", "page_key", "line", F.posexplode(F.regexp_extract_all("x", F.lit(r"([。，、；：？！,.;:?!“”])\1+"), F.lit(0))).alias("i", "mark"))
    w = F.row_number().over(K.Window.partitionBy("path").orderBy("page", "page_key", "line", "i"))
    return runs.withColumn("r_", w).where("r_ <= 5").select("page_key", n(F.col("line") + 1).alias("line"), "mark")


# Chinese marks made ASCII and commas tripled, so that rules B and C have work.
_DERIVED = "replace(translate(text_layer, '。；：？！（）', '.;:?!()'), '，', '，，，')"
_DERIVED_C = f"(SELECT page_key, path, {_DERIVED} AS c FROM pages WHERE text_layer IS NOT NULL)"


def _derived(t):
    c = F.replace(F.translate("text_layer", "。；：？！（）", ".;:?!()"), F.lit("，"), F.lit("，，，"))
    return t("pages").where("text_layer IS NOT NULL").select("page_key", c.alias("c"))


@query(f"SELECT page_key, {K._B} AS text FROM (SELECT page_key, string_split(c, '') AS s FROM {_DERIVED_C})")
def rewrite_b_derived(t):
    return _derived(t).select("page_key", R.rule_b(F.col("c")).alias("text"))


@query(f"SELECT page_key, {K._C} AS text FROM {_DERIVED_C}")
def rewrite_c_derived(t):
    return _derived(t).select("page_key", R.rule_c(F.col("c")).alias("text"))


@query(f"SELECT mark, count(*) AS n FROM (SELECT unnest(regexp_extract_all(c, '{S.CJK}([(),.;:?!])', 1)) AS mark FROM {_DERIVED_C}) GROUP BY mark")
def punctuation_derived(t):
    m = F.regexp_extract_all("c", F.lit(f"[{X.CJK}]([(),.;:?!])"), F.lit(1))
    return _derived(t).select(F.explode(m).alias("mark")).groupBy("mark").agg(F.count("*").alias("n"))


_E1 = "c"
for _w, _y, _a, _b in (
    ("羲", "是", "[这那就不才会都]", S.CJK), ("场", "而", "[,.;:?!，。；：？！以及反而或并因]", "[是且]"), ("口", "们", "[我你他她它]", ""),
    ("目", "自", "", "己"), ("习", "则", S.CJK, "是"), ("习", "则", "习", "[的是在来去]"), ("翻", "需", "[还只]", S.CJK),
):
    _left = f"({_a}[ \\t\\x{{3000}}]{{0,64}})" if _a else "()"
    _right = f"([ \\t\\x{{3000}}]{{0,64}}{_b})" if _b else "()"
    for _ in range(2):
        _E1 = f"regexp_replace({_E1}, '{_left}{_w}{_right}', '\\1{_y}\\2', 'g')"
_D1 = "regexp_replace(c, '(?m)‖…*[oO]? *|‖ *|\\.{{3,}}{w}*[oO]?{w}*$', '', 'g')".format(w=S.WS)
_D2 = (
    f"regexp_replace(c, '(?m)^{S.WS}*(第{S.WS}*\\p{{Nd}}+{S.WS}*页({S.WS}|[/上中下])*|-{S.WS}*\\p{{Nd}}+{S.WS}*-|\\p{{Nd}}+/\\p{{Nd}}+){S.WS}*$', '', 'g')"
)
_PASS = f"""WITH s0 AS (SELECT page_key, translate({_DERIVED}, '{K._SUB[0]}', '{K._SUB[1]}') AS c FROM pages WHERE text_layer IS NOT NULL),
s1 AS (SELECT page_key, {K._A} AS c FROM s0),
s2 AS (SELECT page_key, {K._B} AS c FROM (SELECT page_key, string_split(c, '') AS s FROM s1)),
s3 AS (SELECT page_key, {K._C} AS c FROM s2),
s4 AS (SELECT page_key, {_D1} AS c FROM s3),
s5 AS (SELECT page_key, {_D2} AS c FROM s4),
s6 AS (SELECT page_key, {_E1} AS c FROM s5),
s7 AS (SELECT page_key, translate(c, '　', ' ') AS c FROM s6)"""


def _suspect(t):
    """Derived texts in which rule E has work as well."""
    return _derived(t).select("page_key", F.translate("c", *K._SUB).alias("c"))


@query(f"{_PASS} SELECT page_key, c AS text FROM s7")
def rewrite_pass(t):
    return _suspect(t).select("page_key", R.rewrite(F.col("c")).alias("text"))


_DIFF = "sum(len(list_filter(range(1, length({a}) + 1), lambda i: string_split({a}, '')[i] <> string_split({b}, '')[i])))"


@query(f"""{_PASS}, x AS (SELECT s0.c AS c0, s1.c AS c1, s2.c AS c2, s3.c AS c3, s4.c AS c4, s5.c AS c5, s6.c AS c6 FROM s0 JOIN s1 USING (page_key)
  JOIN s2 USING (page_key) JOIN s3 USING (page_key) JOIN s4 USING (page_key) JOIN s5 USING (page_key) JOIN s6 USING (page_key)),
y AS (SELECT *, string_split(c1, '') AS l1, string_split(c2, '') AS l2, string_split(c5, '') AS l5, string_split(c6, '') AS l6 FROM x)
SELECT 'A' AS rule, sum(length(c0) - length(c1))::BIGINT AS edits FROM y
UNION ALL SELECT 'B', sum(len(list_filter(list_zip(l1, l2), lambda z: z[1] <> z[2])))::BIGINT FROM y
UNION ALL SELECT 'C', sum({S.count('c2', '|'.join(f'(?:{m}{m}+)' for m in '。，、；：？！'))})::BIGINT FROM y
UNION ALL SELECT 'D', sum(len(regexp_extract_all(c3, '(?m)‖…*[oO]? *|‖ *|\\.{{3,}}{S.WS}*[oO]?{S.WS}*$')) + len(regexp_extract_all(c4,
  '(?m)^{S.WS}*(?:第{S.WS}*\\p{{Nd}}+{S.WS}*页(?:{S.WS}|[/上中下])*|-{S.WS}*\\p{{Nd}}+{S.WS}*-|\\p{{Nd}}+/\\p{{Nd}}+){S.WS}*$')))::BIGINT FROM y
UNION ALL SELECT 'E', sum(len(list_filter(list_zip(l5, l6), lambda z: z[1] <> z[2])))::BIGINT FROM y
UNION ALL SELECT 'G', sum(length(c6) - length(replace(c6, '　', '')))::BIGINT FROM y""")
def edit_totals(t):
    return review.edit_totals(_suspect(t), "c")


@query(None)
def rewrite_log(t):
    return review.rewrite_log(_suspect(t), "page_key", "c")


# -- audit ----------------------------------------------------------------------
@query(f"""{K._OLDNEW}, ls AS (SELECT hash, string_agg(path, ' | ' ORDER BY path) AS listed FROM (SELECT hash, path FROM nw WHERE hash IS NOT NULL AND size IN (SELECT size FROM o)
  QUALIFY row_number() OVER (PARTITION BY hash ORDER BY path) <= 20) GROUP BY hash) SELECT o.path, matches, listed FROM o LEFT JOIN m USING (hash) LEFT JOIN ls USING (hash)""".replace("matches, listed FROM o", "coalesce(matches, 0) AS matches, listed FROM o"))
def audit_match_list(t):
    return audit.reconcile(*K._files(t)).select("path", "matches", "listed")


@query(f"""{K._OLDNEW}, b AS (SELECT hash FROM o WHERE hash IS NOT NULL INTERSECT SELECT hash FROM nw WHERE hash IS NOT NULL)
SELECT 'old' AS side, path, hash FROM o WHERE hash IN (SELECT hash FROM b) UNION ALL SELECT 'new', path, hash FROM nw WHERE hash IN (SELECT hash FROM b)""")
def audit_classes(t):
    return audit.matched_files(*K._files(t))


@query("""SELECT path, CASE WHEN hit THEN 'matched' WHEN regexp_matches(lower(path), '\\.(log|tmp|temp|pyc)$') OR list_has_any(string_split(lower(path), '/'),
    ['tmp', '__pycache__', 'node_modules', '.venv', 'venv', 'site-packages', '.cache', '.pytest_cache', '.vite', '.next']) THEN 'temporary_or_rebuildable'
  WHEN regexp_matches(lower(path), '\\.(mp3|mp4|mov|flv|wav|m4a|avi|mkv|zip|rar|7z|tar|gz)$') THEN 'media_or_archive' WHEN bad THEN 'read_error' ELSE 'pending' END AS category FROM (
  SELECT CASE source WHEN 'course' THEN replace(path, '.md', '.MP4') WHEN 'article' THEN replace(path, '.md', '.log') WHEN 'lecture_handout' THEN 'tmp/' || path
    WHEN 'memory_notes' THEN replace(path, '.md', '.zip') ELSE path END AS path, status = 'complete' AND status IS NOT NULL AND false AS hit, false AS bad FROM documents)""")
def audit_categories(t):
    moved = (
        F.when(F.col("source") == "course", F.replace("path", F.lit(".md"), F.lit(".MP4")))
        .when(F.col("source") == "article", F.replace("path", F.lit(".md"), F.lit(".log")))
        .when(F.col("source") == "lecture_handout", F.concat(F.lit("tmp/"), "path"))
        .when(F.col("source") == "memory_notes", F.replace("path", F.lit(".md"), F.lit(".zip")))
        .otherwise(F.col("path"))
    )
    d = t("documents").select(moved.alias("path"))
    return d.select("path", audit.category(F.col("path"), F.lit(False), F.lit(False)).alias("category"))


# -- ingest -----------------------------------------------------------------------
@query("""WITH m AS (SELECT upper(trim(source_hash)) AS k, count(*) AS n FROM books WHERE source_hash IS NOT NULL GROUP BY 1)
SELECT source_hash, coalesce(n, 0) AS found FROM (SELECT DISTINCT upper(trim(source_hash)) AS source_hash FROM documents WHERE source_hash IS NOT NULL) LEFT JOIN m ON k = source_hash WHERE coalesce(n, 0) <> 1""")
def manifest_cardinality(t):
    return ingest.manifest_cardinality(t("books"), t("documents"), "source_hash")


@query("""SELECT book_id, code FROM (SELECT book_id, unnest([CASE WHEN s NOT IN ('ocr', 'native', 'hybrid') THEN 'bad_mode' END, CASE WHEN coalesce(p, 0) <= 0 THEN 'bad_pages' END,
  CASE WHEN title IS NULL OR trim(title) = '' THEN 'no_title' END, CASE WHEN h IS NULL THEN 'no_source' END, CASE WHEN length(trim(h)) <> 64 THEN 'bad_source_hash' END]) AS code
  FROM (SELECT book_id, coalesce(watermark, strategy) AS s, CASE WHEN confidence IS NULL THEN 0 ELSE expected_pages END AS p, CASE WHEN status = 'review' THEN ' ' ELSE title END AS title,
    CASE WHEN status = 'queued' THEN NULL WHEN lang = 'en' THEN substr(source_hash, 1, 60) ELSE source_hash END AS h FROM books)) WHERE code IS NOT NULL""")
def manifest_problems_derived(t):
    b = t("books").select(
        "book_id",
        F.coalesce("watermark", "strategy").alias("strategy"),
        F.when(F.col("confidence").isNull(), 0).otherwise(F.col("expected_pages")).alias("expected_pages"),
        F.when(F.col("status") == "review", " ").otherwise(F.col("title")).alias("title"),
        F.when(F.col("status") == "queued", F.lit(None)).when(F.col("lang") == "en", F.substring("source_hash", 1, 60)).otherwise(F.col("source_hash")).alias("source_hash"),
    )
    return ingest.manifest_problems(b)


@query("SELECT book_id, least(expected_pages, 20) AS pages FROM books WHERE status <> 'done' OR status IS NULL")
def planned_books(t):
    b = t("books").select(
        "book_id", F.col("expected_pages").alias("pages"), F.coalesce(F.col("status") != "done", F.lit(True)).alias("enabled"), F.col("review_threshold").alias("priority")
    )
    return ingest.planned_books(b, sample=20).select("book_id", "pages")


@query("SELECT book_id, CASE WHEN review_threshold > 0 THEN '1-' || least(review_threshold, expected_pages) END AS pages FROM books")
def sample_ranges(t):
    return t("books").select("book_id", ingest.sample_range(F.col("expected_pages"), F.col("review_threshold")).alias("pages"))


_FLAT = "regexp_replace(path, '/[^/]+/([^/]+)$', '/\\1')"


def _flat(c="path"):
    """Paths without the folder of the book."""
    return F.regexp_replace(c, "/[^/]+/([^/]+)$", "/$1")


@query(f"""SELECT path, min(doc_id) AS doc_id FROM (SELECT doc_id, CASE WHEN title IS NULL THEN '文库/文字层/书册/README.md' ELSE {_FLAT} END AS path FROM documents)
WHERE regexp_replace(path, '/[^/]*$', '') = '文库/文字层/书册' AND lower(string_split(path, '/')[-1]) <> 'readme.md' GROUP BY path""")
def select_documents(t):
    path = F.when(F.col("title").isNull(), "文库/文字层/书册/README.md").otherwise(_flat())
    d = t("documents").select("doc_id", path.alias("path"))
    return ingest.select_documents(d, "文库/文字层/书册", "doc_id").select("path", "doc_id")


@query("""SELECT doc_id FROM documents WHERE source IN ('memory_notes', 'audit_reports', 'course')
ORDER BY CASE source WHEN 'memory_notes' THEN 1 WHEN 'audit_reports' THEN 2 ELSE 3 END, path LIMIT 200""")
def first_across(t):
    d = t("documents").select("doc_id", F.col("source").alias("root"), "path")
    return ingest.first_across(d, ["memory_notes", "audit_reports", "course"], 200).select("doc_id")


@query("""WITH w AS (SELECT book_id, unnest(range(1, expected_pages + 1))::INT AS page FROM books WHERE expected_pages > 0), h AS (SELECT DISTINCT book_id, page FROM pages WHERE page IS NOT NULL)
SELECT book_id, page, 'missing' AS code FROM w ANTI JOIN h USING (book_id, page)
UNION ALL SELECT book_id, page, 'unexpected' FROM (SELECT * FROM h SEMI JOIN books USING (book_id)) ANTI JOIN w USING (book_id, page)""")
def page_differences(t):
    return ingest.page_differences(t("pages"), t("books").select("book_id", F.col("expected_pages").alias("pages")))


@query(f"""{K._PICK}, sh AS (SELECT DISTINCT book_id, page FROM pages WHERE result = 'both_empty_requires_visual_or_ocr'),
f AS (SELECT *, CASE WHEN scan THEN sc ELSE nat END AS ft FROM d) SELECT DISTINCT book_id, page FROM f SEMI JOIN sh USING (book_id, page) WHERE length({S.squeeze('ft')}) = 0""")
def short_empty(t):
    p = t("pages").join(t("books").select("book_id", "review_threshold"), "book_id", "left")
    final = X.hybrid(F.col("native_text"), F.col("text_layer"), F.col("review_threshold"))
    return ingest.short_empty(p.withColumn("final_text", final), t("pages").where("result = 'both_empty_requires_visual_or_ocr'"))


_LAYER = """(SELECT book_id, path, status, source_hash AS sh, '---' || chr(10) || 'pages: ' || length(coalesce(title, '')) || chr(10) ||
  CASE WHEN source = 'course' THEN 'source_sha256: x' ELSE 'source_sha256: ' || coalesce(source_hash, '') END || chr(10) || '---' || chr(10) AS text FROM documents)"""


@query(f"""WITH l AS (SELECT book_id, path, upper(trim(regexp_extract(text, '(?m)^source_sha256:(.*)$', 1))) AS st, regexp_extract(text, '(?m)^pages: (.*)$', 1)::INT AS pg FROM {_LAYER}),
j AS (SELECT l.*, expected_pages AS want, upper(trim(b.source_hash)) AS now FROM l JOIN books b USING (book_id))
SELECT book_id, path, code FROM (SELECT book_id, path, unnest([CASE WHEN NOT regexp_full_match(st, '[0-9A-F]{{64}}') THEN 'bad_source_hash' END,
  CASE WHEN pg IS DISTINCT FROM want THEN 'page_count' END, CASE WHEN regexp_full_match(st, '[0-9A-F]{{64}}') AND st IS DISTINCT FROM now THEN 'source_changed' END]) AS code FROM j) WHERE code IS NOT NULL""")
def layer_provenance(t):
    stated = F.when(F.col("source") == "course", "x").otherwise(F.coalesce("source_hash", F.lit("")))
    text = F.concat(F.lit("---\npages: "), F.length(F.coalesce("title", F.lit(""))).cast("string"), F.lit("\nsource_sha256: "), stated, F.lit("\n---\n"))
    layers = t("documents").select("book_id", "path", text.alias("text"))
    return ingest.provenance(layers, t("books").select("book_id", F.col("expected_pages").alias("pages"), "source_hash"))


@query("""SELECT DISTINCT path FROM (SELECT path, lower(trim(text_hash)) AS a FROM scan_ledger) JOIN (SELECT path, lower(trim(text_hash)) AS b FROM documents) USING (path) WHERE a <> b""")
def changed_during_scan(t):
    before = t("scan_ledger").select("path", F.col("text_hash").alias("hash"))
    return ingest.changed_meanwhile(before, t("documents").select("path", F.col("text_hash").alias("hash")))


@query("""SELECT doc_id FROM documents d WHERE EXISTS (SELECT 1 FROM scan_ledger l WHERE l.status = 'complete' AND l.path = d.path AND l.text_hash = d.text_hash)""")
def cached_documents(t):
    return ingest.cached(t("documents"), t("scan_ledger"), ["path", "text_hash"], F.col("status") == "complete").select("doc_id")


@query("""WITH p AS (SELECT path, page, CASE WHEN length(coalesce(native_text, '')) >= length(coalesce(text_layer, '')) THEN coalesce(native_text, '') ELSE coalesce(text_layer, '') END AS t FROM pages)
SELECT path, '---' || chr(10) || 'path: ' || path || chr(10) || '---' || chr(10) || chr(10) || '# ' || path || chr(10) || chr(10) ||
  string_agg('## Page ' || page || chr(10) || chr(10) || t, chr(10) || chr(10) ORDER BY page, t) AS markdown FROM p WHERE page IS NOT NULL GROUP BY path""")
def compose_headed(t):
    a, b = F.coalesce("native_text", F.lit("")), F.coalesce("text_layer", F.lit(""))
    p = t("pages").where("page IS NOT NULL").select("path", "page", F.when(F.length(a) >= F.length(b), a).otherwise(b).alias("final_text"))
    return ingest.compose_text_layer(p, "path", head=ingest.layer_head({"path": F.col("path")}, F.col("path")))


# -- validation ---------------------------------------------------------------------
@query("""WITH f AS (SELECT CASE WHEN status = 'pending' THEN replace(path, '.md', '/.env') ELSE path END AS path,
  CASE status WHEN 'error' THEN text || ' token: ' || text_hash WHEN 'processing' THEN text || ' ghp_' || text_hash ELSE text END AS text FROM documents)
SELECT path, 'secret_pattern' AS code FROM f WHERE regexp_matches(text, '\\bgh[pousr]_[A-Za-z0-9_]{20,}\\b') OR regexp_matches(text, '(?i)\\b(api[_-]?key|token|secret)\\s*[:=]\\s*["'']?[A-Za-z0-9_-]{20,}')
UNION ALL SELECT path, 'sensitive_file_tracked' FROM f WHERE path LIKE '%/.env'""")
def secret_scan_derived(t):
    s = F.col("status")
    text = F.when(s == "error", F.concat("text", F.lit(" token: "), "text_hash")).when(s == "processing", F.concat("text", F.lit(" ghp_"), "text_hash")).otherwise(F.col("text"))
    path = F.when(s == "pending", F.replace("path", F.lit(".md"), F.lit("/.env"))).otherwise(F.col("path"))
    return validate.secrets(t("documents").select(path.alias("path"), text.alias("text")), "path", "text")


_RULES = [
    validate.Numbered("course", "文库/课程/正文", r"^(\d{8})\.md$", ("zh", "en"), None, "number", ("title",), ("第", "的"), 1, 999),
    validate.Numbered("practice", "文库/实操/转写", r"^(\d{7}[0-8])\.md$", ("zh",), "complete", None, (), None, 0, 33),
]
_VAULT = f"""(SELECT {_FLAT} AS path, '---' || chr(10) || 'type: ' || coalesce(lang, '') || chr(10) || 'status: ' || coalesce(status, '') || chr(10) ||
  CASE WHEN confidence IS NULL THEN 'other' ELSE 'number' END || ': ' || n_chars || chr(10) || CASE WHEN title IS NULL THEN '' ELSE 'title: x' || chr(10) END || '---' || chr(10) || coalesce(text, '') AS text,
  lang, status, confidence, n_chars, title FROM documents)"""


def _vault(t):
    field = F.when(F.col("confidence").isNull(), "other").otherwise("number")
    text = F.concat(
        F.lit("---\ntype: "), F.coalesce("lang", F.lit("")), F.lit("\nstatus: "), F.coalesce("status", F.lit("")), F.lit("\n"), field, F.lit(": "),
        F.col("n_chars").cast("string"), F.lit("\n"), F.when(F.col("title").isNull(), "").otherwise("title: x\n"), F.lit("---\n"), F.coalesce("text", F.lit("")),
    )
    return t("documents").select(_flat().alias("path"), text.alias("text"))


_ISSUES = f"""WITH v AS (SELECT *, string_split(path, '/')[-1] AS nm, regexp_replace(path, '/[^/]*$', '') AS folder FROM {_VAULT}),
c AS (SELECT *, try_cast(regexp_extract(nm, '^(\\d{{8}})\\.md$', 1) AS INT) AS no, length(text) - length(replace(text, '第', '')) AS m1, length(text) - length(replace(text, '的', '')) AS m2
  FROM v WHERE folder = '文库/课程/正文'),
r AS (SELECT *, try_cast(regexp_extract(nm, '^(\\d{{7}}[0-8])\\.md$', 1) AS INT) AS no FROM v WHERE folder = '文库/实操/转写'),
i AS (SELECT path, unnest([CASE WHEN no IS NULL THEN 'course_filename' END, CASE WHEN no IS NOT NULL AND coalesce(trim(lang), '') NOT IN ('zh', 'en') THEN 'course_type' END,
    CASE WHEN no IS NOT NULL AND coalesce(status, '') = '' THEN 'course_status' END,
    CASE WHEN no IS NOT NULL AND (confidence IS NULL OR n_chars IS DISTINCT FROM no) THEN 'course_frontmatter_number' END,
    CASE WHEN no IS NOT NULL AND title IS NULL THEN 'course_title' END,
    CASE WHEN no IS NOT NULL AND (m1 <> 1 OR m2 <> 1) THEN 'marker_count' WHEN no IS NOT NULL AND strpos(text, '第') > strpos(text, '的') THEN 'marker_order' END]) AS code FROM c
  UNION ALL SELECT path, unnest([CASE WHEN no IS NULL THEN 'practice_filename' END, CASE WHEN no IS NOT NULL AND coalesce(trim(lang), '') <> 'zh' THEN 'practice_type' END,
    CASE WHEN no IS NOT NULL AND coalesce(status, '') <> 'complete' THEN 'practice_status' END]) FROM r
  UNION ALL SELECT '文库/课程/正文', CASE WHEN min(no) = 1 AND max(no) = 999 AND count(no) = 999 AND count(DISTINCT no) = 999 THEN NULL ELSE 'course_numbering' END FROM c
  UNION ALL SELECT '文库/实操/转写', CASE WHEN min(no) = 0 AND max(no) = 33 AND count(no) = 34 AND count(DISTINCT no) = 34 THEN NULL ELSE 'practice_numbering' END FROM r),
issues AS (SELECT path, code FROM i WHERE code IS NOT NULL)"""


@query(f"{_ISSUES} SELECT * FROM issues")
def vault_issues(t):
    return validate.numbered_corpus(_vault(t), _RULES)


@query(f"""{_ISSUES}, s AS (SELECT code, string_agg(path, ', ' ORDER BY path) AS first FROM (SELECT * FROM issues QUALIFY row_number() OVER (PARTITION BY code ORDER BY path) <= 12) GROUP BY code)
SELECT code, n, first FROM s JOIN (SELECT code, count(*) AS n FROM issues GROUP BY code) USING (code)""")
def issue_samples(t):
    return validate.samples(validate.numbered_corpus(_vault(t), _RULES), "code", "path")


@query("""SELECT book_id, 'missing' AS side FROM (SELECT book_id FROM books EXCEPT SELECT book_id FROM scan_ledger) UNION ALL
SELECT book_id, 'extra' FROM (SELECT book_id FROM scan_ledger WHERE status = 'error' EXCEPT SELECT book_id FROM documents WHERE status = 'complete')""")
def allowlist_check(t):
    a = validate.mismatch(t("books"), t("scan_ledger"), "book_id").where("side = 'missing'")
    b = validate.mismatch(t("documents").where("status = 'complete'"), t("scan_ledger").where("status = 'error'"), "book_id")
    return a.unionByName(b.where("side = 'extra'"))


@query("""SELECT doc_id, CASE WHEN path IS NULL OR NOT starts_with(path, '文库/') OR list_contains(p, '..') THEN 'outside' WHEN NOT list_contains(p, '文字层') THEN 'not_in_layer'
  WHEN list_contains(p, '书册') AND source <> 'book_text_layer' THEN 'original' WHEN NOT path LIKE '%.md' THEN 'suffix' ELSE 'ok' END AS state
FROM (SELECT doc_id, source, path, string_split(path, '/') AS p FROM (SELECT doc_id, source, CASE WHEN title IS NULL THEN replace(path, '文库/', '文库/../') WHEN confidence IS NULL THEN replace(path, '.md', '.txt') ELSE path END AS path FROM documents))""")
def path_states(t):
    moved = F.when(F.col("title").isNull(), F.replace("path", F.lit("文库/"), F.lit("文库/../"))).when(F.col("confidence").isNull(), F.replace("path", F.lit(".md"), F.lit(".txt"))).otherwise(F.col("path"))
    d = t("documents").select("doc_id", moved.alias("path"))
    return d.select("doc_id", X.path_state(F.col("path"), "文库", "文字层", "原件").alias("state"))


_STEM = "regexp_replace(path, '\\.md$', '')"


@query(f"""WITH l AS (SELECT path, title, source, CASE source WHEN 'course' THEN {_STEM} WHEN 'article' THEN upper({_STEM}) WHEN 'book_text_layer' THEN '../' || string_split({_STEM}, '/')[-2] || '/' || string_split({_STEM}, '/')[-1]
    WHEN 'topic_synthesis' THEN './' || string_split({_STEM}, '/')[-1] WHEN 'practice_transcript' THEN title WHEN 'practice_synthesis' THEN '../../../../../../x' ELSE 'no/such' END AS target FROM documents),
t AS (SELECT lower(title) AS called, min(path) AS p, count(DISTINCT path) AS k FROM documents WHERE title IS NOT NULL GROUP BY 1)
SELECT path, target, CASE source WHEN 'course' THEN 'ok' WHEN 'article' THEN 'case' WHEN 'book_text_layer' THEN 'ok' WHEN 'topic_synthesis' THEN 'ok' WHEN 'practice_transcript' THEN CASE WHEN k = 1 THEN 'ok' ELSE 'ambiguous' END ELSE 'broken' END AS state,
  CASE WHEN source IN ('course', 'article', 'book_text_layer', 'topic_synthesis') THEN path WHEN source = 'practice_transcript' AND k = 1 THEN p END AS to_path
FROM l LEFT JOIN t ON source = 'practice_transcript' AND lower(target) = called WHERE target IS NOT NULL""")
def link_branches(t):
    stem, parts = validate.stem(F.col("path")), F.split(validate.stem(F.col("path")), "/")
    at = lambda k: F.try_element_at(parts, F.lit(k))
    target = (
        F.when(F.col("source") == "course", stem).when(F.col("source") == "article", F.upper(stem))
        .when(F.col("source") == "book_text_layer", F.concat(F.lit("../"), at(-2), F.lit("/"), at(-1)))
        .when(F.col("source") == "topic_synthesis", F.concat(F.lit("./"), at(-1)))
        .when(F.col("source") == "practice_transcript", F.col("title"))
        .when(F.col("source") == "practice_synthesis", F.lit("../../../../../../x"))
        .otherwise("no/such")
    )
    found = t("documents").select("path", target.alias("target")).where("target IS NOT NULL")
    return validate.resolve_wiki(found, t("documents").select("path", F.col("title").alias("name")))


@query("""WITH f AS (SELECT path, source, regexp_replace(path, '/[^/]*$', '') AS folder FROM documents)
SELECT path, '../../../../../../../x.md' AS target, 'markdown_link_escape' AS code FROM f WHERE source = 'course'
UNION ALL SELECT path, folder || '/none it.md', 'broken_markdown_link' FROM f WHERE source <> 'course'""")
def markdown_links(t):
    name = F.element_at(F.split("path", "/"), -1)
    bad = F.when(F.col("source") == "course", "../../../../../../x.md").otherwise("./none%20it.md#top")
    text = F.concat(F.lit("[a]("), name, F.lit(") ![b](<"), bad, F.lit(">) [c](https://e.org/a.md) [d](a.txt)\n```\n[e](no.md)\n```\n"))
    d = t("documents").select("path", text.alias("text"))
    return validate.broken_markdown(validate.links(d, "path", "text"), d)


# -- retrieval ----------------------------------------------------------------------
@query(K.SQL["retrieval_topk"].replace("SELECT chunk_key, path, source_kind, round(score, 6) AS score,", """SELECT chunk_key, section, page, source_kind,
  CASE WHEN source_kind IN ('article', 'course') THEN 'high' WHEN source_kind = 'practice_transcript' THEN 'low' ELSE 'medium' END AS confidence,""").replace(
    "FROM sc JOIN chunks USING (chunk_key)", "FROM sc JOIN (SELECT c.* REPLACE (d.k AS source_kind) FROM chunks c JOIN (SELECT document_id, min(source_kind) AS k FROM chunks GROUP BY 1) d USING (document_id)) USING (chunk_key)"))
def retrieval_hits(t):
    chunks = t("chunks")
    index, statistics = K.retrieval.scan_index(chunks, K.QUESTION)
    scores = K.retrieval.bm25(index, statistics, K.retrieval.query_terms(chunks.sparkSession, K.QUESTION))
    hits = K.retrieval.top_k(chunks, scores, 20, documents=K.retrieval.document_rows(chunks))
    return hits.select("chunk_key", "section", "page", "source_kind", "confidence", n(F.col("rank")).alias("rank"))


@query(K.SQL["retrieval_topk"])
def retrieval_indexed(t):
    """The same ranking over an index that is written first."""
    chunks = t("chunks")
    spark = chunks.sparkSession
    folder = f"{checkpoint_dir(spark)}/quire-index-{uuid.uuid4().hex}"
    K.retrieval.write_index(chunks, folder)
    scores = K.retrieval.bm25(*K.retrieval.read_index(spark, folder, K.QUESTION), K.retrieval.query_terms(spark, K.QUESTION))
    hits = K.retrieval.top_k(chunks, scores, 20)
    return hits.select("chunk_key", "path", "source_kind", "score", n(F.col("rank")).alias("rank"))


# -- review -----------------------------------------------------------------------
@query("""WITH s AS (SELECT source, count(*) FILTER (status = 'complete') AS done, count(*) FILTER (status = 'error') AS bad FROM documents GROUP BY source)
SELECT source, CASE WHEN bad > 5 THEN NULL ELSE '- ready: ' || done || ' of x' || chr(10) || '| open | ' || bad || ' | y |' END AS text, CASE WHEN bad > 5 THEN '2' ELSE '' END AS failed FROM s""")
def index_patch(t):
    s = t("documents").groupBy("source").agg(F.count_if(F.col("status") == "complete").alias("done"), F.count_if(F.col("status") == "error").alias("bad"))
    line = "| open | 0 | y |"
    text = F.concat(F.lit("- ready: 0 of x\n"), F.when(F.col("bad") > 5, f"{line}\n{line}").otherwise(line))
    patches = [
        (r"(?m)^(- ready: )\d+( of x)$", F.concat(F.lit("$1"), F.col("done").cast("string"), F.lit("$2"))),
        (r"(?m)^(\| open \| )\d+( \|.*\|)$", F.concat(F.lit("$1"), F.col("bad").cast("string"), F.lit("$2"))),
    ]
    return s.select("source", review.patch_once(text, patches).alias("p")).select("source", "p.text", F.array_join("p.failed", ",").alias("failed"))


@query("""WITH d AS (SELECT path, max(lower(trim(text_hash))) AS th, max(lower(trim(source_hash))) AS sh, max(book_id) AS root, max(length(coalesce(title, ''))) AS pages,
    max(list_transform(regexp_extract_all(text, '## Page (\\d+)', 1), lambda x: x::INT)) AS h FROM documents WHERE text IS NOT NULL GROUP BY path),
p AS (SELECT ledger_id AS review_id, attempts AS version, book_id AS root, path, lower(trim(text_hash)) AS th, lower(trim(source_hash)) AS sh FROM scan_ledger),
j AS (SELECT p.*, d.path IS NOT NULL AS known, d.root AS r2, d.th AS t2, d.sh AS s2, pages, h FROM p LEFT JOIN d USING (path))
SELECT review_id, code FROM (SELECT review_id, unnest([CASE WHEN version IS DISTINCT FROM 1 THEN 'version' END, CASE WHEN NOT known THEN 'unknown_path' END,
  CASE WHEN known AND root IS DISTINCT FROM r2 THEN 'root' END, CASE WHEN known AND th IS DISTINCT FROM t2 THEN 'text_changed' END, CASE WHEN known AND sh IS DISTINCT FROM s2 THEN 'source_changed' END,
  CASE WHEN known AND sh IS DISTINCT FROM t2 THEN 'provenance' END, CASE WHEN known AND h IS DISTINCT FROM range(1, len(h) + 1) THEN 'page_sequence' END,
  CASE WHEN known AND len(h) IS DISTINCT FROM pages THEN 'page_count' END]) AS code FROM j) WHERE code IS NOT NULL""")
def plan_guards(t):
    plans = t("scan_ledger").select(F.col("ledger_id").alias("review_id"), F.col("attempts").alias("version"), F.col("book_id").alias("root"), "path", "text_hash", "source_hash")
    headings = F.transform(F.regexp_extract_all("text", F.lit(r"## Page (\d+)"), F.lit(1)), lambda x: x.cast("int"))
    now = t("documents").where("text IS NOT NULL").select(
        "path", F.col("book_id").alias("root"), "text_hash", "source_hash", F.col("text_hash").alias("stated_hash"),
        F.length(F.coalesce("title", F.lit(""))).alias("pages"), headings.alias("headings"),
    )
    return review.plan_problems(plans, now)


@query("""WITH e AS (SELECT path AS review_id, path, page, result IS NOT NULL AS approved, CASE WHEN text_chars > 300 THEN book_id END AS reviewer, flags AS reason, text_layer AS replacement, text_layer, native_text FROM pages WHERE page IS NOT NULL),
k AS (SELECT DISTINCT path, page FROM pages WHERE native_text IS NOT NULL),
ev AS (SELECT review_id, page, path, sha256(text_layer) AS hash FROM e WHERE text_layer IS NOT NULL),
fi AS (SELECT DISTINCT path, sha256(native_text) AS hash FROM e WHERE native_text IS NOT NULL UNION SELECT path, sha256(text_layer) FROM e WHERE text_layer IS NOT NULL AND page = 1)
SELECT review_id, page, code FROM (SELECT e.review_id, e.page, unnest([CASE WHEN k.path IS NULL THEN 'unknown_page' END, CASE WHEN NOT approved THEN 'not_approved' END,
  CASE WHEN trim(coalesce(reviewer, '')) = '' THEN 'no_reviewer' END, CASE WHEN trim(coalesce(reason, '')) = '' THEN 'no_reason' END,
  CASE WHEN (e.review_id, e.page) NOT IN (SELECT (review_id, page) FROM ev) THEN 'no_evidence' END, CASE WHEN regexp_matches(replacement, '(?m)^## Page \\d+') THEN 'page_heading' END]) AS code
  FROM e LEFT JOIN k ON e.path = k.path AND e.page = k.page) WHERE code IS NOT NULL
UNION ALL SELECT review_id, page, 'double_page' FROM e GROUP BY review_id, page HAVING count(*) > 1
UNION ALL SELECT DISTINCT review_id, page, 'evidence_changed' FROM ev WHERE NOT EXISTS (SELECT 1 FROM fi WHERE fi.path = ev.path AND fi.hash = ev.hash)
UNION ALL SELECT DISTINCT path, NULL::INT, 'no_pages' FROM documents WHERE path NOT IN (SELECT review_id FROM e)""")
def page_guards(t):
    p = t("pages").where("page IS NOT NULL")
    entries = p.select(
        F.col("path").alias("review_id"), "path", "page", F.col("result").isNotNull().alias("approved"), F.when(F.col("text_chars") > 300, F.col("book_id")).alias("reviewer"),
        F.col("flags").alias("reason"), F.col("text_layer").alias("replacement"),
    )
    evidence = p.where("text_layer IS NOT NULL").select(F.col("path").alias("review_id"), "page", "path", F.sha2("text_layer", 256).alias("hash"))
    files = p.where("native_text IS NOT NULL").select("path", F.sha2("native_text", 256).alias("hash")).unionByName(
        p.where("text_layer IS NOT NULL AND page = 1").select("path", F.sha2("text_layer", 256).alias("hash"))
    )
    plans = t("documents").select(F.col("path").alias("review_id")).unionByName(entries.select("review_id"))
    return review.page_problems(plans, entries, evidence, files, p.where("native_text IS NOT NULL"))


@query("""SELECT page_key, sha256(text_layer) AS before_hash, sha256(coalesce(native_text, text_layer)) AS after_hash,
  sha256(text_layer) IS DISTINCT FROM sha256(coalesce(native_text, text_layer)) AS changed FROM pages""")
def edit_receipts(t):
    p = t("pages")
    return review.receipts(p, p.select("page_key", F.coalesce("native_text", "text_layer").alias("text_layer")), "page_key", "text_layer")


# -- further reports ---------------------------------------------------------------
@query(f"""{K._AB}, z AS (SELECT lang, book_id, {S.compare5('a', 'b')} AS comparison FROM ab JOIN (SELECT page_key, lang FROM pages) USING (page_key))
SELECT lang, comparison, count(*) AS n, count(DISTINCT book_id) AS books FROM z GROUP BY ALL""")
def compare_nested(t):
    out = K.compare.compared(t("pages")).groupBy("lang", "comparison")
    return out.agg(F.count("*").alias("n"), F.count_distinct("book_id").alias("books"))


@query("""SELECT run_id, count(*) AS files, count(*) FILTER (status = 'error') AS errors, count(*) FILTER (error_message = 'file changed during scan') AS changed,
  count(*) FILTER (error_message IS NOT NULL) AS issues FROM scan_ledger GROUP BY run_id""")
def run_counts(t):
    return t("scan_ledger").groupBy("run_id").agg(
        F.count("*").alias("files"), F.count_if(F.col("status") == "error").alias("errors"),
        F.count_if(F.col("error_message") == "file changed during scan").alias("changed"), F.count_if(F.col("error_message").isNotNull()).alias("issues"),
    )


@query(f"""{_PASS} SELECT s0.page_key, (length(s0.c) - length(s7.c))::BIGINT AS chars, (strlen(s0.c) - strlen(s7.c))::BIGINT AS bytes FROM s0 JOIN s7 USING (page_key) WHERE s0.c <> s7.c""")
def pass_delta(t):
    c = _suspect(t).withColumn("a", R.rewrite(F.col("c"))).where("a <> c")
    return c.select("page_key", n(F.length("c") - F.length("a")).alias("chars"), n(F.octet_length("c") - F.octet_length("a")).alias("bytes"))


_DOCS = """(SELECT doc_id, CASE source WHEN 'course' THEN '---' || chr(10) || 'title: x' || chr(10) || '  more' || chr(10) || '---' || chr(10) || '## Page 1' || chr(10) || 'a' || chr(10) || '## Page 2' || chr(10) || 'b'
  WHEN 'article' THEN '---' || chr(10) || 'no key' || chr(10) || '---' || chr(10) || '## Page 1' || chr(10) || '## Page 1' ELSE text END AS text FROM documents)"""


@query(f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM {_DOCS}),
e AS (SELECT doc_id, t, list_transform(regexp_extract_all({S.body('t')}, '(?m)^## Page (\\d+)[ \\t]*$', 1), lambda x: x::INT) AS p,
  list_filter(string_split({S.front('t')}, chr(10)), lambda x: trim(x) <> '' AND NOT regexp_full_match(x, '([^\\s:][^:]*:(\\s.*)?|\\s.*|-\\s.*|#.*)')) AS bad FROM d)
SELECT doc_id, code FROM (SELECT doc_id, unnest([CASE WHEN NOT regexp_matches({S.newlines('t')}, '(?s)\\A---\\n.*?\\n---(\\n|\\z)') THEN 'missing_frontmatter' END, CASE WHEN len(bad) > 0 THEN 'invalid_yaml' END,
  CASE WHEN len(p) = 0 OR p <> range(1, len(p) + 1) THEN 'invalid_page_sequence' END, CASE WHEN len(list_distinct(p)) < len(p) THEN 'repeated_page' END]) AS code FROM e) WHERE code IS NOT NULL""")
def document_issues(t):
    text = (
        F.when(F.col("source") == "course", "---\ntitle: x\n  more\n---\n## Page 1\na\n## Page 2\nb")
        .when(F.col("source") == "article", "---\nno key\n---\n## Page 1\n## Page 1")
        .otherwise(F.col("text"))
    )
    return ingest.document_issues(t("documents").select("doc_id", text.alias("text")), "doc_id")


@query("""WITH b AS (SELECT lower(trim(source_hash)) AS h, min(book_id) AS src FROM books WHERE source_hash IS NOT NULL GROUP BY 1),
l AS (SELECT path, sha256(concat('v1', chr(0), coalesce(lower(trim(text_hash)), ''), chr(0), coalesce(lower(trim(source_hash)), ''), chr(0), coalesce(src, ''))) AS sig FROM scan_ledger LEFT JOIN b ON lower(trim(source_hash)) = h WHERE status = 'complete'),
d AS (SELECT doc_id, path, sha256(concat('v1', chr(0), coalesce(lower(trim(text_hash)), ''), chr(0), coalesce(lower(trim(source_hash)), ''), chr(0), coalesce(src, ''))) AS sig FROM documents LEFT JOIN b ON lower(trim(source_hash)) = h)
SELECT doc_id FROM d WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.path = d.path AND l.sig = d.sig)""")
def signature_sources(t):
    sources = t("books").select("source_hash", F.col("book_id").alias("path"))
    plain = lambda c: F.lower(F.trim(c))
    sig = ingest.signature("v1", plain("text_hash"), plain("source_hash"), F.col("source_path")).alias("sig")
    store = K.compare.match_sources(t("scan_ledger").where("status = 'complete'"), sources).select("path", sig)
    now = K.compare.match_sources(t("documents"), sources).select("doc_id", "path", sig)
    return ingest.outdated(now, store, ["path", "sig"]).select("doc_id")


@query("""WITH e AS (SELECT user_id, event_id, ts, event_type, props, row_number() OVER (PARTITION BY user_id ORDER BY value DESC NULLS LAST, event_id) AS r FROM events),
k AS (SELECT user_id, r, CASE WHEN trim(coalesce(event_type, '')) = '' AND trim(coalesce(props, '')) = '' THEN NULL ELSE '- [情景 ' || substr(ts::VARCHAR, 1, 10) || '] ' || substr(trim(coalesce(event_type, '')), 1, 80) || '：' || substr(trim(coalesce(props, '')), 1, 300)
  || chr(10) || '- [事实] ' || event_id || chr(10) || '- [事实] ' || substr(repeat(event_type, 40), 1, 150) END AS x FROM e WHERE r <= 3)
SELECT user_id, string_agg(x, chr(10) ORDER BY r) AS shown FROM k GROUP BY user_id""")
def recall_lines(t):
    w = K.Window.partitionBy("user_id").orderBy(F.desc_nulls_last("value"), "event_id")
    best = t("events").withColumn("r", F.row_number().over(w)).where("r <= 3")
    facts = F.array(F.col("event_id").cast("string"), F.repeat("event_type", 40), F.lit("never shown"))
    lines = best.select("user_id", "r", X.recalled(F.col("ts"), F.col("event_type"), F.col("props"), facts).alias("l"))
    joined = F.array_join(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("r", "l"))), lambda x: x["l"])), "\n")
    return lines.groupBy("user_id").agg(F.nullif(joined, F.lit("")).alias("shown"))


# SQL of two queries of the catalogue whose parts are stated here.
SQL["rewrite_all"] = (
    _PASS.replace(f"translate({_DERIVED}, '{K._SUB[0]}', '{K._SUB[1]}') AS c", "text_layer AS c") + " SELECT page_key, c AS text FROM s7"
)
SQL["compose_layers"] = f"""WITH c AS (SELECT path, page, {K._NAT} AS nat, {K._SCAN} AS sc FROM pages),
d AS (SELECT path, page, CASE WHEN length({S.squeeze('nat')}) < 50 AND length({S.squeeze('sc')}) > length({S.squeeze('nat')}) THEN sc ELSE nat END AS t FROM c)
SELECT path, string_agg('## Page ' || page || chr(10) || chr(10) || t, chr(10) || chr(10) ORDER BY page, t) AS markdown FROM d GROUP BY path"""
