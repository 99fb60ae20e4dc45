"""Fragments of the SQL that states each query a second time."""

from __future__ import annotations

from ..functions.text import EMPTY_MARKERS, MARKED, STOPWORDS, UNMARKED

WS = r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
CJK = r"[\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}]"


def literal(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def newlines(c: str) -> str:
    return f"regexp_replace({c}, '\\r\\n?', chr(10), 'g')"


def body(c: str) -> str:
    return f"regexp_replace({newlines(c)}, '(?s)\\A---\\n.*?\\n---(\\n|\\z)', '')"


def front(c: str) -> str:
    return f"regexp_extract({newlines(c)}, '(?s)\\A---\\n(.*?)\\n---(\\n|\\z)', 1)"


def strip(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '\\A{WS}+', ''), '{WS}+\\z', '')"


def squeeze(c: str) -> str:
    return f"regexp_replace({c}, '{WS}+', '', 'g')"


def clean(c: str) -> str:
    out = f"string_split({c}, chr(10))"
    markers = ", ".join(literal(m) for m in EMPTY_MARKERS)
    return squeeze(f"array_to_string(list_transform({out}, lambda x: CASE WHEN x IN ({markers}) THEN '' ELSE x END), chr(10))")


def clean_scan(c: str, mark: str | None = None) -> str:
    lines = f"list_transform(string_split({newlines(c)}, chr(10)), lambda x: regexp_replace(x, '{WS}+\\z', ''))"
    if mark:
        lead = f"lower(regexp_replace(x, '\\A{WS}+', ''))"
        lines = f"list_filter({lines}, lambda x: {mark} IS NULL OR trim({mark}) = '' OR {lead} <> lower(trim({mark})))"
    return strip(f"regexp_replace(array_to_string({lines}, chr(10)), '\\n{{3,}}', chr(10) || chr(10), 'g')")


def clean_native(c: str) -> str:
    markers = ", ".join(literal(m) for m in EMPTY_MARKERS)
    kept = f"list_filter(string_split({clean_scan(c)}, chr(10)), lambda x: trim(x) NOT IN ({markers}) AND NOT starts_with(trim(x), '> [!warning] 本页'))"
    return clean_scan(f"array_to_string({kept}, chr(10))")


def tokens(c: str) -> str:
    stop = ", ".join(literal(w) for w in STOPWORDS)
    text = f"translate(lower({c}), '{MARKED}', '{UNMARKED}')"
    chars = f"string_split({text}, '')"
    words = rf"regexp_extract_all(regexp_replace({text}, '[\x{{3400}}-\x{{9FFF}}]', ' ', 'g'), '[\p{{L}}\p{{M}}\p{{N}}]+')"
    pairs = (
        f"list_filter(list_transform(list_zip({chars}, ({chars})[2:]), lambda z: z[1] || coalesce(z[2], '')), "
        r"lambda b: regexp_full_match(b, '[\x{3400}-\x{9FFF}]{2}'))"
    )
    return f"list_filter(list_concat({words}, {pairs}), lambda w: w NOT IN ({stop}))"


def estimate(c: str) -> str:
    found = rf"regexp_extract_all({c}, '[\x{{3400}}-\x{{9FFF}}]|[A-Za-z0-9_]+|[^\t-\r \x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]')"
    return f"coalesce(list_sum(list_transform({found}, lambda w: CASE WHEN regexp_matches(w, '^[A-Za-z0-9_]') THEN (length(w) + 3) // 4 ELSE 1 END)), 0)"


def compare5(a: str, b: str) -> str:
    return (
        f"CASE WHEN {a} = '' AND {b} = '' THEN 'both_empty_requires_visual_or_ocr' WHEN {a} = '' THEN 'text_missing_native_available' "
        f"WHEN {b} = '' THEN 'source_image_requires_visual' WHEN {a} = {b} THEN 'exact_after_layout_whitespace_only' "
        "ELSE 'character_difference_requires_review' END"
    )


def count(c: str, pattern: str) -> str:
    return f"len(regexp_extract_all({c}, {literal(pattern)}))"
