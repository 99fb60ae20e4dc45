"""Lines of a page that are no text of it: headers, page numbers, marks.

Running lines are found by fuzzy repetition: a line at a page edge is reduced
to a key in which scanning faults, case, blanks, digits and look-alikes make
no difference, keys are counted over the pages of a book, and a key that
stands on enough distinct pages of its book is furniture wherever it stands.
Page numbers are found by their form and, where a bare number could be text,
by being the number of the page.
"""

from __future__ import annotations

import re
import unicodedata

import xxhash

from .counts import Lines

BREAK = re.compile(r"\r\n|\n|\r")
EDGE = 3  # lines from either end of a page that are counted
WHOLE = 64  # a key of more characters is held as its digest
PLACEHOLDER = re.compile(r"^\s*[\[［]本页未提取到文本.{0,20}[\]］]\s*$")

# Characters that scanning takes for one another, wrong -> right.
MISREAD_HAN = {
    "旳": "的", "夫": "天", "干": "于", "千": "于干", "于": "干千", "朗": "期",
    "问": "间", "重": "量", "量": "重", "队": "认", "失": "先", "卒": "率",
    "析": "折", "太": "大", "贷": "货", "术": "木", "木": "术", "巿": "市",
    "末": "未", "已": "己", "人": "入", "入": "人", "曰": "日", "土": "士",
    "り": "い", "ほ": "は", "お": "を", "だ": "た", "た": "だ", "て": "で",
    "で": "て", "一": "ー",
}
MISREAD_LATIN = [
    ("c", "e"), ("e", "c"), ("l", "i"), ("i", "l"), ("f", "t"), ("t", "f"),
    ("u", "n"), ("n", "u"), ("h", "b"), ("b", "h"), ("rn", "m"), ("m", "rn"),
    ("ii", "u"), ("u", "ii"), ("ii", "ü"), ("li", "h"), ("h", "li"), ("l", "I"),
    ("1", "l"), ("1", "i"), ("0", "o"), ("5", "s"), ("0", "O"), ("1", "I"),
    ("cl", "d"), ("d", "cl"), ("vv", "w"), ("8", "B"), ("6", "b"), ("9", "g"),
]

_CLASS = {
    **{k: v[0] for k, v in MISREAD_HAN.items() if k not in "于量木入でた"},
    **{"千": "干", "于": "干", "量": "重", "术": "木"},
    **dict(zip("1i|05cfubh", "lllosetnoo", strict=True)),
    **dict(zip("аеорсухο", "aeopcyxo", strict=True)),
}
_CLASS |= {k: _CLASS.get(v, v) for k, v in _CLASS.items()}


class _Fold(dict):
    """Character -> its class, worked out once for each character."""

    def __missing__(self, code: int) -> str:
        out = ""
        for c in unicodedata.normalize("NFD", unicodedata.normalize("NFKC", chr(code)).lower()):
            if c.isalnum():
                c = _CLASS.get(c, c)
                out += "" if c.isdigit() else c
        self[code] = out
        return out


_FOLD = _Fold()
_NUMBER = re.compile(r"(?<![^\W\d_])[\dlOIo]{1,4}(?![^\W\d_])")
_DIGIT = re.compile(r"\d")


def line_key(line: str) -> str:
    """The fuzzy key of a line; empty for lines without letters.

    Numbers go first, then forms are unified and characters that scanning
    takes for one another fall together.
    """
    if _DIGIT.search(line):
        line = _NUMBER.sub(" ", line)
    key = line.translate(_FOLD).replace("rn", "m").replace("ll", "n")
    return key if len(key) <= WHOLE else f"#{xxhash.xxh3_128_hexdigest(key)}"


# numbers with a part, and what is left of a measure at a wrapped line's end
_MEASURE = re.compile(r"^\s*\d+[.,]\d|\d[.,]\d+\s*(?:%|เปอร์เซ็นต์|パーセント|Prozent|points?\b)|^\s*(?:เปอร์เซ็นต์|ชิ้น|อัน|ฯลฯ)\s*$")
_DASH = re.compile(r"\s[—–―-]\s")


def keys_of(line: str) -> list[str]:
    """Keys under which a line may be running: the whole, and what stands
    before a dash (book title before the chapter's)."""
    if _MEASURE.search(line):
        return []
    whole = line_key(line)
    if len(whole) < 3:
        return []
    m = _DASH.search(line)
    head = line_key(line[: m.start()]) if m else ""
    return [whole, head] if len(head) >= 3 and head != whole else [whole]


_NUM = r"[0-9０-９lIOo]{1,5}"
_DECORATED = re.compile(
    rf"^\s*(?:[-‐‑–—−·•*~]\s*{_NUM}\s*[-‐‑–—−·•*~]|[\[［(（【]\s*[0-9０-９lO]{{1,4}}\s*[\]］】]|"
    rf"{_NUM}\s*[/／]\s*{_NUM}|第\s*{_NUM}\s*[页頁ページ]+(?:\s*[共/／]\s*{_NUM}\s*[页頁]?)?|"
    rf"[Pp][aoc][gq][ec]\s*{_NUM}(?:\s*[o0][ft]\s*{_NUM})?|[Pp]\s*[.．]\s*{_NUM}|"
    rf"[Ss](?:eite|\.)\s*{_NUM}|{_NUM}\s*[页頁])\s*$"
)
_BARE = re.compile(r"^\s*[0-9０-９lIOoS]{1,4}\s*$")
_ROMAN = re.compile(r"^\s*(?=[ivxlcIVXLC1]{1,8}\s*$)[ivxlcIVXLC1]+\s*$")
_HAN_NUMBER = re.compile(r"^\s*[〇○零一二三四五六七八九十百]{1,4}\s*$")
_MARKS = re.compile(r"^[\s‖|~…._·•°'`^¦:;,*=+\-–—]*(?:[oOxv.,]{0,2})[\s‖|~…._·•°'`^¦]*$")
_MARK_SIGN = re.compile(r"[‖¦]|[.…·]{3}|~")


def roman(n: int) -> str:
    out = ""
    for v, s in ((100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
        while n >= v:
            out, n = out + s, n - v
    return out


def han_numbers(n: int) -> set[str]:
    digits = "〇一二三四五六七八九"
    plain = "".join(digits[int(c)] for c in str(n))
    out = {plain, plain.replace("〇", "零"), plain.replace("〇", "○")}
    if 10 <= n < 100:
        t, u = divmod(n, 10)
        out.add(("" if t == 1 else digits[t]) + "十" + (digits[u] if u else ""))
    elif n < 10:
        out.add(digits[n])
    return out


def number_of(s: str) -> int | None:
    s = unicodedata.normalize("NFKC", s).strip().translate(str.maketrans("lIOoS", "11005"))
    return int(s) if s.isascii() and s.isdigit() else None


def is_page_number(line: str, page: int | None, edge: bool) -> bool:
    """A line that is only a page number.  Decorated numbers count by form;
    bare, roman and Chinese numbers only at an edge and as the page's own."""
    if len(line) > 40:
        return False
    if _DECORATED.match(line):
        return True
    if not edge or page is None:
        return False
    if _BARE.match(line):
        return number_of(line) == page
    if _ROMAN.match(line) and page < 400:
        return line.strip().lower().replace("1", "l") in (roman(page), roman(page).replace("i", "l"))
    if _HAN_NUMBER.match(line):
        return line.strip() in han_numbers(page)
    return False


def is_scan_mark(line: str) -> bool:
    return len(line) <= 24 and bool(_MARKS.match(line)) and bool(_MARK_SIGN.search(line))


def split_lines(text: str) -> list[tuple[int, int]]:
    """(start, end) of each line without its break."""
    out, at = [], 0
    if "\r" not in text:
        for line in text.split("\n"):
            out.append((at, at + len(line)))
            at += len(line) + 1
        return out
    for m in BREAK.finditer(text):
        out.append((at, m.start()))
        at = m.end()
    out.append((at, len(text)))
    return out


def stray_width(longest: int) -> float:
    """How long a running line inside a page may be: well shorter than the
    text's own lines, where those are long.  At an edge it may have any length."""
    return max(48, 0.6 * longest)


def _numbered(line: str, page: int | None) -> bool:
    """A line with text that begins or ends with the page's number."""
    if page is None or not _DIGIT.search(line):
        return False
    m = _OUTER.match(line)
    return bool(m) and any(x and number_of(x) == page for x in m.groups())


_OUTER = re.compile(r"^\s*([0-9０-９lO]{1,4}(?=\s))?.*?((?<=\s)[0-9０-９lO]{1,4})?\s*$")


def count_edges(book: str | None, page: int | None, text: str, counts: dict) -> None:
    """Adds the edge lines of one page to the corpus counts.

    "L": the key within its book, at an edge or as a short line without marks
    inside; "H": the key, of whatever book, where the line carries the page's
    number.
    """
    lines = [s for s in BREAK.split(text) if s and not s.isspace()]
    mask = 1 << ((page or 0) % 64)
    book = str(book)
    last = len(lines) - 1
    longest = max(map(len, lines), default=0)
    width = min(0.8 * longest, stray_width(longest)) if last > 3 else 0
    for n, s in enumerate(lines):
        inside = 1 < n < last - 1
        if inside and len(s) > width or _INNER.search(s) or not _LETTERS.search(s):
            continue
        numbered = not inside and _numbered(s, page)
        for k in keys_of(s):
            for key in (("L", book, k), ("H", "", k)) if numbered else (("L", book, k),):
                c = counts.get(key)
                if c is None:
                    counts[key] = [1, mask]
                else:
                    c[0] += 1
                    c[1] |= mask
    c = counts.setdefault(("P", book, ""), [0, 0])
    c[0] += 1
    c[1] |= mask


_INNER = re.compile(r"[!?。！？।，；、]|[.,;:](?:\s*$)|[,;]\s")  # marks of running text
_LETTERS = re.compile(r"[^\W\d_]{2}|[^\W\d_]\s[^\W\d_]\s")
_NUMBERISH = re.compile(r"[0-9０-９]|^\W*[ivxlcIVXLCO〇零一二三四五六七八九十百]+\W*$")
_THAI = re.compile(r"[\u0e00-\u0e7f]")


class Detector:
    """Decides lines against the running lines of the corpus."""

    def __init__(self, known: Lines | None):
        self.known = known

    def running(self, book: str | None, line: str, edge: bool) -> bool:
        if self.known is None:
            return False
        for k in keys_of(line):
            if (str(book), k) in self.known.own:
                return True
            if (edge or len(k) >= 5) and k in self.known.anywhere:
                return True
        return False

    def lines(
        self, book: str | None, page: int | None, text: str, spans: list[tuple[int, int]]
    ) -> set[int]:
        """Indexes of the furniture lines of a page."""
        full = [i for i, (a, b) in enumerate(spans) if b > a and not text[a:b].isspace()]
        out = set()
        last = len(full) - 1
        width = stray_width(max((spans[i][1] - spans[i][0] for i in full), default=0))
        for rank, i in enumerate(full):
            a, b = spans[i]
            s = text[a:b]
            edge = rank < EDGE or rank > last - EDGE
            if b - a <= 40:
                if _NUMBERISH.search(s):
                    if is_page_number(s, page, edge) or (
                        (rank in (0, last) and last > 0 and _BARE.match(s) or edge and _ROMAN.match(s))
                        and not _THAI.search(text)
                    ):
                        out.add(i)
                        continue
                elif _MARK_SIGN.search(s) and is_scan_mark(s):
                    out.add(i)
                    continue
            if (edge or b - a <= width) and not _INNER.search(s) and _LETTERS.search(s):
                if self.running(book, s, edge):
                    out.add(i)
        return out
