"""Sentence units of texts in many languages and scripts.

``units(text)`` runs a pushdown automaton over the text's marks.  The stack
holds open quotations and brackets; list, heading and table levels are states
of the line scanner that feeds it.  A full stop is decided against
abbreviation tries read backwards from the stop.  Offsets count code points
of the text as stored.

Results by case: a null or blank text has no unit; a text without any mark
gives its lines.  A first pass pairs the quotation marks and brackets of a
block, a second runs the automaton; quotations may have any length.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread
from . import furniture as Fu
from . import counts as C
from .skeleton import TABLE

# Abbreviations by what follows them.
NEVER_END = """dr prof mr mrs ms m hr fr st mme mlle mm vgl cf e.g i.e eg ie z.b d.h u.a
bzw ca vs viz resp sog al approx dept ed eds rev gen gov sen rep hon capt lt sgt col
नं डॉ श्री पं प्रो""".split()
BEFORE_NUMBER = """no nos vol vols p pp fig figs ch sec art s bd nr abb kap tab t n c ed
eq ex ref chap v nº jan feb mar apr jun jul aug sep sept oct nov dec क्र सं""".split()
MAY_END = "inc ltd co corp plc llc gmbh ag a.m p.m etc ff usw jr sr u.s u.k ph.d".split()


def trie(words: list[str], tag: str, root: dict) -> dict:
    """Words spelled backwards; "" at a node holds the kind of a whole word."""
    for w in words:
        node = root
        for c in reversed(w):
            node = node.setdefault(c, {})
        node[""] = tag
    return root


ABBREVIATIONS: dict = {}
trie(NEVER_END, "never", ABBREVIATIONS)
trie(BEFORE_NUMBER, "number", ABBREVIATIONS)
trie(MAY_END, "may", ABBREVIATIONS)

OPEN = {"“": "”", "„": "“", "«": "»", "「": "」", "『": "』", "《": "》", "(": ")",
        "（": "）", "[": "]", "［": "］", "【": "】", "〔": "〕", "〈": "〉"}
QUOTES = set("“„«「『\"")
CLOSERS = set("”“»」』\"’》)）]］】〕〉")
HARD = "。｡！？!?।॥"
_TOKEN = re.compile(r"[“”„«»「」『』\"《》()（）\[\]［］【】〔〕〈〉]|[。｡！？!?।॥．.…]+")
_PAIRED = re.compile(r"[“”„«»「」『』\"《》()（）\[\]［］【】〔〕〈〉]")
_THAI = re.compile(r"[฀-๿]")
_THAI_GAP = re.compile(r"(?<=\S)[ \u00a0\u2007\u202f\u3000]+(?=\S)")
_FINAL = re.compile(r"[。｡！？!?।॥…]|[^\s\d.．][.．](?=[\s”\"»)）]|$)|\d[.．]\s*$", re.M)
_SPACED = re.compile(r"[぀-ヿ㐀-鿿]")
_CHAPTER = re.compile(r"第\S{1,5}[章节回部篇]\s")
_GAP = re.compile(r"\s+")
_WORDY = re.compile(r"[^\W_]")
_HEADING = re.compile(r"^\s*[#＃]{1,6}[\s\u3000]")
_ITEM = re.compile(
    r"^\s*(?:[-*+•·‣◦‐‑－＊][\s\u3000]+|[(（][0-9０-９a-zA-Zivx一二三四五六七八九十]{1,4}[)）]\s*|"
    r"[0-9０-９]{1,3}(?:[.)）．]\s|、|[)）]\s*)|[a-zA-Z][)）]\s)"
)
_TABLE = re.compile(r"^\s*[|｜].*[|｜]\s*$")
_ATTRIBUTION = re.compile(
    r"^[^。！？!?।，,；;：:“\n]{0,30}?(?:(?:(?<![来據据传小])[说說]|道|问|問|喊|叫|答|提醒|写|告诉)"
    r"(?:道|着|了)?(?:大家|我们?|你们?|他们?|她们?|自己)?[，,。：:！!？?]|"
    r"(?:言った|聞いた|叫んだ|答えた|(?:कहा|पूछा|बोला|बोली|चिल्लाया))[。।，、,!?])"
)
_ON = re.compile(r"^(?:[,，、;；:：)）]|と|って|之后|之後|然后便|以后|后便|的|か、|が、|は、)")
_SAID_BEFORE = re.compile(r"(?:[:：]|(?:说|說|问|問|道|答|喊)[,，])\s*$")
# Thai words that carry a sentence over a blank.
_TH_ON_AFTER = re.compile(
    r"(?:ที่|สำนัก|ว่า|นาย|นาง|นางสาว|ของ|โดย|และ|แต่|หรือ|ใน|กับ|จาก|เป็น|คือ|ปี|เมื่อ|ตำบล|อำเภอ|จังหวัด|"
    r"เมือง|หมู่บ้าน|ราว|ประมาณ|เพิ่มขึ้น|ลดลง|ร้อยละ|เล่ม|หน้า|ข้อ|(?<![฀-๿])[ก-ฮ][.．]|[,:;(“«])$"
)
_TH_ON_BEFORE = re.compile(
    r"^(?:[0-9๐-๙]|ฯลฯ|ๆ|แล้ว|และ|แต่|ซึ่ง|ใน|ที่|หรือ|เพราะ|ว่า|เปอร์เซ็นต์|ร้อยละ|ชิ้น|อัน|คน|บาท|ตัว|เล่ม|"
    r"กิโลกรัม|เมตร|จึง|ทั้งนี้|อย่างไรก็ตาม|โดย|เมื่อ|ของ|กับ|จาก|น\.|[,:;)”»“])"
)


# Names after which a German ordinal number stands in a date.
MONTHS = """januar februar märz april mai juni juli august september oktober november dezember
jahrhundert""".split()
_DATE = re.compile(r"\s*(" + "|".join(MONTHS) + r")\b", re.I)


def _plain(c: str) -> str:
    """A letter in its ordinary form: wide forms and look-alikes undone."""
    if c.isascii():
        return c
    p = TABLE[ord(c)]
    return p if isinstance(p, str) and len(p) == 1 else c


def _abbreviation(text: str, at: int, start: int) -> str:
    """Kind of the abbreviation that ends before the stop at ``at``, or ""."""
    node, i, found = ABBREVIATIONS, at - 1, ""
    while i >= start:
        c = _plain(text[i]).lower()
        if c.isspace() and i > start and text[i - 1] in ".．":
            c = ""  # "z. B." is spelled as "z.B."
        if c:
            node = node.get(c)
            if node is None:
                break
        i -= 1
        if "" in node and c and (i < start or not (text[i].isalnum() or text[i] == ".")):
            found = node[""]
    return found


def _ends_at_stop(text: str, i: int, j: int, start: int, end: int, nxt: str, gap: bool) -> bool:
    """Whether the run of stops text[i:j] ends a sentence.  nxt: the next
    character that is no blank, gap: whether a blank stands before it."""
    run = text[i:j]
    if any(c in HARD for c in run):
        return True
    if i and text[i - 1] in "‖¦~":
        return False  # a stray scan mark
    if "…" in run or j - i >= 2:  # an ellipsis
        if not nxt:
            return True
        return gap and (nxt.isupper() or nxt in QUOTES)
    before = _plain(text[i - 1]) if i > start else ""
    if not before or before.isspace():
        return False
    if before.isdigit() and _DATE.match(text, j):
        return False
    if not nxt:
        return _abbreviation(text, i, start) in ("", "may")
    if before.isdigit() and nxt.isdigit():
        return False
    wide = text[i] == "．"
    if not gap and not (wide and not nxt.isalnum()) and nxt not in CLOSERS and not Fu.unicodedata.category(nxt).startswith("Lo"):
        return False
    if nxt.islower():
        return False
    kind = _abbreviation(text, i, start)
    if kind == "never":
        return False
    if kind == "number":
        return not (nxt.isdigit() or nxt.isalpha())
    if kind == "may":
        return not nxt.isdigit()
    if "฀" <= before <= "๿":
        return False
    if before.isalpha() and before < "\u0250" and (i - 2 < start or not text[i - 2].isalnum()):
        return False  # an initial, or one letter of an abbreviation
    return True


def _goes_on(text: str, opened: int, close: int, end: int) -> bool:
    """Whether the sentence goes on after a quotation that a mark closes."""
    rest = text[close : min(end, close + 60)].lstrip()
    if not rest:
        return False
    if rest[0].islower() or _ON.match(rest):
        return True
    if _SAID_BEFORE.search(text[max(0, opened - 6) : opened]):
        return False
    return bool(_ATTRIBUTION.match(rest))


def closers(text: str, spans: list[tuple[int, int]]) -> set[int]:
    """Places of the openers in a block that are closed in it, however far
    away.  A closer belongs to the last opener of its kind; what was opened
    between the two and not closed stays open."""
    out: set[int] = set()
    stack: list[tuple[str, int]] = []
    waiting: Counter = Counter()
    for a, b in spans:
        for m in _PAIRED.finditer(text, a, b):
            c, i = m[0], m.start()
            if waiting[c]:
                while True:
                    close, at = stack.pop()
                    waiting[close] -= 1
                    if close == c:
                        break
                out.add(at)
            elif c in OPEN or c == '"' and (i == 0 or text[i - 1].isspace() or text[i - 1] in "([（"):
                stack.append((OPEN.get(c, c), i))
                waiting[stack[-1][0]] += 1
    return out


class Automaton:
    """Scans the lines of one block; the stack lives over line ends."""

    def __init__(self, text: str, thai: bool, out: list[tuple[int, int]]):
        self.text, self.thai, self.out = text, thai, out
        self.start = -1  # of the unit under way
        self.last = -1  # end of its text so far
        self.stack: list[tuple[str, int]] = []

    def emit(self, end: int) -> None:
        if self.start >= 0 and _WORDY.search(self.text, self.start, end):
            self.out.append((self.start, end))
        self.start = -1

    def flush(self) -> None:
        if self.start >= 0:
            self.emit(self.last)
        self.stack.clear()

    def block(self, spans: list[tuple[int, int]]) -> None:
        self.closer = closers(self.text, spans)
        for k, (a, b) in enumerate(spans):
            self.line(a, b, spans[k + 1 :])
        self.flush()

    def _next(self, at: int, b: int, later: list[tuple[int, int]]) -> tuple[str, bool]:
        text = self.text
        j = at
        while j < b and text[j].isspace():
            j += 1
        if j < b:
            return text[j], j > at
        for x, _ in later:
            return text[x], True
        return "", True

    def line(self, a: int, b: int, later: list[tuple[int, int]]) -> None:
        text = self.text
        at = a
        if self.thai and self.start >= 0 and not self.stack and self._thai_end(self.start, self.last, a, b):
            self.emit(self.last)
        if self.thai:
            marks = sorted(
                [(m.start(), m.end()) for m in _TOKEN.finditer(text, a, b)]
                + [(m.start(), m.end()) for m in _THAI_GAP.finditer(text, a, b)]
            )
        else:
            marks = [m.span() for m in _TOKEN.finditer(text, a, b)]
        for i, j in marks:
            if i < at:
                continue
            c = text[i]
            if self.start < 0:
                s = at
                while s < j and text[s].isspace():
                    s += 1
                if s == j:
                    continue
                self.start = s
            if c.isspace():
                if not self.stack and self._thai_end(self.start, i, j, b):
                    self.emit(i)
                    at = j
                continue
            if self.stack and c == self.stack[-1][0] and not (c == "“" and self.stack[-1][0] != "“"):
                self.stack.pop()
                continue
            if c in OPEN or c == '"':
                if i in self.closer:  # one that is never closed opens nothing
                    self.stack.append((OPEN.get(c, '"'), i))
                continue
            if c not in HARD and c not in ".．…":
                continue  # a closer without its opener
            nxt, gap = self._next(j, b, later)
            end, opened, depth = j, -1, len(self.stack)
            while depth:  # closers that belong to the sentence
                k = end
                while k < b and text[k] in " \u00a0\u202f\u2007":
                    k += 1
                if k < b and text[k] == self.stack[depth - 1][0]:
                    depth -= 1
                    opened, end = self.stack[depth][1], k + 1
                else:
                    break
            while end < b and text[end] in "¹²³":
                end += 1
            if depth:
                continue  # still inside a quotation or bracket
            if end > j and opened >= 0:
                nxt, gap = self._next(end, b, later)
                if nxt and not gap and text[end : end + 1] and c in ".．" and nxt.isalnum() and text[opened] not in QUOTES:
                    continue
            if not _ends_at_stop(text, i, j, self.start, b, nxt, gap or end > j):
                continue
            if opened >= 0:
                del self.stack[depth:]
                at = end
                rest = text[end:b] + "".join(text[x:y] for x, y in later[:2])
                if text[opened] in QUOTES and _goes_on(text[opened - 6 if opened > 6 else 0 : opened] + rest, min(6, opened), min(6, opened), 10**9):
                    continue
            self.emit(end)
            at = end
        if at < b and not text[at:b].isspace():
            if self.start < 0:
                while text[at].isspace():
                    at += 1
                self.start = at
            self.last = b
            while text[self.last - 1].isspace():
                self.last -= 1
        elif self.start >= 0:
            self.last = max(self.last, at)

    def _thai_end(self, start: int, i: int, j: int, b: int) -> bool:
        """Whether the blank text[i:j] ends a Thai sentence."""
        text = self.text
        left, right = text[max(start, i - 16) : i], text[j : min(b, j + 16)]
        if not _THAI.search(left) or not right:
            if not (left and left[-1].isdigit() and right and _THAI.match(right)):
                return False
        if not _THAI.match(right) and right[0] not in "“":
            return False
        if _TH_ON_BEFORE.match(right) or _TH_ON_AFTER.search(left):
            return False
        return True


def _lines_are_units(text: str, spans: list[tuple[int, int]]) -> bool:
    """In text without final marks; but lines of one width are wrapped text."""
    if any(_FINAL.search(text, a, b) for a, b in spans):
        return False
    widths = [b - a for a, b in spans[:-1]]
    return not (len(widths) >= 3 and min(widths) >= 20 and max(widths) - min(widths) <= 2)


_CLOSING = "。！？!?.:：;；”\"»」』"


def units(text: str | None, drop: set[int] | None = None, spans=None) -> list[tuple[int, int]]:
    """(start, end) of each sentence unit, in order.

    drop: indexes of lines, in ``furniture.split_lines``, that are no text; a
    unit they interrupt goes on after them.
    """
    if not text or text.isspace():
        return []
    spans = Fu.split_lines(text) if spans is None else spans
    thai = bool(_THAI.search(text))
    kept: list[tuple[int, int, str]] = []  # start, end, kind of line
    numbers: list[int] = []  # lines that begin like a numbered item
    for n, (a, b) in enumerate(spans):
        if drop and n in drop:
            continue
        while b > a and text[b - 1].isspace():
            b -= 1
        while a < b and text[a].isspace():
            a += 1
        if a == b:
            kept.append((a, b, "blank"))
            continue
        c = text[a]
        if c in "|｜":
            kind = "own" if _TABLE.match(text[a:b]) else "text"
        elif c in "#＃":
            kind = "own" if _HEADING.match(text[a:b]) else "text"
        elif c in "[［" and Fu.PLACEHOLDER.match(text[a:b]):
            continue
        elif not c.isalpha() or (b > a + 1 and text[a + 1] in ")）"):
            kind = "item" if _ITEM.match(text[a : a + 12]) else "text"
            if kind == "item" and (c.isdigit() or c.isalpha()):
                if b - a <= 4 and text[a:b].rstrip(".．").isdigit():
                    kind = "text"  # the rest of a wrapped line
                else:
                    numbers.append(len(kept))
        else:
            kind = "text"
        kept.append((a, b, kind))
    if len(numbers) == 1:  # one alone, inside running text, is wrapped text
        k = numbers[0]
        if k and kept[k - 1][2] == "text":
            a, b, _ = kept[k - 1]
            if text[b - 1] not in _CLOSING or _abbreviation(text, b - 1, a) in ("number", "never"):
                kept[k] = (*kept[k][:2], "text")
    body = [(a, b) for a, b, k in kept if k == "text"]
    loose = bool(body) and _lines_are_units(text, body)
    out: list[tuple[int, int]] = []
    block: list[tuple[int, int]] = []
    item = False
    levels: list[int] = []  # indents of the open list items
    auto = Automaton(text, thai, out)

    def close() -> None:
        nonlocal item
        if not block:
            return
        if item and not any(_FINAL.search(text, a, b) for a, b in block):
            out.append((block[0][0], block[-1][1]))
        elif item:
            out.append((block[0][0], block[-1][1]))
        elif loose and not thai:
            one = len(block) == 1 and (len(body) == 1 or block[0][1] - block[0][0] > 45)
            if one and _SPACED.search(text, *block[0]) and not _CHAPTER.match(text[block[0][0] : block[0][0] + 8]):
                at, end = block[0]
                first = at
                for m in _GAP.finditer(text, at, end):
                    a, b = m.span()
                    # blanks beside a single character are spaced letters
                    if a - 2 >= first and not text[a - 2].isspace() and b + 1 < end and not text[b + 1].isspace():
                        out.append((at, a))
                        at = b
                out.append((at, block[0][1]))
            else:
                out.extend(s for s in block if _WORDY.search(text, *s))
        else:
            auto.block(block)
        block.clear()
        item = False

    for a, b, kind in kept:
        if kind == "blank":
            close()
        elif kind == "own":
            close()
            levels.clear()
            out.append((a, b))
        elif kind == "item":
            close()
            indent = a - 1 - max(text.rfind("\n", 0, a), text.rfind("\r", 0, a))
            while levels and levels[-1] >= indent:
                levels.pop()
            levels.append(indent)
            block.append((a, b))
            item = True
        else:
            if item and len(levels) > 1:
                # back under an outer item: text of its own, not of the inner one
                indent = a - 1 - max(text.rfind("\n", 0, a), text.rfind("\r", 0, a))
                if levels[0] < indent <= levels[-1]:
                    close()
                    while levels[-1] >= indent:
                        levels.pop()
            block.append((a, b))
    close()
    return out


def page_counts(batch: pa.RecordBatch, counts: dict) -> None:
    book, page = batch.column("book_id").to_pylist(), batch.column("page").to_pylist()
    for field in ("text_layer", "native_text"):
        if field in batch.schema.names:
            for b, p, t in zip(book, page, batch.column(field).to_pylist(), strict=True):
                if t:
                    Fu.count_edges(b, p, t, counts)


def page_sketch(pages: DataFrame, fields=("text_layer", "native_text")) -> C.Lines:
    """The running lines of all pages."""
    return C.lines(pages.select("book_id", "page", *fields), page_counts)


def sentence_units(
    df: DataFrame, key: str, text: str, field: str, sketch: C.Lines | None = None
) -> DataFrame:
    """One row per unit: field, unit_key, unit_no (from 1), start_char, end_char.

    start_char counts the characters before the unit, end_char those up to and
    with its last.  With a sketch (pages: columns book_id and page) furniture
    lines are no text.  Null keys are kept; null and blank texts have no rows.
    No shuffle: rows are read and split where they lie.
    """
    spark = df.sparkSession
    given = spark.sparkContext.broadcast(sketch) if sketch is not None else None
    columns = [F.col(key).cast("long").alias("k"), F.col(text).alias("t")]
    if given is not None:
        columns += [F.col("book_id").alias("book"), F.col("page").cast("int").alias("page")]

    def run(batches):
        detector = Fu.Detector(given.value) if given is not None else None
        for batch in batches:
            keys, texts = batch.column("k").to_pylist(), batch.column("t").to_pylist()
            if detector is not None:
                books, pages = batch.column("book").to_pylist(), batch.column("page").to_pylist()
            ks, ns, ss, es = [], [], [], []
            for r, t in enumerate(texts):
                if not t:
                    continue
                spans = Fu.split_lines(t)
                drop = detector.lines(books[r], pages[r], t, spans) if detector is not None else None
                found = units(t, drop, spans)
                ks += [keys[r]] * len(found)
                ns += range(1, len(found) + 1)
                for s, e in found:
                    ss.append(s)
                    es.append(e)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ks, pa.int64()), pa.array(ns, pa.int32()), pa.array(ss, pa.int64()), pa.array(es, pa.int64())],
                names=["unit_key", "unit_no", "start_char", "end_char"],
            )

    return (
        spread(df.select(*columns))
        .mapInArrow(run, "unit_key long, unit_no int, start_char long, end_char long")
        .select(F.lit(field).alias("field"), "*")
    )
