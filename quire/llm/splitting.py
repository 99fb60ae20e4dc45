"""Splitting oversized items at natural boundaries.

A text is parsed into a structure tree: sections by heading level, nested
lists and their items, tables and their rows, fenced blocks, paragraphs; a
leaf is cut at sentences, lines, clauses, words and at last characters.
Packing merges neighbouring siblings, from left to right, while they fit, and
opens only a node that is too large by itself.  Pieces are then laid over the
text so that each one begins up to ``overlap`` tokens before the end of the
one before it, again at a boundary where there is one.

Every piece is a slice of the stored text: nothing is lost and nothing is
made up; the slices cover all that is not blank.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import spread

LIMIT, OVERLAP = 480, 60
# Unicode White_Space, as text and as a class of Java's regex.
WHITE = "\t-\r \x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_TOKEN = re.compile(f"[A-Za-z0-9_]+|[^{WHITE}A-Za-z0-9_]")
_NOT_WHITE = re.compile(f"[^{WHITE}]")
_RUN = re.compile("[A-Za-z0-9_]+")
_OTHER = re.compile(f"[^{WHITE}A-Za-z0-9_]")


def tokens(text: str) -> int:
    """Estimated tokens: each run of ASCII letters, digits and underscores a
    quarter of its length, rounded up; every other visible character one."""
    return sum((len(w) + 3) // 4 for w in _RUN.findall(text)) + len(_OTHER.findall(text))


def tokens_column(c: Column) -> Column:
    """The same estimate as a column expression."""
    runs = F.regexp_extract_all(c, F.lit("[A-Za-z0-9_]+"), F.lit(0))
    other = F.regexp_count(c, F.lit(r"[^\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}A-Za-z0-9_]"))
    return (
        F.aggregate(runs, F.lit(0), lambda n, w: n + F.floor((F.length(w) + 3) / 4).cast("int")) + other
    ).cast("int")


class Meter:
    """Token counts of slices by prefix sums over the token starts."""

    def __init__(self, text: str):
        self.text = text
        self.starts: list[int] = []
        self.ends: list[int] = []
        self.sums = [0]
        for m in _TOKEN.finditer(text):
            n = (m.end() - m.start() + 3) // 4 if m[0][0].isascii() and (m[0][0].isalnum() or m[0][0] == "_") else 1
            self.starts.append(m.start())
            self.ends.append(m.end())
            self.sums.append(self.sums[-1] + n)

    def count(self, a: int, b: int) -> int:
        """Tokens of text[a:b]; a run that is cut counts what remains of it."""
        if b <= a:
            return 0
        i, j = bisect_right(self.ends, a), bisect_left(self.starts, b)
        n = self.sums[j] - self.sums[i] if j > i else 0
        if j > i:
            s, e = self.starts[i], self.ends[i]
            if s < a:
                n -= (e - s + 3) // 4 - (min(e, b) - a + 3) // 4
                if j - 1 == i:
                    return n
            s, e = self.starts[j - 1], self.ends[j - 1]
            if e > b:
                n -= (e - s + 3) // 4 - (b - max(s, a) + 3) // 4
        return n

    def reach(self, a: int, budget: int) -> int:
        """The furthest b for which text[a:b] stays within the budget."""
        i = bisect_right(self.ends, a)
        used, at = 0, a
        while i < len(self.starts):
            s, e = max(self.starts[i], a), self.ends[i]
            n = (e - s + 3) // 4 if self.sums[i + 1] - self.sums[i] > 1 or e - s > 1 else 1
            if used + n > budget:
                return s + 4 * (budget - used) if e - s > 1 else at
            used, at = used + n, e
            i += 1
        return len(self.text)


_LINES = re.compile(r"[^\r\n]*(?:\r\n|\n|\r|$)")
_LINE = re.compile(r"\r\n|\n|\r")
_SENTENCE = re.compile(r"(?:[。｡！？!?।॥]+|[^\d\s.][.]+|…+)[”’\"'»」』）)\]]*(?=\s|[^\s.,;:!?。！？”’\"»」』）)])|(?<=[฀-๿]) (?=[฀-๿])")
_CLAUSE = re.compile(r"[；;：:，,、][”\"»]?\s*|\s[—–-]\s")
_WORD_GAP = re.compile(r"\s+")
_CELL = re.compile(r"[|｜]")
_HEADING = re.compile(r"[ \t\u3000]*([#＃]{1,6})[ \t\u3000]")
_ITEM = re.compile(r"([ \t\u3000]*)(?:[-*+•·‣◦][ \t\u3000]|(?:\d{1,3}|[a-zA-Z])[.)．）][ \t\u3000]|\d{1,3}、|[(（][\d一二三四五六七八九十]{1,3}[)）])")
_ROW = re.compile(r"[ \t\u3000]*[|｜]")
_FENCE = re.compile(r"[ \t]*(```|~~~)")
_INDENT = re.compile(r"[ \t\u3000]*")
# What a leaf is cut at, in this order, when it is opened.
INSIDE = {
    "text": (_SENTENCE, _LINE, _CLAUSE, _WORD_GAP),
    "row": (_CELL, _CLAUSE, _WORD_GAP),
    "code": (_LINE, _CLAUSE, _WORD_GAP),
    "heading": (_CLAUSE, _WORD_GAP),
}


class Node:
    """A stretch of the text: section, list, item, table or a leaf.

    depth: of a section its heading's level, of an item its indent.
    """

    __slots__ = ("start", "end", "kind", "depth", "children")

    def __init__(self, start: int, end: int, kind: str, depth: int = 0):
        self.start, self.end, self.kind, self.depth = start, end, kind, depth
        self.children: list[Node] = []

    def only_heading(self) -> bool:
        return self.kind == "heading" or self.kind == "section" and all(c.only_heading() for c in self.children)


def parse(text: str) -> Node:
    """The structure tree of a text.

    Sections lie in the sections of lower headings; lists lie in the items
    they are indented under; a table holds its rows; a fenced block and a
    paragraph are leaves.  A stack holds what is open; each line closes what
    it does not belong to.
    """
    root = Node(0, len(text), "section")
    stack = [root]
    fence, gap = "", True

    def grow(end: int) -> None:
        for n in stack:
            n.end = max(n.end, end) if n is not root else n.end

    def add(start: int, end: int, kind: str, depth: int = 0, push: bool = False) -> None:
        node = Node(start, end, kind, depth)
        stack[-1].children.append(node)
        if push:
            stack.append(node)
        grow(end)

    def close(*kinds: str) -> None:
        while stack[-1].kind in kinds:
            stack.pop()

    for m in _LINES.finditer(text):
        a, b = m.span()
        if a == b:
            continue
        last = stack[-1].children[-1] if stack[-1].children else None
        if fence:
            last.end = b
            grow(b)
            f = _FENCE.match(text, a, b)
            if f and f[1] == fence:
                fence = ""
            continue
        if not _NOT_WHITE.search(text, a, b):
            close("table")
            gap = True
            continue
        joined, gap = not gap, False
        if h := _HEADING.match(text, a, b):
            close("table", "item", "list")
            level = len(h[1])
            while stack[-1].depth >= level:
                stack.pop()
            add(a, b, "section", level, True)
            add(a, b, "heading")
        elif f := _FENCE.match(text, a, b):
            close("table", "item", "list")
            fence = f[1]
            add(a, b, "code")
        elif _ROW.match(text, a, b):
            if stack[-1].kind != "table":
                close("item", "list")
                add(a, b, "table", 0, True)
            add(a, b, "row")
        elif i := _ITEM.match(text, a, b):
            close("table")
            indent = len(i[1])
            while stack[-1].kind in ("item", "list") and (stack[-1].kind == "list" or stack[-1].depth >= indent):
                if stack[-1].kind == "list" and stack[-1].depth <= indent:
                    break
                stack.pop()
            if stack[-1].kind != "list":
                add(a, b, "list", indent, True)
            add(a, b, "item", indent, True)
            add(a, b, "text")
        else:
            close("table")
            if stack[-1].kind in ("item", "list"):
                deep = len(_INDENT.match(text, a, b)[0])
                if not joined and deep <= stack[-1].depth:
                    close("item", "list")
                    joined = False
            last = stack[-1].children[-1] if stack[-1].children else None
            if joined and last is not None and last.kind == "text":
                last.end = b
                grow(b)
            else:
                add(a, b, "text")
    return root


def _cuts(text: str, node: Node) -> list[Node]:
    """The parts of a leaf at the first boundary that cuts it at all."""
    patterns = INSIDE[node.kind]
    for k in range(node.depth, len(patterns)):
        out, at = [], node.start
        for m in patterns[k].finditer(text, node.start, node.end):
            if node.start < m.end() < node.end:
                out.append(Node(at, m.end(), node.kind, k + 1))
                at = m.end()
        if out:
            return [*out, Node(at, node.end, node.kind, k + 1)]
    return []


def _characters(meter: Meter, a: int, b: int, limit: int) -> list[tuple[int, int]]:
    out = []
    while meter.count(a, b) > limit:
        e = meter.reach(a, limit)
        e = e if e > a else a + 1
        while e < b and e > a + 1 and _COMBINING.match(meter.text[e]):
            e -= 1
        out.append((a, e))
        a = e
    return [*out, (a, b)]


def pack(meter: Meter, node: Node, limit: int, lead: int | None = None) -> list[tuple[int, int]]:
    """(start, end) of the pieces of a node, within the limit.

    A node that fits is one piece.  Only a node that does not is opened: of
    its children, neighbours that fit merge while they fit together, those
    that do not are packed by themselves, and nothing merges over the edge of
    an opened node.  A heading stays with what follows it: ``lead`` is where
    the headings begin that the node's first piece must hold as well.
    """
    start = node.start if lead is None else lead
    if meter.count(start, node.end) <= limit:
        return [(start, node.end)]
    children = node.children if node.kind not in INSIDE else _cuts(meter.text, node)
    if not children:
        return _characters(meter, start, node.end, limit)
    out: list[tuple[int, int]] = []
    held: list[int] | None = None if lead is None else [lead, node.start]  # a group under way
    bare = lead is not None  # it holds headings only
    for child in children:
        # headings alone take no more than half a piece, so that text can follow
        room = limit // 2 if held and bare and child.only_heading() else limit
        if held and meter.count(held[0], child.end) <= room:
            held[1], bare = child.end, bare and child.only_heading()
            continue
        if held and (not bare or child.only_heading()):  # headings too many for one piece stand for themselves
            out.append((held[0], held[1]))
            held = None
        before = held[0] if held else None
        held = None
        if before is None and meter.count(child.start, child.end) <= limit:
            held, bare = [child.start, child.end], child.only_heading()
        else:
            out += pack(meter, child, limit, before)
            bare = False
    if held:
        out.append((held[0], held[1]))
    return out


_COMBINING = re.compile("[̀-゙゚ͯัิ-ฺ็-๎ऀ-ः़ा-ॏ]")


def _back(meter: Meter, floor: int, at: int, budget: int) -> int:
    """The start of the overlap before ``at``: within the budget and, where
    there is one, at a sentence, clause or word boundary."""
    lo, hi = floor, at
    while lo < hi:  # the least start within the budget
        mid = (lo + hi) // 2
        if meter.count(mid, at) <= budget:
            hi = mid
        else:
            lo = mid + 1
    text = meter.text
    for pattern in (_SENTENCE, _LINE, _CLAUSE, _WORD_GAP):
        for m in pattern.finditer(text, lo, at):
            if lo < m.end() < at and _NOT_WHITE.search(text, m.end(), at):
                return m.end()
    while lo < at and _COMBINING.match(text[lo]):
        lo += 1
    return lo


def split(text: str | None, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, int]]:
    """(start, end, overlap tokens) of the pieces of a text, in order.

    A null or blank text has none; a text within the limit is one piece.  The
    limit holds with the overlap counted in; the overlap is at most half of
    the limit.
    """
    if not text or not _NOT_WHITE.search(text):
        return []
    if len(text) <= limit or tokens(text) <= limit:
        return [(0, len(text), 0)]
    meter = Meter(text)
    overlap = min(overlap, limit // 2)
    out: list[tuple[int, int, int]] = []
    for s, e in pack(meter, parse(text), limit - overlap):
        while e > s and text[e - 1].isspace():
            e -= 1
        if e <= s:
            continue
        start, shared = s, 0
        if out:
            budget = min(overlap, limit - meter.count(s, e))
            if budget > 0:
                start = _back(meter, out[-1][0], s, budget)
                shared = meter.count(start, s)
        while start < e and text[start].isspace():
            start += 1
        out.append((start, e, shared))
    return out


PIECES = "piece_no int, start_char long, end_char long, overlap_tokens int, token_count int, content string"


def split_items(
    df: DataFrame, key: str, text: str, keep: tuple[str, ...] = (), limit: int = LIMIT, overlap: int = OVERLAP
) -> DataFrame:
    """Pieces of all items: key, kept columns, pieces (count), then PIECES.

    Items within the limit pass as one piece; null and blank ones have none.
    Long and short items lie side by side in a partition; no shuffle.  A kept
    column that has the name of a result column comes as ``<name>_of_item``.
    """
    names = [f.strip().split()[0] for f in PIECES.split(",")] + ["pieces"]
    kept = df.select(*[F.col(c).alias(f"{c}_of_item" if c in names else c) for c in (key, *keep)])
    columns_kept = kept.columns

    def run(batches):
        for batch in batches:
            t = pa.Table.from_batches([batch])
            at, rows = [], []
            for r, x in enumerate(t.column("text_of_item_").to_pylist()):
                found = split(x, limit, overlap)
                for n, (s, e, o) in enumerate(found, 1):
                    at.append(r)
                    rows.append((len(found), n, s, e, o, tokens(x[s:e]), x[s:e]))
            out = t.select(columns_kept).take(pa.array(at, pa.int64()))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            types = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string())
            for name, values, kind in zip(["pieces", *names[:-1]], columns, types, strict=True):
                out = out.append_column(name, pa.array(values, kind))
            yield from out.to_batches()

    schema = T.StructType(kept.schema.fields + T.StructType.fromDDL("pieces int, " + PIECES).fields)
    rows = df.select(*[F.col(c).alias(k) for c, k in zip((key, *keep), columns_kept, strict=True)], F.col(text).alias("text_of_item_"))
    return spread(rows).mapInArrow(run, schema)


def oversized(df: DataFrame, key: str, text: str, limit: int = LIMIT) -> DataFrame:
    """Keys of the items that were cut: those with more than one piece, and a
    single run of letters over the limit, which is cut as well."""
    spark_key = F.col(key).cast("long")
    pieces = split_items(df.select(spark_key.alias(key), text), key, text, limit=limit)
    return pieces.where("pieces > 1 AND piece_no = 1").select(key)
