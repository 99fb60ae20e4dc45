"""Repair of scanned pages: furniture out, words joined, faults listed.

Two passes over all pages count words and character contexts, and edge lines,
exactly (``counts``); a third decides each line against these counts.  Pages
are shuffled by their text alone, for the words, so a book that holds a third
of all pages is as good as any other.

* furniture: ``furniture.Detector`` (fuzzy repetition at page edges, page
  numbers, scan marks);
* broken_word: a hyphen at a line's end whose word the corpus knows without
  it and not with it;
* misread: a control or replacement character; a digit inside a word; a word
  the corpus hardly knows while it knows well the word that undoes one
  scanning confusion; a Chinese or Japanese character whose context prefers
  its confusable;
* spaced_letters: blanks between the characters of running Chinese or
  Japanese text.

Null and blank texts have no faults and repair to null and to "".
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from ..session import spread
from . import counts as C
from . import furniture as Fu

HYPHENS = "-‐‑\u00ad‒﹣－¬"
_WORD = re.compile(r"[^\W_]+")
_LATIN = re.compile(r"[A-Za-zÀ-ɏ0-9Ͱ-ӿ]+")
_HYPHENATED = re.compile(r"[a-zß-ɏ0-9Ͱ-ӿ]+(?:[-‐][a-zß-ɏ]+)*")
_HAN_JOIN = re.compile(r"(?<=[぀-鿿])[\s\u00a0\u3000]+(?=[぀-鿿])")
_HAS_LATIN = re.compile(r"[A-Za-z]")
_HAN = re.compile(r"[぀-ヿ㐀-鿿]")
_BLANKS = " \u00a0\u2000-\u200a\u202f\u3000"
_CUT = re.compile(rf"([^\W_][\w’']*)([{HYPHENS}])\s*$")
_INNER_HYPHEN = re.compile(r"[^\W\d_]+(?:[-‐‑][^\W\d_]+)+")
_SPACED = re.compile(rf"[぀-ヿ㐀-鿿][{_BLANKS}][぀-ヿ㐀-鿿][{_BLANKS}][぀-ヿ㐀-鿿]")
_SPACED_START = re.compile(rf"^\s*[぀-ヿ㐀-鿿][{_BLANKS}][぀-ヿ㐀-鿿]")
_SPACED_END = re.compile(rf"[぀-ヿ㐀-鿿][{_BLANKS}][぀-ヿ㐀-鿿]\s*$")
_PAIR = re.compile(rf"(?![章节回部篇页])[぀-ヿ㐀-鿿][{_BLANKS}][぀-ヿ㐀-鿿]")
_MARK = re.compile("[。，！？；、]")
_HAN_BLANK = re.compile(rf"(?<=[぀-ヿ㐀-鿿，。、；！？])[{_BLANKS}](?=[぀-ヿ㐀-鿿，。、；！？])")
_LOST = re.compile("[�□\x00-\x08\x0b\x0c\x0e-\x1f\x7f]|/G[0-9A-F]{2,}")
_INVISIBLE = re.compile("[\u200b-\u200f\u2060-\u2064\ufeff\u034f]")
_MIXED = re.compile(r"[^\W\d_][015]+[^\W\d_]|(?<![^\W_])[15][a-zà-ÿ]{3,}|(?<![^\W_])0[a-zà-ÿ]{2,}")
_ORDINAL = re.compile(r"^\d+(?:st|nd|rd|th|er|ère|re|e|ème)$")

_WRONG = "".join(dict.fromkeys(Fu.MISREAD_HAN))
_BOTH = "".join(dict.fromkeys(_WRONG + "".join(Fu.MISREAD_HAN.values())))
_CONTEXT = re.compile(rf"(?=([぀-ヿ㐀-鿿][{_BOTH}][぀-ヿ㐀-鿿]))")
_WRONG_AT = re.compile(f"[{_WRONG}]")
_WRONG_CONTEXT = re.compile(rf"(?=([぀-ヿ㐀-鿿])([{_WRONG}])([぀-ヿ㐀-鿿]))")
_PIECES = re.compile(rf"([^\W_][\w’']*)[{HYPHENS}](?=[^\S\n]*(?:\n\s*([^\W_]*)|$))")
_ANY_CUT = re.compile(rf"[{HYPHENS}]\s*$", re.M)
_TAIL = re.compile(r"([^\W_][\w’']*)()$")


def letters(text: str) -> str:
    """A text in one form: compatibility ideographs, wide letters and
    look-alikes unified, nothing invisible; line breaks stay."""
    if text.isascii() or not _UNUSUAL.search(text):
        return text
    text = unicodedata.normalize("NFKC", _INVISIBLE.sub("", text))
    return text.translate(_LOOKALIKE) if _FOREIGN.search(text) else text


_FOREIGN = re.compile("[\u0370-\u04ff]")
_UNUSUAL = re.compile(
    "[\u0300-\u036f\u0370-\u04ff\u200b-\u200f\u2060-\u2064\ufeff\u034f\u2e80-\u2fdf"
    "\u3099\u309a\uf900-\ufaff\ufb00-\ufb06\uff10-\uff19\uff21-\uff3a\uff41-\uff5a\uff0d]"
)
_LOOKALIKE = str.maketrans("аеорсухіѕјοΑΒΕΗΙΚΜΝΟΡΤΧАВЕКМНОРСТХ", "aeopcyxisjoABEHIKMNOPTXABEKMHOPCTX")


def _head(word: str) -> str:
    return word.split("’")[-1].split("'")[-1]


def vocabulary(text: str, counts: Counter) -> None:
    """Adds a text's words and the contexts of confusable characters.

    Words keep their inner hyphens here and contexts are three characters;
    "x-" and "~x" are what stands before and after a hyphen at a line's end.
    ``keys`` parts them later, once for each distinct one.
    """
    text = letters(text)
    if _HAS_LATIN.search(text):
        low = text.lower()
        counts.update(_HYPHENATED.findall(low))
        if _ANY_CUT.search(low):
            for head, tail in _PIECES.findall(low):
                counts[_head(head) + "-"] += 1
                if tail:
                    counts["~" + tail] += 1
    if _HAN.search(text):
        counts.update(_CONTEXT.findall(_HAN_JOIN.sub("", text)))


def keys(counts: Counter) -> dict[str, int]:
    """Keys: words, "-" + compounds, and contexts with their halves."""
    out: dict[str, int] = {}

    def add(k: str, n: int) -> None:
        out[k] = out.get(k, 0) + n

    for w, n in counts.items():
        if w[0] == "~" or w[-1] == "-":
            add(w, n)
        elif w[0] > "\u2fff":
            add(w, n)
            add(w[:2], n)
            add(w[1:] + "~", n)
        elif "-" in w or "‐" in w:
            w = w.replace("‐", "-")
            add("-" + w, n)
            for part in w.split("-"):
                add(part, n)
        else:
            add(w, n)
    return out


FIELDS = ("text_layer", "native_text")


def page_words(batch: pa.RecordBatch, counts: Counter) -> None:
    for field in FIELDS:
        for t in batch.column(field).to_pylist():
            if t and not t.isspace():
                vocabulary(t, counts)


def page_lines(batch: pa.RecordBatch, counts: dict) -> None:
    book, page = batch.column("book_id").to_pylist(), batch.column("page").to_pylist()
    for field in FIELDS:
        for b, p, t in zip(book, page, batch.column(field).to_pylist(), strict=True):
            if t and not t.isspace():
                Fu.count_edges(b, p, t, counts)


class Corpus(NamedTuple):
    words: C.Words
    lines: C.Lines


def corpus_counts(pages: DataFrame) -> Corpus:
    """Words and contexts, and the running lines, of all pages.

    Words are counted once for each distinct page: repeated deliveries are no
    further evidence.
    """
    return Corpus(
        C.words(pages.select(*FIELDS).distinct(), page_words, keys),
        C.lines(pages.select("book_id", "page", *FIELDS), page_lines),
    )


class Reader:
    """Decides the lines of pages against the corpus counts."""

    def __init__(self, corpus: Corpus):
        self.count, self.detector = corpus.words.count, Fu.Detector(corpus.lines)
        self.highest = int(corpus.words.n.max(initial=0))
        self.words: dict[str, str] = {}
        self.contexts: dict[str, str] = {}

    def undo(self, word: str) -> str:
        """The word as it should be read, or "" if it stands as it is."""
        known = self.words.get(word)
        if known is None:
            if len(self.words) > 400_000:
                self.words.clear()
            known = self.words[word] = self._undo(word)
        return known

    def _undo(self, word: str) -> str:
        n = self.count(word)
        best, most = "", max(12, 15 * n)
        if most > self.highest or len(word) < 2 or word.isdigit():
            return ""
        for wrong, right in Fu.MISREAD_LATIN:
            right = right.lower()
            i = word.find(wrong)
            while i >= 0:
                v = word[:i] + right + word[i + len(wrong) :]
                if v != word and (k := self.count(v)) >= most:
                    best, most = v, k
                i = word.find(wrong, i + 1)
        return best

    def context(self, left: str, c: str, right: str) -> str:
        """The character that should stand between left and right, or ""."""
        key = left + c + right
        known = self.contexts.get(key)
        if known is None:
            if len(self.contexts) > 400_000:
                self.contexts.clear()
            known = self.contexts[key] = self._context(left, c, right)
        return known

    def _context(self, left: str, c: str, right: str) -> str:
        count = self.count
        n = count(left + c + right)
        for y in Fu.MISREAD_HAN[c]:
            m = count(left + y + right)
            if m >= 8 and m >= 8 * n:
                return y
            if m >= 3 and n <= m and n <= 2 + m / 3:
                a, b = count(left + c), count(left + y)
                d, e = count(c + right + "~"), count(y + right + "~")
                if b >= 10 * max(a, 1) or e >= 10 * max(d, 1):
                    return y
            if n <= 2 + m:  # no more usual than the other: both sides by themselves
                a, b = count(left + c), count(left + y)
                d, e = count(c + right + "~"), count(y + right + "~")
                if (b + 1) * (e + 1) >= 400 * (a + 1) * (d + 1) and b > a and e > d:
                    return y
        return ""

    def cut(self, head: str, tail: str) -> bool:
        """Whether head + hyphen + tail is a word cut by a line break."""
        if not head or head[-1].isdigit():
            return False
        if not tail:  # the page ends here: no word by itself is a cut one
            h = head.lower()  # nor is one that mostly stands before a hyphen
            return len(head) > 1 and self.count(h) < 5 * max(1, self.count(h + "-"))
        if not tail[0].isalpha():
            return False
        if tail[0].isupper() and not head[-1:].isupper():
            return False
        joined = self.count((head + tail).lower())
        own = self.count("-" + (head + "-" + tail).lower())
        if joined or own:
            return joined >= own
        # neither is known: two words that are each common, and more so than
        # as pieces at a line's end, stay a compound
        h, t = head.lower(), tail.lower()
        a, b = self.count(h), self.count(t)
        return not (a >= 15 + 5 * max(1, self.count(h + "-")) and b >= 15 + 5 * max(1, self.count("~" + t)))

    def faults(self, book: str | None, page: int | None, text: str) -> list[tuple[int, str]]:
        """(line_no, kind) of one text."""
        spans = Fu.split_lines(text)
        drop = self.detector.lines(book, page, text, spans)
        lines = text.split("\n")
        if len(lines) != len(spans):  # bare carriage returns: lines are what line feeds part
            starts, at = [], 0
            for x in lines:
                starts.append(at)
                at += len(x) + 1
            by = {}
            for i, (a, _) in enumerate(spans):
                n = max(k for k, s in enumerate(starts) if s <= a)
                by.setdefault(n, []).append(i)
            drop = {n for n, ii in by.items() if all(i in drop for i in ii)}
        out = [(i + 1, "furniture") for i in sorted(drop)]
        body = [i for i, x in enumerate(lines) if i not in drop and x and not x.isspace()]
        if len(body) == 1 and Fu.PLACEHOLDER.match(lines[body[0]]):
            return out
        raw = [lines[i] for i in body]
        forms = letters("\n".join(raw)).split("\n")
        whole = "\n".join(forms)
        bad = set()
        if _LOST.search(text):
            bad.update(k for k, x in enumerate(raw) if _LOST.search(x))
        if _HAN.search(whole):
            if _PAIR.search(whole):
                out += [(body[k] + 1, "spaced_letters") for k in self._spaced(forms, whole)]
            joined = _HAN_JOIN.sub("", whole)
            if any(self.context(*w) for w in _WRONG_CONTEXT.findall(joined)):
                for k, x in enumerate(forms):
                    if k not in bad and _WRONG_AT.search(x):
                        if self._misread_han(_HAN_BLANK.sub("", x.strip()), k, forms):
                            bad.add(k)
        if _HAS_LATIN.search(whole):
            cuts = {}
            if _ANY_CUT.search(text):
                for k, x in enumerate(raw):
                    if x.rstrip()[-1:] in HYPHENS:
                        if (head := self._cut_at(k, x, forms)) is not None:
                            cuts[k] = head
                            out.append((body[k] + 1, "broken_word"))
            words = set(_LATIN.findall(whole.lower()))
            known = self.words
            wrong = {
                w for w in words
                if (known[w] if w in known else self.undo(w))
                or not w.isalpha() and len(w) < 30 and _MIXED.search(w) and not _ORDINAL.match(w)
            }
            if cuts or wrong:
                self._misread_latin(forms, cuts, wrong, bad)
        out += [(body[k] + 1, "misread") for k in bad]
        return out

    def _spaced(self, forms: list[str], whole: str) -> list[int]:
        """Lines with spaced letters.  Text with marks needs no blanks, so one
        between two characters is enough there (after a chapter number it is
        in place); without marks, where blanks part the clauses, a character
        must stand between two blanks."""
        if len(_MARK.findall(whole)) * 100 >= len(whole):
            return [k for k, line in enumerate(forms) if _PAIR.search(line)]
        out, before = [], False
        for k, line in enumerate(forms):
            spaced = bool(_SPACED.search(line))
            if not spaced and before and _SPACED_START.search(line):
                spaced = True
            if not spaced and k + 1 < len(forms) and _SPACED_END.search(line):
                after = forms[k + 1]
                spaced = bool(_SPACED_START.search(after) or _SPACED.search(after[:12]))
            before = bool(_SPACED_END.search(line))
            if spaced:
                out.append(k)
        return out

    def _cut_at(self, k: int, raw: str, forms: list[str]) -> str | None:
        """The head of a word that a hyphen cuts at the end of line k."""
        line = forms[k].rsplit(None, 1)[-1] if forms[k] and not forms[k].isspace() else ""  # a cut word has no blank
        soft = raw.rstrip()[-1:] in "\u00ad¬"
        m = _CUT.search(line) or (soft and _TAIL.search(line))
        if not m:
            return None
        head = _head(m[1])
        t = _LATIN.match(forms[k + 1].lstrip()) if k + 1 < len(forms) else None
        tail = t[0] if t else ""
        return head if soft and tail or self.cut(head, tail) else None

    def _misread_latin(self, forms: list[str], cuts: dict[int, str], wrong: set[str], bad: set[int]) -> None:
        final = len(forms) - 1
        for k, line in enumerate(forms):
            if k in bad and k not in cuts:
                continue
            words = _LATIN.findall(line.lower())
            if not words:
                continue
            first, last = 0, len(words)
            if k - 1 in cuts or k == 0:
                first = 1  # the rest of a cut word, or one cut off by the page before
            if k in cuts or k == final:
                last -= 1
            if wrong and not wrong.isdisjoint(words[first:last]):
                bad.add(k)
            if k in cuts:
                head = cuts[k].lower()
                after = _LATIN.match(forms[k + 1].lstrip().lower()) if k < final else None
                right = self.undo(head + after[0]) if after else ""
                if right:
                    if right[: len(head)] != head:
                        bad.add(k)
                    if right[-len(after[0]) :] != after[0]:
                        bad.add(k + 1)

    def _misread_han(self, line: str, k: int, forms: list[str]) -> bool:
        for m in _WRONG_AT.finditer(line):
            i = m.start()
            left = line[i - 1] if i else (forms[k - 1].rstrip()[-1:] if k else "")
            right = line[i + 1 : i + 2] or (forms[k + 1].lstrip()[:1] if k + 1 < len(forms) else "")
            if left and right and _HAN.match(left) and _HAN.match(right):
                if self.context(left, m[0], right):
                    return True
            else:
                c, n = m[0], None
                for y in Fu.MISREAD_HAN[c]:
                    if left and _HAN.match(left):
                        n, o = self.count(left + c), self.count(left + y)
                    elif right and _HAN.match(right):
                        n, o = self.count(c + right + "~"), self.count(y + right + "~")
                    else:
                        continue
                    if o >= 15 and o >= 12 * n:
                        return True
        return False

    def repair(self, book: str | None, page: int | None, text: str | None) -> str | None:
        """The page's own text as continuous paragraphs.

        Furniture goes, words cut by a break are joined, spaced letters close
        up, confusions with a certain reading are undone.
        """
        if text is None:
            return None
        spans = Fu.split_lines(text)
        drop = self.detector.lines(book, page, text, spans)
        paragraphs: list[str] = [""]
        for i, (a, b) in enumerate(spans):
            if i in drop:
                continue
            raw = text[a:b].strip()
            if not raw or Fu.PLACEHOLDER.match(raw):
                if paragraphs[-1]:
                    paragraphs.append("")
                continue
            line = _LOST.sub("", _INVISIBLE.sub("", raw))
            while _HAN_BLANK.search(line) and _SPACED.search(line):
                line = _HAN_BLANK.sub("", line)
            line = self._reread(line)
            so_far = paragraphs[-1]
            if not so_far:
                paragraphs[-1] = line
                continue
            m = None
            if so_far[-1] in HYPHENS:  # a cut word stands in the last word
                m = _CUT.search(so_far, len(so_far) - len(so_far.rsplit(None, 1)[-1]))
            if m:
                t = _LATIN.match(line)
                if t and (m[2] in "\u00ad¬" or self.cut(m[1].split("’")[-1], t[0])):
                    paragraphs[-1] = so_far[: m.end(1)] + line
                else:
                    paragraphs[-1] = so_far + line
            elif _HAN.match(so_far[-1]) or so_far[-1] in "，。、；：！？”」》）":
                paragraphs[-1] = so_far + line
            else:
                paragraphs[-1] = so_far + " " + line
        return "\n\n".join(p for p in paragraphs if p)

    def _reread(self, line: str) -> str:
        if _HAN.search(line):
            out = list(line)
            for m in _WRONG_AT.finditer(line):
                i = m.start()
                if 0 < i < len(line) - 1 and (y := self.context(line[i - 1], m[0], line[i + 1])):
                    out[i] = y
            line = "".join(out)
        if _HAS_LATIN.search(line) and any(map(self.undo, _LATIN.findall(line.lower()))):
            line = _LATIN.sub(self._word, line)
        return line

    def _word(self, m: re.Match) -> str:
        w = m[0]
        right = self.undo(w.lower())
        if not right:
            return w
        return right.upper() if w.isupper() else right.capitalize() if w[0].isupper() else right


def line_faults(pages: DataFrame, corpus: Corpus | None = None) -> DataFrame:
    """page_key, field, line_no, kind: one row per fault of a line."""
    corpus = corpus_counts(pages) if corpus is None else corpus
    given = pages.sparkSession.sparkContext.broadcast(corpus)

    def run(batches):
        reader = Reader(given.value)
        for batch in batches:
            key, book, page = (batch.column(c).to_pylist() for c in ("page_key", "book_id", "page"))
            ks, fs, ns, ds = [], [], [], []
            for field in FIELDS:
                for k, b, p, t in zip(key, book, page, batch.column(field).to_pylist(), strict=True):
                    if t and not t.isspace():
                        for n, kind in reader.faults(b, p, t):
                            ks.append(k)
                            fs.append(field)
                            ns.append(n)
                            ds.append(kind)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ks, pa.int64()), pa.array(fs, pa.string()), pa.array(ns, pa.int64()), pa.array(ds, pa.string())],
                names=["page_key", "field", "line_no", "kind"],
            )

    return spread(pages.select("page_key", "book_id", "page", *FIELDS)).mapInArrow(
        run, "page_key long, field string, line_no long, kind string"
    )


def repaired_pages(pages: DataFrame, corpus: Corpus | None = None) -> DataFrame:
    """page_key, text_layer, native_text as continuous paragraphs."""
    corpus = corpus_counts(pages) if corpus is None else corpus
    given = pages.sparkSession.sparkContext.broadcast(corpus)

    def run(batches):
        reader = Reader(given.value)
        for batch in batches:
            key, book, page = (batch.column(c).to_pylist() for c in ("page_key", "book_id", "page"))
            out = [pa.array(key, pa.int64())]
            for field in FIELDS:
                out.append(
                    pa.array(
                        [reader.repair(b, p, t) for b, p, t in zip(book, page, batch.column(field).to_pylist(), strict=True)],
                        pa.string(),
                    )
                )
            yield pa.RecordBatch.from_arrays(out, names=["page_key", *FIELDS])

    return spread(pages.select("page_key", "book_id", "page", *FIELDS)).mapInArrow(
        run, "page_key long, text_layer string, native_text string"
    )
