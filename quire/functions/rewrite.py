"""Proofreading rules for Chinese text: counters and ordered rewrites.

A rule is one regular expression (or a few in a row), so a whole pass is one
projection.  ``count_*`` only looks, ``rule_*`` rewrites; edits of a rule are
counted on the text it gets.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import CJK

_C = f"[{CJK}]"
_GAP = r"[ \t\x{3000}]{0,64}"  # look-behinds need a bound
# ASCII marks and their full-width forms.
FULL_WIDTH = {",": "，", ".": "。", ";": "；", ":": "：", "?": "？", "!": "！", "(": "（", ")": "）"}
# Characters that often stand for another.
SUSPECTS = "砚口义巳已目戡仁场习丽宫乾趴讥翻戍芸"


def count_inner_spaces(c: Column) -> Column:
    """A: Chinese, one space, Chinese; matches do not overlap."""
    return F.regexp_count(c, F.lit(f"({_C}) ({_C})"))


def count_half_width(c: Column) -> Column:
    """B: ASCII mark right after a Chinese character."""
    return F.regexp_count(c, F.lit(rf"{_C}[(),.;:?!]"))


def count_repeated(c: Column) -> Column:
    """C: runs of one mark."""
    return F.regexp_count(c, F.lit(r"([。，、；：？！,.;:?!“”])\1+"))


# What scanning leaves behind, and lines that number a page.
NOISE = r"‖…?\s*[oO]?\s*", r"\.{3,}\s*[oO]?\s*$", r"‖", r"…{2,}"
FOOTERS = r"^第\s*\d+\s*页[\s/上中下]*$", r"^-\s*\d+\s*-\s*$", r"^\d+/\d+$"


def count_noise(c: Column) -> Column:
    """D: marks that scanning leaves behind."""
    return F.regexp_count(c, F.lit("(?md)(?:" + "|".join(NOISE) + ")"))


def count_footers(c: Column) -> Column:
    return F.regexp_count(c, F.lit("(?md)" + "|".join(FOOTERS)))


def count_suspects(c: Column) -> Column:
    """E: characters that often stand for another."""
    return F.length(c) - F.length(F.translate(c, SUSPECTS, ""))


def count_wide_spaces(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"\x{3000}"))


def count_invisible(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"[\x{200B}-\x{200D}\x{2060}\x{FEFF}]"))


_MARK = "[,.;:?!()]"
# For each rule: what it matches, what it puts there, and why.
PATTERNS = {
    "A": [(f" (?<={_C} )(?={_C})", "", "blank between Chinese characters")],
    "B": [(f"{_MARK}(?<![A-Za-z0-9]{_MARK})(?:(?<={_C}{_MARK})|(?={_C}))(?![A-Za-z0-9])", "", "ASCII mark in Chinese text")],
    "C": [(r"(?<mark>[。，、；：？！])\k<mark>+", "${mark}", "repeated mark")],
    "D": [
        (r"(?mdU)(?:‖…*[oO]? *|‖ *|\.{3,}\s*[oO]?\s*$)", "", "scanning noise"),
        (r"(?mdU)^\s*(?:第\s*\d+\s*页[\s/上中下]*|-\s*\d+\s*-|\d+/\d+)\s*$", "", "page footer"),
    ],
    "E": [],
    "G": [("\u3000", " ", "full-width blank")],
}


def rule_a(c: Column) -> Column:
    """Deletes one ASCII space between two Chinese characters."""
    return F.regexp_replace(c, PATTERNS["A"][0][0], "")


def rule_b(c: Column) -> Column:
    """ASCII marks next to a Chinese character, and next to no ASCII letter
    or digit, become full width."""
    for mark, full in FULL_WIDTH.items():
        m = "\\" + mark
        c = F.regexp_replace(c, f"{m}(?<![A-Za-z0-9]{m})(?:(?<={_C}{m})|(?={_C}))(?![A-Za-z0-9])", full)
    return c


def rule_c(c: Column) -> Column:
    """Runs of one Chinese mark become one."""
    return F.regexp_replace(c, r"([。，、；：？！])\1+", "$1")


def rule_d(c: Column) -> Column:
    """Deletes scanning noise, then page footers."""
    for pattern, new, _ in PATTERNS["D"]:
        c = F.regexp_replace(c, pattern, new)
    return c


# wrong, right, set before, what follows; by the sets that the rule's gate lets
# through.  The character itself comes first in each pattern, so that the
# look-behind runs only where it stands.
MISREAD = (
    ("羲", "是", "[这那就不才会都]", f"(?={_GAP}{_C})"),
    ("场", "而", "[,.;:?!，。；：？！以及反而或并因]", f"(?={_GAP}[是且])"),
    ("口", "们", "[我你他她它]", ""),
    ("目", "自", "", f"(?={_GAP}己)"),
    ("习", "则", _C, f"(?={_GAP}是)"),
    ("习", "则", "习", f"(?={_GAP}[的是在来去])"),
    ("翻", "需", "[还只]", f"(?={_GAP}{_C})"),
)


PATTERNS["E"] = [
    ((f"(?<={before}{_GAP}{w})" if before else "").join((w, after)), right, f"{w} read for {right}") for w, right, before, after in MISREAD
]


def rule_e(c: Column, wrong: str | None = None) -> Column:
    """Undoes certain confusions of characters, all or one of them."""
    for (w, *_), (pattern, right, _) in zip(MISREAD, PATTERNS["E"], strict=True):
        if wrong in (None, w):
            c = F.regexp_replace(c, pattern, right)
    return c


def rule_g(c: Column) -> Column:
    """Full-width spaces become ASCII ones."""
    return F.translate(c, "　", " ")


RULES = {"A": rule_a, "B": rule_b, "C": rule_c, "D": rule_d, "E": rule_e, "G": rule_g}


def rewrite(c: Column, rules: str = "ABCDEG") -> Column:
    """The rules in their fixed order."""
    return reduce(lambda x, r: RULES[r](x), [r for r in RULES if r in rules], c)
