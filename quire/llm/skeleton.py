"""One form for texts that look alike.

A text's skeleton: decompose, replace every character by the prototype of its
look-alike class, decompose again, compose.  Two texts look the same exactly
if their skeletons are equal.  Prototypes come from rules over the Unicode
database (wide and narrow forms, compatibility ideographs, radicals, font
variants, ligatures, blanks of other widths, characters that print nothing)
and from the tables of look-alike letters below.

What a reader can tell apart stays apart: letter case, accents, raised and
circled digits, simplified and traditional forms, number of blanks, breaks.
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread, written

HOT = 100_000  # rows of one text that one task takes
# Letters of other scripts that look like Latin ones.
LOOKALIKES = {
    # Cyrillic
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i",
    "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l", "ү": "y",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P",
    "С": "C", "Т": "T", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S", "Ү": "Y", "Ԍ": "G",
    "Ԛ": "Q", "Ԝ": "W", "Ӏ": "I", "ґ": "ґ",
    # Greek
    "ο": "o", "α": "a", "ν": "v", "ρ": "p", "ι": "i", "υ": "u", "κ": "k", "ϲ": "c",
    "ϳ": "j", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K",
    "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C",
    # Armenian, Cherokee and Latin extensions
    "օ": "o", "ս": "u", "հ": "h", "ո": "n", "ց": "g", "զ": "q", "Տ": "S", "Օ": "O",
    "ɑ": "a", "ɡ": "g", "ı": "i", "ɩ": "i", "ꞵ": "ß", "ᴏ": "o", "ᴄ": "c", "ᴠ": "v",
    "ᴡ": "w", "ᴢ": "z", "ꜱ": "s", "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭼ": "E", "Ꮋ": "H",
    "Ꭻ": "J", "Ꮶ": "K", "Ꮇ": "M", "Ꮲ": "P", "Ꭲ": "T", "Ꮃ": "W", "Ꮓ": "Z",
    # marks
    "‐": "-", "‑": "-", "‒": "-", "−": "-", "⁃": "-", "˗": "-", "﹣": "-", "－": "-",
    "∕": "/", "⁄": "/", "∶": ":", "：": ":", "ː": ":", "׃": ":", "ǃ": "!", "‚": ",",
    "․": ".", "。": "。", "｡": "。", "؍": ",", "٫": ",", "¦": "|", "∣": "|", "ǀ": "|",
    "｜": "|", "⼁": "丨", "∗": "*", "⁎": "*", "′": "′", "ˈ": "'", "＇": "'",
    "‧": "·", "・": "・", "･": "・", "•": "•", "∙": "·", "⋅": "·", "…": "...",
    "〜": "~", "～": "~", "∼": "~", "˜": "~", "〈": "〈", "〉": "〉", "⟨": "〈", "⟩": "〉",
}
# Blanks of other widths; line and paragraph separators.
BLANKS = "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
BREAKS = "\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
FILLERS = "\u034f\u115f\u1160\u17b4\u17b5\u3164\uffa0"
_ALIKE = ("<wide>", "<narrow>", "<font>")


def prints_nothing(c: str) -> bool:
    o = ord(c)
    return (
        unicodedata.category(c) == "Cf"
        or c in FILLERS
        or 0xFE00 <= o <= 0xFE0F
        or 0xE0100 <= o <= 0xE01EF
        or 0x180B <= o <= 0x180F
        or (unicodedata.category(c) == "Cc" and c not in "\t\n\r" and c not in BREAKS)
    )


def prototype(c: str) -> str:
    """The prototype of one character, by table and then by rule."""
    if c in LOOKALIKES:
        return LOOKALIKES[c]
    if c in BLANKS:
        return " "
    if c in BREAKS:
        return "\n"
    if prints_nothing(c):
        return ""
    d = unicodedata.decomposition(c)
    if d:
        tag, *codes = d.split() if d[0] == "<" else ("", *d.split())
        o = ord(c)
        ligature = 0xFB00 <= o <= 0xFB06 or c in "ĲĳǇǈǉǊǋǌǱǲǳ"
        ideograph = 0x2E80 <= o <= 0x2FDF or 0xF900 <= o <= 0xFAFF or 0x2F800 <= o <= 0x2FA1F
        roman = 0x2160 <= o <= 0x217F
        if not tag or tag in _ALIKE or ligature or ideograph or roman:
            return "".join(prototype(chr(int(x, 16))) for x in codes)
    return c


class _Table(dict):
    def __missing__(self, code: int) -> str | int:
        c = chr(code)
        out = prototype(c)
        self[code] = code if out == c else out
        return self[code]


TABLE = _Table()
for _code in range(128):
    TABLE[_code] = TABLE[_code]
_CRLF = re.compile(r"\r\n?")
# Characters of which none has a prototype of its own: nothing to replace.
_PLAIN = re.compile(
    "[^\t\n -~一-鿿ぁ-ゖァ-ヺーก-ฺ฿-๛"
    "、-》「-】“”‘’—ऄ-हा-्।]"
)


def skeleton(text: str | None) -> str | None:
    """The form in which texts that look alike are equal; null stays null."""
    if text is None:
        return None
    if "\r" in text:
        text = _CRLF.sub("\n", text)
    unusual = set(_PLAIN.findall(text))
    if not unusual:
        return text
    marked = not unusual.isdisjoint(_MARKED) or any(unicodedata.combining(c) for c in unusual)
    if marked:
        text = unicodedata.normalize("NFD", text)
        unusual = set(_PLAIN.findall(text))
    for c in unusual:
        p = TABLE[ord(c)]
        if p != ord(c):
            text = text.replace(c, p)
            marked = marked or p in "\u3099\u309a" and p != ""
    return unicodedata.normalize("NFC", text) if marked else text


# Letters with accents in one character, of the scripts at hand.
_MARKED = {chr(i) for i in (*range(0xC0, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x2000))}
_MARKED = {c for c in _MARKED if unicodedata.decomposition(c)}


def digest(text: str | None) -> bytes | None:
    import xxhash

    s = skeleton(text)
    return None if s is None else xxhash.xxh3_128_digest(s)


def with_skeleton(df: DataFrame, text: str, into: str = "skeleton") -> DataFrame:
    """Adds the skeleton of a text column; an existing ``into`` is replaced."""
    names = df.columns
    kept = [c for c in names if c != into]

    def run(batches):
        for batch in batches:
            t = pa.Table.from_batches([batch])
            out = pa.array([skeleton(x) for x in t.column("skeleton_of_").to_pylist()], pa.string())
            yield from t.select(kept).append_column(into, out).to_batches()

    schema = df.select(*kept).schema.add(into, "string")
    return spread(df.select(*kept, F.col(text).alias("skeleton_of_"))).mapInArrow(run, schema)


def hashed(df: DataFrame, key: str, text: str, field: str) -> DataFrame:
    """field, key, hash of the skeleton and of the text: no text is shuffled."""

    def run(batches):
        import xxhash

        for batch in batches:
            keys, texts = batch.column("k").to_pylist(), batch.column("t").to_pylist()
            ks, sk, raw = [], [], []
            for k, t in zip(keys, texts, strict=True):
                if t is None:
                    continue
                s = skeleton(t)
                h = xxhash.xxh3_128_digest(s)
                ks.append(k)
                sk.append(h)
                raw.append(h if s is t or s == t else xxhash.xxh3_128_digest(t))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ks, pa.int64()), pa.array(sk, pa.binary()), pa.array(raw, pa.binary())],
                names=["key", "skeleton", "raw"],
            )

    return (
        spread(df.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t")))
        .mapInArrow(run, "key long, skeleton binary, raw binary")
        .select(F.lit(field).alias("field"), "*")
    )


def mixed_variants(rows: DataFrame) -> DataFrame:
    """field, skeleton, raw, n, variant_id: the texts of classes that hold
    more than one, with their number of rows and least key.  Copies fall
    together on the map side, so a class of very many is no hot key."""
    variants = rows.groupBy("field", "skeleton", "raw").agg(F.count("*").alias("n"), F.min("key").alias("variant_id"))
    several = variants.groupBy("field", "skeleton").agg(F.count("*").alias("v")).where("v > 1")
    return variants.join(several.drop("v"), ["field", "skeleton"])


def classes_of(rows: DataFrame) -> DataFrame:
    """One row per text row whose class holds different texts: field, key,
    class_id (least key of the class), variant_id (least key of the same
    text), members.  rows: ``hashed``."""
    rows = written(rows, "skeletons")
    variants = mixed_variants(rows)
    classes = variants.groupBy("field", "skeleton").agg(F.min("variant_id").alias("class_id"), F.sum("n").alias("members"))
    named = variants.drop("n").join(classes, ["field", "skeleton"])
    return rows.join(named, ["field", "skeleton", "raw"]).select("field", "key", "class_id", "variant_id", "members")


def pairs_of(rows: DataFrame, hot: int = HOT) -> DataFrame:
    """field, key_a, key_b (key_a < key_b): rows of one class with different
    texts.  rows: ``hashed``.

    Texts are hashed once.  Distinct texts of a class are paired first and
    rows are put to them then, so copies of one text never meet each other,
    and each step makes no more rows than the result has.  Rows of a text
    that has more than ``hot`` are dealt to several tasks.
    """
    rows = written(rows, "skeletons")
    variants = mixed_variants(rows).withColumn("shares", F.ceil(F.col("n") / hot).cast("int")).drop("n", "variant_id")
    ours = rows.join(variants, ["field", "skeleton", "raw"])
    dealt = ours.withColumn("share", F.pmod(F.xxhash64("key"), "shares").cast("int")).drop("shares")
    side = lambda d, x: d.select("field", "skeleton", F.col("raw").alias(f"raw_{x}"), *[F.col(c).alias(f"{c}_{x}") for c in d.columns[3:]])
    each = variants.withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).drop("shares")
    pairs = side(each, "a").join(side(each, "b"), ["field", "skeleton"]).where("raw_a < raw_b")
    a, b = (side(dealt, x) for x in "ab")
    both = pairs.join(a, ["field", "skeleton", "raw_a", "share_a"]).join(b, ["field", "skeleton", "raw_b", "share_b"])
    return both.select("field", F.least("key_a", "key_b").alias("key_a"), F.greatest("key_a", "key_b").alias("key_b")).where("key_a < key_b")


def look_alike_classes(df: DataFrame, key: str, text: str, field: str) -> DataFrame:
    """``classes_of`` one table.  Nulls have no class; empty texts differ from
    texts that print nothing and look like them."""
    return classes_of(hashed(df, key, text, field))


def look_alike_pairs(df: DataFrame, key: str, text: str, field: str) -> DataFrame:
    """``pairs_of`` one table; nulls and empty texts as in the classes."""
    return pairs_of(hashed(df, key, text, field))
