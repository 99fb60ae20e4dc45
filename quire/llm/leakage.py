"""Evaluation texts inside the corpus.

Each shard of the corpus (a stretch of a partition) gets a suffix array: its
suffixes, at every ``step``-th character, sorted by their first ``depth``
characters.  Every suffix of every test item is binary-searched in it; equal
ranges are extended to the longest verbatim match.  A match of at least
``depth + step - 1`` characters is found wherever it lies.  Depth and step go
by the script of the item, and every document is searched for all items, in
whatever script it is written itself.  Matches of one document and item that
lie on a common course are chained to a passage, over which wrong or missing
characters leave gaps; its ends are followed over shorter matches.  It counts
if it covers ``share`` of the item.

Characters are compared in one form: case, width, accents, look-alikes,
blanks, marks and characters that scanning confuses make no difference.

Documents stay where they are (no shuffle).  The items are the broadcast
side; they are sent in blocks of at most ``BLOCK`` characters, so that a
larger test set makes more passes and not larger broadcasts.

Null and empty documents and items hold nothing.  Repeated documents and
items are rows of their own.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread
from .furniture import _CLASS
from .skeleton import prototype

BLOCK = 4_000_000  # characters of items in one broadcast: 16 MB at most
SHARD = 3_000_000  # characters of documents in one suffix array
WIDE = (22, 4)  # depth and step for scripts of many characters
NARROW = (40, 8)  # and for alphabets
SHARE = 0.5  # of an item's compared characters
CANDIDATE = 0.35  # of them that verbatim matches must span; their ends are then followed


@cache
def forms() -> np.ndarray:
    """Code unit -> its form, 0 for what is left out."""
    out = np.zeros(1 << 16, np.uint16)
    for code in range(1 << 16):
        if 0xD800 <= code < 0xF900:
            continue
        c = chr(code)
        p = unicodedata.normalize("NFKC", prototype(c)).lower()
        p = unicodedata.normalize("NFD", p)[:1]
        if not p or 0x300 <= ord(p) < 0x370 or p in "゙゚":
            continue
        if not (p.isalnum() or unicodedata.category(p)[0] == "M"):
            continue
        p = _CLASS.get(p, p)
        if ord(p) < 1 << 16:
            out[code] = ord(p)
    return out


def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Forms of all texts in a row, and the offset of each (one more at the
    end).  Between texts stands a 0xFFFF, which no match crosses."""
    if not texts:
        return np.zeros(0, np.uint16), np.zeros(1, np.int64)
    raw = np.frombuffer("".join(x + "￿" for x in texts).encode("utf-16-le", "surrogatepass"), np.uint16)
    table = forms()
    out = table[raw]
    ends = np.flatnonzero(raw == 0xFFFF)
    out[ends] = 0xFFFF
    kept = out != 0
    out = out[kept]
    offsets = np.concatenate([[0], np.flatnonzero(out == 0xFFFF) + 1])
    return out, offsets


def windows(codes: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The first ``depth`` forms of the suffixes at ``at``, as byte strings
    in which comparing bytes compares characters."""
    big = codes.astype(">u2").view(np.uint8)
    view = np.lib.stride_tricks.sliding_window_view(big, 2 * depth)
    return np.ascontiguousarray(view[2 * at]).view(f"S{2 * depth}").ravel()


def _inside(codes: np.ndarray, depth: int, step: int) -> np.ndarray:
    """Positions, every step-th, whose first ``depth`` forms cross no end."""
    n = len(codes) - depth + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    end = np.flatnonzero(codes == 0xFFFF)
    at = np.arange(0, n, step)
    nxt = np.searchsorted(end, at)
    reach = np.where(nxt < len(end), end[np.minimum(nxt, len(end) - 1)], len(codes)) if len(end) else np.full(len(at), len(codes))
    return at[reach - at >= depth]


class Suffixes:
    """The sorted suffixes of a shard."""

    def __init__(self, codes: np.ndarray, depth: int, step: int):
        self.codes, self.depth = codes, depth
        at = _inside(codes, depth, step)
        keys = windows(codes, at, depth) if len(at) else np.zeros(0, f"S{2 * depth}")
        order = np.argsort(keys, kind="quicksort")
        self.at, self.keys = at[order], keys[order]

    def find(self, tests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the test, position in the shard) of all that share their
        first ``depth`` forms.  tests: sorted or not."""
        lo = np.searchsorted(self.keys, tests, "left")
        hi = np.searchsorted(self.keys, tests, "right")
        n = hi - lo
        which = np.repeat(np.arange(len(tests)), n)
        start = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        return which, self.at[start + np.arange(len(which))]


def extend(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of a[i:] and b[j:], known to be >= depth."""
    length = np.full(len(i), depth, np.int64)
    live = np.arange(len(i))
    while len(live):
        x, y = i[live] + length[live], j[live] + length[live]
        ok = (x < len(a)) & (y < len(b))
        live, x, y = live[ok], x[ok], y[ok]
        same = (a[x] == b[y]) & (a[x] != 0xFFFF)
        live = live[same]
        length[live] += 1
    return length


class Items:
    """A block of test items: forms, their windows, their lengths."""

    def __init__(self, ids: list[int], texts: list[str], depth: int):
        self.ids = np.array(ids, np.int64)
        self.codes, self.offsets = encode(texts)
        self.sizes = np.diff(self.offsets) - 1
        self.at = _inside(self.codes, depth, 1)
        keys = windows(self.codes, self.at, depth) if len(self.at) else np.zeros(0, f"S{2 * depth}")
        order = np.argsort(keys)
        self.at, self.keys = self.at[order], keys[order]
        self.of = np.searchsorted(self.offsets, self.at, "right") - 1


def is_wide(text: str) -> bool:
    """Whether a text is mostly Chinese or Japanese, by all its characters."""
    n = len(text)
    return n > 0 and len(text.encode("utf-8", "surrogatepass")) > 2.0 * n and not _LOW.search(text)


import re  # noqa: E402

_LOW = re.compile("[ऀ-๿]{6}")


def passages(
    pos: np.ndarray, where: np.ndarray, length: np.ndarray, size: int, slack: int = 90
) -> tuple[int, int, int, int, int]:
    """The chain of matches that covers most of an item.

    pos, where, length: matches by place in the item and in the document.
    Returns (covered, item start, item end, document start, document end).
    """
    order = np.argsort(pos + where, kind="stable")
    best = (0, 0, 0, 0, 0)
    chains: list[list[int]] = []  # covered, istart, iend, dstart, dend
    for p, w, n in zip(pos[order].tolist(), where[order].tolist(), length[order].tolist(), strict=True):
        for c in chains:
            gap = p - c[2]
            drift = (w - p) - (c[4] - c[2])
            if p >= c[1] and abs(drift) <= slack + max(0, gap) // 8 and gap <= max(slack * 2, size // 4) and w + n > c[4] - slack:
                e = p + n
                c[0] += max(0, e - max(c[2], p))
                if e > c[2]:
                    c[2], c[4] = e, w + n
                break
        else:
            chains.append([n, p, p + n, w, w + n])
    for c in chains:
        if c[0] > best[0]:
            best = tuple(c)
    return best


def follow(x: str, y: str, seed: int, gap: int = 24) -> tuple[int, int]:
    """How far x and y go on alike from their beginnings: verbatim stretches of
    at least ``seed`` characters, over at most ``gap`` that differ."""
    i = j = 0
    while True:
        best = None
        for skip in range(gap):
            piece = x[i + skip : i + skip + seed]
            if len(piece) < seed or best is not None and skip >= best[0] + best[1]:
                break
            at = y.find(piece, j, j + gap + seed)
            if at >= 0 and (best is None or skip + at - j < best[0] + best[1]):
                best = (skip, at - j)
        if best is None:
            return i, j
        i, j = i + best[0] + seed, j + best[1] + seed
        while i < len(x) and j < len(y) and x[i] == y[j]:
            i, j = i + 1, j + 1


def _text(codes: np.ndarray) -> str:
    return codes.astype("<u2").tobytes().decode("utf-16-le", "surrogatepass")


SCHEMA = (
    "doc_id long, item_id long, covered double, matched_chars long, longest_match long, "
    "item_start long, doc_start long, doc_end long"
)


def _search(codes, offsets, ids, items: Items, depth: int, step: int, share: float) -> Iterator[tuple]:
    seed = depth // 4
    shard = Suffixes(codes, depth, step)
    which, there = shard.find(items.keys)
    if not len(which):
        return
    here = items.at[which]
    item = items.of[which]
    doc = np.searchsorted(offsets, there, "right") - 1
    length = extend(items.codes, here, codes, there, depth)
    # a pair of document and item needs matches that reach far enough apart
    pair = doc.astype(np.int64) * len(items.ids) + item
    order = np.argsort(pair, kind="stable")
    pair, here, there, length, item, doc = (x[order] for x in (pair, here, there, length, item, doc))
    start = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
    low = np.minimum.reduceat(here, start)
    high = np.maximum.reduceat(here + length, start)
    wide_enough = high - low >= min(share, CANDIDATE) * items.sizes[item[start]]
    bounds = np.concatenate([start, [len(pair)]])
    for k in np.flatnonzero(wide_enough):
        s, e = bounds[k], bounds[k + 1]
        i, d = item[s], doc[s]
        size = int(items.sizes[i])
        base = items.offsets[i]
        covered, a, b, da, db = passages(here[s:e] - base, there[s:e] - offsets[d], length[s:e], size)
        if covered < 0.3 * (b - a):
            continue
        if b - a < size:  # faults near its ends hide some of the passage
            mine, theirs = items.codes[base : base + size], codes[offsets[d] : offsets[d + 1] - 1]
            back = follow(_text(mine[:a][::-1]), _text(theirs[:da][::-1]), seed)
            on = follow(_text(mine[b:]), _text(theirs[db:]), seed)
            a, da, b, db = a - back[0], da - back[1], b + on[0], db + on[1]
        if b - a >= share * size:
            yield (
                int(ids[d]), int(items.ids[i]), round((b - a) / size, 4), int(covered),
                int(length[s:e].max()), int(a), int(da), int(db),
            )


def _blocks(items: DataFrame, item_id: str, text: str) -> Iterator[tuple[list[int], list[str]]]:
    """The items in blocks of bounded size, read one partition at a time."""
    ids, texts, size = [], [], 0
    rows = items.select(F.col(item_id).cast("long"), text).where(F.col(text).isNotNull())
    for i, t in rows.toLocalIterator():
        if ids and size + len(t) > BLOCK:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(i)
        texts.append(t)
        size += len(t)
    if ids:
        yield ids, texts


def leaked_items(
    documents: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    share: float = SHARE,
) -> DataFrame:
    """One row per document and item it holds at least ``share`` of.

    Columns: SCHEMA.  ``covered`` is the passage's share of the item in
    compared characters, ``longest_match`` its longest verbatim match,
    ``item_start``, ``doc_start`` and ``doc_end`` its place in compared
    characters.
    """
    spark = documents.sparkSession
    source = spread(documents.select(F.col(doc_id).cast("long").alias("k"), F.col(text).alias("t")).where("t IS NOT NULL AND t <> ''"))
    parts = []
    for ids, texts in _blocks(items, item_id, text):
        split = ([], []), ([], [])
        for i, t in zip(ids, texts, strict=True):
            side = split[0] if is_wide(t) else split[1]
            side[0].append(i)
            side[1].append(t)
        given = spark.sparkContext.broadcast([(i, t) for i, t in split])

        def run(batches, given=given):
            sides = [Items(*given.value[k], (WIDE, NARROW)[k][0]) for k in (0, 1)]
            held: list = [[], [], 0]

            def flush():
                ids, texts = np.array(held[0]), held[1]
                held[:] = [[], [], 0]
                if not len(ids):
                    return
                codes, offsets = encode(texts)
                for side, (depth, step) in zip(sides, (WIDE, NARROW), strict=True):
                    rows = list(_search(codes, offsets, ids, side, depth, step, share)) if len(side.ids) else []
                    if rows:
                        columns = zip(*rows, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, pa.float64() if n == 2 else pa.int64()) for n, c in enumerate(columns)],
                            names=[f.split()[0] for f in SCHEMA.split(", ")],
                        )

            for batch in batches:
                for i, t in zip(batch.column("k").to_pylist(), batch.column("t").to_pylist(), strict=True):
                    held[0].append(i)
                    held[1].append(t)
                    held[2] += len(t)
                    if held[2] >= SHARD:
                        yield from flush()
            yield from flush()

        parts.append(source.mapInArrow(run, SCHEMA))
    if not parts:
        return spark.createDataFrame([], SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def without_leaks(documents: DataFrame, leaks: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The corpus without the documents that hold items."""
    return documents.join(leaks.select(doc_id).distinct(), doc_id, "left_anti")
