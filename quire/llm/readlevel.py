"""Reading level of documents by smoothed unigram models per level.

A document is a bag of units: words where a script writes them apart, pairs
of neighbouring characters where it doesn't, and one unit for the length of
each sentence.  For every language and level a unigram model is fitted on
texts that readers have graded; a level's probability of a unit is smoothed
towards the unit's share over all levels.  A document gets the level under
which it is most likely.

Units are hashed into ``BUCKETS``, so the model has a fixed size and may be
broadcast.  Sentence lengths are also pooled over languages; a language
without graded texts is judged by them.  Fitting takes at most ``LABELLED``
graded documents, chosen by a hash of their id.

Headings, front matter, links and page marks are no text of a document; nor
are passages of held-out test items, if the items are given.  Null, empty and
stub texts (fewer than ``LEAST`` letters of their own) have no level.
"""

from __future__ import annotations

import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread, written
from .leakage import forms

LEVELS = 5
REGION = 1 << 16  # buckets of a language; the last LENGTHS are for sentence lengths
LENGTHS = 64
BUCKETS = 8 * REGION
LABELLED = 20_000  # graded documents at most for fitting: 400 KB broadcast
PRIOR = 20.0  # pseudo-count that draws a unit towards the overall shares
LENGTH_PRIOR = 20.0
LENGTH_WEIGHT = 10.0  # a sentence's length speaks for the whole sentence
LEAST = 20
PROBE = 40  # characters of a test item that mark a passage of it
PROBE_STEP = 8
BLOCK = 2_000_000  # characters of items that are sent to all executors at once

LANGUAGES = ("other", "zh", "ja", "th", "hi", "en", "fr", "de")
# Frequent words that tell Latin-script languages apart.
FREQUENT = {
    "en": "the of and that this a in to".split(),
    "fr": "le la les des et que une du".split(),
    "de": "der die das und eine ein dem den".split(),
}
_FRONT = re.compile(r"\A---\r?\n.*?\r?\n---[ \t]*(?:\r?\n|\Z)", re.S)
_ASIDE = re.compile(
    r"^[ \t]*(?:#{1,6}[ \t].*|\[\[.*\]\].*|[\[［]本页未提取到文本.*|\[blank page\]|TODO|待补|[-–—·\[ ]*\d+[-–—·\] /\d]*)$", re.M
)
_KINDS = {"space": 1, "word": 2, "han": 4, "kana": 8, "thai": 16, "deva": 32, "end": 64, "stop": 128}
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def own_text(text: str | None) -> str:
    """The text without front matter, headings, links and page marks."""
    if not text:
        return ""
    if text.startswith("---"):
        text = _FRONT.sub("", text)
    return _ASIDE.sub("", text)


@cache
def tables() -> tuple[np.ndarray, np.ndarray]:
    """Code unit -> lower case, and code unit -> kinds as bits."""
    lower, kind = np.arange(1 << 16, dtype=np.uint32), np.zeros(1 << 16, np.uint8)
    for code in range(1 << 16):
        if 0xD800 <= code < 0xE000:
            continue
        c = chr(code)
        low = c.lower()
        if len(low) == 1:
            lower[code] = ord(low)
        k = 0
        if c.isspace():
            k |= _KINDS["space"]
        if c.isalpha() or 0x300 <= code < 0x370:
            k |= _KINDS["word"]
        if 0x3400 <= code < 0xA000:
            k = _KINDS["han"]
        elif 0x3040 <= code < 0x3100:
            k = _KINDS["kana"]
        elif 0xE00 <= code < 0xE80:
            k = _KINDS["thai"]
        elif 0x900 <= code < 0x980 and c not in "।॥":
            k = _KINDS["deva"] | _KINDS["word"]
        if c in "。！？!?।॥\n｡":
            k |= _KINDS["end"]
        if c in ".．":
            k |= _KINDS["stop"]
        kind[code] = k
    return lower, kind


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    with np.errstate(over="ignore"):
        up = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, _BASE, np.uint64))])
        down = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, inverse, np.uint64))])
    return up, down


def _mix(h: np.ndarray, lang: np.ndarray) -> np.ndarray:
    """Bucket of a unit in its language's region."""
    with np.errstate(over="ignore"):
        h = h * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xC4CEB9FE1A85EC53)
        h ^= h >> np.uint64(32)
    return lang * REGION + (h % np.uint64(REGION - LENGTHS)).astype(np.int64)


@cache
def _frequent() -> dict[str, np.ndarray]:
    out = {}
    for lang, words in FREQUENT.items():
        codes = np.array([ord(c) for w in words for c in w + " "], np.uint64)
        out[lang] = np.unique(_words(codes, codes != 32)[0])
    return out


def _words(codes: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each maximal run of positions ``inside``."""
    edge = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    with np.errstate(over="ignore"):
        up, down = _powers(len(codes))
        total = np.concatenate([[np.uint64(0)], np.cumsum(codes.astype(np.uint64) * up[: len(codes)])])
        return (total[end] - total[start]) * down[start], start


class Probes:
    """Windows of the test items; positions of a text that lie in one."""

    def __init__(self, texts: list[str]):
        from .leakage import _inside, encode, windows

        codes, _ = encode(texts)
        at = _inside(codes, PROBE, 1)
        self.keys = np.unique(windows(codes, at, PROBE)) if len(at) else None

    def mark(self, raw: np.ndarray) -> np.ndarray | None:
        """raw: code units of texts, each ended by 0xFFFF."""
        from .leakage import _inside, windows

        if self.keys is None:
            return None
        form = forms()[raw]
        form[raw == 0xFFFF] = 0xFFFF
        place = np.flatnonzero(form)
        codes = form[place]
        at = _inside(codes, PROBE, PROBE_STEP)
        if not len(at):
            return None
        keys = windows(codes, at, PROBE)
        i = np.searchsorted(self.keys, keys)
        hit = at[self.keys[np.minimum(i, len(self.keys) - 1)] == keys]
        if not len(hit):
            return None
        step = np.zeros(len(raw) + 1, np.int32)
        np.add.at(step, place[np.maximum(hit - PROBE_STEP, 0)], 1)
        np.add.at(step, place[np.minimum(hit + PROBE + PROBE_STEP, len(place) - 1)], -1)
        return np.cumsum(step[:-1]) > 0


def joined(texts: list[str]) -> np.ndarray:
    """Code units of texts, each ended by 0xFFFF."""
    return np.frombuffer("".join(t + "\uffff" for t in texts).encode("utf-16-le", "surrogatepass"), np.uint16)


def packed(mask: np.ndarray | None, ends: np.ndarray) -> list[bytes | None]:
    """Marked positions of each text as bits; None where there are none."""
    if mask is None:
        return [None] * len(ends)
    return [np.packbits(m).tobytes() if m.any() else None for m in np.split(mask, ends[:-1] + 1)]


def unpacked(bits: list[bytes | None], ends: np.ndarray) -> np.ndarray | None:
    if not any(bits):
        return None
    sizes = np.diff(np.concatenate([[-1], ends]))
    return np.concatenate(
        [np.unpackbits(np.frombuffer(b, np.uint8), count=n) if b else np.zeros(n, np.uint8) for b, n in zip(bits, sizes, strict=True)]
    ).astype(bool)


def units(texts: list[str], probes: Probes | None = None, marked: list[bytes | None] | None = None):
    """Units of many texts at once.  marked: positions that other probes have
    found already (``packed``).

    Returns (document, bucket, weight class: 0 content, 1 length, 2 pooled
    length) of all units, and letters and language of each document.
    """
    n = len(texts)
    raw = joined(texts)
    lower, kinds = tables()
    codes, kind = lower[raw].astype(np.uint64), kinds[raw].copy()
    ends = np.flatnonzero(raw == 0xFFFF)
    doc = np.repeat(np.arange(n), np.diff(np.concatenate([[0], ends + 1])))
    masked = probes.mark(raw) if probes is not None else None
    before = unpacked(marked, ends) if marked is not None else None
    if before is not None:
        masked = before if masked is None else masked | before
    if masked is not None:
        share = np.bincount(doc, masked, n) / np.maximum(np.bincount(doc, None, n), 1)
        masked &= share[doc] < 0.9  # a document that is all passage keeps its text
        kind[masked] = 0
    counts = {k: np.bincount(doc, (kind & b) > 0, n) for k, b in _KINDS.items()}
    letters = counts["word"] + counts["han"] + counts["kana"] + counts["thai"]

    word = (kind & _KINDS["word"]) > 0
    hashes, start = _words(codes, word)
    of = doc[start] if len(start) else start
    lang = np.zeros(n, np.int64)
    votes = np.stack([np.bincount(of, np.isin(hashes, _frequent()[x]), n) for x in ("en", "fr", "de")])
    lang = np.where(votes.max(0) > 0, votes.argmax(0) + 5, 0)
    lang[counts["deva"] > 0.3 * letters] = 4
    lang[counts["thai"] > 0.3 * letters] = 3
    lang[counts["han"] > 0.3 * letters] = 1
    lang[(counts["kana"] > 0.15 * letters) & (counts["kana"] > 0)] = 2
    dense = (lang >= 1) & (lang <= 3)

    keep = ~dense[of]
    parts = [(of[keep], _mix(hashes[keep], lang[of[keep]]), np.zeros(keep.sum(), np.int8))]
    own = ((kind & (_KINDS["word"] | _KINDS["han"] | _KINDS["kana"] | _KINDS["thai"])) > 0) & dense[doc]
    at = np.flatnonzero(own)
    if len(at) > 1:
        a, b = at[:-1], at[1:]
        near = (doc[a] == doc[b]) & (b - a <= 2)
        a, b = a[near], b[near]
        pair = (codes[a] << np.uint64(32)) | codes[b]
        parts.append((doc[a], _mix(pair, lang[doc[a]]), np.zeros(len(a), np.int8)))

    # sentence lengths: letters in dense scripts by two, words elsewhere
    stop = (kind & _KINDS["end"]) > 0
    dot = np.flatnonzero((kind & _KINDS["stop"]) > 0)
    dot = dot[dot + 1 < len(raw)]
    stop[dot[((kinds[raw[dot + 1]] & _KINDS["space"]) > 0) | (raw[dot + 1] == 0xFFFF)]] = True
    stop[ends] = True
    size = np.where(dense[doc], own * 0.5, 0.0)
    size[start] += ~dense[of]
    edges = np.flatnonzero(stop)
    run = np.cumsum(size)[edges]
    length = np.diff(np.concatenate([[0.0], run]))
    s_doc = doc[edges]
    some = length >= 1
    bucket = REGION - LENGTHS + np.minimum(LENGTHS - 1, (np.log2(np.maximum(length, 1)) * 3).astype(np.int64))
    s_doc, bucket = s_doc[some], bucket[some]
    parts.append((s_doc, lang[s_doc] * REGION + bucket, np.ones(len(s_doc), np.int8)))
    parts.append((s_doc, bucket, np.full(len(s_doc), 2, np.int8)))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)), letters, lang


class Model:
    """Weights [bucket, level] of the units."""

    def __init__(self, counts: np.ndarray, seen: np.ndarray):
        """counts: [bucket, level]; seen: graded documents by language.  The
        region of "other" has the pooled sentence lengths."""
        self.seen = seen
        self.weights = np.zeros((BUCKETS, LEVELS), np.float32)
        for lang in range(len(LANGUAGES)):
            low, cut, high = lang * REGION, (lang + 1) * REGION - LENGTHS, (lang + 1) * REGION
            for a, b, prior, weight in ((low, cut, PRIOR, 1.0), (cut, high, LENGTH_PRIOR, LENGTH_WEIGHT)):
                c = counts[a:b]
                share = c.sum(0) + 1.0
                share /= share.sum()
                w = np.log((c + prior * share) / (share * (c.sum(1, keepdims=True) + prior)))
                self.weights[a:b] = w * weight

    def scores(self, texts: list[str], probes: Probes | None = None, marked: list[bytes | None] | None = None):
        (doc, bucket, cls), letters, lang = units(texts, probes, marked)
        out = np.zeros((len(texts), LEVELS))
        known = self.seen[lang] > 0
        mine = np.where(known[doc], cls < 2, cls == 2)
        doc, w = doc[mine], self.weights[bucket[mine]]
        for g in range(LEVELS):
            out[:, g] = np.bincount(doc, w[:, g], len(texts))
        return out, letters, lang


def gold_levels(labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """doc_id, level: the mean of a document's valid grades, rounded.  A mean
    half way between two levels speaks for neither and makes no row.  Repeated
    rows of a rater count once, null grades and grades off the scale never."""
    mean = (
        labels.where(F.col("grade").between(1, LEVELS) & F.col(doc_id).isNotNull())
        .select(doc_id, "rater", "grade")
        .distinct()
        .groupBy(doc_id)
        .agg(F.avg("grade").alias("mean"))
    )
    return mean.where("mean <> floor(mean) + 0.5").select(doc_id, F.floor(F.col("mean") + 0.5).cast("int").alias("level"))


def _item_blocks(items: DataFrame | None, text: str) -> list[list[str]]:
    """The items in blocks of at most BLOCK characters, a longer item alone."""
    if items is None:
        return []
    out: list[list[str]] = []
    size = 0
    for (t,) in items.select(text).where(F.col(text).isNotNull()).toLocalIterator():
        if not out or size + len(t) > BLOCK:
            out.append([])
            size = 0
        out[-1].append(t)
        size += len(t)
    return out


def _with_marks(rows: DataFrame, blocks: list[list[str]]) -> DataFrame:
    """Adds ``m``, the positions of own text that lie in an item of the
    blocks; rows: columns t and others.  Each block is a pass of its own over
    the rows, so that no executor holds more than one; passes are cut by
    written tables."""
    rows = rows.withColumn("m", F.lit(None).cast("binary"))
    names = rows.columns
    for block in blocks:
        given = rows.sparkSession.sparkContext.broadcast(block)

        def run(batches, given=given):
            probes = Probes(given.value)
            for batch in batches:
                t = pa.Table.from_batches([batch])
                texts = [own_text(x) for x in t.column("t").to_pylist()]
                marks = t.column("m").to_pylist()
                if texts:
                    raw = joined(texts)
                    ends = np.flatnonzero(raw == 0xFFFF)
                    here, before = probes.mark(raw), unpacked(marks, ends)
                    if here is not None:
                        marks = packed(here if before is None else here | before, ends)
                yield from t.drop(["m"]).append_column("m", pa.array(marks, pa.binary())).select(names).to_batches()

        rows = written(rows.mapInArrow(run, rows.schema), "marks")
    return rows


def fit(
    documents: DataFrame,
    labels: DataFrame,
    items: DataFrame | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    limit: int = LABELLED,
) -> Model:
    """Fits the unigram models on at most ``limit`` graded documents."""
    gold = gold_levels(labels, doc_id).orderBy(F.xxhash64(doc_id), doc_id).limit(limit)
    blocks = _item_blocks(items, "text")
    given = documents.sparkSession.sparkContext.broadcast(blocks[-1] if blocks else [])

    def run(batches):
        probes = Probes(given.value) if given.value else None
        counts = np.zeros(BUCKETS * LEVELS, np.int64)
        seen = np.zeros(len(LANGUAGES), np.int64)
        for batch in batches:
            texts = [own_text(t) for t in batch.column("t").to_pylist()]
            level = np.array(batch.column("level").to_pylist(), np.int64) - 1
            if not texts:
                continue
            (doc, bucket, cls), letters, lang = units(texts, probes, batch.column("m").to_pylist())
            good = letters[doc] >= LEAST
            counts += np.bincount(bucket[good] * LEVELS + level[doc[good]], None, BUCKETS * LEVELS)
            seen += np.bincount(lang[letters >= LEAST], None, len(LANGUAGES))
        key = np.flatnonzero(counts)
        n = np.concatenate([counts[key], seen])
        key = np.concatenate([key, -1 - np.arange(len(LANGUAGES))])
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["key", "n"])

    graded = (
        spread(documents.select(F.col(doc_id).alias(doc_id), F.col(text).alias("t")).where("t IS NOT NULL"))
        .join(F.broadcast(gold), doc_id)
        .select("t", "level")
    )
    rows = (
        _with_marks(graded, blocks[:-1])
        .mapInArrow(run, "key long, n long")
        .groupBy("key")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    key, n = rows.column("key").to_numpy(), rows.column("n").to_numpy()
    counts = np.zeros(BUCKETS * LEVELS)
    counts[key[key >= 0]] = n[key >= 0]
    seen = np.zeros(len(LANGUAGES), np.int64)
    seen[-1 - key[key < 0]] = n[key < 0]
    return Model(counts.reshape(BUCKETS, LEVELS), seen)


CHARACTERS = 2_000_000  # worked on at once


def reading_levels(
    documents: DataFrame,
    labels: DataFrame,
    items: DataFrame | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    model: Model | None = None,
) -> DataFrame:
    """doc_id, lang, level, margin, one row per usable document.

    ``margin`` is the log-likelihood of levels 4 and 5 against 1 to 3, by
    their best, for each 100 letters.  Ties go to the lower level.
    """
    model = fit(documents, labels, items, doc_id, text) if model is None else model
    blocks = _item_blocks(items, "text")
    given = documents.sparkSession.sparkContext.broadcast((model, blocks[-1] if blocks else []))

    def score(model, probes, ids, texts, marks):
        s, letters, lang = model.scores(texts, probes, marks)
        level = s.argmax(1) + 1
        margin = (s[:, 3:].max(1) - s[:, :3].max(1)) / np.maximum(letters, 1) * 100
        ok = np.flatnonzero(letters >= LEAST)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.array(ids, np.int64)[ok]),
                pa.array([LANGUAGES[x] for x in lang[ok]], pa.string()),
                pa.array(level[ok].astype(np.int32)),
                pa.array(np.round(margin[ok], 4)),
            ],
            names=["doc_id", "lang", "level", "margin"],
        )

    def run(batches):
        model, probe_texts = given.value
        probes = Probes(probe_texts) if probe_texts else None
        ids, texts, marks, size = [], [], [], 0
        for batch in batches:
            for i, t, m in zip(*(batch.column(c).to_pylist() for c in "ktm"), strict=True):
                ids.append(i)
                texts.append(own_text(t))
                marks.append(m)
                size += len(texts[-1])
                if size >= CHARACTERS:
                    yield score(model, probes, ids, texts, marks)
                    ids, texts, marks, size = [], [], [], 0
        if ids:
            yield score(model, probes, ids, texts, marks)

    rows = spread(documents.select(F.col(doc_id).cast("long").alias("k"), F.col(text).alias("t")).where("t IS NOT NULL AND t <> ''"))
    return _with_marks(rows, blocks[:-1]).mapInArrow(run, "doc_id long, lang string, level int, margin double")
