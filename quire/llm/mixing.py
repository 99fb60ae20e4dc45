"""Mixing sources to target weights by raking.

Sizes are tokens of a public tokenizer.  Documents fall into cells of source,
language and topic; iterative proportional fitting rakes the cells' weights to
the plan's source shares and to language and topic marginals, under each
source's cap on repeats.  A cell's weight is the expected number of copies of
each of its documents; documents get the whole part for certain and one more
copy with the rest as probability, drawn by a hash of plan and document, so
that a run can be repeated.

The total is the largest at which every source reaches its share within its
cap (or a given smaller one).  Reported are the shares reached, by source,
language and topic, and how far the raking came.
"""

from __future__ import annotations

import base64
import os
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import spread, written
from . import topics

VOCABULARY = os.environ.get("QUIRE_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
# The split pattern that goes with the vocabulary, as its publisher states it.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
PIECE = 200_000  # characters encoded at once; longer texts go in pieces
ROUNDS = 200

def base_language(c: Column) -> Column:
    """'ZH', 'zh-Hans ', 'zh_CN' -> 'zh'; what is no code of two or three
    letters, and null, -> 'und'."""
    code = F.lower(F.regexp_extract(F.trim(c), r"^([A-Za-z]{2,3})(?:[-_].*)?$", 1))
    return F.when(code.isNull() | (code == ""), "und").otherwise(code)


def encoder(vocabulary: str = VOCABULARY):
    """Makes, on a worker, the size of the vocabulary and the function from a
    text to its tokens; a null text has none.

    Texts are encoded whole; a text of over PIECE characters goes to the
    encoder in pieces cut before blanks or, without any, between characters.
    """

    def make():
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        known = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

        def encode(t: str | None) -> list[int]:
            if not t:
                return []
            if len(t) <= PIECE:
                return known.encode_ordinary(t)
            out, at = [], 0
            while at < len(t):
                end = t.rfind(" ", at + PIECE // 2, at + PIECE) if len(t) - at > PIECE else len(t)
                end = end if end > at else at + PIECE
                out += known.encode_ordinary(t[at:end])
                at = end
            return out

        return max(ranks.values()) + 1, encode

    return make


def token_sizes(documents: DataFrame, keys: list[str], text: str = "text", vocabulary: str = VOCABULARY, model: topics.Topics | None = None) -> DataFrame:
    """keys and tokens (long) of every document; a null text has 0 tokens.
    With a model (and lang among the keys) also its topic."""
    kept = documents.select(*keys)
    columns_kept = kept.columns
    make = encoder(vocabulary)
    given = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        _, encode = make()
        for batch in batches:
            t = pa.Table.from_batches([batch])
            ids = list(map(encode, t.column("text_to_size_").to_pylist()))
            out = t.select(columns_kept).append_column("tokens", pa.array(list(map(len, ids)), pa.int64()))
            if given.value is not None:
                names = [given.value.name(i, x) for i, x in zip(ids, t.column("lang").to_pylist(), strict=True)]
                out = out.append_column("topic", pa.array(names, pa.string()))
            yield from out.to_batches()

    schema = kept.schema.add("tokens", "long")
    if model is not None:
        schema = schema.add("topic", "string")
    return spread(documents.select(*keys, F.col(text).alias("text_to_size_"))).mapInArrow(run, schema)


class Fit(NamedTuple):
    """weights: copies of each cell; total: tokens they make; rounds: of
    raking; error: the largest share by which a source misses its target."""

    weights: np.ndarray
    total: float
    rounds: int
    error: float


def rake(
    tokens: np.ndarray, source: np.ndarray, others: list[np.ndarray], share: np.ndarray, cap: np.ndarray, total: float | None = None
) -> Fit:
    """Iterative proportional fitting of the weights of cells.

    tokens: of each cell; source and others: group number of each cell in each
    margin; share, cap: of each source.  The other margins aim at the shares
    that their groups have in the corpus.  The source margin is fitted last in
    each round, under the caps.  Ends when a round changes nothing; where the
    margins contradict each other, after ``ROUNDS``, with the sources right.
    """
    have = np.bincount(source, tokens, len(share))
    want = np.where(have > 0, share, 0.0)
    if want.sum() <= 0:
        return Fit(np.zeros(len(tokens)), 0.0, 0, 0.0)
    want = want / want.sum()
    positive = want > 0
    most = (cap[positive] * have[positive] / want[positive]).min()
    total = most if total is None else min(total, most)
    if total <= 0:
        return Fit(np.zeros(len(tokens)), 0.0, 0, 0.0)
    goal = want * total
    limit = cap[source]
    weight = np.where(want[source] > 0, goal[source] / np.maximum(have[source], 1), 0.0)
    for rounds in range(1, ROUNDS + 1):
        before = weight.copy()
        for group in others:
            aim = np.bincount(group, tokens * positive[source], group.max() + 1)
            aim = aim / aim.sum() * total
            now = np.bincount(group, tokens * weight, len(aim))
            weight = np.minimum(weight * np.where(now > 0, aim / np.maximum(now, 1e-12), 1.0)[group], limit)
        for _ in range(20):  # the caps take from some cells what others make up for
            now = np.bincount(source, tokens * weight, len(share))
            factor = np.where(now > 0, goal / np.maximum(now, 1e-12), 1.0)
            if np.all(np.abs(factor[positive] - 1) < 1e-9):
                break
            weight = np.minimum(weight * factor[source], limit)
        if np.abs(weight - before).max() < 1e-9 * max(1.0, weight.max()):
            break
    error = np.abs(np.bincount(source, tokens * weight, len(share)) / total - want).max()
    return Fit(weight, float(total), rounds, float(error))


def plan_weights(cells: list[tuple], targets: list[tuple], total: float | None = None) -> tuple[list[tuple], list[tuple]]:
    """(plan, source, lang, topic, copies) of all cells of all plans, and
    (plan, margin, name, wanted, rounds, error) of the margins they are fitted
    to.

    cells: (source, lang, topic, tokens); targets: (plan, source, share, cap).
    A null or negative share is none; a null cap allows no repetition; a
    source named twice in a plan has its last share and cap by order.
    """
    weights, margins = [], []
    langs = {x: i for i, x in enumerate(sorted({c[1] for c in cells}))}
    themes = {x: i for i, x in enumerate(sorted({c[2] for c in cells}))}
    for plan in sorted({t[0] for t in targets}):
        rows = {t[1]: (max(t[2] or 0.0, 0.0), 1 if t[3] is None else max(t[3], 0)) for t in targets if t[0] == plan}
        names = {s: i for i, s in enumerate(sorted(rows))}
        mine = [c for c in cells if c[0] in names and c[3] > 0]
        if not mine:
            continue
        tokens = np.array([c[3] for c in mine], float)
        source = np.array([names[c[0]] for c in mine])
        share = np.array([rows[s][0] for s in names])
        fit = rake(
            tokens, source, [np.array([langs[c[1]] for c in mine]), np.array([themes[c[2]] for c in mine])],
            share, np.array([rows[s][1] for s in names], float), total,
        )
        weights += [(plan, c[0], c[1], c[2], float(w)) for c, w in zip(mine, fit.weights, strict=True) if w > 0]
        used = tokens * (share > 0)[source]
        have = np.bincount(source, tokens, len(share))
        wanted = np.where(have > 0, share, 0.0)
        parts = [("source", s, wanted[i] / wanted.sum() if wanted.sum() else 0.0) for s, i in names.items()]
        for margin, at in (("lang", 1), ("topic", 2)):
            sums: dict[str, float] = {}
            for c, n in zip(mine, used, strict=True):
                sums[c[at]] = sums.get(c[at], 0.0) + n
            parts += [(margin, x, n / used.sum() if used.sum() else 0.0) for x, n in sorted(sums.items())]
        margins += [(plan, m, x, float(w), fit.rounds, fit.error) for m, x, w in parts]
    return weights, margins


class Mix(NamedTuple):
    """mixed: documents of the mix with plan, doc_id, source, lang, topic,
    tokens and copies >= 1; sized: all sized documents; plans: the plans' rows;
    margins: what the weights are fitted to (see ``plan_weights``)."""

    mixed: DataFrame
    sized: DataFrame
    plans: list[tuple]
    margins: list[tuple]


def mixture(
    documents: DataFrame,
    targets: DataFrame,
    total: float | None = None,
    vocabulary: str = VOCABULARY,
    topic: Column | None = None,
) -> Mix:
    """The mix of every plan.

    Documents without a source, or of a source a plan does not name or gives
    no share, take no part in it.  ``topic`` may be any column of documents;
    else topics are learned of all documents (``topics.learn``).  Read by the driver are the plans
    and the tokens of the cells: as many as the plans' sources times the
    language codes that documents have times the topics, whatever the number
    of documents.
    """
    spark = documents.sparkSession
    plans = targets.select("plan", "source", "target_share", "max_repeats").orderBy("plan", "source").collect()
    plans = [tuple(r) for r in plans if r[0] is not None and r[1] is not None]
    labelled = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", base_language(F.col("lang")).alias("lang"), "text",
        *([] if topic is None else [F.coalesce(topic.cast("string"), F.lit("none")).alias("topic")]),
    )
    keys = [c for c in labelled.columns if c != "text"]
    if topic is None:
        _, sizes = topics.learn(topics.bags(labelled, encoder(vocabulary), keys))
    else:
        sizes = token_sizes(labelled, keys, "text", vocabulary)
    # sized once: the table is read for the cells, the draw and the report
    sized = written(sizes, "sizes")
    caps = spark.createDataFrame([(p, s, 1 if c is None else int(c)) for p, s, _, c in plans], "plan string, source string, cap int")
    named = sized.join(caps.select("source").distinct(), "source", "left_semi")
    cells = [tuple(r) for r in named.groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens")).collect()]
    weights, margins = plan_weights(cells, plans, total)
    expected = spark.createDataFrame(weights, "plan string, source string, lang string, topic string, expected double")
    draw = (F.xxhash64("plan", "doc_id").bitwiseAND(F.lit((1 << 40) - 1)) / F.lit(float(1 << 40))).cast("double")
    whole = F.floor(F.col("expected") + 1e-9)
    mixed = (
        sized.where("tokens > 0")
        .join(expected, ["source", "lang", "topic"])
        .join(caps, ["plan", "source"])
        .withColumn("copies", F.least(F.col("cap"), (whole + (draw < F.col("expected") - whole).cast("int")).cast("int")))
        .where("copies > 0")
        .select("plan", "doc_id", "source", "lang", "topic", "tokens", "copies")
    )
    return Mix(mixed, sized, plans, margins)


def mix_report(mix: Mix) -> DataFrame:
    """plan, margin ('source', 'lang' or 'topic'), name, target_share (of a
    source as the plan states it, else the share in the corpus), fitted_share
    (what the raking aims at), max_repeats, documents, available_tokens,
    mixed_documents, mixed_tokens, most_copies, actual_share, rounds, error.

    One row for each source of a plan, sources without documents included, and
    for each language and topic of its sources.
    """
    spark = mix.sized.sparkSession
    stated = {(p, s): (t, c) for p, s, t, c in mix.plans}
    fitted = {(p, m, x): (w, r, e) for p, m, x, w, r, e in mix.margins}
    keys = {**{(p, "source", s): None for p, s in stated}, **dict.fromkeys(fitted)}
    rows = []
    for p, m, x in keys:
        w, r, e = fitted.get((p, m, x), (0.0, 0, 0.0))
        share, cap = stated[p, x] if m == "source" else (w, None)
        rows.append((p, m, x, share, w, cap, r, e))
    wanted = spark.createDataFrame(
        rows, "plan string, margin string, name string, target_share double, fitted_share double, max_repeats int, rounds int, error double"
    )
    margin = F.inline(F.array(*[F.struct(F.lit(m).alias("margin"), F.col(m).alias("name")) for m in ("source", "lang", "topic")]))
    ours = spark.createDataFrame(list(stated), "plan string, source string")
    cells = mix.sized.groupBy("source", "lang", "topic").agg(F.count("*").alias("documents"), F.sum("tokens").alias("available_tokens"))
    have = cells.join(ours, "source").select("plan", margin, "documents", "available_tokens").groupBy("plan", "margin", "name").agg(
        F.sum("documents").alias("documents"), F.sum("available_tokens").alias("available_tokens")
    )
    copies = mix.mixed.groupBy("plan", "source", "lang", "topic").agg(
        F.count("*").alias("mixed_documents"),
        F.sum(F.col("tokens") * F.col("copies")).alias("mixed_tokens"),
        F.max("copies").alias("most_copies"),
    )
    got = copies.select("plan", margin, "mixed_documents", "mixed_tokens", "most_copies").groupBy("plan", "margin", "name").agg(
        F.sum("mixed_documents").alias("mixed_documents"), F.sum("mixed_tokens").alias("mixed_tokens"), F.max("most_copies").alias("most_copies")
    )
    whole = copies.groupBy("plan").agg(F.sum("mixed_tokens").alias("plan_tokens"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return (
        wanted.join(have, ["plan", "margin", "name"], "left")
        .join(got, ["plan", "margin", "name"], "left")
        .join(whole, "plan", "left")
        .select(
            "plan", "margin", "name", "target_share", F.round("fitted_share", 6).alias("fitted_share"), "max_repeats",
            zero("documents"), zero("available_tokens"), zero("mixed_documents"), zero("mixed_tokens"), zero("most_copies"),
            F.round(F.coalesce(F.col("mixed_tokens"), F.lit(0)) / F.col("plan_tokens"), 6).alias("actual_share"), "rounds", F.round("error", 9).alias("error"),
        )
    )
