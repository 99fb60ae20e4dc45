"""Topics of documents, learned without labels.

A document is the sum of the random directions of the tokens it has, each
weighted by how rare the token is, scaled to length 1, less the mean of its
language; so that documents are told apart by what they speak of and not by the language
they do it in.  Directions come from a seed and are the same everywhere.
Topics are the centres of spherical k-means; every document is given the
nearest one.

Rarity, means and centres are of all documents.  Texts are encoded once, into a
written table of their distinct tokens; k-means passes over a written table of
vectors, 64 bytes a document, and each partition of it sends one row of sums.
Vectors and centres lie on a grid, so that sums in floating point are exact and
the model is the same in whatever order and parts the rows come.

The number of topics is a parameter.  Null and short texts (fewer than
``LEAST`` tokens) have the topic 'none'; without others all have.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread, written

WIDTH = 32  # of a document's vector
TOPICS = 12
LEAST = 20
ROUNDS = 30
GRID, FINE = 1 << 14, 1 << 20  # steps to 1 of vectors and of centres: products and their sums fit 53 bits
HERE = 20_000  # vectors that the driver takes the passes over itself: 2 MB

Encode = Callable[[str | None], list[int]]
Step = Callable[[np.ndarray, np.ndarray], np.ndarray]
Join = Callable[[np.ndarray, np.ndarray], np.ndarray]


class Topics:
    """The fitted model: rarity of tokens, mean of each language ('': of all),
    centres."""

    def __init__(self, rarity: np.ndarray, means: dict[str, np.ndarray], centres: np.ndarray):
        self.rarity, self.means, self.centres = rarity, means, centres
        self._weighted: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_weighted": None}  # made where it is used

    def vector(self, bag: np.ndarray) -> np.ndarray:
        """Of a document's distinct tokens in order; in steps of the grid."""
        if self._weighted is None:
            random = np.random.default_rng(7).standard_normal((len(self.rarity), WIDTH), np.float32)
            self._weighted = random * self.rarity[:, None]
        return np.rint(unit(self._weighted[bag].sum(0)) * GRID).astype(np.int16)

    def names(self, centred: np.ndarray) -> list[str]:
        return [f"topic {i + 1:02d}" for i in (centred @ self.centres.T).argmax(1).tolist()] if len(centred) else []

    def name(self, ids: list[int], lang: str | None) -> str:
        if len(ids) < LEAST or not len(self.centres):
            return "none"
        v = self.vector(np.unique(np.array(ids, np.int64)))
        return self.names(centred(v[None], np.zeros(1, np.int64), [lang], self.means))[0]


def unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=-1, keepdims=True), 1e-9)


def grid(v: np.ndarray, steps: int) -> np.ndarray:
    return np.rint(v * steps) / steps


def bag_type(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def centred(vectors: np.ndarray, lang: np.ndarray, langs: list[str | None], means: dict[str, np.ndarray]) -> np.ndarray:
    """vectors less the means of their languages; lang: numbers in langs."""
    return grid(unit(vectors / GRID - np.stack([means.get(x or "", means[""]) for x in langs])[lang]), GRID)


def raw(batch: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """vectors, numbers of their languages, and these, of rows that have a vector."""
    langs = pa.chunked_array([batch.column("lang_")] if isinstance(batch, pa.RecordBatch) else batch.column("lang_").chunks, pa.string())
    langs = pc.fill_null(langs, "").combine_chunks().dictionary_encode()
    v = np.frombuffer(b"".join(batch.column("vector_").to_pylist()), "<i2").reshape(-1, WIDTH)
    return v, langs.indices.to_numpy(), langs.dictionary.to_pylist()


def folder(table: DataFrame, means: dict[str, np.ndarray], n: int) -> Callable[[Step, Join], np.ndarray]:
    """The function that joins what a step makes, batch by batch, of the n
    vectors of table and their marks; on the executors, or here if few."""
    rows = table.where("vector_ IS NOT NULL").select("lang_", "mark_", "vector_")
    read = lambda batch: (centred(*raw(batch), means), batch.column("mark_").to_numpy())
    mine = read(rows.toArrow()) if n <= HERE else None

    def fold(step: Step, join: Join) -> np.ndarray:
        if mine is not None:
            return step(*mine)

        def run(batches: Iterable[pa.RecordBatch]):
            parts = [step(*read(b)) for b in batches if b.num_rows]
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array([reduce(join, parts).tobytes()], pa.binary())], names=["part"])

        parts = rows.mapInArrow(run, "part binary").toArrow().column("part").to_pylist()
        return reduce(join, map(np.frombuffer, parts))

    return fold


def draws(mark: np.ndarray, i: int) -> np.ndarray:
    """Numbers between 0 and 1 that marks draw in round i."""
    x = mark.astype(np.int64).view(np.uint64) + np.uint64((i + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (((x ^ (x >> np.uint64(31))) >> np.uint64(11)) + 0.5) / (1 << 53)


def centres(fold: Callable[[Step, Join], np.ndarray], k: int) -> np.ndarray:
    """Spherical k-means from far-apart beginnings; the centres in a fixed
    order, the most frequent first.  A beginning is the vector that wins a draw
    among all, with chances by the square of its distance from those before."""
    c = np.zeros((0, WIDTH))
    for i in range(k):

        def drawn(v: np.ndarray, mark: np.ndarray, c: np.ndarray = c, i: int = i) -> np.ndarray:
            far = np.clip(1 - (v @ c.T).max(1), 1e-9, None) ** 2 if len(c) else 1.0
            score = np.log(draws(mark, i)) / far
            return np.append(score.max(), max(v[score == score.max()].tolist()))

        c = np.vstack([c, fold(drawn, lambda a, b: max(a, b, key=tuple))[1:]])
    for rounds in range(ROUNDS + 1):

        def summed(v: np.ndarray, mark: np.ndarray, c: np.ndarray = c) -> np.ndarray:
            near = np.eye(len(c))[(v @ c.T).argmax(1)]
            return np.column_stack([near.sum(0), near.T @ v]).ravel()

        sums = fold(summed, np.add).reshape(k, WIDTH + 1)
        new = np.where(np.linalg.norm(sums[:, 1:], axis=1, keepdims=True) > 1e-6, grid(unit(sums[:, 1:]), FINE), c)
        if rounds == ROUNDS or np.array_equal(new, c):
            break
        c = new
    return c[np.argsort(-sums[:, 0], kind="stable")]


def bags(
    documents: DataFrame, encoder: Callable[[], tuple[int, Encode]], keys: Sequence[str] = (), key: str = "doc_id", lang: str = "lang", text: str = "text"
) -> DataFrame:
    """keys and tokens (long) of every document, its language, mark (a hash of
    key and text) and bag (its distinct tokens in order), and the size of the
    vocabulary; written.  encoder: makes, on a worker, the size of the
    vocabulary and the function from text to ids."""
    given = documents.select(*keys, F.col(lang).alias("lang_"), F.xxhash64(key, text).alias("mark_"), F.col(text).alias("text_"))
    kept = given.drop("text_")
    columns = kept.columns

    def run(batches):
        size, encode = encoder()
        for batch in batches:
            t = pa.Table.from_batches([batch])
            tokens, found = [], []
            for x in t.column("text_").to_pylist():
                ids = encode(x)
                tokens.append(len(ids))
                found.append(np.unique(np.array(ids, bag_type(size))).tobytes())
            out = t.select(columns).append_column("tokens", pa.array(tokens, pa.int64())).append_column("bag_", pa.array(found, pa.binary()))
            yield from out.append_column("size_", pa.array([size] * len(out), pa.int64())).to_batches()

    return written(spread(given).mapInArrow(run, kept.schema.add("tokens", "long").add("bag_", "binary").add("size_", "long")), "bags")


def rarities(bags: DataFrame) -> np.ndarray | None:
    """Of each token of the vocabulary, by the documents that have it; None
    without documents."""

    def seen(batches):
        n, docs = None, 0
        for batch in batches:
            if batch.num_rows:
                size = batch.column("size_")[0].as_py()
                here = np.bincount(np.frombuffer(b"".join(batch.column("bag_").to_pylist()), bag_type(size)), minlength=size)
                n = here if n is None else n + here
                docs += batch.num_rows
        if n is not None:
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(at, [-1, -2])), pa.array(np.append(n[at], [docs, size]))], names=["token", "n"])

    found = bags.select("bag_", "size_").mapInArrow(seen, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"), F.max("n").alias("most")).toArrow()
    n = {r["token"]: r for r in found.to_pylist()}
    if not n:
        return None
    docs, rarity = n[-1]["n"], np.zeros(n[-2]["most"], np.float32)
    for token, r in n.items():
        if token >= 0:
            rarity[token] = np.log((docs + 1) / (r["n"] + 1)) if r["n"] > 1 else 0.0
    return rarity


def lang_means(vectors: DataFrame) -> tuple[dict[str, np.ndarray], int]:
    """Means of all vectors ('') and of languages that have 20; the number of vectors."""

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            v, lang, langs = raw(batch)
            for i, x in enumerate(langs):
                own = v[lang == i]
                sums[x] = sums.get(x, 0) + np.append(own.sum(0, np.int64), len(own))
        if sums:
            at = np.tile(np.arange(WIDTH + 1), len(sums))
            names = np.repeat(np.array(list(sums), object), WIDTH + 1)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(at), pa.array(np.concatenate(list(sums.values())))], names=["lang", "at", "n"])

    found = vectors.where("vector_ IS NOT NULL").select("lang_", "vector_").mapInArrow(run, "lang string, at long, n long").groupBy("lang", "at").agg(F.sum("n").alias("n"))
    by: dict[str, np.ndarray] = {}
    for x, at, n in map(dict.values, found.toArrow().to_pylist()):
        by.setdefault(x, np.zeros(WIDTH + 1))[at] = n
    whole = sum(by.values(), np.zeros(WIDTH + 1))
    means = {x: s[:-1] / s[-1] / GRID for x, s in sorted(by.items()) if x and s[-1] >= 20}
    return means | {"": whole[:-1] / max(whole[-1], 1) / GRID}, int(whole[-1])


def learn(bags: DataFrame, topics: int = TOPICS) -> tuple[Topics, DataFrame]:
    """The model of all documents of ``bags``; their keys, tokens and topic."""
    model = Topics(np.zeros(1), {"": np.zeros(WIDTH)}, np.zeros((0, WIDTH)))
    rarity = rarities(bags)
    if rarity is None:
        return model, bags.drop("lang_", "mark_", "bag_", "size_").withColumn("topic", F.lit("none"))
    model.rarity = rarity
    kept = bags.drop("bag_", "size_")
    columns, given = kept.columns, bags.sparkSession.sparkContext.broadcast(model)

    def vectors(batches):
        for batch in batches:
            t, m = pa.Table.from_batches([batch]), given.value
            both = zip(t.column("bag_").to_pylist(), t.column("tokens").to_pylist(), strict=True)
            v = [m.vector(np.frombuffer(x, bag_type(len(m.rarity)))).tobytes() if n >= LEAST else None for x, n in both]
            yield from t.select(columns).append_column("vector_", pa.array(v, pa.binary())).to_batches()

    table = written(bags.drop("size_").mapInArrow(vectors, kept.schema.add("vector_", "binary")), "vectors")
    model.means, n = lang_means(table)
    if n:
        model.centres = centres(folder(table, model.means, n), min(topics, n))
    wanted = [c for c in columns if c not in ("lang_", "mark_")]
    fitted = Topics(np.zeros(1), model.means, model.centres)

    def named(batches):
        for batch in batches:
            t = pa.Table.from_batches([batch])
            has = pc.is_valid(t.column("vector_"))
            names = np.full(len(t), "none", object)
            names[has.to_numpy()] = fitted.names(centred(*raw(t.filter(has)), fitted.means)) if pc.any(has).as_py() else []
            yield from t.select(wanted).append_column("topic", pa.array(names, pa.string())).to_batches()

    return model, table.mapInArrow(named, kept.select(*wanted).schema.add("topic", "string"))


def fit(
    documents: DataFrame, encoder: Callable[[], tuple[int, Encode]], topics: int = TOPICS, key: str = "doc_id", lang: str = "lang", text: str = "text"
) -> Topics:
    """Fits topics on all documents."""
    return learn(bags(documents, encoder, (), key, lang, text), topics)[0]
