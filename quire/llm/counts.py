"""Exact corpus counts of words and contexts, and the running lines.

Both are counted over all pages by a groupBy; partitions add up their own keys
first.  Words and contexts are counted under 64-bit digests and read into one
sorted table of 16 bytes a key, which grows with the vocabulary.  Line keys,
which grow with the pages, have a table of their own: it is written, decided
where it lies, and only the running lines are read.

Lines carry a 64-bit set of page numbers (modulo 64), joined by bitwise or, so
that repeated deliveries of one page count once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, spread

LINES = "kind string, book string, key string, n long, pages long"


class Words:
    """Read side of the words: sorted ``digests`` and their counts ``n``."""

    def __init__(self, digests: np.ndarray, n: np.ndarray):
        self.digests, self.n = digests, n

    def count(self, key: str) -> int:
        d = np.uint64(xxhash.xxh3_64_intdigest(key))
        i = self.digests.searchsorted(d)
        return int(self.n[i]) if i < len(self.digests) and self.digests[i] == d else 0


def words(df: DataFrame, features: Callable[[pa.RecordBatch, Counter], None], finish: Callable[[Counter], dict[str, int]]) -> Words:
    """Counts the keys that ``features`` adds for each batch, over all rows;
    ``finish`` makes keys of a partition's counts before they are added up."""

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            features(batch, counts)
        found = finish(counts)
        digests = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found)).view(np.int64)
        n = np.fromiter(found.values(), np.int64, len(found))
        for i in range(0, len(n), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(digests[i : i + (1 << 16)]), pa.array(n[i : i + (1 << 16)])], names=["digest", "n"])

    table = spread(df).mapInArrow(run, "digest long, n long").groupBy("digest").agg(F.sum("n").alias("n")).toArrow()
    digests = table.column("digest").to_numpy().view(np.uint64)
    order = np.argsort(digests)
    return Words(digests[order], table.column("n").to_numpy()[order])


class Lines:
    """Read side of the lines: (book, key) of the running lines of books, and
    the keys that are running lines in any book."""

    def __init__(self, own: set[tuple[str, str]], anywhere: set[str]):
        self.own, self.anywhere = own, anywhere


def lines(
    df: DataFrame,
    features: Callable[[pa.RecordBatch, dict], None],
    share: float = 0.02,
    least: int = 3,
) -> Lines:
    """Counts the line keys (``furniture.count_edges``) over all rows and keeps
    those that stand on enough pages.  A key seen on one page only is never
    enough and is not written.  A running line that stands on four pages of its
    book is known when it strays into another book."""

    def run(batches):
        counts: dict = {}
        for batch in batches:
            features(batch, counts)
        found = list(counts.items())
        for i in range(0, len(found), 1 << 16):
            part = found[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array([k[c] for k, _ in part], pa.string()) for c in range(3)),
                    pa.array([c[0] for _, c in part], pa.int64()),
                    pa.array(np.array([c[1] for _, c in part], np.uint64).view(np.int64)),
                ],
                names=["kind", "book", "key", "n", "pages"],
            )

    table = cut(
        spread(df).mapInArrow(run, LINES)
        .groupBy("kind", "book", "key")
        .agg(F.sum("n").alias("n"), F.expr("bit_count(bit_or(pages))").cast("int").alias("spread"))
        .where("kind = 'P' OR spread >= 2")
    )
    books = table.where("kind = 'P'").select("book", F.col("n").alias("total"))
    usual = table.where("kind = 'L'").join(books, "book").where(F.col("n") >= share * F.col("total"))
    own = usual.where((F.col("spread") >= least) | (F.col("n") >= 0.15 * F.col("total"))).select("book", "key")
    numbered = table.where((F.col("kind") == "H") & (F.col("spread") >= least)).select("key")
    anywhere = numbered.union(usual.where("n >= 4 AND spread >= 4").select("key")).distinct()
    a, b = own.toArrow(), anywhere.toArrow()
    return Lines(set(zip(a.column("book").to_pylist(), a.column("key").to_pylist(), strict=True)), set(b.column("key").to_pylist()))
