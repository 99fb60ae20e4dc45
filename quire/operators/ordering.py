"""Places in a total order, without one task that sees all rows."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import written


def placed(df: DataFrame, order: list[Column | str], into: str = "place") -> DataFrame:
    """Adds the place (from 1) of each row in the given order.

    Rows are parted by ranges of the order and counted within their part; a
    part's first place is the number of rows in the parts before it, of which
    the driver reads one count each.  Nulls come first; rows that the order
    does not tell apart get any of their places.  An existing ``into`` is
    replaced.
    """
    rows = df.drop(into)
    parts = written(rows.repartitionByRange(*order).withColumn("part_", F.spark_partition_id()), "places")
    sizes = sorted(tuple(r) for r in parts.groupBy("part_").agg(F.count("*").alias("n")).collect())
    before = accumulate((n for _, n in sizes), initial=0)
    firsts = df.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(sizes, before, strict=False)], "part_ int, before_ long")
    here = F.row_number().over(Window.partitionBy("part_").orderBy(*order))
    return parts.withColumn("here_", here).join(F.broadcast(firsts), "part_").withColumn(into, F.col("before_") + F.col("here_")).select(*rows.columns, into)
