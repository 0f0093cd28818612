"""Equi-joins of tables whose keys may be hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import cut

#: A right side of up to this many rows is broadcast (some 100 bytes a row).
BROADCAST_ROWS = 100_000
#: A key with at least one in so many left rows is hot; there are at most that many.
HOT_ONE_IN = 2_000


def hot_join(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """`left` joined with `right` (one row a key, columns apart from those of `left` but for `key`), `how` left or inner.

    A right side of up to BROADCAST_ROWS rows, counted first, is broadcast. Beyond it, the keys with at least one row in
    HOT_ONE_IN of `left` (so at most HOT_ONE_IN keys, told from counts with a map-side combine) are still joined by
    broadcast, and only the rows of the others are shuffled: no task gets all rows of a hot key. Rows with a null key have
    no match and aren't shuffled either. `right` should be cheap to read twice (a table or a `cut`).
    """
    if right.count() <= BROADCAST_ROWS:
        return left.join(F.broadcast(right), key, how)
    counts = cut(left.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__n")))
    whole = counts.agg(F.sum("__n")).first()[0] or 0
    hot = cut(counts.where(F.col("__n") >= whole / HOT_ONE_IN).select(key))
    few = cut(right.join(F.broadcast(hot), key, "left_semi"))
    marked = left.join(F.broadcast(hot.withColumn("__hot", F.lit(True))), key, "left")
    direct = marked.where(F.col("__hot") | F.col(key).isNull()).drop("__hot").join(F.broadcast(few), key, how)
    rest = marked.where(F.col("__hot").isNull() & F.col(key).isNotNull()).drop("__hot").join(right, key, how)
    return direct.unionByName(rest)
