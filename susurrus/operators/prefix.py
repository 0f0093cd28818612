"""Running sums over ordered groups of any size.

A window over one key sorts the whole key in one task. Here every key is cut into buckets of its order; rows are summed
within their bucket, buckets (one row each) are summed per key, and both are added. A key that holds a third of all rows
is spread over its buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import cut


def same(left: str, right: str, cols: list[str]):
    """Null-safe equality of the columns `cols` of two aliased sides."""
    out = F.lit(True)
    for c in cols:
        out = out & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return out


def running_sum(df: DataFrame, keys: list[str], bucket: str, order: list[str], value: str, out: str) -> DataFrame:
    """Adds `out`: the sum of `value` over the rows of the same `keys` up to and with this one.

    `bucket` must not decrease along `order`; `order` must be total within a bucket, or ties get an arbitrary order.
    Null values count as 0. An empty table gives an empty table.
    """
    within = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1) if keys else Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(*keys, bucket).agg(F.sum(value).alias("__of_bucket"))
    sums = sums.withColumn("__before", F.coalesce(F.sum("__of_bucket").over(before), F.lit(0))).drop("__of_bucket")
    return (
        df.alias("l")
        .join(sums.alias("r"), same("l", "r", [*keys, bucket]))
        .select("l.*", "r.__before")
        .withColumn(out, F.sum(F.coalesce(F.col(value), F.lit(0))).over(within) + F.col("__before"))
        .drop("__before")
    )


def neighbour(df: DataFrame, keys: list[str], bucket: str, order: list[str], value: str, out: str, ahead: bool = True) -> DataFrame:
    """Adds `out`: `value` of the next row (`ahead`) or the previous row of the same `keys`; null at the end.

    As `running_sum`, it looks within buckets of the order and takes one edge row a bucket across them, so a key of any
    size is spread over its buckets. `bucket` must not decrease along `order`.
    """
    place = F.struct(*order)
    within = Window.partitionBy(*keys, bucket).orderBy(*order)
    move = F.lead if ahead else F.lag
    pick = F.min if ahead else F.max
    edges = df.groupBy(*keys, bucket).agg(pick(F.struct(place.alias("p"), F.col(value).alias("v"))).alias("__edge"))
    edges = edges.withColumn("__over", move(F.col("__edge.v")).over(Window.partitionBy(*keys).orderBy(bucket))).drop("__edge")
    x = df.alias("l").join(edges.alias("r"), same("l", "r", [*keys, bucket])).select("l.*", "r.__over")
    inside = move(F.struct(F.col(value).alias("v"))).over(within)
    return x.withColumn("__in", inside).withColumn(out, F.when(F.col("__in").isNull(), F.col("__over")).otherwise(F.col("__in.v"))).drop("__in", "__over")


def numbered(df: DataFrame, keys: list[str], order: list[str], out: str) -> DataFrame:
    """Adds `out`: the 0-based place of a row among those of the same `keys` (nulls are a key), in the order `order`.

    Rows are sorted over ranges of (keys, order), as for a global sort, and written once; places follow from the places
    in a range and the sizes of the ranges before, so a key that holds a third of all rows is spread over ranges. Ties in
    `order` get an arbitrary order. An empty table gives an empty table.
    """
    parts = cut(df.repartitionByRange(*keys, *order).withColumn("__num_p", F.spark_partition_id()))
    local = F.row_number().over(Window.partitionBy("__num_p", *keys).orderBy(*order)) - 1
    if not keys:
        key, per = F.struct(F.lit(0)), parts.groupBy("__num_p").agg(F.count("*").alias("__num_n"))
    else:
        key, per = F.struct(*keys), parts.groupBy("__num_p", *keys).agg(F.count("*").alias("__num_n"))
    # one row a range: its first key, and its last with the rows of it; only a first key can have rows in ranges before
    edges = cut(per.groupBy("__num_p").agg(F.min(key).alias("__num_first"), F.max(F.struct(key.alias("k"), F.col("__num_n").alias("n"))).alias("__num_last")))
    asks = edges.select("__num_p", F.col("__num_first").alias("__num_k"), F.lit(0).cast("long").alias("__num_n"), F.lit(0).alias("__num_says"))
    says = edges.select("__num_p", F.col("__num_last.k").alias("__num_k"), F.col("__num_last.n").alias("__num_n"), F.lit(1).alias("__num_says"))
    before = Window.partitionBy("__num_k").orderBy("__num_p", "__num_says").rowsBetween(Window.unboundedPreceding, -1)
    known = asks.unionByName(says).withColumn("__num_off", F.coalesce(F.sum("__num_n").over(before), F.lit(0))).where("__num_says = 0").select("__num_p", "__num_k", "__num_off")
    x = parts.withColumn("__num_at", local).withColumn("__num_key", key).alias("l").join(F.broadcast(known).alias("r"), same("l", "r", ["__num_p"])).select("l.*", "r.__num_k", "r.__num_off")
    return x.withColumn(out, F.col("__num_at") + F.when(F.col("__num_key").eqNullSafe(F.col("__num_k")), F.col("__num_off")).otherwise(0)).drop("__num_p", "__num_at", "__num_key", "__num_k", "__num_off")
