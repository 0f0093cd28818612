"""Overlapping and gapped time intervals: continuous periods and gaps per entity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .prefix import same


def milliseconds(col):
    """Whole milliseconds of seconds; null for null, NaN and infinite values."""
    x = F.col(col).cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(9e12)), F.round(x * 1000).cast("bigint"))


def periods_and_gaps(df: DataFrame, keys: list[str], start: str, end: str, max_gap_ms: int | None = None, bucket_ms: int = 600_000) -> DataFrame:
    """Rows (keys, kind, from_ms, to_ms): every longest stretch covered without a hole, and every hole between two
    neighbouring stretches of an entity that lasts at most `max_gap_ms` (null: any length).

    Intervals are sorted by start per entity and each start is compared with the running maximum of the ends before it; a
    start beyond that maximum opens an island, islands are numbered cumulatively and aggregated to periods, and the gap
    before a period is (maximum before, start). The running maximum and the numbering are carried over buckets of
    `bucket_ms` of start time: a task sorts one bucket of one entity, never a whole entity, and equal starts are merged
    before the first shuffle. Touching intervals form one stretch.

    Rows with a null, NaN or infinite bound or end <= start are ignored; a null entity is an entity of its own; repeated
    rows change nothing; an empty table gives no rows. Other columns are not read, whatever their names.
    """
    s, e = milliseconds(start), milliseconds(end)
    rows = df.select(*keys, s.alias("__s"), e.alias("__e")).where(F.col("__s") < F.col("__e"))
    rows = rows.groupBy(*keys, "__s").agg(F.max("__e").alias("__e"))
    rows = rows.withColumn("__b", F.floor(F.col("__s") / F.lit(bucket_ms)))
    at = [*keys, "__b"]

    before = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carry = rows.groupBy(*at).agg(F.max("__e").alias("__m")).select(*at, F.max("__m").over(before).alias("__carry"))
    earlier = Window.partitionBy(*at).orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    marked = (
        rows.alias("l").join(carry.alias("r"), same("l", "r", at)).select("l.*", "r.__carry")
        .withColumn("__prev", F.greatest(F.max("__e").over(earlier), F.col("__carry")))
        .withColumn("__opens", (F.col("__prev").isNull() | (F.col("__s") > F.col("__prev"))).cast("bigint"))
        .withColumn("__local", F.sum("__opens").over(Window.partitionBy(*at).orderBy("__s").rowsBetween(Window.unboundedPreceding, 0)))
    )
    parts = marked.groupBy(*at, "__local").agg(
        F.min("__s").alias("__s"), F.max("__e").alias("__e"), F.max(F.when(F.col("__opens") == 1, F.col("__prev"))).alias("__prev")
    )
    offsets = parts.groupBy(*at).agg(F.max("__local").alias("__n")).select(*at, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    periods = (
        parts.alias("l").join(offsets.alias("r"), same("l", "r", at))
        .select("l.*", (F.col("l.__local") + F.col("r.__off")).alias("__label"))
        .groupBy(*keys, "__label")
        .agg(F.min("__s").alias("__s"), F.max("__e").alias("__e"), F.max("__prev").alias("__prev"))
    )
    gap = F.col("__prev").isNotNull() if max_gap_ms is None else (F.col("__s") - F.col("__prev")) <= max_gap_ms
    both = F.array(
        F.struct(F.lit("period").alias("kind"), F.col("__s").alias("from_ms"), F.col("__e").alias("to_ms")),
        F.when(gap, F.struct(F.lit("gap").alias("kind"), F.col("__prev").alias("from_ms"), F.col("__s").alias("to_ms"))),
    )
    return periods.select(*keys, F.explode(F.array_compact(both)).alias("x")).select(*keys, "x.*")
