"""Deterministic order by hash, and stratified round-robin samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .timelines import first_by


def stable_hash(seed: Column, x: Column) -> Column:
    """md5 of `seed:x`, in hex."""
    return F.md5(F.concat_ws(":", seed.cast("string"), x.cast("string")))


def round_robin(df: DataFrame, stratum: str, key: str, n: int, seed: int) -> DataFrame:
    """`n` rows drawn in turn from the strata, each in hash order: first the first of each stratum, then the second, ...

    A stratum gives at most `n` rows, so each is cut to its first `n` before the shuffle; the final order sorts at most
    n rows a stratum. Rows with a null stratum are left out; of rows with one key the first by hash counts.
    """
    x = df.where(F.col(stratum).isNotNull()).withColumn("__h", stable_hash(F.lit(seed), F.col(key))).withColumn("__s", stable_hash(F.lit(seed), F.col(stratum)))
    x = first_by(x, [stratum], ["__h", key], keep=n)
    x = x.withColumn("turn", F.row_number().over(Window.partitionBy(stratum).orderBy("__h", key)))
    return x.orderBy("turn", "__s", "__h").limit(n).drop("__h", "__s")
