"""Release tables: pseudonyms, split validation, shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import stripped
from .prefix import numbered


def creator_ids(df: DataFrame, author: str) -> DataFrame:
    """Rows (author, creator_id): trimmed authors in order as creator_01, creator_02, ... (join with `stripped` authors).
    Only the distinct authors are numbered, over ranges of their order; null and blank ones name nobody."""
    names = df.select(stripped(F.col(author)).alias(author)).where(F.col(author) != "").distinct()
    at = numbered(names, [], [author], "__place")
    return at.select(author, F.concat(F.lit("creator_"), F.format_string("%02d", F.col("__place") + 1)).alias("creator_id"))


def split_leaks(df: DataFrame, split: str, key: str) -> DataFrame:
    """Rows (key, splits, rows): keys that stand in more than one split or more than once."""
    x = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.countDistinct(split).alias("splits"), F.count("*").alias("rows"))
    return x.where("splits > 1 or rows > 1")


def require_no_leaks(df: DataFrame, split: str, key: str, preview: int = 5) -> None:
    bad = split_leaks(df, split, key).orderBy(key).limit(preview).collect()
    if bad:
        raise ValueError(f"keys repeated within or across splits, such as {[x[key] for x in bad]}")


def greedy_shards(df: DataFrame, order: list[str], size: str, target: int) -> DataFrame:
    """Adds `shard`, from 0: rows in order fill a shard; a row that would push a shard that isn't empty beyond `target`
    opens the next. Null sizes count as 0.

    The fold is sequential by its nature, so one task streams (order, size) pairs, bounded in memory, a batch's shards being
    found in its running sums; wide columns are joined back afterwards by the caller if need be. Sizes aren't negative.
    """
    schema = df.schema.add("shard", "long")

    def fold(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, filled, empty = 0, 0, True
        for pdf in parts:
            upto = pdf[size].fillna(0).to_numpy().cumsum()
            out, at = np.zeros(len(upto), np.int64), 0
            while at < len(upto):
                before = upto[at - 1] if at else 0
                if empty:
                    end = max(at + 1, int(np.searchsorted(upto, before + target, "right")))  # a row beyond the target is a shard of its own
                else:
                    end = int(np.searchsorted(upto, before + target - filled, "right"))
                if end > at:
                    out[at:end], empty = shard, False
                    filled, at = filled + upto[end - 1] - before, end
                if at < len(upto):
                    shard, filled, empty = shard + 1, 0, True
            yield pdf.assign(shard=out)

    return df.repartition(1).sortWithinPartitions(*order).mapInPandas(fold, schema)


def public_row(columns: list[str], private: list[str]) -> list[Column]:
    return [F.col(c) for c in columns if c not in private]
