"""Timelines: canonical seconds, order, and ends from the next start."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import seconds_of, timeline_line
from .prefix import neighbour, same


def first_by(df: DataFrame, keys: list[str], order: list, keep: int = 1) -> DataFrame:
    """The first `keep` rows of each key in the given order. Spark filters the row numbers in the map stage too
    (WindowGroupLimit), so a hot key is cut before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= keep).drop("__rn")


def parse_description(df: DataFrame, video: str, text: str) -> DataFrame:
    """Rows (video, pos, time_str, seconds, title): the time-marked lines of descriptions, one a second, the first kept."""
    lines = df.select(video, F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    mark, title = timeline_line(F.col("line"))
    rows = lines.select(video, "pos", mark.alias("time_str"), title.alias("title")).withColumn("seconds", seconds_of(F.col("time_str"))).where("seconds is not null")
    return first_by(rows, [video, "seconds"], ["pos"]).select(video, "pos", "time_str", "seconds", "title")


def normalize(df: DataFrame, video: str, pos: str, mark: str, seconds: str, duration: str, bucket_seconds: int = 3_600, strict: bool = True) -> DataFrame:
    """Adds `second` (from the mark, else the stored seconds), `corrected`, and `start`, `end`: rows of a video in order of
    (second, pos), each ending where the next begins, the last at the duration of the track (the greatest `duration` of the
    video).

    A track that ends before its last row begins is refused: an error when read, or, if not `strict`, an `end` of null.
    Rows without any second are left out if not `strict`, else they are an error. Next starts are looked up within hours
    and carried over their edges, so no task sorts a whole video. A null video is a video of its own; a video without any
    duration has no last end.
    """
    by_mark = seconds_of(F.col(mark))
    second = F.coalesce(by_mark, F.col(seconds).try_cast("int"))
    if strict:
        second = F.coalesce(second, F.raise_error(F.concat(F.lit("neither a time nor seconds: "), F.coalesce(F.col(mark).cast("string"), F.lit("null")))).cast("int"))
    rows = df.withColumn("second", second).where("second is not null")
    rows = rows.withColumn("corrected", F.coalesce(by_mark != F.col(seconds), F.lit(False))).withColumn("start", F.col("second").cast("double"))
    ends = rows.groupBy(video).agg(F.max(F.col(duration).cast("double")).alias("__whole"))
    x = neighbour(rows.withColumn("__b", F.floor(F.col("second") / bucket_seconds)), [video], "__b", ["second", pos], "start", "__next")
    x = x.alias("l").join(ends.alias("r"), same("l", "r", [video])).select("l.*", "r.__whole")
    end = F.coalesce("__next", "__whole")
    early = F.raise_error(F.concat(F.lit("the track ends before its last row begins: "), F.coalesce(F.col(video).cast("string"), F.lit("null")))).cast("double") if strict else F.lit(None).cast("double")
    return x.withColumn("end", F.when(end < F.col("start"), early).otherwise(end)).drop("__b", "__next", "__whole")


def gaps(df: DataFrame, keys: list[str], start: str, end: str, bucket: float = 3_600.0) -> DataFrame:
    """Per key the number, least, greatest and mean of start minus previous end, rows in order of (start, end)."""
    x = df.where(F.col(start).isNotNull() & F.col(end).isNotNull()).withColumn("__b", F.floor(F.col(start) / bucket))
    x = neighbour(x, keys, "__b", [start, end], end, "__prev", ahead=False).withColumn("gap", F.col(start) - F.col("__prev")).where("gap is not null")
    return x.groupBy(*keys).agg(F.count("*").alias("gaps"), F.min("gap").alias("least"), F.max("gap").alias("greatest"), F.avg("gap").alias("mean"))
