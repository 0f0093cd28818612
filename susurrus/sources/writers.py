"""Sinks: release shards, joined timeline cells, frequency tables, upserts."""

from __future__ import annotations

import json
import math
import re
import uuid
from collections.abc import Iterable, Iterator
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.prefix import numbered, same
from ..operators.release import greedy_shards
from .readers import LEDGER
from .tables import cut

#: Sizes of small shards that one task writes one after another, together about.
TASK_BYTES = 64 << 20
#: With version 2 tasks move their own files instead of the driver all: the folder beside is seen by nobody before its rows agree.
COMMIT = "mapreduce.fileoutputcommitter.algorithm.version"


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def write_text(spark: SparkSession, path: str, parts: Iterable[str]) -> None:
    """Writes one file from its parts and renames it into place, so a reader sees the old file or the whole new one."""
    at, fs = _fs(spark, path)
    temporary = spark._jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{at.getName()}.tmp")
    out = fs.create(temporary, True)
    for p in parts:
        out.write(bytearray(p.encode()))
    out.close()
    fs.delete(at, False)
    if not fs.rename(temporary, at):
        raise OSError(f"can't rename into {path}")


def write_document(df: DataFrame, path: str, key: str = "data", **facts: str) -> None:
    """Writes the rows as one JSON document `{facts, key: [...]}`, streamed through the driver partition by partition."""
    spark = df.sparkSession
    rows = (r[0] for r in df.select(F.to_json(F.struct(*df.columns))).toLocalIterator())

    def parts() -> Iterator[str]:
        yield "{" + "".join(f"{json.dumps(k)}: {json.dumps(v)}, " for k, v in facts.items()) + f"{json.dumps(key)}: [\n"
        for k, row in enumerate(rows):
            yield (",\n" if k else "") + row
        yield "\n]}\n"

    write_text(spark, path, parts())


def _rows_by_file(spark: SparkSession, path: str, glob: str) -> dict[str, int]:
    """Rows of each Parquet file below `path` whose name fits `glob`, by its full path: one job lists the folders and one
    reads the footers, in few tasks of many files each. Files without rows are not among them."""
    tasks = 4 * spark.sparkContext.defaultParallelism
    own = spark._jsparkSession.newSession()  # the caller's session is not changed
    own.conf().set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(tasks))
    files = own.read().schema("__none int").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).parquet(path)
    x = DataFrame(files, spark).coalesce(tasks).groupBy(F.col("_metadata.file_path").alias("at"))
    return {unquote(r["at"]): r["n"] for r in x.agg(F.count("*").alias("n")).collect()}


def write_shards(df: DataFrame, path: str, split: str, order: list[str], size: str, target_bytes: int, resume: bool = True) -> DataFrame:
    """Writes `df` as zstd Parquet files `split-00000-of-000NN.parquet`, one a greedy shard, and returns (name, rows, written).

    With `resume`, a file that is there with as many rows as its shard has is kept. Others are written to a folder beside,
    their rows counted from the files, and renamed into place only if all counts agree. A shard is written by one task, which
    writes small shards one after another; rows are counted by one job for all files, so the number of jobs doesn't grow with
    the shards. The driver sees one row a shard and renames the files.
    """
    spark = df.sparkSession
    parts = cut(greedy_shards(df.select(*order, size), order, size, target_bytes).select(*order, size, "shard"))
    found = parts.groupBy("shard").agg(F.count("*").alias("n"), F.sum(size).alias("bytes")).collect()
    want, filled = {r["shard"]: r["n"] for r in found}, {r["shard"]: r["bytes"] or 0 for r in found}
    names = {k: f"{split}-{k:05d}-of-{len(want):05d}.parquet" for k in want}
    folder, fs = _fs(spark, path)
    fs.mkdirs(folder)
    there, done = {}, fs.getFileStatus(folder).getPath().toString()
    if resume and want:
        ours = re.sub(r"([\\*?\[\]{}])", r"\\\1", split) + f"-*-of-{len(want):05d}.parquet"
        there = _rows_by_file(spark, path, ours)
    todo = [k for k in sorted(want) if there.get(f"{done}/{names[k]}") != want[k]]
    beside = f"{path}/.writing-{uuid.uuid4().hex}"
    if todo:
        due = parts.select(*order, "shard")
        if len(todo) < len(want):
            due = due.join(F.broadcast(spark.createDataFrame([(k,) for k in todo], "shard long")), "shard", "left_semi")
        tasks = min(len(todo), max(4 * spark.sparkContext.defaultParallelism, math.ceil(sum(filled[k] for k in todo) / TASK_BYTES)))
        df.join(due, order).repartition(tasks, "shard").sortWithinPartitions("shard", *order).write.option("compression", "zstd").option(COMMIT, "2").partitionBy("shard").parquet(beside)
        made: dict[int, list] = {}
        for at, n in _rows_by_file(spark, beside, "*.parquet").items():
            made.setdefault(int(at.rsplit("/", 2)[-2].removeprefix("shard=")), []).append((at.rsplit("/", 1)[-1], n))
        for k in todo:
            if [n for _, n in made.get(k, [])] != [want[k]]:
                raise RuntimeError(f"rows of {names[k]} don't agree")
        hadoop_path = spark._jvm.org.apache.hadoop.fs.Path  # looked up once: each lookup is several calls of the JVM
        for k in todo:
            to = hadoop_path(folder, names[k])
            fs.delete(to, False)
            if not fs.rename(hadoop_path(f"{beside}/shard={k}/{made[k][0][0]}"), to):
                raise OSError(f"can't rename into {names[k]}")
        fs.delete(_fs(spark, beside)[0], True)
    new = set(todo)
    return spark.createDataFrame([(names[k], want[k], k in new) for k in sorted(want)], "name string, rows long, written boolean")


def write_metadata(df: DataFrame, path: str, audio: str = "audio") -> None:
    """JSON lines of the rows with the audio's base name in place of its path."""
    df.withColumn(audio, F.regexp_extract(audio, r"([^/]*)$", 1)).write.mode("overwrite").json(path)


def write_frequencies(df: DataFrame, value: str, path: str) -> None:
    """Values and counts as tab-separated text, the most frequent first."""
    frequency_table(df, value).write.mode("overwrite").option("sep", "\t").csv(path)


def write_table(df: DataFrame, path: str, **options) -> None:
    """CSV with a header; a table without rows is a file of its header."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').options(**options).csv(path)


def append_ledger(df: DataFrame, path: str) -> None:
    """Appends rows (columns LEDGER) to a ledger."""
    df.select(*LEDGER).fillna("").write.mode("append").option("header", True).option("escape", '"').csv(path)


def timeline_line(marks: Column, titles: Column) -> Column:
    """The marks and titles of a timeline (arrays in order) in one line, `mark title | mark title`."""
    parts = F.zip_with(marks, titles, lambda m, t: F.trim(F.concat_ws(" ", m, F.when(t != "", t))))
    return F.array_join(parts, " | ")


def purge(rows: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """The rows that agree with no row of `gone` in any one of `keys` (an anti-join for each; nulls agree with nothing)."""
    for k in keys:
        rows = rows.join(gone.where(F.col(k).isNotNull()).select(k).distinct(), k, "left_anti")
    return rows


def timeline_cells(df: DataFrame, key: list[str], order: str, start: str, end: str) -> DataFrame:
    """Rows (key, clean_start, clean_end): the windows of a line joined by `;` in order."""
    x = df.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct(order, F.col(start).alias("a"), F.col(end).alias("b")))).alias("w"))
    return x.select(*key, F.concat_ws(";", F.transform("w", lambda v: v["a"].cast("string"))).alias("clean_start"), F.concat_ws(";", F.transform("w", lambda v: v["b"].cast("string"))).alias("clean_end"))


def frequency_table(df: DataFrame, value: str) -> DataFrame:
    return df.where(F.trim(F.col(value)) != "").groupBy(F.trim(F.col(value)).alias(value)).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.lower(value), value)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Both tables with one row a key: of `new`, the greatest `version`; else the row of `old`."""
    x = old.withColumn("__rank", F.lit(0)).unionByName(new.withColumn("__rank", F.lit(1)))
    w = Window.partitionBy(*keys).orderBy(F.desc("__rank"), F.desc(version))
    return x.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn", "__rank")


def segment_rows(df: DataFrame, video: str, order: list[str], private: list[str]) -> DataFrame:
    """Windows as a segment document's rows, one JSON line each with its place and the number of rows of its video, without
    private fields: a video of any size stays many lines, never one cell."""
    n = cut(df.groupBy(video).agg(F.count("*").alias("segment_count")))
    x = numbered(df.drop(*private), [video], order, "segment_index")
    return x.alias("l").join(F.broadcast(n).alias("r") if n.count() <= 100_000 else n.alias("r"), same("l", "r", [video])).select("l.*", "r.segment_count")


def write_creator_map(ids: DataFrame, path: str, note: str = "Internal only.") -> None:
    """The private map of pseudonyms to authors, in a place of its own; release rows never carry the authors."""
    write_document(ids.select("creator_id", "author").orderBy("creator_id"), path, "creators", note=note)


def write_sorted(df: DataFrame, path: str, key: str, **facts: str) -> None:
    """Results as one document in order of `key`."""
    write_document(df.orderBy(key), path, "results", **facts)


def release_manifest(parts: dict[str, DataFrame], path: str) -> dict:
    """Writes and returns {name: rows} of the parts of a release."""
    facts = {name: df.count() for name, df in parts.items()}
    any_part = next(iter(parts.values()))
    write_text(any_part.sparkSession, path, [json.dumps({"parts": facts}, ensure_ascii=False)])
    return facts
