"""Incremental work: pending rows, resume, and keyed upserts of a stream."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.writers import upsert


def pending(rows: DataFrame, done: DataFrame, key: str, good=None) -> DataFrame:
    """Rows whose key has no good result yet; results that `good` rejects (errors) are done again."""
    ok = done if good is None else done.where(good)
    return rows.join(ok.select(key).distinct(), key, "left_anti")


def resume(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Old and new results, the new winning."""
    return new.unionByName(old.join(new.select(key), key, "left_anti"), allowMissingColumns=True)


class Table:
    """A keyed Parquet table in buckets of its keys below one folder, for the upserts of a stream.

    A batch rewrites the buckets that its keys fall into and no other, into files of its own number; a manifest, renamed
    into place when they are complete, says which number each bucket is read from. So a batch costs what it touches, a
    failed one leaves the table as it was, a batch that ran before is recognised by its number, and files that the newest
    manifest doesn't name are deleted. One writer at a time.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 64) -> None:
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets

    def _path(self, name: str = ""):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _manifest(self) -> tuple[int, dict[str, int]]:
        """(number of the newest batch or -1, bucket -> number of its files)."""
        path, fs = self._path()
        names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        done = [int(n.removeprefix("manifest-").removesuffix(".json")) for n in names if n.startswith("manifest-") and n.endswith(".json")]
        if not done:
            return -1, {}
        text = self.spark.read.text(f"{self.folder}/manifest-{max(done)}.json", wholetext=True).first()[0]
        return max(done), json.loads(text)

    def _files(self, at: dict[str, int]) -> DataFrame | None:
        paths = [f"{self.folder}/v={v}/__b={b}" for b, v in sorted(at.items())]
        return self.spark.read.parquet(*paths) if paths else None

    def read(self) -> DataFrame | None:
        return self._files(self._manifest()[1])

    def merge(self, batch: DataFrame, number: int, keys: list[str], version: str) -> None:
        last, at = self._manifest()
        if number <= last:
            return
        new = batch.withColumn("__b", F.pmod(F.xxhash64(*keys), F.lit(self.buckets)))
        touched = [str(x[0]) for x in new.select("__b").distinct().collect()]  # at most as many as there are buckets
        old = self._files({b: at[b] for b in touched if b in at})
        base = batch.limit(0) if old is None else old
        merged = upsert(base, batch, keys, version).withColumn("__b", F.pmod(F.xxhash64(*keys), F.lit(self.buckets)))
        merged.repartition("__b").write.mode("overwrite").partitionBy("__b").parquet(f"{self.folder}/v={number}")
        after = at | {b: number for b in touched}
        temporary, fs = self._path(f"writing-{number}")
        out = fs.create(temporary, True)
        out.write(bytearray(json.dumps(after).encode()))
        out.close()
        fs.rename(temporary, self._path(f"manifest-{number}.json")[0])
        for b in touched:
            if b in at:
                fs.delete(self._path(f"v={at[b]}/__b={b}")[0], True)
        if last >= 0:
            fs.delete(self._path(f"manifest-{last}.json")[0], False)
        for v in set(at.values()) - set(after.values()):
            fs.delete(self._path(f"v={v}")[0], True)


def upsert_stream(stream: DataFrame, table: Table, keys: list[str], version: str, checkpoint: str, before: Callable[[DataFrame], DataFrame] | None = None):
    """Starts a query that upserts each micro-batch of what is there now into `table`; await its end."""

    def each(batch: DataFrame, number: int) -> None:
        table.merge(before(batch) if before else batch, number, keys, version)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def session_counts(stream: DataFrame, time: str, user: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Events by user and session; works on tables and, with a watermark for late rows, on streams."""
    return stream.withWatermark(time, late).groupBy(F.col(user), F.session_window(time, gap).alias("s")).agg(F.count("*").alias("events")).select(user, F.col("s.start").alias("start"), F.col("s.end").alias("end"), "events")
