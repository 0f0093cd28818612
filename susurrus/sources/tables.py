"""Parquet tables of a folder, and tables written to cut a lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table `name` of `folder`; column pruning and pushed filters stay with Catalyst."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Temporary folders of local applications without a shared folder, and the folders that `cut` wrote, by application.
_LOCAL: dict[str, str] = {}
_WRITTEN: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: `spark.checkpoint.dir` of the session or its configuration.

    Where it is unset, a local application (tests) gets a temporary folder, the same for all its sessions; on a cluster
    that is an error, because executors on other machines would not see such a folder. The session is not changed.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = f"file://{tempfile.mkdtemp(prefix='susurrus-')}"
    return _LOCAL[app]


def cut(df: DataFrame) -> DataFrame:
    """Writes `df` once to the shared folder and reads it back.

    Later steps start from the files, so a lost executor costs a re-read and no recomputation; unlike checkpoint(), the
    plan runs once and later scans keep column pruning.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(df: DataFrame) -> None:
    """Deletes the files of a `cut` that nothing reads any more."""
    spark = df.sparkSession
    mine = _WRITTEN.get(spark.sparkContext.applicationId, [])
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        for path in [p for p in mine if p.rsplit("/", 1)[-1] == folder.rsplit("/", 1)[-1]]:
            _delete(spark, path)
            mine.remove(path)


def release_all(spark: SparkSession) -> None:
    """Deletes the files of every `cut` of this application: to be called when the results that read them are written."""
    for path in _WRITTEN.pop(spark.sparkContext.applicationId, []):
        _delete(spark, path)
