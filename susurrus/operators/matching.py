"""Joins: ambiguity-aware identifiers, tolerance intervals, presence in several sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import none_if_empty, stem


def identifiers(*named: Column, path: Column | None = None) -> Column:
    """Candidate keys from strong to weak: the named ids, the path, its stem; without nulls, blanks and repetitions."""
    weak = [path, stem(path)] if path is not None else []
    return F.array_distinct(F.array_compact(F.array(*[none_if_empty(F.trim(x.cast("string"))) for x in [*named, *weak]])))


def match_identifiers(left: DataFrame, left_id: str, left_keys: Column, right: DataFrame, right_id: str, right_keys: Column) -> DataFrame:
    """Rows (left_id, right_id, key): for each left row the right row of its strongest key that exactly one right row has.

    A key of several right rows matches nothing; a weaker key may still match. Left rows without a match have nulls.
    Keys are reduced to (count, row) with a map-side combine, so a key of any number of rows stays one row.
    """
    index = (
        right.select(F.col(right_id).alias("r"), F.explode(right_keys).alias("key")).groupBy("key")
        .agg(F.min("r").alias("r"), F.max("r").alias("top")).where("r <=> top").select("key", "r")
    )
    keys = left.select(F.col(left_id).alias("l"), F.posexplode(left_keys).alias("pos", "key"))
    best = keys.join(index, "key").groupBy("l").agg(F.min(F.struct("pos", "key", "r")).alias("x"))
    return left.select(F.col(left_id).alias("l")).join(best, "l", "left").select(F.col("l").alias(left_id), F.col("x.r").alias(right_id), F.col("x.key").alias("key"))


def match_intervals(left: DataFrame, right: DataFrame, keys: list[str], tolerance: float = 0.51) -> DataFrame:
    """Pairs of rows with equal keys whose `start` and `end` differ by at most `tolerance`, with all columns of both
    (the right ones named r_...). An equi-join on buckets of one tolerance: the left start goes to its bucket and both
    neighbours, the right start to its own, so no pair comes twice and nothing is compared across buckets."""
    width = F.lit(float(tolerance))
    own = F.floor(F.col("start") / width)
    a = left.withColumn("__b", F.explode(F.array(own - 1, own, own + 1)))
    b = right.select(*[F.col(c).alias(c if c in keys else f"r_{c}") for c in right.columns]).withColumn("__b", F.floor(F.col("r_start") / width))
    return a.join(b, [*keys, "__b"]).where((F.abs(F.col("start") - F.col("r_start")) <= width) & (F.abs(F.col("end") - F.col("r_end")) <= width)).drop("__b")


def presence(sources: dict[str, DataFrame]) -> DataFrame:
    """Rows (id, <source>..., n): for every id of any source (frames of one column) in which sources it is."""
    tagged = None
    for name, df in sources.items():
        x = df.select(F.col(df.columns[0]).cast("string").alias("id"), *[F.lit(int(k == name)).alias(k) for k in sources])
        tagged = x if tagged is None else tagged.unionByName(x)
    out = tagged.where("id is not null").groupBy("id").agg(*[F.max(k).alias(k) for k in sources])
    return out.withColumn("n", sum((F.col(k) for k in sources), F.lit(0)))


def aligned(sources: dict[str, DataFrame], strict: bool = True) -> DataFrame:
    """Rows (id): the ids that every source (frames of one column) has. If `strict`, ids that only some have are an error;
    no common id is one always."""
    x = presence(sources)
    n = x.agg(F.count("*").alias("all"), F.count_if(F.col("n") == len(sources)).alias("common"), *[F.sum(k).alias(k) for k in sources]).first()
    if strict and n["all"] != n["common"]:
        raise ValueError("ids differ: " + ", ".join(f"{k}={n[k]}" for k in sources) + f", common={n['common']}")
    if not n["common"]:
        raise ValueError("no common ids")
    return x.where(F.col("n") == len(sources)).select("id")


def model_files(labels: DataFrame, models: DataFrame, files: DataFrame) -> DataFrame:
    """Rows (audio_id, model, path, there): the file that each model (id, audio_dir, filename with {audio_id}) should have for
    each label (audio_id), and whether it is among `files` (path). Models are few: their list goes to each label as a literal,
    and the paths are one equi-join with the listing."""
    known = F.array(*[F.struct(F.lit(r["id"]).alias("model"), F.lit(r["audio_dir"].rstrip("/")).alias("dir"), F.lit(r["filename"]).alias("name")) for r in models.orderBy("id").collect()])
    x = labels.select("audio_id", F.explode(known).alias("m"))
    x = x.select("audio_id", "m.model", F.concat("m.dir", F.lit("/"), F.replace(F.col("m.name"), F.lit("{audio_id}"), F.col("audio_id"))).alias("path"))
    have = files.select("path").distinct().withColumn("there", F.lit(True))
    return x.join(have, "path", "left").select("audio_id", "model", "path", F.coalesce("there", F.lit(False)).alias("there"))


def usable(of_models: DataFrame) -> DataFrame:
    """Rows (audio_id): the labels for which every model has its file."""
    return of_models.groupBy("audio_id").agg(F.bool_and("there").alias("all")).where("all").select("audio_id")


def representative(records: DataFrame, key: str, paths: str, files: DataFrame) -> DataFrame:
    """Rows (key, path, there): of the paths (array) of each record the first that is among `files` (path), else the first that
    isn't blank; null if there is none. Paths are exploded and joined once; a record is reduced to one row."""
    x = records.select(key, F.posexplode_outer(paths).alias("pos", "path")).withColumn("path", none_if_empty(F.trim("path")))
    x = x.join(files.select("path").distinct().withColumn("there", F.lit(True)), "path", "left").withColumn("there", F.coalesce("there", F.lit(False)))
    best = x.groupBy(key).agg(F.min_by(F.struct("path", "there"), F.when(F.col("path").isNotNull(), F.struct((~F.col("there")).alias("a"), F.col("pos").alias("b")))).alias("x"))
    return best.select(key, "x.path", F.coalesce("x.there", F.lit(False)).alias("there"))


def only_wav(files: DataFrame) -> DataFrame:
    """Rows (folder, name): the wav of each folder (folder, name): the one named like the folder, else the only one; folders
    with several others have no row."""
    x = files.where(F.lower("name").endswith(".wav")).withColumn("own", F.col("name") == F.concat("folder", F.lit(".wav")))
    y = x.groupBy("folder").agg(F.max(F.when(F.col("own"), F.col("name"))).alias("own"), F.min("name").alias("low"), F.max("name").alias("high"))
    return y.select("folder", F.coalesce("own", F.when(F.col("low") == F.col("high"), F.col("low"))).alias("name")).where("name is not null")
