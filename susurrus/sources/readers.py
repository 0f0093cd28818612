"""Scans of annotation documents: JSON wrappers, JSON lines, timeline CSVs, vocabularies, predictions, audio."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import none_if_empty, token

#: Keys under which a wrapper may hold its rows, in order of preference.
ROW_KEYS = ["data", "events", "items", "annotations"]


def json_rows(spark: SparkSession, path: str, row: T.StructType | str, keys: list[str] | None = None, required: bool = False) -> DataFrame:
    """Rows of JSON documents that are a list, or an object with its list under the first of `keys` that it has.

    A given schema, so nothing is inferred; a record that doesn't parse raises. Null elements are dropped. `required`
    raises where no list is found, else such a document has no rows. Adds `doc_path` and `pos`, the place in the list.
    """
    keys = keys or ROW_KEYS
    row = row if isinstance(row, str) else row.simpleString()
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("doc_path"), F.trim("value").alias("value"))
    wrapped = F.from_json("value", "struct<" + ",".join(f"{k}:array<{row}>" for k in keys) + ">", {"mode": "FAILFAST"})
    listed = F.from_json("value", f"array<{row}>", {"mode": "FAILFAST"})
    rows = F.when(F.col("value").startswith("["), listed).otherwise(F.coalesce(*[wrapped[k] for k in keys]))
    if required:
        rows = F.coalesce(rows, F.raise_error(F.concat(F.lit("no list of rows in "), "doc_path")).cast(f"array<{row}>"))
    return text.select("doc_path", F.posexplode(rows).alias("pos", "row")).where("row is not null").select("doc_path", "pos", "row.*")


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines; a line that doesn't parse raises."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def unique_values(df: DataFrame, key: str, value: str) -> DataFrame:
    """Rows (key, value) where empty keys or values and repeated keys are errors."""
    x = df.select(F.trim(F.col(key)).alias(key), F.trim(F.col(value)).alias(value))
    bad = (F.coalesce(F.col(key), F.lit("")) == "") | (F.coalesce(F.col(value), F.lit("")) == "")
    x = x.withColumn(key, F.when(bad, F.raise_error(F.lit("empty id or value")).cast("string")).otherwise(F.col(key)))
    y = x.groupBy(key).agg(F.min(value).alias(value), F.count("*").alias("n"))
    return y.select(F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("repeated id "), key)).cast("string")).otherwise(F.col(key)).alias(key), value)


def timeline_csv(spark: SparkSession, path: str) -> DataFrame:
    """Timeline CSVs (video_id, time, start, end, seconds, segment_title), byte-order mark and blanks in the header
    tolerated; rows without start or end are left out; a blank video_id is the name of the folder."""
    raw = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path)
    x = raw.select(*[F.col(f"`{c}`").alias(c.replace("﻿", "").strip()) for c in raw.columns], F.regexp_extract("_metadata.file_path", r"([^/]+)/[^/]+$", 1).alias("__folder"))
    for c in ("start", "end"):
        if c not in x.columns:
            raise ValueError(f"timeline without column {c}")
    x = x.where("trim(start) <> '' and trim(end) <> ''")
    video = none_if_empty(F.trim("video_id")) if "video_id" in x.columns else F.lit(None).cast("string")
    return x.withColumn("video_id", F.coalesce(video, F.col("__folder"))).withColumn("start", F.col("start").try_cast("double")).withColumn("end", F.col("end").try_cast("double")).drop("__folder")


def verb_lexicon(df: DataFrame, verb_class: str, verbs: str) -> DataFrame:
    """Rows (verb, verb_class, pos) of a class table with `;` or `,` separated verbs; a verb in two classes, or no verb at
    all, is an error when read."""
    x = df.select(F.col(verb_class).alias("verb_class"), F.posexplode(F.split(verbs, "[;,]")).alias("pos", "v")).select(token(F.col("v")).alias("verb"), "verb_class", "pos").where("verb <> ''")
    y = x.groupBy("verb").agg(F.min("verb_class").alias("verb_class"), F.min("pos").alias("pos"), F.countDistinct("verb_class").alias("n"))
    if y.isEmpty():
        raise ValueError("verb lexicon is empty")
    return y.select(F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("verb in two classes: "), "verb")).cast("string")).otherwise(F.col("verb")).alias("verb"), "verb_class", "pos")


def alias_map(df: DataFrame, group: str, alias: str, status: str | None = None) -> DataFrame:
    """Rows (alias, group) of approved aliases; an alias in two groups is an error when read."""
    x = df if status is None else df.where(F.coalesce(F.lower(F.trim(F.col(status))), F.lit("approved")) == "approved")
    y = x.select(F.lower(F.trim(F.col(alias))).alias("alias"), F.col(group).alias("grp")).where("alias <> ''").groupBy("alias").agg(F.min("grp").alias("group"), F.countDistinct("grp").alias("n"))
    return y.select(F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("alias in two groups: "), "alias")).cast("string")).otherwise(F.col("alias")).alias("alias"), "group")


def predictions(df: DataFrame, run: str, question: str, place: str) -> DataFrame:
    """Rows (run_id, question_id, pred): pred_logprob, else pred_label, else pred, trimmed in upper case; blank ones don't
    count, of repeated questions the last does."""
    have = [none_if_empty(F.upper(F.trim(F.col(c)))) for c in ("pred_logprob", "pred_label", "pred") if c in df.columns]
    x = df.select(F.col(run).alias("run_id"), F.col(question).cast("string").alias("question_id"), F.coalesce(*have).alias("pred"), F.col(place).alias("__at")).where("pred is not null")
    return x.groupBy("run_id", "question_id").agg(F.max_by("pred", "__at").alias("pred"))


def listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Rows (path, name, folder, modified, bytes) of files, found recursively; contents are not read."""
    x = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return x.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("folder"), F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


def disambiguation(spark: SparkSession, path: str) -> DataFrame:
    """Rows (verb_class, rules): blocks of a text file that begin with a line `name —`, rules being the lines `- ...` below."""
    text = spark.read.text(path, wholetext=True).select(F.split("value", r"\r?\n").alias("lines"))
    head = lambda x: x.rlike(r"^[a-z][a-z0-9_]*\s+—")
    # blocks are folded within the (small) file: a header opens a block, other lines join the last one
    blocks = F.aggregate(
        "lines", F.array().cast("array<array<string>>"),
        lambda acc, x: F.when(head(x), F.concat(acc, F.array(F.array(x)))).when(F.size(acc) == 0, acc).otherwise(F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.concat(F.element_at(acc, -1), F.array(x))))),
    )
    return text.select(F.explode(blocks).alias("b")).select(F.regexp_extract(F.col("b")[0], r"^([a-z][a-z0-9_]*)", 1).alias("verb_class"), F.filter("b", lambda x: x.startswith("- ")).alias("rules"))


def text_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows (doc_path, line_no, line) of text files, line numbers from 1; a file is split in one task."""
    x = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("doc_path"), F.posexplode(F.split("value", r"\r?\n")).alias("at", "line"))
    return x.select("doc_path", (F.col("at") + 1).alias("line_no"), "line")


def numbered_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows (doc_path, line_no, <schema>) of JSON lines; blank lines are skipped, a line that is no JSON object is an error
    that names file and line."""
    x = text_rows(spark, path).where(F.trim("line") != "")
    row = F.from_json("line", f"{schema}, __bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"})
    good = F.trim("line").startswith("{") & row["__bad"].isNull()
    where = F.concat(F.lit("expected an object at "), "doc_path", F.lit(":"), F.col("line_no").cast("string"))
    kind = spark.createDataFrame([], schema).schema.simpleString()
    x = x.select("doc_path", "line_no", F.when(good, row.dropFields("__bad")).otherwise(F.raise_error(where).cast(kind)).alias("row"))
    return x.select("doc_path", "line_no", "row.*")


def url_list(spark: SparkSession, path: str) -> DataFrame:
    """Rows (url): the lines of a list, trimmed, without blanks and comments (`#`)."""
    return spark.read.text(path).select(F.trim("value").alias("url")).where("url <> '' and not startswith(url, '#')")


def model_registry(spark: SparkSession, path: str) -> DataFrame:
    """Rows (id, audio_dir, filename) of a list of models or an object with `models`; an id of other signs than letters,
    digits, `.`, `_`, `-`, a repeated id and a missing folder are errors when read; `filename` is {audio_id}.wav if absent."""
    x = json_rows(spark, path, "struct<id:string,audio_dir:string,filename:string>", ["models"], required=True)
    x = x.select(F.coalesce(F.trim("id"), F.lit("")).alias("id"), F.coalesce(F.trim("audio_dir"), F.lit("")).alias("audio_dir"), F.coalesce(none_if_empty(F.trim("filename")), F.lit("{audio_id}.wav")).alias("filename"))
    x = x.groupBy("id").agg(F.count("*").alias("n"), F.min(F.struct("audio_dir", "filename")).alias("m"))
    wrong = (
        F.when(~F.col("id").rlike(r"^[A-Za-z0-9][A-Za-z0-9._-]*$"), F.concat(F.lit("invalid model id: "), "id"))
        .when(F.col("n") > 1, F.concat(F.lit("repeated model id: "), "id")).when(F.col("m.audio_dir") == "", F.concat(F.lit("model without audio_dir: "), "id"))
    )
    return x.select(F.when(wrong.isNotNull(), F.raise_error(wrong).cast("string")).otherwise(F.col("id")).alias("id"), "m.audio_dir", "m.filename")


#: The columns of the export ledger.
LEDGER = ["webpage_url", "uploader", "audio_filename", "title", "timeline"]


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """Rows of an export ledger (columns LEDGER), nulls as the empty string; a ledger without files has no rows."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    schema = T.StructType([T.StructField(c, T.StringType()) for c in LEDGER])
    if not fs.exists(at):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path).fillna("")


def meta_index(spark: SparkSession, path: str, fields: str) -> DataFrame:
    """Rows (id, <fields>) of metadata documents in three shapes: an object by id, one object with its `id`, a list of
    objects with `id`. Of repeated ids within a document the last counts; `fields` is a schema that has no `id`."""
    row = f"struct<id:string,{spark.createDataFrame([], fields).schema.simpleString()[7:-1]}>"
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("doc_path"), F.trim("value").alias("v"))
    listed = F.from_json("v", f"array<{row}>")
    one = F.from_json("v", row)
    by_id = F.transform(F.map_entries(F.from_json("v", f"map<string,{row}>")), lambda e: e["value"].withField("id", e["key"]))
    rows = F.when(F.col("v").startswith("["), listed).when(F.get_json_object("v", "$.id").isNotNull(), F.array(one)).otherwise(by_id)
    x = text.select("doc_path", F.posexplode(rows).alias("pos", "row")).where("row.id is not null")
    y = x.groupBy("doc_path", F.col("row.id").alias("id")).agg(F.max_by("row", "pos").alias("row"))
    return y.select("id", F.col("row").dropFields("id").alias("row")).select("id", "row.*")


def subset_ids(spark: SparkSession, path: str) -> DataFrame:
    """Rows (question_id): the ids of a subset document, a list or an object with `questions` or `question_ids`, whose
    elements are ids or objects with `question_id`; empty ones don't count."""
    text = spark.read.text(path, wholetext=True).select(F.trim("value").alias("v"))
    inner = F.when(F.col("v").startswith("["), F.col("v")).otherwise(F.coalesce(F.get_json_object("v", "$.questions"), F.get_json_object("v", "$.question_ids")))
    x = text.select(F.explode(F.from_json(inner, "array<string>")).alias("x"))
    own = F.when(F.col("x").startswith("{"), F.get_json_object("x", "$.question_id")).otherwise(F.col("x"))
    return x.select(own.alias("question_id")).where("question_id <> ''").distinct()


def marked_prompt(text: str, system: str = "### SYSTEM", user: str = "### USER") -> tuple[str, str]:
    """(system, user) parts of a prompt file; comment lines (`#`, not `###`) go; a missing user mark is an error."""
    kept = "\n".join(x for x in text.splitlines() if not x.lstrip().startswith("#") or x.lstrip().startswith("###"))
    head, mark, tail = kept.partition(user)
    if not mark:
        raise ValueError(f"prompt without {user}")
    return head.strip().removeprefix(system).strip(), tail.strip()


def last_alias(df: DataFrame, alias: str, group: str, place: str) -> DataFrame:
    """Rows (alias, group) where a repeated alias counts with its last group (by `place`); blank ones don't count."""
    x = df.select(F.lower(F.trim(F.col(alias))).alias("alias"), F.trim(F.col(group)).alias("group"), F.col(place).alias("__at")).where("alias <> '' and group <> ''")
    return x.groupBy("alias").agg(F.max_by("group", "__at").alias("group"))


#: Suffixes of audio files, and files beside them that are none.
AUDIO = ["wav", "m4a", "mp3", "webm", "aac", "flac", "opus"]


def best_files(files: DataFrame) -> DataFrame:
    """Rows (base, name, candidates): of the files (name, bytes) of one base name (up to the first point) the best: an audio
    suffix before another before none, then the largest, then the shortest name, then the last by name. Parts of downloads
    (`.part`) don't count. A reduction with a map-side combine."""
    x = files.where(~F.col("name").endswith(".part")).withColumn("base", F.regexp_extract("name", r"^([^.]*)", 1)).where("base <> ''")
    suffix = F.lower(F.regexp_extract("name", r".\.([^.]*)$", 1))
    rank = F.when(suffix.isin(AUDIO), 2).when(suffix != "", 1).otherwise(0)
    best = x.groupBy("base").agg(F.max(F.struct(rank.alias("r"), F.col("bytes"), (-F.length("name")).alias("l"), "name")).alias("x"), F.count("*").alias("candidates"))
    return best.select("base", "x.name", "candidates")


def judge_runs(spark: SparkSession, path: str, fields: str = "task:string,gold_label:string,pred_logprob:string,pred_label:string,pred:string") -> DataFrame:
    """Rows (run, question_id, <fields>) of the result documents of runs (a list, or an object with `results`), the run being
    the file's name; results without an id don't count, of repeated ids the last does."""
    x = json_rows(spark, path, f"struct<question_id:string,{fields}>", ["results"], required=True).where("question_id <> ''")
    names = [f.split(":")[0] for f in fields.split(",")]
    y = x.groupBy(F.regexp_extract("doc_path", r"([^/]*?)(?:\.[^./]*)?$", 1).alias("run"), "question_id").agg(F.max_by(F.struct(*names), "pos").alias("x"))
    return y.select("run", "question_id", "x.*")
