"""Queries that write tables in the formats of the sinks and read them back with the scans."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import records as R
from ..functions import text as X
from ..operators import audio, matching, release, runlog
from ..sources import readers, writers
from ..sources.tables import cut, shared_folder, table
from ..streaming import incremental
from .reference import _NEEDLES, _SQ

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _place(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/io-{uuid.uuid4().hex}"


@query("SELECT CASE WHEN event_uid % 3 = 0 THEN 'data' WHEN event_uid % 3 = 1 THEN 'events' ELSE 'list' END AS shape, id, event_uid, start_sec, verb FROM train_events")
def scan_wrappers(spark: SparkSession, d: str) -> DataFrame:
    """Events from JSON documents that hold their rows as a list or under a key."""
    at, e = _place(spark), table(spark, d, "train_events").select("id", "event_uid", "start_sec", "verb")
    part = lambda k: e.where(F.col("event_uid") % 3 == k)
    writers.write_document(part(0), f"{at}/data.json", "data", source="a")
    writers.write_document(part(1), f"{at}/events.json", "events")
    rows = [r[0] for r in part(2).select(F.to_json(F.struct("*"))).toLocalIterator()]
    writers.write_text(spark, f"{at}/list.json", ["[", ", ".join(rows), ", null]" if rows else "]"])
    x = readers.json_rows(spark, f"{at}/*.json", "struct<id:string,event_uid:bigint,start_sec:double,verb:string>", required=True)
    return x.select(F.regexp_extract("doc_path", r"([a-z]+)\.json$", 1).alias("shape"), "id", "event_uid", "start_sec", "verb")


@query(r"SELECT wav AS audio_id, max(trim(caption)) AS caption FROM train_label WHERE wav <> '' AND trim(caption) <> '' GROUP BY wav")
def manifest_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """A manifest of captions as JSON lines, read back with unique ids."""
    at = _place(spark)
    t = table(spark, d, "train_label").where("wav <> '' and trim(caption) <> ''").groupBy(F.col("wav").alias("audio_id")).agg(F.max(F.trim("caption")).alias("caption"))
    t.write.json(at)
    return readers.unique_values(readers.json_lines(spark, at, "audio_id string, caption string"), "audio_id", "caption")


@query("SELECT item_id, wav, CAST(row_number() OVER (ORDER BY gt_row_id) AS INT) AS line_no FROM manual_gt_example")
def numbered_lines(spark: SparkSession, d: str) -> DataFrame:
    """Rows of a JSON-lines file with their line numbers."""
    at = _place(spark)
    g = table(spark, d, "manual_gt_example").select("gt_row_id", "item_id", "wav").orderBy("gt_row_id")
    writers.write_text(spark, f"{at}/a.jsonl", (r[0] + "\n" for r in g.select(F.to_json(F.struct("item_id", "wav"))).toLocalIterator()))
    return readers.numbered_json_lines(spark, f"{at}/a.jsonl", "item_id string, wav string").select("item_id", "wav", "line_no")


@query(r"""
WITH l AS (SELECT DISTINCT regexp_replace(regexp_extract(wav, '([^/]*)$', 1), '(.)\.[^.]*$', '\1') AS audio_id FROM train_label WHERE wav <> ''), m AS (SELECT unnest(['base', 'large.v2', 'tiny_1']) AS model, unnest([97, 7, 3]) AS lost),
f AS (SELECT audio_id, model, ('0x' || substr(md5(audio_id), 1, 6))::BIGINT % lost <> 0 AS there FROM l, m)
SELECT model, count(*) AS labels, count(*) FILTER (NOT there) AS missing, (SELECT count(*) FROM (SELECT audio_id FROM f GROUP BY audio_id HAVING bool_and(there))) AS usable FROM f GROUP BY model""")
def model_alignment(spark: SparkSession, d: str) -> DataFrame:
    """Files that models of a registry lack for the labels, and the labels that all models have."""
    at = _place(spark)
    models = [{"id": "base", "audio_dir": "/m/base"}, {"id": "large.v2", "audio_dir": "/m/large/", "filename": "gen_{audio_id}.wav"}, {"id": "tiny_1", "audio_dir": "/m/tiny"}]
    writers.write_text(spark, f"{at}/models.json", [json.dumps({"models": models})])
    reg = cut(readers.model_registry(spark, f"{at}/models.json"))
    labels = cut(table(spark, d, "train_label").where("wav <> ''").select(R.manifest_id(F.lit(None).cast("string"), F.col("wav")).alias("audio_id")).distinct())
    h = F.conv(F.substring(F.md5("audio_id"), 1, 6), 16, 10).cast("bigint")
    made = F.array(*[F.when(h % lost != 0, F.format_string(p, F.col("audio_id"))) for p, lost in (("/m/base/%s.wav", 97), ("/m/large/gen_%s.wav", 7), ("/m/tiny/%s.wav", 3))])
    files = labels.select(F.explode(F.array_compact(made)).alias("path"))
    x = cut(matching.model_files(labels, reg, files))
    n = matching.usable(x).count()
    return x.groupBy("model").agg(F.count("*").alias("labels"), F.count_if(~F.col("there")).alias("missing")).withColumn("usable", F.lit(n).cast("long"))


@query(r"""
SELECT coalesce(nullif(trim(video_id), ''), 'folder') AS video_id, start_sec AS start, end_sec AS "end", time_str AS time, seconds FROM timeline WHERE start_sec IS NOT NULL AND end_sec IS NOT NULL""")
def timeline_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Timelines as CSV with a header, read back; a blank video is the folder's name."""
    at = f"{_place(spark)}/folder"
    t = table(spark, d, "timeline").select("video_id", F.col("time_str").alias(" time "), F.col("start_sec").alias("start"), F.col("end_sec").alias("end"), "seconds")
    writers.write_table(t, at)
    x = readers.timeline_csv(spark, at)
    return x.select("video_id", "start", "end", X.none_if_empty(F.col("time")).alias("time"), F.col("seconds").cast("bigint").alias("seconds"))


_CELL = r"string_agg(trim(regexp_replace(concat_ws(' ', time_str, CASE WHEN regexp_replace(trim(title), '\s+', ' ', 'g') <> '' THEN regexp_replace(trim(title), '\s+', ' ', 'g') END), '\s+', ' ', 'g')), ' | ' ORDER BY pos, line_id)"


@query(rf"""
WITH v AS (SELECT video_id, {_CELL} AS timeline FROM timeline WHERE video_id IS NOT NULL AND time_str IS NOT NULL AND pos < 20 GROUP BY video_id)
SELECT 'https://www.youtube.com/watch?v=' || video_id AS webpage_url, 'audio/' || video_id || '/' || video_id || '.wav' AS audio_filename, timeline, video_id FROM v WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.video_id = v.video_id)""")
def ledger_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """A ledger of videos with the first twenty lines of their timeline in one cell, appended in two parts, read back,
    and purged of the videos that documents name."""
    at = _place(spark)
    plain = X.squeezed(F.regexp_replace(F.coalesce("title", F.lit("")), r"(?U)\s+", " "))
    t = table(spark, d, "timeline").where("video_id is not null and time_str is not null and pos < 20").select("video_id", "pos", "line_id", "time_str", plain.alias("title"))
    v = t.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("pos", "line_id", "time_str", "title"))).alias("x"))
    url = F.concat(F.lit("https://www.youtube.com/watch?v="), "video_id")
    rows = v.select(url.alias("webpage_url"), F.lit("").alias("uploader"), F.concat(F.lit("audio/"), "video_id", F.lit("/"), "video_id", F.lit(".wav")).alias("audio_filename"), F.lit("").alias("title"), writers.timeline_line(F.col("x.time_str"), F.col("x.title")).alias("timeline"))
    odd = F.pmod(F.xxhash64("webpage_url"), F.lit(2)) == 1
    for part in (rows.where(odd), rows.where(~odd)):
        writers.append_ledger(part, at)
    back = readers.ledger(spark, at).withColumn("video_id", R.video_of_ledger(F.when(odd, F.col("webpage_url")), F.col("audio_filename")))
    kept = writers.purge(back, table(spark, d, "documents").select("video_id"), ["video_id"])
    return kept.select("webpage_url", "audio_filename", F.regexp_replace("timeline", r"\s+", " ").alias("timeline"), "video_id")


@query(r"""
WITH a AS (SELECT id, max(title) AS title, count(*) AS events FROM train_events WHERE id IS NOT NULL GROUP BY id)
SELECT id, CASE WHEN md5(id) < '4' THEN 'new' ELSE title END AS title, events FROM a""")
def meta_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Metadata in its three shapes, read, and updated by id."""
    at = _place(spark)
    a = cut(table(spark, d, "train_events").where("id is not null").groupBy("id").agg(F.max("title").alias("title"), F.count("*").alias("events")).withColumn("h", F.md5("id")))
    strings = lambda c: [r[0] for r in a.where(c).select(F.to_json(F.struct("id", "title", "events"))).toLocalIterator()]
    one, listed = strings(F.col("h") < "02"), strings((F.col("h") >= "02") & (F.col("h") < "8"))
    for k, s in enumerate(one):
        writers.write_text(spark, f"{at}/one-{k}.json", [s])
    writers.write_text(spark, f"{at}/list.json", ["[", ",".join(listed), "]"])
    by_id = a.where("h >= '8'").select("id", F.to_json(F.struct("title", "events")).alias("v"))
    writers.write_text(spark, f"{at}/map.json", ["{", ",".join(f"{json.dumps(r['id'])}: {r['v']}" for r in by_id.toLocalIterator()), "}"])
    old = readers.meta_index(spark, f"{at}/*.json", "title string, events bigint")
    new = a.where("h < '4'").select("id", F.lit("new").alias("title"), "events")
    return writers.upsert(old, new, ["id"], "events").select("id", "title", "events")


@query(r"SELECT trim(verb) AS verb, count(*) AS n FROM segment_label_parse WHERE trim(verb) <> '' GROUP BY 1")
def frequency_file(spark: SparkSession, d: str) -> DataFrame:
    """Frequencies as tab-separated text, read back."""
    at = _place(spark)
    writers.write_frequencies(table(spark, d, "segment_label_parse").select("verb"), "verb", at)
    return spark.read.schema("verb string, n long").option("sep", "\t").csv(at)


@query(r"""
WITH RECURSIVE o AS (SELECT doc_id, coalesce(n_chars, 0) AS size, row_number() OVER (ORDER BY doc_id) AS k FROM documents),
f AS (SELECT k, size AS filled, 0 AS shard FROM o WHERE k = 1 UNION ALL SELECT o.k, CASE WHEN f.filled + o.size > 60000 THEN o.size ELSE f.filled + o.size END, CASE WHEN f.filled + o.size > 60000 THEN f.shard + 1 ELSE f.shard END FROM f JOIN o ON o.k = f.k + 1)
SELECT printf('train-%05d-of-%05d.parquet', shard, (SELECT max(shard) + 1 FROM f)) AS name, count(*) AS rows, shard % 2 = 0 AS written FROM f GROUP BY shard""")
def release_shards(spark: SparkSession, d: str) -> DataFrame:
    """A release in shards by name; a second run after every second file is gone writes those anew and keeps the others."""
    at = _place(spark)
    docs = table(spark, d, "documents").select("doc_id", "source", F.coalesce("n_chars", F.lit(0)).alias("size"))
    first = writers.write_shards(docs, at, "train", ["doc_id"], "size", 60_000).collect()
    folder, fs = writers._fs(spark, at)
    path = spark._jvm.org.apache.hadoop.fs.Path
    for k, r in enumerate(first):
        if k % 2 == 0:
            fs.delete(path(folder, r["name"]), False)
    return writers.write_shards(docs, at, "train", ["doc_id"], "size", 60_000)


@query(rf"""
WITH s AS (SELECT coalesce(clean_error, '') AS d, CASE WHEN clean_detected THEN 'success' ELSE 'failed' END AS status FROM segment_label_parse), l AS (SELECT status, lower(regexp_replace(d, '\s+', ' ', 'g')) AS t FROM s)
SELECT 'status' AS kind, status AS name, count(*) AS n FROM l GROUP BY status UNION ALL SELECT 'reason', CASE {_NEEDLES} ELSE 'unknown' END, count(*) FROM l WHERE status = 'failed' GROUP BY 2
UNION ALL SELECT 'failures', 'kept', least(50, count(*)) FROM l WHERE status = 'failed' UNION ALL SELECT 'failures', 'dropped', greatest(0, count(*) - 50) FROM l WHERE status = 'failed'""")
def run_summary(spark: SparkSession, d: str) -> DataFrame:
    """The summary document of a run, written, read back and laid out: counts, reasons, kept and dropped details."""
    at = _place(spark)
    t = table(spark, d, "segment_label_parse").select("seg_id", F.when(F.col("clean_detected"), "success").otherwise("failed").alias("status"), F.lit(None).cast("string").alias("reason"), F.coalesce("clean_error", F.lit("")).alias("detail"))
    writers.write_text(spark, f"{at}/summary.json", [json.dumps(runlog.payload(t, "cut", "status", "seg_id", "reason", "detail", most=50))])
    x = spark.read.schema("counts map<string,long>, failure_reasons map<string,long>, failures array<struct<item_id:string>>, dropped_failure_details long").option("multiLine", True).json(f"{at}/summary.json")
    one = lambda kind, col: x.select(F.lit(kind).alias("kind"), F.explode(col).alias("name", "n"))
    kept = x.select(F.lit("failures").alias("kind"), F.explode(F.create_map(F.lit("kept"), F.size("failures").cast("long"), F.lit("dropped"), F.col("dropped_failure_details"))).alias("name", "n"))
    return one("status", "counts").unionByName(one("reason", "failure_reasons")).unionByName(kept)


@query(r"""
WITH f AS (SELECT DISTINCT regexp_extract(wav, '([^/]*)$', 1) AS name, wav FROM train_label WHERE wav IS NOT NULL),
g AS (SELECT regexp_replace(name, '_.*', '') || CASE WHEN md5(wav) < '2' THEN '' WHEN md5(wav) < '6' THEN '.txt' WHEN md5(wav) < '7' THEN '.wav.part' ELSE '.wav' END AS name, length(wav) AS bytes FROM f),
h AS (SELECT regexp_extract(name, '^([^.]*)', 1) AS base, name, bytes, CASE WHEN name LIKE '%.wav' THEN 2 WHEN name LIKE '%.txt' THEN 1 ELSE 0 END AS r FROM g WHERE name NOT LIKE '%.part')
SELECT base, arg_max(name, [r, bytes, -length(name)]) AS name, count(*) AS candidates FROM h WHERE base <> '' GROUP BY base""")
def best_audio(spark: SparkSession, d: str) -> DataFrame:
    """The best file of each base name."""
    f = table(spark, d, "train_label").where("wav is not null").select("wav").distinct()
    h = F.md5("wav")
    ending = F.when(h < "2", "").when(h < "6", ".txt").when(h < "7", ".wav.part").otherwise(".wav")
    return readers.best_files(f.select(F.concat(F.regexp_replace(F.regexp_extract("wav", r"([^/]*)$", 1), "_.*", ""), ending).alias("name"), F.length("wav").alias("bytes")))


@query(rf"""
SELECT question_id FROM (SELECT CAST(label_id AS VARCHAR) AS question_id FROM train_label WHERE label_id % 3 = 0 UNION SELECT item_id FROM manual_gt_example WHERE item_id <> '' UNION SELECT {_SQ.format("suite")} FROM eval_item) WHERE question_id <> ''""")
def subset_files(spark: SparkSession, d: str) -> DataFrame:
    """Ids of subset documents in their three shapes."""
    at = _place(spark)
    lists = {
        "a": table(spark, d, "train_label").where("label_id % 3 = 0").select(F.col("label_id").cast("string").alias("q")), "b": table(spark, d, "manual_gt_example").where("item_id is not null").select(F.col("item_id").alias("q")).distinct(),
        "c": table(spark, d, "eval_item").select(X.audit_text(F.col("suite")).alias("q")).distinct(),
    }
    for k, df in lists.items():
        ids = [r["q"] for r in df.toLocalIterator()]
        writers.write_text(spark, f"{at}/{k}.json", [json.dumps({"a": ids, "b": {"questions": [{"question_id": q} for q in [*ids, ""]]}, "c": {"question_ids": ids}}[k])])
    return readers.subset_ids(spark, f"{at}/*.json")


@query("""
SELECT vec_id, len(embedding) / 8000.0 AS seconds, true AS loudness FROM embeddings""")
def audio_facts(spark: SparkSession, d: str) -> DataFrame:
    """Vectors as sound: written as 16-bit PCM, read back, duration and whether the loudness is that of the vector, also after
    it was matched to a reference of half the loudness."""
    import numpy as np
    import pandas as pd

    def sound(parts):
        for pdf in parts:
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "rms": [float(np.sqrt((np.clip(np.asarray(v, float), -1, 1) ** 2).mean())) for v in pdf["embedding"]], "content": [audio.encode(np.asarray(v, float)[:, None], 8000) for v in pdf["embedding"]]})

    e = table(spark, d, "embeddings").select("vec_id", "embedding")
    x = e.mapInPandas(sound, f"vec_id {dict(e.dtypes)['vec_id']}, rms double, content binary").withColumn("f", audio.audio_facts("content"))
    x = x.withColumn("g", audio.gain(F.col("f.rms"), F.col("rms") / 2, F.col("f.peak"))).withColumn("h", audio.audio_facts(audio.amplified("content", "g")))
    near = lambda a, b: F.abs(a - b) < 2e-4
    return x.select("vec_id", F.col("f.seconds").alias("seconds"), (near(F.col("f.rms"), F.col("rms")) & near(F.col("h.rms"), F.col("rms") / 2)).alias("loudness"))


@query("SELECT verb_class, class_hint AS rule FROM asmr_verb_classes_en WHERE class_hint <> ''")
def disambiguation_rules(spark: SparkSession, d: str) -> DataFrame:
    """Rules of the classes from a text of headed blocks."""
    at = _place(spark)
    rows = table(spark, d, "asmr_verb_classes_en").select("verb_class", "class_hint").collect()  # one row a class
    writers.write_text(spark, f"{at}/rules.txt", ["Rules\n"] + [f"{r['verb_class']} — block\nnot a rule\n- {r['class_hint']}\n" for r in rows if r["class_hint"]])
    return readers.disambiguation(spark, f"{at}/rules.txt").select("verb_class", F.explode("rules").alias("rule")).withColumn("rule", F.regexp_replace("rule", "^- ", ""))


@query("""
WITH p AS (SELECT wav, annotation.annotator_id AS run_id, upper(trim(coalesce(nullif(gt.verb, ''), nullif(gt.object, '')))) AS pred, gt_row_id FROM manual_gt_example WHERE wav IS NOT NULL)
SELECT run_id, wav AS question_id, arg_max(pred, gt_row_id) AS pred FROM p WHERE pred <> '' GROUP BY ALL""")
def prediction_files(spark: SparkSession, d: str) -> DataFrame:
    """Predictions of runs from their documents; the preferred field that is filled counts, of repeated questions the last."""
    at = _place(spark)
    g = table(spark, d, "manual_gt_example").where("wav is not null").select(F.col("annotation.annotator_id").alias("run_id"), F.col("wav").alias("question_id"), F.lit(" ").alias("pred_logprob"), F.col("gt.verb").alias("pred_label"), F.col("gt.object").alias("pred"), "gt_row_id")
    writers.write_document(g, f"{at}/run.json", "results", judge="x")
    rows = readers.json_rows(spark, f"{at}/run.json", "struct<run_id:string,question_id:string,pred_logprob:string,pred_label:string,pred:string,gt_row_id:bigint>", ["results"])
    return readers.predictions(rows, "run_id", "question_id", "gt_row_id")


@query("SELECT author, count(*) AS n FROM train_label WHERE author IS NOT NULL GROUP BY author")
def cache_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Counts by author kept in a table of buckets, updated by three batches."""
    t = table(spark, d, "train_label").where("author is not null").select("author", F.pmod(F.col("label_id"), F.lit(3)).alias("k"))
    at = incremental.Table(spark, _place(spark), buckets=16)
    for k in range(3):
        part = t.where(F.col("k") <= k).groupBy("author").agg(F.count("*").alias("n")).withColumn("v", F.lit(k))
        at.merge(part, k, ["author"], "v")
    return at.read().select("author", "n")


@query(r"""
WITH s AS (SELECT video_id, seg_id, clean_start, clean_end, clean_segment_index FROM segment_label_parse WHERE video_id IS NOT NULL)
SELECT video_id, seg_id, row_number() OVER (PARTITION BY video_id ORDER BY clean_segment_index NULLS FIRST, seg_id) - 1 AS segment_index, count(*) OVER (PARTITION BY video_id) AS segment_count FROM s""")
def segment_documents(spark: SparkSession, d: str) -> DataFrame:
    """Windows as the rows of segment documents, numbered within their video, without private fields; read back."""
    at = _place(spark)
    s = table(spark, d, "segment_label_parse").where("video_id is not null")
    writers.segment_rows(s, "video_id", ["clean_segment_index", "seg_id"], ["clean_error", "ingested_at"]).write.json(at)
    return readers.json_lines(spark, at, "video_id string, seg_id bigint, segment_index bigint, segment_count bigint")


@query(r"""
WITH a AS (SELECT DISTINCT regexp_replace(author, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') AS author FROM train_label WHERE author IS NOT NULL), n AS (SELECT author, row_number() OVER (ORDER BY author) AS k FROM a WHERE author <> '')
SELECT 'creator_' || CASE WHEN k < 10 THEN '0' ELSE '' END || k AS creator_id, author FROM n""")
def creator_map(spark: SparkSession, d: str) -> DataFrame:
    """The private map of pseudonyms, written apart and read back."""
    at = _place(spark)
    writers.write_creator_map(release.creator_ids(table(spark, d, "train_label"), "author"), f"{at}/map.json")
    return readers.json_rows(spark, f"{at}/map.json", "struct<creator_id:string,author:string>", ["creators"], required=True).select("creator_id", "author")


@query(r"""
SELECT annotation.annotator_id AS run, item_id AS question_id, arg_max(gt.verb, gt_row_id) AS pred FROM manual_gt_example WHERE item_id <> '' AND annotation.annotator_id IN ('annotator_a', 'annotator_b') GROUP BY ALL""")
def judge_documents(spark: SparkSession, d: str) -> DataFrame:
    """Results of two runs as documents in order of their ids, read back; of repeated ids the last counts."""
    at = _place(spark)
    for who in ("annotator_a", "annotator_b"):
        g = table(spark, d, "manual_gt_example").where(F.col("annotation.annotator_id") == who).select(F.col("item_id").alias("question_id"), F.col("gt.verb").alias("pred"), "gt_row_id").withColumn("key", F.struct("question_id", "gt_row_id"))
        writers.write_document(g.orderBy("key").drop("key"), f"{at}/{who}.json", "results", judge=who)
    return readers.judge_runs(spark, f"{at}/*.json", "pred:string").select("run", "question_id", "pred")
