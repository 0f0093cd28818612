"""Further queries: manifests, leaks of materials, windows, paths, prompts, upserts and sessions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import times as T
from ..operators import matching, timelines
from ..operators.prefix import neighbour, numbered, same
from ..sources.tables import cut, shared_folder, table
from ..sources.writers import timeline_cells
from ..streaming import incremental
from .reference import _DONE, r6

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


#: Material aliases of the query below; any alias table will do.
MATERIAL_WORDS = {"wooden": "wood", "wood": "wood", "paper": "paper", "glass": "glass", "steel": "metal", "metal": "metal", "tin": "metal", "leather": "leather", "rubber": "rubber", "silk": "textile", "velvet": "textile", "felt": "textile", "wool": "textile", "clay": "clay", "sand paper": "paper", "salad bowl": "wood"}


@query(r"""
WITH a(w, m) AS (VALUES ('wooden', 'wood'), ('wood', 'wood'), ('paper', 'paper'), ('glass', 'glass'), ('steel', 'metal'), ('metal', 'metal'), ('tin', 'metal'), ('leather', 'leather'), ('rubber', 'rubber'), ('silk', 'textile'), ('velvet', 'textile'), ('felt', 'textile'), ('wool', 'textile'), ('clay', 'clay'), ('sand paper', 'paper'), ('salad bowl', 'wood')),
x(w, m) AS (VALUES ('ice', 'glass'), ('styrofoam', 'foam_solid'), ('silicone', 'rubber'), ('chalk', 'ceramic'), ('marble', 'stone'), ('granite', 'stone'), ('beeswax', 'wax'), ('cardboard', 'paper')),
c AS (SELECT DISTINCT trim(regexp_replace(lower(v), '\s+', ' ', 'g')) AS core FROM (SELECT alias AS v FROM noun_alias_v1 UNION ALL SELECT object FROM train_label) WHERE trim(v) <> ''),
t AS (SELECT core, unnest(str_split(core, ' ')) AS w, unnest(range(len(str_split(core, ' ')))) AS k FROM c),
f AS (SELECT core, 2 * k AS p, w AS form FROM t UNION ALL
  SELECT core, 2 * k + 1, CASE WHEN regexp_matches(w, '.ies$') THEN regexp_replace(w, 'ies$', 'y') WHEN regexp_matches(w, '.es$') THEN regexp_replace(w, 'es$', '') WHEN regexp_matches(w, '[^s]s$') THEN regexp_replace(w, 's$', '') ELSE w END FROM t),
h AS (
  SELECT core, 0 AS p, 'contains_word_material' AS reason, NULL AS material FROM t WHERE w = 'material' UNION ALL
  SELECT core, 1, 'exact_alias:' || core, m FROM c JOIN a ON w = core UNION ALL SELECT core, 2, 'extra_core:' || core, m FROM c JOIN x ON w = core UNION ALL
  SELECT core, 3 + 1 / length(w), 'subphrase_alias:' || w, m FROM c JOIN a ON contains(w, ' ') AND contains(core, w) UNION ALL
  SELECT core, 10 + p, 'token_alias:' || form, m FROM f JOIN a ON w = form UNION ALL SELECT core, 10.5 + p, 'extra_token:' || form, m FROM f JOIN x ON w = form),
b AS (SELECT core, reason, material FROM h QUALIFY row_number() OVER (PARTITION BY core ORDER BY p) = 1)
SELECT core, CASE WHEN core NOT IN ('sponge', 'wooden surface') THEN reason END AS reason, CASE WHEN core NOT IN ('sponge', 'wooden surface') THEN material END AS material,
  CASE WHEN reason IS NULL OR core IN ('sponge', 'wooden surface') THEN core END AS kept FROM c LEFT JOIN b USING (core)""")
def core_leak(spark: SparkSession, d: str) -> DataFrame:
    """What tells the material of a noun, for every alias and every typed object, and the noun itself where nothing does."""
    nouns = table(spark, d, "noun_alias_v1").select(F.col("alias").alias("v")).unionByName(table(spark, d, "train_label").select(F.col("object").alias("v")))
    cores = nouns.select(X.phrase(F.col("v")).alias("core")).where("core is not null").distinct()
    x = cores.select("core", X.leaked_material(F.col("core"), MATERIAL_WORDS).alias("hit"))
    return x.select("core", "hit.reason", "hit.material", F.when(F.col("hit").isNull(), F.col("core")).alias("kept"))


@query(r"""
WITH r AS (SELECT DISTINCT wav AS id FROM train_label WHERE wav IS NOT NULL), c AS (SELECT DISTINCT wav AS id FROM train_label WHERE wav IS NOT NULL AND trim(caption) <> ''), g AS (SELECT DISTINCT wav AS id FROM manual_gt_example WHERE wav IS NOT NULL),
u AS (SELECT id, count(*) AS n FROM (SELECT id FROM r UNION ALL SELECT id FROM c UNION ALL SELECT id FROM g) GROUP BY id)
SELECT n AS manifests, count(*) AS ids, min(id) AS first FROM u GROUP BY n""")
def manifest_align(spark: SparkSession, d: str) -> DataFrame:
    """Ids that one, two or all three manifests have; those in all three are aligned."""
    t = table(spark, d, "train_label")
    x = matching.presence({"reference": t.select("wav"), "captions": t.where("trim(caption) <> ''").select("wav"), "generated": table(spark, d, "manual_gt_example").select("wav")})
    return x.groupBy(F.col("n").cast("bigint").alias("manifests")).agg(F.count("*").alias("ids"), F.min("id").alias("first"))


@query("SELECT video_id, count(*) AS windows, count(*) FILTER (clean_end > clean_start) AS clean, bool_or(coalesce(clean_end > clean_start, false) = false) AS needs_cut FROM segment_label_parse GROUP BY video_id")
def clean_state(spark: SparkSession, d: str) -> DataFrame:
    """Videos whose windows are not all valid need a cut."""
    ok = T.clean_window(F.col("clean_start"), F.col("clean_end")).isNotNull()
    return table(spark, d, "segment_label_parse").groupBy("video_id").agg(F.count("*").alias("windows"), F.count_if(ok).alias("clean"), F.bool_or(~ok).alias("needs_cut"))


@query(r"""
WITH p AS (SELECT label_id, regexp_extract(wav, '([^/]+)/[^/]+$', 1) AS folder FROM train_label WHERE wav IS NOT NULL)
SELECT label_id, regexp_extract(folder, '^(.*)_([^_]*)_([^_]*)$', 1) AS video_id, TRY_CAST(replace(regexp_extract(folder, '^(.*)_([^_]*)_([^_]*)$', 2), 'p', '.') AS DOUBLE) AS start, TRY_CAST(replace(regexp_extract(folder, '^(.*)_([^_]*)_([^_]*)$', 3), 'p', '.') AS DOUBLE) AS "end" FROM p""")
def path_keys(spark: SparkSession, d: str) -> DataFrame:
    """Video and window of the folder of a clip; ids may hold `_`, numbers a `p` for the point."""
    pattern = r"^(.*)_([^_]*)_([^_]*)$"
    folder = F.regexp_extract("wav", r"([^/]+)/[^/]+$", 1)
    number = lambda k: F.translate(F.regexp_extract(folder, pattern, k), "p", ".").try_cast("double")
    return table(spark, d, "train_label").where("wav is not null").select("label_id", F.regexp_extract(folder, pattern, 1).alias("video_id"), number(2).alias("start"), number(3).alias("end"))


@query("SELECT wav, label_id, exported_at FROM train_label WHERE wav IS NOT NULL QUALIFY row_number() OVER (PARTITION BY wav ORDER BY exported_at DESC, label_id DESC) = 1")
def latest_exports(spark: SparkSession, d: str) -> DataFrame:
    """The last export of every clip, by a reduction with a map-side combine rather than a window."""
    t = table(spark, d, "train_label").where("wav is not null")
    return t.groupBy("wav").agg(F.max(F.struct("exported_at", "label_id")).alias("x")).select("wav", "x.label_id", "x.exported_at")


@query("SELECT wav, count(*) AS n, array_to_string(list_sort(list(label_id)), ',') AS ids FROM train_label WHERE wav IS NOT NULL GROUP BY wav HAVING count(*) > 1")
def duplicate_ids(spark: SparkSession, d: str) -> DataFrame:
    """Clips exported more than once, with their rows."""
    x = table(spark, d, "train_label").where("wav is not null").groupBy("wav").agg(F.count("*").alias("n"), F.sort_array(F.collect_list("label_id")).alias("ids")).where("n > 1")
    return x.select("wav", "n", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


@query(r"""
SELECT t.line_id, coalesce(s.clean_start, t.start_sec) AS a, coalesce(s.clean_end, t.end_sec) AS b FROM timeline t LEFT JOIN (SELECT * FROM segment_label_parse WHERE clean_end > clean_start) s
  ON t.video_id = s.video_id AND abs(t.start_sec - s.start_sec) <= 0.51 AND abs(t.end_sec - s.end_sec) <= 0.51 WHERE t.start_sec IS NOT NULL AND t.end_sec IS NOT NULL""")
def capture_windows(spark: SparkSession, d: str) -> DataFrame:
    """The clean windows that match a line, else its own bounds."""
    t = table(spark, d, "timeline").where("start_sec is not null and end_sec is not null").select("line_id", "video_id", F.col("start_sec").alias("start"), F.col("end_sec").alias("end"))
    s = table(spark, d, "segment_label_parse").where("clean_end > clean_start").select("video_id", F.col("start_sec").alias("start"), F.col("end_sec").alias("end"), "clean_start", "clean_end")
    m = matching.match_intervals(t, s, ["video_id"]).select("line_id", F.col("r_clean_start").alias("a"), F.col("r_clean_end").alias("b"))
    return t.join(m, "line_id", "left").select("line_id", F.coalesce("a", "start").alias("a"), F.coalesce("b", "end").alias("b"))


@query(r"""
SELECT video_id, clean_segment_index // 4 AS block, array_to_string(list(CAST(CAST(clean_start AS INT) AS VARCHAR) ORDER BY clean_segment_index, seg_id), ';') AS clean_start, array_to_string(list(CAST(CAST(clean_end AS INT) AS VARCHAR) ORDER BY clean_segment_index, seg_id), ';') AS clean_end
FROM (SELECT video_id, seg_id, clean_segment_index, floor(clean_start) AS clean_start, floor(clean_end) AS clean_end FROM segment_label_parse WHERE clean_end > clean_start AND clean_segment_index IS NOT NULL) GROUP BY ALL""")
def window_cells(spark: SparkSession, d: str) -> DataFrame:
    """Windows of four lines each, joined by `;` in order."""
    s = table(spark, d, "segment_label_parse").where("clean_end > clean_start and clean_segment_index is not null")
    s = s.select("video_id", F.floor(F.col("clean_segment_index") / 4).cast("int").alias("block"), F.struct("clean_segment_index", "seg_id").alias("place"), F.floor("clean_start").alias("a"), F.floor("clean_end").alias("b"))
    return timeline_cells(s, ["video_id", "block"], "place", "a", "b")


@query(r"""
SELECT id AS video_id, label, count(*) AS n FROM train_events WHERE id IS NOT NULL GROUP BY id, label ORDER BY n DESC, id, label LIMIT 5""")
def largest_groups(spark: SparkSession, d: str) -> DataFrame:
    """The five largest groups of events: a top-k, not a full sort."""
    return table(spark, d, "train_events").where("id is not null").groupBy(F.col("id").alias("video_id"), "label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "video_id", "label").limit(5)


@query("SELECT event_uid, CAST(least(10, greatest(1, coalesce(stage3_confidence, 1))) AS INT) AS confidence FROM train_events")
def confidence_clamp(spark: SparkSession, d: str) -> DataFrame:
    """Confidences as whole numbers from 1 to 10."""
    return table(spark, d, "train_events").select("event_uid", X.confidence(F.col("stage3_confidence")).alias("confidence"))


@query(rf"""
SELECT l.label_id FROM train_label l WHERE l.wav IS NOT NULL AND NOT EXISTS (SELECT 1 FROM manual_gt_example g WHERE g.wav = l.wav AND {_DONE})""")
def pending_clips(spark: SparkSession, d: str) -> DataFrame:
    """Clips without a finished annotation: what a resumed run still has to do."""
    done = table(spark, d, "manual_gt_example").select("wav", X.is_completed(F.col("annotation.status"), F.col("gt.subject"), F.col("gt.verb")).alias("good"))
    return incremental.pending(table(spark, d, "train_label").where("wav is not null").select("label_id", "wav"), done, "wav", F.col("good")).select("label_id")


@query("SELECT user_id, event_id, event_type, round(value, 6) AS value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def stream_upsert(spark: SparkSession, d: str) -> DataFrame:
    """The last event of each user, kept by a stream that upserts its batches into a table."""
    at = f"{shared_folder(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    schema = table(spark, d, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{d}/events*.parquet").select("user_id", "event_id", "event_type", "value", F.struct("ts", "event_id").alias("version"))
    target = incremental.Table(spark, f"{at}/table")
    incremental.upsert_stream(stream, target, ["user_id"], "version", f"{at}/checkpoint").awaitTermination()
    return target.read().select("user_id", "event_id", "event_type", r6("value").alias("value"))


@query(r"""
WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 12 HOUR THEN 0 ELSE 1 END AS opens FROM events),
s AS (SELECT user_id, ts, sum(opens) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS k FROM e)
SELECT user_id, CAST(floor(epoch(min(ts))) AS BIGINT) AS start, CAST(floor(epoch(max(ts) + INTERVAL 12 HOUR)) AS BIGINT) AS "end", count(*) AS events FROM s GROUP BY user_id, k""")
def sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions of users, ended by twelve hours without an event."""
    e = table(spark, d, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    x = incremental.session_counts(e, "ts", "user_id", "12 hours")
    return x.select("user_id", F.unix_timestamp("start").alias("start"), F.unix_timestamp("end").alias("end"), "events")


@query(r"""
WITH f AS (SELECT id AS video_id, event_uid, start_sec, coalesce(verb, '') AS verb FROM train_events WHERE start_sec IS NOT NULL)
SELECT event_uid, lag(verb) OVER w AS before, lead(verb) OVER w AS after, row_number() OVER w AS place, count(*) OVER (PARTITION BY video_id) AS events FROM f WINDOW w AS (PARTITION BY video_id ORDER BY start_sec, event_uid)""")
def event_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """Each event with the verbs before and after it in its video."""
    t = table(spark, d, "train_events").where("start_sec is not null").select("id", "event_uid", "start_sec", F.coalesce("verb", F.lit("")).alias("verb"), F.floor(F.col("start_sec") / 3600).alias("hour"))
    t = neighbour(neighbour(t, ["id"], "hour", ["start_sec", "event_uid"], "verb", "after"), ["id"], "hour", ["start_sec", "event_uid"], "verb", "before", ahead=False)
    t = cut(numbered(t, ["id"], ["start_sec", "event_uid"], "place"))
    n = t.groupBy("id").agg(F.count("*").alias("events"))
    return t.alias("l").join(F.broadcast(n).alias("r"), same("l", "r", ["id"])).select("event_uid", "before", "after", (F.col("place") + 1).cast("int").alias("place"), "r.events")


@query(r"""
SELECT line_id, video_id, title FROM timeline WHERE title IS NOT NULL QUALIFY row_number() OVER (PARTITION BY video_id, seconds ORDER BY pos, line_id) = 1 AND seconds IS NOT NULL""")
def timeline_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """One line a second and video, the first kept."""
    t = table(spark, d, "timeline").where("title is not null and seconds is not null")
    return timelines.first_by(t, ["video_id", "seconds"], ["pos", "line_id"]).select("line_id", "video_id", "title")
