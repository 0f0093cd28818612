"""Queries of collecting and preparing annotation work: row rules, orders, presence, windows, coverage, templates, usage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import records as R
from ..functions import rules
from ..functions import text as X
from ..functions import times as T
from ..operators import matching
from ..operators.prefix import neighbour, numbered
from ..operators.skew import hot_join
from ..sources.tables import cut, table
from .bank import _CLASSES, _verb_classes
from .records import _NUM
from .reference import _SQ, VERB_ALIASES, r6

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


#: Verbs that the rules lead to, beside those of the class table.
RULE_VERBS = ["rubbing", "scraping", "brushing", "bubbling", "blowing", "licking", "popping", "crunching"]


@query(rf"""
WITH v(verb, c) AS (VALUES {_CLASSES}), lex AS (SELECT verb FROM v UNION SELECT unnest(['rubbing', 'scraping', 'brushing', 'bubbling', 'blowing', 'licking', 'popping', 'crunching'])),
al(a, t) AS (VALUES ('drumming', 'tapping'), ('patting', 'tapping'), ('clacking', 'knocking'), ('leafing', 'page_turning'), ('sipping', 'chewing'), ('smouldering', 'simmering')),
r AS (SELECT label_id, CASE label_id % 5 WHEN 0 THEN 'cleaning' WHEN 1 THEN 'melting' WHEN 2 THEN 'fail' ELSE verb END AS raw, lower(coalesce(subject, '')) AS s, lower(coalesce(object, '')) AS o, lower(coalesce(seg_label, '')) AS sl, lower(coalesce(caption, '')) AS vis, subject FROM train_label),
k AS (SELECT *, CASE WHEN regexp_matches(o || vis || sl || s, 'ear|mic|silicone') THEN CASE WHEN regexp_matches(s, 'brush|spoolie|bristle|makeup|fluffy ball') THEN 'brushing' WHEN regexp_matches(s, 'cotton|swab|pad|wipe|cloth|konjac|sponge') THEN 'wiping' WHEN regexp_matches(s, 'finger|nail|hand') AND NOT regexp_matches(s, 'pick|stick') THEN 'rubbing' ELSE 'scraping' END END AS cv,
  CASE WHEN regexp_matches(sl || '|' || vis, 'bath bomb') AND regexp_matches(vis, 'leaf|leaves|rustl') THEN 'pressing' WHEN regexp_matches(sl || '|' || vis, 'bath bomb') AND regexp_matches(vis, 'fizz|bubble|dissolv|effervesc|foam') THEN 'bubbling' WHEN regexp_matches(vis, 'fizz|bubble|dissolv|effervesc') THEN 'bubbling' ELSE 'crushing' END AS mv,
  CASE WHEN lower(trim(raw)) = 'fail' THEN CASE WHEN contains(sl, 'kissing') OR contains(vis, 'kiss') THEN 'licking' WHEN contains(sl, 'popping candy') OR contains(vis, 'popping candy') THEN 'popping' WHEN regexp_matches(vis, 'crunch|stretch') AND contains(sl, 'slime') THEN 'crunching' WHEN regexp_matches(vis, 'rub|press|tap') THEN 'rubbing' END END AS fv,
  regexp_replace(trim(lower(raw)), '\s+', '_', 'g') AS t FROM r)
SELECT label_id, CASE WHEN coalesce(raw, '') = '' OR lower(trim(raw)) = 'fail' THEN NULL WHEN raw = 'cleaning' AND cv IS NOT NULL THEN cv WHEN raw = 'melting' THEN mv ELSE coalesce(lex.verb, al.t) END AS verb,
  CASE WHEN coalesce(raw, '') = '' OR lower(trim(raw)) = 'fail' THEN 'missing' WHEN raw = 'cleaning' AND cv IS NOT NULL THEN 'rule_cleaning' WHEN raw = 'melting' THEN 'rule_melting' WHEN lex.verb IS NOT NULL THEN 'lexicon' WHEN al.t IS NOT NULL THEN 'alias' ELSE 'unmapped' END AS source, fv AS seen
FROM k LEFT JOIN lex ON lex.verb = k.t LEFT JOIN al ON al.a = k.t""")
def verb_rules(spark: SparkSession, d: str) -> DataFrame:
    """Verbs by rule, lexicon or alias with their source, and the verb that a picture would suggest (the caption stands for
    its description; every fifth raw verb is one of those that the rules are for)."""
    k = F.col("label_id") % 5
    raw = F.when(k == 0, "cleaning").when(k == 1, "melting").when(k == 2, "fail").otherwise(F.col("verb"))
    lexicon = [*_verb_classes(spark, d), *RULE_VERBS]
    t = table(spark, d, "train_label").withColumn("raw", raw)
    x = t.select("label_id", rules.resolved_verb(F.col("raw"), F.col("subject"), F.col("object"), F.col("seg_label"), F.col("caption"), lexicon, VERB_ALIASES).alias("r"), rules.seen_verb(F.col("raw"), F.col("seg_label"), F.col("caption")).alias("seen"))
    return x.select("label_id", "r.verb", "r.source", "seen")


@query()
def row_normalize(spark: SparkSession, d: str) -> DataFrame:
    """Whole rows normalised: nouns, verb with source, notes, caption, reasons for review."""
    t = table(spark, d, "train_label").select("label_id", "verb", "subject", "object", "seg_label", "caption", "title")
    x = rules.normalized(t, "verb", "subject", "object", "seg_label", "caption", "title", [*_verb_classes(spark, d), *RULE_VERBS], VERB_ALIASES)
    return x.select("label_id", "norm_verb", "norm_subject", "norm_object", "verb_source", "note", "norm_caption", "review")


@query(r"""
WITH e AS (SELECT id, event_uid, start_sec, end_sec, coalesce(segments[1].audio_path, '') AS path FROM train_events WHERE id IS NOT NULL)
SELECT event_uid, row_number() OVER (ORDER BY id, coalesce(CAST(trunc(start_sec) AS BIGINT), 0), coalesce(CAST(trunc(end_sec) AS BIGINT), 0), path, event_uid) AS place FROM e""")
def train_order(spark: SparkSession, d: str) -> DataFrame:
    """The place of each event in the order of video, start, end and path."""
    whole = lambda c: F.coalesce(F.col(c).cast("bigint"), F.lit(0)).alias(c)
    e = table(spark, d, "train_events").where("id is not null").select("id", whole("start_sec"), whole("end_sec"), F.coalesce(F.get("segments", 0)["audio_path"], F.lit("")).alias("path"), "event_uid")
    return numbered(e, [], ["id", "start_sec", "end_sec", "path", "event_uid"], "place").select("event_uid", (F.col("place") + 1).alias("place"))


@query(rf"""
WITH w AS (SELECT id AS video_id, event_uid, concat_ws('_', id, {_NUM.format("start_sec")}, {_NUM.format("end_sec")}) AS stem, start_sec AS lo, end_sec AS hi FROM train_events WHERE id IS NOT NULL AND end_sec > start_sec)
SELECT video_id, stem, min(event_uid) AS event_uid FROM w GROUP BY ALL ORDER BY video_id, stem LIMIT 100""")
def task_list(spark: SparkSession, d: str) -> DataFrame:
    """The first hundred tasks: one a stem, the first kept, in order of video and stem (a top-k)."""
    e = table(spark, d, "train_events").where("id is not null and end_sec > start_sec")
    x = e.groupBy(F.col("id").alias("video_id"), R.folder_name(F.col("id"), F.col("start_sec"), F.col("end_sec")).alias("stem")).agg(F.min("event_uid").alias("event_uid"))
    return x.orderBy("video_id", "stem").limit(100)


@query(r"""
WITH k AS (SELECT line_id, video_id, seconds, pos, NOT regexp_matches(lower(coalesce(title, '')), 'intro|preview|tap') AS kept FROM timeline WHERE video_id IS NOT NULL AND seconds IS NOT NULL),
g AS (SELECT *, bool_or(kept) OVER (PARTITION BY video_id) AS any_kept FROM k)
SELECT line_id, video_id, CAST(seconds AS DOUBLE) AS start, CAST(lead(seconds) OVER (PARTITION BY video_id ORDER BY seconds, pos, line_id) AS DOUBLE) AS till FROM g WHERE kept OR NOT any_kept""")
def keyword_strip(spark: SparkSession, d: str) -> DataFrame:
    """Timelines without the lines of some keywords, ends anew from the next line; a timeline that would be left empty stays."""
    t = table(spark, d, "timeline").where("video_id is not null and seconds is not null").select("line_id", "video_id", "seconds", "pos", "title")
    t = t.withColumn("kept", ~R.title_has(F.col("title"), R.keywords("Intro, preview,tap")))
    some = cut(t.groupBy("video_id").agg(F.bool_or("kept").alias("some")))
    x = hot_join(t, some, "video_id", "inner").where("kept or not some").withColumn("start", F.col("seconds").cast("double")).withColumn("hour", F.floor(F.col("seconds") / 3600))
    return neighbour(x, ["video_id"], "hour", ["seconds", "pos", "line_id"], "start", "till").select("line_id", "video_id", "start", "till")


@query(r"""
WITH v AS (SELECT DISTINCT id AS video_id FROM train_events WHERE id IS NOT NULL), t AS (SELECT video_id, count(*) FILTER (trim(time_str) <> '') AS lines FROM timeline WHERE video_id IS NOT NULL GROUP BY video_id)
SELECT video_id, coalesce(lines, 0) >= 1 AS has_rows, coalesce(lines, 0) >= 2 AS cached, row_number() OVER (ORDER BY lower(video_id), video_id) AS place FROM v LEFT JOIN t USING (video_id)""")
def timeline_presence(spark: SparkSession, d: str) -> DataFrame:
    """Which videos have a timeline, in order of their names without case."""
    v = table(spark, d, "train_events").where("id is not null").select(F.col("id").alias("video_id")).distinct()
    t = cut(table(spark, d, "timeline").where("video_id is not null").groupBy("video_id").agg(F.count_if(F.coalesce(X.stripped("time_str") != "", F.lit(False))).alias("lines")))
    x = hot_join(v, t, "video_id").withColumn("lower", F.lower("video_id"))
    y = numbered(x, [], ["lower", "video_id"], "place")
    n = F.coalesce("lines", F.lit(0))
    return y.select("video_id", (n >= 1).alias("has_rows"), (n >= 2).alias("cached"), (F.col("place") + 1).alias("place"))


@query(r"""
SELECT t.line_id, arg_min(s.seg_id, [coalesce(s.clean_segment_index, -1), s.seg_id]) AS seg_id FROM timeline t JOIN segment_label_parse s ON t.video_id = s.video_id AND abs(t.start_sec - s.start_sec) <= 0.51 AND abs(t.end_sec - s.end_sec) <= 0.51 GROUP BY t.line_id""")
def first_window(spark: SparkSession, d: str) -> DataFrame:
    """The first window that agrees with a line within the tolerance."""
    a = table(spark, d, "timeline").select("line_id", "video_id", F.col("start_sec").alias("start"), F.col("end_sec").alias("end"))
    b = table(spark, d, "segment_label_parse").select("seg_id", "clean_segment_index", "video_id", F.col("start_sec").alias("start"), F.col("end_sec").alias("end"))
    m = matching.match_intervals(a, b, ["video_id"])
    return m.groupBy("line_id").agg(F.min_by("r_seg_id", F.struct(F.coalesce("r_clean_segment_index", F.lit(-1)), "r_seg_id")).alias("seg_id"))


@query(rf"""
WITH w AS (SELECT video_id, seg_id, label, title, clean_start AS a, clean_end AS b, concat_ws('_', video_id, {_NUM.format("clean_start")}, {_NUM.format("clean_end")}) AS folder FROM segment_label_parse WHERE video_id IS NOT NULL AND clean_end > clean_start),
p AS (SELECT id, max(title) AS title FROM train_events WHERE id IS NOT NULL GROUP BY id)
SELECT folder, video_id, seg_id, coalesce(nullif(trim(w.title), ''), p.title) AS title, round(a, 6) AS a, round(b, 6) AS b FROM (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY folder ORDER BY seg_id) = 1) w LEFT JOIN p ON p.id = w.video_id""")
def clip_windows(spark: SparkSession, d: str) -> DataFrame:
    """The valid windows as clips, one a folder name, with the title of the window, else of the video."""
    ok = T.clean_window(F.col("clean_start"), F.col("clean_end")).isNotNull()
    s = table(spark, d, "segment_label_parse").where(F.col("video_id").isNotNull() & ok)
    folder = R.folder_name(F.col("video_id"), F.col("clean_start"), F.col("clean_end"))
    x = s.groupBy(folder.alias("folder")).agg(F.min_by(F.struct("video_id", "seg_id", "title", "clean_start", "clean_end"), "seg_id").alias("x")).select("folder", "x.*")
    titles = cut(table(spark, d, "train_events").where("id is not null").groupBy(F.col("id").alias("video_id")).agg(F.max("title").alias("of_video")))
    return hot_join(x, titles, "video_id").select("folder", "video_id", "seg_id", F.coalesce(X.none_if_empty(X.stripped(F.col("title"))), F.col("of_video")).alias("title"), r6("clean_start").alias("a"), r6("clean_end").alias("b"))


@query(r"""
WITH s AS (SELECT video_id, count(*) AS n, bool_and(coalesce(end_sec > start_sec, false) AND clean_start IS NOT NULL AND clean_end IS NOT NULL AND clean_segment_index IS NOT NULL AND coalesce(clean_end > clean_start, false)) AS valid FROM segment_label_parse WHERE video_id IS NOT NULL GROUP BY video_id),
t AS (SELECT DISTINCT video_id FROM timeline WHERE video_id IS NOT NULL)
SELECT video_id, CASE WHEN n IS NULL THEN 'stub_and_cleaned' WHEN valid THEN 'skipped' ELSE 'cleaned' END AS status FROM t LEFT JOIN s USING (video_id)""")
def cut_status(spark: SparkSession, d: str) -> DataFrame:
    """What a cutting run does with each video that has a timeline: nothing where all windows are there and valid, a cut where
    some aren't, a stub first where there is no window at all."""
    valid = F.coalesce(F.col("end_sec") > F.col("start_sec"), F.lit(False)) & F.col("clean_segment_index").isNotNull() & T.clean_window(F.col("clean_start"), F.col("clean_end")).isNotNull()
    s = cut(table(spark, d, "segment_label_parse").where("video_id is not null").groupBy("video_id").agg(F.bool_and(valid).alias("valid")))
    t = table(spark, d, "timeline").where("video_id is not null").select("video_id").distinct()
    return hot_join(t, s, "video_id").select("video_id", F.when(F.col("valid").isNull(), "stub_and_cleaned").when(F.col("valid"), "skipped").otherwise("cleaned").alias("status"))


@query(r"""
WITH f AS (SELECT id, label, NOT contains(lower(coalesce(label, '')), 'mixed beeswax soup') AND (regexp_matches(lower(coalesce(label, '')), 'preview|intro|combination') OR (contains(lower(coalesce(label, '')), 'mix') AND NOT contains(lower(coalesce(label, '')), 'mixing'))) AS blocked FROM train_events)
SELECT id AS video_id, count(*) AS before, count(*) FILTER (NOT blocked) AS after, count(DISTINCT label) FILTER (blocked) AS removed_labels FROM f GROUP BY id""")
def filter_report(spark: SparkSession, d: str) -> DataFrame:
    """Events of each video before and after the filter of blocked labels, and how many labels it removes."""
    e = table(spark, d, "train_events").select(F.col("id").alias("video_id"), "label", X.is_blocked(F.col("label")).alias("blocked"))
    return e.groupBy("video_id").agg(F.count("*").alias("before"), F.count_if(~F.col("blocked")).alias("after"), F.countDistinct(F.when(F.col("blocked"), F.col("label"))).alias("removed_labels"))


@query(r"""
SELECT coalesce(nullif(trim(wav), ''), 'row_' || label_id) AS item_id, wav, 'train' AS split, 'pending' AS status, CAST(NULL AS VARCHAR) AS gt_verb, seg_label, title FROM train_label QUALIFY row_number() OVER (PARTITION BY coalesce(nullif(trim(wav), ''), 'row_' || label_id) ORDER BY label_id) = 1""")
def blind_template(spark: SparkSession, d: str) -> DataFrame:
    """Items to annotate: one an identifier, labels hidden, with the context."""
    ids = F.coalesce(X.none_if_empty(F.trim("wav")), F.concat(F.lit("row_"), F.col("label_id").cast("string")))
    x = table(spark, d, "train_label").groupBy(ids.alias("item_id")).agg(F.min_by(F.struct("wav", "seg_label", "title"), "label_id").alias("x"))
    empty = F.struct(*[F.lit(None).cast("string").alias(f) for f in ("subject", "verb", "object")])
    y = x.select("item_id", "x.*", empty.alias("gt"), F.struct(F.lit(None).cast("string").alias("annotator_id"), F.lit("pending").alias("status"), F.lit(None).cast("string").alias("notes")).alias("annotation"))
    return y.select("item_id", "wav", F.lit("train").alias("split"), "annotation.status", F.col("gt.verb").alias("gt_verb"), "seg_label", "title")


@query(r"""
WITH u AS (SELECT coalesce(verb_source, 'none') AS stage, CAST(length(coalesce(title, '')) AS BIGINT) AS prompt, CAST(length(coalesce(label, '')) AS BIGINT) AS completion FROM segment_label_parse),
r AS (SELECT stage, CAST(sum(prompt) AS BIGINT) AS prompt, CAST(sum(completion) AS BIGINT) AS completion, count(*) FILTER (prompt + completion > 0) AS calls FROM u GROUP BY stage),
m AS (SELECT stage, prompt + 5 AS prompt, completion, calls + CASE WHEN calls % 2 = 0 THEN 1 ELSE -1 END AS calls FROM r)
SELECT r.stage, CASE WHEN m.calls > r.calls THEN 'meta' ELSE 'events' END AS taken, greatest(r.calls, m.calls) AS calls, CASE WHEN m.calls > r.calls THEN m.prompt ELSE r.prompt END AS prompt, r.completion FROM r JOIN m USING (stage)""")
def usage_rebuild(spark: SparkSession, d: str) -> DataFrame:
    """Usage by stage rebuilt from rows and from a stored account, the one with more calls kept."""
    n = lambda c: F.coalesce(F.length(c), F.lit(0)).cast("long")
    u = table(spark, d, "segment_label_parse").select(F.coalesce("verb_source", F.lit("none")).alias("stage"), n("title").alias("prompt"), n("label").alias("completion"))
    r = cut(u.groupBy("stage").agg(F.sum("prompt").alias("prompt"), F.sum("completion").alias("completion"), F.count_if(F.col("prompt") + F.col("completion") > 0).alias("calls")))
    m = r.select("stage", (F.col("prompt") + 5).alias("prompt"), "completion", (F.col("calls") + F.when(F.col("calls") % 2 == 0, 1).otherwise(-1)).alias("calls"))
    both = r.withColumn("taken", F.lit("events")).unionByName(m.withColumn("taken", F.lit("meta")))
    # of equal accounts the rows count, so they get the greater second key
    best = both.groupBy("stage").agg(F.max_by(F.struct("taken", "calls", "prompt", "completion"), F.struct("calls", (F.col("taken") == "events").alias("first"))).alias("x"))
    return best.select("stage", "x.taken", "x.calls", "x.prompt", "x.completion")


@query(rf"""
WITH w AS (SELECT DISTINCT video_id, {_NUM.format("clean_start")} AS a FROM segment_label_parse WHERE video_id IS NOT NULL AND clean_end > clean_start), f AS (SELECT DISTINCT video_id, a FROM w WHERE md5(video_id || a) < 'c')
SELECT video_id, count(*) AS expected, count(f.a) AS there FROM w LEFT JOIN f USING (video_id, a) GROUP BY video_id""")
def frame_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Pictures that the windows of each video should have, and those that are there."""
    w = table(spark, d, "segment_label_parse").where("video_id is not null and clean_end > clean_start").select("video_id", R.file_number(F.col("clean_start")).alias("a")).distinct()
    have = w.where(F.md5(F.concat("video_id", "a")) < "c").withColumn("there", F.lit(1))
    return w.join(have, ["video_id", "a"], "left").groupBy("video_id").agg(F.count("*").alias("expected"), F.count("there").alias("there"))


@query(rf"""
WITH p AS (SELECT DISTINCT {_SQ.format("g.gt.object")} AS l, {_SQ.format("t.object")} AS r FROM manual_gt_example g JOIN train_label t USING (wav)), q AS (SELECT * FROM p WHERE l IS NOT NULL AND r IS NOT NULL AND l <> r),
k AS (SELECT *, md5(l || '|' || r) < '8' AS known FROM q) SELECT l, r, known AS cached, md5(l || '/' || r) < '4' AS same FROM k""")
def judge_cache(spark: SparkSession, d: str) -> DataFrame:
    """Distinct pairs of nouns judged by a provider once each: from the cache where it has them, else asked."""
    g = table(spark, d, "manual_gt_example").select("wav", X.audit_text(F.col("gt.object")).alias("l"))
    p = g.join(table(spark, d, "train_label").select("wav", X.audit_text(F.col("object")).alias("r")), "wav").where("l <> r").select("l", "r").distinct()
    judged = F.md5(F.concat_ws("/", "l", "r")) < "4"
    p = cut(p.withColumn("key", R.pair_key(F.col("l"), F.col("r"))))
    cache = p.where(F.md5(F.concat_ws("|", "l", "r")) < "8").select("key", judged.alias("same"))
    probed = hot_join(p, cut(cache), "key")
    asked = probed.where("same is null").select("l", "r", judged.alias("same"))
    return probed.where("same is not null").select("l", "r", F.lit(True).alias("cached"), "same").unionByName(asked.select("l", "r", F.lit(False).alias("cached"), "same"))


@query(r"""
WITH l AS (SELECT DISTINCT id, label FROM train_events WHERE id IS NOT NULL AND label IS NOT NULL), p AS (SELECT id, label, lower(label) AS t FROM l)
SELECT id, label, regexp_matches(t, '(^|[^a-z])(water|liquid|soapy|submerged|effervesc|bath bomb|fluid|fizz|bubbles?|contains liquid|agitated by airflow)([^a-z0-9_]|$)') AS liquid, contains(label, '+') OR contains(label, '&') AS parallel FROM p""")
def label_context(spark: SparkSession, d: str) -> DataFrame:
    """Labels that speak of a liquid or of several sounds at once."""
    x = table(spark, d, "train_events").where("id is not null and label is not null").select("id", "label").distinct()
    return x.select("id", "label", rules.in_liquid(F.col("label")).alias("liquid"), X.is_parallel(F.col("label")).alias("parallel"))


@query(r"""
WITH t AS (SELECT video_id, count(*) AS lines FROM timeline WHERE video_id IS NOT NULL GROUP BY video_id), e AS (SELECT id AS video_id, count(*) AS events FROM train_events WHERE id IS NOT NULL GROUP BY id), d AS (SELECT video_id, count(*) AS documents FROM documents WHERE video_id IS NOT NULL GROUP BY video_id)
SELECT count(*) AS videos, count(lines) AS with_timeline, count(events) AS with_events, count(documents) AS with_documents, count(*) FILTER (lines IS NOT NULL AND events IS NOT NULL AND documents IS NOT NULL) AS complete, CAST(sum(coalesce(lines, 0)) AS BIGINT) AS lines
FROM t FULL JOIN e USING (video_id) FULL JOIN d USING (video_id)""")
def ingest_summary(spark: SparkSession, d: str) -> DataFrame:
    """How many videos each source has, how many all of them, and lines in all: one pass over tagged rows."""
    part = lambda name, col, tag: table(spark, d, name).where(F.col(col).isNotNull()).select(F.col(col).alias("video_id"), F.lit(tag).alias("src"))
    x = part("timeline", "video_id", "t").unionByName(part("train_events", "id", "e")).unionByName(part("documents", "video_id", "d"))
    v = x.groupBy("video_id").agg(*[F.count_if(F.col("src") == k).alias(k) for k in "ted"])
    return v.agg(
        F.count("*").alias("videos"), F.count_if(F.col("t") > 0).alias("with_timeline"), F.count_if(F.col("e") > 0).alias("with_events"), F.count_if(F.col("d") > 0).alias("with_documents"),
        F.count_if((F.col("t") > 0) & (F.col("e") > 0) & (F.col("d") > 0)).alias("complete"), F.sum("t").alias("lines"),
    )



@query(r"""
WITH p AS (SELECT event_uid, unnest(segments).audio_path AS path, unnest(range(len(segments))) AS pos FROM train_events), f AS (SELECT DISTINCT wav FROM train_label WHERE wav IS NOT NULL),
x AS (SELECT event_uid, nullif(trim(path), '') AS path, pos, nullif(trim(path), '') IN (SELECT wav FROM f) AS there FROM p),
b AS (SELECT event_uid, path, there FROM x WHERE path IS NOT NULL QUALIFY row_number() OVER (PARTITION BY event_uid ORDER BY CASE WHEN there THEN 0 ELSE 1 END, pos) = 1)
SELECT event_uid, path, coalesce(there, false) AS there FROM train_events LEFT JOIN b USING (event_uid)""")
def representative_audio(spark: SparkSession, d: str) -> DataFrame:
    """One clip an event: the first that was exported, else the first."""
    e = table(spark, d, "train_events").select("event_uid", F.transform("segments", lambda s: s["audio_path"]).alias("paths"))
    return matching.representative(e, "event_uid", "paths", table(spark, d, "train_label").where("wav is not null").select(F.col("wav").alias("path")))


_HMS = "CASE WHEN {0} < 0 THEN '-' ELSE '' END || printf('%d:%02d:%02d.%03d', CAST(floor(round(abs({0}) * 1000) / 3600000) AS BIGINT), CAST(floor(round(abs({0}) * 1000) / 60000) AS BIGINT) % 60, CAST(floor(round(abs({0}) * 1000) / 1000) AS BIGINT) % 60, CAST(round(abs({0}) * 1000) AS BIGINT) % 1000)"


@query(f"""
WITH s AS (SELECT seg_id, clean_start AS a, clean_end AS b, start_sec AS o FROM segment_label_parse WHERE clean_start IS NOT NULL AND clean_end IS NOT NULL AND start_sec IS NOT NULL)
SELECT seg_id, {_HMS.format("a")} AS start_hms, {_HMS.format("b")} AS end_hms, {_HMS.format("(b - a)")} AS duration_hms, {_HMS.format("(a - o)")} AS start_rel_hms, {_HMS.format("(b - o)")} AS end_rel_hms FROM s""")
def hms_columns(spark: SparkSession, d: str) -> DataFrame:
    """Windows with their times written out, also from the start of their line."""
    s = table(spark, d, "segment_label_parse").where("clean_start is not null and clean_end is not null and start_sec is not null")
    return s.select("seg_id", *T.hms_columns(F.col("clean_start"), F.col("clean_end"), F.col("start_sec"))).drop("start_rel", "end_rel")


@query(r"""
WITH k AS (SELECT seg_id, trim(video_id) AS video_id, clean_start AS a, clean_end AS b FROM segment_label_parse WHERE clean_start IS NOT NULL AND clean_end IS NOT NULL)
SELECT seg_id, video_id, round(a, 6) AS a, round(b, 6) AS b FROM k WHERE b > a AND video_id <> ''""")
def window_folders(spark: SparkSession, d: str) -> DataFrame:
    """Windows from the keys of their folders; broken keys and windows that don't end after their start give no row."""
    s = table(spark, d, "segment_label_parse").where("clean_start is not null and clean_end is not null")
    x = s.select("seg_id", F.trim("video_id").alias("video_id"), R.window_of_key(F.concat_ws("_", F.col("clean_start").cast("string"), F.col("clean_end").cast("string"))).alias("w"))
    return x.where("w is not null and video_id <> ''").select("seg_id", "video_id", r6("w.start").alias("a"), r6("w.end").alias("b"))


@query(r"""
WITH l AS (SELECT event_uid, id, CASE event_uid % 4 WHEN 0 THEN 'https://www.youtube.com/watch?v=' || id WHEN 1 THEN 'https://www.youtube.com/shorts/' || id WHEN 2 THEN NULL ELSE ' ' || id || ' ' END AS url, author, title FROM train_events)
SELECT event_uid, CASE WHEN url LIKE 'http%' THEN url ELSE 'https://www.youtube.com/watch?v=' || id END AS url, coalesce(nullif(trim(author), ''), nullif(trim(title), ''), id) AS uploader FROM l WHERE id <> '' AND NOT contains(coalesce(url, ''), '/shorts/')""")
def channel_urls(spark: SparkSession, d: str) -> DataFrame:
    """Addresses and uploaders of listed videos, without short ones."""
    k = F.col("event_uid") % 4
    base = "https://www.youtube.com/"
    url = F.when(k == 0, F.concat(F.lit(base + "watch?v="), "id")).when(k == 1, F.concat(F.lit(base + "shorts/"), "id")).when(k == 3, F.concat(F.lit(" "), "id", F.lit(" ")))
    t = table(spark, d, "train_events").where("id <> ''").select("event_uid", "id", R.listed_url(F.when(k != 3, F.col("id")), url).alias("url"), R.first_named(F.col("author"), F.col("title"), F.col("id")).alias("uploader"))
    return t.where(~F.contains("url", F.lit("/shorts/"))).drop("id")


@query(r"""
WITH f AS (SELECT DISTINCT regexp_extract(wav, '([^/]+)/[^/]+$', 1) AS folder, CASE WHEN md5(wav) < '2' THEN regexp_extract(wav, '([^/]+)/[^/]+$', 1) || '.wav' ELSE regexp_extract(wav, '([^/]*)$', 1) END AS name FROM train_label WHERE wav IS NOT NULL)
SELECT folder, coalesce(max(name) FILTER (name = folder || '.wav'), CASE WHEN min(name) = max(name) THEN min(name) END) AS name FROM f WHERE name LIKE '%.wav' GROUP BY folder HAVING coalesce(max(name) FILTER (name = folder || '.wav'), CASE WHEN min(name) = max(name) THEN min(name) END) IS NOT NULL""")
def unique_wavs(spark: SparkSession, d: str) -> DataFrame:
    """The wav of each folder that has one named like it, or only one."""
    folder = F.regexp_extract("wav", r"([^/]+)/[^/]+$", 1)
    f = table(spark, d, "train_label").where("wav is not null").select(folder.alias("folder"), F.when(F.md5("wav") < "2", F.concat(folder, F.lit(".wav"))).otherwise(F.regexp_extract("wav", r"([^/]*)$", 1)).alias("name"))
    return matching.only_wav(f)


@query(r"""
WITH t AS (SELECT line_id, video_id, title, lang, start_sec AS a, end_sec AS b FROM timeline WHERE start_sec IS NOT NULL AND end_sec IS NOT NULL), s AS (SELECT * FROM segment_label_parse WHERE clean_end > clean_start)
SELECT t.line_id, s.seg_id, t.title, t.lang, s.clean_start, s.clean_end, CAST(coalesce(s.clean_segment_index, 0) AS INT) AS clean_segment_index, s.seg_id IS NOT NULL AS clean_detected FROM t LEFT JOIN s ON t.video_id = s.video_id AND abs(t.a - s.start_sec) <= 0.51 AND abs(t.b - s.end_sec) <= 0.51""")
def child_segments(spark: SparkSession, d: str) -> DataFrame:
    """Windows with what they inherit from their line; a line without a window is a stub with empty fields."""
    t = table(spark, d, "timeline").where("start_sec is not null and end_sec is not null").select("line_id", "video_id", "title", "lang", F.col("start_sec").alias("start"), F.col("end_sec").alias("end"))
    s = table(spark, d, "segment_label_parse").where("clean_end > clean_start").select("video_id", "seg_id", "clean_start", "clean_end", "clean_segment_index", F.col("start_sec").alias("start"), F.col("end_sec").alias("end"))
    m = matching.match_intervals(t.select("line_id", "video_id", "start", "end"), s, ["video_id"]).select("line_id", F.col("r_seg_id").alias("seg_id"), F.col("r_clean_start").alias("clean_start"), F.col("r_clean_end").alias("clean_end"), F.col("r_clean_segment_index").alias("clean_segment_index"))
    return t.join(m, "line_id", "left").select("line_id", "seg_id", "title", "lang", "clean_start", "clean_end", F.coalesce("clean_segment_index", F.lit(0)).alias("clean_segment_index"), F.col("seg_id").isNotNull().alias("clean_detected"))


@query(rf"""
WITH p AS (SELECT DISTINCT wav FROM train_label l WHERE wav IS NOT NULL AND NOT EXISTS (SELECT 1 FROM manual_gt_example g WHERE g.wav = l.wav)) SELECT wav, row_number() OVER (ORDER BY wav) AS place FROM p QUALIFY row_number() OVER (ORDER BY wav) > 50 ORDER BY wav LIMIT 25""")
def pending_page(spark: SparkSession, d: str) -> DataFrame:
    """A page of pending clips: 25 behind the first 50 in order of their paths."""
    p = table(spark, d, "train_label").where("wav is not null").select("wav").distinct().join(table(spark, d, "manual_gt_example").where("wav is not null").select("wav"), "wav", "left_anti")
    return numbered(p.orderBy("wav").limit(75), [], ["wav"], "place").select("wav", (F.col("place") + 1).alias("place")).where("place > 50")
