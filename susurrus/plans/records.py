"""Queries of record keys, replies, catalogues, annotator agreement, letter scores and subsets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import records as R
from ..functions import text as X
from ..operators import matching, scoring
from ..operators.packed import unpack
from ..sources.tables import cut, table
from .bank import _CLASSES, _verb_classes
from .reference import _DONE, _PAIRS, _SCORED, _SQ, VERB_ALIASES, _pairs, _predictions, _questions, _votes_sql, audio_subset_votes, r6

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


_NUM = "CASE WHEN abs({0} - trunc({0})) < 1e-6 THEN CAST(CAST(trunc({0}) AS BIGINT) AS VARCHAR) ELSE replace(rtrim(printf('%.9f', {0}), '0'), '.', 'p') END"


@query(rf"""
WITH e AS (SELECT *, concat_ws('_', id, {_NUM.format("start_sec")}, {_NUM.format("end_sec")}) AS folder FROM train_events WHERE id IS NOT NULL AND start_sec IS NOT NULL AND end_sec IS NOT NULL)
SELECT event_uid, trim(coalesce(nullif(label, ''), title, '')) AS label, id || '_' || CAST(trunc(start_sec) AS BIGINT) || '_' || CAST(trunc(end_sec) AS BIGINT) AS key, folder, CASE WHEN NOT regexp_matches(folder, '[<>:"/\\|?*]') THEN folder || '.png' END AS picture FROM e""")
def record_keys(spark: SparkSession, d: str) -> DataFrame:
    """Labels, keys, folder and picture names of events."""
    e = table(spark, d, "train_events").where("id is not null and start_sec is not null and end_sec is not null")
    a = (F.col("id"), F.col("start_sec"), F.col("end_sec"))
    return e.select("event_uid", R.segment_label(F.col("label"), F.col("title")).alias("label"), R.event_key(*a).alias("key"), R.folder_name(*a).alias("folder"), R.picture_name(*a).alias("picture"))


_STAMP = """CASE WHEN {0} >= 3600 THEN printf('%d:%02d:', CAST(floor({0} / 3600) AS BIGINT), CAST(floor(({0} - floor({0} / 3600) * 3600) / 60) AS BIGINT)) || {1} WHEN {0} >= 60 THEN printf('%d:', CAST(floor({0} / 60) AS BIGINT)) || {1} ELSE {1} END"""
_REST = "regexp_replace(printf('%.6f', {0} - floor({0} / 60) * 60), '\\.?0+$', '')"


@query(f"""
WITH w AS (SELECT line_id, start_sec AS a, greatest(end_sec, start_sec + 0.05) AS b FROM timeline WHERE end_sec > start_sec)
SELECT line_id, '*' || {_STAMP.format("a", _REST.format("a"))} || '-' || {_STAMP.format("b", _REST.format("b"))} AS section FROM w""")
def download_sections(spark: SparkSession, d: str) -> DataFrame:
    """Stretches of timeline lines as section strings."""
    t = table(spark, d, "timeline").where("end_sec > start_sec")
    return t.select("line_id", R.section(F.col("start_sec"), F.col("end_sec")).alias("section"))


@query(r"""
WITH t AS (SELECT label_id, CASE WHEN label_id % 2 = 0 THEN 'https://www.youtube.com/watch?app=x&v=' || regexp_extract(wav, 'audio/(.+)_[^_/]*_[^_/]*/', 1) || '&t=5' END AS url, wav FROM train_label WHERE wav IS NOT NULL)
SELECT label_id, coalesce(nullif(regexp_extract(url, '[?&]v=([^&]+)', 1), ''), nullif(regexp_extract(wav, '(?:^|/)audio/([^/]+)/', 1), ''), '') AS video, coalesce(url, 'https://www.youtube.com/watch?v=' || label_id) AS watch FROM t""")
def ledger_ids(spark: SparkSession, d: str) -> DataFrame:
    """The video of each ledger row, from its address, else its path, and the address to watch it."""
    made = F.concat(F.lit("https://www.youtube.com/watch?app=x&v="), F.regexp_extract("wav", "audio/(.+)_[^_/]*_[^_/]*/", 1), F.lit("&t=5"))
    t = table(spark, d, "train_label").where("wav is not null").select("label_id", "wav", F.when(F.col("label_id") % 2 == 0, made).alias("url"))
    return t.select("label_id", R.video_of_ledger(F.col("url"), F.col("wav")).alias("video"), R.watch_url(F.col("label_id").cast("string"), F.col("url")).alias("watch"))


@query(rf"""
WITH t AS (SELECT label_id, verb, object FROM train_label)
SELECT label_id, CASE WHEN label_id % 7 <> 0 THEN CASE WHEN trim(verb) = '' OR lower(trim(verb)) = 'null' THEN NULL WHEN lower(trim(verb)) = 'fail' THEN 'fail' ELSE regexp_replace(trim(lower(verb)), '\s+', '_', 'g') END END AS verb,
  CASE WHEN label_id % 7 <> 0 THEN CASE WHEN lower(trim(object)) = 'fail' THEN 'fail' ELSE {_SQ.format("object")} END END AS object, label_id % 7 <> 0 AS parsed FROM t""")
def json_replies(spark: SparkSession, d: str) -> DataFrame:
    """Replies in code fences parsed to fields; a reply that is no object (here every seventh) gives none."""
    t = table(spark, d, "train_label").select("label_id", F.to_json(F.struct("verb", "object"), {"ignoreNullFields": "false"}).alias("j"))
    content = F.when(F.col("label_id") % 7 == 0, F.concat(F.lit("["), "j", F.lit("]"))).when(F.col("label_id") % 2 == 0, F.concat(F.lit("```json\n"), "j", F.lit("\n```\n"))).otherwise(F.concat(F.lit("  "), "j"))
    x = t.select("label_id", R.json_object(content, "verb string, object string").alias("r"))
    return x.select("label_id", R.svo_field(F.col("r.verb"), False).alias("verb"), R.svo_field(F.col("r.object"), True).alias("object"), F.col("r").isNotNull().alias("parsed"))


@query(f"""
WITH v(verb, c) AS (VALUES {_CLASSES}), w AS (SELECT c, string_agg(verb, ', ' ORDER BY verb) AS shown FROM v GROUP BY c)
SELECT verb_class, '- ' || verb_class || CASE WHEN class_hint <> '' THEN chr(10) || '  when_to_use: ' || class_hint ELSE '' END || CASE WHEN noun_cues <> '' THEN chr(10) || '  noun_cues: ' || noun_cues ELSE '' END AS catalog,
  '- ' || verb_class || ': ' || coalesce(shown, '') || chr(10) || chr(10) || 'Allowed verbs (pick exactly one): ' || shown AS allowed FROM asmr_verb_classes_en LEFT JOIN w ON c = verb_class""")
def class_catalog(spark: SparkSession, d: str) -> DataFrame:
    """The catalogue entry of each verb class, and its allowed verbs by name."""
    t = table(spark, d, "asmr_verb_classes_en")
    v = unpack(t.withColumn("source", F.lit("verbs")), "source", "verbs", ["verb_class"], least_values=1).groupBy("verb_class").agg(F.array_join(F.array_sort(F.collect_set(X.token(F.col("val")))), ", ").alias("list"))
    part = lambda name, col: F.coalesce(F.concat(F.lit(f"\n  {name}: "), X.none_if_empty(F.col(col))), F.lit(""))
    x = t.join(F.broadcast(v), "verb_class", "left")
    return x.select("verb_class", F.concat(F.lit("- "), "verb_class", part("when_to_use", "class_hint"), part("noun_cues", "noun_cues")).alias("catalog"), F.concat(F.lit("- "), "verb_class", F.lit(": "), "list", F.lit("\n\nAllowed verbs (pick exactly one): "), "list").alias("allowed"))


# letters, subsets
@query(rf"""
WITH v AS (SELECT item_id, {_SQ.format("gt.verb")} AS verb, count(*) AS n FROM manual_gt_example WHERE item_id IS NOT NULL AND {_DONE} GROUP BY ALL),
r AS (SELECT item_id, ln(n / sum(n) OVER (PARTITION BY item_id)) AS logprob, row_number() OVER (PARTITION BY item_id ORDER BY verb) AS k FROM v),
s AS (SELECT i.item_id, l.letter, l.k, coalesce(r.logprob, -1e9) AS score FROM (SELECT DISTINCT item_id FROM v) i, (SELECT unnest(['A', 'B', 'C', 'D']) AS letter, unnest([1, 2, 3, 4]) AS k) l LEFT JOIN r ON r.item_id = i.item_id AND r.k = l.k)
SELECT item_id, letter, round(score, 6) AS score, letter = first_value(letter) OVER (PARTITION BY item_id ORDER BY round(score, 6) DESC, letter) AS best FROM s""")
def token_scores(spark: SparkSession, d: str) -> DataFrame:
    """Scores of the letters A to D from log probabilities of the first token that isn't blank (here the shares of the verbs
    that annotators gave), and which is best."""
    g = table(spark, d, "manual_gt_example").where("item_id is not null").where(X.is_completed(F.col("annotation.status"), F.col("gt.subject"), F.col("gt.verb")))
    votes = g.groupBy("item_id", X.audit_text(F.col("gt.verb")).alias("verb")).agg(F.count("*").alias("n"))
    # verbs are a vocabulary, so an item's votes are a bounded row
    x = votes.groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct("verb", "n"))).alias("v"), F.sum("n").alias("all"))
    letter = lambda k: F.get(F.array(*[F.lit(c) for c in "ABCD"]), k)
    top = F.transform("v", lambda s, k: F.struct(F.concat(F.lit(" "), F.lower(letter(k))).alias("token"), F.log(s["n"] / F.col("all")).alias("logprob")))
    blank = F.struct(F.lit(" \n").alias("token"), F.lit(0.0).alias("logprob"), F.array(F.struct(F.lit("D").alias("token"), F.lit(0.0).alias("logprob"))).alias("top_logprobs"))
    first = F.struct(top[0]["token"].alias("token"), top[0]["logprob"].alias("logprob"), top.alias("top_logprobs"))
    s = scoring.letter_scores(x.select("item_id", F.array(blank, first).alias("tokens")), "item_id", "tokens", list("ABCD")).withColumn("score", r6("score"))
    b = scoring.best_letter(s, "item_id", "letter", "score", "rank")
    return s.join(b.withColumnRenamed("best", "top"), "item_id").select("item_id", "letter", "score", (F.col("letter") == F.col("top")).alias("best"))


@query(f"""
WITH {_SCORED}, i AS (SELECT question_id FROM ({_votes_sql()})), z AS (SELECT g.run_id, g.question_id, q.task, q.gold, p.pred FROM g JOIN q USING (question_id) JOIN p ON p.run_id = g.run_id AND p.question_id = g.question_id WHERE p.pred IS NOT NULL)
SELECT task, count(*) AS n, round(avg(CAST(pred IS NOT DISTINCT FROM gold AS INT)), 6) AS accuracy FROM z SEMI JOIN i USING (question_id) GROUP BY task""")
def subset_task_accuracy(spark: SparkSession, d: str) -> DataFrame:
    """Accuracy by task over all runs, of the questions that need the sound."""
    x = scoring.task_accuracy(_questions(spark, d), _predictions(spark, d), audio_subset_votes(spark, d))
    return x.select("task", "n", r6("accuracy").alias("accuracy"))


@query(r"""
WITH b AS (SELECT DISTINCT wav FROM train_label WHERE wav IS NOT NULL), s AS (SELECT DISTINCT wav FROM manual_gt_example WHERE wav <> ''), m AS (SELECT video_id FROM documents WHERE video_id <> '' EXCEPT SELECT id FROM train_events)
SELECT 'clips' AS subset, (SELECT count(*) FROM s) AS ids, (SELECT count(*) FROM s ANTI JOIN b USING (wav)) AS missing, (SELECT min(wav) FROM s ANTI JOIN b USING (wav)) AS first UNION ALL
SELECT 'videos', (SELECT count(DISTINCT video_id) FROM documents WHERE video_id <> ''), (SELECT count(*) FROM m), (SELECT min(video_id) FROM m)""")
def subset_missing(spark: SparkSession, d: str) -> DataFrame:
    """Ids of two subsets that their bank doesn't have."""
    pairs = [("clips", table(spark, d, "manual_gt_example").select("wav"), table(spark, d, "train_label").select("wav"), "wav"), ("videos", table(spark, d, "documents").select("video_id"), table(spark, d, "train_events").select(F.col("id").alias("video_id")), "video_id")]
    out = None
    for name, subset, of, key in pairs:
        n = subset.where(F.col(key) != "").agg(F.countDistinct(key).alias("ids")).withColumn("subset", F.lit(name))
        m = scoring.not_in_bank(subset, of, key).agg(F.count("*").alias("missing"), F.min(key).alias("first")).withColumn("subset", F.lit(name))
        x = n.join(m, "subset").select("subset", "ids", "missing", "first")
        out = x if out is None else out.unionByName(x)
    return out


# entities and annotators
_GROUPS = f"n AS (SELECT {_SQ.format('alias')} AS alias, group_id FROM noun_alias_v1)"


def _staged(pairs: DataFrame, spark: SparkSession, d: str, fields: list[tuple[str, str, str]], keep: list[str]) -> DataFrame:
    """Rows (keep, field, stage): how the nouns of each pair agree."""
    n = table(spark, d, "noun_alias_v1").select(X.audit_text(F.col("alias")).alias("alias"), "group_id")
    x = pairs.select(*keep, F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(a).alias("l"), F.col(b).alias("r")) for f, a, b in fields])).alias("x")).select(*keep, "x.*")
    x = x.join(F.broadcast(n.select(F.col("alias").alias("l"), F.col("group_id").alias("lg"))), "l", "left").join(F.broadcast(n.select(F.col("alias").alias("r"), F.col("group_id").alias("rg"))), "r", "left")
    return x.select(*keep, "field", scoring.match_stage(F.col("l"), F.col("r"), F.col("lg"), F.col("rg")).alias("stage"))


@query(rf"""
WITH {_PAIRS}, {_GROUPS}, x AS (SELECT 'object' AS field, gold_object AS l, pred_object AS r FROM p UNION ALL SELECT 'subject', gold_subject, pred_subject FROM p),
s AS (SELECT field, CASE WHEN l IS NOT DISTINCT FROM r THEN 'strict' WHEN a.group_id = b.group_id THEN 'alias' END AS stage FROM x LEFT JOIN n a ON a.alias = l LEFT JOIN n b ON b.alias = r)
SELECT field, count(*) AS n, count(*) FILTER (stage = 'strict') AS strict_correct, round(count(*) FILTER (stage = 'strict') / count(*), 6) AS strict_accuracy, count(stage) AS alias_correct, round(count(stage) / count(*), 6) AS alias_accuracy,
  count(stage) AS resolved_correct, round(count(stage) / count(*), 6) AS resolved_accuracy, count(*) - count(stage) AS unresolved FROM s GROUP BY field""")
def entity_summary(spark: SparkSession, d: str) -> DataFrame:
    """Agreement of subjects and objects as written and through aliases."""
    x = _staged(_pairs(spark, d), spark, d, [("object", "gold_object", "pred_object"), ("subject", "gold_subject", "pred_subject")], ["gt_row_id"])
    return scoring.entity_summary(x, ["field"], "stage")


_AB = rf"""
d AS (SELECT gt_row_id, annotation.annotator_id AS who, trim(item_id) AS item_id, wav, gt FROM manual_gt_example WHERE {_DONE}),
k AS (SELECT gt_row_id, who, unnest([nullif(item_id, ''), nullif(trim(wav), ''), nullif(regexp_replace(regexp_extract(wav, '([^/]*)$', 1), '(.)\.[^.]*$', '\1'), '')]) AS key, unnest([1, 2, 3]) AS pos FROM d),
i AS (SELECT key, min(gt_row_id) AS r FROM k WHERE who = 'annotator_b' AND key IS NOT NULL GROUP BY key HAVING count(DISTINCT gt_row_id) = 1),
m AS (SELECT k.gt_row_id AS l, arg_min(i.r, pos) AS r FROM k JOIN i USING (key) WHERE who = 'annotator_a' GROUP BY k.gt_row_id),
v(verb, c) AS (VALUES {_CLASSES}), al(a, t) AS (VALUES ('drumming', 'tapping'), ('patting', 'tapping'), ('clacking', 'knocking'), ('leafing', 'page_turning'), ('sipping', 'chewing'), ('smouldering', 'simmering')),
t AS (SELECT gt_row_id, gt, regexp_replace(trim(lower(gt.verb)), '\s+', '_', 'g') AS tok FROM d),
x AS (SELECT gt_row_id, coalesce(al.t, v.verb) AS verb, coalesce(w.c, v.c) AS cls, {_SQ.format("gt.subject")} AS subject, {_SQ.format("gt.object")} AS object FROM t LEFT JOIN v ON v.verb = tok LEFT JOIN al ON al.a = tok LEFT JOIN v w ON w.verb = al.t),
p AS (SELECT a.verb AS lv, b.verb AS rv, a.cls AS lc, b.cls AS rc, a.subject AS ls, b.subject AS rs, a.object AS lo, b.object AS ro FROM m JOIN x a ON a.gt_row_id = m.l JOIN x b ON b.gt_row_id = m.r),
{_GROUPS}"""


def _kappa_sql(a: str, b: str) -> str:
    po = f"(SELECT avg(CAST({a} IS NOT DISTINCT FROM {b} AS INT)) FROM p)"
    pe = f"(SELECT coalesce(sum(x.n * y.n), 0) / (SELECT count(*) * count(*) FROM p) FROM (SELECT {a} AS z, count(*) AS n FROM p GROUP BY 1) x JOIN (SELECT {b} AS z, count(*) AS n FROM p GROUP BY 1) y ON x.z IS NOT DISTINCT FROM y.z)"
    return f"round({po}, 6), round(CASE WHEN abs(1 - {pe}) <= 1e-9 THEN CASE WHEN {po} >= 1 THEN 1 ELSE 0 END ELSE ({po} - {pe}) / (1 - {pe}) END, 6)"


def _noun_sql(a: str, b: str) -> str:
    return f"(SELECT round(avg(CAST({a} IS NOT DISTINCT FROM {b} AS INT)), 6) FROM p), (SELECT round(avg(CAST({a} IS NOT DISTINCT FROM {b} OR coalesce(g.group_id = h.group_id, false) AS INT)), 6) FROM p LEFT JOIN n g ON g.alias = {a} LEFT JOIN n h ON h.alias = {b})"


@query(f"""
WITH {_AB}, o(field, aligned, agreement, beyond) AS (SELECT 'verb', (SELECT count(*) FROM p), {_kappa_sql("lv", "rv")} UNION ALL SELECT 'superclass', (SELECT count(*) FROM p), {_kappa_sql("lc", "rc")}
  UNION ALL SELECT 'subject', (SELECT count(*) FROM p), {_noun_sql("ls", "rs")} UNION ALL SELECT 'object', (SELECT count(*) FROM p), {_noun_sql("lo", "ro")}) SELECT * FROM o""")
def annotator_agreement(spark: SparkSession, d: str) -> DataFrame:
    """Agreement of two annotators on the rows that match through unambiguous identifiers: exact and beyond chance (kappa) for
    verbs and their classes, as written and through aliases for nouns."""
    g = table(spark, d, "manual_gt_example").where(X.is_completed(F.col("annotation.status"), F.col("gt.subject"), F.col("gt.verb")))
    g = g.select("gt_row_id", "item_id", "wav", F.col("annotation.annotator_id").alias("who"), X.token(F.col("gt.verb")).alias("verb"), X.audit_text(F.col("gt.subject")).alias("subject"), X.audit_text(F.col("gt.object")).alias("object"))
    classes = _verb_classes(spark, d)
    canon = {v: VERB_ALIASES.get(v, v) for v in {*classes, *VERB_ALIASES}}
    look = lambda m, c: F.try_element_at(F.create_map(*[F.lit(x) for kv in sorted(m.items()) for x in kv]), c)
    g = cut(g.withColumn("verb", look(canon, F.col("verb"))).withColumn("cls", look(classes, F.col("verb"))))
    keys = matching.identifiers(F.col("item_id"), path=F.col("wav"))
    left, right = g.where("who = 'annotator_a'"), g.where("who = 'annotator_b'")
    m = matching.match_identifiers(left.withColumnRenamed("gt_row_id", "l"), "l", keys, right.withColumnRenamed("gt_row_id", "r"), "r", keys).where("r is not null").select("l", "r")
    cols = ["verb", "cls", "subject", "object"]
    p = cut(m.join(left.select(F.col("gt_row_id").alias("l"), *[F.col(c).alias(f"l_{c}") for c in cols]), "l").join(right.select(F.col("gt_row_id").alias("r"), *[F.col(c).alias(f"r_{c}") for c in cols]), "r"))
    out = None
    for name, c in (("verb", "verb"), ("superclass", "cls")):
        x = scoring.cohen_kappa(p.withColumn("field", F.lit(name)), ["field"], f"l_{c}", f"r_{c}").select("field", F.col("n").alias("aligned"), r6("observed").alias("agreement"), r6("kappa").alias("beyond"))
        out = x if out is None else out.unionByName(x)
    e = scoring.entity_summary(_staged(p, spark, d, [(c, f"l_{c}", f"r_{c}") for c in ("subject", "object")], ["l_verb"]), ["field"], "stage")
    return out.unionByName(e.select("field", F.col("n").alias("aligned"), F.col("strict_accuracy").alias("agreement"), F.col("alias_accuracy").alias("beyond")))
