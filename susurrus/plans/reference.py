"""Queries of the operators for timelines, labels, audits, question banks, scores and releases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import times as T
from ..operators import embeddings, matching, release, runlog, sampling, scoring, segmentation, timelines
from ..operators.packed import unpack
from ..operators.prefix import same
from ..operators.skew import hot_join
from ..sources.tables import cut, table

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def r6(x):
    return F.round(x, 6)


# questions and runs, derived from clips: gold and predictions are letters by hash
def _letter(h):
    return F.when(h < "4", "A").when(h < "8", "B").when(h < "c", "C").otherwise("D")


def _questions(spark: SparkSession, d: str) -> DataFrame:
    q = F.col("label_id").cast("string")
    opts = F.array(*[F.struct(F.lit(c).alias("label"), F.lit(c.lower()).alias("value"), F.lit("impact" if c in "AB" else "friction").alias("verb_class")) for c in "ABCD"])
    return table(spark, d, "train_label").select(
        q.alias("question_id"), F.element_at(F.array(*[F.lit(t) for t in scoring.TASKS]), (F.pmod("label_id", F.lit(3)) + 1).cast("int")).alias("task"), _letter(F.substring(F.md5(q), 1, 1)).alias("gold_label"), opts.alias("options")
    )


def _predictions(spark: SparkSession, d: str, runs: int = 3, kind: str = "") -> DataFrame:
    q = F.col("label_id").cast("string")
    x = table(spark, d, "train_label").select(q.alias("question_id"), F.explode(F.sequence(F.lit(1), F.lit(runs))).alias("run_id"))
    h = F.md5(F.concat_ws(":", F.lit(kind), F.col("run_id").cast("string"), "question_id"))
    return x.select("run_id", "question_id", _letter(F.substring(h, 1, 1)).alias("pred"), F.substring(h, 2, 1).alias("x")).where("x <> '0'").drop("x")


_L = "CASE WHEN {0} < '4' THEN 'A' WHEN {0} < '8' THEN 'B' WHEN {0} < 'c' THEN 'C' ELSE 'D' END"
_SCORED = f"""
q AS (SELECT CAST(label_id AS VARCHAR) AS question_id, ['verb_mc', 'subject_material_mc', 'object_material_mc'][CAST(label_id % 3 AS INT) + 1] AS task,
  {_L.format("substr(md5(CAST(label_id AS VARCHAR)), 1, 1)")} AS gold FROM train_label),
g AS (SELECT q.*, r.run_id, md5(concat_ws(':', '', CAST(r.run_id AS VARCHAR), question_id)) AS h FROM q, (SELECT unnest([1, 2, 3]) AS run_id) r),
p AS (SELECT *, CASE WHEN substr(h, 2, 1) <> '0' THEN {_L.format("substr(h, 1, 1)")} END AS pred FROM g),
s AS (SELECT run_id, task, CASE WHEN pred = gold THEN 1 ELSE 0 END AS ok, CASE WHEN task = 'verb_mc' THEN CASE WHEN (pred IN ('A', 'B')) = (gold IN ('A', 'B')) THEN 1 ELSE 0 END END AS cls FROM p),
t AS (SELECT run_id, task AS metric, avg(ok) AS value, count(*) AS n FROM s GROUP BY ALL),
m AS (SELECT * FROM t UNION ALL SELECT run_id, 'overall', avg(ok), count(*) FROM s GROUP BY run_id UNION ALL SELECT run_id, 'superclass', avg(cls), count(cls) FROM s GROUP BY run_id
  UNION ALL SELECT run_id, 'macro', avg(value), count(*) FROM t GROUP BY run_id)
"""


@query(f"WITH {_SCORED} SELECT metric, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, count(*) AS runs FROM m GROUP BY metric")
def mc_score_runs(spark: SparkSession, d: str) -> DataFrame:
    """Mean and deviation over three runs of the accuracy overall, by task, by superclass and macro."""
    x = scoring.average_runs(scoring.score_runs(_questions(spark, d), _predictions(spark, d)))
    return x.select("metric", r6("mean").alias("mean"), r6("std").alias("std"), "runs")


@query(f"WITH {_SCORED} SELECT run_id, metric, round(value, 6) AS value, n FROM m")
def mc_score_each_run(spark: SparkSession, d: str) -> DataFrame:
    """The same metrics of each run."""
    return scoring.score_runs(_questions(spark, d), _predictions(spark, d)).select("run_id", "metric", r6("value").alias("value"), "n")


def _votes_sql() -> str:
    return f"""
WITH q AS (SELECT CAST(label_id AS VARCHAR) AS question_id, {_L.format("substr(md5(CAST(label_id AS VARCHAR)), 1, 1)")} AS gold FROM train_label),
g AS (SELECT q.*, k.kind, r.run_id, md5(concat_ws(':', k.kind, CAST(r.run_id AS VARCHAR), question_id)) AS h FROM q, (SELECT unnest(['reference', 'silence']) AS kind) k, (SELECT unnest([1, 2, 3]) AS run_id) r),
v AS (SELECT question_id, kind, run_id, CAST({_L.format("substr(h, 1, 1)")} = gold AS INT) AS correct FROM g WHERE substr(h, 2, 1) <> '0')
SELECT question_id, CAST(sum(correct) FILTER (kind = 'reference') AS BIGINT) AS reference_votes, CAST(sum(correct) FILTER (kind = 'silence') AS BIGINT) AS silence_votes FROM v GROUP BY question_id
HAVING count(*) = 6 AND sum(correct) FILTER (kind = 'reference') >= 2 AND sum(correct) FILTER (kind = 'silence') <= 1"""


@query(_votes_sql())
def audio_subset_votes(spark: SparkSession, d: str) -> DataFrame:
    """Questions answered with the sound and not without it."""
    gold = _questions(spark, d).select("question_id", "gold_label")
    both = [_predictions(spark, d, 3, k).withColumn("kind", F.lit(k)) for k in ("reference", "silence")]
    votes = both[0].unionByName(both[1]).join(gold, "question_id").select("question_id", "run_id", "kind", (F.col("pred") == F.col("gold_label")).cast("int").alias("correct"))
    return scoring.vote_subset(votes, "kind", "correct")


@query("""
WITH s AS (SELECT label_id, unnest(['A', 'B', 'C', 'D']) AS letter FROM train_label),
v AS (SELECT label_id, letter, CASE WHEN substr(md5(concat(letter, ':', label_id)), 2, 1) = '0' THEN -1e9 ELSE -CAST(strpos('0123456789abcdef', substr(md5(concat(letter, ':', label_id)), 1, 1)) AS DOUBLE) END AS score FROM s)
SELECT label_id, CASE WHEN max(score) > -1e8 THEN arg_max(letter, score * 100 - strpos('ABCD', letter)) END AS best FROM v GROUP BY label_id""")
def best_letter(spark: SparkSession, d: str) -> DataFrame:
    """The letter of the greatest score, the first on ties."""
    s = table(spark, d, "train_label").select("label_id", F.posexplode(F.array(*[F.lit(c) for c in "ABCD"])).alias("rank", "letter"))
    h = F.md5(F.concat_ws(":", "letter", F.col("label_id").cast("string")))
    score = F.when(F.substring(h, 2, 1) == "0", F.lit(-1e9)).otherwise(-F.instr(F.lit("0123456789abcdef"), F.substring(h, 1, 1)).cast("double"))
    return scoring.best_letter(s.withColumn("score", score), "label_id", "letter", "score", "rank")


# timelines
@query(r"""
WITH t AS (SELECT line_id, video_id, pos, seconds, end_sec, str_split(trim(time_str), ':') AS p FROM timeline),
u AS (SELECT *, CASE len(p) WHEN 3 THEN TRY_CAST(p[1] AS INT) * 3600 + TRY_CAST(p[2] AS INT) * 60 + TRY_CAST(p[3] AS INT) WHEN 2 THEN TRY_CAST(p[1] AS INT) * 60 + TRY_CAST(p[2] AS INT) END AS mark FROM t),
v AS (SELECT *, coalesce(mark, CAST(seconds AS INT)) AS second FROM u),
w AS (SELECT line_id, video_id, second, coalesce(mark <> seconds, false) AS corrected, CAST(second AS DOUBLE) AS start,
  coalesce(CAST(lead(second) OVER (PARTITION BY video_id ORDER BY second, pos, line_id) AS DOUBLE), max(end_sec) OVER (PARTITION BY video_id)) AS till FROM v WHERE second IS NOT NULL)
SELECT line_id, video_id, second, corrected, start, CASE WHEN till >= start THEN till END AS "end" FROM w""")
def timeline_normalize(spark: SparkSession, d: str) -> DataFrame:
    """Canonical seconds, and ends from the next start; the last end is that of the track, none if it lies before the start."""
    t = table(spark, d, "timeline").withColumn("place", F.struct("pos", "line_id"))
    return timelines.normalize(t, "video_id", "place", "time_str", "seconds", "end_sec", strict=False).select("line_id", "video_id", "second", "corrected", "start", "end")


@query(r"""
WITH l AS (SELECT line_id, regexp_replace(concat(time_str, CASE WHEN line_id % 2 = 0 THEN ' - ' ELSE ' | ' END, title), '\s', ' ', 'g') AS line FROM timeline WHERE time_str IS NOT NULL AND title IS NOT NULL),
p AS (SELECT line_id, nullif(regexp_extract(line, '^\s*(\d{1,3}(?::\d{1,2}){1,2})(?:[^0-9]|$)', 1), '') AS mark, line FROM l),
q AS (SELECT line_id, mark, nullif(trim(regexp_replace(substr(line, strpos(line, mark) + length(mark)), '^\s*[-–—|:]?\s*', '')), '') AS title, str_split(mark, ':') AS s FROM p WHERE mark IS NOT NULL)
SELECT line_id, mark, title, CASE len(s) WHEN 3 THEN CAST(s[1] AS INT) * 3600 + CAST(s[2] AS INT) * 60 + CAST(s[3] AS INT) ELSE CAST(s[1] AS INT) * 60 + CAST(s[2] AS INT) END AS second FROM q""")
def timestamp_parse(spark: SparkSession, d: str) -> DataFrame:
    """Time mark, title and seconds of timeline lines."""
    sep = F.when(F.col("line_id") % 2 == 0, " - ").otherwise(" | ")
    line = F.regexp_replace(F.concat("time_str", sep, "title"), r"\s", " ")
    mark, title = T.timeline_line(line)
    x = table(spark, d, "timeline").where("time_str is not null and title is not null").select("line_id", mark.alias("mark"), X.none_if_empty(F.trim(title)).alias("title")).where("mark is not null")
    return x.withColumn("second", T.seconds_of(F.col("mark")))


@query(r"""
WITH g AS (SELECT id AS video_id, start_sec - lag(end_sec) OVER (PARTITION BY id ORDER BY start_sec, end_sec, event_uid) AS gap FROM train_events WHERE start_sec IS NOT NULL AND end_sec IS NOT NULL)
SELECT video_id, count(*) AS gaps, round(min(gap), 6) AS least, round(max(gap), 6) AS greatest, round(avg(gap), 6) AS mean FROM g WHERE gap IS NOT NULL GROUP BY video_id""")
def event_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Gaps between the events of a video, in order."""
    x = timelines.gaps(table(spark, d, "train_events").select(F.col("id").alias("video_id"), F.col("start_sec"), "end_sec", "event_uid"), ["video_id"], "start_sec", "end_sec")
    return x.select("video_id", "gaps", r6("least").alias("least"), r6("greatest").alias("greatest"), r6("mean").alias("mean"))


@query(r"""
SELECT line_id, CASE WHEN end_sec = floor(end_sec) THEN CAST(CAST(end_sec AS BIGINT) AS VARCHAR) ELSE rtrim(rtrim(printf('%.9f', end_sec), '0'), '.') END AS plain,
  printf('%d:%02d:%02d.%03d', CAST(floor(start_sec / 3600) AS BIGINT), CAST(floor(start_sec / 60) AS BIGINT) % 60, CAST(floor(start_sec) AS BIGINT) % 60, CAST(round(start_sec * 1000) AS BIGINT) % 1000) AS hms
FROM timeline WHERE start_sec IS NOT NULL AND end_sec IS NOT NULL""")
def time_formats(spark: SparkSession, d: str) -> DataFrame:
    """Seconds as plain numbers and as H:MM:SS.mmm."""
    return table(spark, d, "timeline").where("start_sec is not null and end_sec is not null").select("line_id", T.format_seconds(F.col("end_sec")).alias("plain"), T.hms(F.col("start_sec")).alias("hms"))


@query(r"""
WITH w AS (SELECT event_uid, start_sec AS lo, CASE WHEN end_sec > start_sec THEN end_sec - start_sec ELSE 0.05 END AS span FROM train_events WHERE start_sec IS NOT NULL AND end_sec IS NOT NULL),
m AS (SELECT *, greatest(1e-3, least(0.05, span * 0.05)) AS margin FROM w),
n AS (SELECT *, CASE WHEN 2.0 < span - margin THEN 2.0 ELSE greatest(margin, least(2.0, span / 2)) END AS near FROM m)
SELECT event_uid, round(lo + least(greatest(CASE WHEN near < span - margin THEN near ELSE span / 2 END, margin), span - margin), 6) AS point FROM n""")
def capture_points(spark: SparkSession, d: str) -> DataFrame:
    """A point two seconds into each event, inside it."""
    return table(spark, d, "train_events").where("start_sec is not null and end_sec is not null").select("event_uid", r6(T.capture_point(F.col("start_sec"), F.col("end_sec"), F.lit(2.0))).alias("point"))


@query(r"""
WITH e AS (SELECT id, label, group_method, clip_count, duration_sec FROM train_events),
g AS (SELECT id, label, count(*) AS n, bool_and(group_method IS NOT DISTINCT FROM 'ruptures') AS all_cut, bool_or(group_method IS NOT DISTINCT FROM 'ruptures') AS any_cut, sum(clip_count) AS clips FROM e GROUP BY id, label)
SELECT n AS size, count(*) AS groups, count(*) FILTER (all_cut) AS all_cut, count(*) FILTER (any_cut) AS any_cut, CAST(sum(clips) AS BIGINT) AS clips, round(avg(clips), 6) AS mean_clips FROM g GROUP BY n""")
def split_statistics(spark: SparkSession, d: str) -> DataFrame:
    """How often labels of a video are split into several events, by method."""
    cut = F.col("group_method").eqNullSafe("ruptures")
    g = table(spark, d, "train_events").groupBy("id", "label").agg(F.count("*").alias("n"), F.bool_and(cut).alias("all"), F.bool_or(cut).alias("any"), F.sum("clip_count").alias("clips"))
    return g.groupBy(F.col("n").alias("size")).agg(F.count("*").alias("groups"), F.count_if("all").alias("all_cut"), F.count_if("any").alias("any_cut"), F.sum("clips").alias("clips"), r6(F.avg("clips")).alias("mean_clips"))


# labels
@query(r"""
WITH e AS (SELECT event_uid, lower(coalesce(label, '')) AS l, coalesce(label, '') AS raw FROM train_events)
SELECT event_uid, NOT contains(l, 'mixed beeswax soup') AND (contains(l, 'preview') OR contains(l, 'intro') OR contains(l, 'combination') OR (contains(l, 'mix') AND NOT contains(l, 'mixing'))) AS blocked,
  contains(raw, '+') OR contains(raw, '&') AS parallel FROM e""")
def blocked_filter(spark: SparkSession, d: str) -> DataFrame:
    """Blocked and parallel labels."""
    return table(spark, d, "train_events").select("event_uid", X.is_blocked(F.col("label")).alias("blocked"), X.is_parallel(F.col("label")).alias("parallel"))


_SQ = r"nullif(trim(regexp_replace(lower(replace({0}, '_', ' ')), '\s+', ' ', 'g')), '')"


def _noun_sql(x: str) -> str:
    t = _SQ.format(x)
    return f"CASE WHEN contains({t}, '3dio') THEN '3dio mic' WHEN {t} IN ('mic', 'mics', 'microphone', 'microphones') THEN 'mic' WHEN {t} IN ('hand', 'left hand', 'right hand', 'human hand') THEN 'hands' WHEN {t} = 'finger' THEN 'fingers' WHEN {t} = 'nail' THEN 'nails' WHEN {t} = 'fingernail' THEN 'fingernails' ELSE {t} END"


_EAR = r"\y(silicone|binaural|3dio|mannequin|dummy head|ear model|ear replica|ear-shaped)\y".replace(r"\y", r"\b")


@query(rf"""
WITH n AS (SELECT label_id, object AS raw, concat(coalesce(seg_label, ''), ' ', coalesce(title, '')) AS ctx, {_noun_sql("object")} AS noun FROM train_label),
c AS (SELECT *, trim(regexp_replace(regexp_replace(noun, '\b(red|blue|green|pink|purple|black|white|yellow|orange|teal|amber|golden|silver|metallic|glittery)\b', '', 'gi'), '\s+', ' ', 'g')) AS plain FROM n),
t AS (SELECT *, CASE WHEN regexp_matches(plain, 'ear pick|earpick|ear stick|ear cleaner|ear cleaning') THEN
    CASE WHEN regexp_matches(plain, 'bamboo|wood') THEN 'wooden tool' WHEN regexp_matches(plain, 'metal|spring|steel') THEN 'metal tool' WHEN contains(plain, 'plastic') THEN 'plastic tool' WHEN regexp_matches(plain, 'cotton|fluffy|swab') THEN 'cotton tool' WHEN regexp_matches(plain, 'silicone|rubber') THEN 'silicone tool' ELSE 'metal tool' END
  WHEN contains(plain, 'tweezer') THEN 'metal tool' WHEN contains(plain, 'spoolie') THEN 'plastic tool' WHEN regexp_matches(plain, 'cotton swab|cotton tip') THEN 'cotton swab'
  WHEN regexp_matches(plain, ' brush$| brushes$|paint brush|makeup brush|hairbrush') THEN CASE WHEN contains(plain, 'wood') THEN 'wooden brush' ELSE 'brush' END
  WHEN contains(plain, 'fork') AND contains(plain, 'brush') THEN 'brush' ELSE plain END AS tool FROM c),
e AS (SELECT *, CASE WHEN tool IN ('ear', 'ears', 'left ear', 'right ear', 'ear canal', 'eardrum') AND (regexp_matches(ctx, '{_EAR}', 'i') OR regexp_matches(lower(ctx), 'ear cleaning|silicone')) THEN CASE tool WHEN 'ears' THEN 'silicone ears' ELSE 'silicone ear' END
  WHEN tool IN ('earpod', 'earpods', 'earphone', 'earphones', 'earbud', 'earbuds', 'earphone mic') THEN CASE WHEN regexp_matches(ctx, '{_EAR}', 'i') THEN 'silicone ear' ELSE 'mic' END
  WHEN contains(tool, 'crystal ear') THEN 'glass ear' WHEN contains(tool, 'wooden ear') THEN 'wooden ear' WHEN regexp_matches(tool, 'dummy head|wooden head') THEN 'silicone ear' ELSE tool END AS heard FROM t),
w AS (SELECT *, replace(heard, 'sealing wax', 'wax') AS waxed FROM e),
z AS (SELECT *, {_noun_sql("waxed")} AS again FROM w)
SELECT label_id, noun, CASE WHEN lower(trim(raw)) = 'fail' THEN 'fail' WHEN contains(again, 'recorder') AND NOT contains(again, 'mic') THEN 'mic' ELSE again END AS phrase FROM z""")
def noun_normalize(spark: SparkSession, d: str) -> DataFrame:
    """Nouns in their normal form, and the whole phrase pipeline with the label and title around."""
    return table(spark, d, "train_label").select("label_id", X.noun(F.col("object")).alias("noun"), X.noun_phrase(F.col("object"), F.col("seg_label"), F.col("title")).alias("phrase"))


@query(r"""
SELECT label_id, coalesce(regexp_replace(trim(lower(verb)), '\s+', '_', 'g'), '') AS token, concat_ws('__', 'vb', coalesce(nullif(trim(regexp_replace(lower(subject), '[^a-z0-9]+', '-', 'g'), '-'), ''), '_'), coalesce(nullif(trim(regexp_replace(lower(object), '[^a-z0-9]+', '-', 'g'), '-'), ''), '_')) AS group_id,
  CASE WHEN regexp_matches(w, '.ies$') THEN regexp_replace(w, 'ies$', 'y') WHEN regexp_matches(w, '.es$') THEN regexp_replace(w, 'es$', '') WHEN regexp_matches(w, '[^s]s$') THEN regexp_replace(w, 's$', '') ELSE w END AS singular
FROM (SELECT *, lower(object) AS w FROM train_label)""")
def text_keys(spark: SparkSession, d: str) -> DataFrame:
    """Tokens, group ids from slugs, singulars."""
    return table(spark, d, "train_label").select("label_id", X.token(F.col("verb")).alias("token"), X.group_id("vb", F.col("subject"), F.col("object")).alias("group_id"), X.singular(F.lower("object")).alias("singular"))


@query(r"""
WITH f AS (SELECT label_id, [CASE WHEN lower(trim(subject)) <> 'fail' AND trim(subject) <> '' THEN trim(subject) END, CASE WHEN lower(trim(verb)) <> 'fail' AND trim(verb) <> '' THEN trim(verb) END, CASE WHEN lower(trim(object)) <> 'fail' AND trim(object) <> '' THEN trim(object) END] AS p, caption FROM train_label)
SELECT label_id, nullif(array_to_string(list_filter(p, lambda x: x IS NOT NULL), ' '), '') AS built, coalesce(nullif(trim(caption), ''), nullif(array_to_string(list_filter(p, lambda x: x IS NOT NULL), ' '), '')) AS kept FROM f""")
def captions(spark: SparkSession, d: str) -> DataFrame:
    """Captions from filled parts, and with an existing caption preferred."""
    built = X.caption(F.col("subject"), F.col("verb"), F.col("object"))
    return table(spark, d, "train_label").select("label_id", built.alias("built"), F.coalesce(X.none_if_empty(X.stripped(F.col("caption"))), built).alias("kept"))


#: Aliases of verbs outside the class table, for the queries below.
VERB_ALIASES = {"drumming": "tapping", "patting": "tapping", "clacking": "knocking", "leafing": "page_turning", "sipping": "chewing", "smouldering": "simmering"}


def _lexicon(spark: SparkSession, d: str) -> DataFrame:
    cells = table(spark, d, "asmr_verb_classes_en").withColumn("source", F.lit("verbs"))
    one = cells.select("verb_class", "verbs", "source")
    split = unpack(one, "source", "verbs", ["verb_class"], least_values=1)
    lex = split.select(X.token(F.col("val")).alias("verb"), "verb_class")
    return lex.where("verb not in ('" + "', '".join(VERB_ALIASES) + "')")


_LEX = """
lex AS (SELECT unnest(['puffing', 'snapping', 'crushing', 'crumbling', 'crinkling', 'rustling', 'folding,_paper', 'slicing', 'shaving,_soap', 'filing', 'knocking', 'thumping', 'simmering', 'typing', 'clicking', 'pouring', 'dripping', 'spraying_"mist"', 'humming', 'chewing', 'tongue_clicking',
 'page_turning', 'card_shuffling', 'shaking', 'rattling', 'jingling', 'scratching', 'stroking', 'brushing,_dry', 'sweeping', 'wiping', 'lathering', 'smearing', 'tapping', 'squeezing', 'kneading', 'pressing', 'stirring', 'whisking', 'swirling']) AS verb),
ali AS (SELECT unnest(['drumming', 'patting', 'clacking', 'leafing', 'sipping', 'smouldering']) AS alias, unnest(['tapping', 'tapping', 'knocking', 'page_turning', 'chewing', 'simmering']) AS target)
"""


@query(rf"""
WITH {_LEX}, v AS (SELECT label_id, coalesce(regexp_replace(trim(lower(verb)), '\s+', '_', 'g'), '') AS t FROM train_label)
SELECT label_id, coalesce(lex.verb, ali.target) AS verb, CASE WHEN t IN ('', 'fail') THEN 'missing' WHEN lex.verb IS NOT NULL THEN 'lexicon' WHEN ali.target IS NOT NULL THEN 'alias' ELSE 'unmapped' END AS verb_source
FROM v LEFT JOIN lex ON lex.verb = t LEFT JOIN ali ON ali.alias = t""")
def verb_resolve(spark: SparkSession, d: str) -> DataFrame:
    """Verbs in the closed set, through the lexicon, else through an alias, with where they came from."""
    lex = F.broadcast(_lexicon(spark, d).select(F.col("verb").alias("known")))
    aliases = F.broadcast(spark.createDataFrame(list(VERB_ALIASES.items()), "alias string, target string"))
    x = table(spark, d, "train_label").select("label_id", X.token(F.col("verb")).alias("t"))
    x = x.join(lex, F.col("t") == F.col("known"), "left").join(aliases, F.col("t") == F.col("alias"), "left")
    source = F.when(F.col("t").isin("", "fail"), "missing").when(F.col("known").isNotNull(), "lexicon").when(F.col("target").isNotNull(), "alias").otherwise("unmapped")
    return x.select("label_id", F.coalesce("known", "target").alias("verb"), source.alias("verb_source"))


def _exported(spark: SparkSession, d: str) -> DataFrame:
    """Clips with the reason why they are left out; the first of equal (wav, subject, verb, object) is kept."""
    t = table(spark, d, "train_label")
    verb = X.token(F.col("verb"))
    why = F.when(verb == "", "missing_verb").when(X.is_fail(F.col("subject")) | X.is_fail(F.col("object")), "noun_failed").when(F.col("rn") > 1, "duplicate")
    w = Window.partitionBy("wav", "subject", verb, "object").orderBy("exported_at", "label_id")
    return t.withColumn("rn", F.row_number().over(w)).select("label_id", "wav", "subject", verb.alias("verb"), "object", why.alias("reason"))


_EXPORT = r"""
e AS (SELECT label_id, wav, subject, object, coalesce(regexp_replace(trim(lower(verb)), '\s+', '_', 'g'), '') AS verb, exported_at FROM train_label),
x AS (SELECT *, row_number() OVER (PARTITION BY wav, subject, verb, object ORDER BY exported_at, label_id) AS rn FROM e),
y AS (SELECT label_id, wav, subject, verb, object, CASE WHEN verb = '' THEN 'missing_verb' WHEN lower(trim(subject)) = 'fail' OR lower(trim(object)) = 'fail' THEN 'noun_failed' WHEN rn > 1 THEN 'duplicate' END AS reason FROM x)
"""


@query(f"WITH {_EXPORT} SELECT label_id, wav, subject, verb, object FROM y WHERE reason IS NULL")
def label_export(spark: SparkSession, d: str) -> DataFrame:
    """Clips fit for export, without repetitions."""
    return _exported(spark, d).where("reason is null").drop("reason")


@query(f"WITH {_EXPORT} SELECT coalesce(reason, 'kept') AS reason, count(*) AS n, count(DISTINCT (subject, verb, object)) AS triples FROM y GROUP BY ALL")
def skip_reason_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows by reason, and distinct triples."""
    return _exported(spark, d).groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"), F.countDistinct(F.struct("subject", "verb", "object")).alias("triples"))


@query(r"""
WITH v AS (SELECT 'verb' AS field, nullif(trim(verb), '') AS value FROM segment_label_parse UNION ALL SELECT 'subject', nullif(trim(subject), '') FROM segment_label_parse UNION ALL SELECT 'object', nullif(trim(object), '') FROM segment_label_parse)
SELECT field, value, count(*) AS n, row_number() OVER (PARTITION BY field ORDER BY count(*) DESC, lower(value), value) AS place FROM v WHERE value IS NOT NULL GROUP BY field, value""")
def value_frequency(spark: SparkSession, d: str) -> DataFrame:
    """Values of three fields by frequency, in one pass."""
    t = table(spark, d, "segment_label_parse")
    x = t.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), X.none_if_empty(F.trim(f)).alias("value")) for f in ("verb", "subject", "object")])).alias("x")).select("x.*").where("value is not null")
    w = Window.partitionBy("field").orderBy(F.desc("n"), F.lower("value"), "value")
    return x.groupBy("field", "value").agg(F.count("*").alias("n")).withColumn("place", F.row_number().over(w))


# runs
#: The reasons written out once more for the SQL side.
_NEEDLES = """
WHEN regexp_matches(t, 'rate limit|too many requests|http 429|status 429|quota exceeded') THEN 'rate_limit'
WHEN regexp_matches(t, 'timed out|timeout|deadline exceeded') THEN 'timeout'
WHEN regexp_matches(t, 'connection (reset|refused|aborted)|temporary failure in name resolution|name or service not known|network is unreachable|remote end closed|http 50[234]') THEN 'network'
WHEN regexp_matches(t, 'unauthorized|forbidden|http 40[13]|sign in|cookie') THEN 'authentication'
WHEN regexp_matches(t, 'video unavailable|private video|removed|not available|members-only|age-restricted') THEN 'source_unavailable'
WHEN regexp_matches(t, 'video too long|duration exceeds|too long|maximum duration') THEN 'source_too_long'
WHEN regexp_matches(t, 'ffmpeg|ffprobe|decode|invalid data found|unsupported codec') THEN 'media_processing'
WHEN regexp_matches(t, 'no such file|not found|missing audio|missing image|不存在') THEN 'missing_input'
WHEN regexp_matches(t, 'no space left|disk quota|read-only file system') THEN 'storage'
WHEN regexp_matches(t, 'invalid input|invalid url|parse error|jsondecodeerror|缺少有效') THEN 'invalid_input'
WHEN regexp_matches(t, 'api error|internal server error|service unavailable|bad gateway') THEN 'api_error'
"""


@query(rf"""
WITH s AS (SELECT coalesce(origin, 'none') AS stage, CASE WHEN source = 'issue_tracker' THEN 'failed' ELSE 'success' END AS status, lower(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')) AS t FROM documents)
SELECT stage, status, CASE WHEN status = 'failed' THEN CASE {_NEEDLES} ELSE 'unknown' END END AS reason, count(*) AS n FROM s GROUP BY ALL""")
def failure_classify(spark: SparkSession, d: str) -> DataFrame:
    """Documents by origin and status, those of the issue tracker (as failed runs) by the reason that their whole text tells."""
    t = table(spark, d, "documents").select(F.col("text").alias("detail"), F.when(F.col("source") == "issue_tracker", "failed").otherwise("success").alias("status"), F.coalesce("origin", F.lit("none")).alias("stage"), F.lit(None).cast("string").alias("given"))
    return runlog.summary(runlog.with_reason(t, "status", "given", "detail"), "stage", "status")


@query(r"""
SELECT suite AS stage, CAST(sum(length(text)) AS BIGINT) AS prompt, CAST(sum(length(text) // 4) AS BIGINT) AS completion, count(*) AS calls FROM eval_item GROUP BY ROLLUP (suite)""")
def usage_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Usage by stage and in all, in one rollup."""
    t = table(spark, d, "eval_item").select(F.col("suite").alias("stage"), F.length("text").cast("long").alias("prompt"), F.floor(F.length("text") / 4).alias("completion"))
    return runlog.usage(t, "stage", ["prompt", "completion"])


# joins
@query(r"""
WITH l AS (SELECT gt_row_id, [wav, regexp_replace(regexp_extract(wav, '([^/]*)$', 1), '(.)\.[^.]*$', '\1')] AS ks FROM manual_gt_example),
r AS (SELECT event_uid, unnest(segments).audio_path AS wav FROM train_events),
i AS (SELECT key, min(event_uid) AS event_uid FROM (SELECT event_uid, wav AS key FROM r UNION ALL SELECT event_uid, regexp_replace(regexp_extract(wav, '([^/]*)$', 1), '(.)\.[^.]*$', '\1') FROM r) WHERE key <> '' GROUP BY key HAVING count(DISTINCT event_uid) = 1),
e AS (SELECT gt_row_id, unnest(ks) AS key, unnest([1, 2]) AS pos FROM l)
SELECT l.gt_row_id, b.event_uid, b.key FROM l LEFT JOIN (SELECT e.gt_row_id, e.key, i.event_uid FROM e JOIN i USING (key) QUALIFY row_number() OVER (PARTITION BY e.gt_row_id ORDER BY pos) = 1) b USING (gt_row_id)""")
def identifier_match(spark: SparkSession, d: str) -> DataFrame:
    """Annotation rows matched to events through paths, else stems; ambiguous keys match nothing."""
    left = table(spark, d, "manual_gt_example").select("gt_row_id", "wav")
    right = table(spark, d, "train_events").select("event_uid", F.explode("segments").alias("s")).select("event_uid", F.col("s.audio_path").alias("p"))
    return matching.match_identifiers(left, "gt_row_id", matching.identifiers(path=F.col("wav")), right, "event_uid", matching.identifiers(path=F.col("p")))


@query(r"""
SELECT t.line_id, s.seg_id FROM timeline t JOIN segment_label_parse s ON t.video_id = s.video_id AND abs(t.start_sec - s.start_sec) <= 0.51 AND abs(t.end_sec - s.end_sec) <= 0.51""")
def interval_match(spark: SparkSession, d: str) -> DataFrame:
    """Timeline lines and windows with nearly equal bounds."""
    a = table(spark, d, "timeline").select("line_id", "video_id", F.col("start_sec").alias("start"), F.col("end_sec").alias("end"))
    b = table(spark, d, "segment_label_parse").select("seg_id", "video_id", F.col("start_sec").alias("start"), F.col("end_sec").alias("end"))
    return matching.match_intervals(a, b, ["video_id"]).select("line_id", F.col("r_seg_id").alias("seg_id"))


@query(r"""
WITH i AS (SELECT video_id AS id, 1 AS timeline, 0 AS events, 0 AS documents FROM timeline UNION ALL SELECT id, 0, 1, 0 FROM train_events UNION ALL SELECT video_id, 0, 0, 1 FROM documents),
p AS (SELECT id, max(timeline) AS timeline, max(events) AS events, max(documents) AS documents FROM i WHERE id IS NOT NULL GROUP BY id)
SELECT *, timeline + events + documents AS n FROM p""")
def presence_report(spark: SparkSession, d: str) -> DataFrame:
    """In which tables each video is."""
    return matching.presence({"timeline": table(spark, d, "timeline").select("video_id"), "events": table(spark, d, "train_events").select("id"), "documents": table(spark, d, "documents").select("video_id")})


@query("SELECT event_uid, id FROM train_events e WHERE NOT EXISTS (SELECT 1 FROM segment_label_parse s WHERE s.video_id = e.id AND s.clean_detected)")
def anti_prune(spark: SparkSession, d: str) -> DataFrame:
    """Events of videos without a detected window."""
    return table(spark, d, "train_events").select("event_uid", "id").join(table(spark, d, "segment_label_parse").where("clean_detected").select(F.col("video_id").alias("id")), "id", "left_anti")


@query(r"""
SELECT o_custkey, count(*) AS orders FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') GROUP BY o_custkey""")
def semi_and_anti(spark: SparkSession, d: str) -> DataFrame:
    """Orders of customers in credit, without a returned line: a semi and an anti join."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    r = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return o.join(c, "o_custkey", "left_semi").join(r, "o_orderkey", "left_anti").groupBy("o_custkey").agg(F.count("*").alias("orders"))


# audits
def _pairs(spark: SparkSession, d: str) -> DataFrame:
    """Annotations that count with the clip's label: gold and predicted verb and object."""
    g = table(spark, d, "manual_gt_example").where(X.is_completed(F.col("annotation.status"), F.col("gt.subject"), F.col("gt.verb")))
    g = g.select("gt_row_id", "item_id", "wav", F.col("annotation.annotator_id").alias("annotator"), X.token(F.col("gt.verb")).alias("gold"), X.audit_text(F.col("gt.object")).alias("gold_object"), X.audit_text(F.col("gt.subject")).alias("gold_subject"))
    # the first label of a clip, by a reduction with a map-side combine
    p = table(spark, d, "train_label").where("wav is not null").groupBy("wav").agg(F.min_by(F.struct("verb", "object", "subject"), "label_id").alias("x"))
    return g.join(p.select("wav", X.token(F.col("x.verb")).alias("pred"), X.audit_text(F.col("x.object")).alias("pred_object"), X.audit_text(F.col("x.subject")).alias("pred_subject")), "wav")


_DONE = f"coalesce({_SQ.format('annotation.status')}, '') NOT IN ('pending', 'skip', 'skipped', 'invalid', 'excluded') AND {_SQ.format('gt.subject')} IS NOT NULL AND {_SQ.format('gt.verb')} IS NOT NULL"
_PAIRS = rf"""
g AS (SELECT gt_row_id, item_id, wav, annotation.annotator_id AS annotator, coalesce(regexp_replace(trim(lower(gt.verb)), '\s+', '_', 'g'), '') AS gold, {_SQ.format("gt.object")} AS gold_object, {_SQ.format("gt.subject")} AS gold_subject FROM manual_gt_example WHERE {_DONE}),
l AS (SELECT wav, coalesce(regexp_replace(trim(lower(verb)), '\s+', '_', 'g'), '') AS pred, {_SQ.format("object")} AS pred_object, {_SQ.format("subject")} AS pred_subject FROM train_label WHERE wav IS NOT NULL QUALIFY row_number() OVER (PARTITION BY wav ORDER BY label_id) = 1),
p AS (SELECT * FROM g JOIN l USING (wav))
"""
_F1 = _PAIRS + r""",
s AS (SELECT gold AS label, count(*) AS support, count(*) FILTER (gold = pred) AS hit FROM p GROUP BY gold),
q AS (SELECT pred AS label, count(*) AS said FROM p GROUP BY pred),
f AS (SELECT label, support, CASE WHEN coalesce(said, 0) > 0 THEN hit / said ELSE 0 END AS precision, hit / support AS recall FROM s LEFT JOIN q USING (label)),
h AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM f)
"""


@query(f"WITH {_F1} SELECT label, support, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM h")
def label_prf(spark: SparkSession, d: str) -> DataFrame:
    """Precision, recall and F1 of every verb."""
    x = scoring.label_metrics(_pairs(spark, d), "gold", "pred")
    return x.select("label", "support", *[r6(c).alias(c) for c in ("precision", "recall", "f1")])


@query(f"WITH {_F1} SELECT round(avg(f1), 6) AS macro_f1, count(*) AS labels, (SELECT round(avg(CAST(gold_object IS NOT DISTINCT FROM pred_object AS INT)), 6) FROM p) AS object_accuracy FROM h")
def macro_f1(spark: SparkSession, d: str) -> DataFrame:
    """Macro F1 of verbs and null-safe accuracy of objects."""
    pairs = _pairs(spark, d)
    f = scoring.label_metrics(pairs, "gold", "pred").agg(r6(F.avg("f1")).alias("macro_f1"), F.count("*").alias("labels"))
    a = scoring.accuracy(pairs, "gold_object", "pred_object").select(r6("accuracy").alias("object_accuracy"))
    return f.withColumn("k", F.lit(1)).join(a.withColumn("k", F.lit(1)), "k").drop("k")


@query(rf"""
WITH {_PAIRS}, n AS (SELECT trim(lower(alias)) AS alias, group_id FROM noun_alias_v1)
SELECT p.gt_row_id, CASE WHEN gold_object IS NOT DISTINCT FROM pred_object THEN 'strict' WHEN a.group_id = b.group_id THEN 'alias' END AS stage FROM p LEFT JOIN n a ON a.alias = gold_object LEFT JOIN n b ON b.alias = pred_object""")
def noun_match_stage(spark: SparkSession, d: str) -> DataFrame:
    """Whether objects agree as written or through one alias group."""
    n = table(spark, d, "noun_alias_v1").select(X.audit_text(F.col("alias")).alias("alias"), "group_id")
    a, b = F.broadcast(n.select(F.col("alias").alias("gold_object"), F.col("group_id").alias("g1"))), F.broadcast(n.select(F.col("alias").alias("pred_object"), F.col("group_id").alias("g2")))
    x = _pairs(spark, d).join(a, "gold_object", "left").join(b, "pred_object", "left")
    return x.select("gt_row_id", F.when(F.col("gold_object").eqNullSafe(F.col("pred_object")), "strict").when(F.col("g1") == F.col("g2"), "alias").alias("stage"))


@query(rf"""
WITH {_PAIRS}, k AS (SELECT annotator, gold AS l, pred AS r FROM p),
c AS (SELECT annotator, l, r, count(*) AS n FROM k GROUP BY ALL),
w AS (SELECT annotator, sum(n) AS n, sum(n) FILTER (l = r) AS same FROM c GROUP BY annotator),
a AS (SELECT annotator, l AS x, sum(n) AS a FROM c GROUP BY ALL), b AS (SELECT annotator, r AS x, sum(n) AS b FROM c GROUP BY ALL),
h AS (SELECT annotator, sum(a * b) AS ab FROM a JOIN b USING (annotator, x) GROUP BY annotator),
z AS (SELECT annotator, CAST(n AS BIGINT) AS n, coalesce(same, 0) / n AS po, coalesce(ab, 0) / (n * n) AS pe FROM w LEFT JOIN h USING (annotator))
SELECT annotator, n, round(po, 6) AS observed, round(pe, 6) AS expected, round(CASE WHEN abs(1 - pe) <= 1e-9 THEN CASE WHEN po >= 1 THEN 1 ELSE 0 END ELSE (po - pe) / (1 - pe) END, 6) AS kappa FROM z""")
def cohen_kappa(spark: SparkSession, d: str) -> DataFrame:
    """Agreement beyond chance of each annotator with the clips' verbs."""
    x = scoring.cohen_kappa(_pairs(spark, d), ["annotator"], "gold", "pred")
    return x.select("annotator", "n", *[r6(c).alias(c) for c in ("observed", "expected", "kappa")])


# samples and releases
@query(r"""
WITH v AS (SELECT label_id, coalesce(regexp_replace(trim(lower(verb)), '\s+', '_', 'g'), '') AS verb FROM train_label WHERE verb IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY verb ORDER BY md5(concat('7:', label_id)), label_id) AS turn FROM v)
SELECT label_id, verb, turn FROM r ORDER BY turn, md5(concat('7:', verb)), md5(concat('7:', label_id)) LIMIT 206""")
def stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    """206 clips, drawn from the verbs in turn."""
    t = table(spark, d, "train_label").where("verb is not null").select("label_id", X.token(F.col("verb")).alias("verb"))
    return sampling.round_robin(t, "verb", "label_id", 206, 7)


@query(r"""
WITH a AS (SELECT DISTINCT regexp_replace(author, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') AS author FROM train_label WHERE author IS NOT NULL)
SELECT author, concat('creator_', CASE WHEN k < 10 THEN '0' ELSE '' END, k) AS creator_id FROM (SELECT author, row_number() OVER (ORDER BY author) AS k FROM a WHERE author <> '')""")
def creator_ids(spark: SparkSession, d: str) -> DataFrame:
    """Pseudonyms of the authors."""
    return release.creator_ids(table(spark, d, "train_label"), "author")


@query("SELECT wav, count(DISTINCT split) AS splits, count(*) AS rows FROM manual_gt_example WHERE wav IS NOT NULL GROUP BY wav HAVING count(DISTINCT split) > 1 OR count(*) > 1")
def split_leaks(spark: SparkSession, d: str) -> DataFrame:
    """Clips repeated within or across splits."""
    return release.split_leaks(table(spark, d, "manual_gt_example"), "split", "wav")


@query(r"""
WITH RECURSIVE o AS (SELECT doc_id, coalesce(n_chars, 0) AS size, row_number() OVER (ORDER BY doc_id) AS k FROM documents),
f AS (SELECT k, doc_id, size, size AS filled, 0 AS shard FROM o WHERE k = 1 UNION ALL
  SELECT o.k, o.doc_id, o.size, CASE WHEN f.filled + o.size > 20000 THEN o.size ELSE f.filled + o.size END, CASE WHEN f.filled + o.size > 20000 THEN f.shard + 1 ELSE f.shard END FROM f JOIN o ON o.k = f.k + 1)
SELECT doc_id, CAST(shard AS BIGINT) AS shard FROM f""")
def greedy_shards(spark: SparkSession, d: str) -> DataFrame:
    """Documents in shards of up to 20,000 characters."""
    return release.greedy_shards(table(spark, d, "documents").select("doc_id", F.coalesce("n_chars", F.lit(0)).alias("size")), ["doc_id"], "size", 20_000).select("doc_id", "shard")


@query(r"""
WITH t AS (SELECT *, regexp_replace(author, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') AS who FROM train_label), n AS (SELECT who, row_number() OVER (ORDER BY who) AS k FROM (SELECT DISTINCT who FROM t WHERE who <> ''))
SELECT label_id, trim(regexp_replace(replace(regexp_replace(regexp_extract(wav, '([^/]*)$', 1), '\.[^./]*$', ''), '/', '__'), '[^A-Za-z0-9._-]+', '_', 'g'), '_') AS audio_id, caption, verb, subject, object,
  CASE WHEN k IS NULL THEN 'creator_unknown' ELSE concat('creator_', CASE WHEN k < 10 THEN '0' ELSE '' END, k) END AS creator_id FROM t LEFT JOIN n USING (who)""")
def release_rows(spark: SparkSession, d: str) -> DataFrame:
    """Public columns with pseudonyms; private ones are dropped."""
    t = table(spark, d, "train_label").withColumn("author", X.stripped(F.col("author")))
    ids = cut(release.creator_ids(t, "author"))
    return hot_join(t, ids, "author").select("label_id", X.audio_id(F.col("wav")).alias("audio_id"), "caption", "verb", "subject", "object", F.coalesce("creator_id", F.lit("creator_unknown")).alias("creator_id"))


# segments
@query(r"""
WITH f AS (SELECT user_id, (row_number() OVER w) - 1 AS first, avg(value) OVER a AS mean, sqrt(var_pop(value) OVER a + 1e-8) AS std, count(value) OVER a AS n FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id), a AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING))
SELECT user_id, CAST(first AS INT) AS first, CAST(first + 4 AS INT) AS center, round(mean, 6) AS mean, round(std, 6) AS std FROM f WHERE n = 8 AND first % 4 = 0""")
def sliding_stats(spark: SparkSession, d: str) -> DataFrame:
    """Mean and deviation over every fourth full window of eight events."""
    return segmentation.sliding(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], "value", 8, 4).select("user_id", "first", "center", r6("mean").alias("mean"), r6("std").alias("std"))


@query(r"""
WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.5) AS b, quantile_cont(value, 0.75) AS c FROM events GROUP BY event_type)
SELECT event_id, round((value - b) / (c - a + 1e-8), 6) AS scaled FROM events JOIN q USING (event_type)""")
def robust_scale(spark: SparkSession, d: str) -> DataFrame:
    """Values scaled by median and quartiles of their type."""
    return segmentation.robust_scale(table(spark, d, "events"), ["event_type"], "value").select("event_id", r6("scaled").alias("scaled"))


@query()
def change_points(spark: SparkSession, d: str) -> DataFrame:
    """Segments of each user's values between change points."""
    return segmentation.change_points(table(spark, d, "events"), "user_id", ["ts", "event_id"], ["value"])


@query(r"""
WITH g AS (SELECT id AS video_id, min(start_sec) AS lo, max(end_sec) AS hi FROM train_events WHERE start_sec IS NOT NULL AND end_sec IS NOT NULL GROUP BY id HAVING max(end_sec) > min(start_sec)),
w AS (SELECT *, CAST(greatest(1, ceil((hi - lo) / 2)) AS INT) AS n FROM g),
s AS (SELECT DISTINCT video_id, lo, hi, n, CAST(floor((start_sec - lo) / 2) AS INT) AS b FROM train_events JOIN w ON video_id IS NOT DISTINCT FROM id WHERE start_sec IS NOT NULL AND end_sec IS NOT NULL),
l AS (SELECT video_id, lo, hi, n, list_sort(list_distinct(list_append(list_prepend(0, coalesce(list(b) FILTER (b > 0 AND b < n), [])), n))) AS bs FROM s GROUP BY video_id, lo, hi, n),
m AS (SELECT video_id, lo, hi, n, list_reduce(list_transform(bs[1:-2], lambda x: [x]), lambda a, x: CASE WHEN x[1] - a[-1] >= 5 THEN list_concat(a, x) ELSE a END) AS kept FROM l),
k AS (SELECT video_id, lo, hi, list_append(kept, n) AS bs FROM m),
e AS (SELECT video_id, lo, hi, bs, unnest(range(1, len(bs))) AS i FROM k),
c AS (SELECT video_id, i - 1 AS segment, CASE WHEN i = 1 THEN lo ELSE lo + 2 * bs[i] + 1 END AS a, CASE WHEN i = len(bs) - 1 THEN hi ELSE lo + 2 * bs[i + 1] - 1 END AS b FROM e)
SELECT video_id, CAST(segment AS INT) AS segment, round(a, 6) AS start, round(b, 6) AS "end", b - a >= 10 AS kept FROM c""")
def cut_segments(spark: SparkSession, d: str) -> DataFrame:
    """Segments of every whole video in two-second windows: boundaries where events begin, those closer than five windows
    merged, edges shrunk by half of two seconds, segments under ten seconds not kept."""
    e = table(spark, d, "train_events").where("start_sec is not null and end_sec is not null").select(F.col("id").alias("video_id"), "start_sec", "end_sec")
    g = cut(e.groupBy("video_id").agg(F.min("start_sec").alias("lo"), F.max("end_sec").alias("hi")).where("hi > lo").withColumn("n", F.greatest(F.lit(1), F.ceil((F.col("hi") - F.col("lo")) / 2)).cast("int")))
    at = e.alias("l").join(g.alias("r"), same("l", "r", ["video_id"])).select("r.*", F.floor((F.col("l.start_sec") - F.col("r.lo")) / 2).cast("int").alias("b")).distinct()
    # at most one boundary a window of the video
    x = at.groupBy("video_id", "lo", "hi", "n").agg(F.collect_list(F.when((F.col("b") > 0) & (F.col("b") < F.col("n")), F.col("b"))).alias("inner"))
    x = x.withColumn("bounds", segmentation.merge_short(F.concat(F.array(F.lit(0)), "inner", F.array("n")), 5))
    y = segmentation.cut_segments(x, "video_id", lambda k: 2.0 * k + 1, "bounds", "lo", "hi", 2.0, 10.0)
    return y.select("video_id", "segment", r6("start").alias("start"), r6("end").alias("end"), "kept")


@query()
def segment_chain(spark: SparkSession, d: str) -> DataFrame:
    """The whole chain over each user's values: scaled, sliding statistics, change points of the windows, short segments
    merged, and the rows that each segment spans."""
    x = segmentation.robust_scale(table(spark, d, "events").select("user_id", "ts", "event_id", "value"), ["user_id"], "value")
    w = cut(segmentation.sliding(x, ["user_id"], ["ts", "event_id"], "scaled", 8, 4))
    points = segmentation.change_points(w, "user_id", ["first"], ["mean", "std"], penalty=3.0, least=5)
    b = points.groupBy("user_id").agg(F.array_sort(F.collect_list(F.col("last") + 1)).alias("ends"))
    b = b.withColumn("bounds", segmentation.merge_short(F.concat(F.array(F.lit(0)), "ends"), 5)).withColumn("lo", F.lit(0.0)).withColumn("hi", F.element_at("bounds", -1) * 4.0 + 4)
    return segmentation.cut_segments(b, "user_id", lambda k: 4.0 * k + 4, "bounds", "lo", "hi", 2.0, 10.0)


# embeddings
@query(r"""
WITH l AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
c AS (SELECT label, i, avg(CAST(x AS DOUBLE)) AS m FROM l GROUP BY ALL)
SELECT vec_id, round(sum(x * m) / (sqrt(sum(CAST(x AS DOUBLE) * x)) * sqrt(sum(m * m))), 6) AS cosine FROM (SELECT vec_id, CAST(x AS DOUBLE) AS x, m FROM l JOIN c USING (label, i)) GROUP BY vec_id""")
def clap_cosine(spark: SparkSession, d: str) -> DataFrame:
    """Cosine of each vector and the mean of its label."""
    e = table(spark, d, "embeddings")
    return e.join(F.broadcast(embeddings.centroids(e, "label", "embedding")), "label").select("vec_id", r6(embeddings.cosine(F.col("embedding"), F.col("centroid"))).alias("cosine"))


@query()
def frechet_distance(spark: SparkSession, d: str) -> DataFrame:
    """Fréchet distance of the vectors with even and with odd labels."""
    e = table(spark, d, "embeddings")
    return spark.createDataFrame([("even_odd", embeddings.frechet(e.where("label % 2 = 0"), e.where("label % 2 = 1"), "embedding"))], "pair string, distance double")


_SOFT = """
e AS (SELECT vec_id, label, list_transform(embedding, lambda x: exp(CAST(x AS DOUBLE) - CAST(list_max(embedding) AS DOUBLE))) AS v FROM embeddings), s AS (SELECT vec_id, label, list_transform(v, lambda x: x / list_sum(v)) AS p FROM e),
l AS (SELECT vec_id, label, unnest(p) AS p, unnest(range(len(p))) AS i FROM s)
"""


@query(f"""
WITH {_SOFT}, m AS (SELECT i, avg(p) AS q FROM l GROUP BY i), k AS (SELECT vec_id, sum(greatest(p, 1e-6) * ln(greatest(p, 1e-6) / greatest(q, 1e-6))) AS kl FROM l JOIN m USING (i) GROUP BY vec_id),
r AS (SELECT a.vec_id, sum(greatest(a.p, 1e-6) * ln(greatest(a.p, 1e-6) / greatest(b.p, 1e-6))) AS kl FROM l a JOIN l b ON b.vec_id = a.vec_id + 1 AND b.i = a.i GROUP BY a.vec_id)
SELECT 'inception' AS metric, count(*) AS n, round(exp(avg(kl)), 6) AS value FROM k UNION ALL SELECT 'divergence', count(*), round(avg(kl), 6) FROM r""")
def distribution_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Inception score of the vectors' distributions, and the mean divergence of each from that of the next."""
    p = cut(table(spark, d, "embeddings").select("vec_id", embeddings.softmax(F.col("embedding")).alias("p")))
    a = embeddings.inception_score(p, "p").select(F.lit("inception").alias("metric"), "n", r6("score").alias("value"))
    b = embeddings.paired_divergence(p, p.select((F.col("vec_id") - 1).alias("vec_id"), "p"), "vec_id", "p").select(F.lit("divergence").alias("metric"), "n", r6("divergence").alias("value"))
    return a.unionByName(b)


@query(r"""
SELECT line_id, regexp_matches(coalesce(title, ''), '[\x{3040}-\x{309F}\x{30A0}-\x{30FF}\x{4E00}-\x{9FFF}]') AS cjk, CASE WHEN regexp_matches(coalesce(title, ''), '[\x{3040}-\x{309F}\x{30A0}-\x{30FF}\x{4E00}-\x{9FFF}]') THEN concat('tr:', md5(title)) ELSE title END AS title_en FROM timeline""")
def cjk_translate(spark: SparkSession, d: str) -> DataFrame:
    """Titles with kana or Han signs translated once per distinct text by a provider (here a stub), and joined back."""
    from ..operators.providers import apply_distinct, stub

    t = table(spark, d, "timeline").select("line_id", "title", X.has_cjk(F.col("title")).alias("cjk"))
    return apply_distinct(t, "title", F.col("cjk"), stub("tr:"), "title_en").select("line_id", "cjk", "title_en")
