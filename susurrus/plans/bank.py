"""Queries of the question bank: clusters of clips, options, questions of both tiers, the bank and its counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import bank, scoring
from ..operators.packed import unpack
from ..sources import readers
from ..sources.tables import cut, table
from .reference import _DONE

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


#: Materials by the words that tell them, for the clips of the test tables; any such table will do.
MATERIAL_OF = {
    "wooden": "wood", "wood": "wood", "walnut": "wood", "pine": "wood", "bamboo": "wood", "paper": "paper", "rice": "paper", "glass": "glass", "crystal": "glass", "steel": "metal", "metal": "metal", "tin": "metal", "leather": "leather",
    "rubber": "rubber", "wax": "wax", "plastic": "plastic", "acrylic": "plastic", "silk": "textile_fibrous", "velvet": "textile_fibrous", "felt": "textile_fibrous", "wool": "textile_fibrous", "cotton": "textile_fibrous", "clay": "clay", "foam": "foam_lather",
}
#: Materials of the pool that no clip need have.
POOL = ["rubber", "wax", "leather", "paper", "wood", "plastic", "glass", "metal", "textile_fibrous", "clay", "foam_lather", "foam_solid"]
OM, SM, VB = ["subject_core", "verb", "object_core"], ["subject_core", "verb", "object_core", "object_material"], ["subject_core", "object_core"]


def _clips(spark: SparkSession, d: str) -> DataFrame:
    """The first label of every clip: its verb, who makes the sound (hands or a tool), the last word of the object as its
    core, and the materials of both."""
    t = table(spark, d, "train_label").where("wav is not null").groupBy("wav").agg(F.min_by(F.struct("verb", "subject", "object"), "label_id").alias("x"))
    words = F.create_map(*[F.lit(v) for kv in MATERIAL_OF.items() for v in kv])

    def parts(col: str):
        text = F.when(~X.is_fail(F.col(col)), X.audit_text(F.col(col)))
        return X.let(text, lambda t: F.struct(
            t.alias("text"), F.element_at(F.split(t, " "), -1).alias("core"), F.get(F.array_compact(F.transform(F.split(t, " "), lambda w: F.try_element_at(words, w))), 0).alias("material"),
        ))

    x = t.select(F.col("wav").alias("audio_id"), X.none_if_empty(X.token(F.col("x.verb"))).alias("verb"), parts("x.subject").alias("s"), parts("x.object").alias("o"))
    return x.select("audio_id", "verb", F.when(F.col("s.text").rlike("hand|finger|nail|palm|knuckle"), "hands").when(F.col("s.text").isNotNull(), "tool").alias("subject_core"), F.col("o.core").alias("object_core"), F.col("s.material").alias("subject_material"), F.col("o.material").alias("object_material"))


def _verb_classes(spark: SparkSession, d: str) -> dict[str, str]:
    cells = table(spark, d, "asmr_verb_classes_en").withColumn("source", F.lit("verbs")).select("verb_class", "verbs", "source")
    return {r["verb"]: r["verb_class"] for r in unpack(cells, "source", "verbs", ["verb_class"], least_values=1).select(X.token(F.col("val")).alias("verb"), "verb_class").collect()}


def _verb_pool(clips: DataFrame, classes: dict[str, str]) -> dict[str, str | None]:
    """Verbs of the clips (a vocabulary) with their class."""
    return {r["verb"]: classes.get(r["verb"]) for r in clips.where("verb is not null").select("verb").distinct().collect()}


_T = r"nullif(trim(regexp_replace(lower(replace({0}, '_', ' ')), '\s+', ' ', 'g')), '')"
_SLUG = "coalesce(nullif(trim(regexp_replace(lower({0}), '[^a-z0-9]+', '-', 'g'), '-'), ''), '_')"
_WORDS = "('wooden', 'wood'), ('wood', 'wood'), ('walnut', 'wood'), ('pine', 'wood'), ('bamboo', 'wood'), ('paper', 'paper'), ('rice', 'paper'), ('glass', 'glass'), ('crystal', 'glass'), ('steel', 'metal'), ('metal', 'metal'), ('tin', 'metal'), ('leather', 'leather'), ('rubber', 'rubber'), ('wax', 'wax'), ('plastic', 'plastic'), ('acrylic', 'plastic'), ('silk', 'textile_fibrous'), ('velvet', 'textile_fibrous'), ('felt', 'textile_fibrous'), ('wool', 'textile_fibrous'), ('cotton', 'textile_fibrous'), ('clay', 'clay'), ('foam', 'foam_lather')"
_FAMILY = "CASE WHEN {0} IN ('rubber', 'wax', 'leather', 'paper', 'wood') THEN 'rubber' WHEN {0} IN ('plastic', 'glass', 'metal') THEN 'plastic' ELSE {0} END"
_CLASSES = """('tapping', 'soft_strike'), ('drumming', 'soft_strike'), ('patting', 'soft_strike'), ('knocking', 'hard_strike'), ('clacking', 'hard_strike'), ('thumping', 'hard_strike'), ('scratching', 'slide_dry'), ('stroking', 'slide_dry'), ('brushing,_dry', 'slide_dry'), ('sweeping', 'slide_dry'),
 ('wiping', 'slide_wet'), ('lathering', 'slide_wet'), ('smearing', 'slide_wet'), ('crinkling', 'crumple'), ('rustling', 'crumple'), ('folding,_paper', 'crumple'), ('page_turning', 'page_work'), ('leafing', 'page_work'), ('card_shuffling', 'page_work'), ('typing', 'key_work'), ('clicking', 'key_work'),
 ('squeezing', 'squash'), ('kneading', 'squash'), ('pressing', 'squash'), ('snapping', 'break_up'), ('crushing', 'break_up'), ('crumbling', 'break_up'), ('slicing', 'edge_work'), ('shaving,_soap', 'edge_work'), ('filing', 'edge_work'), ('pouring', 'liquid_move'), ('dripping', 'liquid_move'), ('spraying_"mist"', 'liquid_move'),
 ('stirring', 'stir_round'), ('whisking', 'stir_round'), ('swirling', 'stir_round'), ('shaking', 'shake_loose'), ('rattling', 'shake_loose'), ('jingling', 'shake_loose'), ('puffing', 'air_flow'), ('humming', 'mouth_low'), ('chewing', 'mouth_low'), ('sipping', 'mouth_low'), ('tongue_clicking', 'mouth_low'), ('smouldering', 'heat_noise'), ('simmering', 'heat_noise')"""
#: Clips, pools, groups and members written out in SQL.
_BANK = rf"""
mw(w, m) AS (VALUES {_WORDS}), vc(v, c) AS (VALUES {_CLASSES}),
f AS (SELECT wav AS audio_id, nullif(coalesce(regexp_replace(trim(lower(verb)), '\s+', '_', 'g'), ''), '') AS verb, CASE WHEN lower(trim(subject)) <> 'fail' THEN {_T.format("subject")} END AS s, CASE WHEN lower(trim(object)) <> 'fail' THEN {_T.format("object")} END AS o
  FROM train_label WHERE wav IS NOT NULL QUALIFY row_number() OVER (PARTITION BY wav ORDER BY label_id) = 1),
t AS (SELECT audio_id, 's' AS k, unnest(str_split(s, ' ')) AS w, unnest(range(len(str_split(s, ' ')))) AS p FROM f WHERE s IS NOT NULL UNION ALL SELECT audio_id, 'o', unnest(str_split(o, ' ')), unnest(range(len(str_split(o, ' ')))) FROM f WHERE o IS NOT NULL),
mm AS (SELECT audio_id, arg_min(m, p) FILTER (k = 's') AS sm, arg_min(m, p) FILTER (k = 'o') AS om FROM t JOIN mw USING (w) GROUP BY audio_id),
c AS (SELECT f.audio_id, verb, CASE WHEN regexp_matches(s, 'hand|finger|nail|palm|knuckle') THEN 'hands' WHEN s IS NOT NULL THEN 'tool' END AS subject_core, str_split(o, ' ')[-1] AS object_core, sm AS subject_material, om AS object_material FROM f LEFT JOIN mm USING (audio_id)),
pool AS (SELECT unnest(['rubber', 'wax', 'leather', 'paper', 'wood', 'plastic', 'glass', 'metal', 'textile_fibrous', 'clay', 'foam_lather', 'foam_solid']) AS m UNION SELECT subject_material FROM c WHERE subject_material IS NOT NULL UNION SELECT object_material FROM c WHERE object_material IS NOT NULL),
vp AS (SELECT DISTINCT verb AS v, vc.c FROM c LEFT JOIN vc ON vc.v = verb WHERE verb IS NOT NULL),
mk AS (SELECT audio_id, 'om' AS px, [subject_core, verb, object_core] AS ks, object_material AS g FROM c WHERE object_material IS NOT NULL UNION ALL SELECT audio_id, 'sm', [subject_core, verb, object_core, object_material], subject_material FROM c WHERE subject_material IS NOT NULL),
kf AS (SELECT px, ks, {_FAMILY.format("g")} AS fam, list(DISTINCT g) AS ms FROM mk GROUP BY ALL),
kn AS (SELECT *, row_number() OVER (PARTITION BY px, ks ORDER BY fam) AS i, count(*) OVER (PARTITION BY px, ks) AS top FROM kf),
sub AS (SELECT px, ks, top, i, [m] AS subset FROM (SELECT px, ks, top, i, unnest(ms) AS m FROM kn WHERE i = 1) UNION ALL
  SELECT sub.px, sub.ks, sub.top, n.i, list_append(sub.subset, n.m) FROM sub JOIN (SELECT px, ks, i, unnest(ms) AS m FROM kn) n ON n.px = sub.px AND n.ks IS NOT DISTINCT FROM sub.ks AND n.i = sub.i + 1),
gr AS (SELECT px, ks, list_sort(subset) AS vals, count(*) OVER (PARTITION BY px, ks) AS n FROM sub WHERE i = top AND top >= 2),
gi AS (SELECT px, ks, vals, px || '__' || array_to_string(list_transform(ks, lambda x: {_SLUG.format("x")}), '__') || CASE WHEN n > 1 THEN '__d' || {_SLUG.format("array_to_string(vals, '-')")} ELSE '' END AS group_id FROM gr),
mt AS (SELECT group_id, audio_id, g AS gold, vals, gi.px, row_number() OVER (PARTITION BY group_id ORDER BY audio_id) - 1 AS inst FROM gi JOIN mk ON mk.px = gi.px AND mk.ks IS NOT DISTINCT FROM gi.ks AND list_contains(vals, g)),
vg AS (SELECT [subject_core, object_core] AS ks, list_sort(list(DISTINCT verb)) AS vals FROM c WHERE verb IS NOT NULL GROUP BY ALL HAVING count(DISTINCT verb) >= 2),
vm AS (SELECT 'vb__' || array_to_string(list_transform(ks, lambda x: {_SLUG.format("x")}), '__') AS group_id, audio_id, verb AS gold, vals FROM vg JOIN c ON [subject_core, object_core] IS NOT DISTINCT FROM ks AND verb IS NOT NULL),
vt AS (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY audio_id) - 1 AS inst FROM vm),
mq AS (SELECT group_id || '__inst' || inst AS question_id, group_id, CASE px WHEN 'om' THEN 'object_material_mc' ELSE 'subject_material_mc' END AS task, 'strict_minimal_pair' AS tier, audio_id, gold, vals FROM mt UNION ALL
  SELECT 't2_' || px || '__' || audio_id, NULL, CASE px WHEN 'om' THEN 'object_material_mc' ELSE 'subject_material_mc' END, 'curated_distant_single', audio_id, g, [g] FROM mk WHERE NOT EXISTS (SELECT 1 FROM mt WHERE mt.px = mk.px AND mt.audio_id = mk.audio_id)),
vq AS (SELECT group_id || '__inst' || inst AS question_id, group_id, 'verb_mc' AS task, 'strict_minimal_pair' AS tier, audio_id, gold, vals FROM vt UNION ALL
  SELECT 't2_vb__' || audio_id, NULL, 'verb_mc', 'curated_distant_single', audio_id, verb, [verb] FROM c WHERE verb IS NOT NULL AND audio_id NOT IN (SELECT audio_id FROM vt)),
mp AS (SELECT question_id, m AS value, row_number() OVER (PARTITION BY question_id ORDER BY md5(question_id || ':pad:' || m)) AS p FROM mq JOIN pool ON {_FAMILY.format("m")} <> {_FAMILY.format("gold")} AND NOT list_contains(vals, m)),
mo AS (SELECT question_id, gold AS value, 'target' AS source, 0 AS o, 0 AS p FROM mq UNION ALL SELECT question_id, x, 'same_group', 1, row_number() OVER (PARTITION BY question_id ORDER BY x) FROM (SELECT question_id, unnest(list_filter(vals, lambda x: x <> gold)) AS x FROM mq) UNION ALL SELECT question_id, value, 'distant_pool', 2, p FROM mp),
mc AS (SELECT * FROM mo QUALIFY row_number() OVER (PARTITION BY question_id ORDER BY o, p) <= 4),
vd AS (SELECT q.question_id, q.vals, q.tier, b.v AS value, CASE WHEN q.tier = 'strict_minimal_pair' THEN row_number() OVER (PARTITION BY q.question_id ORDER BY CASE WHEN b.c IS NOT DISTINCT FROM a.c THEN 0 ELSE 1 END, b.v)
    ELSE row_number() OVER (PARTITION BY q.question_id ORDER BY CASE WHEN b.c IS NOT DISTINCT FROM a.c THEN 1 ELSE 0 END, CASE WHEN b.c IS NOT DISTINCT FROM a.c THEN b.v ELSE md5(q.question_id || ':vpad:' || b.v) END) END AS p
  FROM vq q JOIN vp a ON a.v = q.gold JOIN vp b ON b.v <> q.gold),
vo AS (SELECT question_id, gold AS value, 'target' AS source, 0 AS o, 0 AS p FROM vq UNION ALL SELECT question_id, x, 'same_group', 1, row_number() OVER (PARTITION BY question_id ORDER BY x) FROM (SELECT question_id, unnest(list_filter(vals, lambda x: x <> gold)) AS x FROM vq)
  UNION ALL SELECT question_id, value, CASE tier WHEN 'strict_minimal_pair' THEN 'near_pool' ELSE 'distant_pool' END, 2, p FROM vd WHERE p <= 4 - len(vals) AND NOT list_contains(vals, value)),
vx AS (SELECT * FROM vo QUALIFY row_number() OVER (PARTITION BY question_id ORDER BY o, p) <= 4),
al AS (SELECT question_id, value, source, ['A', 'B', 'C', 'D'][CAST(row_number() OVER (PARTITION BY question_id ORDER BY md5(question_id || ':' || value)) AS INT)] AS label FROM (SELECT * FROM mc UNION ALL SELECT * FROM vx)),
qs AS (SELECT * FROM mq UNION ALL SELECT * FROM vq),
bk AS (SELECT qs.question_id, group_id, task, tier, audio_id, gold AS gold_value, max(label) FILTER (value = gold) AS gold_label, string_agg(label || '=' || value || ':' || source, ' ' ORDER BY label) AS options FROM qs JOIN al USING (question_id) GROUP BY ALL)
"""


def _questions(spark: SparkSession, d: str, task: str) -> tuple[DataFrame, DataFrame]:
    """(questions of both tiers, their options) of one task."""
    c = cut(_clips(spark, d))
    if task == "verb_mc":
        pool = _verb_pool(c, _verb_classes(spark, d))
        one = cut(bank.tier_one(c, bank.clusters(c, "vb", VB, "verb", "audio_id"), VB, "values", "verb", "audio_id"))
        two = bank.tier_two(c, one, "t2_vb", "verb", "audio_id")
        shown = bank.verb_options(one, pool, "question_id", "gold", "values").unionByName(bank.verb_options(two, pool, "question_id", "gold", "values", distant=True)).drop("verb_class")
    else:
        value, keys, prefix = ("object_material", OM, "om") if task == "object_material_mc" else ("subject_material", SM, "sm")
        seen = c.select(F.explode(F.array("subject_material", "object_material")).alias("m")).where("m is not null").distinct().collect()  # a vocabulary
        pool = sorted({*POOL, *(r["m"] for r in seen)})
        one = cut(bank.tier_one(c, bank.material_groups(c, prefix, keys, value, "audio_id"), keys, "subset", value, "audio_id"))
        two = bank.tier_two(c, one, f"t2_{prefix}", value, "audio_id")
        shown = bank.options(one, pool, "question_id", "gold", "values").unionByName(bank.options(two, pool, "question_id", "gold", "values"))
    q = one.withColumn("tier", F.lit("strict_minimal_pair")).unionByName(two.withColumn("tier", F.lit("curated_distant_single")))
    return q, shown


def bank_of(spark: SparkSession, d: str, task: str) -> DataFrame:
    return bank.question_bank(*_questions(spark, d, task), task, "audio_id")


def _flat(x: DataFrame) -> DataFrame:
    return x.withColumn("options", F.array_join(F.transform("options", lambda o: F.concat(o["label"], F.lit("="), o["value"], F.lit(":"), o["source"])), " "))


def _task(task: str):
    @query(f"WITH RECURSIVE {_BANK} SELECT * FROM bk WHERE task = '{task}'")
    def run(spark: SparkSession, d: str) -> DataFrame:
        return _flat(bank_of(spark, d, task))

    run.__doc__ = f"Questions of both tiers of the task {task}, with options and gold letter."
    QUERIES[f"bank_{task}"], ORACLES[f"bank_{task}"] = QUERIES.pop("run"), ORACLES.pop("run")


for _t in ("object_material_mc", "subject_material_mc", "verb_mc"):
    _task(_t)


def whole_bank(spark: SparkSession, d: str) -> DataFrame:
    x = None
    for t in ("object_material_mc", "subject_material_mc", "verb_mc"):
        y = bank_of(spark, d, t)
        x = y if x is None else x.unionByName(y)
    return x


@query(f"WITH RECURSIVE {_BANK} SELECT tier, task, count(*) AS questions, count(DISTINCT audio_id) AS clips FROM bk GROUP BY GROUPING SETS ((tier, task), (tier), ())")
def bank_counts(spark: SparkSession, d: str) -> DataFrame:
    """Questions and distinct clips by tier and task, by tier, and in all."""
    x = whole_bank(spark, d)
    return x.groupingSets([["tier", "task"], ["tier"], []], "tier", "task").agg(F.count("*").alias("questions"), F.countDistinct("audio_id").alias("clips"))


@query(f"WITH RECURSIVE {_BANK} SELECT group_id, array_to_string(vals, ',') AS materials, count(*) AS members FROM mt GROUP BY ALL")
def material_groups(spark: SparkSession, d: str) -> DataFrame:
    """Groups of clips that differ in one material only, whose materials sound apart, of both roles."""
    c = cut(_clips(spark, d))
    parts = [bank.members(c, bank.material_groups(c, p, k, v, "audio_id"), k, "subset", v, "audio_id") for p, k, v in (("om", OM, "object_material"), ("sm", SM, "subject_material"))]
    return parts[0].unionByName(parts[1]).groupBy("group_id", F.array_join("values", ",").alias("materials")).agg(F.count("*").alias("members"))


@query(f"WITH RECURSIVE {_BANK} SELECT group_id, array_to_string(vals, ',') AS verbs, count(*) AS members FROM vt GROUP BY ALL")
def minpair_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Clips that differ in their verb only."""
    c = cut(_clips(spark, d))
    m = bank.members(c, bank.clusters(c, "vb", VB, "verb", "audio_id"), VB, "values", "verb", "audio_id")
    return m.groupBy("group_id", F.array_join("values", ",").alias("verbs")).agg(F.count("*").alias("members"))


@query(f"WITH RECURSIVE {_BANK}, g AS (SELECT group_id, audio_id FROM mt UNION SELECT group_id, audio_id FROM vt) SELECT audio_id, array_to_string(list_sort(list(group_id)), ' ') AS group_ids FROM g GROUP BY audio_id")
def clip_groups(spark: SparkSession, d: str) -> DataFrame:
    """The groups of every clip that is in one."""
    c = cut(_clips(spark, d))
    parts = [bank.members(c, bank.material_groups(c, p, k, v, "audio_id"), k, "subset", v, "audio_id") for p, k, v in (("om", OM, "object_material"), ("sm", SM, "subject_material"))]
    parts.append(bank.members(c, bank.clusters(c, "vb", VB, "verb", "audio_id"), VB, "values", "verb", "audio_id"))
    m = parts[0].select("group_id", "audio_id").unionByName(parts[1].select("group_id", "audio_id")).unionByName(parts[2].select("group_id", "audio_id"))
    return bank.group_lists(m, "audio_id").select("audio_id", F.array_join("group_ids", " ").alias("group_ids"))


@query(rf"WITH RECURSIVE {_BANK} SELECT verb, object_material, count(*) AS n, count(DISTINCT object_core) AS cores FROM c GROUP BY GROUPING SETS ((verb, object_material), (verb), ())")
def tier_task_sets(spark: SparkSession, d: str) -> DataFrame:
    """Counts of clips by verb and material, by verb, and in all, in one aggregation."""
    c = _clips(spark, d)
    return c.groupingSets([["verb", "object_material"], ["verb"], []], "verb", "object_material").agg(F.count("*").alias("n"), F.countDistinct("object_core").alias("cores"))


_PROMPT = r"""
CASE task WHEN 'verb_mc' THEN 'Subject: ' || coalesce(subject_core, 'item') || chr(10) || 'Object: ' || coalesce(object_core, 'surface') || chr(10) || 'Which action best matches the sound?'
  WHEN 'object_material_mc' THEN 'Subject: ' || coalesce(subject_core, 'item') || chr(10) || 'Action: ' || coalesce(verb, '') || chr(10) || 'Object: ' || coalesce(object_core, 'surface') || chr(10) || 'What is the object''s material?'
  ELSE 'Subject: ' || coalesce(subject_core, 'item') || chr(10) || 'Action: ' || coalesce(verb, '') || chr(10) || 'Object: ' || coalesce(object_core, 'surface') || coalesce(' (' || replace(object_material, '_', ' ') || ')', '') || chr(10) || 'What is the subject''s material?' END
|| chr(10) || (SELECT string_agg('(' || al.label || ') ' || replace(al.value, '_', ' '), chr(10) ORDER BY al.label) FROM al WHERE al.question_id = bk.question_id) || chr(10) || 'Answer with a single letter (' || (SELECT string_agg(al.label, '/' ORDER BY al.label) FROM al WHERE al.question_id = bk.question_id) || ') only.'"""


def prompt(task, context, options):
    """The wording of the questions. The text of a question from its task, context (struct of cores, verb and material) and options."""
    part = lambda name, default: F.coalesce(context[name], F.lit(default))
    subject, obj, verb = part("subject_core", "item"), part("object_core", "surface"), part("verb", "")
    suffix = F.coalesce(F.concat(F.lit(" ("), F.translate(context["object_material"], "_", " "), F.lit(")")), F.lit(""))
    ask = (
        F.when(task == "verb_mc", F.format_string("Subject: %s\nObject: %s\nWhich action best matches the sound?", subject, obj))
        .when(task == "object_material_mc", F.format_string("Subject: %s\nAction: %s\nObject: %s\nWhat is the object's material?", subject, verb, obj))
        .otherwise(F.format_string("Subject: %s\nAction: %s\nObject: %s%s\nWhat is the subject's material?", subject, verb, obj, suffix))
    )
    shown = F.array_join(F.transform(options, lambda o: F.concat(F.lit("("), o["label"], F.lit(") "), F.translate(o["value"], "_", " "))), "\n")
    letters = F.array_join(F.transform(options, lambda o: o["label"]), "/")
    return F.concat(ask, F.lit("\n"), shown, F.lit("\nAnswer with a single letter ("), letters, F.lit(") only."))


@query(f"WITH RECURSIVE {_BANK} SELECT question_id, {_PROMPT} AS prompt FROM bk JOIN c USING (audio_id)")
def prompt_render(spark: SparkSession, d: str) -> DataFrame:
    """The prompts of all questions of the bank."""
    c = cut(_clips(spark, d).select("audio_id", F.struct("subject_core", "verb", "object_core", "object_material").alias("context")))
    x = bank.hot_join(whole_bank(spark, d), c, "audio_id", "inner")
    return x.select("question_id", prompt(F.col("task"), F.col("context"), F.col("options")).alias("prompt"))


#: The fields of a question and of an option that stay private.
PRIVATE_QUESTION, PRIVATE_OPTION = ["tier", "group_id"], ["source"]


@query(f"WITH RECURSIVE {_BANK} SELECT question_id, task, regexp_extract(audio_id, '([^/]*)$', 1) AS wav, gold_value, gold_label, regexp_replace(options, ':[a-z_]+', '', 'g') AS options FROM bk")
def bank_release(spark: SparkSession, d: str) -> DataFrame:
    """The bank without private fields of questions and options, paths relative."""
    x = whole_bank(spark, d).withColumn("options", F.transform("options", lambda o: o.dropFields(*PRIVATE_OPTION))).drop(*PRIVATE_QUESTION)
    x = x.withColumn("wav", F.regexp_extract("audio_id", r"([^/]*)$", 1)).drop("audio_id")
    return x.withColumn("options", F.array_join(F.transform("options", lambda o: F.concat(o["label"], F.lit("="), o["value"])), " "))


@query(rf"""WITH RECURSIVE {_BANK},
k AS (SELECT wav AS audio_id, verb_ok FROM (SELECT wav, bool_and(regexp_replace(trim(lower(coalesce(verb, ''))), '\s+', '_', 'g') = first) AS verb_ok FROM (SELECT wav, verb, first_value(regexp_replace(trim(lower(coalesce(verb, ''))), '\s+', '_', 'g')) OVER (PARTITION BY wav ORDER BY label_id) AS first FROM train_label WHERE wav IS NOT NULL) GROUP BY wav))
SELECT question_id, CASE WHEN tier = 'strict_minimal_pair' THEN 'tier1' ELSE 'tier2' END AS tier, CASE task WHEN 'verb_mc' THEN 'verb' WHEN 'object_material_mc' THEN 'object_material' ELSE 'subject_material' END AS eval_target, gold_label || '=' || gold_value AS gold,
  (SELECT string_agg(al.label || '=' || CASE WHEN bk.task = 'verb_mc' THEN al.value ELSE replace(al.value, '_', ' ') END, ' | ' ORDER BY al.label) FROM al WHERE al.question_id = bk.question_id) AS options, coalesce(group_id, '') AS group_id FROM bk JOIN k USING (audio_id) WHERE verb_ok""")
def bank_review(spark: SparkSession, d: str) -> DataFrame:
    """Review rows of the questions whose clip is flagged the same in all of its exports."""
    first = F.min_by(X.token(F.col("verb")), "label_id")
    t = table(spark, d, "train_label").where("wav is not null")
    same = cut(t.groupBy(F.col("wav").alias("audio_id")).agg(first.alias("verb"), F.collect_set(X.token(F.col("verb"))).alias("verbs")).select("audio_id", (F.size("verbs") == 1).alias("same")))
    x = bank.same_flag(whole_bank(spark, d), [same], "audio_id").where("clip_meta.same")
    shown = lambda o: F.concat(o["label"], F.lit("="), F.when(F.col("task") == "verb_mc", o["value"]).otherwise(F.translate(o["value"], "_", " ")))
    return x.select(
        "question_id", F.when(F.col("tier") == "strict_minimal_pair", "tier1").otherwise("tier2").alias("tier"), F.when(F.col("task") == "verb_mc", "verb").otherwise(F.regexp_replace("task", "_mc$", "")).alias("eval_target"),
        F.concat("gold_label", F.lit("="), "gold_value").alias("gold"), F.array_join(F.transform("options", shown), " | ").alias("options"), F.coalesce("group_id", F.lit("")).alias("group_id"),
    )


_SCORE = rf"""
gd AS (SELECT gt_row_id, wav, annotation.annotator_id AS run_id, nullif(coalesce(regexp_replace(trim(lower(gt.verb)), '\\s+', '_', 'g'), ''), '') AS verb, {_T.format("gt.subject")} AS s, {_T.format("gt.object")} AS o FROM manual_gt_example WHERE wav IS NOT NULL AND {_DONE}),
gt AS (SELECT gt_row_id, 's' AS k, unnest(str_split(s, ' ')) AS w, unnest(range(len(str_split(s, ' ')))) AS p FROM gd WHERE s IS NOT NULL UNION ALL SELECT gt_row_id, 'o', unnest(str_split(o, ' ')), unnest(range(len(str_split(o, ' ')))) FROM gd WHERE o IS NOT NULL),
gm AS (SELECT gt_row_id, arg_min(m, p) FILTER (k = 's') AS sm, arg_min(m, p) FILTER (k = 'o') AS om FROM gt JOIN mw USING (w) GROUP BY gt_row_id),
lp AS (SELECT run_id, wav, 'verb_mc' AS task, verb AS value, gt_row_id FROM gd UNION ALL SELECT run_id, wav, 'object_material_mc', om, gt_row_id FROM gd JOIN gm USING (gt_row_id) UNION ALL SELECT run_id, wav, 'subject_material_mc', sm, gt_row_id FROM gd JOIN gm USING (gt_row_id)),
sq AS (SELECT * FROM bk WHERE audio_id IN (SELECT wav FROM gd)),
pr AS (SELECT lp.run_id, sq.question_id, arg_max(al.label, gt_row_id) AS pred, arg_max(al.value, gt_row_id) AS said FROM lp JOIN sq ON sq.audio_id = lp.wav AND sq.task = lp.task JOIN al ON al.question_id = sq.question_id AND al.value = lp.value GROUP BY ALL),
sg AS (SELECT r.run_id, sq.task, CAST(pred IS NOT NULL AND pred = gold_label AS INT) AS ok, CASE WHEN sq.task = 'verb_mc' AND a.c IS NOT NULL THEN CAST(coalesce(b.c = a.c, false) AS INT) END AS cls
  FROM sq CROSS JOIN (SELECT DISTINCT run_id FROM pr) r LEFT JOIN pr ON pr.question_id = sq.question_id AND pr.run_id = r.run_id LEFT JOIN vc a ON a.v = gold_value LEFT JOIN vc b ON b.v = said),
st AS (SELECT run_id, task AS metric, avg(ok) AS value FROM sg GROUP BY ALL),
sm AS (SELECT * FROM st UNION ALL SELECT run_id, 'overall', avg(ok) FROM sg GROUP BY run_id UNION ALL SELECT run_id, 'superclass', avg(cls) FROM sg GROUP BY run_id UNION ALL SELECT run_id, 'macro', avg(value) FROM st GROUP BY run_id)
"""


@query(f"WITH RECURSIVE {_BANK}, {_SCORE} SELECT metric, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, count(*) AS runs FROM sm GROUP BY metric")
def bank_scores(spark: SparkSession, d: str) -> DataFrame:
    """The bank's questions on annotated clips scored for each annotator as a run: the option that agrees with the verb or
    material that was given. Mean and deviation over the runs of all metrics."""
    g = table(spark, d, "manual_gt_example").where(F.col("wav").isNotNull() & X.is_completed(F.col("annotation.status"), F.col("gt.subject"), F.col("gt.verb")))
    words = F.create_map(*[F.lit(v) for kv in MATERIAL_OF.items() for v in kv])
    material = lambda c: F.get(F.array_compact(F.transform(F.split(X.audit_text(F.col(c)), " "), lambda w: F.try_element_at(words, w))), 0)
    said = F.array(*[F.struct(F.lit(t).alias("task"), v.alias("value")) for t, v in (("verb_mc", X.none_if_empty(X.token(F.col("gt.verb")))), ("object_material_mc", material("gt.object")), ("subject_material_mc", material("gt.subject")))])
    given = g.select(F.col("annotation.annotator_id").alias("run_id"), F.col("wav").alias("audio_id"), "gt_row_id", F.explode(said).alias("x")).select("run_id", "audio_id", "gt_row_id", "x.*").where("value is not null")
    classes = F.create_map(*[F.lit(x) for kv in sorted(_verb_classes(spark, d).items()) for x in kv])
    q = whole_bank(spark, d).join(g.select(F.col("wav").alias("audio_id")).distinct(), "audio_id", "left_semi")
    q = cut(q.withColumn("options", F.transform("options", lambda o: o.withField("verb_class", F.when(F.col("task") == "verb_mc", F.try_element_at(classes, o["value"]))))))
    letter = F.get(F.filter("options", lambda o: o["value"] == F.col("value")), 0)["label"]
    p = given.join(q, ["audio_id", "task"]).select("run_id", "question_id", letter.alias("pred"), "gt_row_id")
    p = cut(readers.predictions(p, "run_id", "question_id", "gt_row_id"))
    x = scoring.average_runs(scoring.score_runs(q, p))
    return x.select("metric", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "runs")
