"""Queries of the training-data problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import hot_join
from ..sources.tables import cut, table
from . import canonical, consensus, languages, leaks, mixing, sampling, splits, topics


# 2: splits that keep related records together
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Every video that is not the smallest of its group, with the smallest."""
    g = splits.video_groups(table(spark, d, "train_events"), table(spark, d, "train_label"))
    return g.where("id <> component").select(F.col("component").alias("group_id"), "id")


def _split(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    targets = {x["split"]: x["target_share"] for x in table(spark, d, "split_target").collect()}
    clips = splits.clip_groups(table(spark, d, "train_events"), table(spark, d, "train_label"))
    return clips, cut(splits.grouped_split(clips, "component", "verb", targets))


def p2_split(spark: SparkSession, d: str) -> DataFrame:
    """The split of every clip."""
    clips, split = _split(spark, d)
    return hot_join(clips, split, "component", "inner").select("label_id", "component", "split")


def _split_counts(spark: SparkSession, d: str) -> DataFrame:
    clips, split = _split(spark, d)
    # counted by component first, so a hot component is one row a verb before the join
    n = clips.groupBy("component", "verb").agg(F.count("*").alias("clips"))
    return hot_join(n, split, "component", "inner").groupBy("verb", "split").agg(F.sum("clips").alias("clips"))


def p2_shares(spark: SparkSession, d: str) -> DataFrame:
    """Share of each split, by verb."""
    n = _split_counts(spark, d)
    of = n.groupBy("verb").agg(F.sum("clips").alias("of_verb"))
    return n.alias("l").join(F.broadcast(of).alias("r"), F.col("l.verb").eqNullSafe(F.col("r.verb"))).select("l.verb", "split", "clips", (F.col("clips") / F.col("of_verb")).alias("share"))


def p2_balance(spark: SparkSession, d: str) -> DataFrame:
    """Per verb of 200 clips or more, and over all (null verb): its clips, whether each split is within 0.05 (over all:
    0.005) of its target."""
    goal = table(spark, d, "split_target").groupBy("split").agg(F.max("target_share").alias("target"))
    n = _split_counts(spark, d)
    n = cut(n.select(F.coalesce("verb", F.lit("")).alias("verb"), "split", "clips").unionByName(n.groupBy("split").agg(F.sum("clips").alias("clips")).select(F.lit(None).cast("string").alias("verb"), "split", "clips")))
    whole = n.groupBy("verb").agg(F.sum("clips").alias("clips")).where("verb is null or clips >= 200")
    grid = whole.select("verb", "clips", F.explode(F.array(*[F.struct(F.lit(x["split"]).alias("split"), F.lit(x["target"]).alias("target")) for x in goal.collect()])).alias("x")).select("verb", "clips", "x.*")
    have = n.select(F.col("verb").alias("v"), F.col("split").alias("s"), F.col("clips").alias("have"))
    x = grid.join(have, F.col("verb").eqNullSafe(F.col("v")) & (F.col("split") == F.col("s")), "left")
    near = F.abs(F.coalesce("have", F.lit(0)) / F.col("clips") - F.col("target")) <= F.when(F.col("verb").isNull(), 0.005).otherwise(0.05)
    return x.groupBy("verb", "clips").agg(F.bool_and(near).alias("balanced"))


# 4: sample matching target category proportions
VERB, SPLIT = "train_label.verb", "manual_gt_example.split"


def _units(spark: SparkSession, d: str) -> DataFrame:
    verb = F.regexp_replace(F.regexp_replace(F.lower("verb"), r"(?U)^\s+|\s+$", ""), r"(?U)\s+", "_")
    a = table(spark, d, "train_label").select(F.lit(VERB).alias("scope"), verb.alias("category"), F.col("wav").alias("unit"))
    b = table(spark, d, "manual_gt_example").select(F.lit(SPLIT).alias("scope"), F.regexp_replace(F.lower("split"), r"(?U)^\s+|\s+$", "").alias("category"), F.col("item_id").alias("unit"))
    return a.unionByName(b)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Targets that cannot be met: the draw misses more rows than it passed over."""
    return p4_report(spark, d).where("not met").select("scope", "category")


def p4_sample(spark: SparkSession, d: str) -> DataFrame:
    """The two samples."""
    return sampling.draw(_units(spark, d), table(spark, d, "sample_target")).where("drawn").drop("drawn")


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    """Drawn, passed over and missing of every target."""
    targets = table(spark, d, "sample_target")
    return sampling.report(targets, sampling.draw(_units(spark, d), targets))


def p4_balance(spark: SparkSession, d: str) -> DataFrame:
    """Per target the available units, and whether the draw took the calibrated number within one unit (it always should)."""
    targets = table(spark, d, "sample_target")
    x = p4_report(spark, d)
    sizes = {}
    for r in x.withColumn("available", F.col("drawn") + F.col("spare")).collect():  # one row a target
        sizes.setdefault(r["scope"], []).append(r.asDict())
    rows = [(s, r["category"], r["available"], bool(abs(sampling.chances(own)[r["category"]] * r["available"] - r["drawn"]) <= 1.001)) for s, own in sizes.items() for r in own]
    return spark.createDataFrame(rows, f"scope {dict(targets.dtypes)['scope']}, category string, available long, calibrated boolean")


P4_FOUND = r"""
WITH u AS (
  SELECT 'train_label.verb' AS scope, regexp_replace(regexp_replace(lower(verb), '^\s+|\s+$', '', 'g'), '\s+', '_', 'g') AS category, wav AS unit FROM train_label
  UNION ALL SELECT 'manual_gt_example.split', regexp_replace(lower(split), '^\s+|\s+$', '', 'g'), item_id FROM manual_gt_example),
a AS (SELECT scope, category, count(DISTINCT unit) AS n FROM u GROUP BY ALL)
SELECT t.scope, t.category FROM sample_target t LEFT JOIN a USING (scope, category)
WHERE coalesce(a.n, 0) < greatest(CAST(t.min_rows AS DOUBLE), t.target_share * t.sample_rows)
"""

P2_FOUND = r"""
WITH RECURSIVE k AS (
  SELECT id, author FROM train_events
  UNION SELECT e.id, l.author FROM (SELECT id, unnest(segments).audio_path AS wav FROM train_events) e JOIN train_label l USING (wav)),
c AS (SELECT DISTINCT id, regexp_replace(lower(nfc_normalize(translate(author, 'ＡＢＣＤＥＦＧＨＩＪＫＬＭＮＯＰＱＲＳＴＵＶＷＸＹＺａｂｃｄｅｆｇｈｉｊｋｌｍｎｏｐｑｒｓｔｕｖｗｘｙｚ０１２３４５６７８９', 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789'))), '[^\p{L}\p{N}]', '', 'g') AS a
  FROM k WHERE id IS NOT NULL AND lower(trim(author)) NOT IN ('-', 'unknown', 'n/a', '')),
e AS (SELECT DISTINCT x.id AS u, y.id AS v FROM c x JOIN c y USING (a) WHERE a <> ''),
r AS (SELECT DISTINCT id AS u, id AS v FROM train_events WHERE id IS NOT NULL UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u)
SELECT min(v) AS group_id, u AS id FROM r GROUP BY u HAVING min(v) <> u
"""

QUERIES = {"p2_found": p2_found, "p2_split": p2_split, "p2_shares": p2_shares, "p2_balance": p2_balance, "p4_found": p4_found, "p4_sample": p4_sample, "p4_report": p4_report, "p4_balance": p4_balance}
P2_BALANCE = r"""
WITH v AS (SELECT coalesce(regexp_replace(trim(lower(verb)), '\s+', '_', 'g'), '') AS verb FROM train_label)
SELECT verb, count(*) AS clips, true AS balanced FROM v GROUP BY verb HAVING count(*) >= 200 UNION ALL SELECT NULL, count(*), true FROM v
"""
ORACLES = {"p2_found": P2_FOUND, "p2_balance": P2_BALANCE, "p4_found": P4_FOUND, "p4_balance": P4_FOUND.split("SELECT t.scope")[0] + "SELECT t.scope, t.category, coalesce(a.n, 0) AS available, true AS calibrated FROM sample_target t LEFT JOIN a USING (scope, category)"}


# 8: evaluation texts leaking into training text
def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaked(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_item"), "item_id", "text")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents with eight or more consecutive words of an item."""
    return _leaks(spark, d).select("doc_id", "item_id")


def p8_items(spark: SparkSession, d: str) -> DataFrame:
    """Per leaked item: its documents and the longest leak in words."""
    x = _leaks(spark, d).groupBy("item_id").agg(F.count("*").alias("documents"), F.max("words").alias("most_words"))
    return table(spark, d, "eval_item").select("item_id", "suite").join(F.broadcast(x), "item_id")


_P8 = r"""
WITH f AS (SELECT '([\x{AD}\x{200B}-\x{200F}\x{2060}-\x{2064}\x{FEFF}])' AS inv),
n AS (SELECT doc_id, regexp_extract_all(lower(translate(regexp_replace(text, (SELECT inv FROM f), '', 'g'),
  'ＡＢＣＤＥＦＧＨＩＪＫＬＭＮＯＰＱＲＳＴＵＶＷＸＹＺａｂｃｄｅｆｇｈｉｊｋｌｍｎｏｐｑｒｓｔｕｖｗｘｙｚ０１２３４５６７８９　', 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789 ')), '[\p{L}\p{N}]+') AS w FROM documents),
i AS (SELECT item_id, suite, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM eval_item),
ds AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, k, k + 7), ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS k FROM n WHERE len(w) >= 8)),
es AS (SELECT DISTINCT item_id, suite, array_to_string(list_slice(w, k, k + 7), ' ') AS s FROM (SELECT item_id, suite, w, unnest(range(1, len(w) - 6)) AS k FROM i WHERE len(w) >= 8))
"""
QUERIES |= {"p8_found": p8_found, "p8_items": p8_items}
_P8_ITEMS = _P8 + """, dp AS (SELECT doc_id, k, array_to_string(list_slice(w, k, k + 7), ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS k FROM n WHERE len(w) >= 8)),
h AS (SELECT doc_id, item_id, suite, count(DISTINCT place) AS words FROM (SELECT doc_id, item_id, suite, unnest(range(k, k + 8)) AS place FROM dp JOIN es USING (s)) GROUP BY ALL)
SELECT item_id, suite, count(*) AS documents, max(words) AS most_words FROM h GROUP BY ALL"""
ORACLES |= {"p8_found": _P8 + "SELECT DISTINCT doc_id, item_id FROM ds JOIN es USING (s)", "p8_items": _P8_ITEMS}


# 5: mapping free-entered values to canonical list
def _typed(spark: SparkSession, d: str) -> DataFrame:
    """Rows (label_id, field_name, typed): values that are not null, blank, `fail` or letter for letter an alias."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("typed")) for f in ("subject", "object")])
    rows = table(spark, d, "train_label").select("label_id", F.explode(pairs).alias("x")).select("label_id", "x.*").where(r"typed is not null and not typed rlike '(?U)^\\s*$' and lower(trim(typed)) <> 'fail'")
    known = table(spark, d, "noun_alias_v1").select(F.col("alias").alias("typed")).distinct()
    if known.count() <= canonical.BROADCAST_ROWS:
        return rows.join(F.broadcast(known), "typed", "left_anti")
    return hot_join(rows, cut(known.withColumn("known", F.lit(True))), "typed").where("known is null").drop("known")


def _mapped(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = _typed(spark, d)
    counted = cut(rows.groupBy(F.col("typed").alias("value")).agg(F.count("*").alias("n")))
    return rows, counted, canonical.match(counted, "value", table(spark, d, "noun_alias_v1"), "alias", "group_id")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """The group, or `unmatched`, of every value that isn't itself an alias."""
    rows, counted, found = _mapped(spark, d)
    return canonical.attach(rows, "typed", counted, found).select("label_id", "field_name", F.col("group").alias("group_id"))


def p5_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Values that stand for no group, with their number of rows."""
    _, counted, found = _mapped(spark, d)
    return counted.join(found.where(F.col("group") == canonical.UNMATCHED).select("value"), "value").select("value", "n")


QUERIES |= {"p5_found": p5_found, "p5_unmatched": p5_unmatched}


# 6: consensus from several annotators' labels
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """The consensus verb (with `_`) and object (with blanks) of every item."""
    found, _ = consensus.fit(consensus.votes(table(spark, d, "manual_gt_example")))
    return found.select(F.col("item").alias("item_id"), F.translate("verb", " ", "_").alias("verb"), "object")


def p6_annotators(spark: SparkSession, d: str) -> DataFrame:
    """Ability and reliability of every annotator."""
    return consensus.fit(consensus.votes(table(spark, d, "manual_gt_example")))[1]


def p6_agreement(spark: SparkSession, d: str) -> DataFrame:
    """Chance-corrected agreement of both fields."""
    return consensus.agreement(consensus.votes(table(spark, d, "manual_gt_example")))


P6_AGREEMENT = r"""
WITH n AS (SELECT item_id AS item, coalesce(annotation.annotator_id, '') AS a, submitted_at, gt_row_id,
    trim(regexp_replace(lower(replace(gt.verb, '_', ' ')), '\s+', ' ', 'g')) AS verb, coalesce(trim(regexp_replace(lower(replace(gt.object, '_', ' ')), '\s+', ' ', 'g')), '') AS object
  FROM manual_gt_example WHERE item_id IS NOT NULL AND lower(trim(coalesce(annotation.status, ''))) NOT IN ('pending', 'skip', 'skipped', 'invalid', 'excluded')),
v AS (SELECT * FROM n WHERE verb <> '' QUALIFY row_number() OVER (PARTITION BY item, a ORDER BY submitted_at DESC, gt_row_id DESC) = 1),
l AS (SELECT item, 'verb' AS field, verb AS label FROM v UNION ALL SELECT item, 'object', object FROM v),
c AS (SELECT field, item, label, count(*) AS n FROM l GROUP BY ALL),
p AS (SELECT field, item, sum(n) AS m, sum(n * (n - 1)) AS same FROM c GROUP BY ALL HAVING sum(n) > 1),
s AS (SELECT field, count(*) AS items, CAST(sum(m) AS BIGINT) AS votes, sum(same / (m - 1)) AS agree FROM p GROUP BY field),
b AS (SELECT field, label, sum(n) AS n FROM c SEMI JOIN p USING (field, item) GROUP BY ALL),
h AS (SELECT field, sum(n * (n - 1)) AS chance FROM b GROUP BY field),
o AS (SELECT field, items, votes, agree / votes AS observed, chance / (votes * (votes - 1)) AS expected FROM s JOIN h USING (field))
SELECT *, CASE WHEN expected < 1 THEN 1 - (1 - observed) / (1 - expected) END AS alpha FROM o
"""
QUERIES |= {"p6_found": p6_found, "p6_annotators": p6_annotators, "p6_agreement": p6_agreement}
ORACLES |= {"p6_agreement": P6_AGREEMENT}


# 9: mixing sources to target weights
#: Units of size by name; the session setting `susurrus.mix.unit` picks one, "tokens" if it is unset. ("words" is the unit
#: that the problem's statement has for its smallest scale.)
UNITS = {"tokens": lambda: mixing.token_counts(), "words": lambda: mixing.word_counts}


def _mix(spark: SparkSession, d: str, unit: str | None = None) -> tuple[DataFrame, DataFrame]:
    size = UNITS[unit or spark.conf.get("susurrus.mix.unit", "tokens")]()
    return mixing.mix(table(spark, d, "documents"), "doc_id", "source", "text", table(spark, d, "source_target"), size)


def p9_found(spark: SparkSession, d: str, unit: str | None = None) -> DataFrame:
    """Sources whose last copy in the queue finishes before the virtual time of the budget."""
    return _mix(spark, d, unit)[1].where("short").select("source")


def p9_mix(spark: SparkSession, d: str, unit: str | None = None) -> DataFrame:
    """Every copy of a document in the mixture."""
    return _mix(spark, d, unit)[0].select(F.col("doc").alias("doc_id"), "source", "copy", F.col("size").alias("tokens"), "finish")


def p9_report(spark: SparkSession, d: str, unit: str | None = None) -> DataFrame:
    """Target and actual share of every source."""
    return _mix(spark, d, unit)[1]


def p9_words(spark: SparkSession, d: str) -> DataFrame:
    """The report with sizes in words between blanks, which SQL can count: available size and whether a source is short."""
    return p9_report(spark, d, "words").select("source", "available", "short")


P9_WORDS = r"""
WITH x AS (SELECT source, len(list_filter(regexp_split_to_array(text, '[\s\x0b\x{85}\p{Z}]+'), lambda w: w <> '')) AS n FROM documents WHERE source IS NOT NULL AND text IS NOT NULL),
t AS (SELECT source, sum(n) AS n FROM x GROUP BY source), b AS (SELECT max(budget_factor) * (SELECT sum(n) FROM x) AS budget FROM source_target)
SELECT source, CAST(coalesce(n, 0) AS BIGINT) AS available, coalesce(n, 0) * max_repeats < target_share * budget AS short FROM source_target LEFT JOIN t USING (source), b
"""
#: Any common tokenizer gives the same sources: here words in pieces of up to six letters and numbers of up to three digits.
P9_FOUND = r"""
WITH x AS (SELECT source, len(regexp_extract_all(text, '''(?:[sdmt]|ll|ve|re)| ?\p{L}{1,6}| ?\p{N}{1,3}| ?[^\s\p{L}\p{N}]+|\s+')) AS n FROM documents WHERE source IS NOT NULL AND text IS NOT NULL),
t AS (SELECT source, sum(n) AS n FROM x GROUP BY source), b AS (SELECT max(budget_factor) * (SELECT sum(n) FROM x) AS budget FROM source_target)
SELECT source FROM source_target LEFT JOIN t USING (source), b WHERE coalesce(n, 0) * max_repeats < target_share * budget
"""
QUERIES |= {"p9_found": p9_found, "p9_mix": p9_mix, "p9_report": p9_report, "p9_words": p9_words}
ORACLES |= {"p9_found": P9_FOUND, "p9_words": P9_WORDS}


# 10: subject area of each document
def _areas(spark: SparkSession, d: str) -> DataFrame:
    return topics.areas(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "doc_area_label"), "area", "lang", table(spark, d, "eval_item").select("text"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Every area that at least three sentences of a document treat."""
    return _areas(spark, d).select("doc_id", "area")


def p10_makeup(spark: SparkSession, d: str) -> DataFrame:
    """Documents and characters by area; documents of no area stand under a null area."""
    docs = table(spark, d, "documents").select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("chars"))
    return docs.join(_areas(spark, d), "doc_id", "left").groupBy("area").agg(F.count("*").alias("documents"), F.sum("chars").alias("chars"))


QUERIES |= {"p10_found": p10_found, "p10_makeup": p10_makeup}


# 1: missing or wrong document language labels
def _runs(spark: SparkSession, d: str) -> DataFrame:
    return languages.language_runs(table(spark, d, "timeline").select("line_id", "title", "lang"), "line_id", "title", "lang")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """The runs of every title with a missing or wrong language, or with several."""
    return _runs(spark, d).where((F.col("runs") > 1) | ~F.col("declared").eqNullSafe(F.col("lang"))).select("line_id", "run_no", "lang")


def p1_runs(spark: SparkSession, d: str) -> DataFrame:
    """All runs with their confidence."""
    return _runs(spark, d)


QUERIES |= {"p1_found": p1_found, "p1_runs": p1_runs}


# the readings of every distinct value against every alias, by brute force
P5_FOUND = r"""
WITH a AS (SELECT array_to_string(regexp_extract_all(lower(alias), '[\p{L}\p{N}]+'), '') AS a, min(struct_pack(alias := alias, g := group_id)).g AS g FROM noun_alias_v1 GROUP BY 1),
t AS (SELECT label_id, 'subject' AS field_name, subject AS v FROM train_label UNION ALL SELECT label_id, 'object', object FROM train_label),
c AS (SELECT * FROM t WHERE v IS NOT NULL AND trim(v) <> '' AND lower(trim(v)) <> 'fail' AND v NOT IN (SELECT alias FROM noun_alias_v1)),
d AS (SELECT DISTINCT v, list_filter(regexp_split_to_array(lower(replace(v, '_', ' ')), '[,;()\[\]{}]|\s[-–—]+\s'), lambda p: regexp_matches(p, '[\p{L}\p{N}]')) AS parts FROM c),
p AS (SELECT v, unnest([array_to_string(parts, ' '), array_to_string(list_reverse(parts), ' '), coalesce(parts[1], '')]) AS phrase FROM d),
w AS (SELECT v, regexp_extract_all(phrase, '[\p{L}\p{N}]+') AS ws FROM p),
s AS (SELECT DISTINCT v, array_to_string(ws[k:], '') AS r FROM (SELECT v, ws, unnest(range(1, len(ws) + 1)) AS k FROM w)),
m AS (SELECT v, a.a, a.g, levenshtein(r, a.a) AS e FROM s JOIN a ON abs(length(r) - length(a.a)) <= 3),
b AS (SELECT v, g FROM m WHERE e <= CASE WHEN length(a) <= 5 THEN 1 WHEN length(a) <= 9 THEN 2 ELSE 3 END QUALIFY row_number() OVER (PARTITION BY v ORDER BY e / length(a), -length(a), a) = 1)
SELECT label_id, field_name, coalesce(g, 'unmatched') AS group_id FROM c LEFT JOIN b USING (v)
"""
P5_UNMATCHED = P5_FOUND.rsplit("SELECT label_id", 1)[0] + "SELECT v AS value, count(*) AS n FROM c LEFT JOIN b USING (v) WHERE g IS NULL GROUP BY v"
ORACLES |= {"p5_found": P5_FOUND, "p5_unmatched": P5_UNMATCHED}
