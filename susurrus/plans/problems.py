"""Queries of the core's data problems (intervals, packed fields)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.intervals import periods_and_gaps
from ..operators.packed import delimiter_scores, unpack
from ..sources.tables import table

SIX_HOURS_MS = 6 * 3600 * 1000


def _intervals(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "train_events").select(F.lit("train_events").alias("src"), F.col("id").alias("video_id"), F.col("start_sec").alias("a"), F.col("end_sec").alias("b"))
    b = table(spark, d, "segment_label_parse").select(F.lit("segment_label_parse").alias("src"), "video_id", F.col("clean_start").alias("a"), F.col("clean_end").alias("b"))
    return a.unionByName(b)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Continuous periods, and gaps of up to six hours, of each video in both tables."""
    return periods_and_gaps(_intervals(spark, d), ["src", "video_id"], "a", "b", SIX_HOURS_MS)


def p3_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Covered and open time of each video and table, all gaps included."""
    x = periods_and_gaps(_intervals(spark, d), ["src", "video_id"], "a", "b")
    ms = F.col("to_ms") - F.col("from_ms")
    return x.groupBy("src", "video_id").agg(
        F.count_if(F.col("kind") == "period").alias("periods"), F.count_if(F.col("kind") == "gap").alias("gaps"),
        F.coalesce(F.sum(F.when(F.col("kind") == "period", ms)), F.lit(0)).alias("covered_ms"), F.coalesce(F.sum(F.when(F.col("kind") == "gap", ms)), F.lit(0)).alias("open_ms"),
    )


_P3 = """
WITH x AS (
  SELECT 'train_events' AS src, id AS video_id, CAST(round(start_sec * 1000) AS BIGINT) AS s, CAST(round(end_sec * 1000) AS BIGINT) AS e FROM train_events
  UNION ALL
  SELECT 'segment_label_parse', video_id, CAST(round(clean_start * 1000) AS BIGINT), CAST(round(clean_end * 1000) AS BIGINT) FROM segment_label_parse),
d AS (SELECT src, video_id, s, max(e) AS e FROM x WHERE s < e GROUP BY src, video_id, s),
y AS (SELECT *, max(e) OVER (PARTITION BY src, video_id ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM d),
z AS (SELECT *, sum(CASE WHEN prev IS NULL OR s > prev THEN 1 ELSE 0 END) OVER (PARTITION BY src, video_id ORDER BY s ROWS UNBOUNDED PRECEDING) AS label FROM y),
p AS (SELECT src, video_id, label, min(s) AS s, max(e) AS e FROM z GROUP BY ALL),
g AS (SELECT src, video_id, lag(e) OVER (PARTITION BY src, video_id ORDER BY s) AS from_ms, s AS to_ms FROM p),
u AS (SELECT src, video_id, 'period' AS kind, s AS from_ms, e AS to_ms FROM p UNION ALL SELECT src, video_id, 'gap', from_ms, to_ms FROM g WHERE from_ms IS NOT NULL)
"""
P3_FOUND = _P3 + "SELECT * FROM u WHERE kind = 'period' OR to_ms - from_ms <= 21600000"
P3_COVERAGE = _P3 + """SELECT src, video_id, count(*) FILTER (kind = 'period') AS periods, count(*) FILTER (kind = 'gap') AS gaps,
CAST(coalesce(sum(to_ms - from_ms) FILTER (kind = 'period'), 0) AS BIGINT) AS covered_ms, CAST(coalesce(sum(to_ms - from_ms) FILTER (kind = 'gap'), 0) AS BIGINT) AS open_ms
FROM u GROUP BY src, video_id"""


def _cells(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "timeline").select(
        F.lit("timeline").alias("table_name"), F.col("line_id").cast("string").alias("row_key"),
        F.explode(F.array(F.struct(F.lit("clean_start").alias("field_name"), F.col("clean_start").alias("cell")), F.struct(F.lit("clean_end").alias("field_name"), F.col("clean_end").alias("cell")))).alias("x"),
    ).select("table_name", "row_key", "x.*")
    v = table(spark, d, "asmr_verb_classes_en").select(F.lit("asmr_verb_classes_en").alias("table_name"), F.col("verb_class").alias("row_key"), F.lit("verbs").alias("field_name"), F.col("verbs").alias("cell"))
    return t.unionByName(v).withColumn("source", F.concat_ws(".", "table_name", "field_name"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """One row per value of every cell with two or more values."""
    return unpack(_cells(spark, d), "source", "cell", ["table_name", "row_key", "field_name"])


def p7_delimiters(spark: SparkSession, d: str) -> DataFrame:
    """The scores from which the delimiters of each source are inferred."""
    x = delimiter_scores(_cells(spark, d), "source", "cell")
    return x.select("source", "delimiter", "cells", *[F.round(c, 6).alias(c) for c in ("pieces", "deviation", "regular", "numeric", "consistent", "score")])


def _p7_values(cell: str, separators: str) -> str:
    """SQL: the values of a cell split at any of `separators` outside quotes."""
    blanks = "' ' || chr(9) || chr(10)"
    core = rf"regexp_replace(trim({cell}, {blanks}), '^\[([^\[\]]*)\]$', '\1')"
    pieces = rf"""regexp_extract_all({core}, '\s*("[^"]*(?:""[^"]*)*"|''[^'']*(?:''''[^'']*)*''|[^{separators}]*)\s*(?:[{separators}]|$)', 1)"""
    bare = """CASE WHEN p LIKE '"%"' AND length(p) > 1 THEN replace(p[2:-2], '""', '"') WHEN p LIKE '''%''' AND length(p) > 1 THEN replace(p[2:-2], '''''', '''') ELSE p END"""
    return f"list_filter(list_transform(list_transform({pieces}, lambda q: trim(q, {blanks})), lambda p: {bare}), lambda p: trim(p) <> '')"


#: Delimiters stated for the SQL side; the query infers them.
P7_FOUND = rf"""
WITH t AS (SELECT 'timeline' AS table_name, CAST(line_id AS VARCHAR) AS row_key, 'clean_start' AS field_name, {_p7_values("clean_start", r";；,、|/\t\n ")} AS v FROM timeline
  UNION ALL SELECT 'timeline', CAST(line_id AS VARCHAR), 'clean_end', {_p7_values("clean_end", r";；,、|/\t\n ")} FROM timeline
  UNION ALL SELECT 'asmr_verb_classes_en', verb_class, 'verbs', {_p7_values("verbs", r";；,、|/\t\n")} FROM asmr_verb_classes_en)
SELECT table_name, row_key, field_name, CAST(unnest(range(len(v))) AS INT) AS pos, unnest(v) AS val FROM t WHERE len(v) >= 2
"""


#: Each candidate scored alone, written out in SQL.
P7_DELIMITERS = r"""
WITH t AS (SELECT 'timeline.clean_start' AS source, clean_start AS cell FROM timeline UNION ALL SELECT 'timeline.clean_end', clean_end FROM timeline UNION ALL SELECT 'asmr_verb_classes_en.verbs', verbs FROM asmr_verb_classes_en),
b AS (SELECT source, regexp_replace(trim(cell, ' ' || chr(9) || chr(10)), '^(?:\[([^\[\]]*)\]|\(([^()]*)\)|\{([^{}]*)\})$', '\1\2\3') AS c FROM t WHERE cell IS NOT NULL),
m AS (SELECT source, regexp_replace(regexp_replace(c, '"[^"]*(?:""[^"]*)*"', chr(1), 'g'), '''[^'']*(?:''''[^'']*)*''', chr(1), 'g') AS m FROM b),
d AS (SELECT unnest([';', '；', ',', '、', '，', '|', '/', chr(9), chr(10), ' ']) AS delimiter),
p AS (SELECT source, delimiter, list_filter(list_transform(string_split(m, delimiter), lambda x: trim(x, ' ' || chr(9) || chr(10))), lambda x: x <> '') AS ps
  FROM m JOIN d ON contains(m, delimiter) AND (delimiter <> ' ' OR NOT regexp_matches(m, '[;；,、，|/\t\n]'))),
n AS (SELECT source, delimiter, len(ps) AS n, len(list_filter(ps, lambda x: x = chr(1) OR regexp_full_match(x, '[+-]?(?:\d+:)*\d+(?:\.\d+)?'))) AS numeric,
  list_bool_and(list_transform(ps, lambda x: regexp_full_match(x, '(?:[+-]?(?:\d+:)*\d+(?:\.\d+)?|\x01)(?:[\s;；,、，|/]+(?:[+-]?(?:\d+:)*\d+(?:\.\d+)?|\x01))*[\s;；,、，|/]*')
    OR regexp_full_match(x, '[\p{L}\p{N}_''’-]+(?:[/&.+][\p{L}\p{N}_''’-]+)*(?: [\p{L}\p{N}_''’-]+(?:[/&.+][\p{L}\p{N}_''’-]+)*){0,3}'))) AS regular FROM p WHERE len(ps) > 0),
a AS (SELECT source, delimiter, count(*) AS cells, avg(n) AS pieces, stddev_pop(n) AS deviation, avg(CAST(regular AS INT)) AS regular, avg(numeric / n) AS numeric, max(n) AS most FROM n GROUP BY ALL),
k AS (SELECT * EXCLUDE (most), CASE WHEN most < 2 THEN 0 ELSE 1 / (1 + deviation / pieces) END AS consistent FROM a)
SELECT source, delimiter, cells, round(pieces, 6) AS pieces, round(deviation, 6) AS deviation, round(regular, 6) AS regular, round(numeric, 6) AS numeric, round(consistent, 6) AS consistent, round(regular * consistent, 6) AS score FROM k
"""


QUERIES = {"p3_found": p3_found, "p3_coverage": p3_coverage, "p7_found": p7_found, "p7_delimiters": p7_delimiters}
ORACLES = {"p3_found": P3_FOUND, "p3_coverage": P3_COVERAGE, "p7_found": P7_FOUND, "p7_delimiters": P7_DELIMITERS}
