"""Mapping freely entered values to a canonical list: a pigeonhole join in built-in functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import cut
from .words import folded

#: A reference list, or a map of values, of up to this many rows is broadcast (some 100 bytes a row); larger ones shuffle.
BROADCAST_ROWS = 300_000
UNMATCHED = "unmatched"


def edits(length):
    """Edits allowed for a reference string of so many letters and digits: 1 up to five, 2 up to nine, else 3."""
    return F.when(length <= 5, 1).when(length <= 9, 2).otherwise(3)


def _tokens(text):
    return F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def readings(value, most_words):
    """The squeezed strings that a value may mean: the last 1, 2, ... `most_words` words of its phrases.

    A suffix of more words than the longest alias and its edits have letters can't match, as a word has a letter; so
    `most_words` = letters + 3 leaves out nothing. Parts are set off by commas, brackets, semicolons and dashes between blanks. Phrases are the parts in order, the parts
    in reverse order ("lid, tin") and the first part; words before the noun only describe it, so all suffixes count.
    """
    x = F.translate(folded(value), "_", " ")
    parts = F.filter(F.split(x, r"[,;()\[\]{}]|\s[-–—]+\s"), lambda p: p.rlike(r"[\p{L}\p{N}]"))
    phrases = F.array(F.array_join(parts, " "), F.array_join(F.reverse(parts), " "), F.coalesce(F.get(parts, 0), F.lit("")))

    def suffixes(phrase):
        w = _tokens(phrase)
        n = F.size(w)
        at = F.when(n > 0, F.sequence(F.greatest(F.lit(1), n - most_words + 1), n)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.array_join(F.slice(w, i, n), ""))

    return F.array_distinct(F.flatten(F.transform(phrases, suffixes)))


def match(values: DataFrame, value: str, refs: DataFrame, alias: str, group: str) -> DataFrame:
    """Rows (value, group, alias, edits): every distinct value with its group, or with `unmatched`.

    Reference strings, squeezed to letters and digits, are cut into k + 1 segments, k being the edits that their length
    allows; a reading within k edits holds one segment unchanged, shifted by at most k. So the positional substrings of
    each reading are equality-joined with the segments, candidates are verified with levenshtein, the best (fewest edits
    a letter, then the longest, then the smallest alias) wins, and values without one come from an anti-join.

    Null values and null aliases are ignored; blank ones are unmatched; equal values are matched once.
    """
    ref = refs.select(F.array_join(_tokens(folded(F.col(alias))), "").alias("a"), F.col(alias).alias("alias"), F.col(group).alias("grp"))
    ref = cut(ref.where("a <> '' and grp is not null").groupBy("a").agg(F.min(F.struct("alias", "grp")).alias("x")).select("a", "x.*", F.length("a").alias("len")).withColumn("k", edits(F.col("len"))))
    stats = ref.agg(F.count("*").alias("n"), F.coalesce(F.max("len"), F.lit(1)).alias("letters")).first()
    hint = F.broadcast if stats["n"] <= BROADCAST_ROWS else (lambda x: x)

    distinct = values.select(F.col(value).alias("value")).where("value is not null").distinct()
    longest = stats["letters"] + 3
    reads = cut(distinct.select("value", F.explode(F.filter(readings(F.col("value"), longest), lambda r: F.length(r) <= longest)).alias("r")).distinct())

    # segment i of an alias of length len starts at begin and has size letters; the first (len mod (k + 1)) are one longer
    spread = lambda f: f.withColumn("base", F.floor(F.col("len") / (F.col("k") + 1))).withColumn("more", F.col("len") % (F.col("k") + 1))
    cuts = lambda f: (
        spread(f).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("k"))))
        .withColumn("begin", F.col("i") * F.col("base") + F.least("i", "more")).withColumn("size", F.col("base") + (F.col("i") < F.col("more")).cast("int"))
    )
    segments = cuts(ref).select("a", "len", "i", F.expr("substring(a, cast(begin as int) + 1, cast(size as int))").alias("seg"))
    shapes = cuts(ref.select("len", "k").distinct()).select("len", "k", "i", "begin", "size")  # one row a length and segment

    words = reads.select("r").distinct().withColumn("m", F.length("r")).where("m > 0")
    near = words.withColumn("len", F.explode(F.sequence(F.greatest(F.lit(1), F.col("m") - 3), F.col("m") + 3))).join(F.broadcast(shapes), "len").where("abs(m - len) <= k")
    delta = F.col("m") - F.col("len")
    lo = F.greatest(F.lit(0), F.col("begin") - F.col("i"), F.col("begin") + delta - (F.col("k") - F.col("i")))
    hi = F.least(F.col("m") - F.col("size"), F.col("begin") + F.col("i"), F.col("begin") + delta + (F.col("k") - F.col("i")))
    keys = near.withColumn("lo", lo).withColumn("hi", hi).where("lo <= hi").select("r", "len", "k", "i", "size", F.explode(F.sequence("lo", "hi")).alias("at"))
    keys = keys.select("r", "len", "k", "i", F.expr("substring(r, cast(at as int) + 1, cast(size as int))").alias("seg"))
    pairs = keys.join(hint(segments), ["len", "i", "seg"]).select("r", "a", "len", "k").distinct()
    good = pairs.withColumn("edits", F.levenshtein("r", "a")).where("edits <= k")
    best = good.groupBy("r").agg(F.min(F.struct((F.col("edits") / F.col("len")).alias("rate"), (-F.col("len")).alias("neg"), F.col("a"), F.col("edits"))).alias("b"))
    matched = (
        reads.join(best, "r").groupBy("value").agg(F.min("b").alias("b"))
        .join(hint(ref.select(F.col("a"), "alias", "grp")), F.col("b.a") == F.col("a")).select("value", F.col("grp").alias("group"), "alias", F.col("b.edits").alias("edits"))
    )
    matched = cut(matched)
    missing = distinct.join(matched, "value", "left_anti").select("value", F.lit(UNMATCHED).alias("group"), F.lit(None).cast("string").alias("alias"), F.lit(None).cast("int").alias("edits"))
    return matched.unionByName(missing)


def attach(rows: DataFrame, key: str, counted: DataFrame, found: DataFrame) -> DataFrame:
    """`rows` joined with `found` (one row a value) on `key`. `counted` has (value, n) of the rows.

    A small map is broadcast. Beyond BROADCAST_ROWS values, those that hold at least one row in 2,000 (so at most 2,000
    values) are still broadcast and the others shuffled, so no task gets all rows of a hot value.
    """
    n = found.count()
    if n <= BROADCAST_ROWS:
        return rows.join(F.broadcast(found), rows[key] == found["value"]).drop("value")
    whole = counted.agg(F.sum("n")).first()[0]
    hot = cut(counted.where(F.col("n") >= whole / 2000).select("value"))
    few = found.join(F.broadcast(hot), "value")
    a = rows.join(F.broadcast(few), rows[key] == few["value"]).drop("value")
    b = rows.join(F.broadcast(hot.withColumnRenamed("value", "__hot")), F.col(key) == F.col("__hot"), "left_anti")
    return a.unionByName(b.join(found, b[key] == found["value"]).drop("value"))
