"""Minimal-pair question banks: material families, clusters, multiple-choice options."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import group_id, slug
from ..sources.tables import cut
from .prefix import numbered
from .sampling import stable_hash
from .skew import hot_join

#: Materials that are hard to tell apart by sound; others are families of their own.
FAMILIES = [["rubber", "wax", "leather", "paper", "wood"], ["plastic", "glass", "metal"], ["textile_fibrous"], ["clay"], ["foam_lather"], ["foam_solid"]]
LETTERS = ["A", "B", "C", "D"]


def family(material: Column) -> Column:
    names = {m: f[0] for f in FAMILIES for m in f}
    table = F.create_map(*[F.lit(v) for kv in names.items() for v in kv])
    return F.coalesce(F.try_element_at(table, material), material)


def distant_subsets(materials: Column) -> Column:
    """The largest sets of materials of pairwise different families: one member of each family present, in every way.

    Nearness is an equivalence, so these are the products of the families; none where fewer than two families occur.
    """
    mats = F.array_sort(F.array_distinct(F.array_compact(materials)))
    fams = F.array_sort(F.array_distinct(F.transform(mats, family)))
    product = F.aggregate(
        fams, F.array(F.array().cast("array<string>")),
        lambda acc, f: F.flatten(F.transform(acc, lambda s: F.transform(F.filter(mats, lambda m: family(m) == f), lambda m: F.concat(s, F.array(m))))),
    )
    return F.when(F.size(fams) >= 2, F.transform(product, lambda s: F.array_sort(s))).otherwise(F.array().cast("array<array<string>>"))


def clusters(df: DataFrame, prefix: str, keys: list[str], value: str, item: str) -> DataFrame:
    """Rows (group_id, keys, values, members) of key groups with two or more distinct values. Members are counted, values
    collected as a set: their number is bounded by the closed vocabulary of `value`."""
    x = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.array_sort(F.collect_set(value)).alias("values"), F.countDistinct(item).alias("members"))
    return x.where(F.size("values") >= 2).select(group_id(prefix, *[F.col(k) for k in keys]).alias("group_id"), *keys, "values", "members")


def material_groups(df: DataFrame, prefix: str, keys: list[str], material: str, item: str) -> DataFrame:
    """Rows (group_id, keys, subset): one a largest distant subset of each key group; ids end in `__d` and the slugs of
    the subset where a group has several."""
    x = clusters(df, prefix, keys, material, item)
    x = x.withColumn("subsets", distant_subsets(F.col("values"))).where(F.size("subsets") > 0)
    y = x.select("group_id", *keys, F.size("subsets").alias("n"), F.explode("subsets").alias("subset"))
    ending = F.concat(F.lit("__d"), slug(F.array_join("subset", "-")))
    return y.withColumn("group_id", F.when(F.col("n") > 1, F.concat("group_id", ending)).otherwise(F.col("group_id"))).drop("n")


def _by_hash(seed: Column, values: Column) -> Column:
    """The array in the order of md5(seed:value)."""
    return F.transform(F.array_sort(F.transform(values, lambda v: F.struct(stable_hash(seed, v).alias("h"), v.alias("v")))), lambda s: s["v"])


def _options(x: DataFrame, qid: str, gold: str, pad: Column, pool_source: str, most: int) -> DataFrame:
    """`x` with its array `__near` (gold, then the group's other values) padded, cut to `most`, ordered by hash, exploded."""
    x = x.withColumn("__pad", F.slice(pad, 1, F.greatest(F.lit(0), most - F.size("__near"))))
    x = x.withColumn("__shown", _by_hash(F.col(qid), F.slice(F.array_distinct(F.concat("__near", "__pad")), 1, most)))
    x = x.select(qid, gold, "__near", F.posexplode("__shown").alias("k", "value"))
    source = F.when(F.col("value") == F.col(gold), "target").when(F.array_contains("__near", F.col("value")), "same_group").otherwise(pool_source)
    return x.select(qid, F.element_at(F.array(*[F.lit(c) for c in LETTERS]), F.col("k") + 1).alias("label"), "value", source.alias("source"))


def _with_near(questions: DataFrame, gold: str, group: str) -> DataFrame:
    return questions.withColumn("__near", F.concat(F.array(F.col(gold)), F.array_sort(F.array_except(F.col(group), F.array(F.col(gold))))))


def options(questions: DataFrame, pool: list[str], qid: str, gold: str, group: str, most: int = 4) -> DataFrame:
    """Rows (qid, label, value, source): gold, the other values of its group, then distant values of `pool` (a closed
    vocabulary) in hash order up to `most`; their order is by hash too. Each question is one row until its options are
    exploded; nothing is shuffled."""
    x = _with_near(questions, gold, group)
    far = F.filter(F.array(*[F.lit(v) for v in sorted(set(pool))]).cast("array<string>"), lambda v: ~F.array_contains("__near", v) & (family(v) != family(F.col(gold))))
    return _options(x, qid, gold, _by_hash(F.concat(F.col(qid), F.lit(":pad")), far), "distant_pool", most)


def _classes(pool: dict[str, str | None]) -> Column:
    rows = [F.struct(F.lit(v).alias("v"), F.lit(c).cast("string").alias("c")) for v, c in sorted(pool.items())]
    return F.array(*rows) if rows else F.array().cast("array<struct<v:string,c:string>>")


def near_verbs(gold: Column, pool: dict[str, str | None]) -> Column:
    """The other verbs of `pool` (verb -> class, a closed vocabulary), those of the gold verb's class first, each by name."""
    verbs = _classes(pool)
    own = F.get(F.filter(verbs, lambda s: s["v"] == gold), 0)["c"]
    some = lambda same: F.transform(F.filter(verbs, lambda s: (s["v"] != gold) & (s["c"].eqNullSafe(own) if same else ~s["c"].eqNullSafe(own))), lambda s: s["v"])
    return F.concat(some(True), some(False))


def distant_verbs(qid: Column, gold: Column, pool: dict[str, str | None]) -> Column:
    """Verbs of other classes in hash order, then all others by name."""
    verbs = _classes(pool)
    own = F.get(F.filter(verbs, lambda s: s["v"] == gold), 0)["c"]
    far = F.transform(F.filter(verbs, lambda s: (s["v"] != gold) & ~s["c"].eqNullSafe(own)), lambda s: s["v"])
    rest = F.transform(F.filter(verbs, lambda s: s["v"] != gold), lambda s: s["v"])
    return F.array_distinct(F.concat(_by_hash(F.concat(qid, F.lit(":vpad")), far), rest))


def verb_options(questions: DataFrame, pool: dict[str, str | None], qid: str, gold: str, group: str, distant: bool = False, most: int = 4) -> DataFrame:
    """As `options`, padded with near verbs (the class of the gold verb first) or, if `distant`, with verbs of other classes;
    adds `verb_class`. The padding is cut to the free places before what the group has already is left out."""
    x = _with_near(questions, gold, group)
    pad = distant_verbs(F.col(qid), F.col(gold), pool) if distant else near_verbs(F.col(gold), pool)
    y = _options(x, qid, gold, pad, "distant_pool" if distant else "near_pool", most)
    classes = F.create_map(*[F.lit(x) for v, c in sorted(pool.items()) if c for x in (v, c)]) if any(pool.values()) else F.create_map().cast("map<string,string>")
    return y.withColumn("verb_class", F.try_element_at(classes, F.col("value")))


def _key(keys: list[str]) -> Column:
    """One string of the key columns, in which a null differs from every value."""
    return F.to_json(F.struct(*[F.struct(F.col(k).cast("string").alias("v")).alias(f"k{i}") for i, k in enumerate(keys)]))


def members(clips: DataFrame, groups: DataFrame, keys: list[str], values: str, value: str, item: str) -> DataFrame:
    """Rows (group_id, item, gold, values, inst): the clips of each group whose value is one of the group's, numbered from 0
    by item. Hot groups are split (`hot_join`, `numbered`)."""
    own = cut(groups.groupBy(_key(keys).alias("__key")).agg(F.collect_list(F.struct("group_id", F.col(values).alias("values"))).alias("__groups")))  # a bucket has few groups
    x = hot_join(clips.where(F.col(value).isNotNull()).select(_key(keys).alias("__key"), F.col(item), F.col(value).alias("gold")), own, "__key", "inner")
    x = x.select(item, "gold", F.explode("__groups").alias("g")).select("g.group_id", item, "gold", "g.values").where(F.array_contains("values", F.col("gold")))
    return numbered(x, ["group_id"], [item], "inst")


def tier_one(clips: DataFrame, groups: DataFrame, keys: list[str], values: str, value: str, item: str) -> DataFrame:
    """Rows (question_id, group_id, item, gold, values): one question a member of a group."""
    m = members(clips, groups, keys, values, value, item)
    return m.select(F.concat("group_id", F.lit("__inst"), F.col("inst").cast("string")).alias("question_id"), "group_id", item, "gold", "values")


def tier_two(clips: DataFrame, used: DataFrame, prefix: str, value: str, item: str) -> DataFrame:
    """Rows (question_id, group_id, item, gold, values): one question a clip with a value that is in no group."""
    x = clips.where(F.col(value).isNotNull()).join(used.select(item).distinct(), item, "left_anti")
    return x.select(F.concat(F.lit(f"{prefix}__"), F.col(item)).alias("question_id"), F.lit(None).cast("string").alias("group_id"), item, F.col(value).alias("gold"), F.array(value).alias("values"))


def question_bank(questions: DataFrame, shown: DataFrame, task: str, item: str) -> DataFrame:
    """Questions (with their `tier`) and their options in one array, and the letter of the gold one."""
    o = shown.groupBy("question_id").agg(F.array_sort(F.collect_list(F.struct("label", "value", "source"))).alias("options"))
    gold = F.get(F.filter("options", lambda s: s["value"] == F.col("gold")), 0)["label"]
    return questions.join(o, "question_id").select("question_id", "group_id", F.lit(task).alias("task"), "tier", item, F.col("gold").alias("gold_value"), gold.alias("gold_label"), "options")


def same_flag(questions: DataFrame, clips: list[DataFrame], item: str) -> DataFrame:
    """Questions with the facts of their clip (struct `clip_meta`), of the last of `clips` (tables of the same columns, one
    row an item) that has it; null where none has it."""
    ranked = None
    for k, c in enumerate(clips):
        x = c.select(item, F.struct(F.lit(k).alias("k"), F.struct(*[x for x in c.columns if x != item]).alias("m")).alias("x"))
        ranked = x if ranked is None else ranked.unionByName(x)
    last = ranked.groupBy(item).agg(F.max_by("x.m", "x.k").alias("clip_meta"))
    return hot_join(questions, cut(last), item)


def group_lists(members_of: DataFrame, item: str) -> DataFrame:
    """Rows (item, group_ids): the groups of each clip, in order of their ids."""
    return members_of.groupBy(item).agg(F.array_sort(F.collect_set("group_id")).alias("group_ids"))


def question_numbers(df: DataFrame, group: str, order: str) -> Column:
    """0-based place of a member in its group, before anything is filtered."""
    return F.row_number().over(Window.partitionBy(group).orderBy(order)) - 1
