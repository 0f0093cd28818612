"""Splits that keep related records together."""

from __future__ import annotations

import heapq
import math
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import hot_join
from ..sources.tables import cut
from .components import components

#: What stands where an author is not named.
NOBODY = ["-", "unknown", "n/a"]


@F.pandas_udf(T.StringType())
def author_key(raw: pd.Series) -> pd.Series:
    """Letters and digits of a name without case and character width; null if it names nobody."""

    def one(x: str | None) -> str | None:
        if x is None:
            return None
        x = unicodedata.normalize("NFKC", x).casefold()
        if x.strip() in NOBODY:
            return None
        return "".join(c for c in unicodedata.normalize("NFKC", x) if c.isalnum()) or None

    return raw.map(one, na_action="ignore")


def author_keys(events: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (author, author_key) of the distinct spellings in both tables that name somebody, written once: the Python
    function sees each spelling once, not each row."""
    raw = events.select("author").unionByName(labels.select("author")).where("author is not null").distinct()
    keys = cut(raw.select("author", author_key("author").alias("author_key")))
    return keys.where("author_key is not null")


def clip_videos(events: DataFrame) -> DataFrame:
    """Distinct (id, wav): the clips that the events of a video list, written once."""
    x = events.select("id", F.explode("segments").alias("s")).select("id", F.col("s.audio_path").alias("wav"))
    return cut(x.where("id is not null and wav is not null").distinct())


def video_authors(events: DataFrame, labels: DataFrame, keys: DataFrame | None = None, listed: DataFrame | None = None) -> DataFrame:
    """Distinct (id, author): the authors of a video's event rows and of the label rows whose `wav` its events list."""
    keys = author_keys(events, labels) if keys is None else keys
    listed = clip_videos(events) if listed is None else listed
    own = events.select("id", "author").where("id is not null and author is not null").distinct()
    by_wav = labels.select("wav", "author").where("wav is not null and author is not null").distinct()
    raw = own.unionByName(listed.join(by_wav, "wav").select("id", "author")).distinct()
    return hot_join(raw, keys, "author", "inner").select("id", F.col("author_key").alias("author")).distinct()


def video_groups(events: DataFrame, labels: DataFrame, authors: DataFrame | None = None) -> DataFrame:
    """Rows (id, component): every video with the smallest id of its group.

    Two videos belong together if one author has rows of both, directly or through further videos and authors. Null ids
    are ignored; null, blank and placeholder authors join nothing; null or empty `segments` list no clips.
    """
    return components(events, video_authors(events, labels) if authors is None else authors, "id", "author")


def clip_groups(events: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (label_id, component, verb) of `labels`, written once: the group of the clip's video; a clip that no event
    lists hangs on its author's group, or on its own wav (its own row, if that is null). Hot videos, authors and clips are
    joined by broadcast apart from the rest (`hot_join`)."""
    keys, listed = author_keys(events, labels), clip_videos(events)
    authors = cut(video_authors(events, labels, keys, listed))
    groups = cut(video_groups(events, labels, authors))
    by_wav = cut(hot_join(listed.groupBy("wav").agg(F.min("id").alias("id")), groups, "id").select("wav", F.col("component").alias("of_wav")))
    firsts = authors.groupBy("author").agg(F.min("id").alias("id"))
    by_author = cut(hot_join(firsts, groups, "id").select(F.col("author").alias("author_key"), F.col("component").alias("of_author")))
    base = hot_join(labels.select("label_id", "wav", "author", F.regexp_replace(F.lower(F.trim("verb")), r"\s+", "_").alias("verb")), keys, "author")
    at = hot_join(hot_join(base, by_wav, "wav"), by_author, "author_key")
    alone = F.coalesce(F.concat(F.lit("author:"), "author_key"), F.concat(F.lit("wav:"), "wav"), F.concat(F.lit("row:"), F.col("label_id").cast("string")))
    return cut(at.select("label_id", F.coalesce("of_wav", "of_author", alone).alias("component"), "verb"))


class Balance:
    """How far splits are from their targets, with moves and swaps of units (sparse label vectors).

    The cost is the sum over labels of their weight times the squared deviations of the splits' counts from the targets,
    each as a share of the label's rows; the number of rows in all counts as a further label of weight `size_weight`.
    """

    def __init__(self, vectors: list[dict[int, float]], targets: list[float], size_weight: float) -> None:
        n_lab = max((k for v in vectors for k in v), default=-1) + 1
        self.at = [np.array([*v, n_lab]) for v in vectors]
        self.n = [np.array([*v.values(), sum(v.values())], float) for v in vectors]
        whole = np.zeros(n_lab + 1)
        for at, n in zip(self.at, self.n, strict=True):
            whole[at] += n
        self.whole, self.targets = whole, np.array(targets)
        self.weight = np.append(whole[:-1] / max(whole[-1], 1), size_weight) / np.maximum(whole, 1) ** 2
        self.off = -np.outer(whole, self.targets)  # counts minus targets, labels x splits
        self.split = np.full(len(vectors), -1)

    def put(self, u: int, s: int) -> None:
        if self.split[u] >= 0:
            self.off[self.at[u], self.split[u]] -= self.n[u]
        self.split[u] = s
        self.off[self.at[u], s] += self.n[u]

    def gains(self, u: int) -> np.ndarray:
        """Change of the cost if unit `u` moved to each split."""
        off, w = self.off[self.at[u]], (self.weight[self.at[u]] * self.n[u])[:, None]
        return 2 * (w * (off - off[:, [self.split[u]]] + self.n[u][:, None])).sum(0) * (np.arange(len(self.targets)) != self.split[u])

    def refine(self, swaps: int = 200, sweeps: int = 50) -> None:
        """Moves, then swaps among the `swaps` largest units, until none lowers the cost."""
        order = sorted(range(len(self.n)), key=lambda u: -self.n[u][-1])
        few = order[:swaps]
        dense = np.zeros((len(few), len(self.whole)))
        for k, u in enumerate(few):
            dense[k, self.at[u]] = self.n[u]
        cross = (dense * self.weight) @ dense.T
        for _ in range(sweeps):
            moved = False
            for u in order:
                g = self.gains(u)
                if g.min() < -1e-12:
                    self.put(u, int(g.argmin()))
                    moved = True
            if few:
                g, s = np.array([self.gains(u) for u in few]), self.split[few]
                change = g[:, s] + g[:, s].T - 4 * cross
                change[s[:, None] == s[None, :]] = 0
                i, j = np.unravel_index(int(change.argmin()), change.shape)
                if change[i, j] < -1e-12:
                    a, b = int(s[i]), int(s[j])
                    self.put(few[i], b)
                    self.put(few[j], a)
                    moved = True
            if not moved:
                return


def iterative_stratification(vectors: list[tuple], targets: dict[str, float], size_weight: float = 4.0) -> dict:
    """Places (key, {label: rows}): the label with the fewest outstanding rows first, its largest holder into the split
    that needs that label most among those that the holder doesn't fill beyond their size (ties: that needs most rows; if
    it fits nowhere: that needs most rows). Then units are moved and swapped while that brings the splits nearer to their
    targets. Returns key -> split."""
    splits = sorted(targets)
    vectors = sorted(vectors, key=lambda x: str(x[0]))
    names = sorted({k for _, v in vectors for k in v}, key=str)
    number = {k: i for i, k in enumerate(names)}
    units = [{number[k]: float(n) for k, n in sorted(v.items(), key=lambda x: str(x[0]))} for _, v in vectors]
    size = [sum(v.values()) for v in units]
    state = Balance(units, [targets[s] for s in splits], size_weight)
    outstanding, holders = np.zeros(len(names)), [set() for _ in names]
    for u, v in enumerate(units):
        for k, n in v.items():
            outstanding[k] += n
            holders[k].add(u)
    heap = [(n, k) for k, n in enumerate(outstanding)]
    heapq.heapify(heap)
    while heap:
        n, k = heapq.heappop(heap)
        if not holders[k] or n != outstanding[k]:
            continue  # placed with others, or counted anew below
        touched = set()
        for u in sorted(holders[k], key=lambda u: (-units[u][k], u)):
            room = -state.off[-1]
            fits = room >= size[u] - 1e-9
            need = -state.off[k]
            s = max(range(len(splits)), key=lambda j: (fits[j], need[j] if fits[j] else 0.0, room[j], -j))
            state.put(u, s)
            for j, m in units[u].items():
                outstanding[j] -= m
                holders[j].discard(u)
                touched.add(j)
        for j in touched:
            if holders[j]:
                heapq.heappush(heap, (outstanding[j], j))
    state.refine()
    return {key: splits[state.split[u]] for u, (key, _) in enumerate(vectors)}


def grouped_split(rows: DataFrame, group: str, label: str, targets: dict[str, float], large_share: float = 1 / 2000, parts: int = 64) -> DataFrame:
    """Rows (group, split): one split for every group, so that the shares of each label come close to `targets`.

    Groups are components; their label vectors are aggregated. What `iterative_stratification` places are units: a group
    with at least `large_share` of all rows is a unit of its own; the others are gathered by the rarest label that they
    hold, and where a label has more than `parts` of them, they are tied by hash into at least `parts` bundles, none
    of which is expected to hold more than half of `large_share` of all rows. So large and small groups are placed by one method and
    every label counts; bundles are only as fine as the shares need. The driver holds at most 3 / large_share + 2 * parts
    * labels units, so labels must be values of a vocabulary, not free text.

    Null groups are left out; a null label is a label of its own; an empty table gives no rows; splits without a positive
    target get nothing; if no target is positive, all is an error.
    """
    targets = {k: v for k, v in targets.items() if v and v > 0}
    if not targets:
        raise ValueError("no split has a positive target")
    scale = sum(targets.values())
    targets = {k: v / scale for k, v in sorted(targets.items())}
    spark = rows.sparkSession
    counts = cut(rows.where(F.col(group).isNotNull()).groupBy(F.col(group).alias("g"), F.coalesce(F.col(label).cast("string"), F.lit("\0none")).alias("l")).agg(F.count("*").alias("n")))
    total = {x["l"]: x["n"] for x in counts.groupBy("l").agg(F.sum("n").alias("n")).collect()}
    size = sum(total.values())
    if not size:
        return counts.select(F.col("g").alias(group), F.lit(None).cast("string").alias("split")).limit(0)
    rank = {k: i for i, k in enumerate(sorted(total, key=lambda k: (total[k], k)))}
    ranks = F.broadcast(spark.createDataFrame(list(rank.items()), "l string, rank int"))
    # one row a group; its vector has at most one entry a label
    homes = cut(counts.join(ranks, "l").groupBy("g").agg(F.sum("n").alias("size"), F.min("rank").alias("cls"), F.collect_list(F.struct("rank", "n")).alias("v")))
    large = F.col("size") >= large_share * size
    classes = homes.where(~large).groupBy("cls").agg(F.count("*").alias("groups"), F.sum("size").alias("rows")).collect()
    plan = [(x["cls"], 0 if x["groups"] <= parts else max(parts, math.ceil(2 * x["rows"] / (large_share * size)))) for x in classes]
    plan = F.broadcast(spark.createDataFrame(plan, "cls int, bundles int"))
    own = large | (F.coalesce("bundles", F.lit(0)) == 0)
    bundle = F.concat_ws("|", "cls", F.pmod(F.xxhash64("g"), F.col("bundles")))
    units = cut(homes.join(plan, "cls", "left").select("g", "v", F.when(own, F.concat(F.lit("g|"), F.col("g").cast("string"))).otherwise(F.concat(F.lit("b|"), bundle)).alias("unit")))
    vectors: dict = {}
    for x in units.select("unit", F.explode("v").alias("x")).groupBy("unit", "x.rank").agg(F.sum("x.n").alias("n")).collect():
        vectors.setdefault(x["unit"], {})[x["rank"]] = x["n"]
    placed = iterative_stratification(list(vectors.items()), targets)
    split = F.broadcast(spark.createDataFrame(list(placed.items()), "unit string, split string"))
    return units.select("g", "unit").join(split, "unit").select(F.col("g").alias(group), "split")
