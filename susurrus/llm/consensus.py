"""Consensus from several annotators' labels: latent ability and difficulty, learned jointly."""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import hot_join
from ..sources.tables import cut


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def item_posteriors(at: np.ndarray, ann: np.ndarray, lab: np.ndarray, n_lab: np.ndarray, alpha: np.ndarray, wrong: float, steps: int = 12, rate: float = 0.5, prior: float = 4.0):
    """E-step and the item half of the M-step for votes (item, annotator, label), labels numbered from 0 within an item.

    A vote is right with probability sigmoid(alpha[annotator] * beta[item]), beta = exp(b) with a normal prior on b; a wrong
    vote falls on each of the other `wrong` labels alike. Returns (posterior of every (item, label), offsets of the items
    in it, posterior that each vote is right, its modelled probability, beta).
    """
    items = len(n_lab)
    off = np.concatenate([[0], np.cumsum(n_lab)])
    cell = off[at] + lab
    b = np.zeros(items)
    a = alpha[ann]
    for k in range(steps + 1):
        beta = np.exp(b)
        s = np.clip(_sigmoid(a * beta[at]), 1e-6, 1 - 1e-6)
        score = np.bincount(cell, np.log(s) - np.log((1 - s) / wrong), minlength=off[-1])
        top = np.maximum.reduceat(score, off[:-1]) if items else score
        e = np.exp(score - np.repeat(top, n_lab))
        p = e / np.repeat(np.add.reduceat(e, off[:-1]), n_lab) if items else e
        right = p[cell]
        if k < steps:
            grad = np.bincount(at, (right - s) * a, minlength=items) * beta - prior * b
            b = np.clip(b + rate * grad / (1 + np.bincount(at, np.abs(a), minlength=items) * beta), -2.5, 2.5)
    return p, off, right, s, beta


def ability_step(alpha: np.ndarray, grad: np.ndarray, weight: np.ndarray, mean: float = 1.0, prior: float = 0.5) -> np.ndarray:
    """One gradient step on the abilities, under a normal prior around `mean`, scaled by the curvature."""
    return np.clip(alpha + (grad - prior * (alpha - mean)) / (prior + weight), -8, 8)


#: States of a row that does not count.
NOT_FINISHED = ["pending", "skip", "skipped", "invalid", "excluded"]
#: Abilities of up to this many annotators are held by the driver (some 50 bytes each); more are an error. So an item has
#: at most so many votes, 16 bytes each, in its row.
MAX_ANNOTATORS = 1_000_000
#: The numbers of up to this many annotators are broadcast, beyond it they are joined by `hot_join`.
BROADCAST_ANNOTATORS = 100_000


def label_text(col):
    """A label trimmed, in lower case, with `_` and blanks alike."""
    x = F.regexp_replace(F.lower(F.translate(col, "_", " ")), r"(?U)\s+", " ")
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def votes(rows: DataFrame) -> DataFrame:
    """Rows (item, annotator, verb, object): the latest counting row of every annotator for every item.

    Rows with a status in NOT_FINISHED, a null or blank verb or a null item don't count; a null annotator is one annotator
    of its own; a null object is the label "none" (empty). Of rows with equal time the one with the greater id counts.
    """
    x = rows.select(
        F.col("item_id").alias("item"), F.coalesce("annotation.annotator_id", F.lit("")).alias("annotator"), F.lower(F.trim(F.coalesce("annotation.status", F.lit("")))).alias("status"),
        label_text(F.col("gt.verb")).alias("verb"), F.coalesce(label_text(F.col("gt.object")), F.lit("")).alias("object"), F.col("submitted_at").alias("at"), F.col("gt_row_id").alias("row"),
    ).where(F.col("item").isNotNull() & F.col("verb").isNotNull() & (F.col("verb") != "") & ~F.col("status").isin(NOT_FINISHED))
    last = x.groupBy("item", "annotator").agg(F.max(F.struct("at", "row", "verb", "object")).alias("x"))
    return last.select("item", "annotator", "x.verb", "x.object")


def agreement(v: DataFrame) -> DataFrame:
    """Rows (field, items, votes, observed, expected, alpha): Krippendorff's alpha for nominal labels, over the items with
    two or more votes. Only counts per (item, label) are aggregated; alpha is null where one label is all there is."""
    long = v.select("item", F.explode(F.array(F.struct(F.lit("verb").alias("field"), F.col("verb").alias("label")), F.struct(F.lit("object").alias("field"), F.col("object").alias("label")))).alias("x")).select("item", "x.*")
    cells = long.groupBy("field", "item", "label").agg(F.count("*").alias("n"))
    per = cells.groupBy("field", "item").agg(F.sum("n").alias("m"), F.sum(F.col("n") * (F.col("n") - 1)).alias("same")).where("m > 1")
    seen = per.groupBy("field").agg(F.count("*").alias("items"), F.sum("m").alias("votes"), F.sum(F.col("same") / (F.col("m") - 1)).alias("agree"))
    by_label = cells.join(per.select("field", "item"), ["field", "item"]).groupBy("field", "label").agg(F.sum("n").alias("n"))
    chance = by_label.groupBy("field").agg(F.sum(F.col("n") * (F.col("n") - 1)).alias("chance"))
    out = seen.join(chance, "field").select("field", "items", "votes", (F.col("agree") / F.col("votes")).alias("observed"), (F.col("chance") / (F.col("votes") * (F.col("votes") - 1))).alias("expected"))
    return out.withColumn("alpha", F.when(F.col("expected") < 1, 1 - (1 - F.col("observed")) / (1 - F.col("expected"))))


def _flat(batch: pa.RecordBatch):
    """Votes of a batch as arrays; the verb and the object of an item are two items of the model."""
    n = batch.num_rows
    size = np.diff(batch.column("ann").offsets.to_numpy())
    ann = batch.column("ann").flatten().to_numpy()
    at = np.repeat(np.arange(n), size)
    lab = np.concatenate([batch.column(c).flatten().to_numpy() for c in ("v", "o")])
    n_lab = np.concatenate([batch.column(c).to_numpy() for c in ("nv", "no")])
    return np.concatenate([at, at + n]), np.concatenate([ann, ann]), lab, n_lab


def fit(v: DataFrame, wrong: float = 2.0, max_rounds: int = 100, tolerance: float = 0.01):
    """(consensus, annotators) by gradient expectation-maximisation of the ability-difficulty model.

    consensus: (item, verb, object, verb_confidence, object_confidence, verb_difficulty, object_difficulty); annotators:
    (annotator, ability, reliability, votes, converged), reliability being the chance of a right label on an item of usual difficulty.

    An annotator has one ability for both fields. Items are packed once, one row with one vote an annotator, and stay in
    the shared folder; a round reads them, solves labels and difficulties per item given the abilities, and returns only
    the gradient sums of the annotators, pre-aggregated per task. `wrong` is the number of labels among which a wrong vote
    falls: wrong votes crowd on few likely confusions. Abilities don't fall below the point where a vote says nothing, so
    one who always gives the same label is ignored, not inverted. Ties go to the label that sorts first.

    Rounds end when no ability moves by `tolerance` or more; `max_rounds` without that is told by a warning, and the
    column `converged` of annotators says it too.
    """
    spark = v.sparkSession
    counted = v.groupBy("annotator").agg(F.count("*").alias("votes")).orderBy("annotator").limit(MAX_ANNOTATORS + 1).collect()
    if len(counted) > MAX_ANNOTATORS:
        raise ValueError(f"more than {MAX_ANNOTATORS} annotators")
    names = cut(spark.createDataFrame([(x["annotator"], k) for k, x in enumerate(counted)], "annotator string, k int"))
    numbered = v.join(F.broadcast(names), "annotator") if len(counted) <= BROADCAST_ANNOTATORS else hot_join(v, names, "annotator", "inner")
    place = lambda c: F.transform(F.col(c), lambda x: F.array_position(F.col(f"{c}s"), x).cast("int") - 1)
    packed = cut(
        numbered.groupBy("item").agg(F.sort_array(F.collect_list(F.struct("k", "verb", "object"))).alias("x"))
        .select("item", F.col("x.k").alias("ann"), F.col("x.verb").alias("verb"), F.col("x.object").alias("object"))
        .withColumn("verbs", F.array_sort(F.array_distinct("verb"))).withColumn("objects", F.array_sort(F.array_distinct("object")))
        .select("item", "ann", place("verb").alias("v"), place("object").alias("o"), "verbs", "objects", F.size("verbs").alias("nv"), F.size("objects").alias("no"))
    )
    votes_only = packed.select("ann", "v", "o", "nv", "no")
    floor = float(np.log(1 / wrong))
    alpha = np.ones(len(counted))
    moved = np.inf if counted else 0.0
    for _ in range(max_rounds if counted else 0):
        sent = spark.sparkContext.broadcast(np.maximum(alpha, floor))

        def sums(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            now = sent.value
            g, w = np.zeros(len(now)), np.zeros(len(now))
            for b in batches:
                if b.num_rows:
                    at, ann, lab, n_lab = _flat(b)
                    _, _, right, s, beta = item_posteriors(at, ann, lab, n_lab, now, wrong)
                    g += np.bincount(ann, (right - s) * beta[at], minlength=len(now))
                    w += np.bincount(ann, s * (1 - s) * beta[at] ** 2, minlength=len(now))
            k = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(g[k]), pa.array(w[k])], ["k", "g", "w"])

        got = votes_only.mapInArrow(sums, "k int, g double, w double").groupBy("k").agg(F.sum("g").alias("g"), F.sum("w").alias("w")).collect()
        sent.destroy()
        g, w = np.zeros(len(alpha)), np.zeros(len(alpha))
        for x in got:
            g[x["k"]], w[x["k"]] = x["g"], x["w"]
        after = ability_step(alpha, g, w)
        moved = float(np.abs(after - alpha).max())
        alpha = after
        if moved < tolerance:
            break
    if moved >= tolerance:
        warnings.warn(f"abilities still moved by {moved:.3g} after {max_rounds} rounds", stacklevel=2)
    final = spark.sparkContext.broadcast(np.maximum(alpha, floor))  # read when the consensus is; freed with it

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = final.value
        for b in batches:
            if not b.num_rows:
                continue
            p, off, _, _, beta = item_posteriors(*_flat(b), now, wrong)
            n = b.num_rows
            cell = np.arange(len(p)) - np.repeat(off[:-1], np.diff(off))
            order = np.lexsort((cell, -np.round(p, 9), np.repeat(np.arange(2 * n), np.diff(off))))
            best = cell[order[off[:-1]]]
            sure = p[off[:-1] + best]
            texts = [[x[k] for x, k in zip(b.column(c).to_pylist(), part, strict=True)] for c, part in (("verbs", best[:n]), ("objects", best[n:]))]
            yield pa.RecordBatch.from_arrays(
                [b.column("item"), pa.array(texts[0], pa.string()), pa.array(texts[1], pa.string()), *(pa.array(x) for x in (sure[:n], sure[n:], 1 / beta[:n], 1 / beta[n:]))],
                ["item", "verb", "object", "verb_confidence", "object_confidence", "verb_difficulty", "object_difficulty"],
            )

    schema = "item string, verb string, object string, verb_confidence double, object_confidence double, verb_difficulty double, object_difficulty double"
    consensus = packed.mapInArrow(label, schema)
    people = [(x["annotator"], float(a), float(_sigmoid(np.array([a]))[0]), x["votes"], moved < tolerance) for x, a in zip(counted, alpha, strict=True)]
    return consensus, spark.createDataFrame(people, "annotator string, ability double, reliability double, votes long, converged boolean")
