"""Subject areas of each document: complement naive Bayes, refined by expectation-maximisation, calibrated per area."""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import let
from ..sources.tables import cut
from .words import folded

#: Words are hashed to this many slots (a power of two); the model has slots x (areas + 1) numbers, whatever the corpus.
SLOTS = 1 << 17
#: Documents a task reads in a round, about.
DOCS_A_TASK = 5_000
TIME_STAMPED = r"^[\s\p{P}\p{S}]*(?:\d{1,3}:)?\d{1,3}:\d{2}(?!\d)"


def sentences(text):
    """Array of the sentences and lines of a (folded) text, without markup, time-stamped lines and code fences."""
    lines = F.split(F.regexp_replace(text, r"</?[A-Za-z][^<>]*+>", "\n"), r"[\n\r\u2028\u2029]+")
    kept = F.filter(lines, lambda x: ~x.rlike(TIME_STAMPED) & ~x.rlike(r"^\s*```"))
    return F.flatten(F.transform(kept, lambda x: F.split(x, r"(?<=[.!?…。！？])[\s\"'”’)]*\s+")))


def slots(text):
    """Per sentence the slots of its distinct words (two or more letters); sentences without words are dropped."""
    words = F.transform(sentences(folded(text)), lambda s: F.regexp_extract_all(s, F.lit(r"[\p{L}\p{M}]{2,}"), F.lit(0)))
    return F.filter(F.transform(words, lambda w: F.array_distinct(F.transform(w, lambda x: F.pmod(F.xxhash64(x), F.lit(SLOTS)).cast("int")))), lambda w: F.size(w) > 0)


def outside_log(n: np.ndarray, smooth: float = 0.5) -> np.ndarray:
    """Complement naive Bayes weights (classes x slots) of counts: minus the log share of a word outside a class."""
    out = n.sum(0, keepdims=True) - n + smooth
    return -np.log(out / out.sum(1, keepdims=True))


def complement_lifts(n: np.ndarray, floor: float = 0.5, smooth: float = 0.5) -> np.ndarray:
    """Weights of (no area, areas...) from the counts by area in labelled documents: the count in an area over the one
    that its complement, all other areas, leads to expect. No area has weight 0; one word tells at most log(floor) against."""
    whole = n.sum(0)
    own, out = n.sum(1, keepdims=True), whole - n
    expected = out * own / np.maximum(whole.sum() - own, 1)
    return np.vstack([np.zeros(n.shape[1]), np.log(1 - floor + floor * (n + smooth) / (expected + smooth))])


def pooled_log(n: np.ndarray, own: float = 0.5, smooth: float = 10.0) -> np.ndarray:
    """Log word shares of (no area, areas...) from expected counts. An area's words are half its own, half those of all
    areas, so phrases that all areas use tell areas from none, but not one area from another."""
    base = (n.sum(0) + 1e-3) / (n + 1e-3 / len(n)).sum()
    every = n[1:].sum(0)
    pool = (every + smooth * base) / (every.sum() + smooth)
    none = (n[0] + smooth * base) / (n[0].sum() + smooth)
    each = (n[1:] + smooth * pool) / (n[1:].sum(1, keepdims=True) + smooth)
    return np.log(np.vstack([none[None, :], own * each + (1 - own) * pool]))


def respond(tok: np.ndarray, lang: np.ndarray, at: np.ndarray, per_doc: np.ndarray, prior: np.ndarray, w: np.ndarray, bias: float, rounds: int = 4):
    """Class posteriors of each sentence; the class mix of its document is estimated along with them from `prior` (docs x classes).
    `w` is (languages x classes x slots), `lang` the language of each token's document; `bias` speaks for no area."""
    n = int(per_doc.sum())
    if not n:
        return np.zeros((0, w.shape[1]))
    like = np.column_stack([np.bincount(at, w[lang, c, tok], minlength=n) for c in range(w.shape[1])])
    like[:, 0] += bias
    off = np.concatenate([[0], np.cumsum(per_doc)])
    theta = prior
    for _ in range(rounds):
        x = like + np.repeat(np.log(theta + 1e-9), per_doc, axis=0)
        x = np.exp(x - x.max(1, keepdims=True))
        r = x / x.sum(1, keepdims=True)
        sums = np.concatenate([np.zeros((1, r.shape[1])), np.cumsum(r, 0)])
        theta = prior + sums[off[1:]] - sums[off[:-1]]
        theta = theta / theta.sum(1, keepdims=True)
    return r


def at_least(r: np.ndarray, per_doc: np.ndarray, k: int = 3) -> np.ndarray:
    """Chance (docs x classes) that k or more sentences of a document are of a class, sentences being independent."""
    p = np.clip(r, 1e-9, 1 - 1e-6)
    off = np.concatenate([[0], np.cumsum(per_doc)])

    def sums(x: np.ndarray) -> np.ndarray:
        c = np.concatenate([np.zeros((1, x.shape[1])), np.cumsum(x, 0)])
        return c[off[1:]] - c[off[:-1]]

    odds = p / (1 - p)
    none = sums(np.log1p(-p))
    e = [np.ones_like(none)]  # elementary symmetric sums by Newton's identities
    powers = [sums(odds**j) for j in range(1, k)]
    for j in range(1, k):
        e.append(sum((-1) ** (i - 1) * e[j - i] * powers[i - 1] for i in range(1, j + 1)) / j)
    below = sum(np.exp(none + np.log(np.maximum(x, 1e-300))) for x in e)
    return np.clip(1 - below, 0, 1)


def parts(b: pa.RecordBatch, most_tokens: int = 200_000) -> Iterator[tuple]:
    """(first row, end row, tokens, tokens per document, sentence sizes, sentences per document) of parts of a batch."""
    lens = np.diff(b.column("lens").offsets.to_numpy())
    sizes = b.column("lens").flatten().to_numpy()
    tok = b.column("tok").flatten().to_numpy()
    per_tok = np.diff(b.column("tok").offsets.to_numpy())
    t_end, s_end, lo = np.cumsum(per_tok), np.cumsum(lens), 0
    while lo < b.num_rows:
        start_t, start_s = (t_end[lo - 1], s_end[lo - 1]) if lo else (0, 0)
        hi = min(max(lo + 1, int(np.searchsorted(t_end, start_t + most_tokens))), b.num_rows, lo + 4096)
        yield lo, hi, tok[start_t : t_end[hi - 1]], per_tok[lo:hi], sizes[start_s : s_end[hi - 1]], lens[lo:hi]
        lo = hi


def language(tok: np.ndarray, per_tok: np.ndarray, lw: np.ndarray) -> np.ndarray:
    """The most likely language (row of the weights `lw`) of each document."""
    at = np.repeat(np.arange(len(per_tok)), per_tok)
    return np.column_stack([np.bincount(at, x[tok], minlength=len(per_tok)) for x in lw]).argmax(1)


def class_prior(labs: list, prior: np.ndarray, strict: float) -> np.ndarray:
    """The prior of each document; areas not among the labels of a labelled one keep the share `strict`."""
    p = np.tile(prior, (len(labs), 1))
    for k, own in enumerate(labs):
        if own is not None:
            keep = np.full(len(prior), strict)
            keep[[0, *own]] = 1
            p[k] *= keep
    return p / p.sum(1, keepdims=True)


def areas(
    docs: DataFrame, doc: str, text: str, labels: DataFrame, area: str, lang: str | None = None, nothing: DataFrame | None = None,
    least: int = 3, rounds: int = 20, strict: float = 0.1, bias: float = 2.5, least_tagged: float = 0.02, held: float = 0.2, tolerance: float = 0.002, em_rows: int | None = None,
) -> DataFrame:
    """Rows (doc, area, posterior): every area that the calibrated posterior gives to a document with 0.5 or more.

    The posterior is the chance that `least` or more sentences of the document treat the area. A sentence has one of the
    areas or none. Complement naive Bayes on the labelled documents (rows (doc, area) of `labels`, which may hold a few
    errors) gives the first word weights; expectation-maximisation over the documents re-estimates the words of the areas
    and of no area, with the class mix of each document, a labelled document keeping only the share `strict` of its prior
    for areas not among its labels. Texts of `nothing` (rows (text)) are of no area. Last, each area's posterior is
    calibrated on its own by logistic regression, with a ridge towards no change, on the share `held` of the labelled
    documents (by hash) whose labels neither the first weights nor the rounds saw, all of them: a step of the regression is
    a job that returns six sums an area.

    Rounds end when the shares of the classes move by no more than `tolerance`; `rounds` without that is told by a warning.

    Word weights are kept per language: the (dirty) tags of the column `lang` that the share `least_tagged` of the tagged
    documents or more have (so at most 1 / `least_tagged` languages) train a naive Bayes that then gives every document
    one of them. Rarer tags are mostly wrong ones; a document in a language below that share is judged by the language
    that its words are nearest to. Without `lang` all documents count as one language.

    Expectation-maximisation runs on all documents, spread over tasks of some thousand documents or more; a round returns
    sums per hashed word and class, pre-aggregated per task; the driver holds one number a language, class and slot, however
    large the corpus. Only a caller that passes `em_rows` has the rounds run on that many documents by hash. Every document
    is judged, in its own file partition.
    Null and blank texts, and documents without an area, have no row; repeated ids are separate documents (they share
    labels); without any label there are no rows.
    """
    spark = docs.sparkSession
    kind = dict(docs.select(F.col(doc).alias("doc")).dtypes)["doc"]
    names = sorted(x[0] for x in labels.where(F.col(area).isNotNull()).select(area).distinct().collect())
    if not names:
        return docs.select(F.col(doc), F.lit(None).cast("string").alias("area"), F.lit(None).cast("double").alias("posterior")).limit(0)
    number = F.broadcast(spark.createDataFrame([(a, k + 1) for k, a in enumerate(names)], "area string, k int"))
    labs = labels.select(F.col(doc).alias("doc"), F.col(area).alias("area")).join(number, "area").groupBy("doc").agg(F.sort_array(F.collect_set("k")).alias("all"))
    # few labelled documents leave too little to hold back: at least twenty are held, or none
    hide = (F.xxhash64("doc", F.lit(5)) % 1000 + 1000) % 1000 < int(1000 * held)
    hide = hide if labs.where(hide).count() >= 20 else F.lit(False)
    labs = labs.select("doc", "all", F.when(~hide, F.col("all")).alias("labs"))
    tag = F.lower(F.regexp_extract(F.col(lang), r"^\s*([A-Za-z]+)", 1)) if lang else F.lit("")
    # no filter by size here: it would be pushed below the projection and cut every text twice
    rows = docs.where(F.col(text).isNotNull()).select(F.col(doc).alias("doc"), slots(F.col(text)).alias("s"), tag.alias("tag")).join(labs, "doc", "left")
    if nothing is not None:
        none = F.array().cast("array<int>")
        rows = rows.unionByName(nothing.select(F.lit(None).cast(kind).alias("doc"), slots(F.col(nothing.columns[0])).alias("s"), F.lit(None).cast("string").alias("tag"), none.alias("labs"), none.alias("all")))
    flat = let(F.col("s"), lambda s: F.struct(F.flatten(s).alias("tok"), F.transform(s, lambda x: F.size(x)).alias("lens")))
    judged_rows = cut(rows.select("doc", flat.alias("x"), "labs", "all", "tag").select("doc", "x.tok", "x.lens", "labs", "all", "tag")).where("size(lens) > 0")
    n_rows = judged_rows.count()
    data = judged_rows
    cores = spark.sparkContext.defaultParallelism
    if em_rows is not None and n_rows > em_rows:
        data = data.where(F.xxhash64("doc", "lens", F.lit(3)) < int((2 * em_rows / n_rows - 1) * 2**63))
        n_rows = em_rows
    if data is not judged_rows or n_rows < DOCS_A_TASK * data.rdd.getNumPartitions():
        data = cut(data.repartition(max(1, min(cores, math.ceil(n_rows / 500)), math.ceil(n_rows / DOCS_A_TASK))))

    seen = {x["tag"]: x["count"] for x in data.where("tag <> '' and tag <> 'und'").groupBy("tag").count().collect()}
    tags = sorted(t for t in seen if seen[t] >= least_tagged * sum(seen.values())) or [""]
    place = {t: k for k, t in enumerate(tags)}
    c, ls = len(names) + 1, len(tags)

    def gathered(frame: DataFrame, shape: tuple) -> np.ndarray:
        n = np.zeros(int(np.prod(shape)))
        for x in frame.groupBy("cell").agg(F.sum("n").alias("n")).toArrow().to_batches():
            n[x.column("cell").to_numpy()] = x.column("n").to_numpy()
        return n.reshape(shape)

    def emit(n: np.ndarray) -> pa.RecordBatch:
        flat = n.reshape(-1)
        k = np.flatnonzero(flat > 1e-6)
        return pa.RecordBatch.from_arrays([pa.array(k), pa.array(flat[k])], ["cell", "n"])

    lw = np.zeros((1, SLOTS))
    for k in range(3 if ls > 1 else 0):

        sent = spark.sparkContext.broadcast(lw)

        def by_language(batches: Iterator[pa.RecordBatch], k: int = k, sent=sent) -> Iterator[pa.RecordBatch]:
            n, lw = np.zeros(ls * SLOTS), sent.value
            for b in batches:
                known = np.array([place.get(t, -1) for t in b.column("tag").to_pylist()])
                for lo, hi, tok, per_tok, _, _ in parts(b):
                    y = np.repeat(known[lo:hi] if k == 0 else language(tok, per_tok, lw), per_tok)
                    n += np.bincount(y[y >= 0] * SLOTS + tok[y >= 0], minlength=ls * SLOTS)
            yield emit(n)

        lw = outside_log(gathered(data.select("tok", "lens", "tag").mapInArrow(by_language, "cell long, n double"), (ls, SLOTS))).astype(np.float16)
        sent.destroy()
    lang_sent = spark.sparkContext.broadcast(lw)

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, lw = np.zeros((ls, c - 1, SLOTS)), lang_sent.value
        for b in batches:
            own = b.column("labs").to_pylist()
            for lo, hi, tok, per_tok, _, _ in parts(b):
                ends, y = np.cumsum(per_tok), language(tok, per_tok, lw)
                for k in range(lo, hi):
                    x = tok[ends[k - lo] - per_tok[k - lo] : ends[k - lo]]
                    for a in own[k]:
                        np.add.at(n[y[k - lo], a - 1], x, 1 / len(own[k]))
        yield emit(n)

    start = gathered(data.where("size(labs) > 0").select("tok", "lens", "labs").mapInArrow(labelled, "cell long, n double"), (ls, c - 1, SLOTS))
    w = np.stack([complement_lifts(x) for x in start]).astype(np.float16)
    prior = np.concatenate([[0.5], np.full(c - 1, 0.5 / (c - 1))])

    moved = 0.0
    for k in range(rounds):

        sent = spark.sparkContext.broadcast(w)

        def expected(batches: Iterator[pa.RecordBatch], sent=sent, prior: np.ndarray = prior, push: float = 0.0 if k else bias) -> Iterator[pa.RecordBatch]:
            n, w, lw = np.zeros((ls, c, SLOTS)), sent.value, lang_sent.value
            for b in batches:
                own = b.column("labs").to_pylist()
                for lo, hi, tok, per_tok, size, per_doc in parts(b):
                    yt = np.repeat(language(tok, per_tok, lw), per_tok)
                    at = np.repeat(np.arange(len(size)), size)
                    r = respond(tok, yt, at, per_doc, class_prior(own[lo:hi], prior, strict), w, push)
                    for a in range(c):
                        n[:, a] += np.bincount(yt * SLOTS + tok, r[at, a], minlength=ls * SLOTS).reshape(ls, SLOTS)
            yield emit(n)

        counts = gathered(data.select("tok", "lens", "labs").mapInArrow(expected, "cell long, n double"), (ls, c, SLOTS))
        sent.destroy()
        w = np.stack([pooled_log(x) for x in counts]).astype(np.float16)
        mass = counts.sum((0, 2)) + 1
        moved = float(np.abs(mass / mass.sum() - prior).max())
        prior = mass / mass.sum()
        if moved <= tolerance and k >= 3:
            break
    if moved > tolerance:
        warnings.warn(f"shares of the classes still moved by {moved:.3g} after {rounds} rounds", stacklevel=2)

    sent = spark.sparkContext.broadcast(w)

    def judged(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
        w, lw = sent.value, lang_sent.value
        for b in batches:
            for lo, hi, tok, per_tok, size, per_doc in parts(b):
                yt = np.repeat(language(tok, per_tok, lw), per_tok)
                r = respond(tok, yt, np.repeat(np.arange(len(size)), size), per_doc, np.tile(prior, (hi - lo, 1)), w, 0.0)
                part = b.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part.column("doc"), part.column("labs"), part.column("all"), pa.array(list(at_least(r, per_doc, least)[:, 1:]), pa.list_(pa.float64()))], ["doc", "labs", "all", "z"])

    scored = cut(judged_rows.where("doc is not null").select("doc", "tok", "lens", "labs", "all").mapInArrow(judged, f"doc {kind}, labs array<int>, all array<int>, z array<double>"))
    sent.destroy()
    lang_sent.destroy()
    told = scored.where("`all` is not null")
    hidden = told.where("labs is null")
    fits = calibrations(told if hidden.isEmpty() else hidden, len(names))
    table = F.broadcast(spark.createDataFrame([(k, a, float(fits[k][0]), float(fits[k][1])) for k, a in enumerate(names)], "k int, area string, slope double, shift double"))
    odds = F.least(F.lit(12.0), F.greatest(F.lit(-12.0), F.log(F.greatest("z", F.lit(1e-9)) / F.greatest(1 - F.col("z"), F.lit(1e-9)))))
    out = scored.select("doc", F.posexplode("z").alias("k", "z")).where("z > 1e-3").join(table, "k")
    return out.withColumn("posterior", 1 / (1 + F.exp(-(F.col("slope") * odds + F.col("shift"))))).where("posterior >= 0.5").select(F.col("doc").alias(doc), "area", "posterior")


def calibrations(told: DataFrame, areas: int, ridge: float = 5.0, steps: int = 50) -> list[tuple[float, float]]:
    """Slope and shift by area of the logistic regressions of "is one of the areas `all`" on the log odds of `z`, drawn by
    `ridge` towards (1, 0). Newton's steps on all rows; a step that doesn't lower an area's loss is halved. The driver holds
    six sums an area and task."""
    held = cut(told.select("all", "z").coalesce(told.sparkSession.sparkContext.defaultParallelism))

    def sums(beta: np.ndarray) -> np.ndarray:
        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros((areas, 6))
            for b in batches:
                z = b.column("z").flatten().to_numpy().reshape(-1, areas)
                x, y = np.clip(np.log(np.maximum(z, 1e-9) / np.maximum(1 - z, 1e-9)), -12, 12), np.zeros(z.shape)
                y[np.repeat(np.arange(len(z)), np.diff(b.column("all").offsets.to_numpy())), b.column("all").flatten().to_numpy() - 1] = 1
                eta = beta[:, 0] * x + beta[:, 1]
                q = 1 / (1 + np.exp(-eta))
                v = q * (1 - q)
                out += np.column_stack([k.sum(0) for k in (np.logaddexp(0, eta) - y * eta, (q - y) * x, q - y, v * x * x, v * x, v)])
            yield pa.RecordBatch.from_arrays([pa.array([out.reshape(-1).tolist()], pa.list_(pa.float64()))], ["s"])

        return sum((np.array(r["s"]).reshape(areas, 6) for r in held.mapInArrow(part, "s array<double>").collect()), np.zeros((areas, 6)))

    origin = np.tile([1.0, 0.0], (areas, 1))
    beta, step, low = origin.copy(), np.zeros((areas, 2)), np.full(areas, np.inf)
    for _ in range(steps):
        t, off = sums(beta + step), beta + step - origin
        loss = t[:, 0] + ridge / 2 * (off**2).sum(1)
        for k in range(areas):
            if loss[k] <= low[k] + 1e-9 * abs(loss[k]):
                beta[k], low[k] = beta[k] + step[k], loss[k]
                step[k] = -np.linalg.solve(np.array([[t[k, 3], t[k, 4]], [t[k, 4], t[k, 5]]]) + ridge * np.eye(2), t[k, 1:3] + ridge * off[k])
            else:
                step[k] /= 2
        if np.abs(step).max() < 1e-6:
            break
    return [(max(float(b[0]), 0.05), float(b[1])) for b in beta]
