"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

import base64
import math
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.prefix import running_sum
from ..sources.tables import cut

#: A byte-level BPE vocabulary, as ranks (.tiktoken) or in the tokenizers format (.json), at the same place on every
#: executor; the place is a parameter of the installation.
TOKENIZER = os.environ.get("SUSURRUS_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: Fixed value: how byte-level BPE cuts a text before it merges.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _counter(path: str):
    """A function list of texts -> list of token counts; texts that look like special tokens are ordinary text."""
    if path.endswith(".json"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True
        return lambda texts: [len(e.ids) for e in t.encode_batch_fast(texts, add_special_tokens=False)]
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    e = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda texts: [len(e.encode_ordinary(x)) for x in texts]


def token_counts(path: str = TOKENIZER, texts_at_once: int = 256):
    """A function column -> column: tokens of a text by the tokenizer file `path`; null for null, 0 for the empty text."""

    @F.pandas_udf("bigint")
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sizes_of = _counter(path)
        for s in parts:
            out: list = []
            for i in range(0, len(s), texts_at_once):
                texts = s.iloc[i : i + texts_at_once]
                sizes = iter(sizes_of([x for x in texts if x is not None]))
                out += [None if x is None else next(sizes) for x in texts]
            yield pd.Series(out, dtype="Int64")

    return count


def word_counts(text):
    """Words between blanks of a text."""
    return F.size(F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")).cast("bigint")


def fill(totals: dict[str, float], weights: dict[str, float], repeats: dict[str, int], budget: float) -> float:
    """The virtual time at which the served sizes, min(weight * time, repeats * total), add up to the budget (or all is served)."""
    ends = sorted((repeats[s] * totals[s] / weights[s], s) for s in weights if weights[s] > 0 and totals[s] > 0)
    done, rate, now = 0.0, sum(weights[s] for _, s in ends), 0.0
    for end, s in ends:
        if done + rate * (end - now) >= budget:
            return now + (budget - done) / rate
        done, now, rate = done + rate * (end - now), end, rate - weights[s]
    return ends[-1][0] if ends else 0.0


def mix(docs: DataFrame, doc: str, source: str, text: str, targets: DataFrame, size, seed: int = 0, bins: int = 4096):
    """(mixture, report).

    mixture: (doc, source, copy, size, finish): every copy of a document in the mixture, `copy` from 0. report: (source,
    target_share, max_repeats, available, wanted, last_finish, copies, size, actual_share, short).

    Each source's documents are shuffled by hash; the virtual finish time of a copy is the running size of its source at
    its end, repetitions included, divided by the source's target share. Copies are served in the order of finish times
    until the budget, `budget_factor` times the size of all documents, is reached. A source whose last copy in the queue
    finishes before the virtual time `budget` has run dry: it falls short, and the others go on in proportion. The time of
    the last copy must equal the closed form from the totals, else reading the report is an error. Running sizes come
    from bucketed sums, so neither a large source nor the whole mixture is sorted in one task; the driver sees one row
    a target.

    Documents with null source or null text are left out, blank texts have the size that `size` gives; null repeats count
    as 1, null shares as 0; a target source without documents falls short; sources without target are in the budget but
    not in the mixture; repeated ids are separate documents (equal rows may change places, which changes no size).
    """
    spark = docs.sparkSession
    sized = docs.where(F.col(source).isNotNull() & F.col(text).isNotNull()).select(F.col(doc).alias("doc"), F.col(source).alias("source"), size(F.col(text)).alias("size"))
    sized = cut(sized.withColumn("h", F.xxhash64("doc", F.lit(seed))))
    goal = cut(targets.groupBy("source").agg(F.coalesce(F.max("target_share"), F.lit(0.0)).alias("share"), F.coalesce(F.max("max_repeats"), F.lit(1)).alias("repeats"), F.coalesce(F.max("budget_factor"), F.lit(1.0)).alias("factor")))
    all_rows, all_size = sized.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    got = sized.groupBy("source").agg(F.sum("size").alias("total"), F.max("size").alias("most"), F.count("*").alias("rows"))
    goals = [x.asDict() for x in goal.join(got, "source", "left").fillna(0, ["total", "most", "rows"]).collect()]
    budget = max((g["factor"] for g in goals), default=1.0) * all_size
    weights = {g["source"]: g["share"] for g in goals}
    live = {s: w for s, w in weights.items() if w > 0}
    totals, repeats = {g["source"]: g["total"] for g in goals}, {g["source"]: g["repeats"] for g in goals}
    until = fill(totals, live, repeats, budget)
    # by this time at least the budget is served: no source lags by more than one copy
    late = until + 2 * max((g["most"] for g in goals), default=0) / min(live.values(), default=1.0) + 1e-9

    bits = max(2, min(20, math.ceil(math.log2(max(1, all_rows) / 100_000 + 1)) + 4))
    facts = F.broadcast(spark.createDataFrame([(g["source"], g["share"], g["repeats"], float(g["total"])) for g in goals if g["share"] > 0 and g["total"]], "source string, share double, repeats int, total double"))
    queue = cut(running_sum(sized.withColumn("b", F.shiftright("h", 64 - bits)), ["source"], "b", ["h", "doc", "size"], "size", "upto").join(facts, "source"))
    dry = queue.groupBy("source").agg(F.max(((F.col("repeats") - 1) * F.col("total") + F.col("upto")) / F.col("share")).alias("last_finish"))
    needed = F.least(F.col("repeats"), F.floor((late * F.col("share") - F.col("upto")) / F.col("total")) + 1)
    copies = (
        queue.withColumn("needed", needed).where("needed >= 1")
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("needed").cast("int") - 1)))
        .select("doc", "source", "copy", "size", ((F.col("copy") * F.col("total") + F.col("upto")) / F.col("share")).alias("finish"), "h")
    )
    served = running_sum(copies.withColumn("b", F.floor(F.col("finish") / F.lit(max(late, 1e-9)) * bins)), [], "b", ["finish", "source", "h", "doc", "size", "copy"], "size", "upto")
    mixture = cut(served.where(F.col("upto") <= budget).select("doc", "source", "copy", "size", "finish"))

    actual = mixture.groupBy("source").agg(F.count("*").alias("copies"), F.sum("size").alias("size"))
    whole = mixture.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    ends = [(g["source"], g["share"], g["repeats"], g["total"], g["share"] * budget, g["repeats"] * g["total"] / g["share"] if g["share"] > 0 else math.inf) for g in goals]
    report = (
        spark.createDataFrame(ends, "source string, target_share double, max_repeats int, available long, wanted double, closed double")
        .join(dry, "source", "left").join(actual, "source", "left").fillna(0, ["copies", "size"])
        # what isn't in the queue has no copy to finish: a share without size is dry at once, no share never
        .withColumn("last_finish", F.coalesce("last_finish", F.when(F.col("target_share") > 0, 0.0).otherwise(math.inf)))
        .withColumn("last_finish", F.when((F.col("last_finish") == F.col("closed")) | (F.abs(F.col("last_finish") - F.col("closed")) <= 1e-9 * F.col("closed")), F.col("last_finish")).otherwise(F.raise_error(F.concat(F.lit("the queue doesn't end with the total of "), "source"))))
        .withColumn("actual_share", F.col("size") / F.lit(float(max(whole, 1)))).withColumn("short", F.col("last_finish") < budget)
        .select("source", "target_share", "max_repeats", "available", "wanted", "last_finish", "copies", "size", "actual_share", "short")
    )
    return mixture, report
