"""Multiple-choice scoring over several runs, label metrics and agreement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import none_if_empty, stripped

#: The tasks that the macro average knows.
TASKS = ["verb_mc", "subject_material_mc", "object_material_mc"]


def answered(questions: DataFrame, predictions: DataFrame) -> DataFrame:
    """Rows (run_id, question) with `correct` and `class_ok`: every question in every run, a missing prediction is wrong.

    questions: question_id, task, gold_label, options array<struct<label, value, verb_class>>; predictions: run_id,
    question_id, pred. The list of runs (one entry a run) becomes a literal that each question is exploded by.
    """
    runs = F.array(*[F.lit(x[0]) for x in predictions.select("run_id").distinct().orderBy("run_id").collect()]).cast(f"array<{dict(predictions.dtypes)['run_id']}>")
    option = lambda label: F.get(F.filter("options", lambda o: o["label"] == label), 0)["verb_class"]
    grid = questions.withColumn("run_id", F.explode(runs)).join(predictions, ["run_id", "question_id"], "left")
    gold = option(F.col("gold_label"))
    return grid.select(
        "run_id", "question_id", "task", F.coalesce(F.upper(F.trim("pred")) == F.upper(F.trim("gold_label")), F.lit(False)).cast("int").alias("correct"),
        F.when((F.col("task") == "verb_mc") & gold.isNotNull(), F.coalesce(option(F.upper(F.trim("pred"))) == gold, F.lit(False)).cast("int")).alias("class_ok"),
    )


def score_runs(questions: DataFrame, predictions: DataFrame) -> DataFrame:
    """Rows (run_id, metric, value, n): overall, each task, superclass (verb questions whose gold has a class) and macro
    (mean of the known tasks that occur). One aggregation by (run, task); the rest works on its few rows."""
    by_task = answered(questions, predictions).groupBy("run_id", "task").agg(
        F.sum("correct").alias("right"), F.count("*").alias("n"), F.sum("class_ok").alias("class_right"), F.count("class_ok").alias("class_n")
    )
    rate = by_task.select("run_id", F.col("task").alias("metric"), (F.col("right") / F.col("n")).alias("value"), "n")
    total = by_task.groupBy("run_id").agg((F.sum("right") / F.sum("n")).alias("value"), F.sum("n").alias("n")).select("run_id", F.lit("overall").alias("metric"), "value", "n")
    sup = by_task.groupBy("run_id").agg(F.sum("class_right").alias("r"), F.sum("class_n").alias("n")).where("n > 0").select("run_id", F.lit("superclass").alias("metric"), (F.col("r") / F.col("n")).alias("value"), "n")
    macro = rate.where(F.col("metric").isin(TASKS)).groupBy("run_id").agg(F.avg("value").alias("value"), F.count("*").alias("n")).select("run_id", F.lit("macro").alias("metric"), "value", "n")
    return rate.unionByName(total).unionByName(sup).unionByName(macro)


def average_runs(scores: DataFrame) -> DataFrame:
    """Mean and population deviation of each metric over the runs."""
    return scores.groupBy("metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.count("*").alias("runs"))


def vote_subset(votes: DataFrame, kind: str, correct: str, least_reference: int = 2, most_silence: int = 1) -> DataFrame:
    """Questions that all runs of both kinds have, right in at least `least_reference` reference runs and at most
    `most_silence` silence runs. `votes`: question_id, run_id, kind ('reference' or 'silence'), correct."""
    runs = votes.select("run_id", kind).distinct().count()
    x = votes.groupBy("question_id").agg(
        F.countDistinct("run_id", kind).alias("runs"), F.sum(F.when(F.col(kind) == "reference", F.col(correct))).alias("reference_votes"), F.sum(F.when(F.col(kind) == "silence", F.col(correct))).alias("silence_votes")
    )
    return x.where((F.col("runs") == runs) & (F.col("reference_votes") >= least_reference) & (F.col("silence_votes") <= most_silence)).select("question_id", "reference_votes", "silence_votes")


def best_letter(scores: DataFrame, key: str, letter: str, score: str, rank: str) -> DataFrame:
    """The letter of the greatest score per key, the first ranked on ties; null where no score exceeds -1e8."""
    x = scores.groupBy(key).agg(F.max(F.struct(F.col(score).alias("s"), (-F.col(rank)).alias("r"), F.col(letter).alias("l"))).alias("x"))
    return x.select(key, F.when(F.col("x.s") > -1e8, F.col("x.l")).alias("best"))


def label_metrics(pairs: DataFrame, gold: str, pred: str) -> DataFrame:
    """Rows (label, support, precision, recall, f1) of every label that gold has; 0 where a denominator is 0. A predicted
    null is a miss, a null gold is not scored. One aggregation by (gold, pred), then by label."""
    cells = pairs.groupBy(F.col(gold).alias("g"), F.col(pred).alias("p")).agg(F.count("*").alias("n"))
    by_gold = cells.where("g is not null").groupBy(F.col("g").alias("label")).agg(F.sum("n").alias("support"), F.sum(F.when(F.col("g") == F.col("p"), F.col("n")).otherwise(0)).alias("hit"))
    by_pred = cells.where("g is not null and p is not null").groupBy(F.col("p").alias("label")).agg(F.sum("n").alias("said"))
    x = by_gold.join(by_pred, "label", "left").fillna(0, ["said"])
    zero = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    x = x.withColumn("precision", zero(F.col("hit"), F.col("said"))).withColumn("recall", F.col("hit") / F.col("support"))
    return x.select("label", "support", "precision", "recall", zero(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")).alias("f1"))


def accuracy(pairs: DataFrame, gold: str, pred: str) -> DataFrame:
    """One row (n, accuracy); null equals null."""
    return pairs.agg(F.count("*").alias("n"), F.avg(F.col(gold).eqNullSafe(F.col(pred)).cast("int")).alias("accuracy"))


def cohen_kappa(pairs: DataFrame, keys: list[str], left: str, right: str) -> DataFrame:
    """Rows (keys, n, observed, expected, kappa); null is a label like any other; kappa is 1 or 0 where chance agrees fully. `keys` has
    at least one column."""
    cells = pairs.groupBy(*keys, F.col(left).alias("l"), F.col(right).alias("r")).agg(F.count("*").alias("n"))
    whole = cells.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum(F.when(F.col("l").eqNullSafe(F.col("r")), F.col("n")).otherwise(0)).alias("same"))
    a = cells.groupBy(*keys, F.col("l").alias("x")).agg(F.sum("n").alias("a"))
    b = cells.groupBy(*keys, F.col("r").alias("x")).agg(F.sum("n").alias("b"))
    on = F.col("a1.x").eqNullSafe(F.col("b1.x"))
    for k in keys:
        on = on & F.col(f"a1.{k}").eqNullSafe(F.col(f"b1.{k}"))
    chance = a.alias("a1").join(b.alias("b1"), on).groupBy(*[F.col(f"a1.{k}").alias(k) for k in keys]).agg(F.sum(F.col("a") * F.col("b")).alias("ab"))
    x = whole.join(chance, keys, "left")
    x = x.withColumn("observed", F.col("same") / F.col("n")).withColumn("expected", F.coalesce(F.col("ab"), F.lit(0)) / (F.col("n") * F.col("n")))
    return x.select(*keys, "n", "observed", "expected", F.when(F.abs(1 - F.col("expected")) <= 1e-9, F.when(F.col("observed") >= 1, 1.0).otherwise(0.0)).otherwise((F.col("observed") - F.col("expected")) / (1 - F.col("expected"))).alias("kappa"))


def first_token(tokens):
    """The first token (struct token, logprob, top_logprobs) that isn't blank, of an array; null if there is none."""
    return F.get(F.filter(tokens, lambda t: stripped(F.coalesce(t["token"], F.lit(""))) != ""), 0)


#: What a letter scores that no token gives.
MISSING = -1e9


def letter_scores(df: DataFrame, key: str, tokens: str, letters: list[str]) -> DataFrame:
    """Rows (key, letter, rank, score): for each valid letter the greatest log probability that the first non-blank token or
    one of its alternatives gives it (trimmed, in upper case), MISSING where none does. All letters of a row come from the
    row itself: nothing is shuffled."""
    first = df.select(key, first_token(F.col(tokens)).alias("t"))
    own = F.struct(F.col("t.token").alias("token"), F.col("t.logprob").alias("logprob"))
    others = F.transform(F.coalesce("t.top_logprobs", F.array().cast("array<struct<token:string,logprob:double>>")), lambda c: F.struct(c["token"].alias("token"), c["logprob"].alias("logprob")))
    x = first.withColumn("c", F.concat(others, F.array(own)))
    given = lambda letter: F.array_max(F.transform(F.filter("c", lambda c: F.upper(stripped(c["token"])) == letter), lambda c: c["logprob"]))
    scored = F.array(*[F.struct(F.lit(c).alias("letter"), F.lit(i).alias("rank"), F.coalesce(given(c), F.lit(MISSING)).alias("score")) for i, c in enumerate(letters)])
    return x.select(key, F.explode(scored).alias("s")).select(key, "s.*")


def task_accuracy(questions: DataFrame, predictions: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows (task, n, accuracy) over all runs of the questions in `ids` (question_id); a missing prediction and a missing
    gold label are equal, a missing task is `unknown`."""
    x = questions.join(ids.select("question_id").distinct(), "question_id", "left_semi").select("question_id", F.coalesce("task", F.lit("unknown")).alias("task"), "gold_label")
    y = x.join(predictions.select("run_id", "question_id", "pred"), "question_id")
    clean = lambda c: none_if_empty(F.upper(stripped(F.col(c))))
    return y.groupBy("task").agg(F.count("*").alias("n"), F.avg(clean("pred").eqNullSafe(clean("gold_label")).cast("int")).alias("accuracy"))


def entity_summary(stages: DataFrame, keys: list[str], stage: str, settled: str | None = None) -> DataFrame:
    """Rows (keys, n, strict_correct, strict_accuracy, alias_correct, alias_accuracy, resolved_correct, resolved_accuracy,
    unresolved): matches as written, through aliases as well, and with those that `settled` (a boolean of the open rows,
    from a judge outside) adds."""
    more = F.count_if(F.col(stage).isNull() & F.coalesce(F.col(settled), F.lit(False))) if settled else F.lit(0).cast("long")
    x = stages.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(F.col(stage) == "strict").alias("strict_correct"), F.count_if(F.col(stage).isin("strict", "alias")).alias("alias_correct"), more.alias("more"))
    x = x.withColumn("resolved_correct", F.col("alias_correct") + F.col("more"))
    rate = lambda c: F.round(F.col(c) / F.col("n"), 6)
    return x.select(*keys, "n", *[y for c in ("strict", "alias", "resolved") for y in (f"{c}_correct", rate(f"{c}_correct").alias(f"{c}_accuracy"))], (F.col("n") - F.col("alias_correct")).alias("unresolved"))


def match_stage(left, right, left_group, right_group):
    """`strict` for equal normalised texts (null equals null), `alias` for texts of one group, else null."""
    return F.when(left.eqNullSafe(right), "strict").when(left_group == right_group, "alias")


def not_in_bank(subset: DataFrame, bank: DataFrame, key: str) -> DataFrame:
    """The distinct keys of a subset that the bank doesn't have; null and empty keys don't count."""
    return subset.where(F.coalesce(F.col(key), F.lit("")) != "").select(key).distinct().join(bank.select(key), key, "left_anti")


def restrict(bank: DataFrame, subset: DataFrame, key: str, preview: int = 5) -> DataFrame:
    """The rows of the bank whose key is in the subset; keys of the subset that the bank doesn't have are an error."""
    bad = [x[key] for x in not_in_bank(subset, bank, key).orderBy(key).limit(preview).collect()]
    if bad:
        raise ValueError(f"keys of the subset that aren't in the bank, such as {bad}")
    return bank.join(subset.select(key).distinct(), key, "left_semi")
