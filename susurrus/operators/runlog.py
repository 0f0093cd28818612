"""Run accounting: counts by status and reason, bounded details, usage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import detail, failure_reason, none_if_empty
from .timelines import first_by


def with_reason(df: DataFrame, status: str, reason: str, text: str) -> DataFrame:
    """`reason` as given, else for failed rows the class of their detail."""
    given = none_if_empty(F.trim(F.col(reason)))
    return df.withColumn("reason", F.coalesce(given, F.when(F.col(status) == "failed", failure_reason(F.col(text))))).withColumn("detail", detail(F.col(text)))


def summary(df: DataFrame, stage: str, status: str) -> DataFrame:
    return df.groupBy(stage, status, "reason").agg(F.count("*").alias("n"))


def kept_details(df: DataFrame, stage: str, order: str, most: int = 200) -> DataFrame:
    """The first `most` failures of each stage, with the number that were dropped. Each stage is cut to its first rows before
    the shuffle (`first_by`), and counted with a map-side combine."""
    n = df.groupBy(F.col(stage).alias("__stage")).agg(F.count("*").alias("failures"))
    x = first_by(df, [stage], [order], most).join(F.broadcast(n), F.col(stage).eqNullSafe(F.col("__stage"))).drop("__stage")
    return x.withColumn("dropped", F.greatest(F.col("failures") - most, F.lit(0)))


def usage(df: DataFrame, stage: str, values: list[str]) -> DataFrame:
    """Sums of the values and the number of calls by stage, and over all (null stage), in one rollup."""
    return df.rollup(stage).agg(*[F.sum(v).alias(v) for v in values], F.count("*").alias("calls"))


def payload(df: DataFrame, stage: str, status: str, item: str, reason: str, detail_of: str, most: int = 200) -> dict:
    """What a run came to, as one document: counts by status and reason, and the first `most` failures.

    Failed rows (`failed`, `error`) without a reason get the class of their detail. Counts come from one aggregation; the
    driver gets one row a status and reason and at most `most` failures.
    """
    bad = F.col("s").isin("failed", "error")
    x = df.select(F.lower(F.trim(F.col(status))).alias("s"), F.col(item).cast("string").alias("item_id"), none_if_empty(F.trim(F.col(reason))).alias("given"), F.col(detail_of).alias("d"))
    x = x.withColumn("reason", F.coalesce("given", F.when(bad, failure_reason(F.col("d"))))).withColumn("detail", detail(F.col("d")))
    counts, reasons = {}, {}
    for r in x.groupBy("s", "reason").agg(F.count("*").alias("n")).collect():
        counts[r["s"]] = counts.get(r["s"], 0) + r["n"]
        if r["reason"]:
            reasons[r["reason"]] = reasons.get(r["reason"], 0) + r["n"]
    failures = [{k: v for k, v in r.asDict().items() if v} for r in x.where(bad).select("reason", F.substring(F.coalesce("item_id", F.lit("")), 1, 200).alias("item_id"), "detail").orderBy("item_id").limit(most).collect()]
    failed = counts.get("failed", 0) + counts.get("error", 0)
    return {
        "stage": stage, "total": sum(counts.values()), "counts": dict(sorted(counts.items())), "successful": counts.get("success", 0), "failed": failed, "skipped": counts.get("skipped", 0),
        "failure_reasons": dict(sorted(reasons.items())), "failures": failures, "dropped_failure_details": failed - len(failures),
    }
