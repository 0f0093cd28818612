"""External calls (models, translators) as injected providers over distinct inputs."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.records import json_object


def stub(prefix: str) -> Callable[[list[str]], list[str]]:
    """A deterministic provider for tests: the prefix and the md5 of the text."""
    return lambda texts: [prefix + hashlib.md5(t.encode()).hexdigest() for t in texts]


#: Signs of a used-up quota, and of a failure that may pass.
QUOTA = ["arrearage", "insufficient", "quota", "额度", "allocation quota", "exceeded", "free tier", "欠费", "余额", "billing"]
TRANSIENT = ["ffmpeg exited", "-138", "-10054", "timed out", "timeout", "connection", "connection reset", "proxy", "remote end closed", "end of file", "ssl", "unexpected_eof", "tcp://"]


def is_quota(error: object) -> bool:
    return any(k in str(error).lower() for k in QUOTA)


def is_transient(error: object) -> bool:
    return any(k in str(error).lower() for k in TRANSIENT)


def with_retry(call: Callable, retries: int = 2, first: float = 0.0, factor: float = 2.0, passing: Callable[[object], bool] = lambda e: True, sleep: Callable[[float], None] = time.sleep) -> Callable:
    """`call` tried again after failures that may pass, waiting `first`, `first * factor`, ... seconds; the last one is raised."""

    def tried(*args):
        wait = first
        for k in range(retries + 1):
            try:
                return call(*args)
            except Exception as e:  # noqa: BLE001 - a provider may fail in any way
                if k == retries or not passing(e):
                    raise
                if wait:
                    sleep(wait)
                wait *= factor

    return tried


def with_failover(calls: dict[str, Callable], chain: list[str]) -> Callable:
    """The calls of the models of `chain` (repetitions and unknown ones left out) in turn: a used-up quota goes to the next,
    any other failure is raised, as is the last."""
    names = [m for m in dict.fromkeys(chain) if m in calls]
    if not names:
        raise ValueError("no model in the chain")

    def tried(*args):
        for k, m in enumerate(names):
            try:
                return calls[m](*args)
            except Exception as e:  # noqa: BLE001 - as above
                if k + 1 == len(names) or not is_quota(e):
                    raise

    return tried


def ask(df: DataFrame, key: str, prompt: str, call: Callable[[str], tuple[str, int, int]], schema: str, **retry) -> DataFrame:
    """Rows (key, answer struct, error, prompt_tokens, completion_tokens): the provider's JSON reply to each row's prompt.

    `call` returns (text, prompt tokens, completion tokens). A reply that is no JSON object, and a call that fails after its
    retries, is an error of its row; null prompts are not sent. The replies are written by the caller before they are used
    twice, so that each is paid once.
    """
    kind = dict(df.dtypes)[key]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tried = with_retry(call, **retry)
        for pdf in parts:
            rows = []
            for k, p in zip(pdf["__k"], pdf["__p"], strict=True):
                try:
                    text, a, b = tried(p)
                    rows.append((k, text, None, a, b))
                except Exception as e:  # noqa: BLE001 - as above
                    rows.append((k, None, str(e)[:500] or type(e).__name__, 0, 0))
            yield pd.DataFrame(rows, columns=["k", "text", "error", "prompt_tokens", "completion_tokens"])

    x = df.where(F.col(prompt).isNotNull()).select(F.col(key).alias("__k"), F.col(prompt).alias("__p"))
    y = x.mapInPandas(run, f"k {kind}, text string, error string, prompt_tokens long, completion_tokens long").withColumn("answer", json_object(F.col("text"), schema))
    return y.select(F.col("k").alias(key), "answer", F.coalesce("error", F.when(F.col("answer").isNull(), "the reply is no JSON object")).alias("error"), "prompt_tokens", "completion_tokens")


def apply_distinct(df: DataFrame, text: str, where: Column, call: Callable[[list[str]], list[str]], out: str, retries: int = 2, batch: int = 64) -> DataFrame:
    """Adds `out`: the provider's answer for the rows where `where` holds, else the text itself.

    Each distinct text is sent once, in batches; a batch that fails is retried, then sent text by text, and a text that
    still fails keeps its own value. Null texts are never sent.
    """
    asked = df.where(where & F.col(text).isNotNull()).select(F.col(text).alias("__q")).distinct()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def attempt(texts: list[str]) -> list[str | None] | None:
            for _ in range(retries + 1):
                try:
                    got = call(texts)
                    if len(got) == len(texts):
                        return got
                except Exception:  # noqa: BLE001 - a provider may fail in any way
                    continue
            return None

        for pdf in parts:
            qs, answers = pdf["__q"].tolist(), []
            for i in range(0, len(qs), batch):
                part = qs[i : i + batch]
                got = attempt(part)
                answers += got if got is not None else [(attempt([t]) or [None])[0] for t in part]
            yield pd.DataFrame({"__q": qs, "__a": answers})

    answers = asked.mapInPandas(run, "__q string, __a string")
    return df.join(answers, (F.col(text) == F.col("__q")) & where, "left").withColumn(out, F.coalesce("__a", text)).drop("__q", "__a")
