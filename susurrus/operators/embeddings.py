"""Metrics over embeddings."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; null where one has no length."""
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


def centroids(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Rows (key, centroid): the mean vector of each key, by position, with a map-side combine."""
    long = df.select(key, F.posexplode(vector).alias("i", "x")).groupBy(key, "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return long.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("s")).select(key, F.col("s.x").alias("centroid"))


def moments(df: DataFrame, vector: str) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, mean, covariance) of the vectors of `df`; a task gives one sum and one product matrix, whatever its rows."""
    first = df.where(F.col(vector).isNotNull()).select(F.size(vector)).first()
    d = first[0] if first else 0

    def sums(parts):
        n, s, p = 0, np.zeros(d), np.zeros((d, d))
        for pdf in parts:
            x = np.stack([np.asarray(v, float) for v in pdf[vector] if v is not None and len(v) == d]) if len(pdf) else np.zeros((0, d))
            n, s, p = n + len(x), s + x.sum(0), p + x.T @ x
        if n:
            yield pd.DataFrame({"cells": [np.concatenate([[n], s, p.reshape(-1)])]})

    # matrices of the tasks are added up by cell before the driver gets one of them
    cells = df.select(vector).mapInPandas(sums, "cells array<double>").select(F.posexplode("cells").alias("k", "x")).groupBy("k").agg(F.sum("x").alias("x")).toPandas()
    whole = np.zeros(1 + d + d * d)
    whole[cells["k"].to_numpy()] = cells["x"].to_numpy()
    n, s, p = int(whole[0]), whole[1 : d + 1], whole[d + 1 :].reshape(d, d)
    mean = s / max(n, 1)
    return n, mean, (p - n * np.outer(mean, mean)) / max(n - 1, 1)


def frechet(a: DataFrame, b: DataFrame, vector: str) -> float:
    """Fréchet distance of the normal distributions of two sets: |m1 - m2|^2 + tr(c1 + c2 - 2 (c1 c2)^(1/2))."""
    (_, m1, c1), (_, m2, c2) = moments(a, vector), moments(b, vector)
    w, v = np.linalg.eigh(c1)
    root = (v * np.sqrt(np.clip(w, 0, None))) @ v.T
    inner = np.sqrt(np.clip(np.linalg.eigvalsh(root @ c2 @ root), 0, None)).sum()
    return float(((m1 - m2) ** 2).sum() + np.trace(c1) + np.trace(c2) - 2 * inner)


def divergence(p: Column, q: Column, eps: float = 1e-6) -> Column:
    """Kullback-Leibler divergence of two discrete distributions (arrays), each value at least `eps`."""
    safe = lambda x: F.greatest(x.cast("double"), F.lit(eps))
    return F.aggregate(F.zip_with(p, q, lambda a, b: safe(a) * F.log(safe(a) / safe(b))), F.lit(0.0), lambda s, x: s + x)


def softmax(scores: Column) -> Column:
    """Scores (array) as a distribution."""
    top = F.array_max(F.transform(scores, lambda x: x.cast("double")))
    e = F.transform(scores, lambda x: F.exp(x.cast("double") - top))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda s, y: s + y))


def inception_score(df: DataFrame, distribution: str) -> DataFrame:
    """One row (n, score): exp of the mean divergence of each row's distribution from the mean of all. The mean is a small row
    that goes to every task; sums are pre-aggregated."""
    mean = centroids(df.withColumn("__one", F.lit(1)), "__one", distribution)
    x = df.select(distribution).withColumn("__one", F.lit(1)).join(F.broadcast(mean), "__one")
    return x.agg(F.count("*").alias("n"), F.exp(F.avg(divergence(F.col(distribution), F.col("centroid")))).alias("score"))


def paired_divergence(reference: DataFrame, generated: DataFrame, key: str, distribution: str) -> DataFrame:
    """One row (n, divergence): the mean divergence of the reference's from the generated distribution of the same key."""
    x = reference.select(key, F.col(distribution).alias("__p")).join(generated.select(key, F.col(distribution).alias("__q")), key)
    return x.agg(F.count("*").alias("n"), F.avg(divergence(F.col("__p"), F.col("__q"))).alias("divergence"))
