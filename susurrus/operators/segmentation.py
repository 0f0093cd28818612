"""Frame features to segments: scaling, sliding statistics, change points, boundaries."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let
from ..sources.tables import cut
from .prefix import numbered, same


def quantiles(df: DataFrame, keys: list[str], value: str, at: list[float]) -> DataFrame:
    """Rows (keys, q): exact percentiles with linear interpolation, one array entry a value of `at`. Null values don't count.

    From the places of the values in their key (`numbered`), of which only the two beside each percentile are kept: no task
    holds a key, whatever its number of rows."""
    x = cut(numbered(df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("__v")), keys, ["__v"], "__k"))
    n = x.groupBy(*keys).agg(F.count("*").alias("__n"))
    ends = lambda q: F.array(F.floor(F.lit(q) * (F.col("__n") - 1)), F.ceil(F.lit(q) * (F.col("__n") - 1)))
    places = n.select(*keys, "__n", F.explode(F.array_distinct(F.flatten(F.array(*[ends(q) for q in at])))).alias("__k"))
    near = x.alias("l").join(F.broadcast(places).alias("r"), same("l", "r", [*keys, "__k"])).select(*[F.col(f"l.{k}").alias(k) for k in keys], "r.__n", "l.__k", "l.__v")
    held = near.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("__k", "__v"))).alias("__m"), F.max("__n").alias("__n"))

    def one(q: float) -> Column:
        place = F.lit(q) * (F.col("__n") - 1)
        low = F.element_at("__m", F.floor(place))
        return low + (F.element_at("__m", F.ceil(place)) - low) * (place - F.floor(place))

    return held.select(*keys, F.array(*[one(q) for q in at]).alias("q"))


def robust_scale(df: DataFrame, keys: list[str], value: str, out: str = "scaled", eps: float = 1e-8) -> DataFrame:
    """Adds `out`: (x - median) / (interquartile range + eps) per key (null keys are one), by exact linear percentiles."""
    q = quantiles(df, keys, value, [0.25, 0.5, 0.75]).withColumnRenamed("q", "__q")
    x = df.alias("l").join(F.broadcast(q).alias("r"), same("l", "r", keys), "left").select("l.*", "r.__q")
    return x.withColumn(out, (F.col(value) - F.col("__q")[1]) / (F.col("__q")[2] - F.col("__q")[0] + eps)).drop("__q")


def sliding(df: DataFrame, keys: list[str], order: list[str], value: str, window: int, step: int, eps: float = 1e-8) -> DataFrame:
    """Rows (keys, first, center, mean, std) of every `step`-th full window of `window` rows; std = sqrt(variance + eps).
    `first` is the 0-based row in its key, `center` the row in the middle, (first + end) // 2.

    Rows are numbered over ranges of their order and each goes to the windows that hold it (window / step copies), which are
    aggregated with a map-side combine: no task sorts or holds a key. `order` must be total within a key."""
    x = numbered(df.select(*keys, *order, F.col(value).alias("__v")), keys, order, "__k")
    least = F.greatest(F.lit(0), F.ceil((F.col("__k") - (window - 1)) / step))
    x = x.where(least <= F.floor(F.col("__k") / step)).select(*keys, F.explode(F.sequence(least, F.floor(F.col("__k") / step))).alias("__w"), "__v")
    y = x.groupBy(*keys, "__w").agg(F.avg("__v").alias("mean"), F.sqrt(F.var_pop("__v") + eps).alias("std"), F.count("__v").alias("n")).where(F.col("n") == window)
    first = (F.col("__w") * step).cast("int")
    return y.select(*keys, first.alias("first"), F.floor((2 * first + window) / 2).cast("int").alias("center"), "mean", "std")


def merge_short(bounds: Column, least: int) -> Column:
    """Boundaries (first, ..., last), sorted and distinct, without inner ones closer than `least` to the one kept before;
    the last always stays, so the last segment may be short."""
    at = F.array_sort(F.array_distinct(bounds))

    def merged(b: Column) -> Column:
        inner = F.slice(b, 2, F.greatest(F.size(b) - 2, F.lit(0)))
        kept = F.aggregate(inner, F.slice(b, 1, 1), lambda acc, x: F.when(x - F.element_at(acc, -1) >= least, F.concat(acc, F.array(x))).otherwise(acc))
        return F.when(F.size(b) <= 2, b).otherwise(F.concat(kept, F.array(F.element_at(b, -1))))

    return let(at, merged)


def cut_segments(df: DataFrame, key: str, centers, bounds: str, start: str, end: str, gap: float, least: float) -> DataFrame:
    """Rows (key, segment, start, end, kept): segments between boundaries (window numbers). A boundary lies halfway between
    the centres beside it; inner edges shrink by half the gap; segments shorter than `least` are not kept. `centers` is an
    array column, or a function from a window's number (0-based) to its centre."""
    n = F.size(bounds)
    center = centers if callable(centers) else lambda k: F.element_at(centers, k + 1)
    mid = lambda b: (center(b - 1) + center(b)) / 2 + F.col(start)
    held = [] if callable(centers) else [centers]
    x = df.select(key, *held, bounds, start, end, F.explode(F.sequence(F.lit(1), n - 1)).alias("k"))
    a = F.when(F.col("k") == 1, F.col(start)).otherwise(mid(F.element_at(bounds, F.greatest(F.col("k"), F.lit(2)))) + gap / 2)
    b = F.when(F.col("k") == n - 1, F.col(end)).otherwise(mid(F.element_at(bounds, F.least(F.col("k") + 1, n - 1))) - gap / 2)
    x = x.select(key, (F.col("k") - 1).alias("segment"), a.alias("start"), b.alias("end"))
    return x.withColumn("kept", F.col("end") - F.col("start") >= least)


def _pairs_upto(x: np.ndarray, w: np.ndarray, t: float) -> int:
    """Pairs at most `t` apart of the ascending distinct values `x` that occur `w` times, without pairs of equal values."""
    at, last = np.searchsorted(x, x + t, "right") - 1, len(x) - 1
    while (up := (at < last) & (x[np.minimum(at + 1, last)] - x <= t)).any():
        at += up
    while (down := x[at] - x > t).any():
        at -= down
    upto = w.cumsum()
    return int((w * (upto[at] - upto)).sum())


def _kth_pair(x: np.ndarray, w: np.ndarray, k: int) -> float:
    """The k-th smallest distance (from 1) of pairs of distinct values, by bisection over the bits of the number."""
    lo, hi = 0, int(np.float64(x[-1] - x[0]).view(np.int64))
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if _pairs_upto(x, w, np.int64(mid).view(np.float64)) >= k else (mid + 1, hi)
    return float(np.int64(lo).view(np.float64))


def _kth_square(x: np.ndarray, k: int, bits: int = 21, cells: int = 4_000_000) -> float:
    """The k-th smallest (from 1) positive squared distance of rows, by three histograms of the bits of the number."""
    rows, head = max(1, cells // max(1, x.size)), 0
    for shift in (2 * bits, bits, 0):
        n = np.zeros(1 << bits, np.int64)
        for lo in range(0, len(x), rows):
            sq = ((x[lo : lo + rows, None, :] - x[None, lo:, :]) ** 2).sum(2)
            v = sq[np.triu(np.ones(sq.shape, bool), 1) & (sq > 0)].view(np.int64)
            v = v[v >> (shift + bits) == head] >> shift
            n += np.bincount(v & ((1 << bits) - 1), minlength=1 << bits)
        upto = n.cumsum()
        at = int(np.searchsorted(upto, k))
        k -= int(upto[at - 1]) if at else 0
        head = head << bits | at
    return float(np.int64(head).view(np.float64))


def median_square(x: np.ndarray) -> float:
    """Median of the positive squared distances of all pairs of rows; 0 if there are none. Exact, in memory linear in the
    rows; with one column in n log n time, else quadratic."""
    if len(x) <= 1_000:  # all pairs at once give the same number faster
        sq = ((x[:, None, :] - x[None]) ** 2).sum(2)[np.triu_indices(len(x), 1)]
        return float(np.median(sq[sq > 0])) if (sq > 0).any() else 0.0
    values, w = np.unique(x, axis=0, return_counts=True)
    pairs = (len(x) ** 2 - int((w.astype(np.int64) ** 2).sum())) // 2
    if not pairs:
        return 0.0
    if x.shape[1] == 1:
        pick = lambda k: _kth_pair(values[:, 0], w.astype(np.int64), k) ** 2
    else:
        pick = lambda k: _kth_square(x, k)
    return pick(pairs // 2 + 1) if pairs % 2 else (pick(pairs // 2) + pick(pairs // 2 + 1)) / 2


def pelt_rbf(x: np.ndarray, penalty: float, least: int = 2) -> list[int]:
    """Ends of the segments of rows `x` that minimise the sum of kernel costs (rbf, median bandwidth) plus `penalty` for
    each, with pruning. Cost of rows a..b: length minus the sum of its kernel block over its length. The block sums of the
    open starts grow by a kernel column a row, so memory is linear in the rows, and a row costs as much time as there are
    rows since the oldest open start."""
    n = len(x)
    if n < 2 * least:
        return [n]
    median = median_square(x)
    gamma = 1 / median if median else 1.0
    best = np.full(n + 1, np.inf)
    best[0] = -penalty
    prev = np.zeros(n + 1, int)
    open_, block = np.array([0]), np.zeros(1)
    for b in range(1, n + 1):
        lo = open_[0]
        column = np.exp(-gamma * ((x[lo:b] - x[b - 1]) ** 2).sum(1))
        block = block + 2 * column[::-1].cumsum()[::-1][open_ - lo] - 1
        if b < least:
            continue
        use = open_ <= b - least
        size = b - open_[use]
        cost = size - block[use] / size
        total = best[open_[use]] + cost + penalty
        k = int(total.argmin())
        best[b], prev[b] = total[k], open_[use][k]
        keep = ~use
        keep[use] = best[open_[use]] + cost <= best[b]
        open_, block = np.append(open_[keep], b), np.append(block[keep], 0.0)
    out, b = [], n
    while b > 0:
        out.append(int(b))
        b = prev[b]
    return out[::-1]


def binary_rbf(x: np.ndarray, cuts: int, least: int = 2) -> list[int]:
    """Ends of the segments that `cuts` greedy cuts leave: each time the cut that lowers the kernel cost (as in `pelt_rbf`) the
    most, segments of `least` rows or more. Fewer cuts where none is possible. Quadratic memory in the rows."""
    n = len(x)
    median = median_square(x)
    gamma = 1 / median if median else 1.0
    # running sums over the upper triangle: block(a, b) = sum of the kernel over rows and columns a..b
    kernel = np.exp(-gamma * ((x[:, None, :] - x[None]) ** 2).sum(2)) if n else np.zeros((0, 0))
    sums = np.zeros((n + 1, n + 1))
    sums[1:, 1:] = kernel.cumsum(0).cumsum(1)
    cost = lambda a, b: (b - a) - (sums[b, b] - sums[a, b] - sums[b, a] + sums[a, a]) / (b - a)
    bounds = [0, n]
    for _ in range(cuts):
        best = None
        for a, b in zip(bounds, bounds[1:], strict=False):
            for t in range(a + least, b - least + 1):
                gain = cost(a, b) - cost(a, t) - cost(t, b)
                if best is None or gain > best[0] + 1e-12:
                    best = (gain, t)
        if best is None:
            break
        bounds = sorted([*bounds, best[1]])
    return bounds[1:]


def change_points(df: DataFrame, key: str, order: list[str], features: list[str], penalty: float = 3.0, least: int = 5, method: str = "pelt", cuts: int | None = None) -> DataFrame:
    """Rows (key, segment, first, last): change points of the standardised features of each key.

    `method` is "pelt" or "kernel" (the exact optimum under `penalty`; both are the same search here) or "binary" (`cuts`
    greedy cuts, which must be given; quadratic memory in the rows of a key).

    A key is standardised and searched as a whole in one task, whatever its rows: memory is linear in them, time up to
    quadratic where nothing changes. Rows with null features are left out.
    """
    if method not in ("pelt", "kernel", "binary") or (method == "binary" and cuts is None):
        raise ValueError("method is pelt, kernel, or binary with a number of cuts")
    x = df.where(" and ".join(f"`{f}` is not null" for f in features)).select(key, *dict.fromkeys([*order, *features]))

    def find(pdf: pd.DataFrame) -> pd.DataFrame:
        v = pdf.sort_values(order)[features].to_numpy(float)
        med, iqr = np.median(v, 0), np.subtract(*np.percentile(v, [75, 25], 0))
        scaled = (v - med) / (iqr + 1e-8)
        ends = binary_rbf(scaled, cuts, least) if method == "binary" else pelt_rbf(scaled, penalty, least)
        return pd.DataFrame({key: pdf[key].iloc[0], "segment": range(len(ends)), "first": [0, *ends[:-1]], "last": [e - 1 for e in ends]})

    kind = dict(df.dtypes)[key]
    return x.groupBy(key).applyInPandas(find, f"{key} {kind}, segment int, first int, last int")
