"""A sample whose category shares match given targets."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import cut


def distinct_units(units: DataFrame, targets: DataFrame) -> DataFrame:
    """Distinct (scope, category, unit) of the categories that have a target, written once: moments, draw and report read
    it. Units of null category or null unit are not available."""
    named = F.broadcast(targets.select("scope", "category").distinct())  # as many rows as there are targets
    return cut(units.where("category is not null and unit is not null").select("scope", "category", "unit").join(named, ["scope", "category"], "left_semi").distinct())


def calibrated(share: np.ndarray, floor: np.ndarray, have: np.ndarray, total: float, steps: int = 200) -> np.ndarray:
    """Expected sample sizes of the categories of one scope, by Newton iterations on the exponential-tilting dual.

    Of all sizes x with floor <= x <= have that add up to `total`, those nearest to the target shares in the sense of
    sum x log(x / share) - x. With a multiplier m for the total and the bounds' multipliers eliminated, the solution is
    x = share * exp(m), held within its bounds; the dual is concave in m, its gradient is total - sum x and its curvature
    minus the sum of the sizes strictly within their bounds. A step that leaves the interval known to hold the root is
    halved into it. If not even all that is available reaches `total`, all of it is taken; if the floors exceed it, the
    floors stand; categories without a share get their floor.
    """
    floor = np.minimum(floor, have).astype(float)
    live = (share > 0) & (have > 0)
    if not live.any() or floor.sum() >= total:
        return floor
    if np.where(live, have, floor).sum() <= total:
        return np.where(live, have, floor).astype(float)
    s, a, b = share[live].astype(float), np.maximum(floor[live], 1e-300), have[live].astype(float)
    rest = floor[~live].sum()
    lo, hi = float(np.log(a / s).min()), float(np.log(b / s).max())
    m = min(max(float(np.log(total / s.sum())), lo), hi)
    for _ in range(steps):
        x = np.clip(s * np.exp(m), floor[live], b)
        gap = total - rest - x.sum()
        if abs(gap) <= 1e-10 * total:
            break
        lo, hi = (m, hi) if gap > 0 else (lo, m)
        bend = x[(x > floor[live]) & (x < b)].sum()
        after = m + gap / bend if bend > 0 else np.inf
        m = after if lo < after < hi else (lo + hi) / 2
    out = floor.copy()
    out[live] = x
    return out


def chances(moments: list[dict]) -> dict[str, float]:
    """Inclusion probability per category of one scope: with base probability d = total / available for every unit, the
    calibrated size x gives the tilted probability d * exp(log(x / (available * d))) = x / available."""
    total = max((r["sample_rows"] or 0 for r in moments), default=0)
    have = np.array([r["available"] for r in moments], float)
    x = calibrated(np.array([r["target_share"] or 0 for r in moments], float), np.array([r["min_rows"] or 0 for r in moments], float), have, float(total))
    return {r["category"]: float(min(1.0, k / n)) if n else 0.0 for r, k, n in zip(moments, x, have, strict=True)}


def pivotal(p: np.ndarray, u: np.ndarray) -> np.ndarray:
    """The pivotal method in the given order: 0/1 for all but at most one unit, which keeps the rest of probability."""
    p = p.copy()
    a = -1
    for b in range(len(p)):
        if p[b] <= 1e-9 or p[b] >= 1 - 1e-9:
            p[b] = round(p[b])
            continue
        if a < 0:
            a = b
            continue
        s = p[a] + p[b]
        if s < 1:
            win = u[b] * s < p[a]
            p[a], p[b] = (s, 0.0) if win else (0.0, s)
        else:
            win = u[b] * (2 - s) < 1 - p[b]
            p[a], p[b] = (1.0, s - 1) if win else (s - 1, 1.0)
        if not 1e-9 < p[a] < 1 - 1e-9:
            p[a] = round(p[a])
            a = b if 1e-9 < p[b] < 1 - 1e-9 else -1
        if a != b and not 1e-9 < p[b] < 1 - 1e-9:
            p[b] = round(p[b])
    return p


def draw(units: DataFrame, targets: DataFrame, seed: int = 0, block_rows: int = 20_000) -> DataFrame:
    """Rows (scope, category, unit, drawn): the decision on every distinct unit of a category with a target. Probabilities
    come from `chances`, over moments of all units.

    Units that are sure (probability 0 or 1) are decided at once. The others of a category are spread over blocks of about
    `block_rows` by hash; the pivotal method runs in each block and leaves at most one undecided unit, and the undecided
    are the units of the next level (by category, then by scope) until one block is left. So no task holds a category, and
    each size is met within one unit, the total exactly up to rounding. Categories without target, null units and null
    categories are not decided on; an empty table gives no rows.
    """
    return _decide(distinct_units(units, targets), targets, seed, block_rows)


def _decide(distinct: DataFrame, targets: DataFrame, seed: int = 0, block_rows: int = 20_000) -> DataFrame:
    spark = distinct.sparkSession
    have = distinct.groupBy("scope", "category").agg(F.count("*").alias("available"))
    scopes: dict[str, list[dict]] = {}
    for x in targets.join(F.broadcast(have), ["scope", "category"], "left").fillna(0, ["available"]).collect():  # one row a target
        scopes.setdefault(x["scope"], []).append(x.asDict())
    plan = []
    for scope, own in sorted(scopes.items(), key=lambda x: str(x[0])):
        p = chances(own)
        plan += [(scope, r["category"], p[r["category"]], max(1, math.ceil(r["available"] / block_rows))) for r in own if r["available"]]
    table = F.broadcast(spark.createDataFrame(plan, "scope string, category string, p double, blocks int"))
    known = distinct.join(table, ["scope", "category"])
    sure = (F.col("p") <= 1e-9) | (F.col("p") >= 1 - 1e-9)
    kept = [known.where(sure).select("scope", "category", "unit", (F.col("p") > 0.5).alias("drawn"))]
    h = F.xxhash64("scope", "unit", F.lit(seed))
    left = known.where(~sure).select("scope", "category", "unit", "p", F.col("category").alias("within"), F.pmod(h, F.col("blocks")).cast("long").alias("block"))

    def level(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(k=pd.util.hash_pandas_object(pdf["unit"].astype(str) + f"\0{seed}", index=False)).sort_values(["k", "unit", "category"])
        rng = np.random.default_rng(int(pdf["k"].iloc[0]) % (1 << 63))
        pdf["p"] = pivotal(pdf["p"].to_numpy(float), rng.random(len(pdf)))
        return pdf.drop(columns="k")

    schema = left.schema
    most = max([b for _, _, p, b in plan if 1e-9 < p < 1 - 1e-9], default=0)
    undecided = (F.col("p") > 1e-6) & (F.col("p") < 1 - 1e-6)
    while most >= 0:
        done = cut(left.groupBy("scope", "within", "block").applyInPandas(level, schema))
        kept.append(done.where(~undecided).select("scope", "category", "unit", (F.col("p") > 0.5).alias("drawn")))
        left = done.where(undecided)
        if most > 1:
            most = math.ceil(most / block_rows)
            left = left.withColumn("block", F.floor(F.col("block") / block_rows))
        elif most == 1:
            most = 0  # last level: the one undecided unit of each category, together for the scope
            left = left.withColumn("within", F.lit("")).withColumn("block", F.lit(0).cast("long"))
        else:
            kept.append(left.select("scope", "category", "unit", (F.col("p") >= 0.5).alias("drawn")))
            break
    out = kept[0]
    for x in kept[1:]:
        out = out.unionByName(x)
    return out


def report(targets: DataFrame, decided: DataFrame) -> DataFrame:
    """Per target what the draw came to: `drawn` units, `spare` units that it passed over, the share reached, `missing`
    (rows that the draw falls short of the greater of min_rows and target_share * sample_rows), `met` (no row is missing
    that a spare unit couldn't fill) and `reached` (none is missing, up to the one unit that rounding may take; floors of
    other categories may leave fewer). Everything is counted from the rows of the draw: a draw that loses units shows."""
    got = decided.groupBy("scope", "category").agg(F.count_if("drawn").alias("drawn"), F.count_if(~F.col("drawn")).alias("spare"))
    want = F.greatest(F.coalesce("min_rows", F.lit(0)).cast("double"), F.coalesce(F.col("target_share") * F.col("sample_rows"), F.lit(0.0)))
    x = targets.join(F.broadcast(got), ["scope", "category"], "left").fillna(0, ["drawn", "spare"])
    whole = F.sum("drawn").over(Window.partitionBy("scope"))  # over the rows of the targets
    return x.select(
        "scope", "category", "target_share", "min_rows", "sample_rows", "drawn", "spare", (F.col("drawn") / F.nullif(whole, F.lit(0))).alias("share"), F.greatest(F.lit(0.0), want - F.col("drawn")).alias("missing"),
        (F.col("drawn") + F.col("spare") >= want).alias("met"), (F.col("drawn") > want - 1).alias("reached"),
    )
