"""Connected components of a member-group graph by randomised contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import cut, release


def components(nodes: DataFrame, edges: DataFrame, node: str, hub: str, max_rounds: int = 60) -> DataFrame:
    """Rows (node, component): for every node of `nodes` the smallest node (by code point) that it is connected with.

    `edges` has rows (node, hub); nodes that share a hub are connected. Each round gives every node the neighbour, or
    itself, with the smallest hash of the round, and contracts the edges; hubs left with one node are dropped. That takes
    a number of rounds logarithmic in the number of nodes in expectation, whatever the shape of the graph. A hub or node
    of any degree is only ever reduced to a minimum, with a map-side combine, never gathered. Nothing is collected.

    Null nodes and null hubs are ignored; nodes without an edge are their own component; repeated edges change nothing.
    """
    names = nodes.select(F.col(node).alias("n")).where("n is not null").distinct()
    left = cut(edges.select(F.col(node).alias("n"), F.col(hub).alias("h")).where("n is not null and h is not null").distinct())
    maps: list[DataFrame] = []
    for k in range(max_rounds):
        ranked = left.withColumn("r", F.struct(F.xxhash64(F.col("n"), F.lit(k)).alias("x"), F.col("n").alias("n")))
        best = ranked.groupBy("h").agg(F.min("r").alias("r"), F.max("r").alias("top")).where("r <> top").select("h", "r")
        step = cut(left.join(best, "h").groupBy("n").agg(F.min("r").alias("r")).select("n", F.col("r.n").alias("to")))
        if step.isEmpty():
            release(step)
            break
        maps.append(step)
        # hubs with one node were left out of `best`, so they vanish here as well
        after = cut(left.join(best.select("h"), "h").join(step, "n").select(F.col("to").alias("n"), "h").distinct())
        release(left)
        left = after
    else:
        raise RuntimeError(f"components: still contracting after {max_rounds} rounds")
    at = names.select("n", F.col("n").alias("to"))
    for step in maps:
        at = at.join(step.select(F.col("n").alias("to"), F.col("to").alias("next")), "to", "left").select("n", F.coalesce("next", "to").alias("to"))
    at = cut(at)
    least = at.groupBy("to").agg(F.min("n").alias("component"))
    return at.join(least, "to").select(F.col("n").alias(node), "component")
