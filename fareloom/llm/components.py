"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import written

MOST_ROUNDS = 100


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One step: hang neighbours of each node on the least node it knows.

    The large step moves the neighbours above a node, the small step those
    below it. The least neighbour is a map-side aggregation, and is written
    before the join: then both sides of the join are plain shuffles, of which
    adaptive execution can split a node that very many links share.
    """
    sides = links
    if large:
        sides = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
    known = sides.join(written(least, "least"), "u")
    if large:
        moved = known.where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    else:
        below = known.select(F.col("v").alias("u"), F.col("least").alias("v"))
        moved = below.unionByName(known.select("u", F.col("least").alias("v")))
    return moved.where("u > v").distinct()


def _state(links: DataFrame):
    hashed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return links.agg(F.count(F.lit(1)), F.sum(hashed)).first()


def components(links: DataFrame) -> DataFrame:
    """Each linked node but the least of its component: `u`, and that least `v`.

    `links` has columns `u` and `v`, in any direction and repeated or not. The
    rounds (large and small star in turn) are logarithmic in number; each is
    written, so that a lost executor costs one round at most.
    """
    ordered = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = written(ordered.where("u > v").distinct(), "links")
    state = _state(now)
    for _ in range(MOST_ROUNDS):
        if not state[0]:
            return now
        now = written(_star(written(_star(now, large=True), "large"), large=False), "small")
        before, state = state, _state(now)
        if before == state:
            return now
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
