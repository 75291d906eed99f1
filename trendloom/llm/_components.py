"""Connected components over long ids by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.plans.staging import Stage

MAX_ROUNDS = 60


def components(stage: Stage, edges: DataFrame) -> DataFrame:
    """(id, root) for every id in ``edges`` (a, b); root is the smallest id reachable.

    Each half-round is a grouped minimum, combined before the shuffle, and a join
    whose hot keys the adaptive planner splits; every round is written to the
    shared folder and the one before it is dropped. The number of rounds grows
    with the logarithm of the longest chain.
    """
    pairs = stage.write(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    seen = _fingerprint(pairs)
    for _ in range(MAX_ROUNDS):
        if not seen[0]:
            break
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = (
            both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = least.select("u", F.col("m").alias("v"))
        after = stage.write(small.unionByName(own).filter("u <> v").distinct())
        now = _fingerprint(after)
        stage.drop(pairs)
        pairs = after
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = pairs.select(F.col("u").alias("id"), F.col("v").alias("root"))
    return roots.unionByName(pairs.select(F.col("v").alias("id"), F.col("v").alias("root"))).distinct()


def _fingerprint(pairs: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    return tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.pmod(h, F.lit(1 << 31))), F.bit_xor(h)).first())
