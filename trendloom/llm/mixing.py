"""Mixing sources to target weights by Pfair scheduling.

Each block of a source gets a release time and a deadline from the source's
target weight, and one block per slot is taken earliest-deadline-first, so that
no source is ever a whole block away from its share. Weights are counted in
2^40ths of their sum. About a million slots are scheduled, or as many as the
table's blocks need; longer tables repeat them. Every block finds its slot by
arithmetic and one lookup.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.plans.sizing import fits_broadcast, lookup_join
from trendloom.plans.staging import Stage

from ._common import numbered, table, text_of

PARTS = 1 << 40  # of the sum of all weights
SLOTS = 1 << 20  # of the schedule that is repeated
LEAST = 16  # slots a source on average, where there are more sources than SLOTS / LEAST
BLOCK = 32  # documents of a block
MAX_SOURCES = 1_000_000  # their names and weights are listed on the driver


def pfair_period(
    parts: Sequence[int], blocks: Sequence[int] | None = None, slots: int | None = None
) -> Iterator[tuple[int, int]]:
    """(source, its how-manieth block) for each slot of one period, or of its first ``slots`` slots.

    Source s with p of P parts has block j's window from floor(j * P / p) to
    ceil((j + 1) * P / p); in every slot the released block with the earliest
    deadline runs, of ties the source listed first. On one processor this meets
    every window. With ``blocks`` the schedule ends once each source has had so many.
    """
    period = sum(parts)
    wanted = [min(p, p if blocks is None else blocks[s]) for s, p in enumerate(parts)]
    left = sum(wanted)
    waiting = [(0, s, 0) for s in range(len(parts))]  # release, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []  # deadline, source, block
    slot = 0
    while left and (slots is None or slot < slots):
        while waiting and waiting[0][0] <= slot:
            _, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * period // parts[s]), s, j))
        deadline, s, j = heapq.heappop(ready)
        assert deadline > slot, "a window was missed"
        yield s, j
        left -= j < wanted[s]
        if j + 1 < parts[s]:
            heapq.heappush(waiting, ((j + 1) * period // parts[s], s, j + 1))
        slot += 1


def mix(
    docs: DataFrame,
    keys: list[str],
    source: str,
    weights: DataFrame,
    order: list[Column],
    *,
    block: int = BLOCK,
    resolution: int = PARTS,
) -> DataFrame:
    """The slot of every row: ``keys`` + source, block, slot (long), place (in the block).

    ``weights`` has (source, weight), one row for each source; the source null is
    one of its own. A weight counts as its share of the sum in whole parts of
    ``resolution``; sources without a row in ``weights``, or with a weight that is
    null, not finite or not above zero, and those with less count as two in SLOTS
    (2^20, or 16 times the number of sources where that is more). Each source is
    read in ``order``, cut into blocks of ``block`` rows. Every row is placed once:
    nothing is repeated or left out. As long as all sources last, every prefix of
    the first SLOTS slots is less than one block off each source's share. A longer
    table repeats them, and each repetition adds less than one block to the
    distance. Slots of a source that has run dry stay empty, and the others keep
    their proportions. Ties in ``order`` follow the place in the input. More than
    a million sources are an error.

    The result has the names of ``keys``, then ``source``, ``block``, ``slot`` and
    ``place``; a key of one of these names is an error.
    """
    spark = docs.sparkSession
    clash = {"source", "block", "slot", "place"} & {k.lower() for k in keys}
    if clash:
        raise ValueError(f"rename the keys {sorted(clash)}: the result has columns of these names")
    stage = Stage(spark, "mix")
    rows = docs.select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)],
        *[c.alias(f"_o{i}") for i, c in enumerate(order)],
        F.col(source).cast("string").alias("_source"),
    )
    w = F.col(weights.columns[1]).cast("double")
    given = weights.select(
        F.col(weights.columns[0]).cast("string").alias("_source"),
        F.when(F.isnan(w) | (w <= 0) | (w == float("inf")), None).otherwise(w).alias("_weight"),
    )
    counted = rows.groupBy("_source").agg(F.count(F.lit(1)).alias("_n"), F.lit(None).cast("double").alias("_weight"))
    listed = (
        counted.unionByName(given.withColumn("_n", F.lit(0).cast("long")))
        .groupBy("_source").agg(F.sum("_n").alias("_n"), F.max("_weight").alias("_weight"))
        .orderBy(F.col("_source").asc_nulls_first()).limit(MAX_SOURCES + 1).collect()
    )
    if len(listed) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources; group them before mixing")
    slots = max(SLOTS, LEAST * len(listed))
    share = whole_parts([r[2] for r in listed], resolution, slots)
    blocks = [-(-r[1] // block) for r in listed]
    run = np.fromiter(pfair_period(share, blocks, slots), dtype=[("i", "i4"), ("j", "i8")])
    had = np.maximum(1, np.bincount(run["i"], minlength=len(listed))).tolist()  # blocks of a source in one run
    used = np.flatnonzero(run["j"] < np.array(blocks, dtype=np.int64)[run["i"]])
    plan = stage.write(spark.createDataFrame(pa.table({"i": run["i"][used], "j": run["j"][used], "at": used})))
    each = stage.write(
        spark.createDataFrame([(_key(r[0]), i, had[i]) for i, r in enumerate(listed)], "_key string, _i int, _had long")
    )
    ranked = numbered(stage, rows, ["_source"], [f"_o{i}" for i in range(len(order))])
    ranked = ranked.withColumn("_block", F.floor(F.col("_rank") / block).cast("long"))
    # Bounded by MAX_SOURCES and by SLOTS; what is not measured to be small is not broadcast.
    keyed = ranked.withColumn("_key", F.coalesce(F.concat(F.lit("="), "_source"), F.lit("")))
    ranked = lookup_join(keyed, each, "_key", "inner", spread_by="_rank").drop("_key")
    ranked = ranked.withColumn("_j", F.col("_block") % F.col("_had"))
    plan = F.broadcast(plan) if fits_broadcast(plan) else plan
    placed = ranked.join(plan, (F.col("_i") == F.col("i")) & (F.col("_j") == F.col("j")))
    cycle = F.floor(F.col("_block") / F.col("_had")).cast("long")
    return placed.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keys)],
        F.col("_source").alias("source"),
        F.col("_block").alias("block"),
        (cycle * len(run) + F.col("at")).alias("slot"),
        (F.col("_rank") % block).cast("long").alias("place"),
    )


def whole_parts(weights: Sequence[float | None], parts: int = PARTS, slots: int = SLOTS) -> list[int]:
    """Weights (null: none) in whole parts of about ``parts``, enough of them for a block in ``slots`` slots."""
    least = max(1, -(-2 * parts // slots))
    top = max((w for w in weights if w is not None), default=1.0)
    total = math.fsum(w / top for w in weights if w is not None)  # of fractions of the largest, lest it overflow
    return [least if w is None else max(least, math.floor(parts * (w / top / total) + 0.5)) for w in weights]


def _key(source: str | None) -> str:
    return "" if source is None else f"={source}"


def root_weights(docs: DataFrame, source: str) -> DataFrame:
    """Target weights that damp large sources: the square root of their characters."""
    return docs.groupBy(F.col(source).alias("source")).agg(
        F.sqrt(F.sum(F.length(text_of(F.col("text")))).cast("double")).alias("weight")
    )


def op3_pfair_mix(spark, sf_dir):
    """All documents, weighted by the square root of their source's characters, in blocks of 32."""
    docs = table(spark, sf_dir, "documents")
    return mix(docs, ["doc_id"], "source", root_weights(docs, "source"), [F.col("doc_id")])
