"""Packing with optimal length buckets.

A dynamic program over the global length histogram chooses the bucket
boundaries that minimise padding; inside each bucket, batches are filled up to
a token budget. Only the histogram (at most 128 + 64 per doubling of the length
rows) reaches the driver; documents are numbered inside their bucket in ranges,
so that a bucket with a third of all documents is spread over a third of the tasks.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.plans.staging import Stage

from ._common import bin_edge, n_words, numbered, table

BUCKETS = 16
BUDGET = 16_384  # padded tokens of a batch


def optimal_boundaries(edges: list[int], counts: list[int], totals: list[int], buckets: int) -> list[int]:
    """Upper edges of at most ``buckets`` buckets with the least padding.

    ``edges`` ascend; a bin has ``counts`` documents of ``totals`` tokens
    together. Among equally good choices the one with the shortest earlier
    buckets wins.
    """
    n = len(edges)
    if n == 0:
        return []
    k = min(buckets, n)
    upper = np.asarray(edges, dtype=np.float64)
    docs = np.concatenate([[0.0], np.cumsum(np.asarray(counts, dtype=np.float64))])
    tokens = np.concatenate([[0.0], np.cumsum(np.asarray(totals, dtype=np.float64))])
    # cost[i, j]: bins i..j as one bucket; a row is made when it is needed.
    best = upper * docs[1:] - tokens[1:]
    back = np.zeros((k, n), dtype=np.int64)
    for b in range(1, k):
        new = np.full(n, np.inf)
        for j in range(n):
            i = np.arange(1, j + 1) if j else np.arange(0)
            if len(i):
                cost = best[i - 1] + upper[j] * (docs[j + 1] - docs[i]) - (tokens[j + 1] - tokens[i])
                at = int(np.argmin(cost))
                new[j], back[b, j] = cost[at], i[at]
        better = new < best
        back[b] = np.where(better, back[b], -1)  # -1: one bucket fewer is as good
        best = np.where(better, new, best)
    out, j, b = [], n - 1, k - 1
    while j >= 0:
        while b > 0 and back[b, j] < 0:
            b -= 1
        out.append(int(edges[j]))
        j = int(back[b, j]) - 1 if b else -1
        b -= 1
    return out[::-1]


def pack(
    docs: DataFrame,
    keys: list[str],
    length: Column,
    order: list[Column],
    *,
    buckets: int = BUCKETS,
    budget: int = BUDGET,
) -> DataFrame:
    """The place of every row: ``keys`` + n_tokens, bucket, padded_length, batch, slot.

    ``length`` gives a row's tokens (null and negative: 0), ``order`` the order
    inside a bucket. A batch of bucket b has ``budget // padded_length`` rows, at
    least one: a document longer than the budget is a batch of its own. Rows
    with equal keys each have a place; of ties in ``order`` the place in the
    input decides. An empty table gives an empty result.
    """
    stage = Stage(docs.sparkSession, "pack")
    size = F.greatest(F.coalesce(length.cast("long"), F.lit(0)), F.lit(0))
    rows = docs.select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)],
        *[c.alias(f"_o{i}") for i, c in enumerate(order)],
        size.alias("_len"),
    )
    rows = stage.write(rows.withColumn("_edge", bin_edge(F.col("_len"))))
    hist = rows.groupBy("_edge").agg(F.count(F.lit(1)).alias("n"), F.sum("_len").alias("t")).orderBy("_edge").collect()
    ends = optimal_boundaries([r[0] for r in hist], [r[1] for r in hist], [r[2] for r in hist], buckets)
    bucket = F.lit(len(ends) - 1)
    padded = F.lit(ends[-1] if ends else 0).cast("long")
    for b in range(len(ends) - 2, -1, -1):
        bucket = F.when(F.col("_edge") <= ends[b], F.lit(b)).otherwise(bucket)
        padded = F.when(F.col("_edge") <= ends[b], F.lit(ends[b]).cast("long")).otherwise(padded)
    placed = rows.withColumn("_bucket", bucket.cast("int")).withColumn("_padded", padded)
    out = numbered(stage, placed.drop("_edge"), ["_bucket"], [f"_o{i}" for i in range(len(order))])
    capacity = F.greatest(F.floor(F.lit(budget) / F.greatest(F.col("_padded"), F.lit(1))), F.lit(1)).cast("long")
    return out.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keys)],
        F.col("_len").alias("n_tokens"),
        F.col("_bucket").alias("bucket"),
        F.col("_padded").alias("padded_length"),
        F.floor(F.col("_rank") / capacity).cast("long").alias("batch"),
        (F.col("_rank") % capacity).cast("long").alias("slot"),
    )


def op5_length_buckets(spark, sf_dir):
    """All documents by their words and one end mark, in 16 buckets, batches of 16,384 tokens."""
    docs = table(spark, sf_dir, "documents")
    return pack(docs, ["doc_id"], n_words(F.col("text")) + 1, [F.col("doc_id")])
