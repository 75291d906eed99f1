"""Exact top-k inner products with an impact-ordered index, score at a time.

Vectors become whole numbers. Each block of vectors is indexed by impact: a
posting segment holds the vectors whose component in one dimension has an impact
(its absolute value) of one level. Segments are processed level by level in
descending impact, adding query component times value to the scores. What the
levels still to come can add to a score is bounded by the norm of the rest of the
vector and by the level's largest impact. Processing stops only when these bounds
prove that few vectors can still be among the best; exactly those are scored anew
in whole numbers (of Python, where 64 bits might not hold a sum). Queries are compared with every block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendloom.plans.staging import Stage

from ._common import table

BLOCK = 4096  # vectors of an index block, on average
BATCH = 512  # queries processed together
LEVELS = (16, 8, 4, 2, 1)  # least impact of a level, descending
HUGE = 1e300  # sums of this size are not formed in doubles
FEW = 4  # stop when the members that are still possible are at most so many times k, on average


class ImpactIndex:
    """Posting segments of one block, by descending level, then dimension."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, unnamed: np.ndarray, values: np.ndarray):
        self.rows, self.ids, self.unnamed, self.values = rows, ids, unnamed, values
        impact = np.abs(values)
        norms = values**2
        upper = np.inf
        self.levels = []
        for least in LEVELS:
            inside = (impact >= least) & (impact < upper)
            segments = []
            for d in range(values.shape[1]):
                members = np.flatnonzero(inside[:, d])
                if len(members):
                    segments.append((d, members, values[members, d]))
            rest = np.sqrt(np.where(impact < least, norms, 0.0).sum(axis=1))
            self.levels.append((segments, rest, max(0, least - 1)))
            upper = least
        self._by_row = np.argsort(rows, kind="stable")

    def own(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the block, query) where a query is one of the block's own rows."""
        at = np.searchsorted(self.rows[self._by_row], rows)
        at = np.minimum(at, len(self.rows) - 1)
        place = self._by_row[at]
        hit = np.flatnonzero(self.rows[place] == rows)
        return place[hit], hit

    def best(self, rows: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the places and exact scores of its k best, ties to the smaller id; its own row takes no part."""
        n, q = len(self.ids), queries
        dims = min(q.shape[1], self.values.shape[1])
        bound = float(np.abs(self.values).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(1, dims)
        kind = np.float32 if bound < (1 << 24) else np.float64
        slack = 0.5 if bound < (1 << 50) else bound * 1e-12
        place, which = self.own(rows)
        whole = _whole(self.values[:, :dims], bound)
        if bound >= HUGE:  # sums of doubles could overflow: every member is possible
            possible = np.ones((n, len(q)), dtype=bool)
            possible[place, which] = False
            return self._rescored(possible, whole, _whole(q[:, :dims], bound), k)
        scores = np.zeros((n, len(q)), dtype=kind)
        length, total = np.sqrt((q**2).sum(axis=1)), np.abs(q).sum(axis=1)
        columns = np.ascontiguousarray(q.T).astype(kind)
        possible = None
        for level, (segments, rest, largest) in enumerate(self.levels):
            for d, members, value in segments:
                if d < dims:
                    scores[members] += value.astype(kind)[:, None] * columns[d][None, :]
            if level < len(self.levels) - 1 and largest > 3:
                continue
            left = np.minimum(rest[:, None] * length[None, :], (largest * total)[None, :]) + slack
            low = scores - left
            low[place, which] = -np.inf
            floor = np.partition(low, n - k, axis=0)[n - k] if n > k else np.full(len(q), -np.inf)
            possible = scores + left >= floor[None, :]
            possible[place, which] = False
            if possible.sum() <= FEW * k * len(q):
                break
        return self._rescored(possible, whole, _whole(q[:, :dims], bound), k)

    def _rescored(self, possible: np.ndarray, whole: np.ndarray, queries: np.ndarray, k: int):
        out = []
        for j in range(len(queries)):
            members = np.flatnonzero(possible[:, j])
            exact = whole[members] @ queries[j]
            order = np.lexsort((self.ids[members], self.unnamed[members], -exact))[:k]
            out.append((members[order], exact[order]))
        return out


def _whole(values: np.ndarray, bound: float) -> np.ndarray:
    """Whole doubles as numbers that add up exactly where no sum passes ``bound``."""
    if bound < float(1 << 62):
        return values.astype(np.int64)
    return np.array([int(v) for v in values.ravel()], dtype=object).reshape(values.shape)


def whole_vectors(rows: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """(row, id, x): scale * component of the vectors that take part; tasks take the floor, which a double holds exactly."""
    x = F.col(vector).cast("array<double>")
    sound = ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return rows.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(vec_id).cast("long").alias("id"),
        F.when(x.isNotNull() & sound, F.transform(x, lambda v: v * scale)).alias("x"),
    ).filter("x is not null")


def top_inner_products(
    vectors: DataFrame,
    is_query: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    *,
    k: int = 20,
    scale: int = 64,
    block: int = BLOCK,
) -> DataFrame:
    """query_id, rank (int, from 1), vec_id, score (long): each query's ``k`` best among all other rows.

    ``is_query`` is a condition on the column ``id``. Vectors that are null or hold
    null or non-finite components take no part; where lengths differ the
    shorter vector counts as zero beyond its end. Components may be of any size: a
    score that passes 64 bits among the best of a block ends the query with an OverflowError, none is
    left out. Repeated rows and ids are rows each: a copy of the query is a
    candidate, its own row is not. Rows without an id are candidates, behind all
    others of the same score, and queries if ``is_query`` says so. Columns other
    than the two named are not read. Fewer candidates give fewer rows, an empty
    table none.
    """
    stage = Stage(vectors.sparkSession, "impact")
    rows = stage.write(whole_vectors(vectors, vec_id, vector, scale))
    blocks = max(1, -(-rows.count() // block))
    indexed = rows.select(F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block"), F.lit(0).alias("query"), "row", "id", "x")
    queries = rows.filter(is_query).select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), F.lit(1).alias("query"), "row", "id", "x"
    )

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, index, held = None, None, []

        def matrix(parts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
            size = [np.diff(p.column(4).offsets.to_numpy()) for p in parts]
            width = max((int(s.max(initial=0)) for s in size), default=0)
            values = np.zeros((sum(len(s) for s in size), width))
            at = 0
            for p, s in zip(parts, size):
                filled = np.arange(width)[None, :] < s[:, None]
                values[at : at + len(s)][filled] = np.floor(p.column(4).flatten().to_numpy())
                at += len(s)
            rows = np.concatenate([p.column(2).to_numpy() for p in parts])
            ids = np.concatenate([p.column(3).fill_null(0).to_numpy() for p in parts])
            unnamed = np.concatenate([p.column(3).is_null().to_numpy(zero_copy_only=False) for p in parts])
            return rows, ids, unnamed, values

        for batch in batches:
            keys = batch.column(0).to_numpy() * 2 + batch.column(1).to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                key = int(keys[a])
                if key // 2 != current:
                    current, index, held = key // 2, None, []
                if key % 2 == 0:
                    held.append(part)
                    continue
                if index is None and held:
                    index, held = ImpactIndex(*matrix(held)), []
                if index is None:
                    continue  # a block without vectors
                for i in range(0, part.num_rows, BATCH):
                    some = part.slice(i, BATCH)
                    row, ids, unnamed, values = matrix([some])
                    found = index.best(row, values, k)
                    sizes = [len(f[0]) for f in found]
                    places = np.concatenate([f[0] for f in found])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(row, sizes)), pa.array(np.repeat(ids, sizes), mask=np.repeat(unnamed, sizes)),
                            pa.array(index.ids[places], mask=index.unnamed[places]), pa.array(index.rows[places]),
                            pa.array(np.concatenate([f[1] for f in found]), type=pa.int64()),
                        ],
                        names=["row", "query_id", "vec_id", "of", "score"],
                    )

    placed = indexed.unionByName(queries).repartition("block").sortWithinPartitions("block", "query")
    partial = placed.mapInArrow(searched, "row long, query_id long, vec_id long, of long, score long")
    best = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "of")
    ranked = partial.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op8_impact_topk(spark, sf_dir):
    """Every twentieth vector against all others: its 20 highest inner products of floor(64 x)."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_inner_products(vectors, F.col("id") % 20 == 0)
