"""Embedding near-duplicates by hierarchical navigable small-world graphs.

Vectors are spread over shards of bounded size; a task builds a shard's graph,
which is stored, and every slice of the vectors is searched in every graph, one
task for each pair of a graph and a slice. Searches run side by side for a batch of
vectors: each step expands the best open nodes of all beams at once. From what a
beam finds above the threshold, the search goes on along links until nothing more
lies above it, so a beam narrower than a group of copies loses none of it. Before a shard
answers, its beam is audited: vectors made at the threshold's distance from stored
ones are searched, the results are held against all vectors of the shard, and the
beam is doubled until enough is found. Links are confirmed by cosine in double
precision and united into components.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.plans.staging import Stage

from ._common import shuffle_partitions, table
from ._components import components

SHARD = 65_536  # vectors of a graph, on average: about 50 MB with 64 dimensions
SLICE = 16_384  # vectors that one task searches in one graph, on average: more where graphs are many
PIECE = 4_000_000  # bytes of a stored row of a graph
DEGREE = 16  # links a new node makes; up to 3 times as many are kept on the lowest layer
BEAM = 32  # first width of a search
BUILD_BEAM = 40
BATCH = 256
EXPAND = 4  # nodes of a beam that one step opens
AUDITS = 256
PAIRS = 65_536  # pairs of a query and a node that are compared at once beyond the beams, about
RECALL = 0.97


class Graph:
    """Navigable small-world layers over unit vectors; layer 0 holds all nodes."""

    def __init__(self, unit: np.ndarray, seed: int = 7):
        self._hold(unit)
        n = len(unit)
        draw = np.random.Generator(np.random.PCG64(seed)).random(n)
        level = np.minimum((-np.log(np.maximum(draw, 1e-12)) / math.log(DEGREE)).astype(np.int64), 6)
        order = np.lexsort((np.arange(n), -level))  # the highest first, so that every layer begins with its entry
        self.layers: list[np.ndarray] = []
        self.room: list[int] = []
        self.sizes: list[np.ndarray] = []
        for at in range(int(level.max(initial=0)) + 1):
            room = 3 * DEGREE if at == 0 else 2 * DEGREE
            self.layers.append(np.full((n, room), -1, dtype=np.int32))
            self.sizes.append(np.zeros(n, dtype=np.int32))
            self.room.append(room)
        self.entry = int(order[0]) if n else -1
        self.level, done, size = level, 1, 1
        while done < n:
            batch = order[done : done + size]
            self._insert(batch)
            done += len(batch)
            size = min(BATCH, max(1, done // 2))

    def _hold(self, unit: np.ndarray) -> None:
        self.x = np.ascontiguousarray(unit, dtype=np.float32)
        self._seen = np.zeros((BATCH, len(unit)), dtype=np.int32)
        self._base, self._next = 1, 1

    def parts(self) -> dict:
        """What a stored graph needs besides its vectors: the rows of each layer's members."""
        members = [np.flatnonzero(self.level >= at) for at in range(len(self.layers))]
        return {
            "entry": self.entry, "level": self.level, "members": members,
            "links": [layer[m] for layer, m in zip(self.layers, members)],
        }

    @classmethod
    def of(cls, unit: np.ndarray, parts: dict) -> Graph:
        graph = cls.__new__(cls)
        graph._hold(unit)
        graph.entry, graph.level, graph.layers = parts["entry"], parts["level"], []
        for members, links in zip(parts["members"], parts["links"]):
            whole = np.full((len(unit), links.shape[1]), -1, dtype=np.int32)
            whole[members] = links
            graph.layers.append(whole)
        return graph

    def _insert(self, batch: np.ndarray) -> None:
        """Links a batch of nodes: each searches what is there and looks through the batch itself."""
        q = self.x[batch]
        entries = np.full((len(batch), 1), self.entry, dtype=np.int32)
        within = q @ q.T
        np.fill_diagonal(within, -np.inf)
        for layer in range(len(self.layers) - 1, -1, -1):
            member = self.level[batch] >= layer
            ids, sims = self._beam(layer, q, entries, BUILD_BEAM if member.any() else 4)
            entries = ids[:, : min(4, ids.shape[1])]
            if not member.any():
                continue
            here = np.flatnonzero(member)
            near = min(DEGREE, len(here) - 1)
            ids, sims = ids[here], sims[here]
            if near > 0:
                block = within[np.ix_(here, here)]
                at = np.argpartition(-block, near - 1, axis=1)[:, :near]
                ids = np.concatenate([ids, batch[here][at].astype(np.int32)], axis=1)
                sims = np.concatenate([sims, np.take_along_axis(block, at, axis=1)], axis=1)
            chosen = self._diverse(ids, sims, DEGREE)
            nodes = batch[here]
            self.layers[layer][nodes, :DEGREE] = chosen
            self.sizes[layer][nodes] = (chosen >= 0).sum(axis=1)
            row, column = np.nonzero(chosen >= 0)
            self._link_back(layer, chosen[row, column], nodes[row].astype(np.int32))

    def _link_back(self, layer: int, to: np.ndarray, source: np.ndarray) -> None:
        links, sizes, room = self.layers[layer], self.sizes[layer], self.room[layer]
        known = (links[to] == source[:, None]).any(axis=1)
        to, source = to[~known], source[~known]
        sims = np.einsum("ij,ij->i", self.x[to], self.x[source])
        order = np.lexsort((-sims, to))
        to, source = to[order], source[order]
        nodes, first, counts = np.unique(to, return_index=True, return_counts=True)
        rank = np.arange(len(to)) - np.repeat(first, counts)
        free = sizes[to] + rank < room
        links[to[free], (sizes[to] + rank)[free]] = source[free]
        full = np.flatnonzero(sizes[nodes] + counts > room)
        sizes[nodes] = np.minimum(sizes[nodes] + counts, room)
        for i in range(0, len(full), BATCH):
            part = nodes[full[i : i + BATCH]]
            more = np.full((len(part), room), -1, dtype=np.int32)
            width = np.minimum(counts[full[i : i + BATCH]], room)
            cell = np.arange(room)[None, :] < width[:, None]
            more[cell] = source[(first[full[i : i + BATCH]][:, None] + np.arange(room)[None, :])[cell]]
            ids = np.concatenate([links[part], more], axis=1)
            sims = np.einsum("ikd,id->ik", self.x[ids], self.x[part])
            sims[ids < 0] = -np.inf
            kept = self._diverse(ids, sims, 2 * room // 3)
            links[part] = -1
            links[part, : kept.shape[1]] = kept
            sizes[part] = (kept >= 0).sum(axis=1)

    def _diverse(self, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """Up to ``most`` of each row's candidates: nearer to the node than to those chosen; then the nearest left over."""
        order = np.argsort(-sims, axis=1, kind="stable")
        ids, sims = np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1)
        same = ids[:, 1:] == ids[:, :-1]
        sims[:, 1:][same] = -np.inf
        vectors = self.x[ids]
        between = vectors @ vectors.transpose(0, 2, 1)
        width = ids.shape[1]
        chosen = np.zeros(ids.shape, dtype=bool)
        count = np.zeros(len(ids), dtype=np.int64)
        for i in range(width):
            blocked = (np.where(chosen[:, :i], between[:, i, :i], -np.inf) > sims[:, i, None]).any(axis=1)
            take = ~blocked & (count < most) & (sims[:, i] > -np.inf)
            chosen[:, i] = take
            count += take
        rest = np.where(chosen, 2.0, np.where(sims > -np.inf, 1.0, 0.0))
        pick = np.argsort(-rest, axis=1, kind="stable")[:, :most]
        out = np.take_along_axis(ids, pick, axis=1)
        out[np.take_along_axis(rest, pick, axis=1) == 0] = -1
        if out.shape[1] < most:
            out = np.concatenate([out, np.full((len(out), most - out.shape[1]), -1, dtype=out.dtype)], axis=1)
        return out.astype(np.int32)

    def _beam(self, layer: int, q: np.ndarray, entries: np.ndarray, width: int):
        """(ids, similarities), best first, of a beam search for each row of ``q``; -1 where a beam isn't full."""
        links, n = self.layers[layer], len(q)
        self._forget()
        ids = np.full((n, width), -1, dtype=np.int32)
        sims = np.full((n, width), -np.inf, dtype=np.float32)
        row, column = np.nonzero(entries >= 0)
        row, node = self._fresh(row, entries[row, column])
        open_ = np.zeros((n, width), dtype=bool)
        while len(row):
            found = np.einsum("ij,ij->i", self.x[node], q[row])
            better = found > sims[row, -1]
            row, node, found = row[better], node[better], found[better]
            if len(row):
                touched, first, counts = np.unique(row, return_index=True, return_counts=True)
                cell = (np.repeat(np.arange(len(touched)), counts), np.arange(len(row)) - np.repeat(first, counts))
                add_ids = np.full((len(touched), int(counts.max())), -1, dtype=np.int32)
                add_sims = np.full(add_ids.shape, -np.inf, dtype=np.float32)
                add_ids[cell], add_sims[cell] = node, found
                all_ids = np.concatenate([ids[touched], add_ids], axis=1)
                all_sims = np.concatenate([sims[touched], add_sims], axis=1)
                all_open = np.concatenate([open_[touched], add_ids >= 0], axis=1)
                order = np.argsort(-all_sims, axis=1, kind="stable")[:, :width]
                ids[touched] = np.take_along_axis(all_ids, order, axis=1)
                sims[touched] = np.take_along_axis(all_sims, order, axis=1)
                open_[touched] = np.take_along_axis(all_open, order, axis=1)
            take = open_ & (np.cumsum(open_, axis=1) <= EXPAND)
            at, column = np.nonzero(take)
            open_[take] = False
            near = links[ids[at, column]]
            i, k = np.nonzero(near >= 0)
            row, node = self._fresh(at[i], near[i, k])
        return ids, sims

    def _forget(self) -> None:
        """From now on no pair counts as seen: older stamps lie below the base."""
        if self._next > 1 << 30:
            self._seen[:] = 0
            self._next = 1
        self._base = self._next

    def _fresh(self, row: np.ndarray, node: np.ndarray):
        """Pairs met for the first time, in their order; they are marked as seen."""
        new = self._seen[row, node] < self._base
        row, node = row[new], node[new]
        stamp = np.arange(self._next, self._next + len(row), dtype=np.int32)
        self._next += len(row)
        self._seen[row, node] = stamp
        one = self._seen[row, node] == stamp  # of a pair that came twice, the last
        return row[one], node[one]

    def within(
        self, q: np.ndarray, least: float, width: int, own: np.ndarray | None = None, most: int = PAIRS
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, node) pairs whose similarity is about ``least`` or more, found with beams of ``width``.

        They come in chunks of at most about ``most`` pairs, each pair once. ``own`` gives the node that a query is
        itself, -1 where it is none.
        """
        q = np.ascontiguousarray(q, dtype=np.float32)
        entries = np.full((len(q), 1), self.entry, dtype=np.int32)
        for layer in range(len(self.layers) - 1, 0, -1):
            entries, _ = self._beam(layer, q, entries, 8)
        if own is not None:
            entries = np.concatenate([entries, own[:, None].astype(np.int32)], axis=1)
        ids, sims = self._beam(0, q, entries, max(width, entries.shape[1]))
        row, column = np.nonzero(sims >= least - 1e-5)
        # Beyond the beam: what links lead to from a find, as long as it lies above the threshold itself. Nodes that
        # the beam has let go are looked at again. Finds wait in chunks so small that their links are at most ``most``.
        self._forget()
        step = max(1, most // self.layers[0].shape[1])
        row, node = self._fresh(row.astype(np.int32), ids[row, column])
        open_ = [(row[i : i + step], node[i : i + step]) for i in range(0, len(row), step)]
        while open_:
            row, node = open_.pop()
            while open_ and len(row) + len(open_[-1][0]) <= step:
                more = open_.pop()
                row, node = np.concatenate([row, more[0]]), np.concatenate([node, more[1]])
            yield row, node
            near = self.layers[0][node]
            i, k = np.nonzero(near >= 0)
            row, node = self._fresh(row[i], near[i, k])
            near_enough = np.einsum("ij,ij->i", self.x[node], q[row]) >= least - 1e-5
            row, node = row[near_enough], node[near_enough]
            open_ += [(row[i : i + step], node[i : i + step]) for i in range(0, len(row), step)]

    def audited_width(self, least: float, recall: float = RECALL, audits: int = AUDITS) -> int:
        """The first of the widths BEAM, 2 BEAM, ... that finds ``recall`` of what lies within reach of an audit vector.

        That is the mean over the vectors that reach something, so that a large group counts no more than a
        small one. An audit vector lies at the threshold from a stored vector, in a random
        direction; what is within reach comes from comparing with all vectors.
        """
        n, width = len(self.x), BEAM
        if n < 2:
            return width
        rng = np.random.Generator(np.random.PCG64(11))
        stored = self.x[rng.integers(0, n, audits)]
        other = rng.normal(size=stored.shape).astype(np.float32)
        other -= (other * stored).sum(axis=1, keepdims=True) * stored
        other /= np.maximum(np.linalg.norm(other, axis=1, keepdims=True), 1e-12)
        near = least + 0.001
        probes = near * stored + math.sqrt(1 - near * near) * other
        due = probes @ self.x.T >= least
        reach = due.sum(axis=1)
        while width < n and reach.any():
            got = np.zeros(audits, dtype=np.int64)
            for i in range(0, audits, BATCH):
                for row, node in self.within(probes[i : i + BATCH], least, width):
                    got += np.bincount(row[due[row + i, node]] + i, minlength=audits)
            if (got[reach > 0] / reach[reach > 0]).mean() >= recall:
                break
            width *= 2
        return min(width, n)


def _forest(pairs: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """As many of the pairs as connect what all of them connect."""
    parent: dict[int, int] = {}

    def find(a: int) -> int:
        while (up := parent.setdefault(a, a)) != a:
            parent[a] = parent[up]
            a = parent[a]
        return a

    out = []
    for a, b in pairs:
        x, y = find(a), find(b)
        if x != y:
            parent[x] = y
            out.append((a, b))
    return out


def near_vectors(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    *,
    least: float = 0.9,
    shard: int = SHARD,
    recall: float = RECALL,
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row.

    Vectors whose cosine is at least ``least`` in double precision are linked; n_links
    counts the other rows linked directly, component_id is the smallest vec_id
    reachable. Null, empty and zero vectors, and those with null or non-finite
    components, link with nothing; nor do vectors of different lengths. Equal
    vectors are searched once and counted as often as they occur, so repeated rows
    are rows each. Rows whose vec_id is null get the smallest id of their
    component and are never kept. An empty table gives an empty result.
    """
    stage = Stage(vectors.sparkSession, "hnsw")
    x = F.col(vector).cast("array<double>")
    sound = x.isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    sound = F.coalesce(sound & F.exists(x, lambda v: v != 0), F.lit(False))
    rows = stage.write(
        vectors.select(F.col(vec_id).cast("long").alias("id"), F.when(sound, F.transform(x, lambda v: v + 0.0)).alias("x"))
    )
    classes = rows.filter("x is not null").groupBy("x").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("times"))
    classes = stage.write(classes.select(F.monotonically_increasing_id().alias("cls"), "id", "times", "x"))
    by_length = classes.groupBy(F.size("x").alias("d")).count().collect()  # one row for each length of vectors
    found = None
    for length, n in sorted((r[0], r[1]) for r in by_length):
        part = _search(stage, classes.filter(F.size("x") == length), n, shard, least, recall)
        found = part if found is None else found.unionByName(part)
    if found is None:
        out = rows.select("id", F.lit(0).cast("long").alias("n"), F.col("id").alias("component"))
    else:
        found = stage.write(found)
        roots = components(stage, found.filter("b >= 0").select("a", "b"))
        counts = found.filter("b < 0").groupBy("a").agg(F.sum("n").alias("n"))
        known = (
            classes.join(roots, classes["cls"] == roots["id"], "left").join(counts, classes["cls"] == counts["a"], "left")
            .select(classes["x"], classes["id"], "times", F.coalesce("root", "cls").alias("root"), F.coalesce("n", F.lit(0)).alias("n"))
        )
        smallest = known.groupBy("root").agg(F.min("id").alias("component"))
        known = known.join(smallest, "root").select("x", "component", (F.col("n") + F.col("times") - 1).alias("n"))
        out = rows.join(stage.write(known), "x", "left").select(
            "id", F.coalesce("n", F.lit(0)).cast("long").alias("n"),
            F.when(F.col("x").isNotNull(), F.col("component")).otherwise(F.col("id")).alias("component"),
        )
    return out.select(
        F.col("id").alias(vec_id), F.col("n").alias("n_links"), F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"),
    )


def _matrix(part: pa.RecordBatch, column: int) -> np.ndarray:
    """The vectors of a batch, scaled by their largest component, so that squares stay in range."""
    x = part.column(column).flatten().to_numpy().reshape(part.num_rows, -1)
    return x / np.abs(x).max(axis=1, keepdims=True)


def _runs(batch: pa.RecordBatch, keys: int) -> Iterator[pa.RecordBatch]:
    """Parts of a sorted batch with equal values in the first ``keys`` columns."""
    columns = [batch.column(i).to_numpy() for i in range(keys)]
    cut = np.zeros(max(0, batch.num_rows - 1), dtype=bool)
    for c in columns:
        cut |= c[1:] != c[:-1]
    ends = [0, *(np.flatnonzero(cut) + 1).tolist(), batch.num_rows]
    for a, b in zip(ends[:-1], ends[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def _search(stage: Stage, classes: DataFrame, n: int, shard: int, least: float, recall: float) -> DataFrame:
    """(a, b, n): links that connect what is linked (b a class), and how many rows a class links with in a shard (b = -1)."""
    shards = -(-n // shard)
    # Every slice takes a copy of every graph, so there are no more slices than keep the tasks busy.
    slices = min(-(-n // SLICE), -(-4 * shuffle_partitions(classes.sparkSession) // shards))
    own: Column = F.pmod(F.xxhash64("cls"), F.lit(shards))

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []

        def stored() -> Iterator[pa.RecordBatch]:
            cls, times = (np.concatenate([p.column(c).to_numpy() for p in held]) for c in (1, 2))
            order = np.argsort(cls)  # the same graph, whatever order the rows came in
            whole = np.concatenate([_matrix(p, 3) for p in held])[order]
            norms = np.sqrt((whole**2).sum(axis=1))
            graph = Graph(whole / norms[:, None])
            state = {
                "cls": cls[order], "times": times[order], "whole": whole, "norms": norms,
                "width": graph.audited_width(least, recall), "graph": graph.parts(),
            }
            data = pickle.dumps(state)
            for i in range(0, len(data), PIECE):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([current]), pa.array([i // PIECE]), pa.array([data[i : i + PIECE]], type=pa.binary())],
                    names=["shard", "piece", "data"],
                )

        for batch in batches:
            for part in _runs(batch, 1):
                key = part.column(0)[0].as_py()
                if key != current and held:
                    yield from stored()
                    held = []
                current = key
                held.append(part)
        if held:
            yield from stored()

    rows = classes.select(own.alias("shard"), "cls", "times", "x").repartition("shard").sortWithinPartitions("shard")
    graphs = stage.write(rows.mapInArrow(built, "shard long, piece long, data binary"))
    # Every slice meets every graph: the pieces of a graph come first, then the slice's vectors.
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long")))
    stored_ = graphs.select("shard", every.alias("slice"), "piece", "data", F.lit(None).cast("long").alias("cls"), F.lit(None).cast("array<double>").alias("x"))
    asked = classes.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
        F.pmod(F.xxhash64("cls", F.lit(1)), F.lit(slices)).alias("slice"),
        F.lit(1 << 40).alias("piece"), F.lit(None).cast("binary").alias("data"), "cls", "x",
    )

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, pieces, graph, state = None, [], None, {}
        for batch in batches:
            for part in _runs(batch, 3):
                key = (part.column(0)[0].as_py(), part.column(1)[0].as_py())
                if key != current:
                    current, pieces, graph = key, [], None
                if part.column(2)[0].as_py() < 1 << 40:
                    pieces += part.column(3).to_pylist()
                    continue
                if graph is None:
                    if not pieces:
                        continue  # a shard without vectors
                    state = pickle.loads(b"".join(pieces))
                    graph, pieces = Graph.of(state["whole"] / state["norms"][:, None], state["graph"]), []
                for i in range(0, part.num_rows, BATCH):
                    some = part.slice(i, BATCH)
                    yield _linked(graph, state, some.column(4).to_numpy(), _matrix(some, 5), least)

    placed = stored_.unionByName(asked).repartition("shard", "slice").sortWithinPartitions("shard", "slice", "piece")
    return placed.mapInArrow(searched, "a long, b long, n long")


def _linked(graph: Graph, state: dict, q_cls: np.ndarray, q: np.ndarray, least: float) -> pa.RecordBatch:
    """What a batch of vectors links with in one graph, confirmed in double precision."""
    cls, times, whole, norms = state["cls"], state["times"], state["whole"], state["norms"]
    q_norm = np.sqrt((q**2).sum(axis=1))
    at = np.minimum(np.searchsorted(cls, q_cls), len(cls) - 1)
    itself = np.where(cls[at] == q_cls, at, -1)
    linked = np.zeros(len(q), dtype=np.int64)
    first = np.full(len(cls), -1, dtype=np.int32)  # the query that linked with a node first stands for the node
    none = np.empty(0, dtype=np.int64)
    links, same = [(none, none)], set()  # a batch may lie near nothing in a graph of other vectors
    for row, node in graph.within(q / q_norm[:, None], least, state["width"], itself):
        other = node != itself[row]
        row, node = row[other], node[other]
        cosine = np.einsum("ij,ij->i", q[row], whole[node]) / (q_norm[row] * norms[node])
        row, node = row[cosine >= least], node[cosine >= least]
        np.add.at(linked, row, times[node])
        new = first[node] < 0
        first[node[new]] = row[new]
        chosen = first[node] == row
        links.append((row[chosen & new], node[chosen & new]))
        shared = np.unique(first[node].astype(np.int64) * len(q) + row)
        same.update(shared[shared // len(q) != shared % len(q)].tolist())
    row, node = (np.concatenate([x[k] for x in links]) for k in (0, 1))
    some = np.flatnonzero(linked)
    known = q_cls.tolist()
    joined = ((known[x // len(q)], known[x % len(q)]) for x in same)
    forest = _forest(chain(zip(q_cls[row].tolist(), cls[node].tolist()), joined))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([*q_cls[some].tolist(), *(p[0] for p in forest)], type=pa.int64()),
            pa.array([-1] * len(some) + [p[1] for p in forest], type=pa.int64()),
            pa.array([*linked[some].tolist(), *(0 for _ in forest)], type=pa.int64()),
        ],
        names=["a", "b", "n"],
    )


def op6_hnsw_near_dup(spark, sf_dir):
    """All embeddings, linked at a cosine of 0.9."""
    return near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
