"""Near duplicates of texts and vectors and exact top-k, against comparing everything."""

import math
import random
import tracemalloc
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from trendloom.llm import hnsw, impact, minhash
from trendloom.llm._components import components
from trendloom.plans.staging import Stage


def roots_of(nodes, links):
    parent = {n: n for n in nodes}

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_cycles(spark):
    random.seed(8)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    random.shuffle(edges)
    got = {r.id: r.root for r in components(Stage(spark, "t"), spark.createDataFrame(edges, "a long, b long")).collect()}
    want = roots_of({x for e in edges for x in e}, edges)
    assert got == want
    assert components(Stage(spark, "t"), spark.createDataFrame([], "a long, b long")).count() == 0


def shingle_set(text, width):
    words = (text or "").encode().lower().split()
    size = min(width, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def plain_groups(rows, width):
    sets = [shingle_set(t, width) for _, t in rows]
    links = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    return sets, roots_of(range(len(rows)), links)


@pytest.fixture(scope="module")
def copies():
    random.seed(9)
    words = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for group in range(25):
        base = random.choices(words, k=random.randint(3, 120))
        for _ in range(random.choice([1, 2, 3, 14])):
            text = list(base)
            for _ in range(random.randint(0, max(1, len(text) // 25))):
                text[random.randrange(len(text))] = random.choice(words)
            rows.append((n, " ".join(text)))
            n += 1
    return rows + [(900, ""), (901, None), (902, " \t\n"), (903, "One"), (904, "one"), (905, "one two"), (906, "word " * 40_000)]


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_equal_comparing_all(spark, copies, width):
    docs = spark.createDataFrame([(*r, "x", 1) for r in copies], "doc_id long, text string, key string, n int")
    out = {r.doc_id: r for r in minhash.near_duplicates(docs, width=width).collect()}
    sets, roots = plain_groups(copies, width)
    for i, (doc, _) in enumerate(copies):
        smallest = min(copies[j][0] for j in range(len(copies)) if roots[j] == roots[i])
        assert (out[doc].n_shingles, out[doc].component_id, out[doc].kept) == (len(sets[i]), smallest, doc == smallest)


def test_near_duplicates_without_ids_and_rows(spark):
    rows = [(None, "a b c d e f g h"), (5, "a b c d e f g h"), (5, "a b c d e f g h"), (None, None), (None, "q r s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted(((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()), key=str)
    assert out == sorted([(None, 5, False), (5, 5, True), (5, 5, True), (None, None, False), (None, None, False)], key=str)
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_sketches_tell_similarity():
    rng = np.random.default_rng(3)
    for _ in range(60):
        both = rng.integers(0, 1 << 63, 800).astype(np.uint64)
        a, b = both[:720], both[80:]  # 640 of 800
        far = rng.integers(0, 1 << 63, 720).astype(np.uint64)
        sa, sb, sf = (minhash.odd_sketch(minhash.min_hashes(np.unique(x))) for x in (a, b, far))
        bits = lambda x, y: sum(int(v).bit_count() for v in (x ^ y).view(np.uint64))
        assert bits(sa, sb) <= minhash.most_differing() < bits(sa, sf)


def test_bands_lose_no_pair_at_the_threshold():
    miss = (1 - 0.8**minhash.ROWS) ** minhash.BANDS
    assert miss < 5e-5


VECTORS = [
    (1, [1.0, 0.0, 0.0]), (2, [0.95, 0.05, 0.0]), (3, [-1.0, 0.0, 0.0]), (4, None), (5, [0.0, 0.0, 0.0]),
    (6, [1.0, None, 0.0]), (7, [float("nan"), 1.0, 0.0]), (8, [float("inf"), 1.0, 0.0]), (9, []), (10, [2.0, 0.0, 0.0]),
    (11, [1.0, 0.0]), (12, [0.5, 0.0, 0.0]), (None, [1.0, 0.01, 0.0]), (2, [0.95, 0.05, 0.0]),
]


def test_vectors_awkward_rows(spark):
    rows = spark.createDataFrame([(*v, 1) for v in VECTORS], "vec_id long, embedding array<double>, x int")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in hnsw.near_vectors(rows).collect()), key=str)
    linked = [(1, 5, 1, True), (2, 5, 1, False), (2, 5, 1, False), (10, 5, 1, False), (12, 5, 1, False), (None, 5, 1, False)]
    lone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 11)]
    assert got == sorted(linked + lone, key=str)
    assert hnsw.near_vectors(rows.limit(0)).count() == 0


def clustered(n, groups, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 32))
    for g in range(groups):
        members = rng.choice(n, rng.integers(2, 60), replace=False)
        x[members] = x[members[0]] + rng.normal(size=(len(members), 32)) * rng.choice([0.05, 0.2, 0.3])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_graph_recall_and_no_false_link(spark):
    x = clustered(1500, 12, 5)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    out = {r.vec_id: r for r in hnsw.near_vectors(rows, shard=500).collect()}
    similar = x @ x.T >= 0.9
    np.fill_diagonal(similar, False)
    got, due = sum(r.n_links for r in out.values()), int(similar.sum())
    assert due > 1000 and 0.98 * due <= got <= due
    assert all(out[i].n_links <= similar[i].sum() for i in out)
    roots = roots_of(range(len(x)), np.argwhere(similar).tolist())
    assert sum(out[i].component_id != roots[i] for i in out) <= 0.01 * len(x)


def test_slices_that_lie_near_nothing_in_a_graph(spark, monkeypatch):
    """Few vectors meet a graph that holds none of them, and nothing near them."""
    monkeypatch.setattr(hnsw, "SLICE", 2)
    x = np.eye(30)
    x[29] = x[3] + 0.1 * x[4]
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    out = {r.vec_id: (r.n_links, r.component_id) for r in hnsw.near_vectors(rows, shard=2).collect()}
    assert out == {i: (1, 3) if i in (3, 29) else (0, i) for i in range(30)}


def test_large_group_of_near_copies_is_gathered_in_chunks():
    """All vectors alike but none equal: 256 x 4,000 pairs, which took 64 doubles each, twice."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=64) + 0.1 * rng.normal(size=(4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = hnsw.Graph(x)
    state = {"cls": np.arange(4000), "times": np.ones(4000, dtype=np.int64), "whole": x, "norms": np.ones(4000), "width": 32}
    asked = np.arange(0, 4000, 16)
    tracemalloc.start()
    out = hnsw._linked(graph, state, asked, x[asked], 0.9)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6, peak
    counts = {a: n for a, b, n in zip(*(c.to_pylist() for c in out.columns)) if b < 0}
    due = (x[asked] @ x.T >= 0.9).sum(axis=1) - 1
    assert due.min() > 3000 and [counts[a] for a in asked.tolist()] == due.tolist()
    pairs = [(a, b) for a, b in zip(*(c.to_pylist() for c in out.columns[:2])) if b >= 0]
    assert len(pairs) == 3999 and len(set(roots_of(range(4000), pairs).values())) == 1


def test_impact_index_is_exact(spark):
    x = np.round(clustered(700, 5, 6), 2)
    x[50:80] = x[40]  # ties
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(800, None), (820, [0.1, None]), (840, [float("nan")]), (860, []), (880, [0.5])]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, rank int")
    out = impact.top_inner_products(table, F.col("id") % 20 == 0, k=20, block=150).collect()
    whole = {i: np.floor(64 * np.array(v, dtype=float)).astype(np.int64) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)}
    got = defaultdict(list)
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append((r.score, r.vec_id))
    queries = [i for i in whole if i % 20 == 0]
    assert sorted(got) == sorted(queries)
    for q in queries:
        dims = lambda i: min(len(whole[q]), len(whole[i]))
        scores = sorted((-int(whole[q][: dims(i)] @ whole[i][: dims(i)]), i) for i in whole if i != q)[:20]
        assert got[q] == [(-s, i) for s, i in scores]
    few = impact.top_inner_products(table.filter("vec_id < 3"), F.col("id") == 0, k=20)
    assert [(r.query_id, r.rank) for r in few.collect()] == [(0, 1), (0, 2)]
    assert impact.top_inner_products(table.limit(0), F.col("id") == 0).count() == 0


def test_impact_index_takes_null_ids_repeats_and_large_components(spark):
    rows = [
        (0, [1.0, 2.0, 0.5]), (None, [1.0, 2.0, 0.5]), (0, [1.0, 2.0, 0.5]), (7, [1.0, 2.0, 0.5]), (5, [4e7, -3e7, 1.0]),
        (20, [9e6, 0.0, -1.25]), (40, [0.0, 0.0, 1e15]), (8, [-0.01, 0.3, 0.0]), (9, []), (60, [0.0, 1e305]),
    ]
    table = spark.createDataFrame([(*r, 3) for r in rows], "vec_id long, embedding array<double>, score int")
    out = impact.top_inner_products(table.filter("vec_id is null or vec_id < 60"), F.col("id") % 20 == 0, k=4, block=3).collect()
    due = []
    for i, (q, x) in enumerate(rows[:-1]):
        if q is not None and q % 20 == 0:
            one = [math.floor(64 * c) for c in x]
            found = [
                (-sum(a * math.floor(64 * b) for a, b in zip(one, y)), v is None, v or 0) for j, (v, y) in enumerate(rows[:-1]) if j != i
            ]
            due += [(q, r + 1, None if f[1] else f[2], -f[0]) for r, f in enumerate(sorted(found)[:4])]
    assert sorted(map(repr, due)) == sorted(repr((r.query_id, r["rank"], r.vec_id, r.score)) for r in out)
    with pytest.raises(Exception, match="OverflowError|too large|too big"):
        impact.top_inner_products(table, F.col("id") == 60, k=20).collect()
    far = impact.top_inner_products(table.filter("vec_id in (8, 9, 60)"), F.col("id") == 9, k=2).collect()
    assert [(r.vec_id, r.score) for r in sorted(far, key=lambda r: r["rank"])] == [(8, 0), (60, 0)]


def test_pairs_just_below_the_threshold_fall_by_their_rarest_shingles(spark, monkeypatch):
    base = [f"w{i}" for i in range(400)]
    near = [" ".join([*base[: 60 + 9 * k], f"x{k}", *base[61 + 9 * k :]]) for k in range(20)]  # linked with each other
    below = [" ".join([*(f"own{k}_{i}" for i in range(48)), *base[48:]]) for k in range(20)]  # 0.78 to all of them
    docs = spark.createDataFrame(list(enumerate(near + below)), "doc_id long, text string").repartition(2)
    sent = []

    def confirmed(self, pairs, texts, confirm=minhash._Job.confirmed):
        sent.append(pairs.count())
        return confirm(self, pairs, texts)

    monkeypatch.setattr(minhash._Job, "confirmed", confirmed)
    rows = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, width=2).collect()}
    assert rows == {i: 0 if i < 20 else i for i in range(40)}
    assert sent[1] < 60  # of 590 pairs at 0.78


def test_similar_sets_share_one_of_their_rarest_shingles():
    draw = np.random.default_rng(3)
    common = np.unique(draw.integers(0, 1 << 62, 50, dtype=np.uint64))
    often = draw.integers(1, 9, len(common))
    tight = 0
    for _ in range(2000):
        shared = draw.integers(0, 1 << 62, draw.integers(1, 60), dtype=np.uint64)
        own = [draw.integers(0, 1 << 62, draw.integers(0, 9), dtype=np.uint64) for _ in "ab"]
        a, b = (np.unique(np.concatenate([shared, x, draw.choice(common, draw.integers(0, 12))])) for x in own)
        c = len(np.intersect1d(a, b))
        asked = -(-80 * (len(a) + len(b)) // 180)
        x, y = (set(minhash.rarest(v, common, often, (80, 100))[: len(v) - asked + 1].tolist()) for v in (a, b))
        if 100 * c >= 80 * (len(a) + len(b) - c):
            assert x & y
            tight += c == asked
    assert tight > 20
