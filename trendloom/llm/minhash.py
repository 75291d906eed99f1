"""MinHash near-duplicates verified through odd sketches.

Documents with the same shingle set make one class. Each class gets 216 MinHash
values, cut into 36 bands of 6, and folded into a 512-bit odd sketch: the parity
of how often each bit is hit. The population count of two sketches' XOR estimates
how many MinHash values differ, precisely at high similarities, so that nearly all
candidates of the bands that are not similar fall without looking at their texts.
What remains is confirmed on full shingle sets. Members of buckets that stay open get
a finer sketch (2,048 values, 8,192 bits), for texts that share long passages, and their
rarest shingles: two sets that are similar share one among the rarest few of each, in any
one order of all shingles, so that pairs just below the threshold mostly fall without
looking at their texts, and no similar pair does.

A bucket of a band is never expanded into all its pairs. Its members are first
compared with one of them, a different one in each band; what that connects is
settled. Then members outside the largest component of their bucket are compared
with all others of that bucket that they aren't connected with, which is just what
is still open. A pair of similarity 0.8 shares a band with probability 0.99998 and
is kept by its sketch with more than that.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.plans.sizing import fits_broadcast
from trendloom.plans.staging import Stage

from ._blocks import releasing
from ._common import most_frequent, table, text_of
from ._components import components

BANDS, ROWS = 36, 6
HASHES = BANDS * ROWS
BITS = 512
LANES = BITS // 64
# Sketches of texts with an estimated similarity below this one are no candidates:
# four standard deviations below 0.8.
SKETCH_LEAST = 0.65
# Sketches that tell apart what shares long passages: made only for members of open
# buckets; 0.745 is more than four standard deviations below 0.8.
FINE_HASHES, FINE_BITS, FINE_LEAST = 2048, 8192, 0.745
# Rarest shingles that a member of an open bucket carries, and shingles that are told apart by how often they occur, at
# most. A pair that would need more of the rarest is confirmed on its full sets.
RAREST, COMMON = 256, 32_768
MEMBERS = 256  # members of a star that one part of its comparison holds on average
CACHE = 100_000  # words whose hash a task remembers

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)

def _family(hashes: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Multipliers and offsets of MinHash functions, and multipliers that deal their values to bits."""
    draw = np.random.Generator(np.random.PCG64(seed))
    multiply = draw.integers(0, 1 << 31, hashes, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    add = draw.integers(0, 1 << 32, hashes, dtype=np.uint32)
    places = draw.integers(1, 1 << 63, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return multiply[:, None], add[:, None], places


COARSE, FINE = _family(HASHES, 20240607), _family(FINE_HASHES, 20240608)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE:
            self.clear()
        got = self[word] = xxhash.xxh3_64_intdigest(word)
        return got


def shingles(text: bytes, width: int, hashes: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles of ``width`` words.

    A-Z count as a-z; with fewer words the whole sequence is one shingle, without
    words there is none.
    """
    words = text.lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    each = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=n)
    size = min(width, n)
    out = np.full(n - size + 1, np.uint64(size))
    for k in range(size):
        out = _mix(out * _STEP + each[k : n - size + 1 + k])
    return np.unique(out)


def min_hashes(items: np.ndarray, family=COARSE) -> np.ndarray:
    """The minima of a set of hashes, in blocks, so that long texts need no more memory."""
    small = (items >> np.uint64(32)).astype(np.uint32)
    multiply, add, _ = family
    out = np.full(len(multiply), np.uint32(0xFFFFFFFF))
    for i in range(0, len(small), 512):
        np.minimum(out, (small[None, i : i + 512] * multiply + add).min(axis=1), out=out)
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band; the band's number is part of it."""
    rows = values.reshape(BANDS, ROWS).astype(np.uint64)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        keys = _mix(keys * _STEP + rows[:, k])
    return keys.view(np.int64)


def odd_sketch(values: np.ndarray, family=COARSE, size: int = BITS) -> np.ndarray:
    """Parity of the hits of (place, value) on ``size`` bits, a power of two, as 64-bit lanes."""
    bits = _mix(values.astype(np.uint64) + family[2]) % np.uint64(size)
    odd = (np.bincount(bits.astype(np.int64), minlength=size) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def most_differing(least: float = SKETCH_LEAST, hashes: int = HASHES, size: int = BITS) -> int:
    """XOR bits that two sets of similarity ``least`` are expected to show."""
    return int(size / 2 * (1 - (1 - 2 / size) ** (2 * hashes * (1 - least))))


def _signatures(width: int):
    names = ["id", "n", "key", "bands", *(f"s{i}" for i in range(LANES))]

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                sizes, keys, bands, lanes = [], [], [], []
                for x in batch.column(1).cast(pa.large_binary()):
                    items = shingles(x.as_py(), width, hashes)
                    sizes.append(len(items))
                    keys.append(xxhash.xxh3_128_digest(items.tobytes()) if len(items) else None)
                    values = min_hashes(items)
                    bands.append(band_keys(values))
                    lanes.append(odd_sketch(values))
                lanes = np.array(lanes).reshape(-1, LANES)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), pa.array(sizes, type=pa.int64()), pa.array(keys, type=pa.binary()),
                        pa.array(bands, type=pa.list_(pa.int64())), *(pa.array(lanes[:, i].copy()) for i in range(LANES)),
                    ],
                    names=names,
                )

    return signed


def _similar_stars(width: int, numerator: int, denominator: int):
    """Streams over (star, part, member, text), the star's own text (member 0) first; gives confirmed (a, b)."""

    def confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        current, centre = None, None
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                left, right = [], []
                stars, parts, members, cls = (batch.column(i).to_pylist() for i in range(4))
                for star, part, member, c, x in zip(stars, parts, members, cls, batch.column(4).cast(pa.large_binary())):
                    items = shingles(x.as_py(), width, hashes)
                    if not member:
                        current, centre = (star, part), items
                        continue
                    assert current == (star, part), "a star's own text is missing"
                    common = len(np.intersect1d(centre, items, assume_unique=True))
                    if denominator * common >= numerator * (len(centre) + len(items) - common):
                        left.append(star)
                        right.append(c)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(left, type=pa.int64()), pa.array(right, type=pa.int64())], names=["a", "b"]
                )

    return confirmed


def _keyed_texts(width: int):
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            keys = []
            for x in batch.column(0).cast(pa.large_binary()):
                items = shingles(x.as_py(), width, hashes)
                keys.append(xxhash.xxh3_128_digest(items.tobytes()) if len(items) else None)
            yield pa.RecordBatch.from_arrays([pa.array(keys, type=pa.binary()), batch.column(0)], names=["key", "x"])

    return keyed


def _repeated_shingles(width: int):
    """(shingle, n) of the shingles that texts of a portion share; what occurs once in a portion is rare enough to leave out."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                sets = [shingles(x.as_py(), width, hashes) for x in batch.column(1).cast(pa.large_binary())]
                values, n = np.unique(np.concatenate(sets), return_counts=True)
                again = n > 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values[again].view(np.int64)), pa.array(n[again].astype(np.int64))], names=["shingle", "n"]
                )

    return counted


def rarest(items: np.ndarray, common: np.ndarray, often: np.ndarray, least: tuple[int, int]) -> np.ndarray:
    """The first shingles of a set in the order of all (rare ones first): as many as any partner of similarity ``least`` asks for."""
    n = len(items)
    count = np.zeros(n, dtype=np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, items), len(common) - 1)
        count = np.where(common[at] == items, often[at], 0)
    asked = n - -(-least[0] * n // least[1]) + 1
    return items[np.lexsort((items, count))][: min(asked, RAREST)]


def _fine_sketches(width: int, common: np.ndarray, often: np.ndarray, least: tuple[int, int]):
    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                fine, rare = [], []
                for x in batch.column(1).cast(pa.large_binary()):
                    items = shingles(x.as_py(), width, hashes)
                    fine.append(odd_sketch(min_hashes(items, FINE), FINE, FINE_BITS))
                    rare.append(rarest(items, common, often, least).view(np.int64))
                arrays = [pa.array(v, type=pa.list_(pa.int64())) for v in (fine, rare)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["cls", "fine", "rare"])

    return sketched


class _Job:
    """The steps of one run, on the classes of equal sets."""

    def __init__(self, docs: DataFrame, doc_id: str, text: str, width: int, least: tuple[int, int]):
        self.width, self.least = width, least
        self.stage = Stage(docs.sparkSession, "minhash")
        self.texts = docs.select(F.col(doc_id).alias("id"), text_of(F.col(text)).alias("x"))
        kind = docs.schema[doc_id].dataType.simpleString()
        lanes = ", ".join(f"s{i} long" for i in range(LANES))
        self.signed = self.stage.write(
            self.texts.mapInArrow(releasing(_signatures(width)), f"id {kind}, n long, key binary, bands array<long>, {lanes}")
        )
        one = ["n", "bands", *(f"s{i}" for i in range(LANES))]
        grouped = self.signed.filter("n > 0").groupBy("key").agg(
            F.min("id").alias("id"), *[F.any_value(c).alias(c) for c in one]
        )
        self.classes = self.stage.write(grouped.withColumn("cls", F.monotonically_increasing_id()))

    def buckets(self) -> DataFrame:
        """(bucket, band, cls, centre) of the buckets with several classes; the centre is drawn anew in each band."""
        rows = self.classes.select("cls", F.posexplode("bands").alias("band", "bucket"))
        drawn = F.min(F.struct(F.xxhash64("cls", "band").alias("h"), "cls"))
        several = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"), drawn.alias("c")).filter("members > 1")
        joined = rows.join(several.select("bucket", F.col("c.cls").alias("centre")), "bucket")
        return self.stage.write(joined.select("bucket", "band", "cls", "centre"))

    def sketched(self, pairs: DataFrame) -> DataFrame:
        """The distinct pairs (a, b) whose sizes allow the similarity and whose sketches are near enough."""
        side = self.classes.select("cls", "n", *(f"s{i}" for i in range(LANES)))
        a = side.select(*[F.col(c).alias(f"a_{c}") for c in side.columns])
        b = side.select(*[F.col(c).alias(f"b_{c}") for c in side.columns])
        both = pairs.distinct().join(a, F.col("a") == F.col("a_cls")).join(b, F.col("b") == F.col("b_cls"))
        return both.filter(self.near("a_", "b_")).select("a", "b")

    def near(self, a: str, b: str) -> Column:
        """Whether the sizes of two classes allow the similarity and their sketches are near enough."""
        differing = [F.bit_count(F.col(f"{a}s{i}").bitwiseXOR(F.col(f"{b}s{i}"))) for i in range(LANES)]
        bits = functools.reduce(operator.add, differing)
        small, large = F.least(f"{a}n", f"{b}n"), F.greatest(f"{a}n", f"{b}n")
        return (F.lit(self.least[1]) * small >= F.lit(self.least[0]) * large) & (bits <= most_differing())

    def texts_of(self, needed: DataFrame) -> DataFrame:
        """(cls, x): one text of each class in ``needed`` (cls)."""
        wanted = self.stage.write(needed.distinct().join(self.classes.select("cls", "id", "key"), "cls"))
        ids = wanted.select("id").distinct()
        here = F.broadcast(ids) if fits_broadcast(ids) else ids
        # A class without any id is found among the rows without one.
        found = self.texts.join(here, self.texts["id"].eqNullSafe(here["id"]), "left_semi").select("x")
        keyed = found.mapInArrow(releasing(_keyed_texts(self.width)), "key binary, x string")
        matched = keyed.join(wanted.select("key", "cls"), "key").groupBy("cls").agg(F.any_value("x").alias("x"))
        return self.stage.write(matched)

    def fine(self, texts: DataFrame) -> DataFrame:
        """(cls, fine, rare): finer sketches and rarest shingles of texts (cls, x)."""
        counts = texts.mapInArrow(releasing(_repeated_shingles(self.width)), "shingle long, n long")
        counts = self.stage.write(counts.groupBy("shingle").agg(F.sum("n").alias("n")))
        rows = most_frequent(counts, "n", COMMON).toArrow()
        common, often = rows.column(0).to_numpy().view(np.uint64), rows.column(1).to_numpy()
        order = np.argsort(common)
        sketched = _fine_sketches(self.width, common[order], often[order], self.least)
        return self.stage.write(texts.mapInArrow(releasing(sketched), "cls long, fine array<long>, rare array<long>"))

    def may_share(self, a: str, b: str) -> Column:
        """Whether two sets may share as many shingles as the similarity asks for, by the rarest of each; False is certain."""
        part, whole = self.least[0], sum(self.least)
        asked = F.expr(f"({part} * ({a}n + {b}n) + {whole - 1}) div {whole}")
        first = {x: F.greatest(F.col(f"{x}n") - asked + 1, F.lit(0)).cast("int") for x in (a, b)}
        beyond = functools.reduce(operator.or_, (first[x] > F.size(f"{x}rare") for x in (a, b)))
        return beyond | F.arrays_overlap(*[F.slice(f"{x}rare", F.lit(1), first[x]) for x in (a, b)])

    def confirmed(self, pairs: DataFrame, texts: DataFrame) -> DataFrame:
        """The pairs whose full sets are similar. A star's text goes once to each part of its members."""
        degree = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).alias("parts"))
        placed = pairs.join(degree, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"))
        placed = self.stage.write(placed)
        members = placed.select(F.col("a").alias("star"), "part", F.lit(1).alias("member"), F.col("b").alias("cls"))
        stars = placed.select(F.col("a").alias("star"), "part", F.lit(0).alias("member"), F.col("a").alias("cls")).distinct()
        rows = members.unionByName(stars).join(texts, "cls").select("star", "part", "member", "cls", "x")
        rows = rows.repartition("star", "part").sortWithinPartitions("star", "part", "member")
        return self.stage.write(rows.mapInArrow(releasing(_similar_stars(self.width, *self.least)), "a long, b long"))


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows`` with the root of their ``cls``, which is itself where it has no link."""
    found = rows.join(roots.select(F.col("id").alias("cls"), "root"), "cls", "left")
    return found.withColumn("root", F.coalesce("root", "cls"))


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    *,
    width: int = 5,
    least: tuple[int, int] = (80, 100),
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row.

    Documents are linked where the Jaccard similarity of their sets of ``width``-word
    shingles is at least ``least[0] / least[1]``; component_id is the smallest
    doc_id reachable by links, itself included. Null and wordless texts have the
    empty set and are linked with nothing. Rows whose doc_id is null take part and
    get the smallest id of their component (null where there is none); they are
    never kept. Repeated rows are rows each. Other columns are not read.
    """
    job = _Job(docs, doc_id, text, width, least)
    stage = job.stage
    buckets = job.buckets()
    stars = buckets.filter("cls <> centre").select(F.col("centre").alias("a"), F.col("cls").alias("b"))
    near = stage.write(job.sketched(stars))
    texts = job.texts_of(near.select(F.col("a").alias("cls")).unionByName(near.select(F.col("b").alias("cls"))))
    links = job.confirmed(near, texts)
    roots = stage.write(components(stage, links))

    # What is open now: members outside the largest component of their bucket, with all they aren't connected to.
    # Sizes and sketches are compared in the join itself, so that only near pairs come out of it.
    placed = stage.write(_rooted(buckets.select("bucket", "band", "cls"), roots))
    sizes = placed.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("m"))
    largest = sizes.groupBy("bucket").agg(
        F.max(F.struct("m", "root")).alias("top"), F.count(F.lit(1)).alias("groups")
    ).filter("groups > 1").select("bucket", F.col("top.root").alias("top"))
    open_buckets = stage.write(placed.join(largest, "bucket"))
    open_texts = job.texts_of(open_buckets.select("cls"))
    fine = job.fine(open_texts)
    sketches = job.classes.select("cls", "n", "bands", *(f"s{i}" for i in range(LANES))).join(fine, "cls")
    mixed = open_buckets.join(sketches, "cls")
    minor = mixed.filter("root <> top").select(*[F.col(c).alias(f"a_{c}") for c in mixed.columns])
    other = mixed.select(*[F.col(c).alias(f"b_{c}") for c in mixed.columns])
    open_ = F.expr("a_bucket = b_bucket and a_root <> b_root and (b_root = b_top or a_cls < b_cls)")
    differing = F.aggregate(
        F.zip_with("a_fine", "b_fine", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x
    )
    # A pair that shares several buckets comes out of the first of them only.
    first = F.expr("array_position(zip_with(a_bands, b_bands, (x, y) -> x = y), true) = a_band + 1")
    near_enough = job.near("a_", "b_") & first & (differing <= most_differing(FINE_LEAST, FINE_HASHES, FINE_BITS))
    near_enough = near_enough & job.may_share("a_", "b_")
    pairs = minor.join(other, open_ & near_enough).select(F.col("a_cls").alias("a"), F.col("b_cls").alias("b"))
    tested = near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rest = stage.write(pairs.join(tested, ["a", "b"], "left_anti"))
    more = job.confirmed(rest, open_texts)
    # Links between components connect their roots.
    upper = stage.write(components(stage, _rooted(more.select(F.col("a").alias("cls"), "b"), roots).select(
        F.col("root").alias("a"), F.col("b").alias("cls")
    ).transform(lambda t: _rooted(t, roots)).select("a", F.col("root").alias("b"))))
    whole = stage.write(_rooted(_rooted(job.classes.select("key", "id", "cls"), roots).select(
        "key", "id", F.col("root").alias("cls")
    ), upper))
    smallest = whole.groupBy("root").agg(F.min("id").alias("component"))
    by_key = stage.write(whole.join(smallest, "root").select("key", "component"))
    out = job.signed.select("id", "n", "key").join(by_key, "key", "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(doc_id),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )


def op7_minhash_odd_sketch(spark, sf_dir):
    """All documents, linked at a similarity of 0.8 of their two-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), width=2)
