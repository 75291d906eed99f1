"""Collocations from FM-indexes of shards.

A shard is a block of texts. Its words get ids, pieces end in a separator, and the
id sequence is indexed twice: suffixes sorted by their first ``depth`` symbols and
prefixes sorted by their last ones, each with the symbol on its other side (the
Burrows-Wheeler transform, limited to the depth that is asked for). A phrase is a
pair of intervals, one in each index. Extending all phrases of a length to the right
or to the left reads the transform inside their intervals, moves the one interval
by counting and shrinks the other by the counts of smaller symbols, so that both stay
in step. The interval's size is the phrase's count in the shard.

Shards sum up in two steps: hashes of all phrases with their counts go to parts of
the hash range, which answer each shard with those that may be frequent (hashes may
coincide, which only makes more of them); of these the
shards give words and exact counts, which are summed by phrase.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendloom.plans.staging import Stage

from ._blocks import (
    SENT, among, answered, answers, byte_class, distinct, in_blocks, keyed, mixed, parts_for, release, sent, stretches, text_bytes,
    unpacked, whole_blocks, word_hashes, words_of,
)
from ._common import table, text_of

MAX_WORDS = 3
LEAST = 10
TOP = 2_000
SHARE = 50  # percent of a phrase's occurrences that a longer candidate may cover before it replaces the phrase
# What ends a piece, what ends a word, the language of rows without one.
ENDS = b".,;:!?\n\x0b\x0c\r"
GAPS = b" \t"
NO_LANG = "und"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all stretches that begin at ``starts``, one stretch behind the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


class BiIndex:
    """Depth-limited bidirectional index of a sequence of ids from 1 up; 0 separates."""

    def __init__(self, ids: np.ndarray, depth: int):
        self.ids, self.top = ids, int(ids.max()) + 1 if len(ids) else 1
        self.suffixes = self._sorted([np.append(ids[j:], np.zeros(min(j, len(ids)), ids.dtype)) for j in range(depth)])
        prefixes = self._sorted([np.append(np.zeros(min(j, len(ids)), ids.dtype), ids[: len(ids) - j]) for j in range(depth)])
        self.left, self.left_step = self._transform(np.append(0, ids)[self.suffixes])
        self.right, self.right_step = self._transform(np.append(ids[1:], 0)[prefixes])
        self.starts = np.searchsorted(ids[self.suffixes], np.arange(self.top + 1))

    def _sorted(self, keys: list[np.ndarray]) -> np.ndarray:
        bits = self.top.bit_length()
        packed = [keys[0].astype(np.int64)]
        for j, key in enumerate(keys[1:], 2):
            if bits * j <= 63:
                packed[0] = (packed[0] << bits) | key
            else:
                packed.append(key)
        return np.argsort(packed[0], kind="stable") if len(packed) == 1 else np.lexsort(packed[::-1])

    @staticmethod
    def _transform(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The transform and, for each of its places, the place that stepping over its symbol leads to."""
        step = np.empty(len(symbols), dtype=np.int64)
        step[np.argsort(symbols, kind="stable")] = np.arange(len(symbols))
        return symbols, step

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Intervals of all ids: start among suffixes, start among prefixes, size."""
        size = np.diff(self.starts)[1:]
        return self.starts[1:-1][size > 0], self.starts[1:-1][size > 0], size[size > 0]

    def extend(self, mine: np.ndarray, other: np.ndarray, size: np.ndarray, side: str):
        """All phrases one symbol longer on a side: (parent, own start, other start, size).

        ``mine`` are the starts in the index that is read for this side: suffixes to the left, prefixes to the right.
        """
        symbols, step = (self.left, self.left_step) if side == "left" else (self.right, self.right_step)
        before = np.cumsum(size) - size
        parent = np.repeat(np.arange(len(size)), size)
        at = np.arange(len(parent)) + np.repeat(mine - before, size)
        seen = symbols[at].astype(np.int64)
        order = np.argsort(parent * self.top + seen, kind="stable")
        p, s = parent[order], seen[order]
        new = np.ones(len(p), dtype=bool)
        new[1:] = (p[1:] != p[:-1]) | (s[1:] != s[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(p)))
        real = s[first] != 0
        first, count = first[real], count[real]
        up = p[first]
        # Sorted by symbol, a group starts where the smaller symbols of its interval end.
        return up, step[at[order[first]]], other[up] + first - before[up], count

    def phrases(self, depth: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, place of one occurrence in the sequence, count) of all phrases, level by level, on alternating sides."""
        suffix, prefix, size = self.words()
        for n in range(1, depth + 1):
            if n > 1 and len(size):
                if n % 2:
                    _, suffix, prefix, size = self.extend(suffix, prefix, size, "left")
                else:
                    _, prefix, suffix, size = self.extend(prefix, suffix, size, "right")
            yield n, self.suffixes[suffix], size


class Shard:
    """Words, pieces and index of a block; words of different languages are different symbols."""

    def __init__(self, texts, langs, depth: int):
        self.depth = depth
        data, edges = text_bytes(texts)
        self.data = _LOWER[data]
        self.starts, self.stops, doc = words_of(self.data, edges, ~byte_class(ENDS + GAPS))
        n = len(self.starts)
        names = langs.combine_chunks().dictionary_encode() if isinstance(langs, pa.ChunkedArray) else langs.dictionary_encode()
        self.langs = names.dictionary.to_pylist()
        self.lang = names.indices.to_numpy()[doc] if n else np.zeros(0, np.int64)
        ends = np.cumsum(byte_class(ENDS)[self.data], dtype=np.int64)
        new = np.ones(n, dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (ends[self.starts[1:]] != ends[self.stops[:-1] - 1])
        salt = mixed(word_hashes(*self._strings(self.langs)) + np.uint64(1))
        self.hashes = mixed(word_hashes(self.data, self.starts, self.stops) + salt[self.lang]) if n else np.zeros(0, np.uint64)
        ids = self._numbered()
        at = np.arange(n) + np.cumsum(new)
        sequence = np.zeros(n + int(new.sum()) + 1, dtype=np.int64)
        sequence[at] = ids
        self.word_at = np.zeros(len(sequence), dtype=np.int64)
        self.word_at[at] = np.arange(n)
        self.index = BiIndex(sequence, depth)
        self._joined = None

    @staticmethod
    def _strings(values: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data, edges = text_bytes(pa.array(values, pa.string()))
        return data, edges[:-1], edges[1:]

    def _numbered(self) -> np.ndarray:
        """Ids from 1 up, equal for equal words of a language; words that only share their hash are told apart by a second one.

        The hashes that leave the shard stay as they are, so that all shards say the same of a word.
        """
        values, ids, _ = distinct(self.hashes)
        other = word_hashes(self.data, self.starts, self.stops, 1)
        one = np.empty(len(values), dtype=np.uint64)
        one[ids] = other
        if (one[ids] != other).any():
            _, ids, _ = distinct(ids.astype(np.uint64) * np.uint64(1 << 40) + distinct(other)[1].astype(np.uint64))
        return ids + 1

    def phrases(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(length, first word of one occurrence, count, hash) of all phrases."""
        for n, at, count in self.index.phrases(self.depth):
            word = self.word_at[at]
            h = np.full(len(word), np.uint64(n))
            for j in range(n):
                h = h * np.uint64(0x9E3779B97F4A7C15) + self.hashes[word + j]
            yield n, word, count, mixed(h)

    def strings(self, words: np.ndarray, n: int) -> pa.Array:
        """The phrases of ``n`` words from these words on, words joined by one space."""
        # All words of the shard with one space behind each: a phrase is one stretch of it.
        if self._joined is None:
            sizes = self.stops - self.starts
            at = np.cumsum(sizes + 1) - sizes - 1
            joined = np.full(int(at[-1] + sizes[-1] + 1), 0x20, dtype=np.uint8)
            joined[spread(at, sizes)] = self.data[spread(self.starts, sizes)]
            self._joined = joined, at, at + sizes
        if not len(words):
            return pa.array([], pa.string())
        joined, starts, stops = self._joined
        first, size = starts[words], stops[words + n - 1] - starts[words]
        offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        data = joined[spread(first, size)]
        held = pa.Array.from_buffers(pa.large_string(), len(words), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])
        return held.cast(pa.string())


def _send_counts(depth: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in whole_blocks(batches):
            levels = list(Shard(rows.column(0), rows.column(1), depth).phrases())
            keys = keyed(np.concatenate([x[3] for x in levels]), parts)
            count = np.concatenate([x[2] for x in levels])
            order = np.argsort(keys, kind="stable")
            out = sent(block, parts, keys[order], count[order].astype(np.uint32))
            if out is not None:
                yield out

    return run


def _frequent(least: int):
    def choose(rows: pa.Table):
        places, row = unpacked(rows.column("a"), np.uint32)
        counts, _ = unpacked(rows.column("b"), np.uint32)
        _, number, _ = distinct(places)
        total = np.bincount(number, weights=counts)  # whole numbers, far below 2**53
        often = (total >= least)[number]
        for k, a, b in stretches(row):
            if often[a:b].any():
                yield k, places[a:b][often[a:b]], None

    return choose


COUNTS = "lang string, n int, phrase string, count long"


def _give_words(depth: int, parts: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        shard = Shard(left.column("text"), left.column("lang"), depth)
        often = np.sort(answered(right))
        names = pa.array(shard.langs, pa.string())
        totals = np.bincount(shard.lang, minlength=len(names))
        found = [(names, np.zeros(len(names), np.int32), pa.array([""] * len(names), pa.string()), totals)]
        for n, word, count, h in shard.phrases():
            mine = np.flatnonzero(among(keyed(h, parts), often))
            word = word[mine]
            found.append((names.take(pa.array(shard.lang[word])), np.full(len(mine), n, np.int32), shard.strings(word, n), count[mine]))
        del shard
        release()
        kinds = (pa.string(), pa.int32(), pa.string(), pa.int64())
        columns = [pa.chunked_array([pa.array(f[k], kind) for f in found], kind) for k, kind in enumerate(kinds)]
        return pa.table(columns, names=["lang", "n", "phrase", "count"])

    return run


def phrase_counts(
    docs: DataFrame, text: str = "text", lang: str = "lang", *, least: int = LEAST, max_words: int = MAX_WORDS
) -> DataFrame:
    """(lang, n, phrase, count), stored: every phrase of 1 to ``max_words`` words with at least ``least`` occurrences.

    A row with n = 0 and an empty phrase has the number of all words of its language.
    """
    stage = Stage(docs.sparkSession, "phrases")
    rows = docs.select(text_of(F.col(text)).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).alias("lang"))
    blocks = in_blocks(stage, rows, "text")
    parts = parts_for(blocks, "text", 0.15 * max_words)
    often = stage.write(answers(blocks.mapInArrow(_send_counts(max_words, parts), SENT), _frequent(least)))
    given = blocks.groupBy("_block").cogroup(often.groupBy("block")).applyInArrow(_give_words(max_words, parts), COUNTS)
    total = given.groupBy("lang", "n", "phrase").agg(F.sum("count").alias("count"))
    counts = stage.write(total.filter((F.col("n") == 0) | (F.col("count") >= least)))
    stage.drop(often)
    stage.drop(blocks)
    return counts


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    *,
    least: int = LEAST,
    max_words: int = MAX_WORDS,
    top: int = TOP,
    share: int = SHARE,
) -> DataFrame:
    """The best ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), cut into pieces at ``ENDS`` and into words at spaces
    and tabs. Candidates are phrases of 2 to ``max_words`` words that occur ``least``
    times or more (``a``, overlaps included). The score is the least, over all cuts,
    of floor(10**6 * a * a / (l * r)) with the counts of both parts; ``l`` and ``r`` are
    those of the lowest cut, the first one on ties. A candidate inside a longer one
    that has ``share`` percent of its occurrences or more is dropped. ``n`` counts the
    language's words. Products are decimals of 38 digits: exact up to 10**15 occurrences.

    Null texts are empty, a null language is ``und``, repeated rows count each time,
    an empty table gives no rows, and other columns are not read.
    """
    counts = phrase_counts(docs, text, lang, least=least, max_words=max_words)
    words = F.split("phrase", " ")
    part = counts.filter("n > 0").select("lang", F.col("phrase").alias("part"), F.col("count").alias("f"))
    longest = counts.filter("n > 1").select("lang", "n", "phrase", F.col("count").alias("a"), words.alias("w"))
    cuts = longest.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n") - 1))).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("n") - F.col("k")), " ").alias("rest"),
    )
    cuts = cuts.join(part.select("lang", F.col("part").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(part.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    a, l, r = (F.col(c).cast("decimal(16,0)") for c in "alr")
    million = F.lit(1_000_000).cast("decimal(7,0)")
    score = F.call_function("div", (a * a).cast("decimal(31,0)") * million, (l * r).cast("decimal(31,0)"))
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("m")
    )
    inner = longest.filter("n > 2").select(
        "lang", "a",
        F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.col("n") - 1), lambda size: F.transform(
            F.sequence(F.lit(1), F.col("n") - size + 1), lambda at: F.array_join(F.slice("w", at, size), " "),
        )))).alias("phrase"),
    )
    inner = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    alone = scored.join(inner, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.col("longer").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * share)
    )
    best = Window.partitionBy("lang").orderBy(F.desc("m.score"), F.desc("a"), "phrase")
    ranked = alone.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    # One row per language that has candidates.
    sizes = counts.filter("n = 0").select("lang", F.col("count").alias("n"))
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("m.l").alias("l"), F.col("m.r").alias("r"), "n",
        F.col("m.score").alias("score"),
    )


def op11_fm_collocations(spark, sf_dir):
    """The best 2,000 collocations of 2 and 3 words of each language over all documents."""
    return collocations(table(spark, sf_dir, "documents"))
