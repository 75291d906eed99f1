"""Removal of passages that repeat across documents, found by difference-cover anchors.

Of the windows of a document only those at cover positions are hashed as anchors:
positions whose remainder by the period lies in a difference cover, a set with two
members at every distance modulo the period. Wherever a stretch of ``window`` words
occurs twice, some shift below the period brings both occurrences onto a cover
position at once, so the two share an anchor of ``window`` - period + 1 words. Only
where an anchor is shared are the full windows around it hashed and compared.

Documents lie in blocks, as they are read. Anchors, then windows, go from blocks to parts
of the hash range and back (``_blocks``): no pairs are made, and a passage that a
third of all documents hold is one entry per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.plans.staging import Stage

from ._blocks import (
    SENT, among, answered, answers, byte_class, gram_hashes, in_blocks, keyed, nothing_sent, parts_for, release, sent, stretches,
    text_bytes, unpacked, whole_blocks, word_hashes, words_of,
)
from ._common import table, text_of

WINDOW = 13
# Perfect difference sets, by period.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
SPACE = b" \t\n\x0b\x0c\r"


def cover_of(window: int) -> tuple[int, tuple[int, ...]]:
    """Period and cover whose anchors still have half of the window's words."""
    period = max(p for p in COVERS if p - 1 <= window // 2)
    return period, COVERS[period]


class Words:
    """The words of a block's texts: bytes, hashes, and their place in their text."""

    def __init__(self, texts, window: int):
        self.window = window
        self.data, self.edges = text_bytes(texts)
        self.starts, self.stops, self.doc = words_of(self.data, self.edges, ~byte_class(SPACE))
        self.counts = np.bincount(self.doc, minlength=len(self.edges) - 1)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])[:-1]
        self.place = np.arange(len(self.doc)) - self.first[self.doc]
        self.hashes = word_hashes(self.data, self.starts, self.stops)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of the anchors, and their hashes."""
        period, cover = cover_of(self.window)
        size = self.window - period + 1
        grams = gram_hashes(self.hashes, size)
        n = len(grams)
        inside = (self.place[:n] + size <= self.counts[self.doc[:n]]) & (self.counts[self.doc[:n]] >= self.window)
        at = np.flatnonzero(inside & np.isin(self.place[:n] % period, cover))
        return at, grams[at]

    def fits(self) -> np.ndarray:
        """Whether a whole window starts at a word."""
        return self.place + self.window <= self.counts[self.doc]

    def near(self, at: np.ndarray) -> np.ndarray:
        """Word numbers of the windows that hold one of the anchors ``at``."""
        period, _ = cover_of(self.window)
        flags = np.zeros(len(self.doc), dtype=bool)
        for shift in range(period):
            flags[at[self.place[at] >= shift] - shift] = True
        return np.flatnonzero(flags & self.fits())

    def windows(self, at: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
        """Key and a second hash of the windows at these words: 96 bits, and those of the part."""
        other = word_hashes(self.data, self.starts, self.stops, 1)
        return keyed(gram_hashes(self.hashes, self.window)[at], parts), gram_hashes(other, self.window, 1)[at]


def _runs(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that sorts hashes, and where each distinct one starts in it."""
    order = np.lexsort((low, high))
    h, l = high[order], low[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (l[1:] != l[:-1])
    return order, np.flatnonzero(new)


def _send_anchors(window: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in whole_blocks(batches):
            words = Words(rows.column(1), window)
            at, hashes = words.anchors()
            ids = rows.column(0).to_numpy()[words.doc[at]]
            one = np.uint64(1)
            keys = keyed(hashes, parts) & ~one
            order = np.lexsort((ids, keys))
            h, d = keys[order], ids[order]
            new = np.ones(len(h), dtype=bool)
            new[1:] = h[1:] != h[:-1]
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(h)) - 1
            # The lowest bit says whether the block alone has the anchor in several documents.
            out = sent(block, parts, h[first] | (d[first] != d[last]).astype(np.uint64))
            if out is not None:
                yield out

    return run


def _shared_anchors(rows: pa.Table):
    places, row = unpacked(rows.column("a"), np.uint32)
    bare = places & ~np.uint32(1)
    order = np.argsort(bare, kind="stable")
    b = bare[order]
    same = np.zeros(len(b), dtype=bool)
    same[1:] = b[1:] == b[:-1]
    same[:-1] |= same[1:]
    shared = np.empty(len(b), dtype=bool)
    shared[order] = same
    shared |= (places & np.uint32(1)).astype(bool)
    for k, a, b in stretches(row):
        if shared[a:b].any():
            yield k, bare[a:b][shared[a:b]], None


def _send_windows(window: int, parts: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return nothing_sent()
        shared = np.sort(answered(right))
        words = Words(left.column("text"), window)
        at, hashes = words.anchors()
        at = words.near(at[among(keyed(hashes, parts) & ~np.uint64(1), shared)])
        high, low = words.windows(at, parts)
        ids = left.column("id").to_numpy()
        if not len(at):
            return nothing_sent()
        order, first = _runs(high, low)
        base = int(ids.min())
        least = np.minimum.reduceat((ids[words.doc[at]] - base)[order], first)
        width = next(w for w in (np.uint16, np.uint32, np.uint64) if int(least.max()) <= np.iinfo(w).max)
        at = order[first]
        out = sent(int(left.column("_block")[0].as_py()), parts, high[at], low[at], least.astype(width), base)
        return pa.Table.from_batches([out])

    return run


def _older_windows(rows: pa.Table):
    """For each block its windows that a smaller document of another block has, too."""
    high, row = unpacked(rows.column("a"), np.uint32)
    low, _ = unpacked(rows.column("b"), np.uint64)
    bases = rows.column("base").to_pylist()
    ids = []
    for packed, size, base in zip(rows.column("c").to_pylist(), np.bincount(row, minlength=rows.num_rows).tolist(), bases):
        ids.append(np.frombuffer(packed, f"u{len(packed) // size}").astype(np.int64) + base)
    ids = np.concatenate(ids)
    order, first = _runs(high, low)
    sizes = np.diff(np.append(first, len(order)))
    least = np.empty(len(ids), dtype=np.int64)
    least[order] = np.repeat(np.minimum.reduceat(ids[order], first), sizes)
    older = least < ids
    for k, a, b in stretches(row):
        mine = older[a:b]
        if mine.any():
            yield k, high[a:b][mine], low[a:b][mine]


def _kept(window: int, parts: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        words = Words(left.column("text"), window)
        n = left.num_rows
        gone = np.zeros(len(words.doc) + 1, dtype=np.int32)
        at = np.flatnonzero(words.fits())
        known = left.column("id").is_valid().to_numpy(zero_copy_only=False)
        at = at[known[words.doc[at]]]
        if len(at):
            ids = left.column("id").fill_null(0).to_numpy()[words.doc[at]]
            high, low = words.windows(at, parts)
            order, first = _runs(high, low)
            least = np.empty(len(at), dtype=np.int64)
            least[order] = np.repeat(np.minimum.reduceat(ids[order], first), np.diff(np.append(first, len(order))))
            repeated = least < ids
            h = answered(right)
            l, _ = unpacked(right.column("b"), np.uint64)
            if len(h):
                # Equal hashes get one number, so that those sent back can be looked up among the block's.
                o, f = _runs(np.concatenate([high, h]), np.concatenate([low, l]))
                number = np.empty(len(o), dtype=np.int64)
                number[o] = np.repeat(np.arange(len(f)), np.diff(np.append(f, len(o))))
                repeated |= among(number[: len(high)], np.unique(number[len(high) :]))
            hit = at[repeated]
            np.add.at(gone, hit, 1)
            np.add.at(gone, hit + window, -1)
        removed = np.cumsum(gone[:-1]) > 0
        counts = np.bincount(words.doc[removed], minlength=n)
        stay = np.flatnonzero(~removed)
        starts, stops, doc = words.starts[stay], words.stops[stay], words.doc[stay]
        # Bytes of the kept words, and one space before each but a text's first.
        lead = np.ones(len(stay), dtype=np.int64)
        if len(stay):
            lead[0] = 0
            lead[1:] = doc[1:] == doc[:-1]
        sizes = stops - starts
        ends = np.cumsum(sizes + lead)
        out = np.full(int(ends[-1]) if len(ends) else 0, 0x20, dtype=np.uint8)
        inside = np.zeros(len(words.data) + 1, dtype=np.int8)
        inside[starts] = 1
        inside[stops] -= 1
        source = words.data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
        space = np.zeros(len(out), dtype=bool)
        space[(ends - sizes - lead)[lead.astype(bool)]] = True
        out[~space] = source
        per_doc = np.bincount(doc, weights=sizes + lead, minlength=n).astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum(per_doc)])
        texts = pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(out.tobytes())])
        release()
        return pa.Table.from_arrays(
            [left.column("id"), pa.array(words.counts, pa.int64()), pa.array(counts, pa.int64()), texts.cast(pa.string())],
            names=["id", "n_words", "n_removed", "kept"],
        )

    return run


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept.

    A word goes if a window of ``window`` words that covers it starts in a document
    with a smaller id, too; all windows are judged on the input. ``kept`` has the
    other words, joined by one space. Words are runs of anything but white space,
    unchanged; ids are whole numbers. A null text has no words. Rows without an id
    lose nothing and take nothing from others; rows with equal ids take nothing from
    each other, each gives a row. Texts with fewer words than a window lose nothing.
    An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    stage = Stage(spark, "substrings")
    kind = docs.schema[doc_id].dataType
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), text_of(F.col(text)).alias("text"))
    blocks = in_blocks(stage, rows, "text")
    with_id = blocks.filter(F.col("id").isNotNull())
    parts = parts_for(with_id, "text", 0.08)
    shared = stage.write(answers(with_id.mapInArrow(_send_anchors(window, parts), SENT), _shared_anchors))
    met = with_id.groupBy("_block").cogroup(shared.groupBy("block")).applyInArrow(_send_windows(window, parts), SENT)
    older = stage.write(answers(met, _older_windows))
    stage.drop(shared)
    schema = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType()),
    ])
    out = blocks.groupBy("_block").cogroup(older.groupBy("block")).applyInArrow(_kept(window, parts), schema)
    return out.select(F.col("id").cast(kind).alias(doc_id), "n_words", "n_removed", "kept")


def op13_substring_dedup(spark, sf_dir):
    """All documents without passages of 13 words and more that smaller documents have."""
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
