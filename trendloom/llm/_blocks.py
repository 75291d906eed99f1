"""Blocks of texts, their words as arrays of hashes, and the exchange of hashes between blocks.

A block is a bounded stretch of the rows of a table. What a block says of its
hashes goes to the part of the hash range that each lies in, one row per block and
part, sorted and without repeats: a hash that a third of all rows hold arrives once
per block, never once per row. Parts answer with one row per block.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.plans.staging import Stage

from ._common import shuffle_partitions

BLOCK_BYTES = 4 << 20  # of text in a block; a longer text is a block of its own
BLOCK_ROWS = 16_384
PART_HASHES = 1 << 20  # hashes that a part of the range receives, about
_SLICE = 100_000  # words hashed at once

# The finaliser of splitmix64 and odd multipliers.
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def byte_class(listed: bytes) -> np.ndarray:
    """A table of 256 flags that says which bytes are listed."""
    table = np.zeros(256, dtype=bool)
    table[list(listed)] = True
    return table


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values in order, which of them each value is, and how often each occurs."""
    order = np.argsort(values, kind="stable")  # the default kind is slow where values repeat
    ordered = values[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    number = np.empty(len(values), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    return ordered[first], number, np.diff(np.append(first, len(values)))


@cache
def _trim():
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):
        return None


def release() -> None:
    """Give memory that Python and Arrow hold on to back; workers are used again by other tasks."""
    pa.default_memory_pool().release_unused()
    if _trim() is not None:
        _trim()(0)


def releasing(task: Callable) -> Callable:
    """A function over batches that gives memory back before its first and after its last one."""

    def run(batches: Iterator) -> Iterator:
        release()
        yield from task(batches)
        release()

    return run


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of a column (null: empty), one behind the other, and where each starts and ends."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    edges = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data[edges[0] : edges[-1]], edges - edges[0]


def words_of(data: np.ndarray, edges: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word: a longest run, within a text, of bytes that ``inside`` flags."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = inside[data]
    first = np.empty_like(word)
    first[0], first[1:] = True, ~word[:-1]
    first[edges[:-1][edges[:-1] < len(data)]] = True
    last = np.empty_like(word)
    last[:-1], last[-1] = first[1:] | ~word[1:], True
    starts, stops = np.flatnonzero(word & first), np.flatnonzero(word & last) + 1
    return starts, stops, np.searchsorted(edges[1:], starts, side="right")


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, kind: int = 0) -> np.ndarray:
    """A 64-bit hash of the bytes of every word; the two kinds are independent of each other."""
    base = _BASES[kind]
    out = np.empty(len(starts), dtype=np.uint64)
    values = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASES[1 - kind]))
    back = np.uint64(pow(base, -1, 1 << 64))
    for at in range(0, len(starts), _SLICE):
        a, b = starts[at : at + _SLICE], stops[at : at + _SLICE]
        low, size = int(a[0]), int(b[-1] - a[0])
        powers = np.full(size + 1, np.uint64(base))
        powers[0] = 1
        np.cumprod(powers, out=powers)
        sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(values[data[low : low + size]] * powers[:-1], out=sums[1:])
        powers[1:], powers[0] = back, 1
        np.cumprod(powers, out=powers)
        out[at : at + _SLICE] = mixed((sums[b - low] - sums[a - low]) * powers[a - low] + (b - a).astype(np.uint64))
    return out


def gram_hashes(words: np.ndarray, n: int, kind: int = 0) -> np.ndarray:
    """Hashes of all stretches of ``n`` words, whatever texts they lie in."""
    size = len(words) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(size, np.uint64(n))
    for j in range(n):
        out = out * np.uint64(_BASES[kind]) + words[j : j + size]
    return mixed(out)


def in_blocks(stage: Stage, rows: DataFrame, text: str) -> DataFrame:
    """``rows``, stored, with ``_block``: a number that neighbouring rows of bounded bytes share."""
    schema = T.StructType([*rows.schema.fields, T.StructField("_block", T.LongType())])
    at = rows.columns.index(text)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, count = TaskContext.get().partitionId() << 33, 0, 0
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_pylist()
            blocks = []
            for size in sizes:
                if count and (held + size > BLOCK_BYTES or count >= BLOCK_ROWS):
                    block, held, count = block + 1, 0, 0
                held, count = held + size, count + 1
                blocks.append(block)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(blocks, pa.int64())], names=schema.names)

    return stage.write(rows.mapInArrow(number, schema))


def whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Runs of rows with the same last column, ``_block``; a block read by two tasks comes as two runs."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        blocks = batch.column(batch.num_columns - 1).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if held and blocks[a] != current:
                yield current, pa.Table.from_batches(held)
                held = []
                release()
            current = int(blocks[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield current, pa.Table.from_batches(held)
    held = []
    release()


# a: places of keys in their part, 32 bits each; b, c: what goes along; base: what c counts from.
SENT = T.StructType(
    [T.StructField("part", T.IntegerType()), T.StructField("block", T.LongType())]
    + [T.StructField(c, T.BinaryType()) for c in ("a", "b", "c")]
    + [T.StructField("base", T.LongType())]
)
ANSWER = T.StructType(SENT.fields[:4])
_SENT_ARROW = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary()), ("base", pa.int64())])
_ANSWER_ARROW = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("a", pa.binary()), ("b", pa.binary())])


def parts_for(rows: DataFrame, text: str, per_byte: float) -> int:
    """How many parts the hash range is cut into, for so many hashes per byte of text."""
    size = rows.agg(F.coalesce(F.sum(F.octet_length(F.col(text))), F.lit(0))).first()[0]
    return max(2, shuffle_partitions(rows.sparkSession), int(size * per_byte / PART_HASHES) + 1)


def keyed(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Part of the range (two or more) above 32 bits of a hash's place in it; parts grow with the data, so places stay rare."""
    width = (1 << 64) // parts + 1
    part = hashes // np.uint64(width)
    shift = max(0, (width - 1).bit_length() - 32)
    return (part << np.uint64(32)) | ((hashes - part * np.uint64(width)) >> np.uint64(shift))


def sent(block: int, parts: int, keys: np.ndarray, b: np.ndarray | None = None, c: np.ndarray | None = None, base: int = 0):
    """A block's rows of the exchange, one per part that gets something; ``keys`` are sorted, ``b`` and ``c`` go along."""
    edges = np.arange(1, parts, dtype=np.uint64) << np.uint64(32)
    cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
    rows = [(p, cuts[p], cuts[p + 1]) for p in range(parts) if cuts[p] < cuts[p + 1]]
    if not rows:
        return None
    cut = lambda x: pa.array([None if x is None else x[i:j].tobytes() for _, i, j in rows], pa.binary())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.int32()), pa.array([block] * len(rows), pa.int64()), cut(keys.astype(np.uint32)), cut(b),
            cut(c), pa.array([base] * len(rows), pa.int64()),
        ],
        schema=_SENT_ARROW,
    )


def answered(rows: pa.Table) -> np.ndarray:
    """The keys that parts have sent back to a block, in the order of the rows."""
    places, row = unpacked(rows.column("a"), np.uint32)
    return (rows.column("part").to_numpy().astype(np.uint64)[row] << np.uint64(32)) | places


def nothing_sent() -> pa.Table:
    return pa.Table.from_batches([], schema=_SENT_ARROW)


def answers(emitted: DataFrame, choose: Callable[[pa.Table], Iterator[tuple[int, np.ndarray, np.ndarray | None]]]) -> DataFrame:
    """(part, block, a, b) of what ``choose`` makes of all rows of a part: (number of the row answered, a, b)."""

    def reply(rows: pa.Table) -> pa.Table:
        said = list(choose(rows))
        at = pa.array([s[0] for s in said], pa.int64())
        cut = lambda k: pa.array([None if s[k] is None else s[k].tobytes() for s in said], pa.binary())
        held = [rows.column(c).combine_chunks().take(at) for c in ("part", "block")]
        out = pa.Table.from_arrays([*held, cut(1), cut(2)], schema=_ANSWER_ARROW)
        del said
        release()
        return out

    return emitted.groupBy("part").applyInArrow(reply, ANSWER)


def unpacked(column, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All values of a column of packed arrays, and the number of the row of each."""
    held = [np.frombuffer(x, dtype) for x in column.to_pylist() if x is not None]
    if not held:
        return np.zeros(0, dtype), np.zeros(0, np.int64)
    return np.concatenate(held), np.repeat(np.arange(len(held)), [len(x) for x in held])


def stretches(row: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Each number in a sorted array, and the slice that it fills."""
    cuts = np.flatnonzero(np.diff(row)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(row)]):
        if a < b:
            yield int(row[a]), a, b


def among(values: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Which values occur in the sorted array ``held``."""
    if not len(held):
        return np.zeros(len(values), dtype=bool)
    return held[np.minimum(np.searchsorted(held, values), len(held) - 1)] == values
