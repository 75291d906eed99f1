"""Repair of conversation structure by a run-length dynamic program.

Turns of a conversation become symbols (role and fault). An automaton for
``(s?(ua)+)?`` over role initials reads what an edit leaves of each turn, so a symbol is a
min-plus matrix over its four states, insertions before the turn included. Equal
neighbours form a run, and a run of n symbols applies powers of the symbol's matrix,
taken from a cache of its binary powers. Costs to go at the ends of runs then choose
the edits, first in ASCII order among the cheapest.

Conversations are cut into chunks of bounded length: every chunk gives the matrix
of its runs, a conversation's few matrices give each chunk the costs to go behind it,
each chunk unrolls its choices from every state that it may be entered in, and the chain of
entry states picks one. Texts never enter the program.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.plans.staging import Stage

from ._common import WORD, shuffle_partitions, table

CHUNK = 4_096  # turns of a conversation that are solved together
# Costs of edits.
RENAME, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
FAR = 1 << 50  # no way
# States: nothing read, s read, u read, a read. Legal ends are the first and the last.
STATES, ENDS = 4, (0, 3)
INSERTS = {0: (2, "u"), 1: (2, "u"), 2: (3, "a"), 3: (2, "u")}
READS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
# Symbols: role initial (x: any other) in lower case, in upper case if truncated, or "." if the turn has to go.
SYMBOLS = "suaxSUAX."


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus product of two matrices, or of a matrix and a vector."""
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), FAR) if b.ndim == 2 else np.minimum((a + b).min(axis=1), FAR)


def choices(state: int, symbol: str) -> list[tuple[str, int, int, str, bool]]:
    """(edit, cost, next state, role initial that stays, whether the turn is used up), in ASCII order of edits."""
    to, role = INSERTS[state]
    out = [("D", DELETE, state, "-", True), ("I", INSERT, to, role, False)]
    if symbol != ".":
        late = TRUNCATED if symbol.isupper() else 0
        kept = READS.get((state, symbol.lower()))
        if kept is not None:
            out.append(("K", late, kept, symbol.lower(), True))
        out.append(("R", RENAME + late, to, role, True))
    return out


@cache
def after() -> np.ndarray:
    """Costs to go behind the last turn: only insertions are left."""
    value = np.full(STATES, FAR, dtype=np.int64)
    value[list(ENDS)] = 0
    for _ in range(STATES):
        value = np.array([min(value[s], INSERT + value[INSERTS[s][0]]) for s in range(STATES)])
    return value


@cache
def matrix(symbol: str) -> np.ndarray:
    """Least cost from each state before a turn to each state behind it."""
    one = np.full((STATES, STATES), FAR, dtype=np.int64)
    for s in range(STATES):
        for _, cost, to, _, used in choices(s, symbol):
            if used:
                one[s, to] = min(one[s, to], cost)
    for _ in range(STATES):
        for s in range(STATES):
            one[s] = np.minimum(one[s], INSERT + one[INSERTS[s][0]])
    return one


@cache
def binary_power(symbol: str, k: int) -> np.ndarray:
    """The matrix of 2**k equal turns."""
    if k == 0:
        return matrix(symbol)
    half = binary_power(symbol, k - 1)
    return times(half, half)


def powers(n: int) -> list[int]:
    return [k for k in range(n.bit_length()) if n >> k & 1]


def runs(symbols: str) -> list[tuple[str, int]]:
    return [(s, sum(1 for _ in same)) for s, same in groupby(symbols)]


def chunk_matrix(symbols: str) -> np.ndarray:
    out = np.where(np.eye(STATES, dtype=bool), 0, FAR).astype(np.int64)
    for symbol, n in runs(symbols):
        for k in powers(n):
            out = times(out, binary_power(symbol, k))
    return out


def unroll(symbols: str, behind: np.ndarray, state: int) -> tuple[list[str], int]:
    """Per turn the edits before and at it as pairs of edit and role, and the state at the end.

    Costs to go at the ends of runs come from the powers; inside a run they are
    stepped back from its end, as long as it is.
    """
    found = runs(symbols)
    ends = [behind]
    for symbol, n in reversed(found):
        value = ends[-1]
        for k in powers(n):
            value = times(binary_power(symbol, k), value)
        ends.append(value)
    pieces = []
    for (symbol, n), value in zip(found, reversed(ends[:-1])):
        inside = [value]
        for _ in range(n):
            inside.append(times(matrix(symbol), inside[-1]))
        options = [choices(s, symbol) for s in range(STATES)]
        for left in range(n, 0, -1):
            here, there, piece, used = inside[left], inside[left - 1], "", False
            while not used:
                for edit, cost, to, role, used in options[state]:
                    if cost + (there if used else here)[to] == here[state]:
                        piece, state = piece + edit + role, to
                        break
            pieces.append(piece)
    return pieces, state


def last_inserts(state: int) -> str:
    value, piece = after(), ""
    while value[state] and state not in ENDS:
        state, role = INSERTS[state]
        piece += "I" + role
    return piece


def _per_row(function, returns: str):
    """An Arrow function that maps rows of Python values to one value."""

    @F.arrow_udf(returns)
    def run(*columns: pa.Array) -> pa.Array:
        return pa.array([function(*row) for row in zip(*(c.to_pylist() for c in columns))], type=_TYPES[returns])

    return run


_LONGS = pa.list_(pa.int64())
_TYPES = {
    "array<bigint>": _LONGS,
    "array<array<bigint>>": pa.list_(_LONGS),
    "struct<ends:array<bigint>,pieces:array<string>>": pa.struct([("ends", _LONGS), ("pieces", pa.list_(pa.string()))]),
}


def _suffixes(matrices: list[list[int]]) -> list[list[int]]:
    """Costs to go behind each chunk, and before the first, last chunk first."""
    out = [after()]
    for m in reversed(matrices):
        out.append(times(np.array(m, dtype=np.int64).reshape(STATES, STATES), out[-1]))
    return [v.tolist() for v in out]


def _solve(symbols: str, behind: list[int], first: bool) -> dict:
    ends, pieces = [0] * STATES, [""] * STATES
    for s in range(1 if first else STATES):
        got, ends[s] = unroll(symbols, np.array(behind, dtype=np.int64), s)
        pieces[s] = ",".join(got)
    return {"ends": ends, "pieces": pieces}


def _entries(ends: list[list[int]]) -> list[int]:
    """The state that each chunk is entered in, and the one behind the last."""
    states = [0]
    for e in ends:
        states.append(e[states[-1]])
    return states


def in_order(stage: Stage, rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows``, stored, with ``_rank``: how many rows of its group come before a row.

    Rows are sorted in ranges and counted within them, so a group may fill many
    tasks; rows that tie in everything are equal. Only the group that a range starts with
    goes on from the ranges before, and one row per range tells how.
    """
    spark = rows.sparkSession
    keys = [group, *order]
    # The last key spreads rows that are equal in everything; which of them goes where is all the same.
    sorted_rows = rows.withColumn("_seq", F.monotonically_increasing_id())
    sorted_rows = sorted_rows.repartitionByRange(shuffle_partitions(spark), *keys, "_seq").sortWithinPartitions(*keys).drop("_seq")
    more = [T.StructField("_part", T.IntegerType()), T.StructField("_n", T.LongType()), T.StructField("_head", T.BooleanType())]
    schema = T.StructType([*sorted_rows.schema.fields, *more])
    at = sorted_rows.columns.index(group)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, current, n, head, started = TaskContext.get().partitionId(), None, 0, True, False
        for batch in batches:
            ns, heads = [], []
            for value in batch.column(at).to_pylist():
                if started and value != current:
                    n, head = 0, False
                current, started = value, True
                ns.append(n)
                heads.append(head)
                n += 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * len(ns), pa.int32()), pa.array(ns, pa.int64()), pa.array(heads, pa.bool_())],
                names=schema.names,
            )

    placed = stage.write(sorted_rows.mapInArrow(count, schema))
    # One row per range: the groups at its start and its end, and how many rows the last one has there.
    named = F.struct(F.col(group).alias("g"), (F.col("_n") + 1).alias("n"))
    ranges = (
        placed.groupBy("_part").agg(F.max(F.when(F.col("_head"), named)).alias("first"), F.max(named).alias("last"))
        .orderBy("_part").collect()
    )
    offsets, tail, carried = [], None, 0
    for r in ranges:
        before = carried if tail is not None and r["first"]["g"] == tail[0] else 0
        offsets.append((r["_part"], before))
        carried = r["last"]["n"] + (before if r["first"]["g"] == r["last"]["g"] else 0)
        tail = (r["last"]["g"],)
    known = spark.createDataFrame(offsets, "_part int, _before long")
    rank = F.col("_n") + F.when(F.col("_head"), F.col("_before")).otherwise(0)
    return placed.join(F.broadcast(known), "_part").withColumn("_rank", rank).drop("_part", "_n", "_head", "_before")


def initial(role: Column) -> Column:
    return F.substring(role, 1, 1)


def repair(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Edits that give every conversation the roles ``(s?(ua)+)?``, and a report; both stored.

    Turns run by ``turn`` (null first), ties by role, then text. A turn is blank if it
    has nothing but white space, else duplicate if its role and text came earlier in
    the conversation, else truncated if its last character that isn't white space
    is none of ``.!?``. Blank and duplicate turns have to be deleted. A null role or text
    is one space; a null ``conv`` is a conversation of its own; repeated rows are
    duplicates; other columns are not read; an empty table gives no rows.

    Edits: (conv, at, step, edit, role, text), ordered by (at, step): K keeps a turn, R renames
    its role, D deletes it (its own role and text are shown), I inserts an empty turn. Report: one
    row per conversation: conv, gaps, blank, duplicate, truncated, illegal, cost, audit
    (the initials of the edits in order).
    """
    spark = turns.sparkSession
    stage = Stage(spark, "repair")
    space = F.lit(" ")
    rows = turns.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), space).alias("role"), F.coalesce(F.col(text).cast("string"), space).alias("text"),
    )
    placed = in_order(stage, rows, "conv", ["turn", "role", "text"])
    # First places of equal turns by a grouped minimum; joined by place, which no two rows of a conversation share.
    firsts = placed.groupBy("conv", "role", "text").agg(F.min("_rank").alias("_rank")).select("conv", "_rank")
    firsts = stage.write(firsts)
    here = (F.col("p.conv").eqNullSafe(F.col("f.conv"))) & (F.col("p._rank") == F.col("f._rank"))
    marked = placed.alias("p").join(firsts.alias("f"), here, "left").select("p.*", F.col("f._rank").isNull().alias("again"))
    blank = ~F.col("text").rlike(WORD)
    fault = (
        F.when(blank, "blank").when(F.col("again"), "duplicate")
        .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "truncated").otherwise("none")
    )
    role_of = F.when(initial(F.col("role")).isin("s", "u", "a"), initial(F.col("role"))).otherwise("x")
    symbol = (
        F.when(F.col("fault").isin("blank", "duplicate"), ".")
        .when(F.col("fault") == "truncated", F.upper(role_of)).otherwise(role_of)
    )
    chunk, place = F.floor(F.col("_rank") / CHUNK).cast("long"), (F.col("_rank") % CHUNK).cast("int")
    marked = stage.write(
        marked.withColumn("fault", fault)
        .select("conv", "turn", "role", "text", "fault", chunk.alias("chunk"), place.alias("place"), symbol.alias("symbol"), role_of.alias("kind"))
    )
    stage.drop(placed)
    stage.drop(firsts)
    joined = lambda c: F.array_join(F.transform(F.col("all"), lambda x: x[c]), "")
    chunks = (
        marked.groupBy("conv", "chunk").agg(F.sort_array(F.collect_list(F.struct("place", "symbol", "kind"))).alias("all"))
        .select("conv", "chunk", joined("symbol").alias("symbols"), joined("kind").alias("roles"))
    )
    chunks = stage.write(
        chunks.withColumn("matrix", _per_row(lambda s: chunk_matrix(s).reshape(-1).tolist(), "array<bigint>")("symbols"))
    )

    # One row per chunk of at most CHUNK turns from here on.
    def by_conversation(rows: DataFrame, value: str) -> DataFrame:
        listed = rows.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("chunk", value))).alias("all"))
        return listed.select("conv", F.col(f"all.{value}").alias(value))

    def with_chunk(rows: DataFrame, other: DataFrame) -> DataFrame:
        same = F.col("r.conv").eqNullSafe(F.col("o.conv")) & (F.col("r.chunk") == F.col("o.chunk"))
        return rows.alias("r").join(other.alias("o"), same).select("r.*", *[F.col(f"o.{c}") for c in other.columns if c not in ("conv", "chunk")])

    suffixes = by_conversation(chunks, "matrix").select("conv", _per_row(_suffixes, "array<array<bigint>>")("matrix").alias("v"))
    suffixes = stage.write(suffixes.select("conv", F.reverse("v").alias("v")))
    behind = suffixes.select("conv", F.posexplode(F.slice("v", F.lit(2), F.size("v") - 1)).alias("chunk", "behind"))
    solved = with_chunk(chunks.drop("matrix"), behind.withColumn("chunk", F.col("chunk").cast("long")))
    solve = _per_row(_solve, "struct<ends:array<bigint>,pieces:array<string>>")
    solved = stage.write(
        solved.withColumn("got", solve("symbols", "behind", F.col("chunk") == 0))
        .select("conv", "chunk", "roles", F.col("got.ends").alias("ends"), F.col("got.pieces").alias("pieces"))
    )
    entered = by_conversation(solved, "ends").select("conv", _per_row(_entries, "array<bigint>")("ends").alias("states"))
    entered = entered.select("conv", F.posexplode("states").alias("chunk", "state"))
    entered = stage.write(entered.withColumn("chunk", F.col("chunk").cast("long")))
    picked = with_chunk(solved.drop("ends"), entered)
    picked = stage.write(
        picked.select("conv", "chunk", "roles", F.element_at("pieces", (F.col("state") + 1).cast("int")).alias("pieces"))
    )
    # The state behind a conversation's last chunk says what is inserted at its end.
    tail = F.element_at(F.array(*[F.lit(last_inserts(s)) for s in range(STATES)]), (F.col("state") + 1).cast("int"))
    last = entered.groupBy("conv").agg(F.max(F.struct("chunk", "state")).alias("m")).select("conv", "m.chunk", "m.state")
    last = stage.write(last.select("conv", "chunk", tail.alias("piece")))

    edits = stage.write(
        with_chunk(marked.select("conv", "chunk", "place", "role", "text"), picked.drop("roles"))
        .withColumn("piece", F.element_at(F.split("pieces", ","), F.col("place") + 1))
        .select("conv", (F.col("chunk") * CHUNK + F.col("place")).alias("at"), "role", "text", "piece")
        .unionByName(last.filter("piece <> ''").select("conv", (F.col("chunk") * CHUNK).alias("at"), F.lit("").alias("role"), F.lit("").alias("text"), "piece"))
        .withColumn("step", F.explode(F.sequence(F.lit(0), (F.length("piece") / 2 - 1).cast("int"))))
        .withColumn("edit", F.substr("piece", F.col("step") * 2 + 1, F.lit(1)))
        .withColumn("to", F.when(F.substr("piece", F.col("step") * 2 + 2, F.lit(1)) == "u", "user").otherwise("assistant"))
        .select(
            "conv", "at", "step", "edit",
            F.when(F.col("edit").isin("I", "R"), F.col("to")).otherwise(F.col("role")).alias("role"),
            F.when(F.col("edit") == "I", F.lit("")).otherwise(F.col("text")).alias("text"),
        )
    )

    def many(name: str) -> Column:
        return F.sum((F.col("fault") == name).cast("long")).alias(name)

    # Distinct turns are counted over rows that are already one per turn: no group is sorted or held.
    per_turn = marked.groupBy("conv", "turn").agg(many("blank"), many("duplicate"), many("truncated"))
    faults = per_turn.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated")],
    )
    listed = picked.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("chunk", "roles", "pieces"))).alias("all"))
    whole = F.array_join("all.roles", "")
    legal = F.regexp_count(whole, F.lit("s(?=u)")) + F.regexp_count(whole, F.lit("u(?=a)")) + F.regexp_count(whole, F.lit("a(?=u)"))
    report = (
        listed.join(last.select(F.col("conv").alias("c1"), "piece"), F.col("conv").eqNullSafe(F.col("c1")))
        .select(
            "conv",
            (F.length(whole) - 1 - legal).cast("long").alias("illegal"),
            F.translate(F.concat(F.array_join("all.pieces", ""), F.col("piece")), "sua-x,", "").alias("audit"),
        )
        .join(faults.withColumnRenamed("conv", "c2"), F.col("conv").eqNullSafe(F.col("c2")))
        .join(suffixes.select(F.col("conv").alias("c3"), F.col("v")[0][0].alias("cost")), F.col("conv").eqNullSafe(F.col("c3")))
    )
    columns = [F.col("conv").alias(conv), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    return edits.withColumnRenamed("conv", conv), report.select(*columns)


def repaired_digests(edits: DataFrame, conv: str = "conv_id") -> DataFrame:
    """SHA-256 of each repaired conversation, ``role:text`` joined by newlines.

    A digest reads its conversation in order, so that is one task's stream; only
    the digest's state is held.
    """
    rows = edits.filter(F.col("edit") != "D").select(F.col(conv).alias("c"), "at", "step", F.concat_ws(":", "role", "text").alias("said"))
    rows = rows.repartition("c").sortWithinPartitions("c", "at", "step").select("c", "said")
    kind = edits.schema[conv].dataType
    schema = T.StructType([T.StructField(conv, kind), T.StructField("repaired_sha256", T.StringType())])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, done, key_type = None, None, [], None

        def flush():
            out = pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in done], key_type), pa.array([d[1].hexdigest() for d in done], pa.string())], names=schema.names
            )
            done.clear()
            return out

        for batch in batches:
            key_type = batch.schema.field(0).type
            for c, said in zip(batch.column(0).to_pylist(), batch.column(1)):
                if state is None or c != current:
                    if state is not None:
                        done.append((current, state))
                    current, state = c, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(said.as_py().encode())
            if len(done) > 10_000:
                yield flush()
        if state is not None:
            done.append((current, state))
            yield flush()

    return rows.mapInArrow(digests, schema)


def damaged(turns: DataFrame) -> DataFrame:
    """The rows of a conversations table with the faults that crc32(conv_id:turn) mod 20 names."""
    space = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("kind"),
    ).filter("kind <> 0")
    rows = rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        "kind",
    )
    times = F.when(F.col("kind") == 3, 2).otherwise(1)
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), times))).select("conv_id", "turn", "role", "text")


def op12_conversation_repair(spark, sf_dir):
    """All conversations, damaged, then repaired; one row per conversation of the table."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    edits, report = repair(damaged(given))
    ids = given.select(F.col("conv_id").alias("id")).distinct()
    digests = repaired_digests(edits).withColumnRenamed("conv_id", "c4")
    out = ids.join(report, F.col("id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    out = out.join(digests, F.col("id").eqNullSafe(F.col("c4")), "left")
    longs = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select(
        F.col("id").alias("conv_id"), *longs, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
