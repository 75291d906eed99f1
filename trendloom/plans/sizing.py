"""Joins against dimension tables: broadcast behind a size check, salted beyond it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A table is broadcast only when it was measured to be under both bounds.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
# Copies of the other side when the join must shuffle: a key that holds a third
# of all rows is spread over this many tasks.
SALTS = 32
# A key is hot when it has more rows than one task should take, whatever the
# table's size. At most MAX_HOT of them, the most frequent, are handled apart; they
# leave every other key with less than 1 / MAX_HOT of the rows.
HOT_ROWS = 1_000_000
MAX_HOT = 10_000
# A key filter holds at most this many rows of FILTER_BITS bits each, so it is always small enough to broadcast.
FILTER_ROWS = 1 << 20
FILTER_LANES = 4
FILTER_BITS = 64 * FILTER_LANES


def measured_size(df: DataFrame) -> tuple[int, int]:
    """Rows and approximate bytes, counted by Spark (one distributed aggregate)."""
    width = F.lit(0)
    for name, kind in df.dtypes:
        if kind == "string":
            width = width + F.coalesce(F.octet_length(F.col(name)), F.lit(0)) + 16
        elif kind.startswith("array"):
            width = width + F.greatest(F.size(F.col(name)), F.lit(0)) * 8 + 16
        else:
            width = width + 16
    row = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return int(row[0]), int(row[1])


def fits_broadcast(df: DataFrame, max_rows: int | None = None) -> bool:
    rows, size = measured_size(df)
    return rows <= (BROADCAST_ROWS if max_rows is None else max_rows) and size <= BROADCAST_BYTES


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: list[str] | str,
    how: str = "left",
    *,
    spread_by: str | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Join a large table with a lookup table whose keys may be hot on the large side.

    ``how`` is one of inner, left, left_semi, left_anti. ``small`` skips the
    measurement when the caller has already made it. ``spread_by`` names the
    column of ``facts`` that salts hot keys when a broadcast is refused.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if fits_broadcast(lookup) if small is None else small:
        return facts.join(F.broadcast(lookup), keys, how)
    return salted_join(facts, lookup, keys, how, spread_by=spread_by)


def salted_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: list[str] | str,
    how: str = "left",
    *,
    spread_by: str | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Shuffle join that splits every key of ``facts`` over ``salts`` tasks.

    ``lookup`` is repeated once per salt, so each fact still meets all its
    matches exactly once.
    """
    keys = [on] if isinstance(on, str) else list(on)
    seed = F.xxhash64(F.col(spread_by)) if spread_by else F.xxhash64(*facts.columns)
    left = facts.withColumn("_salt", F.pmod(seed, F.lit(salts)).cast("int"))
    right = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, keys + ["_salt"], how).drop("_salt")


def may_match(facts: DataFrame, lookup: DataFrame, key: str, flag: str | None = None) -> DataFrame:
    """The rows of ``facts`` whose ``key`` may occur in ``lookup``; with ``flag``, all rows and a column that tells.

    Every key of ``lookup`` sets one bit, chosen by its hash, in a table of bounded size, which is broadcast. No row
    with a match is lost; of the others a share passes, at most the bits per key set. So a join that has to shuffle
    moves little more than its result. Keep the exact join behind it.
    """
    n = lookup.count()
    rows = 1
    while rows < FILTER_ROWS and rows * FILTER_BITS < 16 * n:
        rows *= 2
    h = F.xxhash64(key)
    at = F.shiftrightunsigned(h, 8).bitwiseAND(F.lit(rows - 1).cast("bigint"))
    lane = F.shiftright(h, 6).bitwiseAND(F.lit(FILTER_LANES - 1).cast("bigint"))
    bit = h.bitwiseAND(F.lit(63).cast("bigint")).cast("int")
    lanes = [f"_lane{i}" for i in range(FILTER_LANES)]
    keyed = lookup.filter(F.col(key).isNotNull()).select(at.alias("_at"), lane.alias("_lane"), bit.alias("_bit"))
    mask = F.expr("shiftleft(1L, _bit)")
    none = F.lit(0).cast("bigint")
    bits = keyed.groupBy("_at").agg(
        *[F.coalesce(F.bit_or(F.when(F.col("_lane") == i, mask)), none).alias(c) for i, c in enumerate(lanes)]
    )
    word = F.col(lanes[-1])
    for i, c in list(enumerate(lanes))[-2::-1]:
        word = F.when(lane == i, F.col(c)).otherwise(word)
    found = F.coalesce(F.getbit(word, bit) == 1, F.lit(False)) & F.col(key).isNotNull()
    met = facts.withColumn("_at", at).join(F.broadcast(bits), "_at", "inner" if flag is None else "left")
    kept = met.filter(found) if flag is None else met.withColumn(flag, found)
    return kept.drop("_at", *lanes)


def hot_split_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "inner",
    *,
    also: list[str] | None = None,
) -> DataFrame:
    """Join with a large lookup table that has one row per key.

    Hot keys of ``facts`` are few by definition: their lookup rows are broadcast
    and their facts stay where they are. All other keys meet in a plain shuffle
    join. ``facts`` is read three times, so it should be a stored or staged table.
    ``also`` names further columns that must be equal (``key`` may be a hash).
    """
    on = [key, *(also or [])]
    counts = facts.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > HOT_ROWS)
    hot = [r[0] for r in counts.orderBy(F.desc("_n"), key).limit(MAX_HOT).select(key).collect()]
    if not hot:
        return facts.join(lookup, on, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    return (
        facts.filter(is_hot)
        .join(F.broadcast(lookup.filter(is_hot)), on, how)
        .unionByName(facts.filter(~is_hot).join(lookup.filter(~is_hot), on, how))
    )
