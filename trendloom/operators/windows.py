"""Biweekly comparison windows anchored at the newest post.

Window ``i`` covers ``[anchor - (i+1)d, anchor - i*d)`` and is compared with the
``d`` days before it. The previous period of window ``i`` is therefore the
current period of window ``i+1``: every post has exactly one *slot* (period
index), and per-slot aggregates serve both sides. Posts at exactly the anchor
are in no slot, because the periods are half-open.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

N_WINDOWS = 4
WINDOW_DAYS = 14


def find_anchor(df: DataFrame, ts: str = "published_at") -> datetime | None:
    """Newest timestamp: one row to the driver, so that later filters are literals.

    The value is an aware UTC datetime, so it means the same instant whatever
    the time zone of the Python process is.
    """
    micros = df.agg(F.unix_micros(F.max(ts)).alias("m")).first()["m"]
    if micros is None:
        return None
    return datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=micros)


def _micros(anchor: datetime) -> int:
    aware = anchor if anchor.tzinfo else anchor.replace(tzinfo=timezone.utc)
    delta = aware - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds


def _at(micros: int) -> Column:
    return F.timestamp_micros(F.lit(micros))


def biweekly_windows(
    df: DataFrame, n: int = N_WINDOWS, days: int = WINDOW_DAYS, ts: str = "published_at"
) -> DataFrame:
    """One row per window: label ``MM/dd–MM/dd`` and the four bounds."""
    step = F.expr(f"interval {int(days)} days")
    anchored = df.agg(F.max(ts).alias("anchor"))
    rows = anchored.select("anchor", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("window_id"))
    cur_end = F.col("anchor") - step * F.col("window_id")
    bounds = rows.select(
        F.col("window_id").cast("int").alias("window_id"),
        (cur_end - step).alias("cur_start"),
        cur_end.alias("cur_end"),
        (cur_end - step - step).alias("prev_start"),
        (cur_end - step).alias("prev_end"),
    )
    label = F.concat(
        F.date_format("cur_start", "MM/dd"), F.lit("–"), F.date_format("cur_end", "MM/dd")
    )
    return bounds.select(
        "window_id", label.alias("window_label"), "cur_start", "cur_end", "prev_start", "prev_end"
    )


def assign_slots(
    df: DataFrame,
    anchor: datetime,
    n: int = N_WINDOWS,
    days: int = WINDOW_DAYS,
    ts: str = "published_at",
) -> DataFrame:
    """Add ``slot`` in 0..n and drop the posts outside all periods.

    Both bounds are literals and reach the Parquet scan as pushed filters.
    """
    width = days * 86_400 * 1_000_000
    end = _micros(anchor)
    # whole microseconds, so that no rounding moves a post over an edge
    slot = F.expr(f"({end}L - unix_micros(`{ts}`) - 1L) div {width}L")
    return df.filter(
        (F.col(ts) >= _at(end - (n + 1) * width)) & (F.col(ts) < _at(end))
    ).withColumn("slot", slot.cast("int"))


def slots_to_sides(df: DataFrame, n: int = N_WINDOWS) -> DataFrame:
    """Turn ``slot`` into ``(window_id, side)``: cur of its own window, prev of the newer one."""
    sides = F.array(
        F.struct(F.col("slot").alias("window_id"), F.lit("cur").alias("side")),
        F.struct((F.col("slot") - 1).alias("window_id"), F.lit("prev").alias("side")),
    )
    out = df.withColumn("_side", F.explode(sides)).select(
        F.col("_side.window_id").alias("window_id"),
        F.col("_side.side").alias("side"),
        *[c for c in df.columns if c != "slot"],
    )
    return out.filter(F.col("window_id").between(0, n - 1))


def assign_windows(
    df: DataFrame,
    anchor: datetime,
    n: int = N_WINDOWS,
    days: int = WINDOW_DAYS,
    ts: str = "published_at",
) -> DataFrame:
    """Every post with each ``(window_id, side)`` it belongs to."""
    return slots_to_sides(assign_slots(df, anchor, n, days, ts), n)
