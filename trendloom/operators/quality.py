"""Checks and selections that the run configuration declares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import norm_text, or_empty
from ..functions.timefns import event_time
from ..plans.sizing import fits_broadcast


def content_hash(*cols: str) -> Column:
    keys = cols or ("title", "text")
    return F.sha2(F.concat_ws("||", *[norm_text(or_empty(c)) for c in keys]), 256)


def dedup_content(
    df: DataFrame, keys: tuple[str, ...] = ("title", "text"), order: list[Column | str] | None = None
) -> DataFrame:
    """First row of each normalised content, over whole texts.

    Content without a letter or digit tells nothing of a copy: such rows are kept
    one per ``mention_id`` (where there is none, one in all).
    """
    by = list(order) if order else [F.asc_nulls_last("published_at"), F.asc("mention_id")]
    blank = F.concat_ws("", *[norm_text(or_empty(c)) for c in keys]) == ""
    own = F.col("mention_id").cast("string") if "mention_id" in df.columns else F.lit(None).cast("string")
    first = Window.partitionBy("content_hash", "_own").orderBy(*by)
    return (
        df.withColumn("content_hash", content_hash(*keys))
        .withColumn("_own", F.when(blank, own))
        .withColumn("_copy", F.row_number().over(first))
        .filter(F.col("_copy") == 1)
        .drop("_copy", "_own")
    )


def volume_checks(
    df: DataFrame, expected: DataFrame, min_rows: int = 100, ts: str = "published_at"
) -> DataFrame:
    """Rows per day and expected source, with an alert for low and for empty ones.

    ``expected(source)`` lists the sources that should deliver on every day from
    the first to the last one with any row, so a day on which all were silent
    shows as well. Dates may be timestamps or the texts that records hold.
    """
    day = F.to_date(event_time(df, ts))
    counts = (
        df.select(day.alias("day"), "source").filter(F.col("day").isNotNull())
        .groupBy("day", "source").agg(F.count(F.lit(1)).alias("n"))
    )
    days = counts.agg(F.min("day").alias("a"), F.max("day").alias("b")).filter("a is not null").select(
        F.explode(F.sequence("a", "b")).alias("day")
    )
    sources = expected.select("source").distinct()
    grid = days.crossJoin(F.broadcast(sources) if fits_broadcast(sources) else sources)
    n = F.coalesce("n", F.lit(0))
    return grid.join(counts, ["day", "source"], "left").select(
        "day",
        "source",
        n.alias("row_count"),
        F.when(n == 0, "empty").when(n < min_rows, "low").otherwise("ok").alias("status"),
    )


def date_range(df: DataFrame, start: str, end: str, ts: str = "published_at") -> DataFrame:
    """Posts of the days ``start`` to ``end``, both included (pushed to the scan where dates are timestamps)."""
    at = event_time(df, ts)
    return df.filter(
        (at >= F.to_timestamp(F.lit(start)))
        & (at < F.to_timestamp(F.lit(end)) + F.expr("interval 1 day"))
    )
