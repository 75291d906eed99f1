"""Building mention records and adding only unseen ones to the store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import or_empty, stable_hash, strip
from ..functions.timefns import event_time
from ..plans.sizing import fits_broadcast, lookup_join
from ..schema import MENTIONS
from .clean import dedup_mentions

# Up to this many rows per group the planner trims every task to the group's
# first n rows by itself (spark.sql.optimizer.windowGroupLimitThreshold).
GROUP_LIMIT = 1000
CAP_SALTS = 64


def with_mention_id(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "mention_id", stable_hash("source", "platform", "keyword", "title", "text", "url")
    )


def make_mentions(df: DataFrame, collected_at: Column | None = None) -> DataFrame:
    """The 22 columns of a mention, in order, from the columns that describe a post.

    Missing optional columns get their defaults; extra columns are dropped.
    """
    have = set(df.columns)

    def text_of(name: str) -> Column:
        return or_empty(F.col(name).cast("string")) if name in have else F.lit("")

    base = df.select(
        *[text_of(c).alias(c) for c in (
            "source", "platform", "sub_source", "source_type", "keyword", "query", "category",
            "title", "text", "author", "community", "published_at", "url",
        )],
        (F.coalesce(F.col("engagement_score").cast("double"), F.lit(0.0))
         if "engagement_score" in have else F.lit(0.0)).alias("engagement_score"),
        (F.coalesce("metrics_json", F.lit("{}"))
         if "metrics_json" in have else F.lit("{}")).alias("metrics_json"),
    )
    full = (
        with_mention_id(base)
        .withColumn("full_text", strip(F.concat("title", F.lit(" "), "text")))
        .withColumn("collected_at", collected_at if collected_at is not None else F.current_timestamp())
        .withColumn("semantic_relevance_score", F.lit(0.0))
        .withColumn("tiktok_relevance_score", F.lit(0.0))
        .withColumn("business_context_label", F.lit(""))
        .withColumn("collector_priority_score", F.lit(0.0))
    )
    return full.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in MENTIONS.fields])


def ingest_new(
    batch: DataFrame, existing: DataFrame, order: list[Column | str] | None = None
) -> DataFrame:
    """Rows of ``batch`` whose id is not stored yet, first occurrence of each id.

    The store may be far larger than the batch. A batch of checked size is
    broadcast to the store's id column, so that only the overlap moves; a large
    batch meets the store in a shuffle join on ids.
    """
    fresh = dedup_mentions(batch, order)
    ids = batch.select("mention_id").distinct()
    stored = existing.select("mention_id")
    if fits_broadcast(ids):
        stored = stored.join(F.broadcast(ids), "mention_id", "left_semi")
    # distinct first: an id may have been stored many times
    return fresh.join(stored.distinct(), "mention_id", "left_anti")


def cap_per_group(
    df: DataFrame,
    key: str | list[str],
    n: int,
    total: int | None = None,
    order: list[Column | str] | None = None,
) -> DataFrame:
    """At most ``n`` rows per group and ``total`` rows overall, newest first.

    The cap is exact. Above ``GROUP_LIMIT`` each group is first cut to its
    leading ``n`` rows within hash-salted parts, so that a hot group is never
    sorted whole in one task. Dates may be timestamps or the texts that records hold.
    """
    keys = [key] if isinstance(key, str) else list(key)
    by = list(order) if order else [event_time(df).desc_nulls_last(), F.asc("mention_id")]

    def first_n(frame: DataFrame, parts: list[str]) -> DataFrame:
        w = Window.partitionBy(*parts).orderBy(*by)
        return frame.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= n).drop("_n")

    out = df
    if n > GROUP_LIMIT:
        salted = out.withColumn("_salt", F.pmod(F.xxhash64("mention_id"), F.lit(CAP_SALTS)))
        out = first_n(salted, keys + ["_salt"]).drop("_salt")
    out = first_n(out, keys)
    if total is None:
        return out
    return (out if order else _since_hour_of(out, total)).orderBy(*by).limit(total)


def _since_hour_of(df: DataFrame, total: int) -> DataFrame:
    """Drop the rows older than the hour in which the ``total``-th newest row lies.

    One scalar comes to the driver; the top-k that follows then sees little more
    than ``total`` rows instead of ``total`` rows per task.
    """
    hours = (
        df.select(F.date_trunc("hour", event_time(df)).alias("hour")).filter("hour is not null")
        .groupBy("hour")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    newest_first = Window.orderBy(F.desc("hour"))
    cut = (
        hours.withColumn("seen", F.sum("n").over(newest_first))
        .filter(F.col("seen") >= total)
        .agg(F.unix_seconds(F.max("hour")).alias("s"))
        .first()["s"]
    )
    if cut is None:
        return df
    return df.filter(event_time(df) >= F.timestamp_seconds(F.lit(cut)))


def ingest_summary(df: DataFrame) -> DataFrame:
    """Rows per source and community, and the source's running total by community name."""
    counts = df.groupBy("source", "community").agg(F.count(F.lit(1)).alias("new_rows"))
    running = Window.partitionBy("source").orderBy("community")
    return counts.withColumn("running_total", F.sum("new_rows").over(running))


def with_category(df: DataFrame, catalog: DataFrame, default: str | None = None) -> DataFrame:
    """Attach the category of the post's community (case-sensitive)."""
    out = lookup_join(df.drop("category"), catalog.select("community", "category"), "community")
    return out if default is None else out.fillna({"category": default})
