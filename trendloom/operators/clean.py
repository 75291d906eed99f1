"""Cleaning of collected mentions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import head, or_empty, strip

MIN_LENGTH = 10
NER_CHARS = 400


def _order(df: DataFrame, order: list | None) -> list:
    if order:
        return list(order)
    return [F.asc_nulls_last(c) for c in ("collected_at", "published_at", "source", "keyword") if c in df.columns]


def dedup_mentions(df: DataFrame, order: list[Column | str] | None = None) -> DataFrame:
    """First row of each ``mention_id`` in ``order``.

    Without ``order`` the earliest collected row wins. Only one row per id and
    task is shuffled (WindowGroupLimit), however many copies an id has.
    """
    first = Window.partitionBy("mention_id").orderBy(*_order(df, order))
    return (
        df.withColumn("_copy", F.row_number().over(first)).filter(F.col("_copy") == 1).drop("_copy")
    )


def fill_nulls(df: DataFrame) -> DataFrame:
    out = df.withColumn("title", or_empty("title")).withColumn("text", or_empty("text"))
    if "category" in df.columns:
        out = out.withColumn("category", F.coalesce("category", F.lit("unknown")))
    return out


def ner_input(max_chars: int | None = NER_CHARS) -> Column:
    return strip(F.concat(or_empty("title"), F.lit(". "), head(or_empty("text"), max_chars)))


def clean_mentions(
    df: DataFrame,
    min_len: int = MIN_LENGTH,
    order: list[Column | str] | None = None,
    max_chars: int | None = NER_CHARS,
) -> DataFrame:
    """Deduplicate, fill nulls, add ``ner_input`` (``max_chars`` of text, None: all), drop the rows that are too short."""
    return (
        fill_nulls(dedup_mentions(df, order))
        .withColumn("ner_input", ner_input(max_chars))
        .filter(F.length("ner_input") >= min_len)
    )


def clean_report(
    df: DataFrame,
    min_len: int = MIN_LENGTH,
    order: list[Column | str] | None = None,
    max_chars: int | None = NER_CHARS,
) -> DataFrame:
    """One row: raw rows, rows after dedup, rows after the length filter."""
    # One scan and one shuffle of narrow rows: the copies of an id are counted as the first one's length is found.
    long_ = (F.length(ner_input(max_chars)) >= min_len).cast("bigint")
    rows = df.select("mention_id", long_.alias("_long"), *_narrow(df, order))
    first = Window.partitionBy("mention_id").orderBy(*_order(df, order))
    each = rows.withColumn("_copy", F.row_number().over(first))
    return each.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count(F.when(F.col("_copy") == 1, 1)).alias("deduped_rows"),
        F.sum(F.when(F.col("_copy") == 1, F.col("_long"))).alias("kept_rows"),
    )


def _narrow(df: DataFrame, order: list | None) -> list[str]:
    if order:
        named = [c for c in order if isinstance(c, str)]
        if len(named) != len(order):
            return [c for c in df.columns if c not in ("mention_id", "title", "text")]
        return [c for c in named if c not in ("mention_id", "title", "text")]
    return [c for c in ("collected_at", "published_at", "source", "keyword") if c in df.columns]
