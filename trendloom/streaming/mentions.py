"""Incremental ingest and running weekly counts as streams over landed files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from ..functions.timefns import event_time as parsed_time
from ..operators.clean import dedup_mentions
from ..operators.ingest import ingest_new
from ..schema import MENTIONS
from ..sources.store import append_mentions, exists

# Posts that arrive later than this after the newest one are left out of the
# running weekly counts.
LATE_BY = "14 days"


def read_mention_stream(
    spark: SparkSession,
    path: str,
    schema: StructType = MENTIONS,
    fmt: str = "parquet",
    max_files: int = 1000,
) -> DataFrame:
    """Landed mention files as a stream, at most ``max_files`` per micro-batch."""
    return (
        spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", max_files).load(path)
    )


def stream_mentions(
    source: DataFrame,
    store: str,
    checkpoint: str,
    order: list[Column | str] | None = None,
) -> DataStreamWriter:
    """A writer that appends every ``mention_id`` to ``store`` exactly once.

    Each micro-batch keeps the first row of an id and drops the ids that the
    store holds. There is no watermark: it would lose posts that land late, and
    the store itself already remembers every id. A micro-batch that is run
    again after a failure finds its rows stored and adds nothing.
    """

    def add(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        # Read three times: measured and joined with the store by its ids alone, then written. Rows are not kept
        # meanwhile, as their texts would be copied to disk.
        if exists(spark, store):
            fresh = ingest_new(batch, spark.read.schema(MENTIONS).parquet(store), order)
        else:
            fresh = dedup_mentions(batch, order)
        append_mentions(fresh, store)

    return source.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)


def stream_weekly(
    source: DataFrame, event_time: str = "published_at", late_by: str = LATE_BY
) -> DataFrame:
    """Running mentions per Monday week and category.

    Epoch day 0 is a Thursday, so weeks that start on Monday are seven-day
    windows offset by four days. State is one row per open week and category.
    Dates may be timestamps or the texts that records hold; rows without a known
    date belong to no week. In append mode a week comes out once, when the
    watermark has passed its end; in update mode with every change.
    """
    week = F.window(F.col(event_time), "7 days", startTime="4 days")
    return (
        source.filter(F.col("category").isNotNull())
        .withColumn(event_time, parsed_time(source, event_time))
        .filter(F.col(event_time).isNotNull())
        .withWatermark(event_time, late_by)
        .groupBy(week.alias("w"), "category")
        .agg(F.count("mention_id").alias("mentions"))
        .select(F.date_format("w.start", "yyyy-MM-dd").alias("week"), "category", "mentions")
    )
