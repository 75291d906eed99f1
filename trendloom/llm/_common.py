"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendloom.plans.staging import Stage

# White space of a word, and what is not.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: Column) -> Column:
    """A null text counts as empty."""
    return F.coalesce(column.cast("string"), F.lit(""))


def lower_ascii(column: Column) -> Column:
    return F.translate(column, UPPER, UPPER.lower())


def n_words(text: Column) -> Column:
    """Words of a text, counted without making them: a word starts where white space or the text's start ends."""
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("long")


def in_fold(id_column: Column, of: int, remainder: int) -> Column:
    """crc32(id as text) mod ``of`` is ``remainder``; a null id counts as the empty text."""
    return (F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % of) == remainder


def bin_edge(value: Column) -> Column:
    """Upper edge of a whole number's bin: exact up to 128, then 64 bins per doubling."""
    step = F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(F.length(F.bin(value)) - 7, F.lit(0)))
    return F.when(value <= 128, value).otherwise(F.ceil(value / step).cast("long") * step)


def most_frequent(rows: DataFrame, count: str, bound: int) -> DataFrame:
    """The rows from some count upwards, as many as fit into ``bound``; counts are told apart by their bins."""
    edge = bin_edge(F.col(count))
    sizes = rows.groupBy(edge.alias("e")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("e")).collect()
    least, held = None, 0
    for r in sizes:
        held += r.n
        if held > bound:
            break
        least = r.e
    return rows.filter(F.lit(False) if least is None else edge >= least)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(stage: Stage, rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``rows`` with ``_rank``: the number of rows before a row in its group.

    No task holds a group: rows are sorted in ranges over (group, order), so a
    group that has a third of all rows lies in a third of the tasks. Each range
    counts what it has of a group, and the counts of the ranges before it (one
    row per range and group) are added. Rows that tie in everything are told apart by their
    place in the staged table.
    """
    spark = rows.sparkSession
    n = shuffle_partitions(spark)
    given = stage.write(rows.withColumn("_seq", F.monotonically_increasing_id()))
    keys = [*group, *order, "_seq"]
    placed = given.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    placed = stage.write(
        placed.withColumn("_at", F.monotonically_increasing_id()).withColumn(
            "_part", F.shiftright(F.col("_at"), 33).cast("int")
        )
    )
    sums = stage.write(
        placed.groupBy("_part", *group).agg(F.count(F.lit(1)).alias("_sum"), F.min("_at").alias("_first"))
    )
    # One row per range and group: at most ranges + groups rows, so the running sums are small.
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("_part").alias("_p"),
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"),
        "_first",
    )
    same = F.col("_part") == F.col("_p")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    joined = placed.join(F.broadcast(offsets), same)
    rank = F.col("_before") + F.col("_at") - F.col("_first")
    return joined.withColumn("_rank", rank).select(*rows.columns, "_rank")
