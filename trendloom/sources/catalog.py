"""Category catalog: which category a community belongs to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_SHAPE = "map<string,array<string>>"


def read_catalog(
    spark: SparkSession, path: str, field: str = "", priority: list[str] | None = None
) -> DataFrame:
    """Catalog from a JSON file; ``field`` is the dotted path of the object in it."""
    return load_catalog(spark.read.text(path, wholetext=True), priority, field)


def load_catalog(
    texts: DataFrame, priority: list[str] | None = None, field: str = "", column: str = "value"
) -> DataFrame:
    """``(category, community, ordinal)`` from a JSON object of community lists.

    Priority categories come first, the others in file order. A community in
    several categories keeps the first; spellings are compared case-sensitively.
    """
    text = F.col(column)
    if field:
        text = F.get_json_object(text, "$." + field)
    return catalog_rows(
        texts.select(F.posexplode(F.from_json(text, _SHAPE)).alias("cat_pos", "category", "communities"))
        .select("cat_pos", "category", F.posexplode("communities").alias("pos", "community")),
        priority,
    )


def catalog_rows(entries: DataFrame, priority: list[str] | None = None) -> DataFrame:
    """The same from flat rows ``(cat_pos, category, pos, community)``."""
    wanted = list(priority or [])
    place = F.lit(len(wanted))
    for i, name in reversed(list(enumerate(wanted))):
        place = F.when(F.col("category") == name, F.lit(i)).otherwise(place)
    first = Window.partitionBy("community").orderBy("_place", "cat_pos", "pos")
    order = Window.orderBy("_place", "cat_pos", "pos")
    # The ordinal numbers the whole catalog, which is a configuration of a few
    # thousand rows at most.
    return (
        entries.withColumn("_place", place)
        .withColumn("_n", F.row_number().over(first))
        .filter(F.col("_n") == 1)
        .withColumn("ordinal", F.row_number().over(order).cast("bigint"))
        .select("category", "community", "ordinal")
    )
