"""Files that a query lands: as many as tasks, and no larger than they need be."""

import glob

from checks import views as V
from checks.registry import QUERIES

SF = "/root/testdata/sf0.001"


def test_landed_files_are_many_and_share_ids(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "s")
    monkeypatch.setattr(V, "scratch", lambda _: base)
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        stored = QUERIES["stream_mentions"](spark, SF)
        assert stored.count() == stored.distinct().count() == V.collected(spark, SF).select("mention_id").distinct().count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(glob.glob(base + "/landed/*.parquet")) > 3
    assert 1 < len(glob.glob(base + "/state/commits/[0-9]*")) <= 4


def test_csv_is_written_compressed_on_request(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "c")
    monkeypatch.setattr(V, "scratch", lambda _: base)
    assert QUERIES["mentions_csv"](spark, SF).count() == QUERIES["archive_posts"](spark, SF).count()
    assert glob.glob(base + "/csv/*.csv.gz")


def test_texts_are_shuffled_once_for_a_delivery_and_batches_are_not_kept(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrame
    from pyspark.sql import functions as F

    kept = []
    monkeypatch.setattr(DataFrame, "persist", lambda df, *a: kept.append(df) or df)
    delivered = V.collected(spark, SF, deliveries=3, parts=6)
    assert sorted(map(str, delivered.collect())) == sorted(map(str, V.collected(spark, SF).collect()))
    share = F.pmod(F.xxhash64("collected_at"), F.lit(3))
    placed = delivered.withColumn("_p", F.spark_partition_id())
    n = V.table(spark, SF, "documents").count()
    places = placed.groupBy((F.col("event_id") % n).alias("doc"), share.alias("d")).agg(F.count_distinct("_p").alias("n"))
    found = places.groupBy().agg(F.max("n"), F.count_distinct("doc"), F.count("*")).first()
    assert found[0] == 1 and found[2] > found[1]
    monkeypatch.setattr(V, "scratch", lambda _: str(tmp_path / "s"))
    assert QUERIES["stream_mentions"](spark, SF).count() == delivered.select("mention_id").distinct().count()
    assert not kept
