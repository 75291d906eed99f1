"""Each stage on its own input, and the whole run against plain counts."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    rows, labels = [], []
    for i in range(160):
        words = [f"word{(i * 37 + k * 11) % 997}" for k in range(30)]
        if i % 4 == 0:
            words[3:3] = ["gromphing", "vexling"]
        labels.append((i, int(i % 4 == 0), 1))
        rows.append((i, " ".join(words), "en", "big" if i % 3 else "small", len(" ".join(words))))
    rows += [
        (500, rows[1][1] + " extra", "en", "small", 5), (501, rows[1][1], "en", None, 5), (None, rows[2][1], "en", "big", 5),
        (502, None, None, "big", None), (503, "", "en", "big", 0), (504, "my password=abcdef123 ok", "en", "big", 24),
        (505, "AA " * 9000, "en", "big", 27000), (505, "AA " * 9000, "en", "big", 27000),
    ]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{path}/labels.parquet")
    return path


def stored(spark, df, tmp_path, name):
    df.write.parquet(str(tmp_path / name))
    return spark.read.parquet(str(tmp_path / name))


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    kept = stored(spark, P.drop_toxic(spark, docs, folder), tmp_path, "1")
    assert kept.columns == columns
    gone = {r.doc_id for r in docs.collect()} - {r.doc_id for r in kept.collect()}
    assert gone == {i for i in range(160) if i % 4 == 0} and kept.count() == docs.count() - 40
    single = stored(spark, P.drop_near_duplicates(spark, kept, folder), tmp_path, "2")
    assert single.columns == columns
    left = Counter(r.doc_id for r in single.collect())
    assert left[1] + left[500] + left[501] == 1 and left[2] + left[None] == 1 and left[505] == 1
    assert left[502] == left[503] == left[504] == 1 and single.count() == kept.count() - 4
    safe = stored(spark, P.redact_secrets(spark, single, folder), tmp_path, "3")
    assert safe.columns == columns and safe.count() == single.count()
    rows = {r.doc_id: r for r in safe.collect()}
    assert rows[504].text == "my [secret] ok" and rows[504].n_chars == 14 and rows[502].text is None
    assert safe.join(single, "doc_id").filter(safe["text"] == single["text"]).count() >= single.count() - 3
    mixed = stored(spark, P.mix_sources(spark, safe, folder), tmp_path, "4")
    assert mixed.columns == columns
    assert Counter(map(str, mixed.collect())) == Counter(map(str, safe.collect()))
    packed = P.pack_batches(spark, mixed, folder)
    assert Counter(r.doc_id for r in packed.collect()) == Counter(r.doc_id for r in mixed.collect())
    # inside a bucket the batches follow the stored order
    at = mixed.select("doc_id", F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("i"))
    placed = packed.join(at, "doc_id").filter("bucket = 0").orderBy("f", "i").collect()
    assert [(r.batch, r.slot) for r in placed] == sorted((r.batch, r.slot) for r in placed)


def test_stages_on_nothing_and_on_clashing_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, docs, folder).count() == 0
    clash = spark.read.parquet(f"{folder}/documents.parquet").withColumn("_row", F.lit(1)).withColumn("_new", F.lit("x")).withColumn("_at", F.lit(2))
    for _, stage in P.STAGES[2:4]:
        out = stage(spark, clash, folder)
        assert out.columns == clash.columns and out.count() == clash.count()


def test_row_numbers_outlive_other_file_splits(spark, folder, monkeypatch):
    """As when an executor comes or goes: the join packs the files otherwise than what found the rows."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    join = P._by_row

    def repacked(*given):
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
        return join(*given)

    monkeypatch.setattr(P, "_by_row", repacked)
    kept = {}
    for stage in (P.drop_near_duplicates, P.mix_sources):
        try:
            kept[stage] = Counter(map(str, stage(spark, docs, folder).collect()))
        finally:
            spark.conf.unset("spark.sql.files.openCostInBytes")
            spark.conf.unset("spark.sql.files.minPartitionNum")
    assert kept[P.mix_sources] == Counter(map(str, docs.collect()))
    left = Counter(r.split("doc_id=")[1].split(",")[0] for r in kept[P.drop_near_duplicates].elements())
    assert left["1"] + left["500"] + left["501"] == 1 and left["2"] + left["None"] == 1 and left["505"] == 1
    assert all(left[str(i)] == 1 for i in (0, 3, 502, 503, 504)) and sum(left.values()) == docs.count() - 4


def test_run(spark, folder):
    out = P.run(spark, folder)
    assert out.columns == ["doc_id", "n_tokens", "bucket", "padded_length", "batch", "slot"]
    assert out.count() == 168 - 40 - 4
