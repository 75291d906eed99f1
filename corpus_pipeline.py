"""The corpus pipeline: documents to batches for training.

Each stage takes the documents that its predecessor kept, as a stored table that
gives its rows in the same order whenever it is read, and calls one operator:

1. ``toxicity`` drops documents scored as toxic;
2. ``near_duplicates`` keeps one document of each group (five-word shingles, 0.8);
3. ``secrets`` replaces every secret in the texts;
4. ``mixing`` puts the documents into the order of a Pfair schedule, so that every
   stretch of the stored table holds the sources at their target weights;
5. ``packing`` gives each document its place in a batch, following that order.

The first four return the columns of their input. Null texts count as empty,
documents without an id are treated like all others, repeated rows are duplicates
of each other, and an empty table runs through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.llm import minhash, mixing, packing, secrets, toxicity
from trendloom.llm._common import n_words, shuffle_partitions, table
from trendloom.plans.sizing import fits_broadcast
from trendloom.plans.staging import Stage
from trendloom.session import ship_package


def _fresh(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def _numbered(spark: SparkSession, docs: DataFrame, row: str) -> DataFrame:
    """``docs`` with row numbers, stored: numbers made anew for each plan follow its file splits, which may change."""
    return Stage(spark, "numbered").write(docs.withColumn(row, F.monotonically_increasing_id()))


def _by_row(docs: DataFrame, row: str, other: DataFrame, how: str) -> DataFrame:
    """Join by row number; the other table is broadcast where it was measured to be small."""
    return docs.join(F.broadcast(other) if fits_broadcast(other) else other, row, how)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below 0.5, by a model of the labels of this input's documents."""
    ship_package(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return docs.filter(toxicity.toxicity(model, F.col("text")) < 0.5).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group that links at 0.8 connect; texts without words are no duplicates."""
    ship_package(spark)
    row = _fresh(docs, "_row")
    numbered = _numbered(spark, docs, row)
    found = minhash.near_duplicates(numbered.select(row, "text"), row)
    gone = Stage(spark, "duplicates").write(found.filter(~F.col("kept")).select(row))
    return _by_row(numbered, row, gone, "left_anti").select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced; n_chars follows where the text has changed."""
    ship_package(spark)
    new, was = _fresh(docs, "_new"), F.col("text")
    out = docs.withColumn(new, secrets.redacted(secrets.train(docs), was))
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col(new).alias("text"))
        elif c == "n_chars":
            size = F.length(new).cast(docs.schema["n_chars"].dataType)
            columns.append(F.when(F.col(new).eqNullSafe(was), F.col("n_chars")).otherwise(size).alias("n_chars"))
        else:
            columns.append(F.col(f"`{c}`"))
    return out.select(*columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, stored in the order of their slots; weights are the square roots of the sources' characters."""
    ship_package(spark)
    row, at = _fresh(docs, "_row"), _fresh(docs, "_at")
    numbered = _numbered(spark, docs, row)
    weights = mixing.root_weights(numbered, "source")
    slots = mixing.mix(numbered, [row], "source", weights, [F.col(row)])
    order = (F.col("slot") * mixing.BLOCK + F.col("place")).alias(at)
    placed = Stage(spark, "slots").write(slots.select(row, order))
    joined = _by_row(numbered, row, placed, "inner").drop(row)
    return joined.repartitionByRange(shuffle_partitions(spark), at).sortWithinPartitions(at).select(*docs.columns)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, bucket, padded_length, batch, slot, in the order in which the documents are stored."""
    ship_package(spark)
    if docs.inputFiles():
        stored = docs.metadataColumn("_metadata")
        order = [stored.getField("file_name"), stored.getField("row_index")]
    else:
        order = [F.monotonically_increasing_id()]
    return packing.pack(docs, ["doc_id"], n_words(F.col("text")) + 1, order)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_batches),
]

# Models, MinHash and the schedule of stored files are beyond SQL; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result stored and read again."""
    stage = Stage(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES:
        docs = stage.write(step(spark, docs, sf_dir))
    return docs
