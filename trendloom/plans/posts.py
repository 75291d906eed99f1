"""From collected mentions to the clustered table, one stored output per stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefns import parse_published_at
from ..operators import cluster as Z
from ..operators import vectors as E
from ..operators.clean import clean_mentions
from ..operators.sentiment import Rules, score_sentiment
from ..sources.store import materialize

STAGES = ("clean", "sentiment", "embeddings", "reduced", "clusters")


def run_stages(
    spark: SparkSession,
    raw: DataFrame | None,
    lexicon: DataFrame | None,
    base: str,
    stages: tuple[str, ...] = STAGES,
    resume: bool = False,
    *,
    rules: bool | Rules = True,
    min_samples: int = Z.MIN_SAMPLES,
    min_cluster_size: int = Z.MIN_CLUSTER_SIZE,
    eps: float | None = None,
    whole_texts: bool = False,
) -> DataFrame:
    """Run the named stages in order and return the last one's table.

    Every stage reads what the one before has stored under ``base``, so a
    single stage can be run again, and with ``resume`` finished stages are
    skipped. ``clusters`` is the sentiment table with ``cluster_id``. By default the
    stages read the first 400 or 500 characters of a text; ``whole_texts`` makes all
    of them read texts to their end.
    """
    unknown = set(stages) - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages {sorted(unknown)}")

    chars = {"max_chars": None} if whole_texts else {}

    def stored(stage: str) -> DataFrame:
        return spark.read.parquet(f"{base}/{stage}")

    def clean() -> DataFrame:
        out = clean_mentions(raw, **chars)
        if dict(out.dtypes)["published_at"] == "string":
            out = out.withColumn("published_at", parse_published_at("published_at"))
        return out

    def sentiment() -> DataFrame:
        return score_sentiment(stored("clean"), lexicon, rules=rules, **chars)

    def embeddings() -> DataFrame:
        return E.embed_text(stored("sentiment"), **chars)

    def reduced() -> DataFrame:
        return E.reduce_dims(stored("embeddings")).select("mention_id", "reduced")

    def clusters() -> DataFrame:
        labels = Z.density_cluster(
            stored("reduced"), min_samples, min_cluster_size, eps, id_col="mention_id"
        )
        return Z.attach_clusters(stored("sentiment"), labels)

    work = {"clean": clean, "sentiment": sentiment, "embeddings": embeddings,
            "reduced": reduced, "clusters": clusters}
    out = None
    for stage in STAGES:
        if stage in stages:
            out = materialize(work[stage], f"{base}/{stage}", resume, spark=spark)
    return out


def cluster_report(clustered: DataFrame) -> DataFrame:
    """Summary of the clustered table (one row)."""
    return Z.cluster_summary(clustered.select(F.col("cluster_id")))
