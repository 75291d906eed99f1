"""Views over the driver tables in the shape the operators expect.

Nothing is synthesised on the driver: posts, raw collector rows, brand lists and
so on are derived from the given tables by Spark, so they grow with them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.functions import norm_text, stable_hash
from trendloom.operators.sentiment import sentiment_scores
from trendloom.plans.staging import shared_folder
from trendloom.session import configure

# Small parameters of the checks (own words picked from the synthetic texts).
LEXICON = [
    ("and", 1.2), ("of", -0.9), ("with", 1.9), ("this", -1.5), ("from", 2.1), ("er", -1.7),
    ("nd", 0.8), ("ha", -2.2), ("he", 1.4), ("ti", -1.1), ("ung", 1.3), ("keit", -1.6),
    ("mente", 1.7), ("que", -1.4), ("les", 1.1), ("ment", -1.2),
]
NEGATIONS = ["not", "the", "und", "la", "le"]
BOOSTERS = ["very", "to", "der", "el", "de"]
DAMPENERS = ["almost", "in", "die", "en", "et"]
DICTIONARY = ["with", "this", "from", "that", "ist", "und", "des", "que", "les", "pour", "de", "la", "le"]
KNOWN = ["with", "from"]
NOISE = ["this", "from", "une", "et", "du", "de", "la", "les"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a UTC timestamp whatever the Parquet annotation is."""
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def dealt(df: DataFrame, key: str) -> DataFrame:
    """Rows spread over all tasks: a given file is one row group, which one task would read and explode."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def event_posts(
    spark: SparkSession, sf_dir: str, found: DataFrame | None = None, deliveries: int | None = None, parts: int = 1
) -> DataFrame:
    """Every event with the document it discusses, and with the rows of ``found`` that have its ``event_id``.

    With ``deliveries`` the events fall into as many by their time, and what a delivery has of a document lies in one
    of ``parts`` partitions: a text is shuffled once for each delivery, not once for each event.
    """
    docs = table(spark, sf_dir, "documents")
    n = docs.count()
    if deliveries is None:
        # either side may be broadcast, and then the other one keeps its partitions
        docs = dealt(docs, "doc_id")
        keyed = dealt(events(spark, sf_dir), "event_id").withColumn("doc_id", F.pmod("event_id", F.lit(n)))
    else:
        keyed = events(spark, sf_dir).withColumn("doc_id", F.pmod("event_id", F.lit(n)))
        share = F.pmod(F.xxhash64("ts"), F.lit(deliveries)).cast("int")
        keyed = keyed.withColumn("_delivery", share).repartition(parts, "doc_id", "_delivery")
        copies = docs.withColumn("_delivery", F.explode(F.sequence(F.lit(0), F.lit(deliveries - 1))))
        return keyed.join(copies.repartition(parts, "doc_id", "_delivery"), ["doc_id", "_delivery"])
    if found is not None:
        keyed = keyed.join(found, "event_id")
    return keyed.join(docs, "doc_id")


def _title(text: Column | str = "text") -> Column:
    return F.substring(text, 1, 80)


def _body(text: Column | str = "text") -> Column:
    return F.substring(text, 81, 2_147_483_647)


def _mention() -> dict[str, Column]:
    return {
        "mention_id": stable_hash(F.lit("events"), F.lit("forum"), "event_type", _title(), _body(), "event_id"),
        "source": F.lit("events"),
        "platform": F.lit("forum"),
        "keyword": F.col("event_type"),
        "category": F.col("source"),
        "community": F.concat(F.lit("u"), F.col("user_id")),
        "title": _title(),
        "text": _body(),
        "url": F.concat(F.lit("https://example.com/p/"), F.col("event_id")),
        "published_at": F.col("ts"),
        "engagement_score": F.col("value"),
    }


def mentions(spark: SparkSession, sf_dir: str, *also: str) -> DataFrame:
    """One mention per event; ``also`` names further columns of the event."""
    return event_posts(spark, sf_dir).select(*[c.alias(name) for name, c in _mention().items()], *also)


def collected(spark: SparkSession, sf_dir: str, deliveries: int | None = None, parts: int = 1) -> DataFrame:
    """Mentions as collected over and over: the same post and keyword share an id."""
    e = event_posts(spark, sf_dir, None, deliveries, parts)
    return e.select(
        stable_hash(F.lit("events"), F.lit("forum"), "event_type", _title(), _body()).alias("mention_id"),
        F.col("event_type").alias("source"),
        F.col("source").alias("category"),
        F.concat(F.lit("u"), F.col("user_id")).alias("community"),
        _title().alias("title"),
        F.nullif(_body(), F.lit("")).alias("text"),
        F.col("ts").alias("collected_at"),
        F.col("ts").alias("published_at"),
        F.col("event_id").alias("event_id"),
    )


def rows(spark: SparkSession, data: list, columns: list[str]) -> DataFrame:
    """A handful of parameter rows, held in the plan (no Python task reads them)."""
    return spark.createDataFrame(pa.table(list(zip(*data)), names=columns))


def lexicon(spark: SparkSession) -> DataFrame:
    return rows(spark, LEXICON, ["token", "valence"])


def words(spark: SparkSession, values: list[str]) -> DataFrame:
    return rows(spark, [(w,) for w in values], ["word"])


POST_KEEP = ["category", "community", "published_at", "engagement_score"]


def posts(spark: SparkSession, sf_dir: str, extra: list[str] | None = None) -> DataFrame:
    """Mentions with level-1 sentiment.

    The narrow columns ride through the scoring. Wide ones (``extra``) would be
    repeated per word there; the scores go back to their events before those
    meet their documents, so that no text is shuffled once per post. An id holds
    its event_id, but an event may meet several documents: ids are compared then.
    """
    base = mentions(spark, sf_dir, "event_id")
    if not extra:
        return sentiment_scores(base, lexicon(spark), keep=POST_KEEP)
    scores = sentiment_scores(base, lexicon(spark), keep=[*POST_KEEP, "event_id"])
    made = _mention()
    own = made["mention_id"].alias("_own")
    found = [c for c in scores.columns if c != "event_id"]
    wide = event_posts(spark, sf_dir, scores).select(*found, own, *[made[c].alias(c) for c in extra])
    return wide.filter(F.col("_own") == F.col("mention_id")).drop("_own")


def _sources_of(docs: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """A function from ``(source, raw)`` to ``(raw, n)``: the number of sources that use each name.

    Up to 64 sources are the bits of one number, so that names meet in one shuffle; more are counted one by one.
    """
    sources = sorted(r[0] for r in docs.filter(F.col("source").isNotNull()).select("source").distinct().limit(65).collect())

    def counted(found: DataFrame) -> DataFrame:
        if not 0 < len(sources) <= 64:
            return found.distinct().groupBy("raw").agg(F.count("source").alias("n"))
        at = F.array_position(F.array(*[F.lit(s) for s in sources]), F.col("source"))
        bits = found.withColumn("_at", (at - 1).cast("int")).withColumn("_bit", F.expr("shiftleft(1L, _at)"))
        return bits.groupBy("raw").agg(F.coalesce(F.bit_count(F.bit_or("_bit")), F.lit(0)).alias("n"))

    return counted


def brand_lists(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three raw name lists: words and word pairs of some sources, and part names.

    A word is a name when 3 to 8 sources use it; ``with``, ``this`` and ``from``
    are added by frequency rules of the filters, not by hand.
    """
    docs = dealt(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), "doc_id")
    used_by = _sources_of(docs)
    head = docs.select("source", F.split(norm_text(F.concat(_title(), F.lit(" "), _body())), " ").alias("w"))
    singles = (
        used_by(
            head.select("source", F.explode(F.array_distinct("w")).alias("raw"))
            .filter(F.length("raw") >= 4)
        )
        .filter(F.col("n").between(3, 8) | F.col("raw").isin("with", "this", "from"))
    )
    pairs = (
        used_by(
            head.select(
                "source",
                F.explode(
                    F.arrays_zip(
                        F.col("w").alias("a"), F.slice("w", F.lit(2), F.greatest(F.size("w"), F.lit(1))).alias("b")
                    )
                ).alias("p"),
            )
            .filter(F.col("p.b").isNotNull())
            .select("source", F.concat_ws("-", "p.a", "p.b").alias("raw"))
        )
        .filter(F.col("n").between(2, 6))
    )
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("ordinal"), F.col("p_name").alias("raw"))

    def listed(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            F.lit(name).alias("list"),
            (F.col("ordinal") if "ordinal" in df.columns else F.lit(0).cast("bigint")).alias("ordinal"),
            "raw",
        )

    return [listed(singles, "a_words"), listed(pairs, "b_pairs"), listed(parts, "c_parts")]


def scratch(spark: SparkSession) -> str:
    """A new folder for a written table: on the shared folder where one is configured."""
    return f"{shared_folder(spark)}/checks-{uuid.uuid4().hex}"


# --- raw collector rows -----------------------------------------------------


def archive_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive posts from events: missing times, tombstones and null counters occur."""
    e = event_posts(spark, sf_dir)
    kind = F.col("event_type")
    return e.select(
        F.col("source").alias("subreddit"),
        F.when(kind == "error", F.lit(None)).otherwise(F.unix_timestamp("ts")).cast("bigint").alias("created_utc"),
        F.when(kind == "signup", F.lit(None)).otherwise(_title()).alias("title"),
        F.when(kind == "click", F.lit("[removed]"))
        .when(kind == "view", F.lit(" [deleted]\n"))
        .otherwise(_body())
        .alias("selftext"),
        F.when(kind == "purchase", F.lit(None))
        .otherwise(F.concat(F.lit("/r/p/"), F.col("event_id")))
        .alias("permalink"),
        F.when(kind == "view", F.lit(None)).otherwise(F.concat(F.lit("u"), F.col("user_id"))).alias("author"),
        F.when(kind == "click", F.lit(None)).otherwise(F.floor("value")).cast("bigint").alias("score"),
        F.col("user_id").alias("num_comments"),
    )


PAGE = 100  # consecutive events of a listing page, which discuss neighbouring documents
PART_DOCS = 200  # documents at which the pages of one part begin


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages of at most 100 consecutive events each.

    A text that many events discuss is not shuffled once per event: pages that begin at neighbouring documents
    make a part, and each part gets the texts of its documents once. Few documents are dealt to several parts.
    """
    docs = table(spark, sf_dir, "documents")
    n, tasks = max(docs.count(), 1), int(spark.conf.get("spark.sql.shuffle.partitions"))
    copies = -(-4 * tasks * PART_DOCS // n)
    first = F.pmod(F.pmod("page", F.lit(n)) * PAGE, F.lit(n))
    part = F.floor(first / PART_DOCS) * copies + F.pmod(F.xxhash64("page"), F.lit(copies))
    kind = F.col("event_type")
    event = F.struct(
        F.pmod("event_id", F.lit(n)).alias("doc_id"),
        kind.alias("kind"),
        F.unix_timestamp("ts").cast("double").alias("created_utc"),
        F.concat(F.lit("/l/"), F.col("event_id")).alias("permalink"),
        F.concat(F.lit("u"), F.col("user_id")).alias("author"),
        F.floor("value").cast("bigint").alias("score"),
        F.col("user_id").alias("num_comments"),
    )
    found = events(spark, sf_dir).filter(F.col("event_id").isNotNull())
    found = found.withColumn("page", F.floor(F.col("event_id") / PAGE)).select(part.alias("part"), "page", event.alias("e"))
    # an id may belong to several documents
    texts = dealt(docs.select("doc_id", "text"), "doc_id").groupBy("doc_id").agg(F.collect_list(F.struct("text")).alias("texts"))
    needed = found.select("part", F.col("e.doc_id").alias("doc_id")).distinct()
    held = dealt(needed.join(texts, "doc_id"), "part").groupBy("part").agg(
        F.map_from_entries(F.collect_list(F.struct("doc_id", "texts"))).alias("held")
    )
    pages = dealt(found, "part").groupBy("part", "page").agg(F.collect_list("e").alias("events")).join(held, "part")
    none = F.array().cast("array<struct<text:string>>")

    def posts_of(e: Column) -> Column:
        return F.transform(F.coalesce(F.try_element_at("held", e["doc_id"]), none), lambda d: _listed_post(e, d["text"]))

    children = F.flatten(F.transform("events", posts_of))
    return pages.select(
        F.concat(F.lit("sub"), F.col("page") % 7).alias("subreddit"),
        F.when(F.col("page") % 2 == 0, "new").otherwise("top").alias("sort"),
        F.struct(F.lit(None).cast("string").alias("after"), children.alias("children")).alias("data"),
    ).filter(F.size("data.children") > 0)


def _listed_post(e: Column, text: Column) -> Column:
    return F.struct(
        F.struct(
            e["created_utc"].alias("created_utc"),
            _title(text).alias("title"),
            F.when(e["kind"] == "click", F.lit("[removed]"))
            .when(e["kind"] == "view", F.lit(" [deleted]"))
            .otherwise(_body(text))
            .alias("selftext"),
            e["permalink"].alias("permalink"),
            e["author"].alias("author"),
            e["score"].alias("score"),
            e["num_comments"].alias("num_comments"),
            F.lit(0.5).alias("upvote_ratio"),
        ).alias("data")
    )


def feed_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entry per document; dates are ISO, RFC-822 or junk by language."""
    day = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("doc_id") % 40 * 86_400)
    d = table(spark, sf_dir, "documents").withColumn("at", day)
    return d.select(
        F.col("source").alias("community"),
        F.lit("hot").alias("sort"),
        F.col("doc_id").alias("position"),
        _title().alias("title"),
        F.col("text").alias("content"),
        F.when(F.col("lang") == "en", F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(F.col("lang") == "de", F.concat(F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))
        .when(F.col("lang") == "fr", F.date_format("at", "dd MMM yyyy HH:mm:ss 'GMT'"))
        .otherwise(F.lit("yesterday"))
        .alias("updated"),
        F.concat(F.lit("https://example.com/d/"), F.col("doc_id")).alias("link"),
        F.col("lang").alias("author"),
    )


def story_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One hit per conversation turn: first turns are stories, later ones comments."""
    c = table(spark, sf_dir, "conversations")
    first = F.col("turn") == 0
    at = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("conv_id") * 977 + F.col("turn") * 60)
    return c.select(
        F.col("role").alias("query"),
        F.concat_ws("-", "conv_id", "turn").alias("objectID"),
        F.when(first, F.substring("text", 1, 60)).otherwise(F.lit("")).alias("title"),
        F.when(first, F.lit(None)).otherwise(F.concat(F.lit("story "), F.col("conv_id"))).alias("story_title"),
        F.when(first, F.lit("")).otherwise(F.col("text")).alias("comment_text"),
        F.when(first, F.col("text")).alias("story_text"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
        F.when(first, F.concat(F.lit("https://example.com/c/"), F.col("conv_id"))).alias("url"),
        F.col("role").alias("author"),
        F.when(first, F.length("text")).cast("bigint").alias("points"),
        F.col("turn").alias("num_comments"),
        F.when(first, F.array(F.lit("story"))).otherwise(F.array(F.lit("comment"), F.lit("x"))).alias("_tags"),
    )


def news_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One item per web page, queried by the page's host."""
    p = table(spark, sf_dir, "pages")
    host = F.regexp_extract("url", r"://([^/]+)/", 1)
    return p.select(
        F.regexp_extract("url", r"\.example\.([a-z]+)/", 1).alias("query"),
        F.col("page_id").alias("position"),
        F.regexp_extract("html", r"<title>([^<]*)</title>", 1).alias("title"),
        F.col("html").alias("description"),
        F.lit("Mon, 01 Jan 2024 10:00:00 GMT").alias("pubDate"),
        F.col("url").alias("link"),
        host.alias("source"),
    )


def catalog_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog as one JSON text: nation names by region, some in two categories."""
    n = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    own = n.select(F.col("r_regionkey").alias("k"), "r_name", F.col("n_nationkey").alias("p"), "n_name")
    # the next region lists every nation of this one again, in lower case for odd keys
    again = n.join(
        table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("nr")),
        F.col("k") == F.col("n_regionkey") + 1,
    ).select(
        "k", F.col("nr").alias("r_name"), (F.col("n_nationkey") + 100).alias("p"),
        F.when(F.col("n_nationkey") % 2 == 1, F.lower("n_name")).otherwise(F.col("n_name")).alias("n_name"),
    )
    # a configuration of 5 categories and 45 names, whatever the scale
    lists = own.unionByName(again).groupBy("k", "r_name").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("p", "n_name"))), lambda s: s["n_name"]).alias("l")
    )
    return lists.agg(F.array_sort(F.collect_list(F.struct("k", "r_name", "l"))).alias("a")).select(
        F.to_json(
            F.map_from_entries(F.transform("a", lambda s: F.struct(s["r_name"], s["l"])))
        ).alias("value")
    )


# Reference texts of the relevance checks: labelled lists of own words.
CONTEXTS = [
    ("english", "the and of with this from that"),
    ("german", "der die und sch ung keit aber"),
    ("french", "de la les que des pour tion"),
    ("spanish", "el en mente los una por"),
]


def contexts(spark: SparkSession) -> DataFrame:
    return rows(spark, CONTEXTS, ["label", "text"])
