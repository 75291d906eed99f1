"""Registered queries and their SQL, in the order of the operator inventory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom import functions as X
from trendloom.operators import board as D
from trendloom.operators import brands as B
from trendloom.operators import clean as K
from trendloom.operators import cluster as Z
from trendloom.operators import ingest as G
from trendloom.operators import knn as J
from trendloom.operators import quality as Q
from trendloom.operators import relevance as L
from trendloom.operators import series as S
from trendloom.operators import sentiment as C
from trendloom.operators import trends as R
from trendloom.operators import vectors as E
from trendloom.operators import windows as W
from trendloom.plans import dashboard as P
from trendloom.sources import catalog as A
from trendloom.sources import raw as N
from trendloom.sources import store as T
from trendloom.streaming import mentions as M

from . import oracle as O
from . import views as V

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def _r6(*cols: str):
    """Unrounded means are compared at six decimals (summation order differs)."""
    from trendloom.functions import np_round

    return [np_round(c, 6).alias(c) for c in cols]


def _o6(*cols: str) -> str:
    return ", ".join(f"{O.rnd(c, 6)} AS {c}" for c in cols)


def _ts(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)


def _ots(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f') AS {c}"


# --- windows and trends -----------------------------------------------------


@register(
    "biweekly_windows",
    O.sql(
        "SELECT window_id, strftime(cur_start, '%m/%d') || '–' || strftime(cur_end, '%m/%d') AS window_label, "
        + ", ".join(_ots(c) for c in ("cur_start", "cur_end", "prev_start", "prev_end"))
        + " FROM windows",
        "windows",
    ),
)
def biweekly_windows(spark, sf):
    w = W.biweekly_windows(V.mentions(spark, sf))
    return w.select(
        "window_id", "window_label", *[_ts(c) for c in ("cur_start", "cur_end", "prev_start", "prev_end")]
    )


@register(
    "window_membership",
    O.sql("SELECT window_id, side, mention_id FROM sides", "sides"),
)
def window_membership(spark, sf):
    m = V.mentions(spark, sf).select("mention_id", "published_at")
    return W.assign_windows(m, W.find_anchor(V.events(spark, sf), "ts")).select("window_id", "side", "mention_id")


def _anchor(spark, sf):
    """The posts are one per event, so the newest event is the anchor."""
    return W.find_anchor(V.events(spark, sf), "ts")


@register(
    "period_stats",
    O.sql(
        f"SELECT window_id, side, category, mentions, communities, {_o6('mean_sentiment', 'mean_engagement')} FROM periods",
        "periods",
    ),
)
def period_stats(spark, sf):
    return R.period_stats(V.posts(spark, sf), _anchor(spark, sf)).select(
        "window_id", "side", "category", "mentions", "communities", *_r6("mean_sentiment", "mean_engagement")
    )


_MEANS = ["mean_sentiment", "mean_engagement", "mean_sentiment_p", "mean_engagement_p"]
_STATS = [
    "window_id", "category", "current_mentions", "current_communities", "previous_mentions", "communities_p",
    "spike_ratio", "normalized_spike", "cross_community", "sentiment_score", "eng_momentum",
    "eng_momentum_norm", "trend_score", "trend_direction", "mentions_delta",
]


@register(
    "category_trends",
    O.sql(f"SELECT {', '.join(_STATS)}, {_o6(*_MEANS)} FROM stats", "stats"),
)
def category_trends(spark, sf):
    return _stats(spark, sf).select(*_STATS, *_r6(*_MEANS))


@register(
    "weekly_breakdown",
    O.sql(
        f"""SELECT w.window_id, category, strftime(date_trunc('week', published_at), '%Y-%m-%d') AS week,
        count(mention_id) AS mentions, {O.rnd(O.mean('sentiment_compound'), 6)} AS mean_sentiment
        FROM posts p JOIN windows w ON p.published_at >= w.prev_start AND p.published_at < w.cur_end
        GROUP BY ALL""",
        "posts", "windows",
    ),
)
def weekly_breakdown(spark, sf):
    return S.weekly_breakdown(V.posts(spark, sf), _anchor(spark, sf)).select(
        "window_id", "category", "week", "mentions", *_r6("mean_sentiment")
    )


@register("sample_posts", O.sql("SELECT * FROM samples", "samples"))
def sample_posts(spark, sf):
    return S.sample_posts(V.posts(spark, sf, ["title", "url"]), _anchor(spark, sf))


# --- sentiment --------------------------------------------------------------


@register(
    "sentiment_scores",
    O.sql(
        "SELECT mention_id, sentiment_compound, sentiment_positive, sentiment_negative, sentiment_neutral, "
        "sentiment_label FROM posts",
        "posts",
    ),
)
def sentiment_scores(spark, sf):
    scored = C.score_sentiment(V.mentions(spark, sf), V.lexicon(spark))
    return scored.select(
        "mention_id", "sentiment_compound", "sentiment_positive", "sentiment_negative",
        "sentiment_neutral", "sentiment_label",
    )


@register(
    "sentiment_summary",
    O.sql(
        f"SELECT sentiment_label, count(*) AS mentions, {O.rnd(O.mean('sentiment_compound'), 6)} AS mean_compound "
        "FROM posts GROUP BY 1",
        "posts",
    ),
)
def sentiment_summary(spark, sf):
    return C.sentiment_summary(V.posts(spark, sf)).select("sentiment_label", "mentions", *_r6("mean_compound"))


# --- brands -----------------------------------------------------------------


def _whitelist(spark, sf):
    return B.build_whitelist(
        B.brand_entries(V.brand_lists(spark, sf)),
        V.words(spark, V.DICTIONARY), V.words(spark, V.KNOWN), V.words(spark, V.NOISE),
    )


@register(
    "brand_entries",
    O.sql(
        "SELECT list, ordinal::BIGINT AS ordinal, trim(raw) AS raw FROM entries "
        "WHERE trim(raw) NOT IN ('', 'nan', 'brand_name')",
        "entries",
    ),
)
def brand_entries(spark, sf):
    return B.brand_entries(V.brand_lists(spark, sf))


@register("brand_whitelist", O.sql("SELECT norm, display FROM whitelist", "whitelist"))
def brand_whitelist(spark, sf):
    return _whitelist(spark, sf)


@register("brand_hits", O.sql("SELECT mention_id, brand FROM hits", "hits"))
def brand_hits(spark, sf):
    from trendloom.session import staged

    return B.extract_brands(V.mentions(spark, sf), staged(_whitelist(spark, sf)))


def _brands(spark, sf):
    from trendloom.session import staged

    return B.brand_stats(
        V.posts(spark, sf, ["title", "text"]), staged(_whitelist(spark, sf)), _anchor(spark, sf)
    )


_BRANDS = "window_id, category, brand, cur_mentions, prev_mentions, brand_spike, avg_sentiment"


@register("brand_trends", O.sql(f"SELECT {_BRANDS}, rank FROM brands", "brands"))
def brand_trends(spark, sf):
    return _brands(spark, sf)


@register(
    "top_brands",
    O.sql(
        "SELECT window_id, category, string_agg(brand, '|' ORDER BY rank) AS top_brands FROM brands "
        "WHERE rank <= 20 GROUP BY ALL",
        "brands",
    ),
)
def top_brands(spark, sf):
    return B.top_brands(_brands(spark, sf)).withColumn("top_brands", F.array_join("top_brands", "|"))


def flagship(spark, sf):
    """Trend scores of the newest window, in score order."""
    stats = _stats(spark, sf)
    return R.in_score_order(stats.filter(F.col("window_id") == 0))


# --- dashboard queries ------------------------------------------------------


def _stats(spark, sf):
    categories = V.mentions(spark, sf).select("category")
    return R.category_trends(V.posts(spark, sf), _anchor(spark, sf), categories=categories)


def _newest(spark, sf):
    return D.select_window(_stats(spark, sf))


@register(
    "select_window",
    O.sql(
        """SELECT s.window_id, category, trend_score FROM stats s JOIN windows w USING (window_id)
        WHERE strftime(cur_start, '%m/%d') || '–' || strftime(cur_end, '%m/%d') =
          (SELECT strftime(cur_start, '%m/%d') || '–' || strftime(cur_end, '%m/%d') FROM windows WHERE window_id = 1)""",
        "stats", "windows",
    ),
)
def select_window(spark, sf):
    windows = W.biweekly_windows(V.events(spark, sf), ts="ts")
    label = windows.filter("window_id = 1").first()["window_label"]
    return D.select_window(_stats(spark, sf), windows, label).select("window_id", "category", "trend_score")


@register(
    "filter_directions",
    O.sql(
        "SELECT window_id, category, trend_direction FROM stats WHERE trend_direction IN ('rising', 'declining')",
        "stats",
    ),
)
def filter_directions(spark, sf):
    return D.filter_directions(_stats(spark, sf), ["rising", "declining"]).select(
        "window_id", "category", "trend_direction"
    )


@register(
    "trend_direction_kpis",
    O.sql(
        "SELECT count(*) AS active_categories, "
        + ", ".join(
            f"count(*) FILTER (trend_direction = '{d}') AS {d}_n, "
            + O.rnd(f"count(*) FILTER (trend_direction = '{d}') / count(*)", 4) + f" AS {d}_share"
            for d in ("rising", "stable", "declining")
        )
        + " FROM newest",
        "newest",
    ),
)
def trend_direction_kpis(spark, sf):
    return D.direction_kpis(_newest(spark, sf))


@register(
    "top_categories",
    O.sql("SELECT category, trend_score FROM newest ORDER BY trend_score DESC, category LIMIT 10", "newest"),
)
def top_categories(spark, sf):
    return D.top_categories(_newest(spark, sf), 10).select("category", "trend_score")


@register(
    "quadrants",
    O.sql(
        """SELECT category, normalized_spike, cross_community,
        CASE WHEN normalized_spike >= 0.5 AND cross_community >= 0.5 THEN 'high_priority'
          WHEN cross_community >= 0.5 THEN 'broad_low_heat' WHEN normalized_spike >= 0.5 THEN 'local_spike'
          ELSE 'low_priority' END AS quadrant FROM newest""",
        "newest",
    ),
)
def quadrants(spark, sf):
    return D.with_quadrant(_newest(spark, sf)).select(
        "category", "normalized_spike", "cross_community", "quadrant"
    )


_BOARD = """(SELECT *, (row_number() OVER (ORDER BY normalized_spike DESC, trend_score DESC, category))::INTEGER AS position
  FROM newest QUALIFY position <= 6)"""


@register(
    "spike_board",
    O.sql(f"SELECT position, category, normalized_spike, spike_ratio, current_mentions FROM {_BOARD}", "newest"),
)
def spike_board(spark, sf):
    return D.spike_board(_newest(spark, sf)).select(
        "position", "category", "normalized_spike", "spike_ratio", "current_mentions"
    )


@register(
    "spike_board_brands",
    O.sql(
        f"""SELECT position, category, rank, brand, cur_mentions, prev_mentions
        FROM {_BOARD} JOIN brands USING (window_id, category) WHERE rank <= 10""",
        "newest", "brands",
    ),
)
def spike_board_brands(spark, sf):
    return D.spike_board_brands(_newest(spark, sf), _brands(spark, sf))


@register(
    "category_card",
    O.sql(
        f"""SELECT category, trend_score, trend_direction, spike_ratio, current_mentions, {_o6('mean_sentiment')},
        CASE WHEN mean_sentiment >= 0.05 THEN 'positive' WHEN mean_sentiment >= -0.05 THEN 'neutral'
          ELSE 'negative' END AS sentiment_word, eng_momentum, current_communities
        FROM newest ORDER BY trend_score DESC, category LIMIT 1""",
        "newest",
    ),
)
def category_card(spark, sf):
    card = D.category_card(_newest(spark, sf))
    return card.withColumn("mean_sentiment", *_r6("mean_sentiment"))


@register(
    "brand_panel",
    O.sql(
        f"""SELECT category, rank, brand, cur_mentions, prev_mentions, avg_sentiment,
        CASE WHEN avg_sentiment >= 0.05 THEN 'pos' WHEN avg_sentiment <= -0.05 THEN 'neg' ELSE 'neu' END AS sentiment_class,
        {O.rnd('cur_mentions / CASE prev_mentions WHEN 0 THEN 1 ELSE prev_mentions END', 2)} AS b_spike
        FROM brands WHERE window_id = 0 AND rank <= 15""",
        "brands",
    ),
)
def brand_panel(spark, sf):
    return D.brand_panel(D.select_window(_brands(spark, sf)))


@register(
    "brand_deltas",
    O.sql(
        """SELECT category, brand, cur_mentions, prev_mentions, cur_mentions - prev_mentions AS delta,
        CASE WHEN cur_mentions > prev_mentions THEN 'rising' ELSE 'declining' END AS delta_class
        FROM brands WHERE window_id = 0 AND rank <= 15""",
        "brands",
    ),
)
def brand_deltas(spark, sf):
    return D.brand_deltas(D.select_window(_brands(spark, sf)))


@register(
    "post_preview",
    O.sql(
        """SELECT category, rank AS position, title, community, engagement_score, sentiment_label, url
        FROM samples WHERE window_id = 0 AND rank <= 4""",
        "samples",
    ),
)
def post_preview(spark, sf):
    samples = S.sample_posts(V.posts(spark, sf, ["title", "url"]), _anchor(spark, sf))
    return D.post_preview(D.select_window(S.sample_post_lists(samples)))


@register(
    "summary_table",
    O.sql(
        f"""SELECT category, trend_direction, trend_score, spike_ratio, current_mentions, {_o6('mean_sentiment')},
        CASE WHEN mean_sentiment >= 0.05 THEN 'pos' WHEN mean_sentiment <= -0.05 THEN 'neg' ELSE 'neu' END AS sentiment_class,
        abs(mentions_delta) AS delta_size, CASE WHEN mentions_delta >= 0 THEN 'up' ELSE 'down' END AS delta_direction
        FROM newest ORDER BY trend_score DESC, category LIMIT 20""",
        "newest",
    ),
)
def summary_table(spark, sf):
    out = D.summary_table(_newest(spark, sf))
    return out.withColumn("mean_sentiment", *_r6("mean_sentiment"))


# --- cleaning and ingest ----------------------------------------------------

_FIRST = "QUALIFY row_number() OVER (PARTITION BY mention_id ORDER BY collected_at, event_id) = 1"
_ORDER = ["collected_at", "event_id"]
_NER = O.strip("title || '. ' || left(coalesce(text, ''), 400)")


@register("dedup_mentions", O.sql(f"SELECT mention_id, event_id, category FROM collected {_FIRST}", "collected"))
def dedup_mentions(spark, sf):
    return K.dedup_mentions(V.collected(spark, sf), _ORDER).select("mention_id", "event_id", "category")


@register(
    "clean_mentions",
    O.sql(
        f"""SELECT mention_id, event_id, category, title, coalesce(text, '') AS text, {_NER} AS ner_input
        FROM (SELECT * FROM collected {_FIRST}) WHERE length({_NER}) >= 10""",
        "collected",
    ),
)
def clean_mentions(spark, sf):
    return K.clean_mentions(V.collected(spark, sf), order=_ORDER).select(
        "mention_id", "event_id", "category", "title", "text", "ner_input"
    )


@register(
    "clean_report",
    O.sql(
        f"""SELECT (SELECT count(*) FROM collected) AS raw_rows, count(*) AS deduped_rows,
        count(*) FILTER (length({_NER}) >= 10) AS kept_rows FROM (SELECT * FROM collected {_FIRST})""",
        "collected",
    ),
)
def clean_report(spark, sf):
    return K.clean_report(V.collected(spark, sf), order=_ORDER)


@register("stable_hash", O.sql("SELECT mention_id, published_at::VARCHAR AS at FROM mentions", "mentions"))
def stable_hash(spark, sf):
    m = V.mentions(spark, sf)
    # DuckDB prints the shortest fraction, as the cast to string does here
    return m.select("mention_id", F.col("published_at").cast("string").alias("at"))


_CUT = "2024-01-15"


@register(
    "incremental_ingest",
    O.sql(
        f"""SELECT mention_id, event_id FROM (SELECT * FROM collected WHERE published_at >= '{_CUT}' {_FIRST})
        WHERE mention_id NOT IN (SELECT mention_id FROM collected WHERE published_at < '{_CUT}')""",
        "collected",
    ),
)
def incremental_ingest(spark, sf):
    rows = V.collected(spark, sf)
    cut = F.to_timestamp(F.lit(_CUT))
    return G.ingest_new(
        rows.filter(F.col("published_at") >= cut), rows.filter(F.col("published_at") < cut), _ORDER
    ).select("mention_id", "event_id")


@register(
    "append_mentions",
    O.sql(
        "SELECT mention_id, count(*) AS copies FROM collected GROUP BY 1",
        "collected",
    ),
)
def append_mentions(spark, sf):
    """Two appends to one store, read back."""
    rows = V.collected(spark, sf)
    cut = F.to_timestamp(F.lit(_CUT))
    path = V.scratch(spark) + "/mentions"
    for part in (rows.filter(F.col("published_at") < cut), rows.filter(F.col("published_at") >= cut)):
        T.append_mentions(_as_mentions(part), path)
    stored = spark.read.parquet(path)
    return stored.groupBy("mention_id").agg(F.count(F.lit(1)).alias("copies"))


def _as_mentions(part):
    """The rows in the stored schema, with the ids they have."""
    from trendloom.schema import MENTIONS

    given = set(part.columns)
    return part.select(
        *[
            (F.col(f.name) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in MENTIONS.fields
        ]
    )


@register(
    "ingest_summary",
    O.sql(
        """SELECT source, community, n AS new_rows,
        sum(n) OVER (PARTITION BY source ORDER BY community)::BIGINT AS running_total
        FROM (SELECT source, community, count(*) AS n FROM collected GROUP BY ALL)""",
        "collected",
    ),
)
def ingest_summary(spark, sf):
    return G.ingest_summary(V.collected(spark, sf))


@register(
    "cap_per_group",
    O.sql(
        """SELECT category, event_id FROM collected
        QUALIFY row_number() OVER (PARTITION BY category ORDER BY published_at DESC, event_id) <= 20
        ORDER BY published_at DESC, event_id LIMIT 150""",
        "collected",
    ),
)
def cap_per_group(spark, sf):
    rows = V.collected(spark, sf)
    return G.cap_per_group(
        rows, "category", 20, 150, order=[F.desc("published_at"), F.asc("event_id")]
    ).select("category", "event_id")


# --- collector rows ---------------------------------------------------------

_RECORD = [c.strip() for c in O.RECORD_COLUMNS.split(",")]


@register("archive_posts", O.records(O.ARCHIVE, "ev"))
def archive_posts(spark, sf):
    raw = V.archive_posts(spark, sf)
    return G.make_mentions(N.normalize_archive_posts(raw, "2024-01-10")).select(*_RECORD)


@register("listing_posts", O.records(O.LISTING, "ev"))
def listing_posts(spark, sf):
    pages = V.listing_pages(spark, sf)
    return G.make_mentions(N.normalize_listing_posts(pages, "2024-01-05")).select(*_RECORD)


@register("feed_entries", O.records(O.FEED))
def feed_entries(spark, sf):
    raw = V.feed_entries(spark, sf)
    return G.make_mentions(N.normalize_feed_entries(raw, "2024-01-10")).select(*_RECORD)


@register("story_hits", O.records(O.STORIES))
def story_hits(spark, sf):
    raw = V.story_hits(spark, sf)
    return G.make_mentions(N.normalize_story_hits(raw, "2024-01-01", "2024-01-03")).select(*_RECORD)


@register("news_items", O.records(O.NEWS))
def news_items(spark, sf):
    return G.make_mentions(N.normalize_news_items(V.news_items(spark, sf))).select(*_RECORD)


@register("mentions_csv", O.records(O.ARCHIVE, "ev"))
def mentions_csv(spark, sf):
    """Records written as CSV and read back: quotes, line breaks and empty texts survive."""
    made = G.make_mentions(N.normalize_archive_posts(V.archive_posts(spark, sf), "2024-01-10"))
    path = V.scratch(spark) + "/csv"
    T.write_mentions_csv(made, path, compression="gzip")
    return T.read_mentions_csv(spark, path).select(*_RECORD)


@register(
    "category_catalog", O.sql("SELECT category, community, ordinal FROM catalog", "catalog")
)
def category_catalog(spark, sf):
    return A.load_catalog(V.catalog_text(spark, sf), ["EUROPE", "ASIA"])


@register(
    "with_category",
    O.sql(
        """SELECT c_custkey, c_nationkey AS nation, coalesce(category, 'none') AS category
        FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN catalog ON community = n_name""",
        "catalog",
    ),
)
def with_category(spark, sf):
    catalog = A.load_catalog(V.catalog_text(spark, sf), ["EUROPE", "ASIA"])
    people = V.table(spark, sf, "customer").join(
        V.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    named = people.select("c_custkey", F.col("c_nationkey").alias("nation"), F.col("n_name").alias("community"))
    return G.with_category(named, catalog, "none").select("c_custkey", "nation", "category")


# --- scalar functions -------------------------------------------------------


@register(
    "parse_published_at",
    """SELECT o_orderkey, strftime(CASE left(o_orderpriority, 1) WHEN '3' THEN t - INTERVAL 2 HOUR
      WHEN '4' THEN NULL ELSE t END, '%Y-%m-%d %H:%M:%S.%f') AS published_at
    FROM (SELECT *, o_orderdate + INTERVAL 1 SECOND * (o_orderkey % 86400)
            + CASE left(o_orderpriority, 1) WHEN '5' THEN INTERVAL 250 MILLISECOND ELSE INTERVAL 0 SECOND END AS t
          FROM orders)""",
)
def parse_published_at(spark, sf):
    """Order dates written in five ways by priority, then parsed."""
    o = V.table(spark, sf, "orders")
    t = F.timestamp_seconds(
        F.unix_timestamp(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey") % 86400
    )
    p = F.substring("o_orderpriority", 1, 1)
    text = (
        F.when(p == "1", F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(p == "2", F.date_format(t, "EEE, dd MMM yyyy HH:mm:ss 'GMT'"))
        .when(p == "3", F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))
        .when(p == "4", F.lit("not a date"))
        .otherwise(F.concat(F.date_format(t, "yyyy-MM-dd HH:mm:ss"), F.lit(".25")))
    )
    parsed = o.select("o_orderkey", X.parse_published_at(text).alias("published_at"))
    return parsed.select("o_orderkey", _ts("published_at"))


@register(
    "time_functions",
    """SELECT o_orderkey, strftime(date_trunc('week', t), '%Y-%m-%d') AS week, strftime(t, '%Y-%m-%dT%H:%M:%S+00:00') AS iso,
      epoch(date_trunc('day', t))::BIGINT AS day_start, epoch(date_trunc('day', t))::BIGINT + 86399 AS day_end
    FROM (SELECT o_orderkey, o_orderdate + INTERVAL 1 SECOND * (o_orderkey % 86400) AS t FROM orders)""",
)
def time_functions(spark, sf):
    o = V.table(spark, sf, "orders")
    t = X.epoch_to_timestamp(
        F.unix_timestamp(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey") % 86400
    )
    start, end = X.day_bounds(F.date_format(t, "yyyy-MM-dd"))
    return o.select(
        "o_orderkey", X.week_start(t).alias("week"), X.iso_utc(t).alias("iso"),
        start.alias("day_start"), end.alias("day_end"),
    )


@register("norm_text", f"SELECT doc_id, {O.norm('text')} AS norm FROM documents")
def norm_text(spark, sf):
    return V.table(spark, sf, "documents").select("doc_id", X.norm_text("text").alias("norm"))


@register(
    "display_name",
    f"""SELECT raw, {O.display('raw')} AS display FROM (
      SELECT DISTINCT unnest(string_split(text, ' ')) AS raw FROM documents
      UNION SELECT c_name FROM customer UNION SELECT p_name FROM part UNION SELECT p_brand FROM part)""",
)
def display_name(spark, sf):
    docs = V.table(spark, sf, "documents").select(F.explode(F.split("text", " ")).alias("raw"))
    part = V.table(spark, sf, "part")
    names = (
        docs.union(V.table(spark, sf, "customer").select("c_name"))
        .union(part.select("p_name"))
        .union(part.select("p_brand"))
        .distinct()
    )
    return names.select("raw", X.display_name("raw").alias("display"))


# --- declared checks --------------------------------------------------------


@register(
    "content_dedup",
    O.sql(
        f"""SELECT event_id, h AS content_hash FROM (SELECT *, sha256(concat_ws('||', {O.norm('title')}, {O.norm("coalesce(text, '')")})) AS h
        FROM collected) QUALIFY row_number() OVER (PARTITION BY h,
          CASE WHEN {O.norm('title')} || {O.norm("coalesce(text, '')")} = '' THEN mention_id END ORDER BY published_at, event_id) = 1""",
        "collected",
    ),
)
def content_dedup(spark, sf):
    rows = V.collected(spark, sf)
    return Q.dedup_content(rows, order=["published_at", "event_id"]).select("event_id", "content_hash")


@register(
    "volume_checks",
    O.sql(
        """SELECT strftime(day, '%Y-%m-%d') AS day, source, coalesce(n, 0)::BIGINT AS row_count,
          CASE WHEN coalesce(n, 0) = 0 THEN 'empty' WHEN n < 60 THEN 'low' ELSE 'ok' END AS status
        FROM (SELECT unnest(generate_series(min(published_at)::DATE, max(published_at)::DATE, INTERVAL 1 DAY))::DATE AS day
              FROM collected)
        CROSS JOIN (SELECT DISTINCT source FROM collected UNION SELECT 'never') x
        LEFT JOIN (SELECT published_at::DATE AS day, source, count(*) AS n FROM collected GROUP BY ALL) USING (day, source)""",
        "collected",
    ),
)
def volume_checks(spark, sf):
    rows = V.collected(spark, sf)
    expected = rows.select("source").union(V.words(spark, ["never"])).distinct()
    return Q.volume_checks(rows, expected, 60).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@register(
    "date_range",
    """SELECT event_id FROM events WHERE ts >= '2024-01-05' AND ts < '2024-01-13'""",
)
def date_range(spark, sf):
    return Q.date_range(V.events(spark, sf), "2024-01-05", "2024-01-12", "ts").select("event_id")


def _stored(spark, sf):
    """Feed records as the store holds them: dates are ISO, RFC-822 or junk texts, some empty."""
    made = G.make_mentions(N.normalize_feed_entries(V.feed_entries(spark, sf), "2024-01-10"))
    late = F.when(F.length("text") % 5 == 0, "").otherwise(F.col("published_at"))
    return made.withColumn("published_at", late).withColumn("collected_at", F.lit(None).cast("timestamp"))


_DATED = f"""dated AS (
  SELECT *, CASE WHEN length(text) % 5 = 0 THEN NULL WHEN author = 'en' THEN tm WHEN author = 'de' THEN tm - INTERVAL 2 HOUR
    WHEN author = 'fr' THEN tm END AS seen_at FROM (
    SELECT r.*, TIMESTAMP '2024-01-01' + INTERVAL 1 DAY * (regexp_extract(url, '[0-9]+$')::BIGINT % 40) AS tm FROM record r))"""


def _dated(final: str) -> str:
    return f"WITH {O.FEED},\n{O.BLOCKS['record']},\n{_DATED}\n{final}"


@register(
    "cap_stored",
    _dated(
        """SELECT mention_id, community FROM (SELECT * FROM dated QUALIFY row_number() OVER (
          PARTITION BY community ORDER BY seen_at DESC NULLS LAST, mention_id) <= 7)"""
    ),
)
def cap_stored(spark, sf):
    return G.cap_per_group(_stored(spark, sf), "community", 7).select("mention_id", "community")


@register(
    "cap_stored_total",
    _dated(
        """SELECT mention_id, community FROM (SELECT * FROM dated QUALIFY row_number() OVER (
          PARTITION BY community ORDER BY seen_at DESC NULLS LAST, mention_id) <= 7) ORDER BY seen_at DESC NULLS LAST, mention_id LIMIT 50"""
    ),
)
def cap_stored_total(spark, sf):
    return G.cap_per_group(_stored(spark, sf), "community", 7, 50).select("mention_id", "community")


@register(
    "volume_checks_stored",
    _dated(
        """SELECT strftime(day, '%Y-%m-%d') AS day, community AS source, coalesce(n, 0)::BIGINT AS row_count,
          CASE WHEN coalesce(n, 0) = 0 THEN 'empty' WHEN n < 2 THEN 'low' ELSE 'ok' END AS status
        FROM (SELECT unnest(generate_series(min(seen_at)::DATE, max(seen_at)::DATE, INTERVAL 1 DAY))::DATE AS day FROM dated)
        CROSS JOIN (SELECT DISTINCT community FROM dated)
        LEFT JOIN (SELECT seen_at::DATE AS day, community, count(*) AS n FROM dated GROUP BY ALL) USING (day, community)"""
    ),
)
def volume_checks_stored(spark, sf):
    rows = _stored(spark, sf).withColumn("source", F.col("community"))
    return Q.volume_checks(rows, rows.select("source"), 2).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@register("date_range_stored", _dated("SELECT mention_id FROM dated WHERE seen_at >= '2024-01-12' AND seen_at < '2024-01-20'"))
def date_range_stored(spark, sf):
    return Q.date_range(_stored(spark, sf), "2024-01-12", "2024-01-19").select("mention_id")


@register(
    "stream_weekly_stored",
    _dated(
        """SELECT strftime(date_trunc('week', seen_at), '%Y-%m-%d') AS week, community AS category, count(*) AS mentions
        FROM dated WHERE seen_at IS NOT NULL
          AND date_trunc('week', seen_at) + INTERVAL 7 DAY <= (SELECT max(seen_at) FROM dated) - INTERVAL 10 DAY GROUP BY ALL"""
    ),
)
def stream_weekly_stored(spark, sf):
    """Weeks that the watermark has closed, from stored records, in append mode into files."""
    base = V.scratch(spark)
    rows = _stored(spark, sf).withColumn("category", F.col("community"))
    rows.write.parquet(base + "/landed")
    source = M.read_mention_stream(spark, base + "/landed", max_files=1000)
    query = (
        M.stream_weekly(source, late_by="10 days").writeStream.outputMode("append").format("parquet")
        .option("path", base + "/weeks").option("checkpointLocation", base + "/state").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema("week string, category string, mentions bigint").parquet(base + "/weeks")


# --- vectors and clusters ---------------------------------------------------


def _vectors(spark, sf):
    return V.table(spark, sf, "embeddings")


@register(
    "unit_vectors",
    """SELECT vec_id, round_even(list_sum(list_transform(u, lambda x: x * x)) * 1e4, 0) / 1e4 AS length,
      list_transform(u, lambda x: round_even(x * 1e4, 0) / 1e4 + 0.0) AS values
    FROM (SELECT vec_id, list_transform(v, lambda x: (x / sqrt(list_inner_product(v, v)))::FLOAT::DOUBLE) AS u
          FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings))""",
)
def unit_vectors(spark, sf):
    u = E.normalize_vectors(_vectors(spark, sf))
    total = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return u.select(
        "vec_id",
        X.np_round(total, 4).alias("length"),
        F.transform("embedding", lambda x: X.np_round(x.cast("double"), 4) + F.lit(0.0)).alias("values"),
    )


@register("knn_graph", O.sql(f"SELECT src, dst, rank, {O.rnd('distance', 6)} AS distance FROM knn", "knn"))
def knn_graph(spark, sf):
    return J.knn_graph(_vectors(spark, sf)).select("src", "dst", "rank", *_r6("distance"))


def _clusters(spark, sf):
    from trendloom.session import staged

    vectors = _vectors(spark, sf)
    graph = staged(J.knn_graph(vectors))
    # the smallest core distance that at least 80% of the vectors do not exceed
    eps = Z.core_distances(graph).agg(F.expr("percentile_disc(0.8) WITHIN GROUP (ORDER BY core)")).first()[0]
    return Z.density_cluster(vectors, 10, 20, eps, graph=graph)


@register(
    "density_cluster",
    O.sql("SELECT vec_id, cluster_root FROM clusters", "clusters", recursive=True),
)
def density_cluster(spark, sf):
    return _clusters(spark, sf).select("vec_id", "cluster_root")


@register(
    "cluster_summary",
    O.sql(
        """SELECT count(DISTINCT cluster_root) AS n_clusters, count(cluster_root) AS n_clustered,
        count(*) - count(cluster_root) AS n_noise,
        round_even(100.0 * (count(*) - count(cluster_root)) / count(*) * 10, 0) / 10 AS noise_pct FROM clusters""",
        "clusters", recursive=True,
    ),
)
def cluster_summary(spark, sf):
    return Z.cluster_summary(_clusters(spark, sf))


@register(
    "cluster_sizes",
    O.sql(
        "SELECT cluster_root, count(*) AS size FROM clusters GROUP BY 1", "clusters", recursive=True
    ),
)
def cluster_sizes(spark, sf):
    """Sizes by number, named by the smallest id of each cluster (numbers are arbitrary)."""
    from trendloom.session import staged

    c = staged(_clusters(spark, sf))
    names = c.groupBy("cluster_id").agg(F.max("cluster_root").alias("cluster_root"))
    return Z.cluster_sizes(c).join(names, "cluster_id").select("cluster_root", "size")


@register(
    "attach_clusters",
    O.sql(
        """SELECT doc_id, source, (cluster_root IS NULL)::INTEGER AS noise
        FROM documents LEFT JOIN clusters ON vec_id = doc_id""",
        "clusters", recursive=True,
    ),
)
def attach_clusters(spark, sf):
    labels = _clusters(spark, sf).withColumnRenamed("vec_id", "doc_id")
    docs = V.table(spark, sf, "documents").select("doc_id", "source")
    return Z.attach_clusters(docs, labels, "doc_id").select(
        "doc_id", "source", (F.col("cluster_id") == -1).cast("int").alias("noise")
    )


@register("embed_text")
def embed_text(spark, sf):
    docs = V.table(spark, sf, "documents").select(
        F.col("doc_id").alias("mention_id"), F.lit("").alias("title"), "text"
    )
    return E.embed_text(docs)


@register("reduce_dims")
def reduce_dims(spark, sf):
    return E.reduce_dims(_vectors(spark, sf)).select("vec_id", "reduced")


# --- rule-based sentiment and relevance -------------------------------------


@register(
    "sentiment_rules",
    O.sql(
        f"""SELECT mention_id, {O.rnd('s / sqrt(s * s + 15)', 4)} AS sentiment_compound,
        {O.rnd('p / (p + g + u)', 3)} AS sentiment_positive, {O.rnd('g / (p + g + u)', 3)} AS sentiment_negative,
        {O.rnd('u / (p + g + u)', 3)} AS sentiment_neutral,
        CASE WHEN {O.rnd('s / sqrt(s * s + 15)', 4)} >= 0.05 THEN 'positive'
          WHEN {O.rnd('s / sqrt(s * s + 15)', 4)} <= -0.05 THEN 'negative' ELSE 'neutral' END AS sentiment_label
        FROM amped""",
        "ruled",
    ),
)
def sentiment_rules(spark, sf):
    rules = C.Rules(negations=V.NEGATIONS, boosters=V.BOOSTERS, dampeners=V.DAMPENERS)
    return C.sentiment_scores(V.mentions(spark, sf), V.lexicon(spark), rules=rules)


@register(
    "business_context",
    O.sql(
        """SELECT DISTINCT m.mention_id, coalesce(label, '') AS business_context_label,
          coalesce(score, 0) AS semantic_relevance_score
        FROM mentions m LEFT JOIN (SELECT * FROM context_scores
          QUALIFY row_number() OVER (PARTITION BY mention_id ORDER BY score DESC, label DESC) = 1) USING (mention_id)""",
        "context_scores",
    ),
)
def business_context(spark, sf):
    return L.business_context(V.mentions(spark, sf), V.contexts(spark))


_FOUND = """SELECT mention_id, max(score) AS semantic_relevance_score,
  coalesce(max(score) FILTER (label = 'english'), 0) AS tiktok_relevance_score FROM context_scores GROUP BY 1
  HAVING max(score) >= 0.3 OR max(score) FILTER (label = 'english') >= 0.18"""


@register("semantic_filter", O.sql(_FOUND, "context_scores"))
def semantic_filter(spark, sf):
    return L.semantic_filter(
        V.mentions(spark, sf), V.contexts(spark), 0.3, 0.18, commerce_label="english"
    )


@register(
    "priority_score",
    O.sql(
        f"""SELECT mention_id, {O.rnd('semantic_relevance_score + 0.3 * tiktok_relevance_score', 6)} AS collector_priority_score
        FROM ({_FOUND})""",
        "context_scores",
    ),
)
def priority_score(spark, sf):
    return L.priority_score(semantic_filter(spark, sf)).select("mention_id", "collector_priority_score")


# --- stored dashboards and streams ------------------------------------------


@register(
    "stored_dashboard",
    O.sql(
        """SELECT window_id, category, trend_score, coalesce(b, '') AS top_brands, coalesce(p, '') AS sample_titles
        FROM stats LEFT JOIN (SELECT window_id, category, string_agg(brand, '|' ORDER BY rank) AS b FROM brands
                              WHERE rank <= 20 GROUP BY ALL) USING (window_id, category)
        LEFT JOIN (SELECT window_id, category, string_agg(url, '|' ORDER BY rank) AS p FROM samples GROUP BY ALL)
          USING (window_id, category)""",
        "stats", "brands", "samples",
    ),
)
def stored_dashboard(spark, sf):
    """All four result tables built, written by window, read back; the category table with its lists."""
    base = V.scratch(spark)
    posts = T.materialize(V.posts(spark, sf, ["title", "text", "url"]), base + "/posts")
    names = T.materialize(_whitelist(spark, sf), base + "/whitelist")
    T.write_dashboard(P.build_dashboard(posts, names), base + "/dashboard")
    stats = T.read_dashboard(spark, base + "/dashboard")["category_stats"]
    return stats.select(
        "window_id", "category", "trend_score",
        F.array_join("top_brands", "|").alias("top_brands"),
        F.array_join("sample_posts.url", "|").alias("sample_titles"),
    )


@register(
    "stream_mentions",
    O.sql("SELECT DISTINCT mention_id FROM collected", "collected"),
)
def stream_mentions(spark, sf):
    """The collected rows land in three deliveries of many files that share ids; the store gets every id once."""
    base = V.scratch(spark)
    files = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // 3)
    # an id comes again with another delivery; a document's copies within one are side by side in the same file
    landed = _as_mentions(V.collected(spark, sf, deliveries=3, parts=3 * files))
    landed.write.option("compression", "zstd").parquet(base + "/landed")
    source = M.read_mention_stream(spark, base + "/landed", max_files=files)
    query = M.stream_mentions(source, base + "/store", base + "/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(base + "/store").select("mention_id")


@register(
    "stream_weekly",
    O.sql(
        """SELECT strftime(date_trunc('week', published_at), '%Y-%m-%d') AS week, category, count(*) AS mentions
        FROM mentions GROUP BY ALL""",
        "mentions",
    ),
)
def stream_weekly(spark, sf):
    base = V.scratch(spark)
    rows = V.mentions(spark, sf).select("mention_id", "category", "published_at")
    rows.repartitionByRange(4, "published_at").write.parquet(base + "/landed")
    source = M.read_mention_stream(spark, base + "/landed", rows.schema, max_files=1000)
    name = "weekly_" + base.rsplit("-", 1)[-1].replace("_", "x")
    query = (
        M.stream_weekly(source).writeStream.outputMode("complete").format("memory").queryName(name)
        .option("checkpointLocation", base + "/state").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.table(name)


@register(
    "vector_store",
    """SELECT vec_id, len(embedding)::INTEGER AS dims, list_transform(embedding, lambda x: x::DOUBLE) AS values
    FROM embeddings""",
)
def vector_store(spark, sf):
    path = V.scratch(spark) + "/vectors"
    E.write_vectors(_vectors(spark, sf), path, "vec_id")
    stored = spark.read.parquet(path)
    return stored.select(
        "vec_id",
        F.size("embedding").alias("dims"),
        F.transform("embedding", lambda x: x.cast("double")).alias("values"),
    )
