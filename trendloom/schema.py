"""Fixed schemas of the stored tables, and the check made at stage boundaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "strings": T.ArrayType(T.StringType()),
}


def _struct(spec: str) -> T.StructType:
    """A flat schema from ``name type`` pairs (usable before a session exists)."""
    pairs = [part.split() for part in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


MENTIONS = _struct(
    "mention_id string, source string, platform string, sub_source string, source_type string, "
    "keyword string, query string, category string, title string, text string, full_text string, "
    "author string, community string, published_at string, collected_at timestamp, url string, "
    "engagement_score double, semantic_relevance_score double, tiktok_relevance_score double, "
    "business_context_label string, collector_priority_score double, metrics_json string"
)

ARCHIVE_POSTS = _struct(
    "subreddit string, created_utc bigint, title string, selftext string, permalink string, "
    "author string, score bigint, num_comments bigint"
)
_LISTED_POST = _struct(
    "created_utc double, title string, selftext string, permalink string, author string, "
    "score bigint, num_comments bigint, upvote_ratio double"
)
LISTING_PAGES = (
    _struct("subreddit string, sort string")
    .add(
        "data",
        T.StructType()
        .add("after", T.StringType())
        .add("children", T.ArrayType(T.StructType().add("data", _LISTED_POST))),
    )
)
FEED_ENTRIES = _struct(
    "community string, sort string, position bigint, title string, content string, "
    "updated string, link string, author string"
)
STORY_HITS = _struct(
    "query string, objectID string, title string, story_title string, comment_text string, "
    "story_text string, created_at string, url string, author string, points bigint, "
    "num_comments bigint, _tags strings"
)
NEWS_ITEMS = _struct(
    "query string, position bigint, title string, description string, pubDate string, "
    "link string, source string"
)

SENTIMENT_COLUMNS = [
    "sentiment_compound", "sentiment_positive", "sentiment_negative", "sentiment_neutral",
    "sentiment_label",
]

WINDOWS = _struct(
    "window_id int, window_label string, cur_start timestamp, cur_end timestamp, "
    "prev_start timestamp, prev_end timestamp"
)
CATEGORY_STATS = _struct(
    "window_id int, category string, current_mentions bigint, current_communities bigint, "
    "mean_sentiment double, mean_engagement double, previous_mentions bigint, "
    "communities_p bigint, mean_sentiment_p double, mean_engagement_p double, "
    "spike_ratio double, normalized_spike double, cross_community double, "
    "sentiment_score double, eng_momentum double, eng_momentum_norm double, trend_score double, "
    "trend_direction string, mentions_delta bigint, top_brands strings"
).add(
    "sample_posts",
    T.ArrayType(
        _struct(
            "title string, community string, engagement_score double, sentiment_label string, url string"
        )
    ),
)
BRAND_STATS = _struct(
    "window_id int, category string, brand string, cur_mentions bigint, prev_mentions bigint, "
    "brand_spike double, avg_sentiment double, rank int"
)
WEEKLY = _struct(
    "window_id int, category string, week string, mentions bigint, mean_sentiment double"
)
DASHBOARD = {
    "windows": WINDOWS,
    "category_stats": CATEGORY_STATS,
    "brand_stats": BRAND_STATS,
    "weekly": WEEKLY,
}


def require(df: DataFrame, columns, stage: str) -> DataFrame:
    """Fail early, with the stage's name, when a needed column is missing or mistyped."""
    wanted = columns.fields if isinstance(columns, T.StructType) else None
    have = dict(df.dtypes)
    if wanted is None:
        missing = [c for c in columns if c not in have]
        wrong = []
    else:
        missing = [f.name for f in wanted if f.name not in have]
        wrong = [
            f"{f.name}: {have[f.name]} instead of {f.dataType.simpleString()}"
            for f in wanted
            if f.name in have and have[f.name] != f.dataType.simpleString()
        ]
    if missing or wrong:
        raise ValueError(f"{stage}: missing columns {missing}, wrong types {wrong}")
    return df
