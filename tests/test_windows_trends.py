"""Window edges and the arithmetic of the trend statistics."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from trendloom.operators import trends as R
from trendloom.operators import windows as W

UTC = timezone.utc
ANCHOR = datetime(2026, 3, 1, 12, 0, 0, 500, tzinfo=UTC)
DAY = timedelta(days=1)
US = timedelta(microseconds=1)

POST = "mention_id string, category string, community string, published_at timestamp, " \
       "sentiment_compound double, engagement_score double"


def test_edges(spark):
    at = {
        "anchor": ANCHOR,
        "just_before": ANCHOR - US,
        "first_of_0": ANCHOR - 14 * DAY,
        "last_of_1": ANCHOR - 14 * DAY - US,
        "first_of_prev_3": ANCHOR - 70 * DAY,
        "too_old": ANCHOR - 70 * DAY - US,
        "none": None,
    }
    df = spark.createDataFrame(list(at.items()), "mention_id string, published_at timestamp")
    assert W.find_anchor(df) == ANCHOR
    got = {}
    for r in W.assign_windows(df, ANCHOR).collect():
        got.setdefault(r["mention_id"], set()).add((r["window_id"], r["side"]))
    assert got == {
        "just_before": {(0, "cur")},
        "first_of_0": {(0, "cur")},
        "last_of_1": {(1, "cur"), (0, "prev")},
        "first_of_prev_3": {(3, "prev")},
    }


def test_window_table(spark):
    df = spark.createDataFrame([(ANCHOR,)], "published_at timestamp")
    rows = W.biweekly_windows(df).orderBy("window_id").collect()
    assert [r["window_label"] for r in rows] == ["02/15–03/01", "02/01–02/15", "01/18–02/01", "01/04–01/18"]
    assert rows[0]["prev_end"] == rows[0]["cur_start"] == rows[1]["cur_end"]


def base(spark, rows):
    return spark.createDataFrame(
        [(0, *r) for r in rows],
        "window_id int, category string, current_mentions bigint, current_communities bigint, "
        "mean_sentiment double, mean_engagement double, previous_mentions bigint, communities_p bigint, "
        "mean_sentiment_p double, mean_engagement_p double",
    )


def test_empty_window_scores(spark):
    out = R.score_categories(base(spark, [("a", 0, 0, 0.0, 0.0, 0, 0, 0.0, 0.0)])).first()
    assert (out["spike_ratio"], out["sentiment_score"], out["eng_momentum"]) == (0.0, 0.5, 1.0)
    assert out["trend_score"] == 0.375 and out["trend_direction"] == "declining"


@pytest.mark.parametrize(
    "mean, prior, others, want",
    [(10.0, 5.0, 1.0, 2.0), (50.0, 5.0, 1.0, 4.0), (8.0, 0.0, 4.0, 2.0), (0.0, 0.0, 0.0, 1.0)],
)
def test_momentum(spark, mean, prior, others, want):
    rows = [("x", 1, 1, 0.0, mean, 1, 1, 0.0, prior)]
    # the median of x and two others is `others` when x is above them
    rows += [(c, 1, 1, 0.0, others, 1, 1, 0.0, 1.0) for c in "ab"]
    got = {r["category"]: r["eng_momentum"] for r in R.score_categories(base(spark, rows)).collect()}
    assert got["x"] == want


def test_zero_median_caps_positive_and_zeroes_negative(spark):
    rows = [(c, 1, 1, 0.0, 0.0, 1, 1, 0.0, 1.0) for c in "abcd"]
    rows += [("up", 1, 1, 0.0, 3.0, 1, 1, 0.0, 0.0), ("down", 1, 1, 0.0, -3.0, 1, 1, 0.0, 0.0)]
    got = {r["category"]: r["eng_momentum"] for r in R.score_categories(base(spark, rows)).collect()}
    assert got["up"] == 4.0 and got["down"] == 0.0


def test_direction_bounds(spark):
    df = spark.createDataFrame([(1.4,), (1.399,), (0.601,), (0.6,)], "s double")
    out = [r[0] for r in df.select(R.trend_direction("s")).collect()]
    assert out == ["rising", "stable", "stable", "declining"]


def test_undated_category_is_in_every_window(spark):
    rows = [
        ("1", "a", "u", ANCHOR, 0.1, 1.0),
        ("2", "a", "u", ANCHOR - DAY, 0.1, 1.0),
        ("3", "undated", "u", None, 0.1, 1.0),
    ]
    stats = R.category_trends(spark.createDataFrame(rows, POST), ANCHOR)
    got = {(r["window_id"], r["category"]): r["current_mentions"] for r in stats.collect()}
    assert len(got) == 8 and got[0, "a"] == 1 and got[0, "undated"] == 0


def test_ranges_hold_on_given_tables(spark):
    from checks.registry import _stats

    s = _stats(spark, "/root/testdata/sf0.001")
    bad = s.filter(
        ~F.col("normalized_spike").between(0, 1)
        | ~F.col("cross_community").between(0, 1)
        | ~F.col("sentiment_score").between(0, 1)
    )
    assert bad.count() == 0
    rows = {(r["window_id"], r["category"]): r for r in s.collect()}
    for (w, c), r in rows.items():
        if (w + 1, c) in rows:
            assert r["previous_mentions"] == rows[w + 1, c]["current_mentions"]
