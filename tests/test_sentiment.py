"""Scores of hand-made posts."""

import math

import pytest

from trendloom.operators import sentiment as C


@pytest.fixture(scope="module")
def lex(spark):
    return spark.createDataFrame([("good", 1.9), ("bad", -2.5), ("no", -1.2)], "token string, valence double")


def compound(spark, lex, text, rules):
    df = spark.createDataFrame([("1", text, None)], "mention_id string, title string, text string")
    return C.sentiment_scores(df, lex, rules=rules).first()


def norm(s):
    return round(s / math.sqrt(s * s + 15), 4)


@pytest.mark.parametrize(
    "text, total",
    [
        ("good", 1.9),
        ("very good", 1.9 + 0.293),
        ("slightly good", 1.9 - 0.293),
        ("very bad", -2.5 - 0.293),
        ("very plain good", 1.9 + 0.293 * 0.95),
        ("very plain old good", 1.9 + 0.293 * 0.9),
        ("not good", 1.9 * -0.74),
        ("not so very good", (1.9 + 0.293 + 0.293 * 0.95) * -0.74),
        ("isn't good", 1.9 * -0.74),
        ("not one of four good", 1.9),
        ("no good", 1.9 - 1.2),
        ("GOOD thing", 1.9 + 0.733),
        ("GOOD", 1.9),
        ("VERY good", 1.9 + 0.293 + 0.733),
        ("good but bad", 1.9 * 0.5 - 2.5 * 1.5),
        ("good!", 1.9 + 0.292),
        ("good!!!!!", 1.9 + 4 * 0.292),
        ("bad!!", -2.5 - 2 * 0.292),
        ("good??", 1.9 + 0.36),
        ("good????", 1.9 + 0.96),
        ("nothing here", 0.0),
        ("", 0.0),
    ],
)
def test_rules(spark, lex, text, total):
    assert compound(spark, lex, text, True)["sentiment_compound"] == pytest.approx(norm(total), abs=1e-9)


def test_plain_sum_and_shares(spark, lex):
    row = compound(spark, lex, "Good, good bad thing.", False)
    s = 1.9 * 2 - 2.5
    total = 2 * 2.9 + 3.5 + 1
    assert row["sentiment_compound"] == norm(s)
    assert row["sentiment_positive"] == round(5.8 / total, 3)
    assert row["sentiment_negative"] == round(3.5 / total, 3)
    assert row["sentiment_neutral"] == round(1 / total, 3)


def test_text_is_read_to_the_limit_only(spark, lex):
    df = spark.createDataFrame([("1", "t", "x" * 499 + " good")], "mention_id string, title string, text string")
    assert C.sentiment_scores(df, lex).first()["sentiment_compound"] == 0.0


def test_label_bounds(spark):
    df = spark.createDataFrame([(0.05,), (0.0499,), (-0.0499,), (-0.05,)], "c double")
    assert [r[0] for r in df.select(C.sentiment_label("c")).collect()] == [
        "positive", "neutral", "neutral", "negative",
    ]
