"""Work that must not grow faster than the input: bounded portions, few passes, few rows on the way."""

import datetime
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from checks import views as V
from trendloom.functions import display_name, norm_text
from trendloom.functions.scalars import PUNCTUATION_CLASS, WHITESPACE, WHITESPACE_CLASS
from trendloom.operators import brands, knn, sentiment


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_visits_are_sent_in_bounded_slices(spark, monkeypatch):
    draw = np.random.default_rng(5).normal(size=(300, 8))
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(draw)], "vec_id long, embedding array<double>")
    whole = {tuple(r) for r in knn.knn_graph(df, 5, block=32).collect()}
    monkeypatch.setattr(knn, "VISIT_BYTES", 1)
    assert {tuple(r) for r in knn.knn_graph(df, 5, block=32).collect()} == whole
    assert len(whole) == 1500
    frame = pd.DataFrame({"id": range(7)})
    assert [len(p) for p in knn._sliced(iter([frame, frame.iloc[:0]]), 3)] == [3, 3, 1]


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_points_come_in_portions_and_vectors_stay(spark, monkeypatch, metric):
    draw = np.random.default_rng(6).normal(size=(260, 6)).round(1)
    draw[100:180] = draw[7] + draw[100:180] / 50  # a cell larger than a portion
    rows = [(f"v{i}", [float(x) for x in v]) for i, v in enumerate(draw)]
    df = spark.createDataFrame(rows, "vec_id string, embedding array<double>")
    whole = {tuple(r) for r in knn.knn_graph(df, 5, metric=metric, block=4096).collect()}
    portions, sent = [], []
    cut, chunk = knn._portions, knn._chunk
    monkeypatch.setattr(knn, "_portions", lambda *a: portions.extend(cut(*a)) or cut(*a))
    monkeypatch.setattr(knn, "_chunk", lambda points: sent.append(points.count()) or chunk(points))
    monkeypatch.setattr(knn, "CHUNK_BYTES", 1)
    got = knn.knn_graph(df, 5, metric=metric, block=30)
    assert {tuple(r) for r in got.collect()} == whole and len(whole) == 1300
    assert len(portions) > 5 and any(of > 1 for *_, of in portions) and sum(sent) == len({tuple(v) for _, v in rows})
    # no second cogroup: the vectors are not sent to the cells they visit
    assert "CoGroup" not in _plan(got)


def test_portions_hold_all_cells_once():
    assert knn._portions(np.array([3, 0, 4, 25, 1, 10, 0]), 10) == [
        (0, 2, 0, 1), (3, 3, 0, 3), (3, 3, 1, 3), (3, 3, 2, 3), (4, 4, 0, 1), (5, 6, 0, 1),
    ]
    assert knn._portions(np.array([0, 0]), 10) == []


def test_norm_text_is_one_pass_with_the_old_result(spark):
    texts = ["", " ", "A-b", "a - b", "  x\t\ty ", "a b", "a. .b", "...", "L'Oréal & co", "a  b", "\n", "x;y", "a　", None]
    texts += [t for c in WHITESPACE + "\x1b\x21\x84\u167f\u200b\u3001" for t in (f"a{c}b", f"{c}a.{c}{c}", f"a {c}-b{c} ")]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    spaced = F.regexp_replace(F.lower("t"), PUNCTUATION_CLASS + "+", " ")
    two = F.trim(F.regexp_replace(spaced, WHITESPACE_CLASS + "+", " "))
    assert all(r[0] == r[1] for r in df.select(norm_text("t"), two).collect())
    one = spark.range(1).select(norm_text(F.concat(F.lit("a"), F.col("id"))).alias("n"))
    assert _plan(one).count("regexp_replace") == 1


def test_only_hits_and_first_words_reach_the_sums(spark):
    posts = spark.createDataFrame(
        [("a", "good day", "and bad luck"), ("a", "good", ""), ("b", "", ""), ("c", "no entry here", None)],
        "mention_id string, title string, text string",
    )
    # a repeated token counts once per entry, a valence of zero is neutral
    lexicon = spark.createDataFrame([("good", 1.0), ("good", 1.0), ("bad", -1.0), ("luck", 0.0)], "token string, valence double")
    for rules in (False, True):
        scores = sentiment.sentiment_scores(posts, lexicon, rules=rules)
        plan = _plan(scores).splitlines()
        depth = {what: next(i for i, line in enumerate(plan) if what in line) for what in ("Aggregate", "Join")}
        between = plan[depth["Aggregate"] : depth["Join"]]
        assert any("Filter" in line and "_nth" in line for line in between)
        got = {r["mention_id"]: tuple(r)[1:5] for r in scores.collect()}
        # words a: 4 entries of good (2 each), one of bad (2), day, and, luck neutral
        assert got["a"][1:] == (8 / 13 // 0.001 / 1000, 2 / 13 // 0.001 / 1000 + 0.001, 3 / 13 // 0.001 / 1000 + 0.001)
        assert got["b"] == (0.0, 0.0, 0.0, 0.0)
        assert got["c"] == (0.0, 0.0, 0.0, 1.0)


def test_names_are_spelled_after_the_first_entry_is_chosen(spark):
    entries = spark.createDataFrame(
        [("a", 1, "acme co"), ("a", 0, "ACME Co"), ("b", 0, "acme-co"), ("a", 2, "';'"), ("c", 0, "abc"), ("d", 0, "with"), ("d", 0, "with")],
        "list string, ordinal long, raw string",
    )
    words = [spark.createDataFrame([(w,)], "word string") for w in ("with", "abc", "noise")]
    out = brands.build_whitelist(entries, *words)
    assert {tuple(r) for r in out.collect()} == {("acme co", "Acme Co"), ("abc", "Abc")}
    plan = _plan(out)
    assert plan.count("initcap") > 0 and "initcap" not in plan[plan.index("Window") :]
    single = spark.createDataFrame([("SAMSUNg",), ("l'oréal",), ("3m",), ("'",), (None,)], "b string")
    assert [r[0] for r in single.select(display_name("b")).collect()] == ["Samsung", "Loréal", "3M", "", None]


def test_sources_of_a_name_meet_in_one_shuffle(spark):
    def counts(n):
        docs = spark.createDataFrame([(f"s{i}",) for i in range(n)] + [(None,)], "source string")
        found = docs.select("source", F.lit("x").alias("raw")).unionByName(docs.select("source", F.lit("x").alias("raw")))
        found = found.unionByName(spark.createDataFrame([(None, "y"), ("s0", "z")], "source string, raw string"))
        return V._sources_of(docs)(found)

    for n in (1, 64, 65):
        assert {tuple(r) for r in counts(n).collect()} == {("x", n), ("y", 0), ("z", 1)}
    assert _plan(counts(64)).count("Aggregate") == 1


def test_listing_pages_hold_each_event_with_its_documents_and_shuffle_no_text_by_page(spark, tmp_path):
    docs = [(i, f"text {i} " * 20, "en", "s", 1) for i in range(30)] + [(7, "again", "en", "s", 1), (8, None, "en", "s", 1), (None, "x", "en", "s", 1)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    at = datetime.datetime(2024, 1, 6)
    kinds = ["click", "view", "error", None]
    rows = [(i, at, i % 9, kinds[i % 4], float(i), "") for i in (*range(-150, 700, 3), 7, 7, 5_000_000_007)] + [(None, at, 1, "view", 1.0, "")]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    pages = V.listing_pages(spark, str(tmp_path))
    assert "Exchange hashpartitioning(page" not in pages._jdf.queryExecution().executedPlan().toString()
    texts = {}
    for i, text, *_ in docs:
        texts.setdefault(i, []).append(text)
    expected = Counter()
    for i, _, user, kind, value, _ in rows:
        for text in texts.get(i % len(docs), []) if i is not None else []:
            body = {"click": "[removed]", "view": " [deleted]"}.get(kind, None if text is None else text[80:])
            expected[(i // 100, None if text is None else text[:80], body, f"/l/{i}", f"u{user}", int(value // 1))] += 1
    got = Counter()
    for r in pages.collect():
        of = {int(c.data.permalink[3:]) // 100 for c in r["data"].children}
        assert len(of) == 1 and r.sort == ("new" if min(of) % 2 == 0 else "top")
        got.update((min(of), c.data.title, c.data.selftext, c.data.permalink, c.data.author, c.data.score) for c in r["data"].children)
    assert got == expected and sum(got.values()) > 250
