"""Cleaning, ingest, stores, streams and their plans."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from checks import views as V
from tests.conftest import plan_of
from trendloom.operators import clean as K
from trendloom.operators import ingest as G
from trendloom.operators import series as S
from trendloom.operators import sentiment as C
from trendloom.operators import trends as R
from trendloom.plans import sizing
from trendloom.schema import ARCHIVE_POSTS, MENTIONS, STORY_HITS, require
from trendloom.sources import catalog as A
from trendloom.sources import raw as N
from trendloom.sources import store as T
from trendloom.streaming import mentions as M

SF = "/root/testdata/sf0.001"
UTC = timezone.utc


def mentions(spark, rows):
    """(id, title, text, second) rows in the stored schema."""
    df = spark.createDataFrame(rows, "mention_id string, title string, text string, at bigint")
    at = F.timestamp_seconds("at")
    have = df.withColumn("collected_at", at).withColumn("published_at", at.cast("string"))
    return have.select(
        *[
            (F.col(f.name) if f.name in have.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in MENTIONS.fields
        ]
    )


def test_first_collected_copy_wins(spark):
    df = mentions(spark, [("a", "late", "x", 9), ("a", "early", "x", 1), ("b", "only", "x", 5)])
    got = {r["mention_id"]: r["title"] for r in K.dedup_mentions(df).collect()}
    assert got == {"a": "early", "b": "only"}


def test_clean_length_counts_the_joined_text(spark):
    df = mentions(spark, [("a", "12345678", "", 1), ("b", "123456789", None, 1), ("c", None, "0123456", 1)])
    got = {r["mention_id"]: r["ner_input"] for r in K.clean_mentions(df).collect()}
    # "12345678." has nine characters after stripping
    assert got == {"b": "123456789."}
    assert tuple(K.clean_report(df).first()) == (3, 3, 1)


def test_both_ingest_joins_agree(spark, monkeypatch):
    batch = mentions(spark, [("a", "1", "", 2), ("a", "0", "", 1), ("b", "x", "", 1), ("c", "y", "", 1)])
    store = mentions(spark, [("b", "old", "", 0), ("z", "old", "", 0)])
    small = sorted((r["mention_id"], r["title"]) for r in G.ingest_new(batch, store).collect())
    monkeypatch.setattr(G, "fits_broadcast", lambda *_: False)
    large = sorted((r["mention_id"], r["title"]) for r in G.ingest_new(batch, store).collect())
    assert small == large == [("a", "0"), ("c", "y")]


@pytest.mark.parametrize("limit", [1000, 2])
def test_cap_is_exact_with_and_without_salting(spark, monkeypatch, limit):
    monkeypatch.setattr(G, "GROUP_LIMIT", limit)
    rows = [(f"{i:03d}", "a" if i % 3 else "b", i % 50) for i in range(200)]
    df = spark.createDataFrame(rows, "mention_id string, c string, s bigint").withColumn(
        "published_at", F.timestamp_seconds("s")
    )
    got = {(r["c"], r["mention_id"]) for r in G.cap_per_group(df, "c", 7).collect()}
    want = set()
    for c in "ab":
        mine = sorted((r for r in rows if r[1] == c), key=lambda r: (-r[2], r[0]))[:7]
        want |= {(c, r[0]) for r in mine}
    assert got == want
    total = [r["mention_id"] for r in G.cap_per_group(df, "c", 100, total=5).collect()]
    assert total == [r[0] for r in sorted(rows, key=lambda r: (-r[2], r[0]))[:5]]


def test_record_defaults(spark):
    df = spark.createDataFrame([("s", None, " t ")], "source string, platform string, title string")
    row = G.make_mentions(df).first()
    assert [f.name for f in MENTIONS.fields] == list(row.asDict())
    assert (row["full_text"], row["metrics_json"], row["engagement_score"]) == ("t", "{}", 0.0)
    assert len(row["mention_id"]) == 24 and row["platform"] == ""


def test_archive_edge_rows(spark):
    rows = [
        ("s", None, "t", " [removed] ", "/p", None, None, None),
        ("s", 0, "t", "[deleted]", None, "x", 1, 2),
        ("s", 1_700_000_000, "old", "", "/p", "x", 1, 2),
        ("s", 1_767_225_600, None, " body ", "/q", "x", 3, 4),
    ]
    out = N.normalize_archive_posts(spark.createDataFrame(rows, ARCHIVE_POSTS), "2026-01-01").collect()
    assert [(r["published_at"], r["title"], r["text"], r["url"], r["engagement_score"]) for r in out] == [
        ("", "t", "", "https://reddit.com/p", 0.0),
        ("", "t", "", "", 7.0),
        ("2026-01-01T00:00:00+00:00", "", "body", "https://reddit.com/q", 15.0),
    ]
    assert out[0]["author"] == "[deleted]" and json.loads(out[0]["metrics_json"]) == {
        "score": None, "num_comments": None,
    }


def test_story_range_is_open_at_both_ends(spark):
    at = ["2026-01-01T00:00:00Z", "2026-01-01T00:00:01Z", "2026-01-02T23:59:58Z", "2026-01-02T23:59:59Z"]
    rows = [("q", str(i), "", "st", "", None, t, "", None, None, None, None) for i, t in enumerate(at)]
    out = N.normalize_story_hits(spark.createDataFrame(rows, STORY_HITS), "2026-01-01", "2026-01-02").collect()
    assert [r["published_at"] for r in out] == at[1:3]
    assert {(r["title"], r["source_type"], r["url"][-5:]) for r in out} == {
        ("st", "story", "?id=1"[-5:]), ("st", "story", "?id=2"[-5:]),
    }


def test_catalog_first_category_and_case(spark):
    text = json.dumps({"x": {"a": ["One", "two"], "b": ["Two", "One"], "c": ["two", "three"]}})
    df = spark.createDataFrame([(text,)], "value string")
    plain = A.load_catalog(df, field="x").orderBy("ordinal").collect()
    assert [(r["category"], r["community"]) for r in plain] == [
        ("a", "One"), ("a", "two"), ("b", "Two"), ("c", "three"),
    ]
    first_c = A.load_catalog(df, ["c", "missing"], "x").orderBy("ordinal").collect()
    assert [(r["category"], r["community"]) for r in first_c][:2] == [("c", "two"), ("c", "three")]


def test_csv_keeps_texts_that_look_like_nulls(spark, tmp_path):
    df = mentions(spark, [("a", "NA", 'say "hi"\n,x', 1), ("b", "null", "", 2), ("c", None, " sp ", 3)])
    T.write_mentions_csv(df, str(tmp_path / "csv"))
    got = {r["mention_id"]: (r["title"], r["text"]) for r in T.read_mentions_csv(spark, str(tmp_path / "csv")).collect()}
    assert got == {"a": ("NA", 'say "hi"\n,x'), "b": ("null", ""), "c": (None, " sp ")}


def test_materialize_resumes(spark, tmp_path):
    path = str(tmp_path / "stage")
    first = T.materialize(spark.range(3), path)
    assert first.count() == 3
    assert T.materialize(lambda: spark.range(99), path, resume=True, spark=spark).count() == 3
    assert T.materialize(spark.range(5), path).count() == 5


def test_schema_check_names_the_stage(spark):
    with pytest.raises(ValueError, match="stage x.*title"):
        require(spark.range(1), ["title"], "stage x")


def test_bucketed_posts_need_no_shuffle_for_dedup_and_sentiment(spark):
    posts = V.mentions(spark, SF)
    table = T.materialize_bucketed(posts, "posts_bucketed", 4)
    scored = C.score_sentiment(K.dedup_mentions(table, ["published_at"]), V.lexicon(spark))
    names = [line.split(" ")[-1] for line in plan_of(scored).splitlines() if "Exchange" in line]
    assert not any("hashpartitioning" in line for line in plan_of(scored).splitlines()), names
    assert scored.count() == posts.count()
    spark.sql("DROP TABLE posts_bucketed")


def test_stream_equals_batch_and_survives_a_rerun(spark, tmp_path):
    a = mentions(spark, [("a", "1", "", 5), ("b", "1", "", 1), ("a", "0", "", 2)])
    b = mentions(spark, [("b", "2", "", 0), ("c", "2", "", 9)])
    landed, store = str(tmp_path / "in"), str(tmp_path / "store")

    def drain(state):
        source = M.read_mention_stream(spark, landed)
        M.stream_mentions(source, store, str(tmp_path / state)).trigger(availableNow=True).start().awaitTermination()
        return sorted((r["mention_id"], r["title"]) for r in spark.read.parquet(store).collect())

    a.coalesce(1).write.mode("append").parquet(landed)
    assert drain("s1") == [("a", "0"), ("b", "1")]
    b.coalesce(1).write.mode("append").parquet(landed)
    assert drain("s1") == [("a", "0"), ("b", "1"), ("c", "2")]
    # a lost checkpoint replays everything and still adds nothing
    assert drain("s2") == [("a", "0"), ("b", "1"), ("c", "2")]


def test_hot_split_join_equals_plain_join(spark):
    facts = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("k"), F.col("id").alias("v")
    )
    lookup = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    total = sizing.hot_split_join(facts, lookup, "k").agg(F.count("*"), F.sum("w"), F.sum("v")).first()
    assert total == facts.join(lookup, "k").agg(F.count("*"), F.sum("w"), F.sum("v")).first()


def test_salted_join_equals_plain_join(spark):
    facts = spark.range(500).select((F.col("id") % 5).alias("k"), F.col("id").alias("v"))
    lookup = spark.range(3).select(F.col("id").alias("k"), F.lit("x").alias("w"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        got = sorted(map(str, sizing.salted_join(facts, lookup, "k", how, spread_by="v").collect()))
        assert got == sorted(map(str, facts.join(lookup, "k", how).collect()))


def test_dates_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "posts")
    V.posts(spark, SF, ["title", "text", "url"]).write.parquet(path)
    posts = spark.read.parquet(path)
    anchor = datetime(2024, 1, 30, tzinfo=UTC)
    plan = plan_of(S.weekly_breakdown(posts, anchor))
    assert "GreaterThanOrEqual(published_at" in plan and "LessThan(published_at" in plan
    assert "title" not in plan and "engagement_score" not in plan
    trends = plan_of(R.category_trends(posts, anchor))
    assert "text:string" not in trends and "Python" not in trends
    top = plan_of(S.sample_posts(posts, anchor))
    assert "WindowGroupLimit" in top


def test_dedup_sends_one_row_per_id_and_task(spark):
    assert "WindowGroupLimit" in plan_of(K.dedup_mentions(V.collected(spark, SF)))


def test_window_filter_prunes_folders(spark, tmp_path):
    posts = T.materialize(V.posts(spark, SF, ["title", "text", "url"]), str(tmp_path / "p"))
    from trendloom.plans.dashboard import build_dashboard

    wl = spark.createDataFrame([("avec", "Avec")], "norm string, display string")
    T.write_dashboard(build_dashboard(posts, wl), str(tmp_path / "d"))
    tables = T.read_dashboard(spark, str(tmp_path / "d"), views=True)
    from trendloom.operators.board import select_window

    plan = plan_of(select_window(tables["category_stats"]))
    assert "PartitionFilters: [isnotnull(window_id" in plan
    assert spark.sql("SELECT count(*) FROM windows").first()[0] == 4
    cur_prev = spark.sql(
        "SELECT sum(current_mentions + previous_mentions) FROM category_stats WHERE window_id = 0"
    ).first()[0]
    assert cur_prev == spark.sql("SELECT sum(mentions) FROM weekly WHERE window_id = 0").first()[0]


def _tables(spark, mark):
    from trendloom.schema import DASHBOARD

    out = {}
    for name, schema in DASHBOARD.items():
        empty = spark.createDataFrame([], schema)
        columns = [F.lit(0 if c == "window_id" else None).cast(schema[c].dataType).alias(c) for c in schema.names]
        rows = spark.range(mark).select(*columns)
        out[name] = rows.unionByName(empty)
    return out


def test_dashboards_are_published_whole(spark, tmp_path):
    import os

    path = str(tmp_path / "board")
    with pytest.raises(FileNotFoundError):
        T.read_dashboard(spark, path)
    assert T.write_dashboard(_tables(spark, 1), path) == 1
    first = T.read_dashboard(spark, path)
    # a run that stops between two tables leaves the edition before readable
    broken = _tables(spark, 2)
    last = list(broken)[-1]
    broken[last] = broken[last].withColumn("window_id", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        T.write_dashboard(broken, path)
    assert {n: t.count() for n, t in T.read_dashboard(spark, path).items()} == dict.fromkeys(broken, 1)
    assert T.write_dashboard(_tables(spark, 3), path) == 2
    assert {t.count() for t in T.read_dashboard(spark, path).values()} == {3}
    # readers of the edition before can finish; the one after the next takes its place
    assert {t.count() for t in first.values()} == {1}
    assert {t.count() for t in T.read_dashboard(spark, path, edition=1).values()} == {1}
    assert T.write_dashboard(_tables(spark, 4), path) == 3
    assert sorted(T.dashboard_editions(spark, path)) == [2, 3]
    assert sorted(n for n in os.listdir(path + "/editions") if n[0] != ".") == ["000000000002", "000000000003"]
    with pytest.raises(FileNotFoundError):
        T.read_dashboard(spark, path, edition=1)
    with pytest.raises(RuntimeError):
        T._put(spark, path + "/editions", "000000000003", "other")
