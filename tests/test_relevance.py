"""Relevance to contexts where the vocabulary is too large to broadcast."""

import pytest

from tests.conftest import plan_of
from trendloom.operators import relevance as L


def test_terms_are_counted_in_the_row(spark):
    rows = [(1, ["b", "a", "b", "c", "b", "a"]), (2, []), (3, ["x"]), (4, None)]
    df = spark.createDataFrame(rows, "i int, w array<string>")
    counted = L._term_counts(df, "w")
    assert sorted(map(tuple, counted.collect())) == [(1, "a", 2), (1, "b", 3), (1, "c", 1), (3, "x", 1)]
    assert "Exchange" not in plan_of(counted)


@pytest.mark.parametrize("frequent", [0, 3, 1000])
def test_rare_words_alone_are_shuffled(spark, monkeypatch, frequent):
    posts = [(str(i % 25), f"red word{i}", "blue " * (i % 3) + f"red rare{i % 11} " + "z" * 70) for i in range(30)] + [("e", "", None)]
    df = spark.createDataFrame(posts, "mention_id string, title string, text string")
    contexts = spark.createDataFrame([("r", "red rare3"), ("b", "blue blue never")], "label string, text string")
    expected = sorted(map(tuple, L.context_scores(df, contexts).collect()))
    assert expected
    monkeypatch.setattr(L, "fits_broadcast", lambda *_: False)
    monkeypatch.setattr(L, "FREQUENT_WORDS", frequent)
    assert sorted(map(tuple, L.context_scores(df, contexts).collect())) == expected


@pytest.mark.parametrize("known", [0, 4, 20, 4_000_000])
def test_words_are_weighted_in_the_task(spark, monkeypatch, known):
    odd = ["Red, BLUE!", "  blue-RED\x1f\x0bÜBER über red", "", None, "…", "red" * 40, " Rareİ x", "I've [blue]_(red)\\~`^%"]
    posts = [(str(i % 25) if i % 7 else None, odd[i % 8], f"red rare{i % 11} w{i}\n" + "über " * (i % 3)) for i in range(40)]
    df = spark.createDataFrame(posts, "mention_id string, title string, text string").repartition(3)
    contexts = spark.createDataFrame(
        [("r", "red über RARE3 rare3"), ("b", "blue blue never"), ("n", "never"), (None, "red"), ("e", None)], "label string, text string"
    )
    text = L.F.concat(L.or_empty("title"), L.F.lit(" "), L.or_empty("text"))
    expected = sorted(map(tuple, L._joined_scores(df, contexts.filter("label is not null"), text, "mention_id").collect()), key=str)
    assert expected
    monkeypatch.setattr(L, "KNOWN_WORDS", known)
    scores = L.context_scores(df, contexts)
    assert sorted(map(tuple, scores.collect()), key=str) == expected
    assert "MapInArrow" in plan_of(scores) and ("Join" in plan_of(scores)) == (known < 1000)
    assert L.context_scores(df.limit(0), contexts).count() == 0
    assert L.context_scores(df, contexts.limit(0)).count() == 0


def test_words_whose_hashes_meet_are_told_apart(spark, monkeypatch):
    df = spark.createDataFrame([(str(i), f"red w{i % 3}", "blue w1") for i in range(9)], "mention_id string, title string, text string")
    contexts = spark.createDataFrame([("r", "red w1"), ("b", "blue w2")], "label string, text string")
    expected = sorted(map(tuple, L.context_scores(df, contexts).collect()))

    counts = L._document_counts

    def collide(batches):
        for batch in counts(batches):
            table = batch.to_pandas()
            table.loc[table["word"] == "w2", "hash"] = L.word_hashes(L.pa.array(["w1"])).view("int64")[0]
            yield L.pa.RecordBatch.from_pandas(table, schema=batch.schema, preserve_index=False)

    monkeypatch.setattr(L, "_document_counts", collide)
    scores = L.context_scores(df, contexts)
    assert sorted(map(tuple, scores.collect())) == expected
    assert "Join" in plan_of(scores)


def test_latin_texts_are_normalised_as_bytes(spark):
    chars = [chr(i) for i in range(256)]
    rows = [(f"A{c}b {c}", f"Z{c}{c}é") for c in chars]
    df = spark.createDataFrame([(str(i), *r) for i, r in enumerate(rows)], "i string, title string, text string")
    text = L.F.concat("title", L.F.lit(" "), "text")
    due = [r[0] for r in df.select(L._words(text)).collect()]
    got = [[w for w in L.plain(f"{a} {b}".encode()).decode().split(" ") if w] for a, b in rows]
    assert got == due
