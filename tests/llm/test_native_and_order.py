"""Pseudonyms, packing and mixing: small tables with every awkward case, and plain versions."""

import itertools
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from trendloom.llm import mixing, packing, pseudonyms
from trendloom.llm._common import n_words

AWKWARD = [
    (1, "plain words", "en", "a", 1),
    (2, "", "en", "a", 0),
    (3, None, None, None, None),
    (3, None, None, None, None),
    (None, "no id here", "en", "b", 10),
    (4, "word " * 30_000, "en", "b", 150_000),
    (5, "plain words", "en", "a", 11),
    (5, "plain words", "en", "a", 11),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    clash = spark.createDataFrame(AWKWARD, SCHEMA)
    return clash.withColumn("_rank", F.lit("x")).withColumn("n_card", F.lit("mine")).withColumn("_found", F.lit(1))


def test_pseudonyms_keep_their_format_and_come_back(spark):
    texts = [
        "a.b33@mail.example.com, 4111 1111 1111 1111 and 4111-1111-1111-1111; 4111111111111112",
        "+1 (316) 555-2121 10.0.0.255 256.1.1.1 01.2.3.4 1.2.3.4.5",
        "2020-02-29 2021-02-29 12/25/1990 25/12/1990 25.12.1990 1899-01-01",
        "123-45-6789 000-12-3456 666-12-3456 123-00-3456",
        "x" * 70 + "@b.c a@b.c @ q@r",
        "",
        None,
    ]
    given = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = pseudonymise_rows(given)
    assert [out[0][k] for k in ("n_email", "n_card")] == [1, 2]
    digits = [t for t in out[0]["text"].replace("-", " ").replace(";", "").split() if t.isdigit()]
    assert digits[0:4] == digits[4:8] and digits[-1] == "4111111111111112"  # equal values, invalid one kept
    assert luhn("".join(digits[:4])) and digits[0][0] == "4"
    assert (out[1]["n_phone"], out[1]["n_ip"]) == (1, 1) and "256.1.1.1 01.2.3.4 1.2.3.4.5" in out[1]["text"]
    assert out[2]["n_date"] == 3 and "2021-02-29" in out[2]["text"] and "25/12/1990" in out[2]["text"]
    assert out[3]["n_ssn"] == 1 and out[3]["text"].endswith("000-12-3456 666-12-3456 123-00-3456")
    assert out[4]["n_email"] == 1 and out[4]["text"].startswith("x" * 70) and out[5]["text"] == "" and out[6]["text"] is None
    assert all(a["text"] != t for a, t in zip(out[:4], texts))
    hidden = pseudonyms.pseudonymise(given, "text", "k", counts=False)
    back = pseudonyms.pseudonymise(hidden, "text", "k", inverse=True, counts=False)
    assert [r.text for r in back.orderBy("doc_id").collect()] == texts


def test_cards_beside_other_digits_and_dates_with_times(spark):
    def card(body):
        return next(body + c for c in "0123456789" if luhn(body + c))

    alone = "4111 1111 1111 1111"
    texts = [
        alone, f"1 {alone}", f"{alone} 123", f"12 34 {alone}", f"{alone} 2024-01-05", f"{alone} 05.01.2024", f"{alone} {alone}",
        "4111111111111111", "4111111111111111 123", "7-4111111111111111", "3782 822463 10005 99", "2024-01-05T10:00:00Z",
    ]
    whole = []  # 19 digits whose first 16 are no card
    for i in range(40):
        d = card(f"{622200000000000000 + 7919 * i}")
        if not luhn(d[:16]):
            whole.append(" ".join((d[:4], d[4:8], d[8:12], d[12:16], d[16:])))
    given = spark.createDataFrame(list(enumerate(texts + whole)), "doc_id long, text string")
    out = pseudonymise_rows(given)
    new = out[0]["text"]
    assert new != alone
    got = [r["text"] for r in out]
    assert got[1:4] == [f"1 {new}", f"{new} 123", f"12 34 {new}"] and got[6] == f"{new} {new}"
    assert all(g.startswith(new + " ") and r["n_date"] == r["n_card"] == 1 for g, r in zip(got[4:6], out[4:6]))
    assert got[7] == new.replace(" ", "") and got[8] == got[7] + " 123" and got[9] == "7-" + got[7]
    assert out[10]["n_card"] == 1 and got[10].endswith(" 99")
    assert out[11]["n_date"] == 1 and got[11][:10] != "2024-01-05" and got[11][10:] == "T10:00:00Z"
    assert len(whole) > 20 and all(r["n_card"] == 1 and r["text"] != t for r, t in zip(out[12:], whole))
    hidden = pseudonyms.pseudonymise(given, "text", "k", counts=False)
    back = pseudonyms.pseudonymise(hidden, "text", "k", inverse=True, counts=False)
    assert [r.text for r in back.orderBy("doc_id").collect()] == texts + whole


def pseudonymise_rows(given):
    return [r.asDict() for r in pseudonyms.pseudonymise(given, "text", "k").orderBy("doc_id").collect()]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def test_pseudonyms_are_one_to_one_on_a_whole_domain(spark):
    numbers = spark.range(17 * 40).select(F.col("id").alias("doc_id"), F.date_add(F.lit("1960-01-01").cast("date"), F.col("id").cast("int")).cast("string").alias("text"))
    out = [r.text for r in pseudonyms.pseudonymise(numbers, "text", "k").collect()]
    assert len(set(out)) == 17 * 40 and all("1900-01-01" <= d <= "2099-12-31" for d in out)


def test_pseudonyms_awkward_rows(docs):
    out = pseudonyms.pseudonymise(docs, "text", "k")
    assert Counter(r.text for r in out.collect()) == Counter(r[1] for r in AWKWARD)
    assert {"_found", "_rank", "lang"} <= set(out.columns) and out.schema["n_card"].dataType.simpleString() == "bigint"
    assert pseudonyms.pseudonymise(docs.limit(0), "text", "k").count() == 0


def test_best_boundaries_against_all_choices():
    random.seed(3)
    for _ in range(200):
        n = random.randint(1, 8)
        edges = sorted(random.sample(range(1, 60), n))
        counts = [random.randint(1, 9) for _ in edges]
        totals = [c * e - random.randint(0, c - 1) for c, e in zip(counts, edges)]
        k = random.randint(1, 4)

        def padding(ends):
            return sum(min(x for x in ends if x >= e) * c - t for e, c, t in zip(edges, counts, totals))

        got = packing.optimal_boundaries(edges, counts, totals, k)
        every = (list(s) + [edges[-1]] for r in range(k) for s in itertools.combinations(edges[:-1], r))
        assert len(got) <= k and padding(got) == min(map(padding, every))


def test_packing_awkward_rows(docs):
    out = packing.pack(docs, ["doc_id"], n_words(F.col("text")) + 1, [F.col("doc_id")], buckets=3, budget=16).collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in AWKWARD)
    batches = defaultdict(list)
    for r in out:
        assert r.n_tokens <= r.padded_length
        batches[r.bucket, r.batch].append(r)
    for rows in batches.values():
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
        assert len(rows) == 1 or len(rows) * rows[0].padded_length <= 16
    assert max(r.n_tokens for r in out) == 30_001
    assert packing.pack(docs.limit(0), ["doc_id"], F.lit(1), [F.col("doc_id")]).count() == 0


def test_packing_numbers_a_bucket_without_gaps(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 7 * (F.col("id") % 3)).alias("n"))
    out = packing.pack(rows, ["doc_id"], F.col("n"), [-F.col("doc_id")], buckets=4, budget=40).collect()
    for bucket in {r.bucket for r in out}:
        mine = sorted((r.batch, r.slot) for r in out if r.bucket == bucket)
        cap = max(1, 40 // max(1, next(r.padded_length for r in out if r.bucket == bucket)))
        assert mine == [divmod(i, cap) for i in range(len(mine))]


def test_schedule_is_never_a_block_away():
    random.seed(5)
    for _ in range(50):
        parts = [random.randint(1, 64) for _ in range(random.randint(1, 20))]
        done, total = [0] * len(parts), sum(parts)
        for t, (s, j) in enumerate(mixing.pfair_period(parts)):
            assert done[s] == j
            done[s] += 1
            assert all(abs(d - (t + 1) * p / total) < 1 for d, p in zip(done, parts))


def test_fine_weights_stay_within_a_block():
    for weights in ([1.0, 0.35], [1.0, 0.001], [3.0, 1.0, 0.001, 0.35, 1e-5]):
        parts, total = mixing.whole_parts(weights), sum(weights)
        done = [0] * len(parts)
        for t, (s, _) in zip(range(20_000), mixing.pfair_period(parts)):
            done[s] += 1
            assert all(abs(d - (t + 1) * w / total) < 1 for d, w in zip(done, weights))


def test_mixing_repeats_its_schedule(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLOTS", 50)
    rows = spark.range(1000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 4 == 0, "b").otherwise("a").alias("source"))
    weights = spark.createDataFrame([("a", 1.0), ("b", 0.35)], "source string, weight double")
    out = mixing.mix(rows, ["doc_id"], "source", weights, [F.col("doc_id")], block=1).orderBy("slot").collect()
    assert len({r.doc_id for r in out}) == len({r.slot for r in out}) == 1000
    for s in "ab":
        assert [r.block for r in out if r.source == s] == list(range(250 if s == "b" else 750))
    for n in range(50, 950, 50):  # a run of 50 slots is 37 to 13 blocks
        assert sum(r.source == "b" for r in out if r.slot < n) == 13 * n // 50


def test_mixing_many_sources_and_taken_names(spark):
    rows = spark.range(60_000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id").cast("string")).alias("source"), F.lit(1.0).alias("w")
    )
    out = mixing.mix(rows, ["doc_id"], "source", rows.select("source", "w"), [F.col("doc_id")])
    assert out.agg(F.count_distinct("doc_id"), F.count_distinct("slot"), F.max("slot")).first()[:] == (60_000, 60_000, 59_999)
    with pytest.raises(ValueError, match="slot"):
        mixing.mix(rows.withColumnRenamed("doc_id", "slot"), ["slot"], "source", rows.select("source", "w"), [F.col("slot")])


def test_mixing_awkward_rows(spark, docs):
    weights = spark.createDataFrame([("a", 2.0), (None, float("nan")), ("unseen", 1.0)], "source string, weight double")
    out = mixing.mix(docs, ["doc_id"], "source", weights, [F.col("doc_id")], block=1, resolution=2).collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in AWKWARD)
    assert len({r.slot for r in out}) == len(AWKWARD)  # one row a slot with blocks of one
    assert Counter(r.source for r in out)[None] == 2
    assert mixing.mix(docs.limit(0), ["doc_id"], "source", weights, [F.col("doc_id")]).count() == 0


def test_mixing_follows_weights(spark):
    rows = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 4 == 0, "rare").otherwise("often").alias("source")
    )
    weights = spark.createDataFrame([("rare", 1.0), ("often", 1.0)], "source string, weight double")
    out = mixing.mix(rows, ["doc_id"], "source", weights, [F.col("doc_id")], block=10).orderBy("slot", "place").collect()
    for n in range(20, 2000, 20):  # both last until slot 200
        assert Counter(r.source for r in out[:n])["rare"] == n // 2
