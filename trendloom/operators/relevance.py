"""Relevance to seed queries and business contexts, as the configuration declares it.

Posts and reference texts are TF-IDF vectors over normalised words; relevance is
the cosine. A handful of reference texts is compared, never post with post.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.latin import content, is_latin, plain, sliced, word_hashes
from ..functions.scalars import head, norm_text, np_round, or_empty
from ..plans.sizing import fits_broadcast, lookup_join
from ..session import staged

MIN_RELEVANCE = 0.015
KEEP_SCORE = 0.18
PRIORITY_BOOST = 0.3
# Of a vocabulary too large to broadcast, the most frequent words are: at most this many, of at most this many bytes.
FREQUENT_WORDS = 500_000
FREQUENT_BYTES = 64
# Words whose weights the tasks hold, by a hash of 8 bytes: 64 MB in all. Beyond them the most frequent are held.
KNOWN_WORDS = 4_000_000
SLICE_BYTES = 8_000_000  # of texts whose words are counted at once, about


def _words(text):
    """Normalised words of a text as an array."""
    return F.filter(F.split(norm_text(text), " "), lambda w: w != "")


def _term_counts(posts: DataFrame, words: str) -> DataFrame:
    """``posts`` with ``word`` and ``tf`` instead of the array ``words``, one row per distinct word.

    Sorted, equal words are runs; their starts tell how many there are, so counting needs no shuffle.
    """
    rest = [c for c in posts.columns if c != words]
    runs = posts.select(*rest, F.sort_array(words).alias("_r"))
    opens = F.zip_with("_r", F.concat(F.array(F.lit(None).cast("string")), "_r"), lambda w, before: w.eqNullSafe(before))
    places = F.transform(opens, lambda same, i: F.when(~same, i))
    starts = F.filter(F.slice(places, F.lit(1), F.size("_r")), lambda i: i.isNotNull())
    found = runs.filter(F.size("_r") > 0).select(*rest, "_r", starts.alias("_s"))
    ends = F.concat(F.slice("_s", F.lit(2), F.size("_s")), F.array(F.size("_r")))
    counted = F.zip_with(
        "_s", ends, lambda a, b: F.struct(F.get("_r", a).alias("word"), (b - a).cast("bigint").alias("tf"))
    )
    return found.select(*rest, F.explode(counted).alias("_t")).select(*rest, "_t.*")


def _with_idf(terms: DataFrame, weights: DataFrame) -> DataFrame:
    """``terms`` with the ``idf`` of their word.

    The words of a vocabulary too large to broadcast differ much in frequency: the frequent ones, which
    most terms are, are broadcast, so that only the terms of rare words are shuffled. No rare word is hot.
    """
    idf = weights.select("word", "idf")
    if fits_broadcast(idf):
        return terms.join(F.broadcast(idf), "word")
    cut = _least_frequency(weights, FREQUENT_WORDS)
    is_frequent = F.lit(False) if cut is None else (F.col("df") >= cut) & (F.octet_length("word") <= FREQUENT_BYTES)
    frequent = F.broadcast(weights.filter(is_frequent).select("word", "idf"))
    rare = weights.filter(~is_frequent).select("word", "idf")
    others = terms.join(F.broadcast(weights.filter(is_frequent).select("word")), "word", "left_anti")
    return terms.join(frequent, "word").unionByName(others.join(rare, "word"))


def context_scores(
    df: DataFrame, contexts: DataFrame, max_chars: int | None = None, id_col: str = "mention_id"
) -> DataFrame:
    """``(id, label, score)``: cosine of every post with every context it shares a word with.

    ``contexts(label, text)`` is a short list of reference texts. Inverse document
    frequencies come from the posts: ln((n + 1) / (df + 1)) + 1. Whole texts count
    unless ``max_chars`` is given. The words of a post are counted and weighted in its task: one shuffle by
    word for the document frequencies, and one of the rare words where they are too many for the tasks to hold.
    """
    text = F.concat(or_empty("title"), F.lit(" "), head(or_empty("text"), max_chars))
    if not fits_broadcast(contexts.select("label", F.explode(_words(F.col("text"))).alias("word"))):
        return _joined_scores(df, contexts, text, id_col)
    # texts of Latin characters alone (ISO 8859-1) are normalised as bytes, where they are split
    given = F.when(is_latin(text), text).otherwise(norm_text(text))
    posts = df.select(F.col(id_col).alias("_id"), F.monotonically_increasing_id().alias("_row"), given.alias("_t"))
    counted = posts.select("_t").mapInArrow(_document_counts, "word string, hash long, n long")
    seen = staged(counted.groupBy("word").agg(F.max("hash").alias("hash"), F.sum("n").alias("df")))
    n = seen.filter("word is null").agg(F.max("df")).first()[0] or 0
    weights = seen.filter("word is not null").select("word", "hash", "df", (F.log(F.lit(float(n + 1)) / (F.col("df") + 1)) + 1.0).alias("idf"))
    refs = _references(contexts, weights, n)
    # A hash that two words share is not held.
    twice = weights.groupBy("hash").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("hash")
    cut = _least_frequency(weights, KNOWN_WORDS)
    frequent = F.lit(False) if cut is None else F.col("df") >= cut
    held = weights.filter(frequent).join(twice, "hash", "left_anti").select("hash", "idf").toArrow()
    hashes, idf = (held.column(c).to_numpy() for c in (0, 1))
    order = np.argsort(hashes)
    known = df.sparkSession.sparkContext.broadcast((hashes[order], idf[order], refs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _post_sums(batches, *known.value)

    id_type = posts.schema["_id"].dataType.simpleString()
    sums = posts.mapInArrow(
        run, f"_id {id_type}, _row long, label string, dot double, ref_norm double, norm2 double, word string, tf long"
    )
    if len(hashes) < weights.count():
        doubled = twice.withColumn("_twice", F.lit(True))
        sums = _with_rare(sums, weights.join(doubled, "hash", "left").filter(~frequent | F.col("_twice").isNotNull()))
    return sums.select(
        F.col("_id").alias(id_col),
        "label",
        np_round(F.col("dot") / (F.sqrt("norm2") * F.col("ref_norm")), 6).alias("score"),
    )


def _references(contexts: DataFrame, weights: DataFrame, n: int) -> tuple:
    """What the tasks need of the reference texts, sorted by word: labels, their norms, and per word its entries.

    An entry is a label and the word's weight there times its inverse document frequency.
    """
    refs = contexts.select("label", F.explode(_words(F.col("text"))).alias("word")).filter(F.col("label").isNotNull())
    refs = staged(refs.groupBy("label", "word").agg(F.count(F.lit(1)).alias("tf")))
    idf = {r[0]: r[1] for r in weights.join(F.broadcast(refs.select("word").distinct()), "word").select("word", "idf").collect()}
    rows = sorted((r["word"], r["label"], r["tf"]) for r in refs.collect())
    unseen = math.log(n + 1) + 1.0
    ref = np.array([tf * idf.get(word, unseen) for word, _, tf in rows], dtype=np.float64)
    labels = sorted({r[1] for r in rows})
    place = {name: i for i, name in enumerate(labels)}
    label = np.array([place[r[1]] for r in rows], dtype=np.int64)
    norms = np.sqrt(np.bincount(label, weights=ref * ref, minlength=len(labels)))
    words = sorted({r[0] for r in rows})
    starts = np.searchsorted(np.array([r[0] for r in rows], dtype=object), np.array([*words], dtype=object)) if rows else np.zeros(0, dtype=np.int64)
    ends = np.r_[starts[1:], len(rows)].astype(np.int64)[: len(words)]
    return labels, norms, words, starts, ends, label, ref * np.array([idf.get(r[0], 0.0) for r in rows])


def _with_rare(sums: DataFrame, rare: DataFrame) -> DataFrame:
    """``sums`` with the squared lengths completed by the words that the tasks did not know."""
    # rows without a word meet nothing, and are spread
    spread = F.when(F.col("word").isNull(), F.col("_row")).otherwise(F.lit(-1)).alias("_spread")
    weights = rare.select("word", F.lit(-1).cast("bigint").alias("_spread"), "idf")
    met = sums.select("*", spread).join(weights, ["word", "_spread"], "left")
    weight = F.col("tf") * F.col("idf")
    # at most one entry per context
    entry = F.when(F.col("label").isNotNull(), F.struct("label", "dot", "ref_norm", "norm2"))
    whole = met.groupBy("_id", "_row").agg(
        F.coalesce(F.sum(weight * weight), F.lit(0.0)).alias("_more"), F.collect_list(entry).alias("found")
    )
    return whole.select("_id", "_more", F.explode("found").alias("f")).select(
        "_id", "f.label", "f.dot", "f.ref_norm", (F.col("f.norm2") + F.col("_more")).alias("norm2")
    )


def _least_frequency(weights: DataFrame, most: int) -> int | None:
    """The least ``df`` such that at most ``most`` words have it or more; None where even the most frequent are more."""
    # one row per frequency, one number to the driver
    down = Window.orderBy(F.desc("df"))
    sizes = weights.groupBy("df").agg(F.count(F.lit(1)).alias("n")).withColumn("n", F.sum("n").over(down))
    return sizes.filter(F.col("n") <= most).agg(F.min("df")).first()[0]


def _counted(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words in the order of their hashes, these, and a text, a word and its number there, row by row."""
    ends, data = content(texts)
    # a run of spaces splits into empty words, which do not count
    split = pc.split_pattern(pa.StringArray.from_buffers(len(texts), pa.py_buffer(ends), pa.py_buffer(plain(data))), " ")
    post = np.repeat(np.arange(len(texts), dtype=np.int64), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    coded = split.flatten().dictionary_encode()
    words = coded.dictionary.cast(pa.string())
    hashes = word_hashes(words).view(np.int64)
    order = np.argsort(hashes, kind="stable")
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    words, hashes = words.take(pa.array(order)), hashes[order]
    key = post * max(1, len(words)) + rank[coded.indices.to_numpy(zero_copy_only=False)]
    blank = pc.index(words, "").as_py()
    if blank >= 0:
        key = key[key % len(words) != blank]
    key.sort()
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
    tf = np.diff(np.r_[first, len(key)])
    return words, hashes, key[first] // max(1, len(words)), key[first] % max(1, len(words)), tf


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts a word occurs, with its hash; the texts themselves count under no word."""
    for batch in batches:
        for _, texts in sliced(batch.column(0), SLICE_BYTES):
            words, hashes, _, code, _ = _counted(texts)
            n = np.bincount(code, minlength=len(words))
            used = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([words.take(pa.array(used)), pa.nulls(1, pa.string())]),
                    pa.array(np.r_[hashes[used], 0]),
                    pa.array(np.r_[n[used], len(texts)]),
                ],
                names=["word", "hash", "n"],
            )


def _post_sums(
    batches: Iterator[pa.RecordBatch], known: np.ndarray, idf: np.ndarray, refs: tuple
) -> Iterator[pa.RecordBatch]:
    """One row per post and label it shares a word with: the product, and the squared length over the known words.

    The other words of these posts follow as rows of their own.
    """
    labels, norms, ref_words, starts, ends, label, product = refs
    ref_words, n_labels = pa.array(ref_words, pa.string()), max(1, len(labels))
    label_names = pa.array(labels, pa.string())
    for batch in batches:
        for begin, texts in sliced(batch.column(2), SLICE_BYTES):
            # sorted by hash, so that sums do not depend on what else a batch holds
            words, hashes, post, code, tf = _counted(texts)
            weight, is_known = np.zeros(len(words)), np.zeros(len(words), dtype=bool)
            if len(known):
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                is_known = known[at] == hashes
                weight = np.where(is_known, idf[at], 0.0)
            norm2 = np.bincount(post, weights=(weight[code] * tf) ** 2, minlength=len(texts))
            ref_at = pc.fill_null(pc.index_in(words, value_set=ref_words), -1).to_numpy()
            met = np.flatnonzero(ref_at[code] >= 0)
            r = ref_at[code[met]]
            times = ends[r] - starts[r]
            entry = np.repeat(starts[r] - np.cumsum(times) + times, times) + np.arange(times.sum())
            found, where = np.unique(np.repeat(post[met], times) * n_labels + label[entry], return_inverse=True)
            dot = np.bincount(where, weights=np.repeat(tf[met], times) * product[entry], minlength=len(found))
            hit, of = found // n_labels, found % n_labels
            matched = np.zeros(len(texts), dtype=bool)
            matched[hit] = True
            rest = np.flatnonzero(~is_known[code] & matched[post])
            rows, none = pa.array(np.r_[hit, post[rest]] + begin), pa.nulls(len(rest), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(rows),
                    batch.column(1).take(rows),
                    pa.concat_arrays([label_names.take(pa.array(of)), pa.nulls(len(rest), pa.string())]),
                    pa.concat_arrays([pa.array(dot, pa.float64()), none]),
                    pa.concat_arrays([pa.array(norms[of]), none]),
                    pa.concat_arrays([pa.array(norm2[hit], pa.float64()), none]),
                    pa.concat_arrays([pa.nulls(len(hit), pa.string()), words.take(pa.array(code[rest]))]),
                    pa.concat_arrays([pa.nulls(len(hit), pa.int64()), pa.array(tf[rest])]),
                ],
                names=["_id", "_row", "label", "dot", "ref_norm", "norm2", "word", "tf"],
            )


def _joined_scores(df: DataFrame, contexts: DataFrame, text: Column, id_col: str) -> DataFrame:
    """``context_scores`` where the reference texts are too many for the tasks to hold: their words are joined.

    The words of a post are counted within its row: one shuffle by word for the document
    frequencies, one by post for the sums.
    """
    posts = df.select(F.col(id_col).alias("_id"), F.monotonically_increasing_id().alias("_row"), _words(text).alias("_w"))
    n = df.count()
    seen = posts.select(F.explode(F.array_distinct("_w")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    weights = staged(seen.select("word", "df", (F.log(F.lit(float(n + 1)) / (F.col("df") + 1)) + 1.0).alias("idf")))
    unseen = F.lit(F.log(F.lit(float(n + 1))) + 1.0)
    refs = (
        contexts.select("label", F.explode(_words(F.col("text"))).alias("word"))
        .groupBy("label", "word").agg(F.count(F.lit(1)).alias("tf"))
        .join(weights, "word", "left")
        .select("label", "word", (F.col("tf") * F.coalesce("idf", unseen)).alias("ref"))
    )
    refs = staged(refs)  # words of a few texts
    norms = refs.groupBy("label").agg(F.sqrt(F.sum(F.col("ref") * F.col("ref"))).alias("ref_norm"))
    by_word = refs.join(norms, "label").groupBy("word").agg(
        F.collect_list(F.struct("label", "ref", "ref_norm")).alias("refs")
    )
    terms = _term_counts(posts, "_w")
    weighted = _with_idf(terms, weights).select("_id", "_row", "word", (F.col("tf") * F.col("idf")).alias("w"))
    # One pass: the norm needs all words, the products only the shared ones.
    matched = lookup_join(weighted, by_word, "word", "left", spread_by="_row")
    none = F.array(F.struct(*[F.lit(None).cast(t).alias(c) for c, t in
                              (("label", "string"), ("ref", "double"), ("ref_norm", "double"))]))
    rows = matched.select(
        "_id", "_row", "w", F.explode(F.concat(none, F.coalesce("refs", F.array_except(none, none)))).alias("r")
    ).select("_id", "_row", "w", "r.*")
    sums = rows.groupBy("_id", "_row", "label").agg(
        F.sum(F.when(F.col("label").isNull(), F.col("w") * F.col("w"))).alias("norm2"),
        F.sum(F.col("w") * F.col("ref")).alias("dot"),
        F.max("ref_norm").alias("ref_norm"),
    )
    # At most one entry per context.
    entry = F.when(F.col("label").isNotNull(), F.struct("label", "dot", "ref_norm"))
    return (
        sums.groupBy("_id", "_row")
        .agg(F.max("norm2").alias("norm2"), F.collect_list(entry).alias("found"))
        .select("_id", "norm2", F.explode("found").alias("f"))
        .select(
            F.col("_id").alias(id_col),
            F.col("f.label").alias("label"),
            np_round(F.col("f.dot") / (F.sqrt("norm2") * F.col("f.ref_norm")), 6).alias("score"),
        )
    )


def business_context(df: DataFrame, contexts: DataFrame, id_col: str = "mention_id") -> DataFrame:
    """``(id, business_context_label, semantic_relevance_score)``: best context of each post.

    A post that shares no word with a context keeps the defaults of a record: an
    empty label and a score of 0.
    """
    best = F.max(F.struct(F.col("score"), F.col("label")))
    found = context_scores(df, contexts, id_col=id_col).groupBy(id_col).agg(best.alias("b"))
    return df.select(id_col).distinct().join(found, id_col, "left").select(
        id_col,
        F.coalesce("b.label", F.lit("")).alias("business_context_label"),
        F.coalesce("b.score", F.lit(0.0)).alias("semantic_relevance_score"),
    )


def semantic_filter(
    df: DataFrame,
    seeds: DataFrame,
    min_score: float = MIN_RELEVANCE,
    keep_score: float = KEEP_SCORE,
    *,
    commerce_label: str | None = None,
    keep_all: bool = False,
    id_col: str = "mention_id",
) -> DataFrame:
    """``(id, semantic_relevance_score, tiktok_relevance_score)`` of the posts to keep.

    Relevance is the best score over ``seeds(label, text)``; the commerce score
    is the one of the seed named ``commerce_label``.
    """
    scores = context_scores(df, seeds, id_col=id_col)
    commerce = F.max(F.when(F.col("label") == F.lit(commerce_label), F.col("score")))
    found = scores.groupBy(id_col).agg(
        F.max("score").alias("semantic_relevance_score"),
        F.coalesce(commerce, F.lit(0.0)).alias("tiktok_relevance_score"),
    )
    if keep_all:
        return df.select(id_col).join(found, id_col, "left").fillna(0.0)
    return found.filter(
        (F.col("semantic_relevance_score") >= min_score)
        | (F.col("tiktok_relevance_score") >= keep_score)
    )


def priority_score(df: DataFrame, boost: float = PRIORITY_BOOST) -> DataFrame:
    """Add ``collector_priority_score`` = relevance + boost x commerce score."""
    return df.withColumn(
        "collector_priority_score",
        np_round(
            F.col("semantic_relevance_score") + F.lit(boost) * F.col("tiktok_relevance_score"), 6
        ),
    )
