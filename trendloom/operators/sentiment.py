"""Lexicon-and-rule sentiment as a Spark job over a lexicon table.

The text of a post becomes one row per word, words meet the lexicon in a
broadcast join (salted shuffle join when the lexicon is too large for that), and
the hits are summed per post; of the other words only their number goes on. Everything a rule needs from the neighbouring
words travels in the row, so no window over the words is needed.

With ``rules=False`` the score is the plain sum of valences over normalised
words. With ``rules=True`` five heuristics of Hutto & Gilbert (ICWSM 2014) are
added: degree words, negation within three preceding words, capitals, the
contrast word "but", and exclamation or question marks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import head, micro, micro_mean, norm_text, np_round, or_empty, tokens
from ..plans.sizing import lookup_join

POSITIVE_AT = 0.05
NEGATIVE_AT = -0.05
ALPHA = 15.0
MAX_CHARS = 500

# --- fixed values: published heuristics ------------------------------------
NEGATIONS = [
    "not", "no", "never", "none", "nobody", "nothing", "nowhere", "neither", "nor", "cannot",
    "cant", "dont", "doesnt", "didnt", "isnt", "arent", "wasnt", "werent", "wont", "wouldnt",
    "shouldnt", "couldnt", "hasnt", "havent", "hadnt", "aint", "without", "rarely", "seldom",
    "despite",
]
BOOSTERS = [
    "very", "really", "extremely", "absolutely", "amazingly", "completely", "deeply", "especially",
    "exceptionally", "greatly", "highly", "hugely", "incredibly", "more", "most", "particularly",
    "purely", "quite", "remarkably", "so", "substantially", "thoroughly", "totally",
    "tremendously", "unbelievably", "utterly",
]
DAMPENERS = [
    "almost", "barely", "hardly", "kinda", "less", "little", "marginally", "occasionally",
    "partly", "scarcely", "slightly", "somewhat", "sorta",
]
# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Rules:
    """Parameters of the rule set."""

    negations: list[str] = field(default_factory=lambda: list(NEGATIONS))
    boosters: list[str] = field(default_factory=lambda: list(BOOSTERS))
    dampeners: list[str] = field(default_factory=lambda: list(DAMPENERS))
    boost: float = 0.293
    caps: float = 0.733
    negate: float = -0.74
    damping: tuple[float, float, float] = (1.0, 0.95, 0.9)
    before_but: float = 0.5
    after_but: float = 1.5
    exclamation: float = 0.292
    max_exclamations: int = 4
    question: float = 0.18
    many_questions: float = 0.96


DEFAULT_RULES = Rules()


def sentiment_label(c: Column | str) -> Column:
    s = F.col(c) if isinstance(c, str) else c
    return F.when(s >= POSITIVE_AT, "positive").when(s <= NEGATIVE_AT, "negative").otherwise("neutral")


def scored_text(max_chars: int | None = MAX_CHARS) -> Column:
    """title, a space, and the first ``max_chars`` characters of text."""
    return F.concat(or_empty("title"), F.lit(" "), head(or_empty("text"), max_chars))


def sentiment_scores(
    df: DataFrame,
    lexicon: DataFrame,
    *,
    keep: list[str] | None = None,
    max_chars: int | None = MAX_CHARS,
    rules: bool | Rules = False,
) -> DataFrame:
    """One row per post: ``mention_id``, the ``keep`` columns and five sentiment columns.

    Ids must be unique (see ``dedup_mentions``): words are summed by id.
    ``keep`` carries narrow columns of the post through the aggregation, so
    that a consumer needs no join back to the posts; wide columns would be
    repeated per word, so join those by id. The words of a post are in one task,
    so they are summed before the shuffle by ``mention_id``.
    """
    keep = [c for c in (keep or []) if c != "mention_id"]
    spec = DEFAULT_RULES if rules is True else rules
    base = df.select("mention_id", *keep, scored_text(max_chars).alias("_text"))
    # A token may have several entries, and _nth tells the first one; a lexicon without such tokens is not shuffled.
    several = lexicon.filter(F.col("token").isNotNull()).groupBy("token").count().filter(F.col("count") > 1)
    entries = Window.partitionBy("token").orderBy("valence")
    nth = F.lit(1) if several.isEmpty() else F.row_number().over(entries)
    lex = lexicon.select(F.col("token").alias("_key"), F.col("valence").alias("_valence"), nth.alias("_nth"))
    words = _plain_words(base) if not spec else _ruled_words(base, spec)
    met = lookup_join(words, lex, "_key", "left", spread_by="mention_id")
    # Words without an entry only count, and the first row of a post carries how many words it has.
    starts = F.coalesce(F.col("_pos_in_post") == 0, F.lit(True))
    met = met.filter(F.col("_nth").isNotNull() | starts)
    if spec:
        met = _with_neighbours(met, lex, spec)
    hits = met.withColumn("_v", F.coalesce(_ruled_valence(spec) if spec else F.col("_valence"), F.lit(0.0)))
    v = F.col("_v")
    n_words = F.sum(F.when(starts & F.coalesce(F.col("_nth") == 1, F.lit(True)), F.col("_n_words")).otherwise(0))
    n_found = F.count(F.when(F.col("_nth") == 1, 1))
    n_idle = F.count(F.when(F.col("_nth").isNotNull() & (v == 0), 1))
    amp = F.max("_amp").alias("_amp") if spec else F.lit(0.0).alias("_amp")
    sums = hits.groupBy("mention_id", *keep).agg(
        F.sum(v).alias("_s"),
        F.sum(F.when(v > 0, v + 1).otherwise(0.0)).alias("_pos"),
        F.sum(F.when(v < 0, 1 - v).otherwise(0.0)).alias("_neg"),
        (n_words - n_found + n_idle).cast("double").alias("_neu"),
        amp,
    )
    return _finish(sums, keep)


def score_sentiment(
    df: DataFrame,
    lexicon: DataFrame,
    *,
    max_chars: int | None = MAX_CHARS,
    rules: bool | Rules = False,
) -> DataFrame:
    """``df`` with the five sentiment columns.

    Joins the scores back by ``mention_id``. On a table bucketed by
    ``mention_id`` neither the aggregate nor this join shuffles.
    """
    scores = sentiment_scores(df, lexicon, max_chars=max_chars, rules=rules)
    return df.join(scores, "mention_id", "left")


def _finish(sums: DataFrame, keep: list[str]) -> DataFrame:
    s, amp = F.col("_s"), F.col("_amp")
    total_s = F.when(s > 0, s + amp).when(s < 0, s - amp).otherwise(F.lit(0.0))
    compound = np_round(total_s / F.sqrt(total_s * total_s + F.lit(ALPHA)), 4)
    pos = F.col("_pos") + F.when(F.col("_pos") > F.col("_neg"), amp).otherwise(0.0)
    neg = F.col("_neg") + F.when(F.col("_pos") < F.col("_neg"), amp).otherwise(0.0)
    total = pos + neg + F.col("_neu")

    def share(c: Column) -> Column:
        return F.when(total == 0, F.lit(0.0)).otherwise(
            np_round(c / F.when(total == 0, F.lit(1.0)).otherwise(total), 3)
        )

    return sums.select(
        "mention_id",
        *keep,
        compound.alias("sentiment_compound"),
        share(pos).alias("sentiment_positive"),
        share(neg).alias("sentiment_negative"),
        share(F.col("_neu")).alias("sentiment_neutral"),
        sentiment_label(compound).alias("sentiment_label"),
    )


def _plain_words(base: DataFrame) -> DataFrame:
    rest = [c for c in base.columns if c != "_text"]
    normed = base.select(*rest, norm_text("_text").alias("_norm"))
    split = normed.select(*rest, F.split("_norm", " ").alias("_words"))
    # a blank text splits into one empty word, which keeps its post in the result
    n_words = F.size(F.array_remove("_words", "")).alias("_n_words")
    words = split.select(*rest, n_words, F.posexplode("_words").alias("_pos_in_post", "_key"))
    return words.withColumn("_key", F.nullif("_key", F.lit("")))


def _bare_words(words: Column) -> Column:
    """Outer punctuation removed, unless two characters or fewer would be left."""
    both = F.transform(
        words, lambda w: F.struct(w.alias("w"), F.regexp_replace(w, r"\A\p{Punct}+|\p{Punct}+\z", "").alias("b"))
    )
    return F.transform(both, lambda s: F.when(F.length(s["b"]) <= 2, s["w"]).otherwise(s["b"]))


def _ruled_words(base: DataFrame, spec: Rules) -> DataFrame:
    """One row per word with its three predecessors and the flags of its post."""
    rest = [c for c in base.columns if c != "_text"]
    text = F.col("_text")
    n_bang = F.least(F.length(text) - F.length(F.replace(text, F.lit("!"))), F.lit(spec.max_exclamations))
    n_what = F.length(text) - F.length(F.replace(text, F.lit("?")))
    amp = n_bang * F.lit(spec.exclamation) + (
        F.when(n_what <= 1, F.lit(0.0))
        .when(n_what <= 3, n_what * F.lit(spec.question))
        .otherwise(F.lit(spec.many_questions))
    )
    posts = base.select(*rest, amp.alias("_amp"), _bare_words(tokens("_text")).alias("_words"))
    shouted = F.size(F.filter("_words", _all_caps))
    posts = posts.select(
        *rest,
        "_amp",
        "_words",
        F.size("_words").alias("_n_words"),
        ((shouted > 0) & (shouted < F.size("_words"))).alias("_mixed_caps"),
        F.array_position(F.transform("_words", F.lower), F.lit("but")).alias("_but"),
    )
    blanks = [F.array(*[F.lit(None).cast("string")] * k) for k in (1, 2, 3)]
    shifted = [F.concat(b, F.col("_words")) for b in blanks]
    zipped = F.arrays_zip(
        F.col("_words").alias("w"),
        *[F.slice(s, F.lit(1), F.size("_words")).alias(f"p{i + 1}") for i, s in enumerate(shifted)],
    )
    of_post = [*rest, "_amp", "_n_words", "_mixed_caps", "_but"]
    words = posts.select(*of_post, F.posexplode_outer(zipped)).select(
        *of_post, F.col("pos").alias("_pos_in_post"), *[F.col(f"col.{c}").alias(f"_{c}") for c in ("w", "p1", "p2", "p3")]
    )
    return words.withColumn("_key", F.lower("_w"))


def _with_neighbours(met: DataFrame, lex: DataFrame, spec: Rules) -> DataFrame:
    """What the three predecessors of every word that is left do to it."""
    # A modifier that is itself in the lexicon scores on its own and modifies
    # nothing. At most len(modifiers) rows come back.
    modifiers = spec.negations + spec.boosters + spec.dampeners
    scoring = {r[0] for r in lex.filter(F.col("_key").isin(modifiers)).select("_key").distinct().collect()}
    live = {
        "boosters": [w for w in spec.boosters if w not in scoring],
        "dampeners": [w for w in spec.dampeners if w not in scoring],
        "negations": [w for w in spec.negations if w not in scoring],
    }
    out = met.withColumn("_is_modifier", F.col("_key").isin(spec.boosters + spec.dampeners))
    for i in (1, 2, 3):
        p = F.lower(f"_p{i}")
        out = out.withColumn(
            f"_boost{i}",
            F.when(_is_in(p, live["boosters"]), F.lit(spec.boost))
            .when(_is_in(p, live["dampeners"]), F.lit(-spec.boost))
            .otherwise(F.lit(0.0)),
        )
        out = out.withColumn(f"_loud{i}", F.coalesce(_all_caps(F.col(f"_p{i}")), F.lit(False)))
        out = out.withColumn(
            f"_neg{i}",
            F.coalesce(_is_in(p, live["negations"]) | p.contains("n't"), F.lit(False)),
        )
    return out.withColumn("_loud", F.coalesce(_all_caps(F.col("_w")), F.lit(False)))


def _is_in(c: Column, words: list[str]) -> Column:
    return c.isin(words) if words else F.lit(False)


def _all_caps(w: Column) -> Column:
    return w.rlike(r"\p{IsUppercase}") & ~w.rlike(r"[\p{IsLowercase}\p{Lt}]")


def _ruled_valence(spec: Rules) -> Column:
    raw = F.when(F.col("_is_modifier"), F.lit(0.0)).otherwise(F.col("_valence"))
    sign = F.signum(raw)
    caps = F.when(F.col("_loud") & F.col("_mixed_caps"), F.lit(spec.caps)).otherwise(0.0)
    v = raw + sign * caps
    for i, damp in zip((1, 2, 3), spec.damping):
        b = F.col(f"_boost{i}")
        loud = F.when(
            F.col(f"_loud{i}") & F.col("_mixed_caps") & (b != 0), F.lit(spec.caps)
        ).otherwise(0.0)
        v = v + sign * (b + loud) * F.lit(damp)
    flips = sum((F.col(f"_neg{i}").cast("int") for i in (1, 2, 3)), F.lit(0))
    v = v * F.pow(F.lit(spec.negate), flips)
    where = F.col("_pos_in_post") + 1
    weight = (
        F.when((F.col("_but") == 0) | F.col("_but").isNull(), F.lit(1.0))
        .when(where < F.col("_but"), F.lit(spec.before_but))
        .when(where > F.col("_but"), F.lit(spec.after_but))
        .otherwise(1.0)
    )
    return F.when(raw == 0, F.lit(0.0)).otherwise(v * weight)


def sentiment_summary(df: DataFrame) -> DataFrame:
    """Posts and mean compound per label."""
    return df.groupBy("sentiment_label").agg(
        
        F.count(F.lit(1)).alias("mentions"),
        micro_mean(F.sum(micro("sentiment_compound")), F.count("sentiment_compound")).alias(
            "mean_compound"
        ),
    )
