"""Toxicity with noisy-channel deobfuscation.

A disguised word (leetspeak, characters spaced or dotted apart, characters
repeated) is a lattice: every character may stand for itself, for the letters it
imitates, or for nothing. A Viterbi search under a character trigram model
trained on the corpus picks the likeliest reading, and the restored words are
scored like all others. Only lattices that hold a word with evidence are searched:
characters that may stand for each other fall into one class, and a lattice's
sequence of classes (repeats and separators left out) has to hold that of a word.

Evidence is learned from labelled rows: in how many toxic and clean documents a
word, or a word beginning of 4 to 7 characters, occurs. A document's score is a
logistic function of its strongest words, fitted on labelled rows that the
counts did not use. Words are looked up once per task and distinct word.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.plans.sizing import fits_broadcast
from trendloom.plans.staging import Stage

from ._blocks import release, releasing
from ._common import most_frequent, table, text_of

FEATURES = 50_000  # words and beginnings kept, at most
TRIGRAMS = 50_000  # character trigrams kept, at most
LEAST_TOXIC = 8  # toxic documents that a feature needs
PREFIXES = (4, 5, 6, 7)
SHORTEST = min(PREFIXES)
CACHE = 60_000  # words whose evidence a task remembers

# Letters that a character may imitate.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "(": "c", "*": "aeiou", "#": "h",
}
SEPARATORS = " .-_*~/\\,"
EDGE = "^"
PUNCTUATION = ".,;:!?\"'()[]{}<>«»“”„…|*$#~-_=+/\\"
PLAIN = "".join(c for c in PUNCTUATION if c not in LEET)  # imitates no letter
# Natural logs of the channel.
IMITATES, REPEATED, SPACED, BOUNDARY, ODD = -1.5, -0.7, -0.2, -1.0, -9.0

_MIXED = re.compile(r"[^\W\d_][0-9@$!|+*€#]+[^\W\d_]|^[0-9@$][^\W\d_]|[^\W\d_][0134570@$]+$", re.UNICODE)
_REPEAT = re.compile(r"([^\W\d_])\1\1", re.UNICODE)
_OPENS = re.compile(r"([^\W\d_])\1|\w[ .\-_*~/\\,]+\w", re.UNICODE)
_LEET = re.compile("[" + re.escape("".join(LEET)) + "]")
_TWICE = re.compile(r"([^\W\d_])\1", re.UNICODE)
_LETTER = re.compile(r"[^\W\d_]", re.UNICODE)
_SAME = re.compile(r"(.)\1+", re.DOTALL)
_SPLIT = re.compile(r"^\w(?:[.\-_*~/]\w){2,}$", re.UNICODE)


def _classes() -> dict[str, str]:
    """The class of each character that imitates or is imitated, but for ``*``, which may also be nothing."""
    of: dict[str, str] = {}
    for c, letters in LEET.items():
        if c not in SEPARATORS:
            joined = {of.get(x, x) for x in c + letters}
            name = min(joined)
            of.update({x: name for x in [*of, c, *letters] if of.get(x, x) in joined})
    return of


CLASSES = str.maketrans({**_classes(), **{c: "" for c in SEPARATORS}})
RUN = 24  # characters of a run that are read from each of its places


def skeleton(seen: str) -> str:
    """Classes of the characters, without separators, equal neighbours once: alike for a word and whatever stands for it."""
    return _SAME.sub(r"\1", seen.translate(CLASSES))


def core(token: str) -> str:
    """A lower-case token without the punctuation around it; a leading @ or $ before a letter stays."""
    if token[:1].isalnum() and token[-1:].isalnum():
        return token
    right = token.rstrip(PUNCTUATION)
    left = right.lstrip(PUNCTUATION + "@")
    at = len(right) - len(left)
    return right[at - 1 :] if at and right[at - 1] in "@$" and left[:1].isalpha() else left


def disguised(word: str) -> bool:
    """Whether a word shows leetspeak, a character three times in a row, or characters set apart."""
    return bool(_MIXED.search(word) or _REPEAT.search(word) or _SPLIT.match(word))


def readings(token: str, word: str) -> list[str]:
    """What of a lower-case token with the core ``word`` to decode: forms with doubled letters, inner separators or leetspeak.

    Punctuation at an edge may be letters or just punctuation: with none of it, with what stands next to the word
    (one character before, equal ones behind), and with all that imitates letters.
    """
    middle = token.strip(PUNCTUATION + "@")
    at = token.find(middle) if middle else 0
    before, behind = token[:at], token[at + len(middle) :]
    heads = {"", before[-1:].strip(PLAIN), before.lstrip(PLAIN)}
    tails = {"", behind[: len(behind) - len(behind.lstrip(behind[:1]))].strip(PLAIN), behind.rstrip(PLAIN)}
    forms = dict.fromkeys([word, *sorted(h + middle + t for h in heads for t in tails)])
    return [f for f in forms if _LETTER.search(f) and (_OPENS.search(f) or _LEET.search(f))]


@dataclass
class CharModel:
    """Interpolated character trigrams; words stand between edges."""

    counts: dict[str, int]
    _cache: dict[str, float] = field(default_factory=dict, repr=False)

    def __post_init__(self):
        self._two, self._one, self._first = Counter(), Counter(), Counter()
        for t, n in self.counts.items():
            self._two[t[1:]] += n
            self._first[t[:2]] += n
            self._one[t[2]] += n
        self._mid = Counter()
        for t, n in self._two.items():
            self._mid[t[0]] += n
        self._all = max(1, sum(self._one.values()))

    def logp(self, two: str, c: str) -> float:
        got = self._cache.get(two + c)
        if got is None:
            p = 0.7 * self.counts.get(two + c, 0) / max(1, self._first[two])
            p += 0.25 * self._two[two[1] + c] / max(1, self._mid[two[1]])
            p += 0.05 * (self._one[c] + 0.01) / (self._all + 10)
            got = self._cache[two + c] = math.log(p)
            if len(self._cache) > CACHE:
                self._cache.clear()
        return got

    def restore(self, seen: str) -> list[str]:
        """Viterbi: the likeliest words behind ``seen``, a disguised word or characters joined by spaces."""
        start, known = EDGE * 2, self._cache.get
        best: dict[str, tuple[float, tuple | None]] = {start: (0.0, None)}
        for k, o in enumerate(seen):
            new: dict[str, tuple[float, tuple | None]] = {}
            inner = 0 < k < len(seen) - 1
            gap = inner and o in SEPARATORS
            again = k and o == seen[k - 1]
            letters = [(c, IMITATES) for c in LEET.get(o, "")]
            if o not in SEPARATORS or not inner:
                letters.append((o, 0.0 if o.isalpha() else ODD))
            for state, (value, path) in best.items():
                if gap:
                    if state not in new or value + SPACED > new[state][0]:
                        new[state] = (value + SPACED, path)
                    if state != start:
                        v = value + BOUNDARY + self.logp(state, EDGE)
                        if start not in new or v > new[start][0]:
                            new[start] = (v, (EDGE, path))
                if again and state != start and (state not in new or value + REPEATED > new[state][0]):
                    new[state] = (value + REPEATED, path)
                for c, cost in letters:
                    p = known(state + c)
                    v = value + cost + (self.logp(state, c) if p is None else p)
                    into = state[1] + c
                    old = new.get(into)
                    if old is None or v > old[0]:
                        new[into] = (v, (c, path))
            best = dict(sorted(new.items(), key=lambda x: -x[1][0])[:64]) if len(new) > 64 else new
        _, path = max(((v + self.logp(s, EDGE), p) for s, (v, p) in best.items()), key=lambda x: x[0])
        chars = []
        while path is not None:
            chars.append(path[0])
            path = path[1]
        return [w for w in "".join(reversed(chars)).split(EDGE) if w]


@dataclass
class Model:
    words: dict[str, float]  # log odds of words, and of beginnings (marked by a leading edge)
    chars: CharModel
    weights: np.ndarray  # of 1, strongest, second, log(1 + strong words), strongest beyond 4
    _cache: dict[str, float] = field(default_factory=dict, repr=False)
    _singles: set[str] = field(default_factory=set, repr=False)  # cached tokens that are one character each
    _opens: dict[str, bool] = field(default_factory=dict, repr=False)  # whether a word that begins so may have evidence

    def __post_init__(self):
        self._shapes = {skeleton(w.lstrip(EDGE)) for w in self.words}
        self._sizes = sorted({len(x) for x in self._shapes})
        self._least = min(self._sizes, default=0)
        self._ordered = sorted(self._shapes)
        stars = set(skeleton("".join(LEET["*"])))
        self._of_stars = any(set(x) <= stars for x in self._shapes)
        self._openings = {x[: self._least] for x in self._shapes}
        self._beginnings = {w[1 : 1 + SHORTEST] for w in self.words if w[0] == EDGE}

    def may_hold(self, seen: str, anywhere: bool = False) -> bool:
        """Whether some reading of ``seen`` (or of a part of it) may hold a word with evidence; False is certain."""
        if EDGE in seen:
            return True
        if "*" in seen:
            # Behind the last letter a word goes on by any vowels; one that starts there holds nothing but vowels.
            head = seen.rstrip(SEPARATORS)
            if anywhere or self._of_stars or any(c in SEPARATORS for c in head):
                return True
            return self.may_begin(head)
        shape = skeleton(seen)
        starts = range(len(shape)) if anywhere or any(c in SEPARATORS for c in seen) else range(1)
        for i in starts:
            if shape[i : i + self._least] in self._openings and any(shape[i : i + n] in self._shapes for n in self._sizes):
                return True
        return False

    def may_begin(self, head: str) -> bool:
        """Whether some word that reads ``head`` and goes on in any way may have evidence; False is certain."""
        shape = skeleton(head)
        at = bisect_left(self._ordered, shape)
        longer = at < len(self._ordered) and self._ordered[at].startswith(shape)
        return longer or any(shape[:n] in self._shapes for n in self._sizes)

    def decoded(self, seen: str) -> list[float]:
        """Evidence of the words that the likeliest reading of ``seen`` holds."""
        return [self.weigh(w) for w in self.chars.restore(seen)] if self.may_hold(seen) else []

    def spaced(self, run: list[str]) -> list[float]:
        """Evidence of the words of a run of single characters.

        The reading of the whole run comes first; words that it does not hold may start at any later place, since
        the run may begin with words of one character ("such a" before a spaced word).
        """
        seen = " ".join(run)
        words = self.chars.restore(seen) if self.may_hold(seen) else []
        later: dict[str, float] = {}
        for i in range(1, len(run)):
            window = run[i : i + RUN]
            if self.may_hold("".join(window)):
                later.update((w, self.weigh(w)) for w in self.chars.restore(" ".join(window)))
        return [self.weigh(w) for w in words] + [x for w, x in later.items() if w not in words]

    def weigh(self, word: str) -> float:
        got = self.words.get(word)
        if got is not None:
            return got
        if word[:SHORTEST] not in self._beginnings:
            return 0.0
        return max((self.words.get(EDGE + word[:n], 0.0) for n in PREFIXES if len(word) > n), default=0.0)

    def token(self, token: str) -> float:
        got = self._cache.get(token)
        if got is None:
            word = token.rstrip(PLAIN)
            plain = word.isalpha()
            if plain and len(word) > SHORTEST:
                begins = self._opens.get(word[:SHORTEST])
                if begins is None:
                    begins = self._opens[word[:SHORTEST]] = self.may_begin(word[:SHORTEST])
                if not begins:
                    return 0.0
            elif not plain:
                word = core(token)
            got = self.weigh(word)
            # What is read below lies within the token; letters are read as they stand.
            if plain:
                opens = _TWICE.search(word) and self.may_hold(word)
            else:
                opens = (_LEET.search(token) or _OPENS.search(token)) and self.may_hold(token, anywhere=True)
            read = opens and disguised(word)
            if read:
                got = max([got, *self.decoded(word)])
            if opens and got <= 0:
                forms = (form for form in readings(token, word) if not (read and form == word))
                got = max([got, *(x for form in forms for x in self.decoded(form))])
            self._cache[token] = got
            if len(word) < 3 and single(token):
                self._singles.add(token)
        return got

    def evidence(self, text: str) -> tuple[float, float, float]:
        """Log odds of the strongest and the second strongest word, and log(1 + strong words)."""
        tokens = text.lower().split()
        if len(self._cache) > CACHE:
            self._cache.clear()
            self._singles.clear()
        if len(self._opens) > CACHE:
            self._opens.clear()
        found, known = [], self._cache.get
        for t in set(tokens):
            x = known(t)
            if x is None:
                x = self.token(t)
            if x > 0:
                found.append(x)
        at = [i for i, t in enumerate(tokens) if t in self._singles]
        if any(b - a == 2 for a, b in zip(at, at[2:])):
            for run in single_runs(tokens):
                found += [x for x in self.spaced(run) if x > 0]
        found.sort(reverse=True)
        strong = sum(x >= 3.0 for x in found)
        return (found[0] if found else 0.0, found[1] if len(found) > 1 else 0.0, math.log1p(strong))

    def score(self, text: str) -> float:
        z = float(self.weights @ inputs(*self.evidence(text)))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def inputs(strongest: float, second: float, strong: float) -> np.ndarray:
    return np.array([1.0, strongest, second, strong, max(0.0, strongest - 4.0)])


def single(token: str) -> str:
    """The one character that a token is without the punctuation around it; empty where it is more or less."""
    if len(token) > 1 and token[0].isalnum() and token[-1].isalnum():  # nothing to strip
        return ""
    return next((x for x in (token, token.strip(PLAIN), token.strip(PUNCTUATION)) if len(x) == 1), "")


def single_runs(tokens: list[str]) -> Iterator[list[str]]:
    """Runs of three and more tokens of one character each, punctuation around it left out."""
    run: list[str] = []
    for t in [*tokens, ""]:
        inner = single(t)
        if inner:
            run.append(inner)
            continue
        if len(run) >= 3:
            yield run
        run = []


def _count_features(labelled: DataFrame) -> DataFrame:
    """(kind, feature, toxic, clean) over (text, toxic): documents with a word or beginning, words with a trigram."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                by = {0: Counter(), 1: Counter()}
                for text, toxic in zip((x.as_py() for x in part.column(0)), part.column(1).to_pylist()):
                    words = {w for w in map(core, set(text.lower().split())) if w}
                    features = words | {EDGE + w[:n] for w in words for n in PREFIXES if len(w) > n}
                    by[int(toxic)].update(features)
                trigrams = Counter()
                for counted in by.values():
                    for w, n in counted.items():
                        if w[0] != EDGE and w.isalpha():
                            padded = EDGE * 2 + w + EDGE
                            for k in range(len(padded) - 2):
                                trigrams[padded[k : k + 3]] += n
                keys = list(by[0].keys() | by[1].keys())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(["w"] * len(keys) + ["t"] * len(trigrams), type=pa.string()),
                        pa.array(keys + list(trigrams), type=pa.string()),
                        pa.array([by[1][f] for f in keys] + [0] * len(trigrams), type=pa.int64()),
                        pa.array([by[0][f] for f in keys] + list(trigrams.values()), type=pa.int64()),
                    ],
                    names=["kind", "feature", "toxic", "clean"],
                )

    return (
        labelled.mapInArrow(releasing(partial), "kind string, feature string, toxic long, clean long")
        .groupBy("kind", "feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, steps: int = 40) -> np.ndarray:
    """Newton's method with a small ridge; rows seen ``n`` times."""
    w = np.zeros(x.shape[1])
    ridge = 0.5 * np.eye(x.shape[1])
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (y - p)) - ridge @ w
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(hessian, gradient)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return w


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    *,
    held_out: int = 0,
) -> Model:
    """A model from all labelled rows outside the fold crc32(doc_id as text) mod 5 = ``held_out``.

    Labels are broadcast where they were measured to be few; a document with
    several labels counts as toxic if one says so, null labels and
    null ids are left out. Of the four training folds, the one before the held-out
    fold fits the logistic function, the others are counted. Without labels of
    both kinds every score is the share of toxic labels.
    """
    spark = docs.sparkSession
    stage = Stage(spark, "toxicity")
    fold = (F.crc32(F.col("id").cast("string").cast("binary")) % 5).cast("int")
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("toxic")).dropna()
    known = known.groupBy("id").agg(F.max(F.col("toxic") != 0).cast("int").alias("toxic")).withColumn("fold", fold)
    known = known.filter(F.col("fold") != held_out)
    known = F.broadcast(known) if fits_broadcast(known) else known
    texts = docs.select(F.col(doc_id).alias("id"), text_of(F.col(text)).alias("x")).filter(F.col("id").isNotNull())
    used = stage.write(texts.join(known, "id").select("x", "toxic", "fold"))
    fitting = (held_out + 4) % 5
    counted = used.filter(F.col("fold") != fitting)
    sizes = {r[0]: r[1] for r in counted.groupBy("toxic").count().collect()}
    shares = used.agg(F.avg("toxic")).first()[0]
    features = stage.write(_count_features(counted.select("x", "toxic")))
    odds = F.log((F.col("toxic") + 0.5) / (sizes.get(1, 0) + 1.0)) - F.log((F.col("clean") + 0.5) / (sizes.get(0, 0) + 1.0))
    strong = features.filter((F.col("kind") == "w") & (F.col("toxic") >= LEAST_TOXIC)).withColumn("odds", odds)
    rows = most_frequent(strong.filter("odds >= 2.0"), "toxic", FEATURES).select("feature", "odds").toArrow()
    words = dict(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()))
    rows = most_frequent(features.filter("kind = 't'"), "clean", TRIGRAMS).select("feature", "clean").toArrow()
    chars = CharModel(dict(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist())))
    model = Model(words, chars, np.zeros(5))

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([model.evidence(x.as_py()) for x in batch.column(0)]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(np.round(found[:, k], 1)) for k in range(3)), batch.column(1)], names=["a", "b", "c", "y"]
            )

    grid = (
        used.filter(F.col("fold") == fitting).select("x", "toxic")
        .mapInArrow(releasing(evidence), "a double, b double, c double, y int")
        .groupBy("a", "b", "c", "y").count().collect()  # tenths: bounded by the range of the log odds
    )
    share = min(max(shares if shares is not None else 0.0, 1e-6), 1 - 1e-6)
    model.weights[0] = math.log(share / (1 - share))
    if {r.y for r in grid} == {0, 1}:
        x = np.array([inputs(r.a, r.b, r.c) for r in grid])
        model.weights = _logistic(x, np.array([float(r.y) for r in grid]), np.array([float(r["count"]) for r in grid]))
    return model


def toxicity(model: Model, text: Column) -> Column:
    """Score in 0..1 of a whole text (null: empty), as an Arrow function over batches."""

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release()
        for batch in batches:
            yield pa.array([model.score(x.as_py()) for x in batch], type=pa.float64())
        release()

    return scored(text_of(text))


def op2_toxicity(spark, sf_dir):
    """All documents, scored by a model of the labels outside the fold crc32 mod 5 = 0."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    scored = docs.select("doc_id", held.alias("held_out"), toxicity(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
