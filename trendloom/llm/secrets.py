"""Secret scan with a linear-chain conditional random field.

Three patterns find what is surely a secret; a conditional random field over
tokens (states: outside, begin, inside) finds what stands and looks like one. Its
features are the shape, length, character classes and entropy of a token and of
its two neighbours on either side, neighbouring words, and what kind of file it
is. It is fitted by maximum likelihood on windows around matches of the patterns
and on windows without any, and decoded by Viterbi. So that it learns more than
the patterns know, every window is fitted on a second time in another form:
secrets drawn anew in other alphabets and lengths, under other names or none;
numbers, dates, paths, addresses and identifiers in clean windows.

Scores of a token are looked up once per task and distinct token. Where a
token's outside score leads by more than two transitions could win back, the
best path is outside there; only the runs between such tokens are decoded.
"""

from __future__ import annotations

import itertools
import math
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ._blocks import release, releasing
from ._common import table, text_of

SAMPLE_ROWS = 100_000  # documents read for fitting, at most; the choice goes by a hash of the text
WINDOWS = 1_500  # windows with and without a match fitted on, at most of each, in two forms
REACH = 12  # tokens on either side of a match in its window
FORMS = 10  # other forms of a window with a match, at most
PER_TEXT = 4  # matches of a text that give windows
CLEAN_TEXTS = 16  # one in so many texts without a match gives a window
TOKEN_CHARS = 512  # a longer token of a window is cut for fitting; scoring reads all of it
DIMENSIONS = 1 << 14
CACHE = 60_000  # tokens whose row a task remembers
PORTION_CHARS = 250_000  # of texts scored at once and handed on; a longer text is a portion of its own
FIT_TOKENS = 8_192  # tokens of the windows whose weights are gathered at once
OFFSETS = (-2, -1, 0, 1, 2)
OUTSIDE, BEGIN, INSIDE = 0, 1, 2

# The patterns, whose keywords are found in either case.
ASSIGN = re.compile(
    r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "crf")
TOKEN = re.compile(r"\w+(?:[+/.\-]+\w+)*=*|[^\w\s]")

# What drawn secrets are made of, and names that they stand behind.
LOWER, CAPITALS, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ALPHABETS = (
    DIGITS + "abcdef", DIGITS + "ABCDEF", DIGITS + LOWER, DIGITS + CAPITALS, DIGITS + LOWER + CAPITALS,
    DIGITS + LOWER + CAPITALS, DIGITS + LOWER + CAPITALS + "+/", DIGITS + LOWER + CAPITALS + "-_",
)
NAMES = (
    "pwd", "pass", "auth", "key", "private_key", "access_key", "AWS_KEY", "credential", "bearer", "signature",
    "client_id", "PASS", "authorization", "signing_key",
)
FIELDS = (
    "id", "name", "date", "state", "version", "path", "host", "count", "size", "user", "price", "ref", "url", "call",
    "ip", "mail", "phone", "card", "time", "order",
)
KEYWORD = re.compile(r"(?ai:password|passwd|secret|token|api_?key)=*")


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    """(start, end, kind, start of the secret itself) of the patterns' matches, by start, then kind as listed."""
    found = []
    if ":" in text or "=" in text:
        found += [(*m.span(), "assign", m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(*m.span(), "access", m.start()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(*m.span(), "hex", m.start()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def signature(token: str) -> tuple:
    """Shape, length, classes, share of digits, entropy and changes of a token; words of letters share few signatures."""
    size = min(len(token) // 4, 12)
    if token.isalpha():
        case = "a" if token.islower() else "A" if token.isupper() else "Aa" if token[1:].islower() else "aA"
        return (case, size)
    if len(token) == 1:
        return (token if token.isascii() and not token.isdigit() else "9" if token.isdigit() else "?", size)
    counts = Counter(token)
    shape = "".join(kind for kind, _ in itertools.groupby(map(_kind, token)))
    digits = sum(n for c, n in counts.items() if c.isdigit())
    entropy = -sum(n / len(token) * math.log2(n / len(token)) for n in counts.values())
    charset = (
        "digits" if token.isdigit() else "hex" if counts.keys() <= set("0123456789abcdef")
        else "caps" if token.isupper() and token.isalnum() else "alnum" if token.isalnum() else "other"
    )
    return (
        shape[:6], size, charset, 4 * digits // len(token), int(2 * entropy), min(len(shape) // 3, 6),
    )


def _kind(c: str) -> str:
    return "9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c


def _dimension(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "replace")) % DIMENSIONS


def features(token: str) -> list[str]:
    """Names of a token's features, without the place they are seen from."""
    word = [f"w={token.lower()}"] if len(token) <= 16 else []
    return word + [f"{i}={x}" for i, x in enumerate(signature(token))]


def file_features(text: str, n_tokens: int) -> list[str]:
    marks = sum(text.count(c) for c in "=:{};")
    return [
        f"f.marks={min(8, int(math.log2(1 + marks)))}",
        f"f.share={min(6, int(20 * marks / max(1, n_tokens)))}",
        f"f.size={min(8, int(math.log10(1 + len(text))))}",
    ]


class _Rows(dict):
    """Token -> row of the table of vectors; tokens of one signature share a row."""

    def __init__(self, crf: Crf):
        super().__init__()
        self.crf, self.size = crf, 1  # row 0: between texts
        self.vectors = np.zeros((1024, len(OFFSETS), 3), dtype=np.float32)  # room for twice the rows whenever it is full
        self.known: dict[tuple, int] = {}

    def __missing__(self, token: str) -> int:
        sig, word = signature(token), token.lower() if len(token) <= 16 else ""
        key = (sig, word if word in self.crf.words else "")
        row = self.known.get(key)
        if row is None:
            names = [f"{i}={x}" for i, x in enumerate(sig)] + ([f"w={word}"] if key[1] else [])
            row = self.known[key] = self.size
            if row == len(self.vectors):
                self.vectors = np.concatenate([self.vectors, np.zeros_like(self.vectors)])
            self.vectors[row] = self.crf.vector(names)
            self.size += 1
        self[token] = row
        return row

    def trim(self) -> None:
        if len(self.known) > CACHE:
            self.clear()
            self.known.clear()
            self.size = 1
        elif len(self) > CACHE:
            self.clear()


@dataclass
class Crf:
    """Weights by hashed feature and state, moves from state to state, and the words that have features."""

    weights: np.ndarray  # (DIMENSIONS, 3)
    moves: np.ndarray  # (3, 3), from row to column
    words: frozenset[str] = frozenset()
    _rows: _Rows | None = field(default=None, repr=False)

    def vector(self, names: list[str]) -> np.ndarray:
        """(offsets, 3): what features of a token add to the scores of the tokens around it."""
        out = np.zeros((len(OFFSETS), 3), dtype=np.float32)
        for k, o in enumerate(OFFSETS):
            for name in names:
                out[k] += self.weights[_dimension(f"{o}|{name}")]
        return out

    def scores(self, texts: list[str], tokens: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of all tokens of all texts, and where each text begins.

        Two empty places, surely outside, stand before every text and at the end.
        """
        if self._rows is None:
            self._rows = _Rows(self)
        self._rows.trim()
        sizes = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        starts = np.cumsum(sizes + 2) - sizes
        real = np.ones(int(sizes.sum()) + 2 * len(texts) + 2, dtype=bool)
        real[starts - 1] = real[starts - 2] = real[-2:] = False
        ids = np.zeros(len(real), dtype=np.int64)
        ids[real] = np.fromiter(
            map(self._rows.__getitem__, itertools.chain.from_iterable(tokens)), dtype=np.int64, count=int(sizes.sum())
        )
        near = self._rows.vectors[ids]
        files = np.array(
            [sum(self.weights[_dimension(n)] for n in file_features(x, len(t))) for x, t in zip(texts, tokens)],
            dtype=np.float32,
        ).reshape(len(texts), 3)
        out = near[:, OFFSETS.index(0)].copy()
        for k, o in enumerate(OFFSETS):
            if o < 0:
                out[-o:] += near[:o, k]
            elif o > 0:
                out[:-o] += near[o:, k]
        out[real] += np.repeat(files, sizes, axis=0)
        out[~real] = (1e6, 0.0, 0.0)
        return out, starts

    def decode(self, scores: np.ndarray) -> np.ndarray:
        """The best state of every place; the first and the last are outside."""
        states = np.zeros(len(scores), dtype=np.int8)
        spread = self.moves.max() - self.moves.min()
        at = np.flatnonzero(scores[:, OUTSIDE] - scores[:, 1:].max(axis=1) <= 2 * spread)
        if not len(at):
            return states
        heads = np.flatnonzero(np.concatenate([[True], np.diff(at) > 1]))
        begin, size = at[heads], np.diff(np.concatenate([heads, [len(at)]]))
        order = np.argsort(-size, kind="stable")
        begin, size = begin[order], size[order]
        # All runs step together, the longest first, so that those still running come first.
        longer = [int(np.searchsorted(-size, -k, side="left")) for k in range(int(size[0]) + 1)]
        best = scores[begin] + self.moves[OUTSIDE]
        state = np.zeros(len(begin), dtype=np.int8)
        back = []
        for k in range(1, int(size[0]) + 1):
            here = longer[k]
            state[here : len(best)] = np.argmax(best[here:] + self.moves[:, OUTSIDE], axis=1)
            if not here:
                break
            reach = best[:here, :, None] + self.moves[None]
            back.append(np.argmax(reach, axis=1).astype(np.int8))
            best = np.max(reach, axis=1) + scores[begin[:here] + k]
        for k in range(int(size[0]) - 1, -1, -1):
            live = longer[k]
            states[begin[:live] + k] = state[:live]
            if k:
                state[:live] = back[k - 1][np.arange(live), state[:live]]
        return states

    def tags(self, texts: list[str]) -> Iterator[tuple[int, list[str], np.ndarray]]:
        """(place, tokens, states) of the texts in which some token is not outside."""
        tokens = [TOKEN.findall(x) for x in texts]
        scores, starts = self.scores(texts, tokens)
        states = self.decode(scores)
        for i in np.unique(np.searchsorted(starts, np.flatnonzero(states), side="right") - 1).tolist():
            yield i, tokens[i], states[starts[i] : starts[i] + len(tokens[i])]

    def find(self, texts: list[str]) -> list[list[tuple[int, int, str]]]:
        """All spans of each text: the patterns' and those tagged ones that meet none of them."""
        spans = [[s[:3] for s in base_spans(x)] for x in texts]
        for i, _, states in self.tags(texts):
            where = [m.span() for m in TOKEN.finditer(texts[i])]
            taken, more, k = spans[i], [], 0
            while k < len(states):
                if states[k] == OUTSIDE:
                    k += 1
                    continue
                j = k + 1
                while j < len(states) and states[j] == INSIDE:
                    j += 1
                a, b = where[k][0], where[j - 1][1]
                if not any(s < b and a < e for s, e, _ in taken):
                    more.append((a, b, "crf"))
                k = j
            if more:
                spans[i] = sorted(taken + more, key=lambda s: (s[0], KINDS.index(s[2])))
        return spans


def _windows(sample: DataFrame) -> DataFrame:
    """(match, hash, tokens, states, file) of windows around matches, and of one window a text without any."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[], [], [], [], []]
            for text, at in zip((x.as_py() for x in batch.column(0)), batch.column(1).to_pylist()):
                spans = base_spans(text)
                if not spans and at % CLEAN_TEXTS:
                    continue
                found = list(TOKEN.finditer(text))
                states = [OUTSIDE] * len(found)
                begins = np.array([m.start() for m in found])
                centres = []
                for _, end, _, start in sorted(spans, key=lambda s: s[3]):
                    i, j = np.searchsorted(begins, [start, end])
                    if i < j and states[i] == OUTSIDE:
                        states[i:j] = [BEGIN] + [INSIDE] * (int(j - i) - 1)
                        centres.append(int(i))
                if not spans and found:
                    centres = [at // CLEAN_TEXTS % len(found)]
                file = file_features(text, len(found))
                for c in centres[:PER_TEXT]:
                    a, b = max(0, c - REACH), c + REACH + 1
                    for column, value in zip(
                        rows, (bool(spans), at, [m[0][:TOKEN_CHARS] for m in found[a:b]], states[a:b], file)
                    ):
                        column.append(value)
            kinds = (pa.bool_(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=k) for c, k in zip(rows, kinds)], names=["match", "at", "tokens", "states", "file"]
            )

    return sample.mapInArrow(
        releasing(cut), "match boolean, at long, tokens array<string>, states array<int>, file array<string>"
    )


def _drawn_secret(draw: random.Random) -> str:
    """Letters and digits of one alphabet, 16 to 64 of them, at times behind a short prefix or with a padded end."""
    letters = draw.choice(ALPHABETS)
    body = "".join(draw.choices(letters, k=draw.choice((16, 18, 20, 24, 28, 32, 36, 40, 44, 52, 64))))
    if draw.random() < 0.25:
        body = "".join(draw.choices(LOWER, k=draw.randint(2, 4))) + draw.choice("_-") + body
    return body + "=" * (draw.randint(0, 2) if "/" in letters else 0)


def _drawn_plain(draw: random.Random, words: list[str]) -> str:
    """What has digits or marks and is no secret: numbers, dates, times, versions, addresses, paths, identifiers."""
    one, two, three = (draw.choice(words) for _ in range(3))
    number = draw.randint(0, 10 ** draw.randint(2, 19))
    return draw.choice((
        f"{number}", f"{number:,}", f"{number % 10**4}.{number % 97}", f"{number % 10**6}%",
        f"{1950 + number % 90}-{1 + number % 12:02d}-{1 + number % 28:02d}", f"{number % 24:02d}:{number % 60:02d}:07",
        f"2024-0{1 + number % 9}-1{number % 10}T0{number % 10}:10:00Z", f"v{number % 9}.{number % 31}.{number % 7}",
        f"{number % 256}.{number % 199}.{number % 101}.{number % 251}", f"{one}.{number % 100}@mail{number % 10}.example.com",
        f"https://www.example.com/{one}/{two}-{three}/{number % 10**6}", f"/usr/{one}/{two}{number % 10}/{three}.txt",
        f"{one}_{two}_{number % 100}", f"{one}{two.capitalize()}{three.capitalize()}{number % 10}", f"{one}{number % 10**4}",
        f"{one}{two}{three}", f"{one}-{two}-{three}", f"{one.upper()}_{two.upper()}", f"+{number % 99} {number % 10**9}",
        f"{one.capitalize()}{two.capitalize()}", f"{one}{two.capitalize()}By{three.capitalize()}{number % 10}({two})",
        f"{one.upper()}{number % 1000}", f"{one}/{two}/{three}", f"0x{number % 65536:x}",
    ))


def _varied(row, words: list[str], form: int) -> tuple[list[str], list[int]]:
    """Another form of a window; what is drawn follows from the form's number and the window's hash and tokens."""
    draw = random.Random(f"{form} {row.at} {' '.join(row.tokens)}")
    given, state = list(row.tokens), list(row.states)
    tokens: list[str] = []
    states: list[int] = []
    if not row.match:
        at = draw.randint(0, len(given))
        plain = TOKEN.findall(_drawn_plain(draw, words))
        if draw.random() < 0.6:
            plain = TOKEN.findall(f"{draw.choice(FIELDS)}{draw.choice((' = ', ': ', '=', ' '))}{' '.join(plain)}")
        tokens = [*given[:at], *plain, *given[at:]]
        return tokens, [OUTSIDE] * len(tokens)
    k = 0
    while k < len(given):
        if state[k] != BEGIN:
            tokens.append(given[k])
            states.append(OUTSIDE)
            k += 1
            continue
        head = next((h for h in range(len(tokens) - 1, max(-1, len(tokens) - 5), -1) if KEYWORD.fullmatch(tokens[h])), None)
        way = draw.random()
        if head is not None and way < 0.25:  # the secret alone among words
            del tokens[head:], states[head:]
        elif head is not None and way < 0.85:
            lead = TOKEN.findall(draw.choice(NAMES) + draw.choice((" = ", ": ", "=", " = \"", " ")))
            tokens[head:], states[head:] = lead, [OUTSIDE] * len(lead)
        drawn = TOKEN.findall(_drawn_secret(draw))
        tokens += drawn
        states += [BEGIN] + [INSIDE] * (len(drawn) - 1)
        k += 1
        while k < len(given) and state[k] == INSIDE:
            k += 1
    return tokens, states


def _fit(rows: list, steps: int = 60) -> Crf:
    """Maximum likelihood by gradient steps with momentum scaling; sequences are padded and run side by side."""
    n, length = len(rows), max((len(r.tokens) for r in rows), default=0)
    weights, moves = np.zeros((DIMENSIONS + 1, 3)), np.zeros((3, 3))
    if not n or not length:
        weights[:, OUTSIDE] = 1.0
        return Crf(weights[:DIMENSIONS], moves)
    names: dict[str, list[str]] = {}
    lists, gold, real = [], np.zeros((n, length), dtype=np.int64), np.zeros((n, length), dtype=bool)
    for i, r in enumerate(rows):
        file = [_dimension(f) for f in r.file]
        for k, token in enumerate(r.tokens):
            dims = list(file)
            for o in OFFSETS:
                if 0 <= k + o < len(r.tokens):
                    near = r.tokens[k + o]
                    if near not in names:
                        names[near] = features(near)
                    dims += [_dimension(f"{o}|{f}") for f in names[near]]
            lists.append(np.array(dims, dtype=np.int32))
            gold[i, k], real[i, k] = r.states[k], True
    most = max(map(len, lists))
    flat = np.full((len(lists), most), DIMENSIONS, dtype=np.int32)
    for k, dims in enumerate(lists):
        flat[k, : len(dims)] = dims
    del lists
    where = np.nonzero(real)
    sizes = real.sum(axis=1)
    first, second = [np.zeros_like(weights), np.zeros_like(moves)], [np.zeros_like(weights), np.zeros_like(moves)]
    observed = np.zeros((len(flat), 3))
    observed[np.arange(len(flat)), gold[where]] = 1.0
    pairs = real[:, 1:]
    seen_moves = np.zeros((3, 3))
    np.add.at(seen_moves, (gold[:, :-1][pairs], gold[:, 1:][pairs]), 1.0)
    index = flat.ravel()
    for step in range(1, steps + 1):
        scores = np.zeros((n, length, 3))
        scores[where] = np.concatenate(
            [weights[flat[k : k + FIT_TOKENS]].sum(axis=1) for k in range(0, len(flat), FIT_TOKENS)]
        )
        alpha, beta = np.zeros((n, length, 3)), np.zeros((n, length, 3))
        alpha[:, 0] = scores[:, 0]
        for k in range(1, length):
            alpha[:, k] = np.logaddexp.reduce(alpha[:, k - 1, :, None] + moves[None], axis=1) + scores[:, k]
        for k in range(length - 2, -1, -1):
            ahead = np.logaddexp.reduce(moves[None] + (beta[:, k + 1] + scores[:, k + 1])[:, None, :], axis=2)
            beta[:, k] = np.where(pairs[:, k][:, None], ahead, 0.0)
        total = np.logaddexp.reduce(alpha[np.arange(n), sizes - 1], axis=1)
        marginal = np.exp(alpha + beta - total[:, None, None])[where]
        both = np.exp(
            alpha[:, :-1, :, None] + moves[None, None] + (scores + beta)[:, 1:, None, :] - total[:, None, None, None]
        )[pairs].sum(axis=0)
        error = observed - marginal
        gradient = np.stack(
            [np.bincount(index, weights=np.repeat(error[:, s], most), minlength=DIMENSIONS + 1) for s in range(3)], axis=1
        )
        gradient[DIMENSIONS] = 0.0
        for p, g, m, v, decay in (
            (weights, gradient - 0.1 * weights, first[0], second[0], 0.1),
            (moves, seen_moves - both - 1.0 * moves, first[1], second[1], 0.1),
        ):
            m += 0.1 * (g - m)
            v += 0.02 * (g * g - v)
            p += decay * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.98**step)) + 1e-3)
    weights[DIMENSIONS] = 0.0
    words = frozenset(t.lower() for t in names if len(t) <= 16)
    return Crf(np.round(weights[:DIMENSIONS], 3), np.round(moves, 3), words)


def train(docs: DataFrame, text: str = "text", *, sample_rows: int = SAMPLE_ROWS, windows: int = WINDOWS) -> Crf:
    """A model from at most ``sample_rows`` texts and ``windows`` windows of either sort.

    The patterns are its teachers: the first ``PER_TEXT`` matches of each sampled
    text, and a place of one in ``CLEAN_TEXTS`` texts without any. Each window is
    taken as it is and in another form (``_varied``), those with a match in up to
    ``FORMS`` others where there are fewer than ``windows``. An empty table gives a model
    that finds nothing.
    """
    rows = docs.select(text_of(F.col(text)).alias("x")).withColumn("at", F.xxhash64("x").bitwiseAND(F.lit((1 << 32) - 1)))
    total = rows.count()
    if total > sample_rows:
        rows = rows.filter(F.col("at") < int(0.9 * sample_rows / total * (1 << 32)))
    cut = _windows(rows)
    taken = [
        *cut.filter("match").orderBy("at", "tokens").limit(windows).collect(),
        *cut.filter("not match").orderBy("at", "tokens").limit(windows).collect(),
    ]
    words = sorted({t.lower() for r in taken for t in r.tokens if t.isascii() and t.isalpha() and 2 < len(t) < 12})
    more = []
    forms = min(FORMS, -(-windows // max(1, sum(r.match for r in taken))))
    for r in taken:
        for form in range(forms if r.match else 1):
            tokens, states = _varied(r, words or ["word"], form)
            more.append(Row(tokens=tokens, states=states, file=r.file))
    return _fit([*taken, *more])


def secrets(model: Crf, text: Column) -> Column:
    """array<struct<kind, start, end>> of a whole text, by start, then kind; code points, end exclusive."""

    @F.arrow_udf("array<struct<kind: string, start: int, end: int>>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        release()
        for part in _portions(batches):
            spans = [[{"kind": k, "start": a, "end": b} for a, b, k in s] for s in model.find(part)]
            yield pa.array(spans, type=kind)
            release()

    return found(text_of(text))


def redacted(model: Crf, text: Column, mark: str = "[secret]") -> Column:
    """The text with every span, touching or overlapping ones together, replaced by ``mark``; null stays null."""

    @F.arrow_udf("string")
    def cleaned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release()
        for part in _portions(batches):
            new = []
            for x, spans in zip(part, model.find(part)):
                pieces, at = [], 0
                for a, b, _ in spans:
                    if b <= at:
                        continue
                    if a > at or not at:
                        pieces += [x[at:a], mark]
                    at = b
                new.append("".join([*pieces, x[at:]]) if spans else x)
            yield pa.array(new, type=pa.string())
            release()

    return F.when(text.isNotNull(), cleaned(text_of(text)))


def _portions(batches: Iterator[pa.Array]) -> Iterator[list[str]]:
    """The texts in order, a bounded number of characters at a time; what is made of a portion goes on without the rest of its batch."""
    for batch in batches:
        part, held = [], 0
        for x in batch:
            x = x.as_py()
            part.append(x)
            held += len(x)
            if held > PORTION_CHARS:
                yield part
                part, held = [], 0
        if part:
            yield part


def op4_secret_crf(spark, sf_dir):
    """All documents: matches of the patterns, a digest of them, and all spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = docs.select("doc_id", secrets(train(docs), F.col("text")).alias("s"))

    def joined(test: str) -> Column:
        return F.expr(
            f"array_join(transform(filter(s, x -> {test}), x -> concat_ws(':', x.kind, x.start, x.end)), ',')"
        )

    return found.select(
        "doc_id",
        *[F.expr(f"cast(size(filter(s, x -> x.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(joined("x.kind <> 'crf'"), 256).alias("base_sha256"),
        joined("true").alias("spans"),
    )
