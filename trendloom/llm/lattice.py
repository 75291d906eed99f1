"""Subword lattice likelihood.

The pieces of an existing vocabulary span a lattice over each word; every
segmentation counts, weighted by the product of its pieces' probabilities, and a
forward recursion in log space returns the marginal probability. The
vocabulary's own scores (merge ranks) give the first weights, as 1 / (10 + rank);
expectation maximisation over the counts of all training words fits them.

Segmentations never cross white space, so a text's probability is the product of
its words' and the end mark's. Words are counted over all training documents and
each distinct word is computed once. The most frequent words of at most 64 bytes,
up to 131,072 of them, are broadcast (8 MB at most); all other words meet their documents in a
shuffled join, in which no word is frequent any more.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.plans.staging import Stage

from ._common import in_fold, most_frequent, table, text_of

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
HOT_WORDS = 131_072
HOT_BYTES = 64
ITERATIONS = 3
COUNTED = 300_000  # distinct words that a task holds before it hands their counts on
MARK = "▁"
_STRANGE = 0x10FFFF + 1  # code of a mark that stands in a text
_NUL = 0x10FFFF + 2  # code of a zero character, as 0 is the mark before a word
BYTES = 256  # values of a byte, equally likely
_P = np.uint64(0x9E3779B97F4A7C15)
_SLOTS = 18
_MULTIPLIERS = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)


@dataclass
class Lattice:
    """Pieces in hashed tables (whole pieces and their prefixes) with log probabilities.

    The last entry of ``logp`` is the end mark's, the one before it that of one
    value of a UTF-8 byte of a character without a piece: together the bytes have
    ``BYTES`` times its probability.
    """

    pieces: list[str]
    logp: np.ndarray

    def __post_init__(self):
        self.longest = max(map(len, self.pieces))
        entries: dict[str, int] = {}
        for piece in self.pieces:
            for n in range(1, len(piece)):
                entries.setdefault(piece[:n], -1)
        entries |= {piece: i for i, piece in enumerate(self.pieces)}
        names = list(entries)
        left_hash = np.zeros(len(names), dtype=np.uint64)
        for at, name in enumerate(names):
            h = 0
            for ch in name:
                h = (h * int(_P) + (0 if ch == MARK else ord(ch)) + 1) & 0xFFFFFFFFFFFFFFFF
            left_hash[at] = h
        left_id = np.fromiter(entries.values(), dtype=np.int32, count=len(names))
        assert len(np.unique(left_hash)) == len(names), "two pieces share a hash"
        self._tables = []
        for multiplier in _MULTIPLIERS:
            slot = ((left_hash * np.uint64(multiplier)) >> np.uint64(64 - _SLOTS)).astype(np.int64)
            key, value = np.zeros(1 << _SLOTS, dtype=np.uint64), np.full(1 << _SLOTS, -2, dtype=np.int32)
            _, first = np.unique(slot, return_index=True)
            key[slot[first]], value[slot[first]] = left_hash[first], left_id[first]
            self._tables.append((np.uint64(multiplier), key, value))
            rest = np.setdiff1d(np.arange(len(left_hash)), first)
            left_hash, left_id = left_hash[rest], left_id[rest]
        assert not len(left_hash), "a piece found no slot"

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece number, -1 for a mere prefix, -2 for neither."""
        out = np.full(len(hashes), -2, dtype=np.int32)
        for multiplier, key, value in self._tables:
            slot = ((hashes * multiplier) >> np.uint64(64 - _SLOTS)).astype(np.int64)
            hit = key[slot] == hashes
            out[hit] = value[slot[hit]]
        return out

    def _edges(self, codes: np.ndarray):
        """Edges of the lattices of equally long words: (length, start * words + word, piece or -1, log p)."""
        length, n = codes.shape
        flat = codes.ravel()
        at = np.arange(length * n)
        hashes = np.zeros(length * n, dtype=np.uint64)
        out = []
        for size in range(1, min(self.longest, length) + 1):
            fits = at < (length - size + 1) * n
            at, hashes = at[fits], hashes[fits]
            hashes = hashes * _P + flat[at + (size - 1) * n].astype(np.uint64) + np.uint64(1)
            found = self._find(hashes)
            whole = found >= 0
            out.append((size, at[whole], found[whole], self.logp[found[whole]]))
            if size == 1:
                alone = ~whole
                c = flat[at[alone]]
                width = np.where((c < 0x80) | (c == _NUL), 1, np.where(c < 0x800, 2, np.where((c < 0x10000) | (c == _STRANGE), 3, 4)))
                out.append((1, at[alone], -width, width * self.logp[-2]))
            alive = found > -2
            at, hashes = at[alive], hashes[alive]
            if not len(at):
                break
        return out

    def _forward(self, edges, length: int, n: int, backward: bool = False) -> np.ndarray:
        weights = np.full((min(self.longest, length) + 1, length, n), -np.inf)
        for size, at, _, logp in edges:
            weights[size].reshape(-1)[at] = logp
        alpha = np.full((length + 1, n), -np.inf)
        alpha[length if backward else 0] = 0.0
        for step in range(1, length + 1):
            sizes = range(1, min(weights.shape[0] - 1, step) + 1)
            if backward:
                i = length - step
                terms = np.stack([weights[s, i] + alpha[i + s] for s in sizes])
            else:
                i = step
                terms = np.stack([weights[s, i - s] + alpha[i - s] for s in sizes])
            top = terms.max(axis=0)
            alpha[i] = top + np.log(np.exp(terms - top).sum(axis=0))
        return alpha

    def groups(self, words: list[str], budget: int = 60_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places in ``words``, codes by position) of equally long words, so many that the arrays stay small."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        order = np.argsort(sizes, kind="stable")
        cuts = np.flatnonzero(np.diff(sizes[order])) + 1
        for same in np.split(order, cuts):
            size = int(sizes[same[0]]) if len(same) else 0
            step = max(1, budget // (size + 1))
            for i in range(0, len(same), step):
                part = same[i : i + step]
                codes = np.zeros((size + 1, len(part)), dtype=np.int64)
                if size:
                    chars = np.array([words[k] for k in part.tolist()], dtype=f"<U{size}").view(np.uint32)
                    chars = chars.reshape(len(part), size).T.astype(np.int64)
                    chars[chars == ord(MARK)] = _STRANGE
                    chars[chars == 0] = _NUL
                    codes[1:] = chars
                yield part, codes

    def log_marginals(self, words: list[str]) -> np.ndarray:
        """Natural log of each word's probability, over all its segmentations."""
        out = np.zeros(len(words))
        for part, codes in self.groups(words):
            length, n = codes.shape
            out[part] = self._forward(self._edges(codes), length, n)[length]
        return out

    def expected(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece (then of the byte of a strange character, then 0) in words seen ``counts`` times."""
        out = np.zeros(len(self.logp))
        for part, codes in self.groups(words):
            length, n = codes.shape
            edges = self._edges(codes)
            alpha = self._forward(edges, length, n)
            beta = self._forward(edges, length, n, backward=True)
            total, seen = alpha[length], counts[part]
            for size, at, piece, logp in edges:
                if len(at):
                    i, word = np.divmod(at, n)
                    share = np.exp(alpha[i, word] + logp + beta[i + size, word] - total[word]) * seen[word]
                    if piece[0] < 0:
                        out[-2] += float((share * -piece).sum())
                    else:
                        out[: len(self.pieces)] += np.bincount(piece, weights=share, minlength=len(self.pieces))
        return out


def _log_shares(weight: np.ndarray) -> np.ndarray:
    """Log probabilities of weights of pieces, of all strange characters' bytes together, and of the end mark."""
    logp = np.log(weight / weight.sum())
    logp[-2] -= math.log(BYTES)
    return logp


def read_vocabulary(path: str) -> Lattice:
    """The file's ordinary pieces, weighted by 1 / (10 + rank); all bytes together and the end mark like the last rank."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    pieces, ranks = [], []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)) and MARK not in piece[1:]:
            pieces.append(piece)
            ranks.append(-sp.get_score(i))
    weight = 1.0 / (10.0 + np.asarray(ranks) - min(ranks))
    weight = np.concatenate([weight, [weight.min(), weight.min()]])
    return Lattice(pieces, _log_shares(weight))


def _words(text: bytes) -> list[bytes]:
    return text.lower().split()  # of bytes: A-Z and the six white-space characters only


def count_words(docs: DataFrame, text: str, train) -> DataFrame:
    """(word, c): all words of all texts with their count in rows where ``train`` holds."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, counts = Counter(), Counter()

        def flush():
            words = list(seen)
            counted = [counts.get(w, 0) for w in words]
            seen.clear()
            counts.clear()
            for i in range(0, len(words), 50_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words[i : i + 50_000], type=pa.string()), pa.array(counted[i : i + 50_000], type=pa.int64())],
                    names=["word", "c"],
                )

        for batch in batches:
            texts = batch.column(0).cast(pa.large_binary())
            for x, learn in zip(texts, batch.column(1).to_pylist()):
                words = _words(x.as_py())
                if learn:
                    counts.update(words)
                    seen.update(dict.fromkeys(words, 1))
                else:
                    seen.update(dict.fromkeys(words, 1))
                if len(seen) > COUNTED:
                    yield from flush()
        yield from flush()

    rows = docs.select(text_of(F.col(text)).alias("x"), F.coalesce(train, F.lit(False)).alias("l"))
    return rows.mapInArrow(partial, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def fit(words: DataFrame, lattice: Lattice, ends: int, iterations: int = ITERATIONS) -> Lattice:
    """Expectation maximisation over (word, c); each piece keeps half a count."""
    for _ in range(iterations):
        model = lattice

        def partial(batches: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(model.logp))
            for batch in batches:
                total += model.expected(batch.column(0).to_pylist(), batch.column(1).to_numpy().astype(np.float64))
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(used.astype(np.int32)), pa.array(total[used])], names=["piece", "uses"]
            )

        uses = words.filter("c > 0").select("word", "c").mapInArrow(partial, "piece int, uses double")
        got = uses.groupBy("piece").agg(F.sum("uses").alias("uses")).collect()  # at most one row per piece
        weight = np.full(len(model.logp), 0.5)
        for r in got:
            weight[r[0]] += r[1]
        weight[-1] += ends
        lattice = Lattice(model.pieces, _log_shares(weight))
    return lattice


def score_texts(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    *,
    fold: tuple[int, int] = (7, 2),
    vocabulary: str = VOCABULARY,
    iterations: int = ITERATIONS,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row.

    Rows in the fold crc32(doc_id as text) mod fold[0] = fold[1] are held out of
    all counts. ``base_score`` is the add-one unigram score of whole words,
    ``score`` the log10 marginal probability of the text under the subword
    lattice, end mark included. A null text is empty, a null id counts as the
    empty text in the fold; repeated rows are rows each; other columns are not
    read. Without training rows both models are uniform.
    """
    spark = docs.sparkSession
    stage = Stage(spark, "lattice")
    held = in_fold(F.col(doc_id), *fold)
    counts = stage.write(count_words(docs, text, ~held))
    n_train = docs.filter(~held).count()
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1))).first()
    n, v = total + n_train, distinct + (n_train > 0)
    model = fit(counts, read_vocabulary(vocabulary), n_train, iterations)

    def marginals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(model.log_marginals(words) / math.log(10))],
                names=["word", "c", "logm"],
            )

    scored = stage.write(counts.mapInArrow(marginals, "word string, c long, logm double"))
    base = lambda c: math.log10((c + 1) / (n + v + 1))
    frequent = most_frequent(scored.filter(F.octet_length("word") <= HOT_BYTES), "c", HOT_WORDS).toArrow()
    hot = spark.sparkContext.broadcast(
        {
            w.encode(): (c > 0, base(c), logm)
            for w, c, logm in zip(*(frequent.column(k).to_pylist() for k in ("word", "c", "logm")))
        }
    )
    del frequent
    end_base, end_logm = base(n_train), float(model.logp[-1]) / math.log(10)

    def per_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_words = hot.value
        for whole in batches:
            for batch in _slices(whole):
                out: list[list] = [[] for _ in range(6)]
                for x in batch.column(2).cast(pa.large_binary()):
                    counted = Counter(_words(x.as_py()))
                    tokens, known, low, high, words, uses = 1, int(n_train > 0), end_base, end_logm, [], []
                    for word, times in counted.items():
                        tokens += times
                        got = known_words.get(word)
                        if got is None:
                            words.append(word)
                            uses.append(times)
                        else:
                            known += times * got[0]
                            low += times * got[1]
                            high += times * got[2]
                    for column, value in zip(out, (tokens, known, low, high, words, uses)):
                        column.append(value)
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), *(pa.array(c, type=k) for c, k in zip(out, kinds))],
                    names=["row", "id", "tokens", "known", "low", "high", "words", "uses"],
                )

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("id"), text_of(F.col(text)).alias("x"))
    parts = rows.mapInArrow(
        per_text,
        f"row long, id {kind}, tokens long, known long, low double, high double, words array<string>, uses array<long>",
    )
    rest = parts.select(
        "row", "id", "tokens", "known", "low", "high", F.explode_outer(F.arrays_zip("words", "uses")).alias("w")
    ).select("row", "id", "tokens", "known", "low", "high", F.col("w.words").alias("word"), F.col("w.uses").alias("uses"))
    seen = F.coalesce(F.col("c"), F.lit(0))
    rarer = F.log10((seen + 1) / F.lit(float(n + v + 1)))
    joined = rest.join(scored.hint("merge"), "word", "left")
    added = joined.groupBy("row", "id", "tokens", "known", "low", "high").agg(
        F.coalesce(F.sum(F.when(seen > 0, F.col("uses"))), F.lit(0)).alias("k"),
        F.coalesce(F.sum(F.when(F.col("word").isNotNull(), F.col("uses") * rarer)), F.lit(0.0)).alias("b"),
        F.coalesce(F.sum(F.col("uses") * F.col("logm")), F.lit(0.0)).alias("s"),
    )
    return added.select(
        F.col("id").alias(doc_id),
        in_fold(F.col("id"), *fold).alias("held_out"),
        F.col("tokens").alias("n_tokens"),
        (F.col("known") + F.col("k")).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("low") + F.col("b")).alias("base_score"),
        (F.col("high") + F.col("s")).alias("score"),
    )


def _slices(batch: pa.RecordBatch, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def op10_subword_lattice(spark, sf_dir):
    """All documents, learning from those outside the fold crc32 mod 7 = 2."""
    return score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))
