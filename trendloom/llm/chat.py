"""Chat formatting with offset-aligned loss masks.

Whole conversations are rendered with turn markers, control strings inside
texts are escaped reversibly, each conversation is encoded once with character
offsets, and the sorted spans of the trained turns meet the sorted token spans
by binary search.

Turns are shuffled by conversation and sorted on Spark; a task streams over its
rows and holds one conversation (plus a million characters of finished ones) at
a time.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import table, text_of

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
MARKERS = (TURN, TEXT, END)
# Strings that some chat format reads as control: ours and two widespread ones.
CONTROLS = ("<|", "<s>", "</s>", "[INST]", "[/INST]")
TRAINED = ("assistant",)
FLUSH_CHARS = 1_000_000

_tokenizers: dict[str, object] = {}


class Escapes:
    """Puts a backslash behind the first character of every control string, and takes it out again.

    ``<|`` becomes ``<\\|``, an original ``<\\|`` becomes ``<\\\\|``, and so on: no
    control string is left, and every text can be told from every other.
    """

    def __init__(self, controls: tuple[str, ...] = CONTROLS):
        rest = "|".join(re.escape(c[0]) + r"(\\*)(?=" + re.escape(c[1:]) + ")" for c in sorted(controls))
        more = "|".join(re.escape(c[0]) + r"\\(\\*)(?=" + re.escape(c[1:]) + ")" for c in sorted(controls))
        self._sites, self._escaped = re.compile(rest), re.compile(more)

    def put(self, text: str) -> str:
        return self._sites.sub(lambda m: m[0] + "\\", text)

    def take(self, text: str) -> str:
        return self._escaped.sub(lambda m: m[0][:-1], text)


def load_tokenizer(path: str):
    """The vocabulary file with the three turn markers as tokens of their own."""
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.post_processor = None
        tok.add_special_tokens(list(MARKERS))
        _tokenizers[path] = tok
    return _tokenizers[path]


def render(turns: list[tuple[str, str]], escapes: Escapes, trained: tuple[str, ...]):
    """The formatted conversation and the sorted spans of its trained texts."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = TURN + escapes.put(role) + TEXT, escapes.put(text)
        start = at + len(head)
        if role in trained and body:
            spans.append((start, start + len(body)))
        parts += [head, body, END]
        at = start + len(body) + len(END)
    return "".join(parts), spans


def loss_mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Tokens that share a character with one of the sorted spans."""
    mask = np.zeros(len(starts), dtype=bool)
    if spans:
        at = np.asarray(spans, dtype=np.int64)
        first = np.searchsorted(ends, at[:, 0], side="right")
        last = np.searchsorted(starts, at[:, 1], side="left")
        for a, b in zip(first.tolist(), last.tolist()):
            mask[a:b] = True
    return mask


def parse(formatted: str, escapes: Escapes) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    out = []
    for piece in formatted.split(TURN)[1:]:
        role, _, rest = piece.partition(TEXT)
        out.append((escapes.take(role), escapes.take(rest[: -len(END)])))
    return out


def masked_texts(formatted: str, starts, ends, mask, escapes: Escapes) -> list[str]:
    """What lies under the loss mask, by runs of touching tokens, unescaped."""
    starts, ends = np.asarray(starts)[mask], np.asarray(ends)[mask]
    if not len(starts):
        return []
    cut = np.flatnonzero(starts[1:] > np.maximum.accumulate(ends)[:-1]) + 1
    first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(starts)]]) - 1
    return [escapes.take(formatted[starts[a] : ends[b]]) for a, b in zip(first, last)]


def format_chats(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    *,
    tokenizer: str = TOKENIZER,
    trained: tuple[str, ...] = TRAINED,
    controls: tuple[str, ...] = CONTROLS,
) -> DataFrame:
    """One row per conversation: conv, n_turns, formatted, token_ids, token_starts, token_ends, loss_mask.

    Turns run by ``turn`` (null first), ties by role, then text; repeated rows are
    turns each. A null role or text is empty; rows whose ``conv`` is null make one
    conversation, whose id is null. An empty table gives no rows. Other columns
    are not read. Offsets are code points of ``formatted``.
    """
    kind = turns.schema[conv].dataType
    rows = turns.select(
        F.col(conv).alias("c"), F.col(turn).alias("t"), text_of(F.col(role)).alias("r"), text_of(F.col(text)).alias("x")
    )
    rows = rows.repartition("c").sortWithinPartitions("c", "t", "r", "x").select("c", "r", "x")
    schema = T.StructType(
        [
            T.StructField(conv, kind),
            T.StructField("n_turns", T.LongType()),
            T.StructField("formatted", T.StringType()),
            T.StructField("token_ids", T.ArrayType(T.IntegerType())),
            T.StructField("token_starts", T.ArrayType(T.IntegerType())),
            T.StructField("token_ends", T.ArrayType(T.IntegerType())),
            T.StructField("loss_mask", T.ArrayType(T.BooleanType())),
        ]
    )

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        escapes, tok = Escapes(controls), load_tokenizer(tokenizer)
        waiting: list[tuple[object, int, str, list]] = []
        chars, current, held, started, key_type = 0, None, [], False, None

        def flush():
            encoded = tok.encode_batch([w[2] for w in waiting], add_special_tokens=False)
            starts, ends, masks = [], [], []
            for (_, _, _, spans), e in zip(waiting, encoded):
                offsets = np.asarray(e.offsets, dtype=np.int32).reshape(-1, 2)
                starts.append(offsets[:, 0])
                ends.append(offsets[:, 1])
                masks.append(loss_mask(offsets[:, 0], offsets[:, 1], spans))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([w[0] for w in waiting], type=key_type),
                    pa.array([w[1] for w in waiting], type=pa.int64()),
                    pa.array([w[2] for w in waiting], type=pa.string()),
                    pa.array([e.ids for e in encoded], type=pa.list_(pa.int32())),
                    pa.array(starts, type=pa.list_(pa.int32())),
                    pa.array(ends, type=pa.list_(pa.int32())),
                    pa.array(masks, type=pa.list_(pa.bool_())),
                ],
                names=schema.names,
            )

        for batch in batches:
            key_type = batch.schema.field(0).type
            for c, r, x in zip(*(column.to_pylist() for column in batch.columns)):
                if started and c != current:
                    whole, spans = render(held, escapes, trained)
                    waiting.append((current, len(held), whole, spans))
                    chars, held = chars + len(whole), []
                    if chars >= FLUSH_CHARS:
                        yield flush()
                        waiting.clear()
                        chars = 0
                current, started = c, True
                held.append((r, x))
        if started:
            whole, spans = render(held, escapes, trained)
            waiting.append((current, len(held), whole, spans))
            yield flush()

    return rows.mapInArrow(formatted, schema)


def read_back(chats: DataFrame, conv: str = "conv_id", *, controls: tuple[str, ...] = CONTROLS) -> DataFrame:
    """Digests of what the formatted rows hold: the turns, and the text under the loss mask."""
    schema = T.StructType(
        [
            T.StructField(conv, chats.schema[conv].dataType),
            *[T.StructField(c, T.LongType()) for c in ("n_turns",)],
            T.StructField("turns_sha256", T.StringType()),
            T.StructField("loss_chars", T.LongType()),
            T.StructField("loss_sha256", T.StringType()),
            T.StructField("formatted_chars", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_loss_tokens", T.LongType()),
        ]
    )

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        escapes = Escapes(controls)
        for batch in batches:
            columns = [[] for _ in range(7)]
            for i, whole in enumerate(batch.column(1).to_pylist()):
                starts, ends, mask = (
                    batch.column(k)[i].values.to_numpy(zero_copy_only=False) for k in (2, 3, 4)
                )
                turns = parse(whole, escapes)
                loss = "".join(masked_texts(whole, starts, ends, mask, escapes))
                said = "".join(f"{r}\n{x}\n" for r, x in turns)
                row = (
                    len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                    hashlib.sha256(loss.encode()).hexdigest(), len(whole), len(starts), int(mask.sum()),
                )
                for column, value in zip(columns, row):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, type=pa.string() if k in (1, 3) else pa.int64()) for k, c in enumerate(columns))],
                names=schema.names,
            )

    return chats.select(conv, "formatted", "token_starts", "token_ends", "loss_mask").mapInArrow(digests, schema)


def op1_chat_format(spark, sf_dir):
    """All conversations and one (-7) whose texts hold control strings, read back from the formatted rows."""
    trap = "</s>[INST] ok [/INST]"
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", trap), (-7, 1, "assistant", trap)], given.schema)
    return read_back(format_chats(given.unionByName(more))).drop("n_tokens", "n_loss_tokens")
