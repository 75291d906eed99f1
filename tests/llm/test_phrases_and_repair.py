"""Collocations, conversation repair and repeated passages against plain versions."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from trendloom.llm import _blocks, collocations, repair, substrings
from trendloom.session import ship_package

LONG = "lorem ipsum dolor " * 30_000


# Words and hashes


def test_words_and_hashes_of_bytes():
    import pyarrow as pa

    texts = ["a bb", "", None, "  x\x0by ", "日本 é", "bb"]
    data, edges = _blocks.text_bytes(pa.chunked_array([pa.array(["zz", *texts[:3]])[1:], pa.array(texts[3:])]))
    starts, stops, doc = _blocks.words_of(data, edges, ~_blocks.byte_class(substrings.SPACE))
    got = [(int(d), data[a:b].tobytes().decode()) for a, b, d in zip(starts, stops, doc)]
    assert got == [(0, "a"), (0, "bb"), (3, "x"), (3, "y"), (4, "日本"), (4, "é"), (5, "bb")]
    for kind in (0, 1):
        h = _blocks.word_hashes(data, starts, stops, kind)
        assert h[1] == h[6] and len(set(h.tolist())) == 6
    assert (_blocks.word_hashes(data, starts, stops)[0] != _blocks.word_hashes(data, starts, stops, 1)[0])


@pytest.mark.parametrize("period, cover", substrings.COVERS.items())
def test_covers_have_every_distance(period, cover):
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


# Repeated passages


def plain_repeats(rows, window):
    least = {}
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    for (i, _), w in zip(rows, tokens):
        for k in range(len(w) - window + 1):
            g = tuple(w[k : k + window])
            if i is not None:
                least[g] = min(least.get(g, i), i)
    out = []
    for (i, _), w in zip(rows, tokens):
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and least[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


@pytest.mark.parametrize("window, small", [(13, False), (13, True), (5, True), (2, False), (50, False)])
def test_repeats_like_a_plain_version(spark, monkeypatch, window, small):
    ship_package(spark)
    random.seed(window + small)
    words = [f"w{i}" for i in range(12)] + ["é", "日本"]
    passages = [random.choices(words, k=random.randint(5, 60)) for _ in range(6)]
    rows = []
    for i in range(150):
        body = []
        for _ in range(random.randint(0, 4)):
            body += random.choice([random.choices(words, k=random.randint(0, 20)), random.choice(passages)])
        rows.append((i - 40, random.choice([" ", "\n", " \t "]).join(body)))
    rows += [rows[3], (rows[5][0], rows[80][1]), (None, rows[9][1]), (None, None), (500, ""), (501, None), (502, " \n"), (503, LONG), (499, LONG)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, id int, n_words string").repartition(5)
    if small:
        spark.conf.set("spark.sql.shuffle.partitions", "9")  # blocks of few documents
    try:
        got = substrings.remove_repeats(df, window=window)
        assert got.columns == ["doc_id", "n_words", "n_removed", "kept"]
        got = sorted(map(tuple, got.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == sorted(plain_repeats(rows, window), key=repr)


def test_repeats_of_nothing(spark):
    ship_package(spark)
    df = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.remove_repeats(df).collect() == []


def test_exchange_between_many_blocks():
    """Parts see the places of several blocks' keys, and a block can tell its own in what comes back."""
    import pyarrow as pa

    random.seed(1)
    for parts in (2, 4, 7, 211):
        hashes = np.array(sorted(random.randrange(1 << 64) for _ in range(500)) + [(1 << 64) - 1], np.uint64)
        keys = _blocks.keyed(hashes, parts)
        assert (np.sort(keys) == keys).all() and int(keys[-1] >> np.uint64(32)) < parts and len(set(keys.tolist())) == 501
        rows = pa.Table.from_batches([_blocks.sent(3, parts, keys, np.arange(501), base=9)])
        assert (_blocks.answered(rows) == keys).all()
        got, row = _blocks.unpacked(rows.column("b"), np.int64)
        assert (got == np.arange(501)).all() and [k for k, _, _ in _blocks.stretches(row)] == list(range(rows.num_rows))
    assert _blocks.sent(3, 4, np.zeros(0, np.uint64)) is None


# Collocations


def plain_collocations(rows, least, max_words, top, share):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    found = {p: c for p, c in f.items() if len(p[1]) > 1 and c >= least}
    out = []
    for (lang, p), a in found.items():
        inside = any(
            q[0] == lang and len(q[1]) > len(p) and 100 * c >= share * a
            and any(q[1][i : i + len(p)] == p for i in range(len(q[1]) - len(p) + 1))
            for q, c in found.items()
        )
        if not inside:
            cuts = [(1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out.append((lang, " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    ranked = []
    for _, group in itertools.groupby(out, key=lambda r: r[0]):
        ranked += [(r[0], i, *r[1:]) for i, r in enumerate(itertools.islice(group, top), 1)]
    return ranked


@pytest.mark.parametrize("max_words, top", [(3, 2000), (4, 7)])
def test_collocations_like_a_plain_version(spark, max_words, top):
    ship_package(spark)
    random.seed(max_words)
    vocabulary = ["the", "of", "New", "york", "city", "São", "paulo", "x", "x", "日本"]
    rows = []
    for i in range(400):
        words = random.choices(vocabulary, weights=[9, 7, 3, 3, 2, 1, 1, 2, 2, 1], k=random.randint(0, 25))
        words = list(itertools.chain(*((w, "York", "City") if w == "New" and random.random() < 0.7 else (w,) for w in words)))
        text = "".join(w + random.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", "; "]) for w in words)
        rows.append((random.choice(["en", "en", "de", None, "und", ""]), text))
    rows += [("en", None), ("en", ""), (None, ". ,"), ("fr", "one"), ("en", LONG[:5000]), ("en", LONG[:5000])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "lang string, text string, phrase int, n int").repartition(7)
    got = collocations.collocations(df, max_words=max_words, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == sorted(plain_collocations(rows, 10, max_words, top, 50))
    assert collocations.collocations(df.limit(0)).collect() == []


def test_words_that_share_a_hash(monkeypatch):
    import pyarrow as pa

    real = collocations.word_hashes
    monkeypatch.setattr(
        collocations, "word_hashes", lambda d, a, b, kind=0: real(d, a, b, 1) if kind else np.ones(len(a), np.uint64)
    )
    shard = collocations.Shard(pa.array(["a b a. c b a b"]), pa.array(["en"]), 2)
    got = {w: c for n, word, count, _ in shard.phrases() for w, c in zip(shard.strings(word, n).to_pylist(), count.tolist())}
    assert got == {"a": 3, "b": 3, "c": 1, "a b": 2, "b a": 2, "c b": 1}


def test_index_counts_phrases_of_any_depth():
    random.seed(1)
    pieces = [random.choices(range(1, 6), k=random.randint(0, 12)) for _ in range(60)]
    sequence = np.array(list(itertools.chain([0], *([*p, 0] for p in pieces))))
    for depth in (1, 2, 3, 5):
        got = {}
        for n, at, count in collocations.BiIndex(sequence, depth).phrases(depth):
            for a, c in zip(at.tolist(), count.tolist()):
                phrase = tuple(sequence[a : a + n].tolist())
                assert phrase not in got and 0 not in phrase
                got[phrase] = c
        want = Counter(tuple(p[i : i + n]) for p in pieces for n in range(1, depth + 1) for i in range(len(p) - n + 1))
        assert got == want


def test_large_counts_are_exact(spark):
    big = 10**15
    df = spark.createDataFrame([(big, big + 1, big + 3)], "a long, l long, r long")
    a, l, r = (F.col(c).cast("decimal(16,0)") for c in "alr")
    million = F.lit(1_000_000).cast("decimal(7,0)")
    got = df.select(F.call_function("div", (a * a).cast("decimal(31,0)") * million, (l * r).cast("decimal(31,0)"))).first()[0]
    assert got == 10**6 * big * big // ((big + 1) * (big + 3))


# Conversation repair


def plain_repair(symbols):
    """Cheapest edits by exploring states turn by turn; ties to the least audit."""
    best = {0: (0, "")}
    close = lambda b: _inserted(b)
    for s in symbols:
        new = {}
        for state, (cost, audit) in close(best).items():
            for edit, more, to, _, used in repair.choices(state, s):
                if used:
                    value = (cost + more, audit + edit)
                    new[to] = min(new.get(to, value), value)
        best = new
    return min(v for s, v in close(best).items() if s in repair.ENDS)


def _inserted(best):
    best = dict(best)
    for _ in range(4):
        for state, (cost, audit) in list(best.items()):
            to = repair.INSERTS[state][0]
            value = (cost + repair.INSERT, audit + "I")
            best[to] = min(best.get(to, value), value)
    return best


@pytest.mark.parametrize("seed", range(4))
def test_unrolled_edits_are_cheapest_and_least(seed):
    random.seed(seed)
    for _ in range(150):
        symbols = "".join(random.choice(repair.SYMBOLS) * random.choice([1, 1, 2, 7]) for _ in range(random.randint(0, 7)))
        cost, audit = plain_repair(symbols)
        cut = random.randint(0, len(symbols))
        parts = [symbols[:cut], symbols[cut:]]
        values = repair._suffixes([repair.chunk_matrix(p).reshape(-1).tolist() for p in parts])[::-1]
        assert values[0][0] == cost
        state, got = 0, ""
        for p, behind in zip(parts, values[1:]):
            pieces, state = repair.unroll(p, np.array(behind), state)
            assert len(pieces) == len(p)
            got += "".join(x[::2] for x in pieces)
        assert got + repair.last_inserts(state)[::2] == audit


def test_powers_of_long_runs():
    n = 10**12 + 7
    m = np.where(np.eye(4, dtype=bool), 0, repair.FAR)
    for k in repair.powers(n):
        m = repair.times(m, repair.binary_power("u", k))
    # Users only: every second one is renamed, and the last, an odd one, gets an inserted answer.
    assert m[0, 3] == 2 * (n // 2) + 2 and len(repair.powers(n)) <= n.bit_length()


def plain_report(rows):
    """Damaged rows to (gaps, blank, duplicate, truncated, illegal, cost, audit, digest) by conversation."""
    out = {}
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((t, r if r is not None else " ", x if x is not None else " "))
    for c, turns in by.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, symbols, faults = set(), "", Counter()
        for _, r, x in turns:
            last = re.sub(r"[\x20\x09-\x0D]+$", "", x)
            kind = r[:1] if r[:1] and r[:1] in "sua" else "x"
            fault = "blank" if not last else "duplicate" if (r, x) in seen else "truncated" if last[-1] not in ".!?" else "none"
            seen.add((r, x))
            faults[fault] += 1
            symbols += "." if fault in ("blank", "duplicate") else kind.upper() if fault == "truncated" else kind
        cost, audit = plain_repair(symbols)
        said, state, i = [], 0, 0
        for e in audit:
            to = repair.INSERTS[state][0]
            name = {2: "user", 3: "assistant"}.get(to)
            if e == "I":
                said.append(f"{name}:")
                state = to
                continue
            _, r, x = turns[i]
            i += 1
            if e == "K":
                said.append(f"{r}:{x}")
                state = repair.READS[state, r[0]]
            elif e == "R":
                said.append(f"{name}:{x}")
                state = to
        numbers = {t for t, _, _ in turns if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        kinds = [r[:1] for _, r, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:]))
        digest = hashlib.sha256("\n".join(said).encode()).hexdigest()
        out[c] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, digest)
    return out


@pytest.mark.parametrize("chunk", [4096, 3])
def test_repair_like_a_plain_version(spark, monkeypatch, chunk):
    ship_package(spark)
    monkeypatch.setattr(repair, "CHUNK", chunk)
    random.seed(chunk)
    texts = ["Hi.", "Hi.", "well", "", " \n", None, "so? \t", "end!", "日本", "a\n.", "x" * 50_000]
    rows = []
    for c in [*range(30), None]:
        for t in range(random.choice([0, 1, 3, 8, 30])):
            turn = random.choice([t, t, t, t + 2, None])
            rows.append((c, turn, random.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "Ann", "sage"]), random.choice(texts)))
    rows += [(77, 1, "user", "same.")] * 20 + [(78, None, "assistant", "only nulls.")]
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], "conv_id long, turn long, role string, text string, edit int, chunk string").repartition(6)
    edits, report = repair.repair(df)
    want = plain_report(rows)
    digests = {r[0]: r[1] for r in repair.repaired_digests(edits).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    got = {r[0]: (*r[1:], digests.get(r[0], nothing)) for r in report.collect()}
    assert got == want
    kept = edits.filter("edit <> 'D'").orderBy("conv_id", "at", "step").collect()
    for c, group in itertools.groupby(kept, key=lambda r: r.conv_id):
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in group)), c


def test_repair_of_nothing(spark):
    ship_package(spark)
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    edits, report = repair.repair(df)
    assert edits.collect() == [] and report.collect() == [] and repair.repaired_digests(edits).collect() == []


def test_damage(spark):
    rows = [(c, t, "assistant", "Yes. No!") for c in (1, 2, None) for t in [*range(60), None]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = []
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        row = (c, t, "user" if kind == 4 else r, "" if kind == 1 else "Yes No" if kind == 2 else x)
        want += [row] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert sorted(map(tuple, repair.damaged(df).collect()), key=repr) == sorted(want, key=repr)
