"""DuckDB SQL of the operators that SQL can express, written from their definitions."""

from __future__ import annotations

N_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"


def op5_sql(buckets: int = 16, budget: int = 16_384) -> str:
    """Bins, the dynamic program as a chain of tables, its way back, then numbering."""
    # A table per step: least cost of bins 0..j with at most b + 1 buckets, and where the last but one ends.
    steps = [
        f"""f{b} AS (SELECT p.j, CASE WHEN q.m.c < p.c THEN q.m.c ELSE p.c END AS c,
        CASE WHEN q.m.c < p.c THEN q.m.i ELSE -1 END AS i
        FROM f{b - 1} p LEFT JOIN (SELECT h.k AS j,
            min({{'c': p.c + h.edge * (h.docs - g.docs) - (h.toks - g.toks), 'i': p.j}}) AS m
            FROM h JOIN f{b - 1} p ON p.j < h.k JOIN h g ON g.k = p.j GROUP BY h.k) q ON q.j = p.j)"""
        for b in range(1, buckets)
    ]
    back = [f"w{buckets - 1} AS (SELECT max(k) AS j FROM h)"]
    for b in range(buckets - 1, 0, -1):
        back.append(
            f"w{b - 1} AS (SELECT CASE WHEN f.i >= 0 THEN f.i WHEN f.i = -1 AND f.j >= 0 THEN f.j END AS j"
            f" FROM w{b} LEFT JOIN f{b} f ON f.j = w{b}.j)"
        )
    ends = " UNION ".join(f"SELECT j FROM w{b}" for b in range(buckets))
    return rf"""WITH l AS (SELECT doc_id, {N_WORDS} + 1 AS n FROM documents),
    e AS (SELECT doc_id, n, CASE WHEN n <= 128 THEN n ELSE
        ((n + (1::BIGINT << (length(bin(n)) - 7)) - 1) // (1::BIGINT << (length(bin(n)) - 7)))
        * (1::BIGINT << (length(bin(n)) - 7)) END AS edge FROM l),
    h AS MATERIALIZED (SELECT edge, row_number() OVER (ORDER BY edge) - 1 AS k, sum(count(*)) OVER (ORDER BY edge) AS docs,
        sum(sum(n)) OVER (ORDER BY edge) AS toks FROM e GROUP BY edge),
    f0 AS MATERIALIZED (SELECT k AS j, edge * docs - toks AS c, -1::BIGINT AS i FROM h),
    {", ".join(s.replace(" AS (", " AS MATERIALIZED (", 1) for s in steps)},
    {", ".join(back)},
    ends AS (SELECT edge, row_number() OVER (ORDER BY edge) - 1 AS bucket FROM h WHERE k IN ({ends})),
    b AS (SELECT doc_id, n, min(ends.edge) AS padded, min(bucket) AS bucket FROM e JOIN ends ON e.edge <= ends.edge
        GROUP BY doc_id, n),
    r AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY doc_id) - 1 AS rank,
        greatest({budget} // greatest(padded, 1), 1) AS cap FROM b)
    SELECT doc_id, n::BIGINT AS n_tokens, bucket::INTEGER AS bucket, padded::BIGINT AS padded_length,
        (rank // cap)::BIGINT AS batch, (rank % cap)::BIGINT AS slot FROM r"""


def op3_sql(block: int = 32, resolution: int = 1 << 40) -> str:
    """Parts, one schedule slot by slot (counts of blocks so far as a list) as far as blocks reach, then arithmetic."""
    return f"""WITH RECURSIVE w AS (SELECT source, sqrt(sum(length(coalesce(text, '')))::DOUBLE) AS weight,
        (count(*) + {block - 1}) // {block} AS blocks FROM documents GROUP BY source),
    m AS (SELECT max(weight) AS top, greatest(1048576, 16 * count(*))::BIGINT AS slots FROM w),
    f AS (SELECT fsum(weight / top) AS total, (2 * {resolution} + any_value(slots) - 1) // any_value(slots) AS least
        FROM w, m WHERE weight > 0),
    p AS (SELECT source, blocks, CASE WHEN weight > 0 THEN greatest(least, floor({resolution} * (weight / top / total) + 0.5))
        ELSE least END::BIGINT AS parts, row_number() OVER (ORDER BY source NULLS FIRST) AS s FROM w, m, f),
    a AS (SELECT list(parts ORDER BY s) AS ps, list(least(parts, blocks) ORDER BY s) AS wanted,
        sum(parts)::BIGINT AS period FROM p),
    t AS (SELECT -1::BIGINT AS slot, 0::BIGINT AS s, list_transform(ps, lambda x: 0::BIGINT) AS done FROM a
        UNION ALL
        SELECT slot + 1, pick, list_transform(done, lambda x, i: CASE WHEN i = pick THEN x + 1 ELSE x END)
        FROM (SELECT slot, done, ps, period, list_sort(list_transform(list_filter(range(1, len(ps) + 1),
                lambda i: done[i] < ps[i] AND done[i] * period // ps[i] <= slot + 1),
                lambda i: {{'deadline': ((done[i] + 1) * period + ps[i] - 1) // ps[i], 'i': i}}))[1].i AS pick
              FROM t, a, m WHERE slot + 1 < slots
                AND len(list_filter(range(1, len(ps) + 1), lambda i: done[i] < wanted[i])) > 0)),
    e AS (SELECT max(slot) + 1 AS n, max_by(done, slot) AS had FROM t),
    q AS (SELECT source, slot AS pos, done[t.s] - 1 AS j, greatest(1, had[t.s]) AS had, n FROM t, e, p
        WHERE slot >= 0 AND p.s = t.s),
    r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS rank FROM documents)
    SELECT doc_id, r.source, (rank // {block})::BIGINT AS block,
        ((rank // {block}) // had * n + pos)::BIGINT AS slot, (rank % {block})::BIGINT AS place
    FROM r JOIN q ON r.source IS NOT DISTINCT FROM q.source AND (rank // {block}) % had = q.j"""


# Texts in turn order; the template adds 23 characters a turn and one for each control string.
OP1 = r"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
g AS (SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '') AS loss,
    sum(23 + length(role) + length(text)
        + len(regexp_extract_all(role || ' ' || text, '<\\*(?:\||s>|/s>)|\[\\*(?:INST\]|/INST\])'))) AS chars
    FROM t GROUP BY conv_id)
SELECT conv_id, n_turns::BIGINT AS n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
    sha256(loss) AS loss_sha256, chars::BIGINT AS formatted_chars FROM g"""

OP8 = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS x FROM embeddings),
p AS (SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.x::DOUBLE[], v.x::DOUBLE[])::BIGINT AS score
    FROM v q JOIN v ON q.vec_id % 20 = 0 AND q.vec_id <> v.vec_id)
SELECT query_id, (row_number() OVER w)::INTEGER AS rank, vec_id, score FROM p
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 20"""

# Counts of every phrase of up to three words of a piece, cuts, the drop of what longer candidates cover.
OP11 = r"""WITH p AS (SELECT row_number() OVER () AS row, lang, s FROM (SELECT coalesce(lang, 'und') AS lang,
        unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) AS s FROM documents)),
    w AS (SELECT row, lang, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS i
        FROM (SELECT row, lang, regexp_extract_all(s, '[^\x20\x09]+') AS ws FROM p)),
    g AS (SELECT lang, x, x || ' ' || lead(x, 1) OVER o AS xy, x || ' ' || lead(x, 1) OVER o || ' ' || lead(x, 2) OVER o AS xyz
        FROM w WINDOW o AS (PARTITION BY row ORDER BY i)),
    c AS MATERIALIZED (SELECT lang, 1 AS k, x AS phrase, count(*) AS f FROM g GROUP BY ALL
        UNION ALL SELECT lang, 2, xy, count(*) FROM g WHERE xy IS NOT NULL GROUP BY ALL
        UNION ALL SELECT lang, 3, xyz, count(*) FROM g WHERE xyz IS NOT NULL GROUP BY ALL),
    n AS (SELECT lang, sum(f)::BIGINT AS n FROM c WHERE k = 1 GROUP BY lang),
    o AS (SELECT *, string_split(phrase, ' ') AS ws FROM c WHERE k > 1 AND f >= 10),
    cuts AS (SELECT lang, phrase, f AS a, k, ws, j, array_to_string(ws[1:j], ' ') AS x, array_to_string(ws[j + 1:], ' ') AS y
        FROM o, (VALUES (1), (2)) AS v(j) WHERE j < k),
    s AS (SELECT u.lang, u.phrase, u.a, u.k, u.ws, u.j, x.f AS l, y.f AS r,
        ((1000000::HUGEINT * u.a * u.a) // (x.f::HUGEINT * y.f))::BIGINT AS score
        FROM cuts u JOIN c x ON x.lang = u.lang AND x.phrase = u.x JOIN c y ON y.lang = u.lang AND y.phrase = u.y),
    m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
    inner3 AS (SELECT lang, part, max(f) AS longer FROM (SELECT lang, f, array_to_string(ws[1:2], ' ') AS part FROM o
        WHERE k = 3 UNION ALL SELECT lang, f, array_to_string(ws[2:3], ' ') FROM o WHERE k = 3) GROUP BY lang, part)
SELECT m.lang, row_number() OVER b AS rank, m.phrase, m.a, m.l, m.r, n.n, m.score
FROM m JOIN n ON n.lang = m.lang LEFT JOIN inner3 i ON i.lang = m.lang AND i.part = m.phrase AND m.k = 2
WHERE i.longer IS NULL OR 100 * i.longer < 50 * m.a
WINDOW b AS (PARTITION BY m.lang ORDER BY m.score DESC, m.a DESC, m.phrase) QUALIFY row_number() OVER b <= 2000"""

# Every window with the smallest document that has it; a word goes if one of the windows over it is older than its document.
OP13 = r"""WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
        FROM documents),
    w AS (SELECT row, doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS i FROM d),
    v AS (SELECT row, doc_id, i, x, sha256(x || ' ' || """ + " || ' ' || ".join(f"lead(x, {k}) OVER o" for k in range(1, 13)) + r""") AS g
        FROM w WINDOW o AS (PARTITION BY row ORDER BY i)),
    l AS (SELECT g, min(doc_id) AS least FROM v WHERE g IS NOT NULL GROUP BY g),
    m AS (SELECT v.row, i, x, max(CASE WHEN least < doc_id THEN i END) OVER (PARTITION BY v.row ORDER BY i) AS last
        FROM v LEFT JOIN l ON l.g = v.g),
    k AS (SELECT row, count(*) AS kept, string_agg(x, ' ' ORDER BY i) AS words FROM m WHERE last IS NULL OR last < i - 12 GROUP BY row)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(kept, 0))::BIGINT AS n_removed,
    sha256(coalesce(words, '')) AS kept_sha256 FROM d LEFT JOIN k ON k.row = d.row"""

# CRC-32 from its polynomial, damage, faults, then the cheapest edits turn by turn over four states (0 start, 1 s, 2 u, 3 a).
OP12 = r"""WITH RECURSIVE tbl AS (SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
    k AS (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
    r AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(4294967295, list_reduce([4294967295]
        || list_transform(range(1, length(key) + 1), lambda p: ascii(key[p])::BIGINT),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 20 AS kind FROM k, tbl),
    d AS (SELECT conv_id AS conv, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM r WHERE kind <> 0),
    o AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text, copy) AS pos FROM d),
    m AS (SELECT *, row_number() OVER (PARTITION BY conv, role, text ORDER BY pos) > 1 AS again,
        NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS late,
        role[1] AS init FROM o),
    p AS MATERIALIZED (SELECT conv, pos, turn, role, text, init, blank, NOT blank AND again AS dup, NOT blank AND NOT again AND late AS trunc,
        lag(init) OVER (PARTITION BY conv ORDER BY pos) AS prev FROM m),
    ins(s, t, n, rep) AS (VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 1, e'user:\n'), (1, 2, 1, e'user:\n'),
        (3, 2, 1, e'user:\n'), (2, 3, 1, e'assistant:\n'), (0, 3, 2, e'user:\nassistant:\n'), (1, 3, 2, e'user:\nassistant:\n')),
    opt(s, t, e, need, cost) AS (SELECT s::INTEGER, s::INTEGER, 'D', NULL::VARCHAR, 3 FROM range(4) v(s)
        UNION ALL VALUES (0, 1, 'K', 's', 0), (0, 2, 'K', 'u', 0), (1, 2, 'K', 'u', 0), (3, 2, 'K', 'u', 0), (2, 3, 'K', 'a', 0),
        (0, 2, 'R', NULL, 2), (1, 2, 'R', NULL, 2), (3, 2, 'R', NULL, 2), (2, 3, 'R', NULL, 2)),
    f AS (SELECT conv, 0::BIGINT AS i, 0::BIGINT AS s, {'c': 0::BIGINT, 'audit': '', 'rep': ''} AS b FROM (SELECT DISTINCT conv FROM p)
        UNION ALL
        SELECT f.conv, f.i + 1, opt.t::BIGINT, min({'c': (f.b.c + 2 * ins.n + opt.cost + CASE WHEN trunc AND e <> 'D' THEN 1 ELSE 0 END)::BIGINT,
            'audit': f.b.audit || repeat('I', ins.n) || e, 'rep': f.b.rep || ins.rep || CASE e WHEN 'D' THEN '' WHEN 'K' THEN role || ':' || text || chr(10)
                ELSE CASE opt.t WHEN 2 THEN 'user:' ELSE 'assistant:' END || text || chr(10) END})
        FROM f JOIN p ON p.conv IS NOT DISTINCT FROM f.conv AND p.pos = f.i + 1 JOIN ins ON ins.s = f.s JOIN opt ON opt.s = ins.t
            AND (e <> 'K' OR need = init) AND (e = 'D' OR NOT (blank OR dup))
        GROUP BY f.conv, f.i + 1, opt.t),
    n AS (SELECT conv, max(pos) AS last, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
        count(*) FILTER (dup) AS duplicate, count(*) FILTER (trunc) AS truncated,
        count(*) FILTER (pos > 1 AND prev || init NOT IN ('su', 'ua', 'au')) AS illegal FROM p GROUP BY conv),
    z AS (SELECT f.conv, min({'c': b.c + 2 * ins.n, 'audit': b.audit || repeat('I', ins.n), 'rep': b.rep || ins.rep}) AS b
        FROM f JOIN n ON n.conv IS NOT DISTINCT FROM f.conv AND f.i = n.last JOIN ins ON ins.s = f.s AND ins.t IN (0, 3) GROUP BY f.conv)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(n.blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
    coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b.c, 0)::BIGINT AS cost,
    coalesce(b.audit, '') AS audit, sha256(coalesce(b.rep[:-2], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN n ON n.conv IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN z ON z.conv IS NOT DISTINCT FROM c.conv_id"""
