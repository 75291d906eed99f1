"""Independent SQL for the registered queries, written for DuckDB.

Built from named blocks that become common table expressions; ``sql(...)``
puts the blocks a query needs, in order, before its final select.
"""

from __future__ import annotations

from . import views as V

PUNCT = r"""['.&,!?/\\()\[\]_*@#%^~`|-]""".replace("'", "''")
WS = (
    r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
CASED = r"\p{Lu}\p{Ll}\p{Lt}"


def norm(x: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(lower({x}), '{PUNCT}+', ' ', 'g'), '{WS}+', ' ', 'g'))"
    )


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def rnd(x: str, k: int) -> str:
    return f"(round_even(({x}) * 1e{k}, 0) / 1e{k} + 0.0)"


def mean(x: str, where: str = "") -> str:
    """Mean of a score from its exact sum in millionths."""
    f = f" FILTER ({where})" if where else ""
    return f"(sum(cast(round_even({x} * 1e6, 0) AS BIGINT)){f} / (count({x}){f} * 1e6))"


def sid(*parts: str) -> str:
    joined = ", ".join(f"coalesce(cast({p} AS varchar), '')" for p in parts)
    return f"substr(sha256(concat_ws('||', {joined})), 1, 24)"


def values(name: str, columns: str, rows: list) -> str:
    body = ", ".join(
        "(" + ", ".join("'" + v.replace("'", "''") + "'" if isinstance(v, str) else repr(v) for v in r) + ")"
        for r in rows
    )
    return f"{name}({columns}) AS (VALUES {body})"


def word_list(name: str, words: list[str]) -> str:
    return values(name, "word", [(w,) for w in words])


def title_case(x: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all({x}, '[{CASED}]+|[^{CASED}]+'), "
        "lambda r: replace(upper(r[1]), 'ẞ', 'Ss') || lower(r[2:])), '')"
    )


def display(x: str) -> str:
    b = strip(f"regexp_replace({x}, '{PUNCT}+', '', 'g')")
    up, lo = r"\p{Lu}", r"\p{Ll}"
    return f"""(SELECT CASE
      WHEN b = '' THEN ''
      WHEN regexp_full_match(b, '[A-Z0-9]{{2,6}}') THEN b
      WHEN (regexp_matches(b[2:], '{up}') AND regexp_matches(b, '{lo}'))
        OR (regexp_matches(b, '{up}') AND NOT regexp_matches(b, '[{lo}\\p{{Lt}}]'))
      THEN CASE lower(b) WHEN 'samsung' THEN 'Samsung' WHEN 'lenovo' THEN 'Lenovo'
           WHEN 'fujifilm' THEN 'Fujifilm' WHEN 'cerave' THEN 'CeraVe' ELSE {title_case('b')} END
      WHEN regexp_matches(b, '{lo}') AND NOT regexp_matches(b, '[{up}\\p{{Lt}}]') THEN {title_case('b')}
      ELSE b END FROM (SELECT {b} AS b))"""


BLOCKS: dict[str, str] = {}

BLOCKS["ev"] = """ev AS (
  SELECT e.*, d.doc_id, d.text AS dtext, d.source AS dsource, left(d.text, 80) AS title, substr(d.text, 81) AS body
  FROM (SELECT * FROM events CROSS JOIN (SELECT count(*) AS n FROM documents) k) e
  JOIN documents d ON e.event_id % e.n = d.doc_id)"""

BLOCKS["mentions"] = f"""mentions AS (
  SELECT {sid("'events'", "'forum'", 'event_type', 'title', 'body', 'event_id')} AS mention_id,
    'events' AS source, 'forum' AS platform, event_type AS keyword, dsource AS category,
    concat('u', user_id) AS community, title, body AS text,
    concat('https://example.com/p/', event_id) AS url, ts AS published_at, value AS engagement_score
  FROM ev)"""

BLOCKS["collected"] = f"""collected AS (
  SELECT {sid("'events'", "'forum'", 'event_type', 'title', 'body')} AS mention_id,
    event_type AS source, dsource AS category, concat('u', user_id) AS community, title,
    nullif(body, '') AS text, ts AS collected_at, ts AS published_at, event_id
  FROM ev)"""

BLOCKS["lexicon"] = values("lexicon", "token, valence", V.LEXICON)

BLOCKS["scores"] = f"""words AS (
  SELECT mention_id, unnest(string_split(t, ' ')) AS token
  FROM (SELECT mention_id, {norm("title || ' ' || left(text, 500)")} AS t FROM mentions) WHERE t <> ''),
word_sums AS (
  SELECT mention_id, sum(v) AS s, sum(CASE WHEN v > 0 THEN v + 1 ELSE 0 END) AS p,
    sum(CASE WHEN v < 0 THEN 1 - v ELSE 0 END) AS g, count(*) FILTER (v = 0) AS u
  FROM (SELECT w.mention_id, coalesce(l.valence, 0.0)::DOUBLE AS v FROM words w LEFT JOIN lexicon l USING (token))
  GROUP BY 1),
scores AS (
  SELECT mention_id, {rnd('s / sqrt(s * s + 15)', 4)} AS sentiment_compound,
    {rnd('p / (p + g + u)', 3)} AS sentiment_positive, {rnd('g / (p + g + u)', 3)} AS sentiment_negative,
    {rnd('u / (p + g + u)', 3)} AS sentiment_neutral
  FROM (SELECT m.mention_id, coalesce(s, 0) AS s, coalesce(p, 0) AS p, coalesce(g, 0) AS g, coalesce(u, 1) AS u
        FROM mentions m LEFT JOIN word_sums USING (mention_id)))"""

BLOCKS["posts"] = """posts AS (
  SELECT m.*, s.* EXCLUDE (mention_id), CASE WHEN sentiment_compound >= 0.05 THEN 'positive'
    WHEN sentiment_compound <= -0.05 THEN 'negative' ELSE 'neutral' END AS sentiment_label
  FROM mentions m JOIN scores s USING (mention_id))"""

BLOCKS["windows"] = """windows AS (
  SELECT i::INTEGER AS window_id, a - INTERVAL 14 DAY * (i + 1) AS cur_start, a - INTERVAL 14 DAY * i AS cur_end,
    a - INTERVAL 14 DAY * (i + 2) AS prev_start, a - INTERVAL 14 DAY * (i + 1) AS prev_end
  FROM (SELECT max(published_at) AS a FROM mentions), range(4) r(i))"""

BLOCKS["sides"] = """sides AS (
  SELECT w.window_id, 'cur' AS side, p.* FROM posts p JOIN windows w
    ON p.published_at >= w.cur_start AND p.published_at < w.cur_end
  UNION ALL
  SELECT w.window_id, 'prev' AS side, p.* FROM posts p JOIN windows w
    ON p.published_at >= w.prev_start AND p.published_at < w.prev_end)"""

BLOCKS["periods"] = f"""periods AS (
  SELECT window_id, side, category, count(mention_id) AS mentions, count(DISTINCT community) AS communities,
    {mean('sentiment_compound')} AS mean_sentiment, avg(engagement_score) AS mean_engagement
  FROM sides GROUP BY ALL)"""

BLOCKS["stats"] = f"""base AS (
  SELECT w.window_id, c.category,
    coalesce(k.mentions, 0)::BIGINT AS current_mentions, coalesce(k.communities, 0)::BIGINT AS current_communities,
    coalesce(k.mean_sentiment, 0) AS mean_sentiment, coalesce(k.mean_engagement, 0) AS mean_engagement,
    coalesce(v.mentions, 0)::BIGINT AS previous_mentions, coalesce(v.communities, 0)::BIGINT AS communities_p,
    coalesce(v.mean_sentiment, 0) AS mean_sentiment_p, coalesce(v.mean_engagement, 0) AS mean_engagement_p
  FROM windows w CROSS JOIN (SELECT DISTINCT category FROM mentions) c
  LEFT JOIN periods k ON k.side = 'cur' AND k.window_id = w.window_id AND k.category = c.category
  LEFT JOIN periods v ON v.side = 'prev' AND v.window_id = w.window_id AND v.category = c.category),
s1 AS (SELECT *, {rnd('current_mentions / CASE previous_mentions WHEN 0 THEN 1 ELSE previous_mentions END', 3)} AS spike_ratio FROM base),
q1 AS (SELECT window_id, quantile_cont(spike_ratio, 0.97) AS qs, max(current_communities) AS mc,
    median(mean_engagement) AS me FROM s1 GROUP BY 1),
s2 AS (SELECT s1.*, {rnd('least(spike_ratio, qs) / greatest(qs, 1)', 4)} AS normalized_spike,
    {rnd('current_communities / greatest(mc, 1)', 4)} AS cross_community,
    {rnd('(mean_sentiment + 1) / 2', 4)} AS sentiment_score,
    {rnd('''least(4, CASE WHEN mean_engagement_p <> 0 THEN mean_engagement / mean_engagement_p
       WHEN me <> 0 THEN mean_engagement / me WHEN mean_engagement > 0 THEN 4
       WHEN mean_engagement = 0 THEN 1 ELSE 0 END)''', 4)} AS eng_momentum
  FROM s1 JOIN q1 USING (window_id)),
q2 AS (SELECT window_id, quantile_cont(eng_momentum, 0.97) AS qe FROM s2 GROUP BY 1),
s3 AS (SELECT s2.*, {rnd('eng_momentum / greatest(qe, 1)', 4)} AS eng_momentum_norm FROM s2 JOIN q2 USING (window_id)),
stats AS (SELECT *, {rnd('0.25 * normalized_spike + 0.25 * cross_community + 0.25 * sentiment_score + 0.25 * eng_momentum_norm', 4)} AS trend_score,
    CASE WHEN spike_ratio >= 1.4 THEN 'rising' WHEN spike_ratio <= 0.6 THEN 'declining' ELSE 'stable' END AS trend_direction,
    current_mentions - previous_mentions AS mentions_delta FROM s3)"""

BLOCKS["newest"] = "newest AS (SELECT * FROM stats WHERE window_id = 0)"

BLOCKS["entries"] = f"""dwords AS (
  SELECT source, string_split({norm("left(text, 80) || ' ' || substr(text, 81)")}, ' ') AS w FROM documents),
singles AS (
  SELECT raw FROM (SELECT DISTINCT source, unnest(w) AS raw FROM dwords) WHERE length(raw) >= 4
  GROUP BY raw HAVING count(*) BETWEEN 3 AND 8 OR raw IN ('with', 'this', 'from')),
pairs AS (
  SELECT raw FROM (SELECT DISTINCT source, w[i] || '-' || w[i + 1] AS raw
                   FROM (SELECT source, w, unnest(range(1, len(w))) AS i FROM dwords))
  GROUP BY raw HAVING count(*) BETWEEN 2 AND 6),
entries AS (
  SELECT 'a_words' AS list, 0 AS ordinal, raw FROM singles
  UNION ALL SELECT 'b_pairs', 0, raw FROM pairs
  UNION ALL SELECT 'c_parts', p_partkey, p_name FROM part)"""

BLOCKS["word_sets"] = ", ".join(
    [word_list("dict", V.DICTIONARY), word_list("known", V.KNOWN), word_list("noise", V.NOISE)]
)

BLOCKS["whitelist"] = f"""normed AS (
  SELECT list, ordinal, trim(raw) AS raw, {norm('raw')} AS norm FROM entries
  WHERE trim(raw) NOT IN ('', 'nan', 'brand_name')),
judged AS (
  SELECT list, ordinal, raw, norm, count(*) AS n_words, count(*) FILTER (w IN (SELECT word FROM noise)) AS k_noise,
    count(*) FILTER (w IN (SELECT word FROM dict)) AS k_dict,
    count(*) FILTER (w NOT IN (SELECT word FROM dict) AND w NOT IN (SELECT word FROM noise)) AS k_rare
  FROM (SELECT *, unnest(string_split(norm, ' ')) AS w FROM normed WHERE length(norm) >= 3) GROUP BY ALL),
kept AS (
  SELECT *, {display('raw')} AS display FROM judged
  WHERE CASE WHEN n_words = 1 THEN k_noise = 0
         AND (norm IN (SELECT word FROM known)
              OR NOT (k_dict = 1 OR (length(norm) < 4 AND regexp_full_match(norm, '\\p{{L}}+'))))
       ELSE k_noise < n_words AND NOT (k_rare = 0 AND k_dict = n_words) END),
whitelist AS (
  SELECT norm, display FROM kept WHERE display <> ''
  QUALIFY row_number() OVER (PARTITION BY norm ORDER BY list, ordinal) = 1)""".replace("\\\\p{L}", "\\p{L}")

BLOCKS["hits"] = f"""ner AS (
  SELECT mention_id, regexp_split_to_array({strip("title || ' ' || left(text, 400)")}, '{WS}+') AS t FROM mentions),
grams AS (
  SELECT DISTINCT mention_id, {norm("array_to_string(t[i:i + n - 1], ' ')")} AS norm
  FROM (SELECT mention_id, t, n, unnest(range(1, len(t) - n + 2)) AS i FROM ner, range(1, 5) r(n))),
hits AS (SELECT DISTINCT g.mention_id, w.display AS brand FROM grams g JOIN whitelist w USING (norm))"""

BLOCKS["brands"] = f"""bc AS (
  SELECT s.window_id, s.category, h.brand, count(*) FILTER (side = 'cur') AS cur_mentions,
    count(*) FILTER (side = 'prev') AS prev_mentions, {mean('sentiment_compound', "side = 'cur'")} AS a
  FROM sides s JOIN hits h USING (mention_id) GROUP BY ALL HAVING count(*) FILTER (side = 'cur') > 0),
spread AS (SELECT window_id, brand, count(DISTINCT category) AS nc FROM bc GROUP BY ALL),
allcats AS (SELECT window_id, count(DISTINCT category) AS tc FROM bc GROUP BY ALL),
brands AS (
  SELECT window_id, category, brand, cur_mentions, prev_mentions,
    {rnd('cur_mentions / greatest(prev_mentions, 1)', 2)} AS brand_spike, {rnd('a', 3)} AS avg_sentiment,
    (row_number() OVER (PARTITION BY window_id, category ORDER BY cur_mentions DESC, brand))::INTEGER AS rank
  FROM bc JOIN spread USING (window_id, brand) JOIN allcats USING (window_id)
  WHERE cur_mentions >= 2 AND nc / tc <= 0.4
  QUALIFY rank <= 25)"""

BLOCKS["samples"] = """samples AS (
  SELECT window_id, category, mention_id, title, community, engagement_score, sentiment_label, url,
    (row_number() OVER (PARTITION BY window_id, category ORDER BY engagement_score DESC, mention_id))::INTEGER AS rank
  FROM sides WHERE side = 'cur' QUALIFY rank <= 5)"""

# What each block builds on, in order.
NEEDS = {
    "mentions": ["ev"],
    "collected": ["ev"],
    "scores": ["mentions", "lexicon"],
    "posts": ["scores"],
    "windows": ["mentions"],
    "sides": ["posts", "windows"],
    "periods": ["sides"],
    "stats": ["periods"],
    "newest": ["stats"],
    "whitelist": ["entries", "word_sets"],
    "hits": ["mentions", "whitelist"],
    "brands": ["hits", "sides"],
    "samples": ["sides"],
}


def sql(final: str, *blocks: str, recursive: bool = False) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for b in blocks:
        add(b)
    if not order:
        return final
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(BLOCKS[b] for b in order) + "\n" + final

BLOCKS["record"] = f"""record AS (
  SELECT {sid('source', 'platform', 'keyword', 'title', 'text', 'url')} AS mention_id, *,
    {strip("title || ' ' || text")} AS full_text FROM raw)"""

BLOCKS["catalog"] = """entries_c AS (
  SELECT r_regionkey AS k, r_name AS category, n_nationkey AS p, n_name AS community
  FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT r_regionkey, r_name, n_nationkey + 100, CASE WHEN n_nationkey % 2 = 1 THEN lower(n_name) ELSE n_name END
  FROM nation JOIN region ON r_regionkey = n_regionkey + 1),
firsts AS (
  SELECT *, CASE category WHEN 'EUROPE' THEN 0 WHEN 'ASIA' THEN 1 ELSE 2 END AS place FROM entries_c
  QUALIFY row_number() OVER (PARTITION BY community ORDER BY place, k, p) = 1),
catalog AS (
  SELECT category, community, row_number() OVER (ORDER BY place, k, p) AS ordinal FROM firsts)"""

ARCHIVE = """raw AS (
  SELECT 'arctic_shift_reddit' AS source, 'reddit' AS platform, 'r/' || dsource AS sub_source,
    'submission' AS source_type, 'r/' || dsource AS keyword, 'r/' || dsource || ' 2026' AS query,
    CASE event_type WHEN 'signup' THEN '' ELSE title END AS title,
    CASE WHEN event_type IN ('click', 'view') THEN '' ELSE {body} END AS text,
    CASE event_type WHEN 'view' THEN '[deleted]' ELSE concat('u', user_id) END AS author, dsource AS community,
    CASE event_type WHEN 'error' THEN '' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') END AS published_at,
    CASE event_type WHEN 'purchase' THEN '' ELSE 'https://reddit.com/r/p/' || event_id END AS url,
    (CASE event_type WHEN 'click' THEN 0 ELSE floor(value) END + 3 * user_id)::DOUBLE AS engagement_score,
    '{{"score": ' || CASE event_type WHEN 'click' THEN 'null' ELSE floor(value)::BIGINT::VARCHAR END
      || ', "num_comments": ' || user_id || '}}' AS metrics_json
  FROM ev WHERE event_type = 'error' OR ts >= '2024-01-10')""".format(body=strip("body"))

LISTING = """raw AS (
  SELECT 'reddit_json' AS source, 'reddit' AS platform, 'r/' || sub AS sub_source, 'submission' AS source_type,
    'r/' || sub AS keyword, 'r/' || sub || ' ' || sort || ' 2026' AS query, title,
    CASE event_type WHEN 'click' THEN '' WHEN 'view' THEN ' [deleted]' ELSE body END AS text,
    concat('u', user_id) AS author, sub AS community, strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS published_at,
    'https://reddit.com/l/' || event_id AS url, (floor(value) + 3 * user_id)::DOUBLE AS engagement_score,
    '{"score": ' || floor(value)::BIGINT || ', "num_comments": ' || user_id || ', "upvote_ratio": 0.5}' AS metrics_json
  FROM (SELECT *, 'sub' || (event_id // 100 % 7) AS sub,
          CASE WHEN event_id // 100 % 2 = 0 THEN 'new' ELSE 'top' END AS sort FROM ev)
  WHERE ts >= '2024-01-05')"""

FEED = """raw AS (
  SELECT 'reddit_rss' AS source, 'reddit' AS platform, 'r/' || source AS sub_source, 'submission' AS source_type,
    'r/' || source AS keyword, 'r/' || source || ' hot' AS query, left(text, 80) AS title, text, lang AS author,
    source AS community, CASE lang WHEN 'en' THEN strftime(tm, '%Y-%m-%dT%H:%M:%S+00:00')
      WHEN 'de' THEN strftime(tm, '%Y-%m-%dT%H:%M:%S+02:00') WHEN 'fr' THEN strftime(tm, '%d %b %Y %H:%M:%S GMT')
      ELSE 'yesterday' END AS published_at,
    'https://example.com/d/' || doc_id AS url, 0.0::DOUBLE AS engagement_score, '{}' AS metrics_json
  FROM (SELECT *, TIMESTAMP '2024-01-01' + INTERVAL 1 DAY * (doc_id % 40) AS tm FROM documents)
  WHERE NOT ((lang = 'en' AND tm < '2024-01-10') OR (lang = 'de' AND tm - INTERVAL 2 HOUR < '2024-01-10')))"""

STORIES = """raw AS (
  SELECT 'hackernews_algolia' AS source, 'forum' AS platform, 'hackernews' AS sub_source,
    CASE turn WHEN 0 THEN 'story' ELSE 'comment' END AS source_type, role AS keyword, role AS query,
    CASE WHEN turn > 0 THEN 'story ' || conv_id ELSE left(text, 60) END AS title, text, role AS author,
    'hackernews' AS community, strftime(tm, '%Y-%m-%dT%H:%M:%SZ') AS published_at,
    CASE turn WHEN 0 THEN 'https://example.com/c/' || conv_id
      ELSE 'https://news.ycombinator.com/item?id=' || conv_id || '-' || turn END AS url,
    (CASE turn WHEN 0 THEN length(text) ELSE 0 END + 3 * turn)::DOUBLE AS engagement_score,
    '{"points": ' || CASE turn WHEN 0 THEN length(text)::VARCHAR ELSE 'null' END || ', "num_comments": ' || turn || '}' AS metrics_json
  FROM (SELECT *, TIMESTAMP '2024-01-01' + INTERVAL 1 SECOND * (conv_id * 977 + turn * 60) AS tm FROM conversations)
  WHERE tm > '2024-01-01' AND tm < '2024-01-03 23:59:59')"""

NEWS = """raw AS (
  SELECT 'google_news_rss' AS source, 'news' AS platform, host AS sub_source, 'article_snippet' AS source_type,
    q AS keyword, q AS query, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, html AS text,
    host AS author, host AS community, 'Mon, 01 Jan 2024 10:00:00 GMT' AS published_at, url,
    0.0::DOUBLE AS engagement_score, '{}' AS metrics_json
  FROM (SELECT *, regexp_extract(url, '://([^/]+)/', 1) AS host, regexp_extract(url, '\\.example\\.([a-z]+)/', 1) AS q
        FROM pages))"""

RECORD_COLUMNS = (
    "mention_id, source, platform, sub_source, source_type, keyword, query, title, text, full_text, author, "
    "community, published_at, url, engagement_score, metrics_json"
)


def records(raw: str, *blocks: str) -> str:
    head = sql("", *blocks) if blocks else "WITH "
    sep = ",\n" if blocks else " "
    return f"{head.rstrip()}{sep}{raw},\n{BLOCKS['record']}\nSELECT {RECORD_COLUMNS} FROM record"

# --- vectors ----------------------------------------------------------------

BLOCKS["knn"] = """pairs_v AS (
  SELECT a.vec_id AS src, b.vec_id AS dst,
    round_even((1 - list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[])) * 1e9, 0) / 1e9 AS distance
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
knn AS (
  SELECT src, dst, distance, row_number() OVER (PARTITION BY src ORDER BY distance, dst)::INTEGER AS rank
  FROM pairs_v QUALIFY rank <= 15)"""

BLOCKS["clusters"] = """core AS (SELECT src AS id, distance AS core FROM knn WHERE rank = 10),
close_e AS (
  SELECT src, dst FROM knn JOIN core a ON a.id = src JOIN core b ON b.id = dst
  WHERE greatest(distance, a.core, b.core) <= (SELECT quantile_disc(core, 0.8) FROM core)),
undirected AS (SELECT src, dst FROM close_e UNION SELECT dst, src FROM close_e),
reach AS (
  SELECT src AS id, src AS other FROM undirected
  UNION SELECT r.id, u.dst FROM reach r JOIN undirected u ON u.src = r.other),
parts AS (SELECT id, min(other) AS root FROM reach GROUP BY 1),
big AS (SELECT root FROM parts GROUP BY 1 HAVING count(*) >= 20),
clusters AS (
  SELECT e.vec_id, b.root AS cluster_root FROM embeddings e LEFT JOIN parts p ON p.id = e.vec_id
  LEFT JOIN big b ON b.root = p.root)"""
NEEDS["clusters"] = ["knn"]

# --- relevance --------------------------------------------------------------

BLOCKS["contexts"] = values("contexts", "label, ctext", V.CONTEXTS)
BLOCKS["context_scores"] = f"""tf AS (
  SELECT mention_id, word, count(*) AS tf FROM (
    SELECT mention_id, unnest(string_split({norm("title || ' ' || text")}, ' ')) AS word FROM mentions)
  WHERE word <> '' GROUP BY ALL),
idf AS (
  SELECT word, ln(((SELECT count(*) FROM mentions) + 1) / (count(*) + 1)) + 1 AS idf FROM tf GROUP BY 1),
ref AS (
  SELECT label, word, count(*) * coalesce(any_value(idf), ln((SELECT count(*) FROM mentions) + 1) + 1) AS r
  FROM (SELECT label, unnest(string_split({norm('ctext')}, ' ')) AS word FROM contexts) LEFT JOIN idf USING (word)
  GROUP BY ALL),
rn AS (SELECT label, sqrt(sum(r * r)) AS rn FROM ref GROUP BY 1),
mn AS (SELECT mention_id, sqrt(sum(tf * idf * tf * idf)) AS mn FROM tf JOIN idf USING (word) GROUP BY 1),
context_scores AS (
  SELECT mention_id, label, {rnd('dot / (mn * rn)', 6)} AS score FROM (
    SELECT mention_id, label, sum(tf * idf * r) AS dot FROM tf JOIN idf USING (word) JOIN ref USING (word) GROUP BY ALL)
  JOIN mn USING (mention_id) JOIN rn USING (label))"""
NEEDS["context_scores"] = ["mentions", "contexts"]

RULED = f"""tok AS (
  SELECT mention_id, generate_subscripts(ws, 1) AS i, unnest(ws) AS raw, len(ws) AS n, t
  FROM (SELECT mention_id, t, regexp_split_to_array({strip('t')}, '{WS}+') AS ws
        FROM (SELECT mention_id, title || ' ' || left(text, 500) AS t FROM mentions)) WHERE {strip('t')} <> ''),
bare AS (
  SELECT *, CASE WHEN length(b) <= 2 THEN raw ELSE b END AS w FROM (
    SELECT *, regexp_replace(regexp_replace(raw, '^[[:punct:]]+', ''), '[[:punct:]]+$', '') AS b FROM tok)),
flags AS (
  SELECT *, lower(w) AS k, regexp_matches(w, '\\p{{Lu}}') AND NOT regexp_matches(w, '[\\p{{Ll}}\\p{{Lt}}]') AS loud FROM bare),
post AS (
  SELECT mention_id, count(*) FILTER (loud) AS n_loud, count(*) AS n, min(i) FILTER (k = 'but') AS but,
    least(4, length(any_value(t)) - length(replace(any_value(t), '!', ''))) * 0.292
    + CASE WHEN length(any_value(t)) - length(replace(any_value(t), '?', '')) <= 1 THEN 0
           WHEN length(any_value(t)) - length(replace(any_value(t), '?', '')) <= 3
           THEN (length(any_value(t)) - length(replace(any_value(t), '?', ''))) * 0.18 ELSE 0.96 END AS amp
  FROM flags GROUP BY 1),
near AS (
  SELECT f.*, {', '.join(f"lag(k, {j}) OVER w AS k{j}, lag(loud, {j}) OVER w AS l{j}" for j in (1, 2, 3))}
  FROM flags f WINDOW w AS (PARTITION BY mention_id ORDER BY i)),
lexm AS (SELECT token FROM lexicon),
mods AS (
  SELECT 'n' AS kind, word FROM negs WHERE word NOT IN (SELECT token FROM lexm)
  UNION ALL SELECT 'u', word FROM ups WHERE word NOT IN (SELECT token FROM lexm)
  UNION ALL SELECT 'd', word FROM downs WHERE word NOT IN (SELECT token FROM lexm)),
val AS (
  SELECT n.mention_id, n.i, n.loud, n_loud > 0 AND n_loud < p.n AS mixed, but, amp,
    CASE WHEN k IN (SELECT word FROM ups UNION SELECT word FROM downs) THEN 0 ELSE coalesce(l.valence, 0)::DOUBLE END AS v,
    {', '.join(f'''CASE WHEN k{j} IN (SELECT word FROM mods WHERE kind = 'u') THEN 0.293
       WHEN k{j} IN (SELECT word FROM mods WHERE kind = 'd') THEN -0.293 ELSE 0 END AS b{j}, coalesce(l{j}, false) AS l{j},
    coalesce(k{j} IN (SELECT word FROM mods WHERE kind = 'n') OR contains(k{j}, 'n''t'), false)::INTEGER AS g{j}''' for j in (1, 2, 3))}
  FROM near n JOIN post p USING (mention_id) LEFT JOIN lexicon l ON l.token = n.k),
fin AS (
  SELECT mention_id, amp, CASE WHEN v = 0 THEN 0 ELSE
    (v + sign(v) * (CASE WHEN loud AND mixed THEN 0.733 ELSE 0 END
      {' '.join(f"+ (b{j} + CASE WHEN l{j} AND mixed AND b{j} <> 0 THEN 0.733 ELSE 0 END) * {d}" for j, d in ((1, 1.0), (2, 0.95), (3, 0.9)))}))
    * pow(-0.74, g1 + g2 + g3) * CASE WHEN but IS NULL OR i = but THEN 1 WHEN i < but THEN 0.5 ELSE 1.5 END END AS v
  FROM val),
agg AS (
  SELECT mention_id, any_value(amp) AS amp, sum(v) AS s, sum(CASE WHEN v > 0 THEN v + 1 ELSE 0 END) AS p,
    sum(CASE WHEN v < 0 THEN 1 - v ELSE 0 END) AS g, count(*) FILTER (v = 0) AS u FROM fin GROUP BY 1),
amped AS (
  SELECT mention_id, CASE WHEN s > 0 THEN s + amp WHEN s < 0 THEN s - amp ELSE 0 END AS s,
    p + CASE WHEN p > g THEN amp ELSE 0 END AS p, g + CASE WHEN p < g THEN amp ELSE 0 END AS g, u FROM agg)"""

BLOCKS["modifiers"] = ", ".join(
    [word_list("negs", V.NEGATIONS), word_list("ups", V.BOOSTERS), word_list("downs", V.DAMPENERS)]
)
BLOCKS["ruled"] = RULED
NEEDS["ruled"] = ["mentions", "lexicon", "modifiers"]
