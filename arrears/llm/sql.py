"""DuckDB SQL of the registered queries, each from the definition of its result."""

from __future__ import annotations

from arrears.llm import chat_format, host_rules, licenses, mixing, url_lists

WORD = r"[^\x20\x09-\x0D]+"
TOKEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWERED = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


MIX_SOURCES = rf"""
WITH docs AS (
  SELECT doc_id, source, coalesce(doc_id, {mixing.NO_ID + 1} - 1) AS id,
         len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
         ('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, {mixing.KEY_DIGITS}))::BIGINT AS key
  FROM documents),
ranked AS (
  SELECT source, sum(size)::BIGINT AS s,
         [{', '.join(map(str, mixing.WEIGHTS))}][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)}) + 1] AS w
  FROM docs GROUP BY source),
-- the level at which weight times level, stopped at {mixing.MAX_EPOCHS} sizes, adds up to all words
levels AS (
  SELECT (sum(s) OVER () - coalesce(sum({mixing.MAX_EPOCHS} * s) OVER (ORDER BY {mixing.MAX_EPOCHS} * s / w, source NULLS LAST
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / (sum(w) OVER (ORDER BY {mixing.MAX_EPOCHS} * s / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM ranked),
targets AS (
  SELECT source, s, least({mixing.MAX_EPOCHS} * s::DOUBLE, w * (SELECT max(level) FROM levels)) AS target FROM ranked),
placed AS (
  SELECT d.*, t.s, t.target, floor(t.target)::BIGINT AS budget,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.id, d.size)::BIGINT AS upto,
         count(*) OVER (PARTITION BY d.source, d.key, d.id, d.size) AS copies
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, s AS source_size, target,
       CASE WHEN s = 0 THEN 0 ELSE (budget // s) * size +
         greatest(0, least(size, (budget % s - (upto - size * copies)) // copies)) END::BIGINT AS taken
FROM placed"""

_ESCAPED = (r"regexp_replace(regexp_replace(replace({}, '&', '" + chat_format.AMP + r"'), '"
            + chat_format.ANGLE_CONTROL + r"', '" + chat_format.ANGLE + r"\1', 'g'), '"
            + chat_format.SQUARE_CONTROL + r"', '" + chat_format.SQUARE + r"\1', 'g')")

CHAT_FORMAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES ({chat_format.CONTROL_ID}, 0, 'user', {_quoted(chat_format.CONTROL_TEXT)}),
                   ({chat_format.CONTROL_ID}, 1, 'assistant', {_quoted(chat_format.CONTROL_TEXT)}))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum({len(chat_format.START) + len(chat_format.TEXT) + len(chat_format.END)}
           + length({_ESCAPED.format('role')}) + length({_ESCAPED.format('text')}))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id"""

HOST_RULES = rf"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
windows AS (
  SELECT r, i, ws[i:i + 2] AS win FROM split, unnest(range(1, len(ws) - 1)) AS u(i)),
repeated AS (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM windows),
covered AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM repeated, unnest([0, 1, 2]) AS u(k) WHERE n > 1 GROUP BY r),
lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM split)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
measured AS (
  SELECT doc_id, source, len(ws)::BIGINT AS n_words,
         length(array_to_string(ws, ''))::BIGINT AS chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM split LEFT JOIN covered USING (r) LEFT JOIN lines USING (r)),
judged AS (
  SELECT *, n_words < {host_rules.MIN_WORDS} OR 100 * n_repeat_words > {host_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM measured),
hosts AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS fails FROM judged GROUP BY source),
moments AS (SELECT avg(fails / n) AS m, var_pop(fails / n) AS v FROM hosts),
prior AS (
  SELECT m, CASE WHEN m * (1 - m) / nullif(v, 0) - 1 > 0 THEN m * (1 - m) / v - 1 ELSE {host_rules.DEFAULT_STRENGTH} END AS s
  FROM moments),
verdicts AS (SELECT source, (fails + m * s) / (n + s) > {host_rules.MAX_RATE} AS rejected FROM hosts, prior)
SELECT doc_id, n_words, coalesce(chars, 0)::BIGINT AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT rejected AS kept
FROM judged j JOIN verdicts v ON j.source IS NOT DISTINCT FROM v.source"""


def _spelled(text: str) -> str:
    out = f"' ' || {text} || ' '"
    for one, other in licenses.SPELLINGS:
        out = f"replace({out}, '{one}', '{other}')"
    return out


def _stated(low: str) -> str:
    return rf"regexp_replace(regexp_replace({low}, '{licenses.STATEMENT}', '\1', 'g'), '{licenses.HOLDER_LINE}', '\1', 'g')"


def _blocks(low: str) -> str:
    flat = (f"regexp_replace(regexp_replace({low}, '{licenses.BETWEEN_BLOCKS}', ' ' || chr(1) || ' ', 'g'), "
            f"'{licenses.IN_TEXT}', ' ', 'g')")
    return f"list_filter(list_transform(string_split({_spelled(flat)}, chr(1)), lambda b: trim(b, ' ')), lambda b: b <> '')"


_LICENSE_LINE = f"trim({_spelled(f"""regexp_replace(line, '{licenses.IN_LINE}', ' ', 'g')""")}, ' ')"

# Entire texts and notices, each with and without its copyright statements; documents likewise.
LICENSE_SCAN = f"""
WITH given(license, text) AS (VALUES {', '.join(f'({_quoted(i)}, {_quoted(t)})' for i, t in [*licenses.KNOWN, *licenses.full_texts()])}),
given_low AS (SELECT license, {LOWERED.format('text')} AS low FROM given),
forms AS (
  SELECT DISTINCT license, array_to_string(bs, ' ') AS form, bs
  FROM (SELECT license, {_blocks('low')} AS bs FROM given_low UNION ALL SELECT license, {_blocks(_stated('low'))} FROM given_low)
  WHERE len(bs) > 0),
known AS (SELECT form, min(license) AS license FROM forms GROUP BY 1),
arranged AS (SELECT license, form, bs FROM forms UNION SELECT license, form, [form] FROM forms),
docs AS (SELECT row_number() OVER () AS r, doc_id, {LOWERED.format('text')} AS low FROM documents),
read AS (SELECT r, doc_id, low, {_blocks('low')} AS plain, {_blocks(_stated('low'))} AS stated FROM docs),
line_hits AS (
  SELECT r, license FROM (SELECT r, {_LICENSE_LINE} AS form FROM (SELECT r, unnest(string_split(low, chr(10))) AS line FROM docs))
  JOIN known USING (form)),
both_forms AS (SELECT r, plain AS bs FROM read UNION ALL SELECT r, stated FROM read WHERE stated <> plain),
block_hits AS (
  SELECT DISTINCT r, license
  FROM (SELECT r, bs, unnest(bs) AS block, unnest(range(1, len(bs) + 1)) AS i FROM both_forms) d
  JOIN arranged a ON d.block = a.bs[1] AND d.bs[i:i + len(a.bs) - 1] = a.bs),
whole AS (
  SELECT r, doc_id, array_to_string(stated, ' ') AS form, coalesce(k.license, o.license) AS license
  FROM read LEFT JOIN known k ON k.form = array_to_string(stated, ' ') LEFT JOIN known o ON o.form = array_to_string(plain, ' ')),
found AS (
  SELECT r, string_agg(DISTINCT license, ',' ORDER BY license) AS notices, sum(n) AS n
  FROM (SELECT r, license, count(*) AS n FROM line_hits GROUP BY ALL
        UNION ALL SELECT r, b.license, 0 FROM block_hits b JOIN whole USING (r) WHERE whole.license IS NULL)
  GROUP BY r)
SELECT doc_id, sha256(form) AS text_digest, license, coalesce(notices, '') AS notices, coalesce(n, 0)::BIGINT AS n_notice_lines
FROM whole LEFT JOIN found USING (r)"""

_HOST = rf"regexp_extract({LOWERED.format('url')}, '{url_lists.HOST}', 2)"

URL_LISTS = f"""
WITH captures AS (
  SELECT row_number() OVER () AS r, page_id, url, {_HOST} AS host,
         TIMESTAMP '2024-01-01' + to_seconds(('0x' || substr(md5(coalesce(url, '')), 1, 8))::BIGINT % 2592000) AS fetched
  FROM pages),
entries AS (
  SELECT CASE WHEN event_id % 2 = 0 OR len(string_split(host, '.')) < 3 THEN host
              ELSE array_to_string(string_split(host, '.')[2:], '.') END AS domain, ts AS since, max(event_type) AS category
  FROM events e JOIN captures c ON e.user_id = c.page_id WHERE host <> '' AND ts IS NOT NULL GROUP BY 1, 2),
intervals AS (
  SELECT *, lead(since) OVER (PARTITION BY domain ORDER BY since) AS until FROM entries),
levels AS (
  SELECT r, fetched, array_to_string(labels[i:], '.') AS domain
  FROM (SELECT *, string_split(host, '.') AS labels FROM captures WHERE host <> ''),
       unnest(range(1, greatest(len(labels), 2))) AS u(i)),
best AS (
  SELECT r, arg_max(l.domain, length(l.domain)) AS listed, arg_max(category, length(l.domain)) AS category
  FROM levels l JOIN intervals v ON l.domain = v.domain AND since <= fetched AND (until IS NULL OR fetched < until)
  GROUP BY r)
SELECT page_id, url, host, listed, category, coalesce(category NOT IN ({', '.join(map(_quoted, url_lists.BLOCKED))}), true) AS kept
FROM captures LEFT JOIN best USING (r)"""

DECONTAMINATE = rf"""
WITH items AS (
  SELECT item_id, regexp_extract_all({LOWERED.format('text')}, '{TOKEN}') AS ws FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS n, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') AS win
  FROM items, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS u(i) WHERE len(ws) > 0),
docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWERED.format('text')}, '{TOKEN}') AS ws FROM documents),
sizes AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT r, n, i, array_to_string(ws[i:i + n - 1], ' ') AS win FROM docs, sizes, unnest(range(1, len(ws) - n + 2)) AS u(i)),
hits AS (SELECT r, d.n, i, item_id FROM doc_windows d JOIN item_windows w ON d.n = w.n AND d.win = w.win),
words AS (SELECT r, count(DISTINCT i + k) AS n_hit FROM hits, unnest(range(0, n)) AS u(k) GROUP BY r),
ids AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, coalesce(item_id::VARCHAR, '') AS id FROM hits) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN ids USING (r)"""


# Importance resampling: the CRC-32 of each distinct feature in steps of a byte.
IMPORTANCE_RESAMPLING = rf"""
WITH RECURSIVE texts AS (
  SELECT 'd' AS kind, row_number() OVER () AS rid, doc_id, regexp_extract_all({LOWERED.format('text')}, '{TOKEN}') AS w FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), NULL, regexp_extract_all({LOWERED.format('text')}, '{TOKEN}') FROM benchmark),
feats AS (
  SELECT kind, rid, unnest(w) AS f FROM texts
  UNION ALL SELECT kind, rid, a || ' ' || b FROM (SELECT kind, rid, unnest(w) AS a, unnest(w[2:]) AS b FROM texts) WHERE b IS NOT NULL),
-- CRC-32 of each distinct feature, a byte a step
table_steps(i, c, k) AS (
  SELECT i, i, 0 FROM (SELECT unnest(range(256))::BIGINT AS i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM table_steps WHERE k < 8),
crc_table AS (SELECT i, c AS v FROM table_steps WHERE k = 8),
steps(f, h, k, c) AS (
  SELECT f, hex(encode(f)), 0, 4294967295::BIGINT FROM (SELECT DISTINCT f FROM feats)
  UNION ALL SELECT f, h, k + 1, xor(c >> 8, v) FROM steps JOIN crc_table
    ON i = xor(c & 255, ('0x' || substr(h, 2 * k + 1, 2))::BIGINT) WHERE 2 * k < length(h)),
bucket AS (SELECT f, xor(c, 4294967295) % 10000 AS b FROM steps WHERE 2 * k = length(h)),
placed AS (SELECT kind, rid, b FROM feats JOIN bucket USING (f)),
counts AS (SELECT b, count(*) FILTER (WHERE kind = 'd') AS s, count(*) FILTER (WHERE kind = 'b') AS t FROM placed GROUP BY b),
sums AS (SELECT sum(s)::DOUBLE AS sa, sum(t)::DOUBLE AS ta FROM counts),
gain AS (SELECT b, floor(1000 * ln((t + 1)::DOUBLE * (sa + 10000) / ((s + 1)::DOUBLE * (ta + 10000))))::BIGINT AS g FROM counts, sums),
weighed AS (SELECT rid, count(*) AS n, sum(g)::HUGEINT AS total
            FROM placed JOIN gain USING (b) WHERE kind = 'd' GROUP BY rid),
scored AS (
  SELECT doc_id, len(w) AS words, coalesce(n, 0) AS n_features,
    CASE WHEN n IS NULL THEN 0 ELSE (total - ((total % n) + n) % n) // n END::BIGINT AS weight,
    floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS noise
  FROM texts LEFT JOIN weighed USING (rid) WHERE kind = 'd'),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY words >= 20 ORDER BY weight + noise DESC, doc_id NULLS FIRST, weight, n_features, words) AS r,
    count(*) FILTER (WHERE words >= 20) OVER () AS able FROM scored)
SELECT doc_id, n_features::BIGINT AS n_features, weight, weight + noise AS score,
  CASE WHEN words >= 20 AND r <= 25 * able // 100 THEN r END::BIGINT AS rank FROM ranked
"""



# Source divergence: all shares side by side, every pair of sources over every kept term.
SOURCE_DIVERGENCE = r"""
WITH words AS (
  SELECT rid, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
        FROM documents)),
kept AS (SELECT lang, term, count(*)::HUGEINT AS total FROM words GROUP BY lang, term HAVING count(DISTINCT rid) >= 3),
langs AS (SELECT lang, sum(total)::HUGEINT AS size, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
counts AS (SELECT w.lang, w.source, w.term, count(*)::HUGEINT AS n FROM words w JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
sizes AS (SELECT g.lang, g.source, coalesce((SELECT sum(n) FROM counts c WHERE c.lang = g.lang AND c.source = g.source), 0)::HUGEINT AS size
          FROM groups g),
shares AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (s.size + l.v) AS p,
    1 + (1000000000 * (k.total + 1)) // (l.size + l.v) AS q
  FROM sizes s JOIN kept k ON k.lang = s.lang JOIN langs l ON l.lang = s.lang
  LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
          FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM every)
SELECT lang, source, part, item, value::BIGINT AS value, r::INTEGER AS rank FROM ranked WHERE part = 'pair' OR r <= 200
"""
