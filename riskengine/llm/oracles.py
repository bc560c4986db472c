"""DuckDB statements for the corpus queries that SQL can express."""

from __future__ import annotations

from riskengine.llm.hardneg import HIGH, LOW, NEGATIVES, POSITIVES, SCALE
from riskengine.llm.lexical import LENGTH_SHARE, M_UNIT, TF_SCALE, TF_UNIT, TOP
from riskengine.llm.licenses import PHRASES, TEMPLATES, THRESHOLD
from riskengine.llm.linededup import MIN_CHARS, MIN_DOCS
from riskengine.llm.mixing import BLOCK_DOCS, PERIOD, SLOTS_PER_SOURCE
from riskengine.llm.queries import INJECTION
from riskengine.llm.urls import CHARS_PER_LINK, LINK

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = rf"list_filter(regexp_split_to_array({_LOWER}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_SYMBOL = r"list_filter(regexp_split_to_array({}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
_WORDS = _SYMBOL.format(_LOWER)

OP1 = """
WITH d AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT payload_digest AS k, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY 1
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM d LEFT JOIN f ON k = payload_digest
"""

OP5 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_SPACED} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT u, v FROM c JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * common >= 80 * (x.n + y.n - common)),
r(id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.id, e.v FROM r JOIN e ON e.u = r.c),
k AS (SELECT id, min(c) AS component_id FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN k ON k.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

OP6 = f"""
WITH dw AS (SELECT doc_id, {_WORDS} AS w FROM documents),
bw AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
g AS (
  SELECT DISTINCT item_id, w[i:i + 9] AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM bw WHERE len(w) > 0)
),
lengths AS (SELECT DISTINCT len(win) AS l FROM g),
p AS (
  SELECT doc_id, i, l, w[i:i + l - 1] AS win
  FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM dw, lengths WHERE len(w) >= l)
),
h AS (SELECT doc_id, i, l, item_id FROM p JOIN g ON p.win = g.win),
hits AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS x FROM h) GROUP BY 1),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM h) GROUP BY 1
)
SELECT dw.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hits ON hits.doc_id = dw.doc_id LEFT JOIN items ON items.doc_id = dw.doc_id
"""

# One backslash goes into `<|`, and into `<\\|` with any number of them, of turns with either.
_OPEN = r"'<(\\*)\|'"
OP7 = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{INJECTION}'), (-1, 1, 'assistant', '{INJECTION}')
), f AS (
  SELECT *, length(regexp_replace(text, {_OPEN}, '<\\\1|', 'g')) + length(role) + length('<|im_start|>' || '<|im_end|>') + 2 AS chars
  FROM t
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""

OP8 = f"""
WITH RECURSIVE c AS (SELECT source, count(*) AS n FROM documents GROUP BY 1),
q AS (SELECT greatest({PERIOD}, {SLOTS_PER_SOURCE} * count(*)) AS q, count(*) AS s, sum(sqrt(n::DOUBLE)) AS roots FROM c),
o AS (SELECT source, n, q, s, greatest(round(q * sqrt(n::DOUBLE) / roots, 6) - 1, 0) AS beyond FROM c, q),
u AS (SELECT *, coalesce(round((q - s)::DOUBLE * beyond / sum(beyond) OVER (), 6), 0) AS quota FROM o),
v AS (SELECT *, q - s - sum(floor(quota)) OVER () AS spare,
             row_number() OVER (ORDER BY quota - floor(quota) DESC, source ASC NULLS FIRST) AS place FROM u),
parts AS (SELECT source, n, q, (1 + floor(quota) + (place <= spare)::INT)::BIGINT AS parts,
                 row_number() OVER (ORDER BY source ASC NULLS FIRST) AS i FROM v),
w AS (SELECT list(parts ORDER BY i) AS w, max(q) AS q FROM parts),
run(t, done, b) AS (
  SELECT -1::BIGINT, list_transform(w, lambda x: 0::BIGINT), 0::BIGINT FROM w
  UNION ALL
  SELECT t + 1, list_transform(range(1, len(done) + 1), lambda i: done[i] + (i = best)::INT), best
  FROM (
    SELECT t, done, q, list_sort(list_filter(list_transform(range(1, len(w) + 1),
             lambda i: CASE WHEN done[i] < w[i] AND done[i] * q // w[i] <= t + 1
                  THEN {{'due': ((done[i] + 1) * q + w[i] - 1) // w[i], 'i': i}} END), lambda x: x IS NOT NULL))[1].i AS best
    FROM run, w WHERE t + 1 < q
  )
),
plan AS (SELECT b AS i, t AS place, row_number() OVER (PARTITION BY b ORDER BY t) - 1 AS k FROM run WHERE t >= 0),
sizes AS (SELECT i, parts, q, (n + {BLOCK_DOCS} - 1) // {BLOCK_DOCS} AS blocks FROM parts),
ends AS (SELECT list(blocks // parts * q + place) AS each_end
         FROM sizes JOIN plan ON plan.i = sizes.i AND plan.k = blocks % parts),
d AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id) - 1 AS r
      FROM documents),
b AS (SELECT doc_id, d.source, r // {BLOCK_DOCS} AS block, (r % {BLOCK_DOCS})::INT AS in_block, p.i, p.parts, p.q
      FROM d JOIN parts p ON p.source IS NOT DISTINCT FROM d.source),
x AS (SELECT b.*, k, block // parts * q AS cycle, place FROM b JOIN plan ON plan.i = b.i AND plan.k = b.block % parts)
SELECT doc_id, source, block, in_block, cycle + place AS slot, cycle + k * q // parts AS release,
       cycle + ((k + 1) * q + parts - 1) // parts AS deadline,
       len(list_filter(each_end, lambda e: e <= cycle + place)) AS phase, cycle + place < list_min(each_end) AS in_mix
FROM x, ends
"""

_PHRASE_ROWS = ", ".join(f"('{p}', '{label}')" for p, label in PHRASES.items())
_TEMPLATE_ROWS = ", ".join(f"('{label}', '{text}')" for label, text in TEMPLATES.items())
OP9 = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
phrases AS (SELECT string_split(p, ' ') AS p, label FROM (VALUES {_PHRASE_ROWS}) v(p, label)),
places AS (
  SELECT doc_id, i - 1 AS pos, label
  FROM (SELECT doc_id, w, p, label, unnest(range(1, len(w) - len(p) + 2)) AS i FROM docs, phrases WHERE len(w) >= len(p))
  WHERE w[i:i + len(p) - 1] = p
),
templates AS (
  SELECT label, list_distinct(words) AS t, ceil(round(len(words) / {THRESHOLD}, 6)) AS longest
  FROM (SELECT label, {_SYMBOL.format("lower(text)")} AS words FROM (VALUES {_TEMPLATE_ROWS}) v(label, text))
),
-- A block is a window of words; the best one starts with a word of the template.
held AS (
  SELECT doc_id, i, label, word, longest, len(t) AS size, ceil(round({THRESHOLD} * len(t), 6)) AS need
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM docs)
  JOIN (SELECT *, unnest(t) AS word FROM templates) USING (word)
),
blocks AS (
  SELECT a.doc_id, a.label, a.i, a.size, a.need, count(DISTINCT b.word) AS common
  FROM held a JOIN held b ON a.doc_id = b.doc_id AND a.label = b.label AND b.i BETWEEN a.i AND a.i + a.longest - 1
  GROUP BY ALL
),
finds AS (SELECT doc_id, label, common / size AS share FROM blocks WHERE common >= need),
base AS (
  SELECT doc_id, count(*) AS n, min(pos) AS first_word, max(pos) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM places GROUP BY 1
),
every AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT doc_id, label FROM places UNION ALL SELECT doc_id, label FROM finds) GROUP BY 1
),
best AS (SELECT doc_id, max(share) AS score FROM finds GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(b.labels, '') AS base_labels, coalesce(e.labels, '') AS labels,
       coalesce(score, 0)::DOUBLE AS score
FROM docs d LEFT JOIN base b ON b.doc_id = d.doc_id LEFT JOIN every e ON e.doc_id = d.doc_id
LEFT JOIN best x ON x.doc_id = d.doc_id
"""

OP10 = rf"""
WITH u AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
         list_sort(list_filter(string_split(regexp_extract(coalesce(url, ''), '(?s)^.*?://[^?#]*\?([^#]*)', 1), '&'),
                   lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))) AS params,
         (length(coalesce(html, '')) - length(replace(coalesce(html, ''), '{LINK}', ''))) // {len(LINK)} AS links,
         length(coalesce(html, '')) AS chars
  FROM pages
), c AS (
  SELECT *, CASE WHEN host <> '' THEN regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)?$', '')
    || regexp_replace(path, '/+$', '') || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS key
  FROM u
), farms AS (SELECT DISTINCT key AS farm FROM c WHERE links * {CHARS_PER_LINK} > chars AND key IS NOT NULL
), r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM c LEFT JOIN farms ON farm = key
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN farm IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""

OP11 = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same, list_inner_product(a.q, c.q)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {POSITIVES}
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INT AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
QUALIFY rank <= {NEGATIVES}
"""

_TERMS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(_LOWER)
OP12 = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS w FROM documents),
lengths AS (SELECT doc_id, len(w) AS n FROM d WHERE len(w) > 0),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM lengths),
t AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM t GROUP BY 1),
q AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL
),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM f, total
),
parts AS (
  SELECT doc_id, term, w * (({TF_SCALE} * tf) // ({TF_UNIT} * tf + {M_UNIT} * (100 - {LENGTH_SHARE} + ({LENGTH_SHARE} * n * docs) // length))) AS part
  FROM t JOIN weights USING (term) JOIN lengths USING (doc_id), total
),
scores AS (SELECT item_id, doc_id, sum(times * part)::BIGINT AS score FROM q JOIN parts USING (term) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= {TOP}
"""

OP13 = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, i, lines[i] AS line FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM d)),
k AS (
  SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
),
shared AS (
  SELECT key, max(doc_id) AS last_doc FROM k WHERE length(key) >= {MIN_CHARS}
  GROUP BY 1 HAVING count(DISTINCT doc_id) >= {MIN_DOCS}
),
m AS (SELECT k.*, coalesce(doc_id <> last_doc, FALSE) AS dropped FROM k LEFT JOIN shared USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (dropped)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

ORACLES: dict[str, str] = {
    "op1_warc_chain": OP1,
    "op5_hyperminhash": OP5,
    "op6_prefix_decontamination": OP6,
    "op7_chat_round_trip": OP7,
    "op8_pfair_mix": OP8,
    "op9_license_scan": OP9,
    "op10_url_filter": OP10,
    "op11_hard_negatives": OP11,
    "op12_nra_search": OP12,
    "op13_line_dedup": OP13,
}
