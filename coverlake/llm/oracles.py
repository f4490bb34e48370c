"""SQL counterparts of the registered queries, for the operators that SQL can express on whole tables.

The URL filter, the toxicity score and the language model are learned, so no SQL is given for them.
"""

from __future__ import annotations

from coverlake.llm import leaks, licenses, lines, lm, mixing, negatives, quality, trie, urls
from coverlake.llm.text import UPPER
from coverlake.llm.near import SHINGLE_WORDS
from coverlake.llm.text import UPPER

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
HAS_WORD = r"regexp_matches({}, '[^\x20\x09-\x0D]')"

MIXING = rf"""
WITH d AS (SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, {list(mixing.WEIGHTS)}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1] AS weight,
         {mixing.MOST_COPIES} * source_size AS cap,
         sum(source_size) OVER () * {mixing.SHARE_PERCENT} AS percent_total
  FROM s),
l AS (
  SELECT *,
         percent_total - 100 * coalesce(sum(cap) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS percent_left,
         sum(weight) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left
  FROM w),
c AS (SELECT *, 100 * cap * weight_left <= weight * percent_left AS capped FROM l),
v AS (SELECT percent_left AS level_left, weight_left AS level_weight FROM c WHERE NOT capped
      ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST LIMIT 1),
t AS (
  SELECT source, source_size,
         CASE WHEN capped THEN CAST(cap AS DOUBLE)
              ELSE CAST(weight * level_left AS DOUBLE) / CAST(100 * level_weight AS DOUBLE) END AS target
  FROM c LEFT JOIN v ON true),
r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size = 0 THEN 0 ELSE t.target / CAST(t.source_size AS DOUBLE) END AS rate,
         CAST(CAST('0x' || substr(md5('{mixing.SEED}:' || coalesce(d.source, '')), 1, 8) AS BIGINT) AS DOUBLE)
             / CAST(4294967296.0 AS DOUBLE) AS start,
         CAST(row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) AS DOUBLE) AS place
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(floor(place * rate + start) - floor((place - 1) * rate + start) AS BIGINT) * size AS taken
FROM r
"""

CHAT = r"""
WITH c AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place
  FROM (SELECT conv_id, turn, role, text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
        UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY place)) AS loss_sha256,
       CAST(sum(24 + length(replace(replace(replace(role, chr(92), chr(92) || chr(92)), '<|', '<' || chr(92) || '|'), chr(10), chr(92) || 'n'))
           + length(replace(replace(text, chr(92), chr(92) || chr(92)), '<|', '<' || chr(92) || '|'))) AS BIGINT)
           AS formatted_chars
FROM c GROUP BY conv_id
"""

_BITS = " + ".join(f"CASE WHEN {r.fails} THEN {1 << k} ELSE 0 END" for k, r in enumerate(quality.RULES))
QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
g AS (SELECT k, i, w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] AS gram
      FROM d, unnest(range(greatest(len(w) - 2, 0))) AS t(i)),
f AS (SELECT k, i FROM g QUALIFY count(*) OVER (PARTITION BY k, gram) > 1),
p AS (SELECT k, count(DISTINCT i + o) AS n FROM f, unnest([0, 1, 2]) AS t(o) GROUP BY k),
l AS (SELECT k, count(*) AS n, count(DISTINCT line) AS n_distinct
      FROM (SELECT k, unnest(string_split(text, chr(10))) AS line FROM d) WHERE {HAS_WORD.format('line')} GROUP BY k),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(l.n, 0) AS BIGINT) AS n_lines, CAST(coalesce(l.n - l.n_distinct, 0) AS BIGINT) AS n_dup_lines,
         CAST(length(regexp_replace(text, '[^\p{{L}}]+', '', 'g')) AS BIGINT) AS n_letters,
         CAST(length(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g')) AS BIGINT) AS n_upper,
         CAST(coalesce(p.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN p USING (k) LEFT JOIN l USING (k)),
b AS (SELECT *, CAST({_BITS} AS BIGINT) AS failed_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failed_bits & {quality.mask(quality.BASE)} <> 0 AS base_failed,
       failed_bits & {quality.mask(quality.STANDARD)} = 0 AS kept, failed_bits
FROM b
"""

LINES = rf"""
WITH o AS (
  SELECT doc_id, k - 1 AS line_no,
         regexp_replace(regexp_replace(raw, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '') AS line
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS raw,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS k FROM documents)),
e AS (SELECT * FROM o WHERE length(line) >= {lines.LEAST_CHARS}),
f AS (SELECT line, length(line) AS n, min({{'doc_id': doc_id, 'line_no': line_no}}) AS first FROM e GROUP BY line),
x AS (SELECT a.line AS line, b.first AS other FROM f a JOIN (SELECT *, unnest(range(n - {lines.EDITS}, n + {lines.EDITS} + 1)) AS m FROM f) b
        ON a.n = b.m WHERE b.first < a.first AND levenshtein(a.line, b.line) <= {lines.EDITS}),
q AS (SELECT line, min(other) AS near_first FROM x GROUP BY line),
j AS (
  SELECT o.doc_id, o.line_no, q.near_first IS NOT NULL AS near,
         q.near_first IS NULL AND f.first < {{'doc_id': o.doc_id, 'line_no': o.line_no}} AS exact,
         coalesce(q.near_first, f.first).doc_id AS first_doc
  FROM o LEFT JOIN f ON o.line = f.line AND f.n = length(o.line) LEFT JOIN q ON o.line = q.line)
SELECT doc_id, max(line_no) + 1 AS n_lines,
       count(*) FILTER (WHERE exact) AS n_exact, count(*) FILTER (WHERE near) AS n_near,
       coalesce(list(CAST(line_no AS INTEGER) ORDER BY line_no) FILTER (WHERE exact OR near), []) AS removed_lines,
       coalesce(list(DISTINCT first_doc ORDER BY first_doc) FILTER (WHERE exact OR near), []) AS first_docs
FROM j GROUP BY doc_id
"""

_N = SHINGLE_WORDS
NEAR = rf"""
WITH RECURSIVE t AS (SELECT coalesce(text, '') AS text, min(doc_id) AS text_id, count(*) AS n_copies FROM documents GROUP BY 1),
w AS (SELECT text_id, {WORDS} AS w FROM t),
s AS MATERIALIZED (
  SELECT DISTINCT text_id, array_to_string(w[i : i + {_N - 1}], ' ') AS shingle
  FROM w, unnest(range(1, greatest(len(w) - {_N - 2}, 2))) AS r(i) WHERE len(w) > 0),
z AS (SELECT text_id, count(*) AS n FROM s GROUP BY text_id),
p AS (SELECT a.text_id AS a, b.text_id AS b, count(*) AS shared
      FROM s a JOIN s b ON a.shingle = b.shingle AND a.text_id <> b.text_id GROUP BY 1, 2),
l AS MATERIALIZED (
  SELECT a, b FROM p JOIN z x ON p.a = x.text_id JOIN z y ON p.b = y.text_id
  WHERE 10 * shared >= 8 * (x.n + y.n - shared)),
r AS (SELECT text_id AS a, text_id AS b FROM t UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS text_id, min(b) AS class_id FROM r GROUP BY a),
g AS (SELECT a AS text_id, count(*) AS n FROM l GROUP BY a)
SELECT d.doc_id, c.class_id, t.text_id, t.n_copies, CAST(coalesce(g.n, 0) AS BIGINT) AS n_links
FROM documents d JOIN t ON coalesce(d.text, '') = t.text JOIN c ON c.text_id = t.text_id LEFT JOIN g ON g.text_id = t.text_id
"""

_TEMPLATES = ", ".join(
    "({}, '{}', '{}')".format(k, name, text.replace("'", "''")) for k, (name, text) in enumerate(licenses.TEMPLATES)
)
_PLAIN = r"trim(regexp_replace(lower(coalesce({}, '')), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
_T = licenses.THRESHOLD_PERCENT
LICENSES = rf"""
WITH t AS (
  SELECT template, license, len(w) - 1 AS n, w[i] || ' ' || w[i + 1] AS pair, count(*) AS wanted,
         CAST(floor((len(w) - 1) * CAST({200 - _T} AS DOUBLE) / {_T}) AS INT) AS reach
  FROM (SELECT template, license, string_split({_PLAIN.format('text')}, ' ') AS w
        FROM (VALUES {_TEMPLATES}) AS v(template, license, text)), unnest(range(1, len(w))) AS r(i)
  GROUP BY template, license, w, pair),
d AS (SELECT row_number() OVER () AS d, doc_id, string_split({_PLAIN.format('text')}, ' ') AS w
      FROM (SELECT DISTINCT doc_id, text FROM documents)),
h AS MATERIALIZED (
  SELECT x.d, x.doc_id, t.*, x.pos, row_number() OVER (PARTITION BY x.d, template ORDER BY x.pos) AS place
  FROM (SELECT d, doc_id, i - 1 AS pos, w[i] || ' ' || w[i + 1] AS pair FROM d, unnest(range(1, len(w))) AS r(i)) x
  JOIN t USING (pair)),
e AS (
  SELECT a.d, a.template, a.pos AS first, b.pos AS last, a.n,
         (b.place - a.place + 1) / CAST(a.n + b.pos - a.pos + 1 AS DOUBLE) AS share
  FROM h a JOIN h b ON a.d = b.d AND a.template = b.template AND b.pos BETWEEN a.pos AND a.pos + a.reach - 1
  WHERE 200 * (b.place - a.place + 1) >= {_T} * (a.n + b.pos - a.pos + 1)
  QUALIFY row_number() OVER (PARTITION BY a.d, a.template, a.pos ORDER BY share DESC, b.pos) = 1),
s AS (
  SELECT d, doc_id, template, license, n, first, last,
         CAST(2.0 AS DOUBLE) * sum(shared) / (n + last - first + 1) AS dice
  FROM (SELECT h.d, h.doc_id, h.template, h.license, h.n, first, last, pair, least(count(*), any_value(wanted)) AS shared
        FROM e JOIN h ON e.d = h.d AND e.template = h.template AND h.pos BETWEEN first AND last
        GROUP BY h.d, h.doc_id, h.template, h.license, h.n, first, last, pair)
  GROUP BY d, doc_id, template, license, n, first, last
  HAVING 200 * sum(shared) >= {_T} * (n + last - first + 1)),
p AS (SELECT *, sum(fresh) OVER (PARTITION BY d ORDER BY first, last ROWS UNBOUNDED PRECEDING) AS island FROM (
  SELECT *, CASE WHEN max(last) OVER (
    PARTITION BY d ORDER BY first, last ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) >= first THEN 0 ELSE 1 END AS fresh
  FROM s)),
m AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY d, island ORDER BY dice DESC, n DESC, license, first) = 1)
SELECT doc_id, license, max(dice) AS dice, count(*) AS n_places, CAST(min(first) AS INTEGER) AS first_word
FROM m GROUP BY doc_id, license
"""

_RULES = ", ".join(f"('{r.host}', '{r.path}', '{r.name}', '{r.verdict}')" for r in urls.RULES)
URL_RULES = rf"""
WITH p AS (
  SELECT row_number() OVER () AS n, page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS rest
  FROM pages),
h AS (
  SELECT n, page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{UPPER.lower()}'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM p),
r AS (SELECT * FROM (VALUES {_RULES}) AS v(rule_host, rule_path, rule, rule_verdict))
SELECT page_id, host, path, rule, rule_verdict
FROM h LEFT JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
QUALIFY row_number() OVER (PARTITION BY n ORDER BY length(rule) DESC, rule) = 1
"""

_S = leaks.SHINGLE_WORDS
_NORMAL = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')"
LEAKS = rf"""
WITH d AS (SELECT DISTINCT doc_id, {_NORMAL} AS w FROM documents),
b AS (SELECT item_id, {_NORMAL} AS w FROM benchmark WHERE text IS NOT NULL),
ds AS MATERIALIZED (
  SELECT doc_id, len(w) AS n_text, i - 1 AS place, array_to_string(w[i : i + {_S - 1}], ' ') AS s
  FROM d, unnest(range(1, greatest(len(w) - {_S - 2}, 1))) AS r(i)),
bs AS MATERIALIZED (
  SELECT item_id, len(w) AS n_words, i - 1 AS place, array_to_string(w[i : i + {_S - 1}], ' ') AS s
  FROM b, unnest(range(1, greatest(len(w) - {_S - 2}, 1))) AS r(i)),
wanted AS (SELECT DISTINCT item_id, n_words, s, length(replace(s, ' ', '')) AS weight FROM bs),
total AS (SELECT item_id, sum(weight) AS total FROM wanted GROUP BY item_id),
hit AS (SELECT DISTINCT ds.doc_id, bs.item_id, n_words, n_text, ds.place FROM ds JOIN bs USING (s)),
win AS (
  SELECT DISTINCT doc_id, item_id, n_words, start
  FROM hit, unnest(range(greatest(0, place - n_words + {_S}), least(place, greatest(0, n_text - n_words)) + 1)) AS r(start)),
found AS (
  SELECT DISTINCT win.doc_id, item_id, n_words, start, s
  FROM win JOIN ds ON ds.doc_id = win.doc_id AND ds.place BETWEEN start AND start + n_words - {_S}),
scored AS (
  SELECT f.doc_id, f.item_id, f.n_words, f.start,
         sum(length(replace(f.s, ' ', ''))) AS have, sum(coalesce(w.weight, 0)) AS shared
  FROM found f LEFT JOIN wanted w ON w.item_id = f.item_id AND w.s = f.s GROUP BY 1, 2, 3, 4),
m AS (
  SELECT doc_id, item_id, n_words, start, CAST(shared AS DOUBLE) / CAST(have + total - shared AS DOUBLE) AS similarity
  FROM scored JOIN total USING (item_id)
  WHERE 100 * shared >= {leaks.THRESHOLD_PERCENT} * (have + total - shared))
SELECT doc_id, item_id, CAST(start AS INTEGER) AS start, CAST(n_words AS INTEGER) AS n_words, similarity
FROM (FROM m UNION ALL
      SELECT doc_id, item_id, len(b.w), i - 1, CAST(1.0 AS DOUBLE)
      FROM d, unnest(range(1, len(d.w) + 1)) AS r(i) JOIN b ON d.w[i : i + len(b.w) - 1] = b.w AND len(b.w) BETWEEN 1 AND {_S - 1})
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start, n_words) = 1
"""

def crc32(column: str) -> str:
    """The unsigned CRC-32 of a number's decimal digits, bit by bit."""
    return f"""xor(list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST({column} AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, byte: list_reduce(
        list_prepend(xor(crc, byte), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]),
        lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END)),
    CAST(4294967295 AS BIGINT))"""


LM_BASE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, CAST({crc32('doc_id')} % {lm.FOLDS} AS INTEGER) AS fold,
         list_append(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\x20\x09-\x0D]+'), ' ') AS w
  FROM documents),
t AS (SELECT k, fold, unnest(w) AS token FROM d),
c AS (SELECT token, count(*) AS c FROM t WHERE fold <> {lm.TEST_FOLD} GROUP BY token),
n AS (SELECT CAST(sum(c) AS BIGINT) AS n, count(*) AS v FROM c),
s AS (
  SELECT k, count(*) AS n_tokens, count(c) AS n_known,
         sum(log10((coalesce(c, 0) + CAST(1 AS DOUBLE)) / (n + v + 1))) AS score
  FROM t LEFT JOIN c USING (token), n GROUP BY k)
SELECT doc_id, fold = {lm.TEST_FOLD} AS held_out, n_tokens, n_known, n AS train_tokens, round(score, 5) AS base_score
FROM d JOIN s USING (k), n
"""

TRIE = rf"""
WITH w AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT *, CAST({crc32('conv_id')} % {trie.SHARED_TURNS} AS INTEGER) AS h, conv_id - conv_id % {trie.GROUP} AS g FROM w),
c AS (
  SELECT h.conv_id, list_concat(coalesce(f.turns, [])[1 : h.h], h.turns[h.h + 1 :]) AS turns
  FROM h LEFT JOIN w f ON f.conv_id = h.g),
p AS (SELECT conv_id, len(turns) AS n, d AS depth, turns[1 : d] AS path FROM c, unnest(range(0, len(turns) + 1)) AS r(d)),
t AS MATERIALIZED (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         CASE WHEN depth > 0 THEN (count(*) - 1) * len(regexp_extract_all(path[depth].text, '[^ 	-
]+')) ELSE 0 END AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256
  FROM p GROUP BY path, depth),
k AS (SELECT path[1 : depth - 1] AS path, depth - 1 AS depth, count(*) AS n FROM t WHERE depth > 0 GROUP BY 1, 2),
u AS (SELECT t.*, coalesce(k.n, 0) AS n_children FROM t LEFT JOIN k USING (path, depth)),
a AS (
  SELECT path[1 : d] AS path, d AS depth, sum(saved) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
  FROM u, unnest(range(0, depth + 1)) AS r(d) GROUP BY 1, 2)
SELECT u.conv_id, u.depth, parent.conv_id AS parent_conv_id, u.n_convs, u.n_children, a.n_leaves,
       CAST(a.saved_tokens AS BIGINT) AS saved_tokens, u.ends_sha256
FROM u JOIN a USING (path, depth)
LEFT JOIN t parent ON u.depth > 0 AND parent.depth = u.depth - 1 AND parent.path = u.path[1 : u.depth - 1]
"""

NEGATIVES = rf"""
WITH v AS (
  SELECT row_number() OVER () AS k, vec_id, CASE WHEN vec_id % {negatives.RELABEL_EVERY} = 0 THEN (label + 1) % {negatives.LABELS} ELSE label END AS label,
         list_transform(embedding, lambda x: floor({negatives.SCALE} * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (
  SELECT a.k AS a, a.vec_id AS anchor_id, b.k AS b, b.vec_id AS vec_id, a.label = b.label AS same,
         CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % {negatives.ANCHOR_EVERY} = 0 AND a.k <> b.k),
p AS (
  SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id NULLS LAST) AS place FROM s WHERE same
  QUALIFY place <= {negatives.POSITIVES})
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.a, place ORDER BY s.score DESC, s.vec_id NULLS LAST) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON p.a = s.a AND NOT s.same
  AND {negatives.LOW_PERCENT} * p.score <= 100 * s.score AND 100 * s.score <= {negatives.HIGH_PERCENT} * p.score
QUALIFY rank <= {negatives.NEGATIVES}
"""

ORACLES: dict[str, str] = {
    "op1_mixing": MIXING,
    "op4_chat_formatting": CHAT,
    "op5_quality_rules": QUALITY,
    "op6_line_dedup": LINES,
    "op7_ngram_jaccard_join": NEAR,
    "op8_license_scans": LICENSES,
    "url_rules": URL_RULES,
    "lm_scoring_base": LM_BASE,
    "op10_benchmark_decontamination": LEAKS,
    "op12_conversation_prefix_trie": TRIE,
    "op13_hard_negative_mining": NEGATIVES,
}
