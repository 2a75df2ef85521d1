"""DuckDB SQL for the queries on documents that SQL can express."""

from __future__ import annotations

from rillframe.llm.quality_rules import CLASSES, VOCABULARY, Divergence

_RULE = Divergence()
_WORDS = ", ".join(f"'{w}'" for w in VOCABULARY)
_LONGEST = max(len(w.encode()) for w in VOCABULARY) + 2
_SPECIAL = ",\n    ".join(f"length(regexp_replace(t, '{others}', '', 'g')) AS {name}" for name, others in CLASSES.items())

OP1 = rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (
  SELECT doc_id, lang, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars, length(t) AS chars,
    length(regexp_replace(t, '[^a-z]', '', 'g')) AS lower_n,
    {_SPECIAL},
    len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines
  FROM d),
win AS (SELECT doc_id, i, w[i:i+4] AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
recurring AS (SELECT doc_id, k FROM win GROUP BY doc_id, k HAVING count(*) > 1),
repeated AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS place FROM win JOIN recurring USING (doc_id, k)) GROUP BY doc_id),
found AS (
  SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, rtrim(lower(x), '.,;:!?') AS word FROM (SELECT doc_id, unnest(w) AS x FROM d) WHERE strlen(x) <= {_LONGEST})
  WHERE word IN ({_WORDS}) GROUP BY doc_id, word),
hist AS (
  SELECT doc_id, lang, chars, n_words, unnest(['lower', 'space', 'upper', 'digit', 'symbol', 'foreign', 'other']) AS c,
    unnest([lower_n, chars - word_chars, upper, digit, symbol, "foreign", chars - lower_n - (chars - word_chars) - upper - digit - symbol - "foreign"]) AS n
  FROM f),
ref_c AS (SELECT key, c, n / sum(n) OVER (PARTITION BY key) AS q FROM (
  SELECT '=' || lang AS key, c, sum(n) AS n FROM hist WHERE chars >= {_RULE.min_chars_judged} AND lang IS NOT NULL GROUP BY lang, c
  UNION ALL SELECT 'all', c, sum(n) FROM hist WHERE chars >= {_RULE.min_chars_judged} GROUP BY c)),
ref_n AS (
  SELECT '=' || lang AS key, sum(n_words) AS n FROM f WHERE n_words >= {_RULE.min_words_judged} AND lang IS NOT NULL GROUP BY lang
  UNION ALL SELECT 'all', sum(n_words) FROM f WHERE n_words >= {_RULE.min_words_judged} HAVING count(*) > 0),
usable AS (SELECT DISTINCT key FROM ref_c JOIN ref_n USING (key)),
keyed AS (SELECT doc_id, n_words, CASE WHEN '=' || lang IN (SELECT key FROM usable) THEN '=' || lang WHEN 'all' IN (SELECT key FROM usable) THEN 'all' END AS key FROM f),
said AS (SELECT lang, word, h.n FROM found h JOIN f USING (doc_id) WHERE n_words >= {_RULE.min_words_judged}),
ref_w AS (
  SELECT key, word, sum(s.n) / any_value(ref_n.n) AS q FROM (SELECT '=' || lang AS key, word, n FROM said WHERE lang IS NOT NULL UNION ALL SELECT 'all', word, n FROM said) s JOIN ref_n USING (key) GROUP BY key, word),
d_char AS (
  SELECT doc_id, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) / 2 ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) / 2 ELSE 0 END))) AS x
  FROM (SELECT doc_id, h.n / chars::DOUBLE AS p, q FROM hist h JOIN keyed USING (doc_id) JOIN ref_c USING (key, c) WHERE chars >= {_RULE.min_chars_judged}) GROUP BY doc_id),
pq AS (
  SELECT f.doc_id, r.word, coalesce(h.n, 0) / n_words::DOUBLE AS p, r.q FROM keyed f JOIN ref_w r ON r.key = f.key LEFT JOIN found h ON h.doc_id = f.doc_id AND h.word = r.word WHERE n_words >= {_RULE.min_words_judged}
  UNION ALL SELECT f.doc_id, h.word, h.n / n_words::DOUBLE, 0 FROM keyed f JOIN found h USING (doc_id) WHERE n_words >= {_RULE.min_words_judged} AND f.key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM ref_w r WHERE r.key = f.key AND r.word = h.word)),
parts AS (SELECT doc_id, p, q FROM pq UNION ALL SELECT doc_id, greatest(0, 1 - sum(p)), greatest(0, 1 - sum(q)) FROM pq GROUP BY doc_id),
d_word AS (SELECT doc_id, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) / 2 ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) / 2 ELSE 0 END))) AS x FROM parts GROUP BY doc_id),
judged AS (
  SELECT f.*, coalesce(r.n, 0) AS n_repeat_words, n_words < {_RULE.min_words} OR 100 * coalesce(r.n, 0) > {_RULE.max_repeat_percent} * n_words AS base_failed, coalesce(c.x, 0) AS dc, coalesce(v.x, 0) AS dw
  FROM f LEFT JOIN repeated r USING (doc_id) LEFT JOIN d_char c USING (doc_id) LEFT JOIN d_word v USING (doc_id))
SELECT doc_id, n_words, word_chars, symbol AS n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND dc <= {_RULE.max_char_distance} AND dw <= {_RULE.max_word_distance} AS kept
FROM judged"""

OP7 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n, md5(string_agg(k, chr(10) ORDER BY k)) AS h FROM s GROUP BY doc_id),
reps AS (SELECT doc_id, n, h, min(doc_id) OVER (PARTITION BY h) AS rep FROM sizes),
r AS (SELECT s.doc_id, k FROM s JOIN reps USING (doc_id) WHERE reps.rep = s.doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM r a JOIN r b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT rep, rep FROM (SELECT DISTINCT rep FROM reps) UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a),
root AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(reps.n, 0) AS n_shingles, coalesce(root.m, d.doc_id) AS component_id, d.doc_id = coalesce(root.m, d.doc_id) AS kept
FROM d LEFT JOIN reps ON reps.doc_id = d.doc_id LEFT JOIN root ON root.a = reps.rep"""
