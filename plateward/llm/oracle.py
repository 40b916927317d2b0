"""DuckDB SQL for the queries that it can express, by other means than the operators use."""

from __future__ import annotations

_WORDS = r"list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_LINES = r"""
WITH stripped AS (
  SELECT row_number() OVER () AS r, page_id,
    nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') AS host,
    regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
      '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'g'),
      '(?i)</?(?:p|div|br|li|ul|ol|h[1-6]|tr|td|th|table|nav|header|footer|article|section|title|head|body|html|pre|blockquote|main|aside|form)\b[^>]*>',
      chr(10), 'g'), '<[^>]*>', '', 'g') AS text
  FROM pages
),
split AS (
  SELECT r, page_id, host, list_filter(list_transform(string_split_regex(text, '[\r\n]+'),
    lambda l: trim(regexp_replace(l, '[ \t]+', ' ', 'g'), ' ')), lambda l: l <> '') AS lines
  FROM stripped
),
lines AS (
  SELECT r, host, unnest(lines) AS line, generate_subscripts(lines, 1) AS k FROM split
),
common AS (
  SELECT host, line FROM (SELECT DISTINCT r, host, line FROM lines WHERE host IS NOT NULL)
  JOIN (SELECT host, count(*) AS pages FROM split GROUP BY host) USING (host)
  GROUP BY host, line, pages HAVING count(*) >= 2 AND count(*) > 0.3 * pages
),
kept AS (
  SELECT r, count(*) AS n_kept, string_agg(line, chr(10) ORDER BY k) AS text
  FROM lines ANTI JOIN common USING (host, line) GROUP BY r
)
SELECT page_id, host, CAST(len(lines) AS BIGINT) AS n_lines,
       CAST(len(lines) - coalesce(n_kept, 0) AS BIGINT) AS n_dropped,
       CAST(coalesce(n_kept, 0) AS BIGINT) AS n_kept, coalesce(text, '') AS text
FROM split LEFT JOIN kept USING (r)
"""

_DECONTAMINATED = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex({_LOWER},
         '[^0-9a-z\x{{80}}-\x{{10FFFF}}]+'), lambda w: w <> '') AS w FROM documents
),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, list_filter(string_split_regex({_LOWER},
         '[^0-9a-z\x{{80}}-\x{{10FFFF}}]+'), lambda w: w <> '') AS w FROM benchmark
),
phrases AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[k : k + 9], ' ') AS phrase
  FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS k FROM items WHERE len(w) > 0)
),
places AS (
  SELECT r, n, k, array_to_string(w[k : k + n - 1], ' ') AS phrase
  FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS k
        FROM docs, (SELECT DISTINCT n FROM phrases) WHERE len(w) >= n)
),
hits AS (SELECT r, k, n, item FROM places JOIN phrases USING (n, phrase)),
hit_words AS (
  SELECT r, count(DISTINCT word) AS n_hit FROM (SELECT r, unnest(generate_series(k, k + n - 1)) AS word FROM hits)
  GROUP BY r
),
hit_items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""

_SIMILAR = rf"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex({_LOWER},
         '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
),
sets AS (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(
           generate_series(1, greatest(len(w) - 3, 1)), lambda k: array_to_string(w[k : k + 3], ' ')))) END AS s
  FROM docs
),
shingles AS (SELECT r, len(s) AS n, unnest(s) AS x FROM sets),
shared AS (
  SELECT a.r AS a, b.r AS b, a.n AS na, b.n AS nb, count(*) AS c
  FROM shingles a JOIN shingles b ON a.x = b.x AND a.r <> b.r GROUP BY ALL
),
links AS (SELECT a, b FROM shared WHERE 100 * c >= 85 * (na + nb - c)),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least_id AS (SELECT a AS r, min(doc_id) AS m FROM reach JOIN docs ON docs.r = reach.b GROUP BY a),
sizes AS (SELECT s, count(*) AS class_size FROM sets GROUP BY s)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, m) AS component_id,
       CAST(if(len(s) = 0, 1, class_size) AS BIGINT) AS class_size
FROM sets LEFT JOIN least_id USING (r) JOIN sizes USING (s)
"""

_LEDGER = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT r, doc_id, text, {_WORDS} AS w,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM docs
),
windows AS (
  SELECT r, k, array_to_string(w[k : k + 7], ' ') AS x
  FROM (SELECT r, w, unnest(generate_series(1, len(w) - 7)) AS k FROM split WHERE len(w) >= 8)
),
repeated AS (
  SELECT r, count(DISTINCT word) AS n FROM (
    SELECT r, unnest(generate_series(k, k + 7)) AS word
    FROM (SELECT r, k, count(*) OVER (PARTITION BY r, x) AS times FROM windows) WHERE times > 1)
  GROUP BY r
),
measured AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    CAST(length(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g')) AS BIGINT) AS n_capitals
  FROM split LEFT JOIN repeated USING (r)
),
failed AS (
  SELECT *, CAST(if(n_words < 20, 1, 0) + if(100 * n_repeat_words > 30 * n_words, 2, 0)
    + if(100 * n_symbols > 10 * word_chars, 4, 0) + if(100 * n_dup_lines > 30 * n_lines, 8, 0)
    + if(word_chars < 2 * n_words, 16, 0) + if(word_chars > 20 * n_words, 32, 0)
    + if(100 * n_capitals > 50 * word_chars, 64, 0) AS BIGINT) AS failed_rules
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failed_rules & 3 <> 0 AS base_failed, failed_rules = 0 AS kept, failed_rules
FROM failed
"""

_RULES = ("few_words", "repeated_windows", "symbols", "repeated_lines", "short_words", "long_words", "capitals")
_POLICIES = (("base", 1, 2), ("standard", 1, 4), ("standard", 2, 7))


def _ablations() -> str:
    rows = [
        f"SELECT '{name}' AS policy, {version} AS version, '{_RULES[k]}' AS rule,"
        f" count(*) FILTER (failed_rules & {(1 << n) - 1} = 0) AS kept,"
        f" count(*) FILTER (failed_rules & {(1 << n) - 1 - (1 << k)} = 0) AS kept_without,"
        f" count(*) FILTER (failed_rules & {(1 << n) - 1} = {1 << k}) AS only FROM failed"
        for name, version, n in _POLICIES
        for k in range(n)
    ]
    layers = _LEDGER[: _LEDGER.rindex("SELECT doc_id, n_words, word_chars")]
    return layers + " UNION ALL ".join(rows)


_PREFERENCES = r"""
WITH turns AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k
  FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL)
),
replies AS (
  SELECT conv_id, k, text, lag(text) OVER w AS earlier, count(*) OVER (PARTITION BY conv_id) AS n,
         lead(k) OVER w IS NULL AS last
  FROM turns WHERE role = 'assistant' WINDOW w AS (PARTITION BY conv_id ORDER BY k)
),
swapped AS (
  SELECT conv_id, k AS spot, text, if(n = 1, split_part(text, chr(10), 1), earlier) AS instead FROM replies WHERE last
),
prefix AS (
  SELECT conv_id, any_value(instead) AS instead, any_value(spot) AS spot,
         CASE WHEN any_value(spot) IS NULL OR any_value(swapped.text) IS NOT DISTINCT FROM any_value(instead)
              THEN count(*) ELSE any_value(spot) - 1 END AS n_common
  FROM turns LEFT JOIN swapped USING (conv_id) GROUP BY conv_id
),
sides AS (
  SELECT conv_id, k, role, n_common, side,
         concat('<|start|>', coalesce(role, ''), chr(10)) AS head,
         concat(coalesce(if(side = 'r' AND k = spot, instead, text), ''), '<|end|>', chr(10)) AS body
  FROM turns JOIN prefix USING (conv_id), (VALUES ('c'), ('r')) s(side)
),
placed AS (
  SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, side, k > n_common ORDER BY k) AS ends
  FROM sides
),
texts AS (
  SELECT conv_id, side, any_value(n_common) AS n_common, count(*) AS n,
    coalesce(string_agg(head || body, '' ORDER BY k) FILTER (k <= n_common), '') AS before,
    coalesce(string_agg(head || body, '' ORDER BY k) FILTER (k > n_common), '') AS after,
    coalesce(string_agg(concat(ends - length(body), ':', ends), ',' ORDER BY k)
             FILTER (k > n_common AND role = 'assistant'), '') AS spans
  FROM placed GROUP BY conv_id, side
)
SELECT c.conv_id, CAST(c.n_common AS INTEGER) AS n_common, c.before AS prompt, c.after AS chosen_text,
       c.spans AS chosen_spans, r.after AS rejected_text, r.spans AS rejected_spans, c.n_common < c.n AS usable
FROM texts c JOIN texts r ON c.conv_id = r.conv_id AND c.side = 'c' AND r.side = 'r'
"""


_PHRASES = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(LOWERED, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
words AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces
),
tokens AS (
  SELECT p, lang, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM (SELECT row_number() OVER () AS p, lang, w FROM words)
),
spots AS (
  SELECT lang, x, lead(x) OVER follows AS y, lead(x, 2) OVER follows AS z FROM tokens
  WINDOW follows AS (PARTITION BY p ORDER BY i)
),
f AS (
  SELECT lang, 1 AS k, x AS phrase, count(*)::HUGEINT AS f FROM spots GROUP BY ALL
  UNION ALL SELECT lang, 2, concat(x, ' ', y), count(*)::HUGEINT FROM spots WHERE y IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, concat(x, ' ', y, ' ', z), count(*)::HUGEINT FROM spots WHERE z IS NOT NULL GROUP BY ALL
),
candidates AS (
  SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10
),
cuts AS (
  SELECT c.lang, c.phrase, c.k, c.f AS a, cut.cut, l.f AS l, r.f AS r, (1000000 * c.f * c.f) // (l.f * r.f) AS score
  FROM candidates c JOIN (VALUES (1), (2)) cut(cut) ON cut.cut < c.k
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1 : cut.cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[cut.cut + 1 : c.k], ' ')
),
lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
),
dropped AS (
  SELECT DISTINCT s.lang, s.phrase FROM candidates s JOIN (
    SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part, f FROM candidates WHERE k = 3
  ) t ON s.lang = t.lang AND s.phrase = t.part AND s.k = 2 AND 100 * t.f >= 50 * s.f
),
totals AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
  FROM lowest ANTI JOIN dropped USING (lang, phrase)
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
""".replace("LOWERED", _LOWER)


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_frequency": _LINES,
        "op2_fm_index": _DECONTAMINATED,
        "op3_jaccard_join": _SIMILAR,
        "op4_rule_ledger": _LEDGER,
        "rule_ablations": _ablations(),
        "op9_preference_format": _PREFERENCES,
        "op13_son_collocations": _PHRASES,
    }
