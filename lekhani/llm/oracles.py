"""DuckDB statements for the queries that SQL can express."""

from lekhani.functions import text as T
from lekhani.llm.repetition import STOP_WORDS

_SPACE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

_BLANK = r"[\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

_STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)
_FOUND = r"""d AS (SELECT DISTINCT doc_id, text, nullif(regexp_replace(regexp_extract(lower(trim(url)), '^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)', 1), '^(www|m)\.|\.$', '', 'g'), '') AS site FROM extracted WHERE doc_id IS NOT NULL),
n AS (SELECT site, count(DISTINCT doc_id) AS docs FROM d WHERE site IS NOT NULL GROUP BY site),
l AS (SELECT doc_id, site, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM d WHERE text IS NOT NULL AND site IS NOT NULL),
k AS (SELECT doc_id, site, line_no, regexp_replace(regexp_replace(lower(line), '[\p{Nd}\p{Z}\p{C}\s]+', '', 'g'), '^[\p{P}\p{S}]+|[\p{P}\p{S}]+$', '', 'g') AS key FROM l),
f AS (SELECT site, key FROM k JOIN n USING (site) WHERE key != '' GROUP BY site, key, docs HAVING count(DISTINCT doc_id) >= 5 AND count(DISTINCT doc_id) >= 0.15 * docs),
found AS (SELECT DISTINCT doc_id, line_no::INT AS line_no FROM k JOIN f USING (site, key))"""
_REPEATS = rf"""w AS (SELECT doc_id, coalesce(text, '') AS text, list_filter(list_transform(regexp_split_to_array(lower(coalesce(text, '')), '{_SPACE}+'), lambda x: regexp_replace(x, '^[\p{{P}}\p{{S}}]+|[\p{{P}}\p{{S}}]+$', '', 'g')), lambda x: x != '') AS w FROM documents),
t AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w),
g AS (SELECT doc_id, i, word || chr(1) || lead(word, 1) OVER o || chr(1) || lead(word, 2) OVER o || chr(1) || lead(word, 3) OVER o || chr(1) || lead(word, 4) OVER o AS g FROM t WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, g ORDER BY i) AS k FROM g WHERE g IS NOT NULL) WHERE k > 1),
c AS (SELECT doc_id, count(DISTINCT p) AS covered FROM (SELECT doc_id, unnest(generate_series(i, i + 4)) AS p FROM r) GROUP BY doc_id)"""

ORACLES = {
    "p1_found": f"WITH {_REPEATS} SELECT doc_id FROM c JOIN w USING (doc_id) WHERE covered >= 0.3 * len(w.w)",
    "p1_repetition": rf"""WITH {_REPEATS},
x AS (SELECT doc_id, text, w, len(w)::DOUBLE AS n, coalesce(covered, 0) AS covered, list_filter(list_transform(regexp_split_to_array(text, '\r\n|\n|\r'), lambda y: trim(y, ' ')), lambda y: y != '') AS l FROM w LEFT JOIN c USING (doc_id)),
s AS (SELECT *, coalesce(covered / nullif(n, 0), 0) AS share, coalesce(length(array_to_string(w, '')) / nullif(n, 0), 0) AS chars, coalesce(len(regexp_extract_all(text, '[#…]|\.\.\.')) / nullif(n, 0), 0) AS symbols, coalesce(len(list_filter(w, lambda y: y IN ({_STOPS}))) / nullif(n, 0), 0) AS stops,
coalesce((len(l) - len(list_distinct(l))) / nullif(len(l), 0), 0) AS repeats, coalesce(len(list_filter(l, lambda y: regexp_matches(y, '^[•●▪◦‣*\-–]'))) / nullif(len(l), 0), 0) AS bullets, coalesce(len(list_filter(l, lambda y: regexp_matches(y, '(…|\.\.\.)$'))) / nullif(len(l), 0), 0) AS cuts FROM x)
SELECT doc_id, n::BIGINT AS n_words, covered::BIGINT AS repeated_words, round(share, 6) AS repeated_share, share >= 0.3 AS repeats_itself, n < 50 AS too_short, chars < 3 AS odd_word_length_low, chars > 10 AS odd_word_length_high, symbols > 0.1 AS symbol_heavy, stops < 0.05 AS few_stop_words, repeats > 0.3 AS same_lines, bullets > 0.9 AS bullet_lines, cuts > 0.3 AS cut_lines FROM s""",
    "p3_found": f"WITH {_FOUND} SELECT doc_id, line_no FROM found",
    "p3_clean": f"""WITH {_FOUND}, cut AS (SELECT doc_id, list(line_no) AS nos FROM found GROUP BY doc_id)
SELECT e.doc_id, CASE WHEN nos IS NULL THEN text ELSE array_to_string(list_filter(string_split(text, chr(10)), lambda x, i: NOT list_contains(nos, (i - 1)::INT)), chr(10)) END AS text, coalesce(len(nos), 0)::BIGINT AS lines_removed FROM extracted e LEFT JOIN cut USING (doc_id)""",
    "p6_repetition": rf"""WITH x AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM cleaned),
w AS (SELECT *, list_filter(list_transform(regexp_split_to_array(lower(text), '{_SPACE}+'), lambda y: regexp_replace(y, '^[\p{{P}}\p{{S}}]+|[\p{{P}}\p{{S}}]+$', '', 'g')), lambda y: y != '') AS w,
list_filter(list_transform(regexp_split_to_array(text, '\r\n|\n|\r'), lambda y: regexp_replace(y, '^{_BLANK}+|{_BLANK}+$', '', 'g')), lambda y: y != '') AS l, list_filter(regexp_split_to_array(text, '\n[\s\x{{0b}}]*\n'), lambda y: trim(y, ' ') != '') AS p FROM x),
grams AS (SELECT row, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM (SELECT row, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM w, (SELECT unnest([2, 3, 4]) AS k) WHERE len(w) >= k)),
counts AS (SELECT row, k, g, count(*) AS n FROM grams GROUP BY ALL),
tops AS (SELECT row, k, max(length(g) * n) FILTER (WHERE n = most AND n > 1) AS chars FROM (SELECT *, max(n) OVER (PARTITION BY row, k) AS most FROM counts) GROUP BY row, k),
top AS (SELECT row, max(chars) FILTER (WHERE k = 2) AS c2, max(chars) FILTER (WHERE k = 3) AS c3, max(chars) FILTER (WHERE k = 4) AS c4 FROM tops GROUP BY row)
SELECT doc_id, len(string_split(text, ' '))::BIGINT AS words_count, length(text)::BIGINT AS chars_count, round((len(regexp_extract_all(text, '[^{T.VALID_CLASS} \n]')) / nullif(length(text), 0))::FLOAT::DOUBLE, 5) AS symbol_ratio,
round(coalesce(length(array_to_string(w, '')) / nullif(len(w), 0), 0), 6) AS mean_word_length, round(coalesce(len(list_filter(w, lambda y: y IN ({_STOPS}))) / nullif(len(w), 0), 0), 6) AS common_word_share,
round(coalesce(len(list_filter(l, lambda y: regexp_matches(y, '[.!?।॥۔؟…。！？]["''”’»)\]]*$'))) / nullif(len(l), 0), 0), 6) AS ended_line_share,
round(coalesce((len(l) - len(list_distinct(l))) / nullif(len(l), 0), 0), 6) AS repeated_line_share, round(coalesce((len(p) - len(list_distinct(p))) / nullif(len(p), 0), 0), 6) AS repeated_paragraph_share,
round(coalesce(c2 / nullif(length(array_to_string(w, ' ')), 0), 0), 6) AS top_2_gram_share, round(coalesce(c3 / nullif(length(array_to_string(w, ' ')), 0), 0), 6) AS top_3_gram_share, round(coalesce(c4 / nullif(length(array_to_string(w, ' ')), 0), 0), 6) AS top_4_gram_share FROM w LEFT JOIN top USING (row)""",
}
