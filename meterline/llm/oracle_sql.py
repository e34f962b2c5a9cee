"""SQL that DuckDB runs to check the text operators that SQL can express on whole tables."""

from __future__ import annotations

import string

from meterline.llm import collocations, decontaminate, rules

_FAILED = " + ".join(f"CASE WHEN {condition} THEN {rules.BIT[name]} ELSE 0 END" for name, condition in rules.RULES)
_CAPITALS, _SMALL = string.ascii_uppercase, string.ascii_lowercase


def _without(chars: str) -> str:
    return f"CAST(length(t) - length(regexp_replace(t, '{chars}', '', 'g')) AS BIGINT)"


RULE_LEDGER = rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
split AS (
    SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
           list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM texts),
windows AS (
    SELECT doc_id, i, array_to_string(words[i:i + {rules.REPEAT_WINDOW - 1}], ' ') AS g
    FROM split, unnest(range(1, greatest(len(words) - {rules.REPEAT_WINDOW - 2}, 1))) AS r(i)),
twice AS (SELECT doc_id, g FROM windows GROUP BY 1, 2 HAVING count(*) > 1),
covered AS (
    SELECT doc_id, count(DISTINCT i + o.j) AS n FROM windows JOIN twice USING (doc_id, g), range({rules.REPEAT_WINDOW}) AS o(j) GROUP BY 1),
measured AS (
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(covered.n, 0) AS n_repeat_words,
           CAST(length(t) AS BIGINT) - {_without(r'[\x20\x09-\x0D]')} AS word_chars, {_without('[#*$%&|<>]')} AS n_symbols,
           {_without('!')} AS n_exclamations, {_without(r'\p{Lu}')} AS n_upper,
           CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           CAST(len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) AS BIGINT) AS n_stutter
    FROM split LEFT JOIN covered USING (doc_id)),
judged AS (SELECT *, CAST({_FAILED} AS BIGINT) AS failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & {rules.BASE} <> 0 AS base_failed,
       failed & {rules.BASE | rules.POLICIES['v3']} = 0 AS kept, failed, n_upper, n_exclamations, n_stutter, n_lines FROM judged"""

_WORDS = (
    f"list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_CAPITALS}', '{_SMALL}'), "
    rf"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
)

WINNOWING = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS words FROM documents),
items AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
item_windows AS (
    SELECT DISTINCT item_id, n, array_to_string(words[i:i + n - 1], ' ') AS g
    FROM (SELECT *, least(len(words), {decontaminate.WINDOW}) AS n FROM items WHERE len(words) > 0), unnest(range(1, len(words) - n + 2)) AS r(i)),
lengths AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
    SELECT doc_id, n, i, array_to_string(words[i:i + n - 1], ' ') AS g
    FROM docs, lengths, unnest(range(1, greatest(len(words) - n + 2, 1))) AS r(i)),
met AS (SELECT doc_id, n, i, item_id FROM doc_windows JOIN item_windows USING (n, g)),
hit AS (SELECT doc_id, count(DISTINCT i + o.j) AS n_hit FROM met, range({decontaminate.WINDOW}) AS o(j) WHERE o.j < n GROUP BY 1),
found AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY 1)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)"""

COLLOCATIONS = rf"""
WITH pieces AS (
    SELECT coalesce(lang, '{collocations.NO_LANGUAGE}') AS lang, unnest(regexp_split_to_array(translate(text, '{_CAPITALS}', '{_SMALL}'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents WHERE text IS NOT NULL),
split AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
grams AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
    FROM split, (VALUES (1), (2), (3)) AS sizes(k), unnest(range(1, greatest(len(w) - k + 2, 1))) AS r(i) GROUP BY ALL),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE k > 1 AND f >= {collocations.LEAST_COUNT}),
longest AS (
    SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(a) AS longest FROM candidates, range(1, 3) AS r(i) WHERE k = 3 GROUP BY 1, 2),
left_over AS (
    SELECT c.* FROM candidates c LEFT JOIN longest l ON c.k = 2 AND c.lang = l.lang AND c.phrase = l.phrase
    WHERE longest IS NULL OR 100 * longest < {collocations.SWALLOWED} * a),
cuts AS (
    SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, cut, (CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(x.f AS HUGEINT) * y.f) AS score
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM left_over) c
    JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.cut], ' ')
    JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE k = 1 GROUP BY 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN sizes USING (lang) WHERE rank <= {collocations.TOP}"""

SQL = {"op9_winnowing": WINNOWING, "op10_rule_ledger": RULE_LEDGER, "op11_stripes": COLLOCATIONS}
