"""The operators that SQL can express, by their plain definition (DuckDB)."""

from __future__ import annotations

from ordermill.llm.quality_rules import EDGES, STOP_WORDS

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

DECONTAMINATE = rf"""
WITH words AS (
  SELECT t, id, list_filter(
    regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
    lambda x: x <> '') AS w
  FROM (SELECT 'd' AS t, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark)),
windows AS (
  SELECT DISTINCT id AS item_id, w[s + 1 : s + least(len(w), 10)] AS part
  FROM (SELECT id, w, unnest(range(greatest(len(w) - 10, 0) + 1)) AS s FROM words WHERE t = 'b' AND len(w) > 0)),
lengths AS (SELECT DISTINCT len(part) AS n FROM windows),
places AS (
  SELECT id, s, n, w[s + 1 : s + n] AS part
  FROM (SELECT id, w, n, unnest(range(len(w) - n + 1)) AS s FROM words, lengths WHERE t = 'd' AND len(w) >= n)),
found AS (SELECT id, s, n, item_id FROM places JOIN windows USING (part)),
hits AS (SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(s, s + n)) AS p FROM found) GROUP BY id),
items AS (
  SELECT id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT id, item_id::VARCHAR AS item_id FROM found) GROUP BY id)
SELECT words.id AS doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hits USING (id) LEFT JOIN items USING (id) WHERE t = 'd'
"""

LINES = """
WITH lines AS (
  SELECT doc_id, i, l FROM (
    SELECT doc_id, unnest(range(len(ls))) AS i, unnest(ls) AS l
    FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL))),
windows AS (
  SELECT doc_id, i AS s, lead(i, 2) OVER w AS e, trim(l, ' ') AS a, lead(trim(l, ' '), 1) OVER w AS b,
    lead(trim(l, ' '), 2) OVER w AS c
  FROM lines WHERE trim(l, ' ') <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
later AS (
  SELECT doc_id, s, e FROM (
    SELECT doc_id, s, e, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, s) AS n
    FROM windows WHERE e IS NOT NULL) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, e + 1)) AS i FROM later),
kept AS (
  SELECT lines.doc_id, string_agg(l, chr(10) ORDER BY lines.i) FILTER (gone.i IS NULL) AS text,
    count(gone.i) AS lines_removed, count(*) AS lines_total
  FROM lines LEFT JOIN gone ON lines.doc_id = gone.doc_id AND lines.i = gone.i GROUP BY lines.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(kept.text, '') END AS text,
  coalesce(lines_removed, 0)::BIGINT AS lines_removed, coalesce(lines_total, 0)::BIGINT AS lines_total
FROM documents d LEFT JOIN kept USING (doc_id)
"""

# DuckDB has no crc32: bytes are folded over the table of the reflected polynomial 0xEDB88320.
CRC32 = """
crc_table AS (
  SELECT list_transform(range(256), lambda b: list_reduce([b] || range(8),
    lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS tab),
crc AS (
  SELECT word, xor(list_reduce([4294967295] || list_transform(range(octet_length(encode(word))),
      lambda i: (instr('0123456789ABCDEF', h[2 * i + 1]) - 1) * 16 + instr('0123456789ABCDEF', h[2 * i + 2]) - 1),
    lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) AS h32
  FROM (SELECT word, hex(encode(word)) AS h FROM distinct_words), crc_table)"""

RESAMPLE = rf"""
WITH words AS (
  SELECT t, id, list_filter(
    regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
    lambda x: x <> '') AS w
  FROM (SELECT 'd' AS t, doc_id AS id, text FROM documents UNION ALL SELECT 'b', NULL, text FROM benchmark)),
each AS (SELECT t, id, unnest(w) AS word FROM words),
distinct_words AS (SELECT DISTINCT word FROM each),
{CRC32.strip()},
buckets AS (SELECT t, id, h32 % 10000 AS b FROM each JOIN crc USING (word)),
sums AS (SELECT count(*) FILTER (t = 'd')::DOUBLE AS s_all, count(*) FILTER (t = 'b')::DOUBLE AS t_all FROM buckets),
gains AS (
  SELECT b, floor(1000 * ln((t_b + 1) * (s_all + 10000) / ((s_b + 1) * (t_all + 10000)))) AS gain
  FROM (SELECT b, count(*) FILTER (t = 'd')::DOUBLE AS s_b, count(*) FILTER (t = 'b')::DOUBLE AS t_b FROM buckets GROUP BY b), sums),
weights AS (SELECT id, floor(sum(gain) / count(*))::BIGINT AS weight FROM buckets JOIN gains USING (b) WHERE t = 'd' GROUP BY id),
scored AS (
  SELECT id AS doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
  FROM words LEFT JOIN weights USING (id) WHERE t = 'd'),
drawn AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n
  FROM scored WHERE n_features >= 20)
SELECT scored.*, CASE WHEN rank <= 10 * n // 100 THEN rank END::BIGINT AS rank
FROM scored LEFT JOIN drawn USING (doc_id)
"""

SPELLING = rf"""
WITH runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')), '{UPPER}', '{LOWER}') AS run
  FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY doc_id, run),
distinct_words AS (SELECT DISTINCT doc_id || ':' || run AS word FROM counted),
{CRC32.strip()},
damaged AS (
  SELECT CASE WHEN h32 % 199 = 0 THEN substr(run, 1, h32 % length(run)) || substr(run, h32 % length(run) + 2) ELSE run END AS word, n
  FROM counted JOIN crc ON word = doc_id || ':' || run),
vocabulary AS (SELECT word, sum(n)::BIGINT AS n FROM damaged WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cuts AS (
  SELECT word, n, p, substr(word, 1, p) || substr(word, p + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS p FROM vocabulary)),
shorter AS (SELECT DISTINCT cuts.word, cuts.n, v.word AS other, v.n AS other_n FROM cuts JOIN vocabulary v ON v.word = rest),
pairs AS (
  SELECT * FROM shorter
  UNION ALL SELECT other, other_n, word, n FROM shorter
  UNION ALL SELECT a.word, a.n, b.word, b.n FROM cuts a JOIN cuts b ON a.p = b.p AND a.rest = b.rest AND a.word <> b.word),
near AS (
  SELECT word, n, count(*) AS n_near, max(other_n) AS best, arg_min(other, (-other_n, other)) AS best_word
  FROM pairs GROUP BY word, n),
forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best >= 5 * v.n THEN best_word END AS form,
    CASE WHEN best >= 5 * v.n THEN best END AS form_n
  FROM vocabulary v LEFT JOIN near USING (word)),
steps AS (
  SELECT word, coalesce(form, word) AS root FROM forms
  UNION SELECT steps.word, forms.form FROM steps JOIN forms ON forms.word = steps.root WHERE forms.form IS NOT NULL),
ends AS (SELECT steps.word, root FROM steps JOIN forms ON forms.word = steps.root WHERE forms.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
"""
SPELLING = SPELLING.replace("WITH runs", "WITH RECURSIVE runs")

_STOP = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
_EDGES = EDGES.replace("'", "''")
RULES = rf"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
windows AS (
  SELECT doc_id, i, w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] AS part
  FROM (SELECT doc_id, w, unnest(range(len(w) - 2)) AS i FROM split WHERE len(w) > 2)),
twice AS (SELECT doc_id, part FROM windows GROUP BY doc_id, part HAVING count(*) > 1),
repeated AS (
  SELECT doc_id, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 3)) AS place FROM windows JOIN twice USING (doc_id, part)) GROUP BY doc_id),
counts AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(list_aggregate(w, 'string_agg', ''))::BIGINT AS chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    len(ls)::BIGINT AS n_lines, len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}')))::BIGINT AS n_letter_words,
    len(list_filter(w, lambda x: trim(lower(x), '{_EDGES}') IN ({_STOP})))::BIGINT AS n_stop_words,
    len(list_filter(ls, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]')))::BIGINT AS n_bullet_lines,
    len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$')))::BIGINT AS n_ellipsis_lines
  FROM split LEFT JOIN repeated USING (doc_id)),
ratios AS (
  SELECT doc_id, n_words, coalesce(chars, 0) AS word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, n_lines, n_letter_words, n_stop_words, n_bullet_lines,
    n_ellipsis_lines, coalesce(chars / nullif(n_words, 0), 0) AS mean_word_chars,
    coalesce(n_symbols / nullif(n_words, 0), 0) AS symbols_per_word, coalesce(n_letter_words / nullif(n_words, 0), 0) AS letter_share,
    coalesce(n_stop_words / nullif(n_words, 0), 0) AS stop_share, coalesce(n_dup_lines / nullif(n_lines, 0), 0) AS dup_line_share,
    coalesce(n_bullet_lines / nullif(n_lines, 0), 0) AS bullet_line_share,
    coalesce(n_ellipsis_lines / nullif(n_lines, 0), 0) AS ellipsis_line_share
  FROM counts)
SELECT *, NOT base_failed AND mean_word_chars BETWEEN 3 AND 10 AND symbols_per_word <= 0.1::DOUBLE AND letter_share >= 0.8::DOUBLE
  AND n_stop_words >= 2 AND stop_share >= 0.05::DOUBLE AND dup_line_share <= 0.5::DOUBLE AND bullet_line_share <= 0.9::DOUBLE
  AND ellipsis_line_share <= 0.3::DOUBLE AS kept
FROM ratios
"""

ORACLES = {"op5_decontaminate": DECONTAMINATE, "op10_lines": LINES, "op11_resample": RESAMPLE, "op12_spelling": SPELLING, "op13_rules": RULES}
