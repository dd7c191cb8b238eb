"""DuckDB SQL for the queries that SQL can express, over the whole tables."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
ALOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

MIX = rf"""
WITH sizes AS (SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk FROM per),
weighted AS (SELECT *, CAST(rk % 3 + 1 AS DOUBLE) AS weight, CAST(source_size AS DOUBLE) * 3.0 AS most FROM ranked),
stepped AS (SELECT *, sum(CAST(source_size AS DOUBLE)) OVER () AS total, sum(weight) OVER () AS weights,
  coalesce(sum(most) OVER (ORDER BY most / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS most_before,
  coalesce(sum(weight) OVER (ORDER BY most / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS weight_before
  FROM weighted),
capped AS (SELECT *, weight * (total - most_before) / (weights - weight_before) > most AS is_capped FROM stepped),
target AS (SELECT source, source_size, CASE WHEN is_capped THEN most ELSE weight * ((total - sum(CASE WHEN is_capped THEN most ELSE 0.0 END) OVER ())
  / (weights - sum(CASE WHEN is_capped THEN weight ELSE 0.0 END) OVER ())) END AS target FROM capped),
placed AS (SELECT s.doc_id, s.size, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
  coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY md5('mix' || coalesce(CAST(s.doc_id AS VARCHAR), '')), s.doc_id, s.size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sizes s JOIN target t ON s.source IS NOT DISTINCT FROM t.source),
cut AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM placed)
SELECT doc_id, size, source_size, target,
  CAST(epochs * size + least(size, greatest(0, budget - epochs * source_size - before)) AS BIGINT) AS taken,
  CAST(epochs AS BIGINT) AS epochs
FROM cut
"""

RULES = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, chr(0)) AS host, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
win AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1),
cover AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM twice, range(5) AS t(k) GROUP BY r),
line AS (SELECT r, host, unnest(string_split(text, chr(10))) AS x FROM d),
full_line AS (SELECT r, host, x, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS words,
  trim(regexp_replace({ALOW.format("translate(x, '123456789', '000000000')")}, '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS k
  FROM line WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
dup AS (SELECT r, count(*) - count(DISTINCT x) AS n_dup_lines FROM full_line GROUP BY r),
often AS (SELECT host, k FROM full_line GROUP BY host, k HAVING count(DISTINCT r) > 20),
lost AS (SELECT r, sum(words) AS n FROM full_line JOIN often USING (host, k) GROUP BY r),
base AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
  CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
  CAST(coalesce(lost.n, 0) AS BIGINT) AS n_frequent_words
  FROM d LEFT JOIN dup USING (r) LEFT JOIN cover USING (r) LEFT JOIN lost USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * (n_words - n_frequent_words) >= 50 * n_words AS kept,
  n_frequent_words
FROM base
"""

LINES = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
line AS (SELECT r, doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d),
keyed AS (SELECT *, {ALOW.format("trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS k FROM line),
common AS (SELECT k, max(doc_id) AS holder FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT r) >= 5),
judged AS (SELECT l.*, c.k IS NOT NULL AND l.doc_id IS DISTINCT FROM c.holder AS gone FROM keyed l LEFT JOIN common c USING (k))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INT)) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(x, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r
"""

CHAT = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, length(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(text, '\', '\\'),
  '<|turn|>', '<\|turn|>'), '<|text|>', '<\|text|>'), '<|end|>', '<\|end|>'), '<|im_start|>', '<\|im_start|>'), '<|im_end|>', '<\|im_end|>'),
  '<|endoftext|>', '<\|endoftext|>'), '</s>', '<\/s>'), '<s>', '<\s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]'), '<<SYS>>', '<\<SYS>>'),
  '<</SYS>>', '<\</SYS>>')) + length(role) + length('<|turn|><|text|><|end|>') AS n FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

DIVERGENCE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all({ALOW.format("coalesce(text, '')")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
tok AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM tok GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
vocabulary AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM d),
cnt AS (SELECT t.lang, t.source, t.term, count(*) AS c FROM tok t JOIN kept k ON t.lang = k.lang AND t.term = k.term GROUP BY t.lang, t.source, t.term),
lang_n AS (SELECT lang, sum(c) AS n FROM cnt GROUP BY lang),
source_n AS (SELECT lang, source, sum(c) AS n FROM cnt GROUP BY lang, source),
lang_p AS (SELECT c.lang, c.term, CAST(1 + (1000000000 * (sum(c.c) + 1)) // (any_value(l.n) + any_value(v.v)) AS BIGINT) AS q
  FROM cnt c JOIN lang_n l ON c.lang = l.lang JOIN vocabulary v ON c.lang = v.lang GROUP BY c.lang, c.term),
group_p AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
  CAST(1 + (1000000000 * (coalesce(c.c, 0) + 1)) // (coalesce(n.n, 0) + v.v) AS BIGINT) AS p
  FROM grp g JOIN kept k ON g.lang = k.lang JOIN vocabulary v ON g.lang = v.lang
  LEFT JOIN source_n n ON g.lang = n.lang AND g.source = n.source
  LEFT JOIN cnt c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
summed AS (SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // b.p) AS BIGINT) AS value
  FROM group_p a JOIN group_p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT g.lang, g.source, 'term' AS part, g.term AS item, CAST((g.p - l.q) * (g.p - l.q) // l.q AS BIGINT) AS value
  FROM group_p g JOIN lang_p l ON g.lang = l.lang AND g.term = l.term WHERE g.c > 0 AND g.p > l.q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""

FIM = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
  sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (SELECT doc_id, text, u, CAST(len(u) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
  CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
cut AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
    WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
part AS (SELECT doc_id, text, n, form, coalesce(array_to_string(u[1:a], ''), '') AS prefix, coalesce(array_to_string(u[a + 1:b], ''), '') AS middle,
  coalesce(array_to_string(u[b + 1:n], ''), '') AS suffix FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM part
"""

SQL = {"op1_mixing": MIX, "op2_quality_rules": RULES, "op7_line_dedup": LINES, "op10_chat_format": CHAT, "op11_divergence": DIVERGENCE, "op13_fill_in_middle": FIM}
