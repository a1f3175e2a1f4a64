"""SQL for the corpus queries that it can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_BLANKS = r"'[\x20\x09-\x0D]+'"

OP4 = r"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
escaped AS (
  SELECT *, replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(text,
    '\', '\\'), '<<SYS>>', '<\-<SYS>>'), '<</SYS>>', '<\-</SYS>>'), '[INST]', '[\-INST]'), '[/INST]', '[\-/INST]'), '<s>', '<\-s>'),
    '</s>', '<\-/s>'), '<|turn', '<\-|turn'), '|>', '|\->'), '<|end|\->', '<\-|end|\->') AS safe,
    CASE role WHEN 'system' THEN 18 WHEN 'user' THEN 15 WHEN 'assistant' THEN 7 ELSE 17 + length(role) END AS marks
  FROM rows_)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(safe) + marks)::BIGINT AS formatted_chars,
  first(conv_id IS NOT NULL) AND bool_and(CASE WHEN role = 'system' THEN prev = '' WHEN role = 'user' THEN prev IN ('', 'system', 'assistant')
    WHEN role = 'assistant' THEN prev = 'user' ELSE false END) AS valid
FROM (SELECT *, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text), '') AS prev FROM escaped)
GROUP BY conv_id
"""

_BENCH_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP7 = f"""
WITH items AS (SELECT item_id, {_BENCH_WORDS} AS w FROM benchmark),
windows AS (
  SELECT item_id, least(len(w), 10) AS n, unnest([array_to_string(w[i : i + least(len(w), 10) - 1], ' ') FOR i IN range(1, len(w) - least(len(w), 10) + 2)]) AS gram
  FROM items WHERE len(w) > 0),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_BENCH_WORDS} AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT r, n, unnest(range(1, len(w) - n + 2)) AS i, unnest([array_to_string(w[i : i + n - 1], ' ') FOR i IN range(1, len(w) - n + 2)]) AS gram
  FROM docs, sizes WHERE len(w) >= n),
hits AS (SELECT g.r, g.i, g.n, v.item_id FROM grams g JOIN windows v ON g.gram = v.gram AND g.n = v.n),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
found AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN found USING (r)
"""

OP9 = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t, {_WORDS} AS w,
    [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines FROM documents),
grams AS (SELECT r, unnest(range(1, len(w) - 3)) AS i, unnest([array_to_string(w[i : i + 4], ' ') FOR i IN range(1, len(w) - 3)]) AS gram FROM docs WHERE len(w) >= 5),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM grams) WHERE n > 1),
repeats AS (SELECT r, sum(least(5, coalesce(nxt - i, 5)))::BIGINT AS n_repeat_words FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM again) GROUP BY r),
line_rows AS (SELECT r, key, source, regexp_replace(translate(trim(regexp_replace(x, {_BLANKS}, ' ', 'g'), ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]+', '0', 'g') AS line
  FROM (SELECT r, coalesce(doc_id::VARCHAR, 'text ' || md5(t)) AS key, source, unnest(lines) AS x FROM docs)),
hosts AS (SELECT source, count(DISTINCT key) AS n_docs FROM line_rows GROUP BY source),
common AS (SELECT c.source, line FROM (SELECT source, line, count(DISTINCT key) AS n FROM line_rows GROUP BY source, line) c
  JOIN hosts h ON c.source IS NOT DISTINCT FROM h.source WHERE n > 3 AND n > 0.05 * n_docs),
removed AS (SELECT r, sum(length(l.line) - length(replace(l.line, ' ', '')) + 1) AS removed FROM line_rows l
  JOIN common c ON l.source IS NOT DISTINCT FROM c.source AND l.line = c.line GROUP BY r),
rules AS (
  SELECT r, doc_id, source, len(w)::BIGINT AS n_words, length(regexp_replace(t, {_BLANKS}, '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words FROM docs LEFT JOIN repeats USING (r)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, greatest(n_words - coalesce(removed, 0), 0)::BIGINT AS n_left_words
  FROM rules LEFT JOIN removed USING (r))
SELECT doc_id, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_left_words,
  NOT base_failed AND n_left_words >= 10 AND n_left_words >= 0.5 * n_words AS kept FROM judged
"""

OP11 = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM documents),
grams AS (
  SELECT lang, 1 AS k, unnest(w) AS g FROM pieces
  UNION ALL SELECT lang, 2, unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) FROM pieces
  UNION ALL SELECT lang, 3, unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) FROM pieces),
f AS (SELECT lang, k, g, count(*) AS f FROM grams GROUP BY ALL),
sizes AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, g, f AS a, string_split(g, ' ') AS p FROM f WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT c.lang, c.k, c.g, c.a, j, x.f AS l, y.f AS r, (1000000::HUGEINT * c.a * c.a // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM cand) c
  JOIN f x ON x.lang = c.lang AND x.k = c.j AND x.g = array_to_string(c.p[1:c.j], ' ')
  JOIN f y ON y.lang = c.lang AND y.k = c.k - c.j AND y.g = array_to_string(c.p[c.j + 1:c.k], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, k, g ORDER BY score, j) = 1),
longer AS (SELECT lang, g, max(a) AS most FROM (SELECT lang, unnest([p[1] || ' ' || p[2], p[2] || ' ' || p[3]]) AS g, a FROM cand WHERE k = 3) GROUP BY lang, g),
ranked AS (SELECT c.*, row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, a DESC, c.g) AS rank FROM lowest c
  LEFT JOIN longer o ON o.lang = c.lang AND o.g = c.g AND c.k = 2 WHERE most IS NULL OR 100 * most < 50 * a)
SELECT lang, rank, g AS phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""

OP12 = """
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
drawn AS (SELECT doc_id, t, n, ('0x' || h[1:8])::UBIGINT AS h1, ('0x' || h[9:16])::UBIGINT AS h2, ('0x' || h[17:24])::UBIGINT AS h3, ('0x' || h[25:32])::UBIGINT AS h4 FROM docs),
cuts AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1))::BIGINT AS a, greatest(h1 % (n + 1), h2 % (n + 1))::BIGINT AS b,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || t[1:a] || '<S>' || t[b + 1:] || '<M>' || t[a + 1:b] ELSE '<S>' || t[b + 1:] || '<P>' || t[1:a] || '<M>' || t[a + 1:b] END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM cuts
"""

ORACLES = {"op4_chat_format": OP4, "op7_decontaminate": OP7, "op9_quality_rules": OP9, "op11_collocations": OP11, "op12_fill_in_middle": OP12}
