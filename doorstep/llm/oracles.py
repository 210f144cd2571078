"""DuckDB SQL with the rows of the operators' queries, where SQL can express them."""

WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP7 = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS body, {WORDS} AS words
  FROM documents
),
windows AS (
  SELECT rid, pos, count(*) OVER (PARTITION BY rid, words[pos], words[pos + 1], words[pos + 2]) AS n
  FROM docs, unnest(range(1, len(words) - 1)) AS t(pos)
),
repeats AS (
  SELECT rid, count(DISTINCT word_at) AS n_repeat_words
  FROM (SELECT rid, unnest([pos, pos + 1, pos + 2]) AS word_at FROM windows WHERE n > 1)
  GROUP BY rid
),
lines AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(body, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
  GROUP BY rid
),
measured AS (
  SELECT d.rid, doc_id, source, len(words) AS n_words,
    length(regexp_replace(body, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines
  FROM docs d LEFT JOIN repeats USING (rid) LEFT JOIN lines USING (rid)
),
failed AS (
  SELECT *, n_words < 50 AS few_words, 100 * n_repeat_words > 50 * n_words AS repetitive,
    100 * n_symbols > 50 * n_words AS symbols, 100 * n_dup_lines > 30 * n_lines AS dup_lines
  FROM measured
),
long_form AS (
  UNPIVOT (SELECT rid, source, few_words, repetitive, symbols, dup_lines FROM failed)
  ON few_words, repetitive, symbols, dup_lines INTO NAME rule VALUE bad
),
hosts AS (
  SELECT rule, source, count(*) AS n, count(*) FILTER (WHERE bad) AS f
  FROM long_form GROUP BY rule, source
),
means AS (SELECT rule, sum(f) / sum(n) AS m, sum(n) AS docs, count(*) AS h FROM hosts GROUP BY rule),
spreads AS (
  SELECT rule, m, m * (1 - m) AS noise,
    (sum(n * pow(f / n - m, 2)) - m * (1 - m) * (any_value(h) - 1)) / any_value(docs) AS v
  FROM hosts JOIN means USING (rule) GROUP BY rule, m
),
priors AS (
  SELECT rule, m, CASE WHEN v > 1e-12 THEN greatest(noise / v - 1, 0e0) END AS w FROM spreads
),
rates AS (
  SELECT rule, source, coalesce((m * w + f) / (w + n), m) AS rate
  FROM hosts JOIN priors USING (rule)
),
verdicts AS (
  SELECT source, max(rate) > 0.8 AS rejected, max(rate) FILTER (WHERE rule = 'symbols') AS symbol_rate,
    max(rate) FILTER (WHERE rule = 'dup_lines') AS dup_rate
  FROM rates GROUP BY source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  few_words OR repetitive AS base_failed,
  NOT (few_words OR repetitive OR rejected OR (symbols AND symbol_rate > 0.005)
       OR (dup_lines AND dup_rate > 0.005)) AS kept
FROM failed JOIN verdicts ON failed.source IS NOT DISTINCT FROM verdicts.source
"""


OP4 = r"""
WITH lines AS (
  SELECT rid, doc_id, site, line
  FROM (
    SELECT rid, doc_id, site, trim(unnest(string_split(body, chr(10))), ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line
    FROM (
      SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS site, coalesce(text, '') AS body
      FROM documents
    )
  )
),
spread AS (SELECT line FROM lines WHERE line <> '' GROUP BY line HAVING count(DISTINCT site) >= 5)
SELECT doc_id, count(*) FILTER (WHERE line <> '') AS n_lines,
  count(spread.line) AS n_removed,
  CAST(coalesce(sum(length(spread.line)), 0) AS BIGINT) AS removed_chars
FROM lines LEFT JOIN spread USING (line)
GROUP BY rid, doc_id
"""

OP13 = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t
),
named AS (
  SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name,
    dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c
  FROM conversations
),
kinds AS (
  SELECT c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_transform(string_split(name, ''), lambda ch: CAST(unicode(ch) AS BIGINT)),
      lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8), 4294967295), 4294967295) % 20 AS kind
  FROM named, crc
),
damaged AS (
  SELECT c, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds WHERE kind <> 0
),
placed AS (
  SELECT c, turn, role, text, left(role, 1) AS initial,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
    row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS r
  FROM damaged
),
faults AS (
  SELECT *, lag(initial) OVER (PARTITION BY c ORDER BY r) AS before,
    CASE WHEN bare = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY r) > 1 THEN 'duplicate'
      WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM placed
),
counts AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, max(r) AS n,
    count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY c
),
inserts(state, place, cost, audit, said) AS (
  VALUES ('', '', 0, '', CAST([] AS VARCHAR[])), ('', 'u', 2, 'I', ['user:']), ('', 'a', 4, 'II', ['user:', 'assistant:']),
    ('s', 's', 0, '', []), ('s', 'u', 2, 'I', ['user:']), ('s', 'a', 4, 'II', ['user:', 'assistant:']),
    ('u', 'u', 0, '', []), ('u', 'a', 2, 'I', ['assistant:']), ('a', 'a', 0, '', []), ('a', 'u', 2, 'I', ['user:'])
),
edits(edit, place, reached) AS (
  VALUES ('D', '', ''), ('D', 's', 's'), ('D', 'u', 'u'), ('D', 'a', 'a'), ('R', '', 'u'), ('R', 's', 'u'), ('R', 'u', 'a'),
    ('R', 'a', 'u'), ('K', '', 's'), ('K', '', 'u'), ('K', 's', 'u'), ('K', 'u', 'a'), ('K', 'a', 'u')
),
ways AS (
  SELECT c, CAST(0 AS BIGINT) AS r, '' AS state, {'cost': 0, 'audit': '', 'said': CAST([] AS VARCHAR[])} AS best FROM counts
  UNION ALL
  SELECT w.c, f.r, e.reached, min({
    'cost': w.best.cost + i.cost + CASE e.edit WHEN 'D' THEN 3 WHEN 'R' THEN 2 ELSE 0 END
      + CASE WHEN e.edit <> 'D' AND f.fault = 'truncated' THEN 1 ELSE 0 END,
    'audit': w.best.audit || i.audit || e.edit,
    'said': list_concat(w.best.said, i.said, CASE e.edit WHEN 'D' THEN CAST([] AS VARCHAR[]) WHEN 'K' THEN [f.role || ':' || f.text]
      ELSE [CASE e.reached WHEN 'u' THEN 'user:' ELSE 'assistant:' END || f.text] END)})
  FROM ways w JOIN inserts i ON i.state = w.state JOIN edits e ON e.place = i.place
    JOIN faults f ON f.c = w.c AND f.r = w.r + 1
  WHERE (e.edit = 'D' OR f.fault NOT IN ('blank', 'duplicate')) AND (e.edit <> 'K' OR f.initial = e.reached)
  GROUP BY w.c, f.r, e.reached
),
repaired AS (
  SELECT w.c, min({'cost': best.cost + i.cost, 'audit': best.audit || i.audit, 'said': list_concat(best.said, i.said)}) AS best
  FROM ways w JOIN counts n ON n.c = w.c AND n.n = w.r JOIN inserts i ON i.state = w.state
  WHERE (w.state, i.place) IN (('', ''), ('a', 'a'), ('u', 'a'), ('s', 'a'))
  GROUP BY w.c
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost,
  coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, c FROM named) LEFT JOIN counts USING (c) LEFT JOIN repaired USING (c)
"""

OP11 = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t
),
runs AS (
  SELECT name || run AS name, run, count(*) AS n
  FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' AS name, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]{5,}')) AS run
    FROM documents
  )
  GROUP BY name || run, run
),
hashed AS (
  SELECT run, n, xor(list_reduce(
      list_transform(range(octet_length(encode(name))), lambda i: CAST(concat('0x', substr(hex(encode(name)), 2 * i + 1, 2)) AS BIGINT)),
      lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8), 4294967295), 4294967295) AS h
  FROM runs, crc
),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
    FROM hashed
  )
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
),
gaps AS (
  SELECT DISTINCT word, n, pos, substr(word, 1, pos - 1) || substr(word, pos + 1) AS rest
  FROM words, unnest(range(1, length(word) + 1)) AS p(pos)
),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n FROM gaps a JOIN gaps b ON a.rest = b.rest AND a.pos = b.pos AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM gaps a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, a.word, a.n FROM gaps a JOIN words b ON a.rest = b.word
),
best AS (SELECT word, count(*) AS n_near, min({'less': -n, 'form': other}) AS best FROM near GROUP BY word),
forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.less >= 2 * n THEN best.form END AS form,
    CASE WHEN -best.less >= 2 * n THEN -best.less END AS form_n
  FROM words LEFT JOIN best USING (word)
),
chains AS (
  SELECT word, word AS root FROM forms
  UNION ALL
  SELECT c.word, f.form FROM chains c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL
),
roots AS (SELECT c.word, c.root FROM chains c JOIN forms f ON f.word = c.root WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""

PII_KINDS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true", "lower(value)"),
    "ip": (
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "list_bool_and(list_transform(string_split(value, '.'), lambda p: length(ltrim(p, '0')) <= 3"
        " AND coalesce(try_cast(ltrim(p, '0') AS INT), 0) <= 255))",
        "value",
    ),
    "card": (
        r"[0-9]([ -]?[0-9])+",
        "length(digits) BETWEEN 13 AND 19 AND list_sum(list_transform(range(length(digits)), lambda i:"
        " CAST(digits[length(digits) - i] AS INT) * (1 + i % 2)"
        " - CASE WHEN i % 2 = 1 AND digits[length(digits) - i] > '4' THEN 9 ELSE 0 END)) % 10 = 0",
        "digits",
    ),
    "phone": (r"\+[0-9][ ().0-9-]+[0-9]", "length(digits) BETWEEN 9 AND 15", "digits"),
}
PII_SPOTS = " UNION ALL ".join(
    f"""
  SELECT rid, key, {k} AS kind, entity, near, stop - length(value) AS start, stop FROM (
    SELECT *, {valid} AS ok, {entity} AS entity,
      list_concat(list_slice(list_transform(regexp_extract_all(gaps[place], '\\p{{L}}+'), lambda w: lower(w)), -5, NULL),
        list_slice(list_transform(regexp_extract_all(gaps[place + 1], '\\p{{L}}+'), lambda w: lower(w)), 1, 5)) AS near,
      sum(length(gaps[place]) + length(value)) OVER (PARTITION BY rid ORDER BY place) AS stop
    FROM (
      SELECT rid, key, gaps, place, found[place] AS value, regexp_replace(found[place], '[^0-9]', '', 'g') AS digits
      FROM (
        SELECT rid, key, regexp_extract_all(body, '{pattern}') AS found, string_split_regex(body, '{pattern}') AS gaps FROM docs
      ), unnest(range(1, len(found) + 1)) AS t(place)
    )
  ) WHERE ok
"""
    for k, (pattern, valid, entity) in enumerate(PII_KINDS.values())
)
OP12 = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body, sha256(coalesce(text, '')) AS key FROM documents
),
base AS ({PII_SPOTS}),
entities AS (SELECT kind, entity, count(DISTINCT key) AS n_entity FROM base GROUP BY ALL HAVING count(DISTINCT key) >= 3),
contexts AS (
  SELECT kind, entity, term, count(DISTINCT key) AS n_both FROM (SELECT kind, entity, key, unnest(near) AS term FROM base)
  WHERE length(term) >= 4 GROUP BY ALL HAVING count(DISTINCT key) >= 3
),
runs AS (
  SELECT rid, key, place, lower(words[place]) AS term,
    sum(length(gaps[place]) + length(words[place])) OVER (PARTITION BY rid ORDER BY place) AS stop, length(words[place]) AS size
  FROM (
    SELECT rid, key, regexp_extract_all(body, '\p{{L}}+') AS words, string_split_regex(body, '\p{{L}}+') AS gaps FROM docs
  ), unnest(range(1, len(words) + 1)) AS t(place)
),
terms AS (
  SELECT term, count(DISTINCT key) AS n_term FROM runs WHERE term IN (SELECT term FROM contexts) GROUP BY term
),
disclosing AS (
  SELECT DISTINCT term FROM contexts JOIN entities USING (kind, entity) JOIN terms USING (term),
    (SELECT CAST(count(DISTINCT key) AS DOUBLE) AS n FROM docs)
  WHERE n_entity < n AND ln(n * n_both / (n_term * n_entity)) / ln(n / n_entity) >= 0.9
),
spans AS (
  SELECT rid, kind, start, stop FROM base
  UNION ALL SELECT rid, 4, stop - size, stop FROM runs WHERE term IN (SELECT term FROM disclosing)
),
found AS (
  SELECT rid, count(*) FILTER (WHERE kind = 0) AS n_email, count(*) FILTER (WHERE kind = 1) AS n_ip,
    count(*) FILTER (WHERE kind = 2) AS n_card, count(*) FILTER (WHERE kind = 3) AS n_phone,
    string_agg(name, ',' ORDER BY kind, start, stop) FILTER (WHERE kind < 4) AS base,
    string_agg(name, ',' ORDER BY kind, start, stop) AS spans
  FROM (SELECT *, ['email', 'ip', 'card', 'phone', 'term'][kind + 1] || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT) AS name FROM spans)
  GROUP BY rid
)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
  coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN found USING (rid)
"""

ORACLES = {
    "op4_line_spread": OP4,
    "op7_host_quality": OP7,
    "op11_spelling_variants": OP11,
    "op12_pii": OP12,
    "op13_conversation_repair": OP13,
}
