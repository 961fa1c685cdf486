"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {
    "op5_exact_dedup": f"""
WITH t AS (SELECT doc_id, sha256({AZ}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC) = 1 AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)""",
    "op1_line_dedup": """
WITH raw AS (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS ls
  FROM documents),
each AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS raw FROM raw),
real AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY raw) AS pos FROM each
  WHERE regexp_matches(line, '[^ \t\n\v\f\r]')),
runs AS (SELECT *, lead(line, 1) OVER d AS l1, lead(line, 2) OVER d AS l2 FROM real
  WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
later AS (SELECT *,
    length(line) >= 40 AND row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) > 1 AS one,
    l2 IS NOT NULL AND row_number() OVER (PARTITION BY line, l1, l2 ORDER BY doc_id, pos) > 1 AS run
  FROM runs),
gone AS (SELECT doc_id, raw, pos, line, one OR bool_or(run) OVER (PARTITION BY doc_id ORDER BY pos
    ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS gone FROM later),
counts AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed FROM gone GROUP BY doc_id),
runs_gone AS (SELECT doc_id, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS g FROM gone WHERE gone),
longest AS (SELECT doc_id, max(c) AS longest_run FROM (SELECT doc_id, g, count(*) AS c FROM runs_gone GROUP BY ALL)
  GROUP BY doc_id),
kept AS (SELECT e.doc_id, string_agg(e.line, chr(10) ORDER BY e.raw) AS text FROM each e
  LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.raw = e.raw WHERE g.gone IS NOT TRUE GROUP BY e.doc_id)
SELECT r.doc_id, coalesce(c.n_lines, 0) AS n_lines, coalesce(c.n_removed, 0) AS n_removed,
  coalesce(l.longest_run, 0) AS longest_run, sha256(coalesce(k.text, '')) AS kept_sha256
FROM raw r LEFT JOIN counts c USING (doc_id) LEFT JOIN longest l USING (doc_id) LEFT JOIN kept k USING (doc_id)""",
    "op10_substring_dedup": r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS doc,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (SELECT doc, i, array_to_string(ws[i:i + 34], ' ') AS w
  FROM (SELECT doc, ws, unnest(range(1, len(ws) - 33)) AS i FROM d)),
twice AS (SELECT doc, i FROM windows QUALIFY count(*) OVER (PARTITION BY w) > 1),
gone AS (SELECT DISTINCT doc, i + k AS j FROM twice, range(35) AS r(k)),
each AS (SELECT doc, unnest(ws) AS word, generate_subscripts(ws, 1) AS j FROM d),
kept AS (SELECT e.doc, count(g.j) AS n_removed, string_agg(e.word, ' ' ORDER BY e.j) FILTER (g.j IS NULL) AS text
  FROM each e LEFT JOIN gone g ON g.doc = e.doc AND g.j = e.j GROUP BY e.doc)
SELECT doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM d LEFT JOIN kept k USING (doc)""",
    "op8_mixing": """
WITH RECURSIVE d AS (SELECT doc_id, coalesce(source, '') AS source, md5(CAST(doc_id AS VARCHAR)) AS key,
  length(coalesce(text, '')) + 1 AS size FROM documents),
sizes AS (SELECT source, sum(size) AS size FROM d GROUP BY source),
ws AS (SELECT source, size, pow(CAST(size AS DOUBLE), 0.5) AS w FROM sizes),
asked AS (SELECT greatest(1000, least(CAST(ceil(50 * sum(w) / min(w)) AS BIGINT), 100 * count(*))) AS slots FROM ws),
q AS (SELECT source, row_number() OVER (ORDER BY source) AS i, size, greatest(1, CAST(round(
  w / sum(w) OVER () * slots) AS BIGINT)) AS q FROM ws, asked),
p AS (SELECT sum(q) AS p, list(q ORDER BY i) AS qs, count(*) AS n FROM q),
edf AS (SELECT 0 AS t, (SELECT list_transform(qs, lambda x: CAST(0 AS BIGINT)) FROM p) AS done, CAST(NULL AS BIGINT) AS k,
    CAST(NULL AS BIGINT) AS nth
  UNION ALL
  SELECT t + 1, list_transform(done, lambda x, i: CASE WHEN i = c THEN x + 1 ELSE x END), c, done[c]
  FROM (SELECT t, done, list_min(list_filter(list_transform(done, lambda x, i: CASE
      WHEN x < qs[i] AND CAST(floor(x * p / qs[i]) AS BIGINT) <= t
      THEN CAST(ceil((x + 1) * p / qs[i]) AS BIGINT) * 1000000 + i END), lambda z: z IS NOT NULL)) % 1000000 AS c
    FROM edf, p WHERE t < p)),
plan AS (SELECT q.source, e.nth, e.t - 1 AS slot, q.q FROM edf e JOIN q ON q.i = e.k),
b AS (SELECT doc_id, source, CAST((sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size
  ROWS UNBOUNDED PRECEDING) - size) // 200000 AS BIGINT) AS block FROM d),
ends AS (SELECT min(plan.slot + (CAST(ceil(q.size / 200000) AS BIGINT) // q.q) * (SELECT p FROM p)) AS horizon
  FROM q JOIN plan ON plan.source = q.source AND plan.nth = CAST(ceil(q.size / 200000) AS BIGINT) % q.q)
SELECT b.doc_id, b.source, b.block, CAST(plan.slot + (b.block // plan.q) * (SELECT p FROM p) AS BIGINT) AS slot,
  plan.slot + (b.block // plan.q) * (SELECT p FROM p) < (SELECT horizon FROM ends) AS in_mix
FROM b JOIN plan ON plan.source = b.source AND plan.nth = b.block % plan.q""",
    "op11_spelling_variants": rf"""
WITH RECURSIVE steps AS (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(256)) AS i)),
tab AS (SELECT list(c ORDER BY i) AS t FROM steps),
runs AS (SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all({AZ}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY doc_id, run),
bytes AS (SELECT run, n, list_transform(range(CAST(length(hex(b)) / 2 AS BIGINT)),
    lambda k: CAST('0x' || substr(hex(b), CAST(2 * k + 1 AS BIGINT), 2) AS BIGINT)) AS b
  FROM (SELECT run, n, encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run) AS b FROM runs)),
sums AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)),
    4294967295) AS h FROM bytes, tab),
shown AS (SELECT n, CASE WHEN h % 31 = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) ||
    substr(run, CAST(h % length(run) + 2 AS BIGINT)) ELSE run END AS word FROM sums),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM shown WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
each AS (SELECT word, n, unnest(range(length(word))) AS i FROM words),
cut AS (SELECT word, n, i, left(word, CAST(i AS BIGINT)) || substr(word, CAST(i + 2 AS BIGINT)) AS rest FROM each),
pairs AS (SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest
    AND length(a.word) = length(b.word) AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n
  FROM pairs GROUP BY word),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * w.n THEN near END AS form,
    CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n FROM words w LEFT JOIN best USING (word)),
chain AS (SELECT word, form AS link, 1 AS k FROM forms WHERE form IS NOT NULL
  UNION ALL SELECT c.word, f.form, k + 1 FROM chain c JOIN forms f ON f.word = c.link WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(link, k) AS root FROM chain GROUP BY word)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM forms LEFT JOIN ends USING (word)""",
    "op12_ranked_search": rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS doc, regexp_extract_all({AZ},
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
real AS (SELECT doc_id, doc, ts, len(ts) AS n FROM d WHERE len(ts) > 0),
total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM real),
tf AS (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(ts) AS term FROM real) GROUP BY doc, term),
items AS (SELECT item_id, row_number() OVER () AS item, list_distinct(regexp_extract_all({AZ},
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS ts FROM benchmark),
asked AS (SELECT item_id, item, unnest(ts) AS term FROM items),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, total GROUP BY term, n_docs),
scored AS (SELECT a.item, a.item_id, r.doc_id, r.doc, CAST(sum(w.w * ((1000000000 * tf.tf) //
    (1000 * tf.tf + 8 * (100 - 90 + (90 * r.n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked a JOIN w USING (term) JOIN tf USING (term) JOIN real r ON r.doc = tf.doc, total
  GROUP BY a.item, a.item_id, r.doc_id, r.doc)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank,
  doc_id, score FROM scored WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS FIRST) <= 10""",
    "op13_set_join": rf"""
WITH RECURSIVE d AS (SELECT doc_id, row_number() OVER () AS doc, regexp_extract_all({AZ}, '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
sets AS (SELECT doc_id, doc, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(len(ws) - 2), lambda i: array_to_string(ws[i + 1:i + 3], ' '))) END AS s FROM d),
own AS (SELECT list_sort(s) AS s, min(doc) AS class, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY ALL),
each AS (SELECT class, n, unnest(s) AS g FROM own),
pairs AS (SELECT a.class AS x, b.class AS y FROM each a JOIN each b ON a.g = b.g AND a.class <> b.class
    AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n
  GROUP BY a.class, b.class, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach AS (SELECT class, class AS other FROM own UNION SELECT r.class, p.y FROM reach r JOIN pairs p ON p.x = r.other),
comp AS (SELECT class, min(other) AS comp FROM reach GROUP BY class),
named AS (SELECT s.doc_id, len(s.s) AS n_shingles, CASE WHEN len(s.s) = 0 THEN -s.doc ELSE c.comp END AS comp FROM sets s
  LEFT JOIN own o ON o.s = list_sort(s.s) LEFT JOIN comp c ON c.class = o.class)
SELECT doc_id, CAST(n_shingles AS BIGINT) AS n_shingles, min(doc_id) OVER (PARTITION BY comp) AS component_id FROM named""",
}
