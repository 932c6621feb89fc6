"""SQL of the operators that DuckDB can express, over whole tables."""

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

CONTAMINATION = f"""
WITH docs AS (
  SELECT row_number() OVER () AS d, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), {LETTERS}), '{WORDS}') AS w
  FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {LETTERS}), '{WORDS}') AS w FROM benchmark
), sized AS (
  SELECT item_id, w, least(10, len(w)) AS size FROM items WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, size, array_to_string(list_slice(w, s, s + size - 1), ' ') AS phrase
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS s FROM sized)
), starts AS (
  SELECT d, w, size, unnest(range(1, len(w) - size + 2)) AS s
  FROM docs CROSS JOIN (SELECT DISTINCT size FROM sized)
  WHERE len(w) >= size
), hits AS (
  SELECT s.d, s.s, s.size, i.item_id
  FROM (SELECT d, s, size, array_to_string(list_slice(w, s, s + size - 1), ' ') AS phrase FROM starts) s
  JOIN windows i ON i.size = s.size AND i.phrase = s.phrase
), words AS (
  SELECT d, count(DISTINCT pos) AS n_hit FROM (SELECT d, unnest(range(s, s + size)) AS pos FROM hits) GROUP BY d
), listed AS (
  SELECT d, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT d, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY d
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (d) LEFT JOIN listed USING (d)
"""

TERMS = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"

DIVERGENCE = f"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), {LETTERS}), '{TERMS}') AS w
  FROM documents
), occurrences AS (
  SELECT d, lang, source, unnest(w) AS term FROM docs
), kept AS (
  SELECT lang, term FROM occurrences GROUP BY ALL HAVING count(DISTINCT d) >= 30
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM occurrences SEMI JOIN kept USING (lang, term) GROUP BY ALL
), vocabulary AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), cells AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)
), totals AS (
  SELECT lang, source, sum(n) AS total FROM cells GROUP BY ALL
), shares AS (
  SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) // (total + 5 * v)::HUGEINT AS p
  FROM cells JOIN totals USING (lang, source) JOIN vocabulary USING (lang)
), overall AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 5)::HUGEINT) // (any_value(total) + 5 * any_value(v))::HUGEINT AS q
  FROM cells JOIN (SELECT lang, sum(total) AS total FROM totals GROUP BY lang) USING (lang) JOIN vocabulary USING (lang)
  GROUP BY lang, term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(p.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM shares JOIN overall USING (lang, term) WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM every
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""

RUNS = "[A-Za-z\u00C0-\u00FF]+"

# crc32 byte by byte from its table of 256 values, which eight steps of shift and xor make.
VARIANTS = f"""
WITH RECURSIVE steps AS (
  SELECT i, 0 AS k, i::UBIGINT AS v FROM range(256) t(i)
  UNION ALL
  SELECT i, k + 1, xor(v >> 1, (v & 1) * 3988292384::UBIGINT) FROM steps WHERE k < 8
), crc AS (
  SELECT list(v ORDER BY i) AS steps FROM steps WHERE k = 8
), runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {LETTERS}), '{RUNS}')) AS run FROM documents
  ) WHERE length(run) >= 7 GROUP BY ALL
), bytes AS (
  SELECT run, n, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
    lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)] ELSE [192 + ord(c) // 64, 128 + ord(c) % 64] END)) AS b
  FROM runs
), hashed AS (
  SELECT run, n, xor(4294967295::UBIGINT, list_reduce(
    list_prepend(4294967295::UBIGINT, list_transform(b, lambda x: x::UBIGINT)),
    lambda c, x: xor(c >> 8, steps[1 + (xor(c, x) & 255)::BIGINT])))::BIGINT AS h
  FROM bytes, crc
), damaged AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM hashed
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM damaged WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), cuts AS (
  SELECT word, n, k, left(word, k - 1) || substr(word, k + 1) AS cut
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM words)
), near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.k = b.k AND a.cut = b.cut AND a.word <> b.word
  UNION
  SELECT a.word, a.n, b.word, b.n FROM cuts a JOIN words b ON a.cut = b.word
  UNION
  SELECT b.word, b.n, a.word, a.n FROM cuts a JOIN words b ON a.cut = b.word
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n
  FROM near GROUP BY word
), judged AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * n THEN other END AS form,
         CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), chains AS (
  SELECT word, word AS root, form AS next FROM judged
  UNION ALL
  SELECT c.word, j.word, j.form FROM chains c JOIN judged j ON j.word = c.next
)
SELECT j.word, j.form, c.root, j.n, j.n_near, j.form_n
FROM judged j JOIN chains c ON c.word = j.word AND c.next IS NULL
"""
