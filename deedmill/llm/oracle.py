"""SQL that checks the queries of this subpackage, where SQL can express them."""

ORACLE: dict[str, str] = {}

ORACLE["op2_url_filters"] = r"""
WITH rules(rule, host, path, verdict) AS (
  VALUES ('com/', 'com', '/', 'allow'),
         ('example.com/en/', 'example.com', '/en/', 'block'),
         ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
         ('net/es/', 'net', '/es/', 'block'),
         ('net/fr/', 'net', '/fr/', 'block')),
numbered AS (SELECT row_number() OVER () AS row_id, page_id, coalesce(url, '') AS url FROM pages),
cut AS (
  SELECT row_id, page_id,
         CASE WHEN contains(url, '://')
              THEN translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*'),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN contains(url, '://')
              THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM numbered),
fits AS (
  SELECT c.row_id, r.rule, r.verdict,
         row_number() OVER (PARTITION BY c.row_id ORDER BY length(r.rule) DESC) AS place
  FROM cut c JOIN rules r
    ON (c.host = r.host OR ends_with(c.host, '.' || r.host)) AND starts_with(c.path, r.path))
SELECT c.page_id, c.host, c.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM cut c LEFT JOIN fits f ON f.row_id = c.row_id AND f.place = 1
"""

ORACLE["op11_line_dedup"] = r"""
WITH numbered AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT row_id, doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM numbered),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
SELECT any_value(k.doc_id) AS doc_id, count(*) AS n_lines,
       count(*) FILTER (r.keeper IS DISTINCT FROM k.doc_id AND r.key IS NOT NULL) AS n_dropped,
       sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.pos)
                       FILTER (r.key IS NULL OR r.keeper IS NOT DISTINCT FROM k.doc_id), '')) AS kept_sha256
FROM keyed k LEFT JOIN repeated r ON r.key = k.key
GROUP BY k.row_id
"""

ORACLE["op5_minhash_near_dedup"] = r"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT row_id, array_to_string(w[p + 1 : p + 5], ' ') AS shingle
  FROM texts, unnest(range(CASE WHEN len(w) = 0 THEN 0 ELSE greatest(1, len(w) - 4) END)) t(p)),
sets AS (SELECT row_id, count(*) AS n, md5(string_agg(shingle, chr(10) ORDER BY shingle)) AS set_key FROM shingles GROUP BY row_id),
classes AS (SELECT set_key, min(row_id) AS rep, any_value(n) AS n FROM sets GROUP BY set_key),
held AS (SELECT c.rep, s.shingle FROM classes c JOIN shingles s ON s.row_id = c.rep),
shared AS (
  SELECT x.rep AS a, y.rep AS b, count(*) AS both
  FROM held x JOIN held y ON x.shingle = y.shingle AND x.rep <> y.rep GROUP BY 1, 2),
links AS (
  SELECT s.a, s.b FROM shared s JOIN classes x ON x.rep = s.a JOIN classes y ON y.rep = s.b
  WHERE 100 * s.both >= 85 * (x.n + y.n - s.both)),
reach AS (SELECT rep, rep AS other FROM classes UNION SELECT r.rep, l.b FROM reach r JOIN links l ON l.a = r.other),
members AS (SELECT c.rep, t.doc_id FROM classes c JOIN sets s USING (set_key) JOIN texts t USING (row_id)),
least AS (SELECT r.rep, min(m.doc_id) AS component_id FROM reach r JOIN members m ON m.rep = r.other GROUP BY r.rep)
SELECT t.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(l.component_id, t.doc_id) AS component_id,
       coalesce(l.component_id, t.doc_id) = t.doc_id AS kept
FROM texts t LEFT JOIN sets s USING (row_id) LEFT JOIN classes c USING (set_key) LEFT JOIN least l USING (rep)
"""

ORACLE["op8_vector_near_dedup"] = r"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y ON x.vec_id <> y.vec_id
  WHERE list_cosine_similarity(x.v, y.v) >= 0.9),
reach AS (SELECT vec_id, vec_id AS other FROM vectors UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.other),
least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
counted AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n_links, 0) AS n_links, coalesce(l.component_id, e.vec_id) AS component_id,
       coalesce(l.component_id, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN counted c USING (vec_id) LEFT JOIN least l USING (vec_id)
"""

#: (metric, quantile per thousand, beyond, slack, both sides), as in ``quality.RULES``.
_RULES = """
rules(metric, place, beyond, slack, two_sided) AS (
  VALUES ('symbols_per_word', 900, 100, 25, false), ('duplicate_lines', 990, 25, 25, false),
         ('repeated_words', 990, 100, 25, false), ('word_length', 900, 400, 25, true))"""


def _reach(level: str, keys: str) -> str:
    return f"""
{level} AS (
  SELECT {keys} q.metric, count(*) AS total, list_sort(list(low)) AS v, (500 * count(*) + 999) // 1000 AS m,
         v[m] AS mid,
         (v[(r.place * count(*) + 999) // 1000] - v[m]) * (100 + r.beyond) // 100 + r.slack AS above,
         (v[m] - v[((1000 - r.place) * count(*) + 999) // 1000]) * (100 + r.beyond) // 100 + r.slack AS below
  FROM passing q JOIN rules r ON r.metric = q.metric
  GROUP BY {keys} q.metric, r.place, r.beyond, r.slack)"""


ORACLE["op9_quality_rules"] = rf"""
WITH {_RULES},
texts AS (
  SELECT row_number() OVER () AS row_id, doc_id, lang, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT row_id, p, w[p + 1] || ' ' || w[p + 2] || ' ' || w[p + 3] AS win FROM texts, unnest(range(greatest(len(w) - 2, 0))) t(p)),
repeated AS (SELECT row_id, p FROM windows QUALIFY count(*) OVER (PARTITION BY row_id, win) > 1),
covered AS (SELECT row_id, count(DISTINCT q) AS n FROM (SELECT row_id, unnest([p, p + 1, p + 2]) AS q FROM repeated) GROUP BY row_id),
stats AS (
  SELECT t.row_id, doc_id, lang, source, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM texts t LEFT JOIN covered c USING (row_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM stats),
metrics AS (
  SELECT row_id, lang, source, base_failed, unnest([
    {{'metric': 'symbols_per_word', 'value': 1000 * n_symbols // greatest(n_words, 1)}},
    {{'metric': 'duplicate_lines', 'value': 1000 * n_dup_lines // greatest(n_lines, 1)}},
    {{'metric': 'repeated_words', 'value': 1000 * n_repeat_words // greatest(n_words, 1)}},
    {{'metric': 'word_length', 'value': 100 * word_chars // greatest(n_words, 1)}}], recursive := true)
  FROM judged),
passing AS (
  SELECT lang, source, metric,
         (value >> greatest(0, length(bin(value)) - 6)) << greatest(0, length(bin(value)) - 6) AS low
  FROM metrics WHERE NOT base_failed),
{_reach("own", "lang, source,").lstrip()},
{_reach("wide", "lang,").lstrip()},
{_reach("every", "").lstrip()},
limits AS (
  SELECT m.row_id, m.value, r.two_sided, CASE WHEN o.total >= 100 THEN o.mid WHEN l.total >= 100 THEN l.mid ELSE e.mid END AS mid,
         CASE WHEN l.total >= 100 THEN least(l.above, 2 * e.above) ELSE e.above END AS lang_above,
         CASE WHEN l.total >= 100 THEN least(l.below, 2 * e.below) ELSE e.below END AS lang_below,
         CASE WHEN o.total >= 100 THEN least(o.above, 2 * lang_above) ELSE lang_above END AS above,
         CASE WHEN o.total >= 100 THEN least(o.below, 2 * lang_below) ELSE lang_below END AS below
  FROM metrics m JOIN rules r USING (metric) JOIN every e USING (metric)
  LEFT JOIN wide l ON l.metric = m.metric AND l.lang IS NOT DISTINCT FROM m.lang
  LEFT JOIN own o ON o.metric = m.metric AND o.lang IS NOT DISTINCT FROM m.lang AND o.source IS NOT DISTINCT FROM m.source),
inside AS (
  SELECT row_id, bool_and(value <= mid + above AND (NOT two_sided OR value >= mid - below)) AS ok FROM limits GROUP BY row_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(ok, true) AS kept
FROM judged LEFT JOIN inside USING (row_id)
"""

ORACLE["op12_spelling_variants"] = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY b) AS steps
  FROM (SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM range(256) t(b))),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[a-zÀ-ÿ]{7,}')) AS run
  FROM documents),
counted AS (
  SELECT run, count(*) AS times, hex(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run) AS bytes FROM runs GROUP BY doc_id, run),
hashed AS (
  SELECT run, times, xor(list_reduce(
           list_prepend(4294967295, list_transform(range(length(bytes) // 2), lambda i: CAST('0x' || substr(bytes, 2 * i + 1, 2) AS BIGINT))),
           lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM counted, crc_table),
spelt AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times FROM hashed),
words AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM spelt WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
shorter AS (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM words, unnest(range(length(word))) t(i)),
pairs AS (
  SELECT x.word, y.word AS near FROM shorter x JOIN shorter y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word
  UNION SELECT x.word, w.word FROM shorter x JOIN words w ON w.word = x.rest
  UNION SELECT w.word, x.word FROM shorter x JOIN words w ON w.word = x.rest),
best AS (
  SELECT p.word, p.near, o.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near,
         row_number() OVER (PARTITION BY p.word ORDER BY o.n DESC, p.near) AS place
  FROM pairs p JOIN words o ON o.word = p.near),
forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= 10 * w.n THEN b.near END AS form,
         CASE WHEN b.near_n >= 10 * w.n THEN b.near_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word AND b.place = 1),
chains AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT c.word, f.form FROM chains c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL),
roots AS (SELECT c.word, c.root FROM chains c JOIN forms f ON f.word = c.root WHERE f.form IS NULL)
SELECT word, n, n_near, form, form_n, root FROM forms JOIN roots USING (word)
"""
