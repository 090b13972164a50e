"""DuckDB SQL of those queries that SQL can express over whole tables."""

OP8 = r"""
WITH p AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
u AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM p),
r AS (
  SELECT * FROM (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                        ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) v(rh, rp, action)),
m AS (
  SELECT DISTINCT ON (u.host, u.path) u.host, u.path, rh || rp AS rule, action
  FROM (SELECT DISTINCT host, path FROM u) u JOIN r
    ON (u.host = rh OR ends_with(u.host, '.' || rh)) AND starts_with(u.path, rp)
  ORDER BY u.host, u.path, length(rh || rp) DESC, length(rh) DESC, action DESC, rule)
SELECT u.page_id, u.host, u.path, m.rule, coalesce(m.action, 'allow') AS verdict
FROM u LEFT JOIN m USING (host, path)
"""

OP2 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
p AS (
  SELECT rid, i, array_to_string(list_slice(w, i, i + 34), ' ') AS win
  FROM (SELECT rid, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
hit AS (SELECT rid, i FROM p JOIN (SELECT win FROM p GROUP BY win HAVING count(*) > 1) USING (win)),
gone AS (SELECT DISTINCT rid, i + j AS k FROM hit, range(35) r(j)),
words AS (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM d),
kept AS (
  SELECT rid, count(*) AS n, string_agg(word, ' ' ORDER BY k) AS line
  FROM words ANTI JOIN gone USING (rid, k) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(line, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""

# n x n: fine for the tables of the correctness check, not for large ones
OP5 = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n
  FROM embeddings),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.vec_id <> b.vec_id AND list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.95),
r(id, c) AS (
  SELECT vec_id, vec_id FROM v
  UNION
  SELECT l.b, r.c FROM r JOIN l ON l.a = r.id)
SELECT vec_id, coalesce(k, 0)::BIGINT AS n_links, c AS component_id, vec_id = c AS kept
FROM v JOIN (SELECT id, min(c) AS c FROM r GROUP BY id) ON id = vec_id
LEFT JOIN (SELECT a, count(*) AS k FROM l GROUP BY a) ON a = vec_id
"""

OP13 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source AS host, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d),
p AS (SELECT rid, i, array_to_string(list_slice(ws, i, i + 2), ' ') AS win
      FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
twice AS (SELECT rid, i FROM p JOIN (SELECT rid, win FROM p GROUP BY ALL HAVING count(*) > 1) USING (rid, win)),
rep AS (SELECT rid, count(DISTINCT i + j) AS n FROM twice, range(3) r(j) GROUP BY rid),
l AS (
  SELECT rid, host, t, regexp_replace(trim(regexp_replace(lower(x), '[\x20\x09-\x0D]+', ' ', 'g')), '[0-9]', '0', 'g') AS line,
         len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT rid, host, t, unnest(ls) AS x FROM w)),
size AS (SELECT host, count(DISTINCT t) AS docs FROM d GROUP BY host),
hot AS (
  SELECT l.host AS host, line FROM l JOIN size ON l.host IS NOT DISTINCT FROM size.host
  GROUP BY l.host, line, docs
  HAVING count(DISTINCT t) > 10 AND count(DISTINCT t) > 0.01 * docs),
lost AS (SELECT rid, sum(n) AS n FROM l JOIN hot ON l.line = hot.line AND l.host IS NOT DISTINCT FROM hot.host GROUP BY rid),
o AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(lost.n, 0)::BIGINT AS n_line_words
  FROM w LEFT JOIN rep USING (rid) LEFT JOIN lost USING (rid))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_line_words <= 0.5 * n_words AS kept
FROM o
"""

_TERMS = r"""regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

OP11 = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, {_TERMS.format('text')} AS ts FROM documents WHERE text IS NOT NULL),
s AS (SELECT count(*) AS nd, sum(len(ts))::BIGINT AS l FROM d WHERE len(ts) > 0),
tf AS (SELECT rid, doc_id, n, t, count(*) AS tf FROM (SELECT rid, doc_id, len(ts) AS n, unnest(ts) AS t FROM d) GROUP BY ALL),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
q AS (SELECT item_id, text, t, count(*) AS reps
      FROM (SELECT item_id, text, unnest({_TERMS.format('text')}) AS t FROM (SELECT DISTINCT item_id, text FROM benchmark))
      GROUP BY ALL),
x AS (
  SELECT item_id, text, rid, doc_id,
         sum(reps * floor(1000 * ln((2 * nd + 2) / (2 * df + 1)))::BIGINT
             * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * nd) // l))))::BIGINT AS score
  FROM q JOIN tf USING (t) JOIN df USING (t), s GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS rank FROM x WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 20
"""

OP12 = r"""
WITH p AS (
  SELECT row_number() OVER () AS pid, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)),
tot AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) AS phrase
      FROM p, range(1, 6) s(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
sub AS (SELECT DISTINCT lang, a, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase
        FROM c, range(2, 5) s(m), range(1, 5) t(i) WHERE m < k AND i + m - 1 <= k),
kept AS (SELECT * FROM c WHERE NOT EXISTS (
           SELECT 1 FROM sub WHERE sub.lang = c.lang AND sub.phrase = c.phrase AND 100 * sub.a >= 100 * c.a)),
x AS (
  SELECT c.lang, c.phrase, c.a, u.a AS l, v.a AS r, n, j,
         ((1000::HUGEINT * c.a * n) // (u.a::HUGEINT * v.a))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM kept) c
  JOIN f u ON u.lang = c.lang AND u.phrase = array_to_string(list_slice(c.w, 1, j), ' ')
  JOIN f v ON v.lang = c.lang AND v.phrase = array_to_string(list_slice(c.w, j + 1, c.k), ' ')
  JOIN tot ON tot.lang = c.lang),
b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
SELECT lang, rank, phrase, a, l, r, n, score FROM o WHERE rank <= 2000
"""

ORACLE_SQL = {"op12_collocations": OP12, "op11_ranked_search": OP11, "op13_quality_rules": OP13, "op2_substring_dedup": OP2, "op5_embedding_dedup": OP5, "op8_url_filters": OP8}
