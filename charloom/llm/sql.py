"""The corpus operators that SQL can express, as DuckDB SQL."""

from __future__ import annotations

MIX = """
WITH d AS (
  SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
  FROM documents),
k AS (
  SELECT *, -ln((('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE + 0.5)
      / 281474976710656.0)
    / coalesce(CASE WHEN size >= 20 THEN 1.0 ELSE 0.5 END
      * CASE WHEN length(text)::DOUBLE / greatest(size, 1) BETWEEN 3 AND 13 THEN 1.0 ELSE 0.5 END, 0.25) AS draw
  FROM d),
s AS (
  SELECT source, sum(size)::DOUBLE AS source_size, 3.0 * sum(size)::DOUBLE AS lim,
    [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS w
  FROM k GROUP BY source),
r AS (
  SELECT *, coalesce(sum(lim) OVER before, 0) AS full_before,
    sum(w) OVER (ORDER BY lim / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left,
    (SELECT sum(source_size) FROM s) AS total
  FROM s WINDOW before AS (ORDER BY lim / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
share AS (SELECT coalesce(arg_min((total - full_before) / w_left, lim / w)
    FILTER (WHERE (total - full_before) / w_left * w <= lim), 0) AS x FROM r),
t AS (
  SELECT s.source, source_size, least(w * x, lim) AS target FROM s, share),
p AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS passes FROM t),
o AS (
  SELECT k.doc_id, k.size, p.source_size, p.target, p.passes, p.target - p.passes * p.source_size AS rest,
    sum(k.size) OVER (PARTITION BY k.source ORDER BY k.draw RANGE UNBOUNDED PRECEDING) AS upto,
    sum(k.size) OVER (PARTITION BY k.source, k.draw) AS own
  FROM k JOIN p ON k.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
  (passes * size + CASE WHEN upto - own < rest AND upto - own / 2.0 <= rest THEN size ELSE 0 END)::BIGINT AS taken
FROM o
"""

LINES = """
WITH l AS (
  SELECT doc_id, text, u.line, u.i FROM documents,
    (SELECT unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i) u),
f AS (
  SELECT doc_id, i, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line,
    row_number() OVER (PARTITION BY doc_id ORDER BY i) AS n
  FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
c AS (
  SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
    sum(len(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) OVER (PARTITION BY doc_id ORDER BY n) AS upto
  FROM f),
fw AS (
  SELECT a.doc_id, a.n AS s, min(b.n) AS e FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.n BETWEEN a.n AND a.n + 49
    AND b.upto - a.upto + a.words >= 50 GROUP BY ALL),
bw AS (
  SELECT a.doc_id, max(b.n) AS s, a.n AS e FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.n BETWEEN a.n - 49 AND a.n
    AND a.upto - b.upto + b.words >= 50 GROUP BY a.doc_id, a.n),
w AS (SELECT * FROM fw UNION SELECT * FROM bw),
t AS (
  SELECT w.doc_id, w.s, w.e, string_agg(c.line, chr(10) ORDER BY c.n) AS run
  FROM w JOIN c ON c.doc_id = w.doc_id AND c.n BETWEEN w.s AND w.e GROUP BY ALL),
g AS (
  SELECT *, first_value(doc_id) OVER o AS doc0, first_value(e) OVER o AS e0, row_number() OVER o AS k
  FROM t WINDOW o AS (PARTITION BY run ORDER BY doc_id, s)),
gone AS (
  SELECT DISTINCT c.doc_id, c.n FROM g JOIN c ON c.doc_id = g.doc_id AND c.n BETWEEN g.s AND g.e
    AND (g.doc_id <> g.doc0 OR c.n > g.e0) WHERE g.k > 1),
o AS (
  SELECT l.doc_id, count(f.n) AS n_lines, count(gone.n) AS n_removed,
    string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE gone.n IS NULL) AS kept
  FROM l LEFT JOIN f ON f.doc_id = l.doc_id AND f.i = l.i LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.n = f.n
  GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
  CASE WHEN n_removed > 0 THEN coalesce(kept, '') ELSE d.text END AS text
FROM documents d LEFT JOIN o ON o.doc_id = d.doc_id
"""

WARC = """
WITH p AS (
  SELECT page_id, url, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
r AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS top FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < top THEN top END AS refers_to, url
FROM r
"""

PHRASES = """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
g AS (
  SELECT lang, k, unnest([array_to_string(words[i:i + k - 1], ' ') FOR i IN range(1, len(words) - k + 2)]) AS gram
  FROM w, (SELECT unnest([1, 2, 3, 4]) AS k)),
f AS (SELECT lang, k, gram, count(*) AS f FROM g GROUP BY ALL),
sizes AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k AS size, gram, string_split(gram, ' ') AS words, f AS a FROM f WHERE k > 1 AND f >= 30),
cuts AS (SELECT *, unnest(range(1, size)) AS pos FROM c),
s AS (
  SELECT c.lang, c.gram, c.a, c.pos, l.f AS l, r.f AS r, (2000000::HUGEINT * c.a // (l.f + r.f)::HUGEINT)::BIGINT AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.gram = array_to_string(c.words[1:c.pos], ' ')
  JOIN f r ON r.lang = c.lang AND r.gram = array_to_string(c.words[c.pos + 1:], ' ')),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, pos) = 1),
inside AS (
  SELECT DISTINCT x.lang, x.gram FROM c x
  JOIN (SELECT lang, a, size, unnest([array_to_string(words[i:i + n - 1], ' ') FOR i IN range(1, size - n + 2)]) AS part
    FROM c, (SELECT unnest([2, 3]) AS n) WHERE n < size) y
    ON y.lang = x.lang AND y.part = x.gram AND 100::HUGEINT * y.a >= 80::HUGEINT * x.a),
o AS (
  SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.gram) AS rank,
    b.gram AS phrase, a, l, r, score
  FROM best b ANTI JOIN inside i ON i.lang = b.lang AND i.gram = b.gram)
SELECT o.lang, rank, phrase, a, l, r, n, score FROM o JOIN sizes USING (lang) WHERE rank <= 2000
"""


def all_sql() -> dict[str, str]:
    return {"op1_warc": WARC, "op3_mix_sources": MIX, "op4_line_dedup": LINES, "op13_phrase_mining": PHRASES}
