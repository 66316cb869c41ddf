"""The queries of ``table_queries`` as standalone SQL over the same tables, for checking results."""

from __future__ import annotations

from charloom.functions.text import WS_RANGES
from charloom.plans.table_queries import LEARNING_ROUNDS, MAX_TOTAL, SHARD_TOTAL, TOKEN_VOCABULARY, TOPIC_PHRASES, TOPIC_WEIGHTS, TOPIC_WORDS

WS = f"[{WS_RANGES}]"
LANG_RANK = "CASE lang WHEN 'en' THEN 0 WHEN 'es' THEN 1 WHEN 'fr' THEN 2 WHEN 'de' THEN 3 END"
QUOTA = -(-MAX_TOTAL // 4)
SHARD_QUOTA = -(-SHARD_TOTAL // 4)
WORDS = ", ".join(f"'{w}'" for w in TOPIC_WORDS)


def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{WS}+', ''), '{WS}+$', '')"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'), ' ')"


def filled(x: str) -> str:
    return f"regexp_matches({x}, '[^{WS_RANGES}]')"


def ascii_english(x: str) -> str:
    s = strip(x)
    other = f"length(regexp_replace({s}, '[\\x{{0}}-\\x{{7f}}]', '', 'g'))"
    return (
        f"CASE WHEN length({s}) < 3 THEN {other} = 0 "
        f"ELSE (length({s}) - {other})::DOUBLE / length({s}) > 0.9::DOUBLE END"
    )


def has_topic(x: str) -> str:
    return f"list_has_any(string_split_regex(lower({x}), '[^\\p{{L}}\\p{{N}}]+'), [{WORDS}])"


PHRASE_ROWS = ", ".join(
    f"('{t}', {p.split()}, {TOPIC_WEIGHTS[t]}::DOUBLE)" for t, phrases in TOPIC_PHRASES.items() for p in phrases
)
TOPICAL = f"""phrases(topic, p, weight) AS (VALUES {PHRASE_ROWS}),
word_lists AS (SELECT doc_id, lang,
    list_filter(string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS w FROM documents),
word_rows AS (SELECT doc_id, lang, w, unnest(range(1, len(w) + 1)) AS i FROM word_lists),
found AS (SELECT doc_id, lang, topic, weight, count(*) AS n FROM word_rows JOIN phrases
    ON w[i] = p[1] AND (len(p) = 1 OR w[i + 1] = p[2]) GROUP BY ALL)"""

DECOMPOSED = "replace(replace(text, chr(233), 'e' || chr(769)), chr(252), 'u' || chr(776))"

INSTRUCTIONS = """
asked AS (SELECT a.conv_id, a.turn, a.text AS instruction, b.text AS output
  FROM conversations a LEFT JOIN conversations b
    ON b.conv_id = a.conv_id AND b.turn = a.turn + 1 AND b.role = 'assistant'
  WHERE a.role = 'user'),
numbered AS (SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS pos, instruction, output FROM asked)"""

PAIR_ROWS = """
pair_rows AS (
  SELECT 'en-es' AS pair, lang, doc_id AS pos, text FROM documents WHERE lang IN ('en', 'es')
  UNION ALL
  SELECT 'fr-de', lang, doc_id, text FROM documents WHERE lang IN ('fr', 'de'))"""

MANIFEST = "manifest AS (SELECT lang, source AS shard, min(doc_id) AS pos FROM documents GROUP BY ALL)"
SHARDS = f"""{MANIFEST},
shards AS (SELECT lang, shard, (row_number() OVER (PARTITION BY lang ORDER BY pos))::INTEGER AS shard_rank
  FROM manifest),
sharded AS (
  SELECT d.doc_id AS pos, d.lang, s.shard_rank, d.text, coalesce(l.quality = 1, true) AS keep
  FROM documents d JOIN shards s ON s.lang = d.lang AND s.shard = d.source AND s.shard_rank <= 2
  LEFT JOIN labels l USING (doc_id)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, shard_rank ORDER BY pos) AS rn FROM sharded),
first_shard AS (SELECT * FROM ranked WHERE shard_rank = 1 AND rn <= {SHARD_QUOTA} AND keep),
taken AS (SELECT lang, count(*) AS n FROM first_shard GROUP BY lang),
second_shard AS (SELECT r.* FROM ranked r LEFT JOIN taken t USING (lang)
  WHERE shard_rank = 2 AND rn <= {SHARD_QUOTA} - coalesce(n, 0) AND keep),
budgeted AS (SELECT * FROM first_shard UNION ALL SELECT * FROM second_shard)"""

ANSWERS = """
gold AS (SELECT doc_id AS pos, lang, lower(substr(text, doc_id % 5 + 3, 1)) AS gold FROM documents),
pred AS (SELECT doc_id AS pos, substr(lower(substr(text, doc_id % 7 + 1, 4)), 1, 3) AS pred
  FROM documents WHERE doc_id % 5 <> 0),
scored AS (SELECT pos, lang, gold, coalesce(pred, '') AS pred, contains(coalesce(pred, ''), gold) AS hit
  FROM gold LEFT JOIN pred USING (pos))"""


def chars(name: str, src: str, keep: str = "") -> str:
    """Characters of ``src(id, t)`` with the ones before them."""
    k = f"{keep}, " if keep else ""
    return f"""
{name}_ch AS (SELECT id, {k}unnest(string_split(t, '')) AS ch, generate_subscripts(string_split(t, ''), 1) AS i
  FROM {src} WHERE length(t) > 0),
{name} AS (SELECT id, {k}i, ch, lag(ch, 1) OVER w AS p1, lag(ch, 2) OVER w AS p2, lag(ch, 3) OVER w AS p3,
  lag(ch, 4) OVER w AS p4 FROM {name}_ch WINDOW w AS (PARTITION BY id ORDER BY i))"""


def counts(name: str, src: str) -> str:
    """Counts of orders 1 to 3 as ``(ctx, ch, cnt)``."""
    return f"""{chars(name + "_pos", src)},
{name} AS (SELECT ctx, ch, count(*) AS cnt FROM (
  SELECT '' AS ctx, ch FROM {name}_pos
  UNION ALL SELECT p1, ch FROM {name}_pos WHERE i >= 2
  UNION ALL SELECT p2 || p1, ch FROM {name}_pos WHERE i >= 3) GROUP BY ctx, ch)"""


def tops(name: str, src: str, where: str = "true") -> str:
    return f"""
{name} AS (SELECT ctx, string_agg(ch, '' ORDER BY rk) AS tops FROM (
  SELECT ctx, ch, row_number() OVER (PARTITION BY ctx ORDER BY cnt DESC, ch) AS rk FROM {src} WHERE {where})
  WHERE rk <= 3 GROUP BY ctx)"""


def token_tops(name: str, pos: str) -> str:
    """``(ctx, tops)`` of the token path: two-character tokens summed by the first character they show."""
    token = strip("token")
    return f"""
{name}_last AS (SELECT * FROM {pos} QUALIFY row_number() OVER (PARTITION BY id ORDER BY i DESC) = 1),
{name}_n AS (SELECT ctx, token, count(*) AS cnt FROM (
  SELECT '' AS ctx, p1 || ch AS token FROM {pos} WHERE i >= 2
  UNION ALL SELECT p2, p1 || ch FROM {pos} WHERE i >= 3
  UNION ALL SELECT p3 || p2, p1 || ch FROM {pos} WHERE i >= 4
  UNION ALL SELECT '', ch FROM {name}_last
  UNION ALL SELECT p1, ch FROM {name}_last WHERE i >= 2
  UNION ALL SELECT p2 || p1, ch FROM {name}_last WHERE i >= 3) GROUP BY ALL),{first_char_tops(name)}"""


def first_char_tops(name: str) -> str:
    """``(ctx, tops)`` from the counted tokens ``{name}_n``."""
    token = strip("token")
    return f"""
{name}_lp AS (SELECT ctx, token, ln(cnt / (sum(cnt) OVER (PARTITION BY ctx))::DOUBLE) AS lp FROM {name}_n),
{name}_ok AS (SELECT ctx, substr({token}, 1, 1) AS ch, lp FROM (
    SELECT *, row_number() OVER (PARTITION BY ctx ORDER BY lp DESC, token) AS rk FROM {name}_lp)
  WHERE rk <= 5000 AND {token} <> '' AND ascii({token}) >= 32 AND substr({token}, 1, 1) <> chr(65533)),
{name}_sum AS (SELECT ctx, ch, max(m) + ln(sum(exp(lp - m))) AS lp
  FROM (SELECT *, max(lp) OVER (PARTITION BY ctx, ch) AS m FROM {name}_ok) GROUP BY ctx, ch),
{name} AS (SELECT ctx, string_agg(ch, '' ORDER BY rk) AS tops FROM (
  SELECT ctx, ch, row_number() OVER (PARTITION BY ctx ORDER BY round(lp, 9) DESC, ch) AS rk FROM {name}_sum)
  WHERE rk <= 3 GROUP BY ctx)"""


def longest_match(name: str, src: str, size: int) -> str:
    """``{name}_n``: tokens of ``src(id, t)`` by longest match after contexts of 0 to 2 characters, ``(ctx, token, cnt)``."""
    return f"""{chars(name + "_gram", src)},
{name}_vocab AS (SELECT token, count(*) AS cnt FROM (
  SELECT p1 || ch AS token FROM {name}_gram WHERE i >= 2 UNION ALL SELECT p2 || p1 || ch FROM {name}_gram WHERE i >= 3
  UNION ALL SELECT p3 || p2 || p1 || ch FROM {name}_gram WHERE i >= 4)
  GROUP BY token ORDER BY count(*) DESC, token LIMIT {size}),
{name}_pattern AS (SELECT string_agg(regexp_escape(token), '|' ORDER BY length(token) DESC, token) || '|(?s:.)' AS pattern
  FROM {name}_vocab),
{name}_cut AS (SELECT id, regexp_extract_all(t, pattern) AS w FROM {src}, {name}_pattern WHERE t <> ''),
{name}_flat AS (SELECT id, unnest(w) AS token, generate_subscripts(w, 1) AS i FROM {name}_cut),
{name}_full AS (SELECT right(coalesce(lag(token, 2) OVER o, '') || coalesce(lag(token) OVER o, ''), 2) AS ctx, token
  FROM {name}_flat WINDOW o AS (PARTITION BY id ORDER BY i)),
{name}_n AS (SELECT right(ctx, k) AS ctx, token, count(*) AS cnt
  FROM {name}_full JOIN (VALUES (0), (1), (2)) o(k) ON k <= length(ctx) GROUP BY ALL)"""


def lookup(name: str, src: str, key: str, text: str, top: str, fallback: str = "") -> str:
    """Three guesses per row of ``src``: longest context first, then shorter ones, then ``fallback``."""
    return f"""
{name}_c AS (SELECT {key}, coalesce(a.tops, '') || coalesce(b.tops, '') ||
    coalesce((SELECT tops FROM {top} WHERE ctx = ''), '') || '{fallback}' AS c
  FROM {src} LEFT JOIN {top} a ON length({text}) >= 2 AND a.ctx = right({text}, 2)
  LEFT JOIN {top} b ON length({text}) >= 1 AND b.ctx = right({text}, 1)),
{name}_u AS (SELECT {key}, ch, min(i) AS i FROM (
  SELECT {key}, unnest(string_split(c, '')) AS ch, generate_subscripts(string_split(c, ''), 1) AS i
  FROM {name}_c) GROUP BY {key}, ch),
{name} AS (SELECT {key}, string_agg(ch, '' ORDER BY i) AS guesses FROM (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY i) AS rk FROM {name}_u)
  WHERE rk <= 3 GROUP BY {key})"""


ALL_LINES = f"""
all_lines AS (SELECT doc_id, lang, {collapse("text")} AS t FROM documents),
every AS (SELECT *, greatest(least(5, length(t) - 1), 0) AS low FROM all_lines),
prompt_lines AS (SELECT doc_id, lang, t, low + (doc_id * 7919) % greatest(length(t) - low, 1) AS cut FROM every),
lines AS (SELECT * FROM prompt_lines WHERE t <> '')"""

PROMPTS = "prompts AS (SELECT doc_id AS pos, lang, substr(t, 1, cut) AS text, substr(t, cut + 1, 1) AS gold FROM {src})"

HELDOUT = f"""{ALL_LINES},
shuffled AS (SELECT *, row_number() OVER (ORDER BY substr(md5('42:' || doc_id), 1, 15)) AS rk,
  count(*) OVER () AS n FROM lines),
split AS (SELECT *, n >= 20 AND rk <= ceil(n * 0.05::DOUBLE) AS test FROM shuffled),
train AS (SELECT doc_id AS id, lang, t FROM split WHERE NOT test),
test AS (SELECT doc_id, doc_id AS id, lang, t, cut FROM split WHERE test)"""

HEAD_HELDOUT = f"""{ALL_LINES},
train AS (SELECT doc_id AS id, lang, t FROM lines WHERE doc_id >= 100),
test AS (SELECT doc_id AS id, lang, t FROM lines WHERE doc_id < 100)"""

DOCUMENT_MODEL = "model_src AS (SELECT doc_id AS id, text AS t FROM documents), " + counts("model", "model_src")


def detector(inputs: str, source: str = "SELECT doc_id AS id, lang, text AS t FROM documents") -> str:
    """``detected(id, n_grams, detected)`` for ``inputs(id, t)`` with profiles of ``source(id, lang, t)``."""
    return f"""
prof_src AS (SELECT id, lang, {strip('t')} AS t FROM ({source})),
{chars("prof_pos", "prof_src", "lang")},
prof_cnt AS (SELECT lang, p2 || p1 || ch AS g, count(*) AS c FROM prof_pos WHERE i >= 3 GROUP BY ALL),
prof_size AS (SELECT lang, sum(c)::BIGINT + count(*) AS d FROM prof_cnt GROUP BY lang),
floors AS (SELECT min(round(ln(1 / d::DOUBLE) * 1000)::BIGINT) AS floor FROM prof_size),
prof AS (SELECT lang, g, round(ln((c + 1) / d::DOUBLE) * 1000)::BIGINT - (SELECT floor FROM floors) AS gain
  FROM prof_cnt JOIN prof_size USING (lang)),
det_src AS (SELECT id, {strip("t")} AS t FROM {inputs}),
{chars("det_pos", "det_src")},
det_gram AS (SELECT id, p2 || p1 || ch AS g FROM det_pos WHERE i >= 3),
det_n AS (SELECT id, count(*) AS n_grams FROM det_gram GROUP BY id),
det_gain AS (SELECT id, lang, sum(gain)::BIGINT AS gain FROM det_gram JOIN prof USING (g) GROUP BY ALL),
det_best AS (SELECT id, lang FROM det_gain WHERE gain > 0
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY gain DESC, {LANG_RANK}) = 1),
detected AS (SELECT id, n_grams, lang AS detected FROM det_n LEFT JOIN det_best USING (id))"""


def english(text: str, detected: str) -> str:
    s = strip(text)
    return (
        f"CASE WHEN length({s}) < 3 THEN NOT regexp_matches({s}, '[^\\x{{0}}-\\x{{7f}}]') "
        f"ELSE coalesce({detected} = 'en', {ascii_english(text)}) END"
    )


# Held-out or queried grams of ``{held}(g, cnt, ...)`` with the evidence of each order in ``model``.
def evidence(held: str, model: str) -> str:
    return f"""
totals AS (SELECT ctx, sum(cnt)::BIGINT AS total FROM {model} GROUP BY ctx),
vocab AS (SELECT count(*) AS v, sum(cnt)::BIGINT AS n FROM {model} WHERE ctx = ''),
ev AS (SELECT h.*, v, n AS t1, coalesce(m1.cnt, 0) AS c1,
    coalesce(m2.cnt, 0) AS c2, coalesce(x2.total, 0) AS t2,
    coalesce(m3.cnt, 0) AS c3, coalesce(x3.total, 0) AS t3
  FROM {held} h CROSS JOIN vocab
  LEFT JOIN {model} m1 ON m1.ctx = '' AND m1.ch = right(g, 1)
  LEFT JOIN {model} m2 ON length(g) >= 2 AND m2.ctx = substr(g, length(g) - 1, 1) AND m2.ch = right(g, 1)
  LEFT JOIN totals x2 ON length(g) >= 2 AND x2.ctx = substr(g, length(g) - 1, 1)
  LEFT JOIN {model} m3 ON length(g) = 3 AND m3.ctx = substr(g, 1, 2) AND m3.ch = right(g, 1)
  LEFT JOIN totals x3 ON length(g) = 3 AND x3.ctx = substr(g, 1, 2)),
ev1 AS (SELECT *, 0.7::DOUBLE * c1 / t1 + 0.3::DOUBLE / v AS i1, c1::DOUBLE / t1 AS s1 FROM ev),
ev2 AS (SELECT *, CASE WHEN length(g) >= 2 AND t2 > 0 THEN 0.7::DOUBLE * c2 / t2 + 0.3::DOUBLE * i1 ELSE i1 END AS i2,
    CASE WHEN c2 > 0 THEN c2::DOUBLE / t2 ELSE 0.4::DOUBLE * s1 END AS s2 FROM ev1),
ev3 AS (SELECT *, CASE WHEN length(g) = 3 AND t3 > 0 THEN 0.7::DOUBLE * c3 / t3 + 0.3::DOUBLE * i2 ELSE i2 END AS interp,
    CASE WHEN c3 > 0 THEN c3::DOUBLE / t3 ELSE 0.4::DOUBLE * s2 END AS backoff,
    CASE length(g) WHEN 1 THEN (c1 + 1)::DOUBLE / (t1 + v) WHEN 2 THEN (c2 + 1)::DOUBLE / (t2 + v)
      ELSE (c3 + 1)::DOUBLE / (t3 + v) END AS addk FROM ev2)"""


def kneser_ney(held: str) -> str:
    """``kn_p(..., p)`` for the grams of ``{held}(g, ...)`` under ``model`` by modified Kneser-Ney smoothing."""
    t = ", ".join(f"(count(*) FILTER (a = {j}))::DOUBLE AS t{j}" for j in (1, 2, 3, 4))
    d = ", ".join(
        f"least(greatest(CASE WHEN t{j} > 0 THEN {j} - {j + 1} * y * t{j + 1} / t{j} ELSE y END, 0), {j}) AS d{j}" for j in (1, 2, 3)
    )
    return f"""
kn_g AS (SELECT ctx || ch AS g, ctx, length(ctx) + 1 AS o, cnt FROM model),
kn_l AS (SELECT substr(g, 2) AS s, count(*) AS lefts, sum(cnt) AS inside FROM kn_g WHERE o > 1 GROUP BY ALL),
kn_a AS (SELECT g, ctx, o, CASE WHEN o = 3 THEN cnt ELSE coalesce(lefts, 0) + (cnt > coalesce(inside, 0))::INT END AS a
  FROM kn_g LEFT JOIN kn_l ON s = g),
kn_t AS (SELECT o, {t} FROM kn_a GROUP BY o),
kn_d AS (SELECT o, {d} FROM (SELECT *, CASE WHEN t1 > 0 THEN t1 / (t1 + 2 * t2) ELSE 0.5::DOUBLE END AS y FROM kn_t)),
kn_m AS (SELECT g, ctx, a, CASE WHEN a = 1 THEN d1 WHEN a = 2 THEN d2 ELSE d3 END AS d FROM kn_a JOIN kn_d USING (o)),
kn_c AS (SELECT ctx, sum(a)::DOUBLE AS total, sum(d) / sum(a)::DOUBLE AS back FROM kn_m GROUP BY ctx),
kn AS (SELECT g, (a - d) / total AS own FROM kn_m JOIN kn_c USING (ctx)),
kn_e AS (SELECT h.*, (SELECT count(*) FROM model WHERE ctx = '')::DOUBLE AS v,
    k1.own AS o1, k2.own AS o2, k3.own AS o3, (SELECT back FROM kn_c WHERE ctx = '') AS b1, b2.back AS b2, b3.back AS b3
  FROM {held} h LEFT JOIN kn k1 ON k1.g = right(h.g, 1)
  LEFT JOIN kn k2 ON length(h.g) >= 2 AND k2.g = right(h.g, 2)
  LEFT JOIN kn_c b2 ON length(h.g) >= 2 AND b2.ctx = substr(h.g, length(h.g) - 1, 1)
  LEFT JOIN kn k3 ON length(h.g) = 3 AND k3.g = h.g
  LEFT JOIN kn_c b3 ON length(h.g) = 3 AND b3.ctx = substr(h.g, 1, 2)),
kn_p AS (SELECT *, coalesce(o3, 0) + coalesce(b3, 1) * (coalesce(o2, 0) + coalesce(b2, 1) * (coalesce(o1, 0) + b1 / v)) AS p
  FROM kn_e)"""


def parts(name: str, src: str) -> str:
    """``{name}`` with what each order says of a gram (``q0 .. q3``) and the gram's bucket, from evidence rows ``{src}``."""
    return f"""
{name}_1 AS (SELECT *, 1 / v::DOUBLE AS q0, c1 / t1::DOUBLE AS q1 FROM {src}),
{name}_2 AS (SELECT *, CASE WHEN length(g) >= 2 AND t2 > 0 THEN c2 / t2::DOUBLE ELSE q1 END AS q2 FROM {name}_1),
{name} AS (SELECT *, CASE WHEN length(g) = 3 AND t3 > 0 THEN c3 / t3::DOUBLE ELSE q2 END AS q3,
  CASE WHEN length(g) = 3 AND t3 > 0 THEN length(t3::VARCHAR) ELSE 0 END AS bucket FROM {name}_2)"""


MIXED = "a0 * q0 + a1 * q1 + a2 * q2 + a3 * q3"


def learnt_weights(name: str, src: str) -> str:
    """``{name}(bucket, a0 .. a3)`` after the set rounds of expectation-maximisation over ``{src}(cnt, q0 .., bucket)``."""
    equal = ", ".join(f"0.25::DOUBLE AS a{o}" for o in range(4))
    rounds = [f"{name}_0 AS (SELECT DISTINCT bucket, {equal} FROM {src})"]
    for r in range(1, LEARNING_ROUNDS + 1):
        shares = ", ".join(f"sum(cnt * a{o} * q{o} / p) / sum(cnt)::DOUBLE AS a{o}" for o in range(4))
        out = name if r == LEARNING_ROUNDS else f"{name}_{r}"
        rounds.append(f"""{out} AS MATERIALIZED (SELECT bucket, {shares}
  FROM (SELECT *, {MIXED} AS p FROM {src} JOIN {name}_{r - 1} USING (bucket)) GROUP BY bucket)""")
    return ",\n".join(rounds)


def full_grams(name: str, pos: str, keep: str = "") -> str:
    k = f"{keep}, " if keep else ""
    return f"""
{name} AS (SELECT {k}coalesce(p2, '') || coalesce(p1, '') || ch AS g, count(*) AS cnt FROM {pos} GROUP BY ALL)"""


BENCHMARK_GRAMS = f"""{DOCUMENT_MODEL}, held_src AS (SELECT item_id AS id, text AS t FROM benchmark),
{chars("held_pos", "held_src")}, {full_grams("held", "held_pos")}"""

CONVERSATION_GRAMS = f"""
held_src AS (SELECT row_number() OVER () AS id, role, text AS t FROM conversations),
{chars("held_pos", "held_src", "role")}, {full_grams("held", "held_pos", "role")}"""

ROLE_PERPLEXITY = """SELECT role, n, round(loss, 6) AS loss,
  round(CASE WHEN loss < 50 THEN exp(loss) ELSE 'inf'::DOUBLE END, 5) AS ppl FROM losses"""

CONVERSATION_EVIDENCE = f"WITH {CONVERSATION_GRAMS}, {evidence('held', 'model')} SELECT * FROM ev"

def quota_sql(rows: str, q: int, total: int, cols: str, text: str = "text") -> str:
    """``cols`` of the first ``q`` rows per language, cut to ``total`` in language order."""
    return f"""
kept AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY pos) AS rn FROM ({rows})),
ordered AS (SELECT *, row_number() OVER (ORDER BY {LANG_RANK}, pos) AS place FROM kept WHERE rn <= {q})
SELECT {cols} FROM ordered WHERE place <= {total}"""


def trimmed(cap: int) -> str:
    return f"""{PAIR_ROWS},
sides AS (SELECT pair, lang, count(*) AS n FROM pair_rows GROUP BY ALL),
shorter AS (SELECT pair, greatest(0, min(n) - {cap}) AS skip FROM sides GROUP BY pair),
side_rank AS (SELECT *, row_number() OVER (PARTITION BY pair, lang ORDER BY pos) AS r FROM pair_rows),
trimmed AS (SELECT s.* FROM side_rank s JOIN shorter USING (pair) WHERE r > skip AND r <= skip + {cap})"""


def head_sql(files: list[str], n: int, cols: str, rows: str) -> str:
    rank = " ".join(f"WHEN '{f}' THEN {i}" for i, f in enumerate(files))
    listed = ", ".join(f"'{f}'" for f in files)
    return f"""
SELECT {cols} FROM (SELECT *, row_number() OVER (ORDER BY CASE lang {rank} END, pos) AS r
  FROM ({rows}) WHERE lang IN ({listed})) WHERE r <= {n}"""


DOC_ROWS = "SELECT doc_id AS pos, lang, text FROM documents"
GAPPED = "SELECT doc_id AS pos, lang, CASE WHEN doc_id % 3 = 0 THEN ' ' ELSE text END AS text FROM documents"
WEB_TEXT = f"substr({collapse('nfc_normalize(text)')}, 1, 8000)"
NUMBERED_DOCS = f"SELECT row_number() OVER (ORDER BY doc_id) - 1 AS pos, {collapse('text')} AS text FROM documents"
PHYSICAL = """
phys AS (SELECT doc_id, unnest(string_split_regex(text, '\\r\\n|\\r|\\n')) AS line,
  generate_subscripts(string_split_regex(text, '\\r\\n|\\r|\\n'), 1) AS i FROM documents),
phys_pos AS (SELECT row_number() OVER (ORDER BY doc_id, i) - 1 AS pos, line FROM phys)"""
BYTES = "bytes AS (SELECT unnest(regexp_extract_all(hex(text), '..')) AS b FROM documents)"
FLAT = f"""
flat AS (SELECT conv_id, string_agg({collapse("text")}, ' ' ORDER BY turn) AS text
  FROM conversations WHERE {filled("text")} GROUP BY conv_id)"""
SPLIT_ASCII = f"""SELECT {ascii_english("text")} AS is_english, count(*) AS n
  FROM documents WHERE {filled("text")} GROUP BY 1"""
TRIGRAMS = f"""tri_src AS (SELECT doc_id AS id, lang, text AS t FROM documents), {chars("tri_pos", "tri_src", "lang")}"""


def route_sql(inputs: str, english_src: str, other_src: str) -> str:
    return f"""
{counts("en_model", english_src)}, {tops("en_top", "en_model", "strlen(ch) = 1 AND ascii(ch) BETWEEN 32 AND 127")},
{counts("ot_model", other_src)},
{token_tops("ot_top", "ot_model_pos")},
{lookup("en_guess", f"(SELECT * FROM {inputs} WHERE is_english)", "pos", "text", "en_top", " .eta")},
{lookup("ot_guess", f"(SELECT * FROM {inputs} WHERE NOT is_english)", "pos", "text", "ot_top", "天气快不错吗")},
routed AS (SELECT * FROM en_guess UNION ALL SELECT * FROM ot_guess)"""


def or_empty(guesses: str) -> str:
    return f"CASE WHEN text <> '' THEN {guesses} WHEN is_english THEN 'eta' ELSE '天气快' END"


def detected_lines() -> str:
    return f"""inputs AS (SELECT doc_id AS id, {strip("text")} AS t FROM documents
            WHERE lang IN ('en', 'es', 'fr', 'de') AND {filled("text")}), {detector("inputs")},
          lines AS (SELECT id, CASE WHEN lang IN ('en', 'es') THEN 0 ELSE 1 END AS source_rank, t
            FROM inputs JOIN documents ON doc_id = id)"""


def train_eval(split: str, p: str, loss: str = "-ln({p})") -> str:
    return f"""WITH {split}, {counts("model", "train")}, {chars("held_pos", "test", "lang")},
          {full_grams("held", "held_pos", "lang")}, {evidence("held", "model")},
          losses AS (SELECT lang, sum(cnt)::BIGINT AS n, sum(({loss.format(p=p)}) * cnt) / sum(cnt) AS loss FROM ev3 GROUP BY lang),
          {tops("top", "model")},
          asked AS (SELECT lang, cnt, substr(g, 1, length(g) - 1) AS key, right(g, 1) AS gold FROM held),
          keys AS (SELECT DISTINCT key FROM asked), {lookup("guess", "keys", "key", "key", "top")},
          accurate AS (SELECT lang, coalesce(sum(cnt) FILTER (guesses[1] = gold), 0) / sum(cnt)::DOUBLE AS accuracy
            FROM asked JOIN guess USING (key) GROUP BY lang)
          SELECT lang, n, round(loss, 6) AS loss, round(accuracy, 6) AS accuracy,
            round(CASE WHEN loss < 50 THEN exp(loss) ELSE 'inf'::DOUBLE END, 5) AS ppl FROM losses JOIN accurate USING (lang)"""


def all_sql() -> dict[str, str]:
    return {
        "read_lines": NUMBERED_DOCS,
        "read_corpus_lines": f"WITH {PHYSICAL} SELECT pos, {strip('line')} AS text FROM phys_pos WHERE {filled('line')}",
        "read_jsonl_docs": f"""SELECT {strip("text")} AS text, quality * 0.5::DOUBLE AS id_score
          FROM documents LEFT JOIN labels USING (doc_id) WHERE doc_id % 10 > 1 AND {filled("text")}""",
        "read_conversation_json": f"""WITH {FLAT} SELECT row_number() OVER (ORDER BY conv_id) - 1 AS pos,
            conv_id::VARCHAR AS id, coalesce(text, '') AS text
          FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN flat USING (conv_id)""",
        "read_conversation_array": f"""WITH {FLAT} SELECT row_number() OVER (ORDER BY conv_id) - 1 AS pos,
            conv_id::VARCHAR AS id, coalesce(text, '') AS text
          FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN flat USING (conv_id)""",
        "read_instruction_pairs": f"WITH {INSTRUCTIONS} SELECT * FROM numbered",
        "read_parallel_text": """SELECT CASE WHEN lang IN ('en', 'fr') THEN 'en-fr' ELSE 'es-de' END AS pair, lang,
            row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos,
            regexp_replace(text, '\\r\\n|[\\r\\n]', ' ', 'g') AS text
          FROM documents""",
        "read_language_configs": """SELECT lang,
            CASE lang WHEN 'en' THEN 0 WHEN 'es' THEN 2 WHEN 'fr' THEN 3 ELSE 4 END AS lang_rank,
            count(*) AS n, sum(length(text))::BIGINT AS chars, 0::BIGINT AS first_pos, count(*) - 1 AS last_pos,
            count(*) AS positions FROM documents GROUP BY lang""",
        "select_shards": f"""WITH {MANIFEST} SELECT lang, shard, shard_rank::INTEGER AS shard_rank FROM (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY pos) AS shard_rank FROM manifest)
          WHERE shard_rank <= 2""",
        "concat_corpora": f"""SELECT CASE lang WHEN 'fr' THEN 0 WHEN 'en' THEN 1 WHEN 'de' THEN 2 ELSE 3 END AS source_rank,
            doc_id, text FROM documents WHERE {filled("text")}""",
        "write_lines": """SELECT row_number() OVER (ORDER BY lang, doc_id) - 1 AS pos,
            regexp_replace(text, '\\r\\n|[\\r\\n]', ' ', 'g') AS text FROM documents""",
        "write_language_split": f"""SELECT CASE WHEN is_english THEN 'docs_english' ELSE 'docs_non_english' END AS split,
            n FROM ({SPLIT_ASCII})""",
        "write_split_manifest": f"""SELECT CASE WHEN {ascii_english("text")} THEN 'docs_english' ELSE 'docs_non_english' END AS split,
            count(*) AS n, sum(strlen(regexp_replace({strip("text")}, '\\r\\n|[\\r\\n]', ' ', 'g')) + 1)::BIGINT AS n_bytes,
            min(doc_id) AS first_doc, max(doc_id) AS last_doc
          FROM documents WHERE {filled("text")} GROUP BY 1""",
        "write_predictions": """SELECT doc_id AS pos, CASE WHEN doc_id % 5 = 0 THEN 'eta'
            ELSE translate(substr(text, doc_id % 7 + 1, 4), chr(13) || chr(10), '__') END AS pred FROM documents""",
        "write_if_absent": NUMBERED_DOCS,
        "strip_ws": f"SELECT doc_id, {strip('text')} AS text FROM documents",
        "collapse_ws": f"SELECT doc_id, {collapse('text')} AS text FROM documents",
        "nfc": f"SELECT doc_id, nfc_normalize({DECOMPOSED}) AS text FROM documents",
        "cap_chars": f"SELECT doc_id, substr({collapse('text')}, 1, 8000) AS text FROM documents",
        "decode_utf8_lossy": "SELECT doc_id, text || chr(65533) || lang AS text FROM documents",
        "concat_instruction_output": f"""WITH {INSTRUCTIONS} SELECT conv_id, turn,
            {collapse("coalesce(instruction, '') || ' ' || coalesce(output, '')")} AS text FROM asked""",
        "byte_tokens": f"WITH {BYTES} SELECT ('0x' || b)::INTEGER + 4 AS token, count(*) AS n FROM bytes GROUP BY 1",
        "truncate_tokens": """SELECT doc_id, least(strlen(text), 1024) AS n_tokens,
            CASE WHEN strlen(text) > 0
              THEN ('0x' || substr(hex(text), 2 * least(strlen(text), 1024) - 1, 2))::BIGINT + 4 END AS last_token
          FROM documents""",
        "next_char_pairs": f"WITH {TRIGRAMS} SELECT lang, ch, count(*) AS n FROM tri_pos WHERE i >= 3 GROUP BY ALL",
        "fold_guess": "SELECT doc_id, substr(lower(text), 1, 3) AS guess FROM documents",
        "non_blank": f"""SELECT doc_id, count(*) AS n_lines, count(*) FILTER ({filled("line")}) AS n_non_blank
          FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY doc_id""",
        "min_chars": f"""SELECT doc_id, length({strip("text")}) >= 10 AS web,
            length({strip("text")}) >= 20 AS encyclopedia FROM documents""",
        "min_chars_after_nfc": f"""SELECT doc_id, chars::INTEGER AS chars FROM (
            SELECT doc_id, length(nfc_normalize({strip(DECOMPOSED)})) AS chars FROM documents) WHERE chars >= 20""",
        "is_conversational": """SELECT event_type, count(*) AS n, count(*) FILTER (
              WHERE props IS NULL OR coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) >= 50, false)) AS n_keep
          FROM events GROUP BY event_type""",
        "drop_malformed_json": """SELECT event_type, count(*) AS n FROM events
          WHERE json_valid(CASE WHEN event_id % 7 = 0 THEN substr(props, 1, length(props) - 1) ELSE props END)
          GROUP BY event_type""",
        "is_english_ascii": f"SELECT doc_id, {ascii_english('text')} AS is_english FROM documents",
        "detect_language": f"""WITH inputs AS (SELECT doc_id AS id, text AS t FROM documents), {detector("inputs")}
          SELECT id AS doc_id, n_grams, detected FROM detected""",
        "is_english": f"""WITH inputs AS (SELECT doc_id AS id, text AS t FROM documents), {detector("inputs")}
          SELECT lang, {english("text", "detected")} AS is_english, count(*) AS n
          FROM documents LEFT JOIN detected ON id = doc_id GROUP BY ALL""",
        "printable_candidate": f"""WITH u AS (SELECT unnest(string_split(text, '')) AS ch FROM documents WHERE length(text) > 0)
          SELECT ch, count(*) AS cnt FROM u
          WHERE {strip("ch")} <> '' AND ascii({strip("ch")}) >= 32 AND ch <> chr(65533) GROUP BY ch""",
        "single_byte_candidate": f"""WITH {BYTES} SELECT ('0x' || b)::BIGINT AS byte, count(*) AS n FROM bytes
          GROUP BY 1 HAVING byte BETWEEN 32 AND 127""",
        "utf8_audit": """WITH c AS (SELECT lang, unnest(string_split(text, '')) AS ch FROM documents WHERE length(text) > 0),
          per AS (SELECT lang, count(*) FILTER (strlen(ch) = 1) AS chars_1, count(*) FILTER (strlen(ch) = 2) AS chars_2,
            count(*) FILTER (strlen(ch) = 3) AS chars_3, count(*) FILTER (strlen(ch) = 4) AS chars_4 FROM c GROUP BY lang)
          SELECT lang, count(*) AS n_rows, 0::BIGINT AS invalid_rows, any_value(chars_1) AS chars_1,
            any_value(chars_2) AS chars_2, any_value(chars_3) AS chars_3, any_value(chars_4) AS chars_4
          FROM documents JOIN per USING (lang) GROUP BY lang""",
        "domain_filter": f"SELECT doc_id, lang FROM documents WHERE NOT {has_topic('text')}",
        "domain_weight": f"""SELECT doc_id, CASE WHEN {has_topic("text")} THEN 0.25::DOUBLE ELSE 1::DOUBLE END AS weight
          FROM documents""",
        "token_vocabulary": f"""WITH tok_src AS (SELECT doc_id AS id, text AS t FROM documents),
          {longest_match("tok", "tok_src", TOKEN_VOCABULARY)} SELECT token, cnt FROM tok_vocab""",
        "token_counts": f"""WITH tok_src AS (SELECT doc_id AS id, text AS t FROM documents),
          {longest_match("tok", "tok_src", TOKEN_VOCABULARY)} SELECT ctx, token, cnt FROM tok_n""",
        "marginalise_tokens": f"""WITH tok_src AS (SELECT doc_id AS id, text AS t FROM documents),
          {longest_match("tok", "tok_src", TOKEN_VOCABULARY)}, {first_char_tops("tok")}
          SELECT ctx, ch, round(lp, 6) + 0::DOUBLE AS logprob FROM tok_sum""",
        "dense_routed_success": f"""WITH {HELDOUT},
          en_src AS (SELECT id, t FROM train WHERE lang = 'en'), ot_src AS (SELECT id, t FROM train WHERE lang <> 'en'),
          {counts("en_model", "en_src")}, {tops("en_top", "en_model", "strlen(ch) = 1 AND ascii(ch) BETWEEN 32 AND 127")},
          {longest_match("ot_top", "ot_src", TOKEN_VOCABULARY)}, {first_char_tops("ot_top")},
          flagged AS (SELECT id, t, lang, {ascii_english("t")} AS is_english FROM test),
          {chars("held_pos", "flagged", "lang, is_english")},
          keyed AS (SELECT lang, is_english, coalesce(p2, '') || coalesce(p1, '') AS key, ch AS gold, count(*) AS cnt
            FROM held_pos GROUP BY ALL),
          en_keys AS (SELECT DISTINCT key FROM keyed WHERE is_english), {lookup("en_guess", "en_keys", "key", "key", "en_top", " .eta")},
          ot_keys AS (SELECT DISTINCT key FROM keyed WHERE NOT is_english),
          {lookup("ot_guess", "ot_keys", "key", "key", "ot_top", "天气快不错吗")},
          graded AS (SELECT keyed.*, lower(guesses) AS pred FROM keyed JOIN en_guess USING (key) WHERE is_english
            UNION ALL SELECT keyed.*, lower(guesses) FROM keyed JOIN ot_guess USING (key) WHERE NOT is_english)
          SELECT lang, is_english, sum(cnt)::BIGINT AS n,
            coalesce(sum(cnt) FILTER (contains(substr(pred, 1, 3), lower(gold))), 0)::BIGINT AS hits,
            coalesce(sum(cnt) FILTER (substr(pred, 1, 1) = lower(gold)), 0)::BIGINT AS top1_hits
          FROM graded GROUP BY ALL""",
        "topic_hits": f"""WITH {TOPICAL} SELECT lang, topic, count(*) AS n_docs, sum(n)::BIGINT AS n_hits FROM found GROUP BY ALL""",
        "topic_weight": f"""WITH {TOPICAL}, least_of AS (SELECT doc_id, min(weight) AS weight FROM found GROUP BY ALL)
          SELECT doc_id, coalesce(weight, 1::DOUBLE) AS weight FROM documents LEFT JOIN least_of USING (doc_id)""",
        "domain_semi": f"SELECT doc_id, lang FROM documents WHERE {has_topic('text')}",
        "domain_anti": f"SELECT doc_id, lang FROM documents WHERE NOT {has_topic('text')}",
        "score_join": f"WITH {ANSWERS} SELECT pos, gold, pred, hit FROM scored",
        "align_pairs": f"""WITH {PAIR_ROWS},
          r AS (SELECT *, row_number() OVER (PARTITION BY pair, lang ORDER BY pos) - 1 AS rank FROM pair_rows)
          SELECT a.pair, a.rank, a.pos AS pos_1, b.pos AS pos_2, length(a.text)::INTEGER AS len_1,
            length(b.text)::INTEGER AS len_2
          FROM r a JOIN r b ON a.pair = b.pair AND a.rank = b.rank
          WHERE a.lang = string_split(a.pair, '-')[1] AND b.lang = string_split(a.pair, '-')[2]""",
        "route_predict": f"""WITH {ALL_LINES}, {PROMPTS.format(src="prompt_lines")},
          inputs AS (SELECT *, {ascii_english("text")} AS is_english FROM prompts),
          en_src AS (SELECT doc_id AS id, text AS t FROM documents WHERE lang = 'en'),
          ot_src AS (SELECT doc_id AS id, text AS t FROM documents WHERE lang <> 'en'),
          {route_sql("inputs", "en_src", "ot_src")}
          SELECT pos, is_english, {or_empty("guesses")} AS pred FROM routed JOIN inputs USING (pos)""",
        "ngram_backoff_lookup": f"""WITH {DOCUMENT_MODEL}, {tops("top", "model")}, {ALL_LINES}, {PROMPTS.format(src="prompt_lines")},
          keys AS (SELECT DISTINCT right(text, 2) AS key FROM prompts),
          {lookup("guess", "keys", "key", "key", "top")} SELECT key, guesses FROM guess""",
        "split_counts": SPLIT_ASCII,
        "split_counts_python": f"""SELECT NOT regexp_matches(text, '[^\\x{{0}}-\\x{{7f}}]') AS is_english, count(*) AS n
          FROM documents WHERE {filled("text")} GROUP BY 1""",
        "tokenize_batches": """SELECT doc_id, least(strlen(text), 1024) AS n_tokens,
            CASE WHEN strlen(text) > 0
              THEN ('0x' || substr(hex(text), 2 * least(strlen(text), 1024) - 1, 2))::BIGINT END AS last_token
          FROM documents""",
        "line_count_non_blank": f"""SELECT source AS file, count(*) FILTER (line >= 10 AND {filled("text")}) AS n FROM (
            SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS line FROM documents)
          GROUP BY source""",
        "pair_min_count": f"""WITH {PAIR_ROWS}, sides AS (SELECT pair, lang, count(*) AS n FROM pair_rows GROUP BY ALL)
          SELECT pair, min(n) AS min_count FROM sides GROUP BY pair""",
        "token_batch_stats": """SELECT lang, count(*) AS n_rows, sum(strlen(text))::BIGINT AS tokens,
            count(*) FILTER (strlen(text) > 1024) AS clipped_rows, 1024::BIGINT AS aligned_limit,
            sum(ceil(least(strlen(text), 1024) / 64.0) * 64 - least(strlen(text), 1024))::BIGINT AS padding,
            greatest(1, count(*) // 32) AS steps FROM documents GROUP BY lang""",
        "flatten_conversation": f"WITH {FLAT} SELECT conv_id, text FROM flat",
        "success_rate": f"""WITH {ANSWERS} SELECT lang, count(*) AS n, count(*) FILTER (hit) AS hits,
            round(count(*) FILTER (hit) / count(*)::DOUBLE, 6) AS success_rate FROM scored GROUP BY lang""",
        "top1_accuracy": f"""WITH {ANSWERS} SELECT lang, count(*) AS n, count(*) FILTER (substr(pred, 1, 1) = gold) AS top1_hits,
            round(count(*) FILTER (substr(pred, 1, 1) = gold) / count(*)::DOUBLE, 6) AS top1_accuracy
          FROM scored GROUP BY lang""",
        "marginalise_first_char": f"""WITH {TRIGRAMS},
          pairs AS (SELECT p3 || p2 AS ctx, p1 || ch AS token, count(*) AS cnt FROM tri_pos WHERE i >= 4 GROUP BY ALL),
          lp AS (SELECT ctx, token, ln(cnt / (sum(cnt) OVER (PARTITION BY ctx))::DOUBLE) AS lp FROM pairs),
          best AS (SELECT *, row_number() OVER (PARTITION BY ctx ORDER BY lp DESC, token) AS rk FROM lp),
          ok AS (SELECT ctx, substr({strip("token")}, 1, 1) AS ch, lp FROM best
            WHERE rk <= 5000 AND {strip("token")} <> '' AND ascii({strip("token")}) >= 32
              AND substr({strip("token")}, 1, 1) <> chr(65533)),
          peak AS (SELECT *, max(lp) OVER (PARTITION BY ctx, ch) AS m FROM ok)
          SELECT ctx, ch, round(max(m) + ln(sum(exp(lp - m))), 6) + 0::DOUBLE AS logprob FROM peak GROUP BY ctx, ch""",
        "ngram_counts_3": f"WITH {TRIGRAMS} SELECT p2 || p1 AS ctx, ch, count(*) AS cnt FROM tri_pos WHERE i >= 3 GROUP BY ALL",
        "ngram_counts_5": f"""WITH {TRIGRAMS} SELECT p4 || p3 || p2 || p1 AS ctx, ch, count(*) AS cnt FROM tri_pos
          WHERE i >= 5 GROUP BY ALL""",
        "ngram_probs_addk": f"""WITH {DOCUMENT_MODEL} SELECT ctx, ch,
            round((cnt + 1) / (sum(cnt) OVER (PARTITION BY ctx) + (SELECT count(*) FROM model WHERE ctx = ''))::DOUBLE, 6) AS p
          FROM model WHERE length(ctx) = 2""",
        "ngram_probs_interp": f"""WITH {DOCUMENT_MODEL},
          q AS (SELECT ctx || ch AS g FROM model WHERE length(ctx) = 2), {evidence("q", "model")}
          SELECT g, round(interp, 6) AS p FROM ev3""",
        "ngram_probs_backoff": f"""WITH {DOCUMENT_MODEL},
          q AS (SELECT ctx || ch AS g FROM model WHERE length(ctx) = 2), {evidence("q", "model")}
          SELECT g, round(backoff, 6) AS p FROM ev3""",
        "ngram_probs_kneser_ney": f"""WITH {DOCUMENT_MODEL},
          q AS (SELECT ctx || ch AS g FROM model WHERE length(ctx) = 2), {kneser_ney("q")}
          SELECT g, round(p, 6) AS p FROM kn_p""",
        "interpolation_weights": f"""WITH {BENCHMARK_GRAMS}, {evidence("held", "model")}, {parts("em", "ev")},
          {learnt_weights("w", "em")}
          SELECT bucket::INTEGER AS bucket, o::INTEGER AS o, round([a0, a1, a2, a3][o + 1], 6) AS weight
          FROM w, (SELECT unnest([0, 1, 2, 3]) AS o)""",
        "perplexity_kneser_ney": f"""WITH {DOCUMENT_MODEL}, {CONVERSATION_GRAMS}, {kneser_ney("held")},
          losses AS (SELECT role, sum(cnt)::BIGINT AS n, sum(-ln(p) * cnt) / sum(cnt) AS loss FROM kn_p GROUP BY role)
          {ROLE_PERPLEXITY}""",
        "perplexity_learnt_weights": f"""WITH {BENCHMARK_GRAMS}, {evidence("held", "model")}, {parts("em", "ev")},
          {learnt_weights("w", "em")},
          asked AS ({CONVERSATION_EVIDENCE}), {parts("told", "asked")},
          mixed AS (SELECT role, cnt, CASE WHEN a0 IS NULL THEN (q0 + q1 + q2 + q3) / 4 ELSE {MIXED} END AS p
            FROM told LEFT JOIN w USING (bucket)),
          losses AS (SELECT role, sum(cnt)::BIGINT AS n, sum(-ln(p) * cnt) / sum(cnt) AS loss FROM mixed GROUP BY role)
          {ROLE_PERPLEXITY}""",
        "cross_entropy": f"""WITH {DOCUMENT_MODEL}, held_src AS (SELECT item_id AS id, text AS t FROM benchmark),
          {chars("held_pos", "held_src")}, {full_grams("held", "held_pos")}, {evidence("held", "model")}
          SELECT sum(cnt)::BIGINT AS n, round(sum(-ln(interp) * cnt) / sum(cnt), 6) AS loss FROM ev3""",
        "perplexity": f"""WITH {DOCUMENT_MODEL},
          held_src AS (SELECT row_number() OVER () AS id, role, text AS t FROM conversations),
          {chars("held_pos", "held_src", "role")}, {full_grams("held", "held_pos", "role")}, {evidence("held", "model")},
          losses AS (SELECT role, sum(cnt)::BIGINT AS n, sum(-ln(interp) * cnt) / sum(cnt) AS loss FROM ev3 GROUP BY role)
          SELECT role, n, round(loss, 6) AS loss,
            round(CASE WHEN loss < 50 THEN exp(loss) ELSE 'inf'::DOUBLE END, 5) AS ppl FROM losses""",
        "stream_quota_state": """SELECT pos, lang FROM (
            SELECT lang, doc_id AS pos, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn FROM documents)
          WHERE rn <= 60""",
        "language_quota": f"""SELECT lang, pos FROM (
            SELECT lang, doc_id AS pos, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn FROM documents)
          WHERE rn <= {QUOTA}""",
        "shard_budget_quota": f"WITH {SHARDS} SELECT lang, shard_rank, pos FROM budgeted",
        "trim_from_top": f"WITH {trimmed(90)} SELECT pair, lang, pos FROM trimmed",
        "line_index": """SELECT source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS line, doc_id AS pos
          FROM documents""",
        "topk_per_row": f"""WITH {TRIGRAMS},
          c AS (SELECT p2 || p1 AS ctx, ch, count(*) AS cnt FROM tri_pos WHERE i >= 3 GROUP BY ALL)
          SELECT ctx, ch, cnt, rank FROM (
            SELECT *, (row_number() OVER (PARTITION BY ctx ORDER BY cnt DESC, ch))::INTEGER AS rank FROM c) WHERE rank <= 3""",
        "global_cut": f"""SELECT lang, pos FROM (
            SELECT lang, doc_id AS pos, row_number() OVER (ORDER BY {LANG_RANK}, doc_id) AS r FROM documents)
          WHERE r <= {MAX_TOTAL}""",
        "quota_and_cut": "WITH " + quota_sql(DOC_ROWS, -(-(MAX_TOTAL - 1) // 4), MAX_TOTAL - 1, "lang, pos"),
        "slice_raw": f"SELECT pos, lang FROM ({GAPPED}) WHERE pos >= 50 AND pos < 150 AND {filled('text')}",
        "slice_non_blank": f"""SELECT pos, lang FROM (SELECT pos, lang, row_number() OVER (ORDER BY pos) AS r
            FROM ({GAPPED}) WHERE pos >= 50 AND {filled("text")}) WHERE r <= 100""",
        "head_lines": head_sql(["es", "de", "fr"], 200, "lang AS file, pos", DOC_ROWS),
        "head_holdout": f"""SELECT pos, CASE WHEN pos < 120 THEN 'eval' ELSE 'train' END AS split
          FROM ({GAPPED}) WHERE {filled("text")}""",
        "random_holdout": """SELECT doc_id, CASE WHEN rk <= ceil(n * 0.05::DOUBLE) THEN 'test' ELSE 'train' END AS split
          FROM (SELECT doc_id, row_number() OVER (ORDER BY substr(md5('42:' || doc_id), 1, 15)) AS rk,
            count(*) OVER () AS n FROM documents)""",
        "mix_sources": f"""SELECT 'general' AS mix_source, doc_id FROM documents WHERE lang = 'en'
          UNION ALL SELECT 'topical', doc_id FROM documents
          WHERE {has_topic("text")} AND substr(md5(doc_id::VARCHAR), 1, 8) < '{int(0.3 * 2**32):08x}'""",
        "union_sources": """SELECT origin, count(*) AS n, sum(length(text))::BIGINT AS chars FROM (
            SELECT text, 'documents' AS origin FROM documents UNION ALL SELECT text, 'benchmark' FROM benchmark
            UNION ALL SELECT text, 'conversations' FROM conversations) GROUP BY origin""",
        "fill_guesses": """WITH t AS (SELECT doc_id,
            CASE WHEN length(text) > doc_id % 3 + 1 THEN substr(text, 1, 1) ELSE '' END
              || CASE WHEN length(text) > doc_id % 3 + 2 THEN substr(text, 2, 1) ELSE '' END AS top FROM documents),
          c AS (SELECT doc_id, 'token_path' AS path, top || '天气快不错吗' AS c FROM t
            UNION ALL SELECT doc_id, 'byte_path', top || ' .eta' FROM t),
          u AS (SELECT doc_id, path, ch, min(i) AS i FROM (SELECT doc_id, path, unnest(string_split(c, '')) AS ch,
            generate_subscripts(string_split(c, ''), 1) AS i FROM c) GROUP BY ALL),
          r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, path ORDER BY i) AS rk FROM u)
          SELECT doc_id, string_agg(ch, '' ORDER BY i) FILTER (path = 'token_path') AS token_path,
            string_agg(ch, '' ORDER BY i) FILTER (path = 'byte_path') AS byte_path
          FROM r WHERE rk <= 3 GROUP BY doc_id""",
        "empty_input_guess": """SELECT doc_id, CASE WHEN doc_id % 4 = 0 OR (doc_id % 4 > 1 AND text = '') THEN 'eta' ELSE 'xyz' END AS byte_path,
            CASE WHEN doc_id % 4 = 0 OR (doc_id % 4 > 1 AND text = '') THEN '天气快' ELSE 'xyz' END AS token_path FROM documents""",
        "stream_clean": f"SELECT doc_id AS pos, lang, {WEB_TEXT} AS text FROM documents WHERE length({strip('text')}) >= 10",
        "stream_split_counts": f"""SELECT lang, {ascii_english("text")} AS is_english, count(*) AS n
          FROM documents WHERE {filled("text")} GROUP BY ALL""",
        "stream_language_quota": "SELECT lang, least(count(*), 60) AS n FROM documents GROUP BY lang",
        "stream_predict": f"""WITH {DOCUMENT_MODEL}, {tops("top", "model")}, {ALL_LINES}, {PROMPTS.format(src="prompt_lines")},
          {lookup("guess", "prompts", "pos", "text", "top", " .eta")}
          SELECT pos, CASE WHEN text = '' THEN 'eta' ELSE guesses END AS pred FROM guess JOIN prompts USING (pos)""",
        "job_web_corpus": "WITH " + quota_sql(
            f"{DOC_ROWS} WHERE length({strip('text')}) >= 10", QUOTA, MAX_TOTAL, f"lang, pos, {WEB_TEXT} AS text"
        ),
        "job_encyclopedia_corpus": "WITH " + quota_sql(
            f"{DOC_ROWS} WHERE length({strip('text')}) >= 20", QUOTA, MAX_TOTAL, f"lang, pos, {WEB_TEXT} AS text"
        ),
        "job_clean_corpus": "WITH " + quota_sql(
            f"""SELECT doc_id AS pos, lang, nfc_normalize({strip(DECOMPOSED)}) AS text FROM documents
              WHERE length(nfc_normalize({strip(DECOMPOSED)})) >= 2""",
            QUOTA, MAX_TOTAL, f"lang, pos, {collapse('text')} AS text",
        ),
        "job_register_corpus": f"""WITH {SHARDS},
          fin AS (SELECT *, row_number() OVER (ORDER BY {LANG_RANK}, shard_rank, pos) AS place FROM budgeted)
          SELECT lang, shard_rank, pos, nfc_normalize({strip("text")}) AS text FROM fin WHERE place <= {SHARD_TOTAL}""",
        "job_instruction_corpus": f"""WITH {INSTRUCTIONS} SELECT pos,
            {collapse("coalesce(instruction, '') || ' ' || coalesce(output, '')")} AS text
          FROM numbered WHERE pos >= 20 AND pos < 120
            AND {filled("coalesce(instruction, '') || ' ' || coalesce(output, '')")}""",
        "job_chat_corpus": f"""WITH {FLAT} SELECT conv_id AS pos, text FROM (
            SELECT *, row_number() OVER (ORDER BY conv_id) AS r FROM flat WHERE conv_id >= 15) WHERE r <= 90""",
        "job_chat_corpus_read": f"""WITH {FLAT},
          items AS (SELECT conv_id, row_number() OVER (ORDER BY conv_id) - 1 AS pos
            FROM (SELECT DISTINCT conv_id FROM conversations))
          SELECT pos, text FROM (SELECT pos, text, row_number() OVER (ORDER BY pos) AS r
            FROM items JOIN flat USING (conv_id) WHERE pos >= 15) WHERE r <= 90""",
        "job_instruction_corpus_read": f"""WITH {INSTRUCTIONS} SELECT pos,
            {collapse("coalesce(instruction, '') || ' ' || coalesce(output, '')")} AS text
          FROM numbered WHERE pos >= 20 AND pos < 120
            AND {filled("coalesce(instruction, '') || ' ' || coalesce(output, '')")}""",
        "job_pair_corpus": head_sql(
            ["es", "en"], 150, "lang, pos, text",
            f"SELECT doc_id AS pos, lang, {collapse('text')} AS text FROM documents WHERE {filled('text')}",
        ),
        "job_pair_splits": f"""WITH {trimmed(90)} SELECT pair,
            CASE WHEN lang = 'en' THEN 'english' ELSE 'non_english' END AS split, pos, {collapse("text")} AS text FROM trimmed""",
        "job_pair_splits_written": f"""WITH {trimmed(90)} SELECT CASE WHEN lang = 'en' THEN 'english' ELSE 'non_english' END AS split,
            count(*) AS n FROM trimmed GROUP BY 1""",
        "job_detected_splits": f"""WITH {detected_lines()}
          SELECT source_rank, {english("t", "detected")} AS is_english, count(*) AS n, sum(length(t))::BIGINT AS chars
          FROM lines LEFT JOIN detected USING (id) GROUP BY ALL""",
        "job_detected_splits_written": f"""WITH {detected_lines()}
          SELECT CASE WHEN {english("t", "detected")} THEN 'english' ELSE 'non_english' END AS split, count(*) AS n
          FROM lines LEFT JOIN detected USING (id) GROUP BY ALL""",
        "job_train_eval": train_eval(HELDOUT, "addk"),
        "job_train_eval_head": train_eval(HEAD_HELDOUT, "interp"),
        "job_train_eval_loss": train_eval(HELDOUT, "addk", "1 - {p}"),
        "job_predict_grade": f"""WITH {HELDOUT}, {PROMPTS.format(src="test")},
          raw AS (SELECT pos AS id, text AS t FROM prompts), {detector("raw", "SELECT id, lang, t FROM train")},
          inputs AS (SELECT prompts.*, {english("text", "detected")} AS is_english
            FROM prompts LEFT JOIN detected ON id = pos),
          en_src AS (SELECT * FROM train WHERE lang = 'en'), ot_src AS (SELECT * FROM train WHERE lang <> 'en'),
          {route_sql("inputs", "en_src", "ot_src")}
          SELECT pos, lang, is_english, lower(gold) AS gold, substr(lower({or_empty("guesses")}), 1, 3) AS pred,
            contains(substr(lower({or_empty("guesses")}), 1, 3), lower(gold)) AS hit
          FROM inputs JOIN routed USING (pos)""",
        "heldout_success": f"""WITH {HELDOUT}, {PROMPTS.format(src="test")}, {counts("model", "train")}, {tops("top", "model")},
          {lookup("guess", "prompts", "pos", "text", "top", " .eta")}
          SELECT lang, count(*) AS n,
            count(*) FILTER (contains(substr(lower(pred), 1, 3), lower(gold))) AS hits,
            count(*) FILTER (substr(lower(pred), 1, 1) = lower(gold)) AS top1_hits
          FROM (SELECT *, CASE WHEN text = '' THEN 'eta' ELSE guesses END AS pred FROM prompts JOIN guess USING (pos))
          GROUP BY lang""",
        "dense_success": f"""WITH {HELDOUT}, {counts("model", "train")}, {tops("top", "model")},
          {chars("held_pos", "test", "lang")},
          keyed AS (SELECT lang, coalesce(p2, '') || coalesce(p1, '') AS key, ch AS gold, count(*) AS cnt
            FROM held_pos GROUP BY ALL),
          keys AS (SELECT DISTINCT key FROM keyed), {lookup("guess", "keys", "key", "key", "top", " .eta")}
          SELECT lang, sum(cnt)::BIGINT AS n,
            coalesce(sum(cnt) FILTER (contains(lower(guesses), lower(gold))), 0)::BIGINT AS hits,
            coalesce(sum(cnt) FILTER (lower(guesses[1]) = lower(gold)), 0)::BIGINT AS top1_hits
          FROM keyed JOIN guess USING (key) GROUP BY lang""",
    }
