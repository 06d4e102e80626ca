"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations


from lacuna.llm import chat, licenses, mixing, quality, urlfilter

ORACLE = {}

WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"


def _value(rule: str) -> str:
    return {"symbols_per_word": "CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END",
            "dup_line_share": "CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END",
            "repeat_word_share": "CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END",
            "long_words": "CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END",
            "short_words": "-CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END"}[rule]


def _quality() -> str:
    rules = list(quality.LADDERS)
    vectors = ", ".join(f"({i}, " + ", ".join(f"{v[r]}::DOUBLE" for r in rules) + ")" for i, v in enumerate(quality.steps()))
    beyond = " OR ".join(f"{_value(r)} > s.{r}" for r in rules)
    rejected = ", ".join(f"CASE WHEN {_value(r)} > (SELECT {r} FROM cut WHERE cut.lang IS NOT DISTINCT FROM f.lang) THEN '{r}' END" for r in rules)
    p = quality.RISK
    return f"""
WITH w AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text, {WORDS} AS words,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
           FROM documents),
t AS (SELECT rid, unnest(range(1, len(words) - 1)) AS i, words FROM w),
g AS (SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS triple FROM t),
d AS (SELECT rid, i FROM g QUALIFY count(*) OVER (PARTITION BY rid, triple) > 1),
c AS (SELECT rid, count(DISTINCT i + j) AS n FROM d, range(0, 3) r(j) GROUP BY rid),
f AS (SELECT w.doc_id, lang, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
      FROM w LEFT JOIN c USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f),
s(step, {", ".join(rules)}) AS (VALUES {vectors}),
known AS (SELECT b.* FROM b JOIN (SELECT doc_id, min(quality) AS quality FROM labels GROUP BY doc_id) l USING (doc_id)
          WHERE quality = 1 AND NOT base_failed),
tried AS (SELECT lang, s.step, count(*) AS n, count(*) FILTER (WHERE {beyond}) AS k FROM known, s GROUP BY ALL),
tested AS (SELECT *, (SELECT count(*) FROM (SELECT DISTINCT lang FROM known)) AS strata,
             (SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({p}) + (n - i) * ln(1 - {p}))) FROM range(0, k + 1) q(i)) AS pv
           FROM tried),
held AS (SELECT *, bool_and(k < n * {p} AND pv <= {quality.LEVEL} / strata) OVER (PARTITION BY lang ORDER BY step) AS reached FROM tested),
cut AS (SELECT lang, s.* FROM (SELECT lang, max(step) AS step FROM held WHERE reached GROUP BY ALL) JOIN s USING (step)),
j AS (SELECT f.*, coalesce(array_to_string([{rejected}], ','), '') AS rejected_by FROM b f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND rejected_by = '' AS kept, rejected_by FROM j"""


ORACLE["op1_quality_rules"] = _quality()


def _mixing() -> str:
    case = " ".join(f"WHEN {i} THEN {float(w)}::DOUBLE" for i, w in enumerate(mixing.WEIGHTS))
    return f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, len({WORDS}) AS size FROM documents),
b AS (SELECT doc_id, source, size,
        (('0x' || substr(md5(concat_ws('|', '{mixing.SEED}', coalesce(doc_id::VARCHAR, ''), size, md5(text))), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496 AS u
      FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n,
        CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} {case} END AS w, {mixing.MOST} * sum(size)::DOUBLE AS cap
      FROM b GROUP BY source),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER p, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER p, 0)) AS lev
      FROM s WINDOW p AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT *, least(cap, coalesce((SELECT max(lev) FROM l WHERE lev * w <= cap) * w, cap)) AS target FROM l),
i AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
r AS (SELECT *, target - whole * source_size AS rest FROM i),
q AS (SELECT b.*, r.* EXCLUDE (source), CASE WHEN rest > 0 THEN
        u / (1 - u) / (rest / source_size / (1 - rest / source_size) * sqrt(source_size / n / greatest(size, 1))) END AS q
      FROM b JOIN r ON b.source IS NOT DISTINCT FROM r.source),
z AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY q, coalesce(doc_id, -9223372036854775808), size ROWS UNBOUNDED PRECEDING) AS upto FROM q)
SELECT doc_id, size, source_size, target,
  (size * copies)::BIGINT AS taken, copies FROM (SELECT *, (whole + CASE WHEN q IS NOT NULL AND upto + upto - size <= 2 * rest THEN 1 ELSE 0 END)::INT AS copies FROM z)"""


ORACLE["op9_source_mixing"] = _mixing()


def _urls() -> str:
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    rows = ", ".join(f"({quote(r.name)}, '{r.action}', {quote(r.regex)}, {r.site}, {r.rank})" for r in urlfilter.default_rules())
    return f"""
WITH r(name, action, regex, site, rank) AS (VALUES {rows}),
p AS (SELECT page_id, coalesce(url, '') AS url, regexp_extract(coalesce(url, ''), {quote(urlfilter.URL)}, 1) AS h,
        regexp_extract(coalesce(url, ''), {quote(urlfilter.URL)}, 2) AS path FROM pages),
u AS (SELECT page_id, url, translate(h, '{urlfilter.UPPER}', '{urlfilter.LOWER}') AS host, path FROM p),
f AS (SELECT DISTINCT u.*, r.* FROM u JOIN r ON regexp_matches(CASE WHEN site THEN host || path ELSE url END, regex)),
b AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY page_id, url ORDER BY site DESC, site OR action = 'allow' DESC, rank DESC, name DESC) = 1)
SELECT u.page_id, u.host, u.path, CASE WHEN site THEN name END AS rule, CASE WHEN NOT site THEN name END AS pattern,
  coalesce(action, 'allow') AS verdict
FROM u LEFT JOIN b ON u.page_id IS NOT DISTINCT FROM b.page_id AND u.url = b.url"""


ORACLE["op4_url_filter"] = _urls()

ORACLE["op7_topk_search"] = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
      FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 20"""

ORACLE["op6_chat_perspectives"] = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text, count(*) AS n FROM conversations GROUP BY ALL),
s AS (SELECT DISTINCT conv_id, role AS speaker FROM t),
m AS (SELECT t.*, speaker, floor(turn / {chat.BLOCK})::BIGINT AS block,
        CASE WHEN role = speaker THEN '{chat.START}assistant' ELSE '{chat.START}user name=' || role END || chr(10) AS head
      FROM t JOIN s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
p AS (SELECT *, head || text || '{chat.END}' || chr(10) AS piece FROM m),
o AS (SELECT *, sum(length(piece)) OVER (PARTITION BY conv_id, speaker, block ORDER BY turn, role, text) AS upto FROM p)
SELECT conv_id, speaker, block, '' AS part, count(*)::INT AS n_turns, sum(n)::BIGINT AS n_rows,
  string_agg(piece, '' ORDER BY turn, role, text) AS text,
  coalesce(string_agg(CASE WHEN role = speaker THEN (upto - length(piece) + length(head))::BIGINT || ':' || (upto - 1)::BIGINT END, ',' ORDER BY turn, role, text), '') AS mask
FROM o GROUP BY conv_id, speaker, block"""



def _licenses() -> str:
    listed = lambda text: "[" + ", ".join(f"'{w.decode()}'" for w in licenses.words_of(text)) + "]"
    phrases = ", ".join(f"('{label}', {listed(text)})" for label, text in licenses.PHRASES)
    templates = ", ".join(f"({i}, '{label}', {listed(text)}, {m}, {licenses.need(m, licenses.THRESHOLD)}, {licenses.spacing(m)})"
                          for i, (label, text) in enumerate(licenses.TEMPLATES) for m in [len(licenses.words_of(text))])
    return f"""
WITH p(label, phrase) AS (VALUES {phrases}),
t(id, label, words, m, need, s) AS (VALUES {templates}),
tw AS (SELECT id, s, word, count(*) AS k FROM (SELECT id, s, unnest(words) AS word FROM t) GROUP BY ALL),
d AS (SELECT row_number() OVER () AS rid, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), '{urlfilter.UPPER}', '{urlfilter.LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
w AS (SELECT rid, unnest(words) AS word, unnest(range(0, len(words))) AS i, len(words) AS n FROM d),
base AS (SELECT d.rid, p.label, w.i AS start FROM w JOIN p ON w.word = p.phrase[1] JOIN d USING (rid) WHERE d.words[w.i + 1:w.i + len(p.phrase)] = p.phrase),
hit AS (SELECT DISTINCT rid, n, i, c.s, w.word FROM w JOIN (SELECT DISTINCT s, word FROM tw) c ON w.word = c.word),
inblock AS (SELECT rid, s, word, i, unnest(list_distinct([least(i // s, greatest(ceil(n / s)::BIGINT - 2, 0)), greatest(i // s - 1, 0)])) AS b, n FROM hit),
c AS (SELECT rid, s, b, word, count(*) AS k FROM inblock WHERE b <= greatest(ceil(n / s)::BIGINT - 2, 0) AND i >= b * s AND i < (b + 2) * s GROUP BY ALL),
m AS (SELECT c.rid, t.label, sum(least(c.k, tw.k)) / t.m AS score FROM c JOIN tw ON tw.s = c.s AND tw.word = c.word JOIN t ON t.id = tw.id
      GROUP BY c.rid, c.b, t.id, t.label, t.m, t.need HAVING sum(least(c.k, tw.k)) >= t.need),
a AS (SELECT rid, label, start, 1.0::DOUBLE AS score FROM base UNION ALL SELECT rid, label, NULL, score FROM m),
g AS (SELECT rid, count(start) AS n_base, min(start) AS first_word, max(start) AS last_word, max(score) AS score,
        array_to_string(list_sort(list(DISTINCT label) FILTER (WHERE start IS NOT NULL)), ',') AS base_labels,
        array_to_string(list_sort(list(DISTINCT label)), ',') AS labels FROM a GROUP BY rid)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN g USING (rid)"""


ORACLE["op11_license_scan"] = _licenses()


# the CRC bit by bit, near words from all words with one code point left out
ORACLE["op13_spelling_variants"] = f"""
WITH RECURSIVE r AS (SELECT doc_id, translate(run, '{urlfilter.UPPER}', '{urlfilter.LOWER}') AS run, count(*) AS c
      FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents) WHERE length(run) >= 7 GROUP BY ALL),
k AS (SELECT *, concat(doc_id::VARCHAR, ':', run) AS name FROM r),
h AS (SELECT run, c, xor(4294967295::BIGINT, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(range(0, octet_length(encode(name))), lambda i: ('0x' || substr(hex(name), 2 * i::INT + 1, 2))::BIGINT)),
        lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384::BIGINT * (x & 1))))) AS h FROM k),
w AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, c FROM h),
v AS (SELECT word, sum(c)::BIGINT AS n FROM w WHERE length(word) >= 7 GROUP BY 1 HAVING sum(c) >= 2),
d AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM v)),
s AS (SELECT DISTINCT d.word AS a, d.n AS na, v.word AS b, v.n AS nb FROM d JOIN v ON v.word = d.rest),
p AS (SELECT a.word, b.word AS other, b.n FROM d a JOIN d b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
      UNION ALL SELECT a, b, nb FROM s UNION ALL SELECT b, a, na FROM s),
f AS (SELECT v.word, v.n, count(p.other) AS n_near, max(p.n) AS most, arg_min(p.other, (-p.n, p.other)) AS best FROM v LEFT JOIN p ON p.word = v.word GROUP BY 1, 2),
g AS (SELECT word, n, n_near, CASE WHEN most >= 10 * n THEN best END AS form, CASE WHEN most >= 10 * n THEN most END AS form_n FROM f),
t AS (SELECT word, coalesce(form, word) AS root, form FROM g UNION ALL SELECT t.word, g.form, g.form FROM t JOIN g ON g.word = t.form WHERE g.form IS NOT NULL),
e AS (SELECT t.word, t.root FROM t JOIN g ON g.word = t.root WHERE g.form IS NULL)
SELECT g.word, g.form, e.root, g.n, g.n_near, g.form_n FROM g JOIN e ON e.word = g.word"""
