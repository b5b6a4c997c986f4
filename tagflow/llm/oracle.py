"""DuckDB SQL for the queries that SQL can express."""

WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
_fits = " UNION ALL ".join(
    f"SELECT page_id, '{h}{p}' AS rule, '{v}' AS verdict, length('{h}{p}') AS len FROM u WHERE (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}')" for v, h, p in RULES)
_globs = [("*spam* *", "contains(host, 'spam')"), ("*casino* *", "contains(host, 'casino')"), ("*adult* *", "contains(host, 'adult')"), ("* /login*", "starts_with(path, '/login')"), ("* /track/*", "starts_with(path, '/track/')")]

URLS = f"""WITH r AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{UPPER.lower()}') AS host, regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM r),
f AS (SELECT * FROM ({_fits}) QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY len DESC) = 1),
g AS (SELECT u.*, f.rule, f.verdict AS own, CASE WHEN f.rule IS NULL THEN CASE {" ".join(f"WHEN {c} THEN '{n}'" for n, c in _globs)} END END AS "glob" FROM u LEFT JOIN f USING (page_id))
SELECT page_id, host, path, rule, coalesce(own, CASE WHEN "glob" IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, "glob" FROM g"""

HOST_RULES = f"""WITH w AS (SELECT doc_id, source, text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines FROM documents),
x AS (SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, w FROM w WHERE len(w) > 4), win AS (SELECT doc_id, i, w[i:i + 4] AS g FROM x),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1), cov AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS k FROM rep) GROUP BY 1),
m AS (SELECT w.doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars, CAST(len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
 len(lines) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words FROM w LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
a AS (SELECT *, base_failed OR 100 * n_symbols > 30 * n_words OR 100 * n_dup_lines > 30 * n_lines OR word_chars < 2 * n_words OR word_chars > 15 * n_words AS failed FROM b),
h AS (SELECT source, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (failed) AS DOUBLE) AS f FROM a GROUP BY 1), t AS (SELECT sum(n) AS n, sum(f) AS f, count(*) AS k, sum(n * n) AS q, sum(f) / sum(n) AS mean FROM h),
v AS (SELECT any_value(t.n) AS n, any_value(t.f) AS f, any_value(mean) AS mean, (sum(h.n * (h.f / h.n - mean) * (h.f / h.n - mean)) - (any_value(k) - 1) * any_value(mean) * (1 - any_value(mean))) / nullif(any_value(t.n) - any_value(q) / any_value(t.n), 0) AS between_ FROM h, t),
s AS (SELECT *, CASE WHEN between_ > 0 THEN least(1e6, greatest(1.0, mean * (1 - mean) / between_ - 1)) ELSE 1e6 END AS strength FROM v),
p AS (SELECT CASE WHEN f IN (0, n) THEN 0.5 ELSE mean * strength END AS alpha, CASE WHEN f IN (0, n) THEN 0.5 ELSE (1 - mean) * strength END AS beta FROM s),
r AS (SELECT source, (f + alpha) / (n + alpha + beta) AS rate FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rate <= 0.5 AS kept, failed, round(CAST(rate AS DOUBLE), 6) AS host_rate FROM a JOIN r ON a.source IS NOT DISTINCT FROM r.source"""

_SHINGLES = f"""WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{WORD}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0))
"""

NEAR = "WITH RECURSIVE " + _SHINGLES.removeprefix("WITH ") + """, n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1) m USING (doc_id)"""

CONTAINED = _SHINGLES + f""", bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{WORD}') AS w FROM benchmark),
b AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM bw WHERE len(w) > 4)), n AS (SELECT item_id, count(*) AS n_shingles FROM b GROUP BY 1),
c AS (SELECT doc_id, item_id, count(*) AS n_common FROM s JOIN b USING (g) GROUP BY 1, 2)
SELECT doc_id, item_id, n_shingles, n_common FROM c JOIN n USING (item_id) WHERE 100 * n_common >= 80 * n_shingles"""

MIX = f"""WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || coalesce(text, '')) AS key FROM documents),
z AS (SELECT source, sum(size) AS source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM d GROUP BY source),
r AS (SELECT *, 3 * source_size AS lim, 3 * source_size / weight AS ratio FROM z), c AS (SELECT *, coalesce(sum(lim) OVER o, 0) AS lim_before, coalesce(sum(weight) OVER o, 0) AS w_before FROM r WINDOW o AS (ORDER BY ratio, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
y0 AS (SELECT ratio, rank, ((SELECT sum(source_size) FROM z) - lim_before) / ((SELECT sum(weight) FROM z) - w_before) AS level FROM c),
v AS (SELECT coalesce(arg_min(level, ratio * 1e6 + rank) FILTER (ratio >= level), 1e300) AS level FROM y0),
t AS (SELECT source, rank, source_size, least(weight * level, lim)::DOUBLE AS target FROM r, v),
b AS (SELECT *, CAST(ceil(source_size / 32) AS BIGINT) AS blocks FROM t), c2 AS (SELECT *, CAST(ceil(source_size / greatest(blocks, 1)) AS BIGINT) AS words, floor(target / nullif(source_size, 0)) AS passes FROM b),
s AS (SELECT *, CASE WHEN source_size > 0 THEN passes * blocks + least(blocks, (target - passes * source_size) / words) ELSE 0 END AS share FROM c2),
u AS (SELECT *, CAST(round(sum(share) OVER (ORDER BY rank) / (SELECT sum(share) FROM s) * round((SELECT sum(share) FROM s))) AS BIGINT) AS high FROM s), y AS (SELECT *, high - coalesce(lag(high) OVER (ORDER BY rank), 0) AS slots FROM u),
e AS (SELECT rank, unnest(range(least(slots, 3 * blocks))) % blocks AS block FROM y WHERE share > 0), x AS (SELECT rank, block, count(*) AS times FROM e GROUP BY ALL),
f AS (SELECT d.*, rank, z.source_size, CAST(sum(size) OVER (PARTITION BY rank ORDER BY key, size, doc_id ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS first FROM d JOIN z ON d.source IS NOT DISTINCT FROM z.source),
j AS (SELECT f.rank, first, size, words, unnest(range(first // words, (first + size - 1) // words + 1)) AS block FROM f JOIN s USING (rank) WHERE size > 0),
g AS (SELECT rank, first, sum((least(first + size, (block + 1) * words) - greatest(first, block * words)) * times) AS taken FROM j JOIN x USING (rank, block) GROUP BY 1, 2)
SELECT f.doc_id, f.size, CAST(f.source_size AS BIGINT) AS source_size, round(target, 6) AS target, CASE WHEN f.size > 0 THEN CAST(coalesce(taken, 0) AS BIGINT) ELSE 0 END AS taken FROM f JOIN t USING (rank) LEFT JOIN g ON f.rank = g.rank AND f.first = g.first AND f.size > 0"""

COLLOCATIONS = f"""WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p), t AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY 1),
o AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w), s AS (SELECT lang, w, i, unnest(range(1, 6)) AS k FROM o),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a FROM s WHERE i + k - 1 <= len(w) GROUP BY 1, 2, 3 HAVING count(*) >= 100),
c AS (SELECT lang, k AS len, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1), x AS (SELECT *, unnest(range(1, len)) AS k FROM c),
y AS (SELECT x.lang, x.phrase, x.a, p.a AS l, q.a AS r, n, x.k, CAST((1000::HUGEINT * x.a * n) // (p.a::HUGEINT * q.a) AS BIGINT) AS score FROM x JOIN f p ON p.lang = x.lang AND p.k = x.k AND p.phrase = array_to_string(x.w[1:x.k], ' ')
 JOIN f q ON q.lang = x.lang AND q.k = x.len - x.k AND q.phrase = array_to_string(x.w[x.k + 1:x.len], ' ') JOIN t ON t.lang = x.lang),
z AS (SELECT * FROM y QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (SELECT lang, w, a, len, unnest(range(2, len)) AS k FROM c WHERE len > 2), j AS (SELECT lang, w, a, k, unnest(range(1, len - k + 2)) AS b FROM i),
d AS (SELECT DISTINCT j.lang, z.phrase FROM j JOIN z ON z.lang = j.lang AND z.phrase = array_to_string(j.w[j.b:j.b + j.k - 1], ' ') AND 100 * j.a >= 100 * z.a),
g AS (SELECT z.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM z ANTI JOIN d USING (lang, phrase))
SELECT lang, rank, phrase, a, l, r, n, score FROM g WHERE rank <= 2000"""

#: By query. The others hash with functions that SQL does not have, learn, or write JSON; tests/llm hold them against brute force.
SQL = {
    "op1_host_quality_rules": HOST_RULES,
    "op4_ngram_jaccard_join": NEAR,
    "op5_url_globs": URLS,
    "op6_benchmark_containment": CONTAINED,
    "op7_source_mix": MIX,
    "op11_phrase_collocations": COLLOCATIONS,
}
