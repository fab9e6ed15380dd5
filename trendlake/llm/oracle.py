"""SQL over the same tables for the queries that SQL can express."""

from trendlake.llm.quality import MAX_HOST_RATE, MAX_REPEAT_PERCENT, MIN_WORDS
from trendlake.llm.urls import MIN_SOFT, RULES, SOFT, STRICT

WORD = r"[^\x20\x09-\x0D]"
LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _url_sql() -> str:
    rules = []
    for action, rule in sorted(RULES, key=lambda r: (-len(r[1]), r[1])):
        host, _, path = rule.partition("/")
        rules.append(f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}') THEN '{action} {rule}'")
    hit = r"regexp_matches(low, '(^|[^\p{{L}}\p{{N}}]){}($|[^\p{{L}}\p{{N}}])')::INT"
    strict, soft = (" + ".join(hit.format(t) for t in terms) for terms in (STRICT, SOFT))
    return rf"""
WITH parts AS (SELECT page_id, {LOWER.format("url")} AS low,
                      CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
split AS (SELECT page_id, low, {LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
                 regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
ruled AS (SELECT *, CASE {" ".join(rules)} END AS fit FROM split)
SELECT page_id, host, path, split_part(fit, ' ', 2) AS rule,
       CASE WHEN fit IS NOT NULL THEN split_part(fit, ' ', 1)
            WHEN {strict} > 0 OR {soft} >= {MIN_SOFT} THEN 'block' ELSE 'allow' END AS verdict
FROM ruled"""


EXACT = f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
       sha256(body) AS text_sha256
FROM (SELECT doc_id, {LOWER.format("text")} AS body FROM documents) WINDOW same AS (PARTITION BY body)"""

# Rows of {table}: its columns, the counts, and kept.
JUDGED = rf"""
WITH docs AS (SELECT *, row_number() OVER () AS n_row, coalesce(text, '') AS body FROM {{table}}),
words AS (SELECT n_row, regexp_extract_all(body, '{WORD}+') AS w FROM docs),
windows AS (SELECT n_row, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
            FROM (SELECT n_row, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
again AS (SELECT n_row, i FROM windows QUALIFY count(*) OVER (PARTITION BY n_row, g) > 1),
covered AS (SELECT n_row, count(DISTINCT p) AS n FROM (SELECT n_row, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY n_row),
lines AS (SELECT n_row, unnest(string_split(body, chr(10))) AS line FROM docs),
dup AS (SELECT n_row, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '{WORD}') GROUP BY n_row),
counted AS (SELECT docs.*, len(w) AS n_words, length(regexp_replace(body, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
                   length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
                   coalesce(covered.n, 0) AS n_repeat_words
            FROM docs JOIN words USING (n_row) LEFT JOIN dup USING (n_row) LEFT JOIN covered USING (n_row)),
judged AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counted),
hosts AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS f FROM judged WHERE source IS NOT NULL GROUP BY source),
mean AS (SELECT sum(f) / sum(n) AS m, sum(n) AS n, count(*) AS hosts FROM hosts),
spread AS (SELECT m, greatest(sum(hosts.n * (f / hosts.n - m) ** 2) / mean.n - m * (1 - m) * mean.hosts / mean.n, m * (1 - m) * 1e-4) AS v
           FROM hosts, mean GROUP BY m, mean.n, mean.hosts),
prior AS (SELECT CASE WHEN m > 0 AND m < 1 THEN m * greatest(m * (1 - m) / v - 1, 1) ELSE m + 0.5 END AS a,
                 CASE WHEN m > 0 AND m < 1 THEN (1 - m) * greatest(m * (1 - m) / v - 1, 1) ELSE 1.5 - m END AS b FROM spread),
rejected AS (SELECT source FROM hosts, prior WHERE (f + a) / (n + a + b) > {MAX_HOST_RATE})
"""

QUALITY = JUDGED.replace("{table}", "documents") + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (source IS NULL OR source NOT IN (SELECT source FROM rejected)) AS kept FROM judged"""

# CRC-32 of the decimal key bit by bit; runs as islands of equal 16-word windows at each lag.
RUNS = r"""
WITH texts AS (SELECT doc_id, doc_id::VARCHAR AS k, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
bits AS (SELECT *, flatten(list_transform(range(1, length(k) + 1), lambda i: [ascii(substr(k, i, 1))::BIGINT, 0, 0, 0, 0, 0, 0, 0])) AS b FROM texts),
hashed AS (SELECT *, len(w)::BIGINT AS n, xor(list_reduce(list_prepend(4294967295::BIGINT, b),
             lambda c, e: xor(xor(c, e) >> 1, 3988292384::BIGINT * (xor(c, e) & 1))), 4294967295::BIGINT) AS h FROM bits),
placed AS (SELECT doc_id, w, n, h, CASE WHEN n > 0 THEN (h // 10) % n ELSE 0 END AS a FROM hashed),
plan AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM placed),
made AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 THEN list_transform(range(0, n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) ELSE w END AS w FROM plan),
grams AS (SELECT doc_id, i, array_to_string(w[i + 1:i + 16], ' ') AS g FROM (SELECT doc_id, w, unnest(range(0, n - 15)) AS i FROM made)),
pairs AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.g = y.g AND x.i < y.i),
numbered AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs),
stretches AS (SELECT doc_id, q, min(i) AS s, max(i) + 16 - min(i) + q AS size FROM numbered GROUP BY doc_id, q, island),
long AS (SELECT * FROM stretches WHERE size >= greatest(24, 3 * q)),
runs AS (SELECT * FROM long l WHERE NOT EXISTS (SELECT 1 FROM long o WHERE o.doc_id = l.doc_id AND o.q < l.q AND l.q % o.q = 0 AND o.s <= l.s AND o.s + o.size >= l.s + l.size)),
listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || size || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM runs GROUP BY 1),
best AS (SELECT doc_id, s, size, q FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY size::DOUBLE / q DESC, s, q) AS r FROM runs) WHERE r = 1),
words AS (SELECT doc_id, unnest(range(0, n)) AS i, unnest(w) AS word FROM made),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + size)) AS i FROM runs),
rest AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS body FROM words x WHERE NOT EXISTS (SELECT 1 FROM gone y WHERE y.doc_id = x.doc_id AND y.i = x.i) GROUP BY 1)
SELECT m.doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, size AS length, q AS period, 1000 * size // q AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(body, '')) AS collapsed_sha256
FROM made m LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN rest USING (doc_id)"""

# All pairs and the closure of their links.
NEIGHBOURS = """
WITH RECURSIVE rows_ AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
sized AS (SELECT vec_id, e, len(e) AS width, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM rows_
          WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
known AS (SELECT vec_id, width, list_transform(e, lambda x: x / norm) AS u FROM sized WHERE norm > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM known a JOIN known b ON a.width = b.width AND a.vec_id <> b.vec_id
          WHERE list_inner_product(a.u, b.u) >= 0.9),
reach(node, root) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node),
least AS (SELECT node, min(root) AS component_id FROM reach GROUP BY 1),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON node = vec_id LEFT JOIN degree ON a = vec_id"""

ORACLE: dict[str, str] = {"op4_urls": _url_sql(), "op5_exact": EXACT, "op6_quality": QUALITY, "op11_runs": RUNS, "op13_neighbours": NEIGHBOURS}
