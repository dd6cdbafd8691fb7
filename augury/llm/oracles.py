"""The queries as SQL for DuckDB, where SQL can express them."""

from __future__ import annotations

_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPLIT = r"regexp_split_to_array({0}, '[\x20\x09-\x0D]+')"

EXACT_DEDUP = f"""
WITH folded AS (SELECT doc_id, {_FOLD} AS t FROM documents)
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(t) AS text_sha256
FROM folded WINDOW same AS (PARTITION BY t)
"""

HOST_RULES = rf"""
WITH texts AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
worded AS (SELECT *, list_filter({_SPLIT.format('t')}, lambda x: x <> '') AS words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM texts),
runs AS (SELECT doc_id, p, array_to_string(list_slice(words, p, p + 7), ' ') AS run
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS p FROM worded)),
again AS (SELECT doc_id, p FROM runs QUALIFY count(*) OVER (PARTITION BY doc_id, run) > 1),
covered AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + 8)) AS q FROM again) GROUP BY doc_id),
counted AS (SELECT doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words FROM worded LEFT JOIN covered USING (doc_id)),
ruled AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    100 * n_symbols > 10 * n_words AS symbols_failed FROM counted),
hosts AS (SELECT source, count(*) AS documents, count(*) FILTER (base_failed OR symbols_failed) AS failed FROM ruled GROUP BY source),
sums AS (SELECT sum(documents) AS n, sum(failed) AS f, count(*) AS h, sum(documents * (failed / documents) ** 2) AS squares,
    sum(CAST(documents AS DOUBLE) ** 2) AS n2 FROM hosts),
spreads AS (SELECT *, (f + 1) / (n + 2) AS m,
    (greatest(0.0, squares - n * (f / n) ** 2) - (h - 1) * (f / n) * (1 - f / n)) / greatest(1.0, n - n2 / n) AS s FROM sums),
prior AS (SELECT m, least(1000.0, greatest(2.0, CASE WHEN s > 0 THEN m * (1 - m) / s - 1 ELSE 1000.0 END)) AS w FROM spreads),
judged AS (SELECT source, (failed + m * w) / (documents + w) AS host_rate FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT symbols_failed AND host_rate <= 0.5 AS kept, symbols_failed, round(host_rate, 6) AS host_rate
FROM ruled r JOIN judged j ON r.source IS NOT DISTINCT FROM j.source
"""

# Each of the 32 characters is five of the digest's bits; four of them lie in five hex digits.
WARC = """
WITH digested AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
valued AS (SELECT *, list_transform(range(0, 8), lambda g: list_sum(list_transform(range(1, 6), lambda k:
    (strpos('0123456789abcdef', substr(h, CAST(5 * g + k AS INTEGER), 1)) - 1) * CAST(16 ** (5 - k) AS BIGINT)))) AS v FROM digested)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST(v[i // 4 + 1] AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) % 32 + 1 AS INTEGER), 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = min(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> min(page_id) OVER same THEN min(page_id) OVER same END AS refers_to
FROM valued WINDOW same AS (PARTITION BY payload)
"""

JACCARD = rf"""
WITH RECURSIVE worded AS (SELECT doc_id, list_filter({_SPLIT.format(_FOLD)}, lambda x: x <> '') AS words FROM documents),
shingles AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(list_slice(words, i, i + 4), ' ')) END) AS s FROM worded),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id),
links AS (SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * o >= 75 * (p.n + q.n - o)),
reached AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, c.component_id FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reached GROUP BY x) c USING (doc_id)
"""


TOP_K = """
WITH numbers AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, e.vec_id, CAST(list_inner_product(q.v, e.v) AS BIGINT) AS score
    FROM numbers q JOIN numbers e ON q.vec_id % 50 = 0 AND e.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score FROM scored
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY rank <= 5
"""


def oracles() -> dict[str, str]:
    return {
        "op2_host_quality_rules": HOST_RULES,
        "op4_warc_transactions": WARC,
        "op5_radix_exact_dedup": EXACT_DEDUP,
        "op6_vertical_jaccard_join": JACCARD,
        "op12_sorted_list_top_k": TOP_K,
    }
