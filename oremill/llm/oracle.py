"""SQL that DuckDB runs to the same results, for the operators that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op8_warc"] = """
WITH digested AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
    FROM pages
), owners AS (
    SELECT payload_digest, max(page_id) AS owner FROM digested WHERE payload_bytes >= 1000 GROUP BY payload_digest
), typed AS (
    SELECT d.*, CASE WHEN owner IS NOT NULL AND owner IS DISTINCT FROM page_id THEN owner END AS refers_to
    FROM digested d LEFT JOIN owners o ON o.payload_digest = d.payload_digest AND d.payload_bytes >= 1000
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM typed
"""

#: Lists of doubles; links are symmetric, and the closure follows them to the smallest id.
ORACLE["op3_embedding_dedup"] = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93
), reached AS (
    SELECT a AS vec_id, a AS other FROM links UNION SELECT r.vec_id, l.b FROM reached r JOIN links l ON r.other = l.a
), roots AS (SELECT vec_id, min(other) AS root FROM reached GROUP BY vec_id),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, coalesce(root, e.vec_id) AS component_id, coalesce(root, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN roots USING (vec_id) LEFT JOIN counts USING (vec_id)
"""

#: All windows of up to 20 lines with 20 characters, written out as text; the line break cannot stand inside a line.
ORACLE["op2_line_dedup"] = """
WITH lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS line
    FROM documents WHERE text IS NOT NULL
), kept AS (
    SELECT doc_id, line, trim(raw) AS body, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS pos FROM lines WHERE trim(raw) <> ''
), grown AS (
    SELECT doc_id, pos, m, array_to_string(list_slice(bodies, pos, pos + m - 1), chr(10)) AS body
    FROM (SELECT doc_id, list(body ORDER BY pos) AS bodies FROM kept GROUP BY doc_id) d
    JOIN kept k USING (doc_id), (SELECT unnest(range(1, 21)) AS m)
    WHERE pos + m - 1 <= len(bodies)
), windows AS (
    SELECT doc_id, pos, m, body FROM grown WHERE length(replace(body, chr(10), '')) >= 20
), later AS (
    SELECT doc_id, pos, m FROM windows
    QUALIFY row_number() OVER (PARTITION BY md5(body), m ORDER BY doc_id, pos) > 1
), gone AS (
    SELECT DISTINCT k.doc_id, k.line FROM later l JOIN kept k ON k.doc_id = l.doc_id AND k.pos BETWEEN l.pos AND l.pos + l.m - 1
), left_over AS (
    SELECT l.doc_id, string_agg(l.raw, chr(10) ORDER BY l.line) FILTER (g.line IS NULL) AS text,
           count(*) FILTER (trim(l.raw) <> '') AS n_lines, count(g.line) AS n_deleted
    FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.line = l.line GROUP BY l.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(l.text, '') END AS text,
       CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_deleted, 0) AS BIGINT) AS n_deleted
FROM documents d LEFT JOIN left_over l USING (doc_id)
"""

#: The lists hold the units of a text; parts are joined from slices of them.
ORACLE["op11_fill_middle"] = r"""
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || CAST(doc_id AS VARCHAR)) AS hex,
           regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
    FROM documents
), drawn AS (
    SELECT *, len(units) AS n, CAST('0x' || hex[1:8] AS BIGINT) AS h1, CAST('0x' || hex[9:16] AS BIGINT) AS h2,
           CAST('0x' || hex[17:24] AS BIGINT) AS h3, CAST('0x' || hex[25:32] AS BIGINT) AS h4
    FROM cut
), formed AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
                WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
), parts AS (
    SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS suffix
    FROM formed
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

#: A bigram model.  Discounts follow from counts of counts, and are the fixed ones where these leave them out of range.
ORACLE["op12_lm_scores"] = r"""
WITH texts AS (
    SELECT row_number() OVER () AS row, doc_id,
           list_concat(['> '], regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), ['< ']) AS words
    FROM documents
), crc_table AS (
    SELECT n, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n) AS v
    FROM (SELECT unnest(range(256)) AS n)
), crc_list AS (SELECT list(v ORDER BY n) AS t FROM crc_table),
parted AS (
    SELECT row, doc_id, words, xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT)),
               lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295) % 10 AS part
    FROM texts, crc_list
), bigrams AS (
    SELECT row, part, unnest(words[:-2]) AS v, unnest(words[2:]) AS w FROM parted
), counts AS (
    SELECT v, w, count(*) AS c FROM bigrams WHERE part <> 0 GROUP BY v, w
), contexts AS (
    SELECT v, sum(c) AS total, count(*) FILTER (c = 1) AS once, count(*) FILTER (c = 2) AS twice, count(*) FILTER (c > 2) AS often FROM counts GROUP BY v
), singles AS (
    SELECT w, count(*) AS c, sum(c) AS seen FROM counts GROUP BY w
), of_counts AS (
    SELECT 2 AS k, count(*) FILTER (c = 1) AS n1, count(*) FILTER (c = 2) AS n2, count(*) FILTER (c = 3) AS n3, count(*) FILTER (c = 4) AS n4, count(*) FILTER (c > 2) AS more, sum(c) AS total FROM counts
    UNION ALL
    SELECT 1, count(*) FILTER (c = 1), count(*) FILTER (c = 2), count(*) FILTER (c = 3), count(*) FILTER (c = 4), count(*) FILTER (c > 2), sum(c) FROM singles
), raw AS (
    SELECT *, 1 - 2 * n1 / (n1 + 2 * n2) * n2 / nullif(n1, 0) AS r1, 2 - 3 * n1 / (n1 + 2 * n2) * n3 / nullif(n2, 0) AS r2, 3 - 4 * n1 / (n1 + 2 * n2) * n4 / nullif(n3, 0) AS r3,
           n1 > 0 AND n2 > 0 AND n3 > 0 AND n4 > 0 AS told
    FROM of_counts
), discounts AS (
    SELECT *, told AND r1 > 0 AND r1 < 1 AND r2 > 0 AND r2 < 2 AND r3 > 0 AND r3 < 3 AS fit FROM raw
), d AS (
    SELECT k, n1, n2, more, total, CASE WHEN fit THEN r1 ELSE 0.5 END AS d1, CASE WHEN fit THEN r2 ELSE 1.0 END AS d2, CASE WHEN fit THEN r3 ELSE 1.5 END AS d3 FROM discounts
), whole AS (SELECT count(*) AS vocabulary, sum(seen) AS seen FROM singles),
scored AS (
    SELECT b.row, coalesce(s.seen, 0) AS seen, whole.seen AS all_seen, vocabulary,
           (coalesce(s.c, 0) - CASE coalesce(s.c, 0) WHEN 0 THEN 0 WHEN 1 THEN l.d1 WHEN 2 THEN l.d2 ELSE l.d3 END
            + (l.d1 * l.n1 + l.d2 * l.n2 + l.d3 * l.more) / (vocabulary + 1)) / l.total AS lower,
           coalesce(c.c, 0) - CASE coalesce(c.c, 0) WHEN 0 THEN 0 WHEN 1 THEN h.d1 WHEN 2 THEN h.d2 ELSE h.d3 END AS left_over,
           h.d1 * once + h.d2 * twice + h.d3 * often AS rest, x.total
    FROM bigrams b CROSS JOIN whole JOIN d l ON l.k = 1 JOIN d h ON h.k = 2
    LEFT JOIN counts c USING (v, w) LEFT JOIN contexts x USING (v) LEFT JOIN singles s ON s.w = b.w
), summed AS (
    SELECT row, count(*) AS n_tokens, count(*) FILTER (seen > 0) AS n_known, any_value(all_seen) AS train_tokens,
           sum(log10((seen + 0.1) / (all_seen + 0.1 * (vocabulary + 1)))) AS base_score,
           sum(log10(CASE WHEN total > 0 THEN (left_over + rest * lower) / total ELSE lower END)) AS score
    FROM scored GROUP BY row
)
SELECT doc_id, part = 0 AS held_out, n_tokens, n_known, CAST(train_tokens AS BIGINT) AS train_tokens, CAST(base_score AS DOUBLE) AS base_score, CAST(score AS DOUBLE) AS score
FROM parted JOIN summed USING (row)
"""

#: Components are whole numbers, so sums of products of doubles are exact.
ORACLE["op13_hard_negatives"] = """
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
    FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN pairs n USING (anchor_id)
WHERE NOT n.same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
