"""SQL for the operators that SQL can express over whole tables; the others are held against brute force in the tests."""

# Words by splitting; a window's place is the document and the word it starts at.
FM_DEDUP = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS (SELECT doc_id, i, list_slice(w, i, i + 19) AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS n FROM win) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM again, (SELECT unnest(range(0, 20)) AS k)),
word AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id"""

_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
item AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark),
win AS (SELECT list_slice(w, i, i + 12) AS s, list(DISTINCT item) AS items FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item WHERE len(w) > 0) GROUP BY s),
size AS (SELECT DISTINCT len(s) AS n FROM win),
place AS (SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS s FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, size WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, n, items FROM place JOIN win USING (s)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS items FROM (SELECT doc_id, unnest(items) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

# Bytes as pairs of hexadecimal digits; runs of windows that touch are one removed span.
SA_DEDUP = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM d WHERE len(h) >= 100)),
least AS (SELECT s, min(doc_id) AS f FROM win GROUP BY s HAVING min(doc_id) < max(doc_id)),
again AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM win JOIN least USING (s) WHERE f < doc_id),
span AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM again) GROUP BY doc_id, run),
piece AS (SELECT doc_id, a AS place, substr(h, 2 * f + 1, 2 * (a - f)) AS part FROM (SELECT doc_id, a, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS f FROM span) JOIN d USING (doc_id)
UNION ALL SELECT doc_id, len(h), substr(h, 2 * b + 1) FROM (SELECT doc_id, max(b) AS b FROM span GROUP BY doc_id) JOIN d USING (doc_id)),
kept AS (SELECT doc_id, string_agg(part, '' ORDER BY place) AS k FROM piece GROUP BY doc_id),
gone AS (SELECT doc_id, sum(b - a) AS n, count(*) AS spans FROM span GROUP BY doc_id)
SELECT d.doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256 FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id LEFT JOIN gone ON d.doc_id = gone.doc_id"""
