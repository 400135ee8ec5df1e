"""DuckDB SQL that gives the rows of registered queries, where SQL can express them."""

WORD = r"[^\x20\x09-\x0D]+"

LINE_QUALITY = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, regexp_extract_all(text, '{WORD}') AS ws FROM docs),
windows AS (
    SELECT r, i, [ws[i], ws[i + 1], ws[i + 2]] AS win
    FROM (SELECT r, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM w WHERE len(ws) >= 4)
),
again AS (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM windows),
covered AS (
    SELECT r, count(DISTINCT p) AS n_repeat_words
    FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM again WHERE n >= 2) GROUP BY r
),
lines AS (
    SELECT r, source, line FROM (SELECT r, source, unnest(string_split(text, chr(10))) AS line FROM docs)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
),
dups AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY r),
normal AS (
    SELECT r, source,
        regexp_replace(lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'))), '[0-9]', '0', 'g') AS line
    FROM lines
),
holders AS (
    SELECT source, line, count(DISTINCT d.text) AS n_texts
    FROM (SELECT DISTINCT r, source, line FROM normal) JOIN (SELECT r, text FROM docs) d USING (r)
    GROUP BY source, line
),
removed AS (
    SELECT n.r, sum(len(n.line) - len(replace(n.line, ' ', '')) + 1) AS words_removed
    FROM normal n JOIN holders h ON n.line = h.line AND n.source IS NOT DISTINCT FROM h.source
    WHERE n_texts > 20 GROUP BY n.r
),
measured AS (
    SELECT doc_id, len(ws)::BIGINT AS n_words, len(array_to_string(ws, ''))::BIGINT AS word_chars,
        len(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
        coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
        coalesce(words_removed, 0)::BIGINT AS words_removed
    FROM docs JOIN w USING (r) LEFT JOIN covered USING (r) LEFT JOIN dups USING (r) LEFT JOIN removed USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
        AND NOT 100 * (n_words - words_removed) < 30 * n_words AS kept,
    words_removed
FROM measured
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws
    FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, [ws[i], ws[i + 1], ws[i + 2], ws[i + 3]] AS s
    FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 3)) AS i FROM docs WHERE len(ws) >= 4)
    UNION ALL SELECT doc_id, ws FROM docs WHERE len(ws) BETWEEN 1 AND 3
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
),
links AS (
    SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * shared >= 80 * (x.n + y.n - shared)
),
reached AS (
    SELECT doc_id AS a, doc_id AS b FROM docs UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
),
components AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM components LEFT JOIN sizes USING (doc_id)
"""

TOP_K = """
WITH rows AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM rows q JOIN rows c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

WARC = """
WITH p AS (
    SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
),
bits AS (SELECT *, unhex(hex)::BIT::VARCHAR AS b FROM p),
digits AS (
    SELECT page_id, payload_bytes, hex, array_to_string(list_transform(range(0, 160, 5), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * substr(b, i + 1, 1)::INT + 8 * substr(b, i + 2, 1)::INT
            + 4 * substr(b, i + 3, 1)::INT + 2 * substr(b, i + 4, 1)::INT + substr(b, i + 5, 1)::INT, 1)), '') AS payload_digest
    FROM bits
),
owned AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS owner FROM digits)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = owner THEN NULL ELSE owner END AS refers_to
FROM owned
"""

HARD_NEGATIVES = """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
        list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
),
positives AS (
    SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
),
ranked AS (
    SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)::INT AS rank
    FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
        AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
"""

SPELLINGS = """
WITH RECURSIVE crc_table AS (
    SELECT list(c ORDER BY i) AS t FROM (
        SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
            lambda c, s: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS c
        FROM (SELECT unnest(range(256)) AS i))
),
found AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{6,}')) AS run FROM documents)
),
runs AS (SELECT id, run, count(*) AS n, hex(encode(id || ':' || run)) AS h FROM found GROUP BY id, run),
marked AS (
    SELECT run, n, xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(range(1, len(h), 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) AS mark
    FROM runs, crc_table
),
changed AS (
    SELECT CASE WHEN mark % 199 = 0 THEN substr(run, 1, mark % length(run)) || substr(run, mark % length(run) + 2) ELSE run END AS word, n
    FROM marked
),
words AS (SELECT word, sum(n)::BIGINT AS n FROM changed WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
holes AS (
    SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
    FROM (SELECT word, unnest(generate_series(1, length(word))) AS i FROM words)
),
shorter AS (SELECT DISTINCT h.word AS a, w.word AS b FROM holes h JOIN words w ON h.rest = w.word),
near AS (
    SELECT x.word AS a, y.word AS b FROM holes x JOIN holes y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word
    UNION SELECT a, b FROM shorter UNION SELECT b, a FROM shorter
),
ranked AS (
    SELECT a, b, w.n AS n_b, count(*) OVER (PARTITION BY a) AS n_near, row_number() OVER (PARTITION BY a ORDER BY w.n DESC, b) AS r
    FROM near JOIN words w ON w.word = b
),
formed AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN n_b >= 5 * n THEN b END AS form, CASE WHEN n_b >= 5 * n THEN n_b END AS form_n
    FROM words LEFT JOIN ranked ON a = word AND r = 1
),
followed AS (
    SELECT word, word AS root FROM formed
    UNION ALL SELECT f.word, g.form FROM followed f JOIN formed g ON f.root = g.word WHERE g.form IS NOT NULL
),
roots AS (SELECT f.word, f.root FROM followed f JOIN formed g ON f.root = g.word WHERE g.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)
"""
