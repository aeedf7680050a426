"""SQL for the registered queries that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

ORACLES: dict[str, str] = {}

ORACLES["op1_mixing"] = rf"""
WITH sized AS (
    SELECT doc_id, source,
        CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
        CAST('0x' || substr(md5(
            coalesce('+' || CAST(doc_id AS VARCHAR), '-') || chr(31) || coalesce('+' || text, '-')
        ), 1, 15) AS BIGINT) AS place
    FROM documents
), ranked AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        row_number() OVER (ORDER BY source NULLS LAST) AS rank
    FROM sized GROUP BY source
), weighed AS (
    SELECT *, [3, 1, 2][(rank - 1) % 3 + 1] AS weight, source_size * 2 AS full_at FROM ranked
), levels AS (
    SELECT *, row_number() OVER filling AS turn,
        (sum(source_size) OVER () * 1.5::DOUBLE
            - coalesce(sum(full_at) OVER (filling ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / (sum(weight) OVER ()
            - coalesce(sum(weight) OVER (filling ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            AS level
    FROM weighed
    WINDOW filling AS (ORDER BY full_at / weight, rank)
), opened AS (
    SELECT turn AS first_turn, level AS last_level FROM levels
    WHERE level * weight < full_at ORDER BY turn LIMIT 1
), targets AS (
    SELECT source, source_size,
        CASE WHEN first_turn IS NULL OR turn < first_turn THEN CAST(full_at AS DOUBLE)
            ELSE last_level * weight END AS target
    FROM levels LEFT JOIN opened ON true
), placed AS (
    SELECT s.*, t.source_size, t.target,
        CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
        sum(s.size) OVER (PARTITION BY s.source ORDER BY place) - s.size AS earlier
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
    CAST(size * (whole + CASE
        WHEN target - whole * source_size <= 0 THEN 0
        WHEN 2 * (target - whole * source_size - earlier) >= size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed
"""

ORACLES["op2_decontaminate"] = r"""
WITH item_words AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), windows AS (
    SELECT DISTINCT item, w[start:start + 12] AS win, least(len(w), 13) AS n
    FROM item_words, LATERAL (SELECT unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS start)
    WHERE len(w) > 0
), doc_words AS (
    SELECT doc_id, coalesce(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
    FROM documents
), lengths AS (SELECT DISTINCT n FROM windows
), places AS (
    SELECT doc_id, n, start, array_to_string(w[start:start + n - 1], ' ') AS words
    FROM doc_words, lengths, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS start)
    WHERE len(w) >= n
), found AS (
    SELECT p.doc_id, p.start, p.n, w.item FROM places p
    JOIN windows w ON w.n = p.n AND array_to_string(w.win, ' ') = p.words
), hits AS (
    SELECT doc_id, count(DISTINCT word) AS n_hit
    FROM found, LATERAL (SELECT unnest(range(start, start + n)) AS word) GROUP BY doc_id
), held AS (
    SELECT doc_id, count(DISTINCT item) AS n_items,
        string_agg(DISTINCT item, ',' ORDER BY item) AS items
    FROM found GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words d LEFT JOIN hits h ON h.doc_id = d.doc_id LEFT JOIN held i ON i.doc_id = d.doc_id
"""

ORACLES["op3_quality"] = rf"""
WITH parts AS (
    SELECT doc_id, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)),
            lambda line: regexp_matches(line, '{WORD}')) AS lines
    FROM documents
), windows AS (
    SELECT doc_id, start, array_to_string(w[start:start + 2], ' ') AS words
    FROM parts, LATERAL (SELECT unnest(range(1, len(w) - 1)) AS start) WHERE len(w) >= 3
), repeated AS (
    SELECT doc_id, start, count(*) OVER (PARTITION BY doc_id, words) AS n FROM windows
), covered AS (
    SELECT doc_id, count(DISTINCT word) AS n
    FROM repeated, LATERAL (SELECT unnest(range(start, start + 3)) AS word)
    WHERE n >= 2 GROUP BY doc_id
), measured AS (
    SELECT p.doc_id, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT)
            AS n_symbols,
        CAST(len(lines) AS BIGINT) AS n_lines,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
    FROM parts p LEFT JOIN covered c ON c.doc_id = p.doc_id
), failed AS (
    SELECT *, CAST((n_words < 50)::INT
        + 2 * (100 * n_repeat_words > 50 * n_words)::INT
        + 4 * (10 * n_symbols > n_words)::INT
        + 8 * (10 * n_dup_lines > 3 * n_lines)::INT
        + 16 * (word_chars > 14 * n_words)::INT
        + 32 * (word_chars < 2 * n_words)::INT
        + 64 * (100 * n_repeat_words > 20 * n_words)::INT AS BIGINT) AS failed_bits
    FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    failed_bits & 3 <> 0 AS base_failed, failed_bits = 0 AS kept, failed_bits
FROM failed
"""

ORACLES["op6_chat"] = r"""
WITH named AS (
    SELECT row_number() OVER () AS number, conv_id, turn, replace(translate(
            coalesce(role, 'unknown'), chr(13) || chr(10), '  '), '<|im_', '<| im_') AS role,
        replace(coalesce(text, ''), '<|im_', '<| im_') AS text
    FROM conversations
), turns AS (
    SELECT *, role = 'system' AS instruction,
        coalesce(CAST(conv_id AS VARCHAR), 'row ' || number) AS conversation,
        row_number() OVER (PARTITION BY coalesce(CAST(conv_id AS VARCHAR), 'row ' || number)
            ORDER BY turn NULLS LAST, role, text) - 1 AS place
    FROM named
), speaking AS (
    SELECT DISTINCT conversation, role AS participant FROM turns WHERE NOT instruction
), parts AS (
    SELECT t.*, place // 512 AS segment, participant,
        NOT instruction AND role = participant AS own,
        '<|im_start|>' || CASE WHEN instruction THEN role
            WHEN role = participant THEN 'assistant' ELSE 'user name=' || role END || chr(10) AS head,
        text || '<|im_end|>' || chr(10) AS body
    FROM turns t JOIN speaking s ON t.conversation = s.conversation
), placed AS (
    SELECT *, sum(length(head) + length(body)) OVER (
        PARTITION BY conversation, participant, segment ORDER BY place
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - length(body) AS start
    FROM parts
)
SELECT any_value(conv_id) AS conv_id, participant, CAST(segment AS BIGINT) AS segment,
    count(*) AS n_turns, count(*) FILTER (own) AS n_trained,
    string_agg(head || body, '' ORDER BY place) AS rendered,
    coalesce(string_agg(CASE WHEN own THEN CAST(start AS BIGINT) || ':' || length(body) END, ','
        ORDER BY place), '') AS mask
FROM placed GROUP BY conversation, participant, segment
"""

ORACLES["op9_line_dedup"] = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
    FROM documents
), keyed AS (
    SELECT doc_id, place, line, translate(regexp_replace(line,
            '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), repeated AS (
    SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
    SELECT k.*, r.key IS NOT NULL AND k.doc_id < r.last_doc AS dropped
    FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

ORACLES["op12_divergence"] = r"""
WITH docs AS (
    SELECT row_number() OVER () AS number, coalesce(lang, '') AS lang,
        coalesce(source, '') AS source, coalesce(text, '') AS text
    FROM documents
), words AS (
    SELECT number, lang, source, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM docs
), kept AS (
    SELECT lang, term, count(*) AS n FROM words
    GROUP BY lang, term HAVING count(DISTINCT number) >= 3
), langs AS (
    SELECT lang, count(*) AS terms, sum(n) AS total FROM kept GROUP BY lang
), found AS (
    SELECT w.lang, w.source, w.term, count(*) AS n
    FROM words w JOIN kept k ON w.lang = k.lang AND w.term = k.term
    GROUP BY w.lang, w.source, w.term
), groups AS (
    SELECT g.lang, g.source, coalesce(any_value(l.terms), 0) AS terms,
        coalesce(sum(f.n), 0) AS total
    FROM (SELECT DISTINCT lang, source FROM docs) g
    LEFT JOIN langs l ON g.lang = l.lang
    LEFT JOIN found f ON g.lang = f.lang AND g.source = f.source
    GROUP BY g.lang, g.source
), shares AS (
    SELECT g.lang, g.source, k.term, coalesce(f.n, 0) AS n,
        1 + 1000000000::HUGEINT * (coalesce(f.n, 0) + 1) // (g.total + g.terms) AS p,
        1 + 1000000000::HUGEINT * (k.n + 1) // (l.total + l.terms) AS q
    FROM groups g JOIN kept k ON g.lang = k.lang JOIN langs l ON g.lang = l.lang
    LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term
), pairs AS (
    SELECT a.lang, a.source, b.source AS item,
        coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
    WHERE x.term IS NULL OR y.term IS NOT NULL
    GROUP BY a.lang, a.source, b.source
), parts AS (
    SELECT lang, source, 'pair' AS part, item, value FROM pairs
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (
        PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
    FROM parts
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""
