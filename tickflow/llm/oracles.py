"""DuckDB SQL for the queries that SQL can express."""

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

NEAR_DUPLICATES = rf"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN []
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) END AS s
    FROM split
), classes AS (
    SELECT min(doc_id) AS rep, list_sort(s) AS s, len(list_sort(s)) AS n FROM sets WHERE len(s) > 0 GROUP BY ALL
), shingled AS (
    SELECT rep, n, unnest(s) AS sh FROM classes
), pairs AS (
    SELECT a.rep AS a, b.rep AS b, a.n AS na, b.n AS nb, count(*) AS o
    FROM shingled a JOIN shingled b ON a.sh = b.sh AND a.rep < b.rep GROUP BY ALL
), links AS (
    SELECT a, b FROM pairs WHERE 100 * o >= 75 * (na + nb - o)
), edges AS (
    SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
    SELECT rep AS node, rep AS label FROM classes
    UNION
    SELECT e.b, r.label FROM reach r JOIN edges e ON e.a = r.node
), found AS (
    SELECT node, min(label) AS label FROM reach GROUP BY node
)
SELECT d.doc_id, len(d.s)::BIGINT AS n_shingles, coalesce(f.label, d.doc_id) AS component_id,
    d.doc_id = coalesce(f.label, d.doc_id) AS kept
FROM sets d LEFT JOIN classes c ON list_sort(d.s) = c.s AND len(d.s) > 0 LEFT JOIN found f ON f.node = c.rep
"""

DECONTAMINATION = rf"""
WITH dw AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), iw AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), win AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS size,
        unnest([array_to_string(w[i:i + 9], ' ') for i in range(1, greatest(len(w) - 9, 1) + 1)]) AS t
    FROM iw WHERE len(w) > 0
), places AS (
    SELECT doc_id, size,
        unnest([{{'i': i, 't': array_to_string(w[i:i + size - 1], ' ')}} for i in range(1, len(w) - size + 2)]) AS p
    FROM dw, (SELECT DISTINCT size FROM win) WHERE len(w) >= size
), spans AS (
    SELECT DISTINCT doc_id, p.i AS i, places.size AS size, item_id
    FROM places JOIN win ON p.t = win.t AND places.size = win.size
), hit AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM spans) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM spans) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

CHAT = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL
    SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), ordered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS place,
        length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) + length(regexp_replace(
            replace(replace(role, '%', '%25'), chr(10), '%0A'), '<(\\*)\|', '<\1\\|', 'g'
        )) + 24 AS chars
    FROM turns
), joined AS (
    SELECT conv_id, count(*) AS n_turns, sum(chars)::BIGINT AS formatted_chars,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY place) AS said,
        coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '') AS loss
    FROM ordered GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars,
    sha256(loss) AS loss_sha256, formatted_chars
FROM joined
"""

# crc32 by its table, byte by byte; a conversation is the list of its turns' digests and roles.
PREFIX_TRIE = r"""
WITH ordered AS (
    SELECT conv_id, sha256(coalesce(text, '')) || coalesce(role, '') AS said, length(coalesce(text, '')) AS chars,
        row_number() OVER (
            PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))
        ) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), crc AS (
    SELECT list(list_reduce(
        list_concat([i], range(8)), lambda a, k: xor(a >> 1, 3988292384 * (a & 1))
    ) ORDER BY i) AS entries FROM range(256) r(i)
), named AS (
    SELECT conv_id, conv_id - conv_id % 100 AS first, xor(list_reduce(
        list_concat([4294967295], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
        lambda a, x: xor(a >> 8, entries[(xor(a, x) & 255) + 1])
    ), 4294967295) % 6 AS shared
    FROM (SELECT DISTINCT conv_id FROM ordered), crc
), items AS (
    SELECT n.conv_id, 0 AS part, place, said, chars FROM named n JOIN ordered o ON o.conv_id = n.first AND place <= shared
    UNION ALL
    SELECT n.conv_id, 1, place, said, chars FROM named n JOIN ordered o ON o.conv_id = n.conv_id AND place > shared
), listed AS (
    SELECT conv_id, list(said ORDER BY part, place) AS s, list(chars ORDER BY part, place) AS l FROM items GROUP BY conv_id
), rebuilt AS (
    SELECT conv_id, coalesce(s, []::VARCHAR[]) AS s, coalesce(l, []::BIGINT[]) AS l FROM named LEFT JOIN listed USING (conv_id)
), prefixes AS (
    SELECT conv_id, s, l, unnest(range(0, len(s) + 1)) AS d FROM rebuilt
), nodes AS (
    SELECT s[1:d] AS p, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(CASE WHEN d = 0 THEN 0 ELSE l[d] END) AS chars,
        coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(s) = d), '') AS ends
    FROM prefixes GROUP BY s[1:d], d
), children AS (
    SELECT p[1:d - 1] AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY p[1:d - 1]
), known AS (
    SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (p)
), below AS (
    SELECT p[1:e] AS p, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * chars)::BIGINT AS saved_tokens
    FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM known) GROUP BY p[1:e]
)
SELECT k.conv_id, k.d AS depth, u.conv_id AS parent_conv_id, k.n_convs, k.n_children, b.n_leaves, b.saved_tokens,
    sha256(k.ends) AS ends_sha256
FROM known k JOIN below b USING (p) LEFT JOIN nodes u ON k.d > 0 AND u.p = k.p[1:k.d - 1]
"""
